"""Sharding by histogram sort, in DataFrame operations only.

Rows are sorted by (CRC-32 of the text, id, place), so equal texts stand side by side and the order is
total.  Splitters are found by counting exact bytes and rows below candidate boundaries: each round
cuts every undecided interval of keys into ``2**RADIX`` probes, counts all rows of the intervals
by one pre-aggregated groupBy, and keeps the probe interval in which the target lies, until it is
within tolerance or one row.  Then the rows are exchanged once, by the range they fall in, and numbered.

A shard is cut further into ranges of about equal row counts (same rounds, other targets), so that
numbering the rows of a shard is no single task's work however large the shard or a group of copies.

Defined cases: a null text has no bytes and CRC 0; a null id sorts first; repeated rows are kept apart by
their place in the input; an empty table gives an empty result; with fewer rows than shards
some shards are empty.  Columns of the input other than the key are returned if named in ``carry``.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sourcelens.llm.common import cut

RADIX = 12
#: A splitter may be off by this part of a shard's share; one row is as near as it gets.
TOLERANCE = 1e-4
#: Inner ranges hold at most about so many rows each.
RANGE_ROWS = 1_000_000
MIN_RANGES = 64
KEYS = ("_k0", "_k1", "_k2")


@dataclass
class Splitter:
    """First key of the upper side: rows with (k0, k1, k2) >= key are above.  ``rows`` are below."""
    key: tuple
    rows: int
    size: int


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    raw = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))
    return docs.select(F.col(id_col).alias(id_col), (F.length(raw) + 16).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"),
                       F.crc32(raw).alias("_k0"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("_k1"),
                       F.monotonically_increasing_id().alias("_k2"), *carry)


@dataclass
class _Open:
    """A target still undecided: ``below`` is counted under the key interval [lo, lo + 2**shift) of component ``level``."""
    target: float
    measure: str
    slack: float
    prefix: tuple
    rows: int = 0
    size: int = 0


def _spread(df: DataFrame, level: int) -> tuple[int, int]:
    lo, hi = df.agg(F.min(KEYS[level]), F.max(KEYS[level])).first()
    return lo, hi


def _refine(df: DataFrame, opened: list[_Open], level: int) -> list[tuple[_Open, Splitter]]:
    """Splitters of targets that lie among the rows whose earlier key parts equal ``prefix``."""
    if not opened:
        return []
    done: list[tuple[_Open, Splitter]] = []
    deeper: list[_Open] = []
    prefixes = sorted({o.prefix for o in opened})
    within = df
    if level:
        within = df.where(F.struct(*KEYS[:level]).isin([F.struct(*[F.lit(x).cast("bigint") for x in p]) for p in prefixes]))
    lo, hi = _spread(within, level)
    shift = max(0, (hi - lo).bit_length() - RADIX)
    top = {p: [((lo >> shift), (hi >> shift) + 1)] for p in prefixes}  # intervals of buckets at this shift
    todo = [(o, None) for o in opened]  # None: the whole interval; else the bucket of the round before
    last_shift = None
    while todo:
        if last_shift is None:
            part = within
        else:  # only rows in the buckets that hold a target
            open_keys = sorted({(o.prefix, b) for o, b in todo})
            coarse = F.shiftright(F.col(KEYS[level]), last_shift)
            if level:
                part = within.where(F.struct(*KEYS[:level], coarse.alias("b")).isin(
                    [F.struct(*[F.lit(x).cast("bigint") for x in (*p, b)]) for p, b in open_keys]))
            else:
                part = within.where(coarse.isin([b for _, b in open_keys]))
        bucket = F.shiftright(F.col(KEYS[level]), shift)
        counted = (part.groupBy(*KEYS[:level], bucket.alias("_b")).agg(F.count("*").alias("n"), F.sum("size").alias("s"))
                   .collect())  # at most 2**RADIX probes per open interval
        tables: dict = {}
        for r in counted:
            p = tuple(r[k] for k in KEYS[:level])
            tables.setdefault((p, None if last_shift is None else r["_b"] >> (last_shift - shift)), []).append((r["_b"], r["n"], r["s"]))
        sums = {}
        for k, v in tables.items():
            v.sort()
            n = s = 0
            rows, sizes = [], []
            for _, a, b in v:
                n, s = n + a, s + b
                rows.append(n)
                sizes.append(s)
            sums[k] = ([x[0] for x in v], rows, sizes)
        again = []
        for o, b in todo:
            buckets, rows, sizes = sums[(o.prefix, b)]
            ends = rows if o.measure == "rows" else sizes
            base = o.rows if o.measure == "rows" else o.size
            i = min(bisect_left(ends, o.target - base), len(ends) - 1)
            under_rows, under_size = o.rows + (rows[i - 1] if i else 0), o.size + (sizes[i - 1] if i else 0)
            over_rows, over_size = o.rows + rows[i], o.size + sizes[i]
            under, over = (under_rows, over_rows) if o.measure == "rows" else (under_size, over_size)
            first = buckets[i] << shift
            if min(o.target - under, over - o.target) <= o.slack or over_rows - under_rows <= 1:
                lower = o.target - under <= over - o.target or (buckets[i] + 1) << shift >= 2**63
                key = first if lower else (buckets[i] + 1) << shift
                done.append((o, Splitter((*o.prefix, key), under_rows if lower else over_rows, under_size if lower else over_size)))
            elif shift == 0:
                deeper.append(_Open(o.target, o.measure, o.slack, (*o.prefix, first), under_rows, under_size))
            else:
                again.append((_Open(o.target, o.measure, o.slack, o.prefix, under_rows, under_size), buckets[i]))
        todo, last_shift, shift = again, shift, max(0, shift - RADIX)
    return done + (_refine(df, deeper, level + 1) if deeper else [])


def _full(key: tuple) -> tuple:
    """A splitter on the first parts of the key stands below every row that starts so."""
    return key + (-(2**63),) * (3 - len(key))


def find_splitters(keyed: DataFrame, targets: list[tuple[float, str, float]]) -> list[Splitter]:
    """For each (target, measure ``rows`` or ``size``, slack) the splitter below which that much lies."""
    found = _refine(keyed, [_Open(t, m, s, ()) for t, m, s in targets], 0)
    by = {(o.target, o.measure): s for o, s in found}
    return [Splitter(_full((s := by[(t, m)]).key), s.rows, s.size) for t, m, _ in targets]


def _rank_among(splitters: list[Splitter]) -> Column:
    """How many splitters are at or below the row's key: a binary search over a literal array."""
    text = json.dumps([dict(zip("abc", s.key, strict=True)) for s in splitters])
    at = F.from_json(F.lit(text), "array<struct<a:bigint,b:bigint,c:bigint>>")
    key = F.struct(*[F.col(k).alias(a) for k, a in zip(KEYS, "abc", strict=True)])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(splitters).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        (low + step <= len(splitters)) & (F.get(at, F.least(low + step, F.lit(len(splitters))) - 1) <= key), low + step).otherwise(low))


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                    carry: tuple[str, ...] = (), tolerance: float = TOLERANCE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``id``, size, text_crc32, shard, slot, and the columns of ``carry``; shards of near equal bytes, in key order."""
    carry = [c for c in carry if c not in {id_col, "size", "text_crc32", "shard", "slot", *KEYS}]
    keyed = cut(_keyed(docs, id_col, text_col, carry))
    total, size = keyed.agg(F.count("*"), F.sum("size")).first()
    out = [id_col, "size", "text_crc32", *carry]
    if not total:
        return keyed.select(*out, F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    ranges = max(MIN_RANGES, -(-total // range_rows))
    targets = [(size * i / n_shards, "size", tolerance * size / n_shards) for i in range(1, n_shards)]
    targets += [(total * i / ranges, "rows", 0.2 * total / ranges) for i in range(1, ranges)]
    all_ = find_splitters(keyed, targets)
    outer = sorted(all_[: n_shards - 1], key=lambda s: s.key)
    inner = sorted({s.key: s for s in all_}.values(), key=lambda s: s.key)
    below = [0, *(s.rows for s in inner)]  # rows below each range
    start = [0, *(s.rows for s in outer)]  # rows below each shard
    shard_of = [0, *(sum(o.key <= s.key for o in outer) for s in inner)]
    skip = F.from_json(F.lit(json.dumps([b - start[k] for b, k in zip(below, shard_of, strict=True)])), "array<bigint>")
    shard = F.from_json(F.lit(json.dumps(shard_of)), "array<int>")
    placed = keyed.withColumn("_r", _rank_among(inner))
    nth = F.row_number().over(W.partitionBy("_r").orderBy(*KEYS))
    return placed.select(*out, F.get(shard, F.col("_r")).alias("shard"),
                         (F.get(skip, F.col("_r")) + nth - 1).alias("slot"))
