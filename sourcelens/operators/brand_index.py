"""Brand mentions for catalogs of any length (J11, F8): an inverted join instead of one substring scan per brand.

Every place of a text is looked at once: hashes of the byte strings that begin there, of the lengths that names have, are looked up in a Bloom filter of all
lower-cased names.  What passes leaves the task as the byte string itself with the keys of its texts, and meets the catalog in an equi-join, so the filter's
errors change nothing.  Texts stay where they are; what moves grows with the mentions.  The plan has the same size for ten brands and for a million, and
work per text is its places and mentions, not the catalog.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcelens.llm.common import map_arrow

#: Characters of a gram; a shorter name is its own gram.
GRAM = 4
#: A catalog of up to so many brands (some 100 bytes each) is broadcast; a larger one meets the texts' mentions in a shuffle.
MAX_BROADCAST_BRANDS = 200_000
#: Bits of the filter for each of its keys, and at most (32 MB): with a longer catalog more strings pass that are no names, and the join drops them.
BITS_PER_KEY = 32
MAX_BITS = 1 << 28
PROBES = 4
#: Bytes of text looked at together, and mentions that leave a task together.
SLICE = 1 << 20
MENTIONS = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_MIX, _LENGTH, _START = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, n of them at least."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(max(n, SLICE + 1), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[base]


class _Bytes:
    """Byte strings one after the other, and hashes of any piece of them from sums over the starts."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, len(data) + 1)[:len(data)], out=self.sums[1:])
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def hashes(self, at: np.ndarray | None, n: int, start: bool) -> np.ndarray:
        """Hashes of the ``n`` bytes from each place ``at`` (None: from all places); ``start``: as the start of a longer name."""
        last = len(self.data) - n + 1
        x = (self.sums[n:] - self.sums[:last]) * self.inverse[:last] if at is None else (self.sums[at + n] - self.sums[at]) * self.inverse[at]
        x += np.uint64((n * _LENGTH + start * _START) % (1 << 64))
        x ^= x >> np.uint64(32)
        x *= np.uint64(_MIX)
        x ^= x >> np.uint64(29)
        return x


def _bits(h: np.ndarray, j: int, size: int) -> np.ndarray:
    """The ``j``-th bit of each hash in a filter of ``size`` bits, a power of two."""
    return (h + np.uint64(j) * (h >> np.uint64(32) | np.uint64(1))) & np.uint64(size - 1)


def _in_filter(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places in ``h`` of the hashes that the filter may hold."""
    kept = None
    for j in range(PROBES):
        b = _bits(h if kept is None else h[kept], j, len(bits) * 8)
        hit = np.flatnonzero((bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & np.uint8(1))
        kept = hit if kept is None else kept[hit]
    return kept


def _tier(n: int) -> int:
    """The power of two whose first bytes a name of ``n`` bytes is looked up by."""
    return 1 << (n.bit_length() - 1)


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points that begin at the places ``at``."""
    b = [data[np.minimum(at + k, len(data) - 1)].astype(np.int64) for k in range(4)]
    tail = [x & 63 for x in b]
    return np.select([b[0] < 0x80, b[0] < 0xE0, b[0] < 0xF0], [b[0], (b[0] & 31) << 6 | tail[1], (b[0] & 15) << 12 | tail[1] << 6 | tail[2]],
                     (b[0] & 7) << 18 | tail[1] << 12 | tail[2] << 6 | tail[3])


def _before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the characters begin that end right before the places ``at``."""
    at = at - 1
    for _ in range(3):
        at = np.where((data[at] & 0xC0 == 0x80) & (at > 0), at - 1, at)
    return at


def _whole_words(data: np.ndarray, first: np.ndarray, end: np.ndarray, at: np.ndarray, n: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Which of the strings of ``n`` bytes from ``at``, in texts from ``first`` to ``end``, have a word boundary on both sides."""
    def is_word(places):
        return word[np.minimum(_code_points(data, places), len(word) - 1)]

    stop = at + n
    left = np.where(at > first, is_word(_before(data, np.maximum(at, 1))), False)
    right = np.where(stop < end, is_word(np.minimum(stop, len(data) - 1)), False)
    return (left != is_word(at)) & (right != is_word(_before(data, stop)))


def _mentions_in(data: np.ndarray, ends: np.ndarray, lengths: list[int], bits: np.ndarray, word: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(text, place, length, hash) of the strings in ``data``, whose texts end at ``ends``, that the filter may hold, each once for a text."""
    s = _Bytes(data)
    found = []
    for tier in sorted({_tier(n) for n in lengths}):
        if len(data) < tier:
            continue
        starts = _in_filter(s.hashes(None, tier, True), bits)
        stops = ends[np.searchsorted(ends, starts, "right")]
        for n in (n for n in lengths if _tier(n) == tier):
            at = starts[starts + n <= stops]
            h = s.hashes(at, n, False)
            kept = _in_filter(h, bits)
            found.append((at[kept], np.full(len(kept), n), h[kept]))
    at, n, h = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    text = np.searchsorted(ends, at, "right")
    if word is not None and len(at):
        kept = _whole_words(data, np.concatenate([[0], ends])[text], ends[text], at, n, word)
        text, at, n, h = text[kept], at[kept], n[kept], h[kept]
    order = np.lexsort((n, h, text))
    text, at, n, h = text[order], at[order], n[order], h[order]
    # one of the occurrences in a text, by the strings themselves
    same = np.zeros(len(at), bool)
    same[1:] = (text[1:] == text[:-1]) & (h[1:] == h[:-1]) & (n[1:] == n[:-1])
    same[1:] &= _equal(data, at[1:], at[:-1], n[1:], same[1:])
    return text[~same], at[~same], n[~same], h[~same]


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Whether the ``n`` bytes from ``a`` and from ``b`` are the same, where ``asked``."""
    out = np.zeros(len(a), bool)
    for size in np.unique(n[asked]):
        rows = np.flatnonzero(asked & (n == size))
        for at in range(0, len(rows), max(1, SLICE // int(size))):
            r = rows[at:at + max(1, SLICE // int(size))]
            out[r] = (data[a[r][:, None] + np.arange(size)] == data[b[r][:, None] + np.arange(size)]).all(axis=1)
    return out


def _grouped(keys, strings: list[tuple[bytes, int]]) -> pa.RecordBatch:
    """(needle, keys): each string once with the keys of its rows."""
    rows: dict[bytes, list[int]] = {}
    for x, row in strings:
        rows.setdefault(x, []).append(row)
    ends = np.cumsum([0, *map(len, rows.values())])
    taken = keys.take(pa.array([r for x in rows.values() for r in x], pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), taken)], ["needle", "keys"])


def _slices(offsets: np.ndarray):
    """(first, last) rows of slices of whole texts, of ``SLICE`` bytes or one text."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        yield first, last
        first = last


def _found(rows: DataFrame, key: str, lengths: list[int], bits: np.ndarray, word: np.ndarray | None) -> DataFrame:
    """(needle, keys) of ``rows`` (key, _lt): byte strings that may be names, each with the keys of the rows that hold it, once for a row."""
    def run(batches):
        for c in batches:
            texts = c.column("_lt").cast(pa.large_binary())
            if not len(texts):
                continue
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            strings: list[tuple[bytes, int]] = []
            for first, last in _slices(offsets):
                piece = data[offsets[first]:offsets[last]]
                ends = offsets[first + 1:last + 1] - offsets[first]
                raw = piece.tobytes()
                text, at, n, _ = _mentions_in(piece, ends, lengths, bits, word)
                strings += [(raw[a:a + m], t) for t, a, m in zip((text + first).tolist(), at.tolist(), n.tolist(), strict=True)]
                if len(strings) >= MENTIONS:
                    yield _grouped(c.column("_key"), strings)
                    strings = []
            if strings:
                yield _grouped(c.column("_key"), strings)

    schema = T.StructType([T.StructField("needle", T.BinaryType()), T.StructField("keys", T.ArrayType(rows.schema[key].dataType))])
    return map_arrow(rows.select(F.col(key).alias("_key"), "_lt"), run, schema)


def _filter(needles: DataFrame, keys: int) -> np.ndarray:
    """The Bloom filter of ``needles`` (needle binary) and their starts, as bytes.  It is made in the tasks; the driver gets its words, at most ``MAX_BITS``."""
    size = min(MAX_BITS, max(1024, 1 << (keys * BITS_PER_KEY - 1).bit_length()))

    def run(batches):
        for c in batches:
            x = c.column("needle").cast(pa.large_binary())
            if not len(x):
                continue
            offsets = np.frombuffer(x.buffers()[1], np.int64)[x.offset:x.offset + len(x) + 1]
            s = _Bytes(np.frombuffer(x.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]])
            at, n = offsets[:-1] - offsets[0], np.diff(offsets)
            h = [np.zeros(0, np.uint64)]
            for size_ in np.unique(n[n > 0]).tolist():
                own = at[n == size_]
                h += [s.hashes(own, size_, False), s.hashes(own, _tier(size_), True)]
            b = np.unique(np.concatenate([_bits(x, j, size) for x in h for j in range(PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array((b >> np.uint64(6)).astype(np.int64)), pa.array((b & np.uint64(63)).astype(np.int32))], ["at", "bit"])

    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    words = map_arrow(needles, run, "at bigint, bit int").groupBy("at").agg(F.bit_or(one).alias("word")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[words.column("at").to_numpy()] = words.column("word").to_numpy()
    return out.astype("<i8").view(np.uint8)


def _word_table(df: DataFrame) -> np.ndarray:
    """For every code point whether it belongs to a word, as the pattern's boundaries take it."""
    every = df.sparkSession.range(1, 0x110000).where("id NOT BETWEEN 55296 AND 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    inside = every.where(F.regexp_like(char, F.lit(r"(?U)^\w$")))
    out = np.zeros(0x110000, bool)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("id") % 64).cast("int"))
    for r in inside.groupBy((F.col("id") / 64).cast("int").alias("at")).agg(F.bit_or(one).alias("word")).collect():  # some 2,500 numbers
        out[r["at"] * 64:r["at"] * 64 + 64] = [(r["word"] >> k) & 1 for k in range(64)]
    return out


def char_grams(text, n: int) -> Column:
    """The distinct n-grams of a text: every place is looked at once, by a pattern that takes no room.  For n = 0 the empty gram."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array(F.lit("")) if n == 0 else F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), 1))


def _lengths(catalog: DataFrame) -> list[int]:
    """Lengths of grams that occur in the catalog: at most GRAM + 1 numbers."""
    return sorted(r[0] for r in catalog.select(F.least(F.length("needle"), F.lit(GRAM)).alias("n")).distinct().collect())


def _text_grams(lt: str, lengths: list[int]) -> Column:
    return F.explode(F.concat(*[char_grams(lt, n) for n in lengths]))


def _named(catalog: DataFrame) -> DataFrame:
    """(brand_pos, brand, needle, pattern): the pattern finds the name as whole words."""
    needle = F.lower("brand")
    quoted = F.concat(F.lit(r"(?U)\b\Q"), F.replace(needle, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b"))
    return catalog.where("brand IS NOT NULL").select("brand_pos", "brand", needle.alias("needle"), quoted.alias("pattern"))


def brand_index(catalog: DataFrame, texts: DataFrame, text: str = "text", broadcast_brands: int = MAX_BROADCAST_BRANDS) -> DataFrame:
    """(gram, brand_pos, brand, needle, pattern): every brand of ``catalog`` (brand_pos, brand) under its rarest gram, by the number of ``texts`` that have it
    (all are counted).  A brand with a gram that no text has is left out: no text can name it."""
    names = _named(catalog)
    grams = names.select("*", F.explode(F.when(F.length("needle") < GRAM, F.array("needle")).otherwise(char_grams("needle", GRAM))).alias("gram"))
    wanted = grams.select("gram").distinct()
    wanted = F.broadcast(wanted) if names.count() <= broadcast_brands else wanted
    lengths = _lengths(names)
    if not lengths:
        return grams.limit(0)
    seen = texts.select(F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_lt")).select(_text_grams("_lt", lengths).alias("gram"))
    counts = seen.join(wanted, "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))
    known = grams.join(counts, "gram", "left")
    return (known.groupBy("brand_pos", "brand", "needle", "pattern")
            .agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "gram")).alias("rarest")).where("rarest.texts > 0")
            .select("rarest.gram", "brand_pos", "brand", "needle", "pattern"))


def catalog_mentions(df: DataFrame, catalog: DataFrame, key: str = "doc_id", text: str = "text", word_boundary: bool = False,
                     index: DataFrame | None = None, broadcast_brands: int = MAX_BROADCAST_BRANDS) -> DataFrame:
    """J11 long form for a catalog table (brand_pos, brand): (key, brand_pos, brand), a row for each row of ``df`` and each brand its text names; the
    same rows as ``links.brand_mentions`` gives for a list.  Names are matched in lower case; an empty name is in every text; null texts are empty.
    ``index``: the names of a ``brand_index`` are looked for, in place of the catalog's.

    Planning collects the lengths of names and the filter.  While the catalog is small enough to be broadcast, nothing is shuffled; beyond, only
    names with keys move."""
    names = _named(catalog).distinct() if index is None else index.drop("gram")
    same = names.groupBy("needle").agg(F.count(F.lit(1)).alias("n"))
    sizes = same.groupBy(F.octet_length("needle").alias("size")).agg(F.sum("n").alias("names"), F.count(F.lit(1)).alias("needles")).collect()  # a row for each length
    rows = df.select(key, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_lt"))
    lengths = sorted(r["size"] for r in sizes if r["size"] > 0)
    out = rows.limit(0).join(names.limit(0).select("brand_pos", "brand"))
    if lengths:
        binary = F.col("needle").cast("binary")
        bits = _filter(same.where("needle <> ''").select(binary.alias("needle")), 2 * sum(r["needles"] for r in sizes))
        found = _found(rows, key, lengths, bits, _word_table(df) if word_boundary else None)
        known = names.select(binary.alias("needle"), "brand_pos", "brand")
        known = F.broadcast(known) if sum(r["names"] for r in sizes) <= broadcast_brands else known
        out = found.join(known, "needle").select(F.explode("keys").alias(key), "brand_pos", "brand")
    if any(r["size"] == 0 for r in sizes):
        empty = names.where("needle = ''").select("brand_pos", "brand", "pattern")
        everywhere = rows.where(F.regexp_like("_lt", F.lit(r"(?U)\b"))) if word_boundary else rows
        more = everywhere.select(key).crossJoin(empty.select("brand_pos", "brand"))
        out = out.unionByName(more) if lengths else more
    return out


def with_catalog_brands(df: DataFrame, catalog: DataFrame, key: str = "doc_id", text: str = "text", out: str = "comps", word_boundary: bool = False,
                        index: DataFrame | None = None, broadcast_brands: int = MAX_BROADCAST_BRANDS) -> DataFrame:
    """F8 for a catalog table: ``df`` plus the array of brands its text names, in catalog order (empty if none).  ``key`` tells rows apart: rows of equal keys get the brands
    of all of them.  The long form is grouped by key; only keys and names move."""
    hits = catalog_mentions(df, catalog, key, text, word_boundary, index, broadcast_brands)
    lists = hits.groupBy(F.col(key).alias("_key")).agg(
        F.transform(F.array_sort(F.collect_set(F.struct("brand_pos", "brand"))), lambda x: x["brand"]).alias("_brands"))
    joined = df.join(lists, df[key].eqNullSafe(F.col("_key")), "left")
    return joined.withColumn(out, F.coalesce("_brands", F.array().cast("array<string>"))).drop("_key", "_brands")
