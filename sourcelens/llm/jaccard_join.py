"""Exact Jaccard self-join of documents on word shingles, by universe partition and pigeonhole.

A document is its set of shingle hashes (64 bits).  Equal sets become one *node* first, so copies are never paired.
Sets whose sizes allow a link fall into a common size band.  A band's largest possible symmetric difference of linked
sets is H; its hash universe is cut into somewhat more than H segments, so linked sets agree in at least one segment entirely.  Segment
contents are the index keys.  Where a key pair costs more than it should (measured: pairs under the keys of two
neighbouring segments against the keys that the other way adds), the two segments are allocated as one with
its one-deletion neighbourhood: over segments with exact and one-deletion keys, the allowed differences still sum to H.

Candidates under a key are verified exactly, but not all of them: only pairs of different components matter.  Some rounds
compare each member of a key's group with one pivot; links join components.  What is still apart is compared in blocks of
bounded size.  A lossless bound goes first: a set's parity bits, some for each element, differ in no more places than the sets do, and
in hardly fewer, so what passes is little more than the links.

Defined cases: a text without words (or null) has no shingles and is its own component; with fewer words than a
shingle the whole sequence is one; repeated rows are copies; a null id is kept, and never names a component that has
another id; an empty table gives an empty result.  ``documents`` may have further columns: only id and text are read.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache
from math import ceil, exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.llm.common import cut, few, map_arrow, map_rows, release
from sourcelens.llm.components import components
from sourcelens.llm.url_filter import bloom_blocks, bloom_pass

SHINGLE = 5
THRESHOLD = (80, 100)
BAND_RATIO = 1.3
LEAST_BITS, MOST_BITS = 512, 32_768  # of a sketch; that of a set with more elements than MOST_BITS has at least one for each
BITS_EACH = 4
ROUNDS = 3
#: Pivots go on while the last ones found more than one link in so many.
FEW_LINKS = 8
BLOCK = 256
#: What writing and reading one more index key costs, in compared pairs.
KEY_COST = 4.0
#: Part of the pairs of two exact segments that is left when they become one with one deletion.
DELETION_SHARE = 0.25
HASH_BITS = 32
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))  # odd multipliers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes.  Only A-Z is lower-cased and only ASCII white space separates words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    n = len(h) - width + 1
    total = np.zeros(max(n, 1), np.uint64)
    if n >= 1:
        for i in range(width):
            total = _mix(total * _M1 + h[i:i + n])
    else:
        total[0] = np.uint64(len(h))
        for x in h:
            total = _mix(total * _M3 + x)
    return np.unique(_mix(total))


class Bands:
    """Size bands for a threshold of num / den: lower ends, H, numbers of segments, first slot numbers.

    There are some more than H + 1 segments, so linked sets agree in several.  A set leaves out the keys of its empty
    segments, which many sets share, if it has no more of them than that surplus: then it still agrees with a linked set in one
    that isn't empty."""

    def __init__(self, num: int, den: int, ratio: float = BAND_RATIO):
        self.num, self.den, self.ratio = num, den, ratio
        self.lower, self.apart, self.segments, self.first = [1], [], [], [0]

    def grow(self, size: int) -> None:
        while self.lower[-1] <= size:
            low = self.lower[-1]
            nxt = max(low + 1, int(low * self.ratio))
            top = nxt - 1
            both = top + top * self.den // self.num  # sizes of the largest pair that meets in this band
            self.apart.append(self.distance(both))
            m = self.apart[-1] + 1
            self.segments.append(m + (ceil(1 + 1.5 * m * exp(-low / m)) if m > 1 else 0))  # the rest covers empty ones
            self.first.append(self.first[-1] + self.segments[-1])
            self.lower.append(nxt)

    def distance(self, both: int) -> int:
        """Largest symmetric difference of linked sets whose sizes sum to ``both``."""
        return both * (self.den - self.num) // (self.den + self.num)

    def of(self, size: int) -> range:
        """Its own band and those of smaller sizes it can be linked with."""
        self.grow(size)
        smallest = -(-size * self.num // self.den)
        return range(bisect_right(self.lower, smallest) - 1, bisect_right(self.lower, size))


@lru_cache(8)
def bands(num: int, den: int) -> Bands:
    return Bands(num, den)


def segment_keys(tokens: np.ndarray, table: Bands, merged: dict[int, list[int]] | None = None) -> np.ndarray:
    """Index keys: slot number (band and segment) in the upper bits, hash of the segment's content below (0: left out).

    ``merged`` None: the exact keys of all segments.  Else: for each band, the numbers k of the segment pairs (2k, 2k + 1) that are one
    segment with one-deletion neighbourhoods; only their keys are given."""
    out = []
    if not len(tokens):
        return np.zeros(0, np.int64)
    mixed = _mix(tokens * _M1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    upper = (tokens >> np.uint64(33)).astype(np.int64)
    for b in table.of(len(tokens)):
        m = table.segments[b]
        ends = np.searchsorted(upper, -(-(np.arange(m + 1) << 31) // m))
        slots = table.first[b] + np.arange(m)
        if merged is None:
            sizes = ends[1:] - ends[:-1]
            empty = sizes == 0
            skipped = empty & (empty.sum() < m - table.apart[b])
            out.append((slots, sums[ends[1:]] - sums[ends[:-1]] + sizes.astype(np.uint64), skipped))
            continue
        for k in merged.get(b, ()):
            low, high = ends[2 * k], ends[2 * k + 2]
            content = sums[high:high + 1] - sums[low:low + 1]
            left_out = np.concatenate([content + np.uint64(high - low), content - mixed[low:high] + np.uint64(high - low) - np.uint64(1)])
            out.append((np.full(len(left_out), slots[2 * k]), left_out * _M3, np.zeros(len(left_out), bool)))
    if not out:
        return np.zeros(0, np.int64)
    slot, content, skipped = (np.concatenate(x) for x in zip(*out, strict=True))
    hashed = np.maximum(_mix(_mix(content) + slot.astype(np.uint64) * _M1) >> np.uint64(64 - HASH_BITS), np.uint64(1))
    return (slot << HASH_BITS) + np.where(skipped, 0, hashed.astype(np.int64))


def _sketch(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens for each value of their low bits, as bits.  Two sketches differ in at most as many bits as the
    sets have elements apart: an element changes one bit.  Sets of n elements that are d apart differ in about d - d * d / (4 * n) bits or more."""
    n = len(tokens)
    bits = 1 << (max(LEAST_BITS, min(BITS_EACH * n, max(MOST_BITS, n))) - 1).bit_length()
    return np.packbits((np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of the same set with ``size`` bytes, a power of two."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def _least_difference(x: bytes, y: bytes) -> int:
    """At most the symmetric difference of the two sets."""
    size = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())


def _signatures(docs: DataFrame, id_col: str, text: str, width: int, num: int, den: int) -> DataFrame:
    def run(c):
        table, out = bands(num, den), {"id": c["id"], "n": [], "digest": [], "sketch": [], "slot": [], "hashes": []}
        for t in c["t"]:
            x = shingles(t, width)
            out["n"].append(len(x))
            out["digest"].append(xxhash.xxh3_128_digest(x.tobytes()))
            out["sketch"].append(_sketch(x))
            keys = segment_keys(x, table)
            out["slot"].append(int(keys[0]) >> HASH_BITS if len(keys) else 0)
            out["hashes"].append(keys.astype(np.int32))  # the lower half; a set's slots are consecutive
        return out

    return map_rows(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("t")), run,
                    "id bigint, n bigint, digest binary, sketch binary, slot bigint, hashes array<int>")


def _exploded(nodes: DataFrame) -> DataFrame:
    """(node, key): the index keys of the nodes."""
    rows = nodes.select("node", "slot", F.posexplode("hashes").alias("p", "h")).where("h <> 0")
    upper = F.shiftleft(F.col("slot") + F.col("p"), HASH_BITS)
    return rows.select("node", upper.bitwiseOR(F.col("h").cast("bigint").bitwiseAND(F.lit((1 << HASH_BITS) - 1))).alias("key"))


def _merged_keys(nodes: DataFrame, merged: dict[int, list[int]], width: int, num: int, den: int) -> DataFrame:
    """(node, text) -> (node, keys) of the merged segments."""
    def run(c):
        return {"node": c["node"], "keys": [segment_keys(shingles(t, width), bands(num, den), merged) for t in c["t"]]}

    return map_rows(nodes.select("node", "t"), run, "node bigint, keys array<bigint>")


def _allocation(counts: DataFrame, nodes: DataFrame, table: Bands) -> dict[int, list[int]]:
    """Segment pairs for which one deletion costs less, by band.  The driver gets a row per slot: as many as the largest set asks for."""
    sizes = nodes.groupBy("n").agg(F.count("*").alias("docs")).collect()  # one row per set size
    table.grow(max([1, *(r["n"] for r in sizes)]))
    docs, tokens = [0] * len(table.apart), [0] * len(table.apart)
    for r in sizes:
        for b in table.of(r["n"]):
            docs[b] += r["docs"]
            tokens[b] += r["docs"] * r["n"]
    slot = F.shiftright("key", HASH_BITS)
    pairs = {r["slot"]: r["pairs"] for r in counts.groupBy(slot.alias("slot")).agg(F.sum(F.col("g") * (F.col("g") - 1.0) / 2).alias("pairs")).collect()}
    out: dict[int, list[int]] = {}
    for b in range(len(table.apart)):
        m = table.segments[b]
        for k in range(m // 2):
            s = table.first[b] + 2 * k
            exact = pairs.get(s, 0) + pairs.get(s + 1, 0)
            one_deletion = KEY_COST * (docs[b] + tokens[b] * 2 / m) + DELETION_SHARE * exact
            if one_deletion < exact:
                out.setdefault(b, []).append(k)
    return out


def _texts_of(docs: DataFrame, nodes: DataFrame, id_col: str, text: str) -> DataFrame:
    """Texts of the nodes' first documents: a Bloom filter of their ids spares the shuffle of other texts."""
    filter_, blocks = bloom_blocks(nodes.select(F.col("id").alias("key")))
    own = docs.select(F.col(id_col).cast("bigint").alias("key"), F.col(text).alias("t")).where(F.col("key").isNotNull())
    return bloom_pass(own, filter_, blocks).join(nodes.select(F.col("id").alias("key"), "node", "digest"), "key")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, tokens).  An id that stands for several texts gives those whose digest is the node's: repeated rows go before, where the join has put
    them side by side; texts of one id and one set may give a node twice, which repeats its pairs and changes nothing."""
    def run(c):
        found = [(node, x.tobytes()) for node, digest, t in zip(c["node"], c["digest"], c["t"], strict=True)
                 if xxhash.xxh3_128_digest((x := shingles(t, width)).tobytes()) == digest]
        return {"node": [a for a, _ in found], "tokens": [b for _, b in found]}

    return map_rows(texts.dropDuplicates(["key", "node", "digest", "t"]).select("node", "digest", "t"), run, "node bigint, tokens binary")


def _both(pairs: DataFrame, side: DataFrame, cols: list[str], rows: int) -> DataFrame:
    for x in "ab":
        pairs = few(pairs, rows).join(side.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in cols]), x)
    return few(pairs, rows)


def _possible(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b, sketch_a, sketch_b) whose sizes and sketches allow a link."""
    def run(batches):
        for c in batches:
            most = (c.column("n_a").to_numpy() + c.column("n_b").to_numpy()) * (den - num) // (den + num)
            keep = [_least_difference(x.as_py(), y.as_py()) <= m for x, y, m in zip(c.column("sketch_a"), c.column("sketch_b"), most, strict=True)]
            yield c.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(pairs.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"), run, "a bigint, b bigint")


def _linked(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b, tokens_a, tokens_b) whose exact similarity is high enough."""
    def run(batches):
        for c in batches:
            keep = []
            for x, y in zip(c.column("tokens_a"), c.column("tokens_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(den * same >= num * (len(x) + len(y) - same))
            yield c.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(pairs.select("a", "b", "tokens_a", "tokens_b"), run, "a bigint, b bigint")


def _block_pairs(x: np.ndarray, node: np.ndarray, comp: np.ndarray, n: np.ndarray, sketches: list[bytes], num: int, den: int) -> np.ndarray:
    """Pairs of different components between the one or two blocks (``x``) of one group whose sizes and sketches allow a link."""
    size = min(map(len, sketches))
    bits = np.stack([_folded(s, size) for s in sketches])
    u, v = np.flatnonzero(x == x.min()), np.flatnonzero(x == x.max())
    most = (n[u][:, None] + n[v][None, :]) * (den - num) // (den + num)
    possible = (comp[u][:, None] != comp[v][None, :]) & (np.abs(n[u][:, None] - n[v][None, :]) <= most)
    step = max(1, (1 << 20) // (len(v) * bits.shape[1]))  # some MB at a time
    for at in range(0, len(u), step):
        if possible[at:at + step].any():
            apart = np.bitwise_count(bits[u[at:at + step]][:, None, :] ^ bits[v][None, :, :]).sum(axis=2, dtype=np.int64)
            possible[at:at + step] &= apart <= most[at:at + step]
    s, t = np.nonzero(possible)
    return np.unique(np.sort(np.stack([node[u[s]], node[v[t]]], axis=1), axis=1), axis=0)


def _pairs_in_blocks(members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different components under one key that may be linked, by the sketches.  Groups are cut into blocks; the rows of a
    pair of blocks stand side by side, so a task holds one pair of blocks and the batch that it reads."""
    g = F.ceil(F.col("g") / BLOCK).cast("int")
    x = F.pmod(F.xxhash64("node", F.lit(3)), g).cast("int")
    dealt = (members.withColumns({"x": x, "nb": g}).select("key", "x", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("y"), "node", "comp", "n", "sketch")
             .select("key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "node", "comp", "n", "sketch")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))

    def pairs(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        x, node, comp, n = (t.column(k).to_numpy() for k in ("x", "node", "comp", "n"))
        sketches, found = t.column("sketch"), [np.zeros((0, 2), np.int64)]
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            if comp[s:e].min() < comp[s:e].max() and (x[s] == t.column("i")[s].as_py() == t.column("j")[s].as_py() or x[s:e].min() < x[s:e].max()):
                found.append(_block_pairs(x[s:e], node[s:e], comp[s:e], n[s:e], sketches.slice(s, e - s).to_pylist(), num, den))
        out = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    def run(batches):
        held = None  # the rows of the last pair of blocks, which may go on in the next batch
        for c in batches:
            t = pa.Table.from_batches([c])
            t = (t if held is None else pa.concat_tables([held, t])).combine_chunks()
            if not t.num_rows:
                continue
            place = np.stack([t.column(k).to_numpy() for k in ("key", "i", "j")])
            starts = np.concatenate([[0], np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1])
            held = t.slice(starts[-1])
            yield pairs(t, starts)
        if held is not None and held.num_rows:
            yield pairs(held.combine_chunks(), np.array([0, held.num_rows]))

    return map_arrow(dealt, run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD,
                    rounds: int = ROUNDS) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``: links are pairs with similarity of at least num / den."""
    num, den = threshold
    signed = cut(_signatures(docs, id_col, text, width, num, den))
    rows = signed.count()
    # copies: one node per set; first() of equal sets is the same whichever row it is
    nodes = cut(signed.where("n > 0 and id is not null").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("slot").alias("slot"), F.first("hashes").alias("hashes"))
        .withColumn("node", F.monotonically_increasing_id()), rows)
    signed = cut(signed.select("id", "n", "digest"), rows)  # the rest is kept once, with the nodes
    release(docs.sparkSession)
    exact = _exploded(nodes)
    counts = cut(exact.groupBy("key").agg(F.count("*").alias("g")).where("g > 1"))
    release(docs.sparkSession)
    table = Bands(num, den)
    merged = _allocation(counts, nodes, table)
    if merged:
        slots = [table.first[b] + 2 * k + i for b, ks in merged.items() for k in ks for i in (0, 1)]
        again = F.from_json(F.lit(str(slots)), "array<bigint>")
        counts = counts.where(~F.array_contains(again, F.shiftright("key", HASH_BITS)))
        lows = [(table.lower[b], table.lower[b + 1] - 1) for b in merged]
        in_band = F.lit(False)
        for low, high in lows:
            in_band = in_band | F.col("n").between(low, high * den // num)
        texts = _texts_of(docs, nodes.where(in_band), id_col, text)
        more = _merged_keys(texts, merged, width, num, den).select("node", F.explode("keys").alias("key")).distinct()
        more = cut(more)
        more_counts = more.groupBy("key").agg(F.count("*").alias("g")).where("g > 1")
        exact, counts = exact.unionByName(more), cut(counts.unionByName(more_counts))
    size = counts.agg(F.sum("g")).first()[0] or 0
    shared, blocks = bloom_blocks(counts.select("key"))  # most keys belong to one set only and need no shuffle
    members = cut(bloom_pass(exact, shared, blocks).join(counts, "key"), size)
    active = cut(members.select("node").distinct().join(nodes.select("node", "id", "digest", "n", "sketch"), "node"), size)
    release(docs.sparkSession)
    sets = cut(_sets(_texts_of(docs, active, id_col, text), width), size)
    named, exact, counts = nodes.select("digest", "node", "id"), None, None
    named, nodes = cut(named, rows), None
    release(docs.sparkSession)

    comps, total, r, last = None, 0, 0, False
    while not last:
        last = r >= rounds or r > 0 and new * FEW_LINKS <= total
        label = members.withColumn("comp", F.col("node")) if comps is None else few(
            members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")), size)
        pivots = label.groupBy("key").agg(F.min_by(F.struct("node", "comp"), F.xxhash64("node", F.lit(r))).alias("p"),
                                          F.min("comp").alias("low"), F.max("comp").alias("high"),
                                          F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")).where("low < high")
        label = cut(label.join(pivots.select("key", "p", "who"), "key"), size)  # a key whose members are in one component is done with
        members = label.select("key", "node", "g")
        if not last:
            pairs = (label.where("comp <> p.comp")
                     .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct())
            maybe = _possible(_both(pairs, active, ["n", "sketch"], size), num, den)
        else:  # a key of two members has been tried; of keys with the same members one is enough
            keys = few(label.where("g > 2").groupBy("g", "who").agg(F.min("key").alias("key")).select("key"), size)
            rest = few(few(label.join(keys, "key", "left_semi").drop("p", "who"), size).join(active.select("node", "n", "sketch"), "node"), size)
            maybe = _pairs_in_blocks(rest, num, den)
        maybe = cut(maybe, size)
        asked = maybe.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        own = bloom_pass(sets.withColumnRenamed("node", "key"), *bloom_blocks(asked)).withColumnRenamed("key", "node")
        found = cut(_linked(_both(maybe, own, ["tokens"], size), num, den), size)
        new = found.count()
        if new:
            known = found if comps is None else found.unionByName(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")))
            comps = cut(components(known), size)
        total, r = total + new, r + 1
        label = pivots = maybe = found = asked = own = known = None
        release(docs.sparkSession)
    if comps is not None:
        named = named.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        least = named.groupBy("comp").agg(F.min("id").alias("component_id"))
        named = named.join(least, "comp")
    else:
        named = named.withColumn("component_id", F.col("id"))
    out = signed.select("id", "n", "digest").join(named.select("digest", "component_id"), "digest", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("id")).alias("component_id"))
