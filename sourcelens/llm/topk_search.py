"""Exact top-k search by distributed histogram selection.

Vectors become integers (floor of ``scale`` times each component).  Queries and candidates are packed into
blocks, and every query block meets every candidate block once per round.  A round scores all of them
and counts, for each query, the scores that fall in each of ``BINS`` equal bins of that query's open
interval; summed over all blocks this is the global histogram, and the bin that holds the k-th highest
score is the next, ``BINS`` times smaller, interval.  When an interval is a single integer, that is the exact
k-th value.  One last pass keeps the scores above it, and of those equal to it as many of the smallest
ids as are still missing, so a vector that fills a third of the table adds at most k rows per block.

Defined cases: vectors that are null, empty, or hold a null, a non-finite value or one of ``2**31 / scale`` or more
take no part; queries only meet candidates of the same length; a query's own rows are all rows of its id, and
a repeated query id is asked once, with the smallest of its vectors; other repeated rows are candidates each;
ties go to the smaller id; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sourcelens.llm.common import cut, map_arrow

BINS = 64
QUERY_BLOCK = 512
VECTOR_BLOCK = 4096
_BLOCK = "dim int, ids binary, vectors binary"


def _usable(vec: Column, scale: int) -> Column:
    bound = 2.0**31 / scale
    ok = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < bound, F.lit(False)) & ~F.isnan(x))
    return F.coalesce(F.size(vec) > 0, F.lit(False)) & F.coalesce(ok, F.lit(False))


def _packed(df: DataFrame, rows: int, scale: int) -> DataFrame:
    """(id, vec) rows -> blocks of at most ``rows`` vectors of one length, as int64 ids and float64 integers."""
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def pack(batches):
        held: dict[int, tuple[list, list]] = {}

        def block(dim):
            ids, vectors = held.pop(dim)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                                               pa.array([np.concatenate(vectors).tobytes()], pa.binary())], schema=schema)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            column = batch.column(1)
            lengths = np.diff(column.offsets.to_numpy())
            flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for dim in np.unique(lengths):
                own = np.flatnonzero(lengths == dim)
                matrix = flat[starts[own][:, None] + np.arange(dim)]
                for at in range(0, len(own), rows):
                    a, b = held.setdefault(int(dim), ([], []))
                    a.append(ids[own[at:at + rows]])
                    b.append(matrix[at:at + rows])
                    if sum(map(len, a)) >= rows:
                        yield block(int(dim))
        for dim in list(held):
            yield block(dim)

    return map_arrow(df, pack, _BLOCK)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products; float64 is exact while every partial sum stays below 2**53."""
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2**53:
        return (q @ v.T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


def _matrix(block: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(block, np.float64).reshape(-1, dim)


def _pairs(queries: DataFrame, vectors: DataFrame, state: DataFrame, dims: DataFrame) -> DataFrame:
    """Every query block with the state of its queries beside every candidate block of the same length."""
    asked = queries.join(state, "qb")
    spread = asked.join(dims, "dim").select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("vb"))
    return spread.join(vectors, ["dim", "vb"])


def _numbered(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks numbered 0.. within a length.  There are few: one for thousands of rows."""
    return cut(cut(blocks.withColumn("_p", F.monotonically_increasing_id())).withColumn(
        name, F.row_number().over(W.partitionBy("dim").orderBy("_p")) - 1).drop("_p"))


def top_k(table: DataFrame, k: int = 5, is_query: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256, query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``is_query`` (default: every 50th id) its ``k`` highest scores."""
    if is_query is None:
        is_query = F.col(id_col) % 50 == 0
    rows = table.where(F.col(id_col).isNotNull() & _usable(F.col(vec_col), scale))
    ids = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("q"))
    vectors = _numbered(_packed(ids.select("id", "vec"), vector_block, scale), "vb")
    asked = ids.where("q").groupBy("id").agg(F.min("vec").alias("vec"))
    blocks = _packed(asked, query_block, scale)
    queries = cut(cut(blocks).withColumn("qb", F.monotonically_increasing_id())).withColumnsRenamed({"ids": "qids", "vectors": "qvecs"})
    dims = F.broadcast(vectors.groupBy("dim").agg(F.count("*").cast("int").alias("nb")))  # one row per length

    # bounds of all scores by the largest component sums: |q.v| <= max|q| * sum|v|
    peak = _peak(vectors, "vectors").first()
    bound = int(peak["peak"] or 0) * int(peak["total"] or 0) + 1
    width = 1
    while width * BINS < 2 * bound:
        width *= BINS
    state = queries.select("qb", F.lit(None).cast("binary").alias("lo"), F.lit(None).cast("binary").alias("need"))
    pairs_of = lambda s: _pairs(queries, vectors, s, dims)
    while True:
        counted = map_arrow(pairs_of(state), _count_round(-bound, width, k), "qb bigint, i int, bin int, n bigint")
        sums = counted.groupBy("qb", "i", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(W.partitionBy("qb", "i").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1))
        # bin -1 says what is still needed and where the interval begins
        per = (sums.where("bin >= 0").withColumn("above", F.coalesce(above, F.lit(0)))
               .join(_needs(state, queries, k, -bound), ["qb", "i"]))
        kept = (per.where("above < need").groupBy("qb", "i", "lo", "need")
                .agg(F.min_by(F.struct("bin", "above"), "bin").alias("b"), F.sum("n").alias("seen")))
        # with fewer than k candidates the interval shrinks to its lowest bin, and all of them are kept
        chosen = kept.select("qb", "i", (F.col("lo") + F.col("b.bin") * F.lit(width)).alias("lo"),
                             (F.col("need") - F.col("b.above")).alias("need"))
        state = cut(_state(chosen, queries, -bound))
        if width == 1:
            break
        width //= BINS
    found = map_arrow(pairs_of(state), _keep_round(), "query_id bigint, vec_id bigint, score bigint")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _peak(blocks: DataFrame, col: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            peaks, totals = [], []
            for dim, raw in zip(batch.column("dim").to_pylist(), batch.column(col).to_pylist(), strict=True):
                m = np.abs(_matrix(raw, dim))
                peaks.append(int(m.max(initial=0)))
                totals.append(int(m.sum(axis=1).max(initial=0)))
            yield pa.RecordBatch.from_arrays([pa.array(peaks, pa.int64()), pa.array(totals, pa.int64())], ["peak", "total"])

    return map_arrow(blocks.select("dim", col), run, "peak bigint, total bigint").agg(F.max("peak").alias("peak"), F.max("total").alias("total"))


def _each(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield {n: batch.column(n)[at].as_py() for n in batch.schema.names}


def _interval(r: dict, start: int, k: int):
    n = len(r["qids"]) // 8
    lo = np.frombuffer(r["lo"], np.int64) if r["lo"] else np.full(n, start, np.int64)
    need = np.frombuffer(r["need"], np.int64) if r["need"] else np.full(n, k, np.int64)
    return lo, need


def _block_scores(r: dict):
    """Scores of a block pair and where a candidate is the query's own."""
    qids, vids = np.frombuffer(r["qids"], np.int64), np.frombuffer(r["ids"], np.int64)
    return qids, vids, _scores(_matrix(r["qvecs"], r["dim"]), _matrix(r["vectors"], r["dim"])), qids[:, None] == vids[None, :]


def _count_round(start: int, width: int, k: int):
    def run(batches):
        sums: dict[int, np.ndarray] = {}

        def rows():
            for qb, c in sums.items():
                i, b = np.nonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), qb, np.int64)), pa.array(i.astype(np.int32)),
                                                  pa.array(b.astype(np.int32)), pa.array(c[i, b])], ["qb", "i", "bin", "n"])
            sums.clear()

        for r in _each(batches):
            lo, _ = _interval(r, start, k)
            _, _, s, own = _block_scores(r)
            b = (s - lo[:, None]) // width
            ok = (b >= 0) & (b < BINS) & ~own
            flat = (np.arange(len(lo))[:, None] * BINS + b)[ok]
            c = np.bincount(flat, minlength=len(lo) * BINS).reshape(len(lo), BINS)
            sums[r["qb"]] = sums[r["qb"]] + c if r["qb"] in sums else c
            if len(sums) >= 256:  # bounded: 256 blocks of 512 queries
                yield from rows()
        yield from rows()

    return run


def _keep_round():
    def run(batches):
        for r in _each(batches):
            lo, need = _interval(r, 0, 0)
            qids, vids, s, own = _block_scores(r)
            s = np.where(own, np.iinfo(np.int64).min, s)
            i, j = np.nonzero(s > lo[:, None])
            out = [(i, j)]
            for q in np.flatnonzero((s == lo[:, None]).any(axis=1)):
                ties = np.flatnonzero(s[q] == lo[q])
                ties = ties[np.argsort(vids[ties], kind="stable")[:need[q]]]
                out.append((np.full(len(ties), q), ties))
            i, j = np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])
            yield pa.RecordBatch.from_arrays([pa.array(qids[i]), pa.array(vids[j]), pa.array(s[i, j])], ["query_id", "vec_id", "score"])

    return run


def _needs(state: DataFrame, queries: DataFrame, k: int, start: int) -> DataFrame:
    """State as rows (qb, i, lo, need)."""
    def run(batches):
        for r in _each(batches):
            lo, need = _interval(r, start, k)
            n = len(lo)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, r["qb"], np.int64)), pa.array(np.arange(n, dtype=np.int32)),
                                              pa.array(lo), pa.array(need)], ["qb", "i", "lo", "need"])

    return map_arrow(state.join(queries.select("qb", "qids"), "qb"), run, "qb bigint, i int, lo bigint, need bigint")


def _state(chosen: DataFrame, queries: DataFrame, start: int) -> DataFrame:
    """Rows (qb, i, lo, need) back to one row per block; a query without candidates needs nothing."""
    schema = pa.schema([("qb", pa.int64()), ("lo", pa.binary()), ("need", pa.binary())])
    lists = chosen.groupBy("qb").agg(F.collect_list(F.struct("i", "lo", "need")).alias("s"))  # a block's queries

    def run(batches):
        for r in _each(batches):
            n = len(r["qids"]) // 8
            lo, need = np.full(n, np.iinfo(np.int64).max, np.int64), np.zeros(n, np.int64)
            for x in r["s"] or []:
                lo[x["i"]], need[x["i"]] = x["lo"], x["need"]
            yield pa.RecordBatch.from_arrays([pa.array([r["qb"]], pa.int64()), pa.array([lo.tobytes()], pa.binary()),
                                              pa.array([need.tobytes()], pa.binary())], schema=schema)

    return map_arrow(queries.select("qb", "qids").join(lists, "qb", "left"), run, "qb bigint, lo binary, need binary")
