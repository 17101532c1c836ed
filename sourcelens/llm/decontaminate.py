"""Benchmark decontamination: shared word pairs as seeds, then Smith-Waterman alignment.

Test items become words (lower case, letters and digits); every pair of neighbouring words of an item is a seed, however frequent.
Item and passage are aligned locally (match 1, mismatch and gap -1); a pair is contaminated if the score reaches a share of the item's
length, so edited copies are found and chance meetings are not.

Seeds lose nothing.  An alignment of M matches and E errors has at most E + 1 runs, so at least M - E - 1 neighbouring
words of the item stand side by side in the passage too; with M - E >= T that is T - 1 seeds, within 2m - T words (M <= m, the item's length).
Only items with so many seeds so near each other are aligned, in the region that such a passage can reach.  No seed is chosen by its
frequency, so neither leaked copies nor items of frequent words change what is found.

The benchmark side is small; it goes to the tasks in blocks of checked size (a further pass over the
documents for each), so no pass shuffles documents and no key can be hot.

Defined cases: null and empty texts have no words; items without words match nothing; an item of one word
is its own seed; repeated items and rows give a row each pair only once; spans are code points, end exclusive; texts are read whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.llm.common import arrow_schema, map_arrow

WORD = re.compile(r"[^\W_]+")
MIN_SCORE = 0.5
#: Items shorter than this must be found word for word.
SHORT = 8
#: Seeds of all items that are looked at in one step of a document.
HITS = 1_000_000
#: Items and characters that a block of the benchmark may have.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Items:
    """A block of the benchmark: vocabulary, word ids of each item, its seeds and how many of them a copy must hold."""

    def __init__(self, rows: list[tuple[int, str | None]], min_score: float = MIN_SCORE):
        self.ids, self.words, self.vocab = [], [], {}
        for item, text in rows:
            own = words_of(text)
            if own:
                self.ids.append(item)
                self.words.append(np.array([self.vocab.setdefault(w, len(self.vocab)) for w in own], np.int64))
        sizes = np.array([len(w) for w in self.words], np.int64)
        #: The score that makes a copy.
        self.least = np.where(sizes < SHORT, sizes, np.ceil(min_score * sizes - 1e-9).astype(np.int64))
        grams = np.where(self.least < 2, 1, 2)
        #: Seeds that a copy holds at least, and the number of words that it has at most.
        self.need, self.reach = np.maximum(1, self.least - (grams - 1)), 2 * sizes - self.least
        self.index: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # n -> codes, where each one's items begin, items
        for n in sorted(set(grams.tolist())):
            own = np.flatnonzero(grams == n)
            found = [np.unique(self.code(self.words[i], n)) for i in own]
            codes, items = np.concatenate(found), np.repeat(own, [len(c) for c in found])
            order = np.lexsort((items, codes))
            codes, starts = np.unique(codes[order], return_index=True)
            self.index[n] = codes, np.append(starts, len(items)), items[order]

    def code(self, ids: np.ndarray, n: int) -> np.ndarray:
        """A number for each n-gram, -1 if it has a word outside the vocabulary."""
        count = len(ids) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64)
        base, out, known = len(self.vocab) + 1, np.zeros(count, np.int64), np.ones(count, bool)
        for i in range(n):
            part = ids[i:i + count]
            out = out * base + part  # exact: base ** 2 < 2 ** 63
            known &= part >= 0
        return np.where(known, out, -1)

    def candidates(self, ids: np.ndarray):
        """(item, regions): where a document has enough of an item's seeds near each other."""
        for n, (known, starts, owners) in self.index.items():
            codes = self.code(ids, n)
            place = np.searchsorted(known, codes)
            at = np.flatnonzero(known[np.minimum(place, len(known) - 1)] == codes)
            place = place[at]
            sizes = starts[place + 1] - starts[place]
            ends = np.cumsum(sizes)

            def owning(part):
                size = sizes[part]
                return owners[np.repeat(starts[place[part]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]

            # however long the text, only a part's hits are held before items are sorted out
            parts = np.split(np.arange(len(at)), np.flatnonzero(np.diff(ends // HITS)) + 1)
            counts = np.zeros(len(self.need), np.int64)
            for part in parts:
                counts += np.bincount(owning(part), minlength=len(counts))
            enough = counts >= self.need
            if not enough.any():
                continue
            kept = [(own[keep := enough[own]], np.repeat(at[part], sizes[part])[keep]) for part in parts for own in [owning(part)]]
            hits, places = (np.concatenate(x) for x in zip(*kept, strict=True))
            order = np.argsort(hits, kind="stable")  # of one item, places stay in order
            hits, places = hits[order], places[order]
            for own in np.split(np.arange(len(hits)), np.flatnonzero(np.diff(hits)) + 1):
                item, p = int(hits[own[0]]), places[own]
                need, reach = int(self.need[item]), int(self.reach[item])
                first, last = p[:len(p) - need + 1], p[need - 1:]
                near = last + n - first <= reach
                if near.any():
                    yield item, _joined(last[near] + n - reach, first[near] + reach)


def _joined(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Ranges in order become ranges that don't overlap."""
    cuts = np.flatnonzero(low[1:] > high[:-1]) + 1
    return list(zip(low[np.append(0, cuts)].tolist(), high[np.append(cuts - 1, len(high) - 1)].tolist(), strict=True))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, places of the item's and the passage's last aligned word)."""
    best = (0, 0, 0)
    steps = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for i, w in enumerate(item):
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(passage == w, 1, -1), row[1:] - 1)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps  # gaps in the item
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j - 1)
    return best


def _matches(items: Items, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(item, score, first, last word) of each contaminated item in a document."""
    out = []
    for item, regions in items.candidates(ids):
        words, best = items.words[item], None
        for low, high in regions:
            low = max(0, low)
            score, a, b = align(words, ids[low:high])
            if best is None or score > best[0]:
                best = (score, a, b, low)
        score, a, b, low = best
        if score >= items.least[item]:
            back = align(words[:a + 1][::-1], ids[low:low + b + 1][::-1])
            out.append((item, score, low + b - back[2], low + b))
    return out


def _each_text(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column("t").to_pylist()
            own = [words_of(t) for t in texts]
            yield part.column("id").to_pylist(), texts, own


def _blocks(benchmark: DataFrame, item_col: str, text: str, min_score: float):
    rows, chars = [], 0
    for r in benchmark.select(F.col(item_col).alias("i"), F.col(text).alias("t")).distinct().orderBy("i", "t").toLocalIterator():
        rows.append((r["i"], r["t"]))
        chars += len(r["t"] or "")
        if len(rows) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
            yield Items(rows, min_score)
            rows, chars = [], 0
    yield Items(rows, min_score)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
                 item_text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(id, item_id, score, start, end): every document and test item of which it holds a copy, with the best passage."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    kinds = f"id {own.schema['id'].dataType.simpleString()}, item {benchmark.schema[item_col].dataType.simpleString()}"
    schema = f"{kinds}, score double, start bigint, end bigint"
    arrow = arrow_schema(spark, schema)
    found = None
    for items in _blocks(benchmark, item_col, item_text, min_score):
        if not items.words:
            continue
        held = spark.sparkContext.broadcast(items)  # one block: of checked size

        def run(batches, held=held):
            items = held.value
            vocab = items.vocab
            for ids, texts, words in _each_text(batches):
                out = []
                for doc, t, w in zip(ids, texts, words, strict=True):
                    got = _matches(items, np.array([vocab.get(x, -1) for x in w], np.int64))
                    if got:
                        places = [m.span() for m in WORD.finditer(t.lower())]
                        shift = len(t.lower()) != len(t)
                        out += [(doc, items.ids[i], s / len(items.words[i]), None if shift else places[a][0], None if shift else places[b][1])
                                for i, s, a, b in got]
                columns = list(zip(*out, strict=True)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        part = map_arrow(own, run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    best = found.groupBy("id", "item").agg(F.max(F.struct("score", (-F.col("start")).alias("s"), (-F.col("end")).alias("e"))).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("b.score").alias("score"),
                       (-F.col("b.s")).alias("start"), (-F.col("b.e")).alias("end"))


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id", item_text: str = "text",
                  min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item, each judged by its own text, whatever its id."""
    spark = docs.sparkSession
    for items in _blocks(benchmark, item_col, item_text, min_score):
        if not items.words:
            continue
        held = spark.sparkContext.broadcast(items)  # one block: of checked size

        def run(batches, held=held):
            items = held.value
            vocab = items.vocab
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    texts = part.column(part.schema.get_field_index(text)).to_pylist()
                    yield part.filter(pa.array([not _matches(items, np.array([vocab.get(w, -1) for w in words_of(t)], np.int64)) for t in texts], pa.bool_()))

        docs = map_arrow(docs, run, docs.schema)
    return docs
