"""Spelling variants: words one edit apart, by a frontier of trie states that advances by joins with a distributed edge table.

Words become a path-compressed trie: a node is a prefix after which words differ or end, named by its hash; an edge (parent, first, label,
child) spells the way to the next node.  A state pairs two places of the trie between which one edit has been made: (the word's node and the rest of its label, the
other node and the rest of its label).  The word's node stands for word and position: words with the same beginning share a state.  Two words
one edit apart differ first at a node both have, so every state starts there, from two different edges of a node: replacing the first sign, or skipping it
on one side.  A step spells the rests against each other, then joins the side that has reached its node with the edges that go on alike.
States in which both sides end a word at once are neighbours.  The number of steps follows the branching nodes on a path, not the length of words.

Node hashes of different prefixes may collide; that can only add states, and every neighbour pair is checked by its edit distance.

Words are counted in tasks, in a table of bounded size that is emptied into partial counts; so a word that is everywhere leaves a task once.

Defined cases: null and empty texts have no words; a null id counts as an empty one in the hash; words of any length take part; a repeated row
counts each time; an empty table, or one without words, gives an empty result; only id and text are read, so further columns can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcelens.llm.common import cut, map_arrow, map_rows

#: Fixed: which runs are words, and how the counted table's words are thinned by a hash.
RUN = re.compile("[a-zÀ-ÿ]+")
DELETES = 97
MIN_CHARS = 5
MIN_COUNT = 3
#: A word's form has at least so many times its own count.
DOMINANCE = 2
#: Words in a task's table, runs counted in one step, and the longest word (bytes) whose hashes are combined.
TABLE_WORDS = 200_000
STEP_RUNS = 200_000
SHORT = 48


class Words(dict):
    """Word to number, with each word's CRC-32, bytes and count."""

    def __init__(self):
        super().__init__()
        self.crc, self.size, self.count = (np.zeros(1024, t) for t in (np.uint32, np.int64, np.int64))

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        if number == len(self.crc):
            self.crc, self.size, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.crc, self.size, self.count))
        raw = word.encode()
        self.crc[number], self.size[number] = zlib.crc32(raw), len(raw)
        return number


_ZEROS = [bytes(n) for n in range(SHORT + 1)]
_OF_ZEROS = np.array([zlib.crc32(z) for z in _ZEROS], np.uint32)


def _after(prefix: bytes) -> np.ndarray:
    """What XORed with the CRC-32 of n bytes gives that of the prefix and these bytes, for each n."""
    start = zlib.crc32(prefix)
    return np.array([zlib.crc32(z, start) for z in _ZEROS], np.uint32) ^ _OF_ZEROS


def without_one(word: str, h: int) -> str:
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _partial_counts(batches: Iterator[tuple[list, list]]) -> Iterator[Counter | dict]:
    """Counts by word, in portions.  The hash of id and run decides which runs lose a sign; it is put together from those of id and word."""
    table, shorter = Words(), Counter()
    runs: list[int] = []
    docs: list[tuple[bytes, int]] = []

    def count():
        if not runs:
            return
        number = np.array(runs)
        after = np.stack([_after(p) for p, _ in docs])
        of_doc, size = np.repeat(np.arange(len(docs)), [n for _, n in docs]), table.size[number]
        h = table.crc[number] ^ after[of_doc, np.minimum(size, SHORT)]
        names = None
        long = np.flatnonzero(size > SHORT)
        if len(long):
            names = list(table)
            h[long] = [zlib.crc32(docs[d][0] + names[i].encode()) for d, i in zip(of_doc[long], number[long], strict=True)]
        hit = np.flatnonzero(h % DELETES == 0)
        if len(hit):
            names = names or list(table)
            shorter.update(without_one(names[i], x) for i, x in zip(number[hit].tolist(), h[hit].tolist(), strict=True))
        table.count[:len(table)] += np.bincount(np.delete(number, hit), minlength=len(table))
        runs.clear()
        docs.clear()

    for ids, texts in batches:
        for id_, text in zip(ids, texts, strict=True):
            found = RUN.findall((text or "").encode().lower().decode())
            runs.extend(map(table.__getitem__, found))
            docs.append((b"%s:" % (b"" if id_ is None else str(id_).encode()), len(found)))
            if len(runs) >= STEP_RUNS:
                count()
            if len(table) + len(shorter) >= TABLE_WORDS:
                count()
                yield from (dict(zip(table, table.count.tolist())), shorter)
                table, shorter = Words(), Counter()
    count()
    yield from (dict(zip(table, table.count.tolist())), shorter)


def count_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of the thinned runs."""
    def run(batches):
        slices = (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256))
        for counts in _partial_counts((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in slices):
            kept = [(w, n) for w, n in counts.items() if n and len(w) >= min_chars]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    parts = map_arrow(docs.select(F.col(id_col).cast("string"), F.col(text)), run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _prefixes(word: str) -> list[int]:
    h = xxhash.xxh3_64()
    out = [h.intdigest() - (1 << 63)]
    for c in word:
        h.update(c.encode())
        out.append(h.intdigest() - (1 << 63))
    return out


ROOT = _prefixes("")[0]


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (parent, first, label, child, ends, goes_on) and ends (node, word, n) of a table of distinct (word, n).  ``ends``: a word ends at the child;
    ``goes_on``: it has children."""
    spelt = cut(map_rows(words.select("word", "n"), lambda c: {**c, "path": [_prefixes(w) for w in c["word"]]}, "word string, n bigint, path array<bigint>", rows=4096))
    ends = cut(spelt.select(F.element_at("path", -1).alias("node"), "word", "n"))
    places = spelt.select("word", F.posexplode("path").alias("pos", "node")).where("pos > 0")  # the root is a node in any case
    after = F.substring("word", F.col("pos") + 1, F.lit(1))
    nodes = (places.groupBy("node").agg(F.min(after).alias("low"), F.max(after).alias("high"))
             .where("low = '' or low <> high").select("node", (F.col("low") == "").alias("ends"), (F.col("high") != "").alias("goes_on")))
    root = F.struct(F.lit(0).alias("pos"), F.lit(ROOT).alias("node"), F.lit(False).alias("ends"), F.lit(True).alias("goes_on"))
    path = F.array_sort(F.collect_list(F.struct("pos", "node", "ends", "goes_on")))
    paths = places.join(nodes, "node").groupBy("word").agg(path.alias("path")).withColumn("path", F.concat(F.array(root), "path"))
    steps = paths.select("word", "path", F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("i"))
    a, b = F.get("path", F.col("i") - 1), F.get("path", "i")
    edges = steps.select(a["node"].alias("parent"), F.substring("word", a["pos"] + 1, b["pos"] - a["pos"]).alias("label"), b["node"].alias("child"),
                         b["ends"].alias("ends"), b["goes_on"].alias("goes_on"))
    return cut(edges.dropDuplicates(["parent", "label"]).withColumn("first", F.left("label", F.lit(1)))), ends


def _rest(x: Column, y: Column) -> Column:
    """What is left of ``x`` when ``y`` is spelt beside it."""
    return F.substring(x, F.length(y) + 1, F.length(x))


def _spelt(states: DataFrame) -> DataFrame:
    """States whose rests agree as far as both go, with what remains of them; those that can go on or end."""
    a, b = F.col("rest_a"), F.col("rest_b")
    left = states.where(a.startswith(b) | b.startswith(a)).withColumns({"rest_a": _rest(a, b), "rest_b": _rest(b, a)})
    return left.where("if(rest_a = '', goes_a or rest_b = '' and ends_a, true) and if(rest_b = '', goes_b or rest_a = '' and ends_b, true)")


def _side(edge: str, side: str) -> list[Column]:
    return [F.col(f"{edge}.child").alias(side), F.col(f"{edge}.ends").alias(f"ends_{side}"), F.col(f"{edge}.goes_on").alias(f"goes_{side}")]


def neighbours(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words exactly one edit apart."""
    x, y = edges.alias("x"), edges.alias("y")
    two = x.join(y, (F.col("x.parent") == F.col("y.parent")) & (F.col("x.first") != F.col("y.first")))
    sides = [*_side("x", "a"), *_side("y", "b")]
    skipped = F.substring("y.label", F.lit(2), F.length("y.label"))
    starts = F.array(F.struct(F.col("x.label").alias("rest_a"), skipped.alias("rest_b")),  # b has one sign more
                     F.when(F.col("x.first") < F.col("y.first"), F.struct(F.substring("x.label", F.lit(2), F.length("x.label")).alias("rest_a"), skipped.alias("rest_b"))))
    frontier = cut(_spelt(two.select(*sides, F.explode(F.array_compact(starts)).alias("s")).select("*", "s.rest_a", "s.rest_b").drop("s")))
    # a word and the same with one sign at its end
    at_end = edges.where("ends and length(label) = 1").join(ends.select(F.col("node").alias("parent")), "parent", "left_semi")
    found = [at_end.select(F.col("parent").alias("a"), F.col("child").alias("b"))]
    while not frontier.isEmpty():
        found.append(frontier.where("rest_a = '' and rest_b = '' and ends_a and ends_b").select("a", "b"))
        both = frontier.where("rest_a = '' and rest_b = '' and goes_a and goes_b").alias("s").join(edges.alias("e"), F.col("s.a") == F.col("e.parent"))
        one = frontier.where("rest_a <> '' or rest_b <> ''").unionByName(
            both.select(*_side("e", "a"), "s.b", "s.ends_b", "s.goes_b", F.col("e.label").alias("rest_a"), "s.rest_b"))
        at_a = F.col("rest_a") == ""
        ready = one.withColumns({"node": F.when(at_a, F.col("a")).otherwise(F.col("b")), "sign": F.left(F.when(at_a, F.col("rest_b")).otherwise(F.col("rest_a")), F.lit(1))})
        on = ready.alias("s").join(edges.alias("e"), (F.col("s.node") == F.col("e.parent")) & (F.col("s.sign") == F.col("e.first")))
        now_a = F.col("s.rest_a") == ""
        moved = {}
        for side, here in (("a", now_a), ("b", ~now_a)):
            for col, new in ((side, "child"), (f"ends_{side}", "ends"), (f"goes_{side}", "goes_on"), (f"rest_{side}", "label")):
                moved[col] = F.when(here, F.col(f"e.{new}")).otherwise(F.col(f"s.{col}")).alias(col)
        frontier = cut(_spelt(on.select(*moved.values())))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    named = (pairs.join(ends.select(F.col("node").alias("a"), "word", "n"), "a")
             .join(ends.select(F.col("node").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n")), "b"))
    once = named.where(F.levenshtein("word", "near") == 1).select("word", "n", "near", "near_n")
    return once.unionByName(once.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table of (word, form) without circles: each round every word goes on to where its form has got, so rounds are as the
    logarithm of the longest chain."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        then = cut(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if then.where("moved").isEmpty():
            return now
        now = then.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word."""
    words = cut(count_words(docs, id_col, text, min_chars, min_count))
    near = neighbours(*trie(words))
    best = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    form_n = -F.col("best.less")
    has = form_n >= DOMINANCE * F.col("n")
    best = cut(best.select("word", "n_near", F.when(has, F.col("best.form")).alias("form"), F.when(has, form_n).alias("form_n")))
    named = words.join(best, "word", "left").join(roots(best.where("form is not null")), "word", "left")
    return named.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
