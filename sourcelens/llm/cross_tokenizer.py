"""Alignment of two tokenizers' tokens over the same bytes, by a galloping intersection of their end offsets.

A is a byte-level BPE, B a piece model with byte fallback that puts a space before the text.  Both token sequences spell the
bytes of space + text.  Each tokenizer gives an ascending list of byte ends; the shorter list drives an exponential, then
binary search into the longer one, which gives the rank of each of its ends there.  Where the ends are equal both tokenizers have a boundary:
these common indices slice the tokens into groups.  Differences of neighbouring ranks are the ranges of tokens that a token overlaps.

Two tokens that end together are linked.  Their ids form a pair; the corpus-wide count of a pair is how many links hold it.
A link is best if no other pair of its B id has a higher count.

Defined cases: null and empty texts have no tokens, nor have texts whose tokens don't spell space + text (a literal U+2581, which B
reads as a space); special tokens' strings are plain text; texts of any length are aligned whole; rows are told apart by a key of
their own, so null and repeated ids change nothing; only id and text are read, so further columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.llm.bpe import Vocabulary
from sourcelens.llm.common import map_rows, shared_folder

#: Ends that one step of the galloping search places.
BLOCK = 256
#: A pair table of up to so many rows (24 bytes each) is broadcast; a larger one is joined by shuffles.
BROADCAST_PAIRS = 2_000_000
#: The encoder of A is recursive in runs of white space; texts with such long ones go through our own.
LONG_SPACE = re.compile(r"\s{20000}")

#: Fixed: how a byte-level vocabulary splits a text before its merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizers:
    """Both vocabularies, loaded once per Python worker.  ``a``: a byte-level BPE whose ids are in merge order; ``b``: a piece model's file."""

    def __init__(self, a: Vocabulary, b: bytes):
        import sentencepiece
        import tiktoken
        special = set(a.added.values())
        a.split = None  # special tokens are plain text
        self.own, self.a_strings = a, a.strings
        self.a = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks={s: i for i, s in enumerate(a.strings) if s and i not in special}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.b_strings = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                          for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_lengths, self.b_lengths = (np.array([len(s) for s in x], np.int64) for x in (self.a_strings, self.b_strings))
        most = max(len(self.a_strings), len(self.b_strings))
        self.comma, self.bar, self.semicolon = (np.array([b"%d%s" % (i, end) for i in range(most)]) for end in (b",", b"|", b";"))

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text the ids of space + text by A and of the text by B; both empty where either doesn't spell space + text."""
        none = np.zeros(0, np.uint32)
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1), strict=True):
            if not text:
                yield none, none
                continue
            spaced = " " + text
            a = np.frombuffer(self.own.encode(spaced), "<u4").tolist() if LONG_SPACE.search(spaced) else self.a.encode_ordinary(spaced)
            raw = spaced.encode()
            same = all(b"".join([strings[i] for i in ids]) == raw for strings, ids in ((self.a_strings, a), (self.b_strings, b)))
            yield (np.array(a, np.uint32), np.array(b, np.uint32)) if same else (none, none)

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])

    def groups_text(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: each token's number with the sign after it, put in its place in one step."""
        of_a, of_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        place_a = np.arange(len(a)) + np.repeat(at_b + 1 - of_b, of_a)
        place_b = np.arange(len(b)) + np.repeat(at_a + 1, of_b)
        out = np.empty(len(a) + len(b), self.comma.dtype)
        out[place_a], out[place_b] = self.comma[a], self.comma[b]
        out[place_a[at_a]], out[place_b[at_b]] = self.bar[a[at_a]], self.semicolon[b[at_b]]
        return out.tobytes().translate(None, b"\0")[:-1]  # shorter numbers are padded by zero bytes


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """The rank of each value of ``short`` in ``long``: how many of its values are smaller.  Both ascend.  A block of values at a time:
    from the last rank on steps double until they pass the block; a binary search for each value ends inside these bounds."""
    ranks, j, m = np.empty(len(short), np.int64), 0, len(long)
    for at in range(0, len(short), BLOCK):
        block, step = short[at:at + BLOCK], BLOCK
        while j + step < m and long[j + step] < block[-1]:
            step *= 2
        ranks[at:at + BLOCK] = j + np.searchsorted(long[j:j + step + 1], block)
        j = int(ranks[min(at + BLOCK, len(short)) - 1])
    return ranks


def common_ends(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the equal values of two ascending lists."""
    if len(x) > len(y):
        return common_ends(y, x)[::-1]
    ranks = gallop(x, y)
    at = np.flatnonzero(np.append(y, -1)[ranks] == x)
    return at, ranks[at]


def overlap_ranges(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of ``y`` that each token of ``x`` overlaps; both lists of ends reach the same last byte."""
    swapped = len(x) > len(y)
    if not swapped:
        ranks = gallop(x, y)
        passed = ranks + (y[ranks] == x)  # tokens of y that end by the end of each token of x
    else:  # ranks of y in x: count, for each token of x, the ends of y by its end
        ranks = gallop(y, x)
        passed = np.cumsum(np.bincount(ranks, minlength=len(x)))
    first = np.concatenate([np.zeros(1, np.int64), passed[:-1]])
    whole = np.isin(x, y) if swapped else y[np.minimum(passed - 1, len(y) - 1)] == x
    return first, np.where(whole, passed - 1, passed)


_LOADED: dict[tuple, Tokenizers] = {}


def _mapped(docs: DataFrame, byte_bpe: str, piece_model: str, columns: list, run, schema: str) -> DataFrame:
    with open(piece_model, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast((Vocabulary(byte_bpe), f.read()))  # vocabulary files: bounded

    def loaded(c):
        key = (byte_bpe, piece_model)
        if key not in _LOADED:
            _LOADED[key] = Tokenizers(*held.value)
        return run(_LOADED[key], c)

    return map_rows(docs.select(*columns), loaded, schema, rows=64)


def align_documents(docs: DataFrame, byte_bpe: str, piece_model: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_overlaps, groups_sha256, pairs, times): ``pairs`` are a document's distinct linked id pairs
    (A's id in the upper 32 bits), ``times`` their numbers of links, ``n_overlaps`` the pairs of tokens that share bytes."""
    def run(t, c):
        out = {"id": c["id"], "n_a": [], "n_b": [], "n_groups": [], "n_overlaps": [], "groups_sha256": [], "pairs": [], "times": []}
        for a, b in t.encode(c["t"]):
            at_a, at_b = common_ends(*t.ends(a, b))
            pairs, times = np.unique(a[at_a].astype(np.int64) << 32 | b[at_b], return_counts=True)
            for k, v in (("n_a", len(a)), ("n_b", len(b)), ("n_groups", len(at_a)), ("n_overlaps", len(a) + len(b) - len(at_a)),
                         ("groups_sha256", hashlib.sha256(t.groups_text(a, b, at_a, at_b)).hexdigest() if len(a) else ""),
                         ("pairs", pairs), ("times", times.astype(np.int32))):
                out[k].append(v)
        return out

    return _mapped(docs, byte_bpe, piece_model, [F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("t")], run,
                   "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_overlaps bigint, groups_sha256 string, pairs array<bigint>, times array<int>")


def token_ranges(docs: DataFrame, byte_bpe: str, piece_model: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each token of A: (id, pos, a_id, b_first, b_last, b_ids): the tokens of B that share bytes with it."""
    def run(t, c):
        out = {"id": c["id"], "tokens": []}
        for a, b in t.encode(c["t"]):
            first, last = overlap_ranges(*t.ends(a, b)) if len(a) else (a, a)
            out["tokens"].append([{"pos": i, "a_id": x, "b_first": f, "b_last": e, "b_ids": b[f:e + 1].tolist()}
                                  for i, (x, f, e) in enumerate(zip(a.tolist(), first.tolist(), last.tolist(), strict=True))])
        return out

    token = "array<struct<pos: bigint, a_id: bigint, b_first: bigint, b_last: bigint, b_ids: array<bigint>>>"
    return _mapped(docs, byte_bpe, piece_model, [F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("t")], run,
                   f"id bigint, tokens {token}").select("id", F.inline("tokens"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, links, best): corpus-wide numbers of links, and whether no pair of the same B id has more."""
    counts = (aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("links")))
    counts = counts.withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = counts.groupBy("b_id").agg(F.max("links").alias("most"))
    return counts.join(most, "b_id").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def align_corpus(docs: DataFrame, byte_bpe: str, piece_model: str, id_col: str = "doc_id", text: str = "text",
                 broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """A row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps.  Alignments are written once to the
    shared folder: as Parquet, whose dictionaries hold each pair once a file; the counts and the sums both read them there."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/aligned-{uuid.uuid4().hex}"
    align_documents(docs, byte_bpe, piece_model, id_col, text).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/documents")
    aligned = spark.read.parquet(f"{folder}/documents")
    pair_counts(aligned).write.parquet(f"{folder}/pairs")
    pairs = spark.read.parquet(f"{folder}/pairs")
    few = pairs.count() <= broadcast_pairs
    own = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))
    sums = (own.join(F.broadcast(pairs) if few else pairs, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum")))
    none = F.lit(0).cast("bigint")
    return aligned.drop("pairs", "times").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256", "n_overlaps")
