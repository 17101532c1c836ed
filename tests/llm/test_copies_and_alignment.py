"""Exact deduplication, spelling variants and token alignment against brute force and the tokenizer libraries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from llm_cases import SCHEMA
from pyspark.sql import functions as F

from sourcelens.llm import cross_tokenizer as ct
from sourcelens.llm import grace_dedup as gd
from sourcelens.llm import spelling_trie as st


# ---- Grace hashing --------------------------------------------------------------------------------------------
def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def same_groups(rows, got):
    """``got``: (id, keep_id, group_size, kept, sha256); rows of one group and id may differ in ``kept`` only."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            want[i, keep, len(ids), i == keep and not kept, hashlib.sha256(t.encode()).hexdigest()] += 1
            kept = kept or i == keep
    assert Counter(tuple(r) for r in got) == want


def copies():
    rng = random.Random(3)
    rows = [(i, rng.choice(["Hot Text " * 30, "HOT TEXT " * 30])) for i in range(700)]  # one group holds a third
    rows += [(1000 + i, f"Text {i % 900} " + "x" * (i % 900)) for i in range(1200)]
    rows += [(None, None), (None, ""), (3000, ""), (3001, None), (None, "only null"), (None, "Only Null"), (4000, "again"), (4000, "again"),
             (4001, "straße ÄÖ"), (4002, "STRAßE äö"), (4003, "STRAßE ÄÖ"), (5000, "long " * 60_000), (5001, "LONG " * 60_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"table_bytes": 3000, "first_table_bytes": 4000, "first_table_rows": 50}])
def test_exact_duplicates(spark, limits):
    rows = copies()
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id bigint, text string, place int, content string").repartition(5)
    same_groups(rows, gd.exact_duplicates(docs, **limits).collect())


def test_equal_hashes_decide_nothing(spark):
    rows = copies()[:300]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    same_groups(rows, gd.exact_duplicates(docs, hash_of=lambda c: (F.length(c) % 3).cast("bigint")).collect())


def test_overfull_buckets_are_partitioned_again(spark, tmp_path):
    rows = spark.range(400).select(F.xxhash64("id").alias("hash"), F.lit(1000).cast("bigint").alias("size"))
    rows = rows.unionByName(spark.createDataFrame([(5, 50_000)], "hash bigint, size bigint"))   # one content larger than a table
    levels = gd.overfull(rows, str(tmp_path), 20_000, 1)
    out = gd.with_bucket(rows, levels).groupBy("bucket").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    assert sum(r["s"] for r in out) == 450_000 and all(r["s"] <= 20_000 or r["n"] == 1 for r in out)
    assert len(levels) > 2 and len({r["bucket"].split(".")[0] for r in out}) > 1


def test_open_addressing_table():
    contents = []
    table = gd.Table(lambda i, x: contents[i] == x, slots=4)
    rng = random.Random(1)
    numbers = {}
    for _ in range(3000):
        x = b"%d" % rng.randrange(500)
        number, new = table.find_or_add(int(x) % 7, x)  # seven hashes only
        assert new == (x not in numbers) and numbers.setdefault(x, number) == number
        if new:
            contents.append(x)
    assert 2 * len(contents) <= len(table.slots)


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert gd.exact_duplicates(none).collect() == []
    assert st.spelling_variants(none).collect() == []
    assert ct.align_corpus(none, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).collect() == []


# ---- spelling variants ----------------------------------------------------------------------------------------
def words_of(rows, min_chars=5, min_count=3):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_chars:
                total[w] += 1
    return {w: n for w, n in total.items() if n >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def variants(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: f for w, xs in near.items() if xs and n[f := min(xs, key=lambda x: (-n[x], x))] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root(w)) for w in n)


def text_rows():
    rng = random.Random(8)
    stems = ["letter", "lettre", "letters", "latter", "ladder", "bladder", "läddер", "straße", "strasse", "ÉTUDE", "étude", "etude", "aaaaa", "aaaaaa", "aaaaaaa",
             "abcde", "bcdef", "abcdef", "×÷×÷×", "wordend", "wordends", "ends", "q" * 5000 + "a", "q" * 5000 + "b", "q" * 4999 + "b", "x" + "q" * 5000]
    words = stems + ["".join(rng.choice("abß") for _ in range(rng.randrange(4, 8))) for _ in range(150)]
    weights = [1 / (1 + k % 40) for k in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=60)) + f" A{i} 12-x") for i in range(300)]
    return rows + [(None, "letter étude"), (None, None), (7, ""), (8, "!!"), rows[0], rows[0], (900, "hot " * 3 + "lettre " * 5000)]


def test_spelling_variants(spark):
    rows = text_rows()
    docs = spark.createDataFrame([(i, t, 5, "clash") for i, t in rows], "doc_id bigint, text string, n int, word string").repartition(3)
    got = sorted(((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in st.spelling_variants(docs).collect()), key=lambda r: r[0])
    want = variants(words_of(rows))
    assert got == want
    assert sum(r[3] is not None for r in want) > 20 and any(len(r[0]) > 4000 for r in want)


def test_counts_do_not_depend_on_the_size_of_the_table(monkeypatch):
    rows = text_rows()
    monkeypatch.setattr(st, "TABLE_WORDS", 40)
    monkeypatch.setattr(st, "STEP_RUNS", 100)
    total = Counter()
    for part in st._partial_counts([([i for i, _ in rows[k:k + 7]], [t for _, t in rows[k:k + 7]]) for k in range(0, len(rows), 7)]):
        total.update(part)
    assert {w: n for w, n in total.items() if len(w) >= 5 and n >= 3} == words_of(rows)


def test_neighbours_of_a_dense_vocabulary(spark):
    """All words of two letters up to a length: many prefixes that are words, many edits at each place."""
    import itertools
    n = {"".join(w): 3 + len(w) for k in range(1, 7) for w in itertools.product("ab", repeat=k)}
    got = sorted((r["word"], r["near"]) for r in st.neighbours(*st.trie(spark.createDataFrame(list(n.items()), "word string, n bigint"))).collect())
    assert got == sorted((a, b) for a in n for b in n if one_edit(a, b))


def test_colliding_nodes_add_no_neighbour(spark, monkeypatch):
    rng = random.Random(2)
    n = {"".join(rng.choice("abcd") for _ in range(5)): 3 for _ in range(200)}
    monkeypatch.setattr(st, "_prefixes", lambda w: [k if k == 0 else 1 + sum(map(ord, w[:k])) % 60 + 100 * k for k in range(len(w) + 1)])
    monkeypatch.setattr(st, "ROOT", 0)
    got = {(r["word"], r["near"]) for r in st.neighbours(*st.trie(spark.createDataFrame(list(n.items()), "word string, n bigint"))).collect()}
    assert all(one_edit(a, b) for a, b in got)


def test_roots_of_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [(f"s{i}", "w5") for i in range(50)]
    got = {r["word"]: r["root"] for r in st.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert set(got) == {w for w, _ in chain} and set(got.values()) == {"w37"}


# ---- alignment ------------------------------------------------------------------------------------------------
TEXTS = [None, "", " ", "  a  b ", "\n\n x\ty ", "a" * 30_000, "naïve 你好 <|endoftext|> <s> </s> <0x0A> 😀", "x▁y", "\0a", "tabs\t\t end  ", "don't can't 12345 !!??",
         " " * 30_000 + "z", "é" * 50, "the same text", "the same text", "The Same text, twice. " * 400]


def library_rows(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    symbols = {s: i for i, s in enumerate(ct_symbols())}
    docs, counts = [], Counter()
    for t in texts:
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        bytes_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not t or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        at_b = {e: j for j, e in enumerate(ends_b)}
        links = [(ids_a[i], ids_b[at_b[e]]) for i, e in enumerate(ends_a) if e in at_b]
        counts.update(links)
        parts, i0, j0 = [], 0, 0
        for i, e in enumerate(ends_a):
            if e in at_b:
                parts.append(",".join(map(str, ids_a[i0:i + 1])) + "|" + ",".join(map(str, ids_b[j0:at_b[e] + 1])))
                i0, j0 = i + 1, at_b[e] + 1
        docs.append((len(ids_a), len(ids_b), len(parts), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if ids_a else ""))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [(n_a, n_b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha) for n_a, n_b, n, links, sha in docs]


def ct_symbols():
    from sourcelens.llm.bpe import byte_symbols
    return byte_symbols()


@pytest.mark.parametrize("broadcast_pairs", [ct.BROADCAST_PAIRS, 0])
def test_alignment_equals_the_libraries(spark, broadcast_pairs):
    texts = TEXTS + [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()]
    ids = [None if k % 7 == 3 else k % 50 for k in range(len(texts))]
    docs = spark.createDataFrame([(i, t, k, "row") for k, (i, t) in enumerate(zip(ids, texts, strict=True))], "doc_id bigint, text string, n_a int, pairs string").repartition(3)
    got = ct.align_corpus(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), broadcast_pairs=broadcast_pairs).collect()
    want = [(i, *r) for i, r in zip(ids, library_rows(texts), strict=True)]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r[k] for k in names) for r in got) == Counter(want)


def test_gallop_and_overlaps():
    rng = random.Random(4)
    for n, m in [(1, 1), (3, 4000), (4000, 3), (700, 700), (300, 5000)]:
        end = max(n, m) * 3
        x, y = (np.array(sorted({*rng.sample(range(1, end), k - 1), end})) for k in (n, m))
        assert ct.gallop(x, y).tolist() == np.searchsorted(y, x).tolist()
        at_x, at_y = ct.common_ends(x, y)
        assert x[at_x].tolist() == y[at_y].tolist() == sorted(set(x.tolist()) & set(y.tolist()))
        first, last = ct.overlap_ranges(x, y)
        starts_x, starts_y = ([0, *z[:-1].tolist()] for z in (x, y))
        for i in rng.sample(range(len(x)), min(len(x), 40)):
            own = [j for j in range(len(y)) if starts_y[j] < x[i] and y[j] > starts_x[i]]
            assert (first[i], last[i]) == (own[0], own[-1])


def test_token_ranges(spark):
    docs = spark.createDataFrame([(1, "unbelievable alignment"), (2, None)], "doc_id bigint, text string")
    rows = ct.token_ranges(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).orderBy("pos").collect()
    assert {r["id"] for r in rows} == {1} and [r["pos"] for r in rows] == list(range(len(rows)))
    assert all(r["b_first"] <= r["b_last"] and len(r["b_ids"]) == r["b_last"] - r["b_first"] + 1 for r in rows)
    assert all(b["b_first"] - a["b_last"] in (0, 1) for a, b in zip(rows, rows[1:]))
