"""Brand mentions by an inverted join: equal to one scan per brand, at any length of the catalog."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sourcelens.operators.brand_index import brand_index, catalog_mentions, with_catalog_brands
from sourcelens.operators.links import brand_mentions

ODD = ["", "a", "AI", "C++", "é", "Ünï", "two words", "x.y*z", "\\E[a]", "😀", "a😀b", "line\nbreak", "RIVAL", "rival pro", "Abcd", "abcde"]


def texts():
    rng = random.Random(2)
    names = [rng.choice(ODD).swapcase() for _ in range(150)]
    rows = [(i, " ".join(rng.choice(names + ["rivalry", "xabcdy", "b.c", "two  words", "ai-ai", "C+++", "naïve"]) for _ in range(rng.randrange(12)))) for i in range(80)]
    return rows + [(100, None), (101, ""), (102, "rival " * 3000), (None, "RIVAL two words"), (7, "two words"), (7, "two words"), (7, "rival")]


def frames(spark, brands):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in texts()], "doc_id int, text string, brand string").repartition(3)
    return docs, spark.createDataFrame([(n + 1, b) for n, b in enumerate(brands)], "brand_pos int, brand string")


@pytest.mark.parametrize("word", [False, True])
@pytest.mark.parametrize("broadcast_brands", [1000, 0])
def test_equal_to_one_scan_per_brand(spark, word, broadcast_brands):
    docs, catalog = frames(spark, ODD)
    got = sorted(map(tuple, catalog_mentions(docs, catalog, word_boundary=word, broadcast_brands=broadcast_brands).collect()), key=repr)
    if word:  # Python's word boundaries; the empty name is at every boundary
        hit = lambda t, b: re.search(rf"\b{re.escape(b.lower())}\b", t.lower()) is not None
        want = [(i, n + 1, b) for i, t in texts() for n, b in enumerate(ODD) if hit(t or "", b)]
    else:
        want = list(map(tuple, brand_mentions(docs, ODD).collect()))
        assert want
    assert got == sorted(want, key=repr)


def test_fifty_thousand_brands(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) for _ in range(60_000)]
    brands = sorted({f"{rng.choice(words)} {rng.choice(words)}" if k % 3 else rng.choice(words) for k in range(70_000)})[:50_000]
    rng.shuffle(brands)
    rows = [(i, " ".join(rng.choice(words) if rng.random() < 0.9 else rng.choice(brands).upper() for _ in range(40))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    catalog = spark.createDataFrame([(n, b) for n, b in enumerate(brands)], "brand_pos int, brand string")
    mentions = catalog_mentions(docs, catalog)
    want = sorted((i, n, b) for i, t in rows for n, b in enumerate(brands) if b in t.lower())
    assert sorted(map(tuple, mentions.collect())) == want and len(want) > 500
    few = catalog_mentions(docs, catalog.where("brand_pos < 3"))
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert size(mentions) == pytest.approx(size(few), rel=0.2)


def test_lists_in_catalog_order(spark):
    docs, catalog = frames(spark, ["RIVAL", "two words", "nobody", "Rival"])
    one = docs.where("doc_id IS NULL OR doc_id <> 7").withColumn("comps", F.lit("old"))
    got = {r.doc_id: r.comps for r in with_catalog_brands(one, catalog).collect()}
    assert got[None] == ["RIVAL", "two words", "Rival"] and got[100] == [] and got[102] == ["RIVAL", "Rival"] and len(got) == one.count()
    both = with_catalog_brands(docs.where("doc_id = 7"), catalog).collect()
    assert {tuple(r.comps) for r in both} >= {("RIVAL", "two words", "Rival")} and len(both) == docs.where("doc_id = 7").count()


def test_a_brand_is_kept_under_its_rarest_gram(spark):
    docs = spark.createDataFrame([(i, "common words" + (" rarely" if i == 3 else "")) for i in range(20)], "doc_id int, text string")
    catalog = spark.createDataFrame([(1, "common words rarely"), (2, "missing")], "brand_pos int, brand string")
    index = brand_index(catalog, docs).collect()
    assert [r.brand_pos for r in index] == [1] and "common".find(index[0].gram) < 0 and "words".find(index[0].gram) < 0


def test_empty_tables(spark):
    docs, catalog = frames(spark, ODD)
    assert catalog_mentions(docs, catalog.limit(0)).collect() == []
    assert catalog_mentions(docs.limit(0), catalog).collect() == []
    assert {tuple(r.comps) for r in with_catalog_brands(docs, catalog.limit(0)).collect()} == {()}


@pytest.mark.parametrize("word", [False, True])
def test_neither_texts_nor_their_grams_are_shuffled(spark, word):
    docs, catalog = frames(spark, ODD)
    mentions = catalog_mentions(docs, catalog, word_boundary=word, broadcast_brands=0)
    plan = mentions._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "_hash" not in plan
    assert not [line for line in plan.split("\n") if "Exchange" in line and "_lt" in line]


def test_one_needle_for_several_brands_and_long_texts(spark):
    from sourcelens.operators import brand_index as b
    name = "é" * 40 + " x"
    rows = [(i, ("ab " * i + name + "!" + "ü" * 5) * 3) for i in range(30)] + [(99, "z" * (b.SLICE + 5) + " " + name.upper())]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    catalog = spark.createDataFrame([(1, name), (2, name.upper()), (3, "ab " + name), (4, "z" * 1000), (5, "b ab")], "brand_pos int, brand string")
    for word in (False, True):
        got = sorted((r.doc_id, r.brand_pos) for r in catalog_mentions(docs, catalog, word_boundary=word, broadcast_brands=0).collect())
        whole = lambda t, n: re.search(rf"\b{n}\b" if word else n, t) is not None
        assert got == sorted((i, p) for i, t in rows for p, n in ((1, name), (2, name), (3, "ab " + name), (4, "z" * 1000), (5, "b ab")) if whole(t.lower(), n))
