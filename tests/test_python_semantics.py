"""Spark's regex labels equal Python's ``re`` (the reference's regex engine) on whole tables:
claim search on lower-cased text, price and URL findall, canonical links."""

import re

import pytest
from pyspark.sql import functions as F

from sourcelens.functions.text import claim_flags, prices_seen
from sourcelens.functions.urls import url_mentions
from sourcelens.plans import testbed as tb

SF = "/root/testdata/sf0.01"
URL_RE = r'https?://[^\s\)\]\"\'>,]+'


def test_claims_and_prices_match_python_re(spark, rules):
    docs = tb.table(spark, SF, "documents").select("doc_id", "text")
    flags = claim_flags(F.col("text"), rules)
    got = {r.doc_id: r for r in docs.select("doc_id", "text", *[c.alias(n) for n, c in flags.items()],
                                            prices_seen(F.col("text"), rules).alias("prices")).collect()}
    for doc_id, r in got.items():
        t = (r.text or "").lower()
        for name, pats in rules.claim_patterns:
            assert r[name] == any(re.search(p, t) for p in pats), (doc_id, name)
        assert r.current_signal == any(re.search(p, t) for p in rules.current_signal_patterns)
        assert r.prices == sorted(set(re.findall(rules.price_pattern, r.text or "")))


def test_prices_match_python_re_on_price_text(spark, rules):
    part = tb.table(spark, SF, "part")
    text = F.concat(F.col("p_name"), F.lit(" $"), F.floor("p_retailprice").cast("string"), F.lit(" or $ "),
                    F.col("p_size").cast("string"), F.lit("0 $12345"))
    rows = part.select(text.alias("t"), prices_seen(text, rules).alias("p")).collect()
    for r in rows:
        assert r.p == sorted(set(re.findall(rules.price_pattern, r.t)))


def test_url_mentions_and_links_match_python(spark, rules):
    bodies = tb.link_bodies(spark, SF)
    rows = bodies.select("text", url_mentions(F.col("text")).alias("u")).collect()
    assert all(r.u == re.findall(URL_RE, r.text) for r in rows)


def test_claims_on_answers_match_python_re(spark, rules):
    a = tb.conversation_answers(spark, SF).select("response")
    flags = claim_flags(F.col("response"), rules)
    for r in a.select("response", *[c.alias(n) for n, c in flags.items()]).collect():
        t = r.response.lower()
        for name, pats in rules.claim_patterns:
            assert r[name] == any(re.search(p, t) for p in pats)


LITERALS = [("only.{0,20}the", ["only", "the"]), ("a(bc)+d", ["bc", "a", "d"]), ("a(bc)?d", ["a", "d"]), ("(x|yz)ab", ["ab"]), ("[ab]cde?", ["cd"]), (r"\bword\b", ["word"]),
            (r"\d+%", ["%"]), ("(?i)abc", []), ("x|y", []), (".*", []), ("(?:no longer|not)", ["no"]), ("(?=abc)a", ["a"]), ("(?!abc)de", ["de"]), ("a{0}bc", ["bc"]), ("the.{0,12}the", ["the"]),
            ("(", [])]


@pytest.mark.parametrize("pattern, literals", LITERALS)
def test_literals_that_a_match_must_hold(pattern, literals):
    from sourcelens.functions.text import required_literals
    got = required_literals(pattern)
    assert got == literals


def test_guarded_claims_equal_the_regex(spark):
    """On texts made of the patterns' own parts, where literals come without a match and the other way round."""
    import random
    from sourcelens.functions.text import claim_flag
    rng = random.Random(7)
    claims = [["only.{0,5}the", "never"], ["a(bc)+d"], ["a(bc)?d"], ["(x|yz)ab", r"\d+%"], ["x|y"], ["(?i)ABC"], []]
    parts = ["only", "the", "never", "a", "bc", "d", "x", "yz", "ab", "7", "%", "\n", " ", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", *[claim_flag("t", c).alias(f"c{k}") for k, c in enumerate(claims)]).collect()
    for r in rows:
        for k, c in enumerate(claims):
            assert r[f"c{k}"] == any(re.search(p, texts[r.i] or "") for p in c) if texts[r.i] is not None else r[f"c{k}"] is False, (texts[r.i], c)
