"""Ownership against long domain lists: equal to the expression and to the suffix join, without moving a row."""

import random

import pytest

from sourcelens.functions.urls import host_of
from sourcelens.operators.ownership import domain_dimension, label_ownership, label_ownership_domains, label_ownership_join, with_nonprod
from sourcelens.plans.web import web_sheet, web_snapshot
from sourcelens.sources import readers
from test_plans import AS_OF, empty_cache, land


def random_rules(rules, n, seed=1):
    rng = random.Random(seed)
    name = lambda: ".".join(rng.choice("abcXYZ") + str(rng.randrange(n)) for _ in range(rng.randrange(1, 4))) + rng.choice([".test", ".co.test", ".com"])
    rivals, owned = tuple(name() for _ in range(n)), tuple(name() for _ in range(n))
    return rules.with_(competitor_domains=rivals + owned[:2], owned_domains=owned + rules.app_store_hosts[:1], nonprod_prefixes=("m", "blog"))


def hosts(rules, n=300):
    rng = random.Random(3)
    known = [d.lower() for d in (*rules.competitor_domains, *rules.owned_domains, *rules.app_store_hosts, rules.marketplace_host)]
    out = [rng.choice(["", "m.", "blog.", "m.x.", "x", "www."]) + rng.choice(known) for _ in range(n)]
    return out + ["", "test", "com", ".", "a.", ".test", "m.test", None, *known[:3], "play.google.com", "x.play.google.com", "amazon.com"]


@pytest.mark.parametrize("broadcast_domains", [100_000, 0])
def test_equal_to_the_other_forms(spark, rules, broadcast_domains):
    r = random_rules(rules, 40)
    rows = [(i, h, f"https://{h}/dp/1?id={r.owned_app_ids[0] if i % 2 else ''}", "old") for i, h in enumerate(hosts(r))]
    df = spark.createDataFrame(rows, "id int, host string, url string, ownership string")
    got = {x.id: (x.ownership, x.np) for x in label_ownership_domains(df, r, nonprod="np", broadcast_domains=broadcast_domains).collect()}
    want = {x.id: (x.ownership, bool(x.np)) for x in with_nonprod(label_ownership(df, r, "url", "host"), r, "host", "np").collect()}
    assert got == want and {o for o, _ in want.values()} >= {"competitor", "owned", "third_party", "owned_marketplace"} and any(n for _, n in want.values())
    joined = {x.id: x.ownership for x in label_ownership_join(df.where("host is not null"), r, "url", "host").collect()}
    assert joined == {i: got[i][0] for i in joined}


def test_a_hot_host_stays_where_it_is(spark, rules):
    df = spark.range(10_000).selectExpr("if(id % 3 > 0, 'm.hot.example.net', concat('h', id, '.test')) AS host", "concat('https://h/', id) AS url")
    physical = label_ownership_domains(df, random_rules(rules, 200))._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical


def test_a_web_run_with_a_hundred_thousand_domains(spark, tmp_path, rules):
    big, less = random_rules(rules, 50_000), random_rules(rules, 100)
    urls = [f"https://{h}/p{i}?x=1" for i, h in enumerate(hosts(big, 120)) if h and not h.startswith(".") and not h.endswith(".")]
    recs = readers.read_serp(spark, land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [{"url": u} for u in urls]}]))
    snap = web_snapshot(recs, empty_cache(spark), None, big, AS_OF)
    rows = {r.url: (r.ownership, r.nonprod_url) for r in web_sheet(snap).collect()}
    flat = spark.createDataFrame([(u,) for u in rows], "url string").withColumn("host", host_of("url"))
    joined = label_ownership_join(flat, big, "url", "host", domains=domain_dimension(spark, big))
    assert {u: o for u, (o, _) in rows.items()} == {r.url: r.ownership for r in joined.collect()}
    owned = {d.lower() for d in big.owned_domains}
    for u, (_, nonprod) in rows.items():
        labels = u.split("/")[2].split(".")
        assert nonprod == (labels[0] in ("m", "blog") and any(".".join(labels[k:]) in owned for k in range(1, len(labels))))
    size = lambda r: len(web_snapshot(recs, empty_cache(spark), None, r, AS_OF).sheet._jdf.queryExecution().optimizedPlan().toString())
    assert size(big) == pytest.approx(size(less), rel=0.3)


def test_domains_without_rows(spark, rules):
    df = spark.createDataFrame([("h.test", "https://h.test/")], "host string, url string")
    none = spark.createDataFrame([], "domain string, kind string")
    assert [r.ownership for r in label_ownership_domains(df, rules, domains=none).collect()] == ["third_party"]
    odd = spark.createDataFrame([(None, "owned"), ("H.test", "owned"), ("h.TEST", "competitor"), ("h.test", "unknown")], "domain string, kind string")
    assert [r.ownership for r in label_ownership_domains(df, rules, domains=odd).collect()] == ["competitor"]
    assert label_ownership_domains(df.limit(0), rules, domains=odd).collect() == []
