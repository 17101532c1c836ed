"""Run comparison (R3) and agreement with a labelled set (R4) against brute force."""

import random
from collections import Counter

import pytest

from sourcelens.plans import reports

SCHEMA = "k1 string, k2 bigint, v string, x double, l array<string>, s struct<a: string, b: string>"


def brute_diff(a, b):
    cols = ["v", "x", "l", "s"]
    plain = lambda r: tuple(repr(0.0 if c == 0 else c) for c in r)
    out = {}
    for key in {r[:2] for r in a + b}:
        ra, rb = (Counter(plain(r[2:]) for r in rows if r[:2] == key) for rows in (a, b))
        na, nb, same = ra.total(), rb.total(), (ra & rb).total()
        change = "added" if not na else "removed" if not nb else "same" if same == na == nb else "changed"
        differs = [c for i, c in enumerate(cols) if Counter(r[i] for r in ra.elements()) != Counter(r[i] for r in rb.elements())]
        out[key] = (change, ",".join(differs) if change == "changed" else "", na, nb, same)
    return out


def test_runs_are_compared_as_multisets(spark):
    rng = random.Random(6)

    def row():
        return (rng.choice(["p", "q", None, "hot", "hot"]), rng.choice([1, 2, None]), rng.choice(["a", "", None]), rng.choice([0.0, -0.0, 1.5, None]),
                rng.choice([None, [], ["x", None], [None, "x"], ["x"]]), rng.choice([None, ("a", None), (None, "a")]))
    a = [row() for _ in range(150)]
    b = rng.sample(a, 100) + [row() for _ in range(30)] + [("only b", 1, None, None, None, None)] * 2
    a += [("only a", 1, "a", 1.0, [], None), ("twice", 5, "a", 1.0, ["x"], ("a", "b")), ("twice", 5, "b", 2.0, ["x"], ("a", "b"))]
    b += [("twice", 5, "b", 1.0, ["x"], ("a", "b")), ("twice", 5, "a", 2.0, ["x"], ("a", "b"))]   # the same values, combined differently
    got = reports.snapshot_diff(spark.createDataFrame(a, SCHEMA).repartition(3), spark.createDataFrame(b, SCHEMA).repartition(2), ["k1", "k2"]).collect()
    assert {r[:2]: tuple(r[2:]) for r in map(tuple, got)} == brute_diff(a, b)
    twice = next(r for r in got if r.k1 == "twice")
    assert (twice.change, twice.changed_columns, twice.rows_same) == ("changed", "", 0)


def test_repeated_keys_make_no_product_and_no_join(spark):
    a = spark.range(20_000).selectExpr("'hot' AS k", "id % 3 AS v")
    d = reports.snapshot_diff(a, a, ["k"])
    assert [tuple(r) for r in d.collect()] == [("hot", "same", "", 20_000, 20_000, 20_000)]
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("partial_sum") >= 2


def test_snapshots_without_common_columns_or_rows(spark):
    a, none = spark.createDataFrame([("k", 1)], "k string, v int"), spark.createDataFrame([], "k string, v int")
    assert [tuple(r) for r in reports.snapshot_diff(a.select("k"), a.select("k"), ["k"]).collect()] == [("k", "same", "", 1, 1, 1)]
    assert [r.change for r in reports.snapshot_diff(none, a, ["k"]).collect()] == ["added"]
    assert reports.snapshot_diff(none, none, ["k"]).collect() == []


def kappa(pairs):
    n = len(pairs)
    agree = sum(g == p for g, p in pairs) / n
    gy, py = sum(g for g, _ in pairs) / n, sum(p for _, p in pairs) / n
    chance = gy * py + (1 - gy) * (1 - py)
    return agree, (agree - chance) / (1 - chance)


def test_agreement_with_abstentions(spark):
    rng = random.Random(9)
    gold = {i: (rng.choice([True, False, None]), rng.choice([1, 2, 3, None])) for i in range(200)}
    pred = {i: (rng.choice([True, False, None]), rng.choice([1, 2, 3, None])) for i in range(20, 230)}
    g = spark.createDataFrame([(i, *v) for i, v in gold.items()] * 2, "k int, f boolean, r int")   # every label given twice
    p = spark.createDataFrame([(i, *v) for i, v in pred.items()], "k int, f boolean, r int")
    got = {r.field: r for r in reports.gold_agreement(p, g, "k", ["f"], ["r"]).collect()}
    both = [(gold[i], pred.get(i, (None, None))) for i in gold]
    name = {True: "yes", False: "no", None: "none"}
    counts = Counter(f"{name[a[0]]}_{name[b[0]]}" for a, b in both)
    assert all(got["f"][f"{x}_{y}"] == counts[f"{x}_{y}"] for x in name.values() for y in name.values())
    rated = [(a[0], b[0]) for a, b in both if None not in (a[0], b[0])]
    agree, k = kappa(rated)
    assert (got["f"].rated, got["f"].accuracy, got["f"].kappa) == (len(rated), round(agree, 6), round(k, 6))
    assert got["f"].coverage == round(len(rated) / sum(a[0] is not None for a, _ in both), 6)
    off = [b[1] - a[1] for a, b in both if None not in (a[1], b[1])]
    assert (got["r"].rated, got["r"].mae, got["r"].bias) == (len(off), round(sum(map(abs, off)) / len(off), 6), round(sum(off) / len(off), 6))
    four = reports.score_against_gold(p, g, "k", ["f"]).first()
    seen = Counter((gold[i][0], pred[i][0]) for i in gold if i in pred)
    assert (four.tp, four.fp, four.fn, four.tn) == (seen[True, True], seen[False, True], seen[True, False], seen[False, False])


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, True, 1)]])
def test_agreement_over_nothing_is_null(spark, rows):
    g = spark.createDataFrame(rows, "k int, f boolean, r int")
    got = {r.field: r for r in reports.gold_agreement(g.limit(0), g, "k", ["f"], ["r"]).collect()}
    assert (got["f"].rated, got["f"].accuracy, got["f"].kappa, got["r"].mae) == (0, None, None, None)
    if rows and rows[0][1]:
        same = {r.field: r for r in reports.gold_agreement(g, g, "k", ["f"], ["r"]).collect()}
        assert (same["f"].accuracy, same["f"].kappa, same["f"].coverage, same["r"].mae) == (1.0, None, 1.0, 0.0)
