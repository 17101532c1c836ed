"""The score ledger: what has been paid for is kept, whatever becomes of the job."""

import os
from collections import Counter

import pandas as pd
import pytest

from sourcelens.operators.verdicts import score_batches
from sourcelens.plans.web import web_snapshot
from sourcelens.schemas import WEB_VERDICT
from sourcelens.sources.ledger import compact_ledger, fingerprint, latest_scores, read_ledger, score_with_ledger


def counting(log, bad=(), poison=None):
    """A scorer that writes every text it is asked about to ``log``; ``poison`` ends its process."""
    def scorer(batch):
        for t in batch["text"]:
            if t == poison:
                os._exit(3)
            with open(log, "a") as f:
                f.write(f"{t}\n")
        return pd.DataFrame({"key": batch["key"], "says_about_brand": batch["text"].str.upper(), "error": ["no" if t in bad else None for t in batch["text"]]})
    return scorer


def asked(log):
    return Counter(log.read_text().split("\n")[:-1]) if log.exists() else Counter()


def frame(spark, texts):
    return spark.createDataFrame([(f"k{i}", t, "clash") for i, t in enumerate(texts)], "key string, text string, fingerprint string").drop("fingerprint").repartition(3)


def test_equal_texts_are_scored_once_and_never_again(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "ledger")
    texts = [f"t{i % 7}" for i in range(100)] + ["hot"] * 300
    got = score_with_ledger(frame(spark, texts), counting(log), path, WEB_VERDICT, "m1").collect()
    assert sorted((r.key, r.says_about_brand, r.score_status) for r in got) == sorted((f"k{i}", t.upper(), "ok") for i, t in enumerate(texts))
    assert asked(log) == Counter({t: 1 for t in texts})
    again = score_with_ledger(frame(spark, texts + ["new"]), counting(log), path, WEB_VERDICT, "m1").collect()
    assert len(again) == 401 and asked(log) == Counter({t: 1 for t in texts + ["new"]})
    score_with_ledger(frame(spark, ["hot"]), counting(log), path, WEB_VERDICT, "m2")   # another model
    assert asked(log)["hot"] == 2


def test_hints_are_part_of_the_content(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "ledger")
    df = spark.createDataFrame([("a", "t", "x", None), ("b", "t", "x", None), ("c", "t", None, "x"), ("d", "t", "x", "")], "key string, text string, h1 string, h2 string")
    assert df.select(fingerprint("m", "text", ("h1", "h2"))).distinct().count() == 3
    assert score_with_ledger(df, counting(log), path, WEB_VERDICT, "m", hints=("h1", "h2")).count() == 4
    assert asked(log) == Counter({"t": 3})


def test_a_failed_text_is_asked_again_and_its_verdict_replaces_the_failure(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "ledger")
    first = score_with_ledger(frame(spark, ["good", "bad"]), counting(log, bad=("bad",)), path, WEB_VERDICT, "m").collect()
    assert sorted((r.score_status, r.score_error) for r in first) == [("failed", "no"), ("ok", None)]
    kept = score_with_ledger(frame(spark, ["good", "bad"]), counting(log), path, WEB_VERDICT, "m", retry_failed=False).collect()
    assert sorted(r.score_status for r in kept) == ["failed", "ok"] and asked(log)["bad"] == 1
    then = score_with_ledger(frame(spark, ["good", "bad"]), counting(log), path, WEB_VERDICT, "m").collect()
    assert {r.score_status for r in then} == {"ok"} and asked(log) == Counter({"good": 1, "bad": 2})
    compact_ledger(spark, path, str(tmp_path / "compact"), WEB_VERDICT)
    one = read_ledger(spark, str(tmp_path / "compact"), WEB_VERDICT)
    assert one.count() == 2 and latest_scores(one).where("score_status = 'ok'").count() == 2


def test_a_job_that_fails_leaves_what_it_has_paid_for(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "ledger")
    texts = [f"t{i:03}" for i in range(60)]
    with pytest.raises(Exception):
        score_with_ledger(frame(spark, texts), counting(log, poison="t031"), path, WEB_VERDICT, "m", texts_per_task=3)
    stored = {r.says_about_brand.lower() for r in read_ledger(spark, path, WEB_VERDICT).collect()}
    before = asked(log)
    assert 0 < len(stored) < 60 and stored <= set(before)
    got = score_with_ledger(frame(spark, texts), counting(log), path, WEB_VERDICT, "m", texts_per_task=3).collect()
    assert sorted(r.says_about_brand.lower() for r in got) == texts
    assert set((asked(log) - before).elements()) == set(texts) - stored   # exactly what was left


def test_nothing_to_score(spark, tmp_path):
    none = spark.createDataFrame([], "key string, text string")
    assert score_with_ledger(none, lambda b: 1 / 0, str(tmp_path / "l"), WEB_VERDICT, "m").collect() == []
    blank = spark.createDataFrame([("a", None), ("b", "")], "key string, text string")
    got = score_with_ledger(blank, lambda b: pd.DataFrame({"key": b["key"], "sentiment": 1.0}), str(tmp_path / "l"), WEB_VERDICT, "m").collect()
    assert [r.sentiment for r in got] == [1.0, 1.0]


def test_two_web_runs_share_a_ledger(spark, tmp_path, rules):
    from sourcelens.sources import readers
    from test_plans import AS_OF, empty_cache, land
    log, path = tmp_path / "log", str(tmp_path / "ledger")
    from sourcelens.operators.catalog import topics_frame
    topics = topics_frame(spark, [{"id": "t", "intent": "i", "query": "q"}])
    hits = [{"url": f"https://w{i}.test/", "description": "the same words" if i else "other words"} for i in range(4)]
    recs = readers.read_serp(spark, land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": hits}]), topics)
    for _ in range(2):
        snap = web_snapshot(recs, empty_cache(spark), None, rules, AS_OF, scorer=counting(log), ledger=path)
        rows = snap.sheet.collect()
        assert sorted(r.says_about_brand for r in rows) == ["OTHER WORDS"] + ["THE SAME WORDS"] * 3 and {r.verdict_source for r in rows} == {"model"}
    assert asked(log) == Counter({"the same words": 1, "other words": 1})


@pytest.mark.parametrize("field, value", [("competitors_named", 3), ("competitors_named", True), ("sentiment", float("inf")), ("price_mentioned", "\ud800"),
                                          ("says_about_brand", object()), ("mentions_competition", [1])])
def test_no_value_of_a_scorer_ends_the_job(spark, field, value):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "key string, text string").coalesce(1)
    got = {r.key: r for r in score_batches(df, lambda b: pd.DataFrame({"key": b["key"], field: pd.Series([value, None], dtype=object)}), WEB_VERDICT).collect()}
    assert got["b"].score_status == "ok" and got["a"].score_status in ("ok", "failed")


def test_a_rank_that_no_number_holds(spark):
    from sourcelens.schemas import ANSWER_VERDICT
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "key string, text string").coalesce(1)
    got = score_batches(df, lambda b: pd.DataFrame({"key": b["key"], "rank": [float("inf"), 1e30, 2]}), ANSWER_VERDICT).orderBy("key").collect()
    assert [(r.score_status, r["rank"]) for r in got] == [("ok", None), ("ok", None), ("ok", 2)]
