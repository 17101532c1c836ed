"""Answer rows: status, sources, non-production flag, error rows, snapshot, sheet order."""

import pandas as pd
from pyspark.sql import functions as F

from sourcelens.operators.answers import error_rows
from sourcelens.operators.catalog import request_manifest
from sourcelens.plans.answers import answer_sheet, answer_snapshot, classify_answers
from sourcelens.schemas import ANSWER_VERDICT, LLM_COLUMNS

ANS_SCHEMA = "surface string, run long, prompt string, response string, citations array<string>, error string"


def answers(spark, rows):
    return spark.createDataFrame(rows, ANS_SCHEMA)


def manifest(spark, prompts, surfaces, runs):
    p = spark.createDataFrame([(x, "brand_entity", f"t{i}") for i, x in enumerate(prompts)],
                              "prompt string, intent string, topic_id string")
    return request_manifest(p, surfaces, runs)


def test_empty_answer_is_not_judged(spark, rules):
    df = answers(spark, [("perplexity", 1, "license vs Token", "   ", [], None)])
    r = classify_answers(df.withColumn("intent", F.lit("comparison")).withColumn("topic_id", F.lit("")),
                         None, rules).first()
    assert r.status == "empty" and r.mentioned is None and r.says_about_brand == ""
    assert r.sources_cited == [] and r.nonprod_url is False


def test_sources_canonicalised_deduped_nonprod(spark, rules):
    text = "license is great. See https://example.net/a?utm_source=chat.example"
    df = answers(spark, [("chatgpt", 1, "license", text,
                          ["https://blog.example.net/faqs?os=android", "https://example.net/a"], None)])
    r = classify_answers(df, None, rules).first()
    assert r.sources_cited == ["https://example.net/a", "https://blog.example.net/faqs"]
    assert r.nonprod_url is True and r.status == "ok" and r.mentioned is True


def test_model_verdict_path(spark, rules):
    df = answers(spark, [("chatgpt", 1, "best monitor", "license is best. Token is second.", [], None)])
    v = spark.createDataFrame([("chatgpt\u001f1\u001fbest monitor", True, 2, True, "Recommends license.", True,
                                "vs Token", ["Token"], 0.6, None, ["https://example.net/"])], ANSWER_VERDICT)
    r = classify_answers(df, v, rules).first()
    assert r.recommended is True and r.rank == 2 and r.competitors_named == ["Token"]
    assert r.says_about_brand == "Recommends license." and r.verdict_source == "model"
    assert r.sources_cited == ["https://example.net"]


def test_error_rows_per_prompt_and_unknown_surface(spark):
    m = manifest(spark, ["p1", "p2"], ["chatgpt", "perplexity", "other"], 1)
    f = spark.createDataFrame([("chatgpt", 1, None, "actor exploded"), ("perplexity", 1, "p2", "api 500")],
                              "surface string, run long, prompt string, note string")
    rows = {(r.surface, r.prompt): r.error_note for r in error_rows(m, f, ["chatgpt", "perplexity"]).collect()}
    assert rows == {("chatgpt", "p1"): "actor exploded", ("chatgpt", "p2"): "actor exploded",
                    ("perplexity", "p2"): "api 500", ("other", "p1"): "unknown surface 'other'",
                    ("other", "p2"): "unknown surface 'other'"}


def test_snapshot_runs_errors_and_order(spark, rules):
    m = manifest(spark, ["license", "license reviews"], ["chatgpt", "perplexity"], 3)
    rows = [("chatgpt", r, p, f"license is great ({p}, {r}).", [], None)
            for r in (1, 2, 3) for p in ("license", "license reviews")]
    rows.append(("perplexity", 1, "license", "", [], "no API key configured"))
    snap = answer_snapshot(m, answers(spark, rows), rules, ["chatgpt", "perplexity"])
    pdf = answer_sheet(snap).toPandas()
    assert list(pdf.columns) == LLM_COLUMNS
    ok = pdf[pdf.status == "ok"]
    assert sorted(ok[ok.prompt == "license"].run.tolist()) == [1, 2, 3]
    err = pdf[pdf.status == "error"]
    assert len(err) == 1 and err.iloc[0].error_note == "no API key configured"


def test_snapshot_missing_prompts_optional(spark, rules):
    m = manifest(spark, ["a", "b"], ["chatgpt"], 1)
    df = answers(spark, [("chatgpt", 1, "a", "license", [], None)])
    assert answer_snapshot(m, df, rules, ["chatgpt"]).count() == 1
    snap = answer_snapshot(m, df, rules, ["chatgpt"], include_missing=True)
    assert {(r.prompt, r.status) for r in snap.collect()} == {("a", "ok"), ("b", "missing")}


def test_scorer_and_failed_rows(spark, rules):
    m = manifest(spark, ["good", "bad"], ["chatgpt"], 1)
    df = answers(spark, [("chatgpt", 1, "good", "license is fine", [], None),
                         ("chatgpt", 1, "bad", "license boom", [], None)])

    def scorer(batch):
        boom = batch["text"].str.contains("boom")
        return pd.DataFrame({"key": batch["key"], "error": boom.map({True: "no answer", False: None}), "mentioned": True, "rank": 1, "recommended": True,
                             "says_about_brand": "Scored.", "mentions_competition": False,
                             "competition_summary": None, "competitors_named": [[] for _ in range(len(batch))],
                             "sentiment": 0.9, "price_mentioned": "$99",
                             "sources_cited": [[] for _ in range(len(batch))]})
    snap = {r.prompt: r for r in answer_snapshot(m, df, rules, ["chatgpt"], scorer=scorer).collect()}
    assert snap["good"].says_about_brand == "Scored." and snap["good"].price == "$99"
    assert snap["bad"].verdict_source == "fallback" and snap["bad"].says_about_brand == "Mentions license."


def test_request_from_selection_and_adhoc_writes_snapshot(spark, tmp_path, rules):
    """Catalog position 1 plus two ad-hoc prompts, one of them a duplicate of the selected
    topic: the duplicate is not requested twice, the ad-hoc intent is kept, and the run is
    written as one snapshot partition."""
    from sourcelens.operators.catalog import add_adhoc, select_catalog, topics_frame
    from sourcelens.sources.sinks import write_snapshot
    topics = topics_frame(spark, [{"id": "brand_head", "intent": "brand_entity", "query": "license monitor"},
                                  {"id": "cmp_token", "intent": "comparison", "query": "license vs Token"}])
    cat = topics.select((F.col("seq") + 1).alias("pos"), F.col("query").alias("label"), "intent",
                        F.col("id").alias("topic_id"))
    chosen = select_catalog(cat, ["1"]).select(F.col("label").alias("prompt"), "intent",
                                                                      "topic_id")
    extra = spark.createDataFrame([("license vs Other", "comparison", 0), ("license monitor", "", 1)],
                                  "text string, intent string, ord long")
    prompts = chosen.unionByName(add_adhoc(chosen, extra).drop("ord"))
    m = request_manifest(prompts, ["chatgpt"], 1)
    assert sorted(r.prompt for r in m.collect()) == ["license monitor", "license vs Other"]
    ans = answers(spark, [("chatgpt", 1, r.prompt, "license is great. Worth it.", [], None) for r in m.collect()])
    snap = answer_snapshot(m, ans, rules, ["chatgpt"])
    base = str(tmp_path / "runs")
    assert write_snapshot(answer_sheet(snap), base, "answers", "run-1", guard=ans)
    back = spark.read.parquet(base + "/answers")
    assert {r.prompt: r.intent for r in back.collect()} == {"license monitor": "brand_entity",
                                                            "license vs Other": "comparison"}


def test_cluster_conf_only_fills_unset(spark):
    from sourcelens.session import CLUSTER_CONF, apply_cluster_conf
    done = apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "8"})
    assert set(done) <= set(CLUSTER_CONF) | {"spark.sql.shuffle.partitions"}
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10485760")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")


def test_error_note_whole_and_unicode_blank_is_empty(spark, rules):
    m = manifest(spark, ["p1"], ["chatgpt"], 1)
    f = spark.createDataFrame([("chatgpt", 1, None, "x" * 500)], "surface string, run long, prompt string, note string")
    assert len(error_rows(m, f, ["chatgpt"]).first().error_note) == 500
    assert len(error_rows(m, f, ["chatgpt"], note_cap=300).first().error_note) == 300
    df = answers(spark, [("chatgpt", 1, "p1", "  \n ", [], None)])
    assert classify_answers(df, None, rules).first().status == "empty"


def test_failures_are_equi_joins(spark):
    """Neither a whole call nor a single prompt's failure compares a prompt with other prompts' failures."""
    m = manifest(spark, [f"p{i}" for i in range(50)], ["chatgpt"], 2)
    f = spark.createDataFrame([("chatgpt", 1, None, "down")] + [("chatgpt", 2, f"p{i}", "slow") for i in range(20)] * 2,
                              "surface string, run long, prompt string, note string")
    out = error_rows(m, f, ["chatgpt"])
    assert out.count() == 70 and out.select("surface", "run", "prompt").distinct().count() == 70
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and " OR " not in plan


def test_repeated_answers_and_verdicts_don_t_multiply(spark, rules):
    df = answers(spark, [("chatgpt", 1, "p", "license is one", [], None), ("chatgpt", 1, "p", "license is two", [], None)])
    m = manifest(spark, ["p"], ["chatgpt"], 1)
    v = spark.createDataFrame([("chatgpt\u001f1\u001fp", True, 1, True, s, False, None, [], 0.1, None, []) for s in ("A", "B")],
                              ANSWER_VERDICT).withColumn("seq", F.monotonically_increasing_id())
    rows = answer_snapshot(m, df, rules, ["chatgpt"], verdicts=v).collect()
    assert [r.says_about_brand for r in rows] == ["B", "B"]

    def scorer(batch):   # optional fields left out
        return pd.DataFrame({"key": batch["key"], "says_about_brand": batch["text"]})
    rows = answer_snapshot(m, df, rules, ["chatgpt"], scorer=scorer).collect()
    assert sorted(r.says_about_brand for r in rows) == ["license is one", "license is two"]
    assert {r.response_text for r in rows if r.says_about_brand == r.response_text} == {"license is one", "license is two"}


def test_scorer_output_is_made_safe(spark):
    from sourcelens.operators.verdicts import score_batches
    from sourcelens.schemas import WEB_VERDICT
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(("fine", "odd", "lost", "x" * 30000))], "key string, text string").coalesce(1)

    def odd(batch):
        kept = batch[batch["text"] != "lost"]
        return pd.DataFrame({"key": kept["key"], "sentiment": ["0.5", "not a number", float("nan")], "mentions_competition": [1, None, "true"],
                             "competitors_named": [["A", None], float("nan"), None], "says_about_brand": [3, None, "s"], "extra": 1})
    got = {r.key: r for r in score_batches(df, odd, WEB_VERDICT).collect()}
    assert [got[k].score_status for k in "0123"] == ["ok", "ok", "missing", "ok"]
    assert (got["0"].sentiment, got["1"].sentiment, got["0"].says_about_brand) == (0.5, None, "3")
    assert got["0"].mentions_competition is True and got["3"].mentions_competition is True and got["0"].competitors_named == ["A"]
    calls = score_batches(df, lambda b: 1 / 0, WEB_VERDICT).collect()
    assert {r.score_status for r in calls} == {"failed"} and "ZeroDivisionError" in calls[0].score_error
    whole = score_batches(df, lambda b: pd.DataFrame({"key": b["key"], "says_about_brand": b["text"].str.len()}), WEB_VERDICT)
    assert "30000" in {r.says_about_brand for r in whole.collect()}


def test_an_answer_without_a_known_surface_is_an_error_row(spark, rules):
    df = answers(spark, [(None, None, "p", "text", [], None), ("elsewhere", 1, "p", "text", [], None)])
    rows = answer_snapshot(manifest(spark, ["p"], ["chatgpt"], 1), df, rules, ["chatgpt"]).collect()
    assert [r.status for r in rows] == ["error", "error"] and {r.error_note for r in rows} == {"answer of an unknown surface"}


def test_the_last_entry_of_a_repeated_prompt_gives_its_intent(spark, rules):
    prompts = spark.createDataFrame([("p", "old", "t1", 1), ("p", "new", "t2", 2)], "prompt string, intent string, topic_id string, seq long")
    m = request_manifest(prompts.drop("seq"), ["chatgpt"], 1)
    rows = answer_snapshot(m, answers(spark, [("chatgpt", 1, "p", "text", [], None)]), rules, ["chatgpt"], prompts=prompts).collect()
    assert [(r.intent, r.topic_id) for r in rows] == [("new", "t2")]


def test_all_sources_are_cited(spark, rules):
    text = " ".join(f"https://s{i}.test" for i in range(20))
    r = classify_answers(answers(spark, [("chatgpt", 1, "p", text, ["https://c.test"], None)]), None, rules).first()
    assert len(r.sources_cited) == 21
