"""Physical plan checks: native expressions only (no Python outside V1), pushdown, top-k shapes."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_outside_scorer(spark):
    for name, fn in E._own_queries().items():
        p = plan(fn(spark, SF))
        if name == "scored_verdicts":
            assert "MapInPandas" in p or "PythonMapInArrow" in p or "MapInArrow" in p
        else:
            assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p, name


def test_dedupe_cuts_rows_before_shuffle(spark):
    p = plan(E.q_dedupe_best(spark, SF))
    assert "WindowGroupLimit" in p


def test_scan_prunes_columns(spark):
    from sourcelens.plans.testbed import table
    df = table(spark, SF, "documents").select("doc_id", "text")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_cache_ttl_filter_pushed_to_scan(spark, tmp_path):
    from sourcelens.sources.cache import append_cache, cache_fresh, read_cache
    base = str(tmp_path / "c")
    append_cache(spark.createDataFrame([("https://a.test", "t")], "url string, text string"), base, "2024-01-19")
    p = cache_fresh(read_cache(spark, base), "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "fetch_date" in p


def test_report_top_k_is_distributed(spark):
    from sourcelens.operators.ownership import with_nonprod
    from sourcelens.plans.reports import nonprod_report
    df = with_nonprod(E._pages_parts(spark, SF), E.R).select(F.col("canon_url").alias("url"), "nonprod_url")
    assert "TakeOrderedAndProject" in plan(nonprod_report(df, top=5))
    assert nonprod_report(df).count() == E.q_nonprod_report(spark, SF).count() > 5


def test_web_snapshot_sorts_no_whole_records_to_aggregate(spark):
    assert "SortAggregate" not in plan(E._web(spark, SF).sheet)


def test_roll_ups_scan_the_answers_once(spark):
    for df in (E.q_citation_rollup(spark, SF), E.q_competitor_share(spark, SF)):
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
        final = p.split("== Initial Plan ==")[0]
        assert "ReusedExchange" in final or final.count("conversations.parquet") <= 4, final[:3000]


def test_dedupe_with_a_hot_url(spark):
    """A third of all rows on one URL: the result is still one best row per URL."""
    from pyspark.sql import functions as F
    from sourcelens.operators.dedupe import dedupe_best
    n = 30000
    df = (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("https://hot.test")).otherwise(
            F.concat(F.lit("https://u"), F.col("id").cast("string"), F.lit(".test"))).alias("url"),
        ((F.col("id") * 7919) % 50 + 1).alias("rank"), F.lit(0).alias("source_ord"), F.col("id").alias("seq")))
    out = dedupe_best(df, "url")
    assert out.count() == n - n // 3 + 1
    hot = out.where(F.col("url") == "https://hot.test").first()
    best_rank = df.where(F.col("url") == "https://hot.test").agg(F.min("rank")).first()[0]
    first_seq = (df.where((F.col("url") == "https://hot.test") & (F.col("rank") == best_rank))
                   .agg(F.min("seq")).first()[0])
    assert (hot.rank, hot.seq) == (best_rank, first_seq)


def test_citation_share_with_a_hot_host(spark):
    """One host holds a third of all citations: shares still sum to one, and the
    aggregation is partial (HashAggregate before the shuffle)."""
    from pyspark.sql import functions as F
    from sourcelens.plans.reports import citation_rollup
    df = spark.range(9000).select(
        F.lit("ok").alias("status"),
        F.when(F.col("id") % 3 == 0, F.lit("https://hot.test/a")).otherwise(
            F.concat(F.lit("https://h"), (F.col("id") % 100).cast("string"), F.lit(".test/x"))).alias("s")).select("status", F.array("s").alias("sources_cited"))
    out = citation_rollup(df)
    rows = {r.host: r.citations for r in out.collect()}
    assert rows["hot.test"] == 3000 and sum(rows.values()) == 9000
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in p


def shuffles_above(p, *scan):
    """How many exchanges stand above the scan whose line holds all of ``scan``."""
    lines = [(re.search(r"[A-Za-z*]", x).start(), x) for x in p.split("\n") if re.search(r"[A-Za-z*]", x)]
    at = next(i for i, (_, x) in enumerate(lines) if all(s in x for s in scan))
    depth, n = lines[at][0], 0
    for d, x in reversed(lines[:at]):
        if d < depth:
            depth, n = d, n + (" Exchange " in x.replace("- Exchange", " Exchange "))
    return n


def test_landed_lines_shuffle_texts_once(spark):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (E.q_serp_records(spark, SF), E.q_news_records(spark, SF), E.tb.ad_lines(spark, SF)):
            assert shuffles_above(plan(df), "documents.parquet", "text:string") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_lines_land_again_as_they_are(spark):
    lines = spark.createDataFrame([('{"a": "é\\u2028"}',), ("",), ("x y ",)], "line string")
    one = E.tb.land(lines, "one")
    two = E.tb.land(E.tb.landed(spark, one), "two")
    want = sorted(r.line for r in lines.collect())
    assert sorted(r.line for r in E.tb.landed(spark, one).collect()) == sorted(r.line for r in E.tb.landed(spark, two).collect()) == want
