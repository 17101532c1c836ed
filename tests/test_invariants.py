
from pyspark.sql import functions as F

import __spark_entry__ as E
from sourcelens.functions.urls import canonical_url
from sourcelens.operators.catalog import request_manifest
from sourcelens.operators.fetch import plan_fetch
from sourcelens.plans import testbed as tb
from sourcelens.plans.answers import answer_snapshot

SF = "/root/testdata/sf0.1"


def test_keep_best_has_unique_urls(spark):
    df = E.q_dedupe_best(spark, SF)
    assert df.count() == df.select("url").distinct().count()
    sheet = E.q_web_snapshot(spark, SF)
    assert sheet.count() == sheet.select("url").distinct().count()


def test_hits_and_misses_partition_the_requests(spark):
    req = tb.table(spark, SF, "pages").select(canonical_url("url").alias("url")).distinct()
    plan = plan_fetch(req, tb.page_cache(spark, SF), tb.AS_OF, seq="seq")
    hits, misses = plan.hits.select("url"), plan.misses.select("url")
    crawlable = req.where(F.col("url").startswith("http"))
    assert hits.count() + misses.count() == crawlable.count()
    assert hits.join(misses, "url").count() == 0


def test_every_request_gets_a_row(spark):
    prompts = tb.conversation_prompts(spark, SF)
    manifest = request_manifest(prompts, tb.SURFACES, 2)
    snap = answer_snapshot(manifest, tb.conversation_answers(spark, SF), tb.rules(), tb.KNOWN_SURFACES,
                           include_missing=True)
    keys = ["surface", "run", "prompt"]
    assert manifest.select(*keys).join(snap.select(*keys).distinct(), keys, "left_anti").count() == 0
    assert snap.where(F.col("status") == "missing").count() > 0
    statuses = {r.status for r in snap.select("status").distinct().collect()}
    assert statuses <= {"ok", "empty", "error", "missing"}
