"""The two end-to-end jobs: web refresh (E2 + sinks) and answer visibility (E4 + sinks).

Both take a configuration in the same shape as the reference's (topic catalog, claim
patterns, domains, brands, surfaces, runs; plus ``brand``) and landing folders written by
the scrapers, and write one self-contained run: the sheet as a ``run_id`` partition, a
``run_meta`` row, and for the web track the crawl list and the next cache version.
Selections and ad-hoc prompts are rows, not command-line strings.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from pathlib import Path
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.operators.catalog import add_adhoc, request_manifest, require_matched, select_catalog, topics_frame
from sourcelens.plans.answers import answer_snapshot
from sourcelens.plans.reports import nonprod_cited, nonprod_report
from sourcelens.plans.web import web_snapshot
from sourcelens.rules import BrandRules
from sourcelens.schemas import AD_ITEM, ANSWER_API_ITEM, ANSWER_ITEM, CONTENT_ITEM, DISCOVERY, FORUM_ITEM, LANDING, SERP_ITEM
from sourcelens.sources import readers
from sourcelens.session import checkpoint_dir, cut_lineage
from sourcelens.sources.cache import append_cache, evict_cache, read_cache
from sourcelens.sources.sinks import new_run_id, write_answers, write_snapshot, write_web

WEB_SOURCES = ["serp", "news", "ads", "reddit"]
DEFAULT_RUNS = 5


def load_config(path: str | Path) -> dict:
    return json.loads(Path(path).read_text())


def rules_from_config(config: dict, brand: str | None = None) -> BrandRules:
    d = dict(config)
    d["brand"] = brand or config.get("brand")
    if not d["brand"]:
        raise ValueError("the configuration names no brand")
    return BrandRules.from_dict(d)


def _catalog(spark: SparkSession, config: dict) -> DataFrame:
    """The topic catalog with its 1-based position (topics without a query are dropped)."""
    topics = [t for t in config.get("topics", []) if t.get("query")]
    return topics_frame(spark, topics).withColumn("pos", F.col("seq") + 1)


def select_topics(spark: SparkSession, config: dict, selectors: list[str] | None) -> DataFrame:
    """J12 over the catalog: ``None`` or ``['all']`` selects every topic; a token that selects none is an error."""
    catalog = _catalog(spark, config)
    require_matched(catalog, selectors, label="query", pos="pos")
    return select_catalog(catalog, selectors, label="query", pos="pos")


@dataclass
class WebRun:
    run_id: str
    written: bool
    sheet: DataFrame
    crawl_list: DataFrame


def _reports(sources: list[readers.Source]) -> dict[str, str]:
    return {k: v for s in sources for k, v in s.report().items()}


def _score_counts(scores: DataFrame | None) -> dict[str, str]:
    if scores is None:
        return {}
    return {f"scores.{r['score_status']}": str(r["count"]) for r in scores.groupBy("score_status").count().collect()}


def web_refresh(spark: SparkSession, config: dict, landing: str, out: str, cache: str, *,
                sources: list[str] | None = None, queries: list[str] | None = None, as_of: str | None = None,
                scorer: Callable | None = None, brand: str | None = None, note: str = "", run_id: str | None = None,
                ledger: str | None = None, scorer_id: str | None = None) -> WebRun:
    """Web track: landed search / news / ads / forum items -> snapshot sheet, alert, crawl list, cache.

    ``landing`` holds one folder per source (``serp``, ``news``, ``ads``, ``reddit``), ``pages`` (the landed crawl) and
    optionally ``verdicts_web`` (model verdicts by canonical URL; else ``scorer``, else the rule fallback).  A missing
    folder is a failed source: it contributes nothing, and ``run_meta`` says so, as it says how many lines were unreadable.
    Written: the sheet (``web``, and in discovery order as CSV, ``web_csv``), every non-production URL (``nonprod_web``),
    ``crawl_list``, ``run_meta``, and the crawled pages in the cache, whose days past twice the time to live are removed.  The scorer's verdicts go to a ``ledger`` (``scores_web``
    unless given) as they come, so a failed run started again asks only for what is left.  Landed lines are parsed once, into
    ``staged``; those that can't be read are kept whole, with place and reason, in ``quarantine_web``.
    """
    rules = rules_from_config(config, brand)
    sources = sources or list(WEB_SOURCES)
    as_of = as_of or dt.date.today().isoformat()
    chosen = select_topics(spark, config, queries)
    topics = chosen.select("id", "intent", "query", "seq")
    rid = run_id or new_run_id()
    read = {"serp": (SERP_ITEM, lambda i: readers.serp_records(i, topics, "web", True, broadcast_topics=True)),
            "news": (SERP_ITEM, lambda i: readers.serp_records(i, topics, "news", False, broadcast_topics=True)),
            "ads": (AD_ITEM, lambda i: readers.ad_records(i, rules)), "reddit": (FORUM_ITEM, readers.forum_records),
            "pages": (CONTENT_ITEM, readers.page_bodies)}
    staged = f"{out}/staged/run_id={rid}"
    *found, pages = [readers.staged_source(n, spark, f"{landing}/{n}", read[n][0], f"{staged}/{n}", read[n][1])
                     for n in [*(n for n in WEB_SOURCES if n in sources), "pages"]]
    judged = readers.try_source("verdicts_web", lambda s, p, observe: readers.read_verdicts(s, p, "web", rules.brand, observe),
                                spark, f"{landing}/verdicts_web")
    parts = [s.rows for s in found if s.rows is not None]
    recs = readers.union_discovery(*parts) if parts else spark.createDataFrame([], DISCOVERY)
    snap = web_snapshot(recs, read_cache(spark, cache, as_of), pages.rows, rules, as_of, verdicts=judged.rows, scorer=scorer,
                        checkpoint=checkpoint_dir(spark) is not None, cache_seq="seq", ledger=ledger or f"{out}/scores_web", scorer_id=scorer_id)
    meta = {"as_of": as_of, "sources": ",".join(sources), "queries": ",".join(queries or ["all"]), "note": note}
    written = write_snapshot(snap.sheet, out, "web", rid, meta, guard=recs,
                             after=lambda: _reports([*found, pages, judged]) | _score_counts(snap.scores))
    readers.write_quarantine([*found, pages], f"{out}/quarantine_web/run_id={rid}")
    if written:
        stored = spark.read.parquet(f"{out}/web").where(F.col("run_id") == rid)
        write_web(snap.sheet, f"{out}/web_csv/run_id={rid}", mode="overwrite")
        nonprod_report(stored).write.mode("overwrite").parquet(f"{out}/nonprod_web/run_id={rid}")
        snap.crawl_list.write.mode("overwrite").parquet(f"{out}/crawl_list/run_id={rid}")
        if snap.crawled is not None:
            append_cache(snap.crawled, cache, as_of)
            evict_cache(spark, cache, as_of)
    return WebRun(rid, written, snap.sheet, snap.crawl_list)


@dataclass
class AnswerRun:
    run_id: str
    written: bool
    sheet: DataFrame


def answer_visibility(spark: SparkSession, config: dict, landing: str, out: str, *,
                      surfaces: list[str] | None = None, prompts: list[str] | None = None,
                      extra_prompts: list[tuple[str, str]] | None = None, num_runs: int | None = None,
                      scorer: Callable | None = None, brand: str | None = None, note: str = "", run_id: str | None = None,
                      ledger: str | None = None, scorer_id: str | None = None) -> AnswerRun:
    """Answer track: manifest (selected topics + ad-hoc prompts) x surfaces x runs, landed answers (``answers`` folder:
    assistant items, raw ones under ``surface=.../run=...``; ``answer_api``: API payloads; ``failures``: failed calls;
    optionally ``verdicts_answers``: model verdicts) -> the 19-column sheet (``answers``; sorted, as CSV: ``answers_csv``),
    the cited non-production URLs (``nonprod_answers``) and ``run_meta``."""
    rules = rules_from_config(config, brand)
    known = list(config.get("llm_surfaces", ["chatgpt", "perplexity"]))
    surfaces = surfaces or known
    runs = num_runs or config.get("llm_num_runs", DEFAULT_RUNS)
    chosen = select_topics(spark, config, prompts).select(F.col("query").alias("prompt"), "intent",
                                                           F.col("id").alias("topic_id"), F.col("seq"))
    if extra_prompts:
        extra = spark.createDataFrame([(t, i, n) for n, (t, i) in enumerate(extra_prompts)],
                                      "text string, intent string, ord bigint")
        chosen = chosen.unionByName(add_adhoc(chosen, extra).withColumnRenamed("ord", "seq"))
    manifest = request_manifest(chosen.drop("seq"), surfaces, runs)
    rid = run_id or new_run_id()
    landed = [readers.staged_source(n, spark, f"{landing}/{n}", kind, f"{out}/staged/run_id={rid}/{n}", make)
              for n, kind, make in (("answers", ANSWER_ITEM, readers.answer_items), ("answer_api", ANSWER_API_ITEM, readers.answer_api_items))]
    parts = [s.rows for s in landed if s.rows is not None]
    answers = spark.createDataFrame([], "surface string, run bigint, prompt string, response string, citations array<string>, "
                                        f"error string, seq {LANDING.simpleString()}")
    for p in parts:
        answers = answers.unionByName(p)
    failed = readers.try_source("failures", readers.read_failures, spark, f"{landing}/failures")
    judged = readers.try_source("verdicts_answers", lambda s, p, observe: readers.read_verdicts(s, p, "answer", rules.brand, observe),
                                spark, f"{landing}/verdicts_answers")
    snap = answer_snapshot(manifest, answers, rules, known, failures=failed.rows, verdicts=judged.rows, scorer=scorer, prompts=chosen,
                           ledger=ledger or f"{out}/scores_answers", scorer_id=scorer_id)
    if checkpoint_dir(spark) is not None:  # once, for the guard, the sheet, the CSV and the alert
        snap = cut_lineage(snap)
    meta = {"num_runs": runs, "surfaces": ",".join(surfaces), "prompts": ",".join(prompts or ["all"]), "note": note}
    written = write_snapshot(snap, out, "answers", rid, meta, after=lambda: _reports([*landed, failed, judged]))
    readers.write_quarantine(landed, f"{out}/quarantine_answers/run_id={rid}")
    if written:
        write_answers(snap, f"{out}/answers_csv/run_id={rid}", mode="overwrite")
        nonprod_cited(snap, rules).write.mode("overwrite").parquet(f"{out}/nonprod_answers/run_id={rid}")
    return AnswerRun(rid, written, snap)
