"""Answer track: classify answers into sheet rows (E3) and the composed snapshot."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcelens.operators.answers import error_rows, merged_sources, status
from sourcelens.functions.urls import any_nonprod
from sourcelens.operators.catalog import tag_topics
from sourcelens.operators.verdicts import (answer_fallback, merge_verdicts, persist_scores, score_batches,
                                           with_text_labels)
from sourcelens.operators.dedupe import last_by_key
from sourcelens.rules import BrandRules
from sourcelens.schemas import ANSWER_VERDICT, LLM_SCHEMA
from sourcelens.sources.ledger import score_with_ledger, scorer_name
from sourcelens.sources.sinks import conform

EMPTY_NOTE = "returned no answer text"
NO_SURFACE_NOTE = "answer of an unknown surface"
_SEP = "\u001f"


def answer_key(surface="surface", run="run", prompt="prompt") -> Column:
    """Verdict key of a request: (surface, run, prompt)."""
    return F.concat_ws(_SEP, F.col(surface), F.col(run).cast("string"), F.col(prompt))


def scored_key(response="response") -> Column:
    """Verdict key of one answer: two different answers to the same request are judged apart."""
    return F.concat_ws(_SEP, answer_key(), F.sha2(F.col(response), 256))


def classify_answers(answers: DataFrame, verdicts: DataFrame | None, rules: BrandRules, key: Column | None = None) -> DataFrame:
    """One sheet row per answer.  Blank answers are ``empty`` and never judged; a failed
    call (``error`` set) is ``error``; ``ok`` answers take the model verdict by key or the
    whole fallback, and cite verdict sources ++ citations ++ inline URLs (canonical,
    ordered distinct).  Lists stay arrays: the sink joins them to text."""
    for c, v in (("intent", "unknown"), ("topic_id", ""), ("error", None)):
        if c not in answers.columns:
            answers = answers.withColumn(c, F.lit(v).cast("string"))
    if "citations" not in answers.columns:
        answers = answers.withColumn("citations", F.array().cast("array<string>"))
    df = answers.withColumn("status", status("response", "error")).withColumn("key", answer_key() if key is None else key)
    df = with_text_labels(df, rules, "response")
    ok = F.col("status") == "ok"
    df = merge_verdicts(df, verdicts, "key", answer_fallback("response", rules), use_verdict=ok)
    df = df.withColumn("_src", merged_sources(F.col("sources_cited"), F.col("citations"), F.col("response")))

    def okv(c: Column, blank) -> Column:
        return F.when(ok, c).otherwise(blank)

    none = F.array().cast("array<string>")
    null_b, null_d, null_s = F.lit(None).cast("boolean"), F.lit(None).cast("double"), F.lit(None).cast("string")
    note = F.when(F.col("status") == "error", F.coalesce(F.col("error"), F.lit(""))) \
        .when(F.col("status") == "empty", F.lit(EMPTY_NOTE)).otherwise(F.lit(""))
    return df.select(
        "surface", F.col("run").cast("bigint").alias("run"), "prompt",
        F.coalesce(F.col("intent"), F.lit("unknown")).alias("intent"),
        F.coalesce(F.col("topic_id"), F.lit("")).alias("topic_id"),
        okv(F.coalesce(F.col("mentioned"), F.lit(False)), null_b).alias("mentioned"),
        okv(F.col("rank").cast("bigint"), F.lit(None).cast("bigint")).alias("rank"),
        okv(F.coalesce(F.col("recommended"), F.lit(False)), null_b).alias("recommended"),
        okv(F.coalesce(F.col("says_about_brand"), F.lit("")), F.lit("")).alias("says_about_brand"),
        okv(F.coalesce(F.col("mentions_competition"), F.lit(False)), null_b).alias("mentions_competition"),
        okv(F.coalesce(F.col("competition_summary"), F.lit("")), F.lit("")).alias("competition_summary"),
        okv(F.coalesce(F.col("competitors_named"), none), none).alias("competitors_named"),
        okv(F.coalesce(F.col("sentiment"), F.lit(0.0)), null_d).alias("sentiment"),
        okv(F.col("price_mentioned"), null_s).alias("price"),
        okv(F.col("_src"), none).alias("sources_cited"),
        okv(any_nonprod(F.col("_src"), rules), F.lit(False)).alias("nonprod_url"),
        okv(F.col("response"), F.lit("")).alias("response_text"),
        "status", note.alias("error_note"),
        okv(F.col("stale"), null_b).alias("stale"), "verdict_source", *(["seq"] if "seq" in answers.columns else []))


def answer_snapshot(manifest: DataFrame, answers: DataFrame, rules: BrandRules, known_surfaces,
                    failures: DataFrame | None = None, verdicts: DataFrame | None = None,
                    scorer: Callable | None = None, include_missing: bool = False, prompts: DataFrame | None = None,
                    ledger: str | None = None, scorer_id: str | None = None) -> DataFrame:
    """Manifest (J9) + landed answers (S8/S9) + failed calls (J10) -> 19-column rows.

    ``answers``: surface, run, prompt, response, citations, error.  An answer with
    ``error`` set fails its prompt; ``failures`` rows (surface, run, prompt|null, note) fail
    a prompt or a whole (surface, run) call; unknown surfaces fail everywhere, and a landed answer without a
    known surface is an error row.  Intent and topic come from ``prompts`` (prompt, intent, topic_id, and ``seq``: the last
    entry of a repeated prompt wins), or else from the manifest; unmatched -> unknown.
    With a ``ledger`` folder the ``scorer`` is asked once for equal (response, surface, prompt), over all runs.
    With ``include_missing``, manifest requests with no answer get a ``missing`` row.
    """
    known = list(known_surfaces)
    on_known = F.coalesce(F.col("surface").isin(*known), F.lit(False))
    if "error" not in answers.columns:
        answers = answers.withColumn("error", F.lit(None).cast("string"))
    answers = answers.withColumn("error", F.coalesce("error", F.when(~on_known, F.lit(NO_SURFACE_NOTE))))
    ans = answers.where(on_known)
    cat = prompts if prompts is not None else manifest.select("prompt", "intent", "topic_id")
    order = F.col("seq") if "seq" in cat.columns else F.to_json(F.struct("intent", "topic_id"))
    prompt_cat = last_by_key(cat.withColumn("_order", order), "prompt", "_order").select(
        F.col("prompt").alias("query"), "intent", F.col("topic_id").alias("id"), F.lit(0).alias("seq"))
    # one pass over the answers: ok, empty and per-answer error rows are all classified here;
    # only whole-call failures (prompt null) need the manifest expansion below
    tagged = tag_topics(answers, prompt_cat, "prompt")
    key = None
    if scorer is not None and verdicts is None:
        to_score = tagged.withColumn("status", status("response", "error")).where(F.col("status") == "ok")
        key = scored_key()
        to_score, hints = to_score.withColumn("key", key), ("surface", "prompt")
        verdicts = (persist_scores(score_batches(to_score, scorer, ANSWER_VERDICT, "key", "response", hints)) if ledger is None else
                    score_with_ledger(to_score, scorer, ledger, ANSWER_VERDICT, scorer_id or scorer_name(scorer), "key", "response", hints))
    rows = classify_answers(tagged, verdicts, rules, key)
    errs = error_rows(manifest, failures.select("surface", "run", "prompt", "note") if failures is not None
                      else None, known)
    parts = [rows, errs]
    if include_missing:
        got = ans.select("surface", "run", "prompt").distinct()
        miss = (manifest.where(F.col("surface").isin(*known))
                        .join(got, ["surface", "run", "prompt"], "left_anti")
                        .join(errs.select("surface", "run", "prompt"), ["surface", "run", "prompt"], "left_anti")
                        .withColumn("status", F.lit("missing")).withColumn("error_note", F.lit("")))
        parts.append(miss)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    none = F.array().cast("array<string>")
    blanks = {"says_about_brand": F.lit(""), "competition_summary": F.lit(""), "response_text": F.lit(""),
              "competitors_named": none, "sources_cited": none, "nonprod_url": F.lit(False)}
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in blanks.items()})


def answer_sheet(df: DataFrame) -> DataFrame:
    """The 19 columns as written: lists joined to text."""
    return conform(df, LLM_SCHEMA)
