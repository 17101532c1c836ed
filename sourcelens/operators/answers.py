"""Answer rows: status routing (P5), failed-call expansion (J10), cited sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcelens.functions.text import cap
from sourcelens.functions.urls import any_nonprod, canonical_url, strip_ws, url_mentions
from sourcelens.rules import BrandRules


def status(response, error) -> Column:
    """P5: failed call -> ``error``; blank (whitespace-only) answer -> ``empty``; else ``ok``."""
    r = F.coalesce(F.col(response) if isinstance(response, str) else response, F.lit(""))
    e = F.col(error) if isinstance(error, str) else error
    return (F.when(e.isNotNull(), F.lit("error"))
             .when(strip_ws(r) == "", F.lit("empty"))
             .otherwise(F.lit("ok")))


def with_status(df: DataFrame, response: str = "response", error: str = "error") -> DataFrame:
    return df.withColumn("status", status(response, error))


def merged_sources(verdict_sources, extra_sources, text, n: int | None = None) -> Column:
    """U4: verdict sources ++ extra citations ++ URLs in the text, in that order; only
    http(s) values, canonicalised, ordered distinct; all of them unless ``n`` is given."""
    def arr(c):
        c = F.col(c) if isinstance(c, str) else c
        return F.coalesce(c, F.array().cast("array<string>"))
    allv = F.concat(arr(verdict_sources), arr(extra_sources), url_mentions(text))
    http = F.filter(allv, lambda s: s.isNotNull() & s.startswith("http"))
    sources = F.array_distinct(F.transform(http, canonical_url))
    return sources if n is None else F.slice(sources, 1, n)


def with_sources(df: DataFrame, rules: BrandRules, verdict_sources: str, extra_sources: str, text: str,
                 out: str = "sources") -> DataFrame:
    return (df.withColumn(out, merged_sources(verdict_sources, extra_sources, F.col(text)))
              .withColumn("nonprod_url", any_nonprod(F.col(out), rules)))


def error_rows(manifest: DataFrame, failures: DataFrame | None, known_surfaces, note_cap: int | None = None) -> DataFrame:
    """One error row per manifest prompt of every failed (surface, run).

    ``failures`` rows are (surface, run, prompt, note); a null prompt fails the whole (surface, run) call, a set
    prompt fails only that prompt (of several notes the greatest counts; a whole call's note comes first).
    Surfaces outside ``known_surfaces`` fail for every run and prompt.

    Two equi-joins: whole calls are a distinct (surface, run) set, a row per call; single prompts join on
    (surface, run, prompt).  Neither compares a prompt with another prompt's failure."""
    m = manifest.select("surface", "run", "prompt", "intent", "topic_id")
    known = F.col("surface").isin(*known_surfaces) if known_surfaces else F.lit(False)
    unknown_note = F.when(~known, F.concat(F.lit("unknown surface '"), F.col("surface"), F.lit("'")))
    if failures is None:
        out = m.withColumn("error_note", unknown_note).where(F.col("error_note").isNotNull())
    else:
        note = F.max(F.coalesce("note", F.lit("")))
        calls = failures.where(F.col("prompt").isNull()).groupBy("surface", "run").agg(note.alias("_call"))
        prompts = failures.where(F.col("prompt").isNotNull()).groupBy("surface", "run", "prompt").agg(note.alias("_one"))
        j = m.join(calls, ["surface", "run"], "left").join(prompts, ["surface", "run", "prompt"], "left")
        out = (j.withColumn("error_note", F.coalesce(unknown_note, F.col("_call"), F.col("_one")))
                .where(F.col("error_note").isNotNull()).drop("_call", "_one"))
    return (out.withColumn("error_note", cap(F.col("error_note"), note_cap)).withColumn("status", F.lit("error"))
               .select("surface", "run", "prompt", "intent", "topic_id", "error_note", "status"))
