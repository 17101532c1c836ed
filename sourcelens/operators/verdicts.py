"""Verdicts: rule-based fallbacks (F9, F10), merge with model verdicts (J5, F11) and the
pluggable scorer (V1).

A verdict table is keyed (``key``) and carries the fields of ``schemas.WEB_VERDICT`` or
``schemas.ANSWER_VERDICT``.  The merge is a left equi-join on the key; a row without a
verdict (the scorer failed, or there was no body) takes the *whole* fallback verdict,
never a field-wise mix.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcelens.functions.text import (any_claim, brands_in, cap, claim_flags, lowered, mentions_brand,
                                       names_summary, narrative, prices_seen)
from sourcelens.functions.urls import url_mentions
from sourcelens.operators.dedupe import last_by_key
from sourcelens.rules import BrandRules
from sourcelens.schemas import ANSWER_VERDICT, WEB_VERDICT


def with_text_labels(df: DataFrame, rules: BrandRules, text: str = "text") -> DataFrame:
    """P3, P4, F6, F8 on one text column: claim flags, ``stale``, ``prices_seen``, ``comps``
    and ``brand_named``.  The lower-cased text is computed once per row, as a column that
    every label reads (and dropped at the end)."""
    out = df.withColumn("_lt", lowered(F.col(text)))
    lt = F.col("_lt")
    labels = dict(claim_flags(F.col(text), rules, lower_text=lt))
    labels["prices_seen"] = prices_seen(F.col(text), rules)
    labels["comps"] = brands_in(F.col(text), list(rules.competitor_brands), rules.word_boundary, lower_text=lt)
    labels["brand_named"] = mentions_brand(F.col(text), rules, lower_text=lt)
    return (out.withColumns(labels)
               .withColumn("stale", any_claim(rules.stale_claim_names))
               .drop("_lt"))


def web_fallback(text: str, rules: BrandRules) -> dict:
    """F9 as column expressions over a frame that already has ``with_text_labels``."""
    return {
        "says_about_brand": narrative(F.col("stale"), F.col("brand_named"), rules, rules.stale_note_web),
        "mentions_competition": F.size("comps") > 0,
        "competition_summary": names_summary(F.col("comps")),
        "competitors_named": F.col("comps"),
        "sentiment": F.lit(0.0),
        "price_mentioned": F.get(F.col("prices_seen"), 0),
    }


def answer_fallback(text: str, rules: BrandRules) -> dict:
    """F10 as column expressions over a frame that already has ``with_text_labels``."""
    return {
        "mentioned": F.col("brand_named"),
        "rank": F.lit(None).cast("bigint"),
        "recommended": F.lit(False),
        "says_about_brand": narrative(F.col("stale"), F.col("brand_named"), rules, rules.stale_note_answer),
        "mentions_competition": F.size("comps") > 0,
        "competition_summary": names_summary(F.col("comps")),
        "competitors_named": F.col("comps"),
        "sentiment": F.lit(0.0),
        "price_mentioned": F.lit(None).cast("string"),
        "sources_cited": url_mentions(F.col(text)),
    }


def merge_verdicts(df: DataFrame, verdicts: DataFrame | None, key: str, fallback: dict,
                   use_verdict=None, prefix: str = "v_") -> DataFrame:
    """Left join on ``key``; where a verdict row exists (and ``use_verdict`` holds) every
    field comes from it, otherwise every field comes from ``fallback``.  Of several verdicts for a key the last
    counts (by ``seq`` if the table has it, else the greatest row, so that a re-run picks the same), and those with
    a ``score_status`` other than ``ok`` don't count."""
    fields = list(fallback)
    if verdicts is None:
        has = F.lit(False)
        joined = df
    else:
        if "score_status" in verdicts.columns:
            verdicts = verdicts.where(F.col("score_status") == "ok")
        order = F.col("seq") if "seq" in verdicts.columns else F.to_json(F.struct(*verdicts.columns))
        verdicts = last_by_key(verdicts.withColumn("_order", order), "key", "_order")
        v = verdicts.select(F.col("key").alias("_vkey"), F.lit(True).alias("_has_v"),
                            *[F.col(f).alias(prefix + f) for f in fields if f in verdicts.columns])
        joined = df.join(v, df[key] == v["_vkey"], "left").drop("_vkey")
        has = F.coalesce(F.col("_has_v"), F.lit(False))
    if use_verdict is not None:
        has = has & use_verdict
    merged = {"verdict_source": F.when(has, F.lit("model")).otherwise(F.lit("fallback"))}
    for f, fb in fallback.items():
        vcol = F.col(prefix + f) if verdicts is not None and f in verdicts.columns else F.lit(None)
        merged[f] = F.when(has, vcol.cast(fb_type(f))).otherwise(fb)
    out = joined.withColumns(merged)   # one projection: no fallback reads a field it replaces
    drops = [c for c in out.columns if c.startswith(prefix)] + (["_has_v"] if verdicts is not None else [])
    return out.drop(*drops)


_TYPES = {f.name: f.dataType for f in list(WEB_VERDICT.fields) + list(ANSWER_VERDICT.fields)}


def fb_type(field: str) -> T.DataType:
    return _TYPES.get(field, T.StringType())


# ---------------------------------------------------------------------------
# V1: pluggable scorer
# ---------------------------------------------------------------------------
def _ship_by_value(fn) -> None:
    """A scorer defined in a script, notebook or entry file is not importable on the Python
    workers; have cloudpickle send its module's code by value (installed packages stay
    by reference)."""
    import sys
    from pyspark import cloudpickle
    mod = sys.modules.get(getattr(fn, "__module__", None) or "")
    if mod is None or mod.__name__ in ("__main__", "builtins"):
        return
    path = getattr(mod, "__file__", "") or ""
    if "site-packages" in path or "dist-packages" in path:
        return
    try:
        cloudpickle.register_pickle_by_value(mod)
    except (ValueError, TypeError):
        pass


def _utf8(value) -> str:
    """As text that Arrow can hold: a lone surrogate becomes a question mark."""
    return str(value).encode("utf-8", "replace").decode()


def _plain(value, kind: T.DataType):
    """A scorer's value as the declared type, or None: missing values are NaN in pandas, numbers may be text."""
    if isinstance(kind, T.ArrayType):
        if value is None or isinstance(value, (str, float)):
            return None
        if isinstance(value, (bool, int, dict)):
            raise TypeError(f"{value!r} is no list")
        return [_utf8(x) for x in value if x is not None]
    if value is None or value is pd.NaT or isinstance(value, float) and value != value:
        return None
    if isinstance(kind, T.StringType):
        return _utf8(value)
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else str(value).strip().lower() in ("true", "1", "1.0", "yes")
    try:
        if isinstance(kind, T.LongType):
            whole = int(float(value))
            return whole if -(1 << 63) <= whole < 1 << 63 else None
        return float(value)
    except (TypeError, ValueError, OverflowError):
        return None


def score_batches(df: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType = WEB_VERDICT,
                  key: str = "key", text: str = "text", hints: tuple[str, ...] = (),
                  text_cap: int | None = None, parallelism: int | None = None) -> DataFrame:
    """V1: run a caller-supplied scorer over Arrow batches (``mapInPandas``).

    ``scorer(batch)`` gets a pandas frame with ``key``, ``text`` (whole unless ``text_cap`` is given) and the ``hints``
    columns, and returns verdict rows with ``key`` and any of the fields of ``schema``; a column ``error`` may name what
    failed for a row.  Every input row gives one output row (per returned verdict) with ``score_status``: ``ok``, ``failed``
    (the row's error, or the exception of the whole call) or ``missing`` (no verdict came back), and ``score_error``.  A
    failed call is not repeated: the scorer is a paid model, and rows it did score must not be paid twice.  Fields that are
    missing or of the wrong type are null.  ``parallelism`` repartitions the projected input to that many tasks, e.g.
    to match a model's rate limit.
    """
    _ship_by_value(scorer)
    cols = [F.col(key).cast("string").alias("key"), cap(F.col(text), text_cap).alias("text")] + \
           [F.col(h) for h in hints]
    fields = [(f.name, f.dataType) for f in schema.fields if f.name != "key"]
    names = ["key", *[n for n, _ in fields], "score_status", "score_error"]

    def rows(batch: pd.DataFrame) -> list[tuple]:
        blank = [None] * len(fields)
        try:
            got = scorer(batch)
            records = [] if got is None else got.to_dict("records")
        except Exception as e:  # a model call may fail in any way; every row says so
            return [(k, *blank, "failed", f"{type(e).__name__}: {e}") for k in batch["key"]]
        out, seen = [], set()
        for r in records:
            k = None
            try:
                k, error = _plain(r.get("key"), T.StringType()), _plain(r.get("error"), T.StringType())
                seen.add(k)
                out.append((k, *blank, "failed", error) if error else (k, *[_plain(r.get(n), t) for n, t in fields], "ok", None))
            except Exception as e:  # a value that no field can hold; the other rows of the call have been paid for
                out.append((k, *blank, "failed", f"{type(e).__name__}: {e}"))
        return out + [(k, *blank, "missing", None) for k in batch["key"] if k not in seen]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(rows(batch), columns=names, dtype=object)

    inp = df.select(*cols)
    if parallelism:
        inp = inp.repartition(parallelism)
    out = T.StructType([f for f in schema.fields if f.name == "key"] + [f for f in schema.fields if f.name != "key"]
                       + [T.StructField("score_status", T.StringType()), T.StructField("score_error", T.StringType())])
    return inp.mapInPandas(run, out)


def persist_scores(verdicts: DataFrame) -> DataFrame:
    """Save scorer output once in the shared checkpoint folder, so a lost executor re-reads it instead of
    calling the scorer (a paid, slow model) again.  Without a folder this fails before any call is paid."""
    from sourcelens.session import cut_lineage
    return cut_lineage(verdicts)
