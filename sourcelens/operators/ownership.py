"""Ownership labels (J7, J8) and non-production flags.

Three plans for J7 give the same labels:

* ``label_ownership`` - one ``CASE`` expression over literal domain lists; no join, no
  shuffle.  Right for the usual handful of domains.
* ``label_ownership_join`` - for long domain lists: the *distinct hosts* are exploded
  into their dot-suffixes (``a.b.c -> a.b.c, b.c, c``) and equi-joined to the domain
  dimension, turning a theta (suffix) match into a hash join; the winning priority
  per host is a partial aggregate, and the per-host label joins back on ``host``.
* ``label_ownership_domains`` - for long domain lists, without joining back: the last k labels of each row's host are
  looked up in the domain table, one hash join for each number of labels that domains have.  No row is multiplied and,
  with a broadcast table, none moves, however hot its host.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.functions.urls import host_of, host_under, is_nonprod
from sourcelens.rules import BrandRules

# A domain list from the rules is broadcast up to this length; a longer one is left to the planner.
MAX_BROADCAST_DOMAINS = 100_000
# Up to so many domains the labels are expressions over literals; longer lists are looked up in a table.
MAX_LITERAL_DOMAINS = 64
# label priorities of the first-match-wins chain
_P_COMPETITOR, _P_APPSTORE, _P_OWNED, _P_MARKET = 1, 2, 3, 4


def _contains_any(url: Column, needles) -> Column:
    if not needles:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.coalesce(url.contains(n), F.lit(False)) for n in needles])


def _url_rules(url: Column, host: Column, rules: BrandRules) -> tuple[Column, Column]:
    app = F.when(_contains_any(url, rules.owned_app_ids), F.lit("owned")).otherwise(F.lit("third_party"))
    market = (host == rules.marketplace_host) & F.coalesce(url.contains(rules.marketplace_marker), F.lit(False))
    return app, market


def ownership(url, host, rules: BrandRules) -> Column:
    """J7 as one expression: competitor -> app store -> owned -> marketplace -> third party."""
    u = F.col(url) if isinstance(url, str) else url
    h = F.col(host) if isinstance(host, str) else host
    app, market = _url_rules(u, h, rules)
    return (F.when(host_under(h, rules.competitor_domains), F.lit("competitor"))
             .when(h.isin(*[x.lower() for x in rules.app_store_hosts]), app)
             .when(host_under(h, rules.owned_domains), F.lit("owned"))
             .when(market, F.lit("owned_marketplace"))
             .otherwise(F.lit("third_party")))


def label_ownership(df: DataFrame, rules: BrandRules, url: str = "url", host: str | None = None,
                    out: str = "ownership") -> DataFrame:
    h = F.col(host) if host else host_of(url)
    return df.withColumn(out, ownership(F.col(url), h, rules))


def domain_dimension(spark: SparkSession, rules: BrandRules) -> DataFrame:
    """(domain, priority) rows for suffix-matched classes; size is the rule list, not the data."""
    rows = ([(d.lower(), _P_COMPETITOR) for d in rules.competitor_domains]
            + [(d.lower(), _P_APPSTORE) for d in rules.app_store_hosts]
            + [(d.lower(), _P_OWNED) for d in rules.owned_domains])
    return spark.createDataFrame(rows, "domain string, priority int")


def label_ownership_join(df: DataFrame, rules: BrandRules, url: str = "url", host: str = "host",
                         out: str = "ownership", domains: DataFrame | None = None) -> DataFrame:
    """J7 as a join, for large domain lists.  ``domains`` may be any (domain, priority) table;
    app-store hosts (priority 2) must match exactly, the others by dot-boundary suffix."""
    spark = df.sparkSession
    dim = domains if domains is not None else domain_dimension(spark, rules)
    hosts = df.select(F.col(host).alias("h")).distinct()
    labels = hosts.select(
        "h",
        F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size(F.split("h", r"\.", -1))),
            lambda i: F.array_join(F.slice(F.split("h", r"\.", -1), i, F.size(F.split("h", r"\.", -1))), ".")))
        .alias("depth", "suffix"))
    few = domains is None and len(rules.competitor_domains) + len(rules.owned_domains) <= MAX_BROADCAST_DOMAINS
    hit = labels.join(F.broadcast(dim) if few else dim, labels.suffix == dim.domain)
    # app-store hosts only match the whole host
    hit = hit.where((F.col("priority") != _P_APPSTORE) | (F.col("depth") == 0))
    best = hit.groupBy("h").agg(F.min("priority").alias("_prio"))
    joined = df.join(best, df[host] == best.h, "left").drop("h")
    u, h = F.col(url), F.col(host)
    app, market = _url_rules(u, h, rules)
    label = (F.when(F.col("_prio") == _P_COMPETITOR, F.lit("competitor"))
              .when(F.col("_prio") == _P_APPSTORE, app)
              .when(F.col("_prio") == _P_OWNED, F.lit("owned"))
              .when(market, F.lit("owned_marketplace"))
              .otherwise(F.lit("third_party")))
    return joined.withColumn(out, label).drop("_prio")


def long_lists(rules: BrandRules) -> bool:
    return len(rules.competitor_domains) + len(rules.owned_domains) > MAX_LITERAL_DOMAINS


def domain_table(spark: SparkSession, rules: BrandRules) -> DataFrame:
    """(domain, kind) rows of the rules' lists; ``kind`` is competitor, app_store or owned."""
    rows = [(d.lower(), kind) for kind, ds in (("competitor", rules.competitor_domains), ("app_store", rules.app_store_hosts), ("owned", rules.owned_domains)) for d in ds]
    return spark.createDataFrame(rows, "domain string, kind string")


def with_domain_match(df: DataFrame, domains: DataFrame, host: str, prefix: str, broadcast_domains: int = MAX_BROADCAST_DOMAINS) -> DataFrame:
    """``df`` plus four flags, none of them null: ``<prefix>competitor`` and ``<prefix>owned`` (the host is such a domain or under it), ``<prefix>app_store`` (it
    is one) and ``<prefix>under_owned`` (it is strictly under an owned one).  ``domains``: (domain, kind), any number of rows."""
    is_ = {k: F.coalesce(F.bool_or(F.col("kind") == k), F.lit(False)).alias(k) for k in ("competitor", "owned", "app_store")}
    dim = (domains.where("domain IS NOT NULL").groupBy(F.lower("domain").alias("domain")).agg(*is_.values())
           .withColumn("labels", F.size(F.split("domain", r"\.", -1))))
    sizes = {r["labels"]: r["n"] for r in dim.groupBy("labels").agg(F.count(F.lit(1)).alias("n")).collect()}  # a host name has few labels
    few = sum(sizes.values()) <= broadcast_domains
    flags = {f"{prefix}{k}": F.lit(False) for k in ("competitor", "owned", "app_store", "under_owned")}
    drop = []
    for k in sorted(sizes):
        own = dim.where(F.col("labels") == k).select(F.col("domain").alias(f"_d{k}"), *[F.col(x).alias(f"_{x}{k}") for x in is_])
        df = df.join(F.broadcast(own) if few else own, F.substring_index(F.col(host), ".", -k) == F.col(f"_d{k}"), "left")
        whole = F.col(host) == F.col(f"_d{k}")
        hit = {x: F.coalesce(F.col(f"_{x}{k}"), F.lit(False)) for x in is_}
        flags[f"{prefix}competitor"] |= hit["competitor"]
        flags[f"{prefix}owned"] |= hit["owned"]
        flags[f"{prefix}app_store"] |= hit["app_store"] & whole
        flags[f"{prefix}under_owned"] |= hit["owned"] & ~whole
        drop += [f"_d{k}", *[f"_{x}{k}" for x in is_]]
    return df.withColumns(flags).drop(*drop)


def ownership_of_match(url: Column, host: Column, rules: BrandRules, prefix: str) -> Column:
    """J7's chain over the flags of ``with_domain_match``."""
    app, market = _url_rules(url, host, rules)
    return (F.when(F.col(f"{prefix}competitor"), F.lit("competitor")).when(F.col(f"{prefix}app_store"), app)
             .when(F.col(f"{prefix}owned"), F.lit("owned")).when(market, F.lit("owned_marketplace")).otherwise(F.lit("third_party")))


def nonprod_of_match(host: Column, rules: BrandRules, prefix: str) -> Column:
    """P6 over the flags of ``with_domain_match``."""
    if not rules.nonprod_prefixes:
        return F.lit(False)
    return F.col(f"{prefix}under_owned") & F.coalesce(F.substring_index(host, ".", 1).isin(*rules.nonprod_prefixes), F.lit(False))


def label_ownership_domains(df: DataFrame, rules: BrandRules, url: str = "url", host: str = "host", out: str = "ownership",
                            domains: DataFrame | None = None, nonprod: str | None = None, broadcast_domains: int = MAX_BROADCAST_DOMAINS) -> DataFrame:
    """J7 (and with a column name for ``nonprod``, P6) against a table of domains: that of the rules, or any (domain, kind)."""
    table = domains if domains is not None else domain_table(df.sparkSession, rules)
    j = with_domain_match(df, table, host, "_m_", broadcast_domains)
    labels = {out: ownership_of_match(F.col(url), F.col(host), rules, "_m_")}
    if nonprod:
        labels[nonprod] = nonprod_of_match(F.col(host), rules, "_m_")
    return j.withColumns(labels).drop("_m_competitor", "_m_owned", "_m_app_store", "_m_under_owned")


def label_ad_ownership(df: DataFrame, rules: BrandRules, advertiser: str = "advertiser", url: str = "url",
                       out: str = "ownership", use_brand_names: bool = False) -> DataFrame:
    """Our brand in the advertiser name -> owned; a competitor domain's label
    (``rival.com -> rival``) -> competitor; otherwise J7 on the landing URL.  The domain label
    rarely appears in an advertiser's name, so ``use_brand_names=True`` also matches the
    competitor brand names."""
    adv = F.lower(F.coalesce(F.col(advertiser), F.lit("")))
    tokens = [d.split(".")[-2] if "." in d else d for d in rules.competitor_domains]
    if use_brand_names:
        tokens += list(rules.competitor_brands)
    tokens = [t.lower() for t in tokens if t]
    comp = reduce(lambda a, b: a | b, [adv.contains(t) for t in tokens]) if tokens else F.lit(False)
    u = F.coalesce(F.col(url), F.lit(""))
    return df.withColumn(out, F.when(adv.contains(rules.brand_lower), F.lit("owned"))
                         .when(comp, F.lit("competitor"))
                         .otherwise(ownership(u, host_of(u), rules)))


def with_nonprod(df: DataFrame, rules: BrandRules, host: str = "host", out: str = "nonprod_url") -> DataFrame:
    return df.withColumn(out, is_nonprod(F.col(host), rules))
