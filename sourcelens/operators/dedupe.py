"""Keep-best / keep-first / last-wins per key.

All three are ``row_number() = 1`` over a window partitioned by the key.  Spark plans
that as a WindowGroupLimit: each map task keeps only its best row per key before the
shuffle, so a hot key (one URL cited by a third of all rows) is cut down map-side and
never reaches one reducer whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def rank_key(rank: str = "rank") -> Column:
    """(is unranked, rank): rank 0 (overviews, panels, ads, forum posts) never displaces a ranked record."""
    r = F.coalesce(F.col(rank), F.lit(0))
    return F.struct((r == 0).alias("unranked"), r.alias("rank"))


def dedupe_best(df: DataFrame, key: str = "url", rank: str = "rank",
                order: tuple[str, ...] = ("source_ord", "seq"), first_seen: bool = False) -> DataFrame:
    """One record per ``key``: lowest non-zero rank; ties keep the first seen
    (total order ``order``).

    With ``first_seen`` the result also carries ``first_seen`` = the key's first appearance (the ``order`` columns of
    its first record), for an output in discovery order.  Both are ``row_number() = 1`` windows, cut down map-side;
    the second one carries only the key and the order, and the join needs no further shuffle."""
    best = _first_per_key(df, key, [rank_key(rank).asc()] + [F.col(c).asc() for c in order])
    if not first_seen:
        return best
    first = _first_per_key(df.select(key, *order), key, [F.col(c).asc() for c in order])
    return best.join(first.select(key, F.struct(*order).alias("first_seen")), key)


def last_by_key(df: DataFrame, key, seq: str = "seq") -> DataFrame:
    """A3: the last row per key wins (duplicate catalog queries, cache rows, crawled pages)."""
    return _first_per_key(df, key, [F.col(seq).desc()])


def keep_first(df: DataFrame, key, order) -> DataFrame:
    """The first row per key by ``order`` (selections, ad-hoc prompts)."""
    order = [order] if isinstance(order, str) else list(order)
    return _first_per_key(df, key, [F.col(c).asc() if isinstance(c, str) else c for c in order])
