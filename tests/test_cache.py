"""Page cache: freshness, upsert/evict, versioned storage, hit/miss split, body merge."""

import datetime as dt

from sourcelens.operators.fetch import enrich, merge_bodies, plan_fetch, split_cache
from sourcelens.sources.cache import append_cache, cache_fresh, cache_upsert, read_cache

AS_OF = "2024-01-20"


def cache_df(spark, rows):
    return spark.createDataFrame([(u, t, dt.date.fromisoformat(d)) for u, t, d in rows],
                                 "url string, text string, fetch_date date")


def test_fresh_within_ttl_and_null_text(spark):
    c = cache_df(spark, [("https://a.test", "A", "2024-01-13"), ("https://b.test", None, "2024-01-20"),
                         ("https://old.test", "O", "2024-01-12")])
    got = {r.url: r.text for r in cache_fresh(c, AS_OF).collect()}
    assert got == {"https://a.test": "A", "https://b.test": ""}


def test_fresh_newest_wins_per_url(spark):
    c = cache_df(spark, [("https://a.test", "old", "2024-01-15"), ("https://a.test", "new", "2024-01-19")])
    assert [r.text for r in cache_fresh(c, AS_OF).collect()] == ["new"]


def test_upsert_replaces_and_evicts(spark):
    c = cache_df(spark, [("https://a.test", "A", "2024-01-10"), ("https://b.test", "B", "2024-01-05"),
                         ("https://gone.test", "G", "2024-01-05")])
    new = spark.createDataFrame([("https://b.test", "B2")], "url string, text string")
    got = {r.url: (r.text, str(r.fetch_date)) for r in cache_upsert(c, new, AS_OF).collect()}
    assert got == {"https://a.test": ("A", "2024-01-10"), "https://b.test": ("B2", "2024-01-20")}


def test_upsert_empty_batch_only_evicts(spark):
    c = cache_df(spark, [("https://a.test", "A", "2024-01-10"), ("https://z.test", "Z", "2024-01-01")])
    assert [r.url for r in cache_upsert(c, None, AS_OF).collect()] == ["https://a.test"]


def test_appended_days_newest_wins(spark, tmp_path):
    base = str(tmp_path / "cache")
    batch = lambda *rows: spark.createDataFrame(rows, "url string, text string")
    assert read_cache(spark, base).count() == 0
    append_cache(batch(), base, "2024-01-01")   # a run that crawled nothing
    assert read_cache(spark, base).count() == 0
    append_cache(batch(("https://a.test", "first"), ("https://b.test", None)), base, "2024-01-18")
    append_cache(batch(("https://a.test", "second")), base, "2024-01-19")
    append_cache(batch(("https://a.test", "second")), base, "2024-01-19")   # repeated after a failure
    append_cache(batch(("https://old.test", "old")), base, "2024-01-02")
    got = {r.url: r.text for r in cache_fresh(read_cache(spark, base, AS_OF), AS_OF, seq="seq").collect()}
    assert got == {"https://a.test": "second", "https://b.test": ""}
    assert "https://old.test" not in {r.url for r in read_cache(spark, base, AS_OF).collect()}   # evicted: older than two TTLs


def test_hits_and_misses_partition_requests(spark):
    c = cache_df(spark, [("https://cached.test/page", "cached text", "2024-01-19")])
    urls = spark.createDataFrame([("https://cached.test/page",), ("https://new.test",), ("aioverview::q",)],
                                 "url string")
    plan = plan_fetch(urls, c, AS_OF)
    assert [r.url for r in plan.hits.collect()] == ["https://cached.test/page"]
    assert [r.url for r in plan.misses.collect()] == ["https://new.test"]   # pseudo-URLs never crawled


def test_cache_hit_needs_no_crawl(spark):
    c = cache_df(spark, [("https://cached.test/page", "cached text", "2024-01-19")])
    urls = spark.createDataFrame([("https://cached.test/page",)], "url string")
    plan = split_cache(urls, cache_fresh(c, AS_OF))
    assert plan.misses.count() == 0
    assert plan.hits.first().text == "cached text"


def test_crawled_body_wins_and_enrich_picks_richer(spark):
    hits = spark.createDataFrame([("https://a.test", "cached"), ("https://b.test", "cached b")], "url string, text string")
    crawled = spark.createDataFrame([("https://a.test", "crawled longer text")], "url string, text string")
    bodies = merge_bodies(hits, crawled)
    recs = spark.createDataFrame([("https://a.test", "s"), ("https://b.test", "a much longer snippet"),
                                  ("https://c.test", "only snippet")], "url string, snippet string")
    got = {r.url: r.body for r in enrich(recs, bodies).collect()}
    assert got == {"https://a.test": "crawled longer text", "https://b.test": "a much longer snippet",
                   "https://c.test": "only snippet"}


# ---- reduction to the requested URLs ---------------------------------------------------------------------------
def test_only_requested_entries_are_moved(spark):
    from pyspark.sql import functions as F
    from sourcelens.sources.cache import requested_only
    cache = spark.range(50_000).selectExpr("concat('https://s.test/', id) AS url", "concat('body ', id) AS text", "date'2024-01-19' AS fetch_date", "id AS seq")
    asked = spark.range(0, 50_000, 100).selectExpr("concat('https://s.test/', id) AS url").unionByName(spark.createDataFrame([(None,), ("https://not.cached/",)], "url string"))
    kept = requested_only(cache, asked, expected_urls=1000)
    assert kept.columns == cache.columns and kept.join(asked, "url", "left_semi").count() == 500
    assert 500 <= kept.count() < 1500
    crowded = requested_only(cache, asked, expected_urls=1)    # far more URLs than expected: more pass, none is lost
    assert crowded.join(asked, "url", "left_semi").count() == 500
    assert requested_only(cache, asked.limit(0)).count() == 0
    plan = plan_fetch(asked.where("url IS NOT NULL"), cache, AS_OF, seq="seq").hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("broadcast")      # the filter stands below the last-wins window
    hits = plan_fetch(asked, cache.unionByName(cache.withColumns({"seq": F.col("seq") + 1, "text": F.lit("newer")})), AS_OF, seq="seq")
    assert {r.text for r in hits.hits.collect()} == {"newer"} and [r.url for r in hits.misses.collect()] == ["https://not.cached/"]


# ---- eviction and compaction -----------------------------------------------------------------------------------
def stored(spark, base):
    return sorted((str(r.fetch_date), r.url, r.text) for r in read_cache(spark, base).collect())


def thirty_days(spark, base, days=30):
    """Each day two runs, with a URL of its own, one of every day and a repeated one."""
    first = dt.date(2024, 1, 1)
    for n in range(days):
        day = (first + dt.timedelta(days=n)).isoformat()
        for run in (1, 2):
            append_cache(spark.createDataFrame([(f"https://d{n}.test/", f"{n}"), ("https://all.test/", f"{n}.{run}")], "url string, text string").repartition(2), base, day)
    return (first + dt.timedelta(days=days - 1)).isoformat()


def test_thirty_daily_runs_leave_fourteen_days(spark, tmp_path):
    from sourcelens.sources.cache import maintain_cache
    base = str(tmp_path / "cache")
    today = thirty_days(spark, base)
    before = {r.url: r.text for r in cache_fresh(read_cache(spark, base, today), today, seq="seq").collect()}
    report = maintain_cache(spark, base, today)
    assert len(report["evicted"]) == 15 and report["evicted"][0] == "2024-01-01" and len(report["compacted"]) == 14
    folders = sorted(p.name for p in (tmp_path / "cache").glob("fetch_date=*"))
    assert folders == [f"fetch_date=2024-01-{d}" for d in range(16, 31)]         # fourteen days and today's
    rows = stored(spark, base)
    closed = [r for r in rows if r[0] < today]
    assert len({r[:2] for r in closed}) == len(closed) == 28 and all(t.endswith(".2") for _, u, t in closed if "all" in u)
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "cache").glob("fetch_date=*") if p.name[11:] < today)
    assert {r.url: r.text for r in cache_fresh(read_cache(spark, base, today), today, seq="seq").collect()} == before
    assert maintain_cache(spark, base, today) == {"evicted": [], "compacted": []}


def test_a_crash_between_the_steps_loses_no_day(spark, tmp_path, monkeypatch):
    from sourcelens.sources import cache as C
    base = str(tmp_path / "cache")
    today = thirty_days(spark, base, 6)
    want = {r.url: r.text for r in cache_fresh(read_cache(spark, base, today), today, seq="seq").collect()}

    swap = C._swap_in
    calls = []

    def dies(spark, base):   # the first call finds nothing; the second one ends before the first day is in place
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return swap(spark, base)

    monkeypatch.setattr(C, "_swap_in", dies)
    try:
        C.compact_cache(spark, base, today)
    except RuntimeError:
        pass
    monkeypatch.setattr(C, "_swap_in", swap)
    fs = tmp_path / "cache"
    half = sorted((fs / "_compacted").glob("fetch_date=*"))
    assert len(half) == 5
    (half[0] / "_SUCCESS").unlink()                              # this copy was not written whole
    import os
    gone = fs / half[1].name
    gone.rename(tmp_path / "lost")                               # this day was taken away, and its copy not yet put in place
    assert {r.url: r.text for r in cache_fresh(read_cache(spark, base, today), today, seq="seq").collect()} != want
    assert C.compact_cache(spark, base, today) == [f"2024-01-0{d}" for d in range(1, 6)]
    assert {r.url: r.text for r in cache_fresh(read_cache(spark, base, today), today, seq="seq").collect()} == want
    assert not os.listdir(fs / "_compacted") and len(stored(spark, base)) == 5 * 2 + 4


def test_maintenance_of_nothing(spark, tmp_path):
    from sourcelens.sources.cache import maintain_cache
    assert maintain_cache(spark, str(tmp_path / "none"), AS_OF) == {"evicted": [], "compacted": []}


def test_repeated_bodies_make_no_further_records(spark):
    records = spark.createDataFrame([("u", "snippet"), ("v", "s")], "url string, snippet string")
    bodies = spark.createDataFrame([("u", "first body"), ("u", "second body"), ("u", None), ("w", "x")], "url string, text string")
    got = {r.url: r.body for r in enrich(records, bodies).collect()}
    assert got == {"u": "second body", "v": "s"} and enrich(records, bodies).count() == 2
    ordered = spark.createDataFrame([("u", "the last body, kept", 2), ("u", "z" * 50, 1)], "url string, text string, seq int")
    assert {r.body for r in enrich(records.where("url = 'u'"), ordered).collect()} == {"the last body, kept"}
