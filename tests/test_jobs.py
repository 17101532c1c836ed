"""The two end-to-end jobs on landed fixtures with a configuration in the reference's shape."""

import json

from pyspark.sql import functions as F

from sourcelens.plans.jobs import answer_visibility, web_refresh

CONFIG = {
    "brand": "license",
    "topics": [
        {"id": "t_name", "intent": "brand_entity", "query": "license monitor"},
        {"id": "t_rival", "intent": "comparison", "query": "license vs Token"},
        {"id": "no_query", "intent": "x"},
    ],
    "llm_surfaces": ["chatgpt", "perplexity"],
    "llm_num_runs": 2,
    "claim_patterns": {"only_the": ["only.{0,20}the"], "the_only": ["the.{0,12}only"]},
    "current_signal_patterns": ["that the"],
    "price_pattern": "\\$\\s?\\d{2,4}",
    "owned_domains": ["example.net"],
    "owned_app_ids": [],
    "competitor_domains": ["example.org"],
    "competitor_brands": ["Token", "There"],
    "nonprod_prefixes": ["m", "blog"],
}


def land(path, items):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part-0.json").write_text("\n".join(json.dumps(i) for i in items) + "\n")


def test_web_refresh_writes_run_crawl_list_and_cache(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing / "serp", [{"searchQuery": {"term": "license vs Token"}, "organicResults": [
        {"url": "https://Mag.test/2024/wallets/?page=1#top", "title": "Wallets", "description": "A Token in each pocket"},
        {"url": "https://blog.example.net/news/7", "title": "Opening hours"}],
        "aiOverview": {"text": "A license: only for the desk."}}])
    land(landing / "reddit", [{"url": "https://forum.test/p/1", "title": "T", "body": "There is cheaper"}])
    land(landing / "pages", [{"url": "https://mag.test/2024/wallets", "markdown": "Six wallets, one Token. $149 "
                                                                         "[order](https://till.test/6)"}])
    out, cache = str(tmp_path / "out"), str(tmp_path / "cache")
    run = web_refresh(spark, CONFIG, str(landing), out, cache, as_of="2024-01-20", note="first", run_id="run-1")
    assert run.written and run.run_id == "run-1"
    meta = {r.key: r.value for r in spark.read.parquet(out + "/run_meta").collect()}
    assert (meta["note"], meta["sources"], meta["source.news"], meta["source.serp"]) == ("first", "serp,news,ads,reddit", "missing", "ok")
    assert meta["source.serp.lines"] == "1" and meta["source.serp.corrupt"] == "0"
    assert {r.url for r in spark.read.parquet(out + "/nonprod_web").collect()} == {"https://blog.example.net/news/7"}
    sheet = {r.url: r for r in spark.read.parquet(out + "/web").collect()}
    a = sheet["https://mag.test/2024/wallets"]
    assert a.topic_id == "t_rival" and a.competitors_named == "Token" and a.price == "$149"
    assert a.links_on_source == "https://till.test/6"
    assert sheet["https://blog.example.net/news/7"].nonprod_url and sheet["https://blog.example.net/news/7"].ownership == "owned"
    assert sheet["aioverview::license vs Token"].says_about_brand == "Describes the old product as current."
    assert sheet["https://forum.test/p/1"].intent == "community"
    crawl = {r.url for r in spark.read.parquet(out + "/crawl_list").collect()}
    # every cache miss of the run (the landed crawl answered one of them)
    assert crawl == {"https://mag.test/2024/wallets", "https://blog.example.net/news/7", "https://forum.test/p/1"}
    # second run: the crawled page is now a cache hit
    again = web_refresh(spark, CONFIG, str(landing), out, cache, as_of="2024-01-21", note="second")
    assert "https://mag.test/2024/wallets" not in {r.url for r in again.crawl_list.collect()}


def test_web_refresh_with_nothing_landed_writes_nothing(spark, tmp_path):
    run = web_refresh(spark, CONFIG, str(tmp_path / "empty"), str(tmp_path / "out"), str(tmp_path / "cache"),
                      as_of="2024-01-20")
    assert not run.written and not (tmp_path / "out").exists()


def test_answer_visibility_selection_adhoc_runs_and_failures(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing / "answers", [
        {"surface": "chatgpt", "run": r, "prompt": p, "response": f"license is great ({r})",
         "citations": [{"url": "https://blog.example.net/x?os=1"}]}
        for r in (1, 2) for p in ("license monitor", "license vs Other")])
    land(landing / "failures", [{"surface": "perplexity", "run": 1, "note": "no API key"},
                                {"surface": "perplexity", "run": 2, "note": "no API key"}])
    out = str(tmp_path / "out")
    run = answer_visibility(spark, CONFIG, str(landing), out, prompts=["1"],
                            extra_prompts=[("license vs Other", "comparison"), ("license monitor", "")])
    assert run.written
    df = spark.read.parquet(out + "/answers")
    ok = df.where(F.col("status") == "ok").collect()
    assert len(ok) == 4 and all(r.nonprod_url for r in ok)
    assert {r.prompt: r.intent for r in ok} == {"license monitor": "brand_entity", "license vs Other": "comparison"}
    err = df.where(F.col("status") == "error").collect()
    assert len(err) == 4 and {r.error_note for r in err} == {"no API key"}


def test_run_meta_holds_observed_counters(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing / "serp", [{"searchQuery": "license vs Token", "organicResults": [
        {"url": "https://mag.test/1"}, {"url": "https://blog.example.net/2"}]}])
    out = str(tmp_path / "out")
    run = web_refresh(spark, CONFIG, str(landing), out, str(tmp_path / "cache"), as_of="2024-01-20")
    meta = {r.key: r.value for r in spark.read.parquet(out + "/run_meta").where(F.col("run_id") == run.run_id)
            .collect()}
    assert meta["count.rows"] == "2" and meta["count.source_web"] == "2" and meta["count.nonprod"] == "1"
    assert meta["count.fetch_missing"] == "2" and meta["as_of"] == "2024-01-20"


def test_both_tracks_select_the_same_topics(spark):
    from sourcelens.plans.jobs import select_topics
    web = select_topics(spark, CONFIG, None)
    answers = select_topics(spark, CONFIG, ["all"])
    key = lambda df: sorted((r.id, r.query) for r in df.collect())
    assert key(web) == key(answers) == [("t_name", "license monitor"), ("t_rival", "license vs Token")]
    assert key(select_topics(spark, CONFIG, ["2"])) == [("t_rival", "license vs Token")]


def test_web_refresh_uses_landed_verdicts(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing / "serp", [{"searchQuery": "license vs Token", "organicResults": [
        {"url": "https://mag.test/2024/wallets", "description": "Token beats license"},
        {"url": "https://other.test/b", "description": "license"}]}])
    land(landing / "verdicts_web", [{"key": "https://mag.test/2024/wallets", "says_about_license": "Judged.",
                                     "mentions_competition": False, "sentiment_license": 0.7}])
    run = web_refresh(spark, CONFIG, str(landing), str(tmp_path / "out"), str(tmp_path / "cache"),
                      as_of="2024-01-20")
    rows = {r.url: r for r in run.sheet.collect()}
    assert rows["https://mag.test/2024/wallets"].says_about_brand == "Judged." and rows["https://mag.test/2024/wallets"].sentiment == 0.7
    assert rows["https://other.test/b"].verdict_source == "fallback"


def test_web_refresh_twice_before_any_crawl(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing / "serp", [{"searchQuery": "license vs Token", "organicResults": [{"url": "https://a.test"}]}])
    for day in ("2024-01-20", "2024-01-21"):
        run = web_refresh(spark, CONFIG, str(landing), str(tmp_path / "out"), str(tmp_path / "cache"), as_of=day)
        assert run.written and [r.url for r in run.crawl_list.collect()] == ["https://a.test"]


def test_answer_job_writes_a_sorted_sheet_and_the_alert(spark, tmp_path):
    from sourcelens.schemas import LLM_SCHEMA
    from sourcelens.sources.sinks import read_sheet
    folder = tmp_path / "landing" / "answers" / "surface=chatgpt"
    for run in (2, 1):
        land(folder / f"run={run}", [{"prompt": p, "response": f"line one\nsee https://m.example.net/{p[-1]} ({run})"} for p in ("license vs Token", "license monitor")])
    out = str(tmp_path / "out")
    answer_visibility(spark, CONFIG, str(tmp_path / "landing"), out, run_id="r1")
    rows = read_sheet(spark, out + "/answers_csv/run_id=r1", LLM_SCHEMA).collect()
    ok = [(r.prompt, r.run) for r in rows if r.status == "ok"]
    assert ok == [("license monitor", 1), ("license monitor", 2), ("license vs Token", 1), ("license vs Token", 2)]
    assert {r.url for r in spark.read.parquet(out + "/nonprod_answers").collect()} == {"https://m.example.net/r", "https://m.example.net/n"}


def test_a_selection_that_matches_nothing_is_an_error(spark, tmp_path):
    import pytest
    with pytest.raises(ValueError, match="nothing like it"):
        web_refresh(spark, CONFIG, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "cache"), queries=["nothing like it"])


def test_unreadable_lines_are_kept_with_place_and_reason(spark, tmp_path):
    from sourcelens.schemas import SERP_ITEM
    from sourcelens.sources import readers
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    good = {"searchQuery": "license vs Token", "organicResults": [{"url": "https://mag.test/1"}]}
    bad = ['{"searchQuery": ', '[1, 2]', '"text"', '{"searchQuery": "x", "organicResults": 5}']
    (landing / "serp").mkdir(parents=True)
    (landing / "serp" / "a.json").write_text("\n".join([json.dumps(good), bad[0], json.dumps(good), bad[1], bad[2]]) + "\n")
    (landing / "serp" / "b.json").write_text(bad[3] + "\n" + json.dumps(good | {"organicResults": None}) + "\n")
    land(landing / "pages", [{"url": "https://mag.test/1", "text": "A page."}])
    run = web_refresh(spark, CONFIG, str(landing), out, str(tmp_path / "cache"), as_of="2024-01-20", run_id="r")
    assert run.written
    rows = spark.read.parquet(f"{out}/quarantine_web/run_id=r").collect()
    kept = sorted((r.source, r.file.rsplit("/", 1)[-1], r.line, r.reason) for r in rows)
    assert kept == sorted([("serp", "a.json", bad[0], "no JSON"), ("serp", "a.json", bad[1], "no object"), ("serp", "a.json", bad[2], "no object"),
                           ("serp", "b.json", bad[3], "a field of another type")])
    meta = {r.key: r.value for r in spark.read.parquet(out + "/run_meta").collect()}
    assert (meta["source.serp.lines"], meta["source.serp.corrupt"], meta["source.pages.corrupt"], meta["source.news"]) == ("7", "4", "0", "missing")
    items, rejected = readers.stage_items(spark, str(landing / "serp"), SERP_ITEM, str(tmp_path / "staged"), "serp")
    plain = readers.read_items(spark, str(landing / "serp"), SERP_ITEM)
    assert items.count() + rejected.count() == 7 and items.dtypes == plain.dtypes
    landed = {(r.file, r.row) for r in rejected.collect()}
    assert len(landed) == 4 and not landed & {(r.item_seq.file, r.item_seq.row) for r in items.collect()}


def test_a_web_run_removes_old_days_from_the_cache(spark, tmp_path):
    from sourcelens.sources.cache import append_cache
    landing, cache = tmp_path / "landing", str(tmp_path / "cache")
    land(landing / "serp", [{"searchQuery": "license vs Token", "organicResults": [{"url": "https://mag.test/1"}]}])
    land(landing / "pages", [{"url": "https://mag.test/1", "text": "A page."}])
    for day in ("2024-01-05", "2024-01-06", "2024-01-19"):
        append_cache(spark.createDataFrame([(f"https://{day}.test/", day)], "url string, text string"), cache, day)
    web_refresh(spark, CONFIG, str(landing), str(tmp_path / "out"), cache, as_of="2024-01-20")
    assert sorted(p.name[11:] for p in (tmp_path / "cache").glob("fetch_date=*")) == ["2024-01-06", "2024-01-19", "2024-01-20"]
