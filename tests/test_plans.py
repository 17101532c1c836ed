"""End to end: web snapshot from landed JSON, junk crawl, empty discovery, scorer path, reports."""

import json

import pandas as pd
from pyspark.sql import functions as F

from sourcelens.operators.catalog import topics_frame
from sourcelens.plans import reports
from sourcelens.plans.web import web_sheet, web_snapshot
from sourcelens.schemas import WEB_COLUMNS
from sourcelens.sources import readers
from sourcelens.sources.cache import append_cache, read_cache

COMPETE_TEXT = "Our editors would rather carry a Token."
CURRENT_TEXT = "They say that the rest is new. $99"
AS_OF = "2024-01-20"


def land(tmp_path, name, items):
    p = tmp_path / name
    p.write_text("\n".join(json.dumps(i) for i in items) + "\n")
    return str(p)


def empty_cache(spark):
    return spark.createDataFrame([], "url string, text string, fetch_date date")


def test_two_runs_over_a_growing_cache(spark, tmp_path, rules):
    """The first run asks for every page; what the crawl brings is judged, stored, and asked for no more."""
    own, rival = rules.owned_domains[0], rules.competitor_domains[0]
    topics = topics_frame(spark, [{"id": "t9", "intent": "price", "query": "reader price"}])
    urls = [f"https://m.{own}/price", f"https://{rival}/offer", "https://paper.test/report", "https://gone.test/404"]
    hits = [{"url": u + "?src=ad", "title": u, "description": "short"} for u in urls[:3]] + [
        {"url": urls[3], "description": f"{rules.competitor_brands[0]} beats everyone, says this long result text"}]
    recs = readers.read_serp(spark, land(tmp_path, "serp.jsonl", [{"searchQuery": "reader price", "organicResults": hits}]), topics)
    pages = readers.read_pages(spark, land(tmp_path, "pages.jsonl", [
        {"url": urls[0], "markdown": "That the price is $75 or $120: [order](https://till.test/o)"}, {"url": urls[1], "text": "An offer. There, at last."},
        {"url": urls[3], "text": "404"}, {"url": "https://never.asked.test", "text": "x"}]))
    base = str(tmp_path / "cache")
    snap = web_snapshot(recs, read_cache(spark, base), pages, rules, AS_OF, cache_seq="seq")
    assert sorted(r.url for r in snap.crawl_list.collect()) == sorted(urls)
    sheet = web_sheet(snap)
    assert sheet.columns == WEB_COLUMNS
    by = {r.url: r for r in sheet.collect()}
    assert [by[u].ownership for u in urls] == ["owned", "competitor", "third_party", "third_party"]
    first = by[urls[0]]
    assert (first.nonprod_url, first.price, first.links_on_source, first.intent, first.topic_id) == (True, "$120", "https://till.test/o", "price", "t9")
    assert by[urls[1]].competitors_named == "There" and by[urls[2]].says_about_brand == f"No clear mention of {rules.brand}."
    assert by[urls[3]].competitors_named == rules.competitor_brands[0]   # the result text says more than the crawled error page
    append_cache(snap.crawled, base, AS_OF)
    again = web_snapshot(recs, read_cache(spark, base, "2024-01-22"), None, rules, "2024-01-22", cache_seq="seq")
    assert [r.url for r in again.crawl_list.collect()] == [urls[2]]
    later = {r.url: r for r in web_sheet(again).collect()}
    assert all(later[u][c] == by[u][c] for u in urls for c in WEB_COLUMNS)


def test_padded_links_keep_their_owner_and_all_their_links(spark, tmp_path, rules):
    own = rules.owned_domains[0]
    text = "see " + " ".join(f"https://l{i}.test/" for i in range(30)) + " tail " + "y" * 30000 + " https://last.test"
    serp = land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [{"url": f"  https://{own}/x ", "description": text}]}])
    row = web_snapshot(readers.read_serp(spark, serp), empty_cache(spark), None, rules, AS_OF).sheet.first()
    assert row.ownership == "owned" and row.links_on_source == [f"https://l{i}.test" for i in range(30)] + ["https://last.test"]


def test_best_record_per_url_and_first_seen_on_ties(spark, tmp_path, rules):
    serp = land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [
        {"url": "https://a.test/x"}, {"url": "https://b.test"}, {"url": "https://www.a.test/x/?ref=1"}]}])
    forum = land(tmp_path, "forum.jsonl", [{"url": "https://b.test/"}, {"url": "https://c.test"}])
    recs = readers.union_discovery(readers.read_serp(spark, serp), readers.read_forum(spark, forum))
    rows = {r.url: (r.source, r.query) for r in web_sheet(web_snapshot(recs, empty_cache(spark), None, rules,
                                                                       AS_OF)).collect()}
    assert rows == {"https://a.test/x": ("web", "q"), "https://b.test": ("web", "q"),
                    "https://c.test": ("reddit", "reddit")}


def test_empty_discovery_writes_nothing(spark, tmp_path, rules):
    from sourcelens.sources.sinks import write_snapshot
    serp = land(tmp_path, "serp.jsonl", [])
    snap = web_snapshot(readers.read_serp(spark, serp), empty_cache(spark), None, rules, AS_OF)
    assert not write_snapshot(web_sheet(snap), str(tmp_path / "out"), "web", "r1")
    assert not (tmp_path / "out").exists()


def test_model_verdict_path_and_fallback_on_failure(spark, tmp_path, rules):
    serp = land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [
        {"url": "https://ok.test", "description": CURRENT_TEXT},
        {"url": "https://fail.test", "description": COMPETE_TEXT + " boom"}]}])

    def scorer(batch):
        boom = batch["text"].str.contains("boom")
        return pd.DataFrame({"key": batch["key"], "error": boom.map({True: "no answer", False: None}), "says_about_brand": "Current reader.",
                             "mentions_competition": False, "competition_summary": None,
                             "competitors_named": [[] for _ in range(len(batch))], "sentiment": 0.5,
                             "price_mentioned": "$99"})
    snap = web_snapshot(readers.read_serp(spark, serp), empty_cache(spark), None, rules, AS_OF, scorer=scorer)
    rows = {r.url: r for r in snap.sheet.collect()}
    assert rows["https://ok.test"].says_about_brand == "Current reader." and rows["https://ok.test"].sentiment == 0.5
    assert rows["https://ok.test"].verdict_source == "model"
    assert rows["https://fail.test"].verdict_source == "fallback" and rows["https://fail.test"].mentions_competition


def test_reports(spark, rules):
    web = spark.createDataFrame([
        ("https://m.example.net/a", "owned", "i1", True, True, "$9", "model"),
        ("https://example.org/b", "competitor", "i1", False, False, None, "fallback"),
        ("https://blog.example.net/c", "owned", "i2", True, True, None, "fallback")],
        "url string, ownership string, intent string, mentions_competition boolean, nonprod_url boolean, "
        "price string, verdict_source string")
    assert [r.url for r in reports.nonprod_report(web, top=5).collect()] == ["https://blog.example.net/c",
                                                                             "https://m.example.net/a"]
    assert {r.url for r in reports.nonprod_report(web).collect()} == {"https://blog.example.net/c", "https://m.example.net/a"}
    roll = {(r.ownership, r.intent): r.rows for r in reports.ownership_rollup(web).collect()}
    assert roll[(None, None)] == 3 and roll[("owned", None)] == 2 and roll[("owned", "i1")] == 1
    answers = spark.createDataFrame([
        ("chatgpt", "p", "ok", True, False, True, ["https://a.test/x, y", "https://b.test"]),
        ("chatgpt", "p", "ok", False, False, False, ["https://a.test/y"]),
        ("chatgpt", "p", "error", None, None, None, [])],
        "surface string, prompt string, status string, mentioned boolean, recommended boolean, stale boolean, "
        "sources_cited array<string>")
    v = reports.visibility_rollup(answers).first()
    assert (v.runs, v.ok_runs, v.mentioned_runs, v.stale_runs, v.mention_rate) == (3, 2, 1, 1, 0.5)
    c = {r.host: (r.citations, r.share) for r in reports.citation_rollup(answers).collect()}
    assert c == {"a.test": (2, 0.6667), "b.test": (1, 0.3333)}
    a = spark.createDataFrame([("u1", "x"), ("u2", "y")], "url string, v string")
    b = spark.createDataFrame([("u1", "x"), ("u2", "z"), ("u3", "w")], "url string, v string")
    d = {r.url: (r.change, r.changed_columns) for r in reports.snapshot_diff(a, b, ["url"]).collect()}
    assert d == {"u1": ("same", ""), "u2": ("changed", "v"), "u3": ("added", "")}
    metered, obs = reports.run_metrics(web.withColumnRenamed("ownership", "source"))
    metered.count()
    assert obs.get["rows"] == 3 and obs.get["nonprod"] == 2


def test_sheet_in_discovery_order_and_raw_vs_canonical_ownership(spark, tmp_path, rules):
    serp = land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [
        {"url": "https://z.test/1"}, {"url": "https://apps.apple.com/us/app/x/id4410?mt=8"},
        {"url": "https://a.test/2"}]}])
    recs = readers.read_serp(spark, serp)
    snap = web_snapshot(recs, empty_cache(spark), None, rules, AS_OF)
    out = str(tmp_path / "web")
    from sourcelens.sources.sinks import read_sheet, write_web
    from sourcelens.schemas import WEB_SCHEMA
    write_web(snap.sheet, out)
    assert [r.url for r in read_sheet(spark, out, WEB_SCHEMA).collect()] == [
        "https://z.test/1", "https://apps.apple.com/us/app/x/id4410", "https://a.test/2"]
    raw = {r.url: r.ownership for r in snap.sheet.collect()}
    canon = {r.url: r.ownership for r in web_snapshot(recs, empty_cache(spark), None, rules, AS_OF,
                                                      label_from_raw=False).sheet.collect()}
    app = "https://apps.apple.com/us/app/x/id4410"
    assert raw[app] == "owned" and canon[app] == "owned"     # the id is in the path here
    play = land(tmp_path, "play.jsonl", [{"searchQuery": "q", "organicResults": [
        {"url": "https://play.google.com/store/apps/details?id=test.pocket.app"}]}])
    precs = readers.read_serp(spark, play)
    assert web_snapshot(precs, empty_cache(spark), None, rules, AS_OF).sheet.first().ownership == "owned"
    assert web_snapshot(precs, empty_cache(spark), None, rules, AS_OF,
                        label_from_raw=False).sheet.first().ownership == "third_party"   # ?id= lost


def test_long_domain_lists_are_labelled_alike(spark, tmp_path, rules):
    many = rules.with_(competitor_domains=tuple(f"rival{i}.test" for i in range(150)) + ("example.org",))
    serp = land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [
        {"url": "https://shop.rival7.test/x"}, {"url": "https://example.org/y"}, {"url": "https://blog.example.net/z"},
        {"url": "https://other.test/w"}]}])
    sheet = web_snapshot(readers.read_serp(spark, serp), empty_cache(spark), None, many, AS_OF).sheet
    got = {r.url: r.ownership for r in sheet.collect()}
    assert got == {"https://shop.rival7.test/x": "competitor", "https://example.org/y": "competitor",
                   "https://blog.example.net/z": "owned", "https://other.test/w": "third_party"}


def test_competitor_share(spark):
    answers = spark.createDataFrame([
        ("chatgpt", "ok", ["Token", "There"]), ("chatgpt", "ok", ["Token", "Token"]), ("chatgpt", "ok", []),
        ("chatgpt", "error", []), ("perplexity", "ok", ["There"])],
        "surface string, status string, competitors_named array<string>")
    got = {(r.surface, r.brand): (r.answers, r.ok_answers, r.share) for r in reports.competitor_share(answers).collect()}
    assert got == {("chatgpt", "Token"): (2, 3, 0.6667), ("chatgpt", "There"): (1, 3, 0.3333),
                   ("perplexity", "There"): (1, 1, 1.0)}


def test_web_alert_in_sheet_order(spark, tmp_path, rules):
    serp = land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [
        {"url": f"https://m.example.net/{c}"} for c in "zyxwvu"]}])
    sheet = web_snapshot(readers.read_serp(spark, serp), empty_cache(spark), None, rules, AS_OF).sheet
    assert [r.url for r in reports.nonprod_report(sheet, top=5).collect()] == [
        f"https://m.example.net/{c}" for c in "zyxwv"]
    assert reports.nonprod_report(sheet).count() == 6


def test_scorer_from_a_module_only_the_driver_can_import(spark, tmp_path, rules):
    """A scorer defined in a script or entry file (importable on the driver only) still runs on
    the Python workers: its module is shipped by value."""
    import importlib
    import sys
    mod_dir = tmp_path / "driver_only"
    mod_dir.mkdir()
    (mod_dir / "my_scorer_mod.py").write_text(
        "import pandas as pd\n"
        "def scorer(batch):\n"
        "    return pd.DataFrame({'key': batch['key'], 'says_about_brand': 'from module',\n"
        "                         'mentions_competition': False, 'competition_summary': None,\n"
        "                         'competitors_named': [[] for _ in range(len(batch))], 'sentiment': 0.1,\n"
        "                         'price_mentioned': None})\n")
    sys.path.insert(0, str(mod_dir))
    try:
        mod = importlib.import_module("my_scorer_mod")
        serp = land(tmp_path, "serp.jsonl", [{"searchQuery": "q", "organicResults": [
            {"url": "https://a.test", "description": "license text"}]}])
        snap = web_snapshot(readers.read_serp(spark, serp), empty_cache(spark), None, rules, AS_OF,
                            scorer=mod.scorer)
        assert snap.sheet.first().says_about_brand == "from module"
    finally:
        sys.path.remove(str(mod_dir))
