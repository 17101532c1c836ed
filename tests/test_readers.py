"""Readers of landed scraper output (JSON lines written by the test into a temp folder)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sourcelens.operators.catalog import topics_frame
from sourcelens.sources import readers

TOPICS = [{"id": "t1", "intent": "price", "query": "reader price"}, {"id": "t2", "intent": "trust", "query": "reader safe"}]


def land(tmp_path, name, items):
    p = tmp_path / name
    p.write_text("\n".join(json.dumps(i) for i in items) + "\n")
    return str(p)


def places(rows):
    """Records in landing order as (platform, query, rank, url)."""
    return [(r.platform, r.query, r["rank"], r.url) for r in sorted(rows, key=lambda r: (r.seq.item.row, r.seq.kind, r.seq.pos))]


def test_search_items_of_either_query_shape(spark, tmp_path):
    hit = lambda u: {"url": u, "title": u[-1]}
    path = land(tmp_path, "serp.jsonl", [
        {"searchQuery": {"term": "reader price", "page": 2}, "organicResults": [hit("https://s.test/a"), {"title": "no link"}, hit("https://s.test/b")]},
        {"searchQuery": "reader safe", "organicResults": [hit("https://s.test/c")]},
        {"searchQuery": {"page": 1}, "organicResults": [hit("https://s.test/d")]},      # an object without a term: no query
        {"searchQuery": "{not json", "organicResults": None},
        {"organicResults": [hit("https://s.test/e"), {"url": ""}]}])
    rows = readers.read_serp(spark, path, topics_frame(spark, TOPICS)).collect()
    assert places(rows) == [("web", "reader price", 1, "https://s.test/a"), ("web", "reader price", 3, "https://s.test/b"),
                            ("web", "reader safe", 1, "https://s.test/c"), ("web", "", 1, "https://s.test/d"), ("web", "", 1, "https://s.test/e")]
    assert [(r.intent, r.topic_id) for r in sorted(rows, key=lambda r: r.url)] == [("price", "t1")] * 2 + [("trust", "t2")] + [("unknown", "")] * 2


def test_overviews_and_panels_are_rank_zero_records(spark, tmp_path):
    long = "[1] " + "cited text " * 900
    path = land(tmp_path, "serp.jsonl", [
        {"searchQuery": "q1", "aiOverview": long, "chatGptSearchResults": [{"text": "one"}, {"text": "", "answer": "two"}, {"text": ""}]},
        {"searchQuery": "q2", "aiOverview": {"parts": ["x"]}, "perplexitySearchResults": [{"answer": "three"}] + [{"text": f"p{i}"} for i in range(60)]},
        {"searchQuery": "q3", "aiOverview": "", "aiOverviewText": "plain"}, {"searchQuery": "q4", "aiOverview": None}])
    rows = readers.read_serp(spark, path).collect()
    by = {(r.platform, r.query, r.seq.pos): r.snippet for r in rows}
    assert by["ai_overview", "q1", 0] == long and by["ai_overview", "q2", 0] == '{"parts":["x"]}' and by["ai_overview", "q3", 0] == "plain"
    assert (by["chatgpt_search", "q1", 0], by["chatgpt_search", "q1", 1]) == ("one", "two") and ("chatgpt_search", "q1", 2) not in by
    assert by["perplexity_search", "q2", 60] == "p59" and not any(q == "q4" for _, q, _ in by)
    assert len({tuple(r.seq) for r in rows}) == len(rows) and {r["rank"] for r in rows} == {0}


def test_news_items_give_hits_only(spark, tmp_path):
    path = land(tmp_path, "news.jsonl", [{"searchQuery": "q", "aiOverview": "not here", "organicResults": [{"url": "https://n.test/1"}]}])
    assert places(readers.read_news(spark, path).collect()) == [("news", "q", 1, "https://n.test/1")]


def test_ads_take_the_first_of_each_choice(spark, tmp_path, rules):
    copy = lambda **k: [k]
    path = land(tmp_path, "ads.jsonl", [
        {"advertiserName": "A", "advertiserId": "id-a", "creativeId": "c1", "url": "https://own.test/x", "previewUrl": "https://pre.test", "variants": []},
        {"advertiserId": "id-b", "creativeId": "c2", "previewUrl": "https://pre.test/b", "variants": copy(text="t", headline="", body="b", description="d")},
        {"advertiserName": "", "advertiserId": "id-c", "url": "", "variants": copy(headline="h") + copy(text="z")},
        {"advertiserName": "D", "creativeId": "c4", "url": "", "variants": copy(text="")},      # neither link nor copy: no record
        {"advertiserName": f"{rules.brand} outlet", "creativeId": "c5", "variants": copy(body="x" * 9000)}])
    rows = {r.url: r for r in readers.read_ads(spark, path, rules).collect()}
    assert {u: (r.title, r.snippet) for u, r in rows.items() if u != "ad::c5"} == {
        "https://own.test/x": ("A", ""), "https://pre.test/b": ("id-b", "t d b"), "ad::id-c": ("id-c", "h z")}
    assert len(rows["ad::c5"].snippet) == 9000 and rows["ad::c5"].ownership == "owned" and rows["ad::id-c"].ownership == "third_party"
    assert {(r.platform, r["rank"], r.intent) for r in rows.values()} == {("ads", 0, "ads")}


def test_ads_empty_input(spark, tmp_path, rules):
    path = land(tmp_path, "ads.jsonl", [])
    assert readers.read_ads(spark, path, rules).count() == 0


def test_forum_posts(spark, tmp_path):
    path = land(tmp_path, "forum.jsonl", [{"link": "https://forum.test/p/1", "title": "T", "text": "x" * 5000},
                                          {"title": "no url"}])
    rows = readers.read_forum(spark, path).collect()
    assert len(rows) == 1 and rows[0].url == "https://forum.test/p/1"
    assert rows[0].query == "reddit" and rows[0].intent == "community" and len(rows[0].snippet) == 5000


def test_page_bodies_are_whole_and_markdown_comes_first(spark, tmp_path):
    marked = "# Title\n" + "word [link](https://far.test/1) " * 2000
    path = land(tmp_path, "pages.jsonl", [{"url": "https://p.test/1/", "markdown": marked, "text": "flat"}, {"url": "https://p.test/2", "markdown": "", "text": "flat"},
                                          {"url": "https://p.test/3"}, {"markdown": "no address"}])
    assert {r.url: r.text for r in readers.read_pages(spark, path).collect()} == {
        "https://p.test/1": marked, "https://p.test/2": "flat", "https://p.test/3": ""}


def test_the_last_landed_body_wins_whatever_its_size(spark, tmp_path):
    """Two landing files name the same pages; the later one wins though it is larger and its name sorts first."""
    folder = tmp_path / "pages"
    folder.mkdir()
    def write(name, note, at, filler):
        items = [{"url": f"https://p.test/{i}", "text": f"{note} {i}"} for i in range(3)] + [{"url": f"https://fill.test/{note}{i}", "text": "f"} for i in range(filler)]
        (folder / name).write_text("\n".join(json.dumps(i) for i in items + [{"url": "https://p.test/2", "text": f"{note} again"}]))
        os.utime(folder / name, (at, at))
    write("part-b.json", "early", 1_700_000_000, 0)
    write("part-a.json", "late", 1_700_000_500, 4000)
    got = {r.url: r.text for r in readers.read_pages(spark, str(folder)).where("url like 'https://p.test/%'").collect()}
    assert got == {"https://p.test/0": "late 0", "https://p.test/1": "late 1", "https://p.test/2": "late again"}


def test_pages_keyed_by_requested_url(spark, tmp_path):
    path = land(tmp_path, "pages.jsonl", [{"url": "https://final.test/x", "requested_url": "https://www.start.test/x/",
                                           "text": "body"}])
    assert [r.url for r in readers.read_pages(spark, path).collect()] == ["https://start.test/x"]


def test_answers_and_api_payloads(spark, tmp_path):
    a = land(tmp_path, "answers.jsonl", [
        {"surface": "chatgpt", "run": 1, "prompt": "license", "response": "ok",
         "citations": [{"url": "https://a.test"}, {"url": ""}, {"title": "no url"}]},
        {"surface": "chatgpt", "run": 1, "prompt": "", "response": "dropped"},
    ])
    rows = readers.read_answers(spark, a).collect()
    assert len(rows) == 1 and rows[0].citations == ["https://a.test"]
    api = land(tmp_path, "api.jsonl", [
        {"surface": "perplexity", "run": 1, "prompt": "p1",
         "choices": [{"message": {"content": "answer"}}], "citations": ["https://c.test", ""]},
        {"surface": "perplexity", "run": 1, "prompt": "p2", "choices": [],
         "search_results": [{"url": "https://s.test"}, {"url": ""}]},
    ])
    got = {r.prompt: (r.response, r.citations) for r in readers.read_answer_api(spark, api).collect()}
    assert got == {"p1": ("answer", ["https://c.test"]), "p2": ("", ["https://s.test"])}


def test_union_skips_missing_sources(spark, tmp_path):
    path = land(tmp_path, "forum.jsonl", [{"url": "https://forum.test/p/1"}])
    u = readers.union_discovery(None, readers.read_forum(spark, path), None)
    assert u.count() == 1 and u.where(F.col("source_ord") == 3).count() == 1


def test_a_missing_source_and_unreadable_lines_are_reported(spark, tmp_path, rules):
    path = tmp_path / "forum.jsonl"
    path.write_text('{"url": "https://forum.test/p/1"}\nnot json at all\n{"url": "https://forum.test/p/2"}\n')
    ads = readers.try_source("ads", readers.read_ads, spark, str(tmp_path / "no-such-folder"), rules)
    forum = readers.try_source("reddit", readers.read_forum, spark, str(path))
    u = readers.union_discovery(ads.rows, forum.rows)
    assert sorted(r.url for r in u.collect()) == ["https://forum.test/p/1", "https://forum.test/p/2"]
    assert ads.report() == {"source.ads": "missing"}
    assert forum.report() == {"source.reddit": "ok", "source.reddit.lines": "3", "source.reddit.corrupt": "1"}


def test_an_error_of_our_own_is_not_taken_for_a_missing_source(spark, tmp_path):
    from pyspark.errors import AnalysisException
    path = land(tmp_path, "forum.jsonl", [{"url": "https://forum.test/p/1"}])
    with pytest.raises(AnalysisException):
        readers.try_source("x", lambda s, p, observe: readers.read_items(s, p, readers.FORUM_ITEM).select("no_such_column"), spark, path)


def test_raw_answers_take_surface_and_run_from_their_folder(spark, tmp_path):
    for surface, run in (("chatgpt", 1), ("perplexity", 2)):
        folder = tmp_path / "answers" / f"surface={surface}" / f"run={run}"
        folder.mkdir(parents=True)
        (folder / "items.json").write_text(json.dumps({"prompt": "p", "response": f"r {surface}", "citations": [{"url": "https://c.test"}]}))
    got = {(r.surface, r.run, r.prompt, r.response) for r in readers.read_answers(spark, str(tmp_path / "answers")).collect()}
    assert got == {("chatgpt", 1, "p", "r chatgpt"), ("perplexity", 2, "p", "r perplexity")}
    bare = land(tmp_path, "bare.jsonl", [{"prompt": "p", "response": "r"}])
    assert [(r.surface, r.run) for r in readers.read_answers(spark, bare).collect()] == [(None, None)]


def test_read_verdicts_with_brand_named_fields(spark, tmp_path):
    path = land(tmp_path, "verdicts.jsonl", [
        {"key": "chatgpt\u001f1\u001fp", "license_mentioned": True, "license_rank": 2, "license_recommended": True,
         "says_about_license": "Recommends it.", "mentions_competition": True, "competitors_named": ["Token"],
         "sentiment_license": 0.5, "sources_cited": ["https://example.net"]}])
    v = readers.read_verdicts(spark, path, "answer", brand="License").first()
    assert (v.mentioned, v.rank, v.recommended, v.says_about_brand, v.sentiment) == (True, 2, True, "Recommends it.",
                                                                                     0.5)
    assert v.competitors_named == ["Token"] and v.sources_cited == ["https://example.net"]
    web = land(tmp_path, "web.jsonl", [{"key": "https://a.test", "says_about_brand": "x", "sentiment": -0.2}])
    w = readers.read_verdicts(spark, web).first()
    assert (w.key, w.says_about_brand, w.sentiment, w.price_mentioned) == ("https://a.test", "x", -0.2, None)


def test_read_verdicts_accepts_generic_names_with_a_brand(spark, tmp_path):
    path = land(tmp_path, "v.jsonl", [{"key": "k", "says_about_brand": "generic", "sentiment": 0.3}])
    v = readers.read_verdicts(spark, path, "web", brand="license").first()
    assert (v.says_about_brand, v.sentiment) == ("generic", 0.3)
