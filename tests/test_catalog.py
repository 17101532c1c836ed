"""Catalog selection (J12), ad-hoc prompts (J13), topic tagging (J1), request manifest."""

import pytest

from sourcelens.operators.catalog import (add_adhoc, request_manifest, require_matched, select_catalog, tag_topics,
                                          topics_frame, unmatched_selectors)


def catalog(spark, labels):
    return spark.createDataFrame([(i + 1, l) for i, l in enumerate(labels)], "pos long, label string")


def chosen(spark, labels, tokens):
    require_matched(catalog(spark, labels), tokens)
    return [r.label for r in select_catalog(catalog(spark, labels), tokens).orderBy("sel_ord", "pos").collect()]


def test_selection_all_and_blank(spark):
    items = ["a", "b", "c"]
    assert chosen(spark, items, None) == items
    assert chosen(spark, items, ["all"]) == items
    assert chosen(spark, items, ["*"]) == items
    assert chosen(spark, items, [""]) == items


def test_selection_indices_and_names(spark):
    items = ["alpha", "beta", "gamma"]
    assert chosen(spark, items, ["1", "3"]) == ["alpha", "gamma"]
    assert chosen(spark, items, ["beta"]) == ["beta"]
    assert chosen(spark, items, ["1", "alpha"]) == ["alpha"]
    assert chosen(spark, items, ["GAM", "1"]) == ["gamma", "alpha"]


def test_selection_substring_selects_every_match(spark):
    assert chosen(spark, ["red ring", "blue ring", "box"], ["ring"]) == ["red ring", "blue ring"]


def test_selection_errors(spark):
    with pytest.raises(ValueError):
        chosen(spark, ["a", "b"], ["9"])
    with pytest.raises(ValueError):
        chosen(spark, ["a", "b"], ["zzz"])


def extra(spark, rows):
    return spark.createDataFrame([(t, i, o) for o, (t, i) in enumerate(rows)], "text string, intent string, ord long")


def adhoc(spark, selected, rows):
    sel = spark.createDataFrame([(p,) for p in selected], "prompt string")
    return [(r.prompt, r.intent) for r in add_adhoc(sel, extra(spark, rows)).orderBy("ord").collect()]


def test_adhoc_blank_and_defaults(spark):
    assert adhoc(spark, [], [("  ", None), ("", "x")]) == []
    assert adhoc(spark, [], [("license vs Token", None)]) == [("license vs Token", "adhoc")]
    assert adhoc(spark, [], [("license vs Token", "comparison"), (" Is license legit? ", "purchase")]) == [
        ("license vs Token", "comparison"), ("Is license legit?", "purchase")]


def test_adhoc_dedupes_and_drops_selected(spark):
    assert adhoc(spark, [], [("license vs Token", ""), ("license vs Token", "comparison")]) == [
        ("license vs Token", "adhoc")]
    assert adhoc(spark, ["license monitor"], [("license vs Token", "comparison"), ("license monitor", "")]) == [
        ("license vs Token", "comparison")]


def test_tag_topics_last_entry_wins_and_unknown(spark):
    topics = topics_frame(spark, [{"id": "a", "intent": "x", "query": "q1"}, {"id": "b", "intent": "y", "query": "q1"},
                                  {"id": "c", "intent": "z", "query": "q2"}])
    df = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "query string")
    got = {r.query: (r.intent, r.topic_id) for r in tag_topics(df, topics, broadcast=True).collect()}
    assert got == {"q1": ("y", "b"), "q2": ("z", "c"), "q3": ("unknown", "")}


def test_request_manifest(spark):
    prompts = spark.createDataFrame([("p1", "i", "t1"), ("p2", "i", "t2")], "prompt string, intent string, topic_id string")
    m = request_manifest(prompts, ["chatgpt", "perplexity"], 3)
    assert m.count() == 12
    assert sorted({r.run for r in m.collect()}) == [1, 2, 3]
    with pytest.raises(ValueError):
        request_manifest(prompts, ["chatgpt"], 0)


def test_selection_is_one_plan_at_any_length(spark):
    """No job runs while planning, no join compares labels with tokens, and a long list behaves like a short one."""
    tokens = ["gam", "1"] + [f"none{i}" for i in range(3000)] + ["9" * 30]
    df = select_catalog(catalog(spark, ["alpha", "beta", "gamma"]), tokens)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Join" not in plan
    assert [r.label for r in df.orderBy("sel_ord", "pos").collect()] == ["gamma", "alpha"]
    missed = unmatched_selectors(catalog(spark, ["alpha", "beta", "gamma"]), tokens)
    assert missed.count() == 3001 and missed.where(missed.token == "9" * 30).count() == 1


def test_read_topics_json_array_drops_topics_without_query(spark, tmp_path):
    import json
    from sourcelens.operators.catalog import read_topics
    p = tmp_path / "topics.json"
    p.write_text(json.dumps([{"id": "a", "intent": "brand_entity", "query": "license monitor"},
                             {"id": "b", "intent": "x"},
                             {"id": "c", "intent": "comparison", "query": "license vs Token"}], indent=2))
    t = read_topics(spark, str(p))
    assert [(r.id, r.query) for r in t.orderBy("seq").collect()] == [("a", "license monitor"),
                                                                     ("c", "license vs Token")]
    df = spark.createDataFrame([("license vs Token",)], "query string")
    assert tag_topics(df, t).first().topic_id == "c"


def test_load_config_and_rules(tmp_path):
    import json
    from sourcelens.plans.jobs import load_config, rules_from_config
    p = tmp_path / "config.json"
    p.write_text(json.dumps({"claim_patterns": {"b": ["x"], "a": ["y"]}, "owned_domains": ["example.net"]}))
    cfg = load_config(p)
    with pytest.raises(ValueError):
        rules_from_config(cfg)
    r = rules_from_config(cfg, brand="license")
    assert r.claim_names == ["b", "a"] and r.owned_domains == ("example.net",) and r.brand_lower == "license"


def test_a_table_of_selectors_selects_as_a_list_does(spark):
    import random
    from sourcelens.operators.catalog import select_by_table, unmatched_by_table
    rng = random.Random(4)
    labels = [" ".join(rng.choice(["Red", "blue", "ring", "bolt", "12", "ü", "é x", "nut"]) for _ in range(rng.randrange(1, 5))) for _ in range(300)] + ["", "only"]
    cat = catalog(spark, labels)
    for tokens in (["ring", " 7 ", "BLUE", "x", "nothing", "0", "9" * 30, "12", "g b", None, "  "], [], ["all"], [" * "], ["all", "red"], ["12"],
                   [f"t{i}" for i in range(500)] + ["only", "é"]):
        sel = spark.createDataFrame(list(enumerate(tokens)), "ord bigint, token string")
        got = sorted((r.sel_ord, r.pos, r.label) for r in select_by_table(cat, sel).collect())
        assert got == sorted((r.sel_ord, r.pos, r.label) for r in select_catalog(cat, tokens).collect())
        if tokens not in ([], ["all"], [" * "]):
            missed = sorted((r.ord, r.token) for r in unmatched_by_table(cat, sel).collect())
            assert missed == sorted((r.ord, r.token) for r in unmatched_selectors(cat, tokens).collect())


def test_repeated_labels_and_selectors_are_looked_up_once(spark, monkeypatch):
    from sourcelens.operators import catalog as c
    seen = []

    def counted(labels, names, *args):
        out = mentions(labels, names, *args)
        seen.append((labels.count(), names.count(), out.count()))
        return out

    mentions = c.catalog_mentions
    monkeypatch.setattr(c, "catalog_mentions", counted)
    cat = catalog(spark, ["Red ring", "red bolt", "Blue"] * 100 + [None])
    tokens = ["RING", "ing", " bolt", "nothing", "7"] * 40
    sel = spark.createDataFrame(list(enumerate(tokens)), "ord bigint, token string")
    got = sorted((r.sel_ord, r.pos, r.label) for r in c.select_by_table(cat, sel).collect())
    assert got == sorted((r.sel_ord, r.pos, r.label) for r in select_catalog(cat, tokens).collect())
    assert seen == [(4, 4, 3)]
    assert sorted(r.ord for r in c.unmatched_by_table(cat, sel).collect()) == [i for i, t in enumerate(tokens) if t == "nothing"]
