"""Language identification, quality, near-duplicate join, decontamination and the pipeline."""

import itertools
import random

import numpy as np
import pytest
from llm_cases import DE, EN, SCHEMA, sentence
from pyspark.sql import functions as F

from sourcelens.llm import crf_language, decontaminate, jaccard_join, pu_quality
from sourcelens.llm.components import components
from sourcelens.llm.queries import held_out


# ---- language -----------------------------------------------------------------------------------------------
def brute_posteriors(scores, transitions):
    n, k = scores.shape
    total = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        w = np.exp(sum(scores[i, s] for i, s in enumerate(path)) + transitions[:, path[0]].copy().dot(np.zeros(k))
                   + sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        w *= np.exp(transitions)[:, path[0]].sum()  # the word before the first has any language
        for i, s in enumerate(path):
            total[i, s] += w
    return total / total.sum(axis=1, keepdims=True)


def test_forward_backward_equals_enumeration(monkeypatch):
    rng = np.random.default_rng(1)
    scores, transitions = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    want = [brute_posteriors(scores[:6], transitions).sum(axis=0), np.zeros(3), brute_posteriors(scores[6:], transitions).sum(axis=0)]
    for chunk in (2, 4, 128):
        monkeypatch.setattr(crf_language, "CHUNK", chunk)
        assert np.allclose(crf_language.posterior_sums(scores, np.array([6, 0, 3]), transitions), want)


def test_language(docs, rows, none):
    got = crf_language.identify(docs.withColumn("score", F.lit("x")), ~held_out(5, 0)).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        if r["lang"] and letters and r["doc_id"] is not None and r["doc_id"] < 200:
            assert r["lang_pred"] == r["lang"] and r["score"] > 0.9
    assert crf_language.identify(none, ~held_out(5, 0)).count() == 0
    assert {r["lang_pred"] for r in crf_language.identify(docs.withColumn("lang", F.lit(None).cast("string")), ~held_out(5, 0)).collect()} == {"und"}


def test_repeated_rows_and_long_texts_thin_no_label(spark):
    rng = random.Random(4)
    once = spark.createDataFrame([(i, sentence(rng, EN, 20), "en") for i in range(300)], "doc_id bigint, text string, lang string")
    again = spark.range(400_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("the same row again").alias("text"), F.lit("en").alias("lang"))
    long = spark.createDataFrame([(1000 + i, "12 " * 8000 + sentence(rng, DE, 6000), "de") for i in range(3)], once.schema)
    found = crf_language.training_sample(once.unionByName(again).unionByName(long), "doc_id", "text", "lang")
    assert [lang for _, lang in found].count("en") == crf_language.SAMPLE_PER_LANGUAGE
    spans = [t for t, lang in found if lang == "de"]
    assert len(spans) == 3 and all(len(t) == crf_language.SAMPLE_CHARS and t[0].isalpha() for t in spans)


def test_code_switched_words_get_their_languages():
    rng = random.Random(2)
    model = crf_language.fit([(sentence(rng, w, 60), lang) for w, lang in ((EN, "en"), (DE, "de")) for _ in range(20)])
    share = model.shares([" ".join(EN) + " " + " ".join(DE[:5])])[0]
    assert abs(share[model.languages.index("en")] - 15 / 20) < 0.05


# ---- quality ------------------------------------------------------------------------------------------------
def test_quality(spark):
    rng = random.Random(9)
    texts = [sentence(rng, EN, 40) if i % 4 else "!! ".join(["buy"] * 30) + " ### " + str(i) for i in range(600)] + [None, ""]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x", 1)], "doc_id bigint, text string, predicted int")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 600, 2)] + [(4, None), (None, 1)], "doc_id bigint, quality int")
    model = pu_quality.fit_quality(docs, labels, pu_quality.learn_rows)
    got = {r["doc_id"]: r for r in pu_quality.score_quality(docs, model).collect()}
    assert len(got) == 603 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert np.mean([got[i]["predicted"] == int(i % 4 > 0) for i in range(600) if held(i)]) > 0.97
    assert pu_quality.fit_quality(docs, labels.limit(0), pu_quality.learn_rows) is None
    assert {r["score"] for r in pu_quality.score_quality(docs, None).collect()} == {0.5}


def held(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_nnpu_needs_no_negative_labels():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(1.5, 1, (400, 5)), rng.normal(-1.5, 1, (400, 5))
    model = pu_quality.fit_nnpu(pos[:200], np.concatenate([pos[200:], neg]), 1 / 3, steps=400)
    assert (model.margin(pos) > 0).mean() > 0.9 and (model.margin(neg) < 0).mean() > 0.9


# ---- near duplicates ----------------------------------------------------------------------------------------
def brute_components(rows, width, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]) and group[i] != group[j]:
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted((i is None, i or 0, len(s), -1 if i is None else least[g]) for (i, _), s, g in zip(rows, sets, group, strict=True))


def families(seed, n, size, edits):
    rng = random.Random(seed)
    out = []
    for f in range(n):
        base = [f"a{rng.randrange(300)}" for _ in range(size + f)]
        out.append(" ".join(base))
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], ["zz" + str(rng.randrange(99))], [w[at], "yy"]])
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width,threshold,cost", [(3, (90, 100), 4.0), (5, (80, 100), 4.0), (3, (90, 100), 0.0)])
def test_near_duplicates(spark, rows, monkeypatch, width, threshold, cost):
    monkeypatch.setattr(jaccard_join, "KEY_COST", cost)  # at 0 one-deletion keys are preferred wherever two sets share a key
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    texts = families(1, 3, 8, 2) + families(2, 3, 60, 4) + families(3, 2, 200, 9)
    own = [(i, t) for i, t, *_ in rows if i is not None] + [(1000 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in own], "doc_id bigint, text string, n int, digest string").repartition(3)
    got = sorted((False, r["doc_id"], r["n_shingles"], r["component_id"])
                 for r in jaccard_join.near_duplicates(df, width=width, threshold=threshold, rounds=1).collect())
    assert got == brute_components(own, width, *threshold)


def test_near_duplicates_odd_rows(spark, none):
    assert jaccard_join.near_duplicates(none).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (3, "q r s t u v w"), (1, None), (2, "")], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in jaccard_join.near_duplicates(df).collect())
    assert got == [(-1, 2, 3), (1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (3, 3, 3)]


def test_segments_keep_the_pigeonhole_promise():
    rng = np.random.default_rng(4)
    for num, den in ((90, 100), (80, 100), (1, 2)) * 3:
        for size in (1, 5, 12, 80, 700):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            b = a.copy()
            while True:
                c = np.delete(b, rng.integers(len(b))) if rng.random() < 0.5 and len(b) > 1 else np.unique(np.append(b, rng.integers(0, 2**63, dtype=np.uint64)))
                same = len(np.intersect1d(a, c))
                if den * same < num * (len(a) + len(c) - same):
                    break
                b = c
            table = jaccard_join.Bands(num, den)
            low = (1 << jaccard_join.HASH_BITS) - 1
            exact = [{k for k in jaccard_join.segment_keys(x, table) if k & low} for x in (a, b)]
            assert exact[0] & exact[1]
            merged = {i: list(range(m // 2)) for i, m in enumerate(table.segments)}
            single = {table.first[i] + m - 1 for i, m in enumerate(table.segments) if m % 2}  # the last of an odd number stays exact
            keys = [set(jaccard_join.segment_keys(x, table, merged)) | {k for k in e if k >> jaccard_join.HASH_BITS in single}
                    for x, e in zip((a, b), exact, strict=True)]
            assert keys[0] & keys[1]


def test_sketches_differ_hardly_less_than_the_sets():
    rng = np.random.default_rng(6)
    for n in (3, 60, 396, 5000, 70_000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for change in (0, 1, n // 9, n // 5, n):
            b = np.unique(np.concatenate([a[change:], rng.integers(0, 2**63, change, dtype=np.uint64)]))
            apart = 2 * change
            least = jaccard_join._least_difference(jaccard_join._sketch(a), jaccard_join._sketch(b))
            assert least <= apart
            if n < 10_000 and change <= n // 5:
                assert least >= apart - apart * apart / (4 * n) - 4 * apart**0.5 / 4 - 1
            if change == n:
                assert least > (2 * n) // 9  # nothing in common: no link at 80 of 100
    small, large = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (100, 5000))
    assert jaccard_join._least_difference(jaccard_join._sketch(small), jaccard_join._sketch(large)) <= 5100


def relatives(n=60, size=400, edits=8):
    """A family of which no two are alike enough, though they share many keys, and near copies of some."""
    rng = random.Random(11)
    base = [f"a{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for f in range(n):
        w = list(base)
        for at in rng.sample(range(size), edits):
            w[at] = f"b{f}x{at}"
        out.append(w)
    out += [[*w[:200], "changed", *w[201:]] for w in out[:10]]
    return [(i, " ".join(w)) for i, w in enumerate(out)]


def test_relatives_below_the_threshold_are_no_candidates(spark, monkeypatch):
    checked, exact = [], jaccard_join._linked
    monkeypatch.setattr(jaccard_join, "_linked", lambda pairs, *a: checked.append(pairs.count()) or exact(pairs, *a))
    rows = relatives()
    got = sorted((False, *r) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == brute_components(rows, 5, 80, 100)
    assert sum(checked) <= 40  # ten links; 70 * 69 / 2 pairs


def test_pairs_of_blocks_go_on_from_batch_to_batch(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rows = [(i, t) for i, t in enumerate(families(2, 3, 60, 4) + [t for _, t in relatives(12)])]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted((False, *r) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), rounds=1).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == brute_components(rows, 5, 80, 100)


def test_components_of_few_links_take_few_tasks(spark):
    keys = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    sc = spark.sparkContext
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40, 2)] + [(0, 7), (5, 30)], "a bigint, b bigint").coalesce(2)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few-tasks", "")
        assert components(links).count() == 40
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    track = sc.statusTracker()
    sizes = [track.getStageInfo(s).numTasks for j in track.getJobIdsForGroup("few-tasks") for s in track.getJobInfo(j).stageIds if track.getStageInfo(s)]
    assert len(sizes) > 5
    assert sum(n == 60 for n in sizes) < len(sizes) / 4, sorted(sizes)


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)] + [(700, 700 + i) for i in range(50)]
    group = {x: x for ab in links for x in ab}
    for _ in range(300):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: g for x, g in group.items() if any(a != b and x in (a, b) for a, b in links)}


# ---- decontamination ----------------------------------------------------------------------------------------
def slow_alignment(item, passage):
    h = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if item[i - 1] == passage[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = rng.integers(0, 4, rng.integers(1, 15)), rng.integers(0, 4, rng.integers(1, 25))
        assert decontaminate.align(a, b)[0] == slow_alignment(a, b)


def test_decontamination(spark):
    rng = random.Random(12)
    words = [f"word{i}" for i in range(500)] + ["the"] * 300
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(30)) for i in range(6)] + [(6, "too short"), (7, ""), (8, None), (0, None)]
    edited = items[1][1].split()
    edited[5], edited[15] = "other", "words"
    del edited[22]
    docs = [(i, text(200), i) for i in range(50)]
    docs += [(100, text(80) + " " + items[0][1].upper() + " " + text(50), 1), (101, text(50) + ", " + ", ".join(edited) + ". " + text(30), 1),
             (102, items[2][1] + "\n" + items[3][1], 1), (102, items[2][1] + "\n" + items[3][1], 1), (103, None, 1), (104, "", 1), (105, "It is Too  short!", 1),
             (106, " ".join(items[4][1].split()[:8]), 1), (None, items[5][1], 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int").repartition(3)
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(df, bench).collect()}
    assert set(got) == {(100, 0), (101, 1), (102, 2), (102, 3), (105, 6), (None, 5)}
    r = got[100, 0]
    assert r["score"] == 1 and docs[50][1][r["start"]:r["end"]] == items[0][1].upper()
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    # items in several blocks give the same
    assert {(r["doc_id"], r["item_id"]) for r in _in_blocks(df, bench)} == set(got)


def test_every_copy_within_the_threshold_is_found(monkeypatch):
    rng = np.random.default_rng(11)
    for hits in (7, decontaminate.HITS):
        monkeypatch.setattr(decontaminate, "HITS", hits)
        for _ in range(40):
            words = [f"w{i}" for i in range(int(rng.integers(5, 40)))]
            rows = [(i, " ".join(rng.choice(words, int(rng.integers(1, 30))))) for i in range(5)]
            items = decontaminate.Items(rows)
            doc = list(rng.choice(words, 60))
            for _, text in rows:
                copy = text.split()
                for at in reversed(range(int(rng.integers(0, 4)), len(copy), int(rng.integers(3, 6)))):
                    copy[at:at + 1] = [["zz"], [], [copy[at], "zz"]][int(rng.integers(3))]
                doc[(at := int(rng.integers(len(doc)))):at] = copy
            ids = np.array([items.vocab.get(w, -1) for w in doc], np.int64)
            want = {i: s for i, w in enumerate(items.words) if (s := decontaminate.align(w, ids)[0]) >= items.least[i]}
            assert {i: s for i, s, *_ in decontaminate._matches(items, ids)} == want


def test_hot_copies_hide_no_edited_copy(spark):
    item = [f"word{i}" for i in range(40)]
    edited, spread = list(item), [w for i, x in enumerate(item) for w in ([x, "new"] if i % 2 and i < 38 else [x])]
    edited[2] = edited[5] = "other"  # all of the first six 3-grams are gone
    docs = [(i, " ".join(item)) for i in range(200)] + [(500, " ".join(edited)), (501, " ".join(spread)), (502, " ".join(reversed(item)))]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id int, text string"))
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    assert set(scores) == {*range(200), 500, 501} and scores[500] == 36 / 40 and scores[501] == 21 / 40


def _in_blocks(df, bench):
    before, decontaminate.BLOCK_ITEMS = decontaminate.BLOCK_ITEMS, 2
    try:
        return decontaminate.contaminated(df, bench).collect()
    finally:
        decontaminate.BLOCK_ITEMS = before


# ---- pipeline -----------------------------------------------------------------------------------------------
def test_pipeline_tells_rows_apart_without_ids(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as cp
    rng = random.Random(21)
    alone = [sentence(rng, [f"w{i}" for i in range(300)], 40) for _ in range(5)]
    leak, copied = sentence(rng, [f"b{i}" for i in range(300)], 30), sentence(rng, [f"c{i}" for i in range(300)], 60)
    rows = [(None, copied), (None, copied), (None, copied + " more"), (9, copied), (1, copied + " end"),  # one group; 1 stays
            (9, alone[0]), (9, alone[1] + " " + leak), (None, alone[2] + " " + leak), (None, alone[3]), (9, alone[4]), (9, alone[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    order = lambda found: sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    near = cp.near_copies(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert near.columns == cp.COLUMNS
    assert order((r["doc_id"], r["text"]) for r in near.collect()) == order([rows[4], *rows[5:10]])
    clean = cp.benchmark_leaks(spark, near, str(tmp_path))
    assert clean.columns == cp.COLUMNS
    assert order((r["doc_id"], r["text"]) for r in clean.collect()) == order([rows[4], rows[5], rows[8], rows[9]])


def test_pipeline(spark, rows, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as cp
    leak = "a passage that only the benchmark should hold and nobody else has words like zebra quartz jigsaw vexing"
    extra = [(300, "the river and " + leak + " over the light of that stone", "en", "s", 1), (301, "the of password = \"abcdefgh12345678\" over the river", "en", "s", 1)]
    spark.createDataFrame(rows + extra, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [n for n, _ in cp.STAGES]
    assert len(names) == 5
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for i, (name, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
        assert i == 4 or docs.columns == cp.COLUMNS
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    first, second, third, fourth, last = kept.values()
    assert not {200, 201, 202, 203} & set(first) and {204, 205, 210, 300, 301} <= set(first)
    near = brute_components([(r["doc_id"], r["text"]) for r in first.values()], 5, 80, 100)
    assert {i for _, i, _, c in near if c == i} | {None} >= set(second) >= {i for _, i, _, c in near if c == i}
    assert 205 not in second and not {207, 208, 209} & set(second)
    assert set(second) - set(third) == {300}
    assert set(third) == set(fourth) and "abcdefgh12345678" not in fourth[301]["text"] and fourth[301]["n_chars"] == len(fourth[301]["text"])
    assert set(last) == set(fourth) and all(r["n_tokens"] > 0 for r in last.values())
    assert {tuple(r) for r in cp.run(spark, str(tmp_path)).select("doc_id", "ids_sha256").collect()} == {(r["doc_id"], r["ids_sha256"]) for r in last.values()}
