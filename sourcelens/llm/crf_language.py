"""Language identification by a linear-chain conditional random field over words.

Every word gets a language.  A word's score for a language adds weights of its character n-grams (2 and 3), its
affixes (the same with word boundaries, up to 3 letters) and its entry in the lexicon of words met in training; neighbours are
tied by learned transition weights.  Training maximises the conditional likelihood of a bounded sample of labelled texts whose words
are rearranged into code-switched runs, so that transitions between languages are seen.  Prediction runs forward-backward over all
words of a text; the summed word posteriors give the text's language, and its share is the score.  Long texts
are cut into chunks whose transfer matrices are chained, which is the same sum, exactly.

Defined cases: a null text and one without letters are ``und`` with score 0, as is everything if no row has a label; case
doesn't count; ties go to the language that sorts first; of repeated training ids the smallest text counts; extra columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sourcelens.llm.common import cut, map_rows

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: The model is fitted on at most so many labelled texts of each language, and on so many characters of each from its first letter on.
SAMPLE_PER_LANGUAGE = 150
SAMPLE_CHARS = 20_000
BUCKETS = 1 << 16
ITERATIONS = 40
CHUNK = 128
#: Words whose scores a Python worker remembers; the memo is cleared when full.
MEMO = 400_000


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(starts of words, feature of each place and order or -1) over the words written one after the other with boundary signs."""
    flat = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03\x03\x03\x03").encode("utf-32-le"), np.uint32).astype(np.int64)
    n = len(flat) - 3
    a, b, c, d = (flat[i:i + n] for i in range(4))
    two = (a * 1_000_003 + b) * 31 % BUCKETS
    three = ((a * 1_000_003 + b) * 1_000_003 + c) * 37 % BUCKETS
    four = (((a * 1_000_003 + b) * 1_000_003 + c) % (1 << 40) * 8191 + d) * 41 % BUCKETS
    in2, in3 = a != 3, (a != 3) & (b != 3)
    in4 = in3 & (c != 3) & ((a == 2) | (d == 3))  # longer ones only as affixes
    grams = np.stack([np.where(in2, two, -1), np.where(in3, three + BUCKETS, -1), np.where(in4, four + 2 * BUCKETS, -1)])
    return np.flatnonzero(a == 2), grams


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray  # (3 * BUCKETS + 1, languages); the last row is zero
    lexicon: dict[str, int]
    lexical: np.ndarray  # (words of the lexicon + 1, languages); the last row is zero
    transitions: np.ndarray
    memo: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None

    def emissions(self, words: list[str]) -> np.ndarray:
        starts, grams = _grams(words)
        total = self.weights[grams[0]] + self.weights[grams[1]] + self.weights[grams[2]]
        return np.add.reduceat(total, starts, axis=0) + self.lexical[[self.lexicon.get(w, -1) for w in words]]

    def remembered(self, words: list[str]) -> np.ndarray:
        """Places of the words in ``scores``; -1 for words without a letter."""
        new = set(words).difference(self.memo)
        if new:
            if self.scores is None or len(self.memo) + len(new) > len(self.scores):
                self.memo.clear()
                new = set(words)
                if self.scores is None or len(new) > len(self.scores):
                    self.scores = np.zeros((max(MEMO, len(new)), len(self.languages)), np.float32)
            real = sorted(w for w in new if any(map(str.isalpha, w)))
            if real:
                at = len(self.memo)
                self.scores[at:at + len(real)] = self.emissions(real)
                self.memo.update(zip(real, range(at, at + len(real)), strict=True))
            self.memo.update((w, -1) for w in new.difference(real))
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def shares(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Each text's share of words per language, or None."""
        words = [WORD.findall((t or "").lower()) for t in texts]
        at = self.remembered([w for own in words for w in own])
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in words])[at >= 0]
        at = at[at >= 0]
        counts = np.bincount(owner, minlength=len(texts))
        sums = posterior_sums(self.scores[at], counts, self.transitions) if len(at) else np.zeros((len(texts), len(self.languages)))
        return [s / n if n else None for s, n in zip(sums, counts, strict=True)]


def posterior_sums(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over sequences that stand one after the other in ``scores``; the sum of each one's word posteriors.

    Sequences become chunks of ``CHUNK`` words.  A padded word has the identity as its matrix and adds nothing."""
    k = scores.shape[1]
    chunks = -(-counts // CHUNK)
    first = np.concatenate([[0], np.cumsum(chunks)])
    n = int(first[-1])
    local = np.arange(len(scores)) - np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    row, col = np.repeat(first[:-1], counts) + local // CHUNK, local % CHUNK
    psi = np.zeros((CHUNK, n, k))
    psi[col, row] = np.exp(scores - scores.max(axis=1, keepdims=True))
    real = np.zeros((CHUNK, n, 1), bool)
    real[col, row] = True
    step = np.exp(transitions - transitions.max())

    product = np.broadcast_to(np.eye(k), (n, k, k)).copy()  # of a chunk's matrices
    for t in range(CHUNK):
        nxt = (product @ step) * psi[t][:, None, :]
        nxt /= np.maximum(nxt.max(axis=(1, 2), keepdims=True), 1e-300)
        product = np.where(real[t][:, :, None], nxt, product)
    enter, leave = np.full((n, k), 1.0 / k), np.ones((n, k))
    for j in range(1, int(chunks.max(initial=0))):
        at = first[:-1][chunks > j] + j
        v = np.einsum("nk,nkl->nl", enter[at - 1], product[at - 1])
        enter[at] = v / v.sum(axis=1, keepdims=True)
    for j in range(int(chunks.max(initial=0)) - 2, -1, -1):
        at = first[:-1][chunks > j + 1] + j
        v = np.einsum("nkl,nl->nk", product[at + 1], leave[at + 1])
        leave[at] = v / v.max(axis=1, keepdims=True)

    alpha = np.empty((CHUNK, n, k))
    v = enter
    for t in range(CHUNK):
        w = (v @ step) * psi[t]
        w /= np.maximum(w.sum(axis=1, keepdims=True), 1e-300)
        v = alpha[t] = np.where(real[t], w, v)
    total, beta = np.zeros((n, k)), leave
    for t in range(CHUNK - 1, -1, -1):
        p = alpha[t] * beta
        p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
        total += np.where(real[t], p, 0)
        b = (beta * psi[t]) @ step.T
        b /= np.maximum(b.max(axis=1, keepdims=True), 1e-300)
        beta = np.where(real[t], b, beta)
    out = np.zeros((len(counts), k))
    np.add.at(out, np.repeat(np.arange(len(counts)), chunks), total)
    return out


def _switched(texts: list[tuple[str, int]], rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Words and labels of all texts as one stream: texts in random order, cut into runs, a quarter of which change places."""
    runs = []
    for i in rng.permutation(len(texts)):
        words = WORD.findall(texts[i][0].lower())
        at = 0
        while at < len(words):
            size = int(rng.integers(4, 60))
            runs.append((words[at:at + size], texts[i][1]))
            at += size
    moved = np.flatnonzero(rng.random(len(runs)) < 0.25)
    order = np.arange(len(runs))
    order[moved] = rng.permutation(moved)
    words = [w for i in order for w in runs[i][0]]
    return words, np.repeat([runs[i][1] for i in order], [len(runs[i][0]) for i in order]).astype(np.int64)


def fit(texts: list[tuple[str, str]], iterations: int = ITERATIONS, rate: float = 0.4, l2: float = 1e-5) -> Crf:
    """Conditional likelihood by full-batch AdaGrad over (text, language) pairs."""
    languages = sorted({lang for _, lang in texts})
    k = len(languages)
    words, labels = _switched([(t, languages.index(lang)) for t, lang in texts], np.random.default_rng(7))
    types, counts = np.unique(np.array(words, dtype=object), return_counts=True)
    lexicon = {w: i for i, w in enumerate(types[counts >= 5])}
    model = Crf(languages, np.zeros((3 * BUCKETS + 1, k)), lexicon, np.zeros((len(lexicon) + 1, k)), np.zeros((k, k)))
    if k < 2 or not words:
        return model
    place = {w: i for i, w in enumerate(types)}
    ids = np.array([place[w] for w in words])
    n = len(ids) // CHUNK if len(ids) >= CHUNK else 1
    length = min(CHUNK, len(ids))
    ids, labels = ids[:n * length].reshape(n, length).T, labels[:n * length].reshape(n, length).T  # the rest of a chunk is left out
    starts, grams = _grams(list(types))
    lex = np.array([lexicon.get(w, -1) for w in types])
    total = len(words)
    del words, place
    size = np.diff(np.append(starts, grams.shape[1]))
    onehot = np.eye(k)
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (labels[:-1].ravel(), labels[1:].ravel()), 1)
    slots = [model.weights, model.lexical, model.transitions]
    squares = [np.full_like(s, 1e-8) for s in slots]
    for _ in range(iterations):
        places = model.weights[grams[0]]  # one order after the other: the driver holds few large arrays at a time
        for order in grams[1:]:
            places += model.weights[order]
        psi = (np.add.reduceat(places, starts, axis=0) + model.lexical[lex])[ids]
        del places
        psi -= psi.max(axis=2, keepdims=True)
        np.exp(psi, out=psi)
        step = np.exp(model.transitions - model.transitions.max())
        alpha, beta = np.empty_like(psi), np.empty_like(psi)
        v = np.full((n, k), 1.0 / k)
        for t in range(length):
            v = (v @ step) * psi[t]
            v /= v.sum(axis=1, keepdims=True)
            alpha[t] = v
        v = beta[-1] = np.ones((n, k))
        for t in range(length - 1, 0, -1):
            v = (v * psi[t]) @ step.T
            v /= v.max(axis=1, keepdims=True)
            beta[t - 1] = v
        pairs = np.zeros((k, k))
        for t in range(1, length):
            pair = alpha[t - 1, :, :, None] * step * (psi[t] * beta[t])[:, None, :]
            pairs += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        post = np.multiply(alpha, beta, out=alpha)
        post /= post.sum(axis=2, keepdims=True)
        by_type = np.zeros((len(types), k))
        np.add.at(by_type, ids.ravel(), (onehot[labels] - post).reshape(-1, k))
        del psi, alpha, beta, post
        spread = np.repeat(by_type, size, axis=0)
        up = [np.zeros_like(s) for s in slots]
        for order in grams:
            ok = order >= 0
            for j in range(k):
                up[0][:, j] += np.bincount(order[ok], spread[ok, j], len(model.weights))
        np.add.at(up[1], lex, by_type)
        up[1][-1] = 0
        up[2] = seen_pairs - pairs
        for s, u, q in zip(slots, up, squares, strict=True):
            u -= l2 * total * s
            q += u * u
            s += rate * u / np.sqrt(q)
    model.weights = model.weights.astype(np.float32)
    return model


def training_sample(labelled: DataFrame, id_col: str, text: str, lang: str, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most ``per_language`` texts of each label, those whose distinct ids hash lowest; of a long text the span of
    ``SAMPLE_CHARS`` characters from its first letter on."""
    fits = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    # written once: the distinct ids of each label, without texts
    ids = cut(fits.select(F.col(id_col).alias("i"), F.col(lang).alias("l"), F.pmod(F.xxhash64(id_col, F.lit(2)), F.lit(1 << 30)).alias("h")).distinct())
    # of a frequent label only about eight times the sample is ranked, so ranking is small however many ids there are
    top = F.lit(8.0 * per_language * (1 << 30)) / F.col("c")
    share = ids.groupBy("l").agg(F.count("*").alias("c")).select(F.col("l").alias("k"), "c", top.alias("top"))
    near = ids.join(F.broadcast(share), ids["l"] == share["k"]).where("h < top")  # one row per label
    # a label with fewer ids than asked for under its threshold has all its ids ranked
    under = near.groupBy("k").agg(F.count("*").alias("m"))
    short = [r["k"] for r in share.join(under, "k", "left").where(F.coalesce("m", F.lit(0)) < F.least("c", F.lit(per_language))).select("k").collect()]
    if short:
        near = near.where(~F.col("l").isin(short)).select("i", "l", "h").unionByName(ids.where(F.col("l").isin(short)))
    hashed = near.select("i", "l", "h").withColumn("n", F.row_number().over(W.partitionBy("l").orderBy("h", "i")))
    chosen = hashed.where(F.col("n") <= per_language).select("i", "l")
    span = F.when(F.length(text) <= SAMPLE_CHARS, F.col(text)).otherwise(F.substring(F.regexp_replace(text, r"^\P{L}++", ""), 1, SAMPLE_CHARS))
    rows = (fits.join(F.broadcast(chosen), (fits[id_col] == chosen["i"]) & (fits[lang] == chosen["l"]))
            .groupBy("i", "l").agg(F.min(span).alias("t")).orderBy("l", "i").collect())  # bounded by the sample
    return [(r["t"], r["l"]) for r in rows]


_LOADED: dict[str, Crf] = {}


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
             per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``docs`` plus lang_pred and score.  Labels are read only from rows of ``learn``."""
    spark = docs.sparkSession
    model = fit(training_sample(docs.where(learn), id_col, text, lang, per_language))
    held = spark.sparkContext.broadcast(model)  # bounded: hashed weights and a lexicon of the sample
    key = f"{spark.sparkContext.applicationId}-{held._jbroadcast.id()}"
    kept = docs.drop("lang_pred", "score")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields) + "`lang_pred` string, `score` double"

    def run(columns):
        if key not in _LOADED:  # the memo of words lives as long as the Python worker works for this model
            _LOADED.clear()
            _LOADED[key] = held.value
        crf = _LOADED[key]
        names, scores = [], []
        for s in crf.shares(columns[text]) if crf.languages else [None] * len(columns[text]):
            names.append(UNDETERMINED if s is None else crf.languages[int(s.argmax())])
            scores.append(0.0 if s is None else min(1.0, float(s.max())))
        return {**columns, "lang_pred": names, "score": scores}

    return map_rows(kept, run, schema, rows=512)
