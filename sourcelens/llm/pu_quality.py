"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows, the unlabelled side is web text as it comes.  A small network is trained on
the non-negative unbiased risk: prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)]); when the second term
falls below zero its gradient is turned round.  The class prior is estimated from the trusted labels (the share of positives
among all labelled rows of the learning side).  Scores are then calibrated by a logistic curve on a bounded sample of
labelled rows, so that 0.7 means what a reader expects.

Features come from the whole text: the byte histogram (letters, digits, white space, each ASCII sign), words that repeat
their neighbour, distinct words and lines, lengths.

Defined cases: a null text is an empty one, which has all features at zero and gets a score like any other; without
positive labels every score is 0.5; repeated ids in the sample count once; of several labels the highest counts; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcelens.llm.common import map_rows

#: Rows drawn for fitting: labelled ones, and unlabelled ones, by hash of the id.
SAMPLE_LABELLED = 6_000
SAMPLE_UNLABELLED = 12_000
HIDDEN = 24
STEPS = 1500
PREDICT_FROM = 0.7

_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]


def features(text: str | None) -> list[float]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    if not len(raw):
        return [0.0] * N_FEATURES
    c = np.bincount(raw, minlength=256)
    words, lines = text.split(), text.split("\n")
    n, w = len(raw), max(1, len(words))
    upper, lower, digits = c[65:91].sum(), c[97:123].sum(), c[48:58].sum()
    beside = sum(map(str.__eq__, words, words[1:]))
    share = np.sqrt(c[_SIGNS] / n)
    return [upper / n, np.sqrt(upper / max(1, upper + lower)), lower / n, np.sqrt(digits / n), c[32] / n, np.sqrt(c[10] / n), c[128:].sum() / n,
            beside / w, len(set(words)) / w, len(set(words)) / w ** 0.8, len(set(lines)) / len(lines), np.log1p(len(words)) / 10, np.log1p(n) / 12,
            n / w / 10, float(w < 5), *share]


N_FEATURES = 15 + len(_SIGNS)


class Scorer:
    def __init__(self, mean, scale, w1, b1, w2, b2, slope=1.0, shift=0.0):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2, self.slope, self.shift = mean, scale, w1, b1, w2, b2, slope, shift

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.shift)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, rate: float = 0.01, l2: float = 1e-4) -> Scorer:
    """Sigmoid loss, Adam, mini-batches; beta = 0, gamma = 1."""
    rng = np.random.default_rng(11)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    d = p.shape[1]
    params = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]

    def gradients(x, out):
        h = np.tanh(x @ params[0] + params[1])
        g = h @ params[2] + params[3]
        s = _sigmoid(g)
        slope = out(s) * s * (1 - s)  # d loss / d g
        back = slope[:, None] * params[2] * (1 - h * h)
        return s, [x.T @ back / len(x), back.mean(axis=0), h.T @ slope / len(x), np.array([slope.mean()])]

    for t in range(1, steps + 1):
        bp, bu = p[rng.integers(0, len(p), 512)], u[rng.integers(0, len(u), 1024)]
        sp, as_positive = gradients(bp, lambda s: -np.ones_like(s))  # loss(+) = 1 - s
        su, u_negative = gradients(bu, lambda s: np.ones_like(s))  # loss(-) = s
        negative_risk = su.mean() - prior * sp.mean()
        grads = []
        for gp, gu, w in zip(as_positive, u_negative, params, strict=True):
            negative = gu + prior * gp  # of E_u[s] - prior * E_p[s]; gp is the gradient of -s
            grads.append((prior * gp + negative if negative_risk >= 0 else -negative) + l2 * w)
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            params[i] = params[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Scorer(mean, scale, params[0], params[1], params[2], float(params[3][0]))


def calibrate(model: Scorer, x: np.ndarray, y: np.ndarray) -> Scorer:
    """Slope and shift of a logistic curve through (margin, label), by Newton steps with smoothed targets."""
    g = model.margin(x)
    if y.min(initial=1) == y.max(initial=0):
        return model
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design, w = np.stack([g, np.ones_like(g)], 1), np.zeros(2)
    for _ in range(50):
        s = _sigmoid(design @ w)
        hess = (design * (s * (1 - s))[:, None]).T @ design + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, design.T @ (target - s) - 1e-3 * w), -5, 5)
    model.slope, model.shift = float(w[0]), float(w[1])
    return model


def _sampled(docs: DataFrame, ids: DataFrame, text: str) -> tuple[np.ndarray, list]:
    """Features and labels of the documents of a bounded list of (i, y)."""
    found = docs.join(F.broadcast(ids), docs["_id"] == ids["i"]).select("i", "y", F.col(text).alias("t"))
    once = map_rows(found, lambda c: {"i": c["i"], "y": c["y"], "x": [features(t) for t in c["t"]]}, "i bigint, y int, x array<double>") \
        .groupBy("i").agg(F.max("y").alias("y"), F.min("x").alias("x")).orderBy("i").collect()
    return np.array([r["x"] for r in once], float).reshape(len(once), N_FEATURES), [r["y"] for r in once]


def fit_quality(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text: str = "text", label: str = "quality",
                labelled: int = SAMPLE_LABELLED, unlabelled: int = SAMPLE_UNLABELLED) -> Scorer | None:
    """``learn(id column)`` says which rows' labels may be read."""
    own = docs.select(F.col(id_col).cast("bigint").alias("_id"), text).where(F.col("_id").isNotNull())
    trusted = (labels.select(F.col(id_col).cast("bigint").alias("i"), F.col(label).cast("int").alias("y"))
               .where(learn(F.col("i")) & F.col("y").isNotNull()).groupBy("i").agg(F.max("y").alias("y")))
    total, positives = trusted.agg(F.count("*"), F.sum("y")).first()
    if not positives:
        return None
    prior = min(0.98, max(0.02, positives / total))  # from all trusted labels
    x, y = _sampled(own, trusted.orderBy(F.xxhash64("i"), "i").limit(labelled), text)
    pool = own.select(F.col("_id").alias("i")).where(learn(F.col("_id"))).distinct().orderBy(F.xxhash64("i", F.lit(5)), "i").limit(unlabelled)
    u, _ = _sampled(own, pool.withColumn("y", F.lit(0)), text)
    y = np.array(y)
    if not (y == 1).any() or not len(u):
        return None
    return calibrate(fit_nnpu(x[y == 1], u, prior), x, y)


def score_quality(docs: DataFrame, model: Scorer | None, text: str = "text") -> DataFrame:
    """``docs`` plus score and predicted."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few kB
    kept = docs.drop("score", "predicted")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields) + "`score` double, `predicted` int"

    def run(columns):
        texts = columns[text]
        s = held.value.score(np.array([features(t) for t in texts]).reshape(-1, N_FEATURES)).tolist() if held.value else [0.5] * len(texts)
        return {**columns, "score": s, "predicted": [int(v >= PREDICT_FROM) for v in s]}

    return map_rows(kept, run, schema)


def learn_rows(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 4 != 2
