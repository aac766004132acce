"""Text quality by positive-unlabelled learning with a non-negative risk.

Trusted positives P and unlabelled text U are told apart by the risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` (Kiryo et al., 2017): the second term estimates the risk on
the unseen negatives, and a step that would drive it below zero is not taken, so the model cannot overfit the
positives it knows. The class prior is the share of label 1 among the labelled rows that may be learnt.

A text's style is compared with that of the positives: how far each feature lies above and below their mean. No weight of such
a distance may be positive, so a text that is farther from the positives in any respect, such as one word said over and over,
never scores higher for it.

All positives and all documents without a learnable label take part. Their features are written to the shared folder once;
with the logistic loss the risk is convex, and each Newton step is a few hundred sums over that table, added up by
Spark in decimals, so no order of tasks changes them. The driver solves for a step of ``2 * FEATURES + 1`` numbers. Scoring
covers every whole text and needs no shuffle. A score depends on the text alone.

NULL and empty texts have all features zero and get the score of that point. Texts of any length are read whole. Repeated rows
count and score as often as they are there; of several labels of one document the highest counts. Documents without a key are
scored, not learnt from. An empty table gives an empty result; without learnable positives every score is the prior (0.5 if
nothing is labelled). Columns named as a result are replaced, others are kept, and none but key and text is read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick, shared_folder, with_results

STEPS = 30
DECAY = 1e-4
SHRINK = (1.0, 0.5, 0.25, 0.125, 1 / 16, 1 / 64)  # parts of a step, the largest that lowers the risk is taken
CLOSE = 1e-6

BYTES = np.arange(256)
LETTER = ((BYTES | 32) >= ord("a")) & ((BYTES | 32) <= ord("z")) | (BYTES >= 128)
UPPER = (BYTES >= ord("A")) & (BYTES <= ord("Z"))
DIGIT = (BYTES >= ord("0")) & (BYTES <= ord("9"))
SPACE = np.isin(BYTES, list(b" \t\r\n"))
PLAIN = np.isin(BYTES, list(b".,;:'\"?-()"))
SYMBOL = ~(LETTER | DIGIT | SPACE | PLAIN) & (BYTES > 32)
FEATURES = 14


def features(text: str | None) -> np.ndarray:
    """Style of one whole text: shares of kinds of characters, word shape and repetition, all about 0 to 1."""
    out = np.zeros(FEATURES)
    words = (text or "").split()
    if not words:
        return out
    data = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    ink = max(1, len(data) - int(counts[SPACE].sum()))
    letters = int(counts[LETTER].sum())
    n = len(words)
    kinds = Counter(words)
    repeated = sum(map(eq, words, words[1:]))
    upper = int(counts[UPPER].sum())
    out[:] = (
        letters / ink,
        upper / max(1, letters),
        int(counts[DIGIT].sum()) / ink,
        np.sqrt(int(counts[SYMBOL].sum()) / ink),
        np.sqrt(int(counts[ord("!")]) / n),
        min(1.0, int(counts[PLAIN].sum()) / n),
        min(1.0, int(counts[ord("|")]) / n),
        np.sqrt(repeated / n),
        len(kinds) / n,
        max(kinds.values()) / n,
        min(1.0, ink / n / 12),
        min(1.0, np.log1p(n) / 10),
        min(1.0, int(counts[10]) / n * 5),
        min(1.0, int(counts[ord(".")]) / n * 4),
    )
    return out


def expand(z: np.ndarray) -> np.ndarray:
    """How far each feature lies above and below that of trusted positives, damped, and a constant.

    Rare kinds of poor text then lie in the same direction as common ones.
    """
    return np.hstack([np.log1p(np.maximum(z, 0)), np.log1p(np.maximum(-z, 0)), np.ones((len(z), 1))])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(expand((x - self.mean) / self.scale) @ self.weights, -30, 30)
        return 1 / (1 + np.exp(-z))


def constant(score: float) -> Model:
    weights = np.zeros(2 * FEATURES + 1)
    score = min(max(score, 1e-6), 1 - 1e-6)
    weights[-1] = np.log(score / (1 - score))
    return Model(np.zeros(FEATURES), np.ones(FEATURES), weights)


def _added(table: DataFrame, sums: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``sums(x, known)`` of each batch, a vector of any fixed length."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, FEATURES)
            value = sums(x, batch["known"].to_numpy(zero_copy_only=False))
            total = value if total is None else total + value
        if total is not None:
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["k", "v"])

    rows = table.mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum(F.col("v").cast("decimal(28,9)")).alias("v")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r.k] = float(r.v)
    return out


def _risk(sums: np.ndarray, prior: float) -> tuple[float, float]:
    """(risk on positives taken as such, estimated risk on the unseen negatives) from sums of losses and counts."""
    p_plus, p_minus, u_minus, n_p, n_u = sums
    return prior * p_plus / n_p, u_minus / n_u - prior * p_minus / n_p


def _losses(z: np.ndarray, known: np.ndarray) -> np.ndarray:
    minus = np.logaddexp(0, z)
    return np.array([np.logaddexp(0, -z[known]).sum(), minus[known].sum(), minus[~known].sum(), known.sum(), (~known).sum()], float)


def _step(w: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """The minimum of the quadratic model at ``w`` where only the last weight, the constant, may be positive."""
    at = w.copy()
    for _ in range(500):
        before = at.copy()
        for k in range(len(w)):
            slope = gradient[k] + hessian[k] @ (at - w)
            at[k] -= slope / hessian[k, k]
            if k < len(w) - 1:
                at[k] = min(at[k], 0.0)
        if np.abs(at - before).max() < 1e-9:
            break
    return at - w


def fit(table: DataFrame, prior: float) -> Model:
    """Minimise the risk over rows (known, x): trusted positives (known) and unlabelled documents."""
    n = FEATURES
    first = _added(table, lambda x, known: np.concatenate(([known.sum(), (~known).sum()], x[known].sum(0), (x[known] ** 2).sum(0))))
    if not len(first) or not first[0]:
        return constant(prior)
    prior = min(max(prior, 0.01), 0.99)
    mean = first[2 : 2 + n] / first[0]
    scale = np.sqrt(np.maximum(first[2 + n :] / first[0] - mean**2, 0)) + 0.01
    alone = not first[1]  # no unlabelled text: the positives stand for it

    def curves(x: np.ndarray, known: np.ndarray, w: np.ndarray) -> np.ndarray:
        e = expand((x - mean) / scale)
        p, u = e[known], e if alone else e[~known]
        s = 1 / (1 + np.exp(-np.clip(u @ w, -30, 30)))
        return np.concatenate((p.sum(0), (u * s[:, None]).sum(0), ((u * (s * (1 - s))[:, None]).T @ u).ravel()))

    def losses(x: np.ndarray, known: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        z = np.clip(expand((x - mean) / scale) @ candidates.T, -30, 30)
        if alone:
            known = np.repeat([True, False], len(known))
            z = np.vstack((z, z))
        return np.concatenate([_losses(column, known) for column in z.T])

    size = 2 * n + 1
    w, best = np.zeros(size), math.inf
    n_p, n_u = first[0], first[0] if alone else first[1]
    for _ in range(STEPS):
        sums = _added(table, lambda x, known, w=w: curves(x, known, w))
        gradient = sums[size : 2 * size] / n_u - prior * sums[:size] / n_p + DECAY * w
        hessian = sums[2 * size :].reshape(size, size) / n_u + (DECAY + 1e-6) * np.eye(size)
        step = _step(w, gradient, hessian)
        tried = np.array([w + part * step for part in SHRINK])
        risks = _added(table, lambda x, known, tried=tried: losses(x, known, tried)).reshape(len(tried), 5)
        if not np.isfinite(best):
            best = sum(_risk(_at_zero(n_p, n_u), prior))
        for candidate, sums in zip(tried, risks, strict=True):
            positive, negative = _risk(sums, prior)
            risk = positive + negative + DECAY / 2 * float(candidate @ candidate)
            if negative >= 0 and risk < best:
                break
        else:
            break
        w, gain, best = candidate, best - risk, risk
        if gain < CLOSE:
            break
    return Model(mean, scale, w)


def _at_zero(n_p: float, n_u: float) -> np.ndarray:
    return np.array([math.log(2) * n_p, math.log(2) * n_p, math.log(2) * n_u, n_p, n_u])


def features_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([features(t.as_py()).tolist() for t in batch], type=pa.list_(pa.float64()))

    return extract(text)


def score_column(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch]).reshape(-1, FEATURES)
            yield pa.array(model.scores(x), type=pa.float64())

    return score(text)


def held_out(key: Column) -> Column:
    """True for ids whose label may not be learnt."""
    return F.coalesce(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on labels (doc_id, quality) of rows that are not held out and on documents without such a label."""
    label = pick(labels, key="doc_id", quality="quality").where(
        F.col("key").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("key"))
    )
    prior = label.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    if prior is None:
        return constant(0.5)
    docs = pick(documents, key="doc_id", text="text").where("key is not null")
    rows = docs.select("key", features_column(F.col("text")).alias("x"))
    told = label.groupBy("key").agg(F.max("quality").alias("quality"))
    rows = rows.join(told, "key", "left").where("quality is null or quality = 1")
    path = f"{shared_folder(documents.sparkSession)}/features"
    rows.select(F.col("quality").isNotNull().alias("known"), "x").write.parquet(path)
    return fit(documents.sparkSession.read.schema("known boolean, x array<double>").parquet(path), prior)


def score_documents(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on). Columns of these names are replaced."""
    scored = with_results(df, score=score_column(F.col(f"`{text}`"), model))
    return with_results(scored, predicted=(F.col("score") >= 0.5).cast("int"))
