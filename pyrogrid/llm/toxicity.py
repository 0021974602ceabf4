"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; unlabelled texts, which hold an unknown part of toxic ones,
stand in for everything else.  The risk of a classifier g with loss l and class prior p is

    p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])

and is minimised by gradient steps; where the second term would fall below zero, the step goes back up
that term only, which keeps it from fitting the positives hidden in the unlabelled part.  The classifier
is linear over hashed words and word beginnings, those that tell the two samples apart.

Both samples are bounded, each by itself (``max_positive``, ``max_unlabelled`` distinct texts, chosen by a hash of the text, texts over
``max_chars`` left aside, and ``max_slots`` features in all); the prior is the share of toxic ones among the distinct labelled training
texts; every row is scored whole, very long ones too.

Defined results: null and empty texts have no features and get the score of the bias alone; rows without a label are not learned from as
labelled ones; ties and repeated rows get equal scores; an empty table gives an empty result; without confirmed toxic rows every score
is 0; columns beside id, text and label are not read and may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

WORD = re.compile(r"[^\W\d_]+")
SLOTS = 1 << 20
#: Lengths of the word beginnings that are features beside the word.
BEGINNINGS = (4, 5, 6)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct slots of a text's words and word beginnings."""
    found: set[str] = set()
    for w in set(WORD.findall((text or "").lower())):
        found.add(w)
        for n in BEGINNINGS:
            if len(w) >= n:
                found.add(w[:n] + "-")
    return np.unique(np.fromiter((zlib.crc32(f.encode("utf-8", "surrogatepass")) % SLOTS for f in found), np.int64, len(found)))


@dataclass
class Classifier:
    """score = sigmoid(bias + sum of the weights of the slots that a text has)."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.dense = np.zeros(SLOTS, np.float32)
        self.dense[self.slots] = self.weights

    def score(self, texts: list[str | None]) -> np.ndarray:
        raw = np.array([self.bias + float(self.dense[features(t)].sum(dtype=np.float64)) for t in texts])
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40)))


def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.zeros(0, np.int64)])


def select_slots(positive: list[np.ndarray], unlabelled: list[np.ndarray], z: float, most: int) -> np.ndarray:
    """Slots more frequent among the positives than among the unlabelled by z standard errors; the most telling ones."""
    n, m = len(positive), len(unlabelled)
    p = np.bincount(flat(positive)[1], minlength=SLOTS)
    u = np.bincount(flat(unlabelled)[1], minlength=SLOTS)
    pooled = (p + u) / (n + m)
    err = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n + 1 / m))
    tells = (p / n - u / m) / err
    chosen = np.flatnonzero((tells >= z) & (p >= 3) & (p / n >= 2 * u / m))
    return np.sort(chosen[np.argsort(-tells[chosen], kind="stable")[:most]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def risk(theta: np.ndarray, p_doc: np.ndarray, p_slot: np.ndarray, u_doc: np.ndarray, u_slot: np.ndarray, n: int, m: int, prior: float) -> tuple[float, float, np.ndarray]:
    """The two terms of the risk with the logistic loss, and the slope of a step: of their sum, or, where the second is negative, up that term.

    theta: weights of the slots, then the bias; documents (n positive, m unlabelled) as pairs of document and slot.
    """
    k = len(theta) - 1
    gp, gu = theta[k] + np.bincount(p_doc, theta[p_slot], n), theta[k] + np.bincount(u_doc, theta[u_slot], m)
    positive, negative = prior * np.logaddexp(0, -gp).mean(), np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    sp, su = _sigmoid(gp), _sigmoid(gu)
    # slopes by the outputs of the classifier
    op, ou = -prior * sp / n, su / m
    op, ou = (op - prior * (1 - sp) / n, ou) if negative >= 0 else (-op, -ou)
    return positive, negative, np.append(np.bincount(p_slot, op[p_doc], k) + np.bincount(u_slot, ou[u_doc], k), op.sum() + ou.sum())


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, z: float = 8.0, most: int = 4096, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> Classifier:
    """Minimise the non-negative risk with the logistic loss by Adam over whole-sample gradients."""
    if not positive or not unlabelled:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), -40.0)
    slots = select_slots(positive, unlabelled, z, most)
    place = np.full(SLOTS, -1)
    place[slots] = np.arange(len(slots))

    def chosen(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        doc, slot = flat(rows)
        at = place[slot]
        return doc[at >= 0], at[at >= 0]

    (pd, pf), (ud, uf) = chosen(positive), chosen(unlabelled)
    n, m, k = len(positive), len(unlabelled), len(slots)
    theta, one, two = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    theta[k] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        grad = risk(theta, pd, pf, ud, uf, n, m, prior)[2]
        grad[:k] += decay * theta[:k]
        one, two = 0.9 * one + 0.1 * grad, 0.999 * two + 0.001 * grad**2
        theta -= rate * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.999**t)) + 1e-9)
    return Classifier(slots, theta[:k], float(theta[k]))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 4000, max_unlabelled: int = 12_000, max_chars: int = 200_000, max_slots: int = 16_000_000) -> Classifier:
    """Fit from docs (doc_id, text) and labels (doc_id, toxic), both of the training fold alone."""
    marked = labels.filter(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").alias("id"), "text").filter(F.length("text") <= max_chars).withColumn("h", F.xxhash64("text"))
    # copies count once: a group of them would be in a draw by hash as a whole, or not at all
    known = texts.select("id", "h").join(marked, "id").groupBy("h").agg(F.max("toxic").alias("toxic"))
    counts = known.agg(F.count("*").alias("n"), F.sum(F.col("toxic")).alias("k")).first()
    n, k = counts["n"], counts["k"] or 0
    if not k:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), -40.0)
    total = texts.select("h").distinct().count()
    prior = min(0.9, max(1e-4, k / n))
    parts = 1_000_000
    part = F.pmod("h", F.lit(parts))
    share = lambda most, of: min(parts, 1 + most * parts // max(1, of))
    once = lambda rows: rows.groupBy("h").agg(F.first("text").alias("text"))
    toxic = once(texts.filter(part < share(max_positive, k)).join(marked.filter("toxic = 1"), "id", "left_semi"))
    others = once(texts.filter(part >= parts - share(max_unlabelled, total)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots = [features(t).astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in slots], pa.binary())], names=["h", "slots"])

    def sample(rows: DataFrame, most: int) -> list[np.ndarray]:
        # ordered, so that the same rows give the same classifier; twice the expected number bounds what comes
        got, left = [], max_slots
        for r in small_batches(rows).select("h", "text").mapInArrow(run, "h long, slots binary").orderBy("h").limit(2 * most).select("slots").toLocalIterator():
            left -= len(r["slots"]) // 4
            if left < 0:
                break
            got.append(np.frombuffer(r["slots"], np.int32))
        return got

    return fit(sample(toxic, max_positive), sample(others, max_unlabelled), prior)


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id as doc_id and the score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.slots, model.weights, model.bias))
    kept: list[Classifier] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Classifier(*shared.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept[0].score(b.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
