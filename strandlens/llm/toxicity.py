"""Toxicity scores: logistic regression over hashed word n-grams and skip-grams, learnt by FTRL-proximal.

Features are the distinct words (lower-cased in ASCII, split at everything but
letters and digits) and their stems, pairs of neighbours, and pairs with one
word between them, hashed to ``2**BITS`` coordinates.  Each coordinate has its own learning rate;
the L1 term leaves most weights exactly zero, so the model is a short list of
(coordinate, weight) that is sent to every worker.

The sample to learn from is bounded: ``PER_CLASS`` labelled documents of either
label outside the held-out fold.  It is read by one task, as features.

Nulls and edge cases: a null text is empty; texts without words get the score of
the intercept alone.  Without labels of both kinds every score is 0.5.
Repeated rows stay separate rows; extra columns are ignored; null ids are
scored and not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, sample_ids
from .shared import id_and_text
from .textkernel import SIGNS, Words, mix64, range_hashes, slices

BITS = 20
#: Stems: the first so many bytes of longer words, which let a form of a word that wasn't seen share weight with those that were.
STEMS = (4, 5, 6, 7, 8)
PER_CLASS = 2500
FOLDS, HELD = 3, 1
THRESHOLD = 0.7


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the learner."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 1.0
    epochs: int = 8
    most_weight: float = 4.0


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, coordinate) of every word, stem, pair and skip pair of a slice, with repeats."""
    words = Words(data, offsets, lower=True, separators=SIGNS)
    h = words.hashes()
    doc = np.repeat(np.arange(len(offsets) - 1), words.counts())
    docs, keys = [doc], [h]
    size = words.ends - words.starts
    for k in STEMS:
        long = size > k
        keys.append(range_hashes(words.data, words.starts[long], words.starts[long] + k))
        docs.append(doc[long])
    for gap in (1, 2):
        if len(h) > gap:
            same = doc[:-gap] == doc[gap:]
            keys.append(mix64(h[:-gap][same] * np.uint64(2 * gap + 1) + h[gap:][same] + np.uint64(gap)))
            docs.append(doc[:-gap][same])
    return np.concatenate(docs), (np.concatenate(keys) >> np.uint64(64 - BITS)).astype(np.int64)


def learn(examples: list[tuple[np.ndarray, int]], p: Ftrl, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, intercept); each example is its distinct coordinates and its label."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias, bias_n = 0.0, 1.0
    rng = np.random.default_rng(seed)
    positive = sum(label for _, label in examples)
    weigh = (min(p.most_weight, max(1.0, (len(examples) - positive) / max(1, positive))), 1.0)  # the rarer label counts more
    for _ in range(p.epochs):
        for k in rng.permutation(len(examples)):
            at, label = examples[k]
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= p.l1, 0.0, -(zi - np.sign(zi) * p.l1) / ((p.beta + root) / p.alpha + p.l2))
            g = 1.0 / (1.0 + np.exp(-np.clip(bias + w.sum(), -30, 30))) - label
            g *= weigh[0] if label else weigh[1]
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - root) / p.alpha * w
            n[at] = grown
            bias_n += g * g
            bias -= 0.1 * g / np.sqrt(bias_n)
    w = np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))
    kept = np.flatnonzero(w)
    return kept, w[kept], bias


def fit(docs: DataFrame, labels: DataFrame, params: Ftrl = Ftrl(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """Learn the weights from a bounded sample of labelled documents outside the held-out fold."""
    ids = sample_ids(labels, label_col, FOLDS, HELD, PER_CLASS, id_col)
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(ids), "doc_id")  # at most 2 * PER_CLASS ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                doc, at = features(data, offsets)
                both = np.unique((doc << BITS) | at)
                cuts = np.searchsorted(both, np.arange(hi - lo + 1) << BITS)
                at = (both & ((1 << BITS) - 1)).astype("<i4")
                raw = [at[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "label")] + [pa.array(raw, pa.binary())], ["doc_id", "label", "at"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            seen += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "at")), strict=True)
        seen.sort()
        examples = [(np.frombuffer(at, "<i4"), label) for _, label, at in seen]
        if len({label for _, label in examples}) == 2:
            kept, w, bias = learn(examples, params)
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.append(kept, -1), pa.int64()), "weight": pa.array(np.append(w, bias))})

    kind = dict(rows.dtypes)["doc_id"]
    encoded = rows.mapInArrow(encode, f"doc_id {kind}, label int, at binary")
    found = encoded.repartition(1).mapInArrow(train, "at long, weight double").toPandas()
    at, weight = found["at"].to_numpy(np.int64), found["weight"].to_numpy(np.float64)
    return at[at >= 0], weight[at >= 0], float(weight[at < 0].sum())


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    kept, weights, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, dtype=np.float32)
        table[kept] = weights
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                doc, at = features(data, offsets)
                hit = table[at] != 0
                both = np.unique((doc[hit] << BITS) | at[hit])
                total = bias + np.bincount(both >> BITS, weights=table[both & ((1 << BITS) - 1)], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], ["doc_id", "score"])

    rows = id_and_text(docs, id_col, text_col)
    scored = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
