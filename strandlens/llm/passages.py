"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages of ``PASSAGE`` words.  A passage is encoded by
numbers that don't depend on where it stands: shares of byte classes, lengths
of words, repetition inside the passage and of what the document said before,
and hashed counts of byte pairs and words; one hidden layer turns these into a
vector.  Gated attention, tanh(V h) * sigmoid(U h), weighs the passages, and a
logistic unit scores the weighted sum.  Only documents carry labels, so the
attention learns by itself which passages decide.

The sample to learn from is bounded: ``PER_CLASS`` labelled documents of either
label outside the held-out fold.  It is read by one task, as encoded passages.

Nulls and edge cases: a null text is empty; a text without words is one passage
of zeros.  Without labels of both kinds every score is 0.5.  Repeated rows stay
separate rows; extra columns are ignored; null ids are scored and not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, sample_ids
from .shared import id_and_text
from .textkernel import Words, ngram_hashes, slices

PASSAGE = 64
PER_CLASS = 1500
FOLDS, HELD = 4, 2
THRESHOLD = 0.7
PAIRS = WORDS = 128
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 14, 32, 0.004, 1e-4

# Byte classes: lower, upper, digit, space, line break, the common signs one by one, other signs, above ASCII.
_CLASS = np.zeros(256, dtype=np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 11 if _b > 127 else 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c == " " else 4 if _c in "\r\n" else 5 + ".,!|:".index(_c) if _c in ".,!|:" else 10
CLASSES = 12
STATS = 6
WIDTH = CLASSES + STATS + PAIRS + WORDS


def _seen_before(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the same key stood earlier in the same document."""
    order = np.lexsort((key, doc))
    again = np.zeros(len(key), dtype=bool)
    same = (doc[order][1:] == doc[order][:-1]) & (key[order][1:] == key[order][:-1])
    again[order[1:][same]] = True
    return again


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of each passage, first passage of each document) of a slice of texts."""
    words = Words(data, offsets)
    counts = words.counts()
    per = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate(([0], np.cumsum(per)))
    total = int(first[-1])
    out = np.zeros((total, WIDTH), dtype=np.float32)
    doc = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(words)) - words.bounds[doc]
    passage = first[doc] + within // PASSAGE
    # a document's bytes belong to the passage of the last of its words that has begun; those before its first word to the first
    begin = np.repeat(offsets[:-1], per)
    inner = np.flatnonzero(within % PASSAGE == 0)
    inner = inner[within[inner] > 0]
    begin[passage[inner]] = words.starts[inner]
    of = np.repeat(np.arange(total), np.diff(np.append(begin, len(data))))
    h = words.hashes()
    n_bytes = np.maximum(np.bincount(of, minlength=total), 1)[:, None]
    n_words = np.maximum(np.bincount(passage, minlength=total), 1)[:, None]
    out[:, :CLASSES] = np.bincount(of * CLASSES + _CLASS[data], minlength=total * CLASSES).reshape(total, CLASSES) / n_bytes * 4
    size = words.ends - words.starts
    mean = np.bincount(passage, size, total) / n_words[:, 0]
    stats = [np.log1p(n_words[:, 0]) / 4, mean / 8, np.bincount(passage, np.minimum(size, 64) ** 2, total) / n_words[:, 0] / 100]
    next_same = np.append((h[1:] == h[:-1]) & (doc[1:] == doc[:-1]), False)[: len(h)]
    stats.append(np.bincount(passage, next_same, total) / n_words[:, 0] * 4)
    stats.append(1 - np.bincount(passage, _seen_before(passage, h), total) / n_words[:, 0])
    three = ngram_hashes(h, 3)
    again = np.zeros(len(words), dtype=bool)
    if len(three):
        again[: len(three)] = _seen_before(doc[: len(three)], three) & (doc[: len(three)] == doc[2:])
    stats.append(np.bincount(passage, again, total) / n_words[:, 0] * 4)
    out[:, CLASSES : CLASSES + STATS] = np.stack(stats, 1)
    at = CLASSES + STATS
    low = data.astype(np.uint32)
    pair = ((low[:-1] * 257 + low[1:]) * np.uint32(2654435761) >> np.uint32(25)).astype(np.int64)
    own = np.ones(len(pair), dtype=bool)
    edges = offsets[1:-1]
    own[edges[(edges > 0) & (edges < len(data))] - 1] = False  # no pair reaches into the next document
    out[:, at : at + PAIRS] = np.sqrt(np.bincount((of[:-1] * PAIRS + pair)[own], minlength=total * PAIRS).reshape(total, PAIRS) / n_bytes * 4)
    word = (h >> np.uint64(57)).astype(np.int64)
    out[:, at + PAIRS :] = np.sqrt(np.bincount(passage * WORDS + word, minlength=total * WORDS).reshape(total, WORDS) / n_words)
    return out, first


class Attention:
    """Hidden layer, gated attention and logistic unit, with their gradients."""

    NAMES = ("W", "b", "V", "U", "a", "c", "d")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int) -> Attention:
        r = np.random.default_rng(seed)
        draw = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        zeros = lambda *s: np.zeros(s, np.float32)
        return cls({"W": draw(WIDTH, HIDDEN), "b": zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "a": draw(GATE), "c": draw(HIDDEN), "d": zeros(1)})

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        w = self.w
        h = np.maximum(x @ w["W"] + w["b"], 0)
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        return h, t, s, (t * s) @ w["a"]

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scores, attention weights, and what the gradients need; first is where each document's passages begin."""
        h, t, s, e = self.hidden(x)
        per = np.diff(first)
        doc = np.repeat(np.arange(len(per)), per)
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[doc])
        weight = e / np.add.reduceat(e, first[:-1])[doc]
        z = np.add.reduceat(h * weight[:, None], first[:-1])
        p = 1 / (1 + np.exp(-np.clip(z @ self.w["c"] + self.w["d"][0], -60, 60)))
        return p, weight, h, t, s, z, doc

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        p, weight, h, t, s, z, doc = self.forward(x, first)
        g = ((p - y) / len(y)).astype(np.float32)
        gz = g[:, None] * w["c"]
        gh = weight[:, None] * gz[doc]
        gw = (h * gz[doc]).sum(1)
        ge = weight * (gw - np.add.reduceat(weight * gw, first[:-1])[doc])
        gt, gs = ge[:, None] * w["a"] * s * (1 - t * t), ge[:, None] * w["a"] * t * s * (1 - s)
        gh = (gh + gt @ w["V"].T + gs @ w["U"].T) * (h > 0)
        return {"W": x.T @ gh, "b": gh.sum(0), "V": h.T @ gt, "U": h.T @ gs, "a": (t * s).T @ ge, "c": z.T @ g, "d": g.sum(keepdims=True)}

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = r.permutation(len(y))
            for lo in range(0, len(order), BATCH):
                docs = order[lo : lo + BATCH]
                per = first[docs + 1] - first[docs]
                cuts = np.concatenate(([0], np.cumsum(per)))
                rows = np.arange(cuts[-1]) + np.repeat(first[docs] - cuts[:-1], per)
                step += 1
                for k, g in self.gradients(x[rows], cuts, y[docs]).items():
                    g = g + DECAY * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)


def fit(docs: DataFrame, labels: DataFrame, seed: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict[str, np.ndarray] | None:
    """Learn the weights from a bounded sample of labelled documents outside the held-out fold; None without both labels."""
    ids = sample_ids(labels, label_col, FOLDS, HELD, PER_CLASS, id_col)
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(ids), "doc_id")  # at most 2 * PER_CLASS ids

    def to_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
                x, first = encode(data, offsets)
                raw = [x[a:b].astype("<f2").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "label")] + [pa.array(raw, pa.binary())], ["doc_id", "label", "x"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            seen += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "x")), strict=True)
        seen.sort(key=lambda r: r[:2])
        y = np.array([r[1] for r in seen], dtype=np.float32)
        if len(set(y.tolist())) == 2:
            parts = [np.frombuffer(r[2], "<f2").reshape(-1, WIDTH) for r in seen]
            first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            model = Attention.fresh(seed)
            model.fit(np.concatenate(parts).astype(np.float32), first, y, seed)
            yield pa.RecordBatch.from_pydict({"name": list(model.w), "raw": [v.astype("<f4").tobytes() for v in model.w.values()]})

    kind = dict(rows.dtypes)["doc_id"]
    encoded = rows.mapInArrow(to_passages, f"doc_id {kind}, label int, x binary")
    found = {r["name"]: np.frombuffer(bytes(r["raw"]), "<f4") for r in encoded.repartition(1).mapInArrow(train, "name string, raw binary").collect()}
    if not found:
        return None
    shapes = {k: v.shape for k, v in Attention.fresh(0).w.items()}
    return {k: found[k].reshape(shapes[k]) for k in Attention.NAMES}


def _scores(model: Attention | None, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, scores, the passage of each text that weighs most)."""
    for lo, hi, data, offsets in slices(texts, 1 << 20):
        if model:
            x, first = encode(data, offsets)
            p, weight, *_, doc = model.forward(x, first)
            order = np.lexsort((-weight, doc))
            yield lo, hi, p.astype(np.float64), (order[first[:-1]] - first[:-1]).astype(np.int64)
        else:
            yield lo, hi, np.full(hi - lo, 0.5), np.zeros(hi - lo, np.int64)


def keep_good(docs: DataFrame, weights: dict[str, np.ndarray] | None, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is at least THRESHOLD; without a model all rows."""
    if weights is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Attention(weights)
        for batch in batches:
            good = [p >= THRESHOLD for _, _, p, _ in _scores(model, batch.column(text_col))]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, weights: dict[str, np.ndarray] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text, with the passage that weighs most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Attention(weights) if weights else None
        for batch in batches:
            for lo, hi, p, top in _scores(model, batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(p), pa.array(top)], ["doc_id", "score", "top_passage"])

    rows = id_and_text(docs, id_col, text_col)
    scored = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, top_passage long")
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "top_passage")
