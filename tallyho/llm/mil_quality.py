"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Every passage is
encoded (byte classes, word statistics, repetition inside the passage and
against the document's earlier passages) by a small layer that is learned with
the rest; gated attention ``w . (tanh(V h) * sigmoid(U h))`` weighs the
passages of a document, and a logistic unit scores the weighted passage
representation.  Only document labels are used.

Fitting takes a bounded sample: at most ``SAMPLE_PER_LABEL`` documents of each
label, with all their passages; if these are more than ``TRAIN_PASSAGES`` a
document on the average, whole documents are left out of the sample.  Classes
are weighed back to their share of all labelled rows.  Scoring reads every
passage of every text, in the task that reads the text.

Edge cases: null and empty texts are a bag of one passage without words and
are scored like any other; labels that are null are no training rows; without
both labels in the sample the score is the share of label 1 (0.5 without
labels); repeated rows repeat; other columns pass through, clashing ones are
replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.llm.bytes_words import LOWER, NOT_SPACE, find_words, mix, prefix_hash, range_hash
from tallyho.llm.common import split_buffers, training_texts, written

PASSAGE_WORDS = 48
SAMPLE_PER_LABEL = 2500
TRAIN_PASSAGES = 96             # on the average of a full sample
SHARD_BYTES = 2 << 20
HIDDEN, GATE = 24, 12

# Byte classes: each ASCII sign for itself, letters by case, digits, the rest.
_CLASS = np.zeros(256, np.int64)
_CLASS[33:127] = np.arange(1, 95)
_CLASS[48:58] = 95
_CLASS[65:91] = 96
_CLASS[97:123] = 97
_CLASS[128:] = 98
_CLASS[10] = 99
CLASSES = 100
FEATURES = CLASSES + 8


def passages(data: np.ndarray, offsets: np.ndarray):
    """(features, first): one row per passage, and where each text's begin."""
    rows = len(offsets) - 1
    start, end, row = find_words(data, offsets, NOT_SPACE)
    n_words = np.bincount(row, minlength=rows)
    n_bags = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(n_bags)])
    number = np.arange(len(start)) - (np.cumsum(n_words) - n_words)[row]
    own = first[row] + number // PASSAGE_WORDS
    total = int(first[-1])
    # a byte belongs to the passage of the last word that began before it
    begin = np.zeros(total, np.int64)
    begin[first[:-1]] = offsets[:-1]
    later = np.flatnonzero((number % PASSAGE_WORDS == 0) & (number > 0))
    begin[own[later]] = start[later]
    of_byte = np.repeat(np.arange(total), np.diff(np.concatenate([begin, [len(data)]])))
    count = np.bincount(of_byte * CLASSES + _CLASS[data], minlength=total * CLASSES).reshape(total, CLASSES)
    size = np.maximum(count.sum(axis=1, keepdims=True), 1)
    words = np.maximum(np.bincount(own, minlength=total), 1)
    low = LOWER[data]
    h = range_hash(prefix_hash(low), start, end)
    share = lambda flag: np.bincount(own[flag], minlength=total) / words
    repeat = np.zeros(len(h), bool)
    repeat[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    fresh = np.zeros(len(h), bool)
    fresh[np.unique(mix(h ^ own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]] = True
    seen = np.zeros(len(h), bool)
    if len(h) > 2:
        three = mix(mix(h[:-2]) + np.uint64(3) * h[1:-1]) + np.uint64(7) * h[2:]
        inside = row[:-2] == row[2:]
        three = mix(three ^ row[:-2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        again = np.ones(len(three), bool)
        again[np.unique(three, return_index=True)[1]] = False
        seen[:-2] = again & inside
    extra = np.stack([
        np.bincount(own, weights=end - start, minlength=total) / words / 10, share(repeat), share(fresh), share(seen),
        share((end - start) > 20), np.log1p(np.bincount(own, minlength=total)) / 4, np.log1p(n_words).repeat(n_bags) / 10,
        np.log1p(count[:, 99]) / 3], axis=1)
    return np.concatenate([np.sqrt(count / size), extra], axis=1).astype(np.float32), first


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    def __init__(self, share: float, mean=None, scale=None, weights=None):
        self.share, self.mean, self.scale, self.weights = share, mean, scale, weights

    def forward(self, x: np.ndarray, first: np.ndarray, p=None):
        """Scores of the bags; x is standardised already."""
        p = p or self.weights
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        a = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        e = np.exp(a - np.maximum.reduceat(a, first[:-1])[bag])
        attention = e / np.add.reduceat(e, first[:-1])[bag]
        z = np.add.reduceat(attention[:, None] * h, first[:-1], axis=0)
        return sigmoid(z @ p["o"] + p["c"]), (h, t, g, attention, bag, z)

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(first) - 1, self.share)
        return self.forward(((x - self.mean) / self.scale).clip(-8, 8), first)[0].astype(np.float64)


def fit_bags(x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, share: float,
             rounds: int = 25, bags: int = 64, rate: float = 0.01, seed: int = 11) -> Model:
    """Adam on the weighted log loss, with gradients written out by hand."""
    draw = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.02
    model = Model(share, mean, scale)
    x = ((x - mean) / scale).clip(-8, 8)
    make = lambda *s: (draw.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"W": make(x.shape[1], HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": make(HIDDEN, GATE), "U": make(HIDDEN, GATE),
         "w": make(GATE), "o": make(HIDDEN), "c": np.zeros((), np.float32)}
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    size = np.diff(first)
    for r in range(rounds):
        for some in np.array_split(draw.permutation(len(y)), max(1, len(y) // bags)):
            own = np.concatenate([[0], np.cumsum(size[some])])
            rows = np.arange(own[-1]) - np.repeat(own[:-1], size[some]) + np.repeat(first[some], size[some])
            xs = x[rows]
            s, (h, th, g, att, bag, z) = model.forward(xs, own, p)
            d = ((s - y[some]) * weight[some] / weight[some].sum()).astype(np.float32)
            dz = d[:, None] * p["o"]
            da = att * ((h - z[bag]) * dz[bag]).sum(axis=1)
            dgate = da[:, None] * p["w"]
            dv, du = dgate * g * (1 - th * th), dgate * th * g * (1 - g)
            dh = (att[:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
            grad = {"o": z.T @ d, "c": d.sum(), "w": (th * g).T @ da, "V": h.T @ dv, "U": h.T @ du, "W": xs.T @ dh, "b": dh.sum(axis=0)}
            t += 1
            step = rate * (1 - r / rounds)
            for k in p:
                gk = grad[k] + 1e-4 * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * gk, 0.999 * v[k] + 0.001 * gk * gk
                p[k] = (p[k] - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    model.weights = p
    return model


def whole_documents(sizes: list[tuple[int, int, int]], most: int) -> set[int]:
    """The doc_ids of the sample, out of (doc_id, label, passages): for each
    label, in the order of a hash, what fits into ``most`` passages, and the
    smallest document if none does."""
    chosen: set[int] = set()
    for label in {y for _, y, _ in sizes}:
        own: dict[int, int] = {}
        for d, y, n in sizes:
            if y == label:
                own[d] = own.get(d, 0) + n
        room, some = most, set()
        for d in sorted(own, key=lambda d: (zlib.crc32(str(d).encode()), d)):
            if own[d] <= room:
                room -= own[d]
                some.add(d)
        chosen |= some or {min(own, key=lambda d: (own[d], d))}
    return chosen


def fit(docs: DataFrame, marks: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """A model from a bounded sample of the documents marked (doc_id, label)."""
    sample, counts = training_texts(docs, marks, {0: per_label, 1: per_label})
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES, 2000):
                x, first = passages(data, offsets)
                x = x.astype(np.float16)
                bags = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(2).cast(pa.int32()),
                                                  pa.array(bags, pa.binary())], ["doc_id", "label", "x"])

    encoded = written(sample.mapInArrow(encode, "doc_id long, label int, x binary"), "bags")
    sizes = [(r["doc_id"], r["label"], r["n"] // (2 * FEATURES))
             for r in encoded.select("doc_id", "label", F.length("x").alias("n")).collect()]
    chosen = whole_documents(sizes, per_label * TRAIN_PASSAGES)
    if len(chosen) < len({d for d, _, _ in sizes}):
        ids = encoded.sparkSession.createDataFrame([(d,) for d in sorted(chosen)], "doc_id long")
        encoded = encoded.join(F.broadcast(ids), "doc_id", "left_semi")
    got = sorted(encoded.collect(),
                 key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["label"]))
    y = np.array([r["label"] for r in got], np.float32)
    if not len(y) or y.min() == y.max():
        return Model(share)
    bags = [np.frombuffer(bytes(r["x"]), np.float16).reshape(-1, FEATURES).astype(np.float32) for r in got]
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    weight = np.where(y > 0, share / (y > 0).mean(), (1 - share) / (y == 0).mean()).astype(np.float32)
    return fit_bags(np.concatenate(bags), first, y, weight, share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score."""
    docs = docs.select(*[c for c in docs.columns if c.lower() != "score"])

    names = docs.columns + ["score"]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES, 2000):
                s = model.scores(*passages(data, offsets))
                yield pa.RecordBatch.from_arrays(part.columns + [pa.array(s)], names)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + [T.StructField("score", T.DoubleType())]))
