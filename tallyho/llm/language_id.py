"""Language identification by hierarchical discrimination.

A text is first assigned to a language family (softmax over hashed letter
trigrams); inside the family, one linear support vector machine per pair of
languages decides between the close relatives, and the pairwise margins are
coupled into a probability.  The score is P(family) * P(language | family).

The models are fitted on a bounded sample: at most ``SAMPLE_PER_LANGUAGE``
labelled texts of each language (fewer with very many languages, so that no
more than ``SAMPLE_ROWS`` reach the driver, as 2048 half floats each).
Every text is scored whole, in the task that reads it.

Edge cases: null text, empty text and text without a letter are ``und`` with
score 0; rows without a label are scored like the others; labels outside the
family table are families of their own; without any labelled text everything
is ``und``; repeated rows repeat; other columns pass through, clashing ones
are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.llm.common import bounded_sample, split_buffers

DIM = 2048
SAMPLE_PER_LANGUAGE = 800
SAMPLE_ROWS = 40_000
CHUNK = 4 << 20
# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "semitic": "ar he mt am",
    "iranian": "fa ku ps tg",
    "indic": "hi ur bn pa mr gu ne si",
    "dravidian": "ta te kn ml",
    "malayic": "id ms jv su",
    "sinitic": "zh",
    "japonic": "ja",
    "koreanic": "ko",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# Letters stay (lower case), every other ASCII byte is a blank.
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigram_rows(data: np.ndarray, offsets: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Unit-length square roots of hashed trigram counts, one row per text."""
    rows = len(offsets) - 1
    counts = np.zeros(rows * dim, np.float32)
    for lo in range(0, max(len(data) - 2, 0), CHUNK):
        b = _FOLD[data[lo: lo + CHUNK + 2]]
        h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        at = np.arange(lo, lo + len(h))
        row = np.searchsorted(offsets, at, side="right") - 1
        whole = (at + 3 <= offsets[row + 1]) & ~((b[:-2] == 32) & (b[1:-1] == 32))
        code = row[whole] * dim + (h[whole] >> np.uint32(21)).astype(np.int64) % dim
        counts += np.bincount(code, minlength=rows * dim).astype(np.float32)
    x = np.sqrt(counts).reshape(rows, dim)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = data | 32
    seen = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122) & (data < 128))])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for r in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[r] = any(c.isalpha() for c in data[offsets[r]: offsets[r + 1]].tobytes().decode("utf-8"))
    return out


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 150, rate: float = 0.5, decay: float = 1e-4):
    """Multinomial logistic weights (dim + 1, classes), classes weighted alike."""
    x1 = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    onehot = np.eye(classes, dtype=np.float32)[y]
    weight = (1.0 / np.maximum(np.bincount(y, minlength=classes), 1))[y][:, None].astype(np.float32) / classes
    w, m, v = (np.zeros((x1.shape[1], classes), np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        g = x1.T @ ((softmax(x1 @ w) - onehot) * weight) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_svm(x: np.ndarray, sign: np.ndarray, cost: float = 4.0, rounds: int = 20, seed: int = 3) -> np.ndarray:
    """Linear SVM with squared hinge loss by dual coordinate descent; the last
    weight is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1).astype(np.float64)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    curve = (x * x).sum(axis=1) + 0.5 / cost
    draw = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in draw.permutation(len(x)):
            gradient = sign[i] * (x[i] @ w) - 1 + 0.5 * alpha[i] / cost
            new = max(alpha[i] - gradient / curve[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * sign[i] * x[i]
                alpha[i] = new
    return w.astype(np.float32)


class Model:
    """Family weights, and the pairwise machines of each family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        families = sorted({FAMILY_OF.get(c, c) for c in self.langs})
        self.members = [[i for i, c in enumerate(self.langs) if FAMILY_OF.get(c, c) == f] for f in families]
        index = {c: i for i, c in enumerate(self.langs)}
        y = np.array([index[c] for c in langs])
        self.family = None
        if len(families) > 1:
            of = np.zeros(len(self.langs), int)
            for k, group in enumerate(self.members):
                of[group] = k
            self.family = fit_softmax(x, of[y], len(families))
        self.pairs = []
        for group in self.members:
            for n, a in enumerate(group):
                for b in group[n + 1:]:
                    rows = (y == a) | (y == b)
                    self.pairs.append((a, b, fit_svm(x[rows], np.where(y[rows] == a, 1.0, -1.0))))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score) of each row: family first, then its pairs."""
        x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
        p = softmax(x @ self.family) if self.family is not None else np.ones((len(x), 1), np.float32)
        chosen = p.argmax(axis=1)
        win = np.zeros((len(x), len(self.langs)))
        for a, b, w in self.pairs:
            a_wins = 1 / (1 + np.exp(-np.clip(4 * (x @ w), -50, 50)))
            win[:, a] += a_wins
            win[:, b] += 1 - a_wins
        best, score = np.zeros(len(x), int), np.zeros(len(x))
        for k, group in enumerate(self.members):
            rows = np.flatnonzero(chosen == k)
            if len(group) == 1:
                best[rows], inside = group[0], np.ones(len(rows))
            else:
                own = win[np.ix_(rows, group)]
                best[rows] = np.array(group)[own.argmax(axis=1)]
                inside = own.max(axis=1) / max(len(group) - 1, 1)
            score[rows] = p[rows, k] * inside
        return best, np.clip(score, 0.0, 1.0)


def fit(train: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """A model from a bounded sample of (doc_id, text, lang) rows."""
    rows = train.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    languages = max(1, rows.select("lang").distinct().count())
    sample = bounded_sample(rows, "lang", min(per_language, SAMPLE_ROWS / languages))

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", CHUNK, 2000):
                good = has_letter(data, offsets)
                x = trigram_rows(data, offsets).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column(2).filter(pa.array(good)).cast(pa.string())),
                     pa.array([r.tobytes() for r in x[good]], pa.binary())], ["lang", "x"])

    got = sorted(sample.mapInArrow(features, "lang string, x binary").collect())
    if not got:
        return None
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), np.float16).reshape(len(got), DIM).astype(np.float32)
    return Model(x, [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    new = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    docs = docs.select(*[c for c in docs.columns if c.lower() not in new.names])

    columns = docs.columns + new.names

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", CHUNK, 2000):
                names, score = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
                good = np.flatnonzero(has_letter(data, offsets)) if model is not None else []
                if len(good):
                    best, p = model.predict(trigram_rows(data, offsets)[good])
                    names[good], score[good] = np.array(model.langs, object)[best], p
                yield pa.RecordBatch.from_arrays(part.columns + [pa.array(names.tolist(), pa.string()), pa.array(score)],
                                                 columns)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + new.fields))
