"""Toxicity: Levenshtein automata intersected with a lexicon trie.

The lexicon is learned from labels: words that turn up in toxic documents in
many different surroundings and hardly ever in clean ones, and stems that
several such words share, with a short fixed seed list.  Trie and Levenshtein
automata of all terms are intersected once, into one deterministic table
(states are sets of trie node and edits used).  Words and stems of
``FUZZY_FROM`` letters or more are found with one edit, two exchanged
neighbours count as one; shorter ones only as they are.  Every word of every
text runs through that table, all words of a shard in step, so misspelled terms
cost no more than exact ones.

Each hit is looked at in a window of ``CONTEXT`` words to either side: quote
marks around it and words of reporting or naming mark a quotation, words of
address and further hits mark abuse.  A logistic unit over counts of exact and
misspelled, quoted and open hits gives the score.

Fitting takes a bounded sample (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``
documents at most; only the terms that pass the test of odds reach the driver).
No term is cut: ``LEXICON_TERMS`` of them share an automaton, more terms make
more automata.  Scoring reads every text whole, in the task that reads it.

Edge cases: null and empty texts have no hits and get the score of such
documents; null labels are no training rows; without both labels the score is
the share of label 1; repeated rows repeat; other columns pass through,
clashing ones are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.llm.bytes_words import find_words
from tallyho.llm.common import split_buffers, training_texts

SAMPLE_TOXIC, SAMPLE_CLEAN = 2500, 8000
LEXICON_TERMS = 200             # terms in one automaton
EDITS, FUZZY_FROM = 1, 5        # edits allowed in terms of so many letters
TERM_LETTERS = (3, 24)
STEM, STEM_LETTERS, STEM_WORDS = "*", (4, 5, 6), 4
ODDS = 20.0
CHANCE = 1e-5                   # of a neutral word to get into the lexicon
CONTEXT = 8
SHARD_BYTES = 2 << 20
# Seed terms, and words that mark reporting and address.
SEED_TERMS = "asshole bastard bitch dumbass idiot imbecile loser moron scumbag stupid".split()
REPORTING = frozenset("said says wrote called calls quote quoted quoting word words term terms phrase insult insults "
                      "slur means sagte schrieb nannte wort zitat dit écrit appelé mot citation dijo escribió llamó "
                      "palabra cita".split())
ADDRESS = frozenset("you your you're youre u ur yourself du dich dein deine ihr euch tu toi ton ta vous votre tú ti usted".split())
QUOTES = frozenset("\"'“”„«»‘’‹›`")
FEATURES = 9

_PLANE = 1 << 16
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(map(chr, range(_PLANE)))], np.uint32)
_PART = np.array([c.isalnum() for c in map(chr, range(_PLANE))])


def code_points(data: np.ndarray, offsets: np.ndarray):
    """(lower-case code points, row limits) of a UTF-8 buffer."""
    raw = data.tobytes()
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    if len(points) != len(data):
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        offsets = starts[offsets]
    low = points < _PLANE
    return np.where(low, _LOWER[np.where(low, points, 0)], points), offsets


def word_places(points: np.ndarray, offsets: np.ndarray):
    """(start, end, row) of every run of letters and digits."""
    low = points < _PLANE
    part = np.where(low, _PART[np.where(low, points, 0)], True)
    return find_words(part.astype(np.uint8), offsets, np.array([False, True]))


class Automaton:
    """Lexicon trie x Levenshtein automata as one table.

    ``step[state, letter]`` is the next state (0: no term can be reached any
    more; state 1: start), ``accept[state]`` the nearest term (-1: none) and
    ``edits[state]`` its distance.  Terms of ``fuzzy_from`` letters or more may
    be off by ``edits``.  A term that ends in ``*`` is a stem: every word with a
    beginning that near to it is accepted, by a tail node that keeps any letter
    (``stem[state]``: nothing but tails is left, the word need not be read on).
    With ``swaps`` two exchanged neighbours are one edit."""

    def __init__(self, terms: list[str], edits: int = EDITS, fuzzy_from: int = FUZZY_FROM, swaps: bool = False):
        self.terms = terms
        letters = sorted({ord(c) for t in terms for c in t.rstrip(STEM)})
        self.letter = {c: i + 1 for i, c in enumerate(letters)}
        self.longest = max(map(len, terms), default=0) + edits + 1
        child: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        room: list[int] = [0]               # edits allowed somewhere below a node
        allowed = [edits if len(t.rstrip(STEM)) >= fuzzy_from else 0 for t in terms]
        tail: dict[int, int] = {}           # end of a stem: its tail node
        tails: set[int] = set()

        def new(end=-1, may=0):
            child.append({})
            ends.append(end)
            room.append(may)
            return len(child) - 1

        for k, t in enumerate(terms):
            node, may = 0, allowed[k]
            room[0] = max(room[0], may)
            for c in t.rstrip(STEM):
                c = self.letter[ord(c)]
                if c not in child[node]:
                    child[node][c] = new()
                node = child[node][c]
                room[node] = max(room[node], may)
            if t.endswith(STEM):
                tail[node] = new(k, may)
                tails.add(tail[node])
            else:
                ends[node] = k
        swapped: list[list[tuple[int, int]]] = [[] for _ in child]  # (second letter, node that waits for the first)
        waits: set[int] = set()
        for n in range(len(child) if swaps else 0):
            for first, m in list(child[n].items()):
                for second, p in list(child[m].items()):
                    if first != second and room[p]:
                        q = new(may=room[p])
                        child[q][first] = p
                        waits.add(q)
                        swapped[n].append((second, q))
        swapped += [[] for _ in range(len(child) - len(swapped))]

        def closed(pairs):
            """The set with letters of terms left out, fewest edits per node."""
            best: dict[int, int] = {}
            todo = list(pairs)
            while todo:
                n, e = todo.pop()
                if e > room[n] and e or best.get(n, 99) <= e:
                    continue
                best[n] = e
                if n in tail:
                    todo.append((tail[n], e))
                if n not in waits:
                    todo += [(m, e + 1) for m in child[n].values() if e + 1 <= room[m]]
            return frozenset(best.items())

        first = closed([(0, 0)])
        number, order, rows = {frozenset(): 0, first: 1}, [frozenset(), first], []

        def numbered(pairs):
            s = closed(pairs)
            if s not in number:
                number[s] = len(order)
                order.append(s)
            return number[s]

        at = 0
        while at < len(order):
            any_, by = [], {}               # nodes after any letter, and after a certain one
            for n, e in order[at]:
                if n in tails:
                    any_.append((n, e))
                    continue
                for c, m in child[n].items():
                    by.setdefault(c, []).append((m, e))
                if e < room[n] and n not in waits:
                    any_.append((n, e + 1))
                    any_ += [(m, e + 1) for m in child[n].values() if e + 1 <= room[m]]
                    for c, q in swapped[n]:
                        by.setdefault(c, []).append((q, e + 1))
            row = np.full(len(letters) + 1, numbered(any_), np.int32)
            for c in sorted(by):
                row[c] = numbered(any_ + by[c])
            rows.append(row)
            at += 1
        self.step = np.array(rows)
        found = [min(((e, n in tails, ends[n]) for n, e in s if ends[n] >= 0 and e <= allowed[ends[n]]), default=(0, False, -1))
                 for s in order]
        self.stem = np.array([bool(s) and all(n in tails for n, _ in s) for s in order])
        self.accept = np.array([k for _, _, k in found], np.int32)
        self.edits = np.array([e for e, _, _ in found], np.int8)
        self.classes = np.zeros(_PLANE, np.int32)
        for c, i in self.letter.items():
            if c < _PLANE:
                self.classes[c] = i

    def run(self, points: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(word, term, edits) of every word that is a term or near one."""
        alive, state, words, terms, edits = np.arange(len(start)), np.ones(len(start), np.int32), [], [], []
        for k in range(self.longest + 1):
            over = (end[alive] - start[alive] == k) | self.stem[state]
            s = state[over]
            hit = self.accept[s] >= 0
            words.append(alive[over][hit])
            terms.append(self.accept[s][hit])
            edits.append(self.edits[s][hit])
            alive, state = alive[~over], state[~over]
            c = points[start[alive] + k]
            state = self.step[state, np.where(c < _PLANE, self.classes[np.where(c < _PLANE, c, 0)], 0)]
            alive, state = alive[state > 0], state[state > 0]
        words = np.concatenate(words)
        order = np.argsort(words, kind="stable")
        return words[order], np.concatenate(terms)[order], np.concatenate(edits)[order]


class Lexicon:
    """Automata of ``LEXICON_TERMS`` terms each; of a word that several of them
    accept, the nearest term counts, and a full one before a stem."""

    def __init__(self, terms: list[str], size: int = LEXICON_TERMS):
        self.terms = terms
        self.parts = [Automaton(terms[k: k + size], swaps=True) for k in range(0, len(terms), size)]
        self.first = range(0, len(terms), size)
        self.is_stem = np.array([t.endswith(STEM) for t in terms], bool)

    def run(self, points: np.ndarray, start: np.ndarray, end: np.ndarray):
        found = [(w, t + k, e) for k, (w, t, e) in ((k, p.run(points, start, end)) for k, p in zip(self.first, self.parts))]
        words, terms, edits = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((terms, self.is_stem[terms], edits, words))
        words, terms, edits = words[order], terms[order], edits[order]
        keep = np.concatenate([[True], words[1:] != words[:-1]])[:len(words)]
        return words[keep], terms[keep], edits[keep]


def spell(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le")


def context(points, start, end, row, offsets, w: int) -> tuple[bool, bool, bool]:
    """Whether word ``w`` is between quote marks, reported, addressed."""
    a, b = max(w - CONTEXT, 0), min(w + CONTEXT, len(start) - 1)
    while row[a] != row[w]:
        a += 1
    while row[b] != row[w]:
        b -= 1
    near = [spell(points[start[k]: end[k]]) for k in range(a, b + 1) if k != w]
    left = spell(points[max(start[a] - 1, offsets[row[w]]): start[w]])
    right = spell(points[end[w]: min(end[b] + 1, offsets[row[w] + 1])])
    marks = lambda s: sum(c in QUOTES and not (0 < i < len(s) - 1 and s[i - 1].isalnum() and s[i + 1].isalnum())
                          for i, c in enumerate(s))
    return marks(left) % 2 == 1 and marks(right) > 0, any(x in REPORTING for x in near), any(x in ADDRESS for x in near)


def features(data, offsets, automaton: Lexicon, weight: np.ndarray):
    """One row of ``FEATURES`` numbers per text, and its hits."""
    rows = len(offsets) - 1
    points, offsets = code_points(data, offsets)
    start, end, row = word_places(points, offsets)
    x = np.zeros((rows, FEATURES))
    words, terms, edits = automaton.run(points, start, end)
    hits = [[] for _ in range(rows)]
    around = np.searchsorted(words, words + CONTEXT, side="right") - np.searchsorted(words, words - CONTEXT) - 1
    for w, t, e, n in zip(words.tolist(), terms.tolist(), edits.tolist(), around.tolist()):
        quoted, reported, addressed = context(points, start, end, row, offsets, w)
        r = row[w]
        open_ = not (quoted or reported)
        x[r, (0 if e == 0 else 2) + (0 if open_ else 1)] += 1
        x[r, 4] += addressed and open_
        x[r, 5] += n > 0 and open_
        if open_:
            x[r, 6 if e == 0 else 7] = max(x[r, 6 if e == 0 else 7], weight[t])
        hits[r].append((w, automaton.terms[t], e, open_))
    x[:, :6] = np.log1p(x[:, :6])
    n = np.bincount(row, minlength=rows)
    x[:, 8] = np.bincount(row[words], minlength=rows) / np.maximum(n, 1) * 10
    return x, hits


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, float]]:
    """(term, log odds) of the words that mark toxic documents.  A word counts
    once for each different word before it, so the copies of one document do
    not make a term of every word in it."""
    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
                label = part.column(2).to_pylist()
                points, limits = code_points(data, offsets)
                start, end, row = word_places(points, limits)
                out = set()
                text, before, last = "", "", -1
                for s, e, r in zip(start.tolist(), end.tolist(), row.tolist()):
                    if r != last:
                        base, before, last = int(limits[r]), "", r
                        text = spell(points[base: limits[r + 1]])
                    word = text[s - base: e - base]
                    if TERM_LETTERS[0] <= e - s <= TERM_LETTERS[1] and word.isalpha():
                        out.add((word, label[r], before if label[r] else str(r)))
                    before = word
                if out:
                    w, y, b = zip(*sorted(out))
                    yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(y, pa.int32()), pa.array(b)], ["word", "label", "seen"])

    if not n_toxic or not n_clean:
        return []
    least = max(4, math.ceil(math.log(CHANCE) / math.log(n_toxic / (n_toxic + n_clean))))
    stems = [F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit(STEM))) for k in STEM_LETTERS]
    forms = F.explode(F.filter(F.array("word", *stems), lambda t: t.isNotNull())).alias("term")
    emitted = [sample.where(F.col("label") == y).mapInArrow(emit, "word string, label int, seen string").select("word", "seen", forms)
               for y in (1, 0)]
    toxic = emitted[0].groupBy("term").agg(F.count_distinct("seen").alias("toxic"), F.count_distinct("word").alias("words"))
    toxic = toxic.where((F.col("toxic") >= least) & ((F.col("words") >= STEM_WORDS) | ~F.col("term").endswith(STEM)))
    clean = emitted[1].groupBy("term").agg(F.count(F.lit(1)).alias("clean"))
    both = toxic.join(clean, "term", "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
    odds = (F.col("toxic") / n_toxic) / ((F.col("clean") + 0.5) / n_clean)
    rows = both.where(odds >= ODDS).select("term", F.log(odds).alias("odds"), "toxic").collect()
    rows.sort(key=lambda r: (-r["odds"] * r["toxic"], r["term"]))
    return [(r["term"], r["odds"]) for r in rows]     # with the terms that a stem covers: these may be misspelled


class Model:
    def __init__(self, share: float, lexicon=(), weights=None):
        self.share, self.weights = share, weights
        learned = dict(lexicon)
        for t in SEED_TERMS:
            learned.setdefault(t, 1.0)
        terms = sorted(learned)
        self.automaton = Lexicon(terms)
        self.term_weight = np.array([learned[t] for t in terms])

    def features(self, data, offsets):
        return features(data, offsets, self.automaton, self.term_weight)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton steps on the weighted log loss with a small ridge."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (weight * (p - y)) + decay * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, marks: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """A model from a bounded sample of the documents marked (doc_id, label)."""
    sample, counts = training_texts(docs, marks, {1: toxic, 0: clean})
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    lexicon = learn_lexicon(sample, min(counts.get(1, 0), toxic), min(counts.get(0, 0), clean))
    model = Model(share, lexicon)

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
                x, _ = model.features(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column(2).cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                                 ["label", "x"])

    got = sample.mapInArrow(encode, "label int, x array<double>").groupBy("label", "x").count().collect()
    y = np.array([r["label"] for r in got], float)
    if len(y) and y.min() != y.max():
        n = np.array([r["count"] for r in got], float)
        weight = n * np.where(y > 0, share / n[y > 0].sum(), (1 - share) / n[y == 0].sum())
        order = sorted(range(len(got)), key=lambda i: (got[i]["label"], got[i]["x"]))
        x = np.array([r["x"] for r in got])
        model.weights = fit_logistic(x[order], y[order], weight[order])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and the hit terms as written in the lexicon."""
    new = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("terms", T.ArrayType(T.StringType()))])
    docs = docs.select(*[c for c in docs.columns if c.lower() not in new.names])

    names = docs.columns + new.names

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
                x, hits = model.features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(model.scores(x)), pa.array([sorted({t for _, t, _, _ in h}) for h in hits],
                                                                       pa.list_(pa.string()))], names)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + new.fields))
