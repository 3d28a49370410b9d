"""Periodic runs and fill-in-middle against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallyho.llm import fill_in_middle, periodic_runs, plans
from tallyho.llm.bytes_words import mix
from tests.llm.conftest import SCHEMA, odd_rows, prose, table

MEDIUM = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=12):
    """Every period over the whole text; of equal intervals the smallest."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def some_words(r):
    k, n = r.choice([1, 2, 2, 3, 5, 30]), r.randint(0, r.choice([15, 40, 120]))
    words = [r.randrange(k) for _ in range(n)]
    if n and r.random() < 0.6:
        a = r.randrange(n)
        p = r.randint(1, max(1, (n - a) // 2))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    if n and r.random() < 0.3:
        words = words + words[r.randrange(n):] + words
    return words


@pytest.mark.parametrize("top,candidates", [(10, 1 << 20), (2, 50)])
def test_runs_equal_brute_force(monkeypatch, top, candidates):
    monkeypatch.setattr(periodic_runs, "_TOP", top)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", candidates)
    r, total = random.Random(top), 0
    for _ in range(60):
        docs = [some_words(r) for _ in range(20)] + [[0] * r.randint(0, 70)]
        limits = np.cumsum([0] + [len(d) for d in docs])
        found = periodic_runs.find_runs(mix(np.array([x for d in docs for x in d], np.uint64)), limits)
        got = [[] for _ in docs]
        for d, s, e, q in zip(*(x.tolist() for x in found)):
            got[d].append((s - int(limits[d]), e - s, q))
        assert got == [brute_runs(d) for d in docs]
        total += len(found[0])
    assert total > 500


def test_grammar_derives_the_text():
    """Every replaced boundary lies in its derivation, all derivations of a
    rule have the same words, and no pair is left twice."""
    r = random.Random(8)
    docs = [some_words(r) for _ in range(40)]
    limits = np.cumsum([0] + [len(d) for d in docs])
    words = [x for d in docs for x in d]
    (rule, boundary, first, end), _ = periodic_runs.grammar(mix(np.array(words, np.uint64)), limits)
    seen = {}
    for k, b, f, e in zip(rule.tolist(), boundary.tolist(), first.tolist(), end.tolist()):
        assert f < b < e
        assert seen.setdefault(k, (b - f, words[f:e])) == (b - f, words[f:e])
    assert len(set(boundary.tolist())) == len(boundary)
    assert all(c >= 2 for c in np.unique(rule, return_counts=True)[1])


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def run_row(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_op11_equals_brute_force(spark):
    got = plans.op11_periodic_runs(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = {d: t for d, t in rows.items() if len(t or "") < 20_000}
    got = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert {d: got[d] for d in rows} == {d: run_row(d, t) for d, t in rows.items()}
    assert sum(r[1] > 0 for r in got.values()) > 15


def test_runs_odd_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SHARD_BYTES", 900)
    again = "x " + "Ä b c\t" * 9 + "tail"
    rows = [*odd_rows(), (50, again, "en", "s"), (50, again, "en", "s"), (None, again, None, None), (51, "one " * 40, "en", "s")]
    got = periodic_runs.runs(table(spark, rows))
    clash = [c for c in SCHEMA.replace(",", "").split()[::2] if c not in ("n_words",)]
    assert got.columns == [*clash, "n_words", "runs", "collapsed"] and got.schema["n_words"].dataType.typeName() == "long"
    out = [r for r in got.collect()]
    assert len(out) == len(rows)
    key = lambda r: (str(r[0]), str(r[1]))
    for r, (d, t, lang, source) in zip(sorted(out, key=key), sorted(rows, key=key)):
        words = WORD.findall(t or "")
        assert (r["doc_id"], r["text"], r["lang"], r["source"], r["score"], r["n_words"]) == (d, t, lang, source, "x", len(words))
        if len(words) < 3000:
            assert [tuple(x) for x in r["runs"]] == brute_runs(words)
    assert {r["collapsed"] for r in out if r["text"] == again} == {"x Ä b c tail"}
    assert {r["collapsed"] for r in out if r["doc_id"] == 51} == {"one"}
    assert {r["collapsed"] for r in out if r["doc_id"] in (1, 2, 3)} == {""}
    digests = periodic_runs.run_digests(periodic_runs.runs(periodic_runs.planted(table(spark, rows)))).collect()
    assert len(digests) == len(rows) and all(r["collapsed_sha256"] and r["runs_sha256"] for r in digests)
    assert periodic_runs.runs(empty).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.runs(empty, min_run=4)


def fim_row(doc_id, text):
    t = text or ""
    d = "" if doc_id is None else str(doc_id)
    h = [int(hashlib.sha256(f"1:{d}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_skip_list_finds_every_rank():
    r = random.Random(3)
    for n in (0, 1, 2, 5, 40, 700, 5000):
        text = "".join(r.choice("aé 漢\n😀b") for _ in range(n))
        raw = np.frombuffer(text.encode(), np.uint8)
        for unit, pieces in (("char", list(text)), ("line", text.splitlines(True)), ("word", None)):
            byte_at, char_at = fill_in_middle.unit_starts(raw, unit)
            skip = fill_in_middle.SkipList(byte_at, char_at)
            if pieces is not None:
                assert skip.n == len(pieces)
            for lane, below in zip(skip.lanes, skip.lanes[1:]):
                assert lane[0].sum() == below[0].sum() == skip.n and lane[1].sum() == len(text)
            for k in {0, skip.n, *[r.randint(0, skip.n) for _ in range(40)]}:
                chars, size = skip.find(k)
                assert (chars, size) == (char_at[k], byte_at[k]) and raw[:size].tobytes().decode() == text[:chars]
                if pieces is not None:
                    assert text[:chars] == "".join(pieces[:k])
    assert len(fill_in_middle.lane_nodes(5000)) > 3


def test_word_units_hold_their_space():
    text = "  one two\n three"
    byte_at, _ = fill_in_middle.unit_starts(np.frombuffer(text.encode(), np.uint8), "word")
    assert [text[a:b] for a, b in zip(byte_at, byte_at[1:])] == ["  one ", "two\n ", "three"]


@pytest.mark.parametrize("unit", fill_in_middle.UNITS)
def test_fim_odd_rows(spark, empty, unit, monkeypatch):
    monkeypatch.setattr(fill_in_middle, "SHARD_BYTES", 900)
    rows = [*odd_rows(), *[(k, f"é{k} <S> x", "en", "s") for k in (90, 91)], *[(k, "é" * k + "<P", "en", "s") for k in range(100, 160)],
            (100, "é" * 100 + "<P", "en", "s"), (161, "S>a<", "en", "s")]
    got = fill_in_middle.restore(fill_in_middle.transform(table(spark, rows), unit))
    out = got.collect()
    assert len(out) == len(rows) and {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert all(r["restored"] == (r["text"] or "") and r["score"] == "x" for r in out)
    key = lambda r: (str(r[0]), str(r[1]))
    if unit == "char":
        for r, (d, t, *_) in zip(sorted(out, key=key), sorted(rows, key=key)):
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == fim_row(d, t)
    assert fill_in_middle.transform(empty, unit).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle.transform(empty, "byte")
