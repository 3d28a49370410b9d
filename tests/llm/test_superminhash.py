"""SuperMinHash near duplicates and links by leaders against brute force."""

import random

import numpy as np
import pytest

from tallyho.llm import plans, star_links, superminhash
from tests.llm import brute
from tests.llm.conftest import odd_rows, prose, table
from tests.llm.test_pairs import near_copies


def test_signatures_estimate_the_similarity():
    r = np.random.default_rng(1)
    for n, share in ((400, 0.8), (30, 0.5), (6, 0.5), (1500, 0.2)):
        found = []
        for _ in range(150):
            u = r.integers(1, 1 << 62, size=n).astype(np.uint64)
            k = round(share * n)
            half = (n - k) // 2
            signed = superminhash.signatures([u[:k + half], np.concatenate([u[:k], u[k + half:]])])
            found.append((signed[0] == signed[1]).mean())
        true = k / n
        assert abs(np.mean(found) - true) < 0.02
        # less variance than independent minima have
        assert np.std(found) < 1.1 * (true * (1 - true) / superminhash.SLOTS) ** 0.5


def test_signatures_fill_all_slots_and_stop_early():
    r = np.random.default_rng(2)
    sets = [r.integers(1, 1 << 62, size=k).astype(np.uint64) for k in (0, 1, 2, 40, 5000)]
    signed = superminhash.signatures(sets)
    steps = (signed >> np.uint64(56)).max(axis=1)
    assert (signed[0] == superminhash._EMPTY).all() and (signed[1:] != superminhash._EMPTY).all()
    assert steps[1] == superminhash.SLOTS - 1 and sorted((signed[1] >> np.uint64(56)).tolist()) == list(range(superminhash.SLOTS))
    assert steps[4] == 0
    alone = [superminhash.signatures([s])[0] for s in sets]
    assert (np.array(alone) == signed).all()                # a batch changes nothing


@pytest.mark.parametrize("words,percent", [(4, 80), (3, 90), (5, 60)])
def test_near_duplicates_equal_all_pairs(spark, words, percent):
    rows = near_copies(words)
    got = superminhash.near_duplicates(table(spark, rows), words, percent).collect()
    want = brute.components([(d, t) for d, t, *_ in rows], words, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(rows) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_odd_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(superminhash, "SHARD_BYTES", 900)
    got = superminhash.near_duplicates(odd).collect()
    want = brute.components({d: (d, t) for d, t, *_ in odd_rows() if d is not None}.values(), 5, 80)
    assert len(got) == len(odd_rows())
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert superminhash.near_duplicates(empty).count() == 0


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    a, b = prose(61, 40), prose(62, 40)
    rows = [(3, a, "en", "s"), (3, b, "en", "s"), (2, b + " tail", "en", "s"), (4, a, "en", "s"), (4, a, "en", "s")]
    got = superminhash.near_duplicates(table(spark, rows), 4, 80).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (2, 2, True), (3, 2, False), (3, 3, True), (4, 3, False), (4, 3, False)]


def test_op13_columns(spark):
    got = plans.op13_near_dedup(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = brute.components([tuple(r) for r in docs], 4, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


def edited(n, base, r, low, high):
    """``n`` copies of ``base`` (a list), with ``low`` to ``high`` of its items replaced by new ones."""
    out = []
    for k in range(n):
        items = list(base)
        for at in r.sample(range(len(base)), r.randint(low, high)):
            items[at] = r.randrange(1 << 60)
        out.append(np.unique(np.array(items, np.int64)))
    return out


def test_edited_copies_under_the_threshold_cost_few_comparisons(spark, monkeypatch):
    """2,000 copies that share a key and mostly do not link, under a leader
    that is far from most: some comparisons a copy (of 2 million pairs), and
    all links are found."""
    r = random.Random(5)
    base = [r.randrange(1 << 60) for _ in range(100)]
    sets = edited(1900, base, r, 11, 30) + edited(90, base, r, 0, 6)
    far = edited(1, base, r, 25, 25)[0]
    sets += [far, *edited(9, far.tolist(), r, 1, 4)]
    frame = spark.createDataFrame([(k, len(s), s.tolist()) for k, s in enumerate(sets)], "cls long, n long, tokens array<long>")
    frame = star_links.written(frame, "test-sets")
    members = frame.selectExpr("7 + 0 * cls as key", "cls", "n")
    made, compared = [], star_links.compared

    def counted(pairs, *rest):
        pairs = star_links.written(pairs, "test-pairs")
        made.append(pairs.count())
        return compared(pairs, *rest)

    monkeypatch.setattr(star_links, "compared", counted)
    got = {x["cls"]: x["comp"] for x in star_links.link_classes(members, frame, 80).collect()}
    group = list(range(len(sets)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a + 1, len(sets)):
            both = len(np.intersect1d(x, sets[b], assume_unique=True))
            if 180 * both >= 80 * (len(x) + len(sets[b])):
                one, two = find(a), find(b)
                group[max(one, two)] = min(one, two)
    want = [find(k) for k in range(len(sets))]
    assert [got.get(k, k) for k in range(len(sets))] == want
    assert len(set(want)) > 1000 and sum(made) < 12 * len(sets)


def test_leader_far_from_a_linked_pair(spark):
    words = {1: "abcdefgh", 2: "pqrstuvw", 3: "pqrstuvwx"}
    frame = spark.createDataFrame([(k, len(w), [ord(c) for c in w]) for k, w in words.items()], "cls long, n long, tokens array<long>")
    members = frame.selectExpr("9L as key", "cls", "n")
    got = star_links.link_classes(members, frame, 80).collect()
    assert {(r["cls"], r["comp"]) for r in got} == {(2, 2), (3, 2)}
