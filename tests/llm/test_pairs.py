"""Jaccard join, BWT dedup and decontamination against brute force."""

import random
import tracemalloc

import numpy as np
import pytest

from tallyho.llm import bwt_dedup, decontaminate, jaccard_join, star_links, superminhash
from tests.llm import brute
from tests.llm.conftest import odd_rows, prose, table

MEDIUM = "/root/testdata/sf0.001"


def near_copies(seed=5):
    r = random.Random(seed)
    rows, n = [], 0
    for g in range(6):
        base = prose(100 + g, r.choice([8, 14, 40, 130, 260])).split(" ")
        for c in range(r.choice([1, 3, 9])):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(words) // 60))):
                words[r.randrange(len(words))] = f"new{r.randint(0, 3)}"
            rows.append((n, " ".join(words), "en", "s"))
            n += 1
    line = prose(999, 45)
    rows += [(n + k, line + f" tail{k}", "en", "s") for k in range(30)]
    return rows


def unique_ids(rows):
    return {d: (d, t) for d, t, *_ in rows if d is not None}.values()


@pytest.mark.parametrize("words,percent,rare,crowd", [(3, 90, 64, 4), (3, 80, 1, 20), (3, 80, 1, 2.5), (2, 85, 3, 0), (3, 90, 0, 1e9)])
def test_join_equals_all_pairs(spark, words, percent, rare, crowd):
    rows = near_copies()
    got = jaccard_join.join(table(spark, rows), words, percent, rare, crowd).collect()
    want = brute.components([(d, t) for d, t, *_ in rows], words, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(rows)


def test_pair_keys_are_bounded(spark):
    """Sets that share their whole prefix are not indexed by all its pairs, and
    boilerplate in otherwise different sets is."""
    copies = [(k, 200, [(300, t) for t in range(60)]) for k in range(300)]
    # 44 shingles that few sets have, then 16 that 90 sets have: two of these are in the longer prefix
    other = [(1000 + k, 200, [(2, 10_000 + 50 * k + j) for j in range(44)] + [(90, 900 + j) for j in range(16)]) for k in range(90)]
    grouped = spark.createDataFrame(copies + other, "cls long, n long, tokens array<struct<df: long, token: long>>")
    got = jaccard_join.keys(grouped, 80, 64, 4).collect()
    rows = {c: sum(r["cls"] == c for r in got) for c in (0, 299, 1000, 1089)}
    # 60 - 16 + 1 shingles and one more, each under two bands
    assert rows[0] == rows[299] == 2 * 46 and rows[1000] == rows[1089] == 2 * (44 + 1)
    assert len(got) == len(set(got))


def test_small_keys_chain_no_group(spark, monkeypatch):
    """Small keys are settled by pairs: texts of other kinds are not compared
    by their differences from a leader that is far from all of them."""
    family = {k: set(range(100)) - set(range(k, k + 15)) | {1000 * k + 100 + j for j in range(15)} for k in range(1, 41)}
    others = {100 + k: {-1000 * k - j for j in range(200)} for k in range(40)}
    others[300], others[301] = {10 ** 6 + j for j in range(50)}, {10 ** 6 + j for j in range(2, 52)}
    sets = family | others
    keys = {1: list(family), 2: [100, 300, 301]}
    for k in range(40):
        for step in (1, 2, 3):
            keys[10 * k + 20 + step] = [100 + k, 100 + (k + step) % 40, k + 1]
    found = []
    plain = star_links.differences
    monkeypatch.setattr(star_links, "differences", lambda rows, *a: found.extend(rows.collect()) or plain(rows, *a))
    members = spark.createDataFrame([(k, c, len(sets[c])) for k, cs in keys.items() for c in cs], "key long, cls long, n long")
    whole = spark.createDataFrame([(c, len(s), sorted(s)) for c, s in sets.items()], "cls long, n long, tokens array<long>")
    comps = {r["cls"]: r["comp"] for r in star_links.link_classes(members, whole, 80).collect()}
    links = {frozenset((a, b)) for cs in keys.values() for a in cs for b in cs if a < b and 180 * len(sets[a] & sets[b]) >= 80 * (
        len(sets[a]) + len(sets[b]))}
    assert {frozenset(c for c in comps if comps[c] == g) for g in comps.values()} == links == {frozenset((300, 301))}
    assert found and {r["cls"] for r in found} <= set(family)


def test_components_take_few_tasks(spark, monkeypatch):
    """Tables of a few ids are not written by a task for every shuffle partition."""
    tables, plain = [], star_links.written
    monkeypatch.setattr(star_links, "written", lambda *a: tables.append(plain(*a)) or tables[-1])
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = star_links.components(spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 301 and {r["comp"] for r in got} == {0}
    assert tables and max(len(t.inputFiles()) for t in tables) == 1


def test_chain_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 99)], "a long, b long")
    got = {r["cls"]: r["comp"] for r in star_links.components(edges).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 99: 99, 100: 99}


def test_join_odd_rows(spark, odd, empty):
    got = jaccard_join.join(odd).collect()
    want = brute.components(unique_ids(odd_rows()), 5, 80)
    assert len(got) == len(odd_rows())
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == sorted(d for d, (_, c) in want.items() if c == d) and ids.count(None) == 1
    assert jaccard_join.join(empty).count() == 0 and jaccard_join.keep_one(empty).count() == 0


def test_keep_one_loses_no_text_of_an_id(spark):
    a, b = prose(61, 40), prose(62, 40)
    rows = [(3, a, "en", "s"), (3, b, "en", "s"), (2, b + " tail", "en", "s"), (4, a, "en", "s"), (4, a, "en", "s"), (5, b, "en", "s"),
            (7, "", "en", "s"), (3, a, "en", "s"), (None, a, "en", "s")]
    got = jaccard_join.keep_one(table(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted([("3", a), ("2", b + " tail"), ("7", ""), ("None", a)])
    assert all(r["score"] == "x" and r["component_id"] == "x" for r in got)


def test_dedup_equals_brute_force(spark):
    r = random.Random(4)
    shared = [prose(50 + k, 25) for k in range(4)]
    rows = []
    for d in range(25):
        text = "".join(r.choice([prose(d * 7 + k, r.randint(1, 30)), r.choice(shared), "é" * r.choice([10, 70, 130])])
                       for k in range(r.randint(0, 5)))
        rows.append((d, text, "en", "s"))
    rows.append((25, "ab" * 400 + shared[0] + shared[0], "en", "s"))
    got = {r["doc_id"]: tuple(r)[1:] for r in bwt_dedup.dedup(table(spark, rows)).collect()}
    assert got == brute.removed([(d, t) for d, t, *_ in rows])


def test_dedup_crowded_anchor(spark, monkeypatch):
    """An anchor with many windows is compared in passes, same result."""
    monkeypatch.setattr(bwt_dedup, "CHUNK_WINDOWS", 30)
    line = prose(77, 60)
    rows = [(d, f"{d} " * d + line + f" {d}", "en", "s") for d in range(12)]
    got = {r["doc_id"]: tuple(r)[1:] for r in bwt_dedup.dedup(table(spark, rows)).collect()}
    assert got == brute.removed([(d, t) for d, t, *_ in rows])


def test_dedup_odd_rows(spark, odd, empty):
    got = bwt_dedup.dedup(odd, with_kept=True).collect()
    want = brute.removed(unique_ids(odd_rows()))
    assert len(got) == len(odd_rows())
    for r in got:
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]
        if r["doc_id"] is not None:
            assert tuple(r)[1:5] == want[r["doc_id"]]
    assert bwt_dedup.dedup(empty).count() == 0


def test_merge_is_the_transform_of_the_union():
    r = np.random.default_rng(1)
    for n, k in [(1, 1), (7, 3), (200, 8), (500, 5)]:
        symbols = [r.integers(0, 3, n).astype(np.uint64) for _ in range(5)]
        again, first = bwt_dedup.repeated(symbols, k)
        rows = list(zip(*[s.tolist() for s in symbols]))
        seen, want = {}, {}
        for i, x in enumerate(rows):
            if x in seen:
                want[i] = seen[x]
            else:
                seen[x] = i
        assert dict(zip(again.tolist(), first.tolist())) == want


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "SHARD_BYTES", 700)
    rows = [(1, prose(1, 600), "en", "s"), (2, "start " + prose(1, 600)[500:2600], "en", "s")]
    got = {r["doc_id"]: tuple(r)[1:] for r in bwt_dedup.dedup(table(spark, rows)).collect()}
    assert got == brute.removed([(d, t) for d, t, *_ in rows])


BENCH = [(1, prose(31, 30)), (2, "Short item"), (3, None), (4, "..."), (5, prose(31, 30)), (None, "gone words"), (10, prose(32, 13))]


def bench_table(spark, rows=BENCH):
    return spark.createDataFrame(rows, "item_id long, text string")


def contaminated_rows():
    return odd_rows() + [(20, "before " + BENCH[0][1].upper() + " after", "en", "s"), (21, "a SHORT-item! b", "en", "s"),
                         (22, prose(5, 900) + BENCH[6][1], "en", "s"), (23, BENCH[0][1][:60], "en", "s")]


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 150])
def test_contamination_equals_brute_force(spark, block_bytes):
    rows = contaminated_rows()
    got = decontaminate.contamination(table(spark, rows), bench_table(spark), block_bytes=block_bytes).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    want = brute.contamination([(d, t) for d, t, *_ in rows], [b for b in BENCH if b[0] is not None])
    assert len(got) == len(rows)
    assert all(tuple(r)[1:] == want[r["doc_id"]] for r in got)
    assert {20, 21} <= {r["doc_id"] for r in got if r["contaminated"]}


def test_longest_matches(spark):
    docs = table(spark, [(1, "x " + BENCH[0][1] + " y", "en", "s")])
    got = decontaminate.longest_matches(docs, bench_table(spark)).collect()
    words = len(brute.ALNUM.findall(brute.lower(BENCH[0][1]).encode()))
    assert {tuple(r) for r in got} == {(1, "1", 0, 1, words), (1, "5", 0, 1, words)}


def test_decontaminate_edges(spark, odd, empty):
    clean = decontaminate.decontaminate(odd, bench_table(spark))
    assert clean.columns == odd.columns and clean.count() == len(odd_rows())
    assert decontaminate.decontaminate(empty, bench_table(spark)).count() == 0
    none = decontaminate.contamination(odd, bench_table(spark, []))
    assert none.where("contaminated or n_hit > 0").count() == 0


def test_hits_come_from_the_longest_matches(monkeypatch):
    r = random.Random(12)
    say = lambda n: " ".join(r.choice(["a", "b", "c"]) for _ in range(n))
    items = [(f"i{k}", say(r.randint(1, 9))) for k in range(12)]
    docs = [say(r.randint(0, 40)) for _ in range(30)]
    docs += ["z " + docs[3], items[0][1] + " z " + items[1][1]]
    calls, longest = [], decontaminate.longest
    monkeypatch.setattr(decontaminate, "longest", lambda *a: calls.append(1) or longest(*a))
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    limits = np.cumsum([0] + [len(d) for d in docs])
    n, spans, found = decontaminate.search_shard(data, limits, decontaminate.TestSet(items, 4))
    assert calls
    for d, k, s, f in zip(docs, n.tolist(), spans, found):
        words, hit, names = d.split(), set(), set()
        for name, text in items:
            t = text.split()
            size = min(4, len(t))
            for p in range(len(t) - size + 1):
                for q in range(len(words) - size + 1):
                    if words[q:q + size] == t[p:p + size]:
                        hit |= set(range(q, q + size))
                        names.add(name)
        assert k == len(words) and f == sorted(names)
        assert [x for a, b in zip(s[::2], s[1::2]) for x in range(a, b)] == sorted(hit)


def test_one_block_at_a_time_is_on_the_driver(spark, monkeypatch):
    import gc
    import weakref

    class Items(list):
        pass

    read, alive, most = decontaminate.block_items, weakref.WeakSet(), []

    def watched(*a):
        gc.collect()
        most.append(len(alive))         # of the blocks before this one
        items = Items(read(*a))
        items.__class__.__hash__ = lambda self: id(self)
        items.__class__.__eq__ = lambda self, other: self is other
        alive.add(items)
        return items

    monkeypatch.setattr(decontaminate, "block_items", watched)
    rows = [(k, prose(50, 60) + prose(k, 40), "en", "a") for k in range(6)]
    bench = spark.createDataFrame([(f"i{k}", prose(50, 20) + prose(200 + k, 20)) for k in range(12)], "item_id string, text string")
    for block_bytes in (600, decontaminate.BLOCK_BYTES):
        got = decontaminate.contamination(table(spark, rows), bench, block_bytes=block_bytes).collect()
        assert len(got) == 6 and all(r["n_items"] == 12 and r["contaminated"] for r in got)
    assert len(most) > 3 and max(most) <= 1


def test_classes_that_can_link_to_none_meet_no_join(spark, monkeypatch):  # noqa: F811
    """Of a group only classes whose own elements leave room for a link are joined with the counts of the group's
    elements, however many the others are."""
    common, sent = list(range(1, 31)), []
    own = lambda k, n: [1000 * k + j for j in range(n)]
    rows = [(0, k, 100, 100, common + own(k, 50)) for k in range(1, 41)] + [(0, k, 100, 100, common + own(k, 2)) for k in (41, 42)]
    found = spark.createDataFrame(rows, "l long, cls long, n long, o long, d array<long>")
    comps = spark.createDataFrame([], "cls long, comp long")
    keep = star_links.written
    monkeypatch.setattr(star_links, "written", lambda df, tag: sent.append((tag, keep(df, tag))) or sent[-1][1])
    keys = star_links.needed_keys(star_links.difference_keys(found, comps, 80))
    assert {r["cls"] for r in keys.collect()} == {41, 42}
    assert {r["cls"] for r in dict(sent)["join-shared"].collect()} == {41, 42}


def test_pairs_are_compared_one_by_one(spark):  # noqa: F811
    """No Python worker holds a batch of whole sets."""
    sets = spark.createDataFrame([(1, 10, list(range(10))), (2, 10, list(range(1, 11))), (3, 9, list(range(-9, 0)))], "cls long, n long, tokens array<long>")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    for percent, linked in ((81, True), (82, False)):
        found = star_links.compared(pairs, sets, percent)
        assert {(r["a"], r["b"]): r["linked"] for r in found.collect()} == {(1, 2): linked, (1, 3): False}
        assert "Arrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_shards_take_little_memory():
    """Of a large batch the temporaries of one shard stay below 100 MB."""
    text = "".join(prose(k, 2_000) for k in range(60)) * 5
    data = np.frombuffer(text.encode(), np.uint8)[:jaccard_join.SHARD_BYTES]
    assert len(data) == jaccard_join.SHARD_BYTES == superminhash.SHARD_BYTES
    cuts = np.arange(0, len(data) + 1, 4096)
    tracemalloc.start()
    superminhash.signatures(jaccard_join.row_sets(data, cuts, 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
