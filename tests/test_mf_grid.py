"""Trainers over the broadcast bound: packed profiles and ratings in a grid of blocks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyho.operators import blocks, mf


@pytest.fixture()
def ratings(spark):
    rows = [(i, j, float((7 * i + j) % 5), (i + j) % 3) for i in range(14) for j in range(11) if (i * j) % 4 != 1]
    rows += [(0, j % 11, 1.5, j % 3) for j in range(100)] + [(i, 2, 0.5, i % 3) for i in range(14)]
    return spark.createDataFrame(rows, "i BIGINT, j BIGINT, r DOUBLE, fold INT")


def in_grid(monkeypatch):
    """From now on nothing is broadcast, columns differ from rows, and a block has several parts of both sides."""
    monkeypatch.setattr(mf, "profile_broadcast_rows", lambda d: 1)
    for name, value in {"GRID_ITEMS": 2, "GRID_PART": 1, "GRID_ROW": 2, "GRID_STEP": 16}.items():
        monkeypatch.setattr(blocks, name, value, raising=False)


def factors(fit):
    return {(side, r[0]): list(r[1]) for side, t in (("u", fit.U), ("v", fit.V)) for r in t.collect()}


def numbers(history):
    return [-1.0 if v is None else v for h in history for v in h[:-1]]


def same(a, b):
    a, b = factors(a), factors(b)
    assert a.keys() == b.keys()
    assert [x for k in a for x in b[k]] == pytest.approx([x for k in a for x in a[k]], rel=1e-9, abs=1e-12)


def test_grids_of_any_shape_give_the_same_factors(spark, ratings, monkeypatch):
    train, test = mf.fold_split(ratings, 1)
    kw = dict(d=3, gain=0.01, lam=0.1, mu=0.2, maxiter=3, seed=5)
    want, want_cv = mf.train(train, test, **kw), mf.cross_validate(ratings, folds=4, **kw)[1]
    in_grid(monkeypatch)
    grid = blocks.lay_out_grid(ratings, users=14, items=11)
    assert (grid.n, grid.columns, len(set(grid.labels))) == (4, 6, 24) and grid.user_parts > 1 and grid.item_parts > 1
    grid.drop()
    got = mf.train(train, test, **kw)
    same(want, got)
    assert numbers(got.history) == pytest.approx(numbers(want.history), rel=1e-9)
    for (_, a, g), (_, b, h) in zip(want_cv, mf.cross_validate(ratings, folds=4, **kw)[1]):
        assert a == (b if a is None else pytest.approx(b, rel=1e-9)) and numbers(g) == pytest.approx(numbers(h), rel=1e-9)


def test_models_end_in_a_grid_as_they_do_without(spark, ratings, monkeypatch, tmp_out):
    """Divergence, no iterations, models that stop one by one, and a run that goes on from its log."""
    broken = dict(d=2, gain=50.0, power=0.0, maxiter=30, seed=1)
    cases = [broken, dict(d=2, maxiter=0, seed=5), dict(d=2, maxiter=3, seed=5, epsilon=1e9)]
    want = [mf.train(ratings, None, **c) for c in cases]
    uneven = ratings.where("fold < 2 or i < 3")
    stops = dict(d=2, folds=3, maxiter=4, seed=9, gain=0.01)
    objectives = [[h[2] for h in hs if h[2] is not None] for _, _, hs in mf.cross_validate(uneven, **stops)[1]]
    stops["epsilon"] = sorted(c[1] for c in objectives)[1]          # some stop after three iterations, others go on
    want_cv = mf.cross_validate(uneven, **stops)[1]
    assert len({len(hs) for _, _, hs in want_cv}) > 1
    straight = mf.train(ratings, None, d=2, maxiter=3, seed=3)
    in_grid(monkeypatch)
    for a, c in zip(want, cases):
        b = mf.train(ratings, None, **c)
        assert a.diverged == b.diverged and len(a.history) == len(b.history)
        if a.diverged:
            assert factors(a).keys() == factors(b).keys() and np.isfinite(list(factors(b).values())).all()
        else:
            same(a, b)
    for (_, _, g), (_, _, h) in zip(want_cv, mf.cross_validate(uneven, **stops)[1]):
        assert numbers(g) == pytest.approx(numbers(h), rel=1e-9)
    mf.train(ratings, None, d=2, maxiter=1, seed=3, log=f"{tmp_out}/log")
    same(straight, mf.train(ratings, None, d=2, maxiter=3, seed=3, log=f"{tmp_out}/log"))


def test_steps_leave_no_shuffle_files(spark, ratings, monkeypatch):
    """files of the steps before are gone when a model's next step begins."""
    in_grid(monkeypatch)
    disk, kept, step = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), [], mf._moved_on_grid

    def counted(*args):
        files = disk.getAllFiles()
        kept.append(sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size())))
        return step(*args)

    monkeypatch.setattr(mf, "_moved_on_grid", counted)
    mf.cross_validate(ratings, folds=3, d=2, maxiter=4, seed=9)
    assert len(kept) == 12 and max(kept) < kept[0] + 24


def test_a_block_keeps_items_and_lets_users_and_ratings_pass(spark, ratings):
    """sums of a group of users leave a block before the next group is read, ratings come in many rows."""
    U, V = np.array([[0.5, 1.0], [0.25, -1.0]]), np.array([[1.0, 2.0], [-1.0, 0.5], [0.0, 3.0]])
    kinds = [f"{x.split()[0]}" for x in blocks.PACKED_PROFILES.split(",")]
    assert kinds == blocks.PACKED_COLUMNS

    def row(at, kind, a, b, c=None, e=None):
        ints = [pa.array([x], pa.int32()) for x in (7, at, kind, 0 if kind < 2 else None, 0, max(at, 0))]
        return pa.RecordBatch.from_arrays([*ints, *(pa.array([None if x is None else x.tobytes()], pa.binary()) for x in (a, b, c, e))],
                                          ["block", "at", "kind", "f", "line", "sub", "a", "b", "c", "e"])

    ids = lambda *x: np.array(x, np.int64)
    fold = lambda *x: np.array(x, np.int32)
    rows = [row(-1, 1, ids(3, 4, 5), V)]
    for g in range(2):
        rows += [row(g, 0, ids(g), U[g:g + 1]), row(g, 2, ids(g, g), np.array([1.0, 2.0]), ids(3, 5), fold(-1, -1)),
                 row(g, 2, ids(g), np.array([4.0]), ids(4), fold(0))]
    read = []
    out = blocks._block_sums(2)(read.append(k) or r for k, r in enumerate(rows))
    first = next(out)
    assert len(read) == 5 and first.column("kind").to_pylist() == [0]
    e = [[U[g] @ V[0] - 1.0, U[g] @ V[2] - 2.0] for g in range(2)]
    assert np.frombuffer(first.column("p")[0].as_py()) == pytest.approx(2 * e[0][0] * V[0] + 2 * e[0][1] * V[2])
    second, items, totals = out
    assert np.frombuffer(second.column("p")[0].as_py()) == pytest.approx(2 * e[1][0] * V[0] + 2 * e[1][1] * V[2])
    assert np.frombuffer(items.column("ids")[0].as_py(), np.int64).tolist() == [3, 5]      # item 4 has a held-out rating only
    assert np.frombuffer(items.column("p")[0].as_py()).reshape(2, 2) == pytest.approx(
        np.array([2 * sum(e[g][k] * U[g] for g in range(2)) for k in range(2)]))
    held = [(U[g] @ V[1] - 4.0) ** 2 for g in range(2)]
    assert [totals.column(c)[0].as_py() for c in ("n", "n_held")] == [4, 2]
    assert totals.column("se")[0].as_py() == pytest.approx(sum(x * x for g in e for x in g))
    assert totals.column("se_held")[0].as_py() == pytest.approx(sum(held))
    # a Parquet batch of packed ratings holds few of them
    before = spark.conf.get(blocks.READER_ROWS)
    with blocks.short_batches(spark):
        assert int(spark.conf.get(blocks.READER_ROWS)) <= 64
    assert spark.conf.get(blocks.READER_ROWS) == before
