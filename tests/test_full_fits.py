"""Registered trainers that run to their own stop, against plain fits."""

import numpy as np
import pytest

from __spark_entry__ import queries
from tallyho.plans import logreg as logreg_plans
from tallyho.plans import mf as mf_plans
from tallyho.sources import tables

SMALL = "/root/testdata/sf0.001"


def brute_logreg(points, cells, lam, max_iter=40, eps=0.1):
    feats = sorted({c["feat"] for c in cells})
    at, row = {f: k for k, f in enumerate(feats)}, {p["id"]: k for k, p in enumerate(points)}
    x, y = np.zeros((len(points), len(feats))), np.array([p["y"] for p in points])
    for c in cells:
        x[row[c["id"]], at[c["feat"]]] += c["x"]
    loss = lambda b: np.logaddexp(0, -y * (x @ b)).sum() + lam * b @ b
    beta, done = np.zeros(len(feats)), 0
    for _ in range(max_iter):
        g = x.T @ (-y / (1 + np.exp(y * (x @ beta)))) + 2 * lam * beta
        t = 1.0
        while loss(beta - t * g) > loss(beta) - 0.2 * t * (g @ g):
            t *= 0.6
        beta, done = beta - t * g, done + 1
        if np.sqrt(g @ g) <= eps:
            break
    return dict(zip(feats, beta)), done


def test_logreg_train_full_is_trained(spark):
    points, cells = (t.collect() for t in tables.labelled_points(spark, SMALL))
    want, steps = brute_logreg(points, cells, logreg_plans.LAM)
    got = {r["feat"]: r["value"] for r in queries()["logreg_train_full"](spark, SMALL).collect()}
    assert steps > logreg_plans.TRAIN_STEPS and got.keys() == want.keys()
    assert max(abs(got[f] - want[f]) for f in want) < 2e-6


def brute_mf(train, test, maxiter=20):
    d, scale, freq = mf_plans.D, mf_plans.INIT_SCALE, mf_plans.FREQ
    i, j, r = (np.array([t[c] for t in train]) for c in "ijr")
    users, ui = np.unique(i, return_inverse=True)
    items, vj = np.unique(j, return_inverse=True)
    U, V = (scale * np.sin(ids[:, None] * (np.arange(d) + 1) * freq) for ids in (users, items))
    pu, pv = {u: k for k, u in enumerate(users)}, {v: k for k, v in enumerate(items)}
    for it in range(1, maxiter + 1):
        known = [(pu[t["i"]], pv[t["j"]], t["r"]) for t in test if t["i"] in pu and t["j"] in pv]
        rmse = np.sqrt(sum((U[a] @ V[b] - x) ** 2 for a, b, x in known) / len(test))
        delta = (U[ui] * V[vj]).sum(axis=1) - r
        gamma = mf_plans.GAIN / it ** mf_plans.POWER
        gu, gv = np.zeros_like(U), np.zeros_like(V)
        np.add.at(gu, ui, 2 * delta[:, None] * V[vj])
        np.add.at(gv, vj, 2 * delta[:, None] * U[ui])
        U, V = U - gamma * (gu + 2 * mf_plans.LAM * U), V - gamma * (gv + 2 * mf_plans.MU * V)
    rows = {("user", int(u)): U[k] for k, u in enumerate(users)} | {("item", int(v)): V[k] for k, v in enumerate(items)}
    return rows, rmse


@pytest.fixture(scope="module")
def ratings(spark):
    return tables.lineitem_ratings(spark, SMALL, mf_plans.FOLDS).collect()


@pytest.mark.parametrize("key", ["mf_train_full", "mf_fit_all_full"])
def test_mf_full_fits_are_trained(spark, ratings, key):
    train = [r for r in ratings if key == "mf_fit_all_full" or r["fold"] != mf_plans.TEST_FOLD]
    want, _ = brute_mf(train, train)
    got = {(r["side"], r["id"]): [r[f"f{k}"] for k in range(mf_plans.D)] for r in queries()[key](spark, SMALL).collect()}
    assert got.keys() == want.keys()
    assert max(np.abs(np.array(got[k]) - want[k]).max() for k in want) < 2e-6


def test_mf_cv_rmse_full_is_the_trained_models(spark, ratings):
    want = np.mean([brute_mf([r for r in ratings if r["fold"] != k], [r for r in ratings if r["fold"] == k])[1]
                    for k in range(mf_plans.FOLDS)])
    row = queries()["mf_cv_rmse_full"](spark, SMALL).first()
    assert row["folds"] == mf_plans.FOLDS and abs(row["cv_rmse"] - want) < 2e-6
