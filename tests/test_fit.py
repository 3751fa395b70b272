"""Fit quality on planted-factor data: the ratings of the driver tables carry no signal."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelrank.operators import joint
from reelrank.operators.joint import fit_joint
from reelrank.operators.model import bias_sweeps, fit_biases, fit_mf, load_model, save_model
from reelrank.operators.scoring import estimate_pairs


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    nu, ni, f = 200, 100, 3
    P, Q = rng.normal(0, 0.8, (nu, f)), rng.normal(0, 0.8, (ni, f))
    bu, bi = rng.normal(0, 0.3, nu), rng.normal(0, 0.3, ni)
    obs = rng.random((nu, ni)) < 0.3
    u, i = np.nonzero(obs)
    r = np.clip(3 + bu[u] + bi[i] + (P[u] * Q[i]).sum(1) + rng.normal(0, 0.3, len(u)), 1, 5)
    test = rng.random(len(u)) < 0.2
    pdf = pd.DataFrame({"customer_id": u, "movie_id": i, "rating": r.astype("float32")})
    mk = lambda m: spark.createDataFrame(pdf[m], "customer_id long, movie_id long, rating float")
    return mk(~test), mk(test)


def _rmse(df):
    return df.agg(F.sqrt(F.avg((F.col("est") - F.col("rating")) ** 2))).first()[0]


def test_als_on_residuals_beats_biases(spark, planted):
    train, test = planted
    bias = fit_biases(train, 0.05, 3).as_mf()
    mf = fit_mf(train, rank=3, reg=0.05, max_iter=10, seed=42)
    b, m = _rmse(estimate_pairs(test, bias)), _rmse(estimate_pairs(test, mf))
    assert m < 0.6 * b, (m, b)


def test_bias_objective_never_rises(spark, planted):
    train, _ = planted
    r = train.select("customer_id", "movie_id", F.col("rating").cast("double").alias("r"))
    mu = r.agg(F.avg("r")).first()[0]
    lam = 0.05
    prev = None
    for s in range(1, 5):
        users, items = bias_sweeps(r, mu, lam, s)
        j = r.join(users, "customer_id").join(items, "movie_id")
        obj = j.agg(F.sum((F.col("r") - mu - F.col("b_u") - F.col("b_i")) ** 2
                          + lam * (F.col("b_u") ** 2 + F.col("b_i") ** 2))).first()[0]
        if prev is not None:
            assert obj <= prev + 1e-9
        prev = obj


def test_model_tables_round_trip(spark, tiny_model, tmp_path):
    save_model(tiny_model, str(tmp_path / "m"))
    back = load_model(spark, str(tmp_path / "m"))
    assert back.global_mean == tiny_model.global_mean and back.rank == tiny_model.rank
    pairs = spark.createDataFrame([(u, i) for u in range(21) for i in range(16)],
                                  "customer_id long, movie_id long")
    a = estimate_pairs(pairs, tiny_model).orderBy("customer_id", "movie_id").collect()
    b = estimate_pairs(pairs, back).orderBy("customer_id", "movie_id").collect()
    assert [r.est for r in a] == [r.est for r in b]


def test_fit_with_ids_beyond_int_range(spark, planted):
    train, test = planted
    shift = lambda df: (df.withColumn("customer_id", F.col("customer_id") + (1 << 40))
                        .withColumn("movie_id", F.col("movie_id") + (3 << 33)))
    tr, te = shift(train), shift(test)
    bias = fit_biases(tr, 0.05, 3).as_mf()
    mf = fit_mf(tr, rank=3, reg=0.05, max_iter=10, seed=42)
    assert mf.user_factors.filter(F.col("p").isNull()).count() == 0
    b, m = _rmse(estimate_pairs(te, bias)), _rmse(estimate_pairs(te, mf))
    assert m < 0.6 * b, (m, b)


def _objective(train, model, lam):
    j = (train.join(model.user_factors, "customer_id").join(model.item_factors, "movie_id").toPandas())
    p, q = np.vstack(j.p), np.vstack(j.q)
    e = j.rating.astype(float) - model.global_mean - j.b_u - j.b_i - (p * q).sum(1)
    return float((e ** 2 + lam * (j.b_u ** 2 + j.b_i ** 2 + (p ** 2).sum(1) + (q ** 2).sum(1))).sum())


def test_joint_fit_falls_and_reaches_als(spark, planted):
    train, test = planted
    model = fit_joint(train, rank=3, reg=0.05, max_iter=6, seed=42)
    steps = model.params["objective"]
    assert len(steps) == 6 and all(b <= a for a, b in zip(steps, steps[1:]))
    assert abs(steps[-1] - _objective(train, model, 0.05)) < 1e-6 * steps[-1]
    als = fit_mf(train, rank=3, reg=0.05, max_iter=10, seed=42)
    assert _rmse(estimate_pairs(test, model)) <= 1.02 * _rmse(estimate_pairs(test, als))
    assert _objective(train, model, 0.05) <= _objective(train, als, 0.05)


def test_joint_fit_does_not_depend_on_how_it_is_dealt(spark, planted, monkeypatch):
    """Hot keys in blocks of their own over several tasks, small blocks, ratings folded early and
    cells of several rows give the same vectors."""
    train, _ = planted
    items = train.select("movie_id").distinct()
    start = items.select("movie_id", F.array((F.col("movie_id") % 7 - 3) / 10.0, F.lit(0.1)).alias("q"))

    def fit(**kw):
        m = fit_joint(train, rank=2, reg=0.05, max_iter=2, start=start, **kw)
        u = m.user_factors.orderBy("customer_id").toPandas()
        i = m.item_factors.orderBy("movie_id").toPandas()
        return np.column_stack([u.b_u, np.vstack(u.p)]), np.column_stack([i.b_i, np.vstack(i.q)])

    want = fit()
    monkeypatch.setattr(joint, "HOLD_RATINGS", 40)
    monkeypatch.setattr(joint, "CELL_RATINGS", 7)
    monkeypatch.setattr(joint, "BLOCK_BYTES", 8 * 9 * 60)
    got = fit(hot_ratings=58)
    assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(want, got, strict=True))
    with pytest.raises(ValueError):
        fit_joint(train.limit(0), rank=2)


def test_a_save_that_dies_leaves_the_old_model(spark, tiny_model, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    save_model(tiny_model, path)
    other = type(tiny_model)(9.0, tiny_model.user_factors.limit(1), tiny_model.item_factors.limit(1),
                             rank=tiny_model.rank)
    monkeypatch.setattr(type(other), "meta", lambda self, spark: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        save_model(other, path)                    # dies after two of three tables
    monkeypatch.undo()
    back = load_model(spark, path)
    assert back.global_mean == tiny_model.global_mean
    assert back.item_factors.count() == tiny_model.item_factors.count()
    save_model(other, path)
    assert load_model(spark, path).global_mean == 9.0
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "nothing"))


def test_a_folded_block_of_many_keys_is_solved_whole():
    """More keys than are solved at once, held together or folded on the way: the same vectors."""
    import numpy as np

    from reelrank.operators import joint
    rng = np.random.default_rng(3)
    keys, other, rank = 2 * joint.SOLVE_AT_ONCE + 9, 40, 2
    own = np.r_[np.arange(keys), rng.integers(0, keys, 3000)].astype(np.int32)
    item = rng.integers(0, other, len(own)).astype(np.int32)
    target = rng.normal(size=len(own))
    vectors = rng.normal(size=(other, rank + 1))

    def solved(hold):
        block = joint.Block(rank, hold)
        block.message(np.arange(other, dtype=np.int32).tobytes(), vectors.tobytes())
        for i in range(0, len(own), 500):
            block.cell(0, *(x[i:i + 500].tobytes() for x in (own, item, target)))
        return block.solve(0.05)

    held, folded = solved(10 ** 9), solved(700)
    assert len(held[0]) == len(folded[0]) == keys
    assert np.allclose(held[0], folded[0]) and np.allclose(held[1:], folded[1:])
