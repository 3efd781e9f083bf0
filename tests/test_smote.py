import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.ml.smote import balance, nearest_vectors, smote
from churnlake.session import stage


@pytest.fixture(scope="module")
def points(customers):
    x = F.array(F.coalesce(F.col("tenure").cast("double"), F.lit(0.0)), F.col("monthly_charges").cast("double"),
                (F.col("total_charges").cast("double")), F.when(F.col("contract") == "Two year", 1.0).otherwise(0.0))
    return stage(customers.select("customer_id", x.alias("x"), F.when(F.col("churn") == "Yes", 1).otherwise(0).alias("label")))


@pytest.mark.parametrize("size", [10**6, 60])
def test_neighbours_are_exact(points, size):
    distinct = stage(points.groupBy("x").agg(F.min("customer_id").alias("vid")).select("vid", "x"))
    rows = distinct.collect()
    x = np.array([r["x"] for r in rows])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :5]
    got = {}
    for r in nearest_vectors(distinct, 5, size).collect():
        got.setdefault(r["vid"], []).append(r["distance"])
    for r, w in zip(rows, want):
        assert sorted(got[r["vid"]]) == pytest.approx(w.tolist(), abs=1e-7)


def test_balanced_and_on_segments(points):
    counts = {r["label"]: r["count"] for r in balance(points).groupBy("label").count().collect()}
    assert counts[0] == counts[1]
    minority = {tuple(r["x"]) for r in points.filter("label = 1").collect()}
    known = np.array(sorted(minority))
    made = smote(points).collect()
    assert len({r["customer_id"] for r in made}) == len(made)
    originals = {r["customer_id"]: r["x"] for r in points.collect()}
    for r in made[::40]:
        a = np.array(originals[r["customer_id"].split("-")[1]])
        y = np.array(r["x"])
        near = known[np.argsort(((known - a) ** 2).sum(axis=1), kind="stable")[:7]]
        gap = min(np.linalg.norm(y - a) + np.linalg.norm(b - y) - np.linalg.norm(b - a) for b in near)
        assert gap == pytest.approx(0, abs=1e-6)


def test_repeatable_and_copies(spark):
    rows = [(f"a{i}", [1.0, 2.0], 1) for i in range(4)] + [("b", [1.5, 2.0], 1)] + [(f"n{i}", [9.0, float(i)], 0) for i in range(15)]
    df = stage(spark.createDataFrame(rows, "customer_id string, x array<double>, label int"))
    first = sorted(map(str, smote(df).collect()))
    assert len(first) == 10 and first == sorted(map(str, smote(df).collect()))


def test_vectors_are_sent_to_few_cells(spark, monkeypatch):
    """Groups lie apart along two features of 42: cuts along them bound the search, and lone vectors ask for few cells too."""
    import churnlake.ml.smote as module

    asked, search = [], module._searched
    monkeypatch.setattr(module, "_searched", lambda rows, cells, k: asked.append(rows.count()) or search(rows, cells, k))
    rng = np.random.default_rng(1)
    x = np.concatenate([np.repeat(rng.integers(0, 40, (25, 2)) * 10.0, 40, axis=0), rng.integers(0, 2, (1000, 40)) + rng.random((1000, 40)) / 10], axis=1)
    x = np.concatenate([x, np.eye(42)[:2] * 1e6])
    df = stage(spark.createDataFrame([(f"v{i:04}", r.tolist()) for i, r in enumerate(x)], "vid string, x array<double>"))
    got = {}
    for r in nearest_vectors(df, 5, 64).collect():
        got.setdefault(r["vid"], []).append(r["distance"])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    for i, want in enumerate(np.sort(d, axis=1)[:, :5]):
        assert sorted(got[f"v{i:04}"]) == pytest.approx(want.tolist(), abs=1e-9)
    assert asked[-1] < 2 * len(x)


@pytest.mark.parametrize("wider, pairs", [(4, 10**9), (1, 10**9), (1, 0)])
def test_shared_neighbours_give_the_rows_of_a_search_of_its_own(spark, monkeypatch, wider, pairs):
    """Samples of a table with copies: long lists, lists that fall short, and those of too many vectors to compare all."""
    import churnlake.ml.smote as module

    monkeypatch.setattr(module, "WIDER", wider)
    monkeypatch.setattr(module, "PAIRS", pairs)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 6, (160, 3)).astype(float), rng.random((240, 3)) * 9])
    rows = [(f"c{i:03}", r.tolist(), int(i % 5 < 2), i % 3) for i, r in enumerate(x)]
    df = stage(spark.createDataFrame(rows, "customer_id string, x array<double>, label int, part int"))
    shared = module.shared_neighbours(df, cell=32)
    for sample in (df, df.filter("part != 0"), df.filter("part = 1"), df.filter("label = 0 OR customer_id < 'c010'")):
        one = stage(sample)
        want = sorted(map(str, smote(one).collect()))
        assert want and sorted(map(str, smote(one, shared=shared).collect())) == want
    few = stage(df.filter("label = 1 OR customer_id < 'c050'"))            # the other class is the smaller one here
    assert sorted(map(str, smote(few, shared=shared).collect())) == sorted(map(str, smote(few).collect()))
