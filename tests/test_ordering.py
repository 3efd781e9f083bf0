"""Global order operators against plain windows, with many small range buckets."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlake.operators.ordering import (
    By, lag_in_group, ntile_global, quantiles, quantiles_by, row_rank, running_totals, tile_ends)
from churnlake.session import stage

BUCKETS = [10**6, 100, 7]


@pytest.fixture(scope="module")
def table(customers):
    """Ties, NULL keys, NULL groups, and one group and one key that hold most rows."""
    df = customers.select("customer_id", "tenure", "total_charges", "contract", "monthly_charges")
    hot = F.when(F.crc32(F.encode("customer_id", "utf-8")) % 3 == 0, F.lit("hot")).otherwise(F.col("contract"))
    return stage(df.withColumns({"one": F.lit(1), "grp": hot, "dbl": F.col("monthly_charges").cast("double")}))


def same(a, b):
    key = lambda r: tuple(repr(x) for x in r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


@pytest.mark.parametrize("size", BUCKETS)
def test_ntile_matches_window(table, size):
    got = ntile_global(table, {
        "a": By("tenure"), "b": By("one", True), "c": By("total_charges", True), "d": By("dbl", True)},
        "customer_id", 5, size)
    w = lambda *o: Window.orderBy(*o, "customer_id")
    want = table.withColumns({
        "a": F.ntile(5).over(w(F.col("tenure").asc_nulls_last())),
        "b": F.ntile(5).over(w(F.col("one").desc_nulls_first())),
        "c": F.ntile(5).over(w(F.col("total_charges").desc_nulls_first())),
        "d": F.ntile(5).over(w(F.col("dbl").desc_nulls_first())),
    })
    assert same(got, want.select(*got.columns))
    sizes = [r["count"] for r in got.groupBy("a").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_ntile_has_no_row_shuffle(table):
    plan = ntile_global(table, {"a": By("tenure")}, "customer_id", 5, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_ntile_of_few_rows(spark):
    few = spark.createDataFrame([("x", 1), ("y", 1), ("z", None)], "customer_id string, k int")
    rows = {r["customer_id"]: r["t"] for r in ntile_global(few, {"t": By("k")}, "customer_id", 5).collect()}
    assert rows == {"x": 1, "y": 2, "z": 3}
    assert ntile_global(few.limit(0), {"t": By("k")}, "customer_id", 5).count() == 0
    assert tile_ends(12, 5) == [3, 6, 8, 10]


@pytest.mark.parametrize("size", BUCKETS)
def test_lag_matches_window(table, size):
    got = lag_in_group(table, "grp", By("tenure"), "customer_id",
                       {"p": "total_charges", "q": "monthly_charges"}, size)
    w = Window.partitionBy("grp").orderBy(F.col("tenure").asc_nulls_last(), "customer_id")
    want = table.withColumns({"p": F.lag("total_charges").over(w), "q": F.lag("monthly_charges").over(w)})
    assert same(got, want.select(*got.columns))


@pytest.mark.parametrize("size", BUCKETS)
def test_row_rank_matches_window(table, size):
    got = row_rank(table, By("tenure"), "customer_id", "grp", "r", size)
    w = Window.partitionBy("grp").orderBy(F.col("tenure").asc_nulls_last(), "customer_id")
    assert same(got, table.withColumn("r", F.row_number().over(w).cast("long")).select(*got.columns))


@pytest.mark.parametrize("size", BUCKETS)
def test_quantiles_match_numpy(table, size):
    values = np.array([r[0] for r in table.select("dbl").collect()])
    probabilities = [0.0, 0.25, 0.5, 0.7, 0.85, 1.0]
    assert quantiles(table, "dbl", probabilities, size) == pytest.approx(np.quantile(values, probabilities).tolist())
    assert quantiles(table, "one", [0.3], size) == [1.0]
    assert quantiles(table.limit(0), "dbl", [0.5], size) == [None]


def test_no_lambda_searches_the_ranges(table):
    """Rows carry the number of their range: no expression over literal limits is left in the plan."""
    for df in (row_rank(table, By("tenure"), "customer_id", "grp", "r", 100),
               lag_in_group(table, "grp", By("tenure"), "customer_id", {"p": "tenure"}, 100)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and "from_json" not in plan


@pytest.mark.parametrize("size", BUCKETS)
def test_quantiles_per_group(table, size):
    rows = table.select("grp", "dbl").collect()
    got = {r["grp"]: list(r)[1:] for r in quantiles_by(table, "grp", "dbl", [0.1, 0.5, 0.99], size).collect()}
    assert set(got) == {r["grp"] for r in rows}
    for g, found in got.items():
        assert found == pytest.approx(np.quantile([r["dbl"] for r in rows if r["grp"] == g], [0.1, 0.5, 0.99]).tolist())


@pytest.mark.parametrize("size", BUCKETS)
def test_running_totals(table, size):
    hist = stage(table.groupBy("dbl").agg(F.count(F.lit(1)).alias("n")))
    got = {r["dbl"]: r["c"] for r in running_totals(hist, By("dbl", True), {"c": "n"}, size).collect()}
    total, want = 0, {}
    for r in sorted(hist.collect(), key=lambda r: -r["dbl"]):
        total += r["n"]
        want[r["dbl"]] = total
    assert got == want
