"""Categories of any number as slots, and the stored layout that segment filters prune."""

import pytest
from pyspark.sql import functions as F

from churnlake.ml import encode
from churnlake.operators.cleaning import filter_segment, store_segments
from churnlake.session import new_path, stage


def test_slots_are_the_dummy_columns(customers):
    columns = ["contract", "payment_method", "internet_service"]
    categories = encode.fit_categories(customers, columns)
    names = list(encode.dummy_columns(categories))
    slots, width = encode.category_slots(customers, columns)
    assert width == len(names)
    dense = {r["customer_id"]: [i for i, n in enumerate(names) if r[n]] for r in
             encode.one_hot(customers.select("customer_id", *columns), categories).collect()}
    got = {r["customer_id"]: r["slots"] for r in encode.one_hot_sparse(customers, "customer_id", columns, slots).collect()}
    assert got == dense


def test_wide_null_and_unseen_categories(spark, customers):
    with pytest.raises(ValueError, match="customer_id"):
        encode.fit_categories(customers, ["contract", "customer_id"])
    slots, width = encode.category_slots(customers, ["customer_id", "contract"])
    assert width == customers.count() - 1 + customers.select("contract").distinct().filter("contract IS NOT NULL").count() - 1
    assert sorted(r["slot"] for r in slots.collect()) == list(range(width))
    train = spark.createDataFrame([("a", None), ("b", None), (None, None)], "x string, y string")
    slots, width = encode.category_slots(train, ["y", "x"])
    assert (width, [tuple(r) for r in slots.collect()]) == (1, [(1, "b", 0)])
    asked = spark.createDataFrame([(1, "a", "z"), (2, "b", None), (3, "new", None), (4, None, None)], "k long, x string, y string")
    got = {r["k"]: r["slots"] for r in encode.one_hot_sparse(asked, "k", ["y", "x"], slots).collect()}
    assert got == {1: [], 2: [0], 3: [], 4: []}
    nothing, width = encode.category_slots(train.limit(0), ["y", "x"])
    assert (width, nothing.count()) == (0, 0)


def scan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.toString(), plan.collectLeaves().head().metrics()


def test_segments_prune_folders_files_and_row_groups(spark, customers):
    df = store_segments(customers, new_path(spark, "segments"), 8)
    assert df.schema.names == customers.schema.names
    total = customers.count()
    plan, metrics = scan(filter_segment(df, "churned").select("customer_id"))
    churned = customers.filter("churn = 'Yes'").count()
    assert "PartitionFilters: [isnotnull(churn" in plan and metrics.apply("numOutputRows").value() == churned < total
    for segment, column in (("long_tenure", "tenure"), ("high_value", "monthly_charges")):
        plan, metrics = scan(filter_segment(df, segment).select("customer_id"))
        assert f"GreaterThan({column}," in plan
        if segment == "long_tenure":  # files end at a tenure, so those below the limit give no row
            assert metrics.apply("numOutputRows").value() < total
        want = filter_segment(customers, segment)
        assert sorted(map(tuple, filter_segment(df, segment).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
