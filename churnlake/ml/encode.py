"""One-hot encoding learned from the training rows, and feature arrays."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.operators.ordering import By, row_rank
from churnlake.session import attach, stage


#: Categories of a column that become columns of their own; the values of a wider column never reach the driver.
WIDEST = 1_000


def fit_categories(train: DataFrame, columns: list[str], widest: int = WIDEST) -> dict[str, list[str]]:
    """Sorted categories per column, for dummy columns. They are counted first: ``category_slots`` takes wider columns."""
    counts = train.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if counts[c] > widest]
    if wide:
        raise ValueError(f"More than {widest} categories, use category_slots: {wide}")
    row = train.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def dummy_columns(categories: dict[str, list[str]]) -> dict[str, Column]:
    """0/1 columns for every category but the first; unseen values and NULL are all 0."""
    return {f"{c}_{v}": F.when(F.col(c) == v, F.lit(1)).otherwise(F.lit(0))
            for c, values in categories.items() for v in values[1:]}


def one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    return df.withColumns(dummy_columns(categories)).drop(*categories)


def _long(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """A row per row and column: (keep..., column_no, category)."""
    parts = [F.struct(F.lit(i).alias("column_no"), F.col(c).cast("string").alias("category")) for i, c in enumerate(columns)]
    return df.select(*keep, F.explode(F.array(*parts)).alias("__part")).select(*keep, "__part.*")


def category_slots(train: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """(column_no, category, slot) and the number of slots: a slot for every category but the first of its column.

    Slots run over the columns in the given order and the sorted categories in each, as dummy columns do. Columns
    may have any number of categories: they are numbered by ranges, and one number per column is all the driver sees.
    NULL is no category.
    """
    found = stage(_long(train, columns).filter(F.col("category").isNotNull()).distinct(), "categories")
    counts = {r["column_no"]: r["count"] for r in found.groupBy("column_no").count().collect()}
    ranked = row_rank(found, By("column_no"), "category")
    first, slots, shift = 1, 0, F.lit(None).cast("long")
    for i in sorted(counts):
        shift = F.when(F.col("column_no") == i, F.when(F.col("rank") > first, F.lit(slots - first - 1))).otherwise(shift)
        first, slots = first + counts[i], slots + counts[i] - 1
    numbered = ranked.withColumn("slot", F.col("rank") + shift).filter(F.col("slot").isNotNull())
    return stage(numbered.select("column_no", "category", "slot"), "slots"), slots


def one_hot_sparse(df: DataFrame, key: str, columns: list[str], slots: DataFrame) -> DataFrame:
    """(key, slots): the slots that are 1, ascending; ``key`` is unique. First and unseen categories and NULL have none."""
    marked = attach(_long(df, columns, key), slots, ["column_no", "category"])
    return marked.groupBy(key).agg(F.sort_array(F.collect_list("slot")).alias("slots"))


def feature_names(numeric: list[str], categories: dict[str, list[str]]) -> list[str]:
    return list(numeric) + list(dummy_columns(categories))


def to_features(df: DataFrame, numeric: list[str], categories: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """``keep`` columns, the feature array ``x`` (missing numbers are 0) and its vector."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric]
    values += [c.cast("double") for c in dummy_columns(categories).values()]
    return with_vector(df.select(*keep, F.array(*values).alias("x")))


def with_vector(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector("x"))
