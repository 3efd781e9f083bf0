"""Repeatable stratified splits and folds from a hash of the customer id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.operators.ordering import By, Position, ROWS_PER_BUCKET, row_rank, rows_at


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def stratified_split(df: DataFrame, label: str, key: str = "customer_id", train_share: float = 0.8,
                     seed: int = 42, rows_in_task: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``is_train``: exactly the rounded share of each class, in hash order. ``df`` is stored, ``key`` unique.

    The position where a class's share ends is searched for in counting passes; rows are then marked where they
    lie. There are few classes; a null label is one of them.
    """
    hashed = df.withColumn("__h", hash_order(key, seed))
    train = F.lit(False)
    for r in df.groupBy(label).count().collect():
        of_class, want = F.col(label).eqNullSafe(F.lit(r[label])), math.floor(train_share * r["count"] + 0.5)
        inside = F.lit(want > 0)
        if 0 < want < r["count"]:
            rows = hashed.filter(of_class)
            pos = Position(rows, By("__h"), key)
            inside = ~pos.after(rows_at(rows, {"share": pos}, [want], r["count"], rows_in_task)["share"][want])
        train = F.when(of_class, inside).otherwise(train)
    return hashed.withColumn("is_train", train).drop("__h")


def stratified_folds(df: DataFrame, label: str, key: str = "customer_id", folds: int = 5, seed: int = 42,
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``fold`` 0..folds-1: the rank in hash order within the class, modulo folds."""
    ranked = row_rank(df.withColumn("__h", hash_order(key, seed)), By("__h"), key, label, "__rank", rows_per_bucket)
    return ranked.withColumn("fold", ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank", "__h")
