"""Minority oversampling with exact nearest neighbours, without comparing all pairs.

Distinct feature vectors are cut into cells: every cell with too many vectors is cut at the quartiles of
the feature that varies most in it, until all cells are small. Of each cell, and of each larger one that
was cut into it, the box is kept that just holds its vectors. The best neighbours in the own cell bound
how far the true ones can be, and each vector is then sent down the boxes into just those cells whose box
its bound reaches. Cells are searched in pieces of a bounded size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.operators.ordering import By, row_rank
from churnlake.session import attach, stage

#: Vectors in a cell, and how many rounds of cuts at most; what they leave larger is dealt out by hash.
CELL, ROUNDS = 1024, 40
#: Vectors that are looked up in a cell by one task.
ASKED = 8192
#: Lists of boxes that are broadcast at most; a box holds two numbers per feature.
BOXES = 2_000
#: A shared list is this many times as long as a sample needs; and the most pairs of vectors that are compared where it falls short.
WIDER, PAIRS = 4, 1_000_000_000
FOUND = "vid string, other string, distance double"


def _divide(points: DataFrame, cell: int) -> tuple[DataFrame, int]:
    """``points`` (vid, x) with ``cell``, stored, and the number of rounds that cut them.

    A round adds a letter to the name of each cell it cuts, the last one a number after a letter. Vectors are
    distinct, so a feature that varies always cuts: at its mean, if its quartiles are one value.
    """
    placed = points.withColumn("cell", F.lit(""))
    for turn in range(ROUNDS):
        spread = F.transform(vector_to_array(Summarizer.variance(F.col("v"))), lambda v: F.nanvl(v, F.lit(0.0)))
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > cell)
        if not sizes.head(1):
            return placed, turn
        large = stage(placed.withColumn("v", array_to_vector("x")).groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), spread.alias("spread"))
                      .where(F.col("rows") > cell)
                      .select("cell", "rows", (F.array_position("spread", F.array_max("spread")) - 1).cast("int").alias("axis")), "smote-axes")
        on_axis = attach(placed, large, ["cell"]).withColumn("p", F.get("x", F.col("axis")))
        cuts = on_axis.where(F.col("axis").isNotNull()).groupBy("cell").agg(
            F.first("rows").alias("rows"), F.first("axis").alias("axis"), F.avg("p").alias("mean"),
            F.min("p").alias("least"), F.max("p").alias("most"), F.percentile_approx("p", [0.25, 0.5, 0.75]).alias("q"))
        stuck = (F.col("least") == F.col("most")) | F.lit(turn == ROUNDS - 1)
        at = F.when(F.col("q")[0] == F.col("q")[2], F.array_repeat("mean", 3)).otherwise(F.col("q"))
        cuts = stage(cuts.select("cell", "axis", at.alias("q"), F.when(stuck, F.ceil(F.col("rows") / cell)).alias("salts")), "smote-cuts")
        quarter = sum((F.get("x", F.col("axis")) > F.col("q")[i]).cast("int") for i in range(3))
        part = (F.when(F.col("axis").isNull(), "").when(F.col("salts").isNull(), F.substring(F.lit("abcd"), quarter + 1, F.lit(1)))
                .otherwise(F.concat(F.lit("h"), F.pmod(F.xxhash64("vid"), F.col("salts")).cast("string"))))
        placed = stage(attach(placed, cuts, ["cell"]).select("vid", "x", F.concat("cell", part).alias("cell")), "smote-cells")
    return placed, ROUNDS


def _steps(cell: str = "cell") -> Column:
    """The cuts that lead to a cell, from its name."""
    return F.regexp_extract_all(cell, F.lit("[a-z][0-9]*"), 0)


def _and_above() -> Column:
    """Names of a cell and of all that it was cut from."""
    return F.transform(F.sequence(F.lit(0), F.size(_steps())), lambda n: F.array_join(F.slice(_steps(), 1, n), ""))


def _boxes(placed: DataFrame, size: int) -> DataFrame:
    """(cell, n, low, high) of every cell and all that it was cut from: its number of vectors, their least and largest values."""
    vectors = placed.select("cell", array_to_vector("x").alias("v")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.min(F.col("v"))).alias("low"), vector_to_array(Summarizer.max(F.col("v"))).alias("high"))
    nodes = stage(vectors, "smote-leaves").select(F.explode(_and_above()).alias("cell"), "n", "low", "high")
    return nodes.groupBy("cell").agg(F.sum("n").alias("n"), F.array(*[F.min(F.get("low", F.lit(i))) for i in range(size)]).alias("low"),
                                     F.array(*[F.max(F.get("high", F.lit(i))) for i in range(size)]).alias("high"))


def _away(gap) -> Column:
    """Distance that ``gap`` makes of a value, the least and the largest of a box, over all features."""
    sides = F.zip_with("low", "high", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    gaps = F.zip_with("x", sides, lambda v, side: gap(v, side["a"], side["b"]))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g))


def _bounded(asked: DataFrame, placed: DataFrame, boxes: DataFrame, k: int) -> DataFrame:
    """``asked`` with a bound for those whose own cell gave none: the far corner of a cell above it that holds over ``k`` vectors."""
    corner = F.nanvl(_away(lambda v, a, b: F.greatest(F.abs(v - a), F.abs(v - b))) * (1 + 1e-9), F.lit(float("inf")))
    loose = asked.where(F.col("bound") == float("inf"))
    above = loose.join(placed.select("vid", "cell"), "vid").select("vid", "x", F.explode(_and_above()).alias("cell"))
    least = above.join(boxes.where(F.col("n") > k), "cell").groupBy("vid").agg(F.min(corner).alias("least"))
    return asked.join(least, "vid", "left").withColumn("bound", F.least("bound", "least")).drop("least")


def _reached(asked: DataFrame, boxes: DataFrame, rounds: int) -> DataFrame:
    """``asked`` (vid, x, bound) once for every cell whose box is within ``bound``."""
    parts = boxes.where("cell != ''").groupBy(F.regexp_replace("cell", "[a-z][0-9]*$", "").alias("of")).agg(
        F.collect_list(F.struct("cell", "low", "high")).alias("parts")).withColumnRenamed("of", "cell")
    parts = stage(parts.withColumn("turn", F.size(_steps())), "smote-parts")
    limit = F.col("bound") * (1 + 1e-9)
    near = F.nanvl(_away(lambda v, a, b: F.when(v < a, a - v).when(v > b, v - b).otherwise(0.0)), F.lit(0.0))
    spread = asked.withColumn("cell", F.lit(""))
    for turn in range(rounds):
        found = attach(spread, parts.where(F.col("turn") == turn).drop("turn"), ["cell"], BOXES).select(
            "vid", "x", "bound", "cell", F.explode_outer("parts").alias("part"))
        found = found.select("vid", "x", "bound", F.coalesce("part.cell", "cell").alias("cell"), F.col("part.low").alias("low"), F.col("part.high").alias("high"))
        spread = found.where(F.col("low").isNull() | (near <= limit)).select("vid", "x", "bound", "cell")
        if turn % 4 == 3:
            spread = stage(spread, "smote-reach")
    return spread


def _searcher(k: int):
    """Task-side search of one cell; returned as a closure so that it ships by value."""

    def search(asked, points):
        import numpy as np
        import pandas as pd

        found = [pd.DataFrame({"vid": [], "other": [], "distance": []}).astype({"vid": str, "other": str, "distance": float})]
        if len(asked) and len(points):
            x, ids, own = np.stack(points["x"].to_numpy()), points["vid"].to_numpy(), asked["vid"].to_numpy()
            a, bound = np.stack(asked["x"].to_numpy()), asked["bound"].to_numpy()
            order = np.argsort(ids)                                 # equal distances go by id
            x, ids = x[order], ids[order]
            middle = x.mean(axis=0)
            x0, a0 = x - middle, a - middle
            xx, aa = (x0 * x0).sum(axis=1), (a0 * a0).sum(axis=1)
            for start in range(0, len(own), 256):
                part = slice(start, start + 256)
                # Squares of distances by one product of matrices, and how far rounding can take them off; only what may be among the nearest is computed exactly.
                rough, off = aa[part, None] + xx[None, :] - 2 * (a0[part] @ x0.T), (aa[part, None] + xx[None, :]) * (8 + x.shape[1]) * 1e-15
                itself = ids[None, :] == own[part][:, None]
                most = np.where(itself, np.inf, rough + off)
                limit = np.partition(most, k - 1, axis=1)[:, k - 1] if k < len(ids) else np.full(len(most), np.inf)
                limit = np.minimum(limit, bound[part] ** 2 * (1 + 1e-9))
                row, column = np.nonzero(~itself & ~(rough - off > limit[:, None]))
                far = np.zeros(len(row))
                for c in range(x.shape[1]):
                    far += (a[part][row, c] - x[column, c]) ** 2
                far = np.sqrt(far)
                near = np.isfinite(far) & (far <= bound[part][row])
                row, column, far = row[near], column[near], far[near]
                best = np.lexsort((column, far, row))
                row, column, far = row[best], column[best], far[best]
                first = np.arange(len(row)) - np.searchsorted(row, row) < k
                found.append(pd.DataFrame({"vid": own[part][row[first]], "other": ids[column[first]], "distance": far[first]}))
        return pd.concat(found)

    return search


def _searched(asked: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest in its cell for every row of ``asked`` (vid, x, bound, cell), no farther than ``bound``.

    A cell that very many ask for is copied to as many tasks as their number needs.
    """
    tasks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ASKED).alias("tasks"))
    copies = cells.join(tasks, "cell").select("vid", "x", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task")).toDF(
        "vid", "x", "cell", "task")
    dealt = asked.join(tasks, "cell").select("vid", "x", "bound", "cell", F.pmod(F.xxhash64("vid"), F.col("tasks")).alias("task")).toDF(
        "vid", "x", "bound", "cell", "task")
    search = _searcher(k)
    return dealt.groupBy("cell", "task").cogroup(copies.groupBy("cell", "task")).applyInPandas(lambda a, b: search(a, b), FOUND)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` least distances per vector, ties by the other's id. Every cell has given ``k`` pairs at most."""
    best = pairs.groupBy("vid").agg(F.slice(F.sort_array(F.collect_set(F.struct("distance", "other"))), 1, k).alias("n"))
    return best.select("vid", F.explode("n").alias("n")).select("vid", "n.other", "n.distance")


def nearest_vectors(points: DataFrame, k: int, cell: int = CELL) -> DataFrame:
    """The k nearest other vectors of every vector: (vid, other, distance), exact.

    ``points`` is a stored table of distinct vectors (vid, x) of one length. How many cells a vector is sent to
    depends on how well its neighbours bound it: few where cells are wide beside the distances of neighbours.
    """
    first = points.select(F.size("x").alias("d")).first()
    if first is None:
        return points.sparkSession.createDataFrame([], FOUND)
    forever = F.lit(float("inf"))
    placed, rounds = _divide(points, cell)
    near = _searched(placed.withColumn("bound", forever), placed, k)
    if not rounds:
        return near
    near = stage(near, "smote-near")
    bound = near.groupBy("vid").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(forever).alias("bound"))
    boxes = stage(_boxes(placed, first["d"]), "smote-boxes")
    asked = points.join(bound, "vid", "left").select("vid", "x", F.coalesce("bound", forever).alias("bound"))
    asked = _bounded(stage(asked, "smote-bounds"), placed, boxes, k)
    elsewhere = stage(_reached(asked, boxes, rounds).join(placed.select("vid", "cell"), ["vid", "cell"], "left_anti"), "smote-asked")
    return _best(near.unionByName(_searched(elsewhere, placed, k)), k)


def vector_id() -> Column:
    """Name of the vector ``x``: equal vectors have one."""
    return F.md5(F.concat_ws(",", F.transform("x", lambda v: v.cast("string"))))


@dataclass
class Neighbours:
    """The ``size`` nearest other vectors of every minority vector of a table, for samples of that table: (vid, other, distance), stored."""

    pairs: DataFrame
    size: int
    of: object                      # the label of that class

    def within(self, points: DataFrame, k: int) -> DataFrame:
        """As ``nearest_vectors`` of ``points``, a stored table of some of the table's vectors (vid, x) of one class.

        Neighbours that are not among ``points`` drop out, and the k nearest left are those in ``points``: lists are in
        order of distance and id. Vectors that lose too many, of lists that do not name all others, are searched for.
        """
        here = points.select(F.col("vid").alias("other"), F.lit(True).alias("here"))
        kept = F.when(F.col("here"), F.struct("distance", "other"))                 # null is not collected
        lists = self.pairs.join(points.select("vid"), "vid", "left_semi").join(here, "other", "left").groupBy("vid").agg(
            F.count(F.lit(1)).alias("listed"), F.slice(F.sort_array(F.collect_list(kept)), 1, k).alias("n"))
        lists = stage(lists, "smote-lists")
        short = (F.size("n") < k) & (F.col("listed") >= self.size)
        found = lists.where(~short).select("vid", F.explode("n").alias("n")).select("vid", "n.other", "n.distance")
        asked = stage(lists.where(short).select("vid"), "smote-short")
        missing = asked.count()
        if not missing:
            return found
        rows = points.count()
        if missing * rows > PAIRS:
            again = nearest_vectors(points.select("vid", "x"), k).join(asked, "vid", "left_semi")
        else:
            parts = math.ceil(rows / ASKED)
            dealt = points.select("vid", "x", F.pmod(F.xxhash64("vid"), F.lit(parts)).cast("string").alias("cell"))
            every = points.join(asked, "vid", "left_semi").select("vid", "x", F.lit(float("inf")).alias("bound"), F.explode(
                F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<string>")).alias("cell"))
            again = _best(_searched(every, dealt, k), k)
        return found.unionByName(again)


def shared_neighbours(train: DataFrame, label: str = "label", k: int = 5, cell: int = CELL) -> Neighbours | None:
    """Neighbours for ``smote`` over several samples of ``train``: one search instead of one each, of four times as many.

    ``train`` is a stored table; None if it has no two classes, or no two rows of the smaller one.
    """
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    if len(sizes) != 2 or min(sizes.values()) < 2:
        return None
    rows = train.filter(F.col(label) == _minority(sizes)).select(vector_id().alias("vid"), "x")
    points = stage(rows.groupBy("vid").agg(F.first("x").alias("x")), "smote-distinct")
    return Neighbours(stage(nearest_vectors(points, WIDER * k, cell), "smote-shared"), WIDER * k, _minority(sizes))


def _minority(sizes: dict):
    return min(sizes, key=lambda v: (sizes[v], v))


def uniform(*parts) -> Column:
    """Number in [0, 1) from a hash: repeatable, unlike ``rand()``."""
    text = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / float(2 ** 32)


def smote(train: DataFrame, label: str = "label", key: str = "customer_id", k: int = 5, seed: int = 42,
          cell: int = CELL, shared: Neighbours | None = None) -> DataFrame:
    """Synthetic minority rows (key, x, label, synthetic) that even out the two classes.

    Every minority row is used equally often (the remainder in hash order). Copies of a
    vector are each other's nearest neighbours, so they are counted, not compared.
    ``train`` is a stored table with the feature array ``x``. ``shared`` are the ``shared_neighbours`` of a table it is
    a sample of, if their smaller class is the same; the rows are those of a search of its own.
    """
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    if len(sizes) != 2:
        raise ValueError(f"two classes needed, got {sorted(sizes)}")
    minority = _minority(sizes)
    few, needed = sizes[minority], max(sizes.values()) - sizes[minority]
    k = min(k, few - 1)
    if k < 1:
        raise ValueError("at least two minority rows needed")
    each, rest = divmod(needed, few)
    rows = stage(train.filter(F.col(label) == minority).select(key, "x", vector_id().alias("vid")), "smote-rows")
    points = stage(rows.groupBy("vid").agg(F.count(F.lit(1)).alias("copies"), F.first("x").alias("x")), "smote-distinct")
    near = shared.within(points, k) if shared and shared.of == minority and k <= shared.size else nearest_vectors(points.select("vid", "x"), k, cell)
    # Neighbour list per vector: its own copies first, then others by distance, k rows in all.
    weighted = near.join(points.select(F.col("vid").alias("other"), "copies", F.col("x").alias("ox")), "other")
    lists = weighted.groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("distance", "other", "copies", "ox"))).alias("others"))
    full = points.join(lists, "vid", "left")
    others = F.flatten(F.transform(F.coalesce("others", F.array().cast(
        "array<struct<distance:double,other:string,copies:bigint,ox:array<double>>>")),
        lambda o: F.array_repeat(o["ox"], F.least(o["copies"], F.lit(k)).cast("int"))))
    own = F.array_repeat(F.col("x"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    neighbours = full.select("vid", F.slice(F.concat(own, others), 1, k).alias("neighbours"))
    ranked = row_rank(rows.withColumn("h", F.md5(F.concat(F.lit(f"{seed}|"), key))), By("h"), key, name="rank")
    turns = F.lit(each) + F.when(F.col("rank") <= rest, 1).otherwise(0)
    bases = ranked.withColumn("turns", turns).filter(F.col("turns") > 0).select(
        key, "x", "vid", F.explode(F.sequence(F.lit(1), F.col("turns"))).alias("turn"))
    pick = F.floor(uniform(F.lit(f"{seed}-n"), key, F.col("turn").cast("string")) * F.size("neighbours")).cast("int")
    step = uniform(F.lit(f"{seed}-s"), key, F.col("turn").cast("string"))
    drawn = bases.join(neighbours, "vid").withColumns({"other": F.get("neighbours", pick), "step": step})
    mixed = F.zip_with("x", "other", lambda a, b: (b - a))
    moved = F.zip_with("x", mixed, lambda a, d: a + d * F.col("step"))
    return drawn.select(
        F.concat_ws("-", F.lit("smote"), key, F.col("turn").cast("string")).alias(key), moved.alias("x"),
        F.lit(minority).cast(train.schema[label].dataType).alias(label), F.lit(True).alias("synthetic"))


def balance(train: DataFrame, label: str = "label", key: str = "customer_id", **options) -> DataFrame:
    """The training rows plus the synthetic ones."""
    real = train.select(key, "x", label, F.lit(False).alias("synthetic"))
    return real.unionByName(smote(train, label, key, **options))
