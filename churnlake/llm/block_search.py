"""Exact nearest neighbours of a query set by tiles of int8 products.

Vectors are scaled to length one and rounded to int8. The product of two rounded vectors
differs from the cosine by no more than the lengths of the rounding errors allow, so a tile of
products gives an interval for every pair. Pairs whose upper end lies below the k-th best known
for the query are left; the others are computed from the original vectors in double precision
and merged in a heap per query.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.common import blocks
from churnlake.session import stage

TILE = 2048
#: Components of the queries and of the candidates that meet in a cell, about.
QUERY_NUMBERS, ROW_NUMBERS = 1 << 21, 1 << 19


@dataclass
class Vectors:
    """Vectors of one dimension: ids, originals in double precision but for a power of two, lengths, int8 values, scales and error lengths."""

    ids: np.ndarray
    exact: np.ndarray
    norm: np.ndarray
    small: np.ndarray
    scale: np.ndarray
    error: np.ndarray


def quantised(ids: np.ndarray, exact: np.ndarray) -> Vectors:
    # scaled by powers of two, which changes no quotient, so that no square overflows or vanishes
    exact = np.ldexp(exact, -np.frexp(np.abs(exact).max(1))[1][:, None])
    squares = np.zeros(len(exact))
    for i in range(exact.shape[1]):
        squares += exact[:, i] * exact[:, i]
    norm = np.sqrt(squares)
    unit = exact / norm[:, None]
    scale = np.abs(unit).max(1) / 127
    small = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - small * scale[:, None]) ** 2).sum(1))
    return Vectors(ids, exact, norm, small.astype(np.int8), scale, error)


def usable(ids: pa.Array, column: pa.Array) -> dict[int, Vectors]:
    """Vectors with an id that are neither null nor zero and have finite components only, by dimension."""
    keep = pc.and_(pc.is_valid(ids), pc.is_valid(column))
    ids, column = ids.filter(keep), column.filter(keep)
    size = np.array(pc.list_value_length(column).to_pylist(), np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    ends = np.cumsum(size)
    out = {}
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        exact = values[(ends[rows] - d)[:, None] + np.arange(d)]
        good = np.isfinite(exact).all(1) & (exact != 0).any(1)
        if good.any():
            out[int(d)] = quantised(ids.to_numpy(zero_copy_only=False)[rows[good]].astype(np.int64), exact[good])
    return out


def cosine(a: Vectors, i: np.ndarray, b: Vectors, j: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (i, j), components added in order, so that equal vectors score equally."""
    dot = np.zeros(len(i))
    x, y = a.exact[i], b.exact[j]
    for c in range(x.shape[1]):
        dot += x[:, c] * y[:, c]
    return dot / (a.norm[i] * b.norm[j])


def search_tile(queries: Vectors, rows: Vectors, heaps: list[list[tuple[float, int]]], k: int) -> None:
    """Bring the ``k`` best of ``rows`` into the heaps of ``queries``: (score, -id), the worst on top."""
    kind = np.float32 if rows.small.shape[1] <= 1000 else np.float64  # sums of int8 products stay exact
    product = queries.small.astype(kind) @ rows.small.astype(kind).T
    near = product * (queries.scale[:, None] * rows.scale[None, :])
    slack = rows.error[None, :] + queries.error[:, None] * (1 + rows.error[None, :]) + 1e-9
    own = queries.ids[:, None] == rows.ids[None, :]
    low = np.where(own, -np.inf, near - slack)
    least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    if low.shape[1] > k:
        least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
    i, j = np.nonzero((near + slack >= least[:, None]) & ~own)
    for a, b in blocks(len(i), 1 << 16):
        score = cosine(queries, i[a:b], rows, j[a:b])
        for q, r, s in zip(i[a:b].tolist(), rows.ids[j[a:b]].tolist(), score.tolist()):
            entry = (s, -r)
            if len(heaps[q]) < k:
                heapq.heappush(heaps[q], entry)
            elif entry > heaps[q][0]:
                heapq.heapreplace(heaps[q], entry)


def _best_of_cell(k: int):
    """Of one cell of the grid: the ``k`` best of its candidates (id, v) for each of its queries (n, id, v)."""

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if candidates.num_rows and queries.num_rows:
            rows = usable(candidates["id"].combine_chunks(), candidates["v"].combine_chunks())
            asked = usable(queries["n"].combine_chunks(), queries["v"].combine_chunks())
            own = dict(zip(queries["n"].to_pylist(), queries["id"].to_pylist()))
            for d in rows.keys() & asked.keys():
                numbers = asked[d].ids
                asked[d].ids = np.array([own[n] for n in numbers.tolist()], np.int64)
                heaps: list[list] = [[] for _ in numbers]
                for a, b in blocks(len(rows[d].ids), TILE):
                    part = Vectors(*(x[a:b] for x in vars(rows[d]).values()))
                    for c, e in blocks(len(numbers), TILE):
                        search_tile(Vectors(*(x[c:e] for x in vars(asked[d]).values())), part, heaps[c:e], k)
                found += [(n, q, -r, s) for n, q, h in zip(numbers.tolist(), asked[d].ids.tolist(), heaps) for s, r in h]
        columns = zip(*found) if found else ([], [], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                        names=["n", "query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            query_numbers: int = QUERY_NUMBERS, row_numbers: int = ROW_NUMBERS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest cosine of each row where ``is_query`` holds.

    All rows but those of the query's own id are candidates; ties go to the smaller id. Rows without id, null
    or zero vectors and vectors with null or non-finite components take no part; only vectors of one length
    are compared. A query row that is repeated is answered as often. Other columns are ignored; an empty table
    gives an empty result.

    Vectors of each length form a grid: queries are dealt at random to blocks of about ``query_numbers`` components,
    candidates to blocks of about ``row_numbers``, and block meets block in a cell by an equal key. So a task holds two
    blocks, whatever the table, a frequent id or vector fills no cell, and the plan does not grow with the queries.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and size(v) > 0")
    rows = stage(rows.withColumns({"d": F.size("v"), "asks": is_query(F.col("id")), "n": F.monotonically_increasing_id()}), "vectors")
    grid = rows.groupBy("d").agg(F.ceil(F.count("*") * F.col("d") / row_numbers).alias("cells"),
                                 F.ceil(F.count_if("asks") * F.col("d") / query_numbers).alias("parts"))
    dealt = rows.join(stage(grid.where("parts > 0"), "grid"), "d")
    place = F.xxhash64("n")
    candidates = dealt.select("d", F.pmod(place, F.col("cells")).alias("cell"),
                              F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "id", "v")
    queries = dealt.where("asks").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"),
                                         F.pmod(place, F.col("parts")).alias("part"), *[F.col(c).alias(c) for c in ("d", "n", "id", "v")])
    key = ["d", "part", "cell"]
    found = candidates.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(
        _best_of_cell(k), "n long, query_id long, vec_id long, score double")
    best = Window.partitionBy("n").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same search by all pairs. DuckDB.
NEAREST_SQL = """
WITH v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) / (q.norm * c.norm) AS score
    FROM n q JOIN n c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
