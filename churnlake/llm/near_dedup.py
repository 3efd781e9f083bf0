"""SimHash near-duplicates by multi-index hashing.

The 64 bits are cut into three segments. Of two fingerprints that differ in at most four
bits, one segment differs in at most one bit. So every fingerprint enumerates the Hamming
ball of radius one around each of its segments, fetches the fingerprints filed under those
values, and the complete distance decides.

Buckets with more than ``crowded`` fingerprints are not read pair by pair. A fingerprint that
meets one enumerates the ball of radius two around all of its bits instead: two fingerprints
are at most four bits apart if and only if these balls meet, and all that share a ball's
member are linked, so each links to the least of them. Both ways are exact and linear.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import components, in_pieces, is_empty, unused
from churnlake.llm.simhash import fingerprint, with_fingerprint
from churnlake.session import stage

#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
DISTANCE = 4


def _filed(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint under the value of each segment."""
    keys = [_key(n, first, width, 0) for n, (first, width) in enumerate(SEGMENTS)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _key(number: int, first: int, width: int, flip: int):
    value = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
    return value.bitwiseXOR(F.lit(flip)) + F.lit(number << 32)


def _probes(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint under the values of the ball of radius one around each segment."""
    keys = [_key(n, first, width, flip) for n, (first, width) in enumerate(SEGMENTS)
            for flip in (0, *(1 << b for b in range(width)))]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _ball(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint under all values at most two bits away."""
    flips = np.array([0, *(1 << b for b in range(64)), *((1 << a) | (1 << b) for a, b in combinations(range(64), 2))],
                     np.uint64).view(np.int64)

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start in range(0, len(fp), 32):
                part = fp[start:start + 32]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part, len(flips))), pa.array((part[:, None] ^ flips).ravel())], names=["fp", "key"])

    return fps.mapInArrow(run, "fp long, key long")


def links(fps: DataFrame, crowded: int = 256) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps`` (fp) that connect all within four bits.

    Below ``crowded`` every pair within four bits is a row; above, enough pairs to connect the same
    fingerprints. An empty table has no links.
    """
    filed = _filed(fps)
    full = stage(filed.groupBy("key").count().where(F.col("count") > crowded).select("key"), "crowded")
    probes = _probes(fps)
    none_full = is_empty(full)
    table = filed if none_full else filed.join(full, "key", "left_anti")
    far = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp")))
    pairs = (probes.alias("p").join(table.alias("t"), (F.col("p.key") == F.col("t.key"))
                                    & (F.col("p.fp") != F.col("t.fp")) & (far <= DISTANCE))
             .select(F.greatest("p.fp", "t.fp").alias("a"), F.least("p.fp", "t.fp").alias("b")))
    if none_full:
        return pairs.distinct()
    met = probes.join(full, "key", "left_semi").select("fp").distinct().repartition("fp")
    ball = stage(_ball(met), "ball")
    least = ball.groupBy("key").agg(F.min("fp").alias("b"))
    stars = ball.join(least, "key").where("fp != b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_in_shingle: int = 4, crowded: int = 256) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the least id among all documents reachable over links of at most
    four differing bits, the row's own included. Null and empty texts have fingerprint zero
    and are linked like any other. Rows that repeat an id keep their own rows. A null id
    never is the least one; a component without any id has a null ``component_id``.
    Other columns are ignored. An empty table gives an empty result.
    """
    rows = stage(with_fingerprint(docs, id_col, text_col, words_in_shingle), "fingerprints")
    fps = stage(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "fps", rows.count())
    roots = components(links(fps.select("fp"), crowded))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document, the one of least id, of each near-duplicate group.

    Null and empty texts have fingerprint zero and are one group with all that link to it. Rows without an id cannot be
    told apart and all stay. Rows that share an id but not the text are judged by their own texts; of rows of a group
    that share its least id, one stays. Other columns are kept, whatever they are called. An empty table stays empty.
    """
    mark, at = unused(docs, "__mark"), docs.columns.index(text_col)

    def append(batches):
        for batch in (piece for whole in batches for piece in in_pieces(whole, at)):
            found = np.array([fingerprint((v.as_py() or "").encode()) for v in batch.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, mark])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{mark}` long"])
    marked = stage(docs.mapInArrow(append, schema), "marked")
    fps = stage(marked.groupBy(F.col(mark).alias("fp")).agg(F.min(id_col).alias("least")), "fps", marked.count())
    roots = components(links(fps.select("fp")))
    rooted = fps.where(F.col("least").isNotNull()).join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min(F.struct("least", "fp")).alias("best")).select(
        F.col("best.least").alias(id_col), F.col("best.fp").alias(mark))
    out = marked.join(best, [id_col, mark], "left_semi").select(*marked.columns)
    once = marked.where(F.col(id_col).isNotNull()).groupBy(id_col, mark).count().where("count > 1")
    if not is_empty(once):
        out = out.dropDuplicates([id_col, mark])
    return out.unionByName(marked.where(F.col(id_col).isNull())).drop(mark)
