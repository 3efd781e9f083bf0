"""Mixing sources to target weights by fixed-length blocks.

The words of a source, its documents in order, are cut into blocks of ``block`` words. Each
output shard draws how many of its slots go to each source: multinomial counts, conditioned
on every source reaching its quota over all shards. A source's draws run through its blocks
by one pseudorandom permutation per pass, so no block comes a third time before all came twice.
Slots and blocks are then joined by source and index.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from churnlake.llm.common import in_pieces, is_empty, running_start, unused, utf8
from churnlake.session import stage

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: numpy's hypergeometric draws end here; above, shards are split in exact proportion.
MOST_DRAWN = 900_000_000


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    blocks: int
    target: float
    draws: int


def word_starts(data: np.ndarray) -> np.ndarray:
    """Where words (runs without ASCII white space) begin in the UTF-8 bytes of one text."""
    word = ~SPACE[data]
    word[1:] &= SPACE[data[:-1]]
    return np.flatnonzero(word)


def with_size(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, tie, size) per row: number of words, and a hash of the text that orders rows of equal id."""

    def run(batches):
        for batch in (piece for whole in batches for piece in in_pieces(whole, 3)):
            data, offsets = utf8(batch.column(3))
            word = ~SPACE[data]
            inner = np.ones(len(data), bool)
            inner[offsets[:-1][np.diff(offsets) > 0]] = False
            word[1:] &= SPACE[data[:-1]] | ~inner[1:]
            total = np.concatenate([[0], np.cumsum(word)])
            size = (total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(size)], names=["id", "source", "tie", "size"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                         F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, f"id {chosen.schema[0].dataType.simpleString()}, source string, tie long, size long")


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """``share`` of all sizes dealt by weight; no target above ``most`` times its size, the excess dealt anew."""
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in sorted(open_) if left * weights[i] / total >= most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            return out
        for i in over:
            out[i] = most * sizes[i]
            open_.discard(i)
        left -= sum(out[i] for i in over)
    return out


def plan(rows: DataFrame, weights: Sequence[float], share: float, most: float, block: int) -> list[Source]:
    """Sizes, targets and draws of the sources, by name, null last. One row per source reaches the driver,
    as their weights do."""
    sizes = {r["source"]: r["size"] for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    goal = targets([sizes[n] for n in names], [weights[i % len(weights)] for i in range(len(names))], share, most)
    out = []
    for name, target in zip(names, goal):
        count = -(-sizes[name] // block)
        draws = min(int(most * count), round(target * count / sizes[name])) if count else 0
        out.append(Source(name, sizes[name], count, target, draws))
    return out


def permuted(index: np.ndarray, size: int, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(size) for each key: a four-round Feistel network, walked until inside."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    key = key.astype(np.uint64)
    while len(todo):
        left, right, k = out[todo] >> np.uint64(half), out[todo] & mask, key[todo]
        for step in range(4):
            mixed = (right + k + np.uint64(step + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def shard_counts(quotas: np.ndarray, shards: int, slots: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws of each source before ``shard`` and in it.

    The slots of a range of shards are split in two halves, the draws of the left half are
    drawn without replacement from the quotas, and so on down to one shard. Every shard
    finds its own counts in log(shards) draws, and all agree.
    """
    low, high, now, before = 0, shards, quotas.copy(), np.zeros_like(quotas)
    while high - low > 1:
        middle = (low + high) // 2
        room = min((middle - low) * slots, int(now.sum()))
        rng = np.random.default_rng([seed, low, high])
        if now.sum() < MOST_DRAWN:
            left = rng.multivariate_hypergeometric(now, room, method="marginals")
        else:
            left = np.minimum(now, [int(q) * room // int(now.sum()) for q in now])
        if shard < middle:
            now, high = left, middle
        else:
            before, now, low = before + left, now - left, middle
    return before, now


def slots(spark, sources: list[Source], slots_per_shard: int, seed: int) -> DataFrame:
    """(shard, slot, source_no, pass_no, block): what each slot of each output shard takes."""
    quotas = np.array([s.draws for s in sources], np.int64)
    counts = [s.blocks for s in sources]
    total = int(quotas.sum())
    shards = max(1, -(-total // slots_per_shard))

    def run(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                before, own = shard_counts(quotas, shards, slots_per_shard, shard, seed)
                source = np.repeat(np.arange(len(own)), own)
                draw = np.concatenate([b + np.arange(n) for b, n in zip(before, own)]) if len(own) else source
                mixed = np.random.default_rng([seed, shard]).permutation(len(source))
                source, draw = source[mixed], draw[mixed]
                pass_no, block = np.zeros_like(draw), np.zeros_like(draw)
                for n in np.unique(source):
                    m = source == n
                    pass_no[m] = draw[m] // counts[n]
                    block[m] = permuted(draw[m] % counts[n], counts[n], seed + 1_000_003 * n + 7919 * pass_no[m])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(source), shard)), *(pa.array(x.astype(np.int64)) for x in
                     (np.arange(len(source)), source, pass_no, block))], names=["shard", "slot", "source_no", "pass_no", "block"])

    ids = spark.range(0, shards if total else 0, 1, min(max(shards, 1), 4096))
    return ids.mapInArrow(run, "shard long, slot long, source_no long, pass_no long, block long")


@dataclass(frozen=True)
class Mixture:
    """``rows``: (id, source, tie, size, source_no, begin) per document; ``begin`` is its first word in its source.
    ``mixed``: (shard, slot, source_no, pass_no, block, id, tie, size, begin, first_word, words): what the slots hold."""

    sources: list[Source]
    rows: DataFrame
    mixed: DataFrame


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = 64,
        slots_per_shard: int = 16_384, seed: int = 42) -> Mixture:
    """Draw a mixture of all documents; reruns over the same rows agree.

    A null text has no words. A null source is a source of its own, the last. A null id comes
    first in its source. Rows of equal id are ordered by text; equal rows stand next to each other.
    Other columns are ignored. Without any word nothing is drawn.
    """
    spark = docs.sparkSession
    rows = stage(with_size(docs, id_col, text_col, source_col), "sizes")
    sources, count = plan(rows, weights, share, most, block), rows.count()
    number = F.lit(None).cast("long")
    for start in range(0, len(sources), 1000):
        part = F.create_map(*[F.lit(x) for i, s in enumerate(sources[start:start + 1000], start) if s.name is not None
                              for x in (s.name, i)]) if any(s.name is not None for s in sources[start:start + 1000]) else None
        if part is not None:
            number = F.coalesce(number, F.try_element_at(part, F.col("source")).cast("long"))
    number = F.when(F.col("source").isNull(), F.lit(len(sources) - 1).cast("long")).otherwise(number)
    rows = running_start(rows.withColumn("source_no", number), ["source_no"], ["id", "tie"], "size", "begin", count)
    rows = stage(rows, "begins", count)
    first, last = F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block)
    pieces = rows.where("size > 0").select("source_no", "id", "tie", "size", "begin", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.col("block") * block - F.col("begin"), F.lit(0))
    pieces = pieces.withColumn("first_word", start).withColumn(
        "words", F.least((F.col("block") + 1) * block - F.col("begin"), F.col("size")) - start)
    # stored, so that its size is known and it is not broadcast
    mixed = stage(slots(spark, sources, slots_per_shard, seed), "slots").join(pieces, ["source_no", "block"])
    return Mixture(sources, rows, mixed)


def digest(found: Mixture, id_col: str = "doc_id") -> DataFrame:
    """Per document: its size, its source's size and target, and how many of its words the mixture takes."""
    taken = found.mixed.groupBy("source_no", "begin").agg(F.sum("words").alias("taken"))
    spark = found.rows.sparkSession
    shape = StructType([StructField("n", LongType()), StructField("source_size", LongType())])
    named = spark.createDataFrame([(i, s.size) for i, s in enumerate(found.sources)], shape)
    goal = spark.createDataFrame([(i, float(s.target)) for i, s in enumerate(found.sources)], "m long, target double")
    named = named.join(goal, F.col("n") == F.col("m")).drop("m")
    filled = found.rows.withColumn("b", F.when(F.col("size") > 0, F.col("begin")))
    out = filled.join(taken.withColumnsRenamed({"source_no": "s", "begin": "t"}),
                      (F.col("source_no") == F.col("s")) & (F.col("b") == F.col("t")), "left")
    return out.join(named, F.col("source_no") == F.col("n")).select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", length_col: str | None = "n_chars", **options) -> DataFrame:
    """The mixture as documents: one row per document and pass, with the words taken in that pass, in their order.

    A document that a pass takes whole keeps its text; the parts of another are joined by a blank.
    """
    mark, held = unused(docs, "__t"), unused(docs, "__parts")
    found = mix(docs, id_col, text_col, source_col, **options)
    taken = found.mixed.groupBy("id", "source_no", "tie", "size", "begin", "pass_no").agg(
        F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("parts"), F.sum("words").alias("got"))
    of, tie, name = (unused(docs, n) for n in ("__id", "__tie", "__source"))
    parts = taken.select(F.col("id").alias(of), F.col("tie").alias(tie),
                         F.when(F.col("got") < F.col("size"), F.col("parts")).alias(held),
                         F.element_at(F.array(*[F.lit(s.name) for s in found.sources]),
                                      (F.col("source_no") + 1).cast("int")).alias(name) if found.sources
                         else F.lit(None).cast("string").alias(name))
    texts = docs.select(*columns).withColumn(mark, F.xxhash64(text_col))
    if not is_empty(found.rows.groupBy("id", "source", "tie").count().where("count > 1")):
        texts = texts.dropDuplicates([id_col, source_col, mark])
    both = texts.join(parts, F.col(id_col).eqNullSafe(F.col(of)) & (F.col(mark) == F.col(tie))
                      & F.col(source_col).eqNullSafe(F.col(name)))
    at = columns.index(text_col)
    out = both.select(*columns, held)

    def run(batches):
        for batch in (piece for whole in batches for piece in in_pieces(whole, at)):
            texts = [t if p is None else cut(t, [(x["first_word"], x["words"]) for x in p])
                     for t, p in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist())]
            arrays = list(batch.columns[:-1])
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    out = out.mapInArrow(run, docs.select(*columns).schema)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col else out


def cut(text: str, parts: list[tuple[int, int]]) -> str:
    """The words ``(first, number)`` of ``text`` with the white space between them; gaps become one blank."""
    data = text.encode()
    starts = np.append(word_starts(np.frombuffer(data, np.uint8)), len(data))
    runs: list[list[int]] = []
    for first, number in parts:
        if runs and runs[-1][1] == first:
            runs[-1][1] += number
        else:
            runs.append([first, first + number])
    return " ".join(data[starts[a]:starts[b]].decode().rstrip(" \t\n\r\x0b\x0c") for a, b in runs)
