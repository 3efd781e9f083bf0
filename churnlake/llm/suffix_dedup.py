"""Removal of repeated byte strings by external induced suffix sorting.

Every byte that a string of ``length`` bytes covers, which also starts earlier in the corpus, is
removed. Which strings are equal is read from suffix arrays:

1. Every string of ``length`` bytes chooses an anchor by its content alone: the least hash among its
   substrings of GRAM bytes. Equal strings have equal anchors, so only strings whose anchor occurs
   twice can repeat. Neighbouring strings mostly share their anchor and form one region. One pass over the
   texts finds all regions and a hash of each; texts are read again only for bytes that are sorted.
2. Equal texts are taken once, and so are equal regions (64 bits of the anchor and 64 of the whole region
   agree); all but the first of them repeat as a whole. Distinct texts are numbered in the order of the corpus.
3. Regions left are dealt by anchor into shards, so equal strings meet in one shard. A shard's suffixes
   are sorted by induction from its LMS suffixes: bucket queues, which are priority queues over the first
   byte and the order of arrival, carry the suffixes and go to disk when they grow. Neighbours in the suffix
   array with a common prefix of ``length`` are equal strings; the earliest stays.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import blocks, discard, running_start, settled
from churnlake.session import stage

#: Bytes of an anchor: shorter ones make fewer regions, but more of them occur in strings that differ.
GRAM = 32
AT_ONCE = 1 << 20
SHARD_BYTES = 4 << 20
#: Texts a task remembers, to cut copies into regions once.
REMEMBERED = 1 << 18
#: Suffixes that queues keep in memory; more go to disk.
IN_MEMORY = 8 << 20
#: In a shard's text, 0 ends it, 1 ends a region, the others are bytes plus 2.
NUMBERS = 258


# -- anchors ------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial 64-bit hashes of all substrings of GRAM bytes, put together from widths that are powers of two."""
    value, width, factor = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    whole, done = None, 0
    while True:
        if GRAM & width:
            whole = value if whole is None else whole[:len(whole) - width] * np.uint64(factor) + value[done:]
            done += width
        if 2 * width > GRAM:
            return whole * np.uint64(0xD6E8FEB86659FD93)
        value = value[:-width] * np.uint64(factor) + value[width:]
        factor = factor * factor % (1 << 64)
        width *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def regions(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first string and number of strings of each region of one text, in order."""
    found = [[], [], []]
    strings = len(data) - length + 1
    for a, b in blocks(max(strings, 0), AT_ONCE - length):
        hashes = gram_hashes(data[a:b + length - 1])
        place = np.arange(len(hashes), dtype=np.uint64)
        # the leftmost of the least hashes: the hash without its last 20 bits, then the place
        least = sliding_min((hashes & np.uint64(0xFFFFFFFFFFF00000)) | place, length - GRAM + 1)
        at = (least & np.uint64(0xFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        found[0].append(hashes[at[first]].view(np.int64))
        found[1].append(first + a)
        found[2].append(np.diff(np.append(first, len(at))))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def profiles(docs: DataFrame, length: int) -> DataFrame:
    """(id, row, h, sha256, n_bytes, found) per row of ``docs`` (id, row, text): a hash of the text, and its regions (anchor,
    place, r). ``place`` holds the first string and the number of strings, ``r`` is a hash of the region's bytes.
    ``found`` is null where the text is too short or, as far as the task remembers, came before."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for a, b in blocks(batch.num_rows, 256):
                hashes, shas, sizes, new, found = [], [], [], [], [[], [], []]
                for value in texts.slice(a, b - a):
                    data = value.as_py() or b""
                    sha = hashlib.sha256(data)
                    hashes.append(text_hash(data))
                    shas.append(sha.hexdigest())
                    sizes.append(len(data))
                    new.append(-1)
                    if len(data) >= length and sha.digest() not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(sha.digest())
                        anchor, first, number = regions(np.frombuffer(data, np.uint8), length)
                        new[-1] = len(anchor)
                        found[0].append(anchor)
                        found[1].append(first * 128 + number)
                        found[2].extend(text_hash(data[x:y]) for x, y in zip(first.tolist(), (first + number + length - 1).tolist()))
                flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found[:2]]
                flat = pa.StructArray.from_arrays([*map(pa.array, flat), pa.array(found[2], pa.int64())], fields=list(REGION))
                new = np.array(new)
                ends = np.cumsum(np.concatenate([[0], np.maximum(new, 0)])).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(new < 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(hashes, pa.int64()),
                     pa.array(shas, pa.string()), pa.array(sizes, pa.int64()), found],
                    names=["id", "row", "h", "sha256", "n_bytes", "found"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, row long, h long, sha256 string, n_bytes long, "
                                "found array<struct<anchor: bigint, place: bigint, r: bigint>>")


REGION = pa.struct([("anchor", pa.int64()), ("place", pa.int64()), ("r", pa.int64())])


def text_hash(data: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


# -- suffix sorting -----------------------------------------------------------

class Queues:
    """First-in-first-out queues of suffixes by first byte; the longest go to a temporary file when memory is full."""

    def __init__(self, buckets: int, in_memory: int = IN_MEMORY):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(buckets)]
        self.files: list[list[tuple[int, int]]] = [[] for _ in range(buckets)]
        self.file = None
        self.held, self.in_memory = 0, in_memory

    def push(self, suffixes: np.ndarray, first: np.ndarray) -> None:
        if not len(suffixes):
            return
        order = np.argsort(first.astype(np.uint16), kind="stable")  # a radix sort for numbers this short
        number = np.bincount(first)
        kinds = np.flatnonzero(number)
        for c, part in zip(kinds.tolist(), np.split(suffixes[order], np.cumsum(number[kinds])[:-1])):
            self.parts[c].append(part)
        self.held += len(suffixes)
        if self.held > self.in_memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for c, parts in enumerate(self.parts):
            if parts:
                self.file.seek(0, 2)
                joined = np.concatenate(parts)
                self.files[c].append((self.file.tell(), len(joined)))
                joined.tofile(self.file)
                self.parts[c] = []
        self.held = 0

    def pop(self, c: int) -> np.ndarray:
        """All of bucket ``c`` in the order of arrival."""
        stored = []
        for at, n in self.files[c]:
            self.file.seek(at)
            stored.append(np.fromfile(self.file, np.int64, n))
        out = np.concatenate([*stored, *self.parts[c], np.zeros(0, np.int64)])
        self.held -= sum(map(len, self.parts[c]))
        self.parts[c], self.files[c] = [], []
        return out


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next (type S)."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    following = np.searchsorted(differs, np.arange(n - 1))
    decided = following < len(differs)
    at = differs[np.minimum(following, max(len(differs) - 1, 0))] if len(differs) else np.zeros(n - 1, np.int64)
    out = np.zeros(n, bool)
    out[:-1] = decided & (text[at] < text[np.minimum(at + 1, n - 1)])
    out[-1] = True
    return out


def _sorted_lms(text: np.ndarray, small: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """The LMS suffixes ordered by at least their first ``depth`` bytes.

    The strings from one LMS suffix to the next are named by order; the reduced string of names is
    ranked by doubling, each round ordering suffixes by twice as many names.
    """
    ends = np.append(lms[1:], len(text) - 1) + 1
    size = ends - lms
    rank = np.zeros(len(lms), np.int64)
    for a in range(0, int(size.max(initial=0)), 6):  # names by bytes and types, six at a time
        key = np.zeros(len(lms), np.int64)
        for b in range(6):
            at = np.minimum(lms + a + b, len(text) - 1)
            key = key * 520 + np.where(a + b < size, 2 * text[at] + small[at] + 1, 0)
        rank = _dense(rank, key)
    width = 1
    while width < depth and rank.max(initial=0) < len(lms) - 1:
        after = np.zeros(len(lms), np.int64)
        after[:-width] = rank[width:] + 1
        rank = _dense(rank, after)
        width *= 2
    return lms[np.argsort(rank, kind="stable")]


def _dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Ranks of the pairs, equal pairs equally."""
    order = np.lexsort((low, high))
    new = np.concatenate([[False], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])])
    out = np.empty(len(high), np.int64)
    out[order] = np.cumsum(new)
    return out


def suffix_array(text: np.ndarray, depth: int, in_memory: int = IN_MEMORY) -> Iterator[np.ndarray]:
    """Suffixes of ``text`` (numbers below NUMBERS, the last one and no other 0) in order of at least ``depth`` of them, bucket by bucket."""
    text = text.astype(np.int32)
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = _sorted_lms(text, small, lms, depth) if len(lms) else lms
    by_first = np.split(seeds, np.searchsorted(text[seeds], np.arange(1, NUMBERS)))
    large, left = Queues(NUMBERS, in_memory), []
    for c in range(NUMBERS):  # type L, from small to large
        taken, now = [], large.pop(c)
        while len(now):
            taken.append(now)
            before = now[now > 0] - 1
            before = before[~small[before]]
            first = text[before]
            large.push(before[first > c], first[first > c])
            now = before[first == c]
        before = by_first[c][by_first[c] > 0] - 1
        large.push(before, text[before])
        left.append(np.concatenate(taken) if taken else now)
    small_queue, right = Queues(NUMBERS, in_memory), [None] * NUMBERS
    for c in range(NUMBERS - 1, -1, -1):  # type S, from large to small
        taken, now = [], small_queue.pop(c)
        while len(now):
            taken.append(now)
            before = now[now > 0] - 1
            before = before[small[before]]
            first = text[before]
            small_queue.push(before[first < c], first[first < c])
            now = before[first == c]
        before = left[c][::-1]
        before = before[before > 0] - 1
        before = before[small[before]]
        small_queue.push(before, text[before])
        right[c] = np.concatenate(taken)[::-1] if taken else now
    for c in range(NUMBERS):
        yield np.concatenate([left[c], right[c]])


def repeated_places(data: np.ndarray, sizes: np.ndarray, length: int, in_memory: int = IN_MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces of ``data``, laid end to end: where each begins once a byte is put after every piece, and for all places
    counted so, whether a string of ``length`` bytes starts there that occurs at an earlier place."""
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    text = np.ones(int((sizes + 1).sum()) + 1, np.uint16)
    text[-1] = 0
    start = np.zeros(len(text), bool)
    at = np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)
    text[at] = data.astype(np.uint16) + 2
    start[at] = np.repeat(begins + sizes, sizes) - at >= length
    del at
    out = np.zeros(len(text), bool)
    windows = np.lib.stride_tricks.sliding_window_view(text, length) if len(text) >= length else None
    for bucket in suffix_array(text, length, in_memory):
        bucket = bucket[start[bucket]]
        if len(bucket) < 2:
            continue
        same = np.zeros(len(bucket), bool)  # a common prefix of the whole length with the suffix before
        ends = text[bucket + length - 1]
        alike = np.flatnonzero(ends[1:] == ends[:-1])
        for a, b in blocks(len(alike), 1 << 15):
            n = alike[a:b]
            same[n + 1] = (windows[bucket[n]] == windows[bucket[n + 1]]).all(1)
        groups = np.flatnonzero(~same)
        earliest = np.minimum.reduceat(bucket, groups)
        out[bucket[bucket != np.repeat(earliest, np.diff(np.append(groups, len(bucket))))]] = True
    return begins, out


def repeated(pieces: list[bytes], length: int, in_memory: int = IN_MEMORY) -> list[np.ndarray]:
    """For each piece, which of its strings of ``length`` bytes occur at an earlier place of the pieces."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    begins, out = repeated_places(np.frombuffer(b"".join(pieces), np.uint8), sizes, length, in_memory)
    return [out[a:a + max(n - length + 1, 0)] for a, n in zip(begins, sizes)]


def _runs(flags: np.ndarray) -> np.ndarray:
    """(begin, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges.reshape(-1, 2)


# -- the operator -------------------------------------------------------------

def _cut_regions(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, t, place, region) of the regions ``found`` of ``texts`` (t, text, found): their bytes."""

    def run(batches):
        for batch in batches:
            texts, size = batch.column(1).cast(pa.binary()), pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            flat = batch.column(2).flatten()
            places = flat.field("place").to_numpy(zero_copy_only=False)
            ends, a = np.cumsum(size), 0
            while a < batch.num_rows:  # a bounded number of regions, one text at least
                before = int(ends[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(ends, before + 20_000, side="right")))
                first = places[before:ends[b - 1]] // 128
                last = (first + places[before:ends[b - 1]] % 128 + length - 1).tolist()
                first, parts = first.tolist(), []
                for i in range(a, b):
                    data, at = texts[i].as_py(), slice(len(parts), len(parts) + int(size[i]))
                    parts.extend(data[x:y] for x, y in zip(first[at], last[at]))
                number = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [flat.field("anchor").slice(before, number), batch.column(0).take(pa.array(np.repeat(np.arange(a, b), size[a:b]))),
                     pa.array(places[before:before + number]), pa.array(parts, pa.binary())], names=["anchor", "t", "place", "region"])
                a = b

    return texts.select("t", "text", "found").mapInArrow(run, "anchor long, t long, place long, region binary")


def _sort_shards(distinct: DataFrame, length: int) -> DataFrame:
    """(t, first, end): runs of repeated strings within the shards of ``distinct`` (shard, t, place, region), in this order."""

    def run(batches):
        held, shard = [], None
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(numbers)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if a == b:
                    continue
                if held and numbers[a] != shard:
                    yield from finish(held)
                    held = []
                shard = numbers[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from finish(held)

    def finish(held):
        t, place = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in (1, 2))
        data, sizes = zip(*(_bytes(h.column(3)) for h in held))
        begins, out = repeated_places(np.concatenate(data), np.concatenate(sizes), length)
        found = _runs(out)
        piece = np.searchsorted(begins, found[:, 0], side="right") - 1
        offset = place[piece] // 128 - begins[piece]
        for a, b in blocks(len(found), 10_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(t[piece[a:b]]), pa.array(offset[a:b] + found[a:b, 0]), pa.array(offset[a:b] + found[a:b, 1] - 1 + length)],
                names=["t", "first", "end"])

    return distinct.mapInArrow(run, "t long, first long, end long")


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and the lengths of its values."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]], np.diff(ends)


def _removed(texts: DataFrame) -> DataFrame:
    """(t, n_removed, n_spans, kept_sha256, spans) of ``texts`` (t, text, parts)."""

    def run(batches):
        for batch in batches:
            rows = []
            for t, text, parts in zip(*(batch.column(i) for i in range(3))):
                data = text.as_py().encode()
                spans: list[list[int]] = []
                for a, b in sorted((p["first"], p["end"]) for p in parts.as_py()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                rows.append((t.as_py(), sum(b - a for a, b in spans), len(spans), kept.hexdigest(),
                             [{"start": a, "end": b} for a, b in spans]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), SPANS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                                             names=["t", "n_removed", "n_spans", "kept_sha256", "spans"])

    return texts.select("t", "text", "parts").mapInArrow(
        run, "t long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, spans (maximal removed runs, ends exclusive).

    Strings are bytes of UTF-8, never cross texts, and are judged on the input. A null text is empty.
    Earlier means a smaller id, or an earlier start in the same text; a null id comes first. Rows that
    repeat an id stand in the order of a hash of the text; rows equal in id and text are one document and
    get the same result each. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    with_regions = stage(profiles(rows.select("id", F.monotonically_increasing_id().alias("row"), "text"), length), "profiles")
    has_regions = F.col("found").isNotNull()
    profiled = stage(with_regions.withColumn("cut", has_regions).drop("found"), "texts")
    # a text's number is its place in the order of the corpus; ``row`` is a row of it that holds its regions
    texts = profiled.groupBy("sha256").agg(
        F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("f"), F.min("h").alias("h"),
        F.min(F.when(F.col("cut"), F.col("row"))).alias("row"))
    texts = texts.select("sha256", F.col("f.known").alias("known"), F.col("f.id").alias("first_id"), "h", "row", F.lit(1).alias("one"))
    texts = running_start(texts, [], ["known", "first_id", "h", "sha256"], "one", "t")
    texts = stage(texts.select("t", "sha256", "first_id", "row"), "texts")
    once = not profiled.groupBy("id", "sha256").count().where("count > 1").head(1)

    def first_texts(wanted: DataFrame) -> DataFrame:
        """``wanted`` (t, ...) with the text of the first document of each text."""
        named = wanted.join(texts.drop("row"), "t")
        out = rows.withColumn("__h", F.sha2("text", 256)).join(
            named, (F.col("__h") == F.col("sha256")) & F.col("id").eqNullSafe(F.col("first_id")))
        return out if once else out.dropDuplicates(["t"])

    listed = lambda df: df.groupBy("t").agg(F.collect_list(F.struct("anchor", "place")).alias("found"))
    found = with_regions.where(has_regions).select("row", F.explode("found").alias("g")).select("g.anchor", "row", "g.place", "g.r")
    often = settled(found.groupBy("anchor").count().where("count > 1").select("anchor"), "often")
    # copies that several tasks cut go here, where few regions are left: only the row that ``texts`` names stays
    cut = found.join(often, "anchor").join(texts.where("row is not null").select("row", "t"), "row")
    cut = settled(cut.select("anchor", "t", "place", "r"), "regions")
    discard(with_regions, often)
    # equal regions: all but the first repeat as a whole; anchors with one kind of region are done with that
    earliest = F.struct("t", "place")
    # (tables that a join reads are stored: AQE splits a hot key only where both sides come from a shuffle of their own)
    firsts = settled(cut.groupBy("anchor", "r").agg(F.min(earliest).alias("earliest")), "firsts")
    marked = cut.join(firsts, ["anchor", "r"]).withColumn("stays", earliest == F.col("earliest"))
    marked = settled(marked.select("anchor", "t", "place", "stays"), "marked")
    discard(cut, firsts)
    first = F.floor(F.col("place") / 128)
    whole = marked.where("not stays").select("t", first.alias("first"), (first + F.col("place") % 128 + length - 1).alias("end"))
    left = marked.where("stays").drop("stays")
    mixed = settled(left.groupBy("anchor").count().where("count > 1").select("anchor"), "mixed")
    kept = settled(listed(left.join(mixed, "anchor")), "left")
    left = settled(_cut_regions(first_texts(kept), length), "bytes")
    discard(mixed, kept)
    total = left.agg(F.sum(F.octet_length("region"))).head()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    dealt = left.select(F.pmod("anchor", F.lit(shards)).alias("shard"), "t", "place", "region")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "t", "place")
    parts = whole.union(_sort_shards(dealt, length)).groupBy("t").agg(F.collect_list(F.struct("first", "end")).alias("parts"))
    parts = settled(parts, "parts")
    discard(marked, left)
    done = settled(_removed(first_texts(parts)), "removed")
    changed = texts.join(done, "t", "left").select(F.col("sha256").alias("__sha"), "first_id", "n_removed", "n_spans", "kept_sha256", "spans")
    named = profiled.join(settled(changed, "by-text"), F.col("sha256") == F.col("__sha"))
    copy = ~F.col("id").eqNullSafe(F.col("first_id")) & (F.col("n_bytes") >= length)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    zero = F.lit(0).cast("long")
    own = lambda c, otherwise: F.coalesce(F.col(c), otherwise)
    return named.select(
        F.col("id").alias(id_col), "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(own("n_removed", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(own("n_spans", zero)).alias("n_spans"),
        F.when(copy, nothing).otherwise(own("kept_sha256", F.col("sha256"))).alias("kept_sha256"),
        F.when(copy, F.array(F.struct(zero.alias("start"), F.col("n_bytes").alias("end"))))
        .otherwise(F.col("spans")).alias("spans"))
