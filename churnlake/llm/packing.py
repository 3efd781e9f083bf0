"""Packing of tokenised documents into fixed windows by minimum bin slack.

Documents longer than a window give whole windows and a rest. Only how many pieces there are of
each length decides the packing: while lengths remain, the largest opens a window, and a bitset
of reachable sums finds the multiset of remaining lengths that fills it closest to capacity; the
counts are found by going back through the bitsets. A multiset is used as often as its lengths
allow, so the plan grows with the number of different lengths, not with the documents.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import in_pieces, running_start
from churnlake.session import few_tasks, stage

WINDOW = 4096
END_ID = 2
#: At about 250 bytes a word; a worker forgets all words beyond. Workers hold them while they run other stages too.
WORDS_KEPT = 200_000


class KeptWords(dict):
    """Token ids by word. A word that is not there is encoded by itself; all are forgotten at ``WORDS_KEPT``."""

    def __init__(self, model, spelling: dict[int, str]):
        super().__init__()
        self.model, self.spelling = model, spelling

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        spelt = word if word.isascii() else word.translate(self.spelling)
        ids = self[word] = np.array([t.id for t in self.model.tokenize(spelt)], "<u4").tobytes()
        return ids


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes, for a tokenizer that lower-cases and splits words.

    The tokenizer's model encodes every word (pre-token) by itself, so ids are kept by word, and a new word
    goes to the model alone, spelt as the pre-tokenizer spells it. Texts with characters outside of Latin
    letters, digits, usual punctuation and white space, or with ``<|``, go to the tokenizer whole.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        latin = [chr(c) for c in (*range(0x20, 0x7F), *range(0xA1, 0x250)) if c != 0xAD]
        letters = "".join(re.escape(c) for c in latin if unicodedata.category(c)[0] == "L")
        numbers = "".join(re.escape(c) for c in latin if unicodedata.category(c)[0] == "N")
        self.ascii = bytes([*b"\t\n\r", *range(0x20, 0x7F)])
        usual = [c for c in latin if not c.isascii() and c != "ŉ" and set(c.lower()) <= set(latin)]
        self.other = re.compile(f"[^{''.join(map(re.escape, usual))}]")
        self.words = re.compile(rf"[{letters}]+|[{numbers}]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{letters}{numbers}]+")
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.kept = KeptWords(self.tokenizer.model, {ord(c): spell(c)[0][0] for c in usual})

    def __call__(self, text: str) -> bytes:
        if "<|" in text or self.other.search(text.encode().translate(None, self.ascii).decode()):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.kept.__getitem__, self.words.findall(text.lower())))


def encoder_of(definition: str) -> Encoder:
    """One encoder in each Python worker, so that later tasks find the words that earlier ones kept.

    It is held by a module made in the worker, because this one need not be there.
    """
    holder = sys.modules.setdefault("kept_word_encoder", types.ModuleType("kept_word_encoder"))
    if getattr(holder, "definition", None) != definition:
        holder.definition, holder.encoder = definition, Encoder(definition)
    return holder.encoder


def pieces(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
           window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): each document's ids and ``end_id``, cut after every ``window`` ids."""
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = encoder_of(definition.value)
        for batch in (piece for whole in batches for piece in in_pieces(whole, 1)):
            ids, rows = [], []
            for i, text in enumerate(batch.column(1)):
                tokens = encoder(text.as_py() or "") + end
                for start in range(0, len(tokens), 4 * window):
                    part = tokens[start:start + 4 * window]
                    rows.append((start // 4, len(part) // 4, zlib.crc32(part), len(tokens) // 4))
                    ids.append(i)
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *columns],
                                             names=["id", "start", "length", "ids_crc32", "doc_tokens"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, f"id {chosen.schema[0].dataType.simpleString()}, start long, length long, "
                                  "ids_crc32 long, doc_tokens long")


@dataclass(frozen=True)
class Pattern:
    """A multiset of lengths (length, number), longest first, and how many windows hold it."""

    lengths: tuple[tuple[int, int], ...]
    windows: int


def fullest(counts: dict[int, int], lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(length, number): the multiset within ``counts`` whose sum comes closest to ``capacity`` from below.

    ``lengths`` holds the keys of ``counts`` in falling order. Bit s of the set says that s can be reached.
    """
    reached, full, steps = 1, 1 << capacity, []
    keep = (full << 1) - 1
    for length in lengths:
        left = min(counts[length], capacity // length) if length <= capacity else 0
        take = 1
        while left > 0 and not reached & full:
            number = min(take, left)
            steps.append((length, number, reached))
            reached |= (reached << (length * number)) & keep
            left -= number
            take *= 2
        if reached & full:
            break
    total, used = reached.bit_length() - 1, Counter()
    for length, number, before in reversed(steps):
        if not before >> total & 1:
            used[length] += number
            total -= length * number
    return sorted(used.items(), reverse=True)


def min_bin_slack(counts: dict[int, int], window: int) -> list[Pattern]:
    """Patterns that use up all pieces of ``counts`` (length to number)."""
    counts = {length: n for length, n in counts.items() if n > 0}
    lengths, out = sorted(counts, reverse=True), []
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        used = Counter(dict(fullest(counts, lengths, window - first)))
        counts[first] += 1
        used[first] += 1
        windows = min(counts[length] // n for length, n in used.items())
        out.append(Pattern(tuple(sorted(used.items(), reverse=True)), windows))
        for length, n in used.items():
            counts[length] -= n * windows
        lengths = [length for length in lengths if counts[length]]
    return out


def places(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first window, number per window, first offset), by rank."""
    used: Counter[int] = Counter()
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    window = 0
    for p in patterns:
        offset = 0
        for length, number in p.lengths:
            rows.setdefault(length, []).append((used[length], window, number, offset))
            used[length] += number * p.windows
            offset += number * length
        window += p.windows
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text counts as empty and has the end id only. Rows that repeat an id are packed each.
    Pieces of equal length are interchangeable; they are placed by id, start and checksum, so reruns
    agree. The number of pieces of each length, at most ``window`` numbers, reaches the driver.
    """
    cut = stage(pieces(docs, tokenizer_file, id_col, text_col, window, end_id), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    table, total = docs.sparkSession.sparkContext.broadcast(places(min_bin_slack(counts, window))), sum(counts.values())
    ranked = running_start(cut.withColumn("one", F.lit(1).cast("long")), ["length"], ["id", "start", "ids_crc32"],
                           "one", "rank", total).drop("one")

    def run(batches):
        where = table.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                m = length == one
                rows = where[int(one)]
                row = rows[np.searchsorted(rows[:, 0], rank[m], side="right") - 1]
                inside = rank[m] - row[:, 0]
                sequence[m] = row[:, 1] + inside // row[:, 2]
                offset[m] = row[:, 3] + inside % row[:, 2] * one
            keep = [batch.column(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(offset)],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = cut.schema["id"].dataType.simpleString()
    return few_tasks(ranked, total).mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long").withColumnRenamed("id", id_col)
