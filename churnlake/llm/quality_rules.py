"""Quality rules of documents as a ledger of failure bits.

One pass measures every text and one expression per rule turns the measurements into a bit: the
ledger holds both. A policy is a named, versioned set of rules, so its mask decides a document by
one bitwise and; texts are not read again for another policy. How many documents each rule removes,
alone or with others, comes from the counts of equal bit patterns.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import kind_of

WINDOW = 5
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_upper_words"]


@dataclass(frozen=True)
class Rule:
    """``failed`` makes the condition of a failure from the measurements; ``bit`` is its place in the ledger for good."""

    name: str
    bit: int
    failed: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    """The rules that documents must not fail. A changed set is a new version."""

    name: str
    version: int
    rules: tuple[str, ...]


RULES = (
    Rule("few_words", 0, lambda: F.col("n_words") < 10),
    Rule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("mean_word_length", 2, lambda: (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words"))),
    Rule("symbols", 3, lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("repeated_lines", 4, lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
    Rule("words_without_letter", 5, lambda: 10 * F.col("n_letter_words") < 8 * F.col("n_words")),
    Rule("capitals", 6, lambda: 10 * F.col("n_upper_words") > 3 * F.col("n_words")),
    Rule("many_words", 7, lambda: F.col("n_words") > 100_000),
)
BASE = Policy("base", 1, ("few_words", "repeated_windows"))
#: Version 1 also turned long documents away; they are cut when they are packed, so version 2 keeps them.
CORPUS = (
    Policy("corpus", 1, tuple(r.name for r in RULES)),
    Policy("corpus", 2, tuple(r.name for r in RULES if r.name != "many_words")),
)


def _words_in_repeats(ids: np.ndarray) -> int:
    """Words that lie in a window of WINDOW words which occurs twice or more. Windows are compared exactly, by ranks."""
    if len(ids) <= WINDOW:
        return 0

    def rank(left, right):
        return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]

    window = ids
    for more in range(1, WINDOW):
        window = rank(window[:len(ids) - more], ids[more:])
    repeated = np.flatnonzero(np.bincount(window)[window] > 1)
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, repeated, 1)
    np.add.at(covered, repeated + WINDOW, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def _measurer() -> Callable[[str | None], tuple[int, ...]]:
    letter = re.compile(rb"[A-Za-z\x80-\xff]").search
    upper = re.compile(rb"[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*").fullmatch

    def measure(text: str | None) -> tuple[int, ...]:
        text = text or ""
        data = text.encode()
        words = data.split()  # of bytes: ASCII white space only
        number: dict[bytes, int] = defaultdict(count().__next__)
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        times = np.bincount(ids, minlength=len(number))
        letters = np.fromiter(map(bool, map(letter, number)), bool, len(number))
        uppers = np.fromiter(map(bool, map(upper, number)), bool, len(number))
        lines = [line for line in data.split(b"\n") if line.strip()]
        return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
                _words_in_repeats(ids), len(lines), int(times[letters].sum()), int(times[uppers].sum()))

    return measure


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, the MEASURES and ``failed``, the bits of the RULES that the text fails.

    Null and empty texts have no word. Rows without an id and repeated rows have a row each, judged by their own
    text. Other columns are ignored; an empty table gives an empty ledger. Nothing is shuffled.
    """
    names = MEASURES

    def run(batches):
        measure = _measurer()
        for batch in batches:
            rows = np.array([measure(v.as_py()) for v in batch.column(1)], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T)], names=["id", *names])

    schema = ", ".join([f"id {kind_of(docs, id_col)}", *(f"{m} long" for m in names)])
    measured = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    bits = reduce(Column.bitwiseOR, (F.when(r.failed(), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES))
    return measured.withColumn("failed", bits).withColumnRenamed("id", id_col)


def mask(policy: Policy) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in policy.rules)


def passes(policy: Policy) -> Column:
    """Whether a row of the ledger fails no rule of ``policy``."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = CORPUS) -> DataFrame:
    """What each rule does in each policy: a row per policy, version and rule.

    ``n_failed`` documents fail the rule, ``n_alone`` of them no other rule of the policy, so the policy without the
    rule would keep as many more; ``n_removed`` fail any rule of the policy and ``n_kept`` none. Counts of equal bit
    patterns are taken first: the second aggregation reads one row per pattern, however large the ledger is.
    """
    spark = entries.sparkSession
    bits = {r.name: r.bit for r in RULES}
    asked = spark.createDataFrame([(p.name, p.version, name, mask(p), 1 << bits[name]) for p in policies for name in p.rules],
                                  "policy string, version int, rule string, mask long, bit long")
    patterns = entries.groupBy("failed").agg(F.count("*").alias("n"))
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    each = patterns.withColumn("asked", F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(asked.columns, row)])
                                                            for row in asked.collect()]))).select("failed", "n", "asked.*")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return each.groupBy("policy", "version", "rule").agg(
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"), total(hit == F.col("bit")).alias("n_alone"),
        total(hit != 0).alias("n_removed"), total(hit == 0).alias("n_kept"))


def judge(docs: DataFrame, policy: Policy = CORPUS[-1], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``: false where a base rule or a rule of ``policy`` fails."""
    return (ledger(docs, id_col, text_col).withColumn("base_failed", ~passes(BASE))
            .withColumn("kept", passes(BASE) & passes(policy)))


#: Both in DuckDB, for the same columns.
JUDGE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM t),
g AS (SELECT doc_id, pos, word, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c, lead(word, 3) OVER p AS d, lead(word, 4) OVER p AS e
      FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, word, b, c, d, e) AS n FROM g WHERE e IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM twice, range(5) AS r(k) WHERE n > 1 GROUP BY doc_id),
per_word AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
                    count(*) FILTER (regexp_matches(word, '[^\x00-\x40\x5B-\x60\x7B-\x7F]')) AS n_letter_words,
                    count(*) FILTER (regexp_full_match(word, '(?s)[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*')) AS n_upper_words
             FROM w GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
per_line AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
             WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_letter_words, 0) AS n_letter_words,
             coalesce(n_upper_words, 0) AS n_upper_words
      FROM t LEFT JOIN per_word USING (doc_id) LEFT JOIN per_line USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
                 + CASE WHEN word_chars < 3 * n_words OR word_chars > 12 * n_words THEN 4 ELSE 0 END
                 + CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END
                 + CASE WHEN 10 * n_letter_words < 8 * n_words THEN 32 ELSE 0 END
                 + CASE WHEN 10 * n_upper_words > 3 * n_words THEN 64 ELSE 0 END + CASE WHEN n_words > 100000 THEN 128 ELSE 0 END)::BIGINT AS failed
      FROM m)
SELECT *, (failed & 3) <> 0 AS base_failed, (failed & 127) = 0 AS kept FROM f
"""
