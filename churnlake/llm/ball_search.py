"""Exact ranked lexical search: inner products over sparse ball trees.

A document is the vector of its integer impacts along the terms that are asked for, a question the
vector of the weights of its terms; the score is their inner product. Each task cuts its documents
into pieces of a bounded size and builds a ball tree over each: a node has a centroid, the radius of
the ball that holds its documents, and along each term how far a document lies above the centroid.
The product of a question with any document below is at most the product with the centroid plus
length times radius, and at most the product with the centroid plus those heights. Subtrees are
opened best bound first, until none can reach the question's worst answer kept; the bounds are
rounded up by more than doubles can err, and leaves are scored in 64-bit integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.common import kind_of
from churnlake.session import stage

#: Documents in a leaf, leaves in a tree, and values in the nodes of one tree (nodes times terms).
LEAF, LEAVES, NODE_VALUES = 64, 128, 1 << 22
#: Questions and their different terms that are searched for in one pass over the documents.
QUESTIONS, QUESTION_TERMS = 256, 16_384
#: A bound is raised by this share and by one: more than sums of doubles below 2**53 lose.
RAISED = 1e-9


def splitter() -> Callable[[str | None], list[bytes]]:
    """Terms of a text: maximal runs of 0-9, letters and all that is not ASCII; only A-Z in lower case. Null has none."""
    codes = bytearray(b" " * 128) + bytes(range(128, 256))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        codes[c] = c
    for c in range(65, 91):
        codes[c] = c + 32
    codes = bytes(codes)
    return lambda text: text.encode().translate(codes).split() if text else []


@dataclass
class Rows:
    """Sparse vectors: row i has ``impacts[starts[i]:starts[i + 1]]`` along ``terms``; ``keys`` order equal scores."""

    keys: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        size = self.starts[rows + 1] - self.starts[rows]
        starts = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.starts[rows] - starts[:-1], size) + np.arange(starts[-1])
        return Rows(self.keys[rows], starts, self.terms[at], self.impacts[at])

    def times(self, vector: np.ndarray) -> np.ndarray:
        """Inner products of all rows, none of which is empty, with a dense vector."""
        return np.add.reduceat(vector[self.terms] * self.impacts, self.starts[:-1])


class BallTree:
    """Nodes in preorder: ``centroid`` and ``above`` (node, term), ``radius``, ``children`` or the ``leaf`` rows."""

    def __init__(self, rows: Rows, n_terms: int):
        self.n_terms = n_terms
        self.centroid: list[np.ndarray] = []
        self.highest: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.leaf: list[Rows | None] = []
        self._build(rows)
        self.above = np.stack(self.highest) - np.stack(self.centroid)
        self.centroid = np.stack(self.centroid)
        self.radius = np.array(self.radius)

    def _build(self, rows: Rows) -> int:
        node, n = len(self.radius), len(rows.keys)
        centroid = np.bincount(rows.terms, rows.impacts, self.n_terms) / n
        own = np.add.reduceat(rows.impacts.astype(float) ** 2, rows.starts[:-1])
        away = own - 2 * rows.times(centroid) + centroid @ centroid
        far = int(away.argmax())
        # what the three terms of a distance can lose in doubles is added before the root is taken
        self.radius.append(math.sqrt(max(away[far], 0) + RAISED * (own.max() + centroid @ centroid) + 1))
        self.centroid.append(centroid)
        self.children.append(None)
        self.leaf.append(rows if n <= LEAF else None)
        self.highest.append(centroid)
        if n <= LEAF:
            highest = np.zeros(self.n_terms)
            np.maximum.at(highest, rows.terms, rows.impacts.astype(float))
        else:
            pivot = self._dense(rows, far)
            other = self._dense(rows, int((own - 2 * rows.times(pivot)).argmax()))
            order = np.argsort(rows.times(other - pivot), kind="stable")  # halves, so that copies do not make the tree deep
            left, right = self._build(rows.take(order[:n // 2])), self._build(rows.take(order[n // 2:]))
            self.children[node] = (left, right)
            highest = np.maximum(self.highest[left], self.highest[right])
        self.highest[node] = highest
        return node

    def _dense(self, rows: Rows, i: int) -> np.ndarray:
        at = slice(rows.starts[i], rows.starts[i + 1])
        return np.bincount(rows.terms[at], rows.impacts[at], self.n_terms)

    def bounds(self, weights: np.ndarray) -> np.ndarray:
        """(node, question): no document of the node scores more with the question. ``weights`` is (term, question)."""
        centre = self.centroid @ weights
        by_ball = centre + self.radius[:, None] * np.sqrt((weights * weights).sum(0))
        return np.minimum(by_ball, centre + self.above @ weights) * (1 + RAISED) + 1

    def search(self, bounds: list[float], weights: np.ndarray, best: list[tuple[int, float]], k: int) -> None:
        """Bring the ``k`` best of all documents into the heap ``best``: (score, key), the worst on top."""
        opened = [(-bounds[0], 0)]
        while opened:
            bound, node = heapq.heappop(opened)
            if -bound < 2 or len(best) == k and -bound < best[0][0]:  # no document above 0, or none that reaches the worst
                return
            rows = self.leaf[node]
            if rows is None:
                for child in self.children[node]:
                    heapq.heappush(opened, (-bounds[child], child))
                continue
            scores = rows.times(weights)
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= max(least, 1)).tolist():
                entry = (int(scores[i]), rows.keys[i])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def impacts(counts: np.ndarray, sizes: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """Impact of a term that occurs ``counts`` times in a document of ``sizes`` terms; integers, division rounds down."""
    length = 100 - 90 + (90 * sizes * n_docs) // n_words
    return (1_000_000_000 * counts) // (1000 * counts + 8 * length)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _vectors(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts): number of all terms of each row, and those that are asked for, with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches):
        split, number = splitter(), shared.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1):
                words = split(text.as_py())
                found = np.array([t for t in map(number.get, words) if t is not None], np.int32)
                found, times = np.unique(found, return_counts=True)
                sizes.append(len(words))
                terms.append(found)
                counts.append(times)
            starts = pa.array(np.concatenate([[0], np.cumsum([len(t) for t in terms])]), pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate([np.zeros(0, kind), *part]).astype(kind)))
                     for part, kind in ((terms, np.int32), (counts, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "counts"])

    return docs.mapInArrow(run, f"id {kind_of(docs, 'id')}, n long, terms array<int>, counts array<long>")


def _document_counts(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term occurs: sums of partitions, of which at most ``n_terms`` rows remain."""

    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten(), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for row in vectors.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[row["term"]] = row["df"]
    return out


def _pieces(batches, most: int, n_docs: int, n_words: int) -> Iterator[Rows]:
    """The rows that hold a term asked for, in pieces of at most ``most``."""
    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
        for start in range(0, batch.num_rows, most):
            part = batch.slice(start, most)
            size = pc.list_value_length(part.column(2)).to_numpy().astype(np.int64)
            counts = part.column(3).flatten().to_numpy()
            found = impacts(counts, np.repeat(part.column(1).to_numpy(), size), n_docs, n_words)
            # the smaller id first among equal scores, no id last
            keys = np.array([-math.inf if i is None else -i for i in part.column(0).to_pylist()], object)
            yield Rows(keys, np.concatenate([[0], np.cumsum(size)]), part.column(2).flatten().to_numpy().astype(np.int64), found)


def _answers(vectors: DataFrame, questions: list[list[int]], n_terms: int, n_docs: int, n_words: int, k: int) -> DataFrame:
    """(number, id, score): the best ``k`` documents of each task for each question."""
    df = _document_counts(vectors, n_terms)
    shared = vectors.sparkSession.sparkContext.broadcast((questions, np.array([weight(n_docs, int(x)) for x in df], np.int64)))
    most = LEAF * max(1, min(LEAVES, NODE_VALUES // (2 * n_terms)))

    def run(batches):
        asked, by_term = shared.value
        weights = np.zeros((len(asked), n_terms), np.int64)
        for n, terms in enumerate(asked):
            weights[n, terms] = by_term[terms]
        dense = np.ascontiguousarray(weights.T, float)
        best = [[] for _ in asked]
        for rows in _pieces(batches, most, n_docs, n_words):
            tree = BallTree(rows, n_terms)
            for n, bounds in enumerate(tree.bounds(dense).T.tolist()):
                tree.search(bounds, weights[n], best[n], k)
        found = [(n, None if key == -math.inf else -key, score) for n, heap in enumerate(best) for score, key in heap]
        if found:
            number, ids, scores = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                                             names=["number", "id", "score"])

    return vectors.mapInArrow(run, "number long, id long, score long")


def _asked(items: DataFrame) -> Iterator[tuple[list[tuple], dict[bytes, int]]]:
    """Blocks of questions (item, numbers of its different terms) and the numbers of their terms."""

    def run(batches):
        split = splitter()
        for batch in batches:
            terms = [sorted(set(split(v.as_py()))) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["id", "terms"])

    block, numbers = [], {}
    for row in items.mapInArrow(run, f"id {kind_of(items, 'id')}, terms array<binary>").toLocalIterator():
        terms = [bytes(t) for t in row["terms"]]
        if block and (len(block) == QUESTIONS or len(numbers) + len(terms) > QUESTION_TERMS):
            yield block, numbers
            block, numbers = [], {}
        if terms:
            block.append((row["id"], [numbers.setdefault(t, len(numbers)) for t in terms]))
    if block:
        yield block, numbers


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 of each item, equal scores by ascending id.

    All documents are scored for all items, in blocks of at most QUESTIONS items: one pass over the texts per block.
    Rows of ``docs`` that repeat an id are documents of their own, and all count in the statistics; documents without
    an id rank behind equal ones. Each row of ``items`` is answered, also when an id is repeated or null. Null and
    empty texts have no terms: such items have no rows, such documents are not counted. Ids of documents are long.
    Other columns are ignored. Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    item_kind = kind_of(items, item_col)
    out = spark.createDataFrame([], f"{item_col} {item_kind}, rank int, {id_col} long, score long")
    for block, numbers in _asked(items.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))):
        vectors = stage(_vectors(texts, numbers), "vectors")
        n_docs, n_words = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_words:
            return out
        found = _answers(vectors, [terms for _, terms in block], len(numbers), n_docs, n_words, k)
        place = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        best = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        named = F.broadcast(spark.createDataFrame([(n, item) for n, (item, _) in enumerate(block)], f"number long, item {item_kind}"))
        answered = best.join(named, "number").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        out = out.unionByName(stage(answered, "answers"))
    return out


#: ``rank`` over documents and benchmark, in DuckDB.
RANK_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS big_n, sum(len(terms))::BIGINT AS big_l FROM t),
d AS (SELECT doc_id, 10 + (90 * len(terms) * big_n) // big_l AS m FROM t, s WHERE len(terms) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM t) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (doc_id) GROUP BY ALL)
SELECT item_id, (row_number() OVER p)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0
WINDOW p AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER p <= 10
"""
