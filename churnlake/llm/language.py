"""Language identification by prediction by partial matching (PPM) over bytes.

For each language a context tree of up to three preceding bytes is learned. A byte is coded
in the longest context of the tree; bytes not seen there escape to the next shorter context,
with the escape probability of method C and exclusion of what the longer contexts could have
coded, down to equal odds of all bytes left. Statistics are frozen after learning, so the code
length of a byte depends on its three predecessors only, and the code lengths of all symbols in
all contexts are tabulated once. The language with the shortest code of a whole text wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import blocks, in_pieces, unused, utf8

ORDER = 3
UNKNOWN = "und"
AT_ONCE = 1 << 19
#: Bytes whose contexts are looked up at once; each takes about 50 bytes of memory meanwhile.
LOOKED_UP = 1 << 17
LETTER = r"\p{L}"


@dataclass
class Model:
    """Frozen code lengths. ``symbol`` maps a byte to its symbol (0 is kept for the start of a text),
    ``row`` three preceding symbols to a context, ``bits[row, symbol]`` holds a length per language."""

    languages: list[str]
    symbol: np.ndarray
    row: np.ndarray
    bits: np.ndarray


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1. A null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid end to end, each after three zero bytes, and where each begins. Zero bytes in a text become 1."""
    data, offsets = utf8(column)
    starts = offsets[:-1] + ORDER * np.arange(1, len(offsets))
    return np.insert(np.maximum(data, 1), np.repeat(offsets[:-1], ORDER), 0), starts


def count_grams(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, n): how often each byte follows each three bytes, by language."""

    def run(batches):
        for batch in (piece for whole in batches for piece in in_pieces(whole, 1, 4 * AT_ONCE)):
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                texts = batch.column(1).filter(pa.array(langs == lang))
                data, _ = _padded(texts)
                for a, b in blocks(len(data), AT_ONCE):
                    a = max(0, a - ORDER)
                    part = data[a:b].astype(np.int64)
                    gram = (part[:-3] << 24) | (part[1:-2] << 16) | (part[2:-1] << 8) | part[3:]
                    gram, n = np.unique(gram[part[3:] > 0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram),
                                                      pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    found = docs.select(lang_col, text_col).mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          chars_per_language: int = 8_000_000, contexts: int = 20_000) -> Model:
    """Learn from the rows of ``docs`` that have text and language and are not held out.

    The sample is bounded: of each language, documents of about ``chars_per_language`` characters,
    chosen by a hash of the id (all, if there are fewer; always the one of least hash). The
    ``contexts`` most frequent contexts of three bytes are kept; others use two bytes or one.
    """
    usable = docs.select(id_col, text_col, lang_col).where(
        F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col))
    usable = usable.withColumn("__h", F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)))
    stats = (usable.groupBy(lang_col).agg(F.sum(F.length(text_col)).alias("chars"), F.min("__h").alias("least"))
             .orderBy(lang_col).collect())
    if not stats:
        return Model([], np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((1, 1, 0), np.float32))
    share = F.create_map(*[F.lit(x) for r in stats for x in
                           (r[0], max(r["least"], int(min(1, chars_per_language / max(1, r["chars"])) * (1 << 30))))])
    sample = usable.where(F.col("__h") <= share[F.col(lang_col)])
    return build([r[0] for r in stats], count_grams(sample, lang_col, text_col).toPandas(), contexts)


def build(languages: list[str], grams, contexts: int) -> Model:
    """Tabulate code lengths from counted grams (lang, gram, n)."""
    seen = np.unique(np.concatenate([(grams.gram.to_numpy() >> s) & 255 for s in (0, 8, 16, 24)] + [np.zeros(1, np.int64)]))
    seen = seen[seen > 0]
    size = len(seen) + 2
    symbol = np.full(256, size - 1, np.int64)  # the last symbol: bytes never seen
    symbol[seen] = np.arange(1, len(seen) + 1)
    to_symbol = symbol.copy()
    to_symbol[0] = 0
    s = [to_symbol[(grams.gram.to_numpy() >> shift) & 255] for shift in (24, 16, 8, 0)]
    lang = grams.lang.map({x: i for i, x in enumerate(languages)}).to_numpy()
    n = grams.n.to_numpy().astype(np.float64)
    two, three = s[1] * size + s[2], (s[0] * size + s[1]) * size + s[2]
    kept3, total = np.unique(three, return_inverse=True)
    total = np.bincount(total, n, len(kept3))
    kept3 = np.sort(kept3[np.argsort(-total, kind="stable")[:contexts]])
    kept2 = np.unique(two)
    row = np.tile(np.arange(size, dtype=np.int32), size * size)  # one byte of context: rows 0 to size - 1
    place2 = np.full(size * size, -1, np.int32)
    place2[kept2] = size + np.arange(len(kept2), dtype=np.int32)
    row = np.where(np.tile(place2, size) >= 0, np.tile(place2, size), row)
    row[kept3] = size + len(kept2) + np.arange(len(kept3), dtype=np.int32)
    bits = np.zeros((size + len(kept2) + len(kept3), size, len(languages)), np.float32)
    ones, twos, threes = np.arange(size), kept2, kept3
    for k in range(len(languages)):
        m = lang == k
        c0 = np.bincount(s[3][m], n[m], size)
        c1 = np.bincount(s[2][m] * size + s[3][m], n[m], size * size).reshape(size, size)
        p2, p3 = np.searchsorted(kept2, two[m]), np.searchsorted(kept3, three[m])
        c2 = np.bincount(p2 * size + s[3][m], n[m], len(kept2) * size).reshape(-1, size)
        in3 = (p3 < len(kept3)) & (kept3[np.minimum(p3, len(kept3) - 1)] == three[m])
        c3 = np.bincount((p3 * size + s[3][m])[in3], n[m][in3], len(kept3) * size).reshape(-1, size)
        bits[:size, :, k] = _code_lengths([c1, c0[None].repeat(size, 0)])
        at = size
        for a, b in blocks(len(twos), 4096):
            bits[at + a:at + b, :, k] = _code_lengths([c2[a:b], c1[twos[a:b] % size], c0[None].repeat(b - a, 0)])
        at += len(twos)
        for a, b in blocks(len(threes), 4096):
            inner = np.searchsorted(kept2, threes[a:b] % (size * size))
            bits[at + a:at + b, :, k] = _code_lengths(
                [c3[a:b], c2[inner], c1[threes[a:b] % size], c0[None].repeat(b - a, 0)])
    return Model(languages, symbol, row, bits)


def _code_lengths(counts: list[np.ndarray]) -> np.ndarray:
    """Bits of each symbol, given its counts in contexts from long to short (rows: contexts, columns: symbols)."""
    rows, size = counts[0].shape
    out, escape, excluded = np.zeros((rows, size)), np.zeros((rows, 1)), np.zeros((rows, size), bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for count in counts:
            left = np.where(excluded, 0.0, count)
            total, kinds = left.sum(1, keepdims=True), (left > 0).sum(1, keepdims=True)
            coded = left > 0
            out = np.where(coded, escape - np.log2(left / (total + kinds)), out)
            escape = np.where(kinds > 0, escape - np.log2(kinds / (total + kinds)), escape)
            excluded |= coded
    out = np.where(excluded, out, escape + np.log2(np.maximum(1, 256 - excluded.sum(1, keepdims=True))))
    out[:, 0] = 0  # nothing is coded at the start of a text
    return out


def code_lengths(model: Model, column: pa.Array) -> np.ndarray:
    """Exact code length in bits of each text (rows) in each language (columns), in blocks of the bytes."""
    data, starts = _padded(column)
    symbol = model.symbol.astype(np.int32)
    symbol[0] = 0
    size = model.bits.shape[1]
    flat = model.bits.reshape(-1, len(model.languages))
    begins = starts - ORDER  # a symbol is counted where its context begins
    out = np.zeros((len(starts), len(model.languages)))
    for a, b in blocks(len(data) - ORDER, LOOKED_UP):
        part = symbol[data[a:b + ORDER]]
        context = (part[:-3] * size + part[1:-2]) * size + part[2:-1]
        cost = flat[model.row[context].astype(np.int64) * size + part[3:]]
        first, last = np.searchsorted(begins, a, side="right") - 1, np.searchsorted(begins, b)
        out[first:last] += np.add.reduceat(cost, np.maximum(begins[first:last] - a, 0), axis=0, dtype=np.float64)
    return out


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the columns ``keep``, ``lang_pred``, ``score``, ``bits_per_byte``.

    ``score`` is the probability of the language, if all are equally likely before. A text that
    is null or has no letter is ``und`` with score 0 and no code length; so is every text if the
    model knows no language. Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.symbol, model.row, model.bits))
    kept = list(keep)
    sent = text_col in kept  # a text that is kept is not sent twice
    at = kept.index(text_col) if sent else len(kept)

    def judged(texts, model, names):
        known = np.array(pc.fill_null(pc.match_substring_regex(texts, LETTER), False).to_pylist(), bool)
        best, score, per_byte = np.full(len(texts), len(names) - 1), np.zeros(len(texts)), np.full(len(texts), np.nan)
        if len(texts) and model.languages:
            length = code_lengths(model, texts)
            odds = np.exp2(length.min(1, keepdims=True) - length)
            size = np.maximum(np.diff(utf8(texts)[1]), 1)
            best = np.where(known, length.argmin(1), best)
            score = np.where(known, (odds / odds.sum(1, keepdims=True)).max(1), 0.0)
            per_byte = np.where(known, length.min(1) / size, np.nan)
        return [pa.array(names[best], pa.string()), pa.array(score), pa.array(per_byte, mask=np.isnan(per_byte))]

    def run(batches):
        model = Model(*shared.value)
        names = np.array([*model.languages, UNKNOWN], object)
        for whole in batches:
            for batch in in_pieces(whole, at, AT_ONCE):
                columns = [c for i, c in enumerate(batch.columns) if sent or i != at]
                yield pa.RecordBatch.from_arrays([*columns, *judged(batch.column(at), model, names)],
                                                 names=[*kept, "lang_pred", "score", "bits_per_byte"])

    chosen = docs.select(*kept, *([] if sent else [F.col(text_col).alias(unused(docs, "__text"))]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:len(kept)])
    return chosen.mapInArrow(run, f"{fields}, lang_pred string, score double, bits_per_byte double")


def keep_known(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (``columns``) without those that are in no language: ``und``, or best described by no model.

    The second kind takes more bits in every language than its bytes have.
    """
    found = predict(docs, learn(docs), keep=tuple(columns))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < 8)).select(*columns)
