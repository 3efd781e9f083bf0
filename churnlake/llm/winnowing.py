"""Document fingerprints by winnowing. DataFrame functions only.

A text is cut into units at blanks and line feeds. Each character of a script written without blanks is a unit
of its own, and so is each character of a word of more than 64, so that units never depend on what else is in
the text or where a run starts. A polynomial hash runs over every K consecutive units, and of every W consecutive hashes the least
is kept, the rightmost of equal ones, with its position. Two texts that share W + K - 1
consecutive units therefore share a fingerprint, and nothing shorter than K units counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import stage

K, W = 4, 8
LONGEST = 64
#: Thai, Lao, Burmese, Khmer, kana, Han.
UNSPACED = "([\\u0e00-\\u0eff\\u1000-\\u109f\\u1780-\\u17ff\\u3040-\\u30ff\\u3400-\\u4dbf\\u4e00-\\u9fff\\uf900-\\ufaff\\x{20000}-\\x{3ffff}])"
#: Characters of the text that order equal ids.
PREFIX = 32
MASK = (1 << 32) - 1
#: Factors of the polynomial, by one and by two units. Below 2**31, so that products with 32-bit hashes stay below 2**63.
FACTOR_1, FACTOR_2 = 1_566_083_941, 1_812_433_253
POSITION_BITS = 31
LAST = (1 << POSITION_BITS) - 1


def with_winnow(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the kept (hash, position) of column ``text`` in order, packed as hash * 2**31 + (2**31 - 1 - position).

    Positions count units from 0. A text of fewer than K units has one hash over all of them; one of
    no unit has none. A null text counts as empty. The steps are columns of their own, so that none is computed twice.
    """
    df = df.withColumn("__u", _units(F.coalesce(F.col(text), F.lit(""))))
    letters = F.flatten(F.transform("__u", lambda u: F.when(F.length(u) > LONGEST, F.split(u, "")).otherwise(F.array(u))))
    cut = F.when(F.exists("__u", lambda u: F.length(u) > LONGEST), letters).otherwise(F.col("__u"))
    df = df.withColumn("__h", F.transform(cut, lambda u: F.xxhash64(u).bitwiseAND(MASK)))
    h, g, m = F.col("__h"), F.col("__g"), F.col("__m")
    empty = F.array().cast("array<bigint>")
    df = df.withColumn("__g", F.when(F.size(h) >= K, _neighbours(h, 1, lambda a, b: (a * FACTOR_1 + b).bitwiseAND(MASK))).otherwise(empty))
    packed = F.transform(F.slice(g, 1, F.size(g) - 2), lambda a, i: _packed((a * FACTOR_2 + g[i + 2]).bitwiseAND(MASK), i))
    whole = F.when(F.size(h) > 0, F.array(_packed(F.xxhash64(h).bitwiseAND(MASK), F.lit(0)))).otherwise(empty)
    df = df.withColumn("__m", F.when(F.size(g) > 0, packed).otherwise(whole))
    for step in (1, 2, 4):  # least of 2, 4, 8 neighbours, as far as there are so many
        wider = _neighbours(m, step, lambda a, b: F.least(a, b))
        df = df.withColumn("__m", F.when(F.size(m) > step, wider).otherwise(m))
    # of fewer than W hashes, some minima are not of all: the least of them is
    few = F.size(g).between(1, W + 1)
    return df.withColumn(out, F.when(few, F.array(F.array_min(m))).otherwise(F.array_distinct(m))).drop("__u", "__h", "__g", "__m")


def _units(text: Column) -> Column:
    spaced = F.when(F.octet_length(text) > F.length(text), F.regexp_replace(text, UNSPACED, " $1 ")).otherwise(text)
    return F.array_remove(F.split(F.replace(spaced, F.lit("\n"), F.lit(" ")), " "), "")


def _packed(value: Column, position: Column) -> Column:
    return value * (1 << POSITION_BITS) + (LAST - position)


def _neighbours(values: Column, by: int, combine) -> Column:
    """``combine(x[i], x[i + by])`` for all i where both exist. ``values`` has more than ``by`` elements."""
    return F.zip_with(F.slice(values, 1, F.size(values) - by), F.slice(values, by + 1, F.size(values) - by), combine)


def hashes(kept: Column) -> Column:
    return F.transform(kept, lambda x: F.shiftright(x, POSITION_BITS))


def positions(kept: Column) -> Column:
    return F.transform(kept, lambda x: F.lit((1 << POSITION_BITS) - 1) - x.bitwiseAND((1 << POSITION_BITS) - 1))


def compact(kept: Column) -> Column:
    """The hashes as 32-bit integers, less 2**31."""
    return F.transform(kept, lambda x: (F.shiftright(x, POSITION_BITS) - (1 << 31)).cast("int"))


def as_text(compact_hashes: Column) -> Column:
    """Hashes as eight hexadecimal digits each, in order, comma-joined."""
    return F.array_join(F.transform(compact_hashes, lambda h: F.lower(F.lpad(F.hex(h.cast("long") + (1 << 31)), 8, "0"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Share of common values among all distinct values of two arrays of hashes; 1 if both are empty."""
    both, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(both / union)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``hashes`` and ``positions`` (arrays of long)."""
    found = with_winnow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "kept")
    return found.select(F.col("id").alias(id_col), hashes(F.col("kept")).alias("hashes"), positions(F.col("kept")).alias("positions"))


def with_next(docs: DataFrame, columns: list[str], prepare=lambda df: df, per_chunk: int = 1 << 20) -> DataFrame:
    """``prepare`` applied to ``docs`` (id, text and others), and ``next_c`` for each of ``columns``: the values of the next row by falling id.

    After the last row comes the first. Equal ids go by text, null ids come last. Rows are dealt by range of (id, text) to
    chunks of about ``per_chunk`` and stored with the number of their chunk; only the first row of each chunk moves on,
    to the chunk before. Rows that agree in id and text share a chunk.
    """
    chunks = max(1, docs.count() // per_chunk)
    dealt = docs.repartitionByRange(chunks, F.desc_nulls_last("id"), F.asc_nulls_first("text")).withColumn("chunk", F.spark_partition_id())
    dealt = stage(dealt, "dealt")
    heads = dealt.groupBy("chunk").agg(F.max("id").alias("head"))
    around = Window.orderBy("chunk")  # a row per chunk
    last = F.max("chunk").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.col("chunk").alias("of"), "head", F.coalesce(F.lag("chunk").over(around), last).alias("to"))
    first = dealt.join(heads, (F.col("chunk") == F.col("of")) & F.col("id").eqNullSafe(F.col("head")))
    others = [c for c in docs.columns if c not in ("id", "text")]
    first = first.groupBy("to", "id").agg(F.min(F.struct("text", *others)).alias("first"))
    guests = stage(first.select("id", "first.text", *[f"first.{c}" for c in others], F.col("to").alias("chunk")), "guests")
    both = prepare(dealt.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True))))
    order = Window.partitionBy("chunk").orderBy("guest", F.desc_nulls_last("id"), F.asc_nulls_first("text"))
    nexts = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return both.withColumns(nexts).where("not guest").drop("guest", "chunk")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likenesses.

    In the edited text the last floor(n / 2) of the n code points are replaced by the first as many of the next
    document by falling id. A null text counts as empty; two texts without any unit are alike (1.0). A single
    document is its own next. Rows that repeat an id keep their rows and follow one another by the first PREFIX
    characters of their texts, then by hash; null ids come last. Other columns are ignored.

    Which row follows which is found on ids and 128-bit hashes alone. Texts move once, by these, and half as much again
    goes to the row before; equal rows move once and follow one another.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digits = [F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text")))]
    rows = rows.withColumn("row", F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), *digits))
    prefix = F.concat(F.substring("text", 1, PREFIX), F.lit("\0"), *digits)  # orders rows of one id
    keys = rows.select("id", "row", prefix.alias("text"), F.length("text").cast("long").alias("n_chars"))
    keys = stage(keys.groupBy("id", "text", "row", "n_chars").agg(F.count("*").alias("copies")), "keys")
    pairs = stage(with_next(keys, ["row"]).drop("text"), "pairs")
    texts = with_winnow(rows.select("row", "text"), "text", "kept").withColumn("fp", compact(F.col("kept")))
    texts = texts.groupBy("row").agg(F.any_value(F.struct("text", "fp")).alias("own"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    guests = texts.withColumnRenamed("row", "next_row").join(pairs, "next_row").select(
        F.col("row").alias("to"), "id", "n_chars", "copies", _following(half, "own").alias("next"))
    met = texts.join(guests, F.col("row") == F.col("to"))
    later = F.struct("next", F.lit(1).cast("long").alias("times"))
    again = F.struct(_following(half, "own").alias("next"), (F.col("copies") - 1).alias("times"))
    met = met.withColumn("step", F.explode(F.when(F.col("copies") > 1, F.array(later, again)).otherwise(F.array(later))))
    text, after = F.col("own.text"), F.col("step.next")
    edited = F.concat(F.substring(text, F.lit(1), F.col("n_chars").cast("int") - half), after["text"])
    met = met.select("id", "n_chars", F.col("own.fp").alias("fp"), edited.alias("edited"), after["fp"].alias("next_fp"), F.col("step.times").alias("times"))
    met = with_winnow(met, "edited", "kept").withColumn("edited_fp", compact(F.col("kept")))
    found = met.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "times")
    return found.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times", "time")


def _following(half: Column, own: str) -> Column:
    """What the row before needs of a row: as many characters as it loses, and the fingerprint."""
    return F.struct(F.substring(F.col(f"{own}.text"), F.lit(1), half).alias("text"), F.col(f"{own}.fp").alias("fp"))
