"""Global order without single-task windows: tiles, ranks, lags, running totals, quantiles.

Ranks, lags, running totals and quantiles deal the rows by range of the whole sort position - null
flag, key and tie-breaking id, so that ties cannot make a hot range - and store them with the number
of their range; sums or last rows per range then carry over from one range to the next. Tiles need
only the positions that end them, which are searched for in a few counting passes: that input is
read several times, so it must give the same rows each time, as a stored table does.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from churnlake.session import attach, stage

ROWS_PER_BUCKET = 1_000_000
SELECT_SAMPLE = 200_000


@dataclass(frozen=True)
class By:
    """A sort key. By default NULLs come last ascending and first descending."""

    column: str
    descending: bool = False
    nulls_first: bool | None = None


class Position:
    """Sort position of a row: fields without NULL or NaN, all compared ascending.

    Descending keys must be numeric: they are negated. With ``group`` the group comes first.
    """

    def __init__(self, df: DataFrame, by: By | list[By], tie: str | None = None, group: str | None = None):
        self.fields: dict[str, Column] = {}
        if group is not None:
            self.fields["group_known"] = F.col(group).isNotNull()
            self.fields["group_key"] = F.coalesce(F.col(group), _filler(df, group))
        for i, one in enumerate([by] if isinstance(by, By) else by):
            key = F.col(one.column)
            first = one.descending if one.nulls_first is None else one.nulls_first
            place = F.when(key.isNull(), F.lit(-2 if first else 2))
            if isinstance(df.schema[one.column].dataType, (T.DoubleType, T.FloatType)):
                place = place.when(F.isnan(key), F.lit(-1 if one.descending else 1))
                key = F.when(~F.isnan(key), key)
            plain = F.coalesce(key, _filler(df, one.column))
            self.fields[f"place_{i}"] = place.otherwise(F.lit(0))
            self.fields[f"key_{i}"] = -plain if one.descending else plain
        if tie is not None:
            self.fields["tie"] = F.coalesce(F.col(tie), _filler(df, tie))
        self.struct = F.struct(*[c.alias(n) for n, c in self.fields.items()])
        self.kind = df.select(self.struct.alias("p")).schema["p"].dataType
        self.in_group = [n for n in self.fields if not n.startswith("group_")]

    def after(self, bound: str) -> Column:
        """Whether the row comes after a position given as JSON: plain comparisons, no struct."""
        limit = F.from_json(F.lit(bound), self.kind)
        later = F.lit(False)
        for name in reversed(self.fields):
            later = (self.fields[name] > limit[name]) | ((self.fields[name] == limit[name]) & later)
        return later

    def within(self, low: str | None, high: str | None) -> Column:
        """Whether low < position <= high; None is no limit."""
        inside = F.lit(True) if low is None else self.after(low)
        return inside if high is None else inside & ~self.after(high)


def _filler(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return F.lit(0 if isinstance(kind, T.NumericType) else "").cast(kind)


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Rank of the last row of every tile but the last, by the NTILE rule."""
    base, extra = divmod(rows, tiles)
    return [t * base + min(t, extra) for t in range(1, tiles)]


@dataclass
class Bracket:
    """Where a wanted rank lies: rows with low < position <= high, ``before`` rows precede them."""

    rank: int
    inside: int
    before: int = 0
    low: str | None = None
    high: str | None = None


def _bracketed(df: DataFrame, pos: Position, brackets: list[tuple]) -> DataFrame:
    """Rows with the number of every bracket (low, high) they lie in."""
    if brackets == [(None, None)]:
        return df.select(F.lit(0).alias("b"), pos.struct.alias("p"))
    numbers = F.array_compact(F.array(*[
        F.when(pos.within(low, high), F.lit(i)) for i, (low, high) in enumerate(brackets)]))
    return df.select(F.explode(numbers).alias("b"), pos.struct.alias("p"))


def rows_at(df: DataFrame, positions: dict[str, Position], ranks: list[int], rows: int,
            limit: int = ROWS_PER_BUCKET, sample: int = SELECT_SAMPLE) -> dict[str, dict[int, str]]:
    """For each ordering the positions (JSON) at the given 1-based ranks, without sorting the rows.

    A sample narrows every rank down to a bracket of about one percent, one counting pass
    tells what precedes it and what it holds. Repeated until a bracket is small enough to
    be sorted by one task. A sample that misses costs another round, never the result.
    """
    found = {n: [Bracket(r, rows) for r in sorted(set(ranks))] for n in positions}
    while any(b.inside > limit for bs in found.values() for b in bs):
        before = sum(b.inside for bs in found.values() for b in bs)
        guesses = None
        for name, pos in positions.items():
            open_ = [b for b in found[name] if b.inside > limit]
            spans = list(dict.fromkeys((b.low, b.high) for b in open_))
            if not spans:
                continue
            share, picks = min(1.0, sample / max(b.inside for b in open_)), []
            for i, span in enumerate(spans):
                mine = [b for b in open_ if (b.low, b.high) == span]
                for b in mine:
                    q = (b.rank - b.before) / b.inside
                    middle, width = F.col("m") * q, F.sqrt(F.col("m") * (4 * math.sqrt(q * (1 - q))) ** 2) + 2
                    picks.append(F.when(F.col("b") == i, F.struct(
                        F.lit(b.rank).cast("long").alias("rank"),
                        F.when(middle > width, F.to_json(F.get("s", F.floor(middle - width).cast("int")))).alias("low"),
                        F.to_json(F.get("s", F.ceil(middle + width).cast("int"))).alias("high"))))
            sampled = _bracketed(df.sample(share, 42), pos, spans).groupBy("b").agg(
                F.array_sort(F.collect_list("p")).alias("s"))
            one = sampled.withColumn("m", F.size("s")).select(F.inline(F.array_compact(F.array(*picks)))).select(
                F.lit(name).alias("ordering"), "rank", "low", "high")
            guesses = one if guesses is None else guesses.unionByName(one)
        guess = {(g["ordering"], g["rank"]): (g["low"], g["high"]) for g in guesses.collect()}
        cells, counts = [], []
        for name, pos in positions.items():
            for b in found[name]:
                if b.inside > limit:
                    low, high = guess.get((name, b.rank), (None, None))
                    low, high = low or b.low, high or b.high
                    cells.append((b, low, high))
                    for inside in ((F.lit(False) if low == b.low else pos.within(b.low, low)), pos.within(low, high)):
                        counts.append(F.count_if(inside).alias(f"c{len(counts)}"))
        counted = df.agg(*counts).first()
        for i, (b, low, high) in enumerate(cells):
            front, middle, local = counted[2 * i], counted[2 * i + 1], b.rank - b.before
            if local <= front:
                b.high, b.inside = low, front
            elif local <= front + middle:
                b.low, b.high, b.inside, b.before = low, high, middle, b.before + front
            else:
                b.low, b.inside, b.before = high, b.inside - front - middle, b.before + front + middle
        if sum(b.inside for bs in found.values() for b in bs) >= before:
            break                              # many equal positions: the brackets cannot shrink further
    hits = None
    for name, pos in positions.items():
        spans = list(dict.fromkeys((b.low, b.high) for b in found[name]))
        order = Window.partitionBy("b").orderBy(*[f"p.{f}" for f in pos.fields])
        rank = F.lit(None).cast("long")
        for b in found[name]:
            here = (F.col("b") == spans.index((b.low, b.high))) & (F.col("rn") == b.rank - b.before)
            rank = F.when(here, F.lit(b.rank).cast("long")).otherwise(rank)
        one = (_bracketed(df, pos, spans).withColumn("rn", F.row_number().over(order)).withColumn("rank", rank)
               .filter(F.col("rank").isNotNull())
               .select(F.lit(name).alias("ordering"), "rank", F.to_json("p").alias("p")))
        hits = one if hits is None else hits.unionByName(one)
    result: dict[str, dict[int, str]] = {n: {} for n in positions}
    for r in hits.collect():
        result[r["ordering"]][r["rank"]] = r["p"]
    return result


def ntile_global(df: DataFrame, orderings: dict[str, By], tie: str, tiles: int = 5,
                 rows_per_bucket: int = ROWS_PER_BUCKET, rows: int | None = None) -> DataFrame:
    """Add one NTILE column per ordering over the whole table; ``tie`` is unique.

    A tile is decided by the few positions that end the tiles, so once those are found the
    rows are tiled where they lie: no row is shuffled.
    """
    rows = df.count() if rows is None else rows
    positions = {n: Position(df, by, tie) for n, by in orderings.items()}
    ranks = sorted({r for r in tile_ends(rows, tiles) if r > 0})
    ends = rows_at(df, positions, ranks, rows, rows_per_bucket) if ranks else {n: {} for n in positions}
    all_ends = tile_ends(rows, tiles)
    columns = {}
    for name, pos in positions.items():
        tile = F.lit(tiles if rows >= tiles else max(rows, 1))
        for number in range(len(all_ends), 0, -1):
            if all_ends[number - 1] > 0:
                tile = F.when(pos.after(ends[name][all_ends[number - 1]]), tile).otherwise(F.lit(number))
        columns[name] = tile.cast("int")
    return df.withColumns(columns)


def in_ranges(df: DataFrame, pos: Position, rows_per_bucket: int, rows: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` with its position ``__p`` and the number ``__range`` of the range of positions the row lies in;
    and whether there are several ranges.

    A table of up to ``rows_per_bucket`` rows is one range. A larger one is dealt by range and stored with the numbers;
    Spark draws the limits from a sample, and they decide who works on what, never a result. Ranges are numbered in
    order of position, some numbers may be missing, and equal positions share a range.
    """
    placed = df.withColumn("__p", pos.struct)
    rows = df.count() if rows is None else rows
    if rows <= rows_per_bucket:
        return placed.withColumn("__range", F.lit(0)), False
    ranges = max(math.ceil(rows / rows_per_bucket), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.repartitionByRange(ranges, *[F.col("__p")[f] for f in pos.fields])
    return stage(dealt.withColumn("__range", F.spark_partition_id()), "ranges"), True


def _by_range(group: str | None) -> Window:
    """Ranges of a group in order: as many rows as there are ranges and groups."""
    return Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy("__range")


def row_rank(df: DataFrame, by: By | list[By], tie: str, group: str | None = None, name: str = "rank",
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add the exact 1-based position of every row, in the table or within ``group``."""
    pos = Position(df, by, tie, group)
    ranged, several = in_ranges(df, pos, rows_per_bucket)
    keys = ([group] if group else []) + ["__range"]
    order = Window.partitionBy(*keys).orderBy(*[f"__p.{f}" for f in pos.in_group])
    ranked = ranged.withColumn(name, F.row_number().over(order).cast("long"))
    if several:
        sizes = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        before = _by_range(group).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
        ranked = attach(ranked, offsets, keys).withColumn(name, F.col(name) + F.col("__before")).drop("__before")
    return ranked.drop("__p", "__range")


def lag_in_group(df: DataFrame, group: str, by: By, tie: str, columns: dict[str, str],
                 rows_per_bucket: int = ROWS_PER_BUCKET, rows: int | None = None) -> DataFrame:
    """Add ``LAG(column)`` within ``group`` by (key, tie) for every new-name/column pair.

    Groups may be huge: the window runs per group and range, and the first row of a range takes its value
    from the last row of the group's range before, one row per group and range.
    """
    pos = Position(df, by, tie, group)
    ranged, several = in_ranges(df, pos, rows_per_bucket, rows)
    values = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    order = Window.partitionBy(group, "__range").orderBy(*[f"__p.{f}" for f in pos.in_group])
    lagged = ranged.withColumn("__prev", F.lag(values).over(order))
    if several:
        last = ranged.groupBy(group, "__range").agg(F.max_by(values, "__p").alias("__last"))
        carried = last.select(group, "__range", F.lag("__last").over(_by_range(group)).alias("__carry"))
        lagged = attach(lagged, carried, [group, "__range"]).withColumn(
            "__prev", F.when(F.col("__prev").isNotNull(), F.col("__prev")).otherwise(F.col("__carry"))).drop("__carry")
    return lagged.withColumns({n: F.col("__prev")[n] for n in columns}).drop("__p", "__range", "__prev")


def running_totals(df: DataFrame, by: By, sums: dict[str, str], rows_per_bucket: int = ROWS_PER_BUCKET,
                   group: str | None = None, rows: int | None = None) -> DataFrame:
    """Add inclusive running sums in key order, over the table or within ``group``; keys are unique in it."""
    pos = Position(df, by, group=group)
    ranged, several = in_ranges(df, pos, rows_per_bucket, rows)
    keys = ([group] if group else []) + ["__range"]
    order = (Window.partitionBy(*keys).orderBy(*[f"__p.{f}" for f in pos.in_group])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    added = ranged.withColumns({n: F.sum(c).over(order) for n, c in sums.items()})
    if several:
        totals = ranged.groupBy(*keys).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
        before = _by_range(group).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(*keys, *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in sums])
        added = attach(added, offsets, keys).withColumns({n: F.col(n) + F.col(f"__b_{n}") for n in sums})
    return added.drop("__p", "__range", *[f"__b_{n}" for n in sums])


def quantiles_by(df: DataFrame, group: str, column: str, probabilities: list[float],
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact quantiles per group, linear interpolation: ``group`` and ``q0``, ``q1``, ... as probabilities are given.

    Equal values of a group are counted first (partial sums on the map side), so a value that fills a third of
    the table is one row from then on. One table of counts answers all groups and probabilities. NULL and NaN
    are left out; a group without other values has no row.
    """
    value = F.col(column).cast("double")
    counts = stage(df.select(F.col(group), value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
                   .groupBy(group, "v").agg(F.count(F.lit(1)).alias("n")), "counts")
    upto = running_totals(counts, By("v"), {"upto": "n"}, rows_per_bucket, group)
    sized = upto.join(counts.groupBy(F.col(group).alias("__of")).agg(F.sum("n").alias("total")), F.col(group).eqNullSafe(F.col("__of")))

    def at(rank: Column) -> Column:
        """The value at a 0-based rank."""
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("v")))

    spots = [(F.col("total") - 1) * F.lit(float(p)) for p in probabilities]
    ends = sized.groupBy(group).agg(F.max("total").alias("total"), *[
        at(f(spot)).alias(f"{n}{i}") for i, spot in enumerate(spots) for n, f in (("low", F.floor), ("high", F.ceil))])
    return ends.select(group, *[
        (F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * (spot - F.floor(spot))).alias(f"q{i}")
        for i, spot in enumerate(spots)])


def quantiles(df: DataFrame, column: str, probabilities: list[float],
              rows_per_bucket: int = ROWS_PER_BUCKET) -> list[float | None]:
    """``quantiles_by`` of the whole table; None where there is no value."""
    row = quantiles_by(df.withColumn("__all", F.lit(0)), "__all", column, probabilities, rows_per_bucket).first()
    return [None] * len(probabilities) if row is None else list(row)[1:]
