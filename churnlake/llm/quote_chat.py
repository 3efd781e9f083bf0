"""Reply-ordered conversations from quotations.

Lines that begin with ``>`` marks are quoted, one level per mark. Runs of lines of one level, and
their single lines, are normalised and hashed; so are the own words of every message, whole, by
paragraph and by line. A quoted passage belongs to the earliest message of the conversation whose own
words hold it, and a message replies to the message its quotes of the lowest level belong to.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import is_empty, running_start
from churnlake.session import stage

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
#: The line that mail programs put before a quotation.
ATTRIBUTION = re.compile(r"(?:On|Am|Le|El) .{1,200}(?:wrote|schrieb.{0,80}|a écrit|escribió) ?:\s*")
PASSAGES = pa.list_(pa.struct([("level", pa.int32()), ("h", pa.int64()), ("size", pa.int32())]))


def levels(text: str) -> list[tuple[int, str]]:
    """(level, content) of each line; level 0 is own words."""
    out = []
    for line in text.split("\n"):
        m = MARKS.match(line)
        out.append((m.group(1).count(">"), line[m.end():]) if m else (0, line))
    return out


def _normal(text: str) -> str:
    return " ".join(text.lower().split())


def parsed(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """Own words, without quotes and attributions, and normalised passages with their level (0: own)."""
    lines = levels(text or "")
    kept = [(n, c) for i, (n, c) in enumerate(lines)
            if not (n == 0 and ATTRIBUTION.fullmatch(c) and i + 1 < len(lines) and lines[i + 1][0] > 0)]
    runs: list[tuple[int, list[str]]] = []
    for level, content in kept:
        if runs and runs[-1][0] == level:
            runs[-1][1].append(content)
        else:
            runs.append((level, [content]))
    own = "\n".join(c for n, c in kept if n == 0)
    own = re.sub(r"\n{3,}", "\n\n", own).strip("\n")
    passages = {(0, _normal(own))}
    for level, contents in runs:
        passages |= {(level, _normal(c)) for c in contents}
        passages |= {(level, _normal(p)) for p in re.split(r"\n[ \t]*\n", "\n".join(contents))}
        passages.add((level, _normal("\n".join(contents))))
    return own, sorted(p for p in passages if p[1])


def _parse(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [parsed(t) for t in batch.column("text").to_pylist()]
            passages = [[{"level": n, "h": xxhash.xxh3_64_intdigest(p) - (1 << 63), "size": len(p)} for n, p in x] for _, x in found]
            keep = [batch.column(c) for c in ("conv", "turn", "role", "tie")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array([o for o, _ in found], pa.string()), pa.array(passages, PASSAGES)],
                                             names=["conv", "turn", "role", "tie", "own", "passages"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "turn")}
    return rows.mapInArrow(run, f"conv {kinds['conv']}, turn {kinds['turn']}, role string, tie long, own string, "
                                "passages array<struct<level: int, h: bigint, size: int>>")


def links(messages: DataFrame) -> DataFrame:
    """(conv, rank, parent, linked) of the ``messages`` (conv, rank, passages) that quote an earlier one.

    Each passage keeps its earliest message only, so a line that very many messages share costs one row of each.
    """
    passages = messages.select("conv", "rank", F.explode("passages").alias("p")).select("conv", "rank", "p.*")
    first = passages.where("level = 0").groupBy(F.col("conv").alias("c"), F.col("h").alias("g")).agg(F.min("rank").alias("origin"))
    quotes = passages.where("level > 0")
    found = quotes.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("h") == F.col("g")) & (F.col("origin") < F.col("rank")))
    best = F.max(F.struct((-F.col("level")).alias("near"), "size", F.col("origin").alias("parent")))
    return found.groupBy("conv", "rank").agg(best.alias("b"), F.count("*").alias("linked")).select("conv", "rank", "b.parent", "linked")


def preorder(tree: DataFrame) -> DataFrame:
    """(conv, rank, root, after, depth): depth-first order of the threads of ``tree`` (conv, rank, parent).

    Every node is entered and left once; the events of a thread form a list, which is ranked by pointer
    doubling, so a thread of n messages takes log2(n) joins and no thread meets in one task. ``after`` counts the
    messages from this one to the end of its thread.
    """
    one = F.lit(1).cast("long")
    placed = stage(running_start(tree.withColumn("one", one), ["conv", "parent"], ["rank"], "one", "sibling").drop("one"), "siblings")
    nodes = placed.select("conv", "rank").union(placed.select("conv", "parent")).distinct()
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    child = placed.where("sibling = 0").select(F.col("conv").alias("c1"), F.col("parent").alias("p1"), F.col("rank").alias("child"))
    own = placed.select(F.col("conv").alias("c2"), F.col("rank").alias("r2"), "parent", "sibling")
    right = placed.select(F.col("conv").alias("c3"), F.col("parent").alias("p3"), F.col("sibling").alias("s3"), F.col("rank").alias("right"))
    full = (nodes.join(child, same("conv", "c1") & (F.col("rank") == F.col("p1")), "left")
            .join(own, same("conv", "c2") & (F.col("rank") == F.col("r2")), "left")
            .join(right, same("conv", "c3") & (F.col("parent") == F.col("p3")) & (F.col("sibling") + 1 == F.col("s3")), "left"))
    down, up = F.lit(0), F.lit(1)
    event = lambda kind, rank: F.struct(rank.alias("rank"), kind.alias("kind"))
    enter = F.when(F.col("child").isNotNull(), event(down, F.col("child"))).otherwise(event(up, F.col("rank")))
    leave = F.when(F.col("right").isNotNull(), event(down, F.col("right"))).when(
        F.col("parent").isNotNull(), event(up, F.col("parent")))
    none = F.lit(None).cast("long")
    now = stage(full.select("conv", event(down, F.col("rank")).alias("at"), enter.alias("next"), F.lit(1).cast("long").alias("after"),
                            F.lit(1).cast("long").alias("open"), none.alias("root"))
                .union(full.select("conv", event(up, F.col("rank")), leave, F.lit(0).cast("long"), F.lit(-1).cast("long"),
                                   F.when(F.col("parent").isNull(), F.col("rank")))), "events")
    while not is_empty(now.where("next is not null")):
        ahead = now.select(F.col("conv").alias("c"), F.col("at").alias("n"), F.col("next").alias("next2"), F.col("after").alias("after2"),
                           F.col("open").alias("open2"), F.col("root").alias("root2"))
        now = stage(now.join(ahead, same("conv", "c") & (F.col("next") == F.col("n")), "left").select(
            "conv", "at", F.col("next2").alias("next"), (F.col("after") + F.coalesce("after2", F.lit(0))).alias("after"),
            (F.col("open") + F.coalesce("open2", F.lit(0))).alias("open"), F.coalesce("root", "root2").alias("root")), "events")
    return now.where("at.kind = 0").select("conv", "at.rank", "root", "after", (-F.col("open")).alias("depth"))


def reply_ordered(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """Per message: conversation, turn, role, position (from 0), reply_to, depth, n_quotes, n_linked, text.

    ``position`` orders a conversation by threads: a thread begins where its first message stands, every
    reply follows the message it answers, and replies to one message go by turn. Messages without a quote
    that is found begin a thread; ``reply_to``, a turn, is null for them. ``text`` has the own words only.
    A null text has none and quotes nothing. Null conversations form one conversation; a null turn comes first.
    Rows of equal turn go by role and text, and rows equal in all stay, next to each other. Other columns are ignored.
    """
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                           F.xxhash64(role_col, text_col).alias("tie"), F.col(text_col).cast("string").alias("text"))
    one = F.lit(1).cast("long")
    parsed_rows = stage(_parse(rows), "parsed")  # dealing by range reads its input twice
    found = running_start(parsed_rows.withColumn("one", one), ["conv"], ["turn", "tie"], "one", "rank").drop("one")
    found = stage(found, "messages")
    linked = stage(links(found), "links")
    quotes = F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long")
    out = found.select("conv", "turn", "role", "rank", "own", quotes.alias("n_quotes"))
    if is_empty(linked):
        out = out.withColumns({"parent": F.lit(None).cast("long"), "linked": F.lit(0).cast("long"), "root": F.col("rank"),
                               "after": F.lit(0).cast("long"), "depth": F.lit(0).cast("long")})
    else:
        order = preorder(linked.select("conv", "rank", "parent")).withColumnsRenamed({"conv": "c2", "rank": "r2"})
        links_ = linked.withColumnsRenamed({"conv": "c1", "rank": "r1"})
        out = (out.join(links_, F.col("conv").eqNullSafe(F.col("c1")) & (F.col("rank") == F.col("r1")), "left")
               .join(order, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("rank") == F.col("r2")), "left")
               .withColumns({"root": F.coalesce("root", "rank"), "linked": F.coalesce("linked", F.lit(0)),
                             "after": F.coalesce("after", F.lit(0)), "depth": F.coalesce("depth", F.lit(0))})
               .drop("c1", "r1", "c2", "r2"))
    out = out.withColumns({"one": one, "before": -F.col("after")})
    out = running_start(out, ["conv"], ["root", "before", "rank"], "one", "position")
    parents = found.select(F.col("conv").alias("c4"), F.col("rank").alias("r4"), F.col("turn").alias("reply_to"))
    out = out.join(parents, F.col("conv").eqNullSafe(F.col("c4")) & (F.col("parent") == F.col("r4")), "left")
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "position", "reply_to",
                      "depth", "n_quotes", F.col("linked").alias("n_linked"), F.col("own").alias(text_col))
