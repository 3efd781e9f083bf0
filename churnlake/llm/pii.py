"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import in_pieces

#: Order in which spans are listed; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: At most 34 letters and digits; which prefix of them is the number, ``_iban_end`` decides.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: Letters and digits of an IBAN by country.
IBAN_LENGTH = {k: int(n) for k, n in (x.split(":") for x in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BI:27 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DJ:27 DK:18 DO:28 EE:20 EG:29 "
    "ES:24 FI:18 FK:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HN:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 "
    "LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MN:20 MR:27 MT:31 MU:30 NI:28 NL:18 NO:15 OM:23 PK:24 PL:28 PS:29 "
    "PT:25 QA:29 RO:24 RS:22 RU:33 SA:24 SC:31 SD:18 SE:24 SI:19 SK:24 SM:27 SO:23 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20 "
    "YE:30").split())}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_/+=-]{20,}+")

#: Words that raise or lower the score of a span of the kind, looked for within CONTEXT characters.
CONTEXT = 48
NEAR = {
    "iban": re.compile(r"(?i)\b(?:iban|account|konto|compte|cuenta|bank)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security|tax id|taxpayer)\b"),
    "secret": re.compile(r"(?i)\b(?:api[_ -]?key|secret|token|password|passwd|pwd|bearer|private[_ -]?key)\b"),
}
AGAINST = re.compile(r"(?i)\b(?:example|isbn|sku|order|invoice|version|sha|commit|checksum)\b")
BASE_SCORE = {"email": 1.0, "ip": 1.0, "card": 1.0, "phone": 1.0, "iban": 0.8, "ssn": 0.4, "secret": 0.3}
THRESHOLD = 0.6


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    number = "".join(str(int(c, 36)) for c in iban[4:] + iban[:4])
    return int(number) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` is tried once with all local characters before it, so long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if 13 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                yield "phone", *m.span()


def _iban_end(text: str, m: re.Match) -> int | None:
    """End of the longest prefix of the candidate that ends at a word boundary, has its country's length and passes mod 97.

    Of a country without a known length, any prefix of 15 characters or more will do.
    """
    ends = [i + 1 for i in range(m.start(), m.end()) if text[i] != " "]
    wanted = IBAN_LENGTH.get(m.group()[:2])
    for n in range(len(ends), 14, -1):
        after = text[ends[n - 1]:ends[n - 1] + 1]
        if n == (wanted or n) and not (after.isascii() and after.isalnum()) and mod97(text[m.start():ends[n - 1]].replace(" ", "")):
            return ends[n - 1]
    return None


def _more(text: str) -> Iterator[tuple[str, int, int]]:
    m = IBAN.search(text)
    while m:
        end = _iban_end(text, m)
        if end:
            yield "iban", m.start(), end
        m = IBAN.search(text, end or m.start() + 1)
    for m in SSN.finditer(text):
        yield "ssn", *m.span()
    for m in SECRET.finditer(text):
        value = m.group()
        if len(set(value)) >= 8 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            yield "secret", *m.span()


def _score(kind: str, text: str, start: int, end: int) -> float:
    score = BASE_SCORE[kind]
    if kind in NEAR:
        around = text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]
        score += 0.4 * bool(NEAR[kind].search(around)) - 0.2 * bool(AGAINST.search(around))
    return min(1.0, max(0.0, score))


def find(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Spans of ``text`` by kind as listed, then start; offsets count code points, ends are exclusive.

    The base kinds pass by their checks alone. The other kinds also need a score of
    ``threshold``, and give way to a base span that they overlap. Different base kinds may
    overlap: each is found on its own.
    """
    spans = [Span(kind, a, b, BASE_SCORE[kind]) for kind, a, b in _base(text)]
    taken = [(s.start, s.end) for s in spans]
    for kind, a, b in _more(text):
        score = _score(kind, text, a, b)
        if score >= threshold and not any(a < y and x < b for x, y in taken):
            spans.append(Span(kind, a, b, round(score, 3)))
    return sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start))


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by ``[KIND]`` of the first of it."""
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= done:
            out += [text[done:s.start], f"[{s.kind.upper()}]"]
        done = max(done, s.end)
    return "".join(out) + text[done:]


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_spans(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
               threshold: float = THRESHOLD) -> DataFrame:
    """Per row: the columns ``keep`` and ``spans``, an array of (kind, start, end, score). Null text has none."""

    def run(batches):
        for batch in batches:
            found = [[] if t is None else [vars(s) for s in find(t, threshold)]
                     for t in (v.as_py() for v in batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, SPAN_TYPE)],
                                             names=[*batch.schema.names[:-1], "spans"])

    chosen = docs.select(*keep, F.col(text_col).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(
        run, f"{fields}, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>")


def _of(kinds: tuple[str, ...]) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def listed(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, comma-joined, as a column over ``spans``."""
    return F.array_join(F.transform(_of(kinds), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of the base kinds, SHA-256 of the base spans and the list of all spans."""
    counts = [F.size(_of((k,))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(*keep, *counts, F.sha2(listed(BASE), 256).alias("base_sha256"), listed(KINDS).alias("spans"))


def masked(docs: DataFrame, columns: list[str], text_col: str = "text", length_col: str | None = "n_chars",
           threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (``columns``) with all spans replaced in the text and its length put right. Null stays null."""
    at = columns.index(text_col)

    def run(batches):
        for batch in (piece for whole in batches for piece in in_pieces(whole, at)):
            texts = [None if t is None else mask(t, find(t, threshold)) for t in (v.as_py() for v in batch.column(at))]
            arrays = list(batch.columns)
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    out = docs.select(*columns)
    out = out.mapInArrow(run, out.schema)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col else out

