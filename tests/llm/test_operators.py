"""Every operator against a plain Python version of its contract, over odd rows and over the small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from churnlake.llm import (block_search, language, mixing, near_dedup, packing, pii, quote_chat, suffix_dedup, url_filter,
                           winnowing)
from churnlake.llm.common import components
from churnlake.session import stage

SMALL = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(300)]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, t string, fp string, h string, "
          "size string, place string, anchor string, chunk string, row string, spans string, score string, key string")


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def odd_rows() -> list[tuple]:
    base = prose(1, 300)
    texts = [None, "", "   \n\t", "é", "x", base, base, base + " tail", base.upper(), prose(2, 40), "a" * 5000, prose(3, 20_000),
             "mail a.b@c.example.com and 4111 1111 1111 1111, 10.0.0.1 or +1 (555) 123-4567", "1234 !!", base[:700] + prose(4, 90)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[9], (None, base, None, None, 5), (None, None, None, None, None), (9, "same id, other text", "fr", "s1", 3)]
    return [r + ("clash",) * 12 for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return stage(spark.createDataFrame(odd_rows(), SCHEMA), "odd")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(
        c + 32 if 65 <= c <= 90 else c for c in range(256))))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


@pytest.mark.parametrize("name", ["odd", "docs", "none"])
def test_near_duplicates(request, name):
    df = request.getfixturevalue(name)
    rows = df.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    group = brute_components(fps)
    least = {}
    for g, r in zip(group, rows):
        least[g] = min((x for x in (least.get(g), r.doc_id) if x is not None), default=None)
    want = Counter((r.doc_id, f"{fp:016x}", least[g]) for r, fp, g in zip(rows, fps, group))
    assert Counter(map(tuple, near_dedup.near_duplicates(df).collect())) == want
    kept = near_dedup.keep_one(df.select(*corpus_pipeline.DOCUMENT_COLUMNS)).collect()
    assert {least[g] for g in group} - {None} == {r.doc_id for r in kept} - {None}


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base}
    for _ in range(300):
        x = rng.choice(sorted(fps))
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for crowded in (256, 2):
        roots = {r.node: r.root for r in components(near_dedup.links(df, crowded)).collect()}
        got = defaultdict(set)
        for x in signed:
            got[roots.get(x, x)].add(x)
        want = defaultdict(set)
        for x, g in zip(signed, brute_components(fps)):
            want[g].add(x)
        assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values()}


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    base, other = prose(11, 300), prose(12, 300)
    df = spark.createDataFrame([(1, base), (2, base), (2, other), (None, base)], "doc_id long, text string")
    for keep in (near_dedup.keep_one,):
        assert sorted(map(tuple, keep(df).collect()), key=str) == sorted([(1, base), (2, other), (None, base)], key=str)


def brute_repeats(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of distinct (id, text) rows in order."""
    seen, out = set(), {}
    for key in sorted({(r.doc_id is not None, r.doc_id or 0, suffix_dedup.text_hash((r.text or "").encode()), r.text or "") for r in rows}):
        data = key[3].encode()
        mark = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            w = data[i:i + length]
            if w in seen:
                mark[i:i + length] = True
            seen.add(w)
        kept = np.frombuffer(data, np.uint8)[~mark].tobytes()
        spans = int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())
        out[key[1] if key[0] else None, key[3]] = (len(data), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("name", ["odd", "docs", "none"])
def test_repeats(request, name):
    df = request.getfixturevalue(name)
    rows = df.select("doc_id", "text").collect()
    want = brute_repeats(rows)
    got = suffix_dedup.remove_repeats(df).drop("spans").collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *want[r.doc_id, r.text or ""]) for r in rows)


@pytest.mark.parametrize("in_memory", [40, 1 << 20])
def test_suffix_sorting_on_disk(in_memory):
    rng = random.Random(9)
    for _ in range(25):
        letters, length = rng.choice([2, 3, 26]), rng.choice([5, 8, 40])
        pieces = [bytes(rng.randrange(97, 97 + letters) for _ in range(rng.randrange(length, length + 60))) for _ in range(12)]
        pieces += rng.choices(pieces, k=3)
        seen = set()
        for piece, flags in zip(pieces, suffix_dedup.repeated(pieces, length, in_memory)):
            for i, flag in enumerate(flags):
                assert flag == (piece[i:i + length] in seen)
                seen.add(piece[i:i + length])


@pytest.mark.parametrize("name", ["odd", "docs", "none"])
def test_personal_data(request, name):
    df = request.getfixturevalue(name)
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, text):
        digits = re.sub("[^0-9]", "", text)
        if kind == "ip":
            return all(int(p) <= 255 for p in text.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    want = Counter()
    for r in df.select("doc_id", "text").collect():
        found = {k: [(m.start(), m.end()) for m in re.finditer(p, r.text or "") if good(k, m.group())] for k, p in patterns.items()}
        listed = ",".join(f"{k}:{a}:{b}" for k in patterns for a, b in found[k])
        want[r.doc_id, *(len(found[k]) for k in patterns), hashlib.sha256(listed.encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:-1] for r in pii.digest(pii.find_spans(df)).collect()) == want


def test_personal_data_by_context_and_checksum():
    kinds = lambda text: [s.kind for s in pii.find(text)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00.") == ["iban"] and kinds("IBAN DE88 3704 0044 0532 0130 00.") == []
    assert kinds("token = 04dbebab91ab85687d33eeaa") == ["secret"] and kinds("commit 04dbebab91ab85687d33eeaa") == []
    assert kinds("SSN 536-22-1234") == ["ssn"] and kinds("order 536-22-1234") == []
    assert pii.mask("a@b.cd, 1", pii.find("a@b.cd, 1")) == "[EMAIL], 1"
    assert pii.find("a" * 200_000 + "@") == [] and pii.find("1" * 200_000) == []


def test_personal_data_before_capitals_and_beyond_200_characters():
    iban, short = "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"
    for number, after in [(iban, " Please pay"), (iban, " COBADEFFXXX"), (iban, " 500.00 EUR"), (short, " EUR 500"), (short, " BIC NWBKGB2L"), (iban, "")]:
        text = f"IBAN {number}{after}"
        assert [(s.kind, s.start, s.end) for s in pii.find(text)] == [("iban", 5, 5 + len(number))], text
        assert pii.mask(text, pii.find(text)) == f"IBAN [IBAN]{after}"
    assert pii.mask(f"AB12 CDEF GHIJ {iban} X", pii.find(f"AB12 CDEF GHIJ {iban} X")) == "AB12 CDEF GHIJ [IBAN] X"
    assert pii.find("IBAN DE88 3704 0044 0532 0130 00 Please pay") == []
    token = "".join(random.Random(2).choices("abcdefABCDEF0123456789", k=320))
    assert pii.mask(f"token = {token} end", pii.find(f"token = {token} end")) == "token = [SECRET] end"


def test_language(odd, none, docs):
    found = language.predict(docs, language.learn(docs), keep=("doc_id", "lang")).withColumn("out", language.held_out()).collect()
    out = [r for r in found if r.out]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97 and all(0 <= r.score <= 1 for r in found)
    got = language.predict(odd, language.learn(odd)).collect()
    assert len(got) == odd.count()
    unknown = {r.doc_id for r in odd.select("doc_id", "text").collect() if not any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == unknown and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert language.predict(none, language.learn(none)).count() == 0


def test_code_lengths_are_exact():
    """The table against a walk from long to short contexts, byte by byte."""
    import pandas as pd
    import pyarrow as pa
    texts = {"a": ["abracadabra", "abra"], "b": ["bonobo", "cab"]}
    rows = Counter()
    for lang, own in texts.items():
        for text in own:
            data = b"\0\0\0" + text.encode()
            for i in range(3, len(data)):
                rows[lang, int.from_bytes(data[i - 3:i + 1], "big")] += 1
    model = language.build(["a", "b"], pd.DataFrame([(k, g, n) for (k, g), n in rows.items()], columns=["lang", "gram", "n"]), 1000)
    got = language.code_lengths(model, pa.array(["abracab", "", "zb", "bonobo"]))
    for row, text in zip(got, ["abracab", "", "zb", "bonobo"]):
        for lang, bits in zip("ab", row):
            total, data = 0.0, b"\0\0\0" + text.encode()
            for i in range(3, len(data)):
                excluded, coded = set(), False
                for order in (3, 2, 1, 0):
                    seen = Counter()
                    for (k, g), n in rows.items():
                        gram = g.to_bytes(4, "big")
                        if k == lang and gram[3 - order:3] == data[i - order:i] and gram[3] not in excluded:
                            seen[gram[3]] += n
                    size = sum(seen.values()) + len(seen)
                    if data[i] in seen:
                        total, coded = total - math.log2(seen[data[i]] / size), True
                        break
                    if seen:
                        total -= math.log2(len(seen) / size)
                        excluded |= set(seen)
                total += 0 if coded else math.log2(256 - len(excluded))
            assert abs(total - bits) < 1e-4


@pytest.mark.parametrize("name", ["odd", "docs", "none"])
def test_mixing(request, name):
    df = request.getfixturevalue(name)
    rows = mixing.digest(mixing.mix(df)).collect()
    want = Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in df.collect())
    assert Counter((r.doc_id, r["size"]) for r in rows) == want and all(r.taken <= 2 * r["size"] for r in rows)
    source = {(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))): r.source for r in df.collect()}
    taken, goal = Counter(), {}
    for r in rows:
        taken[source[r.doc_id, r["size"]]] += r.taken
        goal[source[r.doc_id, r["size"]]] = r.target
    if name == "docs":
        assert all(abs(taken[s] - goal[s]) <= 64 for s in goal)
        assert abs(sum(goal.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-3
        assert sorted(map(tuple, mixing.digest(mixing.mix(df)).collect())) == sorted(map(tuple, rows))


def test_permutation_and_targets():
    for size in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permuted(np.arange(size), size, np.full(size, 7))) == list(range(size))
    assert mixing.targets([10, 10, 10], [5, 2, 1], 1.5, 2) == [20, 50 / 3, 25 / 3]
    assert mixing.cut("a  b\nc d", [(0, 2), (3, 1)]) == "a  b d"


@pytest.mark.parametrize("name", ["odd", "docs", "none"])
def test_packing(request, name):
    df = request.getfixturevalue(name)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pack(df, path).collect()
    ids = [np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in df.collect()]
    want = Counter()
    for r, x in zip(df.collect(), ids):
        for a in range(0, len(x), 4096):
            want[r.doc_id, a, len(x[a:a + 4096]), zlib.crc32(x[a:a + 4096].tobytes()), len(x)] += 1
    assert Counter(tuple(p)[:5] for p in pieces) == want
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, p.length))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 4096
    if name == "docs":
        assert len(windows) <= sum(map(len, ids)) / 4096 * 1.02 + 2


def test_fullest_window():
    rng = random.Random(3)
    for _ in range(40):
        counts = Counter(rng.randrange(1, 30) for _ in range(8))
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        used = packing.fullest(dict(counts), sorted(counts, reverse=True), 50)
        assert sum(a * n for a, n in used) == max(s for s in sums if s <= 50) and all(counts[a] >= n for a, n in used)


def test_encoder_equals_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read())
    for text in ("I'll don't 12ab3 x²½ ªº ǅ ß ſ İı", "a\u0301 é ñ\u00a0x\u00ad\u2028y", "<|endoftext|> a <| b", "ΣΑΣ 日本 \x00\x1c\x85 z", "", "__a--b!!c\n\n\td"):
        assert np.frombuffer(encoder(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def brute_winnow(text):
    units = [u for u in (text or "").replace("\n", " ").split(" ") if u]
    if len(units) * 32 < len(text or ""):
        units = [u for u in re.sub(r"([^ \t\n\r\x0b\x0c]{32})", r"\1 ", text).replace("\n", " ").split(" ") if u]
    mask = (1 << 32) - 1
    h = [xxhash.xxh64_intdigest(u.encode(), 42) & mask for u in units]
    two = [(a * winnowing.FACTOR_1 + b) & mask for a, b in zip(h, h[1:])]
    g = [(a * winnowing.FACTOR_2 + b) & mask for a, b in zip(two, two[2:])]
    if not g:
        return None if h else []
    kept = []
    for i in range(max(1, len(g) - winnowing.W + 1)):
        window = list(enumerate(g[i:i + winnowing.W], i))
        p, v = min(window, key=lambda x: (x[1], -x[0]))
        if not kept or kept[-1][0] != p:
            kept.append((p, v))
    return [v for _, v in kept]


@pytest.mark.parametrize("name", ["odd", "docs", "none"])
def test_winnowing(request, name):
    df = request.getfixturevalue(name)
    rows = sorted(df.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.text or ""))
    want = Counter()
    for i, r in enumerate(rows):
        text, after = r.text or "", rows[(i + 1) % len(rows)].text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        want[r.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    got = winnowing.compare_edited(df).collect()
    assert Counter(tuple(r)[:3] for r in got) == want
    by_text = {r.doc_id: r.text for r in df.collect()}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if name == "docs" and (hashes := brute_winnow(by_text[r.doc_id])) is not None:
            assert r.fingerprint == ",".join(f"{v:08x}" for v in hashes)


def brute_url(url, rules):
    """(host, path, the longest rule that fits): strings alone, no patterns."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        ends = [i for i, c in enumerate(rest) if c in "/?#"]
        host, rest = (rest[:ends[0]], rest[ends[0]:]) if ends else (rest, "")
        path = rest.split("?")[0].split("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for action, text in rules:
        of, tail = text.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + tail):
            fits.append((len(text), text, action))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules_over_all_pages(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    top = pages.agg({"page_id": "max"}).head()[0]
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.com/en/x?y#z", "a://www.Example.COM/en/", "a://xwww.example.com/en/", "b://net/es/",
            "b://a.net/es", "b://net?/es/", "b://com", "b://com/", "b://xcom/", "://a.b.com//", "x://y://z.com/", "b://a.net#/fr/", "b://\u00c9.com/"]
    df = pages.union(spark.createDataFrame([(top + 1 + n, u) for n, u in enumerate(urls)], "page_id long, url string"))
    want = {r.page_id: brute_url(r.url, rules) for r in df.collect()}
    got = url_filter.judge(df, [url_filter.Rule(*r) for r in rules]).collect()
    assert len(got) == len(want)
    for r in got:
        host, path, rule, action = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == action if rule else r.verdict in ("allow", "block")
    assert len({r.rule for r in got}) == len(rules) + 1


def brute_units(text):
    """Words between blanks and line ends; characters of scripts without blanks, and of words over LONGEST characters, stand alone."""
    unspaced = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
                          "\uf900-\ufaff\U00020000-\U0003ffff])")
    words = [u for u in unspaced.sub(r" \1 ", text or "").replace("\n", " ").split(" ") if u]
    return [u for w in words for u in (w if len(w) > winnowing.LONGEST else [w])]


def brute_hashes(text):
    """Of each window of W k-grams the least hash, the rightmost of equal ones, a place once; None under K units."""
    mask = (1 << 32) - 1
    h = [xxhash.xxh64_intdigest(u.encode(), 42) & mask for u in brute_units(text)]
    two = [(a * winnowing.FACTOR_1 + b) & mask for a, b in zip(h, h[1:])]
    g = [(a * winnowing.FACTOR_2 + b) & mask for a, b in zip(two, two[2:])]
    places = []
    for i in range(max(1, len(g) - winnowing.W + 1) if g else 0):
        place = min(range(i, min(i + winnowing.W, len(g))), key=lambda n: (g[n], -n))
        if not places or places[-1] != place:
            places.append(place)
    return ",".join(f"{g[n]:08x}" for n in places) if g else None


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_edited_fingerprints_and_likenesses(request, name):
    df = request.getfixturevalue(name)
    rows = sorted(df.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.text or ""))
    got = winnowing.compare_edited(df).collect()
    own, checked = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in got}, 0

    def alike(a, b):
        a, b = ({v for v in x.split(",") if v} for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    def row_of(i):
        text, after = rows[i % len(rows)].text or "", rows[(i + 1) % len(rows)].text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        return own[rows[i % len(rows)].doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()], text, edited

    for i in range(len(rows)):
        r, text, edited = row_of(i)
        for found, of in ((r.fingerprint, text), (r.edited_fingerprint, edited)):
            want = brute_hashes(of)
            if want is not None:
                checked += 1
                assert found == want
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == alike(r.fingerprint, row_of(i + 1)[0].fingerprint)
    assert checked > len(rows) / 4


def test_units_of_unspaced_text(spark):
    """Half of an unspaced text is found again after spaced text, and a shifted run is found as well."""
    rng = random.Random(6)
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(3000))
    code = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=3000))
    rows = [(n, text[:1500] + " " + prose(7, 400), "xyzab" + text, text) for n, text in enumerate((han, code))]
    df = spark.createDataFrame(rows, "id long, half string, shifted string, text string")
    for c in ("half", "shifted", "text"):
        df = winnowing.with_winnow(df, c, f"k_{c}").withColumn(f"k_{c}", winnowing.hashes(F.col(f"k_{c}")))
    for r in df.collect():
        known = set(r.k_text)
        assert len(known & set(r.k_half)) > 0.45 * len(known) and len(known & set(r.k_shifted)) > 0.95 * len(known)
    emoji = spark.createDataFrame([("a\U00020000b \u0e01\u0e34 " + "x\U0001F600" * 40,)], "text string")
    got = winnowing._units(F.col("text"))
    assert emoji.select(got.alias("u")).head().u == ["a", "\U00020000", "b", "\u0e01", "\u0e34", "x\U0001F600" * 40]


def test_next_over_gaps_in_ids(spark):
    ids = [random.Random(1).randrange(10**15) for _ in range(3000)] + list(range(2000))
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    order = sorted(set(ids), reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    got = winnowing.with_next(df.withColumnRenamed("doc_id", "id"), ["text"], lambda x: x, per_chunk=8)
    assert {r.id: r.next_text for r in got.collect()} == {i: f"text {after[i]}" for i in ids}


@pytest.mark.parametrize("shape", ["far id", "repeated id", "null ids"])
def test_next_deals_by_rank(spark, shape):
    """No chunk takes more than its share, and a repeated id is not moved twice."""
    far = {"far id": 10**15, "repeated id": 7, "null ids": None}[shape]
    rows = [(i, f"text {i}") for i in range(4000)] + [(far, f"far {n:04}") for n in range(1 if shape == "far id" else 2000)]
    df = stage(spark.createDataFrame(rows, "id long, text string"), "ranked")
    sizes = []

    def prepare(x):
        sizes.extend(x.groupBy("chunk").count().collect())
        return x

    got = winnowing.with_next(df, ["text"], prepare, per_chunk=64).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert {(r.id, r.text): r.next_text for r in got} == {r: order[(n + 1) % len(order)][1] for n, r in enumerate(order)}
    assert len(got) == len(rows) and len(sizes) > 40 and max(r["count"] for r in sizes) < 400
    assert sum(r["count"] for r in sizes) == len(rows) + len(sizes)


def test_url_rules(spark):
    from churnlake.llm.queries import RULES
    urls = [None, "", "no scheme.com/", "http://com", "https://A.Example.COM/en/x?y#z", "http://www.example.com/en/1", "http://x.www.example.com/en/",
            "ftp://b.net/es/1", "http://b.net/de/", "http://notcom/", "http://c.com?x=/", "http://c.com/#://d.net/fr/", "x://e.net/fr/a b\nc"]
    want = [("", "", None), ("", "", None), ("", "", None), ("com", "", None), ("a.example.com", "/en/x", "example.com/en/"),
            ("www.example.com", "/en/1", "www.example.com/en/"), ("x.www.example.com", "/en/", "www.example.com/en/"), ("b.net", "/es/1", "net/es/"),
            ("b.net", "/de/", None), ("notcom", "/", None), ("c.com", "", None), ("c.com", "/", "com/"), ("e.net", "/fr/a b\nc", "net/fr/")]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = url_filter.judge(df, RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r["rule"]) for r in got] == want and all(r.verdict in ("allow", "block") for r in got)
    verdicts = {r.text: r.verdict for r in RULES}
    assert all(r.verdict == verdicts[r["rule"]] for r in got if r["rule"])
    assert url_filter.judge(df.limit(0), RULES).count() == 0


def test_rates_leave_out_their_own_fold(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a.com", "b.net", "c.org"]), rng.randrange(5), float(rng.random() < 0.3)) for _ in range(200)] + [("one.de", 2, 1.0)]
    df = spark.createDataFrame(rows, "domain string, fold int, label double")
    got = {(r.domain, r.fold): (r.domain_rate, r.domain_seen) for r in url_filter.suffix_rates(df, "domain", out_of_fold=True).collect()}
    assert set(got) == {(d, f) for d, f, _ in rows}
    for (domain, fold), (rate, seen) in got.items():
        labels = [x for d, f, x in rows if d == domain and f != fold]
        assert rate == pytest.approx((sum(labels) + 10) / (len(labels) + 20)) and seen == pytest.approx(math.log1p(len(labels)))
    assert got["one.de", 2] == (0.5, 0.0)  # as a suffix never seen


def test_trees_rank_held_out_urls(spark):
    from churnlake.llm.queries import RULES
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    assert url_filter.held_out_auc(pages, RULES) > 0.7
    assert url_filter.held_out_auc(pages.limit(0), RULES) is None


def test_search(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(size=16)]) for i in range(230)]
    vectors += [(300 + i, vectors[50][1]) for i in range(40)] + [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (450, [1.0, None] * 8),
                (403, [1.0, 2.0]), (None, vectors[3][1])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in vectors], "vec_id long, embedding array<float>, label int, id string")
    good = {i: np.array(v, float) for i, v in vectors if i is not None and v and None not in v and len(v) == 16 and np.isfinite(v).all() and any(v)}
    got = defaultdict(list)
    for r in block_search.nearest(df, lambda c: c % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in good if i % 50 == 0}
    for q, found in got.items():
        score = {i: float(v @ good[q] / np.linalg.norm(v) / np.linalg.norm(good[q])) for i, v in good.items() if i != q}
        want = sorted(score, key=lambda i: (-round(score[i], 12), i))[:5]
        assert [i for i, _ in found] == want and all(abs(s - score[i]) < 1e-12 for i, s in found)
    assert block_search.nearest(df.limit(0), lambda c: c % 50 == 0).count() == 0


def test_search_over_many_cells(spark):
    """Blocks of a few vectors, a vector and an id that fill a third of the rows each, repeated queries: as in one cell."""
    rng = np.random.default_rng(9)
    vectors = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(120)] + [(50, rng.normal(size=8).tolist()) for _ in range(120)]
    vectors += [(7, [1.0, 2.0, float(i)]) for i in range(9)] + [(100, [1.0, 2.0, 2.5])] * 2
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    asked = lambda c: c % 50 == 0
    whole = block_search.nearest(df, asked)
    got = block_search.nearest(df, asked, query_numbers=64, row_numbers=100)
    assert sorted(got.collect()) == sorted(whole.collect())
    assert got.where("query_id = 50").count() == 5 * 121
    short = [r for r in got.where("query_id = 100").collect() if r.vec_id == 7]
    assert len(short) == 2 * 5  # of their own length only, their own id left out
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CoGroup") == 1 and "Union" not in plan


def test_reply_order(spark):
    rows = [(1, 0, "u", "Hello there\nsecond line"), (1, 1, "a", "Something else"), (1, 2, "u", "> hello   there\n> second line\nmy answer"),
            (1, 3, "a", "> > Hello there\n> my answer\nI see"), (1, 4, "u", "> Something else\nok"), (1, 5, "a", "> second line\nlate reply"),
            (1, 6, "u", None), (2, 0, "u", "> nothing known\nfoo"), (None, None, None, "x"), (1, 7, "u", "> I see\nOn Monday X wrote:\n> ok\nlast"),
            (2, 1, "u", "same"), (2, 1, "u", "same")]
    df = spark.createDataFrame([r + ("c", 1) for r in rows], "conv_id long, turn long, role string, text string, rank string, root int")
    got = quote_chat.reply_ordered(df).orderBy("conv_id", "position").collect()
    assert [(r.conv_id, r.turn, r.reply_to, r.depth) for r in got] == [
        (None, None, None, 0), (1, 0, None, 0), (1, 2, 0, 1), (1, 3, 2, 2), (1, 7, 3, 3), (1, 5, 0, 1), (1, 1, None, 0), (1, 4, 1, 1), (1, 6, None, 0),
        (2, 0, None, 0), (2, 1, None, 0), (2, 1, None, 0)]
    assert got[3].text == "I see" and got[4].text == "last" and got[4].n_linked == 2
    assert quote_chat.reply_ordered(df.limit(0)).count() == 0


def test_conversations_without_quotes_keep_their_order(spark):
    got = entry.queries()["op4_quote_chat"](spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    assert {(r.conv_id, r.turn): (r.position, r.text) for r in got} == {
        (r.conv_id, r.turn): (r.turn, re.sub(r"\n{3,}", "\n\n", r.text).strip("\n")) for r in table}


def test_pipeline(spark, docs):
    """Each stage of the pipeline against a plain version of it, on its own input."""
    steps = dict(corpus_pipeline.STAGES)
    known = stage(steps["language"](spark, docs, SMALL), "known")
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    one = stage(steps["near_duplicates"](spark, known, SMALL), "one")
    rows = known.collect()
    least = {}
    for g, r in zip(brute_components([brute_fingerprint(r.text) for r in rows]), rows):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in one.collect()) == sorted(least.values())
    clean = stage(steps["personal_data"](spark, one, SMALL), "clean")
    texts = {r.doc_id: r.text for r in one.collect()}
    assert {r.doc_id: r.text for r in clean.collect()} == {i: pii.mask(t, pii.find(t)) for i, t in texts.items()}
    mixed = stage(steps["mixture"](spark, clean, SMALL), "mixed")
    assert mixed.columns == corpus_pipeline.DOCUMENT_COLUMNS
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len((r.text or "").encode().split())
    want = {r.doc_id: r.taken for r in mixing.digest(mixing.mix(clean)).collect() if r.taken}
    assert got == want
    pieces = steps["packing"](spark, mixed, SMALL)
    assert pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).agg(F.sum("n")).head()[0] == sum(
        len(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(r.text, add_special_tokens=False).ids) + 1
        for r in mixed.collect())


def test_workers_keep_few_words():
    """Words that the encoder keeps are bounded, and forgetting them changes no ids."""
    encoder = packing.Encoder(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = [" ".join("".join(letters[i // 26 ** p % 26] for p in range(4)) for i in range(a, a + 10_000)) for a in range(0, 250_000, 10_000)]
    first, most = encoder(text[0]), 0
    for one in text:
        encoder(one)
        most = max(most, len(encoder.kept))
    assert most <= 210_000 and encoder(text[0]) == first


def test_new_words_go_to_the_model_alone():
    """Words of usual texts are encoded one by one, without the tokenizer's costly passes over whole texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read())
    texts = [f"a{c}b {c} {c}{c}1{c}'s'LL x{c}'" for c in map(chr, range(0x300))] + ["K Å ẞß", "a < | b", "é<|é"]
    for text in texts:
        assert np.frombuffer(encoder(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    encoder.tokenizer = None
    for text in ("New WORDS, it's 12!", "Größe çà\tñandú\r\nœuvre ²"):
        assert np.frombuffer(encoder(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
