"""Ranked search, quality rules and the conversation trie against plain Python, over odd and over given tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from churnlake.llm import ball_search, prefix_trie, quality_rules
from churnlake.session import stage

SMALL = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id string, id string, n string, terms string, rank string, failed string, kept string, n_words string"


def odd_documents():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["Été", "éTÉ", "日本語", "x_y", "A-b"]
    texts = [None, "", " \n\t", "a", "A", "a a a a", "日本語。日本語", "x" * 70_000, " ".join(rng.choices(words, k=30_000))]
    texts += [" ".join(rng.choices(words[:20 + 20 * (i % 20)], k=rng.randrange(1, 120))) for i in range(900)]
    texts += [texts[20]] * 400 + ["$ $ $ # # word word word word word word word\n" * 3, "UP HERE IT IS LOUD AND LOUD AGAIN OH MY\n\nx\nx", "1 2 3 4 5 6 7 8 9 10 11"]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)] + [(7, "other text of id 7"), (30, texts[30]), (30, texts[30])]
    return [r + ("clash",) * 8 for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return stage(spark.createDataFrame(odd_documents(), DOCS).repartition(5), "odd")


@pytest.fixture(scope="module")
def items(spark):
    texts = [None, "", "...", "a", "w1 w2 w3 W1", "été 日本語 absent", odd_documents()[20][1], odd_documents()[100][1], "w399 w398", "w5", "w5"]
    rows = [(i if i != 4 else None, t) for i, t in enumerate(texts)] + [(7, "w5 w6")]
    return spark.createDataFrame([r + ("clash",) for r in rows], "item_id long, text string, doc_id string")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_rank(docs, items, k=10):
    counted = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    big_n, big_l = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            m = 100 - 90 + (90 * n * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall(lower(text))) if c[t])
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank + 1, None if no_id else i, -score) for rank, (score, no_id, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


@pytest.mark.parametrize("block", [256, 3])
def test_rank(odd, items, monkeypatch, block):
    monkeypatch.setattr(ball_search, "QUESTIONS", block)
    want = brute_rank([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert Counter(map(tuple, ball_search.rank(odd, items).collect())) == want


def test_rank_of_nothing(odd, items):
    names = ["item_id", "rank", "doc_id", "score"]
    for found in (ball_search.rank(odd.limit(0), items), ball_search.rank(odd, items.limit(0)), ball_search.rank(odd.where("text = ''"), items)):
        assert found.columns == names and found.count() == 0


def test_bounds_hold_and_prune():
    """No document scores above the bound of any node over it, and the search leaves most leaves closed."""
    rng = np.random.default_rng(4)
    rows, n_terms = [], 600
    for _ in range(2000):
        start = rng.integers(0, 6) * 100
        terms = np.unique(rng.integers(start, start + 100, rng.integers(1, 40)))
        rows.append((terms, rng.integers(1, 1_000_000, len(terms))))
    starts = np.concatenate([[0], np.cumsum([len(t) for t, _ in rows])])
    all_rows = ball_search.Rows(np.array([-i for i in range(len(rows))], object), starts, np.concatenate([t for t, _ in rows]),
                                np.concatenate([v for _, v in rows]))
    tree = ball_search.BallTree(all_rows, n_terms)
    weights = np.zeros((20, n_terms), np.int64)
    for n in range(20):
        weights[n, rng.choice(100, 8, replace=False) + 100 * (n % 6)] = rng.integers(1, 12_000, 8)
    bounds = tree.bounds(weights.T.astype(float))

    def below(node):
        return [tree.leaf[node]] if tree.leaf[node] else [x for c in tree.children[node] for x in below(c)]

    for node in range(len(tree.radius)):
        for leaf in below(node):
            for n in range(20):
                assert leaf.times(weights[n]).max() <= bounds[node, n]
    scored = []
    real = ball_search.Rows.times
    ball_search.Rows.times = lambda self, v: scored.append(1) or real(self, v)
    try:
        for n in range(20):
            best = []
            tree.search(bounds[:, n].tolist(), weights[n], best, 5)
            scores = real(all_rows, weights[n])
            want = sorted(((int(s), -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:5]
            assert sorted(best, reverse=True) == want
    finally:
        ball_search.Rows.times = real
    assert len(scored) < 20 * sum(x is not None for x in tree.leaf) / 2


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    upper = [w for w in words if not re.search("[a-z]", w) and len(re.findall("[A-Z]", w)) > 1]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_letter_words": sum(bool(re.search("[A-Za-z]|[^\x00-\x7F]", w)) for w in words), "n_upper_words": len(upper)}


def brute_failed(m):
    n = m["n_words"]
    return [n < 10, 100 * m["n_repeat_words"] > 20 * n, m["word_chars"] < 3 * n or m["word_chars"] > 12 * n, 10 * m["n_symbols"] > n,
            10 * m["n_dup_lines"] > 3 * m["n_lines"], 10 * m["n_letter_words"] < 8 * n, 10 * m["n_upper_words"] > 3 * n, n > 100_000]


def test_ledger(odd):
    want = Counter()
    for r in odd.collect():
        m = brute_measures(r.text)
        f = brute_failed(m)
        want[(r.doc_id, *(m[k] for k in quality_rules.MEASURES), sum(b << i for i, b in enumerate(f)), f[0] or f[1], not any(f[:7]))] += 1
    assert Counter(map(tuple, quality_rules.judge(odd).collect())) == want
    empty = quality_rules.judge(odd.limit(0))
    assert empty.columns == ["doc_id", *quality_rules.MEASURES, "failed", "base_failed", "kept"] and empty.count() == 0


def test_ablations(odd):
    entries = stage(quality_rules.ledger(odd), "ledger")
    failed = [r.failed for r in entries.collect()]
    want = set()
    for p in quality_rules.CORPUS:
        mask = quality_rules.mask(p)
        for rule in quality_rules.RULES:
            if rule.name in p.rules:
                want.add((p.name, p.version, rule.name, sum(f >> rule.bit & 1 for f in failed), sum(f & mask == 1 << rule.bit for f in failed),
                          sum(f & mask > 0 for f in failed), sum(f & mask == 0 for f in failed)))
    assert set(map(tuple, quality_rules.ablations(entries).collect())) == want
    assert quality_rules.ablations(entries.limit(0)).count() == 0


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [(r, x) for _, r, x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c - c % 100, [])[:h] + turns[c][h:])
    members, children, done, out = defaultdict(list), defaultdict(list), {}, Counter()
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(done[k][0] for k in children[p]) or 1
        saved = sum(done[k][1] for k in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        done[p] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in members[p] if whole[c] == p)))
        out[(min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved,
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


@pytest.fixture(scope="module")
def conversations(spark):
    rng = random.Random(1)
    rows = [(c, t if t or c % 3 else None, rng.choice(["user", None, "a"]), rng.choice(["x", "yy", None, "é😀", ""]))
            for c in range(600) for t in range(rng.randrange(0, 9))]
    rows += [(c, t, "user", "the same") for c in range(5000, 5300) for t in range(7)]
    rows += [(c, 0, "user", f"first {c}") for c in range(7000, 7900, 100)] + [(8000, t, "u", f"t{t}") for t in range(400)]
    rows += [(None, 1, "u", "x"), (1, 1, "u", "x"), (1, 1, "u", "x")]
    return stage(spark.createDataFrame([r + ("clash",) * 3 for r in rows], "conv_id long, turn long, role string, text string, key string, "
                                       "id string, name string"), "conversations")


@pytest.mark.parametrize("turns", [200_000, 40])
def test_trie(conversations, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "TURNS_IN_RANGE", turns)
    got = prefix_trie.shared_prefixes(conversations)
    assert got.columns == prefix_trie.OUT
    assert Counter(map(tuple, got.collect())) == brute_trie([tuple(r)[:4] for r in conversations.collect()])


def test_trie_of_nothing(conversations):
    assert prefix_trie.shared_prefixes(conversations.limit(0)).count() == 0
    assert prefix_trie.shared_prefixes(conversations.where("conv_id IS NULL")).count() == 0


def test_radix_tree_finds_all_keys_in_every_layout():
    rng = random.Random(2)
    for alphabet in (3, 12, 40, 256):
        keys = [bytes(rng.randrange(alphabet) for _ in range(rng.randrange(0, 4))) for _ in range(2000)]
        keys += [k + b"\x00" * 40 for k in keys[:50]]
        root = prefix_trie.Node(b"", 0)
        for n, key in enumerate(keys):
            prefix_trie.insert(root, key, n)
        sizes, work = set(), [(root, b"")]
        found = {}
        while work:
            node, path = work.pop()
            path += node.run
            sizes.add(node.size)
            found |= {n: path for n in node.ends}
            last = -1
            for byte, child in node.each():
                assert child.run[0] == byte > last
                last = byte
                work.append((child, path))
        assert found == dict(enumerate(keys))
        assert max(sizes) == {3: 4, 12: 16, 40: 48, 256: 256}[alphabet]
