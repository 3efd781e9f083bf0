"""Clashing names, odd values and bare executors."""

import os
import subprocess
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from churnlake.llm import block_search, language, mixing, near_dedup
from churnlake.llm.common import components
from churnlake.session import new_path, stage

SMALL = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CLASHING = ["__text", "__mark", "__t", "__id", "__tie", "__source", "__parts", "fp", "lang_pred_", "n"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_columns_of_the_names_used_inside_are_kept(spark, docs):
    from pyspark.sql import functions as F
    wide = stage(docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING}), "wide")
    names = [*corpus_pipeline.DOCUMENT_COLUMNS, *CLASHING]
    for found in (language.keep_known(wide, names), near_dedup.keep_one(wide), mixing.mixed_documents(wide, names)):
        rows = found.collect()
        assert found.columns == names and rows
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHING)


def test_a_kept_text_goes_to_python_once(docs):
    plan = language.keep_known(docs, corpus_pipeline.DOCUMENT_COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "__text" not in plan


def test_long_and_short_texts_are_judged_alike(spark):
    """Batches are cut by bytes; a text longer than a piece stands alone."""
    text = "the words of this text are plain and of one kind "
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([text] * 40 + [text * 30_000, None, "", text * 20_000, "?"] + [text] * 40)]
    rows += [(1000 + i, "die woerter dieses textes sind einfach und von einer art ", "de", "s", 0) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    found = {r.doc_id: r.lang_pred for r in language.predict(df, language.learn(df)).collect()}
    assert len(found) == len(rows)
    assert all(found[i] == ("und" if not (t or "").strip("?") else lang) for i, t, lang, _, _ in rows)


def test_vectors_of_any_size_are_ranked(spark):
    """Components whose squares overflow or vanish; equal directions score alike."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 6))
    scale = np.array([1e200, 1e-200, 1.0, 1e300, 1e-300, 1e-8])[np.arange(60) % 6]
    df = spark.createDataFrame([(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(base, scale))], "vec_id long, embedding array<double>")
    unit = base / np.sqrt((base ** 2).sum(1))[:, None]
    near = unit @ unit.T
    np.fill_diagonal(near, -9)
    got = {}
    for r in block_search.nearest(df, lambda i: i % 7 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 60, 7))
    for q, found in got.items():
        best = np.argsort(-near[q], kind="stable")[:5]
        assert [found[i + 1][0] for i in range(5)] == best.tolist()
        assert [found[i + 1][1] for i in range(5)] == pytest.approx(near[q][best].tolist(), abs=1e-12)


def test_components_leave_the_callers_cache_alone(spark):
    kept = spark.range(10).cache()
    kept.count()
    components(spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a long, b long")).collect()
    assert kept.storageLevel.useMemory and spark._jsparkSession.sharedState().cacheManager().lookupCachedData(kept._jdf).isDefined()
    kept.unpersist()


def test_small_tables_are_not_written_as_a_file_per_shuffle_partition(spark):
    """Each file that an executor writes to a local folder starts processes beside it."""
    words = np.random.default_rng(5).integers(0, 5000, (400, 30))
    rows = [(i, " ".join(f"w{w}" for w in (words[i - i % 2][:-1] if i % 4 < 2 else words[i])), "en", "web", 100) for i in range(400)]
    docs = stage(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1), "few")
    folder = Path(new_path(spark, "x").removeprefix("file://")).parent
    held = {"spark.sql.shuffle.partitions": "101", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    written = {}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        for name, step in (("near", corpus_pipeline.one_of_each), ("mixed", corpus_pipeline.mixed), ("packed", corpus_pipeline.packed)):
            before = set(folder.rglob("part-*.parquet"))
            assert step(spark, docs, "").count() > 0
            written[name] = len(set(folder.rglob("part-*.parquet")) - before)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # of near-duplicates the first table of links is as wide as the shuffle: its rows are not known before
    assert written["near"] <= 101 + 20 and written["mixed"] <= 12 and written["packed"] <= 8, written


def test_components_in_few_files_keep_every_link(spark, monkeypatch):
    import churnlake.session as session
    monkeypatch.setattr(session, "ROWS_PER_FILE", 7)
    chains = [(i, i + 3) for i in range(1, 200)] + [(500, 900), (901, 900)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chains, "a long, b long").repartition(16)).collect()}
    assert found == {i: 1 + (i - 1) % 3 for i in range(4, 203)} | {900: 500, 901: 500}


def test_code_lengths_need_little_memory_beside_the_texts():
    grams = pd.DataFrame({"lang": "en", "gram": [(97 << 24) | (98 << 16) | (99 << 8) | c for c in range(97, 123)], "n": 1})
    model, texts = language.build(["en"], grams, 100), pa.array(["abcdefghi " * 1000] * 52)
    one = language.code_lengths(model, texts[:1])
    tracemalloc.start()
    try:
        assert (language.code_lengths(model, texts) == one).all()
        assert tracemalloc.get_traced_memory()[1] < 8e6
    finally:
        tracemalloc.stop()


def test_executors_need_not_have_the_package(tmp_path):
    """The package is put on the driver's path only; Python workers start without it."""
    code = (f"import sys; sys.path.insert(0, {REPO!r})\n"
            "import __spark_entry__ as entry\n"
            "sys.path.remove(entry.__file__.rsplit('/', 1)[0])\n"
            "from churnlake.session import local_session\n"
            "spark = local_session(2)\n"
            f"for name in ('op6_packing', 'op11_ball_search', 'op12_quality_rules', 'op13_prefix_trie'):\n"
            f"    assert entry.queries()[name](spark, {SMALL!r}).count() > 0, name\n"
            "print('all ran')\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-2000:]
