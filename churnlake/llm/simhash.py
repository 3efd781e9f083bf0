"""64-bit SimHash fingerprints of word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLES_AT_ONCE = 65_536


def fingerprint(data: bytes, words_in_shingle: int = 4, seed: int = 42) -> int:
    """SimHash of UTF-8 ``data`` as an unsigned integer; 0 if it has no word.

    Words are runs without ASCII white space, A-Z in lower case. Repeated shingles count
    each time. A text with fewer words than a shingle has one shingle, the whole sequence.
    """
    words = data.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    k = min(words_in_shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
    total = len(words) - k + 1
    hashes = (xxhash.xxh64_intdigest(s, seed) for s in shingles)
    ones = np.zeros(64, np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        part = np.fromiter(hashes, np.uint64, min(SHINGLES_AT_ONCE, total - start))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     words_in_shingle: int = 4, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and ``fp`` (the 64 bits as a signed long). Null text counts as empty."""

    def run(batches):
        for batch in batches:
            values = [0 if t is None else fingerprint(t.encode(), words_in_shingle, seed)
                      for t in (v.as_py() for v in batch.column(1))]
            fps = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col))
