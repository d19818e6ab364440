"""The exchange of grams: rows that a batch sends, whatever the number of batches."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import windows
from tablewright.llm.suffix_dedup import remove_repeated_bytes
from tests.llm import brute


@pytest.mark.parametrize("batches", [1, 2, 250, 15_000, 500_000])
def test_rows_of_a_batch_follow_the_root_of_the_batches(batches):
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 123, 4000, dtype=np.uint8)) for _ in range(40)]
    table = pa.table({"__batch": [0] * 40, "__id": pa.array(range(40), pa.int64()), "__text": pa.array(texts, pa.binary())})
    unit = windows.Unit(words=False, window=50, gram=24, buckets=batches)
    sent = windows._send_grams(unit)((pa.scalar(batches - 1),), table, None)
    grams = sum(len(b) // 2 for b in sent["b"].to_pylist())
    step = math.isqrt(batches - 1) + 1
    assert sent.num_rows <= step and grams > 9000
    merged = windows._merge_grams(unit)((pa.scalar(int(sent["bucket"][0].as_py())),), sent.slice(0, 1))
    assert merged.num_rows <= step
    # A narrow bucket hears from as many wide ones as there are groups.
    assert max(unit.cell(b, 0) for b in (0, batches - 1)) // step <= step
    assert {b // step for b in merged["bucket"].to_pylist()} == {sent["bucket"][0].as_py() % step}


def test_counts_beyond_what_a_byte_holds(spark):
    """A passage in very many documents of very many batches is hot only when all of its counts are added."""
    rng = random.Random(2)
    passage = " ".join(f"shared{i}" for i in range(12))
    docs = [(i, f"{rng.randrange(10**9)} {passage} {rng.randrange(10**9)}") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute.repeated_bytes(docs)
    for settings in ({"batch_bytes": 300, "hot": 300}, {"batch_bytes": 200_000, "hot": 4096}):
        rows = remove_repeated_bytes(df, **settings).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == want
