"""Batches in slices: whole, in order, no slice without rows."""

import pyarrow as pa
import pytest

from lumenreel.llm.common import slices


@pytest.mark.parametrize("texts", [[], [None], [None, "", "a" * 50, None, "b", "c" * 9, "d" * 9, ""], ["x" * 7] * 40])
def test_slices_keep_every_row(texts):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    parts = list(slices(batch, "text", 10))
    assert [t for p in parts for t in p["text"].to_pylist()] == texts
    assert all(p.num_rows for p in parts)
    assert all(sum(len(t or "") for t in p["text"].to_pylist()[:-1]) <= 60 for p in parts)
