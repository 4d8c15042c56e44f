"""Scans return what they have freed once they end: a worker outlives its task."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from labelbench.llm import language, lines

BATCH = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words\nin lines", "some words"]})


class Captured:
    """Stands for documents, and keeps the functions that are to run over their batches."""

    schema = T.StructType().add("doc_id", "long").add("text", "string")
    columns = ("doc_id", "text")

    def __init__(self):
        send = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))
        self.sparkSession = SimpleNamespace(sparkContext=send)
        self.scans = []

    def mapInArrow(self, scan, schema):
        self.scans.append(scan)
        return self

    def first(self):
        return [30]

    def toLocalIterator(self):
        return iter(())

    def __getattr__(self, name):
        return lambda *args, **kwargs: self


CODES = language.fit_codes(
    np.stack([language.ngram_lanes(x) for x in (b"some words", b"andere Worte")]), ["en", "de"]
)


SCANS = {
    "language": (language, lambda docs: language.in_a_language(docs, CODES)),
    "named language": (language, lambda docs: language.identified(docs, CODES)),
    "line filters": (lines, lambda docs: lines.repeat_filters(docs)),
    "line counts": (lines, lambda docs: lines.repeated_lines(docs, 10, filter_bytes=-1)),
    "rewritten lines": (lines, lambda docs: lines._rewritten(docs, docs, False)),
}


@pytest.mark.parametrize("scan", SCANS)
def test_a_scan_returns_what_it_has_freed(spark, monkeypatch, scan):
    module, make = SCANS[scan]
    returned = []
    monkeypatch.setattr(module, "give_back", lambda: returned.append(1))
    monkeypatch.setattr(lines, "cut", lambda df: df)
    docs = Captured()
    make(docs)
    rows = sum(batch.num_rows for batch in docs.scans[-1](iter([BATCH, BATCH])))
    assert rows > 0 and returned == [1]
