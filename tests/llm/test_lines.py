from collections import Counter

import pytest

from labelbench.llm import lines
from odd_docs import odd_rows


def _key(line):
    return line.encode().strip(lines.SPACES).lower()


def _brute(min_docs, keep_first=False):
    rows = odd_rows()
    found = Counter(k for r in rows for k in set(map(_key, (r[1] or "").split("\n"))) if k)
    first = {}
    for doc, text, *_ in rows:
        for n, line in enumerate((text or "").split("\n")):
            if doc is not None:
                first[_key(line)] = min(first.get(_key(line), (doc, n)), (doc, n))
    out = []
    for doc, text, *_ in rows:
        all_lines = (text or "").split("\n")
        kept = [
            line
            for n, line in enumerate(all_lines)
            if found[_key(line)] < min_docs or (keep_first and first.get(_key(line)) == (doc, n))
        ]
        out.append((doc, None if text is None else "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"min_docs": 2},
        {"min_docs": 1},
        {"sent_keys": 0},
        {"filter_bytes": 0},
        {"keep_first": True},
        {"keep_first": True, "sent_keys": 0},
    ],
    ids=str,
)
def test_shared_lines_go(odd, options):
    out = lines.drop_repeated_lines(odd, **options)
    assert out.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    found = Counter(tuple(r) for r in out.select("doc_id", "text", "n_lines", "n_dropped").collect())
    assert found == _brute(options.get("min_docs", 10), options.get("keep_first", False))


def test_no_rows_no_lines(no_docs):
    assert lines.drop_repeated_lines(no_docs).count() == 0


def test_suspects_are_few(spark):
    rows = [(i, "\n".join([f"own line {i} {j}" for j in range(20)] + ["shared"])) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    filters, slices = lines.repeat_filters(docs)
    from labelbench.llm import bloom

    sent = bloom.joined(slices, filters.collect())
    own = [lines.line_digest(f"own line {i} {j}".encode()) for i in range(500) for j in range(20)]
    assert bloom.maybe_in(sent, lines._hashes(own)).mean() < 0.02
    assert bloom.maybe_in(sent, lines._hashes([lines.line_digest(b"shared")])).all()
