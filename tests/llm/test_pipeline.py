"""Every stage of the pipeline on the smallest tables, against what it must keep of its input."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from labelbench.shared import cut

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """[(rows of documents before, result)] of all stages."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = docs.limit(1).selectExpr("-1L AS doc_id", "'12 34' AS text", "lang", "source", "5L AS n_chars")
    docs = docs.union(odd)
    found = []
    for _, stage in corpus_pipeline.STAGES:
        result = cut(stage(spark, docs, FOLDER))
        found.append((docs, result))
        docs = result
    return found


def test_there_are_five_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID",
        "line dedup",
        "n-gram Jaccard join",
        "mixing",
        "BPE",
    ]
    assert "pipeline" in __spark_entry__.queries()
    names = [q for q in __spark_entry__.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_only_texts_without_letters_go(stages):
    before, after = stages[0]
    assert {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()} == {-1}
    assert after.count() == before.count() - 1


def test_shared_lines_go(stages):
    before, after = (Counter(map(tuple, df.collect())) for df in stages[1])

    def key(line):
        return line.encode().strip().lower()

    docs = Counter(k for row in before for k in set(map(key, row[1].split("\n"))))
    gone = {k for k, n in docs.items() if k and n >= 10}
    wanted = Counter()
    for doc, text, lang, source, _ in before:
        kept = "\n".join(line for line in text.split("\n") if key(line) not in gone)
        wanted[doc, kept, lang, source, len(kept)] += 1
    assert after == wanted


def test_one_of_each_group_stays(stages):
    before, after = stages[2]
    sets = {}
    for r in before.collect():
        found = r["text"].encode().lower().split()
        sets[r["doc_id"]] = {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()
    holders = defaultdict(set)
    for doc, s in sets.items():
        for shingle in s:
            holders[shingle].add(doc)
    least = {doc: doc for doc in sets}
    links = []
    for doc, s in sets.items():
        for other in set().union(*(holders[x] for x in s)) - {doc} if s else ():
            if 100 * len(s & sets[other]) >= 80 * len(s | sets[other]):
                links.append((doc, other))
    for _ in sets:
        changed = False
        for a, b in links:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
        if not changed:
            break
    assert {r["doc_id"] for r in after.collect()} == {d for d in sets if least[d] == d}


def test_the_mix_repeats_whole_documents(stages):
    before, after = stages[3]
    own = {r["doc_id"]: tuple(r) for r in before.collect()}
    copies = Counter(r["doc_id"] for r in after.collect())
    assert all(tuple(r) == own[r["doc_id"]] for r in after.collect())
    assert max(copies.values()) <= 3
    words = {d: len(row[1].split()) for d, row in own.items()}
    budget = sum(words.values())
    taken = sum(words[d] * n for d, n in copies.items())
    assert budget - max(words.values()) <= taken <= budget


def test_the_ids_are_the_librarys(stages):
    before, after = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    wanted = Counter()
    for r in before.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        wanted[r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), r["text"]] += 1
    assert Counter((r[0], r[1], bytes(r[2]), r[3]) for r in after.collect()) == wanted


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == stages[-1][1].columns and rows.count() > 0


FOREIGN = [
    "Это русский текст о погоде и природе, о людях и городах.",
    "這是一個關於天氣和自然的中文句子, 還有人和城市",
    "qzx wvk jjq xxk zzq pqr vvw kkz qqj xzw",
    "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQgZW5jb2RlZA",
]


def test_texts_in_no_learned_language_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [(-1 - i, text, "en", "src0", len(text)) for i, text in enumerate(FOREIGN)]
    both = docs.union(spark.createDataFrame(odd, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, both, "").collect()}
    gone = {r["doc_id"] for r in both.collect()} - kept
    # A document may be a license line after two unknown words.
    assert {-1, -2, -3, -4} <= gone and len(gone) <= 5


def test_without_labels_texts_with_letters_stay(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars"
    )
    assert corpus_pipeline.identify_language(spark, docs, FOLDER).count() == docs.count()
