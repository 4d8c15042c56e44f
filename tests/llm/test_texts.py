"""Fingerprints, language identification, byte-pair encoding."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelbench.llm import bpe, fingerprints, language
from odd_docs import odd_rows, words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("rows_per_part", [4000, 9])
def test_fingerprints_of_texts_and_edited_texts(odd, rows_per_part):
    rows = fingerprints.fingerprints(odd, rows_per_part).collect()
    texts = sorted(
        ((r[0], r[1] or "") for r in odd_rows()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
        reverse=True,
    )
    wanted = []
    for i, (doc, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        k = len(text) // 3
        edited = (text[: len(text) - k] + following[:k]).encode()
        own, new = fingerprints.vector(text.encode()), fingerprints.vector(edited)
        after = fingerprints.vector(following.encode())
        wanted.append(
            (
                doc,
                len(text),
                sha256(edited).hexdigest(),
                fingerprints.printed(own),
                fingerprints.printed(new),
                fingerprints.likeness(own, new),
                fingerprints.likeness(own, after),
            )
        )
    assert Counter(map(tuple, rows)) == Counter(wanted)


def test_no_rows_no_fingerprints(no_docs):
    assert fingerprints.fingerprints(no_docs).count() == 0


def test_order_does_not_matter_and_paragraphs_come_and_go():
    rng = random.Random(2)
    parts = [" ".join(words(rng, rng.randint(0, 30))).encode() for _ in range(20)]
    whole = fingerprints.vector(b"\n".join(parts))
    rng.shuffle(parts)
    assert fingerprints.printed(fingerprints.vector(b"\n".join(parts))) == fingerprints.printed(whole)
    less = fingerprints.minus(whole, fingerprints.vector(parts[3]))
    rest = fingerprints.vector(b"\n".join(parts[:3] + parts[4:]))
    assert fingerprints.printed(less) == fingerprints.printed(rest)
    assert fingerprints.printed(less) != fingerprints.printed(whole)
    assert fingerprints.likeness(whole, whole) == 1.0 and 0.5 < fingerprints.likeness(whole, less) < 1


def test_grams_are_counted_across_chunks(monkeypatch):
    text = " ".join(words(random.Random(1), 500)).encode()
    whole = fingerprints.printed(fingerprints.vector(text))
    monkeypatch.setattr(fingerprints, "CHUNK", 64)
    assert fingerprints.printed(fingerprints.vector(text)) == whole


def _languages(spark, n=240):
    rng = random.Random(6)
    sounds = {"aa": "aeioun", "bb": "ktrsaz", "cc": "ößäghe"}
    rows = [
        (i, " ".join(words(rng, rng.randint(3, 60), sounds[lang])), lang)
        for i in range(n)
        for lang in [rng.choice(list(sounds))]
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_texts_get_their_language(spark):
    docs = _languages(spark)
    held = {r["doc_id"] for r in docs.where(language.is_held_out()).collect()}
    assert held == {i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2}
    codes = language.trained(docs.where(~language.is_held_out()), per_language=30)
    unseen = docs.where(language.is_held_out()).withColumnRenamed("lang", "truth")
    rows = language.identified(unseen, codes).collect()
    assert np.mean([r["truth"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    again = language.trained(docs.where(~language.is_held_out()).repartition(7), per_language=30)
    assert np.array_equal(again.weights, codes.weights)


def test_all_of_many_languages_are_learned(spark):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèàçñøåæ"
    sounds = {f"l{i:02}": rng.sample(letters, 5) for i in range(40)}
    rows = [(i, " ".join(words(rng, 40, sounds[f"l{i % 40:02}"])), f"l{i % 40:02}") for i in range(40 * 12)]
    rows += [(1000 + i, " ".join(words(rng, 40, sounds["l00"])), "l00") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = language.trained(docs)
    assert codes.languages == sorted(sounds)
    found = language.identified(docs.withColumnRenamed("lang", "truth"), codes).collect()
    assert np.mean([r["truth"] == r["lang_pred"] for r in found]) > 0.95
    assert language.training_rows(docs, 400, 200).groupBy("lang").count().where("count <= 5").count() == 40


def test_rows_without_letters_take_no_languages_place(spark):
    """20,000 letterless rows of a language and one with letters: it is learned from the one."""
    rows = spark.range(20_000).selectExpr("id AS doc_id", "'12 34' AS text", "'zz' AS lang")
    rows = rows.union(spark.sql("SELECT 30000L, 'aha oho uhu aha', 'zz'"))
    rows = rows.union(spark.sql("SELECT id + 40000, concat('the of and ', id), 'en' FROM range(50)"))
    found = {r["lang"]: r["n"] for r in language.training_rows(rows, 400).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert found == {"zz": 1, "en": 50}


def test_texts_without_letters_have_no_language(spark, odd):
    codes = language.trained(_languages(spark), per_language=30)
    out = language.identified(odd, codes)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score", "ambiguous"]
    for r in out.collect():
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or "")))
        assert r["lang_pred"] != "und" or (r["score"] == 0 and not r["ambiguous"])
    assert out.count() == len(odd_rows())


def test_without_labels_or_rows(odd, no_docs):
    assert language.trained(no_docs) is None
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert language.trained(unlabelled) is None
    assert {r["lang_pred"] for r in language.identified(odd, None).collect()} == {"und"}
    assert language.identified(no_docs, None).count() == 0


@pytest.mark.parametrize("languages", [1, 2, 4, 7, 12])
def test_codewords_differ_widely(languages):
    code = language.codewords(languages)
    gaps = [(code[i] != code[j]).sum() for i in range(languages) for j in range(i)]
    assert not gaps or min(gaps) >= max(1, code.shape[1] // 3)


def test_encoding_equals_the_library(odd):
    library = Tokenizer.from_file(VOCABULARY)
    rows = Counter(
        (r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"])
        for r in bpe.encode(odd, VOCABULARY).collect()
    )
    wanted = Counter()
    for doc, text, *_ in odd_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted[doc, len(ids), np.array(ids, "<u4").tobytes(), decoded] += 1
    assert rows == wanted


def test_odd_characters_and_spaces(monkeypatch):
    monkeypatch.setattr(bpe, "HELD_CHUNKS", 50)  # forgotten again and again
    library = Tokenizer.from_file(VOCABULARY)
    with open(VOCABULARY, encoding="utf-8") as file:
        encoder = bpe.Encoder(bpe.Vocabulary(file.read()))
    rng = random.Random(3)
    pieces = [*"aA \n\t1'.²½٣é中😀\x1c\x85\xa0\u2003\u200b\u3000\x00", "  ", "'s", "the", "<|endoftext|>", "\r\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(3000)]
    texts += ["a" * 3000, " " * 500, "=-" * 800, *(f" {chr(c)}{chr(c)}a" for c in range(0, 0xD800, 7))]
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        found = [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(part)]
        assert found == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_every_token_is_encoded_as_the_library_does():
    library = Tokenizer.from_file(VOCABULARY)
    with open(VOCABULARY, encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    encoder = bpe.Encoder(vocabulary)
    texts = [t.decode() for t in vocabulary.id_of if _is_text(t)][::5]
    found = [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)]
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def _is_text(token):
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def test_no_rows_no_tokens(no_docs):
    assert bpe.encode(no_docs, VOCABULARY).count() == 0
