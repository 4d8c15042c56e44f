"""Language identification with error-correcting output codes.

Each language has a codeword. For each bit of the code a binary classifier over character n-grams
is trained to tell the languages with a 1 there from those with a 0. A text takes the language whose
codeword costs least, where a bit costs the logistic loss of its classifier times the weight of the
bit, which falls with the classifier's own training loss. A small lead over the runner-up flags the
text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelbench.llm.batches import column, give_back, runs, text_bytes

LANES = 4096
RUN_BYTES = 1 << 20
UNKNOWN = "und"
HAS_LETTER = r"\p{L}"
ROUNDS = 200
RIDGE = 1e-5
LEAST_BYTES = 16  # of a text whose distance tells anything
MOST_ROWS = 12_800  # of training that the driver gets


def ngram_lanes(data: bytes) -> np.ndarray:
    """Share of each lane among the hashed 1-, 2- and 3-grams of the bytes, scaled to length 1.

    A-Z count as a-z, so headings in capitals look like other text.
    """
    raw = np.frombuffer(data.lower(), np.uint8).astype(np.uint32)
    if not len(raw):
        return np.zeros(LANES, np.float32)
    counts = np.zeros(LANES, np.int64)
    gram = np.zeros(len(raw), np.uint32)
    for n in (1, 2, 3):
        if len(raw) < n:
            break
        gram = (gram[: len(raw) - n + 1] << np.uint32(8)) | raw[n - 1 :]
        mixed = (gram + np.uint32(n << 24)) * np.uint32(2654435761)
        counts += np.bincount(mixed >> np.uint32(20), minlength=LANES)
    values = np.sqrt(counts)
    return (values / np.linalg.norm(values)).astype(np.float32)


def codewords(languages: int, seed: int = 1) -> np.ndarray:
    """Rows of 0 and 1. Up to seven languages get the exhaustive code, in which any two rows differ
    in 2 ** (languages - 2) bits; more get random rows, the best of many draws by least distance."""
    if languages <= 7:
        bits = max(1, 2 ** (languages - 1) - 1)
        columns = (np.arange(bits)[:, None] >> np.arange(languages - 1)) & 1
        return np.column_stack([np.ones(bits, int), columns]).T if languages > 1 else np.ones((1, 1), int)
    draw, best, distance = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = draw.integers(0, 2, (languages, int(15 * np.ceil(np.log2(languages)))))
        code = code[:, (code.min(axis=0) == 0) & (code.max(axis=0) == 1)]
        ones = code.astype(np.float32)
        gaps = ones @ (1 - ones).T + (1 - ones) @ ones.T
        np.fill_diagonal(gaps, np.inf)
        if gaps.min() > distance:
            best, distance = code, gaps.min()
    return best


@dataclass
class Codes:
    """Languages with their codewords, and one linear classifier with a weight for each bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    farthest: float = np.inf  # distance to the nearest codeword beyond which a text is in no language


def fit_codes(features: np.ndarray, labels: list[str]) -> Codes:
    """Ridge logistic classifiers for all bits at once, by accelerated gradient steps."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    place = {name: i for i, name in enumerate(languages)}
    owner = np.array([place[name] for name in labels])
    target = code[owner].astype(np.float64)
    balance = (1.0 / np.bincount(owner))[owner][:, None] / len(languages)
    x = np.column_stack([features.astype(np.float64), np.ones(len(features))])
    w = np.zeros((x.shape[1], code.shape[1]))
    ahead, speed = w.copy(), 1.0
    step = 1.0 / (0.25 * 2.0 + RIDGE)  # rows have length sqrt(2)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-x @ ahead))
        new = ahead - step * (x.T @ ((p - target) * balance) + RIDGE * ahead)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - w)
        w, speed = new, faster
    margin = (x @ w) * (2 * target - 1)
    loss = (np.logaddexp(0, -margin) * balance).sum(axis=0)
    trust = 1 / (loss + 0.05)
    return Codes(languages, code, w[:-1].astype(np.float32), w[-1].astype(np.float32), trust / trust.sum())


def decode(codes: tuple, features: np.ndarray) -> tuple[np.ndarray, ...]:
    """(best codeword, score, lead over the runner-up, distance to the best codeword) of each row.

    The score is the best one's share of exp(-cost), costs being in nats per bit of the code's
    least distance.
    """
    _, code, weights, bias, trust = codes
    margin = features @ weights + bias
    cost = (np.logaddexp(0, -margin) * trust) @ code.T + (np.logaddexp(0, margin) * trust) @ (1 - code).T
    cost = cost * code.shape[1]
    share = np.exp(cost.min(axis=1, keepdims=True) - cost)
    share /= share.sum(axis=1, keepdims=True)
    ranked = np.sort(share, axis=1)
    lead = ranked[:, -1] - (ranked[:, -2] if share.shape[1] > 1 else 0)
    return cost.argmin(axis=1), ranked[:, -1], lead, cost.min(axis=1)


def farthest(features: np.ndarray, labels: list[str], slack: float = 1.25) -> float:
    """A distance that texts of the learned languages stay below: the largest one of rows that get
    their own language from codes fitted to the other half of the rows, times ``slack``, and at least 0.4
    of the distance of a text that no classifier knows anything of, as few rows show few odd ones.

    Infinite when a half lacks a language or no row gets its own.
    """
    names, order = np.array(labels, object), np.argsort(labels, kind="stable")
    half, most = np.zeros(len(labels), bool), 0.0
    half[order[::2]] = True
    for own in (half, ~half):
        if set(names[own]) != set(labels) or set(names[~own]) != set(labels):
            return np.inf
        codes = fit_codes(features[own], list(names[own]))
        parts = (codes.languages, codes.code, codes.weights, codes.bias, codes.trust)
        found, _, _, distance = decode(parts, features[~own])
        right = np.array(codes.languages, object)[found] == names[~own]
        most = max(most, distance[right].max(initial=0.0))
    unknown = np.log(2) * codewords(len(set(labels))).shape[1]
    return max(slack * most, 0.4 * unknown) if most else np.inf


def training_rows(docs: DataFrame, per_language: int, most_rows: int = MOST_ROWS) -> DataFrame:
    """``lang``, ``features``: a bounded sample of labelled rows with a letter in the text.

    Of each language the ``per_language`` rows whose doc_id hashes lowest, or fewer when there are so
    many languages that all rows would be more than ``most_rows``. Each language that any row with a
    letter has gets a row at least: rows without a letter are neither counted nor drawn.
    """
    named = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER))
    named = named.select("doc_id", "lang", "text")
    kept = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    per_language = max(1, min(per_language, most_rows // max(1, kept.count())))
    # Three times the wanted rows pass a bound on the hash, so few rows are measured and ranked.
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    best = Window.partitionBy("lang").orderBy("drawn", "doc_id", "features")

    @F.pandas_udf("binary")
    def lanes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda text: ngram_lanes(text.encode()).tobytes())
        give_back()

    return (
        named.withColumn("drawn", drawn)
        .join(F.broadcast(kept), "lang")  # one row per language
        .where(F.col("drawn") < F.lit(3.0 * per_language + 12) / F.col("n"))
        .select("doc_id", "lang", "drawn", lanes("text").alias("features"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= per_language)
        .select("lang", "features")
    )


def is_held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text leaves 2 when divided by 4; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(
    docs: DataFrame, per_language: int = 400, most_rows: int = MOST_ROWS, bounded: bool = False
) -> Codes | None:
    """Codes fitted to a sample of ``docs``, or None when no row has a language and a letter.

    The driver gets at most ``most_rows`` rows of 16 kB, or one per language if these are more.
    ``bounded`` codes also know how far from all codewords a text is in no learned language.
    """
    rows = training_rows(docs, per_language, most_rows).collect()
    if not rows:
        return None
    # In an order of their own, so that halves do not depend on the layout.
    rows = sorted((row["lang"], bytes(row["features"])) for row in rows) if bounded else rows
    labels = [row[0] for row in rows]
    features = np.stack([np.frombuffer(row[1], np.float32) for row in rows])
    codes = fit_codes(features, labels)
    if bounded:
        codes.farthest = farthest(features, labels)
    return codes


def in_a_language(docs: DataFrame, codes: Codes | None, least_lead: float = 0.1) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, by the decoder's verdict.

    Null texts and those without a letter go, and so do ambiguous ones and those farther from all
    codewords than ``codes.farthest``, of LEAST_BYTES at least: less text is too little for a
    distance. Without codes every text with a letter stays.
    """
    if codes is None:
        return docs.where(F.coalesce(F.col("text").rlike(HAS_LETTER), F.lit(False)))
    plain = (codes.languages, codes.code, codes.weights, codes.bias, codes.trust)
    sent = docs.sparkSession.sparkContext.broadcast((plain, float(codes.farthest)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bound = sent.value
        for batch in batches:
            for part in runs(batch, RUN_BYTES):
                stays = np.array(
                    [t is not None and any(map(str.isalpha, t)) for t in column(part, "text").to_pylist()],
                    bool,
                )
                if stays.any():
                    texts = text_bytes(part).filter(pa.array(stays)).to_pylist()
                    _, _, lead, distance = decode(model, np.stack([ngram_lanes(t) for t in texts]))
                    long = np.array([len(t) >= LEAST_BYTES for t in texts])
                    stays[stays] = (lead >= least_lead) & ~(long & (distance > bound))
                yield part.filter(pa.array(stays, pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def identified(docs: DataFrame, codes: Codes | None, least_lead: float = 0.1) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``ambiguous``, in place: no shuffle.

    Null texts and those without a letter are `und` with score 0, as is every text when there are no
    codes. ``ambiguous`` marks a lead of less than ``least_lead`` over the second language. Only the
    text is looked at. Input columns with one of the three names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "ambiguous")
    plain = (
        None
        if codes is None
        else (codes.languages, codes.code, codes.weights, codes.bias, codes.trust)
    )
    sent = docs.sparkSession.sparkContext.broadcast(plain)
    schema = T.StructType(list(docs.schema.fields))
    schema = schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in runs(batch, RUN_BYTES):
                known = [
                    model is not None and text is not None and any(map(str.isalpha, text))
                    for text in column(part, "text").to_pylist()
                ]
                names = np.full(part.num_rows, UNKNOWN, object)
                score, lead = np.zeros(part.num_rows), np.zeros(part.num_rows)
                if any(known):
                    texts = text_bytes(part).filter(pa.array(known)).to_pylist()
                    found, share, ahead, _ = decode(model, np.stack([ngram_lanes(t) for t in texts]))
                    names[known] = np.array(model[0], object)[found]
                    score[known], lead[known] = share, ahead
                added = [
                    pa.array(names, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(np.array(known) & (lead < least_lead), pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *added],
                    names=[*part.schema.names, "lang_pred", "score", "ambiguous"],
                )
        give_back()

    return docs.mapInArrow(run, schema)
