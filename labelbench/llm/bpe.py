"""Byte-pair encoding by walking the words' prefixes as a trie, and decoding.

The encoding of a word is fixed by the last token of each of its prefixes: a token may end a prefix
when it fits behind the last token of the prefix that it leaves. Distinct words are walked in sorted
order, which is the depth-first order of their trie; the last tokens of a shared prefix are found
once and stay on the path for all words below it.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from labelbench.llm.batches import column, give_back, runs

# How texts fall into words, fixed by the vocabulary's format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 60
# White space other than the space. Where a text has none of it and no two spaces meet, words never
# reach across a space, except that they begin with it.
OTHER_SPACE = "\t\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MARKS = ".,;:!?"
RUN_BYTES = 2 << 20
HELD_CHUNKS = 200_000
HELD_PAIRS = 300_000


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable Latin-1 characters
    for themselves, the others in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level vocabulary file."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        alphabet = byte_alphabet()
        names = parsed["model"]["vocab"]
        tokens = {t: bytes(alphabet[c] for c in t) for t in names}
        self.id_of = {tokens[t]: i for t, i in names.items()}
        self.added = {a["content"]: a["id"] for a in parsed["added_tokens"]}
        named = self.id_of | {t.encode(): i for t, i in self.added.items()}
        self.bytes_of = [b""] * (max(named.values()) + 1)
        for name, i in named.items():
            self.bytes_of[i] = name
        self.rank, self.made = {}, {}
        for rank, pair in enumerate(parsed["model"]["merges"]):
            left, right = (names[t] for t in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = self.id_of[self.bytes_of[left] + self.bytes_of[right]]
            self.rank[left, right] = rank
            self.made.setdefault(whole, (left, right, rank))
        self.longest = max(map(len, self.id_of))
        self.splitter = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.words = regex.compile(WORDS)
        self._edges: dict[int, tuple] = {}
        self._fits: dict[int, bool] = {}

    def _spines(self, token: int) -> tuple[list, list]:
        """The tokens at the right edge and at the left edge while the token is being built: (token,
        rank of the merge that takes it up), from its bytes on."""
        found = self._edges.get(token)
        if found is None:
            found = []
            for side in (1, 0):
                spine, taken, now = [], NEVER, token
                while True:
                    spine.append((now, taken))
                    if now not in self.made:
                        break
                    taken = self.made[now][2]
                    now = self.made[now][side]
                found.append(spine[::-1])
            found = self._edges[token] = tuple(found)
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether the bytes of both, encoded together, give just these two tokens.

        Their edges grow merge by merge in order of rank. They do not fit if at some moment the
        merge across the border comes before the next merge on either side.
        """
        key = left << 20 | right
        known = self._fits.get(key)
        if known is None:
            a, b = self._spines(left)[0], self._spines(right)[1]
            i = j = 0
            while True:
                (x, x_taken), (y, y_taken) = a[i], b[j]
                across = self.rank.get((x, y), NEVER)
                if across < x_taken and across <= y_taken:
                    known = False
                elif x_taken == y_taken == NEVER:
                    known = True
                elif x_taken <= y_taken:
                    i += 1
                    continue
                else:
                    j += 1
                    continue
                break
            self._fits[key] = known
        return known

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """(word, its ids as little-endian 32-bit integers) for sorted distinct words."""
        if len(self._fits) > HELD_PAIRS:
            self._fits.clear()
        id_of, known, longest = self.id_of.get, self._fits.get, self.longest
        before = b""
        last, length = [-1], [0]  # of each prefix on the path: its last token, and its bytes
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], length[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                # Just one token fits, so the order of trying is free: short ones are frequent.
                for start in range(end - 1, max(-1, end - longest - 1), -1):
                    token = id_of(word[start:end])
                    if token is None:
                        continue
                    if start:
                        fit = known(last[start] << 20 | token)
                        if fit is False or (fit is None and not self.fits(last[start], token)):
                            continue
                    last.append(token)
                    length.append(end - start)
                    break
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end -= length[end]
            ids.reverse()
            yield word, struct.pack(f"<{len(ids)}I", *ids)
            before = word

    def pieces(self, text: str) -> list[str]:
        """Words of the text, with added tokens as pieces of their own."""
        if self.splitter is None or not self.splitter.search(text):
            return self.words.findall(text)
        found, at = [], 0
        for match in self.splitter.finditer(text):
            found += self.words.findall(text[at : match.start()])
            found.append(match[0])
            at = match.end()
        return found + self.words.findall(text[at:])

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids, which are little-endian 32-bit integers."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Encoder:
    """Encodes runs of texts; holds the ids of earlier chunks, about ``HELD_CHUNKS`` of them.

    A chunk is what begins at a single space, or a whole text whose words may reach across spaces.
    Chunks are held in two halves: those met since the last turn, and those met in the turn before.
    Frequent chunks are taken over from turn to turn, the others are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.held: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.spaced = any(" " in t for t in vocabulary.added)
        self.marks = [m for m in MARKS if not any(m in t for t in vocabulary.added)]

    def _chunks(self, text: str) -> list[str]:
        if (
            self.spaced
            or "  " in text
            or " \n" in text
            or "\n " in text
            or any(c in text for c in OTHER_SPACE)
        ):
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + chunk for chunk in rest]]

    def _pieces(self, chunk: str) -> list[str]:
        # Letters, with or without a space before them, are one word; a mark behind them is another.
        if chunk.removeprefix(" ").isalpha():
            return [chunk]
        if chunk[-1:] in self.marks and chunk[:-1].removeprefix(" ").isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.vocabulary.pieces(chunk)

    def _unknown(self, wanted: set[str]) -> set[str]:
        """Those of ``wanted`` that are not held; all others are in ``held`` afterwards."""
        held, before = self.held, self.before
        missing = wanted.difference(held)
        known = {chunk: before[chunk] for chunk in missing if chunk in before}
        if len(held) + len(missing) > HELD_CHUNKS // 2:
            known.update((chunk, held[chunk]) for chunk in wanted.intersection(held))
            self.held, self.before = known, held
        else:
            held.update(known)
        return missing.difference(known)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._chunks(text) for text in texts]
        pieces = {chunk: self._pieces(chunk) for chunk in self._unknown(set().union(*split))}
        held = self.held
        words = {word for found in pieces.values() for word in found}
        ids = {t: struct.pack("<I", i) for t, i in self.vocabulary.added.items() if t in words}
        plain = [word.encode() for word in words.difference(ids) if word not in held]
        for word, encoded in self.vocabulary.encode_words(sorted(plain)):
            ids[word.decode()] = encoded
        for chunk, found in pieces.items():
            held[chunk] = b"".join([ids[word] if word in ids else held[word] for word in found])
        return [b"".join(map(held.__getitem__, chunks)) for chunks in split]


def held_encoder(sent: dict) -> Encoder:
    """The encoder of this worker process. It stays with the broadcast value, which a worker keeps
    between tasks, so the vocabulary is parsed once and frequent chunks are known to later tasks."""
    if "encoder" not in sent:
        sent["encoder"] = Encoder(Vocabulary(sent["spec"]))
    return sent["encoder"]


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers), ``decoded``.

    One row per row of ``docs``, in place: no shuffle. Null and empty texts have no ids and decode
    to the empty text. Texts that contain an added token such as an end-of-text mark get its id.
    ``vocabulary_path`` is a byte-level vocabulary file that the driver can read; its content, a few
    MB, is sent to the tasks.
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast({"spec": file.read()})
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held_encoder(sent.value)
        vocabulary = encoder.vocabulary
        for batch in batches:
            for part in runs(batch, RUN_BYTES):
                texts = [text or "" for text in column(part, "text").to_pylist()]
                ids = encoder.encode(texts)
                decoded = [vocabulary.decode(i).decode("utf-8", "replace") for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "doc_id"),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(decoded, pa.string()),
                    ],
                    schema=schema,
                )
        give_back()

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string"
    )
