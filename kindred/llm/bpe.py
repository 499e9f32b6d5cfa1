"""Byte-level BPE with the tokenizers library: encoding with offsets, decoding.

Texts reach Python in Arrow batches. A text is cut where a piece of the pattern
must begin anyway (at a blank behind a character that is not white space), and
pieces that were seen before are looked up: a worker encodes each frequent word
once. What is not known goes piece by piece through the library's BPE model,
with every byte written as the character that stands for it in the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

#: Words behind a blank and other pieces that a worker remembers at most (about
#: 200 bytes each), and the longest it remembers; the rest is encoded each time.
REMEMBERED = 1_000_000
REMEMBERED_PIECES = 300_000
REMEMBERED_CHARS = 48

_BLANK_BEHIND_SPACE = re.compile(r"\s ")
_SAFE_BLANK = re.compile(r"(?<=\S) ")


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself where it is printable
    Latin-1, else the next code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


_CHARS = byte_chars()
#: For str.translate over a text that was decoded as Latin-1.
_TO_CHARS = dict(enumerate(_CHARS))
_TO_BYTES = {ord(c): b for b, c in enumerate(_CHARS)}


def as_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARS)


def as_bytes(token: str) -> bytes:
    return token.translate(_TO_BYTES).encode("latin-1")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """Every pair of tokens whose concatenation is a token, by the rank of the
    latter: with these the model merges what a table of ranks merges."""
    merges = []
    for token in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((as_chars(token[:cut]), as_chars(token[cut:])))
    return merges


class ByteBpe:
    """Encoder and decoder of one vocabulary.

    ``model`` is a BPE model of the tokenizers library over byte characters,
    ``tokens`` the bytes of each id, ``pattern`` splits texts into pieces, ``added``
    has the ids of tokens that ``encode_with_added`` takes as a whole.
    """

    def __init__(self, model: models.BPE, tokens: dict[int, bytes], pattern: str, added: dict[str, int] | None = None):
        self.model = model
        self.tokens = tokens
        self.pattern = regex.compile(pattern)
        self._behind_blank: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self.added = {content: array("I", [i]).tobytes() for content, i in (added or {}).items()}
        # of tokens that begin at one place the longest counts
        longest_first = sorted(self.added, key=len, reverse=True)
        self._added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.added else None
        size = max(tokens, default=-1) + 1
        self._lengths = np.zeros(size, np.int64)
        for i, token in tokens.items():
            self._lengths[i] = len(token)

    @classmethod
    def from_ranks(cls, path: str, pattern: str) -> ByteBpe:
        ranks = read_ranks(path)
        vocab = {as_chars(token): rank for token, rank in ranks.items()}
        model = models.BPE(vocab=vocab, merges=merges_of(ranks), ignore_merges=True)
        return cls(model, {rank: token for token, rank in ranks.items()}, pattern)

    @classmethod
    def from_json(cls, path: str, pattern: str) -> ByteBpe:
        """The model of a tokenizer file; its special tokens are no text for ``encode``."""
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        parts, special = described["model"], {t["id"] for t in described["added_tokens"] if t["special"]}
        if any(t.get(flag) for t in described["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that take blanks or whole words only are not supported")
        if described.get("normalizer"):
            raise ValueError(f"{path}: normalizers are not supported")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["merges"]]
        model = models.BPE(vocab=parts["vocab"], merges=merges, ignore_merges=parts.get("ignore_merges", False))
        tokens = {i: as_bytes(t) for t, i in parts["vocab"].items() if i not in special}
        return cls(model, tokens, pattern, {t["content"]: t["id"] for t in described["added_tokens"]})

    def _encoded(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(as_chars(piece.encode()))]).tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self._pieces.get(piece)
        if found is None:
            found = self._encoded(piece)
            if len(self._pieces) < REMEMBERED_PIECES and len(piece) <= REMEMBERED_CHARS:
                self._pieces[piece] = found
        return found

    def _pieces_of(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.pattern.findall(text)))

    def _behind(self, part: str) -> bytes:
        """The ids of a blank and ``part``."""
        if part.isalpha():  # one piece of letters
            return self._pieces.get(" " + part) or self._encoded(" " + part)
        word, last = part[:-1], part[-1:]
        if word.isalpha() and last in ",.":  # two pieces
            return (self._behind_blank.get(word) or self._piece(" " + word)) + self._piece(last)
        return self._pieces_of(" " + part)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = _SAFE_BLANK.split(text) if _BLANK_BEHIND_SPACE.search(text) else text.split(" ")
        known = self._behind_blank
        out = [self._pieces_of(parts[0]), *map(known.get, parts[1:])]
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    part = parts[i]
                    out[i] = ids = known.get(part) or self._behind(part)
                    if len(known) < REMEMBERED and len(part) <= REMEMBERED_CHARS:
                        known[part] = ids
        return b"".join(out)

    def encode_with_added(self, text: str) -> bytes:
        """As ``encode``, but the file's added tokens are recognised in the text."""
        if self._added is None:
            return self.encode(text)
        parts = self._added.split(text)
        # texts stand at even places, the added tokens between them at odd ones
        return b"".join(self.added[part] if i % 2 else self.encode(part) for i, part in enumerate(parts))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids; a character may be split over several of them,
        so bytes are joined before anybody decodes characters."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def decode_text(self, ids: np.ndarray) -> str:
        return self.decode(ids).decode("utf-8", errors="replace")

    def offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        """(n, 2) code point ranges of the tokens in the text. A token that holds
        part of a character covers the whole character."""
        data = np.frombuffer(text.encode(), np.uint8)
        # code points begun up to and including each byte
        begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        ends = np.cumsum(self._lengths[ids])
        starts = ends - self._lengths[ids]
        return np.stack([np.maximum(begun[np.minimum(starts + 1, len(data))] - 1, 0), begun[ends]], axis=1)


@lru_cache(maxsize=4)
def load_ranks(path: str, pattern: str) -> ByteBpe:
    """Loaded once per worker process."""
    return ByteBpe.from_ranks(path, pattern)


@lru_cache(maxsize=4)
def load_json(path: str, pattern: str) -> ByteBpe:
    return ByteBpe.from_json(path, pattern)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text.

    Row-local. Defined cases: a null text is an empty one with no tokens; ids
    may be null or repeated; an empty table gives no rows; other columns are not
    read.
    """

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load_ranks(ranks_path, pattern)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                data = bpe.encode(text or "")
                ids = np.frombuffer(data, "<u4")
                rows.append((len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(encoded, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and offsets (flat array: start and end of each token in code points)."""

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load_ranks(ranks_path, pattern)
        for batch in batches:
            ids = [np.frombuffer(bpe.encode(text or ""), "<u4") for text in batch["text"]]
            offsets = [bpe.offsets(text or "", i).ravel().astype("int32") for text, i in zip(batch["text"], ids)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [i.astype("int32") for i in ids], "offsets": offsets})

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(encoded, "doc_id bigint, ids array<int>, offsets array<int>")


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows of doc_id and ids."""

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load_ranks(ranks_path, pattern)
        for batch in batches:
            texts = [bpe.decode_text(np.asarray(i)) if i is not None else "" for i in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": texts})

    return encoded.select("doc_id", "ids").mapInPandas(decoded, "doc_id bigint, text string")
