"""Two tokenizers over the same texts: groups of tokens that cover the same bytes.

Tokens of both sides are ranges of bytes. Every token points to the farthest-right
token that overlaps it: of the other side where that one ends later (or at the same
byte, for the first tokenizer's), else to itself. Doubling the pointers of all tokens
at once until they stand still leaves each at the last token of its component, which
names the group. The number of doublings is the logarithm of the longest chain.

Texts reach Python in Arrow batches and are worked on in chunks of bounded size;
longer ones are cut at a blank behind other text, where both tokenizers begin a
token. What is kept of a document are its distinct pairs of linked ids with the
number of times each is linked, in one row. Counts over the corpus, the best partner of an
id and the sums of a document are joins and groupings of these.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.bpe import ByteBpe, load_json
from kindred.operators.sizes import MAX_NARROW_ROWS, shipped
from kindred.session import materialize

#: Characters of text worked on at once, and of a piece of a longer text.
CHUNK_CHARS = 1 << 20
#: Distinct pairs of ids in one row, and the product of a group's sizes from which its ids are counted first.
ROW_PAIRS = 1 << 20
WIDE_GROUP = 4_096
#: Words that a worker remembers, and the longest of them.
REMEMBERED = 1_000_000
REMEMBERED_CHARS = 48

_BEHIND_TEXT = re.compile(r"(?<=\S) ")
_WORD = re.compile(r" *[^ ]+| +$")
_SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

STORED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "own boolean, whole boolean, codes array<bigint>, times array<bigint>"
)


class PieceModel:
    """A sentencepiece model whose pieces hold a blank at their beginning only, so
    that words behind blanks can be encoded one by one and remembered."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        if any(_SPACE in piece.lstrip(_SPACE) for piece in pieces):
            raise ValueError(f"{path}: pieces with a blank behind other text are not supported")
        self.blank = array("I", [self.model.piece_to_id(_SPACE)]).tobytes()
        self.tokens = [self._bytes(piece) for piece in pieces]
        self._words: dict[str, bytes] = {}

    @staticmethod
    def _bytes(piece: str) -> bytes:
        byte = _BYTE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE, " ").encode()

    def _word(self, word: str) -> bytes:
        """Ids of a blank and ``word``."""
        found = self._words.get(word)
        if found is None:
            found = array("I", self.model.encode(word)).tobytes() if word else self.blank
            if len(self._words) < REMEMBERED and len(word) <= REMEMBERED_CHARS:
                self._words[word] = found
        return found

    def encode(self, text: str, *, rest: bool = False) -> bytes:
        """Ids of a blank and ``text`` as little-endian unsigned 32-bit integers;
        with ``rest`` of ``text`` alone, which begins with a blank."""
        if not rest:
            text = " " + text
        if "  " in text or text[-1] == " ":
            return b"".join(self._word(word[1:]) for word in _WORD.findall(text))
        words = text.split(" ")[1:]
        out = list(map(self._words.get, words))
        if None in out:
            out = [self._word(word) if ids is None else ids for word, ids in zip(words, out)]
        return b"".join(out)


@lru_cache(maxsize=2)
def load_pieces(path: str) -> PieceModel:
    return PieceModel(path)


class _Side:
    """Lengths, bytes and decimal digits of a vocabulary's ids."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        shown = [str(i).encode() for i in range(len(tokens))]
        self.width = np.array([len(s) for s in shown], np.int64)
        self.digits = np.zeros((len(tokens), int(self.width.max()) + 1), np.uint8)
        for i, s in enumerate(shown):
            self.digits[i, : len(s)] = np.frombuffer(s, np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class Aligner:
    """Both vocabularies; loaded once per worker."""

    def __init__(self, a_path: str, pattern: str, b_path: str):
        self.a_model: ByteBpe = load_json(a_path, pattern)
        self.b_model = load_pieces(b_path)
        last = max(self.a_model.tokens)
        self.a = _Side([self.a_model.tokens.get(i, b"") for i in range(last + 1)])
        self.b = _Side(self.b_model.tokens)

    def pieces(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides for the text in pieces, None where their bytes are not the text's."""
        lo = 0
        while lo < len(text) or lo == 0:
            cut = _BEHIND_TEXT.search(text, lo + CHUNK_CHARS) if len(text) - lo > CHUNK_CHARS else None
            hi = cut.start() if cut else len(text)
            part = text[lo:hi] if lo else " " + text[:hi]
            a = np.frombuffer(self.a_model.encode(part), "<u4").astype(np.int64)
            b = np.frombuffer(self.b_model.encode(part, rest=True), "<u4").astype(np.int64)
            data = part.encode()
            yield (a, b) if self.a.joined(a) == data and self.b.joined(b) == data else None
            lo = hi

    def ids(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray]]:
        """All pieces of a text; none if it has no tokens by definition."""
        if not text or _SPACE in text:
            return []
        out = []
        for piece in self.pieces(text):
            if piece is None:
                return []
            out.append(piece)
        return out


@lru_cache(maxsize=2)
def load_aligner(a_path: str, pattern: str, b_path: str) -> Aligner:
    return Aligner(a_path, pattern, b_path)


def group_labels(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of both sides, numbered from the left, and their
    number. Both sides cover the same bytes without gaps, no token is empty."""
    a_end, b_end = np.cumsum(a_lengths), np.cumsum(b_lengths)
    n_a = len(a_end)
    # the last token of the other side that begins before a token's end
    over_a = np.searchsorted(b_end - b_lengths, a_end, "left") - 1
    over_b = np.searchsorted(a_end - a_lengths, b_end, "left") - 1
    own = n_a + np.arange(len(b_end))
    to = np.concatenate([n_a + over_a, np.where(a_end[over_b] > b_end, over_b, own)])
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            break
        to = farther
    last = to[n_a:] == own
    number = np.cumsum(last) - 1
    return number[to[:n_a] - n_a], number[to[n_a:] - n_a], int(last.sum())


class Groups:
    """Groups of a run of whole documents (or of a piece of one)."""

    def __init__(self, aligner: Aligner, pieces: list[tuple[np.ndarray, np.ndarray]]):
        self.aligner = aligner
        self.a = np.concatenate([a for a, _ in pieces])
        self.b = np.concatenate([b for _, b in pieces])
        self.n_a = np.array([len(a) for a, _ in pieces])
        self.n_b = np.array([len(b) for _, b in pieces])
        self.of_a, self.of_b, self.n = group_labels(aligner.a.lengths[self.a], aligner.b.lengths[self.b])
        self.size_a = np.bincount(self.of_a, minlength=self.n)
        self.size_b = np.bincount(self.of_b, minlength=self.n)
        self.first_a = np.concatenate([[0], np.cumsum(self.size_a)])
        self.first_b = np.concatenate([[0], np.cumsum(self.size_b)])
        #: first group of each document, and the end
        self.edges = np.searchsorted(self.first_a, np.concatenate([[0], np.cumsum(self.n_a)]))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Groups and links of each document."""
        links = np.concatenate([[0], np.cumsum(self.size_a * self.size_b)])
        return np.diff(self.edges), np.diff(links[self.edges])

    def listings(self) -> Iterator[bytes]:
        """a1,a2|b1;a3|b2,b3 of each document."""
        a, b = self.aligner.a, self.aligner.b
        n = len(self.a) + len(self.b)
        at_a = np.arange(len(self.a)) + self.first_b[self.of_a]
        at_b = np.arange(len(self.b)) + self.first_a[self.of_b + 1]
        wide = max(a.digits.shape[1], b.digits.shape[1])
        shown = np.zeros((n, wide), np.uint8)
        width = np.zeros(n, np.int64)
        for side, ids, at in ((a, self.a, at_a), (b, self.b, at_b)):
            shown[at, : side.digits.shape[1]] = side.digits[ids]
            width[at] = side.width[ids]
        mark = np.full(n, ord(","), np.uint8)
        mark[at_a[self.first_a[1:] - 1]] = ord("|")
        mark[at_b[self.first_b[1:] - 1]] = ord(";")
        shown[np.arange(n), width] = mark
        flat = shown[np.arange(wide) <= width[:, None]]
        ends = np.concatenate([[0], np.cumsum(width + 1)])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])]
        for lo, hi in zip(ends, ends[1:]):
            yield flat[lo : hi - 1].tobytes()

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """document, code (a times the second vocabulary's size, and b), times: each
        distinct pair of linked ids, in portions whose pairs differ; by document and code.
        Where many are to be expected, a portion takes a range of the first side's ids."""
        n_codes = len(self.aligner.a.tokens) * len(self.aligner.b.tokens)
        many = self.size_a * self.size_b > WIDE_GROUP
        wide = [self._counted(g) for g in np.nonzero(many)[0]]
        expected = int((self.size_a * self.size_b)[~many].sum()) + sum(len(a) * len(b) for _, a, _, b, _ in wide)
        for lo, hi in self._id_ranges(expected, wide):
            take = ~many[self.of_a] & (self.a >= lo) & (self.a < hi)
            at = np.nonzero(take)[0]
            repeat = self.size_b[self.of_a[at]]
            begun = np.repeat(np.cumsum(repeat) - repeat, repeat)
            b = self.b[np.repeat(self.first_b[self.of_a[at]], repeat) + np.arange(len(begun)) - begun]
            doc = np.searchsorted(self.edges, self.of_a[at], "right") - 1
            keys = [np.repeat(doc * n_codes + self.a[at] * len(self.aligner.b.tokens), repeat) + b]
            times = [np.ones(len(b), np.int64)]
            for g, ids_a, n_a, ids_b, n_b in wide:
                inside = (ids_a >= lo) & (ids_a < hi)
                base = (np.searchsorted(self.edges, g, "right") - 1) * n_codes
                keys.append((base + ids_a[inside, None] * len(self.aligner.b.tokens) + ids_b).ravel())
                times.append((n_a[inside, None] * n_b).ravel())
            keys, times = np.concatenate(keys), np.concatenate(times)
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            starts = np.nonzero(np.diff(keys, prepend=-1))[0]
            if len(starts):
                yield keys[starts] // n_codes, keys[starts] % n_codes, np.add.reduceat(times, starts)

    def _counted(self, g: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids_a, n_a = np.unique(self.a[self.first_a[g] : self.first_a[g + 1]], return_counts=True)
        ids_b, n_b = np.unique(self.b[self.first_b[g] : self.first_b[g + 1]], return_counts=True)
        return int(g), ids_a, n_a, ids_b, n_b

    def _id_ranges(self, expected: int, wide: list) -> Iterator[tuple[int, int]]:
        end = len(self.aligner.a.tokens)
        if expected <= 4 * ROW_PAIRS or not wide:
            yield 0, end
            return
        # pairs that begin with each id, at most
        load = np.bincount(self.a, weights=self.size_b[self.of_a], minlength=end)
        for _, ids_a, n_a, ids_b, _ in wide:
            load[ids_a] += len(ids_b)
        portion = (np.cumsum(load) // (4 * ROW_PAIRS)).astype(np.int64)
        starts = np.nonzero(np.diff(portion, prepend=-1))[0]
        yield from zip(starts.tolist(), [*starts[1:].tolist(), end])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 6 + [pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [field.split()[0] for field in STORED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def aligned(docs: DataFrame, a_path: str, pattern: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """STORED: a row per document (``own``) with its numbers, the digest of its groups
    and its pairs. Where these are not ``whole``, there are further rows of the same
    ``row`` without numbers, where a pair may come again."""

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load_aligner(a_path, pattern, b_path)
        row = TaskContext.get().partitionId() << 40
        waiting: list[tuple[int, int | None, tuple]] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                row += 1
                pieces = aligner.ids(text.as_py())
                if not pieces:
                    yield _rows([(row, doc_id, 0, 0, 0, 0, "", True, True, [], [])])
                elif len(pieces) > 1:
                    yield from map(_rows, _long(aligner, row, doc_id, pieces))
                else:
                    waiting.append((row, doc_id, pieces[0]))
                    size += len(text.as_py())
                if size >= CHUNK_CHARS:
                    yield from map(_rows, _short(aligner, waiting))
                    waiting, size = [], 0
        if waiting:
            yield from map(_rows, _short(aligner, waiting))

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(worked, STORED)


def _short(aligner: Aligner, waiting: list) -> Iterator[list[tuple]]:
    """Rows of documents of one piece each."""
    groups = Groups(aligner, [piece for _, _, piece in waiting])
    n_groups, n_links = groups.counts()
    digests = [hashlib.sha256(listing).hexdigest() for listing in groups.listings()]
    portions = groups.pairs()
    doc, code, times = next(portions)
    more = next(portions, None)
    edges = np.searchsorted(doc, np.arange(len(waiting) + 1))
    out = []
    for i, (row, doc_id, (a, b)) in enumerate(waiting):
        pair = slice(edges[i], edges[i + 1])
        out.append((row, doc_id, len(a), len(b), int(n_groups[i]), int(n_links[i]), digests[i], True, more is None, code[pair], times[pair]))
    yield out
    while more is not None:
        yield _pair_rows([row for row, _, _ in waiting], *more)
        more = next(portions, None)


def _pair_rows(rows: list[int], doc: np.ndarray, code: np.ndarray, times: np.ndarray) -> list[tuple]:
    out = []
    for i, row in enumerate(rows):
        lo, hi = np.searchsorted(doc, [i, i + 1])
        for s in range(lo, hi, ROW_PAIRS):
            part = slice(s, min(s + ROW_PAIRS, hi))
            out.append((row, None, 0, 0, 0, 0, "", False, False, code[part], times[part]))
    return out


def _long(aligner: Aligner, row: int, doc_id: int | None, pieces: list) -> Iterator[list[tuple]]:
    """Rows of a document of several pieces: pairs piece by piece, the document's own row last."""
    digest, n_groups, n_links = hashlib.sha256(), 0, 0
    for i, piece in enumerate(pieces):
        groups = Groups(aligner, [piece])
        digest.update((b";" if i else b"") + next(groups.listings()))
        here = groups.counts()
        n_groups, n_links = n_groups + int(here[0][0]), n_links + int(here[1][0])
        for portion in groups.pairs():
            yield _pair_rows([row], *portion)
    n_a, n_b = (sum(len(piece[side]) for piece in pieces) for side in (0, 1))
    yield [(row, doc_id, n_a, n_b, n_groups, n_links, digest.hexdigest(), True, False, [], [])]


def _links(stored: DataFrame) -> DataFrame:
    """row, code, n: distinct linked pairs of each document."""

    def listed(rows: DataFrame) -> DataFrame:
        pair = F.explode(F.arrays_zip("codes", "times"))
        return rows.select("row", pair.alias("p")).select("row", F.col("p.codes").alias("code"), F.col("p.times").alias("n"))

    cut = listed(stored.filter(~F.col("whole"))).groupBy("row", "code").agg(F.sum("n").alias("n"))
    return listed(stored.filter("whole")).unionByName(cut)


def align_tokenizers(
    docs: DataFrame,
    a_path: str,
    pattern: str,
    b_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shipped_pairs: int = MAX_NARROW_ROWS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    The counts of pairs are shipped to the tasks while they are at most
    ``shipped_pairs`` rows; beyond it links and counts are joined by a shuffle.

    Defined cases: texts that are null or empty, or whose joined tokens of either
    side are not a blank and the text, have no tokens: zeros and an empty
    ``groups_sha256``. Repeated rows are documents of their own, each counts. Ids
    may be null. An empty table gives no rows. Other columns are not read. A text
    is cut into pieces at blanks; without any it is worked on as a whole.
    """
    stored = materialize(aligned(docs, a_path, pattern, b_path, id_col=id_col, text_col=text_col), "aligned")
    n_b_ids = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    links = _links(stored)
    first_id = F.expr(f"code div {n_b_ids}")
    counts = materialize(links.groupBy("code").agg(F.count(F.lit(1)).alias("n_docs")), "counts")
    best = counts.groupBy(first_id.alias("a")).agg(F.max("n_docs").alias("most"))
    best = F.broadcast(best)  # a row per id of the first vocabulary at most
    judged = counts.join(best, first_id == best.a).select("code", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))
    judged = materialize(judged, "judged")
    scored = links.join(shipped(judged, judged.count(), shipped_pairs), "code").groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(F.lit(0))).alias("n_best"), F.sum(F.col("n") * F.col("n_docs")).alias("count_sum")
    )
    own = stored.filter("own").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("bigint")
    return own.join(scored, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
