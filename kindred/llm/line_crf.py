"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad from features of itself and of
the lines next to it; labels of neighbouring lines depend on each other. The
field is trained on a bounded sample of labelled documents, whose lines take the
document's label. A document's quality is the mean of its lines' forward-backward
marginals, weighted by length and calibrated on the same sample. Scoring is
row-local: batches of documents run through the field together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that the field is fitted on at most, and lines of each.
TRAINING_DOCUMENTS = 4_000
TRAINING_LINES = 200
STEPS = 80

_CLASSES = 9
_UPPER, _LOWER, _DIGIT, _BLANK, _SYMBOL, _MARK, _POINT, _OTHER, _WIDE = range(_CLASSES)


def _byte_classes() -> np.ndarray:
    classes = np.full(256, _OTHER, np.uint8)
    classes[128:] = _WIDE
    for name, members in (
        (_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (_LOWER, b"abcdefghijklmnopqrstuvwxyz"),
        (_DIGIT, b"0123456789"),
        (_BLANK, b" \t\n\x0b\x0c\r"),
        (_SYMBOL, b"#*$%&|<>"),
        (_MARK, b"!?"),
        (_POINT, b".,;:"),
    ):
        classes[list(members)] = name
    return classes


_CLASS_OF = _byte_classes()


@dataclass
class Lines:
    """The lines of some documents: features (lines x numbers), bytes per line,
    and per document the number of its lines (one after the other)."""

    features: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray


def lines_of(texts: list[str]) -> Lines:
    raw: list[bytes] = []
    counts, again, variety = [], [], []
    for text in texts:
        own = [line for line in text.encode().split(b"\n") if line and not line.isspace()]
        seen: set[bytes] = set()
        for line in own:
            again.append(line in seen)
            seen.add(line)
            words = line.split()
            variety.append(len(set(words)) / len(words) if len(words) > 12 else 1.0)
        counts.append(len(own))
        raw += own
    lengths = np.array([len(line) for line in raw], np.int64)
    if not len(raw):
        return Lines(np.zeros((0, _N_FEATURES)), lengths, np.array(counts, np.int64))
    data = _CLASS_OF[np.frombuffer(b"".join(raw), np.uint8)]
    line = np.repeat(np.arange(len(raw)) * _CLASSES, lengths)
    tally = np.bincount(line + data, minlength=len(raw) * _CLASSES).reshape(len(raw), _CLASSES)
    share = tally / lengths[:, None]
    letters = np.maximum(tally[:, _UPPER] + tally[:, _LOWER] + tally[:, _WIDE], 1)
    own = np.stack(
        [
            share[:, _UPPER],
            tally[:, _UPPER] / letters,
            share[:, _DIGIT],
            share[:, _BLANK],
            share[:, _SYMBOL],
            share[:, _MARK],
            share[:, _POINT],
            share[:, _OTHER],
            share[:, _WIDE],
            np.log1p(lengths) / 8,
            np.log1p(lengths / (tally[:, _BLANK] + 1)) / 4,
            np.array(again, float),
            1.0 - np.array(variety),
        ],
        axis=1,
    )
    own = np.concatenate([own, np.sqrt(own), own > 0.02], axis=1)
    # what stands on the lines before and after, in the same document
    counts = np.array(counts, np.int64)
    first = np.zeros(len(raw), bool)
    first[np.cumsum(counts[counts > 0]) - counts[counts > 0]] = True
    last = np.roll(first, -1)
    core = np.concatenate([own[:, :13], np.ones((len(raw), 1))], axis=1)
    before = np.roll(core, 1, axis=0)
    before[first] = 0
    after = np.roll(core, -1, axis=0)
    after[last] = 0
    return Lines(np.concatenate([np.ones((len(raw), 1)), own, before, after], axis=1), lengths, counts)


_N_FEATURES = 1 + 3 * 13 + 2 * 14


def _chain(score: np.ndarray, counts: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals of label 1 per line, expected transitions) of the chains.

    ``score`` is the log odds of each line, ``steps`` the 2 x 2 log potentials of
    neighbouring labels. Chains advance together, the longest first, so a round
    touches only chains that are still running.
    """
    used = np.flatnonzero(counts)
    used = used[np.argsort(-counts[used], kind="stable")]
    n = counts[used]
    start = (np.cumsum(counts) - counts)[used]
    marginal = np.zeros(len(score))
    expected = np.zeros((2, 2))
    if not len(used):
        return marginal, expected
    alpha = np.zeros((len(score), 2))
    beta = np.zeros((len(score), 2))
    longest = int(n[0])
    active = [int(np.searchsorted(-n, -t, side="left")) for t in range(longest + 1)]  # chains with more than t lines
    for t in range(longest):
        at = start[: active[t]] + t
        own = np.stack([np.zeros(len(at)), score[at]], axis=1)
        if t:
            own += np.logaddexp(alpha[at - 1, 0, None] + steps[0], alpha[at - 1, 1, None] + steps[1])
        alpha[at] = own - np.logaddexp(own[:, 0], own[:, 1])[:, None]
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        follow = beta[at + 1] + np.stack([np.zeros(len(at)), score[at + 1]], axis=1)
        own = np.stack([np.logaddexp(steps[i, 0] + follow[:, 0], steps[i, 1] + follow[:, 1]) for i in (0, 1)], axis=1)
        beta[at] = own - np.logaddexp(own[:, 0], own[:, 1])[:, None]
        pair = alpha[at][:, :, None] + steps[None] + follow[:, None, :]
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
        expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = alpha + beta
    marginal = np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))
    return marginal, expected


def _document_means(marginal: np.ndarray, lines: Lines) -> np.ndarray:
    """Mean marginal by length; 0.5 for documents without lines."""
    doc = np.repeat(np.arange(len(lines.counts)), lines.counts)
    weight = np.bincount(doc, lines.lengths, len(lines.counts))
    total = np.bincount(doc, lines.lengths * marginal, len(lines.counts))
    return np.where(weight > 0, total / np.maximum(weight, 1), 0.5)


def _evidence(means: np.ndarray, counts: np.ndarray) -> np.ndarray:
    clipped = np.clip(means, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(means)), np.log(clipped / (1 - clipped)), counts == 0], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass
class LineField:
    weights: np.ndarray
    steps: np.ndarray
    calibration: np.ndarray

    @classmethod
    def fit(cls, lines: Lines, labels: np.ndarray) -> LineField:
        """Penalised maximum likelihood by Adam steps, then a logistic calibration of document means."""
        n_docs = max(1, len(labels))
        y = np.repeat(labels, lines.counts).astype(float)
        doc = np.repeat(np.arange(len(labels)), lines.counts)
        same = doc[1:] == doc[:-1]
        observed = np.zeros((2, 2))
        np.add.at(observed, (y[:-1][same].astype(int), y[1:][same].astype(int)), 1)
        x = lines.features
        theta = np.zeros(x.shape[1] + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, STEPS + 1):
            marginal, expected = _chain(x @ theta[:-4], lines.counts, theta[-4:].reshape(2, 2))
            grad = np.concatenate([x.T @ (y - marginal), (observed - expected).ravel()]) / n_docs - 1e-3 * theta
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad**2
            theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        field = cls(theta[:-4], theta[-4:].reshape(2, 2), np.zeros(3))
        z = _evidence(field.means(lines), lines.counts)
        c = np.zeros(3)
        for _ in range(25):  # Newton steps
            p = _sigmoid(z @ c)
            hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * n_docs / 100 * np.eye(3)
            c += np.linalg.solve(hessian, z.T @ (labels - p) - 1e-2 * n_docs / 100 * c)
        field.calibration = c
        return field

    def means(self, lines: Lines) -> np.ndarray:
        marginal, _ = _chain(lines.features @ self.weights, lines.counts, self.steps)
        return _document_means(marginal, lines)

    def scores(self, texts: list[str]) -> np.ndarray:
        lines = lines_of(texts)
        return _sigmoid(_evidence(self.means(lines), lines.counts) @ self.calibration)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _window(text: str, n_lines: int) -> slice:
    """The lines of a text that are trained on."""
    start = zlib.crc32(text.encode()) % (n_lines - TRAINING_LINES + 1) if n_lines > TRAINING_LINES else 0
    return slice(start, start + TRAINING_LINES)


def fit_field(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> LineField:
    """The field of at most ``TRAINING_DOCUMENTS`` labelled rows outside the held-out
    part, taken by a hash of their ids. Of a text with more than ``TRAINING_LINES`` lines
    a window of so many counts, whose place follows from a hash of the text; the features
    of its lines are those in the whole text.

    Repeated labels of an id count as one, good only if all are good. Without
    labels the field is even: every score is 0.5.
    """
    known = (
        labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & ~is_held_out(F.col(id_col)))
        .groupBy(F.col(id_col).cast("bigint").alias("doc_id"))
        .agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_DOCUMENTS)
    )

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [lines_of([text or ""]) for text in batch["text"]]
            windows = [_window(text or "", len(p.lengths)) for text, p in zip(batch["text"], parts)]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "features": [p.features[w].astype("<f4").tobytes() for p, w in zip(parts, windows)],
                    "lengths": [p.lengths[w].astype("<i4").tobytes() for p, w in zip(parts, windows)],
                }
            )

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # at most TRAINING_DOCUMENTS narrow rows are sent out, and as many documents' lines come back
    chosen = narrow.join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
    rows = (
        chosen.mapInPandas(described, "doc_id bigint, label int, features binary, lengths binary")
        # ids may be repeated: which rows are taken does not depend on the order of tasks
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("features"))
        .limit(TRAINING_DOCUMENTS)
        .toPandas()
        .sort_values(["doc_id", "features"], ignore_index=True)
    )
    if not len(rows):
        return LineField(np.zeros(_N_FEATURES), np.zeros((2, 2)), np.zeros(3))
    lengths = [np.frombuffer(b, "<i4") for b in rows["lengths"]]
    features = np.frombuffer(b"".join(rows["features"]), "<f4").reshape(-1, _N_FEATURES).astype(float)
    lines = Lines(features, np.concatenate(lengths).astype(np.int64), np.array([len(n) for n in lengths], np.int64))
    return LineField.fit(lines, (rows["label"] == 1).to_numpy())


def score_documents(docs: DataFrame, field: LineField, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Row-local. Defined cases: null and empty texts have no lines and get the
    calibrated score of such documents; null ids are not held out; repeated rows
    get equal scores; an empty table gives no rows; other columns are not read.
    """

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [text or "" for text in batch]
            out = np.zeros(len(texts))
            # about as many bytes at once, whatever the texts' lengths
            size, begin = 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size > 2_000_000 or i == len(texts) - 1:
                    out[begin : i + 1] = field.scores(texts[begin : i + 1])
                    size, begin = 0, i + 1
            yield pd.Series(out)

    score = F.pandas_udf(scored, "double")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
