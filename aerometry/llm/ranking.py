"""A quality score learned from preference pairs (Bradley and Terry).

A document's strength is a linear function of its features, and the chance that
one document is better than another is the logistic function of the difference.
Pairs put a document of label 1 before one of label 0; the weights minimise the
logistic loss on feature differences. The cut between keeping and rejecting is a
quantile of the strengths, and the score is the logistic function of the distance
to that cut, scaled so that the cut lies at ``THRESHOLD``.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometry.llm.documents import SPACE, kept, map_texts, sampled, slices, text_bytes

THRESHOLD = 0.3

#: Labelled documents the weights are fitted on, about at most, and pairs made of them.
SAMPLE = 20_000
PAIRS = 40_000

#: Bytes of text whose features are computed at a time; several numbers a byte are held.
BATCH_BYTES = 4 << 20

BINS = 16
PENALTY = 1.0
STEPS = 12

FEATURES = (
    "log_words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "bars",
    "marks",
    "ends",
    "lines",
    "distinct",
    "equal_lines",
    "packed",
    "longest",
)


def _members(characters: str) -> np.ndarray:
    found = np.zeros(256, dtype=np.int32)
    found[list(characters.encode())] = 1
    return found


_COUNTED = {
    "upper": _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digits": _members("0123456789"),
    "symbols": _members("#*$%&<>~^=+\\@_{}[]"),
    "bars": _members("|"),
    "marks": _members(",;:\"'()-"),
    "ends": _members(".!?"),
    "spaces": SPACE.astype(np.int32),
    "begun": (np.arange(256) & 0xC0 != 0x80).astype(np.int32),
}


def features(texts: pa.Array) -> np.ndarray:
    """One row of features per text; a text without words has zeros."""
    data, offsets = text_bytes(texts)
    sums = {}
    for name, members in _COUNTED.items():
        total = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(members[data], out=total[1:])
        sums[name] = np.diff(total[offsets]).astype(np.float64)
    rows = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        text = text.as_py()
        words = text.split()
        if not words:
            continue
        n, chars = len(words), sums["begun"][i] - sums["spaces"][i]
        lines = [line for line in text.split("\n") if line.strip()]
        raw = text.encode()
        rows[i] = (
            np.log1p(n),
            chars / n,
            sums["upper"][i] / max(chars, 1),
            sums["digits"][i] / max(chars, 1),
            sums["symbols"][i] / n,
            sums["bars"][i] / n,
            sums["marks"][i] / n,
            sums["ends"][i] / n,
            len(lines) / n,
            len(set(words)) / n,
            1 - len(set(lines)) / max(len(lines), 1),
            len(zlib.compress(raw, 1)) / len(raw),
            np.log1p(max(map(len, words))),
        )
    return rows


def with_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of every document."""

    def batch(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        rows = pa.array(list(features(texts)), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([ids, rows], ["doc_id", "features"])

    return map_texts(docs, batch, "doc_id long, features array<double>", BATCH_BYTES)


@dataclass(frozen=True)
class Ranking:
    """Weights of the features' bins, the cut and the scale."""

    edges: list[np.ndarray]
    weights: np.ndarray
    cut: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        return binned(rows, self.edges) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, ``THRESHOLD`` at the cut."""
        offset = np.log(THRESHOLD / (1 - THRESHOLD))
        away = np.clip(self.strengths(rows) - self.cut + offset, -500, 500)
        return 1 / (1 + np.exp(-away))


def binned(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Per feature and edge, whether the value lies above the edge."""
    return np.concatenate(
        [(rows[:, j, None] > edge[None, :]) for j, edge in enumerate(edges)], axis=1
    ).astype(np.float32)


def preference_pairs(quality: np.ndarray, most: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Better and worse rows: every row of either label meets others in turn."""
    better, worse = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    count = min(most, len(better) * len(worse))
    if not count:
        return better[:0], worse[:0]
    rng = np.random.default_rng(11)
    turns = lambda rows: np.concatenate(
        [rng.permutation(rows) for _ in range(-(-count // len(rows)))]
    )[:count]
    return turns(better), turns(worse)


def fit(rows: np.ndarray, quality: np.ndarray) -> Ranking:
    """Newton's method on the logistic loss of feature differences.

    The cut is the quantile of the strengths, among all hundredths, that separates the
    labels of the rows best; the lowest of equals. Rows of one label only leave all
    weights zero and every document above the cut.
    """
    shares = np.arange(1, BINS) / BINS
    better, worse = preference_pairs(quality)
    if not len(better):
        return Ranking([np.zeros(0) for _ in FEATURES], np.zeros(0), -1.0)
    edges = [np.unique(np.quantile(column, [0.01, *shares, 0.99])) for column in rows.T]
    indicators = binned(rows, edges)
    weights = np.zeros(indicators.shape[1])
    difference = indicators[better] - indicators[worse]
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(difference @ weights, -50, 50)))
        slope = difference.T @ (1 - chance) - PENALTY * weights
        bend = (difference * (chance * (1 - chance))[:, None].astype(np.float32)).T @ difference
        weights = weights + np.linalg.solve(bend + PENALTY * np.eye(len(weights)), slope)
    strengths = indicators @ weights
    return Ranking(edges, weights, _cut(strengths, quality))


def _cut(strengths: np.ndarray, quality: np.ndarray) -> float:
    """Between two strengths, so that rounding cannot move a document across.

    The hundredth of all rows has none above it and is no cut.
    """
    order = np.argsort(strengths, kind="stable")
    ordered, labels = strengths[order], quality[order] == 1
    below_good = np.concatenate([[0], np.cumsum(labels)])
    best, cut = None, float(ordered[0]) - 1
    for share in np.arange(0, 101) / 100:
        at = int(share * len(ordered))
        while 0 < at < len(ordered) and ordered[at] - ordered[at - 1] < 1e-9:
            at += 1
        if at >= len(ordered):
            continue
        right = (at - below_good[at]) + (labels.sum() - below_good[at])
        if best is None or right > best:
            best = right
            cut = (ordered[at - 1] + ordered[at]) / 2 if at else float(ordered[0]) - 1
    return float(cut)


def held_out() -> Column:
    """Every fifth document by checksum is never learned from."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(checksum, F.lit(5)) == 0, F.lit(False))


SCHEMA = "doc_id long, score double"


def _scored(rows: DataFrame, ranking: Ranking) -> DataFrame:
    def run(batches):
        for batch in batches:
            column = batch.column(1)
            values = np.asarray(column.flatten()).reshape(len(batch), len(FEATURES))
            scores = ranking.scores(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return rows.select("doc_id", "features").mapInArrow(run, SCHEMA)


def usable_marks(labels: DataFrame) -> DataFrame:
    """Distinct (doc_id, quality) of labels to learn from."""
    marks = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("quality").cast("int").alias("quality"),
    )
    return marks.where(F.col("quality").isin(0, 1) & ~held_out()).distinct()


def learn(rows: DataFrame, marks: DataFrame) -> Ranking:
    """The ranking learned from the labelled of ``rows`` (doc_id, features).

    Weights are fitted on about ``SAMPLE`` labelled documents, chosen by checksum.
    """
    labelled = kept(rows.join(marks, "doc_id"), "labelled")
    learned = sampled(labelled, SAMPLE, "doc_id")
    learned.sort(key=lambda row: (row["doc_id"], row["quality"], row["features"]))
    values = np.array([row["features"] for row in learned]).reshape(len(learned), len(FEATURES))
    return fit(values, np.array([row["quality"] for row in learned], dtype=np.int64))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every document.

    One row per input row; null texts count as empty, and empty texts are scored by
    their zero features; repeated rows are scored alike; a document with several
    labels counts once per label, null labels not at all; other columns of ``docs``
    are not read. Without labels of both values everything is kept.
    """
    # Features are computed once and kept as a table in the shared folder.
    rows = kept(with_features(docs), "features")
    ranking = learn(rows, usable_marks(labels))
    return _scored(rows, ranking).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted to be good, all columns as they are.

    Rows are scored where they are read, so that whole texts are not shuffled to
    meet their verdicts. Features are computed ahead for the documents to learn from
    only: about ``SAMPLE`` labelled ones by the same checksum, whose identifiers go to
    all tasks.
    """
    marks = kept(usable_marks(labels), "marks")
    chosen = [(row["doc_id"],) for row in sampled(marks, SAMPLE, "doc_id")]
    chosen = docs.sparkSession.createDataFrame(sorted(set(chosen)), "labelled_id long")
    to_learn = docs.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("labelled_id"), "left_semi"
    )
    ranking = learn(with_features(to_learn), marks)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).fill_null("").cast(pa.large_string())
            good = [
                ranking.scores(features(texts[first:end])) >= THRESHOLD
                for first, end in slices(texts, BATCH_BYTES)
            ]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)
