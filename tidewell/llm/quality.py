"""A quality classifier: ridge regression on random Fourier features, with isotonic calibration."""

from __future__ import annotations


from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.session import settle
from tidewell.llm.common import by_bytes, remainder

# Bytes are counted in these classes; every byte outside ASCII is one class.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:", b"!", b"?", b"|", b"#$%&*@^~",
            b"<>{}[]()=/\\_+-", b"'\"`"]
STATISTICS = len(_CLASSES) + 13
# Random features, their kernel's width in standard deviations, and the ridge
# penalty as a share of the training rows.
FEATURES, WIDTH, RIDGE = 256, 4.0, 1e-3
# Features and labels are rounded to these units, so that all sums are whole
# numbers and do not depend on the order of tasks.
UNIT = 1 << 14
# Raw scores from -0.5 to 1.5 fall in this many bins for calibration.
BINS = 4096




def _class_of_byte() -> np.ndarray:
    table = np.full(256, len(_CLASSES))
    for k, members in enumerate(_CLASSES):
        table[list(members)] = k
    return table


def statistics(text: str | None, class_of_byte: np.ndarray) -> np.ndarray:
    """Shares of byte classes, shapes of words and lines, and repetition in a text; all 0 for an empty one."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(STATISTICS)
    kinds = np.bincount(class_of_byte[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1) / len(raw)
    words = raw.split()
    n = max(1, len(words))
    lengths = np.array([len(w) for w in words] or [0])
    seen = set(words)
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    loud = sum(w.isupper() for w in words)
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
    lines = raw.split(b"\n")
    pairs = list(zip(words, words[1:]))
    own = [
        np.log1p(len(raw)) / 16, np.log1p(len(words)) / 16, min(lengths.mean() / 16, 4), min(lengths.std() / 16, 4), min(np.log1p(lengths.max()) / 8, 4),
        len(seen) / n, doubled / n, loud / n, marked / n, len(set(pairs)) / max(1, len(pairs)),
        len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)) / 12,
    ]
    return np.concatenate([kinds, own])


def document_statistics(docs: DataFrame) -> DataFrame:
    """Replace ``text`` by ``_stats``, the array of its statistics; the other columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _class_of_byte()
        for batch in by_bytes(batches):
            rows = np.stack([statistics(text, classes) for text in batch.column("text").to_pylist()]).astype(np.float32)
            array = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, STATISTICS, np.int32)), pa.array(rows.ravel()))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], array], names=[*kept, "_stats"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, f"{kept}, _stats array<float>")


@dataclass
class Model:
    """What scoring needs: standardisation, random features, their weights and the calibrated steps."""

    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    steps: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features in whole UNITs, the last one constant: products approximate a Gaussian kernel."""
        angles = np.clip((stats - self.mean) / self.scale, -8, 8) @ self.turn + self.shift
        return np.rint(np.concatenate([np.cos(angles), np.ones((len(stats), 1))], axis=1) * UNIT)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights / UNIT

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.steps[bin_of(self.raw(stats))]


def bin_of(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + 0.5) * (BINS / 2)), 0, BINS - 1).astype(int)


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS).astype(float)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each statistic over the training rows; sums are of whole units."""
    def whole(x: Column) -> Column:
        return F.round(x * (1 << 20)).cast("decimal(38,0)")

    one = [F.col("_stats")[k].cast("double") for k in range(STATISTICS)]
    got = rows.agg(F.count("*"), *[F.sum(whole(x)) for x in one], *[F.sum(whole(x * x)) for x in one]).first()
    n = max(1, got[0])
    mean, square = (np.array([float(v or 0) for v in part]) / (n << 20) for part in (got[1:1 + STATISTICS], got[1 + STATISTICS:]))
    return mean, np.sqrt(np.maximum(square - mean * mean, 1e-6))


def _normal_equations(rows: DataFrame, model: Model) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Gram matrix and label products of the features by ``_fold``, summed in partitions first.

    The driver gets one number per pair of features and fold, whatever the rows.
    """
    size = FEATURES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            stats, y, fold = _stats_of(batch), batch.column("_y").to_numpy().astype(float), batch.column("_fold").to_numpy()
            for f in np.unique(fold):
                # whole numbers below 2**53: exact in any order
                x = np.concatenate([model.features(stats[fold == f]), y[fold == f, None] * UNIT], axis=1)
                sums[int(f)] = sums.get(int(f), 0) + (x.T @ x).astype(np.int64)
        for f, gram in sums.items():
            for i in range(size + 1):
                yield pa.RecordBatch.from_arrays([pa.array([f] * (size + 1), pa.int32()), pa.array(i * (size + 1) + np.arange(size + 1)), pa.array(gram[i])], names=["_fold", "_cell", "_sum"])

    cells = rows.select("_stats", "_y", "_fold").mapInArrow(run, "_fold int, _cell long, _sum long")
    found = {}
    for r in cells.groupBy("_fold", "_cell").agg(F.sum(F.col("_sum").cast("decimal(38,0)")).alias("s")).collect():
        found.setdefault(r["_fold"], np.zeros((size + 1) ** 2))[r["_cell"]] = float(r["s"])
    square = {f: v.reshape(size + 1, size + 1) / UNIT**2 for f, v in found.items()}
    return {f: (v[:size, :size], v[:size, size]) for f, v in square.items()}


def _ridge(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    if not parts:
        return np.zeros(FEATURES + 1)
    gram, products = sum(p[0] for p in parts), sum(p[1] for p in parts)
    penalty = RIDGE * gram[-1, -1] * np.eye(len(gram))
    penalty[-1, -1] = 1e-9  # the constant is not held back
    return np.linalg.solve(gram + penalty + 1e-9 * np.eye(len(gram)), products)


def isotonic(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence nearest to ``mean`` by ``weight``; bins without weight take the value before them."""
    blocks: list[list[float]] = []
    for w, m in zip(weight, mean):
        if not w:
            if blocks:
                blocks[-1][2] += 1
            else:
                blocks.append([0.0, m, 1])
            continue
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1] or len(blocks) > 1 and not blocks[-2][0]:
            w2, m2, n2 = blocks.pop()
            w1, m1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2]
    return np.concatenate([np.full(n, m) for _, m, n in blocks])


def fit(rows: DataFrame) -> Model:
    """Learn from all rows of ``_stats, _y, _fold`` (label 0 or 1; fold 0 or 1).

    Ridge weights solve the normal equations of both folds together. The
    calibration sees each fold's scores by the other fold's weights: a
    histogram over BINS raw scores, made monotone. Without rows every score is
    one half.
    """
    mean, scale = _moments(rows)
    random = np.random.default_rng(3)
    turn = random.normal(size=(STATISTICS, FEATURES)) / WIDTH
    model = Model(mean, scale, turn, random.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.full(BINS, 0.5))
    sums = _normal_equations(rows, model)
    if not sums:
        return model
    of_fold = {f: _ridge([s for g, s in sums.items() if g != f] or [sums[f]]) for f in sums}

    def raw_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold = model.features(_stats_of(batch)), batch.column("_fold").to_numpy()
            raw = np.zeros(len(x))
            for f, weights in of_fold.items():
                raw[fold == f] = x[fold == f] @ weights / UNIT
            yield pa.RecordBatch.from_arrays([pa.array(bin_of(raw)), batch.column("_y").cast(pa.int64())], names=["_bin", "_y"])

    binned = rows.select("_stats", "_y", "_fold").mapInArrow(raw_bins, "_bin long, _y long")
    weight, ones = np.zeros(BINS), np.zeros(BINS)
    for r in binned.groupBy("_bin").agg(F.count("*").alias("n"), F.sum("_y").alias("ones")).collect():
        weight[r["_bin"]], ones[r["_bin"]] = r["n"], r["ones"]
    model.steps = isotonic(weight, (ones + 1e-9) / (weight + 2e-9))
    model.weights = _ridge(list(sums.values()))
    return model


def learn(rows: DataFrame, labels: DataFrame, held_out: int) -> Model:
    """The model of the rows (``doc_id, _stats``) whose label may be learned from."""
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("_y"))
    known = known.where(remainder(F.col("doc_id"), held_out) != 0)
    return fit(settle(rows.join(known, "doc_id").select("_stats", "_y", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("_fold"))))


def score(docs: DataFrame, labels: DataFrame, held_out: int = 5, threshold: float = 0.3) -> DataFrame:
    """Quality of every document: ``doc_id, held_out, score, predicted``, a row per row of ``docs`` (``doc_id, text``).

    ``labels`` (``doc_id, quality``) says 1 or 0 for some documents; labels of
    rows whose crc32(doc_id) mod ``held_out`` is 0 are not learned from, nor
    null ones or other values. A document with several labels counts once for
    each. Inputs of a score are statistics of the whole text alone. Null and
    empty texts are scored like any other, null ids are never labelled. Without
    any label every score is 0.5. Other columns are ignored.
    """
    rows = settle(document_statistics(docs.select("doc_id", "text")))
    model = learn(rows, labels, held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_stats_of(batch)))], names=["doc_id", "score"])

    scored = rows.select("doc_id", "_stats").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), held_out) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame, held_out: int = 5, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that ``score`` predicts 1 for, with the columns they had; no text is shuffled.

    The statistics of labelled texts are computed once more than in ``score``.
    """
    labelled = labels.where(F.col("quality").isin(0, 1)).select("doc_id").distinct()
    rows = settle(document_statistics(docs.select("doc_id", "text")).join(labelled, "doc_id", "left_semi"))
    model = learn(rows, labels, held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _class_of_byte()
        for batch in by_bytes(batches):
            stats = np.stack([statistics(text, classes) for text in batch.column("text").to_pylist()]).astype(np.float32).astype(float)
            yield batch.filter(pa.array(model.score(stats) >= threshold))

    return docs.mapInArrow(run, docs.schema)
