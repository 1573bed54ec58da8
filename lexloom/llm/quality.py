"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

A text becomes a fixed vector of statistics; cosines of random projections of the standardised vector approximate a
Gaussian kernel; each partition of the training rows sums its share of the normal equations, and the sums solve for
the ridge weights; raw scores of labelled rows that the fit did not see are turned into probabilities by isotonic
regression. These raw scores come from cross-fitting: the sums of each fold's rows are kept apart, so the weights that score
a fold are solved from the sums of the others; the weights that score documents come from all sums.

Fitting uses at most ``max_rows`` labelled rows (those of the least id hash), a documented bound; scoring is a single
pass over all texts without a shuffle. The model (some thousand numbers) travels with the scoring function.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm._shared import fresh, small_batches, table, written

MAX_ROWS = 20_000
FEATURES = 256
RIDGE = 1e-3
THRESHOLD = 0.3
FOLDS = 5
SEED = 42
#: Partial sums of the normal equations that reach the driver at most.
SUMS = 4

_STOPS = frozenset(b".!?:;\"')")
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-"]] = True


def _runs(left: np.ndarray, right: np.ndarray) -> tuple[int, np.ndarray]:
    """How many distinct pairs two aligned sequences of codes have (1 for none), and the pairs' codes."""
    if not len(right):
        return 1, right
    kinds, codes = np.unique(left[: len(right)] * (int(right.max()) + 1) + right, return_inverse=True)
    return len(kinds), codes


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one UTF-8 text; all zeros for null and texts without words."""
    raw = text or b""
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATISTICS
    size = len(raw)
    of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    letters, upper, lower = int(of[_LETTER].sum()), int(of[65:91].sum()), int(of[97:123].sum())
    counts = Counter(words)
    number = dict(zip(counts, range(len(counts)), strict=True))
    codes = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=n)
    pairs, two = _runs(codes, codes[1:])
    fives = _runs(_runs(two, two[2:])[1], codes[4:])[0] if n > 5 else 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    line_kinds = len(set(lines))
    marked = sum(_SYMBOL[w[-1]] for w in words)
    shouted = sum(w.endswith(b"!!") for w in words)
    bare = sum(not _LETTER[w[0]] for w in words)
    return [
        np.log1p(n),
        np.log1p(size),
        (size - n) / n,
        letters / size,
        upper / max(1, upper + lower),
        int(of[48:58].sum()) / size,
        int(of[_SYMBOL].sum()) / size,
        int(of[33] + of[63]) / n,
        int(of[124]) / n,
        marked / n,
        shouted / n,
        bare / n,
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        1 - pairs / max(1, n - 1),
        1 - fives / max(1, n - 5) if n > 5 else 0.0,
        1 - line_kinds / len(lines),
        np.log1p(size / len(lines)),
        sum(x[-1] in _STOPS for x in lines) / len(lines),
        int(of[46]) / n,
        int(of[44]) / n,
        sum(len(w) <= 3 for w in words) / n,
        np.log1p(max(map(len, words))),
        int(of[60] + of[62] + of[123] + of[125]) / size,
    ]


N_STATISTICS = 24


def statistics_udf():
    """Arrow UDF text -> array of doubles."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def stats(text: pa.Array) -> pa.Array:
        return pa.array((statistics(x.as_py()) for x in text.cast(pa.binary())), pa.list_(pa.float64()))

    return stats


@dataclass(frozen=True)
class Model:
    """A fitted classifier; score() maps rows of statistics to probabilities of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Features of rows of statistics, in steps of 2^-22, so sums of their products over MAX_ROWS rows are exact in any order."""
        z = np.cos(((x - self.mean) / self.scale).clip(-8, 8) @ self.omega + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([np.round(z * 2**22) / 2**22, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.values)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y on x, equal x first made one: the blocks' mean x, ascending, and their mean y."""
    at, inverse, n = np.unique(x, return_inverse=True, return_counts=True)
    blocks: list[list[float]] = []
    for a, b, c in zip(at, np.bincount(inverse, y), n, strict=True):
        blocks.append([a * c, b, float(c)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    sums = np.array(blocks)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, fold, label, stats) of at most max_rows labelled documents outside fold 0, one row per id.

    Conflicting labels of an id count as 1 if their mean is 0.5 or more; null labels and ids are left out.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(F.col(label).isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id")
    known = known.agg((F.avg(label) >= 0.5).cast("double").alias("label"))
    # bounded by max_rows, so the broadcast is too
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    stats = found.select("doc_id", fold(F.col("doc_id")).cast("int").alias("fold"), "label", statistics_udf()("text").alias("stats"))
    return stats.groupBy("doc_id", "fold", "label").agg(F.min("stats").alias("stats"))


def _moment_batches(shape: Model):
    """Per fold of a partition's rows: their number and the upper half of their normal equations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(shape.phase) + 1
        sums = [[0, np.zeros((d, d)), np.zeros(d)] for _ in range(FOLDS)]
        for batch in batches:
            folds, z, y = batch.column(0).to_numpy(), shape.lift(_matrix(batch.column(2))), batch.column(1).to_numpy()
            for k in np.unique(folds):
                own = folds == k
                sums[k] = [sums[k][0] + int(own.sum()), sums[k][1] + z[own].T @ z[own], sums[k][2] + z[own].T @ y[own]]
        half = np.triu_indices(d)
        rows = [(k, n, gram[half].tobytes(), moment.tobytes()) for k, (n, gram, moment) in enumerate(sums) if n]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 4, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["fold", "n", "gram", "moment"])

    return run


def _solved(sums: list, d: int) -> np.ndarray:
    """Ridge weights from partial sums."""
    gram, moment, half = np.zeros((d, d)), np.zeros(d), np.triu_indices(d)
    for r in sums:
        gram[half] += np.frombuffer(r["gram"])
        moment += np.frombuffer(r["moment"])
    penalty = RIDGE * max(1, sum(r["n"] for r in sums)) * np.eye(d) / FEATURES
    penalty[-1, -1] = 1e-9
    return np.linalg.solve(np.triu(gram) + np.triu(gram, 1).T + penalty, moment)


def _matrix(stats: pa.Array) -> np.ndarray:
    return stats.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model | None:
    """Fits on labelled rows outside fold 0, calibrated by the scores that each fold gets from the others' weights.

    None without labelled rows. A fold that is alone gets its scores from no rows: zeros, so its mean label.
    """
    # max_rows short rows: few files, as on local disks Hadoop starts processes for each one, whose memory counts with the executor's
    rows = written(training_rows(docs, labels, label, max_rows).repartition(SUMS), "quality-training")
    moments = [F.struct(F.avg(F.col("stats")[i]).alias("mean"), F.stddev_pop(F.col("stats")[i]).alias("sd")).alias(f"s{i}") for i in range(N_STATISTICS)]
    first = rows.agg(F.count("*").alias("n"), *moments).first()
    if not first["n"]:
        return None
    rng = np.random.default_rng(SEED)
    mean = np.array([round(first[f"s{i}"]["mean"], 9) for i in range(N_STATISTICS)])
    scale = np.array([round(first[f"s{i}"]["sd"], 9) or 1.0 for i in range(N_STATISTICS)])
    omega = rng.standard_normal((N_STATISTICS, FEATURES)) / np.sqrt(N_STATISTICS)
    shape = Model(mean, scale, omega, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    d = FEATURES + 1
    dealt = rows.select("fold", "label", "stats").coalesce(SUMS)
    parts = dealt.mapInArrow(_moment_batches(shape), "fold int, n long, gram binary, moment binary").collect()  # SUMS * 4 rows
    sample = rows.select("doc_id", "fold", "label", "stats").toArrow().sort_by("doc_id")  # max_rows rows
    x, folds = _matrix(sample.column("stats").combine_chunks()), sample.column("fold").to_numpy()
    raw = np.zeros(len(folds))
    for k in np.unique(folds):
        others = [r for r in parts if r["fold"] != k]
        beta = _solved(others, d) if others else np.zeros(d)
        for at in np.array_split(np.flatnonzero(folds == k), 16):
            raw[at] = shape.lift(x[at]) @ beta
    knots, values = isotonic(raw, sample.column("label").to_numpy())
    return Model(mean, scale, omega, shape.phase, _solved(parts, d), knots, values)


def score_udf(model: Model | None):
    """Arrow UDF text -> probability of label 1; 0.5 where nothing was labelled."""

    @F.arrow_udf(T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        if model is None or not len(text):
            return pa.array([0.5] * len(text), pa.float64())
        return pa.array(model.score(np.array([statistics(x.as_py()) for x in text.cast(pa.binary())])), pa.float64())

    return score


def score_quality(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """docs with a column ``name``, in place of one so named. Null and empty texts get the score of a text without words.

    Every row is scored by its text alone, so repeated rows stay and score alike; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(name, score_udf(model)("text"))


def reject_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of docs that score ``threshold`` or more, fitted on the labelled rows among them outside fold 0."""
    (name,) = fresh(docs.columns, "score")
    return score_quality(docs, fit(docs, labels, max_rows=max_rows), name).filter(F.col(name) >= threshold).select(*docs.columns)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's calibrated quality score and decision; fold 0 is held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
