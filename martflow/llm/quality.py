"""A quality classifier by positive-unlabelled learning.

It learns from texts that are trusted to be good and from unlabelled web text, which
holds good and bad.  With the share of good texts (class prior) p, the risk of a scorer g
is  p E+[l(g)] + max(0, E_u[l(-g)] - p E+[l(-g)]),  here with the squared loss
l(z) = (1 - z)^2 / 4.  The second part estimates the risk on bad texts; held at zero from
below, a scorer cannot drive it negative by fitting noise.

For a linear scorer both parts depend on the texts through their second moments only.  These
are added up over every row, so the fit sees all unlabelled text; a matrix of the features'
size comes to the driver.  The class prior is estimated from trusted and unlabelled rows
alone: a first scorer tells the two apart, and among rows with high scores, where unlabelled
ones are good too, the unlabelled share is divided by the trusted one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, unit_hash, utf8

POSITIVES = 6000  # bound, on average, of the trusted rows
RIDGE = 0.1
BINS, WIDEST = 4000, 2.0  # of the scores that tell trusted from unlabelled rows
LIKELY = 0.1  # chance that the slack of a share is too small
SUM_TASKS = 4
THRESHOLD = 0.3
RARE = 0.03  # keeps signs that hardly ever occur from weighing much
BLOCK = 1 << 20

#: Kinds of bytes: control, new line, space, digit, upper, lower, non-ASCII, then groups of signs.
SIGNS = (".,;:", "!?", "|", "#$%&*@^~+=<>", "'\"()[]{}`-_/\\")
KIND = np.zeros(256, np.uint8)
KIND[10], KIND[[9, 32]] = 1, 2
KIND[48:58], KIND[65:91], KIND[97:123], KIND[128:] = 3, 4, 5, 6
for _group, _signs in enumerate(SIGNS, 7):
    KIND[[ord(c) for c in _signs]] = _group
KINDS = 7 + len(SIGNS)
FEATURES = KINDS * KINDS + 256 + 8


def features(text: bytes) -> np.ndarray:
    """Signs, pairs of kinds of signs, and repetition over a whole text."""
    pairs, singles = np.zeros(KINDS * KINDS), np.zeros(256)
    for at in range(0, len(text), BLOCK):
        x = np.frombuffer(text, np.uint8, min(BLOCK + 1, len(text) - at), at)
        kind = KIND[x].astype(np.int32)
        pairs += np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS * KINDS)
        singles += np.bincount(x[:BLOCK], minlength=256)
    words, lines = text.split(), text.split(b"\n")
    n = max(1, len(words))
    shape = np.array([
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / n / 10,
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        float(not words),
    ])
    share = lambda x: np.sqrt(x / max(1, x.sum()))
    return np.concatenate([share(pairs), share(singles), shape]).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    offset: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        # The squared loss makes g an estimate of 2 P(good) - 1; this curve touches it at 0.
        return _sigmoid(2 * ((rows - self.mean) / self.spread @ self.weights + self.offset))


def moments(rows: np.ndarray) -> np.ndarray:
    """Sums of products of all features and a constant one, which comes last."""
    x = np.concatenate([rows, np.ones((len(rows), 1), rows.dtype)], axis=1).astype(np.float64)
    return x.T @ x


def _scale(unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = unlabelled[-1, :-1] / unlabelled[-1, -1]
    square = unlabelled.diagonal()[:-1] / unlabelled[-1, -1]
    return mean, np.sqrt(np.maximum(square - mean**2, 0)) + RARE


def _scaled(sums: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Mean products of the features after moving and stretching them."""
    turn = np.diag(np.append(1 / spread, 1.0))
    turn[:-1, -1] = -mean / spread
    return turn @ (sums / sums[-1, -1]) @ turn.T


def _ridge(size: int) -> np.ndarray:
    return np.diag(np.append(np.full(size - 1, RIDGE), 0.0))


def least_risk(p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Weights (the constant's last) that minimise the non-negative risk, with a ridge.

    ``p`` and ``u`` are mean products of trusted and unlabelled rows.  The risk is the
    greater of two convex quadratics, without and with the part that is held at zero.  If
    each one's own minimum lies where the other is greater, the minimum is where that part
    is zero, on the line of mixtures between the two.
    """
    ridge = _ridge(len(u))

    def mixed(share: float) -> np.ndarray:
        square = (1 - share) * prior * p + share * u + ridge
        return np.linalg.solve(square, (1 + share) * prior * p[-1] - share * u[-1])

    def on_bad(w: np.ndarray) -> float:
        risk = lambda x: (x[-1, -1] + 2 * x[-1] @ w + w @ x @ w) / 4
        return risk(u) - prior * risk(p)

    low, high = 0.0, 1.0
    if on_bad(mixed(high)) >= 0:
        return mixed(high)
    if on_bad(mixed(low)) <= 0:
        return mixed(low)
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if on_bad(mixed(middle)) > 0 else (low, middle)
    return mixed(low)


def fit_moments(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> QualityModel:
    mean, spread = _scale(unlabelled)
    w = least_risk(_scaled(positive, mean, spread), _scaled(unlabelled, mean, spread), prior)
    return QualityModel(mean, spread, w[:-1], float(w[-1]), prior)


def fit_positive_unlabelled(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> QualityModel:
    """The model of feature rows that are at hand."""
    return fit_moments(moments(positive), moments(unlabelled), prior)


def _telling(positive: np.ndarray, unlabelled: np.ndarray, scale: tuple) -> np.ndarray:
    """Weights on plain features of a scorer that is 1 on trusted rows and -1 on unlabelled ones."""
    mean, spread = scale
    p, u = _scaled(positive, mean, spread), _scaled(unlabelled, mean, spread)
    w = np.linalg.solve(p + u + 2 * _ridge(len(u)), p[-1] - u[-1])
    plain = w[:-1] / spread
    return np.append(plain, w[-1] - plain @ mean)


def share_of_good(trusted: np.ndarray, unlabelled: np.ndarray) -> float:
    """The class prior by two histograms of scores, higher scores last.

    Above any score the unlabelled share is at least the prior times the trusted one.  Their
    ratio is taken where it is least after a slack for the numbers of rows.
    """
    rows = [max(x.sum(), 1) for x in (trusted, unlabelled)]
    above = [x[::-1].cumsum()[::-1] / n for x, n in zip((trusted, unlabelled), rows)]
    slack = sum(np.sqrt(np.log(4 / LIKELY) / (2 * n)) for n in rows)
    some = above[0] > 0
    if not some.any():
        return 0.5
    good, every = above[0][some], above[1][some]
    least = np.argmin((every + slack) / good)
    return float(np.clip(every[least] / good[least], 0.01, 0.99))


def _sample(rows: DataFrame, bound: int, salt: str) -> DataFrame:
    """About ``bound`` rows, chosen by a hash of all columns; all rows if there are fewer."""
    count = rows.count()
    luck = unit_hash(*rows.columns, F.lit(salt))
    return rows.filter(luck < bound / max(count, 1))


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.stack([features(t.as_py()) for t in texts])


def _moments(rows: DataFrame) -> dict[tuple[int, bool], np.ndarray]:
    """Moments by half and trust over all of ``rows``."""
    size = FEATURES + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            kinds = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(kinds), 512):
                x, kind = _matrix(batch.column(1).slice(at, 512)), kinds[at : at + 512]
                for k in set(kind.tolist()):
                    own = moments(x[kind == k])
                    sums[k] = sums[k] + own if k in sums else own
        for k, own in sums.items():  # products are symmetric: each row from the diagonal on
            yield pa.RecordBatch.from_arrays(
                [pa.array([k * size + i for i in range(size)], pa.int64()),
                 pa.array([own[i, i:].tobytes() for i in range(size)], pa.binary())],
                ["row", "vector"],
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # a bounded number of rows
        for batch in batches:
            for row, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(vector, np.float64)
                sums[row] = sums[row] + x if row in sums else x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
            ["row", "vector"],
        )

    parts = rows.select("kind", "text").mapInArrow(summed, "row long, vector binary")
    parts = parts.repartition(SUM_TASKS, "row").mapInArrow(added, "row long, vector binary")
    found: dict[int, np.ndarray] = {}
    for row in parts.collect():
        k, i = divmod(row["row"], size)
        matrix = found.setdefault(k, np.zeros((size, size)))
        matrix[i, i:] = matrix[i:, i] = np.frombuffer(row["vector"], np.float64)
    return {(k // 2, bool(k % 2)): matrix for k, matrix in found.items()}


def _histograms(rows: DataFrame, weights: dict[int, np.ndarray]) -> np.ndarray:
    """Numbers of rows by kind and score, each half scored by the weights of the other."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)  # one number for each feature

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((4, BINS), np.int64)
        for batch in batches:
            kinds = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(kinds), 512):
                x, kind = _matrix(batch.column(1).slice(at, 512)), kinds[at : at + 512]
                for k in set(kind.tolist()):
                    w = shared.value.get(1 - k // 2)
                    if w is not None:
                        score = np.clip((x[kind == k] @ w[:-1] + w[-1] + WIDEST) / (2 * WIDEST), 0, 1)
                        seen[k] += np.bincount(np.minimum((score * BINS).astype(int), BINS - 1), minlength=BINS)
        cell = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int64()), pa.array(seen.reshape(-1)[cell], pa.int64())], ["cell", "n"]
        )

    found = rows.select("kind", "text").mapInArrow(counted, "cell long, n long")
    seen = np.zeros(4 * BINS, np.int64)
    for row in found.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        seen[row["cell"]] = row["n"]
    shared.destroy()
    return seen.reshape(4, BINS)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    positives: int = POSITIVES,
) -> QualityModel | None:
    """Learn from the documents and labels given; None without a positive label.

    A document is a trusted positive if all its non-null labels are 1; other labels tell
    nothing.  About ``positives`` of these are used, chosen by a hash, so that their ids go
    to all tasks.  Every row of ``docs`` is an unlabelled one: no sample is taken of them.
    The class prior comes from two halves of the rows, equal texts in the same one, each
    scored by what tells trusted from unlabelled rows in the other.  Null and empty texts
    are texts of no signs; repeated rows count each.
    """
    spark = docs.sparkSession
    ship_package(spark)
    own = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    own = own.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.min(F.col(label_col)).alias("label")
    )
    good = _sample(own.filter("label = 1").select("doc_id"), positives, "positive")
    # At most about ``positives`` ids, so this side is small whatever the corpus.
    trusted = F.broadcast(good.select(F.col("doc_id").alias("good_id")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    half = F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2))
    rows = rows.join(trusted, F.col("doc_id") == F.col("good_id"), "left").select(
        (half * 2 + F.col("good_id").isNotNull().cast("long")).alias("kind"), "text"
    )
    sums = _moments(rows)
    every = sum(sums.values()) if sums else None
    good = sum(m for (_, is_good), m in sums.items() if is_good)
    if not sums or not np.any(good):
        return None
    scale = _scale(every)
    weights = {
        k: _telling(sums[k, True], sums[k, True] + sums.get((k, False), 0), scale) for k in (0, 1) if (k, True) in sums
    }
    seen = _histograms(rows, weights)
    shares = [share_of_good(seen[2 * k + 1], seen[2 * k] + seen[2 * k + 1]) for k in (0, 1) if seen[2 * k + 1].any()]
    return fit_moments(good, every, float(np.mean(shares)) if shares else 0.5)


def quality_score(spark: SparkSession, model: QualityModel | None, text: Column) -> Column:
    """The estimated probability that a text is good; 0.5 without a model.

    Null and empty texts are scored as a text of no signs.  Only the text is an input.
    """
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # one number for each feature

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if shared.value is None or not len(texts):
            return pa.array([0.5] * len(texts), pa.float64())
        found = [
            shared.value.scores(np.stack([features(t.as_py()) for t in texts.slice(at, 512)]))
            for at in range(0, len(texts), 512)
        ]
        return pa.array(np.concatenate(found), pa.float64())

    return score(utf8(text))


def score_documents(
    docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score, predicted`` for each row; ``predicted`` is 1 from ``THRESHOLD`` on.

    Repeated rows get equal scores; an empty table gives no rows.
    """
    score = quality_score(docs.sparkSession, model, F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
