"""Logistic regressions and linear support vector machines, many at a time, by Newton's method.

The rows are packed once. Each round is one pass in which every task adds up, for every problem that is not solved yet,
the loss, its gradient and its matrix of second derivatives, a few thousand numbers a problem whatever the rows; candidates
of a search, folds and bootstrap samples are solved side by side. The steps are taken on the driver, in the scale of the
problem's own rows, whose means and deviations come from the same kind of pass.

A logistic loss is weighed against the squares of the coefficients or, by a proximal step, their sizes. The support vector
machine has the squared hinge loss, so a round's matrix is that of the rows inside the margin, and few rounds do.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchcast.operators.binning import Rows, Sample, pack_blocks
from matchcast.operators.impute import Standardiser, fit_standardiser

# Tasks get this module's helpers by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOGISTIC, MARGIN = "logistic", "margin"
CLOSE = 1e-7  # a step of that size, in deviations of the features, ends a problem
GAIN = 1e-8  # or one that gains so little of the loss
SWEEPS = 100
FAR = 10.0  # the longest step of a coefficient
SUMS = "problem int, sums binary"


@dataclass(frozen=True)
class Problem:
    """One fit: its loss and penalty, the rows it learns from, and the features it uses (all if None)."""

    kind: str = LOGISTIC
    strength: float = 1.0  # of the sum of losses against the penalty
    penalty: str = "l2"
    rounds: int = 1000
    sample: Sample = Sample()
    columns: tuple[int, ...] | None = None
    scaled: bool = True
    scored: int | None = None  # the mark of the rows that ``scores`` asks it for


@dataclass
class Solution:
    """Intercept and coefficients, by feature, in the problem's own scale."""

    intercept: float
    coefficients: np.ndarray
    means: np.ndarray
    deviations: np.ndarray
    rounds: int

    def raw(self) -> np.ndarray:
        """Intercept and coefficients for the packed rows."""
        slope = self.coefficients / self.deviations
        return np.concatenate([[self.intercept - slope @ self.means], slope])


@dataclass
class Packed:
    """Rows as blocks of numbers, the features shifted and scaled alike for all problems."""

    df: DataFrame
    features: list[str]
    shift: np.ndarray
    scale: np.ndarray

    def release(self) -> None:
        self.df.unpersist()


def pack(df: DataFrame, features: list[str], label: str, **options) -> Packed:
    # Workers fill the cores as it is; products in them take one thread each.
    df.sparkSession.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")
    common = fit_standardiser(df, features)
    shift, scale = (np.array([getattr(common, c)[f] for f in features]) for c in ("means", "deviations"))
    blocks = pack_blocks(df, features, label, convert=lambda values: (values - shift) / scale, **options)
    return Packed(blocks.persist(), list(features), shift, scale)


def _with_one(rows: Rows) -> np.ndarray:
    return np.column_stack([np.ones(len(rows.key)), rows.values])


def _terms(kind: str, margin: np.ndarray, label: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The loss of all rows, and each row's first and second derivative by its margin."""
    if kind == LOGISTIC:
        p = 1.0 / (1.0 + np.exp(-np.abs(margin)))
        p = np.where(margin >= 0, p, 1.0 - p)
        return float(w @ (np.logaddexp(0.0, margin) - label * margin)), w * (p - label), w * p * (1.0 - p)
    side = 2.0 * label - 1.0
    short = np.maximum(1.0 - side * margin, 0.0)
    return float(w @ (short * short)), -2.0 * w * side * short, 2.0 * w * (short > 0)


def _summed(packed: Packed, work: dict[int, np.ndarray | None], problems: list[Problem], size: int) -> dict[int, np.ndarray]:
    """One pass: a vector of sums for each problem in ``work``, whose values are its coefficients (None: moments alone)."""

    def add(batches):
        sums = {k: np.zeros(size) for k in work}
        for batch in batches:
            for block in batch.to_pylist():
                rows = Rows.of(block, np.float64)
                x, weights = _with_one(rows), {}
                for k, b in work.items():
                    problem = problems[k]
                    if problem.sample not in weights:
                        weights = {problem.sample: problem.sample.weights(rows)}
                        held = np.flatnonzero(weights[problem.sample])
                        w, z, label = weights[problem.sample][held], x[held], rows.label[held]
                    loss, first, second = (0.0, np.zeros(len(w)), w) if b is None else _terms(problem.kind, z @ b, label, w)
                    sums[k] += np.concatenate([[loss], z.T @ first, (z.T @ (z * second[:, None])).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["problem", "sums"])

    def together(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, np.float64) for s in table.column("sums").to_pylist())
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["problem", "sums"])

    parts = packed.df.mapInArrow(add, SUMS).groupBy("problem").applyInArrow(together, SUMS)
    found = {r["problem"]: np.frombuffer(r["sums"], np.float64) for r in parts.collect()}
    return {k: found.get(k, np.zeros(size)) for k in work}  # a table without partitions has no sums


def _soft_step(g: np.ndarray, h: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The coefficients that a quadratic loss plus their sizes is least at; the first has no penalty.

    Sweeps over the coordinates find which are not zero, and jumps to the least point with these signs, as far as no sign
    turns, take what sweeps are slow at: features that nearly or wholly depend on one another.
    """
    new, slope = b.copy(), g.copy()  # slope: of the quadratic loss at ``new``
    for _ in range(SWEEPS):
        most = 0.0
        for j in range(len(b)):
            steep = h[j, j]
            if steep <= 0:
                continue
            goal = new[j] - slope[j] / steep
            if j:
                goal = math.copysign(max(abs(goal) - 1.0 / steep, 0.0), goal)
            move = goal - new[j]
            if move:
                slope += h[:, j] * move
                new[j], most = goal, max(most, abs(move))
        if most < CLOSE:
            break
        for _ in range(len(b)):
            used = np.flatnonzero(new)
            used = used if len(used) and used[0] == 0 else np.concatenate([[0], used])
            sign = np.sign(new[used])
            sign[0] = 0.0
            inner, wanted = h[np.ix_(used, used)], -(slope[used] + sign)
            move = np.linalg.lstsq(inner, wanted, rcond=1e-10)[0]
            over = wanted - inner @ move
            flat = np.abs(over).max() > 1e-9 * (1 + np.abs(wanted).max())
            move = over if flat else move  # where the loss is flat the sizes fall until a sign would turn
            with np.errstate(divide="ignore", invalid="ignore"):
                turns = np.where((sign != 0) & (sign * move < 0), -new[used] / move, np.inf)
            first = int(turns.argmin())
            length = turns[first] if flat else min(turns[first], 1.0)
            if not np.isfinite(length):
                break
            new[used] += length * move
            slope += h[:, used] @ (length * move)
            if length != turns[first]:
                break
            new[used[first]] = 0.0
    return new


def _penalty(problem: Problem, b: np.ndarray) -> float:
    if problem.kind == MARGIN:
        return 0.5 * float(b @ b)  # its intercept is one of the coefficients
    return float(np.abs(b[1:]).sum()) if problem.penalty == "l1" else 0.5 * float(b[1:] @ b[1:])


def _stepped(problem: Problem, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Where the penalised quadratic approximation of the loss is least."""
    if problem.kind == LOGISTIC and problem.penalty == "l1":
        return _soft_step(g, h, b)
    weighed = np.ones(len(b))
    if problem.kind == LOGISTIC:
        weighed[0] = 0.0
    return b - np.linalg.lstsq(h + np.diag(weighed), g + weighed * b, rcond=1e-13)[0]


@dataclass
class _State:
    columns: np.ndarray
    scale: np.ndarray  # from the packed rows to the problem's own scale: a matrix with the intercept first
    means: np.ndarray
    deviations: np.ndarray
    b: np.ndarray
    before: np.ndarray | None = None
    least: float = np.inf
    rounds: int = 0
    halved: int = 0

    def raw(self, width: int) -> np.ndarray:
        full = np.zeros(width + 1)
        full[np.concatenate([[0], self.columns + 1])] = self.scale.T @ self.b
        return full


def _begin(problem: Problem, moments: np.ndarray, packed: Packed, start: Solution | None) -> _State:
    width = len(packed.features)
    columns = np.arange(width) if problem.columns is None else np.array(problem.columns)
    held = moments[0, 0] or 1.0
    means, deviations = -packed.shift / packed.scale, 1.0 / packed.scale  # the features as they were
    if problem.scaled:
        means = moments[0, 1:] / held
        variance = np.maximum(np.diag(moments)[1:] / held - means * means, 0.0)
        deviations = np.sqrt(variance)
        deviations[deviations < 1e-9] = 1.0
    scale = np.zeros((len(columns) + 1, len(columns) + 1))
    scale[0, 0] = 1.0
    scale[1:, 0] = -means[columns] / deviations[columns]
    scale[np.arange(1, len(columns) + 1), np.arange(1, len(columns) + 1)] = 1.0 / deviations[columns]
    b = np.zeros(len(columns) + 1)
    if start is not None:
        b = np.concatenate([[start.intercept], start.coefficients[columns]])
    return _State(columns, scale, means, deviations, b)


def solve(packed: Packed, problems: list[Problem], starts: dict[int, Solution] | None = None) -> list[Solution]:
    """All problems' solutions; ``starts`` names solutions to begin at."""
    width = len(packed.features)
    size = 1 + (width + 1) + (width + 1) ** 2
    firsts: dict[Sample, int] = {}
    for k, problem in enumerate(problems):
        firsts.setdefault(problem.sample, k)
    moments = _summed(packed, dict.fromkeys(firsts.values()), problems, size)

    def matrix(sums: np.ndarray) -> np.ndarray:
        return sums[width + 2 :].reshape(width + 1, width + 1)

    states = [_begin(p, matrix(moments[firsts[p.sample]]), packed, (starts or {}).get(k)) for k, p in enumerate(problems)]
    open_ = set(range(len(problems)))
    while open_:
        found = _summed(packed, {k: states[k].raw(width) for k in sorted(open_)}, problems, size)
        turns: dict[int, tuple] = {}
        for k, sums in found.items():
            problem, s = problems[k], states[k]
            value = problem.strength * sums[0] + _penalty(problem, s.b)
            if s.before is not None and value > s.least + 1e-12 * (1 + abs(s.least)) and s.halved < 30:
                s.b, s.halved = (s.b + s.before) / 2, s.halved + 1
                continue
            used = np.concatenate([[0], s.columns + 1])
            g = problem.strength * (s.scale @ sums[1 : width + 2][used])
            h = problem.strength * (s.scale @ matrix(sums)[np.ix_(used, used)] @ s.scale.T)
            turns[k] = (value, g, h)
        for k, (value, g, h) in turns.items():
            s = states[k]
            goal = _stepped(problems[k], s.b, g, h)
            new = s.b + np.clip(goal - s.b, -FAR, FAR)
            s.rounds, s.halved = s.rounds + 1, 0
            settled = np.abs(new - s.b).max() < CLOSE or s.least - value <= GAIN * (1 + abs(value))
            s.before, s.least, s.b = s.b, value, new
            if settled or s.rounds >= problems[k].rounds:
                open_.discard(k)
    solutions = []
    for s in states:
        coefficients = np.zeros(width)
        coefficients[s.columns] = s.b[1:]
        solutions.append(Solution(float(s.b[0]), coefficients, s.means, s.deviations, s.rounds))
    return solutions


def scores(packed: Packed, problems: list[Problem], solutions: list[Solution]) -> DataFrame:
    """``fit, key, y, p``: what each logistic problem says of the rows it is asked for."""
    told = [(k, p.scored, s.raw()) for k, (p, s) in enumerate(zip(problems, solutions))]

    def run(batches):
        for batch in batches:
            for block in batch.to_pylist():
                rows = Rows.of(block, np.float64)
                x = _with_one(rows)
                for k, mark, b in told:
                    held = rows.mark == mark
                    p = 1.0 / (1.0 + np.exp(-np.clip(x[held] @ b, -700, 700)))
                    columns = [np.full(len(p), k, np.int32), rows.key[held], rows.label[held], p]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fit", "key", "y", "p"])

    return packed.df.mapInArrow(run, "fit int, key long, y double, p double")


# --- the model -------------------------------------------------------------------------------


@dataclass
class LinearModel:
    """An intercept and coefficients that score vectors, as an expression of their elements."""

    kind: str
    intercept: float
    weights: list[float] = field(default_factory=list)

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def transform(self, df: DataFrame, features: str, probability: str, predicted: str) -> DataFrame:
        values = vector_to_array(F.col(features))
        margin = F.lit(self.intercept)
        wide = df.withColumn("_margin_values", values)
        for i, b in enumerate(self.weights):
            margin = margin + F.get(F.col("_margin_values"), i) * b
        wide = wide.withColumn("_margin", margin)
        if self.kind == LOGISTIC:
            p = 1.0 / (1.0 + F.exp(-F.col("_margin")))
            wide = wide.withColumn("_margin_p", p).withColumn(probability, array_to_vector(F.array(1.0 - F.col("_margin_p"), F.col("_margin_p")))).drop("_margin_p")
        return wide.withColumn(predicted, (F.col("_margin") > 0).cast("double")).drop("_margin", "_margin_values")

    def save(self, path: str, spark: SparkSession) -> None:
        row = [(self.kind, self.intercept, self.weights)]
        spark.createDataFrame(row, "kind string, intercept double, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        r = spark.read.parquet(path).first()
        return cls(r["kind"], r["intercept"], list(r["weights"]))


def as_model(packed: Packed, problem: Problem, solution: Solution) -> tuple[LinearModel, Standardiser | None]:
    """The model in the scale of its own rows, and that scale; an unscaled problem's model reads the features as they are."""
    model = LinearModel(problem.kind, solution.intercept, solution.coefficients.tolist())
    if not problem.scaled:
        return model, None
    means = packed.shift + packed.scale * solution.means
    deviations = packed.scale * solution.deviations
    scaler = Standardiser(*(dict(zip(packed.features, map(float, v))) for v in (means, deviations)))
    return model, scaler


def raw_weights(model: LinearModel, scaler: Standardiser | None, features: list[str]) -> list[float]:
    """The intercept and the coefficients for features as they are."""
    if scaler is None:
        return [model.intercept, *model.weights]
    slopes = [b / scaler.deviations[c] for b, c in zip(model.weights, features)]
    return [model.intercept - sum(b * scaler.means[c] for b, c in zip(slopes, features)), *slopes]


def problem_of(name: str, params: dict, **more) -> Problem:
    """The problem of a logistic regression or a linear SVM with the parameters of ``learners``."""
    kind = LOGISTIC if name == "logistic_regression" else MARGIN
    return Problem(kind, params["C"], params.get("penalty", "l2"), params["max_iter"], **more)


def fit_linear(
    rows: DataFrame, features: list[str], label: str, problem: Problem, weight: str | None = None, packed: Packed | None = None
) -> tuple[LinearModel, Standardiser | None]:
    held = packed or pack(rows, features, label, weights=[F.col(weight)] if weight else None)
    try:
        return as_model(held, problem, solve(held, [problem])[0])
    finally:
        if packed is None:
            held.release()
