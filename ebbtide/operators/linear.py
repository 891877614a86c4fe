"""Linear machines fitted by Newton steps: one aggregate per step for all settings and folds at once."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators import blocks as B
from ebbtide.operators.kernel import projection

STEPS = 100
TOLERANCE = 1e-10  # of the gradient's largest component, per row

LOGISTIC, SQUARED_HINGE = "logistic", "squared hinge"
SIGMOID_PENALTY = 1e-3  # keeps the slope finite where margins separate the classes
VIEWED_ROWS = 128  # rows that are mapped at once, few enough for a core's cache
PROBLEMS_AT_ONCE = 8  # problems of a part and view whose rows are multiplied together
ROWS_AT_ONCE = 4096  # rows that are multiplied at once, few enough for a task's memory
SUMS_AT_ONCE = 32  # sums that are held by the problems that have their rows


@dataclass(frozen=True)
class Problem:
    """Rows of a part outside a fold, seen through a view; minimised is the sum of losses + penalty / 2 |w|^2.

    The intercept, the last number of a solution, has no penalty.
    """

    part: int
    penalty: float
    held_out: int = B.NO_FOLD
    view: tuple[float, int, int] | None = None  # gamma, dimensions, seed of random Fourier features


def viewed(x: np.ndarray, view: tuple[float, int, int] | None) -> np.ndarray:
    """Features with a column of ones."""
    if view is None:
        return np.hstack([x, np.ones((len(x), 1))])
    gamma, size, seed = view
    weights, phases = projection(x.shape[1], size, gamma, seed)
    out = np.ones((len(x), size + 1))
    for low in range(0, len(x), VIEWED_ROWS):
        part = x[low : low + VIEWED_ROWS] @ weights
        part += phases
        np.multiply(np.cos(part, out=part), np.sqrt(2.0 / size), out=out[low : low + VIEWED_ROWS, :size])
    return out


def _terms(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of the logistic losses, their gradient and their second derivatives, one behind the other."""
    margin, sign = z @ w, 2 * y - 1
    p = 1 / (1 + np.exp(-margin))
    value = np.logaddexp(0, -sign * margin).sum()
    gradient = z.T @ (p - y)
    second = z.T @ (z * (p * (1 - p))[:, None])
    return np.concatenate([[len(y), value], gradient, second.ravel()])


def _hinge_terms(z: np.ndarray, y: np.ndarray, w: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the squared hinge by problem, a column of w and of rows: rows, losses and gradient; and what rows have a loss."""
    sign = (2 * y - 1)[:, None]
    short = np.where(rows, np.maximum(1 - sign * (z @ w), 0), 0.0)
    return np.vstack([rows.sum(axis=0), (short**2).sum(axis=0), -2 * (z.T @ (sign * short))]).T, short > 0


class Products:
    """Sums of z'z for several problems. Rows that the same problems have are multiplied once for all of them."""

    def __init__(self, problems: int, size: int):
        self.totals = [np.zeros((size, size)) for _ in range(problems)]
        self.sums: dict[int, np.ndarray] = {}  # by the problems that have the rows, as bits
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, z: np.ndarray, has: np.ndarray) -> None:
        """Rows, and which problems (columns) have them."""
        bits = has @ (1 << np.arange(has.shape[1]))
        own = np.flatnonzero(bits)
        self.waiting.append((z[own], bits[own]))
        self.rows += len(own)
        if self.rows >= ROWS_AT_ONCE:
            self._multiply()

    def _multiply(self) -> None:
        if not self.rows:
            return
        z, bits = (np.concatenate(v) for v in zip(*self.waiting, strict=True))
        self.waiting, self.rows = [], 0
        for own in np.unique(bits).tolist():
            rows = z[bits == own]
            self.sums[own] = self.sums.get(own, 0) + rows.T @ rows
        if len(self.sums) > SUMS_AT_ONCE:
            self._spread()

    def _spread(self) -> None:
        for own, found in self.sums.items():
            for i, total in enumerate(self.totals):
                if own >> i & 1:
                    total += found
        self.sums = {}

    def all(self) -> list[np.ndarray]:
        self._multiply()
        self._spread()
        return self.totals


def solve(blocks: DataFrame, problems: list[Problem], loss: str = LOGISTIC, steps: int = STEPS) -> list[np.ndarray]:
    """Coefficients and intercept of every problem. A step that would raise the sum is halved."""
    now: list[np.ndarray | None] = [None] * len(problems)
    before: list[tuple[np.ndarray, float] | None] = [None] * len(problems)
    open_ = set(range(len(problems)))
    for _ in range(steps):
        points = {i: now[i] for i in open_}
        alike: dict[tuple, list[int]] = {}
        for i in sorted(open_):
            alike.setdefault((problems[i].part, problems[i].view), []).append(i)
        lots = [own[k : k + PROBLEMS_AT_ONCE] for own in alike.values() for k in range(0, len(own), PROBLEMS_AT_ONCE)]

        def parts(own: Iterator[B.Block]) -> Iterator[tuple[int, np.ndarray]]:
            sums: dict[int, np.ndarray] = {}
            products: dict[int, Products] = {}  # by lot
            for block in own:
                views: dict = {}
                for number, lot in enumerate(lots):
                    part, view = problems[lot[0]].part, problems[lot[0]].view
                    if part != block.part:
                        continue
                    if view not in views:
                        views[view] = viewed(block.x, view)
                    z = views[view]
                    w = [np.zeros(z.shape[1]) if points[i] is None else points[i] for i in lot]
                    rows = [block.fold != problems[i].held_out for i in lot]
                    if loss == LOGISTIC:
                        found = [_terms(z[r], block.y[r], v) for v, r in zip(w, rows, strict=True)]
                    else:
                        found, short = _hinge_terms(z, block.y, np.column_stack(w), np.column_stack(rows))
                        products.setdefault(number, Products(len(lot), z.shape[1])).add(z, short)
                    for i, sum_ in zip(lot, found, strict=True):
                        sums[i] = sum_ if i not in sums else sums[i] + sum_
            for number, own_products in products.items():
                for i, second in zip(lots[number], own_products.all(), strict=True):
                    sums[i] = np.concatenate([sums[i], 2 * second.ravel()])
            yield from sums.items()

        for i, sums in B.summed(blocks, parts).items():
            size = int((-1 + np.sqrt(1 + 4 * (len(sums) - 2))) / 2)
            rows, value, gradient, second = sums[0], sums[1], sums[2 : 2 + size].copy(), sums[2 + size :].reshape(size, size).copy()
            w = np.zeros(size) if now[i] is None else now[i]
            value += problems[i].penalty / 2 * (w[:-1] ** 2).sum()
            gradient[:-1] += problems[i].penalty * w[:-1]
            if before[i] is not None and value > before[i][1] * (1 + 1e-12):
                now[i] = (w + before[i][0]) / 2
                continue
            now[i] = w
            if np.abs(gradient).max() <= TOLERANCE * max(rows, 1):
                open_.discard(i)
                continue
            second[np.arange(size - 1), np.arange(size - 1)] += problems[i].penalty
            before[i] = (w, value)
            now[i] = w - np.linalg.solve(second + 1e-12 * np.eye(size), gradient)
            if np.abs(now[i] - w).max() <= 1e-13 * max(1.0, np.abs(w).max()):
                open_.discard(i)
        if not open_:
            break
    return now


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def held_out_scores(blocks: DataFrame, problems: list[Problem], solutions: list[np.ndarray], settings: list[int]) -> DataFrame:
    """Scores of the rows that a problem's part does not know, by setting: SCORES."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.read(batches):
            rows = block.held_out
            for setting, p, w in zip(settings, problems, solutions, strict=True):
                if p.part == block.part and rows.any():
                    yield B.score_batch(setting, p.part, block.y[rows], _sigmoid(viewed(block.x[rows], p.view) @ w))

    return blocks.mapInArrow(run, B.SCORES)


def left_out_margins(blocks: DataFrame, problems: list[Problem], solutions: list[np.ndarray]) -> DataFrame:
    """Blocks of one feature: the margin of each row by the problem that did not see its fold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.read(batches):
            for p, w in zip(problems, solutions, strict=True):
                own = block.fold == p.held_out
                if p.part != block.part or not own.any():
                    continue
                margin = viewed(block.x[own], p.view) @ w
                cells = [block.part, int(own.sum()), *[v.tobytes() for v in (margin, block.y[own], block.fold[own], block.place[own])]]
                types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types, strict=True)], names=["part", "n", "x", "y", "fold", "place"])

    return blocks.mapInArrow(run, B.SCHEMA)


class LinearMachineModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Margin of a vector column; its class is the margin's sign, P(1) the sigmoid of slope * margin + shift.

    Without a view everything is column arithmetic; random Fourier features are a matrix product per batch.
    """

    machine = Param(Params._dummy(), "machine", "coefficients, view, slope and shift as JSON", TypeConverters.toString)

    def __init__(self, machine: str = "{}"):
        super().__init__()
        self._set(machine=machine)

    @classmethod
    def of(cls, solution: np.ndarray, view: tuple[float, int, int] | None = None, slope: float = 1.0, shift: float = 0.0) -> LinearMachineModel:
        return cls(json.dumps({"coefficients": solution.tolist(), "view": view, "slope": slope, "shift": shift}))

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.machine))

    @property
    def coefficients(self) -> np.ndarray:
        return np.array(self.fitted["coefficients"][:-1])

    @property
    def intercept(self) -> float:
        return self.fitted["coefficients"][-1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = self.fitted
        *weights, intercept = fitted["coefficients"]
        values = vector_to_array("features")
        if fitted["view"] is None:
            margin = F.lit(intercept)
            for i, w in enumerate(weights):
                margin = margin + values[i] * F.lit(w)
        else:
            view, solution = tuple(fitted["view"]), np.array(fitted["coefficients"])

            @F.pandas_udf("double")
            def through_view(vectors: pd.Series) -> pd.Series:
                return pd.Series(viewed(np.stack(vectors.to_numpy()), view) @ solution if len(vectors) else [])

            margin = through_view(values)
        scored = dataset.withColumn("margin", margin)
        p = 1 / (1 + F.exp(-(F.col("margin") * fitted["slope"] + fitted["shift"])))
        return scored.withColumns({
            "rawPrediction": array_to_vector(F.array(-F.col("margin"), F.col("margin"))),
            "probability": array_to_vector(F.array(1 - p, p)),
            "prediction": F.when(F.col("margin") > 0, 1.0).otherwise(0.0),
        })


def _moments(blocks: DataFrame) -> dict[int, np.ndarray]:
    """By part, of its own rows: cells of the feature matrix, their sum and their sum of squares; features."""

    def parts(own: Iterator[B.Block]) -> Iterator[tuple[int, np.ndarray]]:
        sums: dict[int, np.ndarray] = {}
        for block in own:
            x = block.x[~block.held_out]
            sums[block.part] = sums.get(block.part, 0) + np.array([x.size, x.sum(), (x**2).sum(), len(x)])
        yield from sums.items()

    return B.summed(blocks, parts)


def gamma_of(name: str | float, moments: np.ndarray) -> float:
    """'scale': one over features times the variance of all cells; 'auto': one over features."""
    cells, total, squares, rows = moments
    inputs = cells / rows
    if name == "scale":
        variance = squares / cells - (total / cells) ** 2
        return 1.0 / (inputs * variance) if variance > 0 else 1.0
    return 1.0 / inputs if name == "auto" else float(name)


class LogisticTrainer:
    """Logistic regression; C weighs the losses against the penalty."""

    def fit(self, blocks: DataFrame, C: float = 1.0) -> LinearMachineModel:
        return LinearMachineModel.of(solve(blocks, [Problem(B.ALL, 1 / C)])[0])

    def cross_scores(self, blocks: DataFrame, parts: list[int], settings: list[dict]) -> DataFrame:
        each = [(i, Problem(part, 1 / s.get("C", 1.0), part)) for i, s in enumerate(settings) for part in parts]
        problems = [p for _, p in each]
        return held_out_scores(blocks, problems, solve(blocks, problems), [i for i, _ in each])


class KernelTrainer:
    """RBF machine: random Fourier features and a squared hinge, its probability a sigmoid of the margin.

    The sigmoid is fitted on margins that no row had a part in: each fold's come from a machine fitted on
    the other folds.
    """

    def __init__(self, seed: int):
        self.seed = seed

    def _problem(self, moments: dict, part: int, held_out: int, C: float = 1.0, gamma: str | float = "scale", dimensions: int = 256) -> Problem:
        return Problem(part, 1 / C, held_out, (gamma_of(gamma, moments[part]), dimensions, self.seed))

    def fit(self, blocks: DataFrame, folds: int = 5, **setting) -> LinearMachineModel:
        own = blocks.where(F.col("part") == B.ALL)
        whole = self._problem(_moments(own), B.ALL, B.NO_FOLD, **setting)
        problems = [whole, *[replace(whole, held_out=k) for k in range(folds)]]
        solution, *others = solve(own, problems, SQUARED_HINGE)
        # kept, as each step reads them
        margins = left_out_margins(own, problems[1:], others).persist()
        slope, shift = solve(margins, [Problem(B.ALL, SIGMOID_PENALTY)])[0]
        margins.unpersist()
        return LinearMachineModel.of(solution, whole.view, float(slope), float(shift))

    def cross_scores(self, blocks: DataFrame, parts: list[int], settings: list[dict]) -> DataFrame:
        moments = _moments(blocks)
        each = [(i, self._problem(moments, part, part, **s)) for i, s in enumerate(settings) for part in parts]
        problems = [p for _, p in each]
        return held_out_scores(blocks, problems, solve(blocks, problems, SQUARED_HINGE), [i for i, _ in each])
