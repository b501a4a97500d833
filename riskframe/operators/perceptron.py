"""Perceptrons by iterative parameter mixing.

Rows are dealt to shards of a fixed size by a digest and written once.  In each epoch every shard starts from the same
weights and reads its rows in mini-batches: rows that are not on the right side of the hyperplane pull the weights
their way.  The weights that the shards end with are averaged, by rows, into the start of the next epoch (a job with
one row of sums per weight).  The model is the average over all steps of the last epoch, which for separable rows are
the weights that separate them.

Several members, each blind to one fold, are trained by the same passes.

Defined results: a row without a label is not learnt from; without any labelled row all weights are 0; rows of one class
give weights that put them on its side; repeated rows count each.  Keys should be unique: rows of one key share a shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise, ship

#: Rows of a shard, whatever the size of the table.
SHARD_ROWS = 1 << 18
#: Rows of a mini-batch.
BATCH_ROWS = 64
#: Strength of the penalty, its share of absolute weights, and epochs without progress before a stop.
ALPHA = 1e-4
L1_RATIO = 0.15
PATIENCE = 5

PENALTIES = ("none", "l1", "l2", "elasticnet")


@dataclass(frozen=True)
class Settings:
    """``eta0`` is the size of a step, ``tol`` the share by which the mean loss must fall to count as progress.

    A share, since the loss of a perceptron grows with ``eta0`` and with the features' scales.
    """

    max_iter: int = 1000
    eta0: float = 1.0
    penalty: str = "none"
    alpha: float = ALPHA
    l1_ratio: float = L1_RATIO
    tol: float = 1e-3

    def __post_init__(self) -> None:
        if self.penalty not in PENALTIES:
            raise ValueError(f"unknown penalty {self.penalty!r}; known: {', '.join(PENALTIES)}")
        if self.max_iter < 1 or not self.eta0 > 0:
            raise ValueError("max_iter must be 1 or more and eta0 positive")

    @property
    def shrink(self) -> tuple[float, float]:
        """Per step: the share by which weights shrink, and the amount that is taken off their size."""
        ratio = {"none": 0.0, "l1": 1.0, "l2": 0.0, "elasticnet": self.l1_ratio}[self.penalty]
        size = 0.0 if self.penalty == "none" else self.eta0 * self.alpha
        return size * (1.0 - ratio), size * ratio


def shards(rows: DataFrame, x: str, y: str, key: str, fold: str | None = None) -> DataFrame:
    """(shard, fold, y, x) written once: y is -1 or 1, x an array of numbers; order within a shard is by digest.

    A null fold counts as a fold of its own, which every member sees.
    """
    n = rows.where(F.col(y).isNotNull()).count()
    count = max(1, math.ceil(n / SHARD_ROWS))
    digest = F.xxhash64(F.lit("perceptron"), F.col(key))
    dealt = rows.where(F.col(y).isNotNull()).select(
        F.pmod(digest, F.lit(count)).alias("shard"),
        F.coalesce(F.col(fold).cast("int") if fold else F.lit(None), F.lit(-1)).alias("fold"),
        (F.col(y).cast("double") * 2 - 1).alias("y"),
        vector_to_array(x).alias("x"),
        F.xxhash64(digest).alias("_order"),
    )
    ordered = dealt.repartition(count, "shard").sortWithinPartitions("shard", "_order", "x", "y")
    return materialise(ordered.drop("_order"), "perceptron-shards")


class _Learner:
    """Weights of all members while a shard is read; the last weight is the intercept."""

    def __init__(self, start: np.ndarray, blind: np.ndarray, settings: Settings):
        self.w, self.blind, self.eta = start.copy(), blind, settings.eta0
        self.shrink, self.cut = settings.shrink
        self.sums = np.zeros_like(start)
        self.steps = 0
        self.rows, self.errors, self.loss = (np.zeros(len(start)) for _ in range(3))

    def read(self, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> None:
        for at in range(0, len(y), BATCH_ROWS):
            here = slice(at, at + BATCH_ROWS)
            xb, yb = x[here], y[here, None]
            used = fold[here, None] != self.blind[None, :]
            side = yb * (xb @ self.w.T)
            wrong = (side <= 0) & used
            n = used.sum(axis=0)
            self.rows += n
            self.errors += wrong.sum(axis=0)
            self.loss -= np.where(wrong, side, 0.0).sum(axis=0)
            pull = (wrong * yb).T @ xb / np.maximum(n, 1)[:, None]
            if self.shrink or self.cut:
                # The intercept is not penalised.
                kept = self.w[:, :-1] * (1.0 - self.shrink)
                self.w[:, :-1] = np.sign(kept) * np.maximum(np.abs(kept) - self.cut, 0.0)
            self.w += self.eta * pull
            self.sums += self.w
            self.steps += 1

    def row(self) -> dict:
        share = self.rows[:, None]
        return {
            "member": list(range(len(self.w))),
            "rows": self.rows.tolist(),
            "errors": self.errors.tolist(),
            "loss": self.loss.tolist(),
            "ends": (self.w * share).tolist(),
            "means": (self.sums / max(self.steps, 1) * share).tolist(),
        }


_SCHEMA = pa.schema(
    [
        ("member", pa.int32()), ("rows", pa.float64()), ("errors", pa.float64()), ("loss", pa.float64()),
        ("ends", pa.list_(pa.float64())), ("means", pa.list_(pa.float64())),
    ]
)
_DDL = "member int, rows double, errors double, loss double, ends array<double>, means array<double>"


def _epoch(data: DataFrame, start: np.ndarray, blind: np.ndarray, settings: Settings) -> dict[str, np.ndarray]:
    """One pass of all shards from the same weights, and their mix."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, current = None, None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            y = batch.column("y").to_numpy()
            fold = batch.column("fold").to_numpy()
            x = batch.column("x").flatten().to_numpy().reshape(len(y), start.shape[1] - 1)
            x = np.column_stack([x, np.ones(len(y))])
            ends = np.flatnonzero(np.diff(shard)) + 1
            for i, j in zip([0, *ends.tolist()], [*ends.tolist(), len(y)]):
                if i == j:
                    continue
                if shard[i] != current:
                    if learner is not None:
                        yield pa.RecordBatch.from_pydict(learner.row(), schema=_SCHEMA)
                    learner, current = _Learner(start, blind, settings), shard[i]
                learner.read(x[i:j], y[i:j], fold[i:j])
        if learner is not None:
            yield pa.RecordBatch.from_pydict(learner.row(), schema=_SCHEMA)

    out = data.select("shard", "fold", "y", "x").mapInArrow(learn, _DDL)
    spread = out.select("member", "rows", "errors", "loss", F.posexplode(F.arrays_zip("ends", "means")).alias("slot", "w"))
    mixed = spread.groupBy("member", "slot").agg(
        F.sum("rows").alias("rows"), F.sum("errors").alias("errors"), F.sum("loss").alias("loss"),
        F.sum("w.ends").alias("ends"), F.sum("w.means").alias("means"),
    )
    # As many rows as the model has numbers.
    totals = {name: np.zeros(start.shape) for name in ("rows", "errors", "loss", "ends", "means")}
    for r in mixed.collect():
        for name, values in totals.items():
            values[r["member"], r["slot"]] = r[name]
    return totals


def train(
    rows: DataFrame,
    x: str,
    y: str,
    key: str,
    *,
    fold: str | None = None,
    members: int = 1,
    settings: Settings = Settings(),
) -> np.ndarray:
    """(members, features + 1): weights per member, the intercept last.

    ``y`` is 0 or 1.  With ``fold`` the member ``i`` does not learn from rows of fold ``i``.  A member stops when it makes
    no mistake in an epoch, or when its mean loss has not fallen by the share ``tol`` for some epochs.
    """
    ship(rows.sparkSession)
    data = shards(rows, x, y, key, fold)
    first = data.select(F.size("x").alias("n")).first()
    width = (first["n"] if first is not None else 0) + 1
    blind = np.arange(members) if fold else np.full(members, -2)
    weights, model = np.zeros((members, width)), np.zeros((members, width))
    best, waited, active = np.full(members, np.inf), np.zeros(members, int), np.ones(members, bool)
    if first is None:
        return model
    for _ in range(settings.max_iter):
        still = np.flatnonzero(active)
        found = _epoch(data, weights[still], blind[still], settings)
        for at, member in enumerate(still.tolist()):
            n = found["rows"][at, -1]
            if n == 0:
                active[member] = False
                continue
            weights[member], model[member] = found["ends"][at] / n, found["means"][at] / n
            loss = found["loss"][at, -1] / n
            waited[member] = waited[member] + 1 if loss > best[member] * (1.0 - settings.tol) else 0
            best[member] = min(best[member], loss)
            active[member] = found["errors"][at, -1] > 0 and waited[member] < PATIENCE
        if not active.any():
            break
    return model
