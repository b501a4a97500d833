"""Pearson correlations of very many columns, by blocked cross-products.

Columns are cut into blocks.  A task reads its rows as batches of numbers and adds up, per pair of blocks, the
products X'X of the values and of their presence, as matrix products; a pair of columns counts the rows that have
both.  Per pair of blocks a task sends one row of sums, however many rows it read, and pairs of blocks are added up
in parallel: neither the plan nor the traffic grows with the square of the columns times the rows.

Values are taken relative to some value of their column, which cancels in the end but keeps digits that sums of
squares of large numbers would lose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.prefix import number
from riskframe.session import materialise, ship

#: Columns in a block.
BLOCK = 256
#: Tasks per core that keep sums; more input is read by the same tasks.
TASKS_PER_CORE = 4
#: Spread below this share of the mean square is rounding: the column is constant.
CONSTANT = 1e-13

_SUMS = ("n", "xy", "x", "y", "xx", "yy", "odd")


def _shifts(numbers: DataFrame, columns: list[str]) -> np.ndarray:
    """Some value of each column; 0 where it has none."""
    first = numbers.first()
    if first is None:
        return np.zeros(len(columns))
    found = [first[i] for i in range(len(columns))]
    missing = [i for i, v in enumerate(found) if v is None]
    for at in range(0, len(missing), BLOCK):
        part = missing[at : at + BLOCK]
        values = numbers.agg(*[F.any_value(f"c{i}", F.lit(True)) for i in part]).first()
        for i, v in zip(part, values):
            found[i] = v
    usable = [v if v is not None and np.isfinite(v) else 0.0 for v in found]
    return np.array(usable, float)


def cross_products(df: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """(i, j, sums): per pair of blocks i >= j the sums over complete pairs, as arrays in row order of a matrix.

    ``n`` rows with both values, ``xy``, ``x``, ``y``, ``xx``, ``yy`` sums of products and values, relative to a shift,
    without infinite ones; ``odd`` infinite values in rows with both.
    """
    ship(df.sparkSession)
    numbers = df.select(*[number(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    shift = _shifts(numbers, columns)
    ends = [min(at + block, len(columns)) for at in range(0, len(columns), block)]
    cuts = list(zip([0, *ends[:-1]], ends))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
            there = ~np.isnan(x)
            endless = np.isinf(x)
            x = np.where(there & ~endless, x - shift, 0.0)
            m = there.astype(float)
            e = endless.astype(float)
            some = endless.any()
            xx = x * x
            for i, (a, b) in enumerate(cuts):
                for j, (c, d) in enumerate(cuts[: i + 1]):
                    found = [
                        m[:, a:b].T @ m[:, c:d],
                        x[:, a:b].T @ x[:, c:d],
                        x[:, a:b].T @ m[:, c:d],
                        m[:, a:b].T @ x[:, c:d],
                        xx[:, a:b].T @ m[:, c:d],
                        m[:, a:b].T @ xx[:, c:d],
                        e[:, a:b].T @ m[:, c:d] + m[:, a:b].T @ e[:, c:d] if some else np.zeros((b - a, d - c)),
                    ]
                    if (i, j) in sums:
                        for total, one in zip(sums[i, j], found):
                            total += one
                    else:
                        sums[i, j] = found
        for (i, j), found in sums.items():
            parts = [pa.array([s.ravel().tobytes()], pa.binary()) for s in found]
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), *parts], names=["i", "j", *_SUMS])

    context = df.sparkSession.sparkContext
    tasks = max(1, context.defaultParallelism * TASKS_PER_CORE)
    kind = "i int, j int, " + ", ".join(f"{s} binary" for s in _SUMS)
    return numbers.coalesce(tasks).mapInArrow(add_up, kind)


def pearson(df: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """(feature_a, feature_b, corr) for every ordered pair of ``columns``.

    Over the rows that have both values; NaN is missing.  Null where either is constant there or no row has both,
    NaN where one of the values is infinite; a column with itself is 1.
    """
    products = materialise(cross_products(df, columns, block), "cross-products")

    def finish(parts: pa.Table) -> pa.Table:
        i, j = parts["i"][0].as_py(), parts["j"][0].as_py()
        rows, width = min(block, len(columns) - i * block), min(block, len(columns) - j * block)
        sums = {}
        for name in _SUMS:
            total = np.zeros(rows * width)
            for piece in parts[name]:
                total += np.frombuffer(piece.as_buffer(), float)
            sums[name] = total.reshape(rows, width)
        n = np.maximum(sums["n"], 1.0)
        spread = {}
        for one, two in (("x", "xx"), ("y", "yy")):
            s = sums[two] - sums[one] * sums[one] / n
            spread[one] = np.where(s > CONSTANT * sums[two], s, 0.0)
        known = (sums["n"] > 0) & (spread["x"] > 0) & (spread["y"] > 0)
        scale = np.sqrt(np.where(known, spread["x"], 1.0)) * np.sqrt(np.where(known, spread["y"], 1.0))
        corr = np.clip((sums["xy"] - sums["x"] * sums["y"] / n) / scale, -1.0, 1.0)
        # An infinite value has no distance from a mean.
        corr, known = np.where(sums["odd"] > 0, np.nan, corr), known | (sums["odd"] > 0)
        a, b = np.meshgrid(np.arange(rows) + i * block, np.arange(width) + j * block, indexing="ij")
        a, b, corr, known = a.ravel(), b.ravel(), corr.ravel(), known.ravel()
        if i == j:
            corr = np.where(a == b, 1.0, corr)
        else:
            a, b, corr, known = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(corr, 2), np.tile(known, 2)
        names = pa.array(columns, pa.string())
        return pa.table({"feature_a": names.take(pa.array(a)), "feature_b": names.take(pa.array(b)), "corr": pa.array(corr, mask=~known, from_pandas=False)})

    return products.groupBy("i", "j").applyInArrow(finish, "feature_a string, feature_b string, corr double")
