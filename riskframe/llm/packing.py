"""Best-fit packing of token sequences by exact complements.

How many pieces there are of each length is all that the plan needs: at most ``capacity`` numbers, whatever
the corpus.  The plan opens sequences with the longest piece left and looks for one piece, a pair or three
pieces whose lengths add up to the gap exactly, as long as pieces of these lengths are left; if there are none,
the longest piece that fits goes in and the search repeats on the smaller gap.  Each such combination is used
as often as the counts allow, so the plan has few entries with a multiplicity each.

Pieces take their places by rank among those of the same length.  A rank is the rank in the task that wrote
the piece plus the pieces of that length of all tasks before it; no group of equal lengths is gathered.

Defined results: a null text is an empty one, which has the closing id only; repeated rows are packed one
by one; longer texts are cut at ``capacity``; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm import tokens
from riskframe.session import materialise

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END = 0

_PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, nth bigint"


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
    kept_pieces: int = tokens.KEPT_PIECES, part_bytes: int = tokens.PART_BYTES,
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids, with its rank among equal lengths of its task.

    ``kept_pieces`` and ``part_bytes`` bound a worker's memory at the price of encoding more words twice; a
    worker that keeps fewer than usual also gives its memory back after each task.
    """
    schema = f"{docs.select(key).schema.fields[0].dataType.simpleString()}"
    columns = f"`{key}` {schema}, {_PIECE}" + (", ids array<bigint>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        closing = np.array([end], np.uint32)
        for batch in batches:
            rows, number, start, length, crc, nth, kept = [], [], [], [], [], [], []
            for row, ids in enumerate(tokens.ids(batch.column("text"), tokenizer, kept_pieces, part_bytes)):
                ids = np.concatenate([ids, closing]).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    n = len(part)
                    rows.append(row)
                    number.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part.tobytes()))
                    nth.append(int(seen[n]))
                    seen[n] += 1
                    if with_ids:
                        kept.append(part.astype(np.int64))
            made = [
                batch.column(key).take(pa.array(rows, pa.int64())),
                pa.array(number, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                pa.array([task] * len(rows), pa.int64()),
                pa.array(nth, pa.int64()),
            ]
            names = [key, "piece", "start", "length", "ids_crc32", "task", "nth"]
            if with_ids:
                made.append(pa.array(kept, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(made, names=names)
        if kept_pieces < tokens.KEPT_PIECES:
            tokens.forget()

    return docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(cut, columns)


class Sums:
    """Lengths that are left, and the sums of one, two and three of them."""

    def __init__(self, counts: np.ndarray):
        self.left = counts

    def one(self, gap: int) -> tuple[int, ...]:
        return (gap,) if self.left[gap] > 0 else ()

    def two(self, gap: int) -> tuple[int, ...]:
        """The pair of which most are left."""
        half = gap // 2
        if half < 1:
            return ()
        low = self.left[1 : half + 1]
        high = self.left[gap - half : gap][::-1]
        often = np.minimum(low, high)
        if gap % 2 == 0:
            often = often.copy()
            often[-1] = self.left[half] // 2
        best = int(np.argmax(often))
        return (gap - best - 1, best + 1) if often[best] > 0 else ()

    def three(self, gap: int) -> tuple[int, ...]:
        """A triple that starts with a frequent length."""
        for first in np.argsort(-self.left[: max(gap - 1, 1)], kind="stable"):
            first = int(first)
            if self.left[first] <= 0:
                break
            if first == 0:
                continue
            self.left[first] -= 1
            pair = self.two(gap - first)
            self.left[first] += 1
            if pair:
                return (first, *pair)
        return ()

    def exact(self, gap: int) -> tuple[int, ...]:
        return self.one(gap) or self.two(gap) or self.three(gap)

    def longest(self, most: int) -> int:
        there = np.flatnonzero(self.left[: most + 1] > 0)
        return int(there[-1]) if len(there) and there[-1] > 0 else 0


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), covering every piece."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    sums = Sums(left)
    out = []
    while (longest := sums.longest(capacity)) > 0:
        recipe: list[int] = []

        def take(lengths: tuple[int, ...], recipe: list[int] = recipe) -> int:
            for n in lengths:
                left[n] -= 1
                recipe.append(n)
            return capacity - sum(recipe)

        gap = take((longest,))
        while gap > 0:
            found = sums.exact(gap)
            if not found and (fit := sums.longest(gap)):
                found = (fit,)
            if not found:
                break
            gap = take(found)
        lengths, uses = np.unique(recipe, return_counts=True)
        more = int((left[lengths] // uses).min())
        left[lengths] -= more * uses
        out.append((tuple(recipe), 1 + more))
    return out


def _slots(recipes: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """For each length, runs of ranks: (length, first rank, first sequence, offset), sorted."""
    used: dict[int, int] = {}
    rows = []
    sequence = 0
    for lengths, times in recipes:
        offset = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    table = np.array(sorted(rows) or np.zeros((0, 4)), np.int64).reshape(-1, 4)
    return tuple(table.T)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **options) -> DataFrame:
    """Pieces with ``sequence_id`` and the ``offset`` in that sequence."""
    written = materialise(pieces(docs, key, text, capacity=capacity, **options), "pieces")
    per_task = materialise(written.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-lengths")
    # At most ``capacity`` rows reach the driver.
    totals = per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    length_, rank_, sequence_, offset_ = _slots(plan({r["length"]: r["n"] for r in totals}, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = written.join(first, ["task", "length"])
    names = [c for c in written.columns if c not in ("task", "nth")]
    out = ranked.select(*names, (F.col("first") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if f.name != "rank")
    starts = np.searchsorted(length_, np.arange(capacity + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            slot = np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths):
                mine = lengths == n
                run = rank_[starts[n] : starts[n + 1]]
                slot[mine] = starts[n] + np.searchsorted(run, ranks[mine], side="right") - 1
            sequence = sequence_[slot] + ranks - rank_[slot]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset_[slot], pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    return out.mapInArrow(place, schema + ", sequence_id bigint, offset bigint")
