"""Benchmark passages in documents by a multi-pattern search over words.

The patterns are windows of consecutive item words.  For each window length there are three tables:
*shift* says, for a block of words, how far the search may move on after it has seen that block at
the end of its window; blocks that no pattern has allow the whole way.  Blocks with shift 0 end some
pattern: *buckets* hold these patterns by that block, and a bucket's patterns are compared with the
window word by word.

Windows are collected a bounded number at a time (``max_windows``); a larger benchmark is searched in
several passes, each with tables of that size, and the hits of all passes are united.

Defined results: a null text has no words; an item without words has no windows; an item without
an id counts as id ""; rows with the same item id are one item; repeated documents are judged one by one;
with an empty benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.text import append, as_bytes, words
from riskframe.session import materialise

WINDOW = 10
#: Pairs of a window and an item whose tables a task holds at a time, about.
MAX_WINDOWS = 200_000
#: Words in the blocks by which the search moves on.
BLOCK = 2


class Patterns:
    """Windows of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(BLOCK, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, set[str]]] = {}

    def add(self, window: tuple, item: str) -> None:
        for end in range(self.block, self.length + 1):
            block = window[end - self.block : end]
            self.shift[block] = min(self.shift.get(block, self.far), self.length - end)
        self.buckets.setdefault(window[-self.block :], {}).setdefault(window, set()).add(item)

    def search(self, text: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> None:
        shift, far, length, block = self.shift, self.far, self.length, self.block
        end, last = length, len(text)
        while end <= last:
            seen = tuple(text[end - block : end])
            move = shift.get(seen, far)
            if move:
                end += move
                continue
            window = tuple(text[end - length : end])
            # A dictionary: it picks by the hash of the words and compares them.
            if ids := self.buckets[seen].get(window):
                spans.append((end - length, end))
                items |= ids
            end += 1


def build(pairs: list[tuple[str, bytes]]) -> list[Patterns]:
    """Tables of (item, window) pairs; the words of a window are joined by spaces."""
    tables: dict[int, Patterns] = {}
    for item, window in pairs:
        ws = tuple(window.split(b" "))
        tables.setdefault(len(ws), Patterns(len(ws))).add(ws, item)
    return list(tables.values())


def windows(benchmark: DataFrame, item: str, item_text: str, window: int) -> DataFrame:
    """(id, words): the distinct windows of every item, words joined by spaces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, value in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text"))):
                ws = words(value)
                length = min(window, len(ws))
                starts = range(len(ws) - length + 1 if length else 0)
                for part in range(0, len(starts), 10_000):
                    found = [b" ".join(ws[i : i + length]) for i in starts[part : part + 10_000]]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found, pa.binary())], names=["id", "words"])

    name = F.coalesce(F.col(item).cast("string"), F.lit("")).alias("id")
    rows = benchmark.select(name, F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    return rows.mapInArrow(cut, "id string, words binary").distinct()


def united(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted, disjoint spans as one flat list."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


HITS = T.StructType().add("_words", "long").add("_spans", T.ArrayType(T.LongType())).add("_items", T.ArrayType(T.StringType()))


def _pass(docs: DataFrame, text: str, tables: list[Patterns], window: int) -> DataFrame:
    """``docs`` with the hits of these tables, united with those of earlier passes."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(tables)  # about max_windows pairs
    before = "_words" in docs.columns
    inputs = [text, "_spans", "_items"] if before else [text]

    def find(column: pa.Array, old_spans: pa.Array | None = None, old_items: pa.Array | None = None) -> list[pa.Array]:
        n_words, spans_out, items_out = [], [], []
        for row, value in enumerate(as_bytes(column)):
            ws = words(value)
            spans: list[tuple[int, int]] = []
            items: set[str] = set()
            for patterns in held.value:
                patterns.search(ws, spans, items)
            if before:
                flat = old_spans[row].as_py()
                spans += zip(flat[::2], flat[1::2])
                items |= set(old_items[row].as_py())
            n_words.append(len(ws))
            spans_out.append(united(spans))
            items_out.append(sorted(items))
        return [
            pa.array(n_words, pa.int64()),
            pa.array(spans_out, pa.list_(pa.int64())),
            pa.array(items_out, pa.list_(pa.string())),
        ]

    if not before:
        return append(docs, HITS, find, *inputs)
    renamed = T.StructType([T.StructField("_new" + f.name, f.dataType) for f in HITS])
    out = append(docs, renamed, find, *inputs).drop(*HITS.fieldNames())
    return out.withColumnsRenamed({"_new" + name: name for name in HITS.fieldNames()})


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` with ``_words`` (their number), ``_spans`` (hit words, flat start and end pairs) and ``_items``."""
    pairs = materialise(windows(benchmark, item, item_text, window), "windows")
    passes = max(1, math.ceil(pairs.count() / max_windows))
    out = docs
    for k in range(passes):
        part = pairs.where(F.pmod(F.xxhash64("id", "words"), F.lit(passes)) == k)
        tables = build([(r["id"], bytes(r["words"])) for r in part.collect()])
        out = _pass(out, text, tables, window)
        if k + 1 < passes:
            out = materialise(out, "decontaminate")
    return out


def hit_words(spans: Column) -> Column:
    """Number of words in flat, disjoint start and end pairs."""
    return F.aggregate(
        F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x
    )


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its words, the hit ones, and a digest of the items found in it."""
    marked = mark(docs.select(key, text), benchmark, text, **options)
    n_hit = hit_words(F.col("_spans"))
    return marked.select(
        F.col(key),
        F.col("_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
