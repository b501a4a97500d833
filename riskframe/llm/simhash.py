"""Near-duplicates by SimHash, found by exact comparison of tiles of fingerprints.

Distinct fingerprints are laid out in tiles by the population counts of their four 16-bit quarters.  Two
fingerprints differ in at least as many bits as the counts of their quarters differ in sum, so a tile meets
only tiles whose counts are within the radius; all other pairs of tiles are skipped.  What meets is compared
in full, by exclusive-or and bit counts over the two tiles.

A pair of tiles yields a spanning forest of its links, not all pairs, so a group of many near copies costs
as many rows as it has members.  Components of these links are the same as those of all links.

Defined results: a null or empty text has fingerprint zero and is linked like any other; repeated rows share
a fingerprint; a row without an id takes part and a group of such rows only has a null id; an empty table
gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.components import components
from riskframe.llm.text import append, as_bytes, spaced
from riskframe.session import materialise

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints in a tile, about.
TILE = 2048
QUARTERS = 4


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = spaced(text)
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(itertools.accumulate(map(len, words), lambda a, x: a + 1 + x))
        starts = [0, *(e + 1 for e in ends[: n - 1])]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    array = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(array), 4096):
        part = array[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = (2 * counts > len(array)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit number."""

    def compute(column: pa.Array) -> list[pa.Array]:
        made = np.array([fingerprint(t, shingle) for t in as_bytes(column)], dtype=np.uint64)
        return [pa.array(made.view(np.int64), pa.int64())]

    return append(docs, T.StructType().add(name, "long"), compute, text)


def _quarter_counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(QUARTERS)]


def _cell(counts: list[Column]) -> Column:
    cell = F.lit(0)
    for c in counts:
        cell = cell * 17 + c
    return cell


def tiles(fingerprints: DataFrame) -> DataFrame:
    """(cell, chunk, fps) of the distinct values in ``fp``."""
    cells = fingerprints.withColumn("cell", _cell(_quarter_counts(F.col("fp"))))
    # At most 17^4 cells, whatever the corpus.
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))
    return (
        cells.join(F.broadcast(sizes), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int").alias("chunk"))
        .agg(F.collect_list("fp").alias("fps"))
    )


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts that a pair within the radius can have."""
    reach = range(-radius, radius + 1)
    return [d for d in itertools.product(reach, repeat=QUARTERS) if sum(map(abs, d)) <= radius]


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what any links between ``a`` and ``b`` connect."""
    rows, columns = [], []
    step = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        rows.append(i + at)
        columns.append(j)
    left, right = np.concatenate(rows), np.concatenate(columns)
    if not len(left):
        return a[:0], b[:0]
    nodes, both = np.unique(np.concatenate([a[left], b[right]]), return_inverse=True)
    u, v = both[: len(left)], both[len(left) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a forest of the links between distinct fingerprints at most ``radius`` bits apart."""
    layout = materialise(tiles(fingerprints), "tiles")
    steps = _steps(radius)
    # Cells are pairs of numbers of four digits to base 17; their neighbours follow from the steps.
    digits = [F.floor(F.col("cell") / 17 ** (QUARTERS - 1 - i)) % 17 for i in range(QUARTERS)]
    moves = F.array(*(F.array(*(F.lit(d) for d in step)) for step in steps))
    moved = [F.col("digits")[i] + F.col("step")[i] for i in range(QUARTERS)]
    valid = F.lit(True)
    for m in moved:
        valid = valid & m.between(0, 16)
    # Existing cells only: at most 17^4 rows.
    there = F.broadcast(layout.select(F.col("cell").alias("near")).distinct())
    asked = (
        layout.select("cell", F.array(*digits).alias("digits"), "chunk", "fps")
        .withColumn("step", F.explode(moves))
        .where(valid)
        .withColumn("near", _cell(moved).cast("int"))
        .where("near >= cell")
        .join(there, "near", "left_semi")
        .select("near", F.col("cell").alias("own"), F.col("chunk").alias("own_chunk"), F.col("fps").alias("a"))
    )
    pairs = (
        asked.join(layout.select(F.col("cell").alias("near"), "chunk", F.col("fps").alias("b")), "near")
        .where("near > own OR chunk >= own_chunk")
        .select("a", "b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            a, b = batch.column("a"), batch.column("b")
            values_a, ends_a = a.values.to_numpy().view(np.uint64), a.offsets.to_numpy()
            values_b, ends_b = b.values.to_numpy().view(np.uint64), b.offsets.to_numpy()
            for row in range(batch.num_rows):
                x, y = forest(
                    values_a[ends_a[row] : ends_a[row + 1]], values_b[ends_b[row] : ends_b[row + 1]], radius
                )
                found_a.append(x)
                found_b.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(f).view(np.int64), pa.int64()) for f in (found_a, found_b)], names=["a", "b"]
            )

    return pairs.mapInArrow(compare, "a bigint, b bigint")


def classes(docs: DataFrame, key: str, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """(fp, least) of every distinct fingerprint: the smallest key of its component."""
    distinct = materialise(docs.groupBy(fp).agg(F.min(key).alias("first")).withColumnRenamed(fp, "fp"), "fingerprints")
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    # Only fingerprints with links share a root, and those are few; alone, a fingerprint is its own root.
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(least, "root").select("fp", "least")


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id) of every row."""
    marked = materialise(with_fingerprint(docs.select(key, text), text, "fp", shingle).select(key, "fp"), "simhash")
    found = classes(marked, key, "fp", radius)
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(found, "fp").select(key, shown.alias("fingerprint"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest key (rows without a key come last)."""
    rows = with_fingerprint(docs, text, "_fp", shingle).withColumn("_row", F.monotonically_increasing_id())
    written = materialise(rows, "simhash-rows")
    ids = written.select("_fp", "_row", F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), "_row").alias("order"))
    roots = components(links(ids.select(F.col("_fp").alias("fp")).distinct(), radius))
    rooted = ids.join(roots, F.col("_fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "_fp"))
    kept = rooted.groupBy("root").agg(F.min("order").alias("order")).select(F.col("order._row").alias("_row"))
    return written.join(kept, "_row", "left_semi").select(*docs.columns)
