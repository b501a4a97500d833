"""Exact top-k by integer inner product, by distributed histogram selection.

Every query is scored against every vector, a block of queries against a tile of vectors at a time, and no
score is stored.  A pass counts, per query, how many scores fall into each of a few thousand buckets of the
range that is still open; the counts of all tiles are added up and the bucket that holds the k-th value is the
next range.  When the range is one number, the k-th value is known: a last pass keeps what is above it, and of
the ties on it those with the smallest ids.

A tile reports buckets from its highest score down to its own k-th only: the k-th value of all cannot be
lower.  So a pass moves at most k counts per query and tile.

Defined results: vectors that are null or hold null or non-finite components take no part; every row is a vector
of its own and is scored against every other row, so rows that repeat an id are candidates (and queries) one by
one, a query's own row alone excepted; rows without an id take no part; shorter vectors are filled up with zeros;
scores are 64-bit and wrap around beyond; fewer than k other vectors give as many ranks; an empty table gives no
rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import materialise

K = 10
SCALE = 1024
BUCKETS = 4096
#: Vectors in a tile and queries in a block, about.
TILE = 8192
QUERY_BLOCK = 1024


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Scores:
    """Scores of a block of queries against a tile of vectors, query by query."""

    def __init__(self, queries: pa.Table, vectors: pa.Table, width: int):
        self.rows, self.ids = vectors["row"].to_numpy(), vectors["id"].to_numpy()
        q, v = _matrix(queries["v"], width), _matrix(vectors["v"], width)
        largest = float(np.abs(q.astype(float)).sum(axis=1).max(initial=0)) * float(np.abs(v.astype(float)).max(initial=0))
        # Sums below 2^53 are exact in doubles, for which matrix products are fast.
        self._q, self._v = (q.astype(float), v.astype(float).T) if largest < 2**53 else (q, v.T)
        self._own = queries["row"].to_numpy()

    def __iter__(self):
        for at in range(0, len(self._own), 64):
            scores = (self._q[at : at + 64] @ self._v).astype(np.int64)
            for row, own in zip(scores, self._own[at : at + 64]):
                others = self.rows != own
                yield row[others], self.ids[others]


def _tiles(vectors: DataFrame, queries: DataFrame, n: int, n_queries: int):
    n_tiles, n_blocks = max(1, math.ceil(n / TILE)), max(1, math.ceil(n_queries / QUERY_BLOCK))

    def all_of(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = queries.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks)).cast("int")).withColumn("tile", all_of(n_tiles))
    right = vectors.withColumn("tile", F.pmod(F.xxhash64("row"), F.lit(n_tiles)).cast("int")).withColumn("block", all_of(n_blocks))
    return left.groupBy("tile", "block").cogroup(right.groupBy("tile", "block"))


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other vectors for each row where ``is_query`` holds."""
    rows = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull())
    one = rows.select(F.col(key).cast("long").alias("id"), quantised(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    # Rows are numbered once and written, so that a repeated task does not number them anew.
    one = materialise(one.withColumn("row", F.monotonically_increasing_id()), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, n_queries, width, most = one.select("asks", F.size("v").alias("w"), norm.alias("norm")).agg(
        F.count("*"), F.coalesce(F.sum(F.col("asks").cast("int")), F.lit(0)), F.coalesce(F.max("w"), F.lit(0)), F.coalesce(F.max("norm"), F.lit(0.0))
    ).first()
    wanted = min(k, n - 1)
    if wanted < 1 or not n_queries:
        return one.limit(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score"))
    # No score is beyond the product of the two lengths.
    reach = F.least(F.ceil(F.sqrt(norm * F.lit(most))) + 1, F.lit(float(2**61))).cast("long")
    queries = one.where("asks").select("row", "id", "v", (-reach).alias("low"), (2 * reach + 1).alias("width"), F.lit(wanted).cast("long").alias("want"))
    candidates = one.select("row", "id", "v")

    def histogram(asked: pa.Table, tile: pa.Table) -> pa.Table:
        out_id, out_bucket, out_n = [], [], []
        if asked.num_rows and tile.num_rows:
            state = zip(*(asked[c].to_pylist() for c in ("row", "low", "width", "want")))
            for (query, low, span, want), (scores, _) in zip(state, Scores(asked, tile, width)):
                scores = scores[(scores >= low) & (scores - low < span)]
                if len(scores) > want:
                    scores = scores[scores >= np.partition(scores, len(scores) - want)[len(scores) - want]]
                buckets, counts = np.unique((scores - low) // -(-span // BUCKETS), return_counts=True)
                out_id += [query] * len(buckets)
                out_bucket += buckets.tolist()
                out_n += counts.tolist()
        return pa.table({"row": pa.array(out_id, pa.int64()), "bucket": pa.array(out_bucket, pa.int64()), "n": pa.array(out_n, pa.int64())})

    while queries.agg(F.max("width")).first()[0] > 1:
        counted = _tiles(candidates, queries, n, n_queries).applyInArrow(histogram, "row bigint, bucket bigint, n bigint")
        down = Window.partitionBy("row").orderBy(F.desc("bucket"))
        reached = (
            counted.groupBy("row", "bucket")
            .agg(F.sum("n").alias("n"))
            .withColumn("sofar", F.sum("n").over(down))
            .join(queries, "row")
            .where((F.col("sofar") >= F.col("want")) & (F.col("sofar") - F.col("n") < F.col("want")))
        )
        step = F.ceil(F.col("width") / BUCKETS)
        queries = materialise(
            reached.select(
                "row", "id", "v", (F.col("low") + F.col("bucket") * step).alias("low"), step.alias("width"), (F.col("want") - F.col("sofar") + F.col("n")).alias("want")
            ),
            "top-k",
        )

    def keep(asked: pa.Table, tile: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 4]
        if asked.num_rows and tile.num_rows:
            state = zip(*(asked[c].to_pylist() for c in ("row", "id", "low", "want")))
            for (row, query, least, want), (scores, ids) in zip(state, Scores(asked, tile, width)):
                ties = np.sort(ids[scores == least])[:want]
                above = scores > least
                found = above.sum() + len(ties)
                out.append((np.full(found, row), np.full(found, query), np.concatenate([ids[above], ties]), np.concatenate([scores[above], np.full(len(ties), least)])))
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)]
        return pa.table(dict(zip(("row", "query_id", "vec_id", "score"), columns)))

    kept = _tiles(candidates, queries, n, n_queries).applyInArrow(keep, "row bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
