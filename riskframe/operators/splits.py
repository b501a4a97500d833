"""Exact, repeatable stratified splits, folds and nested samples.

Rows are ordered inside each class by ``md5(seed:key)``.  A split boundary is then one
digest per class, so assigning rows is a per-row comparison: no shuffle, no join and
the same answer whatever the file layout.  Finding the boundary counts rows per
(class, digest prefix) and afterwards sorts only the few prefixes that hold a boundary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.session import materialise

# Classes up to which boundaries are written into the plan.
INLINE_CLASSES = 50


def digest(key: str, seed: int) -> Column:
    """Uniform, seed-dependent order for rows with a unique key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


@dataclass(frozen=True)
class Cuts:
    """Per class, ascending digests; a row with digest <= cut i lies in the first i+1 parts."""

    key: str
    label: str
    seed: int
    names: list[str]
    boundaries: dict[object, list[str]]

    def assign(self, df: DataFrame, column: str = "split") -> DataFrame:
        """Add the part name of every row; rows of a class unseen by ``fit`` get null.

        Few classes become one expression per row; many become a table of boundaries joined by class, so
        the plan does not grow with them.  Both compare the same digests, made once per row; a filter on the
        part makes them again for every boundary, so write the rows before reading them by part.
        """
        return assign_all(df, [self], [column])

    def _part(self, row_digest: Column, ends: Column) -> Column:
        """Name of the first part whose end is not below the digest.

        A search in an array: a branch per boundary would make the compiled code too long for the JVM to compile it.
        """
        names = F.array(*[F.lit(n) for n in (self.names[-1], *self.names[:-1])])
        at = F.array_position(F.transform(ends, lambda end: row_digest <= end), True).cast("int")
        # Asking for null here keeps the digest out of the search, where it would be made for every boundary.
        return F.when(ends.isNull(), None).when(row_digest.isNull(), F.lit(self.names[-1])).otherwise(F.get(names, at))


def assign_all(df: DataFrame, cuts: list[Cuts], columns: list[str]) -> DataFrame:
    """Add a part name per cuts, as ``Cuts.assign`` does; cuts of the same key and seed share the digests."""
    digests = {(c.key, c.seed): f"_{column}_digest" for c, column in reversed(list(zip(cuts, columns, strict=True)))}
    for (key, seed), at in digests.items():
        df = df.withColumn(at, digest(key, seed))
    for c, column in zip(cuts, columns, strict=True):
        row_digest = F.col(digests[c.key, c.seed])
        if len(c.boundaries) > INLINE_CLASSES:
            kind = df.schema[c.label].dataType
            rows = [(value, ends) for value, ends in c.boundaries.items()]
            schema = T.StructType([T.StructField("_class", kind), T.StructField("_ends", T.ArrayType(T.StringType()))])
            table = df.sparkSession.createDataFrame(rows, schema)
            joined = df.join(table, F.col(c.label).eqNullSafe(F.col("_class")), "left")
            df = joined.withColumn(column, c._part(row_digest, F.col("_ends"))).drop("_class", "_ends")
            continue
        ends = F.lit(None).cast("array<string>")
        for value, listed in c.boundaries.items():
            same = F.col(c.label).isNull() if value is None else F.col(c.label) == F.lit(value)
            ends = F.when(same, F.array(*[F.lit(e) for e in listed])).otherwise(ends)
        df = df.withColumn(column, c._part(row_digest, ends))
    return df.drop(*digests.values())


def _located(counts: DataFrame, by: list[str], ends: list[Column]) -> DataFrame:
    """(by..., prefix, cut, nth): the prefix that holds each end, and the end's place among the rows of that prefix."""
    whole = Window.partitionBy(*by)
    running = whole.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *by,
        "prefix",
        "n",
        F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("n_class"),
    )
    cut = F.posexplode(F.array(*[e.cast("long") for e in ends])).alias("cut", "rank")
    located = counts.select("*", cut)
    located = located.where(
        ((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n")))
        | ((F.col("rank") <= 0) & (F.col("before") == 0))
    )
    return located.select(*by, "prefix", "cut", (F.col("rank") - F.col("before")).alias("nth"))


def _fit_cuts(
    df: DataFrame,
    key: str,
    label: str,
    seed: int,
    names: list[str],
    ends: list[Column],
    prefix_digits: int,
) -> Cuts:
    """``ends[i]`` is a formula over ``n_class``: how many rows lie in parts 0..i."""
    rows = df.select(F.col(label).alias("label"), digest(key, seed).alias("digest"))
    rows = rows.withColumn("prefix", F.substring("digest", 1, prefix_digits))
    counts = rows.groupBy("label", "prefix").agg(F.count(F.lit(1)).alias("n"))
    found = _located(counts, ["label"], ends)
    # One row per class and cut: the size of the answer.
    found = materialise(found, "cuts")
    located_rows = found.collect()

    boundaries: dict[object, list[str]] = {r["label"]: [""] * len(ends) for r in located_rows}
    wanted = found.where(F.col("nth") > 0).withColumnsRenamed({"label": "_label", "prefix": "_prefix", "nth": "_nth"})
    cells = wanted.select("_label", "_prefix").distinct()
    nth = Window.partitionBy("label", "prefix").orderBy("digest")
    same_cell = F.col("label").eqNullSafe(F.col("_label")) & (F.col("prefix") == F.col("_prefix"))
    ranked = rows.join(cells, same_cell, "left_semi").withColumn("nth", F.row_number().over(nth))
    hits = ranked.join(wanted, same_cell & (F.col("nth") == F.col("_nth")))
    for r in hits.select("label", "cut", "digest").collect():
        boundaries[r["label"]][r["cut"]] = r["digest"]
    return Cuts(key, label, seed, names, boundaries)


def fit_fold_fractions(
    df: DataFrame, key: str, label: str, fractions: list[float], fold: str, k: int, *, seed: int = 42, prefix_digits: int = 4
) -> list[Cuts]:
    """For each of ``k`` folds what ``fit_fractions`` gives for the rows of all other folds, in two passes for all of them."""
    names, ends = _fractions(fractions)
    rows = df.where(F.col(fold).isNotNull()).select(
        F.col(label).alias("label"), F.col(fold).alias("fold"), digest(key, seed).alias("digest")
    )
    rows = rows.withColumn("prefix", F.substring("digest", 1, prefix_digits))
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda m: m != F.col("fold"))).alias("member")
    counts = rows.groupBy("label", "prefix", "fold").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("label", "prefix", "n", others).groupBy("member", "label", "prefix").agg(F.sum("n").alias("n"))
    # One row per fold, class and cut: the size of the answer.
    found = materialise(_located(counts, ["member", "label"], ends), "cuts")
    located_rows = found.collect()

    boundaries: list[dict[object, list[str]]] = [{} for _ in range(k)]
    for r in located_rows:
        boundaries[r["member"]].setdefault(r["label"], [""] * len(ends))
    wanted = found.where(F.col("nth") > 0).withColumnsRenamed({c: f"_{c}" for c in ("member", "label", "prefix", "nth")})
    same_cell = F.col("label").eqNullSafe(F.col("_label")) & (F.col("prefix") == F.col("_prefix"))
    nth = Window.partitionBy("member", "label", "prefix").orderBy("digest")
    near = rows.join(wanted.select("_label", "_prefix").distinct(), same_cell, "left_semi")
    ranked = near.select("label", "prefix", "digest", others).withColumn("nth", F.row_number().over(nth))
    same_rank = same_cell & (F.col("member") == F.col("_member")) & (F.col("nth") == F.col("_nth"))
    for r in ranked.join(wanted, same_rank).select("member", "label", "cut", "digest").collect():
        boundaries[r["member"]][r["label"]][r["cut"]] = r["digest"]
    return [Cuts(key, label, seed, names, b) for b in boundaries]


def _check_ratios(train: float, val: float, test: float) -> None:
    if min(train, val, test) < 0:
        raise ValueError("split ratios must not be negative")
    if abs(train + val + test - 1.0) > 1e-9:
        raise ValueError("split ratios must sum to 1")


def fit_split(
    df: DataFrame,
    key: str,
    label: str,
    *,
    seed: int = 42,
    train: float = 0.70,
    val: float = 0.15,
    test: float = 0.15,
    prefix_digits: int = 4,
) -> Cuts:
    """Three-way stratified split; test rows are set aside first, then validation."""
    _check_ratios(train, val, test)
    n = F.col("n_class")
    n_test = F.floor(n * F.lit(float(test)) + 0.5)
    n_val = F.least(F.floor(n * F.lit(float(val)) + 0.5), n - n_test)
    return _fit_cuts(df, key, label, seed, ["test", "val", "train"], [n_test, n_test + n_val], prefix_digits)


def fit_two_way(
    df: DataFrame, key: str, label: str, *, seed: int = 42, test: float = 0.30, prefix_digits: int = 4
) -> Cuts:
    """Stratified train / test split."""
    _check_ratios(1.0 - test, 0.0, test)
    n_test = F.floor(F.col("n_class") * F.lit(float(test)) + 0.5)
    return _fit_cuts(df, key, label, seed, ["test", "train"], [n_test], prefix_digits)


def fit_folds(
    df: DataFrame, key: str, label: str, *, k: int = 5, seed: int = 42, prefix_digits: int = 4
) -> Cuts:
    """Shuffled stratified folds; within a class fold sizes differ by at most one row."""
    if k < 2:
        raise ValueError("at least two folds are needed")
    ends = [F.floor(F.col("n_class") * F.lit(i) / F.lit(k)) for i in range(1, k)]
    return _fit_cuts(df, key, label, seed, [str(i) for i in range(k)], ends, prefix_digits)


def assign_folds(df: DataFrame, folds: Cuts, column: str = "fold") -> DataFrame:
    """Fold number as an integer column, as ``CrossValidator(foldCol=...)`` wants it."""
    return folds.assign(df, column).withColumn(column, F.col(column).cast("int"))


def _fractions(fractions: list[float]) -> tuple[list[str], list[Column]]:
    """Names of the parts, and formulas of their ends, of nested samples."""
    if sorted(fractions) != list(fractions) or not 0 < fractions[0] <= fractions[-1] <= 1:
        raise ValueError("fractions must ascend within (0, 1]")
    ends = [F.floor(F.col("n_class") * F.lit(float(f)) + 0.5) for f in fractions]
    return [str(i) for i in range(len(fractions))] + ["unused"], ends


def fit_fractions(
    df: DataFrame, key: str, label: str, fractions: list[float], *, seed: int = 42, prefix_digits: int = 4
) -> Cuts:
    """Nested stratified samples: part ``i`` completes the first ``fractions[i]`` of each class."""
    names, ends = _fractions(fractions)
    return _fit_cuts(df, key, label, seed, names, ends, prefix_digits)


def sample_rows(df: DataFrame, key: str, k: int, *, seed: int = 42) -> DataFrame:
    """The k rows that come first in digest order (fewer when the table is shorter)."""
    return df.orderBy(digest(key, seed), F.col(key)).limit(k)


# --- checks -----------------------------------------------------------------------


def split_overlap(splits: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that occur in more than one split."""
    return splits.groupBy(key).agg(
        F.min(split).alias("first_split"), F.max(split).alias("last_split")
    ).where(F.col("first_split") != F.col("last_split"))


def split_coverage(df: DataFrame, splits: DataFrame, key: str) -> DataFrame:
    """Keys missing from the splits, and split keys that are not in the table."""
    missing = df.select(key).join(splits.select(key), key, "left_anti")
    unknown = splits.select(key).join(df.select(key), key, "left_anti")
    return missing.withColumn("problem", F.lit("missing")).unionByName(
        unknown.withColumn("problem", F.lit("unknown"))
    )


def verify_splits(
    df: DataFrame,
    splits: DataFrame,
    key: str,
    ratios: dict[str, float],
    *,
    split: str = "split",
    tolerance: float = 0.02,
) -> DataFrame:
    """One row per check: disjoint, covering, and each split's share near its ratio.

    A single pass over the union of both key lists answers every check.
    """
    both = df.select(F.col(key), F.lit(None).cast("string").alias("s"), F.lit(1).alias("t")).unionByName(
        splits.select(F.col(key), F.col(split).alias("s"), F.lit(0).alias("t"))
    )
    per_key = both.groupBy(key).agg(
        F.min("s").alias("lo"), F.max("s").alias("hi"), F.sum("t").alias("t"), F.count("s").alias("n")
    )
    totals = per_key.agg(
        F.sum(F.when(F.col("lo") != F.col("hi"), 1).otherwise(0)).alias("overlap"),
        F.sum(F.when((F.col("t") == 0) | (F.col("n") == 0), 1).otherwise(0)).alias("uncovered"),
        F.sum("n").alias("rows"),
        *[
            F.sum(F.when((F.col("lo") == s) & (F.col("hi") == s), F.col("n")).otherwise(0)).alias(f"rows_{s}")
            for s in ratios
        ],
    )
    checks = [
        F.struct(
            F.lit("disjoint").alias("check"),
            F.col("overlap").cast("double").alias("observed"),
            F.lit(0.0).alias("expected"),
            (F.col("overlap") == 0).alias("passed"),
        ),
        F.struct(
            F.lit("covering").alias("check"),
            F.col("uncovered").cast("double").alias("observed"),
            F.lit(0.0).alias("expected"),
            (F.col("uncovered") == 0).alias("passed"),
        ),
    ]
    for s, ratio in ratios.items():
        share = F.col(f"rows_{s}") / F.nullif(F.col("rows"), F.lit(0))
        checks.append(
            F.struct(
                F.lit(f"ratio_{s}").alias("check"),
                F.round(share, 6).alias("observed"),
                F.lit(float(ratio)).alias("expected"),
                (F.abs(share - F.lit(float(ratio))) <= tolerance).alias("passed"),
            )
        )
    return totals.select(F.inline(F.array(*checks)))


def attach_splits(df: DataFrame, splits: DataFrame, key: str, *, include_test: bool = False) -> DataFrame:
    """Rows with their split; test rows stay out unless asked for.

    The predicate on ``split`` prunes partitions when the split table is written with
    ``partitionBy("split")``.
    """
    chosen = splits if include_test else splits.where(F.col("split") != "test")
    return df.join(chosen.select(key, "split"), key)


def split_metadata(splits: DataFrame, *, seed: int, digest_hex: str, generated_at: str) -> DataFrame:
    """One row that describes a split artifact."""

    def size(name: str) -> Column:
        return F.count(F.when(F.col("split") == name, 1)).alias(f"n_{name}")

    return splits.agg(size("train"), size("val"), size("test")).select(
        F.lit(seed).alias("seed"),
        F.lit(digest_hex).alias("digest"),
        F.lit(digest_hex[:8]).alias("short_digest"),
        "n_train",
        "n_val",
        "n_test",
        F.lit(generated_at).alias("generated_at"),
    )
