"""Data contracts, schema manifests and content fingerprints."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_missing(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.col(f"`{column}`").isNull() | F.isnan(f"`{column}`")
    return F.col(f"`{column}`").isNull()


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, n_missing) for every column, from one aggregate over the table."""
    counted = df.agg(
        *[F.sum(F.when(_is_missing(df, c), 1).otherwise(0)).alias(c) for c in df.columns]
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias("n_missing"))
        for c in df.columns
    ]
    return counted.select(F.inline(F.array(*pairs)))


def _count_copies(df: DataFrame, columns: list[str]) -> DataFrame:
    """(n_rows, n_duplicate_rows) as one row, in two lazy passes.

    Only 8-byte row hashes are shuffled at first.  Rows whose hash is unique are unique; the rest is
    found by a join with the repeated hashes and compared in full, so the count is exact.
    """
    names = [f"`{c}`" for c in columns]
    row_hash = F.xxhash64(*names).alias("_hash")
    copies = df.select(row_hash).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    rows = copies.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"))
    suspects = copies.where(F.col("_n") > 1).select("_hash")
    exact = df.select(*names, row_hash).join(suspects, "_hash", "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    # Two one-row tables.
    return rows.crossJoin(F.broadcast(exact.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicate_rows"))))


def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(n_rows, n_duplicate_rows, duplicate_ratio): all but the first copy count."""
    ratio = F.round(F.try_divide(F.col("n_duplicate_rows"), F.col("n_rows")), 6)
    return _count_copies(df, columns or df.columns).select(
        F.col("n_rows").cast("long").alias("n_rows"),
        "n_duplicate_rows",
        F.coalesce(ratio, F.lit(0.0)).alias("duplicate_ratio"),
    )


def drop_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep one row per combination of values; nulls equal nulls."""
    return df.dropDuplicates(columns) if columns else df.dropDuplicates()


def code_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, code, n) for integer-coded columns, all columns in one shuffle."""
    wide = df.select(*[F.col(f"`{c}`").cast("long").alias(c) for c in columns])
    long = wide.unpivot([], columns, "column", "code").where(F.col("code").isNotNull())
    return long.groupBy("column", "code").agg(F.count(F.lit(1)).alias("n"))


def domain_violations(df: DataFrame, allowed: dict[str, list[int]]) -> DataFrame:
    """(column, bad_code, n): codes that are not allowed.  The data stay as they are."""
    present = {c: v for c, v in allowed.items() if c in df.columns}
    observed = code_counts(df, list(present))
    bad = reduce(
        lambda a, b: a | b,
        [(F.col("column") == c) & ~F.col("code").isin([int(x) for x in v]) for c, v in present.items()],
    )
    return observed.where(bad).select("column", F.col("code").alias("bad_code"), "n")


@dataclass(frozen=True)
class Contract:
    """What a clean labelled table has to satisfy; ``None`` skips the row count."""

    target: str
    n_columns: int
    n_rows: int | None = None
    allowed: dict[str, list[int]] = field(default_factory=dict)

    def check(self, df: DataFrame, only: list[str] | None = None) -> DataFrame:
        """(position, check, severity, passed, observed, expected), fatal checks in order.

        ``only`` names the checks to make; the others cost nothing.  Row and cell counts are one aggregate,
        duplicates need a shuffle (of row hashes).
        """
        asked = {"row_count", "column_count", "target_present", "no_missing", "no_duplicates", "domain"}
        asked = asked if only is None else asked & set(only)
        n_missing = reduce(
            lambda a, b: a + b, [F.when(_is_missing(df, c), 1).otherwise(0) for c in df.columns]
        )
        summary = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(n_missing), F.lit(0)).alias("missing"))
        if "no_duplicates" in asked:
            # Two one-row tables.
            copies = _count_copies(df, df.columns).select(F.col("n_duplicate_rows").alias("copies"))
            summary = summary.crossJoin(F.broadcast(copies))

        def row(position: int, name: str, observed: Column, expected: Column) -> Column:
            return F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("check"),
                F.lit("fatal").alias("severity"),
                (observed == expected).alias("passed"),
                observed.cast("long").alias("observed"),
                expected.cast("long").alias("expected"),
            )

        facts = {
            "column_count": (2, F.lit(len(df.columns)), F.lit(self.n_columns)),
            "target_present": (3, F.lit(int(self.target in df.columns)), F.lit(1)),
            "no_missing": (4, F.col("missing"), F.lit(0)),
            "no_duplicates": (5, F.col("copies"), F.lit(0)),
        }
        if self.n_rows is not None:
            facts = {"row_count": (1, F.col("rows"), F.lit(self.n_rows)), **facts}
        rows = [row(position, name, *pair) for name, (position, *pair) in facts.items() if name in asked]
        fatal = summary.select(F.inline(F.array(*rows))) if rows else None
        if "domain" not in asked or not any(c in df.columns for c in self.allowed):
            return fatal
        warnings = domain_violations(df, self.allowed).select(
            F.lit(6).alias("position"),
            F.concat_ws(":", F.lit("domain"), "column", F.col("bad_code").cast("string")).alias("check"),
            F.lit("warning").alias("severity"),
            F.lit(False).alias("passed"),
            F.col("n").alias("observed"),
            F.lit(0).cast("long").alias("expected"),
        )
        return warnings if fatal is None else fatal.unionByName(warnings)

    def enforce(self, df: DataFrame) -> list[str]:
        """Raise on the first failed fatal check, else return the warnings."""
        fatal = ["row_count", "column_count", "target_present", "no_missing", "no_duplicates"]
        first = first_failure(self.check(df, only=fatal)).collect()
        if first:
            raise ValueError(
                f"contract broken: {first[0]['check']} is {first[0]['observed']}, "
                f"expected {first[0]['expected']}"
            )
        offenders = domain_violations(df, self.allowed) if self.allowed else None
        if offenders is None:
            return []
        listed = offenders.groupBy("column").agg(
            F.count(F.lit(1)).alias("n_codes"), F.min("bad_code").alias("lo"), F.max("bad_code").alias("hi")
        )
        return [
            f"{r['column']}: {r['n_codes']} codes outside the domain, {r['lo']}..{r['hi']}"
            for r in listed.orderBy("column").collect()
        ]


def first_failure(checks: DataFrame) -> DataFrame:
    """The failed fatal check with the lowest position; no rows when all passed."""
    failed = checks.where(~F.col("passed") & (F.col("severity") == "fatal"))
    return failed.orderBy("position").limit(1).select("check", "observed", "expected")


def require_rows(df: DataFrame) -> DataFrame:
    """Reject an empty batch."""
    if df.isEmpty():
        raise ValueError("the batch holds no rows")
    return df


def schema_manifest(df: DataFrame) -> DataFrame:
    """(position, column, dtype, n_rows, n_cols)."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        F.inline(F.array(*rows)), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols")
    )


def content_fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols, column_names, digest, short_digest), independent of row order.

    Row hashes are summed as decimals: a long sum overflows and xor would cancel
    pairs of equal rows.
    """
    names = [f"`{c}`" for c in df.columns]
    sums = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.xxhash64(*names).cast("decimal(20,0)")), F.lit(0)).alias("_sum"),
    )
    listed = ",".join(f"{c}:{t}" for c, t in df.dtypes)
    text = F.concat_ws("|", F.col("_sum").cast("string"), F.col("n_rows").cast("string"), F.lit(listed))
    return sums.select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(",".join(df.columns)).alias("column_names"),
        F.sha2(text, 256).alias("digest"),
    ).withColumn("short_digest", F.substring("digest", 1, 8))


# --- strict records ------------------------------------------------------------------

def validate_json_records(df: DataFrame, column: str, fields: list[str]) -> DataFrame:
    """Add ``record`` (all fields as long) and ``reason`` (null when the record is good).

    The text is parsed into a variant, which keeps the JSON types, so ``"3"`` (a string)
    and ``3.5`` are told from ``3``; a plain typed parse would convert or blank them.
    """
    df = df.withColumn("_parsed", F.try_parse_json(F.col(column)))
    parsed = F.col("_parsed")
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")

    def raw(name: str) -> Column:
        return F.try_variant_get(parsed, f"$['{name}']", "variant")

    def integral(name: str) -> Column:
        return F.coalesce(F.schema_of_variant(raw(name)) == "BIGINT", F.lit(False))

    missing = F.filter(
        F.array(*[F.when(raw(f).isNull(), F.lit(f)) for f in fields]), lambda x: x.isNotNull()
    )
    wrong = F.filter(
        F.array(*[F.when(raw(f).isNotNull() & ~integral(f), F.lit(f)) for f in fields]),
        lambda x: x.isNotNull(),
    )
    reason = (
        F.when(parsed.isNull() | ~F.coalesce(is_object, F.lit(False)), F.lit("not a JSON object"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ",")))
        .when(F.size(wrong) > 0, F.concat(F.lit("not an integer: "), F.array_join(wrong, ",")))
    )
    record = F.struct(*[F.try_variant_get(parsed, f"$['{f}']", "long").alias(f) for f in fields])
    return df.withColumns({"reason": reason, "record": record}).drop("_parsed")


def accepted_and_quarantined(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records as columns, bad ones with their reason."""
    fields = validated.schema["record"].dataType.names
    others = [c for c in validated.columns if c not in ("reason", "record")]
    good = validated.where(F.col("reason").isNull()).select(*others, *[F.col(f"record.{f}") for f in fields])
    bad = validated.where(F.col("reason").isNotNull()).select(*others, "reason")
    return good, bad


def missing_param_keys(params: DataFrame, required: list[str]) -> DataFrame:
    """Runs whose params map lacks a required key: (run_id, missing)."""
    absent = F.array_except(F.array(*[F.lit(k) for k in required]), F.map_keys("params"))
    return params.select("run_id", F.array_join(F.sort_array(absent), ",").alias("missing")).where(
        F.col("missing") != ""
    )
