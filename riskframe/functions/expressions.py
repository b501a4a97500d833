"""Scalar column expressions: run names, labels, casts, rounding, digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- run names ------------------------------------------------------------------------

# Fixed part order of a run name.
RUN_NAME_PARTS = ["stage", "model", "preproc", "dimred", "search", "seed", "data", "code"]


def run_name(
    stage: Column,
    model: Column,
    preproc: Column,
    dimred: Column,
    search: Column,
    seed: Column,
    data_digest: Column,
    code_digest: Column,
) -> Column:
    """``stage__model__preproc__dimred__search__seedN__dataH__codeG``."""
    return F.concat_ws(
        "__",
        stage,
        model,
        preproc,
        dimred,
        search,
        F.concat(F.lit("seed"), seed.cast("string")),
        F.concat(F.lit("data"), data_digest),
        F.concat(F.lit("code"), code_digest),
    )


def run_stage(name: Column) -> Column:
    """First part of a run name; empty for a missing name."""
    return F.coalesce(F.get(F.split(name, "__"), F.lit(0)), F.lit(""))


def run_search(name: Column) -> Column:
    """Fifth part of a run name, ``none`` when there are fewer."""
    return F.coalesce(F.get(F.split(name, "__"), F.lit(4)), F.lit("none"))


def reduction_label(method: Column, n_components: Column, none: str = "none") -> Column:
    """``method_kN``, or ``none`` when no reduction was used."""
    return F.when(F.coalesce(method, F.lit("none")) == "none", F.lit(none)).otherwise(
        F.concat(method, F.lit("_k"), n_components.cast("string"))
    )


def winner_id(text: Column) -> Column:
    """The run id behind ``winner_run_id:`` in a report text."""
    return F.regexp_extract(text, r"winner_run_id:\s*(\S+)", 1)


# --- casts and lookups ----------------------------------------------------------------


def typed_param(value: Column) -> Column:
    """Struct (kind, as_bool, as_long, as_double, as_string) of a logged parameter text.

    Order of attempts: null, bool, int, float, string.
    """
    is_null = value.isNull() | (value == "None")
    lowered = F.lower(value)
    is_bool = lowered.isin("true", "false")
    as_long = value.try_cast("long")
    is_long = value.rlike(r"^\s*[+-]?[0-9]+\s*$") & as_long.isNotNull()
    # The cast alone would also read type suffixes such as "1d".
    number = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"
    as_double = F.when(lowered.rlike(number), value.try_cast("double"))
    kind = (
        F.when(is_null, "null")
        .when(is_bool, "bool")
        .when(is_long, "int")
        .when(as_double.isNotNull(), "float")
        .otherwise("string")
    )
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "bool", lowered == "true").alias("as_bool"),
        F.when(kind == "int", as_long).alias("as_long"),
        F.when(kind == "float", as_double).alias("as_double"),
        F.when(kind == "string", value).alias("as_string"),
    )


# Order of model families by complexity; anything else ranks last.
FAMILY_RANK = {"linear": 0, "tree": 1, "ensemble": 2}
UNKNOWN_FAMILY_RANK = 99


def family_rank(family: Column) -> Column:
    """0 linear, 1 tree, 2 ensemble, 99 otherwise; an absent family counts as an ensemble."""
    family = F.coalesce(family, F.lit("ensemble"))
    rank = F.lit(UNKNOWN_FAMILY_RANK)
    for name, position in FAMILY_RANK.items():
        rank = F.when(family == name, F.lit(position)).otherwise(rank)
    return rank


def metric_or(value: Column, default: float = float("inf")) -> Column:
    """A metric, or ``default`` when it was not logged."""
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(float(default)))


# --- strings --------------------------------------------------------------------------


def normalise_name(name: str) -> str:
    """Column name without outer blanks, lower case, blanks to underscores."""
    return name.strip().lower().replace(" ", "_")


def normalise_text(value: Column) -> Column:
    """The same rule on a string column."""
    return F.replace(F.lower(F.trim(value)), F.lit(" "), F.lit("_"))


def short_digest(hex_digest: Column, n: int = 8) -> Column:
    return F.substring(hex_digest, 1, n)


def name_prefix(name: Column) -> Column:
    """The leading letters: ``pay_amt3`` and ``pay_3`` give ``pay``."""
    return F.regexp_extract(name, r"^([A-Za-z]+)", 1)


def contains(value: Column, text: str) -> Column:
    """Substring test where a null does not contain anything."""
    return F.coalesce(value.contains(text), F.lit(False))


# --- numbers --------------------------------------------------------------------------


def row_mean(columns: list[str]) -> Column:
    """Mean over the non-null columns of a row."""
    values = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.try_divide(total, F.size(values))


def row_count_where(columns: list[str], predicate) -> Column:
    """How many of the columns satisfy the predicate; null counts as no."""
    total = F.lit(0)
    for c in columns:
        total = total + F.when(predicate(F.col(c)), 1).otherwise(0)
    return total


def half_even(value: Column, digits: int) -> Column:
    """Rounding with ties to the even neighbour, as in numpy; ``F.round`` rounds ties up."""
    return F.bround(value, digits)


def fixed_point(value: Column, digits: int = 4) -> Column:
    """Text with a fixed number of digits; null stays null."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), digits)


def utc_text(ts: Column) -> Column:
    """ISO-8601 text of a timestamp taken as UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
