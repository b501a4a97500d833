"""Words of a text, in bytes inside tasks and as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: A word is a run of ASCII letters, ASCII digits and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in _LOWER)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words; bytes from 0x80 on belong to words, so no decoding is needed."""
    return (text or b"").translate(_FOLD).split()


def spaced(text: bytes | None) -> list[bytes]:
    """Lower-cased runs between ASCII white space (space and 0x09 to 0x0D)."""
    return (text or b"").translate(_LOWER).split()


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def append(
    df: DataFrame, fields: T.StructType, compute: Callable[[pa.RecordBatch], list], *inputs: str
) -> DataFrame:
    """``df`` with further columns that ``compute`` makes from the columns ``inputs`` of each batch.

    Rows stay where they are: no shuffle, and all columns of ``df`` pass through.
    """
    taken = set(df.columns)
    if clash := [f.name for f in fields if f.name in taken]:
        raise ValueError(f"columns exist already: {clash}")
    at = [df.columns.index(name) for name in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(*(batch.column(i) for i in at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], names=[*batch.schema.names, *(f.name for f in fields)]
            )

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields.fields]))
