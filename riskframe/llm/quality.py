"""Quality of documents, judged by how far their distributions are from those of their language.

Two histograms describe a text: its characters by class (lower case, capitals, digits, white space, punctuation,
symbols, characters beyond ASCII, controls) and its words by common word, all other words together.  A word is
common in a language if it makes up at least one in ``COMMON_SHARE`` of its words, so a language has at most that many.
The references are the sums over all documents of the language.  A document is dropped if the Jensen-Shannon
distance (base 2, between 0 and 1) of one of its histograms from its reference is beyond the limit.

Short texts differ from any reference by chance.  Guards: characters are compared from ``LEAST_CHARACTERS`` on, words
from ``LEAST_WORDS`` on, and the limit of words grows with one over the root of their number; a language is a
reference from ``LEAST_REFERENCE`` words on, and documents of others are judged by the base rules alone.  Base rules
fail documents of few words and documents most of whose words stand in repeated windows.

Two passes over the texts.  The first hands on sums of distinct words per task; references have one short row per
language, joined to the documents (broadcast up to ``BROADCAST_LANGS`` languages, by a shuffle beyond).

Defined results: a null or empty text has no words and fails; a null language is a language of its own; repeated
rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.text import as_bytes, words
from riskframe.session import materialise, ship

COMMON_SHARE = 200
LEAST_REFERENCE = 10_000
LEAST_CHARACTERS = 300
LEAST_WORDS = 50
CHARACTER_LIMIT = 0.30
#: Limit of the word distance: the first plus the second over the root of the number of words.
WORD_LIMIT = (0.15, 2.0)
#: A text fails below so many words, or with more than so many hundredths of them in repeated windows.
BASE_WORDS = 50
BASE_REPEATS = 50
WINDOW = 3
BROADCAST_LANGS = 1_000
#: Distinct words that a task of the first pass holds before it hands on their sums (memory, not results).
KEPT = 200_000

SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "capital", "digit", "space", "punctuation", "symbol", "beyond ASCII", "control")
_PUNCTUATION = b".,;:!?'\"()-"
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def _class(byte: int) -> int:
    """Class of a character by its first byte; further bytes of a character come after the last class."""
    character = bytes([byte])
    if byte >= 0x80:
        return 6 if byte >= 0xC0 else len(CLASSES)
    for k, holds in enumerate((character.islower(), character.isupper(), character.isdigit(), character in _SPACE, character in _PUNCTUATION)):
        if holds:
            return k
    return 5 if 0x20 < byte < 0x7F else 7


_CLASS = np.array([_class(b) for b in range(256)], np.uint8)
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def histogram(text: bytes) -> tuple[np.ndarray, int]:
    """Characters per class, and the number of symbols."""
    per_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return np.bincount(_CLASS, weights=per_byte, minlength=len(CLASSES) + 1)[: len(CLASSES)].astype(np.int64), int(per_byte[_IS_SYMBOL].sum())


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts; 0 where one of them is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    half = [float(np.sum(x[x > 0] * np.log2(x[x > 0] / middle[x > 0]))) for x in (p, q)]
    return math.sqrt(min(1.0, max(0.0, sum(half) / 2)))


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window of words which the text has at least twice."""
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(t, len(numbers)) for t in tokens], np.int64)
    key = ids[:n]
    for k in range(1, window):
        # Numbered anew after each word, so keys stay below the square of the length.
        key = np.unique(key * len(numbers) + ids[k : k + n], return_inverse=True)[1]
    twice = np.bincount(key)[key] > 1
    covered = np.zeros(len(tokens), bool)
    for k in range(window):
        covered[k : k + n] |= twice
    return int(covered.sum())


def references(docs: DataFrame) -> DataFrame:
    """(lang, characters, common, counts, total): a row per language with enough words, from (lang, text)."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        shapes: dict[str, np.ndarray] = {}

        def rows(keys: list[tuple[str, bytes, int]], sums: list[int]) -> pa.RecordBatch:
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.int32()), pa.array(sums, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "class", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
                text = text or b""
                tokens = words(text)
                found.update((lang, w, -1) for w in tokens)
                shape = shapes.setdefault(lang, np.zeros(len(CLASSES) + 1, np.int64))
                shape[: len(CLASSES)] += histogram(text)[0]
                shape[-1] += len(tokens)
                if len(found) >= KEPT:
                    yield rows(list(found), list(found.values()))
                    found.clear()
        yield rows(list(found), list(found.values()))
        for lang, shape in shapes.items():
            yield rows([(lang, b"", k) for k in range(len(shape))], shape.tolist())

    sums = docs.select("lang", "text").mapInArrow(tally, "lang string, word binary, class int, n bigint")
    counted = materialise(sums.groupBy("lang", "word", "class").agg(F.sum("n").alias("n")), "quality-counts")
    shapes = counted.where("class >= 0").groupBy("lang").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("class") == k, F.col("n"))), F.lit(0)) for k in range(len(CLASSES))]).alias("characters"),
        F.coalesce(F.sum(F.when(F.col("class") == len(CLASSES), F.col("n"))), F.lit(0)).alias("total"),
    )
    shapes = materialise(shapes.where(F.col("total") >= LEAST_REFERENCE), "quality-shapes")
    common = counted.where("class < 0").join(shapes.select("lang", "total"), "lang").where(F.col("n") * COMMON_SHARE >= F.col("total"))
    # At most COMMON_SHARE words of a language are common.
    listed = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("common"))
    return shapes.join(listed, "lang", "left").select("lang", "total", "characters", F.col("common.word").alias("common"), F.col("common.n").alias("counts"))


class Reference:
    """Histograms of a language."""

    def __init__(self, row: dict):
        self.characters = np.array(row["characters"], float)
        self.place = {w: i for i, w in enumerate(row["common"] or [])}
        counts = row["counts"] or []
        self.words = np.array([*counts, row["total"] - sum(counts)], float)

    def character_distance(self, characters: np.ndarray) -> float | None:
        """None where the text is too short to compare."""
        return distance(characters, self.characters) if characters.sum() >= LEAST_CHARACTERS else None

    def word_distance(self, tokens: list[bytes]) -> float | None:
        if len(tokens) < LEAST_WORDS:
            return None
        counts = np.zeros(len(self.words))
        for w in tokens:
            counts[self.place.get(w, -1)] += 1
        return distance(counts, self.words)


MEASURES = (
    T.StructType()
    .add("n_words", "long")
    .add("word_chars", "long")
    .add("n_symbols", "long")
    .add("n_dup_lines", "long")
    .add("n_repeat_words", "long")
    .add("base_failed", "boolean")
    .add("kept", "boolean")
    .add("character_distance", "double")
    .add("word_distance", "double")
)


def measures(text: bytes, reference: Reference | None) -> tuple:
    """The columns of ``MEASURES`` for a text."""
    tokens = text.split()
    shape, symbols = histogram(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = repeated_words(tokens)
    failed = len(tokens) < BASE_WORDS or 100 * repeats > BASE_REPEATS * len(tokens)
    by_character = by_word = None
    if reference is not None:
        folded = words(text)
        by_character, by_word = reference.character_distance(shape), reference.word_distance(folded)
        far = (by_character or 0.0) > CHARACTER_LIMIT or (by_word or 0.0) > WORD_LIMIT[0] + WORD_LIMIT[1] / math.sqrt(max(1, len(folded)))
    else:
        far = False
    n_characters = int(shape.sum()) - int(shape[CLASSES.index("space")])
    return len(tokens), n_characters, symbols, len(lines) - len(set(lines)), repeats, failed, not failed and not far, by_character, by_word


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The key, ``MEASURES`` and verdict of every document."""
    ship(docs.sparkSession)
    # Languages as text with a mark, so that a missing one is a value of its own.
    named = F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), named.alias("lang"), F.col(text).alias("text"))
    known = materialise(references(rows), "quality-references")
    if known.count() <= BROADCAST_LANGS:
        known = F.broadcast(known)
    joined = rows.join(known, "lang", "left").select("key", "text", "lang", "total", "characters", "common", "counts")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Reference] = {}
        for batch in batches:
            lists = ("total", "characters", "common", "counts")
            langs = batch.column("lang").to_pylist()
            there = batch.column("total").is_valid().to_pylist()
            made = []
            for i, (name, value) in enumerate(zip(langs, as_bytes(batch.column("text")))):
                reference = None
                if there[i]:
                    if name not in held:
                        if len(held) >= BROADCAST_LANGS:
                            held.clear()
                        held[name] = Reference({c: batch.column(c)[i].as_py() for c in lists})
                    reference = held[name]
                made.append(measures(value or b"", reference))
            columns = list(zip(*made)) if made else [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(c, _ARROW[f.dataType.typeName()]) for c, f in zip(columns, MEASURES))],
                names=["key", *MEASURES.names],
            )

    kind = T.StructType([T.StructField("key", joined.schema["key"].dataType), *MEASURES.fields])
    return joined.mapInArrow(compute, kind).withColumnRenamed("key", key)


_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
