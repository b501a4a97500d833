"""How document filters overlap: what every order of five filters removes, and what it loses.

A first scan gives every document the failures that its own text decides, and a hash of the text.  Failure E is an
existential self-join: of the hashes that stand with more than one id, texts are read again, a left semi join on
hash, exact text and a smaller doc_id marks the copies.  Their ids are united with the ids of the other failures,
failures of an id become one combination, and combinations are counted per language.  All that the 120 orders say
follows from at most 32 counts per language, so no order looks at a document.

Copies are compared with the smallest id of each distinct text only, so a text that a third of all rows share is a
short row on the one side; the other side is dealt anew where it is hot.  Hashes that repeat are broadcast up to
``BROADCAST_ROWS`` rows and joined by a shuffle beyond.

Defined results: a null text is empty; a null language is the empty string, together with empty languages; a row
without an id is no copy and makes none; rows that share id and text are no copies of each other and count as
often as they occur; a document is good (toxic) if any of its label rows says 1; an empty table gives no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.text import UPPER
from riskframe.session import materialise

FILTERS = "ABCDE"
LEAST_WORDS = 200
#: In hundredths: least share of distinct words, largest share of capitals.
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
SYMBOLS = r"[#$%&*|]"
BROADCAST_ROWS = 500_000

_BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
_MASKS = 1 << len(FILTERS)


def own_failures(text: Column) -> Column:
    """Bits of the failures A to D of a text."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    characters = F.length(text)
    capitals = characters - F.length(F.translate(text, UPPER, ""))
    fails = {
        "A": n < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < n.cast("long") * LEAST_DISTINCT,
        "C": capitals.cast("long") * 100 > characters.cast("long") * MOST_CAPITALS,
        "D": text.rlike(SYMBOLS),
    }
    return sum((F.when(c, _BIT[k]).otherwise(0) for k, c in fails.items()), F.lit(0))


def copies(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """Rows of ``docs`` (id, part, h, text) whose text also stands with a smaller id; ``hashed`` has (id, h) of all rows."""
    spread = hashed.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("h")
    repeated = materialise(spread, "audit-hashes")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    shared = docs.where(F.col("id").isNotNull()).join(repeated, "h", "left_semi")
    firsts = materialise(shared.groupBy("h", "text").agg(F.min("id").alias("first")), "audit-firsts")
    left, right = shared.alias("x"), firsts.alias("y")
    smaller = (F.col("x.h") == F.col("y.h")) & (F.col("x.text") == F.col("y.text")) & (F.col("y.first") < F.col("x.id"))
    return left.join(right, smaller, "left_semi")


def combinations(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents per language and combination of failures."""
    value = F.coalesce(F.col(text), F.lit(""))
    part = F.coalesce(F.col(lang).cast("string"), F.lit(""))
    # A text's second hash tells rows with a repeated id apart where their texts differ.
    rows = docs.select(F.col(key).alias("id"), part.alias("part"), F.xxhash64(value).alias("h"), value.alias("text"))
    told = ["id", "part", "h"]
    own = materialise(rows.select(*told, own_failures(F.col("text")).alias("mask")), "audit-own")
    marked = copies(rows, own.select("id", "h")).select(*told, F.lit(_BIT["E"]).alias("mask"))
    # Ids of failures, united: a row per id and failing filter set, once more for E; n counts rows once.
    failing = own.where("mask > 0").groupBy(*told).agg(F.bit_or("mask").alias("mask")).unionByName(marked)
    failed = failing.groupBy(*told).agg(F.bit_or("mask").alias("mask"))
    # How often an id and text occurs matters only where it failed.
    occurs = own.groupBy(*told).agg(F.count("*").alias("n"), F.max("mask").alias("own_mask"))
    marks = materialise(failed, "audit-failed")
    both = occurs.alias("o").join(
        marks.alias("f"),
        F.col("o.id").eqNullSafe(F.col("f.id")) & (F.col("o.part") == F.col("f.part")) & (F.col("o.h") == F.col("f.h")),
        "left",
    )
    known = both.select("o.id", "o.part", "o.n", F.coalesce("f.mask", F.lit(0)).alias("mask"))
    asked = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id"))
    said = materialise(asked.agg(*[F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")]), "audit-labels")
    labelled = known.join(said, "id", "left")
    return labelled.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )


def orders(counted: DataFrame) -> DataFrame:
    """The audit of every order of the filters from combinations (part, mask, n, good, toxic)."""
    wide = counted.groupBy("part").agg(
        *[
            F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)) for m in range(_MASKS)]).alias(c)
            for c in ("n", "good", "toxic")
        ]
    )
    # Fixed: a row per order and place, 120 times five.
    steps = [
        ("".join(order), step + 1, letter, _BIT[letter], sum(_BIT[x] for x in order[:step]))
        for order in itertools.permutations(FILTERS)
        for step, letter in enumerate(order)
    ]
    names = ("filter_order", "step", "letter", "bit", "before")
    all_steps = F.from_json(
        F.lit("[" + ",".join("{" + ",".join(f'"{k}":"{v}"' if isinstance(v, str) else f'"{k}":{v}' for k, v in zip(names, s)) + "}" for s in steps) + "]"),
        "array<struct<filter_order:string,step:int,letter:string,bit:int,before:int>>",
    )
    rows = wide.withColumn("s", F.explode(all_steps)).select("*", "s.*").drop("s")

    def total(column: str, holds) -> Column:
        """Sum over the masks for which ``holds``, a function of the mask."""
        masks = F.filter(F.sequence(F.lit(0), F.lit(_MASKS - 1)), holds)
        return F.aggregate(masks, F.lit(0).cast("long"), lambda acc, m: acc + F.element_at(column, m + 1))

    bit, before = F.col("bit"), F.col("before")

    def here(m: Column) -> Column:
        return (m.bitwiseAND(bit) > 0) & (m.bitwiseAND(before) == 0)

    told = rows.select(
        "part",
        "filter_order",
        "step",
        "letter",
        total("n", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) > 0) & (m.bitwiseAND(before) > 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    shares = told.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return told.join(shares, ["part", "letter"]).drop("letter")


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) per language and order."""
    return orders(materialise(combinations(docs, labels, key, text, lang), "audit-combinations"))
