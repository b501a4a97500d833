"""From raw documents to packed training sequences.

Each stage takes the table its predecessor kept and returns the rows that stay, with the columns of
documents; the last returns the places of pieces in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, packing, pii, simhash, toxicity
from riskframe.llm.registry import query, table
from riskframe.session import materialise, ship


def nested(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): whole rows as one column, so that no column of theirs clashes with an operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5, under a model of the labelled ones among them.

    A null text is scored as an empty one.  Without labelled rows every score is the same and below 0.5, so all
    rows stay; repeated rows stay or go together; an empty table stays empty.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(nested(docs), model).where("_score < 0.5").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of three-word fingerprints linked by at most three differing bits.

    The row with the smallest id stays; a row without an id only where its group has no other.  Null, empty and
    blank texts share fingerprint zero and are one group; of repeated rows one stays; an empty table stays empty.
    """
    kept = simhash.one_of_each(nested(docs), shingle=simhash.SHINGLE, radius=simhash.RADIUS)
    return kept.select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs.

    Null and empty texts have no words and stay; items without words ask for nothing; repeated rows stay or go together.
    """
    marked = decontaminate.mark(nested(docs), table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("_spans") == 0).select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind, ``n_chars`` counted anew.

    Of spans that overlap the earliest counts, then the longest.  A null text stays null (as does its length), an
    empty one empty; no row is dropped.
    """
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    kept = [new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return pii.redact(nested(docs)).select(*kept)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences.

    A null or empty text is the end token alone; a text beyond a sequence is cut into several pieces; repeated
    rows are packed as often as they occur; no documents give no pieces.
    """
    # Workers still hold what earlier stages left, and the JVM its heap: less is kept here than by the query.
    return packing.pack(docs, kept_pieces=150_000, part_bytes=4 << 20)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def shipped(stage: Stage) -> Stage:
    """The stage, with this package at hand in Python workers."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", shipped(drop_toxic)),
    ("near_duplicates", shipped(drop_near_duplicates)),
    ("decontamination", shipped(drop_contaminated)),
    ("personal_data", shipped(redact_personal_data)),
    ("packing", shipped(pack)),
]

#: Models, fingerprints and tokenizers are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
