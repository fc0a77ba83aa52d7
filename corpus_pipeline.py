"""The training-data pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import dart, decontam, langid, mixing, superkmer
from kiln.llm.common import learnable, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected: no text, no letter, or too uncertain.

    The model learns from the labelled rows of this stage's input; rows with a
    null key or label are judged, not learned from.  Null and empty texts go,
    repeated rows fare alike, long texts are judged whole, an empty table (or
    one without labels, which rejects all) gives no rows.
    """
    model = langid.train(docs.where(learnable("doc_id", 4, 2)))
    return langid.with_language(docs, model, column="__language").where("not __language.rejected").drop("__language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class: the one with the least doc_id.

    Texts of fewer words than a shingle are near only to equal ones; repeated
    rows and null keys are told apart by their text (see ``dart.kept``).
    """
    return dart.kept(docs, dart.near_classes(docs))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 13 words and more that a document with a smaller doc_id holds.

    Texts that lose nothing stay as they are; a document that loses every
    word goes, and ``n_chars`` follows the text.  A null text has no word and
    stays; repeated keys count as one document; long texts are cut whole.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    done = superkmer.deduplicate(docs, carry=tuple(rest), untouched=True)
    left = done.where("n_removed = 0 or n_removed < n_words")
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept")} | {c: F.col(f"carry.`{c}`") for c in rest}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(columns["n_chars"])
    return left.select(*(columns[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item.

    Rows are told apart by key and text: a leaked row goes also if its key is
    null, and a clean row stays that shares its key with a leak.  Null and
    empty texts leak nothing; long texts are searched whole.
    """
    found = decontam.leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__k"), F.col("text_hash").alias("__h")).distinct()
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__k")) & (decontam.text_hash("text") == F.col("__h"))
    return docs.join(found, same, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target asks, numbered by ``copy``.

    Empty texts are taken once; null keys and sources and repeated rows as ``mixing.mixed`` says.
    """
    return mixing.mixed(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: Learned models, sketches and rounding have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
