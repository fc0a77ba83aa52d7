"""Document sources and sinks S1-S10.

Corpus order is the explicit ``seq`` column (a unique long); every stage
that needs "first", "prefix" or "running" reads it instead of row order.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.config import IngestConfig
from kiln.functions.text import word_count
from kiln.operators.ordering import prefix_totals, with_position
from kiln.session import stage_table

# The ten-column document schema, in order.
DOC_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("dump", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("language_score", T.FloatType()),
        T.StructField("token_count", T.IntegerType()),
    ]
)
DOC_COLUMNS = tuple(f.name for f in DOC_SCHEMA.fields)

def read_corpus(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read Parquet documents (a folder of shards or one file)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows over ``partitions`` tasks; ``None`` leaves the scan as it is.

    For sources of few, large files: one row group is one scan task.
    """
    return df.repartition(partitions) if partitions else df


def conform(
    df: DataFrame,
    seq: Column | str = "seq",
    renames: Mapping[str, str] | None = None,
    token_count: Column | None = None,
) -> DataFrame:
    """The ten-column schema plus ``seq``.

    Renamed and cast source columns fill the schema, missing ones are
    typed nulls, extra ones are dropped.  ``seq`` is the unique corpus-order
    key, a long; ``doc_id`` may be any string.  ``token_count`` defaults to
    the whitespace word count when the source has none.
    """
    renames = renames or {}
    src = {renames.get(c, c): F.col(c) for c in df.columns}
    cols = []
    for f in DOC_SCHEMA.fields:
        if f.name == "token_count" and token_count is not None:
            expr = token_count
        elif f.name in src:
            expr = src[f.name]
        elif f.name == "token_count":
            expr = word_count(F.col("text"))
        else:
            expr = F.lit(None)
        cols.append(expr.cast(f.dataType).alias(f.name))
    key = F.col(seq) if isinstance(seq, str) else seq
    return df.select(key.cast("long").alias("seq"), *cols)


def assign_doc_id(df: DataFrame, prefix: str = "doc", order_col: str = "seq") -> DataFrame:
    """S3: ``prefix-%012d`` of the arrival position; a source ``doc_id`` wins.

    The position is a distributed dense rank over ``order_col``.
    """
    return with_doc_ids(with_position(df, order_col, "position"), prefix)


def with_doc_ids(numbered: DataFrame, prefix: str) -> DataFrame:
    """``generated_id`` from ``position``, and ``doc_id`` where the source has none."""
    generated = F.format_string(f"{prefix}-%012d", F.col("position"))
    effective = F.coalesce(F.col("doc_id").cast("string"), generated) if "doc_id" in numbered.columns else generated
    return numbered.withColumn("generated_id", generated).withColumn("doc_id", effective)


def take_budget(
    df: DataFrame,
    target_tokens: int | None = None,
    target_docs: int | None = None,
    order_col: str = "seq",
    token_col: str = "token_count",
) -> DataFrame:
    """Shortest corpus-order prefix reaching the budget.

    The document that crosses the token target is kept (the reference tests
    after appending); with both targets the first one reached stops.
    """
    before, _ = prefix_totals(df, [order_col], {"_tok_before": F.col(token_col), "_docs_before": F.lit(1)})
    cond = F.lit(True)
    if target_tokens is not None:
        cond = cond & (F.col("_tok_before") < F.lit(target_tokens))
    if target_docs is not None:
        cond = cond & (F.col("_docs_before") < F.lit(target_docs))
    return df.join(before.where(cond).select(order_col), order_col, "left_semi")


def shard_of(position: Column | str, shard_size: int) -> Column:
    """Fixed document count per shard; the last one may be short."""
    p = F.col(position) if isinstance(position, str) else position
    return F.floor(p / F.lit(shard_size)).cast("int")


def with_shards(df: DataFrame, shard_size: int, order_col: str = "seq") -> DataFrame:
    return with_position(df, order_col, "position").withColumn("shard", shard_of("position", shard_size))


SHARDS = "shard int, name string, file_group int, documents bigint, first_seq bigint, last_seq bigint"


def shard_groups(sharded: DataFrame, order_col: str = "seq", groups: int | None = None) -> DataFrame:
    """Per shard its name, the group of files it goes to, and what it holds; a group is a range of shards."""
    n = groups or int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sharded.groupBy("shard").agg(F.count("*").alias("documents"), F.min(order_col).alias("first_seq"), F.max(order_col).alias("last_seq"))
    shards = (sharded.agg(F.max("shard").alias("last")).first()["last"] or 0) + 1
    group = F.floor(F.col("shard").cast("long") * F.lit(min(n, shards)) / F.lit(shards)).cast("int")
    named = rows.withColumn("file_group", group).withColumn("name", F.format_string("shard-%05d", "shard"))
    return named.select("shard", "name", "file_group", "documents", F.col("first_seq").cast("long"), F.col("last_seq").cast("long"))


def write_shards(df: DataFrame, path: str, shard_size: int, order_col: str = "seq", groups: int | None = None) -> None:
    """Shards in corpus order, each whole in one file, with a manifest of their names and row counts.

    A task takes the shards of one range (``repartitionById``) and writes
    them to one file, sorted, so a file holds many shards and a reader of
    some shards skips the row groups of others.  Rows that bring their
    ``shard`` keep it, and its name, from input to output.
    """
    sharded = with_shards(df, shard_size, order_col) if "shard" not in df.columns else df
    rows = shard_groups(sharded.select("shard", order_col), order_col, groups)
    # the manifest comes last: a folder with one is whole
    held = stage_table(rows, "shards")
    n = max(1, (held.agg(F.max("file_group")).first()[0] or 0) + 1)
    placed = sharded.join(held.select("shard", "file_group"), "shard")
    placed.repartitionById(n, F.col("file_group")).drop("file_group").sortWithinPartitions("shard", order_col).write.mode("overwrite").parquet(path)
    held.coalesce(1).sortWithinPartitions("shard").write.mode("overwrite").parquet(f"{path.rstrip('/')}/_shards")


def directory_size(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of the files under ``path`` (listing only; contents not read)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("length")
    )
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"))


def format_bytes(n: Column | str) -> Column:
    """Base 1024, two decimals, B..TB then PB."""
    x = (F.col(n) if isinstance(n, str) else n).cast("double")
    # Unit names in order.
    units = ["B", "KB", "MB", "GB", "TB"]
    expr = None
    for i, unit in enumerate(units):
        scaled = F.bround(x / F.lit(float(1024**i)), 2)  # a tie goes to the even digit
        branch = F.format_string(f"%.2f {unit}", scaled)
        cond = x < F.lit(float(1024 ** (i + 1)))
        expr = F.when(cond, branch) if expr is None else expr.when(cond, branch)
    return expr.otherwise(F.format_string("%.2f PB", F.bround(x / F.lit(float(1024**5)), 2)))


def manifest(
    docs: DataFrame,
    cfg: IngestConfig = IngestConfig(),
    size_bytes: int | None = None,
    dataset: str = "documents",
    split: str = "train",
    token_col: str = "token_count",
    output_dir: str | None = None,
) -> DataFrame:
    """One-row manifest (documents, tokens, shards, targets, size, settings, place)."""
    agg = docs.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(token_col), F.lit(0)).cast("long").alias("tokens"),
        F.countDistinct("shard").alias("shards") if "shard" in docs.columns else F.lit(None).alias("shards"),
    )
    b = F.lit(size_bytes).cast("long")
    return agg.select(
        F.lit(dataset).alias("dataset"),
        F.lit(split).alias("split"),
        F.lit(True).alias("streaming"),
        "documents",
        "tokens",
        "shards",
        F.lit(cfg.target_tokens).cast("long").alias("target_tokens"),
        F.lit(cfg.target_docs).cast("long").alias("target_docs"),
        b.alias("bytes"),
        format_bytes(b).alias("size"),
        F.lit(cfg.shard_size).alias("shard_size"),
        F.lit(cfg.schema_version).alias("schema_version"),
        F.lit(json.dumps(dataclasses.asdict(cfg), sort_keys=True)).alias("config"),
        F.lit(output_dir).cast("string").alias("output_dir"),
        F.lit(_dt.datetime.now(_dt.timezone.utc).isoformat().replace("+00:00", "Z")).alias("created_at"),
    )


def scan_shards(spark: SparkSession, path: str, shards: list[int] | None = None) -> DataFrame:
    """All shards, or some; order is ``(shard, seq)`` from the columns, not the files."""
    rows = spark.read.parquet(path)
    return rows if shards is None else rows.where(F.col("shard").isin(shards))  # pushed down: files and row groups are skipped


def shard_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Names, places and row counts of the shards under ``path``."""
    return spark.read.schema(SHARDS).parquet(f"{path.rstrip('/')}/_shards")


def text_scan(spark: SparkSession, path: str, shards: list[int] | None = None, text_col: str = "text") -> DataFrame:
    """The texts of shards in ``(shard, seq)`` order columns; no other column reaches the reader."""
    return scan_shards(spark, path, shards).select("shard", "seq", text_col)
