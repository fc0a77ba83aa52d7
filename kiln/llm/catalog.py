"""The registered queries of the operators: thin, each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kiln.llm import align, ann, chat, dart, decontam, hmm, langid, mixing, quality, superkmer, tokens, toxicity, whiten
from kiln.llm.common import held_out, learnable, table
from kiln.llm.oracle import SQL  # noqa: F401


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    grammar = toxicity.train(docs, labels.where(learnable("doc_id", 5, 0)))
    scored = toxicity.with_toxicity(docs, grammar, column="score")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tokens.with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), byte_bpe())
    return docs.select("doc_id", tokens.utf8_bytes("text").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    rows = plan.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))))
    rows = rows.withColumn("copies", F.col("copies") + (F.col("row") <= F.col("extra")).cast("bigint"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(learnable("doc_id", 4, 2)))
    scored = langid.with_language(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    # a row is a turn of its own, also if its number is null or repeats
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), "role", "text")
    rows = rows.withColumn("turn", F.row_number().over(order))
    log = rows.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("event"), "turn", "role", "text")
    return chat.digests(chat.render(log))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = superkmer.deduplicate(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "distinct_texts")


def op10_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return hmm.score(docs, learnable("doc_id", 7, 2), held_out("doc_id", 7, 2))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), byte_bpe(), piece_bpe())


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = quality.with_quality(docs, quality.train(docs, labels.where(learnable("doc_id", 4, 2))), column="score")
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_source_mix": op4_source_mix,
    "op5_nearest": op5_nearest,
    "op6_language": op6_language,
    "op7_chat": op7_chat,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_hidden_markov": op10_hidden_markov,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_quality": op13_quality,
}

