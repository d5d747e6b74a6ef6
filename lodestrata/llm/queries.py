"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import exact_dedup, fill_middle, kd_shards, language_id, minhash_dedup, mixing, neighbours, periodic, quality, secrets, segmentations, suffix_tree, token_counts
from lodestrata.llm.shared import documents, remainder, stored, whole

SHARDS = 40
TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
QUALITY_AT_LEAST = 0.3
SAMPLES = 2
#: Longest context of the language model. Without a limit the contexts that still might gain follow copied documents to their beginnings, thousands of
#: words each; at 21 million words 1.58 million contexts are retained, 1,700 of them longer than 8 words and 10 to 63 at each length from 30 to 39.
CONTEXT_WORDS = 40


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts.token_count(spark, public_tokenizers.path(TOKENIZER))
    counted = documents(spark, sf_dir).select("doc_id", F.octet_length(whole("text")).cast("long").alias("n_bytes"), counts.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    tree = suffix_tree.fit(docs.where(remainder("doc_id", 5) != 1), depth=CONTEXT_WORDS)
    scored = suffix_tree.score(docs, tree)
    return scored.withColumns({"held_out": remainder("doc_id", 5) == 1, "train_tokens": F.lit(tree.tokens).cast("long")})


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_groups(documents(spark, sf_dir), size=4)


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = kd_shards.kd_shards(documents(spark, sf_dir), leaves=SHARDS)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(remainder("doc_id", 5) != 0)
    weights = quality.fit(docs, labels, "quality")
    scored = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), quality.quality(spark, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_AT_LEAST).cast("int"))


def op8_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return segmentations.encode_samples(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), k=SAMPLES)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    learned = stored(language_id.profiles(docs.where(remainder("doc_id", 4) != 2)), "profiles")
    found = language_id.identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(documents(spark, sf_dir))
    hashes = [F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir))
    base = F.col("base")
    counts = [secrets.number_of(base, kind).alias(f"n_{kind}") for kind in secrets.LEAST]
    spans = secrets.listed(F.array_sort(F.concat(base, F.col("added"))))
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), spans.alias("spans"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", periodic.repeated_tail().alias("text"))
    found = periodic.periodic_runs(docs).withColumn("best", periodic.strongest())
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = [F.col("best.start"), F.col("best.length"), F.col("best.period"), F.expr("1000 * best.length DIV best.period").alias("exponent_milli")]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_mixing": op2_mixing,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_neighbours": op4_neighbours,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_kd_shards": op6_kd_shards,
    "op7_quality": op7_quality,
    "op8_segmentations": op8_segmentations,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_language_id": op10_language_id,
    "op11_fill_middle": op11_fill_middle,
    "op12_secrets": op12_secrets,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {"op2_mixing": mixing.ORACLE_SQL, "op9_exact_dedup": OP9_SQL, "op11_fill_middle": fill_middle.ORACLE_SQL, "op12_secrets": secrets.oracle_sql()}
