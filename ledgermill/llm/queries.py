"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import alignment, licenses, lsa, merkle, minmax, mixture, repeats, rules, secrets, shards, simple8b, suffix_tree, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary file that the cluster's machines have."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Target weights of the sources: the largest one is held back, five are stressed, all others share the rest.
WEIGHTS = {"src0": 0.20, "src1": 0.08, "src2": 0.08, "src3": 0.08, "src4": 0.06, "src5": 0.06}
REST = 0.44


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("matches")
    best = F.array_max(F.transform(found, lambda m: m["dice"]))
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_segments",
        F.size(found).cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["name"]))), ",").alias("licenses"),
        best.alias("best_dice"),
        F.array_join(F.transform(found, lambda m: F.concat_ws(":", m["first"], m["last"], m["name"])), ",").alias("spans"),
    )


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(table(spark, sf_dir, "documents"))


def op3_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.read_digests(simple8b.write_ids(table(spark, sf_dir, "documents"), tokenizer()))


def op4_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op5_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixture.mix(table(spark, sf_dir, "documents"), WEIGHTS, REST)
    return rows.select("d.*", "rate", "n_copies", "copy", "place")


def op6_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsa.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = suffix_tree.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs, labels.where(~held_out).select("doc_id", F.col("toxic").alias("label")))
    score = F.col("score")
    return model.score(docs).select("doc_id", held_out.alias("held_out"), score, F.when(score >= 0.7, 1).otherwise(0).alias("predicted"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("secrets")
    base = F.filter(found, lambda s: s.kind.isin("assign", "access", "hex"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter(found, lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")
    return secrets.secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(found).alias("spans"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.judged(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("d.doc_id").alias("doc_id"),
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        *["n_lines", "n_bad_lines", "lost_words"],
    )


def op10_longest_first_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards.balanced(table(spark, sf_dir, "documents"))
    return rows.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op11_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.lower_ascii(F.col("text")))
    fields = [docs[c] if c != "text" else F.coalesce(tampered, docs[c]) for c in merkle.FIELDS]
    proofs = merkle.proofs(merkle.manifest(docs.withColumn("altered", merkle.leaf(fields)), keep=("altered",)))
    folded, proof = merkle.folded(F.col("altered"), F.col("proof")), merkle.digest(F.col("proof")).alias("proof_sha256")
    rows = proofs.select("doc_id", "leaf", "subroot", "root", proof, folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_license_scan, op2_suffix_tree, op3_simple8b_ids, op4_minmax_near_dedup, op5_poisson_mixture, op6_latent_leaks]
    found += [op7_boosted_toxicity, op8_secret_scan, op9_quality_rules, op10_longest_first_shards]
    found += [op11_suffix_repeats, op12_merkle_manifest, op13_token_alignment]
    return {f.__name__: f for f in found}
