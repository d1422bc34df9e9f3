"""The queries opN_<name> over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catrec.llm import bpe_count, decontam, fuzzy_lines, grouping_pack, hilbert, icws, impact_search, langid, linkgraph, mixing, ppm, rabitq, slot_merkle
from catrec.llm.common import table
from catrec.llm.oracle import OP11_SQL, OP13_SQL

SHARDS = 24
TOKEN_LIMIT = 2048
SEQUENCE_TOKENS = 4096
END_ID = 1
MIX_WEIGHTS = [3, 1, 2]
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def id_remainder(folds: int) -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % folds


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(id_remainder(4) == 2, F.lit(False))
    model = langid.learn(docs.where(~held).select(F.col("doc_id").alias("id"), "text", "lang"))
    named = langid.identify(docs, model, keep=[held.alias("held_out")])
    return named.select("doc_id", "held_out", "lang_pred", "score", "spans")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.find_items(docs, table(spark, sf_dir, "benchmark")).select(
        "row_.doc_id", "contaminated", "items", "distances")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(id_remainder(7) == 2, F.lit(False))
    scored = ppm.score_documents(table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = bpe_count.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return icws.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept", "class_key")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = fuzzy_lines.dropped_lines(table(spark, sf_dir, "documents"))
    return dropped.select("doc_id", "n_lines", F.size("dropped").alias("n_dropped"), "dropped")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping_pack.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path(), SEQUENCE_TOKENS, END_ID)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    proofs = slot_merkle.manifest(docs, LEAF_COLUMNS, tree="lang", order="doc_id", tampered=more,
                                  tamper=id_remainder(7) == 0)
    folded = slot_merkle.fold(F.col("tampered_leaf"), F.col("path"))
    return proofs.select("doc_id", "leaf", "subroot", "root", slot_merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontamination, op3_lm_score, op4_token_counts, op5_sharding,
                                   op6_minhash_dedup, op7_embedding_dedup, op8_source_mixing, op9_url_filter,
                                   op10_fuzzy_lines, op11_ranked_search, op12_best_fit_packing, op13_merkle_manifest)}
ORACLE_SQL: dict[str, str] = {"op11_ranked_search": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
