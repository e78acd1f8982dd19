"""The operators as queries over the given tables, and their SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from divtide.llm import (
    alignment,
    centroids,
    decontaminate,
    fingerprints,
    html_layout,
    jaccard_join,
    line_templates,
    maxent_lm,
    packing,
    quality_rules,
    sharding,
    token_counts,
    toxicity,
)
from divtide.llm.common import documents, table
from divtide.llm.sql import CLUSTER_SQL, CONTAINMENT_SQL, JACCARD_SQL, RULES_SQL, TEMPLATES_SQL


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op9_rule_ledger", RULES_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(quality_rules.ledger(documents(spark, sf_dir)))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.Model(docs, table(spark, sf_dir, "labels")).score(docs)


@query("op3_html_layout")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(table(spark, sf_dir, "pages"))


@query("op5_maxent_lm")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return maxent_lm.Model(docs).score(docs)


@query("op6_line_templates", TEMPLATES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.dedup_lines(documents(spark, sf_dir))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


@query("op7_containment_search", CONTAINMENT_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("doc_key")


@query("op8_jaccard_join", JACCARD_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir)).drop("doc_key", "class_node")


@query("op2_external_shuffle")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.stored_shards(sharding.external_shuffle(documents(spark, sf_dir), n_shards=40))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return packing.pack(cut).drop("ids")


@query("op11_one_permutation_minhash")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints.fingerprint_documents(documents(spark, sf_dir))
    written = {c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")}
    return made.withColumns({"edited_sha256": F.lower(F.hex("edited_sha256")), **written})


@query("op12_bisector_tournament", CLUSTER_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query("op13_diagonal_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    return alignment.align_tokenizers(documents(spark, sf_dir), *paths)
