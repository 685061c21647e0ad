"""The registered queries of the pipeline operators, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.llm import bpe, conversation_trie, decontaminate, html_text, langid, manifest, near_dedup, neighbours, quality, secret_scan, sentence_spans, sql, toxicity, url_filter
from hoptrail.llm.common import materialize, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(
        spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer(spark))


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.NearCopies(table(spark, sf_dir, "documents"), width=2)
    return found.groups().withColumnRenamed("doc", "doc_id")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.report(docs, benchmark, slop=20).drop("matches", "near")


URL_RULES = [
    url_filter.Rule(url_filter.BLOCK, "net/"),
    url_filter.Rule(url_filter.ALLOW, "example.net/en/"),
    url_filter.Rule(url_filter.BLOCK, "example.com/de/"),
    url_filter.Rule(url_filter.ALLOW, "org/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.remove_repeats(docs)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("secrets", lambda x: x["kind"] != secret_scan.RANDOM)
    return secret_scan.find(docs, keep_text=False).select(
        "doc_id",
        *(
            secret_scan.count(base, kind).alias(f"n_{kind}")
            for kind in secret_scan.KINDS
        ),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.filter(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id",
        "held_out",
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    labelled = toxicity.labelled_sample(docs, labels.select("doc_id", "toxic"))
    model = toxicity.fit(toxicity.graded(labelled))
    found = toxicity.score(docs, model).drop("text")
    return found.withColumn("toxic", F.col("p_toxic") >= 0.5)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.fit(pages)).drop("html")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    docs = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "text")
    return quality.judge(docs, quality.fit(docs.filter("NOT held_out"), labels)).drop("text")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialize(conversation_trie.conversations(table(spark, sf_dir, "conversations")))
    return conversation_trie.Trie(conversation_trie.rebuilt(own)).nodes()


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_near_copies, op3_neighbours, op4_decontamination, op5_url_filter, op6_sentence_spans, op7_secrets, op8_language, op9_toxicity, op10_html_text, op11_quality, op12_conversation_trie, op13_merkle_manifest)}


ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": sql.decontamination(),
    "op12_conversation_trie": sql.conversation_trie(),
    "op13_merkle_manifest": sql.manifest(),
}
