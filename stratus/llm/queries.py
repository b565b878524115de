"""The operators applied to the whole given tables, and the SQL that states their results where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import (
    chunk_reuse, exact_dedup, fill_middle, importance, ngram_join, packing, pii, pivot_index, quality_rules, substring_dedup,
    target_resampling, token_counts, url_filters,
)
from stratus.llm.tables import read_table, store
from stratus.session import work_path

#: Fixed values of the registered url rules.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Only for registered runs, so that they can be repeated; a user of the operator passes a secret of their own.
PSEUDONYM_KEY = "registered-query"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise_documents(docs, PSEUDONYM_KEY)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are counted, recounted without markup signs, counted by a second version, and the toxic deleted."""
    docs = read_table(spark, sf_dir, "documents")
    clean = F.translate(F.col("text"), "#*$%&|<>", "")
    # Every text is read once; what follows moves counts only, so no join has to shuffle texts.
    counted = store(
        docs.select(
            "doc_id", "source", "lang",
            token_counts.count_tokens(F.col("text"), "words-1").alias("first"),
            token_counts.count_tokens(clean, "words-1").alias("words-1"),
            token_counts.count_tokens(clean, "kinds-1").alias("kinds-1"),
        ),
        "token-counts-by-document",
    )
    toxic = read_table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    gone = counted.join(toxic, "doc_id", "left_semi")

    def under(rows: DataFrame, version: str, tokens: str) -> DataFrame:
        return rows.select("source", "lang", F.lit(version).alias("tokenizer"), F.col(tokens).alias("tokens"))

    rollup = token_counts.TokenRollup(spark, work_path(spark, "token-counts"))
    recount = counted.select(
        "source", "lang", F.lit("words-1").alias("tokenizer"), F.col("first").alias("before"), F.col("words-1").alias("after")
    )
    rollup.commit("1-inserts", token_counts.inserts(under(counted, "words-1", "first")))
    rollup.commit("2-recount", token_counts.revisions(recount))
    rollup.commit("3-version", token_counts.inserts(under(counted, "kinds-1", "kinds-1")))
    leaving = [token_counts.deletes(under(gone, v, v)) for v in ("words-1", "kinds-1")]
    rollup.commit("4-deletes", leaving[0].unionByName(leaving[1]))
    rollup.compact()
    # Sent again, as after a failure: it is known and counts once.
    rollup.commit("2-recount", token_counts.revisions(recount))
    return rollup.totals()


def op9_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return chunk_reuse.encode_documents(docs, vocabulary("word_bpe_49k.json"), chunk_reuse.DIGESTS)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"), keep="largest")


def op11_embedding_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivot_index.near_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.rearrange(read_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = target_resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_quality_rules, op3_ngram_join, op4_quality_classifier, op5_packing, op6_substring_dedup,
        op7_pii, op8_token_counts, op9_bpe_chunks, op10_exact_dedup, op11_embedding_pivots, op12_fill_middle,
        op13_target_resampling,
    )
}
