"""The queries of this package's operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, fim, jaccard, langid, license, nndescent, packing, periodic, recompress, suffix, tokenfile, toxicity
from .common import crc_of_text, new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cross_polytope_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def held_out(of: int, remainder: int):
    return F.pmod(crc_of_text("doc_id"), F.lit(of)) == remainder


def language_model(documents: DataFrame) -> langid.Model:
    return langid.fit(documents.where(~held_out(3, 1)), public_tokenizers.path("piece_bpe_32k.model"))


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(documents, labels.where(~held_out(5, 0)))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.predict(documents, language_model(documents)).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "token-files")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), out)
    return tokenfile.checksums(tokenfile.read_tokens(spark, out))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = toxicity.score(documents, toxicity_model(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return kept.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text): in documents whose h = crc32(doc_id as text) is a multiple of 10, words from some place on repeat those there."""
    h = crc_of_text("doc_id")
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))

    def planted(w):  # bound as a lambda's variable, or each word would split the text again
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    text = F.get(F.transform(F.array(words), planted), F.lit(0))
    return documents.select("doc_id", F.when((h % 10 == 0) & (F.size(words) > 0), text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's longest run, and digests of all its runs and of the words that are left."""
    found = periodic.runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    said = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"], F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"), F.sha2(F.replace(said, F.lit(",\n"), F.lit("\n")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op12_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document repeated windows cover, and a digest of the others."""
    kept = recompress.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_words", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's cut text, and of the text that is rebuilt from it."""
    cut = fim.transform(table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form")).cast("binary")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_cross_polytope_ann, op2_bpe_roundtrip, op3_best_fit_packing, op4_language_id, op5_token_files, op6_jaccard_join, op7_toxicity, op8_suffix_dedup,
        op9_embedding_near_dedup, op10_license_scan, op11_periodic_runs, op12_recompression_dedup, op13_fill_in_middle,
    )
    return {f.__name__: f for f in every}
