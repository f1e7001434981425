"""Corpus pipeline: documents in, packed training sequences out.

Every stage takes all rows that the one before kept, is written as Parquet and read again. All stages but the last return the
columns of ``documents``. Rows with one doc_id count as one document. Null texts count as empty: they have no language and go in
the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import jaccard, langid, packing, queries, suffix, toxicity
from sievework.llm.common import bounded_batches, materialise

#: A language's share of the probability below which a document counts as of no language.
LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without letters, and texts that no language clearly explains."""
    bounded_batches(spark)
    found = langid.predict(docs, queries.language_model(docs), whole=True)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("row.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    bounded_batches(spark)
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, whole=True).where(F.col("predicted") == 0).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays. Documents with a null doc_id go where their group has
    one with a doc_id, and all stay where it has none."""
    bounded_batches(spark)
    nameless = bool(docs.where("doc_id is null").take(1))
    carried = F.when(F.col("doc_id").isNull(), F.struct("*")).alias("_nameless")
    groups = jaccard.components(docs.select("doc_id", "text", carried), carry=("_nameless",)) if nameless else jaccard.components(docs)
    kept = docs.join(groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id"), "doc_id", "left_semi")
    return kept.unionByName(groups.where("doc_id is null and component_id is null").select("_nameless.*")) if nameless else kept


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts. A character that loses one of its bytes goes as a whole; documents stay, even empty, and one
    with a null doc_id as it is."""
    bounded_batches(spark)
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.col("text").isNull().alias("_no text")).alias("_others")
    kept = suffix.remove_repeats(docs.select("doc_id", "text", others), carry=("_others",), whole_characters=True)
    text = F.when(~F.col("_others.`_no text`"), F.col("kept").cast("string"))
    new = {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("spans") == 0, F.col("_others.n_chars")).otherwise(F.char_length(text)).cast(docs.schema["n_chars"].dataType)
    return kept.select(*(new.get(c, F.col(f"_others.`{c}`")).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    bounded_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("toxic", toxic), ("near_duplicates", near_duplicates), ("repeats", repeats), ("packed", packed)]
#: Language models, chains and tokenizers can't be told in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
