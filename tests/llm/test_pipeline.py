"""The pipeline's stages on planted cases, and its registration."""

from __future__ import annotations

import random

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from sievework.llm import queries, sql, tokens
from sievework.llm.common import BATCH_BYTES, BATCH_SETTING, forget

WORDS = ["the", "house", "river", "stone", "green", "walks", "over", "small", "bridge", "with", "seven", "old", "birds", "near", "water", "light"]


def plain(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ly"]) + ("" if rng.random() > 0.1 else ".") for _ in range(n))


def test_planted_cases(spark, tmp_path):
    rng = random.Random(2)
    passage = plain(rng, 60)
    docs = [(i, plain(rng, 120), "en", "s") for i in range(160)]
    toxic = [(200 + i, plain(rng, 60) + " you scum idiot trash " + plain(rng, 40), "en", "s") for i in range(60)]
    near = [(300, docs[3][1], "en", "s"), (301, docs[4][1].replace(docs[4][1].split()[50], "changed", 1), "en", "s")]
    passages = [(310 + i, plain(rng, 50) + " " + passage + " " + plain(rng, 50), "en", "s") for i in range(3)]
    odd = [(400, None, "en", "s"), (401, "", "en", "s"), (402, "12345 !!", "en", "s")]
    rows = docs + toxic + near + passages + odd
    d = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, int(200 <= r[0] < 300)) for r in docs + toxic], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    sf, out = str(tmp_path), {}
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, now, sf)
        if name != "packed":
            assert result.columns == d.columns
        result.write.parquet(f"{sf}/{name}")
        now = spark.read.parquet(f"{sf}/{name}")
        out[name] = {r.doc_id: r for r in now.collect()}
    clean = {r[0] for r in docs}
    assert set(out["language"]) == {r[0] for r in docs + toxic + near + passages}
    assert clean | {300, 301, 310, 311, 312} <= set(out["toxic"]) and len(set(out["toxic"]) & {r[0] for r in toxic}) <= 2
    assert clean | {310, 311, 312} <= set(out["near_duplicates"]) and not {300, 301} & set(out["near_duplicates"])
    kept = out["repeats"]
    assert set(kept) == set(out["near_duplicates"]) and passage in kept[310].text and passage[20:-20] not in kept[311].text and passage[20:-20] not in kept[312].text
    assert all(kept[i].text == out["near_duplicates"][i].text for i in clean) and all(r.n_chars == len(r.text) for r in kept.values())
    assert set(out["packed"]) == set(kept)
    assert corpus_pipeline.run(spark, sf).count() == spark.read.parquet(f"{sf}/packed").count()


def test_null_ids(spark, tmp_path):
    """Documents with a null doc_id stay to the end unless a near duplicate with a doc_id stays."""
    rng = random.Random(3)
    docs = [(i, plain(rng, 120), "en", "s") for i in range(160)]
    pair = plain(rng, 120)
    nulls = [plain(rng, 120), docs[3][1], pair, pair.replace(pair.split()[50], "changed", 1)]
    rows = docs + [(None, t, "en", "s") for t in nulls]
    d = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, d, "")
    assert got.columns == d.columns and sorted(r.text for r in got.where("doc_id is null").collect()) == sorted([nulls[0], *nulls[2:]])
    assert {r.doc_id for r in got.where("doc_id is not null").collect()} == set(range(160))
    few = corpus_pipeline.near_duplicates(spark, spark.createDataFrame([(None, "a")], "doc_id long, text string"), "").collect()
    assert [r.text for r in few] == ["a"]
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where("doc_id is null and piece = 0").count() == 3


def test_characters_and_columns(spark):
    """Characters that stand for broken ones stay, and so do columns whose names the operators use too."""
    rng = random.Random(4)
    passage = plain(rng, 60)
    rows = [(1, "a \ufffd stays " + passage, 9, "x", None), (2, "b \ufffd leaves " + passage + " end", 8, "y", 1.5), (3, None, 7, "z", 2.5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, row string, score double").withColumn("spans", F.lit(1)).withColumn("kept", F.lit("k"))
    got = {r.doc_id: r for r in corpus_pipeline.repeats(spark, d, "").collect()}
    assert got[1].text == rows[0][1] and got[1].n_chars == 9 and "b \ufffd leave" in got[2].text and got[2].n_chars == len(got[2].text) < 80
    assert got[3].text is None and (got[2].row, got[2].score, got[2].spans, got[2].kept) == ("y", 1.5, 1, "k")
    docs = spark.createDataFrame([(i, plain(rng, 30), "en", 0.5, "x") for i in range(40)], "doc_id long, text string, lang string, score double, row string")
    docs = docs.withColumn("lang_pred", F.lit("fr")).withColumn("predicted", F.lit(1)).withColumn("component_id", F.lit(1))
    assert corpus_pipeline.language(spark, docs, "").columns == docs.columns
    assert sorted(corpus_pipeline.language(spark, docs, "").collect()) == sorted(docs.collect()) == sorted(corpus_pipeline.near_duplicates(spark, docs, "").collect())


def test_empty_input(spark, tmp_path):
    d = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    found = queries.queries()
    assert [q.split("_")[0] for q in found] == [f"op{n}" for n in range(1, 14)] and set(sql.oracle_sql()) <= set(found)


def test_stages_bound_the_batches_sent_to_workers(spark):
    """Whatever the rows' size: 800 texts of 20,000 bytes were one batch."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    try:
        corpus_pipeline.packed(spark, spark.range(1).selectExpr("id as doc_id", "'a' as text"), "")
        rows = spark.range(0, 800, 1, 1).selectExpr("id", "repeat('x', 20000) as text")
        sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"bytes": [b.nbytes]}) for b in batches), "bytes long").collect()
        assert sum(r["bytes"] for r in sizes) >= 16_000_000
        assert max(r["bytes"] for r in sizes) <= BATCH_BYTES + 100_000
        spark.conf.set(BATCH_SETTING, "1m")  # a user's own bound stays
        corpus_pipeline.bounded_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == "1m"
    finally:
        spark.conf.unset(BATCH_SETTING)
        if before is not None:
            spark.conf.set(BATCH_SETTING, before)


def test_other_operators_drop_a_workers_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    held = tokens.cached_tokenizer(path, True)
    assert tokens.cached_tokenizer(path, True) is held
    forget()
    assert tokens.cached_tokenizer.cache_info().currsize == 0
