"""Many patterns by a join against the CASE chain, and line numbers of files in several splits."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sievework.functions import names
from sievework.operators import brands, events
from sievework.sources import readers


def test_literal_ends():
    cases = {"wc_*": ("wc_", ""), "*.jpg": ("", ".jpg"), "a*b?c": ("a", "c"), "plain": ("plain", ""), "x[ab]y": ("x", "y"), "*": ("", ""), "a[*": ("a", ""), "*[!a]": ("", ""), "a[]x]b": ("a", "b"), "*]": ("", "")}
    for pattern, ends in cases.items():
        head, tail = names.literal_ends(pattern)
        assert head == ends[0] and ends[1].endswith(tail)


def test_many_patterns_equal_the_chain(spark):
    rng = random.Random(3)
    pool = ["a", "b", "é", ".", "_", "[ab]", "[!a]", "?", "*", "["]
    patterns = [(f"b{i}", "".join(rng.choice(pool) for _ in range(rng.randint(1, 5)))) for i in range(80)] + [("x", "*"), ("y", "a*"), ("x", "")]
    rng.shuffle(patterns)
    given = ["".join(rng.choice("abé._[]") for _ in range(rng.randint(0, 5))) for _ in range(600)] + [None, "", "a"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(given)], "id long, name string")
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(patterns)], "ordinal long, brand string, pattern string")
    for own in (patterns, patterns[:20]):
        chain = {r.id: r.b for r in rows.select("id", names.first_match(F.col("name"), own).alias("b")).collect()}
        joined = brands.with_first_match(rows, "name", table.where(F.col("ordinal") < len(own))).collect()
        assert {r.id: r.brand for r in joined} == chain and len(joined) == len(given)
    assert brands.with_first_match(rows, "name", table.limit(0)).where("brand is not null").count() == 0


def test_ten_thousand_patterns(spark):
    table = spark.range(10_000).select(F.col("id").alias("ordinal"), F.concat(F.lit("b"), "id").alias("brand"), F.concat(F.lit("shop"), "id", F.lit("_*.jpg")).alias("pattern"))
    rows = spark.range(20_000).select("id", F.concat(F.lit("in/shop"), "id", F.lit("_x.jpg")).alias("key"))
    got = events.with_brand(rows, table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.count() == 10_000 and got.where(F.col("brand") != F.concat(F.lit("b"), "id")).count() == 0


def test_names_with_one_literal_are_dealt_out(spark, monkeypatch):
    """A literal that all names have gives no group of all names, and the matches stay the same."""
    monkeypatch.setattr(brands, "TASK_NAMES", 100)
    patterns = [(0, "own", "n7_*"), (1, "low", "*[0-4].jpg"), (2, "rest", "*.jpg"), (3, "never", "*")]
    table = spark.createDataFrame(patterns, "ordinal long, brand string, pattern string")
    rows = spark.range(2_000).select("id", F.concat(F.lit("n"), F.col("id"), F.lit("_"), F.col("id"), F.lit(".jpg")).alias("name"))
    keys = rows.select(F.col("name").alias("_given"), F.lit("tail").alias("side"), F.lit(".jpg").alias("literal"))
    own, every = brands.dealt(keys, brands.index(table))
    sizes = [r["count"] for r in own.groupBy("side", "literal", "_part").count().collect()]
    assert sum(sizes) == 2_000 and max(sizes) <= 150 and every.where("literal = '.jpg'").count() == 2 * len(sizes)
    got = {r.id: r.brand for r in brands.with_first_match(rows, "name", table).collect()}
    assert got == {i: "own" if i == 7 else "low" if i % 10 <= 4 else "rest" for i in range(2_000)}


@pytest.mark.parametrize("size", ["700", "128m"])
def test_line_numbers_across_splits(spark, tmp_path, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        texts = {"a.txt": [f"a{i} " + "x" * (i % 50) for i in range(400)], "b.txt": ["", "b1", ""], "c.txt": [f"c{i}" for i in range(300)]}
        for name, lines in texts.items():
            (tmp_path / name).write_text("\n".join(lines) + "\n")
        found = readers.numbered_lines(spark, str(tmp_path))
        if size == "700":
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = sorted((r.position, r.file.split("/")[-1], r.line, r.value) for r in found.collect())
        assert got == [(p, name, i + 1, v) for p, (name, i, v) in enumerate((n, i, v) for n, lines in texts.items() for i, v in enumerate(lines))]
        good = '{"label":"a","prediction":"b"}'
        (tmp_path / "p").mkdir()
        (tmp_path / "p" / "rows.jsonl").write_text("\n".join([good] * 200 + [""] + [good] * 30 + ['{"label":"a"}'] + [good] * 99 + ["{}"]))
        with pytest.raises(ValueError, match=r"rows.jsonl, line 232: \{\"label\":\"a\"\}"):
            readers.predictions(spark, str(tmp_path / "p"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
