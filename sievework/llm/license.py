"""License scans: phrases at word level, and an exact set-similarity join of notices with text blocks. DataFrame functions only.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII; A-Z count as a-z. Blocks are ``BLOCK`` words
long and start every ``STEP`` words, so that any run of BLOCK - STEP + 1 words lies whole in one. A notice is found in a block if at
least ``NEED`` of its distinct words are there.

The words of notices are ordered by how many documents contain them, rarest first. A block that reaches the threshold has one of a
notice's first n - ceil(NEED n) + 1 words (prefix), at least ceil(NEED n) words (length), and for the first of the prefix words that
it has, enough words of the notice from there on (position). Documents without any prefix word are never cut into blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Notices and the labels that the join gives.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "released under the mit license": "mit-release",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
}
BLOCK, STEP = 48, 16
NEED = (4, 5)  # four fifths
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def padded(text: Column) -> Column:
    """The words of a text, each between two single spaces; a null text has none."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrases(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels array): all places where a phrase's words stand one after another."""
    rows = df.select(id_col, padded(F.col(text_col)).alias("_words"))
    rows = rows.withColumn("_n", F.when(F.col("_words") == "  ", F.lit(0)).otherwise(_spaces(F.col("_words")) - 1))
    words, count, first, last, labels = F.col("_words"), F.lit(0), [], [], []
    for phrase, label in PHRASES.items():
        has = F.contains(words, F.lit(f" {phrase} "))
        pattern, k = f" {phrase}(?= )", len(phrase.split())
        count = count + F.when(has, F.regexp_count(words, F.lit(pattern))).otherwise(F.lit(0))
        first.append(F.when(has, _spaces(F.substring(words, F.lit(1), F.instr(words, f" {phrase} "))) - 1))
        last.append(F.when(has, F.col("_n") - (_spaces(F.element_at(F.split(words, pattern), -1)) - 1) - k))
        labels.append(F.when(has, F.lit(label)))
    return rows.select(
        id_col,
        F.col("_n").cast("long").alias("n_words"),
        count.cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"),
        F.greatest(*last).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base_labels"),
    )


def word_order(df: DataFrame, text_col: str = "text") -> list[str]:
    """The words of all notices, by the number of documents that contain them as a part of their text; one row comes to the driver."""
    known = sorted({w for n in NOTICES for w in n.split()})
    lowered = df.select(F.lower(text_col).alias("t"))
    counts = lowered.agg(*(F.count_if(F.contains("t", F.lit(w))).alias(w) for w in known)).first()
    return sorted(known, key=lambda w: (counts[w], w))


def notice_table(order: list[str]) -> list[tuple[str, str, list[str], int]]:
    """(notice, label, its distinct words rarest first, words that a block must have)."""
    place = {w: i for i, w in enumerate(order)}
    out = []
    for notice, label in NOTICES.items():
        words = sorted(set(notice.split()), key=place.__getitem__)
        out.append((notice, label, words, math.ceil(NEED[0] * len(words) / NEED[1])))
    return out


def blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, block, notice, label, containment): every text block that has enough of a notice; block counts from 0 in the text."""
    spark = df.sparkSession
    notices = notice_table(word_order(df, text_col))
    prefix = [(n, label, words, need, words[i], len(words) - i) for n, label, words, need in notices for i in range(len(words) - need + 1)]
    keys = sorted({p[4] for p in prefix})
    table = spark.createDataFrame(prefix, "notice string, label string, words array<string>, need int, key string, rest int")
    lowered = F.lower(text_col)
    near = lowered.contains(keys[0])
    for key in keys[1:]:
        near = near | lowered.contains(key)
    words = F.split(F.trim(padded(F.col(text_col))), " ")
    cut = df.where(near).select(id_col, words.alias("_w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0)), F.lit(STEP))
    cut = cut.select(id_col, F.posexplode(F.transform(starts, lambda i: F.array_distinct(F.slice(F.col("_w"), i + 1, BLOCK)))).alias("block", "_b"))
    probes = cut.select(id_col, "block", "_b", F.explode(F.array_intersect("_b", F.array(*map(F.lit, keys)))).alias("key"))
    joined = probes.join(F.broadcast(table), "key")  # a few rows for each notice, fixed by NOTICES
    enough = (F.size("_b") >= F.col("need")) & (F.col("rest") >= F.col("need"))
    both = F.size(F.array_intersect("_b", "words"))
    # the first prefix word that a block has stands for the pair, so that no pair counts twice
    first = F.element_at(F.filter("words", lambda w: F.array_contains("_b", w)), 1) == F.col("key")
    found = joined.where(enough & first).withColumn("_both", both).where(F.col("_both") >= F.col("need"))
    return found.select(id_col, "block", "notice", "label", (F.col("_both") / F.size("words")).alias("containment"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    labels: those of phrases and of notices, distinct, sorted, joined by commas; score: 1 with a phrase, else the greatest containment of
    a notice, else 0. Null and empty texts have no words and no labels. What notices give goes by id and text (its xxhash64), so rows with one
    id and different texts don't share it, and rows with null ids get their own."""
    keyed = df.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text")).alias("_key"), F.col(text_col).alias("_text"))
    own = blocks(keyed, "_key", "_text").groupBy("_key.id", "_key.text").agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_most"))  # at most one entry a notice
    rows = phrases(keyed, "_key", "_text").join(own, F.col("_key.id").eqNullSafe(F.col("id")) & (F.col("_key.text") == F.col("text")), "left")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("_labels", F.array().cast("array<string>"))))
    return rows.select(
        F.col("_key.id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_most", F.lit(0.0))).alias("score"),
    )
