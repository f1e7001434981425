"""Fill-in-the-middle transformation over an index of distinct texts.

1. A text's digest deals it out; a digest that more than one row in ``HOT`` has (and more than ``PART_ROWS`` rows) is split into parts of
   at most that share, so that no task holds a large group of copies. At most ``HOT`` digests can be so frequent: their list is broadcast.
2. The index has one row for each digest and part: its texts are compared byte by byte (least and greatest must be equal), and the
   places where code points start are written once as an Elias-Fano list.
3. The index is joined back to the documents. Each document's seeded cuts are code points; ``select`` turns them into bytes.

The texts are shuffled once: index and documents come from one exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, slices_by_bytes

# Sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
HOT, PART_ROWS = 1000, 4096


def starts(text: bytes) -> np.ndarray:
    """Bytes at which code points start: all that aren't continuation bytes (of a text that isn't UTF-8 as well)."""
    return np.flatnonzero(np.frombuffer(text, dtype=np.uint8) & 0xC0 != 0x80)


def encode(values: np.ndarray, universe: int) -> bytes:
    """Elias-Fano list of ascending numbers below ``universe``: one byte with the count of low bits, the low bits, and the high parts in unary."""
    n = len(values)
    low = max(0, (universe // n).bit_length() - 1) if n else 0
    lows = np.packbits(values[:, None] >> np.arange(low) & 1, bitorder="little") if low else np.zeros(0, np.uint8)
    bits = np.zeros((universe >> low) + n + 1 if n else 0, dtype=np.uint8)
    bits[(values >> low) + np.arange(n)] = 1
    return bytes([low]) + lows.tobytes() + np.packbits(bits, bitorder="little").tobytes()


def select(code: bytes, n: int, k: np.ndarray) -> np.ndarray:
    """The k-th numbers (from 0, below n) of an Elias-Fano list of n."""
    low = code[0]
    split = 1 + (n * low + 7) // 8
    high = np.frombuffer(code, dtype=np.uint8, offset=split)
    before = np.cumsum(np.bitwise_count(high), dtype=np.int64)
    byte = np.searchsorted(before, k, side="right")
    rank = k - np.where(byte > 0, before[byte - 1], 0)
    bits = np.unpackbits(high[byte][:, None], axis=1, bitorder="little")
    value = byte * 8 + np.argmax(np.cumsum(bits, axis=1) > rank[:, None], axis=1) - k
    if low:
        lows = np.unpackbits(np.frombuffer(code, dtype=np.uint8, count=split - 1, offset=1), bitorder="little")[: n * low].reshape(n, low)
        value = value << low | (lows[k].astype(np.int64) << np.arange(low)).sum(axis=1)
    return value


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices_by_bytes(batch.column(2)):
            part = batch.slice(a, b - a)
            counts, codes = [], []
            for text in part.column(2).to_pylist():
                at = starts(text)
                counts.append(len(at))
                codes.append(encode(at, len(text)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(codes, pa.binary())], names=["key", "part", "n", "code"])
        del batch
        give_back()


def _dealt(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, content, key, part), dealt out by key and part."""
    content = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("id"), content.alias("content")).withColumn("key", F.unhex(F.sha2("content", 256)))
    least = max(float(PART_ROWS), df.count() / HOT)
    hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > least)
    hot = hot.select("key", F.ceil(F.col("copies") / F.lit(least)).alias("parts"))
    salt = F.pmod(F.xxhash64("id", F.spark_partition_id()), F.coalesce("parts", F.lit(1))).cast("int")
    return rows.join(F.broadcast(hot), "key", "left").select("id", "content", "key", salt.alias("part")).repartition("key", "part")  # HOT rows at most


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices_by_bytes(batch.column("content")):
            part = batch.slice(a, b - a)
            column = lambda c: part.column(c).to_pylist()
            out = []
            for text, n, code, form, first, last in zip(column("content"), column("n"), column("code"), column("form"), column("first"), column("last")):
                if form == "plain":
                    out.append(text)
                    continue
                k = np.array([first, last], dtype=np.int64)
                x, y = (int(v) if i < n else len(text) for v, i in zip(select(code, n, np.minimum(k, n - 1)), k.tolist()))
                head, tail = (PREFIX.encode() + text[:x], SUFFIX.encode() + text[y:])
                out.append((head + tail if form == "psm" else tail + head) + MIDDLE.encode() + text[x:y])
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "n", "form", "first", "last")), pa.array(out, pa.binary())], names=["id", "n", "form", "first", "last", "output"])
        del batch
        give_back()


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output binary) of every row: the text cut at two code points that ``seed`` and the id choose.

    ``form`` is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain: the text as it is, without counts. Plain are
    ``plain_percent`` of the documents, empty texts, texts with a sentinel, and rows with a null id, as nothing seeds them. A null text counts
    as empty. Repeated rows get the same result each. Code points start at every byte that isn't a continuation byte, so a text that isn't
    UTF-8 is cut and restored as well. Other columns are not looked at."""
    dealt = _dealt(df, id_col, text_col)
    same = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.raise_error(F.lit("two texts have one SHA-256 digest")).cast("binary"))
    # the count keeps all columns in this branch, so that both branches read one exchange
    one = dealt.groupBy("key", "part").agg(F.min("content").alias("least"), F.max("content").alias("most"), F.count("id").alias("ids"))
    index = one.select("key", "part", F.when(F.col("ids") >= 0, same).alias("content")).mapInArrow(_index, "key binary, part int, n long, code binary")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    h = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = F.contains("content", F.lit(PREFIX).cast("binary")) | F.contains("content", F.lit(SUFFIX).cast("binary")) | F.contains("content", F.lit(MIDDLE).cast("binary"))
    form = F.when(F.col("id").isNull() | (F.col("n") == 0) | marked | (h[2] % 100 >= 100 - plain_percent), "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = dealt.join(index, ["key", "part"], "left").withColumn("_digest", digest)
    x, y = (v % (F.col("n") + 1) for v in h[:2])
    rows = rows.select("id", "content", "n", "code", form.alias("form"), F.least(x, y).alias("first"), F.greatest(x, y).alias("last"))
    kind = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("output", T.BinaryType())])
    cut = F.col("form") != "plain"
    return rows.mapInArrow(_cut, kind).select(
        F.col("id").alias(id_col), "n", "form", F.when(cut, F.col("first")).alias("prefix_chars"), F.when(cut, F.col("last") - F.col("first")).alias("middle_chars"), "output"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. Each sentinel occurs once in it: no two of them overlap, and the text has none."""
    o = output.cast("string")
    after = lambda s, mark: F.substring_index(s, mark, -1)
    upto = lambda s, mark: F.substring_index(s, mark, 1)
    psm = F.concat(upto(after(o, PREFIX), SUFFIX), after(o, MIDDLE), upto(after(o, SUFFIX), MIDDLE))
    spm = F.concat(upto(after(o, PREFIX), MIDDLE), after(o, MIDDLE), upto(after(o, SUFFIX), PREFIX))
    return F.when(form == "plain", o).when(form == "psm", psm).otherwise(spm)
