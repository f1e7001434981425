"""Array and hash functions for embeddings and probability vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS_OF_DIGEST = 8  # 32-bit words in one SHA-256 digest
ROWS_AT_ONCE = 256  # of hashed vectors, so that a worker's memory doesn't hang on the batches' size
TINY = 1.1920928955078125e-07  # the least norm that a vector is divided by


def hash_words(payload: Column, width: int) -> Column:
    """``width`` numbers in [-1, 1] from the payload: word i is big-endian word i mod 8 of sha256(be32(i div 8) || payload)."""
    blocks = -(-width // WORDS_OF_DIGEST)
    digest = lambda c: F.sha2(F.concat(F.unhex(F.lpad(F.hex(c), 8, "0")), payload), 256)
    word = lambda d, k: F.conv(F.substring(d, F.lit(1) + k * 8, F.lit(8)), 16, 10).cast("double") / F.lit(4294967295.0) * 2 - 1
    digests = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda c: digest(c))
    words = F.transform(digests, lambda d: F.array(*(word(d, F.lit(k)) for k in range(WORDS_OF_DIGEST))))
    return F.slice(F.flatten(words), 1, width)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def normalised(v: Column) -> Column:
    """``v`` over its norm. Both are bound as a lambda's variable, or each element would work out the whole vector and its norm again."""
    bound = F.transform(F.array(v), lambda w: F.struct(w.alias("w"), F.greatest(norm(w), F.lit(TINY)).alias("n")))
    return F.get(F.transform(bound, lambda b: F.transform(b["w"], lambda x: x.cast("double") / b["n"])), F.lit(0))


def hash_embedding(payload: Column, width: int = 1280) -> Column:
    """Unit vector that depends on the bytes alone; null for a null payload (a missing file is never hashed by its name).

    The numbers of ``normalised(hash_words(payload, width))``, to the bit. Nearly all of the work is hashing the payload width / 8 times, and
    hashlib does that faster than the JVM; the words are then read at once instead of one hexadecimal string each."""
    starts = [c.to_bytes(4, "big") for c in range(-(-width // WORDS_OF_DIGEST))]

    @F.arrow_udf("array<double>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sha = hashlib.sha256
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                found = [v.as_py() for v in some.drop_null()]
                words = np.frombuffer(b"".join(sha(c + v).digest() for v in found for c in starts), dtype=">u4").reshape(len(found), len(starts) * WORDS_OF_DIGEST)[:, :width]
                x = words.astype(np.float64) / 4294967295.0 * 2 - 1
                x /= np.maximum(np.sqrt(np.cumsum(x * x, axis=1)[:, -1:]), TINY)  # summed one after another, as the JVM does
                sizes = np.where(some.is_valid().to_numpy(zero_copy_only=False), width, 0)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.ListArray.from_arrays(ends, pa.array(x.ravel()), mask=some.is_null())
            if not len(batch):
                yield pa.array([], pa.list_(pa.float64()))

    return hashed(payload)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def argmax(p: Column) -> Column:
    """Index from 0 of the first greatest element."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")
