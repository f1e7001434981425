"""Images through Spark's ``image`` source: decoded in the JVM, resized and turned to RGB in Arrow batches.

The source reads what the Java image readers know (PNG, JPEG, GIF, BMP). Files that can't be decoded stay as rows that say so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes of the image files that the source decodes.
DECODED_SUFFIXES = "*.{jpg,jpeg,png,gif,bmp,JPG,JPEG,PNG,GIF,BMP}"
CUBIC = -0.5


def read(spark: SparkSession, path: str, pattern: str = DECODED_SUFFIXES) -> DataFrame:
    """(path, valid, height, width, channels, data) of the images at any depth: bytes by rows, blue before green before red. Files that can't
    be decoded have valid = false and null elsewhere."""
    raw = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    i = F.col("image")
    valid = F.coalesce((i["height"] > 0) & (i["width"] > 0) & i["nChannels"].isin(1, 3, 4), F.lit(False))
    told = lambda c: F.when(valid, i[c])
    return raw.select(i["origin"].alias("path"), valid.alias("valid"), told("height").alias("height"), told("width").alias("width"), told("nChannels").alias("channels"), told("data").alias("data"))


@lru_cache(maxsize=256)
def weights(given: int, wanted: int) -> np.ndarray:
    """(wanted x given) shares of a cubic convolution, widened by the factor where the image shrinks, so that every pixel counts."""
    scale = given / wanted
    wide = max(scale, 1.0)
    centre = (np.arange(wanted)[:, None] + 0.5) * scale
    x = np.abs((np.arange(given)[None, :] + 0.5 - centre) / wide)
    near = ((CUBIC + 2) * x - (CUBIC + 3)) * x * x + 1
    far = (((x - 5) * x + 8) * x - 4) * CUBIC
    w = np.where(x < 1, near, np.where(x < 2, far, 0.0))
    return w / w.sum(axis=1, keepdims=True)


def resized(pixels: np.ndarray, size: int) -> np.ndarray:
    """An image (height, width, 3) of bytes at size x size, rounded to whole levels after each direction; float32."""
    out = pixels.astype(np.float64)
    if out.shape[1] != size:
        out = np.clip(np.floor(np.einsum("hwc,xw->hxc", out, weights(out.shape[1], size), optimize=True) + 0.5), 0, 255)
    if out.shape[0] != size:
        out = np.clip(np.floor(np.einsum("hwc,yh->ywc", out, weights(out.shape[0], size), optimize=True) + 0.5), 0, 255)
    return out.astype(np.float32)


def rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """(height, width, 3), red first, from one, three or four channels; transparency is left out, grey is three times the same."""
    x = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(x, 3, axis=2) if channels == 1 else x[:, :, 2::-1]


def _each(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray | None]]:
    for batch in batches:
        height, width, channels = (batch.column(c).to_pylist() for c in ("height", "width", "channels"))
        for i in range(batch.num_rows):
            data = batch.column("data")[i].as_py()
            yield batch, i, None if data is None else resized(rgb(data, height[i], width[i], channels[i]), size)


def pixels(images: DataFrame, size: int = 224) -> DataFrame:
    """(path, valid, pixels) of ``read``'s rows: size x size x 3 numbers of 0 to 255 by rows, red first; null where nothing could be decoded. One
    image at a time is in memory beside its batch, which the session's ``spark.sql.execution.arrow.maxBytesPerBatch`` bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, x in _each(batches, size):
            value = pa.array([None if x is None else x.ravel()], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("path").slice(i, 1), batch.column("valid").slice(i, 1), value], names=["path", "valid", "pixels"])

    return images.mapInArrow(run, "path string, valid boolean, pixels array<float>")


def below(path: Column, root: str) -> Column:
    """The part of a path after ``root``, as keys of a manifest have it."""
    bare = "/" + root.partition(":")[2].strip("/") if "://" in root else root.rstrip("/")
    bare = "/" + bare.split("/", 2)[-1] if "://" in root and not root.startswith("file:") else bare
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    at = F.instr(plain, bare.replace("//", "/") + "/")
    return F.substring(plain, at + F.lit(len(bare.replace("//", "/")) + 1), F.length(plain))


def embedder(root: str, model: Callable[[], Callable[[np.ndarray], np.ndarray]], size: int = 224, width: int = 1280, backend: str = "efficientnet", at_once: int = 16, key: str = "key") -> Callable[[DataFrame], DataFrame]:
    """An embedder for the curation run that reads the files named by ``key`` below ``root``. ``model`` is called once a task and gives a function
    from (n, size, size, 3) to (n, width); vectors are brought to unit length. A row whose file is missing or can't be decoded is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = model()
        held: list[tuple[str, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            v = np.asarray(embed(np.stack([x for _, x in held])), dtype=np.float32).reshape(len(held), width)
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            v = np.where(norm > 0, v / np.where(norm > 0, norm, 1), v)
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in held]), pa.array(list(v), pa.list_(pa.float32()))], names=["_file", "embedding"])

        for batch, i, x in _each(batches, size):
            if x is not None:
                held.append((batch.column("path")[i].as_py(), x))
            if len(held) >= at_once:
                yield flush()
                held = []
        if held:
            yield flush()

    def apply(df: DataFrame) -> DataFrame:
        found = read(df.sparkSession, root).mapInArrow(run, "_file string, embedding array<float>").select(below(F.col("_file"), root).alias("_file"), "embedding")
        joined = df.join(found, df[key] == found["_file"], "left").drop("_file")
        missing = F.raise_error(F.concat(F.lit("no image that can be decoded for "), F.col(key))).cast("array<float>")
        return joined.withColumn("embedding", F.coalesce("embedding", missing)).withColumn("embedding_backend", F.lit(backend))

    return apply
