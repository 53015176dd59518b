"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, materialize

#: Words are runs of anything but ASCII white space.  ``bytes.split()`` cuts
#: at exactly these six characters, so Python and SQL agree.
SPACE_RE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE_RE), "")), F.lit(0)).cast("long")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out. Null ids: fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Inside, plans that run send at most ``rows`` rows at a time to Python: for
    rows that are wide themselves.  The session's own setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint, and besides lets the planner see the
    table's true size, so a later join is broadcast only if it is small.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rank_within(df: DataFrame, key: str, order: list[str], rank: str) -> DataFrame:
    """1-based rank inside each ``key`` by ``order`` (``key`` must not be null).

    Unlike one window over the key, a key with most of the rows is spread over
    many tasks: rows are range partitioned by key and order, ranked inside
    their partition, and shifted by the row counts of the key's earlier
    partitions (one row for each partition and key that meet).
    """
    ranged = (df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
              .withColumn("_pid", F.spark_partition_id()))
    ranged = materialize(ranged)
    counts = ranged.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_pid", key).orderBy(*order)
    return (ranged.withColumn("_rn", F.row_number().over(inside))
            .join(shift, ["_pid", key])
            .withColumn(rank, F.col("_rn").cast("long") + F.col("_before"))
            .drop("_pid", "_rn", "_before"))


class HashCache(dict):
    """word bytes -> 64-bit hash; forgets everything when it grows too large."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(words: list[bytes], cache: HashCache) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


_ONE_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_ONE_CASE = bytes.maketrans(b"\t\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")


def hashed_words(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of the texts in a row, number of words of each text);
    with ``lower`` A-Z count as a-z.

    A word of the texts is hashed once, whatever its repeats, and nothing is kept
    between calls: pass texts in ``text_chunks``.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").translate(_ONE_CASE if lower else _ONE_SPACE) for t in texts]
    cut = pc.split_pattern(pa.array(raw, pa.large_binary()), b" ")
    flat = cut.flatten()
    words = pc.greater(pc.binary_length(flat), 0)
    upto = np.concatenate([[0], np.cumsum(words.to_numpy(zero_copy_only=False))])
    ends = np.concatenate([[0], np.cumsum(cut.value_lengths().to_numpy())])
    codes = flat.filter(words).dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, codes.dictionary.to_pylist()), dtype=np.uint64,
                         count=len(codes.dictionary))
    return hashes[codes.indices.to_numpy()], np.diff(upto[ends])


def mix64(x: np.ndarray) -> np.ndarray:
    """Invertible mixing of 64-bit values (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of each run of n consecutive values."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(h) - n + 1
    mult = np.uint64(0x9E3779B97F4A7C15 + 2 * seed * 0x51ED270B)
    acc = np.zeros(m, dtype=np.uint64)
    g = mix64(h + np.uint64(seed)) if seed else h
    for i in range(n):
        acc = acc * mult + g[i:i + m]
    return mix64(acc)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed long, which is what Spark stores."""
    return x.view(np.int64)


def text_chunks(texts: list, limit: int = 2_000_000):
    """Index ranges of about ``limit`` characters, so that buffers stay small
    whatever the length of single texts."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def column_chunks(texts: pa.Array, limit: int = 2_000_000):
    """(a, b, texts[a:b] as Python strings): ``text_chunks`` of an Arrow column, of
    which only one chunk is ever held as strings."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    start = 0
    while start < len(texts):
        before = upto[start - 1] if start else 0
        end = min(len(texts), int(np.searchsorted(upto, before + limit)) + 1)
        yield start, end, texts.slice(start, end - start).to_pylist()
        start = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
