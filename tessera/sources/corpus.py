"""Corpus scans: driver parquet tables, the labelled corpus, split CSV files,
and a first-source-wins fallback loader.

The reference keeps three pandas frames (train / validation / test) and
identifies rows by position.  Here a corpus is ONE DataFrame
``doc_id LONG, text STRING, label INT, split STRING``; the split is a column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import hash_bucket
from tessera.functions.text import clean_text
from tessera.operators.ranks import dense_index

# --- fixed values ----------------------------------------------------------
SPLITS = ("train", "validation", "test")
SPLIT_SEED = 42
# Share of the 100 hash buckets given to train and validation; the rest is test.
TRAIN_BUCKETS = 60
VALIDATION_BUCKETS = 80
# ----------------------------------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_of(key, seed: int = SPLIT_SEED) -> Column:
    """Deterministic split from md5 of ``seed:key``: bucket < 60 train,
    < 80 validation, else test.  Same rule in the DuckDB oracle."""
    b = hash_bucket(F.concat(F.lit(f"{seed}:"), (F.col(key) if isinstance(key, str) else key).cast("string")), 100)
    return (F.when(b < TRAIN_BUCKETS, F.lit("train"))
            .when(b < VALIDATION_BUCKETS, F.lit("validation"))
            .otherwise(F.lit("test")))


def labelled_docs(spark: SparkSession, sf_dir: str, label_col: str = "toxic",
                  seed: int = SPLIT_SEED) -> DataFrame:
    """documents JOIN labels on doc_id -> doc_id, text, label, split.

    Both sides are keyed by doc_id; Catalyst picks the join strategy (AQE
    turns it into a broadcast when the labels side is small at runtime).
    Only the needed columns are read from parquet.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col(label_col).alias("label"))
    return (docs.join(labels, "doc_id")
            .select("doc_id", clean_text("text").alias("text"),
                    F.col("label").cast("int").alias("label"),
                    split_of("doc_id", seed).alias("split")))


def all_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document (labelled or not): doc_id, text."""
    return read_table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("text"))


def content_ids(corpus: DataFrame) -> DataFrame:
    """(doc_id, text, label, split): ids that depend on the rows alone.

    ``doc_id`` is the md5 of split, label and text, a dash, and the row's number
    among equal rows; equal rows are interchangeable, so any layout of the files
    and any number of tasks gives the same table.  A row with very many copies is
    spread: copies are dealt out by where they were read and numbered across
    partitions, never in one task.
    """
    rows = corpus.select("text", "label", "split")
    content = F.concat_ws("\x1f", F.col("split"), F.coalesce(F.col("label").cast("string"), F.lit("")), F.col("text"))
    rows = rows.withColumns({"_h": F.md5(content), "_at": F.monotonically_increasing_id()})
    ranked = dense_index(rows, ["_at"], ["_h"], "_n")
    return ranked.select(F.concat("_h", F.lit("-"), F.col("_n").cast("string")).alias("doc_id"), "text", "label", "split")


def land_corpus(corpus: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write a corpus with stored ids as Parquet, one folder for each split, and
    return the landed table: from then on every read sees the same ids, is cut to
    the splits asked for, and is spread over tasks however the source was laid out."""
    ready = corpus if "doc_id" in corpus.columns else content_ids(corpus)
    ready.select("doc_id", "text", "label", "split").write.mode(mode).partitionBy("split").parquet(path)
    return load_parquet_splits(corpus.sparkSession, path)


def scan_split_csvs(spark: SparkSession, root: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """(text, label, split) of ``{root}/{split}.csv``, a file or a folder of files.

    A missing file raises ``AnalysisException`` (Spark resolves paths eagerly).
    Texts may hold newlines and quotes, hence multiLine and the quote escape; a
    file is then one task, so large splits should be folders of files.
    """
    frames = []
    for split in splits:
        # Columns by header name (all strings, no inference pass); extra
        # columns are dropped by the projection below.
        df = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"')
              .csv(f"{root.rstrip('/')}/{split}.csv"))
        frames.append(df.select(clean_text("text").alias("text"),
                                F.col("label").cast("int").alias("label"),
                                F.lit(split).alias("split")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def load_split_csvs(spark: SparkSession, root: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """Split CSV scan with ``content_ids``."""
    return content_ids(scan_split_csvs(spark, root, splits))


def load_parquet_splits(spark: SparkSession, root: str) -> DataFrame:
    """Landed published dataset: parquet with text, label and split columns, and
    its stored ``doc_id``, or ``content_ids`` if it has none."""
    df = spark.read.parquet(root)
    rows = df.select(*[c for c in ("doc_id",) if c in df.columns], clean_text("text").alias("text"),
                     F.col("label").cast("int").alias("label"), "split")
    return rows if "doc_id" in df.columns else content_ids(rows)


def load_with_fallback(loaders: Sequence[tuple[str, Callable[[], DataFrame]]]) -> tuple[DataFrame, str]:
    """First loader whose plan resolves wins; adds a ``source`` column.

    Only ``AnalysisException`` (missing path, bad schema) moves on to the next
    loader; any other error surfaces.
    """
    last: Exception | None = None
    for tag, loader in loaders:
        try:
            df = loader()
            df.schema  # force analysis
        except AnalysisException as exc:  # missing path or bad schema
            last = exc
            continue
        return df.withColumn("source", F.lit(tag)), tag
    raise last if last is not None else ValueError("no loaders given")
