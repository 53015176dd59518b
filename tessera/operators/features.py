"""TF-IDF features: term counts, vocabulary fit, transform (long and vector form).

Plan shape (one shuffle of raw text, everything per document stays local):

  docs --repartition(doc_id)--> explode terms
     --> broadcast join vocab (size bounded by max_features)
     --> groupBy(doc_id, idx)  (no shuffle: hash(doc_id) already clusters it)
     --> L2 norm by window over doc_id (no shuffle, same partitioning)

The vocabulary fit shuffles only on ``term`` with map-side partial
aggregation, so a term present in every document costs one row per task.
Formulas follow the reference's vectorizer: sublinear tf ``1 + ln(tf)``,
smoothed idf ``ln((1 + n) / (1 + df)) + 1`` (MLlib's IDF lacks the ``+ 1``),
L2 row norm; the vocabulary keeps terms with ``df >= min_df`` and the
``max_features`` highest corpus counts (ties by term), indexed by term order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import split_words
from tessera.functions.tokens import (
    char_wb_gram_at,
    char_wb_gram_count,
    word_gram_at,
    word_gram_count,
    word_tokens,
)
from tessera.operators import grams as gr
from tessera.operators.ranks import dense_index
from tessera.session import stored

# Tables of a known row count up to this get an explicit broadcast hint; the
# join of larger ones is left to Catalyst/AQE.
BROADCAST_VOCAB_MAX = 2_000_000


@dataclass(frozen=True)
class VectorizerSpec:
    kind: str = "word"          # "word" or "char" (char_wb)
    ngram_lo: int = 1
    ngram_hi: int = 2
    min_df: int = 2
    max_features: int | None = 8000
    sublinear_tf: bool = True

    def __post_init__(self):
        if self.kind not in ("word", "char"):
            raise ValueError(self.kind)


# --- fixed values: the reference's vectorizer settings ----------------------
WORD_1_2 = VectorizerSpec("word", 1, 2, 2, 8000)
CHAR_3_5 = VectorizerSpec("char", 3, 5, 2, 8000)
WORD_1_2_MIN3 = VectorizerSpec("word", 1, 2, 3, 8000)
CHAR_3_5_MIN3 = VectorizerSpec("char", 3, 5, 3, 8000)
WORD_1_3 = VectorizerSpec("word", 1, 3, 2, 10000)
CHAR_3_6 = VectorizerSpec("char", 3, 6, 2, 10000)
# ----------------------------------------------------------------------------


def gram_rows(docs: DataFrame, spec: VectorizerSpec, text_col: str = "text",
              key: str = "doc_id", num_partitions: int | None = None) -> DataFrame:
    """(doc_id, term, n): the n-grams of every document, not yet summed.

    The documents are hash-partitioned by ``doc_id`` once; whatever is
    counted per document afterwards needs no further shuffle.
    """
    n = num_partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = docs.select(key, text_col).repartition(n, key)
    if spec.kind == "char":
        return _char_rows(parted, spec, text_col, key)
    # Tokens are projected first (the gram expressions read a column, not
    # the tokenizer); then one row per gram index and a plain slice+join, as
    # for char n-grams.  The count can be 0, so the index range is guarded.
    toks = parted.select(key, word_tokens(text_col).alias("_tok"))
    total = word_gram_count("_tok", spec.ngram_lo, spec.ngram_hi)
    k = F.explode(F.when(total > 0, F.sequence(F.lit(0), total - 1)).otherwise(F.array().cast("array<int>")))
    return (toks.select(key, "_tok", k.alias("k"))
            .select(key, word_gram_at("_tok", "k", spec.ngram_lo, spec.ngram_hi).alias("term"),
                    F.lit(1).cast("long").alias("n")))


def _char_rows(parted: DataFrame, spec: VectorizerSpec, text_col: str, key: str) -> DataFrame:
    """char_wb n-grams: a word's n-grams depend only on the word, so words
    are counted per document first and each distinct (doc, word) is expanded
    once, weighted by its count, on the ``doc_id`` partitioning."""
    words = (parted.select(key, F.explode_outer(split_words(text_col)).alias("w"))
             .where(F.col("w").isNotNull())
             .groupBy(key, "w").agg(F.count(F.lit(1)).alias("wc")))
    # One row per gram index, then plain substring arithmetic: stays in
    # whole-stage codegen (a lambda per gram is interpreted).
    k = F.explode(F.sequence(F.lit(0), char_wb_gram_count("w", spec.ngram_lo, spec.ngram_hi) - 1))
    return (words.select(key, "w", "wc", k.alias("k"))
            .select(key, char_wb_gram_at("w", "k", spec.ngram_lo, spec.ngram_hi).alias("term"),
                    F.col("wc").alias("n")))


def term_counts(docs: DataFrame, spec: VectorizerSpec, text_col: str = "text",
                key: str = "doc_id", num_partitions: int | None = None) -> DataFrame:
    """(doc_id, term, tf) for every distinct term of every document."""
    if not isinstance(docs.schema[key].dataType, T.StructType):
        return gr.gram_counts(docs, spec, text_col, key, num_partitions)
    rows = gram_rows(docs, spec, text_col, key, num_partitions)
    return rows.groupBy(key, "term").agg(F.sum("n").alias("tf"))


def fit_vocab(counts: DataFrame, n_docs: int, spec: VectorizerSpec) -> DataFrame:
    """vocab(term, idx, df, cf, idf) from a term-count table."""
    return cut_vocab(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")), n_docs, spec)


def vocab_of(docs: DataFrame, spec: VectorizerSpec, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """``fit_vocab`` straight from the documents: a task hands on a term's sums over
    some hundred documents, not a row for every document that holds it."""
    stats = gr.gram_stats(docs, spec, text_col=text_col, key=key).groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return cut_vocab(stats, docs.select(key).count(), spec)


def cut_vocab(stats: DataFrame, n_docs: int, spec: VectorizerSpec) -> DataFrame:
    """vocab(term, idx, df, cf, idf) from (term, df, cf)."""
    stats = stats.where(F.col("df") >= spec.min_df)
    if spec.max_features is not None:
        # TakeOrderedAndProject: per-partition top-n, then one merge of n rows.
        stats = stats.orderBy(F.desc("cf"), F.asc("term")).limit(spec.max_features)
        idx = F.row_number().over(Window.orderBy("term")) - 1
        vocab = stats.withColumn("idx", idx.cast("int"))
    else:
        vocab = dense_index(stats, ["term"])
        size = vocab.agg(F.max("idx")).first()[0] or 0
        if size >= (1 << 31) - 1:  # vectors are indexed by int
            raise ValueError(f"{size + 1} terms: cap the vocabulary")
        vocab = vocab.withColumn("idx", F.col("idx").cast("int"))
    idf = F.log(F.lit(float(1 + n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return vocab.select("term", "idx", F.col("df").cast("long").alias("df"),
                        F.col("cf").cast("long").alias("cf"), idf.alias("idf"))


def fit_transform(docs: DataFrame, spec: VectorizerSpec, text_col: str = "text", key: str = "doc_id",
                  fit_on: DataFrame | None = None, idx_offset: int = 0):
    """(vocab, long TF-IDF of every doc).  ``fit_on`` (keys only) restricts
    the vocabulary fit to a subset, e.g. the train split.

    Two passes over the texts and nothing corpus-sized is kept: the first
    reduces to one row per term, the second joins the vocabulary right after
    the explode, so only known terms are counted per document.
    """
    fit_docs = docs if fit_on is None else docs.join(fit_on.select(key), key, "left_semi")
    vocab = vocab_of(fit_docs, spec, text_col, key)
    if capped(spec):
        vocab = stored(vocab, "vocab")  # the transform reads it here and now
    return vocab, transform(docs, vocab, spec, text_col, key, idx_offset)


def bounded_broadcast(small: DataFrame, rows: int | None) -> DataFrame:
    """``small`` with a broadcast hint if its known row count allows it,
    else as it is (Catalyst then chooses by size)."""
    return F.broadcast(small) if rows is not None and rows <= BROADCAST_VOCAB_MAX else small


def _weigh(known: DataFrame, spec: VectorizerSpec, key: str, idx_offset: int) -> DataFrame:
    """(doc_id, idx, value) from (doc_id, idx, idf, tf), L2-normalised per document."""
    tf = F.col("tf").cast("double")
    w = (F.lit(1.0) + F.log(tf)) if spec.sublinear_tf else tf
    raw = known.select(key, "idx", (w * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, (F.col("idx") + F.lit(idx_offset)).alias("idx"),
                      (F.col("raw") / norm).alias("value"))


def tfidf_long(counts: DataFrame, vocab: DataFrame, spec: VectorizerSpec,
               key: str = "doc_id", idx_offset: int = 0) -> DataFrame:
    """Long-form TF-IDF of a term-count table: (doc_id, idx, value), each
    document L2-normalised.

    Documents without a known term have no rows (an all-zero row).
    """
    v = bounded_broadcast(vocab.select("term", "idx", "idf"), spec.max_features)
    return _weigh(counts.join(v, "term"), spec, key, idx_offset)


def transform(docs: DataFrame, vocab: DataFrame, spec: VectorizerSpec, text_col: str = "text",
              key: str = "doc_id", idx_offset: int = 0) -> DataFrame:
    """``tfidf_long`` straight from the documents.

    A capped vocabulary goes to the tasks, which look its terms up while they
    count; an uncapped one may be too large for that, so there the counts go into
    a join.
    """
    if not capped(spec):
        return tfidf_long(term_counts(docs, spec, text_col, key), vocab, spec, key, idx_offset)
    return gr.tfidf_entries(docs, vocab_arrays(vocab, spec), text_col, key, idx_offset)


def capped(*specs: VectorizerSpec) -> bool:
    """Whether the vocabularies have a bound that lets them go to every task."""
    return all(s.max_features is not None for s in specs) and sum(s.max_features for s in specs) <= BROADCAST_VOCAB_MAX


def vocab_arrays(vocab: DataFrame, spec: VectorizerSpec) -> gr.Vocabulary:
    """A capped vocabulary (term, idx, idf) as arrays."""
    return gr.vocabulary(spec, vocab.select("term", "idx", "idf").toArrow())


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """The struct that MLlib's sparse vectors are stored as."""
    return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
                    indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))


def as_vectors(df: DataFrame, name: str = "vectors", column: str = "features") -> DataFrame:
    """``df`` stored with its ``sparse_vector`` column read back as vectors.

    Rows never leave the JVM: Parquet keeps a vector as exactly that struct, so
    the reader only has to be told the type.
    """
    from pyspark.ml.linalg import VectorUDT

    fields = [T.StructField(f.name, VectorUDT() if f.name == column else f.dataType, True) for f in df.schema]
    return stored(df, name, T.StructType(fields))


def to_vectors(long_df: DataFrame, size: int, key: str = "doc_id", docs: DataFrame | None = None) -> DataFrame:
    """Sparse vector per document from the long form.

    With ``docs`` given, documents without any known term get an empty
    vector (left join), as the reference's transform keeps an all-zero row.
    """
    grouped = (long_df.groupBy(key)
               .agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("entries")))
    if docs is not None:
        grouped = docs.join(grouped, key, "left")
    e = F.coalesce("entries", F.array().cast("array<struct<idx:int,value:double>>"))
    vec = sparse_vector(size, F.transform(e, lambda x: x["idx"]), F.transform(e, lambda x: x["value"]))
    return as_vectors(grouped.withColumn("features", vec).drop("entries"))
