"""Registered queries for corpus, text functions and TF-IDF features.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL lives in ``ORACLE`` under the same key.  Doubles are rounded to
6 places in both so value hashes are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions.tokens import word_tokens
from tessera.operators import features as fe
from tessera.plans import sqlbits as S
from tessera.plans.fixtures import edge_frame, edge_values_sql
from tessera.plans.scorers import DATA_TERMS
from tessera.sources.corpus import all_docs, labelled_docs, read_table

R = 6  # rounding places for hashed doubles


def _docs_plus_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_docs(spark, sf_dir).unionByName(edge_frame(spark))


DOCS_PLUS_EDGES_SQL = f"(SELECT doc_id, coalesce(text, '') AS text FROM documents UNION ALL SELECT doc_id, text FROM {edge_values_sql()})"
NORM_DOCS_SQL = "(SELECT doc_id, " + S.normalize("coalesce(text, '')") + " AS text FROM documents)"


def _norm_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_docs(spark, sf_dir).select("doc_id", tx.normalize_text("text").alias("text"))


# ---------------------------------------------------------------- corpus ---
def q_labelled_docs(spark, sf_dir):
    return labelled_docs(spark, sf_dir)


LABELLED_SQL = (f"SELECT d.doc_id, coalesce(CAST(d.text AS VARCHAR), '') AS text, "
                f"CAST(l.toxic AS INTEGER) AS label, {S.split_of('d.doc_id')} AS split "
                f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


# ------------------------------------------------------------ text funcs ---
def q_normalize_text(spark, sf_dir):
    return _docs_plus_edges(spark, sf_dir).select("doc_id", tx.normalize_text("text").alias("text_norm"))


def q_sanitize_text(spark, sf_dir):
    terms = tx.REFERENCE_MASK_TERMS + DATA_TERMS
    return _docs_plus_edges(spark, sf_dir).select(
        "doc_id", tx.sanitize_text("text", terms).alias("sanitized_text"))


def q_preprocess_mentions_links(spark, sf_dir):
    return _docs_plus_edges(spark, sf_dir).select(
        "doc_id", tx.preprocess_mentions_links("text").alias("text_pre"))


HUB_MODEL = "cardiffnlp/twitter-roberta-base-dec2021-hate"
LOCAL_MODEL = "outputs/transformer_ft_dec2021/checkpoint-2252"


def q_preprocess_auto(spark, sf_dir):
    d = _docs_plus_edges(spark, sf_dir)
    return d.select(
        "doc_id",
        tx.preprocess_auto("text", HUB_MODEL, "auto").alias("auto_hub"),
        tx.preprocess_auto("text", LOCAL_MODEL, "auto").alias("auto_local"),
        tx.preprocess_auto("text", HUB_MODEL, "none").alias("style_none"),
        tx.preprocess_auto("text", LOCAL_MODEL, "cardiff").alias("style_cardiff"),
    )


def _checkpoint_name_col():
    # A per-document model path derived from the documents table.
    return F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("-twitter-roberta-base-hate/checkpoint-"),
                    F.col("doc_id").cast("string"))


def q_model_slug(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", _checkpoint_name_col().alias("model_name"))
    return d.select("doc_id", "model_name", tx.model_slug("model_name").alias("slug"),
                    tx.is_cardiff_model_col("model_name").alias("is_cardiff"))


def q_word_tokens(spark, sf_dir):
    d = _norm_docs(spark, sf_dir)
    return d.select("doc_id", F.posexplode(word_tokens("text")).alias("pos", "token")) \
        .select("doc_id", F.col("pos").cast("long").alias("pos"), "token")


def q_word_ngrams(spark, sf_dir):
    d = _norm_docs(spark, sf_dir)
    return fe.term_counts(d, fe.WORD_1_2).withColumnRenamed("term", "ngram")


def q_char_ngrams(spark, sf_dir):
    d = _norm_docs(spark, sf_dir)
    return fe.term_counts(d, fe.CHAR_3_5).withColumnRenamed("term", "ngram")


def _vocab_query(spark, sf_dir, spec):
    d = _norm_docs(spark, sf_dir)
    v = fe.vocab_of(d, spec)
    return v.select("term", "idx", "df", "cf", F.round("idf", R).alias("idf"))


def q_vocab_word(spark, sf_dir):
    return _vocab_query(spark, sf_dir, fe.WORD_1_2)


def q_vocab_char(spark, sf_dir):
    return _vocab_query(spark, sf_dir, fe.CHAR_3_5)


def _tfidf_query(spark, sf_dir, spec):
    _, long = fe.fit_transform(_norm_docs(spark, sf_dir), spec)
    return long.select("doc_id", "idx", F.round("value", R).alias("value"))


def q_tfidf_word(spark, sf_dir):
    return _tfidf_query(spark, sf_dir, fe.WORD_1_2)


def q_tfidf_char(spark, sf_dir):
    return _tfidf_query(spark, sf_dir, fe.CHAR_3_5)


COMBINED_WORD = fe.VectorizerSpec("word", 1, 2, 3, 5000)
COMBINED_CHAR = fe.VectorizerSpec("char", 3, 5, 3, 3000)


def q_combined_features(spark, sf_dir):
    d = _norm_docs(spark, sf_dir)
    wv, wl = fe.fit_transform(d, COMBINED_WORD)
    word_size = wv.count()
    _, cl = fe.fit_transform(d, COMBINED_CHAR, idx_offset=word_size)
    return wl.unionByName(cl).select("doc_id", "idx", F.round("value", R).alias("value"))


# ------------------------------------------------------------- oracle SQL ---
def _counts_sql(rows_sql: str) -> str:
    return f"SELECT doc_id, term, count(*) AS tf FROM ({rows_sql}) GROUP BY doc_id, term"


def _vocab_sql(p: str, n_sql: str, min_df: int, max_features: int, fit: str = "true") -> str:
    return f"""
    {p}stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {p}counts WHERE {fit}
              GROUP BY term HAVING count(*) >= {min_df}),
    {p}top AS (SELECT * FROM {p}stats ORDER BY cf DESC, term ASC LIMIT {max_features}),
    {p}vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf,
                     ln((1 + ({n_sql}))::DOUBLE / (1 + df)) + 1 AS idf FROM {p}top)"""


def _rows_sql(spec) -> str:
    if spec.kind == "word":
        return S.word_ngram_rows("nd", "text", spec.ngram_lo, spec.ngram_hi)
    return S.char_ngram_rows("nd", "text", spec.ngram_lo, spec.ngram_hi)


def tfidf_sql_ctes(spec, p: str = "", fit_on: str = "nd") -> str:
    """CTEs {p}counts, {p}vocab, {p}tfidf over the CTE ``nd`` (doc_id, text);
    the vocabulary is fitted on the documents of the relation ``fit_on``."""
    fit = "true" if fit_on == "nd" else f"doc_id IN (SELECT doc_id FROM {fit_on})"
    return f"""
    {p}counts AS ({_counts_sql(_rows_sql(spec))}),
    {_vocab_sql(p, f'SELECT count(*) FROM {fit_on}', spec.min_df, spec.max_features, fit)},
    {p}raw AS (SELECT c.doc_id, v.idx, (1 + ln(c.tf)) * v.idf AS raw FROM {p}counts c JOIN {p}vocab v ON c.term = v.term),
    {p}tfidf AS (SELECT doc_id, idx, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS value FROM {p}raw)"""


ND = f"nd AS {NORM_DOCS_SQL}"

ORACLE = {
    "labelled_docs": LABELLED_SQL,
    "normalize_text": f"SELECT doc_id, {S.normalize('text')} AS text_norm FROM {DOCS_PLUS_EDGES_SQL}",
    "sanitize_text": "SELECT doc_id, " + S.sanitize("text", tx.REFERENCE_MASK_TERMS + DATA_TERMS)
                     + f" AS sanitized_text FROM {DOCS_PLUS_EDGES_SQL}",
    "preprocess_mentions_links": f"SELECT doc_id, {S.mentions_links('text')} AS text_pre FROM {DOCS_PLUS_EDGES_SQL}",
    "preprocess_auto": (f"SELECT doc_id, {S.mentions_links('text')} AS auto_hub, text AS auto_local, "
                        f"text AS style_none, {S.mentions_links('text')} AS style_cardiff FROM {DOCS_PLUS_EDGES_SQL}"),
    "model_slug": ("SELECT doc_id, model_name, translate(model_name, '/-', '__') AS slug, "
                   + S.is_cardiff("model_name") + " AS is_cardiff FROM (SELECT doc_id, source || '/' || lang || "
                   "'-twitter-roberta-base-hate/checkpoint-' || CAST(doc_id AS VARCHAR) AS model_name FROM documents)"),
    "word_tokens": (f"WITH {ND}, t AS (SELECT doc_id, {S.tokens('text')} AS tok FROM nd) "
                    "SELECT doc_id, unnest(range(0, len(tok))) AS pos, unnest(tok) AS token FROM t"),
    "word_ngrams": f"WITH {ND}, g AS ({_counts_sql(S.word_ngram_rows('nd', 'text', 1, 2))}) "
                   "SELECT doc_id, term AS ngram, tf FROM g",
    "char_ngrams": f"WITH {ND}, g AS ({_counts_sql(S.char_ngram_rows('nd', 'text', 3, 5))}) "
                   "SELECT doc_id, term AS ngram, tf FROM g",
    "vocab_word": f"WITH {ND}, {tfidf_sql_ctes(fe.WORD_1_2)} SELECT term, idx, df, cf, round(idf, {R}) AS idf FROM vocab",
    "vocab_char": f"WITH {ND}, {tfidf_sql_ctes(fe.CHAR_3_5)} SELECT term, idx, df, cf, round(idf, {R}) AS idf FROM vocab",
    "tfidf_word": f"WITH {ND}, {tfidf_sql_ctes(fe.WORD_1_2)} SELECT doc_id, idx, round(value, {R}) AS value FROM tfidf",
    "tfidf_char": f"WITH {ND}, {tfidf_sql_ctes(fe.CHAR_3_5)} SELECT doc_id, idx, round(value, {R}) AS value FROM tfidf",
    "combined_features": (f"WITH {ND}, {tfidf_sql_ctes(COMBINED_WORD, 'w_')}, {tfidf_sql_ctes(COMBINED_CHAR, 'c_')} "
                          f"SELECT doc_id, idx, round(value, {R}) AS value FROM w_tfidf UNION ALL "
                          f"SELECT doc_id, CAST(idx + (SELECT count(*) FROM w_vocab) AS INTEGER) AS idx, round(value, {R}) AS value FROM c_tfidf"),
}

QUERIES = {
    "labelled_docs": q_labelled_docs,
    "normalize_text": q_normalize_text,
    "sanitize_text": q_sanitize_text,
    "preprocess_mentions_links": q_preprocess_mentions_links,
    "preprocess_auto": q_preprocess_auto,
    "model_slug": q_model_slug,
    "word_tokens": q_word_tokens,
    "word_ngrams": q_word_ngrams,
    "char_ngrams": q_char_ngrams,
    "vocab_word": q_vocab_word,
    "vocab_char": q_vocab_char,
    "tfidf_word": q_tfidf_word,
    "tfidf_char": q_tfidf_char,
    "combined_features": q_combined_features,
}
