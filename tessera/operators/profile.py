"""Corpus profiling: split sizes, label counts, text-length statistics and
the five-number summary behind a box plot.

Lengths are code points.  Every length statistic comes from one histogram of
(split, length) with cumulative counts: the corpus is scanned once, and a split
that holds most rows is reduced in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import text_length


def split_counts(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def label_counts(corpus: DataFrame) -> DataFrame:
    """Label counts per split (the reference reports the train split)."""
    return corpus.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def length_histogram(corpus: DataFrame, text_col: str = "text", also: tuple = ()) -> DataFrame:
    """(split, also..., len, n, cum, total): how many texts of a split have each
    length, how many are no longer than that, and how many there are.

    The texts are read once and reduced to one row for each length before the
    shuffle; the window runs over those rows, of which a split has at most as
    many as its longest text has characters.
    """
    hist = (corpus.select("split", *also, text_length(text_col).alias("len"))
            .groupBy("split", *also, "len").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("split")
    return hist.withColumns({"cum": F.sum("n").over(w.orderBy("len")),  # range frame: equal lengths count together
                             "total": F.sum("n").over(w)})


def _at_rank(rank: Column) -> Column:
    """The length at a 0-based rank, as an aggregate over histogram rows."""
    return F.min(F.when(F.col("cum") > rank, F.col("len")))


def _quantile(q: float, over=lambda c: c) -> Column:
    """Exact quantile, linear between neighbours (like NumPy), from histogram rows."""
    h = F.lit(q) * (F.col("total") - 1)
    low, high = over(_at_rank(F.floor(h))), over(_at_rank(F.ceil(h)))
    frac = over(F.max(h - F.floor(h)))
    return low + frac * (high - low)


def text_length_stats(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    return length_histogram(corpus, text_col).groupBy("split").agg(
        (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("avg_len"),
        _quantile(0.5).alias("median_len"),
        F.max("len").alias("max_len"),
    )


def length_boxplot(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """Per split: q1, median, q3, whiskers (furthest lengths within 1.5 IQR)."""
    whole = Window.partitionBy("split")
    rows = length_histogram(corpus, text_col).withColumns(
        {name: _quantile(q, lambda c: c.over(whole)) for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))})
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    return (rows.groupBy("split", "q1", "median", "q3")
            .agg(F.min(F.when(F.col("len") >= F.col("q1") - reach, F.col("len"))).alias("whisker_lo"),
                 F.max(F.when(F.col("len") <= F.col("q3") + reach, F.col("len"))).alias("whisker_hi"),
                 F.min("len").alias("min_len"), F.max("len").alias("max_len"), F.sum("n").alias("n")))


def corpus_profile(corpus: DataFrame, source: str, text_col: str = "text",
                   label_values=(0, 1)) -> DataFrame:
    """One row: source tag, rows per split, train label counts, train length
    mean / median / max -- conditional aggregates over one length histogram."""
    is_train = F.col("split") == "train"

    def rows(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    def train(c: Column) -> Column:
        return F.when(is_train, c)

    h = F.lit(0.5) * (F.col("total") - 1)
    low, high = (F.min(train(F.when(F.col("cum") > r, F.col("len")))) for r in (F.floor(h), F.ceil(h)))
    aggs = [rows(F.col("split") == s).alias(f"n_{s}") for s in ("train", "validation", "test")]
    aggs += [rows(is_train & (F.col("label") == v)).alias(f"train_label_{v}") for v in label_values]
    aggs += [
        (F.sum(train(F.col("len") * F.col("n"))) / F.sum(train(F.col("n")))).alias("avg_text_len_chars_train"),
        (low + F.max(train(h - F.floor(h))) * (high - low)).alias("median_text_len_chars_train"),
        F.max(train(F.col("len"))).alias("max_text_len_chars_train"),
    ]
    return length_histogram(corpus, text_col, ("label",)).agg(*aggs).select(F.lit(source).alias("source"), "*")


def profile_struct(profile: DataFrame) -> DataFrame:
    """Nested form of ``corpus_profile`` for the JSON sink (maps of counts)."""
    label_cols = [c for c in profile.columns if c.startswith("train_label_")]
    return profile.select(
        "source",
        F.create_map(*[x for s in ("train", "validation", "test") for x in (F.lit(s), F.col(f"n_{s}"))]).alias("splits"),
        F.create_map(*[x for c in label_cols for x in (F.lit(c.rsplit("_", 1)[1]), F.col(c))]).alias("label_counts_train"),
        "avg_text_len_chars_train", "median_text_len_chars_train", "max_text_len_chars_train",
    )
