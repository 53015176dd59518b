"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the
source's target over its size.  Along the source's documents, ordered by size
and id, the expected copies are summed, one offset that depends on the seed
and the source is added, and a document is emitted once for each integer that
its step of the sum crosses.  Ordering by size spreads the drawn documents
over short and long ones, so the words taken stay near the target.

Defined cases: a null text counts 0 words; a null source is a source of its
own, last in order; a source without words has target 0 and its documents are
not taken; repeated rows are documents of their own (ties in size and id are
interchangeable); an empty table gives an empty result; only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_name, n_words, rank_within

WEIGHTS = (3, 1, 2)
NULL_KEY = "~"


def _key(source: Column) -> Column:
    """Non-null text that sorts as the source does, null last."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(NULL_KEY))


def source_targets(sized: DataFrame, weights=WEIGHTS, share_num: int = 3, share_den: int = 2,
                   max_repeat: int = 2) -> DataFrame:
    """(source_key, source_size, target): targets in words for each source.

    The sources share ``share_num/share_den`` of all words by weight; a source
    stops at ``max_repeat`` times its size and the rest is shared again among
    the others.  Sorted by limit over weight, the limited sources come first,
    which gives the fixed point of that resharing in one pass over one row for
    each source.
    """
    per = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("source_key")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]),
                        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", pick.cast("long")).withColumn("cap", F.col("source_size") * max_repeat)
    whole = Window.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(whole)).withColumn("all_w", F.sum("w").over(whole))
    earlier = Window.orderBy(F.col("cap") / F.col("w"), "source_key").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("cap_before", F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
           .withColumn("w_before", F.coalesce(F.sum("w").over(earlier), F.lit(0))))
    budget = F.col("total") * share_num  # in 1 / share_den words
    limited = (F.col("cap") * share_den * (F.col("all_w") - F.col("w_before"))
               <= F.col("w") * (budget - F.col("cap_before") * share_den))
    per = per.withColumn("limited", limited)
    cap_l = F.coalesce(F.sum(F.when(F.col("limited"), F.col("cap"))).over(whole), F.lit(0))
    w_l = F.coalesce(F.sum(F.when(F.col("limited"), F.col("w"))).over(whole), F.lit(0))
    per = per.withColumn("cap_l", cap_l).withColumn("w_l", w_l)
    level = (F.col("w") * (budget - F.col("cap_l") * share_den)).cast("double") / (
        share_den * (F.col("all_w") - F.col("w_l"))).cast("double")
    return per.select("source_key", "source_size",
                      F.when(F.col("limited"), F.col("cap").cast("double")).otherwise(level).alias("target"))


def offset(source_key: Column, seed: str) -> Column:
    """The source's random offset: an odd 2048th in (0, 1)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), source_key).cast("binary")), 1, 8), 16, 10)
    return (F.pmod(h.cast("long"), F.lit(1024)).cast("double") * 2 + 1) / 2048


def systematic_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   seed: str = "mix", carry: dict[str, Column] | None = None, **shares) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, carry...) for every
    document; ``carry``: further narrow columns to compute from ``docs``."""
    extra = {k: v for k, v in (carry or {}).items()}
    sized = docs.select(*[v.alias(k) for k, v in extra.items()], F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        _key(F.col(source_col)).alias("source_key"), n_words(F.col(text_col)).alias("size"))
    ranked = rank_within(sized, "source_key", ["size", "doc_id"], "rank")
    targets = source_targets(ranked, **shares)
    mixed = ranked.join(F.broadcast(targets), "source_key")
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = offset(F.col("source_key"), seed)
    crossed = F.floor(F.col("rank") * f + u) - F.floor((F.col("rank") - 1) * f + u)
    return mixed.select("doc_id", "source", "size", "source_size", "target", crossed.cast("long").alias("copies"), *extra)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **mix) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as
    it is taken.  Rows equal in id and text are taken alike, as often as the
    most taken of them."""
    h = F.xxhash64(F.col(id_col), F.col(text_col))
    key, same, copies, copy = (free_name(docs, c) for c in ("_mix_key", "_mix_h", "_copies", "_copy"))
    taken = (systematic_mix(docs, id_col, text_col, carry={"_h": h}, **mix).groupBy("_h")
             .agg(F.max("copies").alias(copies)).where(F.col(copies) > 0).select(F.col("_h").alias(same), copies))
    # Only rows with a count come through; each is repeated in place, so no text is shuffled twice.
    joined = docs.withColumn(key, h).join(taken, F.col(key) == F.col(same))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])


#: The same mix in DuckDB SQL over a relation ``{docs}`` with doc_id, text, source.
MIX_SQL = r"""
sized AS (
  SELECT doc_id, source, coalesce('=' || source, '~') AS source_key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM {docs}),
per AS (
  SELECT source_key, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source_key) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source_key),
tot AS (SELECT sum(source_size)::BIGINT AS total, sum(w)::BIGINT AS all_w FROM per),
bef AS (
  SELECT *, 2 * source_size AS cap,
         coalesce(sum(2 * source_size) OVER e, 0)::BIGINT AS cap_before, coalesce(sum(w) OVER e, 0)::BIGINT AS w_before
  FROM per, tot
  WINDOW e AS (ORDER BY (2 * source_size)::DOUBLE / w, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lim AS (SELECT *, cap * 2 * (all_w - w_before) <= w * (total * 3 - cap_before * 2) AS limited FROM bef),
fixed AS (SELECT coalesce(sum(cap) FILTER (limited), 0)::BIGINT AS cap_l,
                 coalesce(sum(w) FILTER (limited), 0)::BIGINT AS w_l FROM lim),
targets AS (
  SELECT source_key, source_size,
         CASE WHEN limited THEN cap::DOUBLE
              ELSE (w * (total * 3 - cap_l * 2))::DOUBLE / (2 * (all_w - w_l))::DOUBLE END AS target
  FROM lim, fixed),
ranked AS (
  SELECT s.*, t.source_size, t.target,
         row_number() OVER (PARTITION BY s.source_key ORDER BY s.size, s.doc_id NULLS FIRST) AS rank,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS f,
         ((('0x' || substr(md5('mix|' || s.source_key), 1, 8))::BIGINT % 1024)::DOUBLE * 2 + 1) / 2048 AS u
  FROM sized s JOIN targets t USING (source_key)),
mixed AS (
  SELECT doc_id, source, size, source_size, target,
         (floor(rank * f + u) - floor((rank - 1) * f + u))::BIGINT AS copies
  FROM ranked)
"""
