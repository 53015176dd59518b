"""Many vocabularies from one pass over the texts: every vectorizer setting of a
sweep, and every leave-one-fold-out refit of a cross-validation.

The texts are tokenized once with the widest n-gram range.  One shuffle on the
term turns them into one row per term: document frequency, corpus count and
positive documents, each as an array with a slot for every fold.  A refit without
fold ``f`` is the total minus slot ``f``; a setting is a cut of those rows.  Slot
-1 stands for all documents, slot ``f`` for all but fold ``f``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import features as fe
from tessera.operators import grams as gr
from tessera.operators.ranks import dense_index, group_top


def variant_name(spec: fe.VectorizerSpec) -> str:
    return f"{spec.kind}_{spec.ngram_lo}_{spec.ngram_hi}_min{spec.min_df}_{spec.max_features or 'all'}"


def widest(specs: Sequence[fe.VectorizerSpec]) -> list[tuple[fe.VectorizerSpec, list[int]]]:
    """(spec that covers them, their places) for each kind and lowest n among
    ``specs``: n-grams of a narrower range are those of the wider one up to a size."""
    groups: dict[tuple[str, int], list[int]] = {}
    for i, s in enumerate(specs):
        groups.setdefault((s.kind, s.ngram_lo), []).append(i)
    return [(fe.VectorizerSpec(kind, lo, max(specs[i].ngram_hi for i in at), 1, None), at)
            for (kind, lo), at in groups.items()]


def family(spec: fe.VectorizerSpec) -> str:
    """What n-grams of specs that share a pass are filed under."""
    return f"{spec.kind}{spec.ngram_lo}"


def gram_size(term: str, kind: str) -> Column:
    """n of an n-gram: its words, or its characters."""
    t = F.col(term)
    if kind == "char":
        return F.char_length(t)
    return F.char_length(t) - F.char_length(F.replace(t, F.lit(" "), F.lit(""))) + 1


def doc_terms(docs: DataFrame, spec: fe.VectorizerSpec, carry: Sequence[str] = ()) -> DataFrame:
    """(row, term, tf): term counts per document; ``row`` is a struct of doc_id
    and the ``carry`` columns, so they need no join afterwards."""
    rows = docs.select(F.struct("doc_id", *carry).alias("row"), "text")
    return fe.term_counts(rows, spec, key="row")


def fold_stats(docs: DataFrame, spec: fe.VectorizerSpec, folds: int = 0) -> DataFrame:
    """(term, df, cf, pos): arrays with one entry per fold (one entry in all if
    ``folds`` is 0) from ``docs`` (doc_id, text, fold, label)."""
    slots = max(folds, 1)
    parts = gr.gram_stats(docs, spec, ["fold"] if folds else [], "label")
    fold = F.col("fold") if folds else F.lit(0)
    aggs = [F.coalesce(F.sum(F.when(fold == f, F.col(name))), F.lit(0)).alias(f"{name}{f}")
            for name in ("df", "cf", "pos") for f in range(slots)]
    flat = parts.groupBy("term").agg(*aggs)
    return flat.select("term", *[F.array(*[F.col(f"{n}{f}") for f in range(slots)]).alias(n) for n in ("df", "cf", "pos")])


def slot_stats(stats: DataFrame, slots: Sequence[int]) -> DataFrame:
    """(slot, term, df, cf, pos): the total less the slot's own fold."""
    def less(name: str, slot: int) -> Column:
        total = F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x)
        return (total if slot < 0 else total - F.col(name)[slot]).alias(name)

    cells = [F.struct(F.lit(s).alias("slot"), *[less(n, s) for n in ("df", "cf", "pos")]) for s in slots]
    return (stats.select("term", F.explode(F.array(*cells)).alias("c"))
            .select("c.slot", "term", "c.df", "c.cf", "c.pos").where(F.col("df") > 0))


def cut(stats: DataFrame, kind: str, variants: Sequence[tuple[int, fe.VectorizerSpec]], n_docs: dict[int, int]) -> DataFrame:
    """(variant, slot, term, idx, df, cf, pos, idf): the vocabulary of every
    variant and slot, equal to ``fit_vocab`` on its own documents."""
    settings = F.array(*[F.struct(F.lit(i).alias("variant"), F.lit(s.min_df).alias("min_df"), F.lit(s.ngram_hi).alias("hi"),
                                  F.lit(s.max_features).cast("int").alias("cap")) for i, s in variants])
    rows = (stats.withColumns({"size": gram_size("term", kind), "v": F.explode(settings)})
            .where((F.col("df") >= F.col("v.min_df")) & (F.col("size") <= F.col("v.hi")))
            .select("v.variant", "v.cap", "slot", "term", "df", "cf", "pos"))
    group = ["variant", "slot"]
    caps = [s.max_features for _, s in variants if s.max_features is not None]
    out = None
    if caps:
        top = group_top(rows.where(F.col("cap").isNotNull()), group, [F.desc("cf"), F.asc("term")], max(caps))
        top = top.where(F.col("_rn") <= F.col("cap"))
        # at most ``max_features`` rows of a group are left
        out = top.withColumn("idx", F.row_number().over(Window.partitionBy(*group).orderBy("term")) - 1).drop("_rn")
    if len(caps) < len(variants):
        free = dense_index(rows.where(F.col("cap").isNull()), ["term"], group).select(*rows.columns, "idx")
        out = free if out is None else out.select(*free.columns).unionByName(free)
    n = F.element_at(F.create_map(*[x for s, c in n_docs.items() for x in (F.lit(s), F.lit(float(1 + c)))]), F.col("slot"))
    idf = F.log(n / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return out.select(*group, "term", F.col("idx").cast("int").alias("idx"), "df", "cf", "pos", idf.alias("idf"))


def slot_sizes(docs: DataFrame, slots: Sequence[int], fold: str | None = None) -> tuple[dict[int, int], dict[int, int]]:
    """Documents and positive documents of each slot."""
    by = docs.groupBy(F.col(fold) if fold else F.lit("all").alias("fold")).agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).collect()
    n, p = sum(r[1] for r in by), sum(r[2] for r in by)
    own = {r[0]: (r[1], r[2]) for r in by if fold}
    return ({s: n - own.get(s, (0, 0))[0] for s in slots}, {s: p - own.get(s, (0, 0))[1] for s in slots})


def fit_vocabs(docs: DataFrame, specs: Sequence[fe.VectorizerSpec], folds: int = 0, refit: bool = False) -> DataFrame:
    """(variant, slot, term, idx, df, cf, pos, idf) for all ``specs`` (``variant``
    is the place in the list) from one pass for each kind over ``docs`` (doc_id,
    text, label, with ``folds`` also fold).  Slots: -1, and with ``refit`` each fold.
    """
    slots = [-1, *(range(folds) if refit else ())]
    n_docs, _ = slot_sizes(docs, slots, "fold" if folds else None)
    out = None
    for wide, at in widest(specs):
        stats = slot_stats(fold_stats(docs, wide, folds if refit else 0), slots)
        part = cut(stats, wide.kind, [(i, specs[i]) for i in at], n_docs)
        out = part if out is None else out.unionByName(part)
    return out


def log_odds(docs: DataFrame, vocabs: DataFrame, specs: Sequence[fe.VectorizerSpec], folds: int) -> DataFrame:
    """(variant, slot, term, weight): smoothed log-odds of a term's presence in the
    positive against the negative documents of every slot, for the vocabulary of
    its own slot or, where only slot -1 was fitted, for that one."""
    slots = [-1, *range(folds)]
    n_docs, n_pos = slot_sizes(docs, slots, "fold")
    number = lambda d: F.element_at(F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("slot"))
    fitted = [r[0] for r in vocabs.select("slot").distinct().collect()]
    out = None
    for wide, at in widest(specs):
        own = vocabs.where(F.col("variant").isin(at))
        stats = slot_stats(fold_stats(docs, wide, folds), slots).select("slot", "term", F.col("df").alias("n"), F.col("pos").alias("p"))
        if fitted == [-1]:
            own = own.select("variant", "term", F.explode(F.array(*[F.lit(s) for s in slots])).alias("slot"))
        j = own.select("variant", "slot", "term").join(stats, ["slot", "term"], "left").fillna(0, ["n", "p"])
        neg = number({s: n_docs[s] - n_pos[s] + 2 for s in slots})
        pos = number({s: n_pos[s] + 2 for s in slots})
        w = F.log(((F.col("p") + 1.0) * neg) / ((F.col("n") - F.col("p") + 1.0) * pos))
        part = j.select("variant", "slot", "term", w.alias("weight"))
        out = part if out is None else out.unionByName(part)
    return out


def tfidf_many(docs: DataFrame, vocabs: DataFrame, specs: Sequence[fe.VectorizerSpec], refit: bool = False) -> DataFrame:
    """(doc_id, variant, slot, idx, value): TF-IDF of ``docs`` (doc_id, text; fold
    with ``refit``) under every vocabulary, L2-normalised under each.  With
    ``refit`` a document enters every slot but its own fold's.  The texts are read
    once for each kind; norms are taken on the partitioning of the counts.
    """
    out = None
    for wide, at in widest(specs):
        counts = doc_terms(docs, wide, ["fold"] if refit else [])
        own = vocabs.where(F.col("variant").isin(at)).select("variant", "slot", "term", "idx", "idf")
        if not refit:
            own = own.where("slot = -1")
        # an uncapped vocabulary joins by its true size
        known = counts.join(F.broadcast(own) if all(specs[i].max_features for i in at) and not refit else own, "term")
        if refit:
            known = known.where(F.col("row.fold") != F.col("slot"))
        tf = [F.when(F.col("variant") == i, (1.0 + F.log(F.col("tf").cast("double"))) if specs[i].sublinear_tf
                     else F.col("tf").cast("double")) for i in at]
        raw = known.select("row", "variant", "slot", "idx", (F.coalesce(*tf) * F.col("idf")).alias("raw"))
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("row", "variant", "slot")))
        part = raw.select("row.doc_id", "variant", "slot", "idx", (F.col("raw") / norm).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out
