"""Scores of many linear models in one pass over the texts.

A weight cube holds, for every term, what each model needs of it: the idf of each
vocabulary (``variant``) and the weight of each model block, for every slot (-1:
fitted on all training rows; f: fitted without fold f).  A document meets the
cube once; one grouped sum per document and slot gives the norm under each
vocabulary and the dot product with each block, hence every model's decision
value.  A document is scored in the slots its ``slots`` array names: -1, and its
own fold for cross-validation, so no model and no fold reads the texts again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import sigmoid
from tessera.operators import features as fe
from tessera.operators import grams as gr
from tessera.operators.vocab import doc_terms, family, widest
from tessera.session import stored

#: A cube estimated at up to this many bytes goes to the tasks as arrays; the join
#: of a larger one is left to Catalyst/AQE.
BROADCAST_CUBE_BYTES = 256 << 20


def weight_cube(vocabs: DataFrame, weights: DataFrame, specs: Sequence[fe.VectorizerSpec], blocks: Sequence[tuple[str, int]],
                slots: Sequence[int]) -> DataFrame:
    """(family, term, cells): ``cells[i]`` is slot ``slots[i]`` as a struct of
    ``idf`` by variant and ``w`` by block, null where it has none.

    ``vocabs`` is (variant, slot, term, idf); ``weights`` is (block, slot, term,
    weight) with ``blocks[block]`` = (model, variant).  A slot without own
    vocabularies takes those of slot -1.
    """
    fitted = {r[0] for r in vocabs.select("slot").distinct().collect()}
    families = F.create_map(*[x for i, s in enumerate(specs) for x in (F.lit(i), F.lit(family(s)))])
    variant_of = F.create_map(*[x for b, (_, v) in enumerate(blocks) for x in (F.lit(b), F.lit(v))])
    none, nowhere = F.lit(None).cast("double"), F.lit(None).cast("int")
    rows = vocabs.select(families[F.col("variant")].alias("family"), "term", "slot", "variant", "idf", nowhere.alias("block"),
                         none.alias("weight"))
    rows = rows.unionByName(weights.select(families[variant_of[F.col("block")]].alias("family"), "term", "slot",
                                           nowhere.alias("variant"), none.alias("idf"), "block", "weight"))
    aggs = []
    for s in slots:
        home = s if s in fitted else -1
        aggs += [F.max(F.when((F.col("slot") == home) & (F.col("variant") == v), F.col("idf"))).alias(f"i_{s}_{v}")
                 for v in range(len(specs))]
        aggs += [F.max(F.when((F.col("slot") == s) & (F.col("block") == b), F.col("weight"))).alias(f"w_{s}_{b}")
                 for b in range(len(blocks))]
    wide = rows.groupBy("family", "term").agg(*aggs)
    cells = [F.struct(F.array(*[F.col(f"i_{s}_{v}") for v in range(len(specs))]).alias("idf"),
                      F.array(*[F.col(f"w_{s}_{b}") for b in range(len(blocks))]).alias("w")) for s in slots]
    return wide.select("family", "term", F.array(*cells).alias("cells"))


def cube_scores(docs: DataFrame, cube: DataFrame, specs: Sequence[fe.VectorizerSpec], blocks: Sequence[tuple[str, int]],
                slots: Sequence[int], intercepts: dict[tuple[str, int], float],
                keep: Sequence[str] = ("split", "label")) -> DataFrame:
    """(experiment, slot, doc_id, keep..., score, prob, prediction) of every model
    for ``docs`` (doc_id, text, slots, keep...) in the slots each document names."""
    cube = stored(cube, "cube")
    width = 64 + len(slots) * (16 + 8 * (len(specs) + len(blocks)))
    if cube.count() * width <= BROADCAST_CUBE_BYTES:
        sums = _sums_in_tasks(docs, cube, specs, blocks, slots)
    else:
        sums = _sums_by_join(docs, cube, specs, blocks, slots)
    base = docs.select("doc_id", *keep, F.explode("slots").alias("slot"))
    j = base.join(sums, ["doc_id", "slot"], "left")
    models = []
    for name in dict.fromkeys(m for m, _ in blocks):
        start = F.element_at(F.create_map(*[x for s in slots for x in (F.lit(s), F.lit(float(intercepts.get((name, s), 0.0))))]),
                             F.col("slot"))
        parts = [F.coalesce(F.col(f"d{b}") / F.sqrt(F.col(f"n{v}")), F.lit(0.0)) for b, (m, v) in enumerate(blocks) if m == name]
        score = start
        for p in parts:
            score = score + p
        models.append(F.struct(F.lit(name).alias("experiment"), score.alias("score")))
    out = j.select("doc_id", "slot", *keep, F.explode(F.array(*models)).alias("m"))
    return out.select("m.experiment", "slot", "doc_id", *keep, "m.score", sigmoid("m.score").alias("prob"),
                      (F.col("m.score") > 0).cast("int").alias("prediction"))


def _totals(rows: DataFrame, specs, blocks, norm, dot) -> DataFrame:
    """One row for each document and slot: n.. (squared norms), d.. (dot products)."""
    return rows.groupBy("doc_id", "slot").agg(*[F.sum(norm(v)).alias(f"n{v}") for v in range(len(specs))],
                                              *[F.sum(dot(b)).alias(f"d{b}") for b in range(len(blocks))])


def _sums_in_tasks(docs: DataFrame, cube: DataFrame, specs, blocks, slots) -> DataFrame:
    """A cube of bounded size goes to the tasks as arrays; what leaves them is a
    few sums for each document, slot and family."""
    parts = None
    for wide, at in widest(specs):
        own = cube.where(F.col("family") == family(wide)).orderBy("term").toArrow()
        cells = own["cells"].combine_chunks().flatten()

        def numbers(name: str, many: int, cells=cells, rows=own.num_rows) -> np.ndarray:
            x = cells.field(name).flatten().to_numpy(zero_copy_only=False)
            return np.nan_to_num(x.astype(float)).reshape(rows, len(slots), many)

        part = gr.cube_sums(docs, wide, own["term"].combine_chunks().cast(pa.string()), numbers("idf", len(specs)),
                            numbers("w", len(blocks)), slots, [v for _, v in blocks], at,
                            [b for b, (_, v) in enumerate(blocks) if v in at])
        parts = part if parts is None else parts.unionByName(part)
    return _totals(parts, specs, blocks, lambda v: F.col(f"n{v}"), lambda b: F.col(f"d{b}"))


def _sums_by_join(docs: DataFrame, cube: DataFrame, specs, blocks, slots) -> DataFrame:
    rows = None
    for wide, _ in widest(specs):
        part = doc_terms(docs, wide, ["slots"]).select(F.lit(family(wide)).alias("family"), "*")
        rows = part if rows is None else rows.unionByName(part)
    place = F.array_position(F.array(*[F.lit(s) for s in slots]), F.col("slot")).cast("int")
    met = (rows.join(cube, ["family", "term"])
           .select("row.doc_id", F.explode("row.slots").alias("slot"), (1.0 + F.log(F.col("tf").cast("double"))).alias("tf"), "cells")
           .select("doc_id", "slot", "tf", F.element_at("cells", place).alias("c")))
    raw = [F.col("tf") * F.col("c.idf")[v] for v in range(len(specs))]
    return _totals(met, specs, blocks, lambda v: raw[v] * raw[v], lambda b: raw[blocks[b][1]] * F.col("c.w")[b])
