"""Exact near-duplicate pairs of embeddings by dual traversal of cover trees.

Equal vectors count once, with their number.  Unit vectors with cosine of at
least t are at most sqrt(2 - 2t) apart, so metric bounds apply.  The top of
the tree is a set of centres per label, nested nets with halving radii over a
bounded sample; every vector goes to its nearest centre, and a centre's
vectors are cut into blocks by their distance from it.  Two blocks are
compared only if the triangle inequality allows a pair.  For each such pair of
blocks a task builds the lower levels (nets of halving radii, covering radius
kept at each node), walks both trees together, drops node pairs by their
covering radii, and checks what is left in double precision.  A block has at
most ``block_rows`` vectors, whatever the label's size.

The sample only shapes the tree; every vector is indexed and compared, and
the result is exact.  A task returns link counts and pairs that join the same
vectors into components as its links do, never all pairs of a group.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, or that have a null label or id, link with nothing (a null id has
a null component and is not kept); vectors of different length never link;
repeated rows are vectors of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import rank_within, written
from tessera.llm.components import connected_components
from tessera.session import materialize


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, safe for tiny and huge values."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def net(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, centre of each point, distance to it): no two centres within
    ``radius``, every point within it of its nearest centre."""
    nearest = np.full(len(points), np.inf)
    owner = np.zeros(len(points), dtype=np.int64)
    centres: list[int] = []
    todo = np.arange(len(points))
    while len(todo):
        pick = [int(todo[0])]
        if len(todo) > 64:  # several at once: the first of the open points that are far from each other
            head = todo[:64]
            far = distances(points[head], points[head]) > radius
            for i in range(1, len(head)):
                if far[i, [int(np.flatnonzero(head == p)[0]) for p in pick]].all():
                    pick.append(int(head[i]))
        d = distances(points, points[pick])
        best = d.argmin(axis=1)
        closer = d[np.arange(len(points)), best] < nearest
        nearest[closer] = d[np.arange(len(points)), best][closer]
        owner[closer] = len(centres) + best[closer]
        centres += pick
        nearest[pick] = 0.0
        owner[pick] = np.arange(len(centres) - len(pick), len(centres))
        todo = todo[nearest[todo] > radius]
    return np.array(centres), owner, nearest


class Node:
    __slots__ = ("members", "radius", "children", "centres", "radii")

    def __init__(self, points: np.ndarray, members: np.ndarray, centre: int, radius: float, step: float, reach: float,
                 leaf: int):
        self.members, self.radius, self.children = members, radius, []
        if len(members) <= leaf or radius <= reach / 2:
            return
        while step >= radius:
            step /= 2
        centres, owner, dist = net(points[members], step)
        while len(centres) == 1 and step > reach / 4:
            step /= 2
            centres, owner, dist = net(points[members], step)
        if len(centres) == 1:
            return
        order = np.argsort(owner, kind="stable")
        parts = np.split(order, np.cumsum(np.bincount(owner, minlength=len(centres)))[:-1])
        for c, part in zip(centres, parts):
            self.children.append(Node(points, members[part], int(members[c]), float(dist[part].max()), step, reach, leaf))
        self.centres = points[members[centres]]
        self.radii = np.array([k.radius for k in self.children])


def tree(points: np.ndarray, reach: float, leaf: int = 24) -> Node:
    radius = float(distances(points, points[:1]).max())
    return Node(points, np.arange(len(points)), 0, radius, 2.0, reach, leaf)


def dual_pairs(a: np.ndarray, b: np.ndarray, cosine: float, same: bool):
    """Yield (rows of a, rows of b) that reach ``cosine``; if ``same``, a is b
    and each pair comes in both orders, without the rows themselves."""
    reach = float(np.sqrt(2.0 - 2.0 * cosine)) + 1e-7
    ta = tree(a, reach)
    tb = ta if same else tree(b, reach)
    stack = [(ta, tb)]
    while stack:
        x, y = stack.pop()
        if x.children and y.children:
            near = distances(x.centres, y.centres) <= x.radii[:, None] + y.radii[None, :] + reach
            stack.extend((x.children[i], y.children[j]) for i, j in zip(*np.nonzero(near)))
        elif x.children or y.children:
            split, other, flip = (x, y, False) if x.children else (y, x, True)
            pts = a if flip else b
            span = distances(split.centres, pts[other.members])
            near = np.flatnonzero((span <= split.radii[:, None] + reach).any(axis=1))
            stack.extend((other, split.children[i]) if flip else (split.children[i], other) for i in near)
        else:
            i, j = np.nonzero(a[x.members] @ b[y.members].T >= cosine)
            i, j = x.members[i], y.members[j]
            if same:
                i, j = i[i != j], j[i != j]
            if len(i):
                yield i, j


def forest(n: int, edges) -> list[tuple[int, int]]:
    """Edges that join parts, by union-find."""
    up = np.arange(n)

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for i, j in edges:
        a, b = root(i), root(j)
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def compare_blocks(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Counts and a spanning forest for one pair of blocks; side 0 and 1, or 0 alone."""
    sides = [pdf[pdf["side"] == k].sort_values("rep") for k in (0, 1)]
    same = sides[1].empty
    a = unit(np.stack(sides[0]["vec"].to_numpy()).astype(float))
    b = a if same else unit(np.stack(sides[1]["vec"].to_numpy()).astype(float))
    ids = [s["rep"].to_numpy() for s in sides]
    times = [s["times"].to_numpy() for s in sides]
    if same:
        ids[1], times[1] = ids[0], times[0]
    count = [np.zeros(len(ids[0]), dtype=np.int64), np.zeros(len(ids[1]), dtype=np.int64)]
    shift = 0 if same else len(a)
    kept: list[tuple[int, int]] = []
    for i, j in dual_pairs(a, b, cosine, same):
        np.add.at(count[0], i, times[1][j])
        if not same:
            np.add.at(count[1], j, times[0][i])
        kept.extend(forest_edges(i, j + shift))
        if len(kept) > 8 * (len(a) + len(b)):
            kept = forest(len(a) + len(b), kept)
    every = ids[0] if same else np.concatenate(ids)
    out = [(int(every[i]), int(every[j]), 0) for i, j in forest(len(every), kept)]
    for k in (0,) if same else (0, 1):
        out += [(int(ids[k][i]), None, int(count[k][i])) for i in np.flatnonzero(count[k])]
    return pd.DataFrame(out, columns=["a", "b", "n"]).astype({"a": "int64", "b": "Int64", "n": "int64"})


def forest_edges(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A few links with the same components as all links (i, j), i sorted:
    each row's first partner, and partners that follow each other in a row,
    which most rows of a dense group have in common."""
    fresh = np.ones(len(i), dtype=bool)
    fresh[1:] = i[1:] != i[:-1]
    chain = np.unique(np.column_stack([j[:-1], j[1:]])[~fresh[1:]], axis=0) if len(j) > 1 else np.zeros((0, 2), int)
    names, flat = np.unique(np.concatenate([i[fresh], chain[:, 0], j[fresh], chain[:, 1]]), return_inverse=True)
    half = len(flat) // 2
    return [(int(names[x]), int(names[y])) for x, y in forest(len(names), zip(flat[:half].tolist(), flat[half:].tolist()))]


def pick_centres(sample: pd.DataFrame, most: int) -> dict[tuple, np.ndarray]:
    """Centres for each (label, dimension): the finest net of halving radius
    with at most ``most`` members."""
    out = {}
    for key, rows in sample.groupby(["label", "dim"], sort=True):
        pts = unit(np.stack(rows["vec"].to_numpy()).astype(float))
        radius, best = 2.0, pts[:1]
        while radius > 0.05:
            radius /= 2
            centres, _, _ = net(pts, radius)
            if len(centres) > most:
                break
            best = pts[centres]
        out[key] = best
    return out


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.98, sample_rows: int = 4096, max_centres: int = 32,
                           block_rows: int = 2048, id_col: str = "vec_id", vec_col: str = "embedding",
                           label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    spark = vectors.sparkSession
    vec = F.col("vec")
    ok = (vec.isNotNull() & (F.size(vec) > 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
          & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
          & F.exists(vec, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    keyed = rows.select("vec_id", "ok", "label", "vec",
                        F.xxhash64("label", "vec").alias("k1"), F.xxhash64(F.lit(17), "vec", "label").alias("k2"))
    reps = materialize(keyed.where("ok").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times"), F.first("label").alias("label"),
        F.first("vec").alias("vec")).withColumn("dim", F.size("vec")))

    sample = reps.select("label", "dim", "rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).toPandas()
    centres = spark.sparkContext.broadcast(pick_centres(sample, max_centres))  # at most sample_rows vectors

    def assign(batches):
        known = centres.value
        for pdf in batches:
            cell, dist = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf))
            for key, part in pdf.groupby(["label", "dim"]).indices.items():
                pts = unit(np.stack(pdf["vec"].to_numpy()[part]).astype(float))
                near = known.get(key)
                d = distances(pts, near if near is not None else np.eye(1, pts.shape[1]))
                cell[part] = d.argmin(axis=1)
                dist[part] = d.min(axis=1)
            yield pd.DataFrame({"grp": pdf["label"] + "|" + pdf["dim"].astype(str) + "|" + pd.Series(cell, index=pdf.index).astype(str),
                                "label": pdf["label"], "dim": pdf["dim"], "cell": cell, "dist": dist, "rep": pdf["rep"],
                                "times": pdf["times"], "vec": pdf["vec"]})

    placed = reps.select("label", "dim", "rep", "times", "vec").mapInPandas(
        assign, "grp string, label string, dim int, cell long, dist double, rep long, times long, vec array<double>")
    ranked = rank_within(placed, "grp", ["dist", "rep"], "rank")
    blocked = materialize(ranked.withColumn("block", F.floor((F.col("rank") - 1) / block_rows)))

    meta = blocked.groupBy("label", "dim", "cell", "block").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"))

    def between(batches):
        known = centres.value
        for pdf in batches:
            gap = []
            for label, dim, c, d in zip(pdf["label"], pdf["dim"], pdf["cell"], pdf["cell_2"]):
                pts = known.get((label, dim))
                gap.append(0.0 if pts is None or c == d else float(distances(pts[[c]], pts[[d]])[0, 0]))
            yield pdf.assign(gap=gap)

    other = meta.select("label", "dim", *[F.col(c).alias(f"{c}_2") for c in ("cell", "block", "lo", "hi")])
    pairs = meta.join(other, ["label", "dim"]).where("(cell, block) <= (cell_2, block_2)")
    pairs = pairs.mapInPandas(between, "label string, dim int, cell long, block long, lo double, hi double, "
                              "cell_2 long, block_2 long, lo_2 double, hi_2 double, gap double")
    reach = float(np.sqrt(2 - 2 * cosine)) + 1e-7
    least = F.greatest(F.col("gap") - F.col("hi") - F.col("hi_2"), F.col("lo") - F.col("gap") - F.col("hi_2"),
                       F.col("lo_2") - F.col("gap") - F.col("hi"))
    pairs = written(pairs.where(least <= reach).select(
        F.xxhash64("label", "dim", "cell", "block", "cell_2", "block_2").alias("pair"), "label", "dim",
        F.explode(F.when((F.col("cell") == F.col("cell_2")) & (F.col("block") == F.col("block_2")),
                         F.array(F.struct(F.lit(0).alias("side"), F.col("cell"), F.col("block"))))
                  .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("cell"), F.col("block")),
                                     F.struct(F.lit(1).alias("side"), F.col("cell_2").alias("cell"),
                                              F.col("block_2").alias("block"))))).alias("m"))
        .select("pair", "label", "dim", "m.*"), "block-pairs")
    found = (blocked.join(pairs, ["label", "dim", "cell", "block"]).select("pair", "side", "rep", "times", "vec")
             .groupBy("pair").applyInPandas(lambda pdf: compare_blocks(pdf, cosine), "a long, b long, n long"))
    found = materialize(found)
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("b is not null").select("a", "b"))
    known = (reps.select("k1", "k2", "rep", "times").join(counts, "rep", "left")
             .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
             .select("k1", "k2", (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    known = written(known, "vector-classes")
    out = keyed.select("vec_id", "ok", "k1", "k2").join(known, ["k1", "k2"], "left")
    comp = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("ok"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col("vec_id") == comp, F.lit(False)).alias("kept"))


#: The same in DuckDB SQL, over all pairs of a label.
NEAR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
part AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, p.component_id, e.vec_id = p.component_id AS kept
FROM embeddings e JOIN part p ON p.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id"""
