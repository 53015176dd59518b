"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf.  A group's leaves form a tree in which 16 consecutive nodes
have one parent; the groups' subroots form the tree above them.  A node is
labelled (height, tree, index).  Values travel between nodes only as messages in
an external priority queue: tables in the shared folder, one for each height, of
(label of the node that the message is for, message).  Nodes of one height never
depend on each other, so a height is taken out whole:

* forward, by ascending label: all messages of the lowest height are taken out,
  gathered by node, and each node puts its digest in for its parent;
* backward, by descending label: a node takes the proof of its own place and puts
  it in, with the digests beside the child, for each child, down to the leaves.

A height is one Spark job on what the height below left, a sixteenth of it, so a
sweep takes log16(rows) rounds and moves each digest twice, whatever the sizes of
the groups: messages are dealt out by (tree, index), never by group alone, and a
leaf's place in its group comes from a range sort, not from one window.

A digest is the lower-case hex SHA-256 of its inputs, concatenated; digests enter
as their hex text.  The last run of a height may be short, even one node; a tree
with one node at a height is finished, so a lone leaf is its own subroot.

Defined cases: a null value enters as ``-``, so null differs from empty text; null
groups come first, then groups by UTF-8 bytes; inside a group null ids come first,
equal ids by digest; repeated rows are leaves of their own with equal digests;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import rank_within, written

NO_PROOF = "CAST(array() AS array<struct<left:string,right:string>>)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """Digest of values: each as UTF-8 byte count, colon, value; null as ``-``."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest leads to along a proof."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def gathered(queue: DataFrame, fan: int) -> DataFrame:
    """Messages (tree, idx, node...) taken out of the queue by the node they are
    for: (tree, idx, children), children in order.  ``done`` marks a tree's only
    node, which has no parent."""
    rest = [c for c in queue.columns if c not in ("tree", "idx")]
    pos = F.pmod(F.col("idx"), F.lit(fan)).cast("int").alias("pos")
    children = F.array_sort(F.collect_list(F.struct(pos, *rest)))  # at most ``fan``
    up = queue.groupBy("tree", F.expr(f"idx div {fan}").alias("idx")).agg(children.alias("children"))
    return up.withColumn("done", (F.col("idx") == 0) & (F.size("children") == 1))


def forward(queue: DataFrame, fan: int, name: str) -> tuple[list[DataFrame], DataFrame | None]:
    """Sweep upwards from the messages (tree, idx, node, ...) of all leaves.

    Returns the runs of each height, lowest first, and (tree, height, node): each
    tree's last node, None if there are no messages.
    """
    heights, tops = [], None
    while True:
        runs = written(gathered(queue, fan), f"{name}-{len(heights)}")
        waiting, ended = runs.agg(F.count(F.when(~F.col("done"), 1)), F.count(F.when(F.col("done"), 1))).first()
        if ended:
            top = runs.where("done").select("tree", F.lit(len(heights)).alias("height"),
                                            F.col("children")[0]["node"].alias("node"))
            tops = top if tops is None else tops.unionByName(top)
        heights.append(runs)
        if not waiting:
            return heights, tops
        joined = F.array_join(F.transform("children", lambda c: c["node"]), "")
        queue = runs.where("NOT done").select("tree", "idx", F.sha2(joined, 256).alias("node"))


def backward(heights: list[DataFrame], tops: DataFrame, carry: Sequence[str], fan: int, name: str) -> DataFrame:
    """Sweep downwards from ``tops`` (tree, height, proof, ...): what every leaf's
    message carried, its proof, and the further columns of its tree's top."""
    told = [c for c in tops.columns if c not in ("tree", "height", "proof")]
    steps = F.expr("""transform(children, (c, i) -> struct(c AS child, struct(
        array_join(transform(slice(children, 1, i), x -> x.node), '') AS left,
        array_join(transform(slice(children, i + 2, size(children)), x -> x.node), '') AS right) AS step))""")
    queue = None
    for h in range(len(heights) - 1, -1, -1):
        # A run of nodes of height h is told its own proof by the height above; a
        # done one holds a top, which starts here and has nothing beside it.
        top = tops.where(F.col("height") == h).select("tree", F.lit(0).cast("long").alias("idx"), "proof", *told)
        queue = top if queue is None else queue.unionByName(top)
        met = heights[h].join(queue, ["tree", "idx"]).select("tree", "idx", "done", "proof", *told, F.explode(steps).alias("c"))
        proof = F.when(F.col("done"), F.col("proof")).otherwise(F.concat(F.array("c.step"), "proof")).alias("proof")
        if h == 0:
            return met.select(*[F.col(f"c.child.{c}").alias(c) for c in carry], proof, *told)
        below = (F.col("idx") * fan + F.col("c.child.pos")).alias("idx")
        queue = written(met.select("tree", below, proof, *told), f"{name}-down-{h}")
    raise ValueError("no heights")


def merkle_proofs(leaves: DataFrame, group: str, order: str, leaf: str = "leaf", carry: Sequence[str] = (),
                  fan: int = 16) -> DataFrame:
    """(order, leaf, *carry, proof, subroot, root) for every row of ``leaves``.

    ``leaf`` holds the rows' digests; ``proof`` is an array of (left, right), the
    concatenated siblings of each level from the leaf up to the root.
    """
    kept = [order, leaf, *carry]
    # a null group before every other, which all start with a letter
    tree = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit(""))
    rows = written(leaves.select(tree.alias("tree"), F.struct(*[F.col(c) for c in kept]).alias("row")), "merkle-leaves")
    ranked = rank_within(rows.select("tree", F.col(f"row.{order}").alias("o"), F.col(f"row.{leaf}").alias("node"), "row"),
                         "tree", ["o", "node"], "idx")
    heights, tops = forward(ranked.select("tree", (F.col("idx") - 1).alias("idx"), "node", "row"), fan, "merkle")
    if tops is None:
        return leaves.where("false").select(*kept, F.expr(NO_PROOF).alias("proof"), F.lit("").alias("subroot"),
                                            F.lit("").alias("root"))
    subroots = rank_within(tops.select(F.lit("").alias("all"), "tree", "height", "node"), "all", ["tree"], "idx")
    upper, root = forward(subroots.select(F.col("all").alias("tree"), (F.col("idx") - 1).alias("idx"), "node",
                                          F.col("tree").alias("subtree"), F.col("height").alias("subheight")), fan, "merkle-top")
    start = root.select("tree", "height", F.expr(NO_PROOF).alias("proof"), F.col("node").alias("root"))
    told = backward(upper, start, ["subtree", "subheight", "node"], fan, "merkle-top")
    told = written(told.select(F.col("subtree").alias("tree"), F.col("subheight").alias("height"), "proof",
                               F.col("node").alias("subroot"), "root"), "merkle-subroots")
    out = backward(heights, told, ["row"], fan, "merkle")
    return out.select("row.*", "proof", "subroot", "root")


def verified_manifest(docs: DataFrame, id_col: str = "doc_id", group: str = "source",
                      columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
                      tampered: Column | None = None, fan: int = 16) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified): each row's proof,
    folded from its digest, or from that of its tampered self where a
    ``tampered`` text is given and not null."""
    claim = F.lit(None).cast("string")
    if tampered is not None:
        fake = [tampered if c == "text" else F.col(c) for c in columns]
        claim = F.when(tampered.isNotNull(), digest(*fake))
    leaves = docs.select(F.col(id_col).alias("doc_id"), F.col(group).alias("_group"),
                         digest(*[F.col(c) for c in columns]).alias("leaf"), claim.alias("claim"))
    out = merkle_proofs(leaves, "_group", "doc_id", carry=["claim"], fan=fan)
    end = folded(F.coalesce("claim", "leaf"), F.col("proof"))
    return (out.select("doc_id", "leaf", "subroot", "root", "proof", end.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def lowered_fifth(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text with A-Z lower-cased where 5 divides the id's crc32, else null."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate(F.col(text_col), UPPER, LOWER))


def _levels_sql(p: str, rows: str, n: int) -> str:
    """CTEs {p}0.. of (k, idx, d), the siblings {p}s0.. and the tops {p}top of the
    trees over the CTE ``rows``, for up to ``n`` heights."""
    out = [f"{p}0 AS (SELECT k, idx, d, count(*) OVER (PARTITION BY k) AS c FROM {rows})"]
    for i in range(n):
        run = "PARTITION BY k, idx // 16 ORDER BY idx ROWS BETWEEN"
        out.append(f"""{p}s{i} AS (SELECT k, idx,
            coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {p}{i} WHERE c > 1)""")
        out.append(f"""{p}{i + 1} AS (SELECT k, idx, d, count(*) OVER (PARTITION BY k) AS c FROM (
            SELECT k, idx // 16 AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d FROM {p}{i} WHERE c > 1 GROUP BY k, idx // 16))""")
    tops = " UNION ALL ".join(f"SELECT k, d FROM {p}{i} WHERE c = 1" for i in range(n + 1))
    return ",\n".join([*out, f"{p}top AS ({tops})"])


def _manifest_sql(group_heights: int = 6, top_heights: int = 4) -> str:
    def leaf(text: str) -> str:
        return "sha256(concat(" + ", ".join(
            f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
            for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"

    low = f"translate(text, '{UPPER}', '{LOWER}')"
    joins, acc, proof = "", "claim", []
    for i in range(group_heights):
        joins += f" LEFT JOIN as{i} s{i} ON s{i}.k = x.k AND s{i}.idx = x.idx // {16 ** i}"
        acc = f"CASE WHEN s{i}.l IS NULL THEN {acc} ELSE sha256(concat(s{i}.l, {acc}, s{i}.r)) END"
        proof.append(f"coalesce(s{i}.l || s{i}.r, '')")
    for i in range(top_heights):
        joins += f" LEFT JOIN bs{i} t{i} ON t{i}.k = '' AND t{i}.idx = b.idx // {16 ** i}"
        acc = f"CASE WHEN t{i}.l IS NULL THEN {acc} ELSE sha256(concat(t{i}.l, {acc}, t{i}.r)) END"
        proof.append(f"coalesce(t{i}.l || t{i}.r, '')")
    return f"""
WITH tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS g(i)),
x AS (SELECT doc_id, coalesce('g' || source, '') AS k, {leaf('text')} AS d,
        CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                 lambda h: CAST(ascii(h) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0
             THEN {leaf(low)} ELSE {leaf('text')} END AS claim FROM documents, tab),
xr AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, d) - 1 AS idx FROM x),
{_levels_sql('a', 'xr', group_heights)},
br AS (SELECT '' AS k, k AS g, d, row_number() OVER (ORDER BY k) - 1 AS idx FROM atop),
{_levels_sql('b', 'br', top_heights)}
SELECT doc_id, x.d AS leaf, b.d AS subroot, z.d AS root, sha256(concat({', '.join(proof)})) AS proof_sha256,
       {acc} AS folded_root, ({acc}) = z.d AS verified
FROM xr x JOIN br b ON b.g = x.k CROSS JOIN btop z{joins}"""


MANIFEST_SQL = _manifest_sql()
