"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Each document is its set of word shingles.  Under one global order of the
shingles, two sets that reach the similarity share at least one shingle among
the first ``p`` of each, p = n - ceil(t n) + 1, and at least l among the first
p + l - 1.  Rare shingles come first in the order, so prefixes avoid those
that many documents share; each document takes the l, up to ``max_match``,
whose prefix has the least estimated candidate cost (the sum of its shingles'
document counts, over l squared), and a pair is verified only if it shares the
smaller of the two l.  Any order is exact; it only steers the cost.

A shared token at positions i and j of two prefixes, the k-th they share, leaves
them at most k + min(n - i - 1, n' - j - 1) shingles in common.  Posting lists
propose a pair only where that bound, with the smaller l for k, still reaches
the similarity.  Shingles of one document alone come first in the order, so a
near copy with too many of its own drops out here.

Sets are compared whole: documents with equal sets are one class from the
start, and candidate pairs are verified by the exact intersection of the
64-bit shingle hashes.  Before whole sets are fetched, a pair must pass a
bound by parities: each set keeps one bit for each of about as many hash
buckets as it has shingles, the parity of the bucket's shingles.  Two sets
differ in at least as many shingles as their parities differ in bits, so a
pair ruled out cannot reach the similarity.  Candidates come in two steps so that a group of
thousands of near copies never becomes all its pairs: first each posting list
(by shingle and size class) proposes only its members with its most central
member, whose shingles are the most frequent on average; then, with the
components of the links found, only members of different components.  Pairs
inside one component cannot change it.  Lists of two are one pair and done in
the first step.

Document counts cover all shingles of all documents, in a sketch of fixed size
(2 ** 21 hash buckets): a shingle counts as frequent if its bucket holds well
more than buckets do on average.

Defined cases: null texts and texts without words have no shingles, link with
nothing and are their own component; fewer words than n make one shingle of
the whole sequence; a null id links with nothing and has a null component;
rows with equal ids are one document for the component; very long texts are
read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, column_chunks, free_name, hashed_words, mix64, ngram_hashes, signed, written
from tessera.llm.components import connected_components
from tessera.session import materialize

SKETCH_BITS = 21  # hash buckets whose documents are counted: 2 ** 21, whatever the corpus
SKETCH_SLICES = 64
FILTER_BITS = 26  # 2 ** 26 bits, 8 MB, say which ids may be wanted, whatever the corpus


def shingles(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    hashes, count = hashed_words(texts, lower=True)
    out, at = [], 0
    for k in count:
        h = hashes[at:at + k]
        at += k
        out.append(np.unique(ngram_hashes(h, n)) if k >= n else ngram_hashes(h, len(h), seed=len(h)) if k
                   else np.zeros(0, dtype=np.uint64))
    return out


def needed(n: int, percent: int) -> int:
    """ceil(percent / 100 * n)."""
    return -(-percent * n // 100)


def bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def choose_prefix(s: np.ndarray, counts: np.ndarray, usual: float, percent: int,
                  max_match: int) -> tuple[int, np.ndarray, float]:
    """(l, prefix, centrality) of a sorted set of shingles; ``counts`` are the
    document counts of the hash buckets and ``usual`` what an ordinary bucket
    holds.  Centrality is the mean logarithm of the counts."""
    n = len(s)
    c = counts[bucket(s)]
    # The order: by power of two of the count over the usual one, then by hash.
    level = np.log2(np.maximum(c / usual, 1.0))
    order = np.lexsort((s, np.floor(level)))
    p = n - needed(n, percent) + 1
    total = np.cumsum(np.maximum(c[order] - usual, 1.0))
    best, cost = 1, math.inf
    for m in range(1, max_match + 1):
        if p + m - 1 > n or (m > 1 and m > needed(n, percent)):
            break
        k = total[p + m - 2] / (m * m) + (p + m - 1)  # candidates, and the longer index
        if k < cost:
            best, cost = m, k
    return best, s[order[:p + best - 1]], float(level.mean())


def parities(s: np.ndarray) -> bytes:
    """The parity of the number of shingles in each hash bucket, as bits; as
    many buckets as shingles, up to the next power of two, 64 at least."""
    places = 1 << max(6, (len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """At most the number of shingles that only one of two sets holds: the bits
    in which their parities differ, the longer one folded to the shorter."""
    a, b = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    short = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, short), axis=0) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _binary(s: np.ndarray) -> bytes:
    return s.astype("<u8").tobytes()


def only_wanted(rows: DataFrame, want: DataFrame) -> DataFrame:
    """The ``rows`` (doc_id, text) whose id may be among ``want``: a bitmap of
    fixed size, by the ids' hashes, spares the others the shuffle of a join.
    It never drops a wanted row; ids that share a bit pass to the join.

    The bitmap is made and read by Spark's own functions: where the join after it
    is broadcast, the task that reads the texts goes on to Python, and a Python
    step here would give each such task two Python workers, which then stay.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    part, bit = F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit")
    bits = want.select(part, bit).repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))
    known = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.pow(F.lit(2), F.col("bit") % 8).cast("int")) != 0
    return (rows.select("doc_id", "text", part, bit).join(F.broadcast(bits), "part")  # 2049 rows of 4 KB at most
            .where(known).select("doc_id", "text"))


def jaccard_classes(docs: DataFrame, n: int = 4, percent: int = 85, max_match: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((doc_id, n_shingles, component_id) for every row, (a, b, common, united)
    links found between class representatives; they span the components)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def count_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for _, _, texts in column_chunks(batch.column(0)):
                every = np.concatenate(shingles(texts, n))
                counts += np.bincount(bucket(every), minlength=len(counts))
        salt = TaskContext.get().partitionId() % 64
        parts = [zlib.compress(c.astype("<i8").tobytes(), 1) for c in np.split(counts, SKETCH_SLICES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SKETCH_SLICES), pa.int32()), pa.array([salt] * SKETCH_SLICES, pa.int32()),
             pa.array(parts, pa.binary())], names=["slice", "salt", "counts"])

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), dtype="<i8") for c in pdf["counts"])
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "salt": [0],
                             "counts": [zlib.compress(total.astype("<i8").tobytes(), 1)]})

    shape = "slice int, salt int, counts binary"
    sketch = (rows.select("text").mapInArrow(count_part, shape).groupBy("slice", "salt").applyInPandas(add_up, shape)
              .groupBy("slice").applyInPandas(add_up, shape).orderBy("slice").collect())  # of fixed size
    counts = (np.concatenate([np.frombuffer(zlib.decompress(r.counts), dtype="<i8") for r in sketch])
              if sketch else np.zeros(1 << SKETCH_BITS)).astype(np.float32)
    shared = spark.sparkContext.broadcast((counts, float(4 * counts.mean() + 8)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, usual = shared.value
        for batch in batches:
            for a, b, texts in column_chunks(batch.column(1)):
                size, k1, k2, match, prefix, centre, parity = [], [], [], [], [], [], []
                for s in shingles(texts, n):
                    m, p, mid = choose_prefix(s, counts, usual, percent, max_match) if len(s) else (0, s, 0.0)
                    size.append(len(s))
                    k1.append(int(signed(np.add.reduce(mix64(s), keepdims=True, dtype=np.uint64))[0]))
                    k2.append(int(signed(np.add.reduce(mix64(s ^ np.uint64(0xA5A5F00D5EED1234)), keepdims=True,
                                                       dtype=np.uint64))[0]))
                    match.append(m)
                    prefix.append(signed(p))
                    centre.append(mid)
                    parity.append(parities(s))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size, pa.int64()), pa.array(k1, pa.int64()),
                     pa.array(k2, pa.int64()), pa.array(match, pa.int32()),
                     pa.array(prefix, type=pa.list_(pa.int64())), pa.array(centre, pa.float32()),
                     pa.array(parity, pa.binary())],
                    names=["doc_id", "n", "k1", "k2", "l", "prefix", "centre", "parity"])

    indexed = written(rows.mapInArrow(
        index, "doc_id long, n long, k1 long, k2 long, l int, prefix array<long>, centre float, "
        "parity binary").withColumn("row", F.monotonically_increasing_id()), "ngram-index")
    # Equal sets: the smallest id stands for them.  Only keys are grouped; rows that
    # another stands for are then taken out, so prefixes of the rest need not move.
    known = indexed.where("n > 0 and doc_id is not null")
    same = (known.groupBy("n", "k1", "k2").agg(F.min(F.struct("doc_id", "row")).alias("r"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").select("n", "k1", "k2", F.col("r.row").alias("first")))
    same = written(same, "ngram-same")
    copies = written(known.select("row", "n", "k1", "k2").join(same, ["n", "k1", "k2"]).where("row <> first")
                     .select("row"), "ngram-copies")
    reps = known.join(copies, "row", "left_anti").drop("row")
    reps = written(reps, "ngram-sets")
    sets = reps.select("n", "k1", "k2", F.col("doc_id").alias("rep"))
    node = F.xxhash64("k1", "k2", "n").alias("node")
    posts = reps.select(F.posexplode("prefix").alias("pos", "token"), node, "n", "l", "centre")
    # How many shingles a pair may have in common from this token on, and as many as the l before it.
    posts = posts.select("token", "node", "n", "l", "centre", (F.col("n") - F.col("pos") + F.col("l") - 1).alias("room"))
    # Counted where they lie: one shuffle of the posts, not a second one of their tokens.
    posts = posts.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("c > 1")

    def reaches(room: str, n_a: str, n_b: str):
        """Whether ``room`` shingles in common suffice for the similarity."""
        return F.expr(f"{100 + percent} * ({room}) >= {percent} * ({n_a} + {n_b})")

    # n - pos + min(l) - 1 on both sides, from room = n - pos + l - 1.
    may_link = reaches("least(room - l, room_2 - l_2) + least(l, l_2)", "n", "n_2")
    band = F.when(F.col("c") > 2, F.floor(F.log("n") / F.lit(math.log(100 / percent))))
    # The hub of a list's band is found where the list lies, without another shuffle.
    hub = F.max(F.struct("centre", "node", "n", "l", "room")).over(Window.partitionBy("token", "band"))
    posts = (posts.withColumn("band", F.coalesce(band, F.lit(-1)))  # lists of two: in one band
             .withColumn("h", hub)
             .select("token", "node", "n", "l", "room", "c",
                     *[F.col(f"h.{x}").alias(f"{x}_2") for x in ("node", "n", "l", "room")]))
    posts = written(posts, "ngram-posts")
    star = (posts.where((F.col("node") != F.col("node_2")) & may_link)
            .select("node", "n", "l", "node_2", "n_2", "l_2", (F.col("c") == 2).alias("two")))

    def candidates(pairs: DataFrame) -> DataFrame:
        """Distinct pairs, smaller node first, that share enough of their prefixes."""
        pair = F.struct(F.least("node", "node_2").alias("node"), F.greatest("node", "node_2").alias("node_2"))
        return (pairs.select(pair.alias("pair"), F.least("l", "l_2").alias("least_l")).groupBy("pair")
                .agg(F.count(F.lit(1)).alias("shared"), F.min("least_l").alias("least_l"))
                .where("shared >= least_l").select("pair.*"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in column_chunks(batch.column(3)):
                packed = [_binary(s) for s in shingles(texts, n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, b - a) for i in range(3)] + [pa.array(packed, pa.binary())],
                    names=["node", "rep", "n", "s"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kept, inter, union = [], [], []
            for i in range(batch.num_rows):
                x = np.frombuffer(cols["s"][i].as_py(), dtype="<u8")
                y = np.frombuffer(cols["s_2"][i].as_py(), dtype="<u8")
                c = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * c >= percent * (len(x) + len(y) - c):
                    kept.append(i)
                    inter.append(c)
                    union.append(len(x) + len(y) - c)
            at = pa.array(kept, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [cols[k].take(at) for k in ("node", "node_2", "rep", "rep_2")] + [pa.array(inter, pa.int64()),
                                                                                  pa.array(union, pa.int64())],
                names=["node", "node_2", "rep", "rep_2", "common", "united"])

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.fromiter((differing(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))),
                                dtype=np.int64, count=batch.num_rows)
            # At most half of what is not apart is common.
            yield batch.select([0, 1]).filter(pa.array((100 + percent) * (both - apart) >= 2 * percent * both))

    keys = reps.select("doc_id", "n", "k1", "k2", node)
    bits = reps.select(node, "n", "parity")

    def links(pairs: DataFrame) -> DataFrame:
        """Pairs that reach the similarity, by their whole sets."""
        near = (written(pairs, "ngram-candidates").join(bits, "node")
                .join(bits.withColumnsRenamed({x: f"{x}_2" for x in ("node", "n", "parity")}), "node_2")
                .select("node", "node_2", "n", "n_2", "parity", "parity_2"))
        with arrow_batches(spark, 2000):
            pairs = written(near.mapInArrow(possible, "node long, node_2 long"), "ngram-possible")
        want = pairs.select("node").union(pairs.select("node_2")).distinct()
        want = written(keys.join(want, "node").select("doc_id", "node", "n", "k1", "k2"), "ngram-wanted")
        # A row of that id with that very set (ids may repeat with other texts).
        chosen = only_wanted(rows, want).join(want, "doc_id").select("node", F.col("doc_id").alias("rep"), "n", "text")
        packed = (chosen.mapInArrow(sets_of, "node long, rep long, n long, s binary")
                  .where(F.length("s") == 8 * F.col("n")).dropDuplicates(["node"]).drop("n"))
        with arrow_batches(spark, 2000):  # whole texts in, whole sets out
            packed = written(packed, "ngram-wanted-sets")
        both = (pairs.join(packed, "node")
                .join(packed.withColumnsRenamed({"node": "node_2", "rep": "rep_2", "s": "s_2"}), "node_2")
                .select("node", "node_2", "rep", "rep_2", "s", "s_2"))
        with arrow_batches(spark, 500):  # two whole sets in a row
            return materialize(both.mapInArrow(
                verify, "node long, node_2 long, rep long, rep_2 long, common long, united long"))

    star = written(star, "ngram-star")
    tried = written(candidates(star), "ngram-tried")
    first = links(tried)
    parts = connected_components(first.select(F.col("node").alias("a"), F.col("node_2").alias("b")))
    tagged = (posts.where("c > 2").select("token", "node", "n", "l", "room").join(parts, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    tagged = written(tagged, "ngram-tagged")
    lists = tagged.groupBy("token", "component").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("room").alias("room"))
    cross = (lists.alias("x").join(lists.alias("y"), F.col("x.token") == F.col("y.token"))
             .where("x.component < y.component")
             .where(f"100 * y.hi >= {percent} * x.lo and 100 * x.hi >= {percent} * y.lo")
             .where(reaches("least(x.room, y.room)", "x.lo", "y.lo"))
             .select("x.token", F.col("x.component").alias("component"), F.col("y.component").alias("component_2")))
    right = tagged.withColumnsRenamed({x: f"{x}_2" for x in ("component", "node", "n", "l", "room")})
    across = cross.join(tagged, ["token", "component"]).join(right, ["token", "component_2"]).where(may_link)
    rest = candidates(across.select("node", "node_2", "l", "l_2").union(
        star.where("two").select("node", "node_2", "l", "l_2")))
    rest = rest.join(tried, ["node", "node_2"], "left_anti")
    found = first.union(links(rest))
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("node_2").alias("b")))
    # The component's smallest id, over all sets in it.
    named = sets.select("n", "k1", "k2", "rep", node).join(
        parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = written(named.join(least, "component").select("n", "k1", "k2", "component_id"), "ngram-classes")
    out = (indexed.select("doc_id", "n", "k1", "k2").join(classes, ["n", "k1", "k2"], "left")
           .select("doc_id", F.col("n").alias("n_shingles"),
                   F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))
    return out, found.select(F.col("rep").alias("a"), F.col("rep_2").alias("b"), "common", "united")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is their
    component's smallest; of rows equal in id and text, one.  Rows without an
    id stay."""
    classes, _ = jaccard_classes(docs, id_col=id_col, text_col=text_col, **how)
    gone = (classes.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct())
    gone = written(gone, "ngram-gone")
    left = docs.join(gone.withColumnRenamed("_gone", free_name(docs, "_gone")), F.col(id_col) == F.col(free_name(docs, "_gone")),
                     "left_anti")
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    key = free_name(docs, "_key")
    return left.withColumn(key, F.sha2(F.concat_ws("|", id_text, F.coalesce(F.col(text_col), F.lit(""))), 256)).dropDuplicates(
        [key]).drop(key)


#: The same classes in DuckDB SQL, by joining all shingles.
JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
         GROUP BY ALL),
link AS (
  SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
sym AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN sym l ON r.y = l.x)
SELECT r.x AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x"""
