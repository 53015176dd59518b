"""Ranked lexical search, reversed: the queries are indexed, the documents stream by.

The items' terms form an inverted index (term -> items) that is broadcast; every
document's term counts are streamed through it once, and each task keeps one
bounded heap per item.  The heaps of the tasks are merged in two steps.

Weights need the corpus first, so a block of items takes two jobs:

1. documents -> the counts of those of their terms that the index holds, written
   once as a compact table.  Each task also adds up, and writes as its last row,
   its document count, term count and document frequencies;
2. that table -> scores, heaps, and the merge.

Only the index of one block is ever held by the driver and the tasks:
``block_bytes`` bounds the text of a block's items (an item longer than that is
a block of its own size), and a larger query table takes several blocks.

Terms are runs of ASCII letters and digits and of anything beyond ASCII; only A-Z
are lower-cased.  All arithmetic but the weight's logarithm is in 64-bit integers.

Defined cases: null and empty texts have no term, give no row as items and count
for nothing as documents; an item row that repeats (same id, same text) is one
item, items that share an id but not the text are ranked each for itself; each
document row is ranked for itself, with null ids after all others among equal
scores; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Bytes of no term become a space, A-Z become a-z, all others stay.
FOLDED = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
               for c in range(256))


def term_lists(text: str | None, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a whole text, in lists of about ``piece`` bytes of it."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(FOLDED)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + piece)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def term_counts(text: str | None) -> Counter:
    out: Counter = Counter()
    for words in term_lists(text):
        out.update(words)
    return out


@dataclass
class ItemIndex:
    """Inverted index over one block of items: posting list ``t`` is
    ``items[starts[t]:starts[t + 1]]`` with the term's repeats in ``repeats``."""
    vocab: dict[bytes, int] = field(default_factory=dict)
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    items: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    repeats: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_items: int = 0

    @classmethod
    def of(cls, texts: list[str | None]) -> ItemIndex:
        lists: dict[bytes, list[tuple[int, int]]] = {}
        for i, text in enumerate(texts):
            for term, n in term_counts(text).items():
                lists.setdefault(term, []).append((i, n))
        flat = [p for posts in lists.values() for p in posts]
        starts = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(p) for p in lists.values()], out=starts[1:])
        pairs = np.array(flat, np.int64).reshape(-1, 2)
        return cls({t: k for k, t in enumerate(lists)}, starts, pairs[:, 0].copy(), pairs[:, 1].copy(), len(texts))

    def scores(self, terms: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Sum over each item's terms, repeats included, of the term's gain."""
        out = np.zeros(self.n_items, np.int64)
        first, n = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        np.add.at(out, self.items[at], np.repeat(gains, n) * self.repeats[at])
        return out


def known_counts(docs: DataFrame, index: ItemIndex, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's length in terms and its counts of the
    index's terms.  A task's last row has ``n_docs`` set: documents with terms in
    ``n_docs``, all their terms in ``n``, document frequencies in ``tfs``."""
    shared = docs.sparkSession.sparkContext.broadcast(index.vocab)  # one block's terms
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        seen, n_docs, n_terms, id_type = np.zeros(len(vocab), np.int64), 0, 0, pa.int64()
        names = ["doc_id", "n", "terms", "tfs", "n_docs"]
        for batch in batches:
            lengths, terms, tfs, id_type = [], [], [], batch.column(0).type
            for text in batch.column(1):
                n, found = 0, Counter()
                for words in term_lists(text.as_py()):
                    n += len(words)
                    found.update(map(vocab.get, words))
                found.pop(None, None)
                lengths.append(n)
                terms.append(np.fromiter(found.keys(), np.int32, len(found)))
                tfs.append(np.fromiter(found.values(), np.int64, len(found)))
                seen[terms[-1]] += 1
                n_docs += n > 0
                n_terms += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64())), pa.nulls(len(lengths), pa.int64())], names=names)
        if n_docs:
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.array([n_terms], pa.int64()), pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([seen[at]], pa.list_(pa.int64())), pa.array([n_docs], pa.int64())], names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, tfs array<bigint>, n_docs bigint")


def best_of_tasks(counts: DataFrame, index: ItemIndex, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): what the bounded heaps hold when a task ends."""
    shared = counts.sparkSession.sparkContext.broadcast((index, weights))  # one block's index
    kind = counts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, w = shared.value
        heaps: list[list] = [[] for _ in range(ix.n_items)]
        least = np.ones(ix.n_items, np.int64)  # what a score must reach to be looked at
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            terms, tfs = batch.column(2), batch.column(3)
            flat_t, flat_f = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
            cuts = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())])
            lengths = batch.column(1).to_numpy()
            for i, doc_id in enumerate(batch.column(0)):
                t, tf = flat_t[cuts[i]:cuts[i + 1]], flat_f[cuts[i]:cuts[i + 1]]
                if not len(t):
                    continue
                m = 100 - 25 + (25 * int(lengths[i]) * n_docs) // n_terms
                got = ix.scores(t, w[t] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m)))
                key = doc_id.as_py()
                for item in np.flatnonzero(got >= least).tolist():
                    # the heap's root is the worst entry: lowest score, then the latest id
                    entry = (int(got[item]), key is not None, Late(key))
                    heap = heaps[item]
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif heap[0] < entry:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == top:
                        least[item] = heap[0][0]
        for at in range(0, ix.n_items, 1000):
            part = [(i, e[2].key, e[0]) for i in range(at, min(at + 1000, ix.n_items)) for e in heaps[i]]
            if part:
                items, ids, scores = zip(*part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int32()), pa.array(ids, id_type), pa.array(scores, pa.int64())],
                    names=["item", "doc_id", "score"])

    return counts.select("doc_id", "n", "terms", "tfs").mapInArrow(run, f"item int, doc_id {kind}, score bigint")


class Late:
    """Ids in reverse, so that a heap's root is the entry with the latest id."""
    __slots__ = ("key",)

    def __init__(self, key):
        self.key = key

    def __lt__(self, other) -> bool:
        return self.key is not None and other.key is not None and other.key < self.key

    def __eq__(self, other) -> bool:
        return self.key == other.key


def merged(best: DataFrame, top: int) -> DataFrame:
    """(item, rank, doc_id, score): the ``top`` of all tasks' heaps.  The heaps
    meet in about as many groups an item as each group has heaps."""
    n = max(1, math.isqrt(best.rdd.getNumPartitions()))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = best.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(n)))
    some = Window.partitionBy("item", "_group").orderBy(*order)
    part = part.withColumn("_r", F.row_number().over(some)).where(F.col("_r") <= top)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return part.select("item", rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= top)


def search_block(docs: DataFrame, items: list, item_schema, top: int, id_col: str, text_col: str) -> DataFrame:
    """The ranking of one block of items, (item_id, text) rows."""
    spark = docs.sparkSession
    index = ItemIndex.of([text for _, text in items])
    table = written(known_counts(docs, index, id_col, text_col), "search-counts")
    of_task = table.where("n_docs IS NOT NULL")
    totals = of_task.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(index.vocab), np.int64)  # one number for each term of the block
    pairs = of_task.select(F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    for r in pairs.groupBy("p.terms").agg(F.sum("p.tfs").alias("df")).toLocalIterator():
        df[r["terms"]] = r["df"]
    n_docs, n_terms = int(totals[0]), int(totals[1])
    weights = np.floor(1000 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)
    best = best_of_tasks(table.where("n_docs IS NULL"), index, weights, n_docs, max(n_terms, 1), top)
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], item_schema)
    return (merged(best, top).join(F.broadcast(ids), "item")  # one block's items
            .select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, top: int = 20, block_bytes: int = 8_000_000, id_col: str = "doc_id",
           text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` highest-scoring documents."""
    spark = docs.sparkSession
    asked = (items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
             .where(F.octet_length("text") > 0).distinct())
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(size / block_bytes))
    kind = asked.schema["item_id"].dataType.simpleString()
    if n_blocks > 1:
        asked = written(asked, "search-items")
    out = None
    for block in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        rows = sorted(((r.item_id, r.text) for r in part.toLocalIterator()), key=lambda r: (r[0] is not None, r[0], r[1]))
        found = search_block(docs, rows, f"item int, item_id {kind}", top, id_col, text_col)
        out = found if out is None else out.unionByName(found)
    return out


SEARCH_SQL = r"""
WITH q AS (SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM len),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
      FROM tf, tot GROUP BY term, n_docs),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * n_docs) // n_terms) AS m FROM len, tot),
s AS (SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""
