"""Removing repeated passages by recompression.

A text is a sequence of word symbols.  First maximal runs of one word, then
in rounds pairs (a symbol of the left class followed by one of the right class)
become single symbols.  A symbol's name is the hash of what it stands for and
the round's classes are bits of the names, so names agree over all documents
and equal passages get equal symbols wherever their surroundings cannot
matter; the rounds run in Spark tasks without any exchange of names.

For each window of ``window`` words, its anchor is the widest symbol (then the
least name) among those whose name depends on words of the window alone, from
the top level down until one of three words is found, so equal windows have
equal anchors.  Spark groups the anchors of all documents: only
those that occur in two documents can belong to a repeat.  The windows under
shared anchors, and only these, are then compared by a 95-bit hash of their
words, which verifies the repeats; words under a window that also starts in a
document with a smaller id are removed.

Texts are shuffled once, by document id, and that exchange serves both later
joins; anchors and windows are narrow rows, at most one for each symbol or
window of a document, with a document's own repeats combined before the
shuffle.  A passage that many documents share adds one row for each of them.

Defined cases: null and empty texts have no words; documents shorter than a
window are kept whole; rows with equal ids never remove each other's words;
rows with a null id neither remove nor lose words; very long texts are read
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import column_chunks, hashed_words, mix64, ngram_hashes, signed

U = np.uint64


class Level:
    """Symbols of one level over several documents: name, first word, end,
    the words [dep_a, dep_b) that decide on it, and its document."""

    __slots__ = ("name", "a", "b", "dep_a", "dep_b", "doc")

    def __init__(self, name, a, b, dep_a, dep_b, doc):
        self.name, self.a, self.b, self.dep_a, self.dep_b, self.doc = name, a, b, dep_a, dep_b, doc


def merge_runs(s: Level) -> Level:
    """Maximal runs of one symbol become one; each symbol now also depends on its neighbours."""
    n = len(s.name)
    same = np.zeros(n, dtype=bool)  # equal to the symbol before
    same[1:] = (s.name[1:] == s.name[:-1]) & (s.doc[1:] == s.doc[:-1])
    head = np.flatnonzero(~same)
    tail = np.append(head[1:], n) - 1
    count = tail - head + 1
    name = np.where(count > 1, mix64(s.name[head] + count.astype(U) * U(0xD1B54A32D192ED03)), s.name[head])
    dep_a, dep_b = s.dep_a[head].copy(), s.dep_b[tail].copy()
    inner = s.doc[head[1:]] == s.doc[head[:-1]]
    dep_a[1:] = np.where(inner, np.minimum(dep_a[1:], s.dep_a[tail[:-1]]), dep_a[1:])
    dep_b[:-1] = np.where(inner, np.maximum(dep_b[:-1], s.dep_b[head[1:]]), dep_b[:-1])
    # At the ends of a document the missing neighbour decides: a window inside another text may have one.
    dep_a[np.append(True, ~inner)] -= 1
    dep_b[np.append(~inner, True)] += 1
    return Level(name, s.a[head], s.b[tail], dep_a, dep_b, s.doc[head])


def merge_pairs(s: Level, seed: int) -> Level:
    """A left-class symbol and the right-class symbol after it become one."""
    n = len(s.name)
    left = (mix64(s.name ^ U(seed)) >> U(63)).astype(bool)
    inner = np.zeros(n, dtype=bool)  # has a symbol after it in its document
    inner[:-1] = s.doc[1:] == s.doc[:-1]
    pair = np.zeros(n, dtype=bool)
    pair[:-1] = inner[:-1] & left[:-1] & ~left[1:]
    second = np.zeros(n, dtype=bool)
    second[1:] = pair[:-1]
    nxt = np.minimum(np.arange(n) + 1, n - 1)
    prev = np.maximum(np.arange(n) - 1, 0)
    has_prev = np.append(False, inner[:-1])
    name = np.where(pair, mix64(s.name * U(0x9E3779B97F4A7C15) + s.name[nxt] + U(seed)), s.name)
    b = np.where(pair, s.b[nxt], s.b)
    # A single left symbol depends on the one after it, a single right one on the one before.
    dep_a = np.where(left, s.dep_a, np.where(has_prev, np.minimum(s.dep_a, s.dep_a[prev]), s.dep_a - 1))
    dep_b = np.where(left, np.where(inner, np.maximum(s.dep_b, s.dep_b[nxt]), s.dep_b + 1), s.dep_b)
    dep_a = np.where(pair, np.minimum(s.dep_a, s.dep_a[nxt]), dep_a)
    dep_b = np.where(pair, np.maximum(s.dep_b, s.dep_b[nxt]), dep_b)
    keep = ~second
    return Level(name[keep], s.a[keep], b[keep], dep_a[keep], dep_b[keep], s.doc[keep])


def levels(words: np.ndarray, doc: np.ndarray, rounds: int) -> list[Level]:
    """The words, then the symbols after each round.  Runs are merged in the
    first round; later rounds merge pairs (equal symbols side by side are of
    one class and stay apart, and looking for runs again would make every
    symbol depend on its neighbours once more)."""
    at = np.arange(len(words), dtype=np.int64)
    s = Level(mix64(words), at, at + 1, at, at + 1, doc)
    out = [s]
    for r in range(rounds):
        s = merge_pairs(merge_runs(s) if r == 0 else s, 0x1001 + 2 * r)
        out.append(s)
    return out


def anchors(words: np.ndarray, doc: np.ndarray, window: int, rounds: int, enough: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(window starts, anchor name of each window)."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    inside = doc[:n] == doc[window - 1:]  # by start: does a window of one document start here
    none = np.iinfo(np.uint64).max
    best = np.full(n, none, dtype=U)
    open_ = inside.copy()
    for high, s in reversed(list(enumerate(levels(words, doc, rounds)))):
        # The windows that hold all the words a symbol depends on start from ``lo`` to ``hi``.
        lo, hi = np.maximum(s.dep_b - window, 0), np.minimum(s.dep_a, n - 1)
        upto = np.concatenate([[0], np.cumsum(open_)])
        use = np.flatnonzero(hi >= lo)
        use = use[upto[hi[use] + 1] > upto[lo[use]]]
        size = hi[use] - lo[use] + 1
        before = np.cumsum(size) - size
        at = np.repeat(lo[use] - before, size) + np.arange(size.sum())
        # Wide symbols first, then the least name; the top six bits hold 63 - width.
        rank = ((U(63) - np.minimum(s.b[use] - s.a[use], 62).astype(U)) << U(58)) | (mix64(s.name[use] + U(high)) >> U(6))
        ok = open_[at]
        np.minimum.at(best, at[ok], np.repeat(rank, size)[ok])
        # A symbol of the level below is at most as wide as what it became part of.
        open_ &= (best >> U(58)) > U(63 - enough)
        if not open_.any():
            break
    start = np.flatnonzero(inside)
    return start, best[start]


def chunk_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in a row, number of each word's text)."""
    hashes, count = hashed_words(texts)
    return hashes, np.repeat(np.arange(len(texts)), count)


def distinct_of(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Places of the first of each (doc, keys...)."""
    order = np.lexsort((*keys[::-1], doc))
    fresh = np.ones(len(order), dtype=bool)
    if len(order) > 1:
        fresh[1:] = doc[order][1:] != doc[order][:-1]
        for k in keys:
            fresh[1:] |= k[order][1:] != k[order][:-1]
    return order[fresh]


def remove_repeats(docs: DataFrame, window: int = 13, rounds: int = 3, id_col: str = "doc_id",
                   text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept, row) for every row;
    ``kept`` are the words left, joined by one space, and ``row`` the columns
    ``carry`` of the input as one struct (null if there are none).  With ``carry``
    there is also ``text``, the input's, which travels once with the row."""
    row = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row.alias("row"))
    row_type = rows.schema["row"].dataType.simpleString()
    ids = rows.where("doc_id is not null and text is not null")

    def emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, texts in column_chunks(batch.column(1)):
                h, doc = chunk_words(texts)
                start, name = anchors(h, doc, window, rounds)
                first = distinct_of(doc[start], name)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(name[first])), pa.array(doc_ids[a:b][doc[start][first]], pa.int64())],
                    names=["anchor", "doc_id"])

    by_anchor = Window.partitionBy("anchor")
    shared = (ids.mapInArrow(emit_anchors, "anchor long, doc_id long")
              .withColumn("lo", F.min("doc_id").over(by_anchor)).withColumn("hi", F.max("doc_id").over(by_anchor))
              .where("lo < hi").groupBy("doc_id").agg(F.collect_list(F.shiftright(F.shiftleft("anchor", 32), 32).cast("int")).alias("marks")))
    by_id = rows.repartition("doc_id")

    def emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A null id has no marks; filled, since nulls would turn the ids into floats.
            doc_ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            marks, none = batch.column(2), np.zeros(0, dtype=np.int32)
            for a, b, texts in column_chunks(batch.column(1)):
                h, doc = chunk_words([t if marks[i].is_valid else None for i, t in enumerate(texts, a)])
                start, name = anchors(h, doc, window, rounds)
                known = [marks[i].values.to_numpy(zero_copy_only=False) if marks[i].is_valid else none
                         for i in range(a, b)]
                low = name.astype(np.uint32).view(np.int32)
                ends = np.searchsorted(doc[start], np.arange(b - a + 1))
                hit = np.concatenate([np.isin(low[ends[i]:ends[i + 1]], known[i]) for i in range(b - a)])
                start = start[hit]
                w1, w2 = (ngram_hashes(h, window, seed)[start] if len(start) else np.zeros(0, dtype=U)
                          for seed in (0, 0x5BD1E995))
                w2 = (w2 >> U(33)).astype(np.int32)
                first = distinct_of(doc[start], w1, w2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(w1[first])), pa.array(w2[first]),
                     pa.array(doc_ids[a:b][doc[start][first]], pa.int64())], names=["w1", "w2", "doc_id"])

    same_words = Window.partitionBy("w1", "w2")
    # Both joins keep every row, so that they read the texts from one and the same exchange.
    repeated = (by_id.join(shared, "doc_id", "left").select("doc_id", "text", "marks", "row")
                .mapInArrow(emit_windows, "w1 long, w2 int, doc_id long")
                .withColumn("lo", F.min("doc_id").over(same_words)).where("doc_id > lo")
                .groupBy("doc_id").agg(F.collect_list("w1").alias("cut")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(2)
            for a, b, texts in column_chunks(batch.column(1)):
                n_words, n_removed, digest, kept = [], [], [], []
                hashes, count = hashed_words([t if cuts[i].is_valid else None for i, t in enumerate(texts, a)])
                cuts_at = np.concatenate([[0], np.cumsum(count)])
                for i, text in enumerate(texts, a):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    left = words
                    if cuts[i].is_valid:
                        w1 = ngram_hashes(hashes[cuts_at[i - a]:cuts_at[i - a + 1]], window)
                        gone = np.isin(w1, cuts[i].values.to_numpy(zero_copy_only=False).view(U))
                        edge = np.zeros(len(words) + 1, dtype=np.int64)
                        at = np.flatnonzero(gone)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + window, -1)
                        left = [w for w, c in zip(words, np.cumsum(edge[:-1])) if not c]
                    text = b" ".join(left)
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    digest.append(hashlib.sha256(text).hexdigest())
                    kept.append(text.decode("utf-8", "surrogatepass"))
                beside = [batch.column(3).slice(a, b - a)] + ([batch.column(1).slice(a, b - a)] if carry else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(digest, pa.string()), pa.array(kept, pa.string()), *beside],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "row", "text"][:5 + len(beside)])

    return (by_id.join(repeated, "doc_id", "left").select("doc_id", "text", "cut", "row")
            .mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
                             f"row {row_type}" + (", text string" if carry else "")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                    **how) -> DataFrame:
    """The rows of ``docs`` with the repeated words cut from their text.  Texts
    that lose nothing stay as they are; the length column follows the text."""
    done = remove_repeats(docs, id_col=id_col, text_col=text_col, carry=[c for c in docs.columns if c != text_col], **how)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    new = {text_col: text}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema[chars_col].dataType)).otherwise(
            F.col("row").getField(chars_col))
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


#: The same in DuckDB SQL over a relation ``{docs}``: (doc_id, n_words, n_removed, kept).
REPEATS_SQL = r"""
w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs}),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
lo AS (SELECT g, min(doc_id) AS lo FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN lo USING (g) WHERE doc_id > lo),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS kept, count(*) AS n
  FROM word w ANTI JOIN hit h ON h.doc_id = w.doc_id AND h.i = w.i GROUP BY w.doc_id),
deduped AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
         coalesce(k.kept, '') AS kept
  FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id)
"""
