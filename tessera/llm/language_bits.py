"""Language identification with bitmask n-gram filters.

One bit-sliced Bloom filter serves all languages: an array of cells, each a mask
with one bit for each language.  An n-gram's ``k`` cells, ANDed, give the mask of
all languages that contain it, in one look-up whatever their number.  A text is
put down to the language whose bit is set for most of its n-grams, after the
count is corrected for the filter's false positives: of ``n`` n-grams a language
that holds ``x`` of them shows about ``x + (n - x) * p``, where ``p`` is the share
of its set bits to the power ``k``, so ``x = (count - n * p) / (1 - p)``.

Fit, all in Spark: of each language's labelled documents about ``per_language``
(by hash of the id, each read whole) give the document frequencies of their
n-grams, added up in each task before the shuffle.  A language contains an n-gram
that at least ``min_docs`` of its documents hold (one, if it has under 20), at no
less than ``share`` of the rate of the language where it is commonest, so stray
foreign words set no bits.
Their cells are ORed by position; only the array of at most ``2 ** max_bits``
cells comes to the driver and is broadcast.  The ``max_languages`` commonest
languages are learnt; both bounds hold at any size of the corpus.

N-grams are runs of 1 to 4 characters of the lower-cased text in which everything
but letters is one space, the space alone not among them; every occurrence in the
whole text counts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a
text of which no language holds an n-gram gets the commonest learnt language with
score 0; equal counts go to the language learnt from more documents, then to the
first by name; null ids belong to no held-out fold; without labelled rows every
text is ``und``; repeated rows score alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix64, written

SIZES = (1, 2, 3, 4)
SPACE = 32


@cache
def letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for all but letters."""
    out = np.full(0x110000, SPACE, np.uint32)
    for i in range(0x32400):  # no letters are assigned beyond
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def spaced_pieces(text: str, piece: int = 1 << 19) -> Iterator[tuple[np.ndarray, int]]:
    """The whole text as code points of letters and single spaces, a space before
    and after it, in pieces: (code points, how many of them the piece before held)."""
    keep = max(SIZES) - 1
    tail = np.full(1, SPACE, np.uint32)
    held = 0
    for at in range(0, len(text), piece):
        raw = np.frombuffer(text[at:at + piece].encode("utf-32-le", "surrogatepass"), np.uint32)
        new = letters()[raw]
        if at + piece >= len(text):
            new = np.append(new, np.uint32(SPACE))
        before = np.concatenate([tail[-1:], new[:-1]])
        new = new[(new != SPACE) | (before != SPACE)]
        both = np.concatenate([tail, new])
        yield both, held
        tail = both[-keep:]
        held = len(tail)


def grams(cp: np.ndarray, held: int) -> np.ndarray:
    """64-bit hashes of the n-grams that end in the part that is not ``held`` over."""
    out = []
    wide = cp.astype(np.uint64)
    acc = np.zeros(len(cp), np.uint64)
    for n in SIZES:
        if len(cp) < n:
            break
        # acc[i]: the n code points from i on, 21 bits each mixed in one by one
        acc = (acc[:len(cp) - n + 1] * np.uint64(0x9E3779B97F4A7C15)) + wide[n - 1:] + np.uint64(1)
        new = acc[max(0, held - n + 1):]
        if n == 1:
            new = new[cp[held:] != SPACE]
        out.append(mix64(new + np.uint64(n)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def has_letter(cp: np.ndarray) -> bool:
    return bool((cp != SPACE).any())


def text_grams(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of a text, piece by piece; none without letters."""
    for cp, held in spaced_pieces(text or ""):
        if has_letter(cp):
            yield grams(cp, held)


def positions(h: np.ndarray, j: int, bits: int) -> np.ndarray:
    """The ``j``-th cell of each hash."""
    step = np.uint64(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64))
    return (mix64(h + step) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class LanguageFilter:
    langs: list[str]          # most documents first, then by name
    bits: int                 # 2 ** bits cells
    k: int
    cells: np.ndarray         # (2 ** bits, bytes): bit l of a row, low bits first
    false_rate: np.ndarray    # by language

    def masks(self, h: np.ndarray) -> np.ndarray:
        """One row of bits for each hash: the languages containing the n-gram."""
        got = self.cells[positions(h, 0, self.bits)]
        for j in range(1, self.k):
            got = got & self.cells[positions(h, j, self.bits)]
        return np.unpackbits(got, axis=1, count=len(self.langs), bitorder="little")

    def counts(self, text: str | None) -> tuple[np.ndarray, int]:
        """Corrected n-gram counts by language, and the number of n-grams."""
        seen, n = np.zeros(len(self.langs)), 0
        for h in text_grams(text):
            seen += self.masks(h).sum(axis=0, dtype=np.int64)
            n += len(h)
        return np.maximum(0.0, (seen - n * self.false_rate) / (1 - self.false_rate)), n

    def decide(self, text: str | None) -> tuple[str, float]:
        """Language and score: how far the second language's count stays behind."""
        x, n = self.counts(text)
        if not n or not self.langs:
            return "und", 0.0
        best = int(x.argmax())  # the first of equal ones
        second = np.delete(x, best).max(initial=0.0)
        return self.langs[best], float(1 - second / x[best]) if x[best] > 0 else 0.0


def fold4(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; fold 2 is held out. Null ids: fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(0))


def labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, held_out_fold: int) -> DataFrame:
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where((fold4(F.col("doc_id")) != held_out_fold) & F.col("lang").isNotNull() & F.col("text").isNotNull()))


def gram_frequencies(sample: DataFrame, codes: dict[str, int]) -> DataFrame:
    """(lang, gram, df): in how many of a language's sampled documents an n-gram is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[np.ndarray]] = {}
        size = 0

        def added() -> Iterator[pa.RecordBatch]:
            for code, lists in waiting.items():
                h, df = np.unique(np.concatenate(lists), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), code, np.int32)), pa.array(h.view(np.int64)), pa.array(df.astype(np.int64))],
                    names=["lang", "gram", "df"])
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                own = [np.unique(h) for h in text_grams(text.as_py())]
                if own:
                    own = np.unique(np.concatenate(own)) if len(own) > 1 else own[0]
                    waiting.setdefault(codes[lang.as_py()], []).append(own)
                    size += len(own)
                if size > 4_000_000:  # what a task holds, 32 MB
                    yield from added()
                    size = 0
        yield from added()

    return (sample.select("lang", "text").mapInArrow(run, "lang int, gram bigint, df bigint")
            .groupBy("lang", "gram").agg(F.sum("df").alias("df")))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out_fold: int = 2,
        per_language: int = 4000, min_docs: int = 2, share: float = 0.1, k: int = 3, max_bits: int = 22,
        max_languages: int = 1024) -> LanguageFilter:
    known = labelled(docs, id_col, text_col, lang_col, held_out_fold)
    top = (known.where(F.col("text").rlike("\\p{L}")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "lang").limit(max_languages).collect())
    langs = [r.lang for r in top]
    if not langs:
        return LanguageFilter([], 1, k, np.zeros((2, 1), np.uint8), np.zeros(0))
    spark = docs.sparkSession
    rates = F.broadcast(spark.createDataFrame([(r.lang, min(1.0, per_language / r.n)) for r in top], "lang string, rate double"))
    drawn = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) < F.col("rate") * (1 << 30)
    sample = known.join(rates, "lang").where(drawn & F.col("text").rlike("\\p{L}"))
    freq = gram_frequencies(sample, {x: i for i, x in enumerate(langs)})
    # rates stand on the expected sample sizes: a language's documents, or per_language of them
    size = F.broadcast(spark.createDataFrame([(i, float(min(r.n, per_language))) for i, r in enumerate(top)], "lang int, docs double"))
    # a language of under 20 documents may have only one with the n-gram
    rated = (freq.join(size, "lang").where((F.col("df") >= min_docs) | (F.col("docs") < 20))
             .select("lang", "gram", (F.col("df") / F.col("docs")).alias("rate")))
    rated = written(rated, "language-grams")
    best = rated.groupBy("gram").agg(F.max("rate").alias("best"))
    held = written(rated.join(best, "gram").where(F.col("rate") >= share * F.col("best")).select("lang", "gram"),
                   "language-held")
    n = held.select("gram").distinct().count()
    bits = min(max_bits, max(10, int(np.ceil(np.log2(max(1, 8 * n))))))
    width = (len(langs) + 7) // 8

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("gram").to_numpy().view(np.uint64)
            lang = batch.column("lang").to_numpy()
            cell = np.concatenate([positions(h, j, bits) for j in range(k)])
            slot, bit = np.tile(lang // 8, k), np.tile(1 << (lang % 8), k)
            yield pa.RecordBatch.from_arrays([pa.array(cell * width + slot), pa.array(bit.astype(np.int32))], names=["at", "mask"])

    bytes_ = held.mapInArrow(cells_of, "at bigint, mask int").groupBy("at").agg(F.expr("bit_or(mask)").alias("mask"))
    cells = np.zeros((1 << bits) * width, np.uint8)
    table = bytes_.toArrow()  # at most 2 ** bits rows for each 8 languages
    cells[table["at"].to_numpy()] = table["mask"].to_numpy()
    cells = cells.reshape(-1, width)
    filled = np.unpackbits(cells, axis=1, count=len(langs), bitorder="little").mean(axis=0)
    return LanguageFilter(langs, bits, k, cells, np.minimum(filled ** k, 0.99))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             held_out_fold: int = 2, **fitting) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document."""
    model = fit(docs, id_col, text_col, lang_col, held_out_fold, **fitting)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** max_bits cells at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            got = [m.decide(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g for g, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double").select(
        "doc_id", (fold4(F.col("doc_id")) == held_out_fold).alias("held_out"), "lang_pred", "score")
