"""Quality classifier by compression.

Two zstandard dictionaries are built, one from labelled good text and one from
labelled bad text.  A text that compresses better with the good one resembles
good text: the normalised difference of the two compressed sizes, with the
compression ratio itself (long runs of one word compress alike with either),
goes through a logistic calibration to a score from 0 to 1.

Dictionaries and calibration are fitted on a bounded sample of labelled rows
outside the held-out fold; every whole text is scored.

Defined cases: null and empty texts get the score of their features (no
difference, no excess); repeated rows score alike; without labelled
rows of both classes every score is 0.5, so everything is kept; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold
from tessera.llm.sampling import fit_logistic, labelled_sample


PIECE = 1024


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    weights: list[float]
    level: int = 3

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(level=self.level, dict_data=d, write_content_size=False,
                                                 write_dict_id=False))
        return [*made, zstandard.ZstdCompressor(level=self.level, write_content_size=False)]


def pieces(raw: bytes, size: int = PIECE) -> list[bytes]:
    """The whole text in pieces of nearly equal length, about ``size`` bytes."""
    n = max(1, round(len(raw) / size))
    cuts = [len(raw) * i // n for i in range(n + 1)]
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def features(raw: bytes, good, bad, plain) -> tuple[float, ...]:
    """Means over the text's pieces, by bytes: the normalised difference of
    the sizes, its sign-preserving square root, and how far the piece alone
    compresses beyond what prose does."""
    if not raw:
        return 0.0, 0.0, 0.0, 0.0
    diff = root = packed = 0.0
    for part in pieces(raw):
        g, b, p = len(good.compress(part)), len(bad.compress(part)), len(plain.compress(part))
        d = (b - g) / max(b, g)
        diff += d * len(part)
        root += np.sign(d) * abs(d) ** 0.5 * len(part)
        packed += max(0.0, 0.35 - max(0, p - 12) / len(part)) * len(part)
    n = len(raw)
    return 5 * diff / n, root / n, 10 * packed / n, 1.0 / np.sqrt(n)


def build_dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary: frequent passages and the entropy tables of the
    sample's symbols, which is what tells short texts apart."""
    samples = [x for t in texts for x in pieces(t)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples for training: their bytes themselves
        return b"\n".join(samples)[-size:]


def fit(sample: list[tuple[int, str, int]], dict_bytes: int = 64_000, level: int = 3) -> CompressionModel:
    """Two of three sample texts feed the dictionaries, the third the calibration."""
    rows = [(t.encode("utf-8", "surrogatepass"), y) for _, t, y in sample]
    kinds = [[t for i, (t, y) in enumerate(rows) if y == k and i % 3 and t] for k in (0, 1)]
    if not kinds[0] or not kinds[1]:
        return CompressionModel(b"", b"", [0.0] * 5, level)
    model = CompressionModel(build_dictionary(kinds[1], dict_bytes), build_dictionary(kinds[0], dict_bytes),
                             [0.0] * 5, level)
    tools = model.compressors()
    held = [(features(t, *tools), y) for i, (t, y) in enumerate(rows) if i % 3 == 0]
    y = np.array([v for _, v in held], dtype=float)
    if 0 < y.sum() < len(y):
        model.weights = fit_logistic(np.array([x for x, _ in held]), y, ridge=1e-6).tolist()
    return model


def scored_rows(docs: DataFrame, labels: DataFrame, per_class: int = 3000, max_bytes: int = 12_000_000,
                dict_bytes: int = 64_000, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                carry: list[str] | None = None, max_text_bytes: int | None = None) -> DataFrame:
    """(row, score): the columns ``carry`` (the id alone by default) as one
    struct, with the score of the row's text.  ``max_text_bytes`` is the longest
    text the fit may learn from (see ``labelled_sample``)."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(labelled_sample(plain, labels, label, per_class, max_bytes, max_text_bytes=max_text_bytes), dict_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most dict_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        w = np.array(m.weights)
        tools = m.compressors() if m.good else None
        for batch in batches:
            x = np.array([features((t.as_py() or "").encode("utf-8", "surrogatepass"), *tools) if tools
                          else (0.0,) * 4 for t in batch.column(1)], dtype=float).reshape(-1, 4)
            score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])

    rows = docs.select(F.struct(*[F.col(c) for c in carry or [id_col]]).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **fitting) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    doc_id = F.col("row").getField(id_col)
    return scored_rows(docs, labels, id_col=id_col, **fitting).select(
        doc_id.alias("doc_id"), (fold(doc_id) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **fitting) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``threshold`` or more."""
    return (scored_rows(docs, labels, carry=docs.columns, **fitting)
            .where(F.col("score") >= threshold).select("row.*"))
