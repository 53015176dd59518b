"""Quality rules as a learned decision list.

One pass over the texts computes a row of statistics for each document.  From
the labelled rows, sequential covering learns conjunctions of thresholds for
low quality: each is grown by information gain on two thirds of the sample and
pruned on the other third, and the covered rows leave before the next one.
The list becomes one ordered Spark ``when`` expression; documents that no
conjunction covers are kept.

The learner sees a bounded sample: the ``sample_rows`` labelled documents with
the smallest hash of their id.  Statistics and verdicts cover all documents.

Defined cases: a null or empty text has no words, so it fails the base rule;
repeated rows are judged alike; repeated labels count once; without labelled
rows of both classes the list is empty and the base rule alone decides; very
long texts are handled whole, a few at a time; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, HashCache, ngram_hashes, word_hashes, written
from tessera.session import materialize

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits",
          "n_punct", "n_distinct", "n_lines", "n_chars")
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "punct_per_word": ("n_punct", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}
_SPACE_BYTES = list(SPACES.encode())
_PUNCT = list(b"!?.,;:-\"'()")


def text_counts(text: str | None, cache: HashCache) -> tuple[int, ...]:
    """The counts of COUNTS for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    hist = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = len(raw) - int(hist[0x80:0xC0].sum())  # code points: all but continuation bytes
    h = word_hashes(words, cache)
    tri = ngram_hashes(h, 3)
    _, where, times = np.unique(tri, return_inverse=True, return_counts=True)
    covered = np.zeros(len(h) + 1, dtype=np.int64)
    starts = np.flatnonzero(times[where] > 1) if len(tri) else np.zeros(0, dtype=np.int64)
    for i in range(3):
        covered[starts + i] = 1
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES.encode())]
    return (len(words), chars - int(hist[_SPACE_BYTES].sum()), int(hist[list(SYMBOLS)].sum()),
            len(lines) - len(set(lines)), int(covered.sum()), int(hist[65:91].sum()), int(hist[48:58].sum()),
            int(hist[_PUNCT].sum()), len(set(words)), len(lines), chars)


def count_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, COUNTS...) for every document."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    fields = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = HashCache()
        for batch in batches:
            rows = np.array([text_counts(x.as_py(), cache) for x in batch.column(1)],
                            dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64())] + [pa.array(rows[:, i]) for i in range(len(COUNTS))],
                schema=fields)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self) -> Column:
        v = ratio(self.feature)
        return v >= F.lit(self.threshold) if self.above else v < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.4g}"


def _covers(tests: list[Test], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    m = np.ones(n, dtype=bool)
    for t in tests:
        m &= t.holds(x)
    return m


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray, bins: int) -> tuple[float, Test | None]:
    """The test with the largest gain p * (log2 precision after - before)."""
    p0, n0 = bad.sum(), len(bad)
    best, found = 0.0, None
    for name, v in x.items():
        cuts = np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))
        cuts = np.unique(np.concatenate([cuts, (cuts[1:] + cuts[:-1]) / 2]))
        if not len(cuts):
            continue
        slot = np.searchsorted(cuts, v, side="right")
        p = np.bincount(slot[bad], minlength=len(cuts) + 1)
        n = np.bincount(slot, minlength=len(cuts) + 1)
        for above in (True, False):
            pc = p[::-1].cumsum()[::-1][1:] if above else p.cumsum()[:-1]
            nc = n[::-1].cumsum()[::-1][1:] if above else n.cumsum()[:-1]
            gain = np.where(pc > 0, pc * (np.log2(np.maximum(pc, 1e-9) / np.maximum(nc, 1)) - np.log2(p0 / n0)), 0)
            i = int(np.argmax(gain))
            if gain[i] > best + 1e-9:
                best, found = float(gain[i]), Test(name, above, float(cuts[i]))
    return best, found


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_tests: int = 4,
               min_precision: float = 0.9, min_cover: int = 5, bins: int = 64) -> list[list[Test]]:
    """Sequential covering: conjunctions for ``bad``, each grown on rows with
    index not 2 modulo 3, pruned on the others, and kept only while its
    smoothed precision over all the rows left reaches ``min_precision``."""
    rules: list[list[Test]] = []
    left = np.arange(len(bad))
    while len(rules) < max_rules and bad[left].sum() >= min_cover:
        grow, prune = left[left % 3 != 2], left[left % 3 == 2]
        tests: list[Test] = []
        inside = grow
        while len(tests) < max_tests and len(inside) and 0 < bad[inside].sum() < len(inside):
            gain, test = _best_test({k: v[inside] for k, v in x.items()}, bad[inside], bins)
            if test is None or gain <= 0:
                break
            tests.append(test)
            inside = inside[test.holds({k: v[inside] for k, v in x.items()})]
        if not tests:
            break

        def worth(part: list[Test], rows=prune) -> float:
            m = _covers(part, {k: v[rows] for k, v in x.items()}, len(rows))
            p = int(bad[rows][m].sum())
            return (p - (m.sum() - p)) / (m.sum() + 2)

        tests = max((tests[:i] for i in range(len(tests), 0, -1)), key=worth)
        m = _covers(tests, {k: v[left] for k, v in x.items()}, len(left))
        p = int(bad[left][m].sum())
        if p < min_cover or (p + 1) / (m.sum() + 2) < min_precision:
            break
        rules.append(tests)
        left = left[~m]
    return rules


def decision_list(rules: list[list[Test]]) -> Column:
    """1-based number of the first conjunction that holds, else 0."""
    out = F.lit(0)
    for i, tests in reversed(list(enumerate(rules, 1))):
        cond = F.lit(True)
        for t in tests:
            cond = cond & t.column()
        out = F.when(cond, F.lit(i)).otherwise(out)
    return out


def first_by_hash(rows: DataFrame, hashed: str, ties: list[str], k: int) -> DataFrame:
    """The first ``k`` rows by a 64-bit hash, then by ``ties``.

    Only rows under a bound taken from the row count are sorted, so tasks send
    about ``k`` rows in all, not ``k`` each; the bound is raised until it holds ``k``.
    """
    total = rows.count()
    share = min(1.0, 1.25 * k / max(total, 1))
    while share < 1.0:
        below = rows.where(F.col(hashed) < int(-2 ** 63 + share * 2 ** 64))
        if below.count() >= k:
            return below.orderBy(hashed, *ties).limit(k)
        share = min(1.0, 2 * share)
    return rows.orderBy(hashed, *ties).limit(k)


def quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, max_dup_percent: int = 50,
                  min_words: int = 50, **learner) -> tuple[DataFrame, list[list[Test]]]:
    """(counts with base_failed, rule and kept, the learned list).

    ``labels``: rows (doc_id, quality); quality 0 is what the list rejects.
    """
    counts = materialize(count_table(docs))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_dup_percent * F.col("n_words"))
    marked = (labels.where("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    rows = written(counts.where(~base).join(marked, "doc_id")
                   .select("quality", "doc_id", *[ratio(r).cast("double").alias(r) for r in RATIOS],
                           F.xxhash64("doc_id").alias("_h")), "rule-sample")
    sample = first_by_hash(rows, "_h", ["doc_id", *RATIOS], sample_rows).toPandas()
    bad = (sample["quality"].to_numpy() == 0)
    x = {r: sample[r].to_numpy() for r in RATIOS}
    rules = learn_list(x, bad, **learner) if 0 < bad.sum() < len(bad) else []
    out = (counts.withColumn("base_failed", base)
           .withColumn("rule", F.when(F.col("base_failed"), F.lit(None).cast("int")).otherwise(decision_list(rules)))
           .withColumn("kept", ~F.col("base_failed") & (F.coalesce("rule", F.lit(0)) == 0)))
    return out, rules
