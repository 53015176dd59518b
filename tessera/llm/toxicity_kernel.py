"""Toxicity by a subsequence string-kernel support vector machine.

The kernel compares two strings by their common subsequences of three
characters, those within a span of five, each damped by ``decay`` for every
character skipped, so that an insult with a gap or an inserted character still
resembles the plain one.  A Nyström map over landmark strings makes the kernel
a short vector and the machine linear.

Labels mark whole texts, and one insult makes a text toxic, so a text is a bag
of its words and its decision value is that of its worst word.  Training
starts from the words that labels single out, then alternates: fit, take each
toxic text's worst word as its positive instance and the worst words of clean
texts as hard negatives, fit again.  A logistic calibration turns the decision
value into a score.

Landmarks, support weights and calibration are fitted on a bounded sample of
labelled rows outside the held-out fold; every whole text is scored.  The fit
collapses to one weight for each subsequence code, so scoring a word costs a
look-up for each of its subsequences, and a word's value is kept for its next
occurrence.

Defined cases: null and empty texts have no words and get the calibrated score
of a harmless text; letters spelt one by one are joined to a word; a word with
inner signs counts both without them and as the words between them; words of
over ``LONG`` characters count in overlapping parts of that length, and such
words and those of scripts without spaces also in all parts as long as the
insults that the fit marked; the fit sees the same parts as the scoring, and
marks parts of ``SHORT`` lengths in such words; repeated rows score alike; without labelled rows of both classes all scores
are 0; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, mix64
from tessera.llm.sampling import fit_logistic, labelled_sample

CODES = 64
SPACE = CODES ** 3
STEPS = ((1, 1), (1, 2), (2, 1), (1, 3), (3, 1), (2, 2))  # gaps between the three characters
LONG = 24
SHORT = range(2, 9)
EDGE = "^"  # marks both ends of a word
_SPELT = regex.compile(r"(?<![\p{L}\p{N}])(?:\p{L}[ .\-_*]{1,2}){3,}\p{L}(?![\p{L}\p{N}])")
_DROP = regex.compile(r"[^\p{L}\p{N}]+")
_SIGNS = regex.compile(r"[^\p{L}\p{N}\p{M}]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


class Codes(dict):
    """character -> number: 0 for EDGE, 1 to 26 for a to z, from 27 on for all others."""

    def __missing__(self, ch: str) -> int:
        o = ord(ch)
        c = self[ch] = o - 96 if "a" <= ch <= "z" else 0 if ch == EDGE else 27 + o
        return c


_CODES = Codes()


def tokens(text: str | None) -> set[str]:
    """The distinct words of a text, lower-cased, inner signs dropped, and the
    words that single spelt-out letters make up."""
    if not text:
        return set()
    low = text.lower()
    out = set(low.split())
    if _SPELT.search(low):
        out.update(_DROP.sub("", m) for m in _SPELT.findall(low))
    return out


def clean(token: str) -> str:
    return token if token.isalpha() else _DROP.sub("", token)


def parts(token: str) -> tuple[list[str], list[str]]:
    """What a token counts as: its words in parts of at most LONG characters,
    and those of its words that also count in all their shorter parts."""
    if token.isascii() and token.isalpha() and len(token) <= LONG:
        return [token], []
    words = [w for w in (clean(x) for x in _SIGNS.split(token)) if w]
    whole = words if len(words) < 2 else [*words, "".join(words)]
    out = [w[at:at + LONG] for w in whole for at in range(0, max(1, len(w) - LONG // 2), LONG // 2)]
    return out, [w for w in words if len(w) > LONG or _UNSPACED.search(w)]


def slices(words: list[str], spans) -> Iterator[str]:
    """All parts of the words that have one of the lengths."""
    return (w[i:i + k] for w in words for k in spans for i in range(len(w) - k + 1))


def codes(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Code below SPACE of three characters: a to z apart, others by a hash of all three."""
    out = (a * CODES + b) * CODES + c
    other = np.flatnonzero((a > 26) | (b > 26) | (c > 26))
    if len(other):
        three = (a[other] << 42) | (b[other] << 21) | c[other]
        out[other] = (mix64(three.astype(np.uint64)) % np.uint64(SPACE)).astype(np.int64)
    return out


def subsequences(words: list[str], decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence code, weight), one row for each code of a word;
    the weights of a word have norm 1."""
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    joined = "".join(f"{EDGE}{w}{EDGE}" for w in words)
    code = np.fromiter(map(_CODES.__getitem__, joined), dtype=np.int64, count=len(joined))
    owner = np.repeat(np.arange(len(words)), lengths)
    keys, weights = [], []
    for a, b in STEPS:
        n = len(code) - a - b
        if n <= 0:
            continue
        same = owner[:n] == owner[a + b:]
        idx = codes(code[:n], code[a:a + n], code[a + b:])
        keys.append((owner[:n] * SPACE + idx)[same])
        weights.append(np.full(len(keys[-1]), decay ** (a + b - 2)))
    if not keys:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)
    key, inv = np.unique(np.concatenate(keys), return_inverse=True)
    w = np.bincount(inv, weights=np.concatenate(weights), minlength=len(key))
    word = key // SPACE
    norm = np.sqrt(np.bincount(word, weights=w * w, minlength=len(words)))
    return word, key % SPACE, w / norm[word]


def kernel(a: list[str], b: list[str], decay: float) -> np.ndarray:
    """Matrix of normalised subsequence kernels."""
    if len(a) > 256:  # in parts, so that the products stay small
        return np.vstack([kernel(a[i:i + 256], b, decay) for i in range(0, len(a), 256)])
    wb, cb, vb = subsequences(b, decay)
    wa, ca, va = subsequences(a, decay)
    used, slot = np.unique(cb, return_inverse=True)
    dense = np.zeros((len(used), len(b)))
    dense[slot, wb] = vb
    at = np.searchsorted(used, ca)
    hit = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == ca)
    out = np.zeros((len(a), len(b)))
    np.add.at(out, wa[hit], va[hit][:, None] * dense[at[hit]])
    return out


def linear_svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, steps: int = 400) -> np.ndarray:
    """Squared-hinge linear machine by accelerated gradient steps; y is +1 or -1."""
    a = np.column_stack([z, np.ones(len(z))])
    lip = 1.0 + 2 * c * np.linalg.norm(a * np.sqrt(weight)[:, None], 2) ** 2
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        slack = np.maximum(0.0, 1 - y * (a @ v))
        grad = v * np.append(np.ones(z.shape[1]), 0.0) - 2 * c * a.T @ (weight * y * slack)
        nxt, t2 = v - grad / lip, (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = nxt + (t - 1) / t2 * (nxt - w), nxt, t2
    return w


@dataclass
class KernelModel:
    table: np.ndarray  # weight of each subsequence code
    bias: float
    slope: float
    intercept: float
    floor: float  # decision value of a text without words
    decay: float
    landmarks: list[str]
    spans: tuple[int, ...] = ()  # lengths of the parts of words without spaces

    def values(self, words: list[str]) -> np.ndarray:
        if len(words) > 8192:
            return np.concatenate([self.values(words[i:i + 8192]) for i in range(0, len(words), 8192)])
        word, code, w = subsequences(words, self.decay)
        return np.bincount(word, weights=w * self.table[code], minlength=len(words)) + self.bias

    def worst(self, words: list[str]) -> tuple[float, str]:
        """The highest value among the words' short parts, and its part."""
        best, some = (self.floor, ""), slices(words, self.spans)
        while chunk := list(set(itertools.islice(some, 20_000))):
            value = self.values(chunk)
            at = max(range(len(chunk)), key=lambda i: (value[i], chunk[i]))
            best = max(best, (float(value[at]), chunk[at]))
        return best


def fit(sample: list[tuple[int, str, int]], landmarks: int = 256, rounds: int = 3, decay: float = 0.5,
        negatives: int = 4000) -> KernelModel | None:
    bags, runs = [], []  # runs: each text's words that count in all their short parts
    for _, text, y in sample:
        both = [parts(t) for t in tokens(text)]
        bags.append(({w for p, _ in both for w in p}, y))
        runs.append(sorted({w for _, r in both for w in r}))
    n_pos = sum(y for _, y in bags)
    if not 0 < n_pos < len(bags):
        return None
    short = set()  # parts that several toxic texts share, one length after the other to bound memory
    for k in SHORT if any(runs) else ():
        df = Counter(w for r, (_, y) in zip(runs, bags) if y and r for w in set(slices(r, (k,))))
        short.update(w for w, n in df.items() if n > 1)
    for r, (words, _) in zip(runs, bags):
        if r:
            words.update(w for w in slices(r, SHORT) if w in short)
    pos_df, neg_df = Counter(), Counter()
    for words, y in bags:
        (pos_df if y else neg_df).update(words)
    n_neg = len(bags) - n_pos

    def lift(w: str) -> float:
        """Log-likelihood gain of the word for toxic texts, 0 if it is not above its share."""
        p, n = pos_df[w], neg_df[w]
        share, base = (p + 0.5) / (p + n + 1), n_pos / len(bags)
        return p * math.log(share / base) if share > base else 0.0

    def pure(w: str) -> bool:
        return pos_df[w] * n_neg > 30 * neg_df[w] * n_pos

    enough = math.log(len(pos_df) + len(neg_df) + 1) + 1  # more words, more of them stand out by chance
    marked = {w for w in pos_df if neg_df[w] == 0 and lift(w) >= 2 * enough}
    left = [words for words, y in bags if y and not words & marked]
    open_df = Counter(w for words in left for w in words if pos_df[w] >= 3 and pure(w))
    while open_df:  # cover the toxic texts, the most telling word of those left first
        base = len(left) / (len(left) + n_neg)
        gain = {w: c * math.log((c + 0.5) / (c + neg_df[w] + 1) / base) for w, c in open_df.items() if c >= 2}
        w = max(gain, key=lambda k: (gain[k], k), default=None)
        if w is None or gain[w] < enough:
            break
        marked.add(w)
        for words in left:
            if w in words:
                open_df.subtract(words & open_df.keys())
        left = [words for words in left if w not in words]
    if not marked:
        marked = {max(words, key=lambda w: (lift(w), w)) for words, y in bags if y and words}
    if not marked:
        return None
    spans = tuple(sorted({len(w) for w in marked if len(w) <= LONG})) if any(runs) else ()
    for r, (words, _) in zip(runs, bags):  # from here on the parts that the scoring looks at
        if r:
            words -= {w for w in short.intersection(words) if len(w) not in spans} - {p for w in r for p in parts(w)[0]}
    clean_words = sorted(neg_df, key=lambda w: (-neg_df[w], w))
    spread = clean_words[::max(1, len(clean_words) // negatives)][:negatives]
    hard: list[str] = []
    model = None
    for _ in range(rounds):
        neg = sorted(set(spread) | set(hard))
        pos = sorted(marked, key=lambda w: (-pos_df[w], w))
        pos_marks = pos[:landmarks // 2]
        near = hard[:landmarks // 4]
        rest = neg[::max(1, len(neg) // (landmarks - len(pos_marks) - len(near) or 1))]
        marks = list(dict.fromkeys([*pos_marks, *near, *rest]))[:landmarks]
        vals, vecs = np.linalg.eigh(kernel(marks, marks, decay))
        keep = vals > 1e-6 * vals.max()
        root = vecs[:, keep] / np.sqrt(vals[keep])
        words = pos + [w for w in neg if w not in marked]
        y = np.where(np.arange(len(words)) < len(pos), 1.0, -1.0)
        weight = np.where(y > 0, 1.0 / len(pos), 1.0 / max(1, len(words) - len(pos))) * len(words) / 2
        svm = linear_svm(kernel(words, marks, decay) @ root, y, weight / len(words) * 50)
        alpha = root @ svm[:-1]
        lw, lc, lv = subsequences(marks, decay)
        flat = np.bincount(lc, weights=lv * alpha[lw], minlength=SPACE)
        model = KernelModel(flat, float(svm[-1]), 1.0, 0.0, -2.0, decay, marks, spans)
        every = sorted(set(pos_df) | set(neg_df))
        value = dict(zip(every, model.values(every)))
        hard = sorted((w for w in neg_df if value[w] > -0.9), key=lambda w: -value[w])[:negatives // 2]
        far = {model.worst(r) for r, (_, y_) in zip(runs, bags) if r and not y_}
        hard = list(dict.fromkeys([*(w for v, w in sorted(far, reverse=True) if v > -0.9), *hard]))[:negatives // 2]
        for words, y_ in bags:  # toxic texts not yet explained: their worst word, if it resembles an insult
            if y_ and words and not words & marked:
                w = max(words, key=lambda w: (value[w], w))
                if value[w] > 0 and lift(w) > 0 and pure(w):
                    marked.add(w)
    bag_value = np.array([max((value[w] for w in words), default=-2.0) for words, _ in bags])
    bag_value = np.maximum(bag_value, [model.worst(r)[0] if r else -2.0 for r in runs])
    labels = np.array([y for _, y in bags], dtype=float)
    w = fit_logistic(np.clip(bag_value, -2, 2)[:, None], labels, ridge=1e-4)
    model.slope, model.intercept = float(max(w[0], 1e-3)), float(w[1])
    return model


class ValueCache:
    """Worst value of each token, over all its parts."""

    LIMIT = 1_000_000

    def __init__(self, model: KernelModel):
        self.model, self.known = model, {}

    def learn(self, new: list[str]) -> None:
        if len(self.known) + len(new) > self.LIMIT:
            self.known.clear()
        some, owner = [], []
        worst = np.full(len(new), self.model.floor)
        for i, tok in enumerate(new):
            whole, run = parts(tok)
            some += whole
            owner += [i] * len(whole)
            if run:
                worst[i] = self.model.worst(run)[0]
            if len(some) >= 20_000 or i == len(new) - 1:
                np.maximum.at(worst, np.array(owner, dtype=np.int64), self.model.values(some) if some else [])
                some, owner = [], []
        self.known.update(zip(new, worst.tolist()))

    def score(self, texts: list[str | None]) -> list[float]:
        bags = [tokens(t) for t in texts]
        new = set().union(*bags).difference(self.known) if bags else set()
        if len(self.known) + len(new) > self.LIMIT:
            new = set().union(*bags)
        if new:
            self.learn(list(new))
        get = self.known.__getitem__
        return [max(map(get, b), default=self.model.floor) for b in bags]


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 2500, max_bytes: int = 10_000_000,
                   threshold: float = 0.7, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
                   max_text_bytes: int | None = None, **fitting) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document; ``max_text_bytes``
    is the longest text the fit may learn from (see ``labelled_sample``)."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(labelled_sample(plain, labels, label, per_class, max_bytes, max_text_bytes=max_text_bytes), **fitting)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SPACE weights, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tessera.llm.common import text_chunks

        m = shared.value
        cache = ValueCache(m) if m else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if m:
                value = np.array([v for a, b in text_chunks(texts) for v in cache.score(texts[a:b])])
                score = 1 / (1 + np.exp(-np.clip(m.slope * np.clip(value, -2, 2) + m.intercept, -35, 35)))
            else:
                score = np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, type=pa.float64())],
                                             names=["doc_id", "score"])

    id_type = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
