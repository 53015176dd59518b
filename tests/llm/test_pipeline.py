"""Each stage of corpus_pipeline.py against brute force, on sf0.001."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tessera.llm.common import table, written

SF = "/root/testdata/sf0.001"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute_survivors(docs: dict[int, str], n: int = 5, percent: int = 80) -> set[int]:
    """The smallest id of each group of linked documents."""
    sets = {}
    for i, t in docs.items():
        w = [x.encode().lower() for x in words(t)]
        sets[i] = {tuple(w[k:k + n]) for k in range(max(len(w) - n, 0) + 1)} if w else set()
    parent = {i: i for i in docs}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i for i in ids if top(i) == i}


def brute_cut(docs: dict[int, str], window: int = 13) -> dict[int, list[str]]:
    """The words left of each document."""
    first: dict[tuple, int] = {}
    for i in sorted(docs):
        w = words(docs[i])
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = {}
    for i, t in docs.items():
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_each_stage(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF), f"test-{name}")
        got = result.collect()
        if name != "packing":
            assert sorted(result.columns) == sorted(names), name
            texts = {r.doc_id: r.text for r in got}
        if name == "quality":
            assert 0 < len(texts) <= len(rows) and texts.items() <= rows.items()
        elif name == "near_duplicates":
            assert set(texts) == brute_survivors(rows) and texts.items() <= rows.items()
        elif name == "repeated_passages":
            left = {i: w for i, w in brute_cut(rows).items() if w}
            assert {i: words(t) for i, t in texts.items() if words(t)} == left
        elif name == "source_mix":
            assert texts.items() <= rows.items()
            assert max(Counter(r.doc_id for r in got).values()) <= 2
            before, after = (sum(len(words(t)) for t in x) for x in (rows.values(), [r.text for r in got]))
            assert 1.3 * before <= after <= 1.7 * before
            copies = Counter(r.doc_id for r in got)
        else:
            tokens = Counter()
            for r in got:
                tokens[r.doc_id] += r.length
            assert all(tokens[r.doc_id] == copies[r.doc_id] * r.doc_tokens for r in got)
            used = Counter()
            for r in got:
                used[r.sequence_id] += r.length
            assert max(used.values()) <= 1024
        if name != "packing":
            docs, rows = result, texts
