"""Language bits, Merkle manifest and reversed search against plain Python, and on
nulls, empties, long texts, ties, repeated rows, empty tables and clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tessera.llm import language_bits as lb
from tessera.llm import lexical_search as ls
from tessera.llm import merkle_manifest as mm
from tessera.llm.common import table

CLASH = ["tree", "idx", "node", "row", "leaf", "claim", "proof", "item", "rank", "score", "n", "rate", "gram", "subroot", "root", "_pid"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------- languages ---
def test_languages_held_out(spark):
    docs = table(spark, SF_CHECK, "documents")
    got = {r.doc_id: r for r in lb.identify(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(got[r.doc_id].held_out for r in out) and sum(g.held_out for g in got.values()) == len(out)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in out) >= 0.99 * len(out)
    assert all(0 <= g.score <= 1 for g in got.values())


def test_filter_counts_equal_sets_after_correction():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 9000).astype(np.uint64)
    held = [set(pool[i * 2000:i * 2000 + 4000].tolist()) for i in range(3)]
    bits, k = 13, 2  # small on purpose: most cells are set
    cells = np.zeros((1 << bits, 1), np.uint8)
    for i, s in enumerate(held):
        for j in range(k):
            cells[lb.positions(np.array(list(s), np.uint64), j, bits), 0] |= 1 << i
    filled = np.unpackbits(cells, axis=1, count=3, bitorder="little").mean(axis=0)
    f = lb.LanguageFilter(["a", "b", "c"], bits, k, cells, filled ** k)
    raw = f.masks(pool).sum(axis=0)
    true = np.array([len(s & set(pool.tolist())) for s in held])
    assert (f.masks(np.array(sorted(held[1]), np.uint64))[:, 1] == 1).all()  # no false negatives
    fixed = (raw - len(pool) * f.false_rate) / (1 - f.false_rate)
    assert (raw - true > 1000).all() and np.abs(fixed - true).max() < 200


def test_pieces_give_the_grams_of_the_whole_text():
    rng = random.Random(2)
    text = "".join(rng.choice("aB é漢 ,.1\n") for _ in range(5000))
    flat = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
    flat = re.sub(" +", " ", flat)
    want = sum(max(0, len(flat) - n + 1) for n in lb.SIZES) - flat.count(" ")
    whole = np.sort(np.concatenate([lb.grams(cp, held) for cp, held in lb.spaced_pieces(text)]))
    assert len(whole) == want
    for size in (1, 2, 7, 1000):
        part = np.sort(np.concatenate([lb.grams(cp, held) for cp, held in lb.spaced_pieces(text, size)]))
        assert (part == whole).all()


def test_language_edge_cases(spark):
    rows = [(i, "the cat and the dog with " * (1 + i % 3), "en") for i in range(30)]
    rows += [(100 + i, "der hund und die katze mit " * (1 + i % 3), "de") for i in range(10)]
    rows += [(200, None, "en"), (201, "", None), (202, " 12 -- \n", "de"), (203, "αβγ", None), (None, "die katze", None),
             (204, "the dog", None), (204, "the dog", None), (205, "die katze und " * 60000 + "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in CLASH})
    got = collections.defaultdict(list)
    for r in lb.identify(docs).collect():
        got[r.doc_id].append((r.lang_pred, r.score, r.held_out))
    assert sum(map(len, got.values())) == len(rows)
    for i in (200, 201, 202):
        assert got[i][0][:2] == ("und", 0.0)
    assert got[203][0][:2] == ("en", 0.0)
    assert got[None] == [("de", got[None][0][1], False)] and got[205][0][0] == "de"
    assert len(got[204]) == 2 and got[204][0] == got[204][1] and got[204][0][0] == "en"
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lb.identify(unlabelled).collect()} == {"und"}
    assert lb.identify(docs.where("false")).count() == 0


# -------------------------------------------------------------- manifest ---
def brute_tree(leaves, fan=16):
    """Root and every leaf's proof [(left, right)...] of one tree."""
    proofs, level = [[] for _ in leaves], [(d, [i]) for i, d in enumerate(leaves)]
    while len(level) > 1:
        up = []
        for at in range(0, len(level), fan):
            run = level[at:at + fan]
            for p, (_, under) in enumerate(run):
                for i in under:
                    proofs[i].append(("".join(d for d, _ in run[:p]), "".join(d for d, _ in run[p + 1:])))
            up.append((H(*[d for d, _ in run]), [i for _, u in run for i in u]))
        level = up
    return level[0][0], proofs


def brute_manifest(rows):
    def leaf(r, lower=False):
        text = r[4].translate(str.maketrans(mm.UPPER, mm.LOWER)) if lower and r[4] is not None else r[4]
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)])

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0], leaf(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order]
    root, above = brute_tree([t[0] for t in trees])
    out = collections.Counter()
    for s, (sub, proofs), top in zip(order, trees, above):
        for (_, doc_id, d, r), own in zip(sorted(groups[s], key=lambda x: x[:3]), proofs):
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            acc = leaf(r, tampered)
            for left, right in own + top:
                acc = H(left, acc, right)
            out[(doc_id, d, sub, root, H(*[x for s_ in own + top for x in s_]), acc, acc == root)] += 1
    return out


def spark_manifest(docs):
    out = mm.verified_manifest(docs, tampered=mm.lowered_fifth())
    got = out.select("doc_id", "leaf", "subroot", "root", mm.proof_digest(F.col("proof")).alias("p"), "folded_root", "verified")
    return collections.Counter(map(tuple, got.collect()))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, None: 1, "": 17}, {"hot": 300, "b": 257, None: 2, "é": 16, "Z": 15}])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(rng.choice([None, rng.randrange(1 << 60)]) if i % 40 == 7 else i * 31, s, rng.choice([None, "en"]),
             rng.choice([None, 5]), rng.choice([None, "", "Some TEXT Ä " * (i % 5), "plain"]))
            for s, n in sizes.items() for i in range(n)]
    rows += rows[:3]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in CLASH}).repartition(5)
    assert spark_manifest(docs) == brute_manifest(rows)
    assert spark_manifest(docs.where("false")) == {}


def test_manifest_many_groups_and_a_long_text(spark):
    rows = [(i, f"s{i % 300}", "en", i, "Long TEXT " * (50000 if i == 5 else 1)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert spark_manifest(docs) == brute_manifest(rows)


# ---------------------------------------------------------------- search ---
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(mm.UPPER, mm.LOWER)))


def brute_search(docs, items, top):
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = collections.Counter()
    for item_id, text in set(items):
        ranked = []
        for doc_id, c in counts:
            if c:
                m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if c[t])
                if s > 0:
                    ranked.append((-s, doc_id is None, doc_id))
        for rank, (s, _, doc_id) in enumerate(sorted(ranked, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out[(item_id, rank, doc_id, -s)] += 1
    return out


@pytest.mark.parametrize("block_bytes", [8_000_000, 60])
def test_search_equals_brute_force(spark, block_bytes):
    rng = random.Random(9)
    word = [f"W{i}" for i in range(30)] + ["Äx", "the", "the", "漢字", "a_b"]
    docs = [(i, " ,".join(rng.choice(word) for _ in range(rng.randrange(40)))) for i in range(150)]
    docs += [(1000 + i, "w1 w2 w2 the") for i in range(40)]  # ties
    docs += [(2000, None), (2001, ""), (2002, "-- !"), (None, "w1 w2 w2 the"), (7, docs[7][1]), (3000, "w3 " * 400000 + "tail")]
    items = [(1, "W1 w2 the"), (2, "the THE the äX"), (3, None), (4, ""), (5, "unknown words"), (None, "w5 漢字"), (1, "W1 w2 the"),
             (6, "tail W3"), (7, " ".join(word) * 3)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASH}).repartition(7)
    q = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in CLASH})
    got = collections.Counter(map(tuple, ls.search(d, q, top=20, block_bytes=block_bytes).collect()))
    assert got == brute_search(docs, items, 20)
    assert ls.search(d.where("false"), q).count() == 0 and ls.search(d, q.where("false")).count() == 0


def test_index_scores_are_whole_numbers_beyond_doubles():
    index = ls.ItemIndex.of(["a a b", "b"])
    got = index.scores(np.array([0, 1]), np.array([(1 << 60) + 1, 3], np.int64))
    assert got.tolist() == [2 * ((1 << 60) + 1) + 3, 3]
