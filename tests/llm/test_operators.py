"""Operators against brute force, and on nulls, empties, ties, repeated rows,
empty tables and clashing column names."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import cover_tree, decision_list, html_main, packing, recompression, toxicity_kernel
from tessera.llm.common import table
from tessera.llm.mixing import mixed_documents, systematic_mix
from tessera.llm.ngram_join import differing, jaccard_classes, one_of_each, parities
from tessera.llm.quality_zstd import score_quality
from tessera.llm.toxicity_kernel import score_toxicity
from tessera.llm.url_templates import judge_urls

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(30000))
COPY = " ".join(f"k{i}" for i in range(40))
EDGE = [(1, None, "s1"), (2, "", "s1"), (3, " \t\n", None), (4, LONG, "s2"), (5, COPY, "s1"), (6, COPY, None),
        (6, COPY, None), (7, COPY + " tail end", "s2"), (8, "x x x", "s1"), (None, COPY, "s2"), (9, "Ä  ö\x85 <|endoftext|>", None)]
CLASH = ["size", "score", "n", "rank", "target", "label", "anchor", "row"]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, source string")
    return df.withColumns({c: F.lit(1) for c in CLASH})


@pytest.fixture(scope="module")
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (5, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")


def test_packing_round_trip(spark, edge, empty):
    rows = packing.pack_documents(edge).collect()
    tok = packing.CachedEncoder(packing.default_tokenizer()).tok
    want = collections.Counter()
    for doc_id, text, _ in EDGE:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at:at + 1024]
            want[(doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(empty).count() == 0
    full = packing.packed_sequences(edge).collect()
    assert all(len(r.input_ids) in (1024, r.n_tokens) for r in full)


def test_packing_keeps_large_ids_beside_a_null(spark):
    rows = [(None, "a b"), ((1 << 53) + 1, "c"), ((1 << 53) + 3, "d e f"), ((1 << 62) + 7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(docs).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows} and len(got) == 4
    assert sorted((r.offset, r.length) for r in got)[0][0] == 0 and len({r.sequence_id for r in got}) == 1


def test_every_entry_arises_from_its_own_bytes():
    """By the listed merges alone, lowest first, each entry's symbols become it."""
    import base64
    import json

    with open(packing.default_tokenizer()) as f:
        model = json.load(f)["model"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    rank = {p: i for i, p in enumerate(pairs)}
    assert [model["vocab"][a + b] for a, b in pairs] == sorted(model["vocab"][a + b] for a, b in pairs)
    for a, b in pairs:
        symbols = list(a + b)
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=lambda p: rank.get(p, len(rank)))
            assert best in rank, (a, b)
            out, i = [], 0
            while i < len(symbols):
                if tuple(symbols[i:i + 2]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
    with open(packing.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
    plain = {t.encode(): i for t, i in model["vocab"].items() if t.isascii() and t.isprintable()}
    assert len(ranks) == len(model["vocab"]) and all(ranks[t] == i for t, i in plain.items())


@pytest.mark.parametrize("ranks", [None, packing.default_ranks()])
def test_cached_encoder_equals_the_tokenizer(ranks):
    enc = packing.CachedEncoder(packing.default_tokenizer(), ranks)
    rng = np.random.default_rng(11)
    parts = ["word", "Word", "it's", "don't", "x1", "12", ".", ",", "ä", "漢字", "\n", " ", " ", " ", "\n", "\t", "\r\n", "\x00", "\x85",
             "\u00a0", "<|endoftext|>", "!", "e\u0301", "\u200b", "'", "a" * 70]
    texts = ["", " ", "\n", "a", " a", "a ", "\na", "a\n", "a\nb", "a\n\nb", "a \nb", "a\n b", "a  b", "\x00 a", "a \x00b"]
    texts += ["".join(rng.choice(parts, rng.integers(1, 30))) for _ in range(3000)]
    enc.LIMIT = 500  # forget often
    for at in range(0, len(texts), 100):
        some = texts[at:at + 100]
        for t, ids in zip(some, enc.encode(some)):
            assert ids.tolist() == enc.tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_bins_respect_all_limits():
    rng = np.random.default_rng(3)
    demand = np.column_stack([rng.integers(1, 900, 500), np.ones(500, int), rng.integers(0, 400, 500)])
    limits = np.array([1024, 4, 700])
    bins, place = packing.fill_bins(demand, limits)
    for b in np.unique(bins):
        assert (demand[bins == b].sum(axis=0) <= limits).all()
        assert sorted(place[bins == b]) == list(range((bins == b).sum()))


def test_html_main_text():
    page = ("<html><head><title>t</title><script>a<b</script></head><body><nav>menu</nav><div class='ad x1'>buy</div>"
            "<article><h1>Head &amp; tail</h1><p>One<b>two</b> three<br>four<p>five<ul><li>six<li>seven</ul>"
            "<form>f</form><div class=comments>no</div><aside>s</aside></article><footer>foot</footer>")
    assert html_main.extract(page, ["html/body/article"]) == "Head & tail Onetwo three four five six seven"
    assert html_main.extract(None, None) == html_main.extract("", ["x"]) == ""
    assert html_main.extract("plain <unclosed", None) == "plain <unclosed"


def test_html_on_tables(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "http://h/x", ""), (3, "http://h/y", "<p>hi"), (3, "http://h/y", "<p>hi")],
                                  "page_id long, url string, html string")
    got = html_main.extract_main_text(pages).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "", 0), (2, "", 0), (3, "hi", 2), (3, "hi", 2)]
    assert html_main.extract_main_text(pages.where("false")).count() == 0


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
def test_scores_on_edges(edge, empty, labels, score):
    rows = score(edge, labels).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert score(empty, labels).count() == 0


def test_kernel_is_the_gapped_subsequence_kernel():
    def phi(w):
        w = f"^{w}^"
        out = collections.Counter()
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + 5)):
                    out[w[i] + w[j] + w[k]] += 0.5 ** (k - i - 2)
        return out

    a, b = ["idiot", "clown", "aa"], ["idxiot", "crown", "aaaa"]
    got = toxicity_kernel.kernel(a, b, 0.5)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            p, q = phi(x), phi(y)
            dot = sum(p[u] * q[u] for u in p)
            assert got[i, j] == pytest.approx(dot / np.sqrt(sum(v * v for v in p.values()) * sum(v * v for v in q.values())))


def _cut(rows, window=13):
    """Brute force of the repeated-window rule."""
    low = {}
    for i, t, _ in rows:
        w = WORDS.findall(t or "")
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                low[key] = min(low.get(key, i), i)
    out = []
    for i, t, _ in rows:
        w = WORDS.findall(t or "")
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if low[tuple(w[k:k + window])] < i:
                    gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_recompression_equals_brute_force(spark, edge, empty):
    got = recompression.remove_repeats(edge).collect()
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(_cut(EDGE), key=key)
    assert recompression.remove_repeats(empty).count() == 0


def test_recompression_on_random_runs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):  # few words, so runs, periods and chance repeats abound
        w = [str(x) for x in rng.integers(0, 3, rng.integers(0, 80))] + ["r"] * int(rng.integers(0, 30))
        rows.append((i, " ".join(w), None))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(tuple(r)[:4] for r in recompression.remove_repeats(df).collect()) == sorted(_cut(rows))


@pytest.mark.parametrize("sizes", [(1, 1), (3, 200), (64, 65), (500, 520), (2000, 5000)])
def test_parities_never_exceed_the_real_difference(sizes):
    rng = np.random.default_rng(sum(sizes))
    for share in (0.0, 0.5, 0.9, 1.0):
        x = rng.integers(0, 2**64, sizes[0], dtype=np.uint64)
        y = np.concatenate([x[:int(share * len(x))], rng.integers(0, 2**64, sizes[1], dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        assert differing(parities(x), parities(y)) <= len(np.setxor1d(x, y))
        assert differing(parities(x), parities(x)) == 0


def test_jaccard_classes_equal_brute_force(spark, edge, empty):
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(120)]
    rows = [(100 + k, " ".join(x if rng.random() > 0.01 * (k % 5) else f"z{rng.integers(99)}" for x in base), "s")
            for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").unionByName(
        edge.select("doc_id", "text", "source"))
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(df)[0].collect()}
    sets = {}
    for i, t, _ in rows + EDGE:
        w = [x.lower() for x in WORDS.findall(t or "")]
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    ids = [i for i in sets if i is not None]
    comp = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                x, y = sets[a], sets[b]
                if x and y and 100 * len(x & y) >= 85 * len(x | y):
                    comp[a] = comp[b] = min(comp[a], comp[b])
        if all(comp[comp[i]] == comp[i] for i in ids):
            break
    assert got == {(i, len(sets[i]), comp.get(i)) for i in sets}
    assert jaccard_classes(empty)[0].count() == 0
    assert one_of_each(edge).columns == edge.columns


def test_mix(edge, empty):
    rows = systematic_mix(edge).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.copies <= 2 for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * sum(r.size for r in rows)) < 1e-6 * 1e5
    assert systematic_mix(empty).count() == 0
    assert mixed_documents(edge).columns == edge.columns


def test_url_rules(spark):
    urls = ["https://A.Example.NET/en/x?q", "http://example.com/de/1", "http://b.org/fr/", "ftp://c.net", "no-scheme", None, "", "x://h#f"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in judge_urls(pages).collect()}
    assert got == {0: ("a.example.net", "/en/x", "example.net/en/"), 1: ("example.com", "/de/1", "example.com/de/"),
                   2: ("b.org", "/fr/", "org/fr/"), 3: ("c.net", "", None), 4: ("", "", None), 5: ("", "", None),
                   6: ("", "", None), 7: ("h", "", None)}
    assert judge_urls(pages.where("false")).count() == 0


def test_url_templates_reject_a_labelled_branch(spark):
    rows = [(i, f"http://h.com/bad/p{i}x{i}") for i in range(40)] + [(100 + i, f"http://h.com/good/q{i}.html") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marked = spark.createDataFrame([(f"http://h.com/bad/p{i}x{i}", "block") for i in range(10)]
                                   + [(f"http://h.com/good/q{i}.html", "allow") for i in range(10)], "url string, label string")
    got = {r.page_id: r.verdict for r in judge_urls(pages, labelled=marked).collect()}
    assert all(v == ("block" if i < 100 else "allow") for i, v in got.items())


def test_decision_list_counts(spark, edge, empty, labels):
    out, _ = decision_list.quality_rules(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    for r in out.collect():
        t = texts[r.doc_id] or ""
        w = WORDS.findall(t)
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        rep = {j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(k, k + 3)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep))
        assert r.base_failed == (len(w) < 50 or 100 * len(rep) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert decision_list.quality_rules(edge, labels)[0].count() == len(EDGE)
    assert decision_list.quality_rules(empty, labels)[0].count() == 0


def test_cover_tree_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 8))
    vec = [(i, int(i % 2), (centre[i % 6] + 0.09 * rng.normal(size=8)).tolist()) for i in range(200)]
    vec += [(300, 0, vec[0][2]), (301, None, vec[0][2]), (302, 0, None), (303, 0, [0.0] * 8), (304, 0, [float("nan")] * 8),
            (305, 0, [None] * 8), (306, 0, [1.0, 2.0]), (None, 0, vec[0][2])]
    df = spark.createDataFrame(vec, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
           cover_tree.near_duplicate_vectors(df, block_rows=40, max_centres=4).collect()}
    ok = [(i, lab, np.array(v)) for i, lab, v in vec if i is not None and lab is not None and v and None not in v
          and np.isfinite(v).all() and np.any(v)]
    comp = {i: i for i, _, _ in vec if i is not None}
    n = collections.Counter()
    links = [(a, b) for a, la, x in ok for b, lb, y in ok if a != b and la == lb and len(x) == len(y)
             and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98]
    for a, _ in links:
        n[a] += 1
    for _ in range(50):
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    for i, c in comp.items():
        assert got[i] == (n[i], c, i == c), i
    assert got[None] == (0, None, False)
    assert cover_tree.near_duplicate_vectors(df.where("false")).count() == 0
