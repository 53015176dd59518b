"""Every operator on tables whose further columns bear the operators' own inner names."""

import collections
import pathlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import tessera.llm
from tessera.llm import common
from tessera.llm.cover_tree import near_duplicate_vectors
from tessera.llm.decision_list import quality_rules
from tessera.llm.html_main import extract_main_text
from tessera.llm.language_bits import identify
from tessera.llm.lexical_search import search
from tessera.llm.merkle_manifest import lowered_fifth, verified_manifest
from tessera.llm.mixing import mixed_documents, systematic_mix
from tessera.llm.ngram_join import jaccard_classes, one_of_each, shingles
from tessera.llm.packing import pack_documents
from tessera.llm.quality_zstd import keep_good, score_quality
from tessera.llm.recompression import remove_repeats, without_repeats
from tessera.llm.toxicity_kernel import score_toxicity
from tessera.llm.url_templates import judge_urls

#: Every name that the operators give a column of their own.
INNER = sorted({n for f in pathlib.Path(tessera.llm.__file__).parent.glob("*.py")
                for n in re.findall(r'(?:alias|withColumn|withColumnRenamed)\(\s*"(\w+)"', f.read_text())})
OWN = {"doc_id", "text", "source", "lang", "n_chars", "page_id", "url", "html", "vec_id", "embedding", "label", "item_id", "quality", "toxic"}
TEXT = " ".join(f"word{i}" for i in range(40))


def crowded(df):
    return df.withColumns({n: F.lit(7) for n in INNER if n not in df.columns and n not in OWN})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, TEXT, "a", "en", 5), (2, TEXT, "b", "en", 5), (3, TEXT + " more", "a", "de", 5), (4, "other words here", None, None, 5),
            (5, None, "a", None, None), (None, "", "b", "en", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")


def rows_of(df):
    return collections.Counter(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("run", [
    lambda d, y: pack_documents(d).select("doc_id", "start", "length", "ids_crc32", "doc_tokens"),
    lambda d, y: score_quality(d, y),
    lambda d, y: remove_repeats(d).drop("row"),
    lambda d, y: score_toxicity(d, y),
    lambda d, y: jaccard_classes(d)[0],
    lambda d, y: systematic_mix(d),
    lambda d, y: quality_rules(d, y)[0].select("doc_id", "n_words", "base_failed", "kept"),
    lambda d, y: identify(d),
    lambda d, y: verified_manifest(d, tampered=lowered_fifth()),
    lambda d, y: search(d, d.select(F.col("doc_id").alias("item_id"), "text")),
], ids=["pack", "quality", "repeats", "toxicity", "jaccard", "mix", "rules", "language", "manifest", "search"])
def test_same_result_beside_clashing_columns(docs, labels, run):
    assert rows_of(run(crowded(docs), labels)) == rows_of(run(docs, labels))


@pytest.mark.parametrize("stage", [lambda d, y: keep_good(d, y), lambda d, y: one_of_each(d, n=5, percent=80),
                                   lambda d, y: without_repeats(d), lambda d, y: mixed_documents(d)],
                         ids=["quality", "near", "passages", "mix"])
def test_stages_keep_clashing_columns(docs, labels, stage):
    wide = crowded(docs)
    got = stage(wide, labels)
    assert got.columns == wide.columns
    assert rows_of(got.select(*docs.columns)) == rows_of(stage(docs, labels))
    assert got.where(" OR ".join(f"`{n}` <> 7 OR `{n}` IS NULL" for n in wide.columns if n not in OWN)).count() == 0
    assert stage(wide.where("false"), labels).columns == wide.columns


def test_pages_and_vectors_beside_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", f"<article><p>{TEXT}</p></article>"), (2, None, None)],
                                  "page_id long, url string, html string")
    for run in (extract_main_text, judge_urls):
        names = run(pages).columns
        assert rows_of(run(crowded(pages)).select(*names)) == rows_of(run(pages))
    vectors = spark.createDataFrame([(i, [1.0, float(i % 2)], 1) for i in range(6)], "vec_id long, embedding array<double>, label int")
    assert rows_of(near_duplicate_vectors(crowded(vectors))) == rows_of(near_duplicate_vectors(vectors))


def test_hashed_words_are_those_of_single_words():
    texts = [None, "", " \t\n", "a b  a\x0bA", " x  y", "ß\rß", "w " * 1000]
    for lower in (False, True):
        h, n = common.hashed_words(texts, lower)
        words = [(t or "").encode().lower().split() if lower else (t or "").encode().split() for t in texts]
        assert n.tolist() == [len(w) for w in words]
        assert h.tolist() == [common.xxhash.xxh3_64_intdigest(x) for w in words for x in w]
    import pyarrow as pa
    column = pa.array(texts)
    for limit in (1, 5, 10 ** 6):
        parts = list(common.column_chunks(column, limit))
        assert [t for _, _, p in parts for t in p] == texts and [a for a, _, _ in parts] == [0, *[b for _, b, _ in parts[:-1]]]
    assert list(common.column_chunks(pa.array([], pa.string()))) == []
    assert [len(s) for s in shingles(["a b", None, "a b c d e", "A B"], 4)] == [1, 0, 2, 1]
    assert np.array_equal(*[shingles([t], 4)[0] for t in ("a b", "A B")])
