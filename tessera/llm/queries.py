"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table
from tessera.llm.cover_tree import NEAR_SQL, near_duplicate_vectors
from tessera.llm.decision_list import quality_rules
from tessera.llm.html_main import extract_main_text
from tessera.llm.language_bits import identify
from tessera.llm.lexical_search import SEARCH_SQL, search
from tessera.llm.merkle_manifest import MANIFEST_SQL, lowered_fifth, proof_digest, verified_manifest
from tessera.llm.mixing import MIX_SQL, systematic_mix
from tessera.llm.ngram_join import JACCARD_SQL, jaccard_classes
from tessera.llm.packing import pack_documents
from tessera.llm.quality_zstd import score_quality
from tessera.llm.recompression import REPEATS_SQL, remove_repeats
from tessera.llm.toxicity_kernel import score_toxicity
from tessera.llm.url_templates import judge_urls


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), max_tokens=1024, max_segments=64)


def op2_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_quality_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated 13-word windows remove from every document."""
    return remove_repeats(table(spark, sf_dir, "documents"), window=13).drop("kept", "row")


def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_adaptive_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    classes, _ = jaccard_classes(table(spark, sf_dir, "documents"))
    return classes


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    mixed = systematic_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rule and learned verdict for every document."""
    judged, _ = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and classes of all embeddings."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op11_language_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return identify(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, folded from a tampered leaf
    where 5 divides the id's crc32."""
    out = verified_manifest(table(spark, sf_dir, "documents"), tampered=lowered_fifth())
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                      "folded_root", "verified")


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


QUERIES = {
    "op1_vector_packing": op1_vector_packing,
    "op2_host_consensus": op2_host_consensus,
    "op3_quality_zstd": op3_quality_zstd,
    "op4_recompression": op4_recompression,
    "op5_string_kernel": op5_string_kernel,
    "op6_adaptive_prefix": op6_adaptive_prefix,
    "op7_systematic_mix": op7_systematic_mix,
    "op8_url_templates": op8_url_templates,
    "op9_decision_list": op9_decision_list,
    "op10_cover_tree": op10_cover_tree,
    "op11_language_bits": op11_language_bits,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_reversed_search": op13_reversed_search,
}

ORACLE = {
    "op4_recompression": "WITH " + REPEATS_SQL.format(docs="documents") + """
SELECT doc_id, n_words, n_removed, sha256(kept) AS kept_sha256 FROM deduped""",
    "op6_adaptive_prefix": JACCARD_SQL,
    "op10_cover_tree": NEAR_SQL,
    "op7_systematic_mix": "WITH " + MIX_SQL.format(docs="documents") + """
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed""",
    "op12_merkle_manifest": MANIFEST_SQL,
    "op13_reversed_search": SEARCH_SQL,
}
