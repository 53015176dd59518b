"""DuckDB SQL fragments that mirror the Spark column functions, used to
write the oracle queries.  RE2 has no back-references, so the repeated
punctuation rule becomes one replace per character."""

from __future__ import annotations

from tessera.functions.numeric import GRID_POINTS, GRID_START, GRID_STOP
from tessera.functions.patterns import (
    FULL_MENTION,
    HASHTAG_PATTERN,
    MENTION_PATTERN,
    TOKEN_PATTERN,
    URL_PATTERN,
    WS,
)
from tessera.functions.text import CARDIFF_MARKERS, REFERENCE_MASK_TERMS
from tessera.sources.corpus import SPLIT_SEED, TRAIN_BUCKETS, VALIDATION_BUCKETS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hash32(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 8)) AS BIGINT)"


def hash_uniform(expr: str) -> str:
    return f"({hash32(expr)} / 4294967296.0::DOUBLE)"


def split_of(key: str = "doc_id", seed: int = SPLIT_SEED) -> str:
    b = f"({hash32(f'{lit(str(seed) + chr(58))} || CAST({key} AS VARCHAR)')} % 100)"
    return (f"CASE WHEN {b} < {TRAIN_BUCKETS} THEN 'train' WHEN {b} < {VALIDATION_BUCKETS} "
            f"THEN 'validation' ELSE 'test' END")


def collapse_ws(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {lit(WS + '+')}, ' ', 'g'))"


def normalize(expr: str) -> str:
    t = f"lower({expr})"
    t = f"regexp_replace({t}, {lit(URL_PATTERN)}, ' URL ', 'gi')"
    t = f"regexp_replace({t}, {lit(MENTION_PATTERN)}, ' USER ', 'g')"
    t = f"regexp_replace({t}, {lit(HASHTAG_PATTERN)}, ' \\1 ', 'g')"
    for ch, esc in (("!", "!"), ("?", "\\?"), (".", "\\."), (",", ",")):
        t = f"regexp_replace({t}, {lit(esc + '{3,}')}, {lit(ch * 2)}, 'g')"
    return collapse_ws(t)


def sanitize(expr: str, terms=REFERENCE_MASK_TERMS, max_chars: int = 170) -> str:
    t = expr
    for term in terms:
        mask = term[:1] + "*" * max(1, len(term) - 1)
        t = f"regexp_replace({t}, {lit(term)}, {lit(mask)}, 'gi')"
    t = f"regexp_replace({t}, {lit(URL_PATTERN)}, 'URL', 'g')"
    t = f"regexp_replace({t}, {lit(MENTION_PATTERN)}, '@USER', 'g')"
    return f"substr({collapse_ws(t)}, 1, {max_chars})"


def split_words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {lit(WS + '+')}), lambda w: w <> '')"


def mentions_links(expr: str) -> str:
    body = (f"CASE WHEN regexp_matches(w, {lit(FULL_MENTION)}) THEN '@user' "
            f"WHEN regexp_matches(w, {lit('^(https?://|www\\.)')}, 'i') THEN 'http' ELSE w END")
    return f"array_to_string(list_transform({split_words(expr)}, lambda w: {body}), ' ')"


def is_cardiff(name_sql: str) -> str:
    return "(" + " OR ".join(f"contains(lower({name_sql}), {lit(m)})" for m in CARDIFF_MARKERS) + ")"


def tokens(expr: str) -> str:
    return f"regexp_extract_all({expr}, {lit(TOKEN_PATTERN)})"


def word_ngram_rows(src: str, text_expr: str, lo: int = 1, hi: int = 2) -> str:
    """SELECT doc_id, term rows (one per n-gram occurrence) from ``src``."""
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(f"SELECT doc_id, unnest(tok) AS term FROM tk")
        else:
            join = " || ' ' || ".join(f"tok[i + {k}]" for k in range(n))
            parts.append(f"SELECT doc_id, unnest(list_transform(range(1, len(tok) - {n - 2}), "
                         f"lambda i: {join})) AS term FROM tk")
    return (f"WITH tk AS (SELECT doc_id, {tokens(text_expr)} AS tok FROM {src}) "
            + " UNION ALL ".join(parts))


def char_ngram_rows(src: str, text_expr: str, lo: int = 3, hi: int = 5) -> str:
    """SELECT doc_id, term rows (one per char_wb n-gram occurrence)."""
    return f"""
    WITH cw AS (SELECT doc_id, unnest({split_words(text_expr)}) AS w FROM {src}),
    cp AS (SELECT doc_id, ' ' || w || ' ' AS p, length(w) + 2 AS plen FROM cw),
    cn AS (SELECT doc_id, p, plen,
                  unnest(CASE WHEN plen < {lo} THEN [plen] ELSE range({lo}, least({hi}, plen) + 1) END) AS n
           FROM cp),
    ci AS (SELECT doc_id, p, n, unnest(range(1, plen - n + 2)) AS i FROM cn)
    SELECT doc_id, substr(p, i, n) AS term FROM ci"""


def grid_value(i: str) -> str:
    step = f"((({GRID_STOP})::DOUBLE - ({GRID_START})::DOUBLE) / {GRID_POINTS - 1})"
    return f"(CASE WHEN ({i}) = {GRID_POINTS - 1} THEN ({GRID_STOP})::DOUBLE ELSE ({GRID_START})::DOUBLE + ({i}) * {step} END)"


def sigmoid(expr: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({expr}))))"
