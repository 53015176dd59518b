"""Text functions as native Column expressions (no Python UDFs).

All functions take and return ``Column`` so they compose inside one
projection, run in whole-stage codegen, and work on streaming DataFrames too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.patterns import (
    FULL_MENTION,
    HASHTAG_PATTERN,
    LINK_PREFIX,
    MENTION_PATTERN,
    URL_PATTERN,
    WS,
)
from tessera.functions.numeric import hash_uniform

# --- fixed values ----------------------------------------------------------
# Mask list of the reference's error-analysis sanitizer, in its order.
REFERENCE_MASK_TERMS = (
    "bitch", "bitches", "whore", "hoe", "illegals", "illegal", "womensuck",
    "buildthatwall", "buildthewall",
)
# Model-name markers that switch on the mention/link preprocessing.
CARDIFF_MARKERS = (
    "cardiffnlp/twitter-roberta-base",
    "cardiffnlp/twitter-roberta-large",
    "twitter-roberta-base-dec2021",
    "twitter-roberta-base-2021-124m",
    "twitter-roberta-base-hate",
    "twitter-roberta-base-hate-latest",
)
SANITIZE_MAX_CHARS = 170
DROPOUT_P = 0.15
# ----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Null text becomes the empty string; anything else is cast to string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def collapse_ws(c) -> Column:
    """Runs of whitespace to one space, then strip."""
    return F.trim(F.regexp_replace(_col(c), WS + "+", " "))


def normalize_text(c) -> Column:
    """Light tweet normalization: lower, URL, USER, hashtag unwrap,
    repeated punctuation cut to two, whitespace collapse."""
    t = F.lower(_col(c))
    t = F.regexp_replace(t, "(?i)" + URL_PATTERN, " URL ")
    t = F.regexp_replace(t, MENTION_PATTERN, " USER ")
    t = F.regexp_replace(t, HASHTAG_PATTERN, " $1 ")
    t = F.regexp_replace(t, r"([!?.,])\1{2,}", "$1$1")
    return collapse_ws(t)


def mask_term(c, term: str) -> Column:
    """Case-insensitive substring mask: first letter of the term, then stars."""
    mask = term[:1] + "*" * max(1, len(term) - 1)
    return F.regexp_replace(_col(c), "(?iu)" + re.escape(term), mask.replace("$", r"\$"))


def sanitize_text(c, terms: Sequence[str] = REFERENCE_MASK_TERMS,
                  max_chars: int = SANITIZE_MAX_CHARS) -> Column:
    """Mask terms (in list order), URL -> ``URL`` (case-sensitive),
    mention -> ``@USER``, collapse whitespace, cut to ``max_chars``."""
    t = _col(c)
    for term in terms:
        t = mask_term(t, term)
    t = F.regexp_replace(t, URL_PATTERN, "URL")
    t = F.regexp_replace(t, MENTION_PATTERN, "@USER")
    t = collapse_ws(t)
    return F.substring(t, 1, max_chars)


def split_words(c) -> Column:
    """Whitespace split without empty strings (Python ``str.split()``)."""
    return F.filter(F.split(_col(c), WS + "+"), lambda w: w != "")


def preprocess_mentions_links(c) -> Column:
    """Token-wise: a token that is a whole mention -> ``@user``; a token that
    starts with a link prefix -> ``http``; joined by single spaces."""
    out = F.transform(
        split_words(c),
        lambda w: F.when(w.rlike(FULL_MENTION), F.lit("@user"))
        .when(w.rlike(LINK_PREFIX), F.lit("http"))
        .otherwise(w),
    )
    return F.array_join(out, " ")


def is_cardiff_model(model_name: str) -> bool:
    lower = model_name.lower()
    return any(m in lower for m in CARDIFF_MARKERS)


def is_cardiff_model_col(c) -> Column:
    """Column form of the marker test, for a column of model names."""
    lower = F.lower(_col(c))
    test = F.lit(False)
    for m in CARDIFF_MARKERS:
        test = test | lower.contains(m)
    return test


def preprocess_auto(c, model_name, style: str = "auto") -> Column:
    """Style ``cardiff`` / ``none`` / ``auto``; auto applies the mention/link
    preprocessing when the model name carries a known marker.

    ``model_name`` may be a Python string (decided on the driver) or a Column.
    """
    if style == "cardiff":
        return preprocess_mentions_links(c)
    if style == "none":
        return _col(c)
    if style != "auto":
        raise ValueError(f"unknown preprocess style: {style}")
    if isinstance(model_name, str):
        return preprocess_mentions_links(c) if is_cardiff_model(model_name) else _col(c)
    return F.when(is_cardiff_model_col(model_name), preprocess_mentions_links(c)).otherwise(_col(c))


def model_slug(c) -> Column:
    """``/`` and ``-`` become ``_``."""
    return F.translate(_col(c), "/-", "__")


def text_length(c) -> Column:
    """Length in Unicode code points."""
    return F.char_length(_col(c))


def augment_dropout(c, key, seed: int = 42, p: float = DROPOUT_P) -> Column:
    """Drop each word with probability ``p``; keep the original text when
    every word is dropped.  The draw for word ``i`` of row ``key`` is a hash
    uniform of ``seed:key:i``, so reruns and engines agree."""
    key = _col(key)
    kept = F.filter(
        split_words(c),
        lambda w, i: hash_uniform(F.concat(F.lit(f"{seed}:"), key.cast("string"),
                                           F.lit(":"), i.cast("string"))) > F.lit(p),
    )
    return F.when(F.size(kept) > 0, F.array_join(kept, " ")).otherwise(_col(c))


def augment_swap(c, key, seed: int = 42) -> Column:
    """Swap one adjacent pair chosen by a hash draw of ``seed:key``; texts of
    fewer than two words are only re-joined."""
    words = split_words(c)
    n = F.size(words)
    u = hash_uniform(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    idx = F.floor(u * (n - 1)).cast("int")  # 0-based, in [0, n-2]
    # Slices instead of a per-element lookup: referencing ``words`` inside a
    # lambda would re-split the text for every element.
    swapped = F.concat(
        F.slice(words, F.lit(1), idx),
        F.array(F.element_at(words, idx + 2), F.element_at(words, idx + 1)),
        F.slice(words, idx + 3, F.greatest(n - idx - 2, F.lit(0))),
    )
    return F.when(n > 1, F.array_join(swapped, " ")).otherwise(F.array_join(words, " "))
