"""Tokenizers of the TF-IDF vectorizers as array-valued Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.patterns import TOKEN_PATTERN
from tessera.functions.text import split_words


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def word_tokens(c) -> Column:
    """Runs of two or more word characters, case kept."""
    return F.regexp_extract_all(_col(c), F.lit(TOKEN_PATTERN), 0)


def _joiner(tok: Column, n: int):
    # F.transform inspects the lambda's arity, so bind n by closure.
    return lambda i: F.array_join(F.slice(tok, i, n), " ")


def word_ngrams(tokens, lo: int = 1, hi: int = 2) -> Column:
    """All n-grams for n in [lo, hi] over a token array, joined by one space
    (unigrams first, then bigrams, ...)."""
    tok = _col(tokens)
    n_tok = F.size(tok)
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(tok)
            continue
        grams = F.transform(F.sequence(F.lit(1), n_tok - n + 1), _joiner(tok, n))
        parts.append(F.when(n_tok >= n, grams).otherwise(_empty_strings()))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_wb_ngrams_of_word(word, lo: int = 3, hi: int = 5) -> Column:
    """Character n-grams of one word padded by a space on each side.

    A padded word shorter than ``lo`` is emitted whole, once; n-grams longer
    than the padded word are skipped.
    """
    p = F.concat(F.lit(" "), _col(word), F.lit(" "))
    plen = F.char_length(p)
    grams = F.flatten(F.transform(
        F.sequence(F.lit(lo), F.least(F.lit(hi), plen)),
        lambda n: F.transform(F.sequence(F.lit(1), plen - n + 1), lambda i: p.substr(i, n)),
    ))
    return F.when(plen < lo, F.array(p)).otherwise(grams)


def char_wb_ngrams(c, lo: int = 3, hi: int = 5) -> Column:
    """Character n-grams inside whitespace-separated words (``char_wb``)."""
    return F.flatten(F.transform(split_words(c), lambda w: char_wb_ngrams_of_word(w, lo, hi)))


def char_wb_gram_count(word, lo: int = 3, hi: int = 5) -> Column:
    """Number of char_wb n-grams of one word (padded length L: one gram when
    L < lo, else the sum of L - n + 1 over n in [lo, min(hi, L)])."""
    L = F.char_length(_col(word)) + 2
    total = F.greatest(L - lo + 1, F.lit(0))
    for n in range(lo + 1, hi + 1):
        total = total + F.greatest(L - n + 1, F.lit(0))
    return F.when(L < lo, F.lit(1)).otherwise(total)


def char_wb_gram_at(word, k, lo: int = 3, hi: int = 5) -> Column:
    """The k-th (0-based) char_wb n-gram of one word, in the order of
    ``char_wb_ngrams_of_word``: plain arithmetic and ``substring`` (whole-stage
    codegen) instead of a lambda per gram.  Pair with
    ``explode(sequence(0, char_wb_gram_count(word) - 1))``."""
    p = F.concat(F.lit(" "), _col(word), F.lit(" "))
    L = F.char_length(_col(word)) + 2
    k = _col(k)
    n_expr = i_expr = None
    off = F.lit(0)
    for n in range(lo, hi + 1):
        c = F.greatest(L - n + 1, F.lit(0))
        inside = k < off + c
        n_expr = F.when(inside, F.lit(n)) if n_expr is None else n_expr.when(inside, F.lit(n))
        i_expr = F.when(inside, k - off + 1) if i_expr is None else i_expr.when(inside, k - off + 1)
        off = off + c
    n_col = F.when(L < lo, L).otherwise(n_expr)
    i_col = F.when(L < lo, F.lit(1)).otherwise(i_expr)
    return F.substring(p, i_col, n_col)


def word_gram_count(tokens, lo: int = 1, hi: int = 2) -> Column:
    """Number of word n-grams (n in [lo, hi]) of a token array."""
    n_tok = F.size(_col(tokens))
    total = F.greatest(n_tok - lo + 1, F.lit(0))
    for n in range(lo + 1, hi + 1):
        total = total + F.greatest(n_tok - n + 1, F.lit(0))
    return total


def word_gram_at(tokens, k, lo: int = 1, hi: int = 2) -> Column:
    """The k-th (0-based) word n-gram in the order of ``word_ngrams``
    (all unigrams, then bigrams, ...), by arithmetic on k and a ``slice``:
    pair with ``explode(sequence(0, word_gram_count(tokens) - 1))``."""
    tok = _col(tokens)
    n_tok = F.size(tok)
    k = _col(k)
    n_expr = i_expr = None
    off = F.lit(0)
    for n in range(lo, hi + 1):
        c = F.greatest(n_tok - n + 1, F.lit(0))
        inside = k < off + c
        n_expr = F.when(inside, F.lit(n)) if n_expr is None else n_expr.when(inside, F.lit(n))
        i_expr = F.when(inside, k - off + 1) if i_expr is None else i_expr.when(inside, k - off + 1)
        off = off + c
    return F.array_join(F.slice(tok, i_expr, n_expr), " ")
