"""Text-function goldens (FIXTURES §3) and edge cases."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions.tokens import char_wb_ngrams, word_ngrams, word_tokens

GOLDEN = [
    ("Hi @Bob_1!!!! see HTTP://x.y #Tag??? ok", "hi USER !! see URL tag ?? ok",
     "Hi @Bob_1!!!! see http #Tag??? ok"),
    ("WWW.a.b,,,, . . ...x #é1 @ñ#b", "URL . . ..x é1 USER b", "http . . ...x #é1 @ñ#b"),
    ("a http b www. c", "a http b www. c", "a http b http c"),
    ("  Mixed\tCase text  ", "mixed case text", "Mixed Case text"),
    ("email me a@b.com, or @x,", "email me a USER .com, or USER ,", "email me a@b.com, or @x,"),
    ("@Bob @bob, https://t.co/x ftp://y httpfoo Www.z", "USER USER , URL ftp://y URL URL",
     "@user @bob, http ftp://y httpfoo http"),
]


def _one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(expr(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize("src,norm,pre", GOLDEN)
def test_normalize_and_mentions(spark, src, norm, pre):
    assert _one(spark, src, tx.normalize_text) == norm
    assert _one(spark, src, tx.preprocess_mentions_links) == pre


def test_sanitize_reference_terms(spark):
    assert _one(spark, "Two BITCHES @Al HTTP://q http://z whoever", tx.sanitize_text) == \
        "Two b****ES @USER HTTP://q URL wh**ver"
    assert _one(spark, "Illegals  are illegal", tx.sanitize_text) == "i******* are i******"


def test_sanitize_cuts_to_170_code_points(spark):
    out = _one(spark, "é" * 400, tx.sanitize_text)
    assert out == "é" * 170


def test_null_text_becomes_empty(spark):
    df = spark.createDataFrame([(None,), ("NA",)], "t string")
    got = [r[0] for r in df.select(tx.clean_text("t")).collect()]
    assert got == ["", "NA"]


def test_char_ngrams_short_words(spark):
    assert _one(spark, "a", lambda c: char_wb_ngrams(c, 3, 5)) == [" a "]
    assert sorted(_one(spark, "ab", lambda c: char_wb_ngrams(c, 3, 5))) == sorted([" ab", "ab ", " ab "])


def test_char_ngrams_match_python_rule(spark):
    def ref(text, lo, hi):
        out = []
        for w in text.split():
            w = " " + w + " "
            for n in range(lo, hi + 1):
                off = 0
                out.append(w[off:off + n])
                while off + n < len(w):
                    off += 1
                    out.append(w[off:off + n])
                if off == 0:
                    break
        return out
    text = "hello a  wonderful x ab world zz"
    for lo, hi in ((3, 5), (3, 6), (4, 6)):
        assert _one(spark, text, lambda c: char_wb_ngrams(c, lo, hi)) == ref(text, lo, hi)


def test_word_tokens_and_ngrams(spark):
    assert _one(spark, "a USER .com it", word_tokens) == ["USER", "com", "it"]
    got = _one(spark, "aa bb cc", lambda c: word_ngrams(word_tokens(c), 1, 3))
    assert got == ["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"]
    assert _one(spark, "aa", lambda c: word_ngrams(word_tokens(c), 1, 2)) == ["aa"]


def test_preprocess_auto_dispatch(spark):
    hub = "cardiffnlp/twitter-roberta-base-dec2021-hate"
    local = "outputs/transformer_ft_dec2021/checkpoint-2252"
    assert tx.is_cardiff_model(hub) and not tx.is_cardiff_model(local)
    src = "@Bob https://t.co/x"
    assert _one(spark, src, lambda c: tx.preprocess_auto(c, hub)) == "@user http"
    assert _one(spark, src, lambda c: tx.preprocess_auto(c, local)) == src
    assert _one(spark, local, tx.model_slug) == "outputs_transformer_ft_dec2021_checkpoint_2252"
    df = spark.createDataFrame([(src, hub), (src, local)], "t string, m string")
    got = [r[0] for r in df.select(tx.preprocess_auto("t", F.col("m"))).collect()]
    assert got == ["@user http", src]


def test_augment_edges(spark):
    df = spark.createDataFrame([(1, "one"), (2, ""), (3, "a b c d e f")], "k long, t string")
    rows = {r.k: (r.s, r.d) for r in df.select("k", tx.augment_swap("t", "k").alias("s"),
                                                 tx.augment_dropout("t", "k", p=1.0).alias("d")).collect()}
    assert rows[1] == ("one", "one")          # one word: unchanged; all dropped -> original
    assert rows[2] == ("", "")
    s = rows[3][0].split()
    assert sorted(s) == list("abcdef") and sum(a != b for a, b in zip(s, "abcdef")) == 2
