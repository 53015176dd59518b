"""Operators keep what they once cut: one test for each place."""

import math
import random

from tessera.llm import html_main, recompression, toxicity_kernel
from tessera.llm.quality_zstd import score_quality
from tessera.llm.sampling import labelled_sample

BODY = "text of the article " * 50


def test_html_vote_holds_title_lead_and_all_sections(spark):
    article = (f"<article><header><h1>Title</h1></header><div class=lead><p>Lead</p></div><div class=body><p>{BODY}</p></div>"
               "<section class=more><div><p>Second</p></div></section><div class=end><p>End</p></div></article>")
    html = f"<html><body><div class=top><a href='/'>Home of the site</a></div>{article}<p>bottom</p></body></html>"
    pages = spark.createDataFrame([(i, f"http://h.com/{i}", html) for i in range(3)], "page_id long, url string, html string")
    assert html_main.best_path(html_main.blocks(html)) == "html/body/article"
    for r in html_main.extract_main_text(pages).collect():
        assert r.text == f"Title Lead {BODY.strip()} Second End"
    plain = f"<body><div class=c><div class=t><h1>Title</h1></div><div class=b><p>{BODY}</p></div></div><div><a href='/'>Home of the site</a></div>"
    assert html_main.extract(plain, None) == f"Title {BODY.strip()}"


def test_html_noise_words_inside_an_article():
    html = ("<article><header class=header><h1 id=share-prices>Share prices</h1></header><h2 class=section-header>Head</h2>"
            "<p class=legal>Legal</p><section id=related-work><p>Related</p></section><div id=social-history>History "
            "<span class=share-price>12</span></div><figure><img src='x'><figcaption>Caption</figcaption></figure>"
            "<p>so <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>tex</annotation></math> holds</p>"
            "<div class='x comments'>no</div><div class=share>no</div><p hidden>no</p></article>")
    assert html_main.extract(html, None) == "Share prices Head Legal Related History 12 Caption so E=m holds"
    assert html_main.extract("<div class=share-bar>no</div><h2 id=legal-notice>Yes</h2><p class=copyright>no</p>", None) == "Yes"


def test_html_rarer_template_keeps_its_article(spark):
    common = f"<body><div class=content><p>{BODY}</p></div><p><a href='/'>Home of the site</a></p></body>"
    rare = f"<body><div class=content><p>Teaser</p></div><main><h1>Title</h1><p>{BODY}</p></main></body>"
    alone = f"<body><div class=content><p>Teaser</p></div><div class=story><p>{BODY}</p></div></body>"
    rows = [(i, "http://h.com/", common) for i in range(50)] + [(50 + i, "http://h.com/", rare) for i in range(5)]
    pages = spark.createDataFrame([*rows, (55, "http://h.com/", alone)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_main.extract_main_text(pages).collect()}
    assert [got[0], got[50], got[55]] == [BODY.strip(), f"Title {BODY.strip()}", f"Teaser {BODY.strip()}"]
    lead = f"<body><main><p>Lead</p><article><p>{BODY}</p></article></main></body>"
    assert html_main.extract(lead, ["body/main/article"]) == f"Lead {BODY.strip()}"
    page = f"<body><p>Top</p><div class=a>{BODY}</div></body>"
    assert html_main.extract(page, ["body/div.a", "body"]) == f"Top {BODY.strip()}"


def test_toxicity_fit_sees_what_stands_late_in_a_long_word():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(6))
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(400)) for _ in range(n))
    glued = [(i, "/".join([*(word() for _ in range(6)), "blockhead" if i % 3 == 0 else word(), word()]), int(i % 3 == 0))
             for i in range(240)]
    unspaced = [(i, han(40) + ("\u767d\u75f4" if i % 3 == 0 else han(2)) + han(rng.randrange(30)), int(i % 3 == 0))
                for i in range(240)]
    for rows, plain in ((glued, "blockhead"), (unspaced, "\u767d\u75f4")):
        model = toxicity_kernel.fit(rows[:180])
        value = toxicity_kernel.ValueCache(model).score([t for _, t, _ in rows[180:]] + [plain])
        score = [1 / (1 + math.exp(-(model.slope * v + model.intercept))) for v in value]
        assert [s >= 0.7 for s in score] == [y == 1 for _, _, y in rows[180:]] + [True]
    model = toxicity_kernel.fit([(i, " ".join([*(word() for _ in range(6)), "blockhead" if i % 3 == 0 else word()]), int(i % 3 == 0))
                                 for i in range(180)])
    assert model.spans == ()


def test_longest_text_of_the_sample_is_a_parameter(spark):
    docs = spark.createDataFrame([(1, "a" * 900), (2, "b" * 100), (4, "c" * 100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in (1, 2, 4)], "doc_id long, quality int, toxic int")
    take = lambda **how: {i for i, _, _ in labelled_sample(docs, labels, "toxic", 10, 1000, held_out_fold=3, **how)}
    assert take() == {2, 4} and take(max_text_bytes=1000) == {1, 2, 4}
    for score in (score_quality, toxicity_kernel.score_toxicity):
        assert score(docs, labels, max_text_bytes=1000).count() == 3


def test_repeats_of_large_ids_beside_a_null_id(spark):
    copy, big = " ".join(f"k{i}" for i in range(40)), 2 ** 53
    docs = spark.createDataFrame([(None, copy), (big, copy), (big + 1, copy)], "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.doc_id: r.n_removed for r in recompression.remove_repeats(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {None: 0, big: 0, big + 1: 40}
