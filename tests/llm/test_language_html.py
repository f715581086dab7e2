import re

import numpy as np
import pytest

from molspark.llm import html, html_labelled, language

LINES = {"en": "the cat and the dog went to the house with them", "de": "der hund und die katze gehen nicht in das haus",
         "fr": "le chat et le chien sont dans la maison avec nous"}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i * 3 + j, text, lang) for i in range(20) for j, (lang, text) in enumerate(LINES.items())]
    rows += [(900, None, "en"), (901, "xx", None), (None, "the house", "en")]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_known_words_and_backoff(model):
    scorer = language.Scorer(model)
    assert scorer.predict("The dog!")[0] == "en"
    assert scorer.predict("HUND und Katze")[0] == "de"
    assert "katzenhaus" not in model.words and scorer.predict("katzenhaus")[0] == "de"  # from its n-grams


def test_undetermined_and_odd_texts(model):
    scorer = language.Scorer(model)
    for text in (None, "", "123 !? ½ \n", "_ - 4"):
        assert scorer.predict(text) == ("und", 0.0)
    said, score = scorer.predict("日本語")
    assert said in LINES and 0 < score <= 1  # has letters, so some learned language
    assert scorer.predict("der hund " * 200_000)[0] == "de"


def test_memory_starts_anew(model):
    scorer = language.Scorer(model, most=3)
    assert [scorer.predict(t)[0] for t in list(LINES.values()) * 2] == list(LINES) * 2


def test_identify_keeps_rows_and_replaces_columns(spark, model):
    df = spark.createDataFrame([(1, LINES["fr"], "x", 1), (1, LINES["fr"], "x", 1), (2, None, "x", 1)],
                               "doc_id long, text string, lang_pred string, _said int")
    got = sorted(map(tuple, language.identify(df, model).select("doc_id", "lang_pred", "_said").collect()))
    assert got == [(1, "fr", 1), (1, "fr", 1), (2, "und", 1)]
    kept = language.accept(df, model)
    assert kept.columns == df.columns and kept.count() == 2
    assert language.identify(df.limit(0), model).count() == 0


def test_accept_lets_the_model_decide(spark, model):
    rows = [(1, "Привет как дела это совсем другой язык и другая письменность"), (2, "Привет"),  # unlearned script
            (3, "qvx zzkw xqv wvvx jqz kkxq vwq zxxv qqz vkj wxq zvv kqx jjv xwz qvk"),  # no known run
            (4, LINES["fr"]), (5, LINES["de"]), (6, "xylophone"), (7, f"{LINES['en']} zyzzyva"), (8, "12 34"),
            (9, "kissa istuu pöydällä ja katselee ikkunasta ulos kun sade lankeaa hiljaa järven ylle")]  # unlearned language
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in language.accept(df, model).collect()} == {2, 4, 5, 6, 7}


def test_rare_words_have_their_own_rows(spark):
    """100,000 words that differ in frequency: the rarest are known too."""
    name = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    rows = [(i, " ".join([name(k) for k in range(i * 1000, i * 1000 + 1000)] * (2 if i < 60 else 1)), "ab"[i % 2])
            for i in range(100)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.words) == 100_000 and model.word_rows.shape == (100_000, 2)
    assert language.Scorer(model).predict(name(99_500))[0] == "b"


def test_model_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.Scorer(language.fit(empty)).predict("word") == ("und", 0.0)


def test_held_out_accuracy(spark):
    from __spark_entry__ import queries
    sf = "/root/testdata/sf0.01"
    got = queries()["op1_language_id"](spark, sf).where("held_out")
    both = got.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    n = both.count()
    assert n and both.where("lang_pred = lang").count() / n > 0.97


@pytest.fixture(scope="module")
def content():
    return html.train(html_labelled.labelled_pages())


def article(page):
    inner = re.sub(r"<(?:br|/?p|/?h1)>", " ", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    import html as entities
    return re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]+>", "", inner))).strip()


def test_pages_of_the_table(spark, content):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = html.extract(pages, content).collect()
    assert len(got) == pages.count()
    for r in got:
        assert r.text == article(r.html) and r.n_chars == len(r.text)


def test_unseen_layouts(content):
    wrong = total = 0
    for page in html_labelled.labelled_pages(120, seed=5):
        nodes = html.parse(page)
        rows, kinds, parents, own = html.features(nodes)
        said = html.marginals(content, rows, kinds, parents)[0] > 0.5
        wrong += int(((said != (html.labels(nodes) > 0.5)) & (own > 0)).sum())
        total += int((own > 0).sum())
    assert wrong / total < 0.02


def test_marginals_against_enumeration(content):
    nodes = html.parse("<div><p>one two</p><nav><a>x</a></nav><ul><li>y</ul></div>")
    rows, kinds, parents, _ = html.features(nodes)
    got, joint, log_z = html.marginals(content, rows, kinds, parents)
    n, z, mass = len(nodes), 0.0, np.zeros(len(nodes))
    for bits in range(1 << n):
        y = [(bits >> i) & 1 for i in range(n)]
        w = np.exp(sum(rows[i] @ content.node for i in range(n) if y[i])
                   + sum(content.edge[kinds[i], y[parents[i]], y[i]] for i in range(1, n)))
        z += w
        mass += w * np.array(y)
    assert np.allclose(got, mass / z) and np.isclose(log_z, np.log(z))
    assert np.allclose(joint[1:].sum(axis=(1, 2)), 1)


PAGE = """<html><head><title>t</title><style>a{}</style></head><body><header><a href=/>Home</a></header>
<div class="cookie-notice"><p>We use cookies. Accept them.</p></div>
<div class="post-content"><h1>A  title</h1><p>First &amp; best <b>para</b>graph with <a href=x>a link</a> inside. It goes on.</p>
<div class="ad-slot">Buy things now.</div><p>Second<br>line.<p>Ti.</div>
<aside class=sidebar><h3>More</h3><ul><li><a>One</a><li><a>Two</a></ul></aside>
<form><label>Search</label><input><button>Go</button></form>
<section id="comments"><h2>Comments</h2><div class=comment><p>Nice text, thank you. I liked it.</p></div></section>
<script>if (a < b) "</p>"</script><footer>&copy; 2020</footer></body></html>"""


def test_parts_that_go(content):
    assert html.main_text(PAGE, content) == "A title First & best paragraph with a link inside. It goes on. Second line. Ti."


def test_odd_pages(spark, content):
    odd = [None, "", "   ", "<", "<<>>", "<p", "plain text only", "<!-- open", "<script>never ends", "</p></div>", "<p>a &lt; b &am c</p>",
           "<div>" * 3000 + "x", "<a href='\"unbalanced>text</a>" * 50, "<article><p>" + "long words here. " * 60_000 + "</article>"]
    df = spark.createDataFrame([(i, p, 1) for i, p in enumerate(odd)], "page_id long, html string, text int")
    got = {r.page_id: r for r in html.extract(df, content).collect()}
    assert len(got) == len(odd)
    assert got[0].text == got[1].text == got[2].text == "" and got[0].n_chars == 0
    assert got[13].n_chars == len(("long words here. " * 60_000).strip())
    assert html.extract(df.limit(0), content).count() == 0


def test_long_attributes_and_nodes(content):
    import time
    for size in (100, 12_000, 1_000_000):
        data = "x > <p>no text.</p> " * (size // 20)
        for quote in "\"'":
            page = PAGE.replace("<h1>", f"<h1 data-x={quote}{data}{quote} class={quote}title{quote}>")
            assert html.main_text(page, content) == html.main_text(PAGE, content)
    # A quote that never closes ends its tag at the next sign, also very many of them.
    begin = time.monotonic()
    html.parse("<a \">\"" * 100_001)
    html.parse("<a '\">" * 100_001)
    assert [x.tag for x in html.parse("<p class=\"a>b<b>c</b>")] == ["#root", "p"]
    assert time.monotonic() - begin < 20


def test_cues_come_from_whole_nodes():
    """A sentence end or legal note counts wherever in its node it stands."""
    page = "<p>{}</p>"
    late = html.features(html.parse(page.format("words<br>" * 100_000 + "One. Two. Three. © all")))[0]
    early = html.features(html.parse(page.format("One. Two. Three. © all<br>" + "words<br>" * 100_000)))[0]
    assert (late == early).all() and (late != html.features(html.parse(page.format("words<br>" * 100_004)))[0]).any()
