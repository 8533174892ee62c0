"""Language, toxicity, page text and suffix-tree scores: held-out accuracy, brute force and edge cases."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from scriptorium.llm.common import table
from scriptorium.llm.html_text import extract, grow, labelled_rows, main_text
from scriptorium.llm.language_id import UNDETERMINED, accepted, identify, windows_of
from scriptorium.llm.suffix_tree import DEPTH, Tree, grams_of, scored, spelled, words_of
from scriptorium.llm.toxicity import score, windows

from .conftest import SMALLEST

SMALL = "/root/testdata/sf0.01"


def remainder(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def test_languages_of_held_out_documents(spark):
    documents = table(spark, SMALL, "documents")
    lang = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    found = identify(documents).collect()
    assert len(found) == len(lang) and all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.95


def test_language_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(i, t, l, "x") for i, (t, l) in enumerate([("der die das und ist nicht " * 9, "de"), ("the and of to in is it " * 9, "en")] * 12)]
    odd = [(100, None, "en", "x"), (101, "", None, "x"), (102, "12 34 -- !", "de", "x"), (None, "the and of", None, "x"), (103, "the of and " * 9000, None, "x")]
    docs = spark.createDataFrame(rows + odd + odd[-1:], schema)
    found = [(r["doc_id"], r["lang_pred"]) for r in identify(docs).collect() if r["doc_id"] is None or r["doc_id"] >= 100]
    assert sorted(found, key=repr) == sorted([(100, UNDETERMINED), (101, UNDETERMINED), (102, UNDETERMINED), (None, "en"), (103, "en"), (103, "en")], key=repr)
    kept = accepted(docs)
    assert kept.columns == docs.columns and sorted({r["doc_id"] for r in kept.collect() if r["doc_id"] is not None}) == [*range(24), 103]
    assert identify(docs.limit(0)).count() == 0 and accepted(docs.limit(0)).count() == 0
    unlabelled = spark.createDataFrame([(1, "the", None, "x")], schema)
    assert [(r["lang_pred"], r["score"]) for r in identify(unlabelled).collect()] == [(UNDETERMINED, 0.0)]


def test_windows_cover_every_run_of_bytes():
    for n in [0, 1, 3, 4, 252, 253, 254, 255, 256, 257, 506, 507, 2000]:
        text = "".join(chr(97 + i * 7 % 26) for i in range(n))
        cut, covered = windows_of(text)
        assert cut.shape[1] == 256 and len(covered) == len(cut) and covered.sum() >= n - 3
        runs = {bytes(w[i : i + 4]) for w in cut for i in range(253)}
        assert all(text[i : i + 4].encode() in runs for i in range(n - 3))


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    found = score(spark, documents, labels).collect()
    assert len(found) == documents.count() and all(r["predicted"] == int(r["score"] >= 0.5) for r in found)
    held = [(toxic[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in toxic]
    hits, alarms = [p for t, p in held if t], [p for t, p in held if not t]
    # measured: 0.70 and 0.02 with the few hundred toxic documents of this scale, 0.97 and 0.01 with 1,600
    assert sum(hits) / len(hits) > 0.6 and sum(alarms) / len(alarms) < 0.05


def test_toxicity_edge_cases(spark, docs):
    labels = spark.createDataFrame([(1, 1, 5), (1, 0, 5), (2, 0, 5), (None, 1, 5), (3, None, 5)], "doc_id long, toxic int, text int")
    found = score(spark, docs([(1, "a b"), (2, None), (2, ""), (None, "x" * 5000), (4, "w " * 40000)]), labels).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found)
    assert score(spark, docs([]), labels).count() == 0
    assert {r["score"] for r in score(spark, docs([(1, "a")]), labels.limit(0)).collect()} == {0.5}
    assert b"".join(windows("x" * 1000)).strip() == b"x" * 1000


def test_tree_of_blocks_learns_its_table():
    tree = grow(labelled_rows())
    assert all(tree(row[:-1]) == row[-1] for row in labelled_rows())


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site"><h1>Site</h1></header><nav><a href=1>a</a> b c</nav>
<div class="cookie-notice"><p>We use cookies to do many things and more words here to look long enough for it.</p></div>
<main><h1>Title &amp; more</h1><p>First   para&nbsp;with <a href="x>y">link</a> text.<br>more</p><script>var a="</p>";</script><form><label>Name</label>
</form><aside>Side words here</aside><p>Short.<!-- <p>no</p> --></p><div class="advert">Buy now this thing</div></main>
<section id="comments"><article class="comment"><p>I am a reader and think this is a long comment about it.</p></article></section><footer>f</footer>"""


def test_pages(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<article><p>" + "long &lt; " * 60000, "x")]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")).collect()
    main = "Title & more\nFirst para with link text. more\nShort."
    assert sorted(((r["page_id"], r["text"][:60], r["n_chars"]) for r in found), key=repr) == sorted(
        [(1, main, len(main)), (1, main, len(main)), (2, "", 0), (3, "", 0), (None, ("long < " * 60000)[:60], 7 * 60000 - 1)], key=repr
    )
    tree = grow(labelled_rows())
    for broken in ['<a "' * 20000, "<div>" * 20000 + "x", "<" * 100000, "<script>" * 20000, "<!--" * 20000, "<p a='" * 20000]:
        main_text(broken, tree)


def plain_counts(rows, parts=10):
    counts = Counter()
    for doc_id, text in rows:
        if remainder(doc_id, parts):
            counts.update([*words_of(text), b"\n"])
    return counts


def check_scores(found, rows):
    c = plain_counts(rows)
    n, v = sum(c.values()), len(c)
    base = lambda own: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
    expected = []
    for doc_id, text in rows:
        own = [*words_of(text), b"\n"]
        expected.append((doc_id, remainder(doc_id, 10) == 0, len(own), sum(c[w] > 0 for w in own), n, round(base(own), 5)))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_suffix_tree_scores(spark):
    documents = table(spark, SMALL, "documents")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = scored(documents).collect()
    check_scores(found, rows)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) and all(r["score"] < 0 for r in found)


def test_suffix_tree_edge_cases(spark, docs):
    rows = [(1, None), (2, ""), (3, "Ab ab AB"), (3, "Ab ab AB"), (None, "q"), (4, "w " * 3000 + "é"), (10, "new words only")]
    check_scores(scored(docs(rows)).collect(), rows)
    check_scores(scored(docs([(30, "x y")] * 2)).collect(), [(30, "x y")] * 2)
    assert scored(docs([])).count() == 0


@pytest.fixture(scope="module")
def tree():
    import pandas as pd

    text = spelled(b"abra cadabra abra banana abra".split() * 20)
    grams = np.concatenate(list(grams_of([text])))
    rows = []
    for depth in range(DEPTH + 1):
        own, n = np.unique(grams & ((1 << 8 * (depth + 1)) - 1), return_counts=True)
        keep = np.isin(own >> 8, [c for c in set((own >> 8).tolist()) if depth < 2 or c % 3])
        rows.append(pd.DataFrame({"depth": depth, "gram": own[keep], "n": n[keep]}))
    return Tree.of(pd.concat(rows))


def test_next_symbols_are_a_distribution_in_every_state(tree):
    for context in [b"\n\n\n\n\n", b" abra", b"zzzzz", b"n ana", b"cadab", b"a aba"]:
        start = int.from_bytes(context, "big") << 8
        assert abs((10 ** tree.log10(np.arange(256) + start)).sum() - 1) < 1e-9
    texts = [spelled(words_of(t)) for t in ("", "abra banana", "x" * 3000)]
    single = [tree.scores([t])[0] for t in texts]
    assert np.allclose(tree.scores(texts), single)


ARTICLE = (
    "<p>This is the first paragraph of the article and it has a good number of plain words in it.</p>"
    "<p>The second paragraph goes on for quite a while with more words that nobody links to at all.</p>"
)


@pytest.mark.parametrize(
    "frame",
    [
        '<div class="content has-sidebar">{}</div>', '<article class="post has-comments">{}</article>', '<div class="entry header-image">{}</div>',
        '<article class="social-science">{}</article>', '<article data-role="banner">{}</article>', '<main id="search">{}</main>',
        '<article><svg class="i"/>{}</article>', "<article><button/>{}</article>", "<object>{}</object>", "<article><select><option>x{}</article>",
        "<article><svg><title>icon</title><path d='M0'/></svg>{}</article>", "<article><button>Share</button>{}</article>",
    ],
)
def test_names_and_elements_that_do_not_end_the_article(frame):
    page = (
        f'<html><body><nav><a href="1">Home</a></nav>{frame.format(ARTICLE)}<div class="site-footer">Imprint and so on</div>'
        '<div id="comments-area"><p>I think that this reader comment should not be here at all.</p></div></body></html>'
    )
    text = main_text(page, grow(labelled_rows()))
    assert text.split("\n")[-2:] == [p.removesuffix("</p>") for p in ARTICLE.split("<p>")[1:]] or text.count("paragraph") == 2
    assert "comment" not in text and "Imprint" not in text and "icon" not in text and "Share" not in text
