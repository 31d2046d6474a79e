"""Very long and broken texts: same results, in time that grows with the text."""

import random
import re
import time

import pytest
import tiktoken
from helpers import docs

from millrace.llm import pii, tokens, wrappers


@pytest.fixture(scope="module")
def tool():
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=tokens.load(), special_tokens={})


def test_cut_blanks_give_the_same_ids(tool, monkeypatch):
    monkeypatch.setattr(tokens, "BLANKS", re.compile(tokens.BLANKS.pattern.replace("10000", "3")))
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b ", " ", "  ", "\n", "\t", "　", "\x1c", "1", "-", "é", "'s"]) for _ in range(rng.randrange(25)))
        assert tokens.encode_long(tool, text) == tool.encode_ordinary(text)


@pytest.mark.parametrize("run", [" ", "\n", "a", "1", "-", "　"])
def test_runs_of_two_million_characters(tool, run):
    start = time.monotonic()
    ids = tokens.encode_long(tool, "x" + run * 2_000_000 + "y")
    assert tool.decode(ids) == "x" + run * 2_000_000 + "y" and time.monotonic() - start < 60


def test_a_document_of_blanks_is_counted(spark):
    rows = tokens.line_tokens(docs(spark, [(1, " " * 1_000_000), (2, "a" + " " * 1_000_000 + "b\nc")])).collect()
    assert sorted((r.doc_id, r.section) for r in rows) == [(1, 0), (2, 0), (2, 1)]
    assert all(r.n_tokens > 0 for r in rows)


def test_personal_data_of_twenty_thousand_lines(spark):
    line = "call +49 30 1234567{} or mail a{}@b.example.org, 4111 1111 1111 1111, 10.0.{}.{}\n"
    text = "".join(line.format(i % 10, i, i % 256, i % 200) for i in range(20_000))
    start = time.monotonic()
    row = pii.personal_spans(docs(spark, [(1, text), (2, "mail a@b.example.org")])).where("doc_id = 1").first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (20_000,) * 4
    assert time.monotonic() - start < 120


def test_longest_candidates_apart_equal_brute_force(spark):
    """Overlapping candidates of all kinds, and base spans between them, against a plain greedy choice."""
    rng, rows = random.Random(4), []
    for d in range(40):
        spans = lambda n, size: sorted({(s, rng.randrange(4), s + rng.randrange(1, size)) for s in (rng.randrange(80) for _ in range(n))})
        base = []
        for s in spans(5, 9):
            if not base or base[-1][2] <= s[0]:
                base.append(s)
        rows.append((d, spans(rng.randrange(25), 12), base))
    kind = "array<struct<start:int,kind:int,end:int>>"
    found = spark.createDataFrame(rows, f"_d long, passed {kind}, base {kind}")
    got = {r._d: sorted(map(tuple, r.added)) for r in pii._longest_apart(found, kind).collect()}
    for d, passed, base in rows:
        taken = []
        for _, *c in sorted((s[0] - s[2], *s) for s in passed):
            if all(b[0] >= c[2] or c[0] >= b[2] for b in [*base, *taken]):
                taken.append(tuple(c))
        assert got.get(d, []) == sorted(taken)


# Pages -----------------------------------------------------------------------------------------------------

BROKEN = {"<a" * 10_000: "<a" * 10_000, "a <b and c <d " * 20_000: ("a <b and c <d " * 20_000).strip(), "<p \"" * 20_000 + "x": None,
          "<script>x</script" * 20_000: None, "<" * 200_000: "<" * 200_000, "<div>" * 50_000 + "</p>" * 50_000 + "end": "end", "<!--" * 50_000: "", "&" * 100_000: "&" * 100_000}


@pytest.mark.parametrize("page", list(BROKEN), ids=lambda p: p[:8])
def test_broken_markup_is_read_in_one_pass(page):
    start = time.monotonic()
    text = " ".join(b[1] for b in wrappers.parse(page)[1])
    assert time.monotonic() - start < 20
    if BROKEN[page] is not None:
        assert text == BROKEN[page]


def test_pages_of_twenty_thousand_blocks():
    rng = random.Random(7)
    one = "".join(f"<p>a {i}</p><h2>b {i}</h2>" for i in range(10_000))
    two = "".join(f"<{t}>c {i}</{t}><hr>" for i, t in enumerate(rng.choice(["p", "h2", "ul"]) for _ in range(12_000)))
    for a, b in ((one, one.replace("<p>a 5</p>", "")), (one, two), (two, one)):
        start = time.monotonic()
        count, pairs = wrappers.align(wrappers.parse(a)[0], wrappers.parse(b)[0])
        assert count == len(pairs) > 1 and time.monotonic() - start < 60


def test_cutting_a_large_alignment_gives_as_many_matches(monkeypatch):
    rng = random.Random(3)

    def page():
        return "".join(f"<{t}><b>x</b>{'<i>y</i>' * 2}</{t}>" if rng.random() < 0.5 else f"<{t}><div>z</div></{t}>"
                       for t in (rng.choice(["p", "h2", "section", "ul"]) for _ in range(rng.randrange(1, 40))))

    for _ in range(60):
        a, b = page(), page()
        whole = wrappers.align(wrappers.parse(a)[0], wrappers.parse(b)[0])[0]
        monkeypatch.setattr(wrappers, "CELLS", 6)
        assert wrappers.align(wrappers.parse(a)[0], wrappers.parse(b)[0])[0] == whole
        monkeypatch.undo()


def text_of_pages(spark, bodies, host="http://h.example"):
    rows = [(i, host, f"<body><div>Top line</div>{b}<div>All rights</div></body>") for i, b in enumerate(bodies)]
    found = wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [r.text for r in found.orderBy("page_id").collect()]


@pytest.mark.parametrize("deep", [3, 62, 3000])
def test_a_menu_at_any_depth_goes(spark, deep):
    nav = "<div>" * deep + "<nav><p>Site menu {0}</p></nav>" + "</div>" * deep
    assert text_of_pages(spark, [nav.format(i) + f"<div><p>Body {i}</p></div>" for i in range(5)]) == [f"Body {i}" for i in range(5)]


@pytest.mark.parametrize("name", ["discussion", "search", "alert", "notice", "share-of-voters", "related", "feedback", "responses", "ad-hoc"])
def test_words_in_classes_do_not_cut_an_article(spark, name):
    body = "<article><p>Intro {0}</p><section class='" + name + "'><p>Part {0}</p></section></article>"
    assert text_of_pages(spark, [body.format(i) for i in range(5)]) == [f"Intro {i} Part {i}" for i in range(5)]


def test_adverts_comments_and_forms_in_an_article_go(spark):
    body = ("<article><header><h1>Title {0}</h1></header><p>Intro {0}</p><div class='box ad'><p>Buy {0}</p></div><aside>Also {0}</aside>"
            "<form><p>Name {0}</p></form><div id='comments'><p>First! {0}</p></div></article>")
    assert text_of_pages(spark, [body.format(i) for i in range(5)]) == [f"Title {i} Intro {i}" for i in range(5)]


@pytest.mark.parametrize("pages", [1, 2, 3, 5, 12])
def test_paragraphs_of_an_article_may_repeat(spark, pages):
    body = "<article><p>Intro {0} of some length</p><p>Correspondence: ask the desk.</p></article>"
    found = text_of_pages(spark, [body.format(i) for i in range(pages)])
    assert found == [f"Intro {i} of some length Correspondence: ask the desk." for i in range(pages)]
