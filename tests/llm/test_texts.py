"""Personal data, benchmark contamination and page text against brute force."""

import hashlib
import html
import random
import re

import pytest
from helpers import EXTRA, ODD, docs
from pyspark.sql import functions as F

from millrace.llm import pii, winnow, wrappers

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(number))) % 10 == 0


def brute_spans(text):
    out = []
    for i, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", m[0])
            good = (True, i == 1 and all(int(x) < 256 for x in m[0].split(".")), 14 <= len(number) <= 19 and luhn(number),
                    10 <= len(number) <= 15)[i]
            if good:
                out.append((m.start(), i, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def personal_rows(rng):
    makers = (lambda: f"{rng.choice('abc')}x.{rng.randint(1, 99)}@mail.example.com", lambda: card(rng),
              lambda: ".".join(str(rng.randint(0, 300)) for _ in range(4)),
              lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", lambda: str(rng.randint(1, 10**17)))
    return [(1000 + i, " ".join(rng.choice([rng.choice(makers)(), "wörd", "text,", "😀"]) for _ in range(12))) for i in range(300)]


def test_base_spans(spark):
    rng = random.Random(1)
    noise = [(3000 + i, "".join(rng.choice("01259.@+-() aZ_%é\n") for _ in range(60))) for i in range(300)]
    tricky = [(4000, "a@b.com_x@c.de a@b..c @x.y a@b a.b.@c.d.e"), (4001, "1.2.3.4.5.6.7.8 999.1.2.3.4 01.002.0003.4 256.1.1.1"),
              (4002, "+1 (269) 555-3296 " + card(rng)), (4003, "a" * 1500 + "1" * 1500), (4004, "4" * 1500 + "@"),
              (4005, "x@y" + ".z" * 500), (4006, "😀" + card(rng) + "😀 +12 345 678 901")]
    rows = ODD + personal_rows(rng) + noise + tricky
    found = pii.personal_spans(docs(spark, rows, EXTRA)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text in rows:
        if i in (4, None):
            continue
        base = brute_spans(text or "")
        r = by_id[i]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest(), text
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in range(4)]
        every = r.spans.split(",") if r.spans else []
        assert set(listed(base).split(",") if base else ()) <= set(every) and len(every) == len(base) + r.n_added
    assert pii.personal_spans(docs(spark, [])).count() == 0


def test_trees_add_numbers_that_run_into_others(spark):
    rng = random.Random(2)
    glued = "call +1 (269) 555-3296 " + card(rng) + " now"
    rows = personal_rows(rng) + [(1, glued), (2, "order 12345678901234567 of 2024-01-02")]
    spans = {(r.doc_id, glued[r.start:r.end]) for r in pii.redact(docs(spark, rows)).where("doc_id = 1").collect()}
    assert (1, "+1 (269) 555-3296") in spans and any(len(s) == 16 for _, s in spans)
    assert pii.redact(docs(spark, rows)).where("doc_id = 2").count() == 0


def test_long_runs_take_linear_time(spark):
    rows = [(1, "a" * 400_000 + "1" * 400_000), (2, "4" * 400_000 + "@"), (3, "x@y" + ".z" * 200_000), (4, "1." * 200_000),
            (5, "+1 " * 100_000), (6, "1 - " * 100_000), (7, "(" * 200_000)]
    found = {r.doc_id: r for r in pii.personal_spans(docs(spark, rows)).collect()}
    assert [found[i].n_email for i in range(1, 8)] == [0, 0, 1, 0, 0, 0, 0] and found[4].n_ip == 50_000


def test_trees_learn_counts():
    import numpy as np
    x = np.array([[a, b] for a in range(4) for b in range(4)])
    y = np.array([90.0 if a >= 2 and b <= 1 else 2.0 for a, b in x])
    model = pii.Boosted(x, y, np.full(16, 100.0))
    assert np.abs(model.scores - y / 100).max() < 0.05


WORDS = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(text, items):
    words, hit, ids = words_of(text), set(), set()
    for item, other in items:
        other = words_of(other)
        n = min(13, len(other))
        windows = {tuple(other[i:i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add("" if item is None else str(item))
    sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(words), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(words)


def test_contamination(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("äb Cd ef gh éÉ kl mn op 12 zz".split())
    items = [(i, " ".join(word() + str(rng.randint(0, 9)) for _ in range(n))) for i, n in enumerate([1, 3, 12, 13, 14, 20, 60, 40])]
    items += [(8, None), (9, " - "), (None, items[5][1] + " tail"), (10, "same " * 30), (5, items[6][1]), (12, "a b c")]
    rows = list(ODD)
    for k in range(60):
        parts = [word() + str(rng.randint(10, 99)) for _ in range(rng.randint(0, 80))]
        source = words_of(rng.choice(items)[1])
        a = rng.randint(0, max(0, len(source) - 5))
        at = rng.randint(0, len(parts))
        parts[at:at] = source[a:a + rng.choice([5, 12, 13, 14, 30])]
        rows.append((100 + k, ", ".join(parts)))
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    found = winnow.contamination(docs(spark, rows, EXTRA), benchmark).collect()
    wanted = {i: (i, *brute_contamination(t, items)) for i, t in rows}
    assert len(found) == len(rows) and {r.doc_id: tuple(r) for r in found} == wanted
    kept = winnow.drop_contaminated(docs(spark, rows, EXTRA), benchmark)
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == sorted(i or 0 for i, t in rows if not wanted[i][-1])
    assert winnow.contamination(docs(spark, rows), benchmark.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert winnow.contamination(docs(spark, []), benchmark).count() == 0


@pytest.mark.parametrize("k, w", [(7, 7), (4, 3), (5, 1)])
def test_every_shared_span_has_a_common_print(spark, k, w):
    rng = random.Random(4)
    lists = [[rng.randint(0, 3) for _ in range(n)] for n in (0, 3, k + w - 2, k + w - 1, 30, 60)]
    shared = [rng.randint(0, 3) for _ in range(k + w - 1)]
    lists += [lists[4] + shared + lists[3], shared, [9, 9, *shared, 9]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, h array<long>")
    kept = {r.i: r.g for r in df.select("i", winnow.kept_grams(F.col("h"), k, w).alias("g")).collect()}
    assert not kept[0] and not kept[1] and not kept[2] and kept[3]
    values = [{g >> winnow.PLACE_BITS for g in kept[i]} for i in (6, 7, 8)]
    assert values[0] & values[1] and values[2] & values[1]


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body><div class="top-menu">Home</div>
<ul><li><a href="/">{0} link</a></li></ul><div class="x"><h1>Title {0}</h1><p>Body {0} &amp; <b>mo</b>re<p>Second {0}<br>line
<p>Read our terms</p></div><div id="comments">bad {0}</div><form>search {0}</form><script>var a="<p>no</p>"</script>
<div>All rights reserved</div><footer>foot {0}</footer></body></html>"""


def test_wrapper_keeps_what_varies(spark):
    rows = [(i, "http://Host.example/%d" % i, PAGE.format(i)) for i in range(12)] + [
        (20, None, None), (21, "x", ""), (22, "http://one.example/a", "plain &lt;text&gt; <i>o</i>nly"), (None, "http://one.example/b", "<p>unclosed"),
        (23, "http://deep.example", "<div>" * 5000 + "deep" + "<p>" * 10 + "end"), (3, "http://host.example/3", PAGE.format(3))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, host string")
    found = wrappers.main_text(df).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    for i in range(12):
        assert text[i] == f"Title {i} Body {i} & more Second {i} line"
    assert [text[i] for i in (20, 21, 22, 23, None)] == ["", "", "plain <text> only", "deep end", "unclosed"]
    assert all(r.n_chars == len(r.text) for r in found)
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_copies_of_an_article_are_not_template(spark):
    rows = [(i, "http://h.example/x", "<body><div><p>The one article</p></div></body>") for i in range(20)]
    rows += [(100 + i, "http://h.example/y", f"<body><div><p>Other {i}</p></div></body>") for i in range(5)]
    found = {r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {"The one article", *(f"Other {i}" for i in range(5))}


def brute_match(a, b):
    """Simple tree matching of nested (label, children) pairs."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + brute_match(x, y))
    return m[-1][-1] + 1


def test_trees_are_aligned_for_the_most_matches():
    rng = random.Random(5)

    def tree(depth):
        return rng.choice("ab"), [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []

    def node(t):
        n = wrappers.Node(t[0], False, False, "")
        n.children = [node(c) for c in t[1]]
        return n

    for _ in range(200):
        x, y = tree(3), tree(3)
        count, pairs = wrappers.align(node(x), node(y))
        assert count == len(pairs) == brute_match(x, y)


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    text = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        inner = re.sub("</?(?:b|i|em|strong|a|span)\\b[^>]*>", "", inner)
        assert text[r.page_id] == " ".join(html.unescape(re.sub("<[^>]+>", " ", inner)).split())


@pytest.mark.parametrize("body, wanted", [
    ('<div class="main-teaser">Teaser {0}</div><div class="x"><p>Body {0} of the page</p></div>', "Teaser {0} Body {0} of the page"),
    ('<article><p>Short words</p></article><div><p>Body {0} of the page</p></div>', "Body {0} of the page"),
    ('<article><p>Read {0}</p></article><div><p>Body {0} of the page, which is long</p></div>', "Read {0} Body {0} of the page, which is long"),
    ('<article><p>Body {0}</p><p>See <a href="/">the long list of sources {0}</a></p></article>', "Body {0} See the long list of sources {0}"),
    ('<div class="discussion"><p>Body {0}</p></div><div class="menu"><a href="/">Go to {0}</a></div>', "Body {0}"),
    ('<div role="main"><p>Body {0} of the page</p></div><div>Other {0}</div>', "Body {0} of the page"),
    ('<div itemprop="text articleBody"><p>Body {0} of the page</p></div><div>Other {0}</div>', "Body {0} of the page")])
def test_alignment_decides_before_names(spark, body, wanted):
    rows = [(i, "http://h.example", f"<body><div>Top line</div>{body.format(i)}<div>All rights</div></body>") for i in range(6)]
    found = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: wanted.format(i) for i in range(6)}


@pytest.mark.parametrize("pages", [2, 3])
def test_template_of_few_pages(spark, pages):
    frame = "<body><div>Top line</div><div><p>{0}</p></div><div>All rights</div></body>"
    shared = "A long passage that every version of the article has"
    rows = [(i, "http://few.example", frame.format(f"Body {i} with words of its own")) for i in range(pages)]
    rows += [(10 + i, "http://versions.example", frame.format(f"{shared}</p><table></table><p>Change {i}")) for i in range(pages)]
    rows += [(20 + i, "http://marked.example", frame.format(f"<article><h1>Head</h1><p>Text {i} is longer</p></article>")) for i in range(pages)]
    rows += [(30, "http://alone.example", frame.format("Body"))]
    found = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(pages):
        assert found[i] == f"Body {i} with words of its own"
        assert found[10 + i] == f"Top line {shared} Change {i} All rights"
        assert found[20 + i] == f"Head Text {i} is longer"
    assert found[30] == "Top line Body All rights"
