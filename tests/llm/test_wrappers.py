"""Wrapper inference: hand-made pages, malformed pages, merging in any grouping."""

import json
import random
import time

import pytest

from hirelake.llm.wrappers import _steps, expression, extract, infer, main_text, merged, page_items, parse

NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
PLAIN = (
    "<html><head><title>T</title><style>p{}</style></head><body><div class='site-menu'><a href=x>One</a> <a href=y>Two</a></div>"
    "<div id=c%d><h2>Head %d</h2><p>First &amp; second\n  text %d.<br>Line</p>%s</div><div class=sidebar>Side</div>"
    "<div>Made by us</div><ul><li><a href=1>Link a %d</a></li><li><a href=2>Link b %d</a></li></ul><script>x='</p>'</script></body></html>"
)


def plain(i):
    return PLAIN % (i, i, i, "<p>more</p>" * (i % 3) + ("<blockquote>quote</blockquote>" if i % 2 else ""), i, i)


CASES = {
    f"<html><body>{NAV}<header>Top</header><article><header><h1>Title&nbsp;x</h1></header><p>A <b>b</b>\tc</p><p>d &lt;e&gt; &#233;</p>loose<footer>foot</footer></article><aside>s</aside></body></html>": "Title x\n\nA b c\n\nd <e> é\n\nloose",
    "<article><p><b>Open bold<br><p>Next</p><div class='ad'>Buy</div><p>Last": "Open bold\n\nNext\n\nLast",
    "<main><p>Text</p><section id=comments><article><p>I think</p></article></section><form><label>Mail</label></form></main>": "Text",
    "<article><p>a < b and c</p><p>cut &am": "a < b and c\n\ncut &am",
    "<article><p>kept</p><p cla": "kept",
    "<article><p>one</p><!-- <p>no</p> --><p>two</p><script>if (a<b) '<p>'</script></article>": "one\n\ntwo",
    "<article><div class='cookie-notice'>Cookies</div><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>": "x\n\ny\n\n1\n\n2",
    "": "", "no tags at all": "no tags at all", "<nav>only</nav>": "",
}


@pytest.mark.parametrize("page", list(CASES))
def test_pages_alone(page):
    assert extract(page, None) == CASES[page]
    assert extract(page, page_items(parse(page))) == CASES[page]


def test_wrapper_of_a_host_without_article():
    pages = [plain(i) for i in range(8)]
    whole = merged([page_items(parse(p)) for p in pages])
    shape = expression(whole, 8)
    assert "(<p>" in shape and "+" in shape and "<blockquote>" in shape and "?" in shape
    for i, p in enumerate(pages):
        out = extract(p, whole)
        assert out.startswith(f"Head {i}\n\nFirst & second text {i}. Line") and "more" * (i % 3 > 0) in out
        assert not any(x in out for x in ("Side", "Made by us", "Link", "One"))
    halves = [merged([page_items(parse(p)) for p in pages[:3]]), merged([page_items(parse(p)) for p in pages[3:]])]
    assert [extract(p, merged(halves)) for p in pages] == [extract(p, whole) for p in pages]


def test_broken_pages_take_linear_time():
    for bad in ("<script>", "<p class=\"", "</b>", "<!--", "<a href='", "<", "<div>", "<p><b>", "<td>"):
        begin = time.time()
        extract("<article>x" + bad * 30_000, None)
        assert time.time() - begin < 6, bad


def test_table(spark):
    rows = [(i, f"https://h{i % 2}.example/x/{i}", plain(i), "e") for i in range(40)]
    rows += [(i + 100, None, page, "e") for i, page in enumerate(CASES)] + [(200, "not a url", None, "e"), (None, "http://H1.example:80/", plain(3), "e"), (3, rows[3][1], rows[3][2], "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    out = {r.page_id: r.text for r in got}
    for i, want in enumerate(CASES.values()):
        assert out[i + 100] == want
    assert out[200] == "" and all(out[i].startswith(f"Head {i}") and "Made by us" not in out[i] for i in range(40))
    few = {r.host: (r.pages, json.loads(r.wrapper)) for r in infer(pages.repartition(12), fan_in=2).collect()}
    assert few["h0.example"][0] == 20 and few["h1.example"][0] == 22
    assert main_text(pages.limit(0)).collect() == []


def test_copies_of_an_article_keep_their_blocks(spark):
    rare = "<blockquote>A rare quote</blockquote>"
    page = lambda i, more: f"<html><body><div>Made by us</div><div id=c><h2>Head {i}</h2><p>Text {i}.</p>{more}</div></body></html>"
    rows = [(i, f"http://big.example/{i}", page(i, "")) for i in range(30)]
    rows += [(100 + i, f"http://big.example/c{i}", page(99, rare) + f"<p>Seen {i} times</p>") for i in range(3)]
    rows += [(200 + i, f"http://small.example/{i}", page(7, rare) + f"<!-- {i} -->") for i in range(3)] + [(210, "http://small.example/x", page(8, ""))]
    out = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("A rare quote" in out[i] and "Text" in out[i] for i in (100, 101, 102, 200, 201, 202))
    assert all("Made by us" not in out[i] for i in (0, 29, 100))


def test_what_a_host_says_in_every_article_goes(spark):
    """Names do not tell it: inside article, no class, among paragraphs of the same kind."""
    body = lambda i, more="": f"<article><p>Body {i} of the article, with words of its own</p><p>Follow our host on all channels</p>{more}<p>Its end, {i}</p></article>"
    rows = [(i, f"http://a.example/{i}", body(i)) for i in range(20)]
    # Two articles share a quote, many copies of one article share its blocks: neither is the host's.
    rows += [(30 + i, "http://a.example/q", body(30 + i, "<p>A quote</p>")) for i in range(2)]
    long = "<p>The longest paragraph of them all, word for word</p><p>A copied line</p>"
    rows += [(100 + i, "http://b.example/", f"<article>{long}<p>Seen {i} times</p></article>") for i in range(30)]
    rows += [(200 + i, "http://b.example/", f"<article><p>Other {i} with text of its own</p></article>") for i in range(3)]
    # More different blocks than a wrapper keeps, and a page that says nothing else.
    many = "".join(f"<p class='k{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}'>Part {k} of page {{i}}</p>" for k in range(1600))
    rows += [(300 + i, "http://c.example/", f"<article>{many.replace('{i}', str(i))}<p>Said by the host</p></article>") for i in range(4)]
    rows += [(310, "http://a.example/only", "<article><p>Follow our host on all channels</p></article>")]
    out = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert all(out[i] == f"Body {i} of the article, with words of its own\n\nIts end, {i}" for i in range(20))
    assert all("A quote" in out[i] and "Follow" not in out[i] for i in (30, 31))
    assert all(out[100 + i].endswith(f"A copied line\n\nSeen {i} times") for i in range(30))
    assert all("Said by" not in out[300 + i] and out[300 + i].endswith(f"Part 1599 of page {i}") for i in range(4))
    assert out[310] == "Follow our host on all channels"


def test_elements_too_many_for_a_wrapper_are_judged_too(spark):
    """Pages of more items than a wrapper keeps, without an article element: link lists and what the host always says go."""
    many = lambda i: "".join(f"<p class='k{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}'>Part {k} of page {i}</p>" for k in range(1600))
    links = lambda i: "<div class='box'>" + "".join(f"<a href='/{k}'>Go to {k} from {i}</a> " for k in range(5)) + "</div>"
    page = lambda i: f"<html><body>{links(i)}<div class='own'>Said by the host</div><h2>Head {i}</h2>{many(i)}</body></html>"
    rows = [(i, f"http://big.example/{i}", page(i)) for i in range(4)] + [(9, "http://big.example/9", page(3)), (10, "http://big.example/n", None)]
    rows += [(20 + i, f"http://small.example/{i}", f"<div class='own'>Said by the host</div><p>Text {i}</p>") for i in range(4)]
    out = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert all(out[i] == "\n\n".join([f"Head {i}", *[f"Part {k} of page {i}" for k in range(1600)]]) for i in range(4))
    assert out[9] == out[3] and out[10] == "" and all(out[20 + i] == f"Text {i}" for i in range(4))


def test_long_lists_are_aligned_however_far_apart_their_items_stand():
    """The second page has 60 elements more before the 520 that both have, more than any search nearby would pass."""
    name = lambda k: f"k{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}"
    part = lambda k, i: f"<div class='{name(k)}'>Part {k} of {i}</div>"
    first, second = ("".join(part(k, i) for k in places) for i, places in enumerate((range(520), [*range(520, 580), *range(520)])))
    both = merged([page_items(parse(first)), page_items(parse(second))])
    assert [x[0] for x in both if x[2] == 2] == [f"div.{name(k)}" for k in range(520)]
    assert [x[0] for x in both if x[2] == 1] == [f"div.{name(k)}" for k in range(520, 580)]


def test_steps_follow_a_longest_common_subsequence():
    draw = random.Random(5)
    for size, keys in ((3, 2), (12, 3), (40, 9), (700, 60), (700, 2_000)):
        a, b = ([str(draw.randrange(keys)) for _ in range(draw.randrange(size, 2 * size))] for _ in range(2))
        best = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(best[j] + 1 if x == y else max(best[j + 1], row[-1]))
            best = row
        i = j = met = 0
        for of_a, of_b in _steps(a, b):
            assert not (of_a and of_b) or a[i] == b[j]
            met += of_a and of_b
            i, j = i + of_a, j + of_b
        assert met == best[-1] and (i == len(a) or j == len(b))
