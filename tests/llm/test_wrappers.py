import html
import random
import re
from functools import cache
from itertools import combinations

from plantmetrics.llm import dom
from plantmetrics.llm.queries import QUERIES
from plantmetrics.llm.wrappers import NO_HINTS, VOTES, Node, extract_main_text, matching, merge

SF = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"
PAGES = "page_id long, url string, html string"


def articles(spark, sf_dir):
    """The text of each page's article, by regular expressions."""
    found = {}
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        found[row.page_id] = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))).split())
    return found


def test_articles_of_the_pages(spark):
    want = articles(spark, SF)
    for row in QUERIES["op6_html_text"](spark, SF).collect():
        assert row.text == want[row.page_id] and row.n_chars == len(row.text)


def test_the_wrapper_alone_finds_the_articles(spark):
    """Without a tag, class or id to go by, but for what the alignment of a host's pages shows."""
    want = articles(spark, LARGE)
    got = extract_main_text(spark.read.parquet(f"{LARGE}/pages.parquet"), NO_HINTS).collect()
    assert len(got) == len(want) and sum(r.text == want[r.page_id] for r in got) >= 0.9 * len(want)


def test_values_that_come_back_are_template_wherever_they_stand(spark):
    def body(k):
        words = " ".join(f"word{k}x{j}" for j in range(40))
        teaser, note = f"Offer number {k % 7} of the week", f"Weather is {k % 3}"
        return f"<div class=a>{teaser}</div><div class=b><h2>Same heading</h2><p>{words}</p></div><div class=c>{note}</div>"

    rows = [(k, "http://h/", body(k)) for k in range(60)] + [(k, "http://small/", body(k)) for k in range(4)]
    rows += [(3, "http://h/", body(3))]  # a repeated row
    got = extract_main_text(spark.createDataFrame(rows, PAGES), NO_HINTS).collect()
    assert len(got) == 65
    for row in got:
        if "small" in row.url:  # too few pages to tell: the block that is over half of the words
            assert f"word{row.page_id}x0" in row.text
        else:
            assert row.text.startswith(f"Same heading word{row.page_id}x0") and row.text.endswith("x39")


def test_an_author_who_comes_back_stays_in_an_article(spark):
    def body(k):
        words = " ".join(f"word{k}x{j}" for j in range(40))
        return f"<div class=x>Buy {k % 4} now</div><article><div class=by>By Ann {k % 5}</div><p>{words}</p></article>"

    rows = [(k, "http://h/", body(k)) for k in range(50)]
    for row in extract_main_text(spark.createDataFrame(rows, PAGES)).collect():
        assert row.text.startswith(f"By Ann {row.page_id % 5} word{row.page_id}x0")


def test_samples_do_not_depend_on_the_order_of_merging():
    def page(k):
        return Node("a", votes={k * 7919 % 1009: k % 5})

    def merged(order):
        top = page(order[0])
        for k in order[1:]:
            top = merge(top, page(k))
        return sorted(top.votes.items())

    forward = merged(range(300))
    assert forward == merged(range(299, -1, -1)) and len(forward) == VOTES
    assert forward == sorted((k * 7919 % 1009, k % 5) for k in range(300))[:VOTES]


def test_matching_against_all_alignments():
    """The largest matching of trees, by trying every order-preserving choice of children."""

    def tree(random_, depth):
        inside = [tree(random_, depth - 1) for _ in range(random_.randrange(4))] if depth else []
        return (random_.choice("ab"), tuple(inside))

    @cache
    def largest(left, right):
        best = 0
        for n in range(1, min(len(left), len(right)) + 1):
            for some in combinations(left, n):
                for others in combinations(right, n):
                    if all(a[0] == b[0] for a, b in zip(some, others)):
                        best = max(best, sum(1 + largest(a[1], b[1]) for a, b in zip(some, others)))
        return best

    def node(plain):
        return Node(plain[0], children=[node(one) for one in plain[1]])

    random_ = random.Random(5)
    for _ in range(200):
        left, right = ([tree(random_, 2) for _ in range(random_.randrange(5))] for _ in range(2))
        size, pairs = matching([node(one) for one in left], [node(one) for one in right])
        assert size == largest(tuple(left), tuple(right))
        assert sum(1 + largest(left[i][1], right[j][1]) for i, j in pairs) == size


def page(k, extra=""):
    return (
        f"<html><head><title>T{k}</title><style>p{{}}</style></head><body><header>Site</header><div id=nav{k}>menu</div>"
        f"<div class='cookie-notice'>We use cookies {k}</div><div class=wrap><div class=tagline>All the news</div>"
        f"<div class=text><h1>Title {k}</h1><p>First &amp; <b>bold</b> words {k} of a story&hellip;<br>next"
        f"<p>Second\n\tparagraph number {k} with some more words{extra}</div><div class='sidebar'>Read {k} too</div></div>"
        f"<form>Sign up {k}</form><section id=comments><p>Reader {k} says no</p></section><script>var x='<p>no</p>'</script></body>"
    )


def test_slots_without_an_article_element(spark):
    rows = [(k, "http://Host.example/a", page(k)) for k in range(6)] + [(90, "http://host.example:80/b", None)]
    rows += [(91, "http://host.example/c", ""), (92, None, "<p>a<!-- c --> b</p>"), (93, "http://other/", "plain <i>te</i>xt")]
    rows += [(94, "http://third/", "<div>" * 5000 + "deep" + "</div>" * 5000), (94, "http://third/", "<p")]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect() if r.page_id != 94}
    for k in range(6):
        assert got[k] == f"Title {k} First & bold words {k} of a story… next Second paragraph number {k} with some more words"
    assert got[90] == got[91] == "" and got[92] == "a b" and got[93] == "plain text"
    assert extract_main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_same_article_on_all_pages_stays(spark):
    story = "<main><h1>One</h1><p>The same story on every page of the host.</p></main>"
    rows = [(k, "http://h/", f"<div class=ad>{k}</div>{story}<footer>{k}</footer>") for k in range(5)]
    got = extract_main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {r.text for r in got} == {"One The same story on every page of the host."}


def test_blocks_of_one_article_stay_however_many_copies_it_has(spark):
    def article(k, extra="", menu=0):
        words = " ".join(f"word{k}x{j}" for j in range(30))
        return f"<div>{menu}</div><article><h1>Title {k}</h1><h2>Background</h2><p>{words}</p>{extra}<div class=note>Text is free</div></article>"

    table = "<table><tr><td>some cells</td><td>of one article</td></tr></table><ul><li>one list</li></ul>"
    few = [(k, "http://few/", article(k)) for k in range(4)] + [(10 + k, "http://few/", article(9, table, k)) for k in range(20)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(few, PAGES)).collect()}
    for k in range(4):
        assert got[k].startswith(f"Title {k} Background word{k}x0") and got[k].endswith("x29")
    assert len({got[10 + k] for k in range(20)}) == 1 and got[10].endswith("x29 some cells of one article one list")
    # a hot host: optional block on three different articles of many
    many = [(k, "http://many/", article(k, table if k < 3 else "")) for k in range(200)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(many, PAGES)).collect()}
    assert got[0].endswith("one list") and got[2].endswith("one list") and got[50].endswith("x29")


def test_lead_and_second_section_stay_without_an_article_element(spark):
    def body(k):
        words = " ".join(f"word{k}x{j}" for j in range(60))
        return (
            f"<div class=top>All the news</div><div class=lead><h1>Title {k}</h1><p>Lead {k}</p></div>"
            f"<div class=long><p>{words}</p></div><div class=more><p>Short end {k}</p></div><div class=bottom>All rights</div>"
        )

    rows = [(k, "http://h/", body(k)) for k in range(5)] + [(9, "http://one/", body(9))]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    for k in range(5):
        assert got[k].startswith(f"Title {k} Lead {k} word{k}x0") and got[k].endswith(f"x59 Short end {k}")
    assert "Title 9 Lead 9 word9x0" in got[9] and "x59 Short end 9" in got[9]


def test_self_closed_pictures_and_formulas_end():
    icons = "<p>a <svg class='i' viewBox=\"0 0 1 1\"/>b <math/>c<svg><path d='M0'/><text>no</text></svg> d<p>e"
    assert dom.blocks(dom.parse(icons)) == ["a b c d", "e"]
    assert dom.blocks(dom.parse("<p>a <svg data-u=x/y><title>no</title></svg> b<svg href='a/'>no</svg>")) == ["a b"]


def test_matching_keeps_order():
    def tree(label, *inside):
        return Node(label, children=list(inside))

    left = [tree("a"), tree("b", tree("x"), tree("y")), tree("c")]
    right = [tree("c"), tree("b", tree("y")), tree("c")]
    assert matching(left, right) == (3, [(1, 1), (2, 2)])


def test_blocks():
    assert dom.blocks(dom.parse("<ul><li>a<li>b <b>c</ul><p>d<p>e</p>f")) == ["a", "b c", "d", "e", "f"]
