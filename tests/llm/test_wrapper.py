"""Tree matching against its definition, and templates counted over whole hosts."""

import random
import time

import pytest

from residua.llm import tree_match, wrapper
from residua.llm.wrapper import Block


def naive(a, b):
    if a.tag != b.tag:
        return 0
    if not a.tag:
        return 2 if a.text == b.text else 1
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + naive(x, y))
    return 1 + best[-1][-1]


def drawn(rng, depth):
    if depth == 0 or rng.random() < 0.35:
        return Block("", rng.choice("uvwxyz"))
    return Block(rng.choice("pd"), children=[drawn(rng, depth - 1) for _ in range(rng.randint(1, 6))])


@pytest.mark.parametrize("cells, few", [(1 << 28, 64), (4, 64), (1 << 28, 0)])
def test_matching_equals_its_definition(monkeypatch, cells, few):
    monkeypatch.setattr(tree_match, "CELLS", cells)
    monkeypatch.setattr(tree_match, "FEW", few)
    rng = random.Random(1)
    for _ in range(600):
        a, b = (Block("#", children=[drawn(rng, 3) for _ in range(rng.randint(1, 4))]) for _ in range(2))
        want = naive(a, b)
        pairs = list(tree_match.matched(a, b))
        assert tree_match.Matching(a, b).score() == want
        assert sum(1 + (not x.tag and x.text == y.text) for x, y in pairs) == want
        assert all(x.tag == y.tag for x, y in pairs) and len({id(x) for x, _ in pairs}) == len(pairs)


def test_wide_pages_take_seconds():
    def tree(word, odd):
        body = "".join(f"<p>{word} {i}</p>" + "<ul><li>same</li></ul>" * (i % 50 == odd) for i in range(12_000))
        return wrapper.pruned(wrapper.parse(f"<article>{body}</article>"))

    begin = time.monotonic()
    pairs = sum(1 for _ in tree_match.matched(tree("one", 3), tree("two", 5)))
    assert pairs >= 24_002 and time.monotonic() - begin < 30


def test_nothing_goes_for_its_share_of_the_text():
    lead = "<div><p>Lead</p><div>" + "<p>much longer body text of the page</p>" * 9 + "</div></div>"
    assert wrapper.main_text(lead).startswith("Lead\n\nmuch")
    assert wrapper.main_text("<article><p>See <a href=x>a very long link text</a></p></article>") == "See a very long link text"
    assert wrapper.main_text("<div><p>See <a href=x>a very long link text</a></p><p>b</p></div>") == "See a very long link text\n\nb"
    form = "<form id=f><label>l</label><article><p>text</p><button>b</button></article></form><form><p>search</p></form>"
    assert wrapper.main_text(form) == "text"
    several = "<article><p>short</p></article><div>ad</div><article><p>a longer one</p></article>"
    assert wrapper.main_text(several) == "short\n\na longer one"


@pytest.fixture(scope="module")
def host(spark):
    """One host with two kinds of pages, a third of them copies, and a few pages of a third kind."""
    blog = "<div>All stories</div><article><h1>T{0}</h1><p>Own words of story {0} are these</p><div class=c9>Write to us</div></article>"
    shop = "<section><div>All goods</div><div><h2>G{0}</h2><p>Good {0} costs {1}</p></div><div>We ship on all days</div></section>"
    odd = "<main><p>About {0}</p></main>"
    rows = [(i, "http://a.example/b", blog.format(i, i * 7)) for i in range(40)]
    rows += [(100 + i, "http://a.example/s", shop.format(i, i * 7)) for i in range(40)]
    rows += [(200 + i, "http://A.example/c", blog.format(0, 0)) for i in range(40)]
    rows += [(300 + i, "http://a.example/o", odd.format(i)) for i in range(2)]
    found = wrapper.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"] for r in found.collect()}, blog, shop


def test_each_kind_of_page_has_its_template(host):
    texts = host[0]
    assert len(texts) == 122
    for i in range(40):
        assert texts[i] == f"T{i}\n\nOwn words of story {i} are these"
        assert texts[100 + i] == f"G{i}\n\nGood {i} costs {i * 7}"
        assert texts[200 + i] == texts[0]
    assert texts[300] == "About 0" and texts[301] == "About 1"


def test_whole_tables_give_what_a_few_pages_give(host):
    texts, blog, shop = host
    for first, page in ((0, blog), (100, shop)):
        saved = wrapper.induce([page.format(i, i * 7) for i in range(40)])
        assert all(texts[first + i] == wrapper.main_text(page.format(i, i * 7), saved) for i in range(40))


def test_a_host_of_near_copies_keeps_its_article(spark):
    page = "<p>Menu</p><article><h1>Title</h1><p>The same long text on all of them</p><p>{0}</p></article>"
    rows = [(i, "http://a.example/", page.format(i)) for i in range(30)]
    found = wrapper.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {f"Title\n\nThe same long text on all of them\n\n{i}" for i in range(30)}
