"""Each operator against a plain version of what it computes, and against SQL where there is some."""

import itertools
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from residua.llm import (
    components, langid, licenses, minhash, packing, queries, suffixes, token_counts, vector_graph, vptree, wrapper,
)
from residua.llm.words import fold, runs, windows, words_of

QUERIES, SQL = queries.all_queries(), queries.all_sql()


def texts_of(folder, where="true"):
    return dict(duckdb.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet' WHERE {where}").fetchall())


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    ours, theirs = QUERIES[name](spark, folder).toPandas(), con.execute(SQL[name]).df()
    columns = sorted(ours.columns)
    assert sorted(theirs.columns) == columns
    pd.testing.assert_frame_equal(
        ours[columns].sort_values(columns).reset_index(drop=True),
        theirs[columns].sort_values(columns).reset_index(drop=True), check_dtype=False,
    )


def test_words_and_windows():
    texts = ["Émile's  FIRST-word, 2nd!", None, "", "a" * 200 + " b", "é\U0001f389x"]
    words = words_of(texts)
    for i, text in enumerate(texts):
        s = slice(words.first[i], words.first[i + 1])
        raw = (text or "").encode()
        cut = [raw[a:b].lower() for a, b in zip(words.start[s], words.end[s])]
        assert cut == [w.lower() for w in fold(text).split()]
    h = words_of(["a b c d a b c d a"]).hash
    for f in (runs, windows):
        got = f(h, 3)
        assert len(got) == 7 and got[0] == got[4] and got[2] == got[6] and len(set(got.tolist())) == 4


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    linked = {x for e in edges if e[0] != e[1] for x in e}
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in found} == {x: find(x) for x in linked}


def test_token_counts_are_the_tokenizers(folder):
    pieces = token_counts.vocabulary(token_counts.VOCABULARY)
    exact = Tokenizer(models.Unigram(pieces, 0, True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace()
    texts = [t for t in texts_of(folder).values() if t][:150]
    texts += ["", " ", "  a  b ", "日本語 <0x41> <s>", "a▁b", "▁▁x", "x" * 500, "éé\n\tfoo", "🎉🎉 hi", "aaaa bbbb"]
    count = token_counts.Counter(pieces)
    assert [count.tokens(t) for t in texts] == [len(exact.encode(t, add_special_tokens=False).ids) for t in texts]


def test_ties_take_the_segmentation_that_starts_first():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)]
    exact = Tokenizer(models.Unigram(pieces, 0, False))
    exact.pre_tokenizer = pre_tokenizers.Metaspace()
    count = token_counts.Counter(pieces)
    for n in range(1, 9):
        assert count.tokens("a" * n) == len(exact.encode("a" * n, add_special_tokens=False).ids)


def weighted_jaccard(a, b, idf):
    keys = set(a) | set(b)
    w = {k: float(idf[k % minhash.COUNTERS]) for k in keys}
    return sum(min(a[k], b[k]) * w[k] for k in keys) / sum(max(a[k], b[k]) * w[k] for k in keys)


def test_near_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    idf = minhash.frequencies(docs)
    bags = {}
    for name, text in texts_of(folder).items():
        _, bag, count, _ = minhash.shingles([text])
        bags[name] = Counter(dict(zip(bag.tolist(), count.tolist())))
    root = {x: x for x in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(bags), 2):
        if bags[a].keys() & bags[b].keys() and weighted_jaccard(bags[a], bags[b], idf) >= minhash.THRESHOLD:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert found == {x: find(x) for x in bags} and len(set(found.values())) < len(found)


def test_a_bucket_without_a_common_centre_loses_no_link(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 400)]
    texts = {}
    for i in range(700):  # copies that differ more from one another than from the base, and chains of copies
        words = list(base)
        for at in rng.integers(0, 400, 1 + i % 12):
            words[at] = f"e{i}x{at}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    idf = minhash.frequencies(docs)
    text, bag, count, one = minhash.weighted(list(texts.values()), idf)
    low = minhash.overlaps(len(texts), text, bag, count, one)
    size = np.bincount(text, count * one)
    near = low >= 0.8 * (size[:, None] + size[None, :] - low)
    seen, todo = {0}, [0]
    while todo:
        for j in np.flatnonzero(near[todo.pop()]).tolist():
            if j not in seen:
                seen.add(j)
                todo.append(j)
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert {x for x, c in found.items() if c == 0} == seen


def test_near_copies_of_a_text_that_fills_a_third_of_the_table(spark):
    rng = np.random.default_rng(11)

    def fresh(k):
        return [f"w{i}" for i in rng.integers(0, 10**9, k)]

    base = fresh(1000)
    near = base[:500] + fresh(50) + base[550:]
    texts = [" ".join(base)] * 100 + [" ".join(near)] + [" ".join(fresh(100)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert found == {i: 0 if i <= 100 else i for i in range(301)}


def test_repeated_passages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    words = {k: fold(t).split() for k, t in texts_of(folder).items()}
    n = suffixes.PASSAGE
    first = {}
    for k in sorted(words):
        for i in range(len(words[k]) - n + 1):
            first.setdefault(tuple(words[k][i : i + n]), k)
    want = {
        (k, i + j)
        for k, w in words.items() for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] != k for j in range(n)
    }
    spans = suffixes.repeated_passages(docs)
    rows = spans.collect()
    assert {(r["doc_id"], r["first_word"] + j) for r in rows for j in range(r["n_words"])} == want != set()
    cut = {r["doc_id"]: len(fold(r["text"]).split()) for r in suffixes.cut_repeats(docs, spans).collect()}
    gone = Counter(k for k, _ in want)
    assert cut == {k: len(w) - gone[k] for k, w in words.items()}


def test_passages_of_every_length_at_every_border(spark):
    rng = np.random.default_rng(8)

    def fresh(k):
        return [f"u{x}" for x in rng.integers(0, 10**9, k)]

    rows, want = [], {}
    for i, n in enumerate([40, 49, 50, 51, 52, 75, 90, 130]):
        passage, a, b = fresh(n), fresh(i * 13 % 60), fresh(i * 29 % 70)
        rows += [(2 * i, " ".join(a + passage + fresh(5))), (2 * i + 1, " ".join(b + passage + fresh(i)))]
        if n >= suffixes.PASSAGE:
            want[2 * i + 1] = (len(b), n, [2 * i])
    found = suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["first_word"], r["n_words"], r["kept_in"]) for r in found} == want


def test_forward_sums_all_segmentations():
    automaton, n = langid.piece_table(langid.VOCABULARY)
    chance = langid.normalised(np.random.default_rng(0).random((n + 1, 3)))
    pieces = [p for p, _ in langid.vocabulary(langid.VOCABULARY) if langid.usable(p) and len(p) < langid.LONGEST_PIECE]
    place = {p: i for i, p in enumerate(pieces)}

    def brute(word):
        total = [np.ones(3)] + [np.zeros(3) for _ in word]
        for e in range(1, len(word) + 1):
            for s in range(e):
                if word[s:e] in place:
                    total[e] = total[e] + total[s] * chance[place[word[s:e]]]
            if word[e - 1] not in place:
                total[e] = total[e] + total[e - 1] * chance[-1]
        return np.log(total[-1])

    words = ["the", "étranger", "日本", "ßtest", "a", "éé", "x" * 40]
    got = langid.lattice(words, langid.VOCABULARY).log_chance(chance)
    assert np.allclose(got, [brute(langid.MARK + w) for w in words], atol=1e-9)


def test_held_out_accuracy(spark, folder):
    found = QUERIES["op6_languages"](spark, folder).toPandas()
    truth = dict(duckdb.execute(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    held = found[found["held_out"]]
    assert len(held) > 40 and (held["lang_pred"] == held["doc_id"].map(truth)).mean() >= 0.97


def test_licence_phrases_and_expressions():
    text = "Under the GNU General-Public LICENSE; see CC BY 4.0, cc\nby. Mit license mit license\nSPDX-License-Identifier: "
    found = licenses.scan(text + "(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */")
    words = fold(text).split()
    starts = [i for p in licenses.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.encode().split()]
    assert found[1:5] == (len(starts), min(starts), max(starts), "cc-by,gpl,mit")
    assert found[5] == "apache,cc-by,gpl,mit" and found[6] == 0.3
    assert licenses.postfix("a or b and c with d") == ["a", "b", "c", "d", "with", "and", "or"]
    assert licenses.postfix("mit or") == ["mit"] and licenses.postfix("(mit") is None and licenses.postfix(")") is None
    assert licenses.evaluate(licenses.postfix("MIT AND (GPL-3.0-only OR X-1)")) == (0.5, {"mit", "gpl"})


@pytest.mark.parametrize("buckets", [1, 3, 8])
def test_packing_pads_least(buckets):
    rng = np.random.default_rng(buckets)
    for _ in range(20):
        lengths = np.unique(rng.integers(0, 60, 9))
        counts = rng.integers(1, 9, len(lengths))

        def padded(ends, lengths=lengths, counts=counts):
            return sum(min(e for e in ends if e >= x) * c for x, c in zip(lengths, counts))

        least = min(
            padded((*inner, lengths[-1]))
            for k in range(min(buckets, len(lengths))) for inner in itertools.combinations(lengths[:-1], k)
        )
        assert padded(packing.best_cuts(lengths, counts, buckets)) == least


def planted(rng, n, dim=32):
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(0, n // 2, 2):
        side = rng.normal(size=dim)
        side -= side @ x[i] * x[i]
        c = 0.95 + 0.05 * rng.random()
        x[i + 1] = c * x[i] + np.sqrt(1 - c * c) * side / np.linalg.norm(side)
    x[n // 2 : n // 2 + n // 5] = x[-1] + 0.015 * rng.normal(size=(n // 5, dim))
    x[n // 2 + n // 5 : n // 2 + n // 5 + 20] = x[0]
    return x.astype(np.float32)


def test_vector_graph_and_audit(spark):
    x = planted(np.random.default_rng(2), 900)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    found = vector_graph.near_vectors(table, shard_rows=120).toPandas().sort_values("vec_id")
    assert found["n_links"].tolist() == near.sum(axis=1).tolist()
    _, nodes = vector_graph.nodes_of(table, "vec_id", "embedding")
    true, got = vector_graph.audit(nodes, vector_graph.links_of(nodes, shard_rows=120))
    assert true > 100 and got >= 0.99 * true


@pytest.mark.parametrize("size", [4, 50, 500])
@pytest.mark.parametrize("kind", ["scaled", "noisy", "both"])
def test_groups_of_almost_identical_vectors_lose_no_link(kind, size):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(700, 24))
    x[:size] = x[0] * (np.arange(1, size + 1)[:, None] if kind != "noisy" else 1.0)
    if kind != "scaled":
        x[1 : size // 2 + 1] += 1e-6 * rng.normal(size=(size // 2, 24))
    x = x[rng.permutation(len(x))]
    y = vector_graph.unit(x)
    a, b = np.nonzero(np.triu(y @ y.T >= 0.95, 1))
    found = vector_graph.FlatGraph(y, 0.95).links()
    assert set(zip(a.tolist(), b.tolist())) == set(zip(*(f.tolist() for f in found))) and len(a) >= size * (size - 1) // 2


def test_scaled_copies_have_exact_links(spark):
    rng = np.random.default_rng(6)
    rows = [(rng.normal(size=16) * 1.0).tolist() for _ in range(300)]
    for n in (4, 50):
        base = rng.normal(size=16)
        rows += [(base * k).tolist() for k in range(1, n + 1)]
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    found = vector_graph.near_vectors(table, shard_rows=120).toPandas().sort_values("vec_id")["n_links"].tolist()
    assert found[300:304] == [3] * 4 and found[304:] == [49] * 50


@pytest.mark.parametrize("factor", [1.0, 1.3])
def test_vantage_point_trees(spark, factor):
    x = planted(np.random.default_rng(5), 1200)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = vptree.nearest(table, "id % 50 = 0", factor=factor, shard=400, block=10).toPandas()
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hits = 0
    for q in range(0, 1200, 50):
        s = y @ y[q]
        s[q] = -9
        kth = np.sort(s)[-5]
        mine = found[found["query_id"] == q].sort_values("rank")
        assert np.allclose(mine["score"], (y @ y[q])[mine["vec_id"]], atol=1e-12) and mine["score"].is_monotonic_decreasing
        hits += (mine["score"] >= kth - 1e-12).sum()
    assert hits == 120 if factor == 1.0 else hits >= 108


def test_ties_go_to_the_smaller_id(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(400)], "vec_id long, embedding array<double>")
    found = vptree.nearest(table, "id = 0 OR id = 3", shard=60).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in found] == [1, 2, 3, 4, 5, 0, 1, 2, 4, 5]


def test_main_text_by_template():
    page = (
        "<body><div>Site of sites</div><div class='menu'><a href=x>Home</a></div><div id=c><h2>T{0} &eacute;</h2><p>First "
        "<i>para</i>graph {0}\n here<br>goes <p>Second {0}<aside>no</aside></div><section class=comments>hm</section><p>All rights"
    )
    pages = [page.format(i * 7 + 100) for i in range(6)]
    saved = wrapper.induce(pages)
    want = "T100 é\n\nFirst paragraph 100 here goes\n\nSecond 100"
    assert wrapper.main_text(pages[0], saved) == want
    assert "Site of sites" in wrapper.main_text(pages[0])
    story = "<nav>x</nav><article><header>h</header><h1>T</h1><p>same text</p><div class=ad>buy</div></article><footer>f</footer>"
    assert wrapper.main_text(story, wrapper.induce([story] * 6)) == "T\n\nsame text"


def test_only_attribute_names_and_whole_class_names_drop_an_element():
    kept = [
        '<p style="overflow:hidden">', '<p data-hidden="false">', '<p title="hidden costs">', '<h2 id="cookies">', '<p id=comments>',
        '<section id="related-work">', '<p class="legal-text">', '<p class="a social-enabled">', "<p data-class='ad'>",
    ]
    for start in ("<article>", '<article style="overflow:hidden">', '<main class="post social-enabled">', '<article class="related">'):
        page = "<body>" + start + "".join(f"{tag}text {i}</{tag[1:].split()[0]}>" for i, tag in enumerate(kept))
        page += '<p>a <a href="/hidden-gems">link</a> <span class="search-term">term</span> <i id=share>x</i></p>'
        want = [f"text {i}" for i in range(len(kept))] + ["a link term x"]
        assert wrapper.main_text(page).split("\n\n") == want
    gone = ["hidden", 'aria-hidden="true"', "hidden=until-found", 'class="x site-footer"', "class=cookie-notice", "role=banner", "id=comments"]
    page = "<article><p>text</p>" + "".join(f"<div {g}>gone <b>now</b></div>" for g in gone) + "<span class=ad>gone</span></article>"
    assert wrapper.main_text(page) == "text"


def test_repeated_boxes_inside_an_article_are_template():
    page = (
        "<nav>x</nav><article><h1>T{0}</h1><p>Own text of page {0}, which is longer than the box</p><div class=c9>Follow us</div>"
        "{1}<p>More of {0}</p></article>"
    )
    pages = [page.format(i, "<p>extra</p>" * (i % 3)) for i in range(10, 17)]
    saved = wrapper.induce(pages[:6])
    for i, html in enumerate(pages, 10):  # the last one was not drawn
        want = [f"T{i}", f"Own text of page {i}, which is longer than the box", *["extra"] * (i % 3), f"More of {i}"]
        assert wrapper.main_text(html, saved).split("\n\n") == want
    copies = [f"<p>{i}</p>" + pages[0] for i in range(6)]  # one article on six pages
    assert "Follow us" in wrapper.main_text(copies[0], wrapper.induce(copies))
    dated = ["<article><h1>Title</h1><p>The same long text on all of them</p><p>%d</p></article>" % i for i in range(6)]
    assert wrapper.main_text(dated[2], wrapper.induce(dated)) == "Title\n\nThe same long text on all of them\n\n2"


def test_the_slot_of_the_template_is_used():
    page = "<div><div><p>{0}</p><p>{0}</p></div><div><p>{1}</p></div></div>"
    saved = wrapper.induce([page.format(f"own words {i} " * 9, f"quote {i}") for i in range(6)])
    assert wrapper.main_text(page.format("own words here", "a quote of many words"), saved) == "own words here\n\nown words here"


@pytest.mark.parametrize("tag", ["div", "blockquote", "section"])
def test_deeply_nested_pages(tag):
    pages = [f"<p>Menu</p>{f'<{tag}>' * 20_000}<p>text {i}" for i in range(4)]
    pages += ["<body>" + "".join(f"<{tag}>line {k}" for k in range(20_000))]
    saved = wrapper.induce(pages[:4])
    assert wrapper.main_text(pages[3], saved) == "text 3"
    assert wrapper.main_text(pages[4], saved).endswith("line 19999")
    article = "<article>" + "".join(f"<{tag}>line {k}" for k in range(20_000))
    assert wrapper.main_text(article, saved).split("\n\n") == [f"line {k}" for k in range(20_000)]


def test_main_text_of_the_pages(spark, folder):
    found = QUERIES["op8_main_texts"](spark, folder).toPandas()
    assert len(found) == 50 and (found["n_chars"] == found["text"].map(len)).all() and (found["n_chars"] > 0).all()
    assert not found["text"].str.contains("©").any()


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_repeat_themselves(spark, folder, name):
    def rows():
        return sorted(map(repr, QUERIES[name](spark, folder).collect()))

    assert rows() == rows() != []
