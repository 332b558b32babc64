"""Every operator and stage on empty tables, and on rows with nulls, empty and very long texts, ties and repeats."""

import pytest

import corpus_pipeline
from residua.llm import langid, licenses, minhash, mixing, packing, suffixes, token_counts, vector_graph, vptree, wrapper

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, score double, words string, s string, place int"
LONG = " ".join(f"word{i % 977} and{i % 89}" for i in range(30_000))
NAN = float("nan")


def documents(spark, rows):
    return spark.createDataFrame([(*r, 7, 0.5, "x", "y", 3) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    plain = "the cat sat on the mat and looked at all of us for a very long time"
    return documents(
        spark,
        [
            (1, plain, "en", "a", 60),
            (1, plain, "en", "a", 60),
            (2, plain, None, None, None),
            (None, plain, "en", "a", 60),
            (3, None, "en", "a", None),
            (4, "", "fr", "b", 0),
            (5, "1234 !!", "fr", "b", 7),
            (6, LONG, "en", "b", len(LONG)),
            (7, LONG + " end", "en", "b", len(LONG)),
            (8, "x" * 50_000, "fr", "c", 50_000),
            (9, "le chat était assis sur le tapis et nous regardait longtemps", "fr", "c", 60),
        ],
    )


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def by(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_token_counts(odd, none):
    assert token_counts.token_counts(none).collect() == []
    found = token_counts.token_counts(odd)
    assert found.count() == 11
    rows = by(found)
    assert rows[3]["n_tokens"] == rows[4]["n_tokens"] == 0 < rows[8]["n_tokens"]


def test_near_duplicates(odd, none):
    assert minhash.near_duplicates(none).collect() == []
    found = minhash.near_duplicates(odd)
    assert found.count() == 11
    rows = by(found)
    assert rows[1]["class_id"] == rows[2]["class_id"] == 1 and not rows[2]["keep"]
    assert rows[6]["class_id"] == rows[7]["class_id"] == 6
    assert rows[None]["class_id"] is None and rows[None]["keep"]
    assert all(rows[i]["class_id"] == i for i in (3, 4, 5, 8, 9))


def test_mixing(odd, none):
    assert mixing.mix(none).collect() == []
    found = mixing.mix(odd)
    rows = by(found)
    assert found.count() == 11 and rows[2]["source"] == rows[2]["lang"] == mixing.NONE
    assert all(0 <= r["p"] <= 1 for r in rows.values())
    assert mixing.sampled(odd).columns == odd.columns


def test_repeated_passages(odd, none):
    assert suffixes.repeated_passages(none).collect() == []
    rows = suffixes.repeated_passages(odd).collect()
    assert [(r["doc_id"], r["first_word"], r["n_words"], r["kept_in"]) for r in rows] == [(7, 0, 60_000, [6])]
    cut = by(suffixes.cut_repeats(odd, suffixes.repeated_passages(odd)))
    assert cut[7]["text"] == " end" and cut[6]["text"] == LONG and cut[3]["text"] is None


def test_languages(spark, odd, none):
    langs, chance = langid.fitted(none)
    assert langs == []
    unknown = odd.select("doc_id", langid.predictor(spark, langs, chance)("text").alias("p")).select("doc_id", "p.*")
    assert {(r["lang_pred"], r["score"]) for r in unknown.collect()} == {("und", 0.0)}
    langs, chance = langid.fitted(odd)
    assert langs == ["en", "fr"]
    rows = by(odd.select("doc_id", langid.predictor(spark, langs, chance)("text").alias("p")).select("doc_id", "p.*"))
    assert {rows[i]["lang_pred"] for i in (3, 4, 5)} == {"und"} and rows[9]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_licenses(odd, none):
    assert licenses.license_scan(none).collect() == []
    rows = by(licenses.license_scan(odd))
    assert rows[3]["n_words"] == 0 and rows[3]["labels"] == "" and rows[3]["first_word"] is None
    assert rows[6]["n_words"] == 60_000 and rows[8]["n_words"] == 1


def test_packing(odd, none):
    def pack(docs):
        return packing.pack(docs.select("doc_id", packing.word_count(docs["text"]).alias("n_tokens")))

    assert pack(none).collect() == []
    found = pack(odd)
    assert found.count() == 11
    places = [(r["bucket"], r["batch"], r["slot"]) for r in found.collect()]
    assert len(set(places)) == 11


VECTORS = "vec_id long, embedding array<float>, label int, id long, node long, vec string"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [
        (0, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.0]),
        (4, None), (5, [0.0, 0.0, 0.0]), (6, [NAN, 1.0, 0.0]), (7, [None, 1.0, 0.0]), (8, [float("inf"), 1.0, 0.0]),
        (9, []), (10, [1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (50, [0.0, 2.0, 0.0]),
    ]
    return spark.createDataFrame([(i, v, 1, 5, 6, "z") for i, v in rows], VECTORS)


def test_vectors(spark, vectors):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_graph.near_vectors(empty).collect() == []
    assert vptree.nearest(empty, "id % 50 = 0").collect() == []
    rows = by(vector_graph.near_vectors(vectors), "vec_id")
    assert len(rows) == 12
    assert [rows[i]["n_links"] for i in (0, 1, 2, 3, 50)] == [2, 2, 2, 1, 1]
    assert [rows[i]["component_id"] for i in (0, 1, 2, 3, 50)] == [0, 0, 0, 3, 3]
    assert all(rows[i]["n_links"] == 0 and rows[i]["kept"] for i in (4, 5, 6, 7, 8, 9, 10))
    near = vptree.nearest(vectors, "id % 50 = 0").orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in near] == [
        (0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 50), (50, 1, 3), (50, 2, 2), (50, 3, 0), (50, 4, 1),
    ]


def test_pages(spark):
    kinds = "page_id long, url string, html string, host string, of string, template string"
    assert wrapper.page_texts(spark.createDataFrame([], kinds)).collect() == []
    long = "<p>" + "very long text " * 20_000
    rows = [
        (1, None, "<p>one</p>two"), (1, None, "<p>one</p>two"), (2, "http://h.example/x", None), (3, "http://h.example/y", ""),
        (4, "no url", "plain &amp; text"), (5, "http://h.example/z", long), (None, "http://h.example/z", "<ul><li>"),
    ]
    found = wrapper.page_texts(spark.createDataFrame([(*r, "a", "b", "c") for r in rows], kinds))
    assert found.count() == 7
    texts = {r["page_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    assert texts[1] == ("one\n\ntwo", 8) and texts[2] == texts[3] == texts[None] == ("", 0)
    assert texts[4] == ("plain & text", 12) and texts[5][1] == 15 * 20_000 - 1


def test_pipeline_stages(spark, odd, none):
    for docs in (none, odd):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            if name == "packing":
                assert out.columns == ["doc_id", "n_tokens", "bucket", "pad_to", "batch", "slot"]
            else:
                assert out.columns == docs.columns, name
            out.collect()


def test_pipeline_decisions(spark, odd):
    kept = corpus_pipeline.language(spark, odd, "")
    assert {3, 4, 5}.isdisjoint(r["doc_id"] for r in kept.collect())
    one = corpus_pipeline.near_duplicates(spark, kept, "")
    assert sorted(r["doc_id"] or -1 for r in one.collect()) == [-1, 1, 6, 8, 9]
    cut = by(corpus_pipeline.repeated_passages(spark, kept, ""))
    assert cut[7]["text"] == " end" and cut[7]["n_chars"] == 4 and cut[6]["n_chars"] == len(LONG)


@pytest.mark.parametrize("letters", [36, 40, 400, 40_000])
def test_long_words_without_pieces_have_a_score(spark, letters):
    """Letters that no piece covers say nothing about the language, however many follow one another."""
    from residua.llm import langid

    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    learned = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, chance = langid.fitted(learned)
    texts = ["the cat and the dog " + "ወ" * letters, "ወ" * letters, "ወ" * letters + " und die katze", "the cat and the dog"]
    found = learned.sparkSession.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(1)
    predict = langid.predictor(spark, langs, chance)
    by_row = {r["i"]: r["p"] for r in found.select("i", predict("text").alias("p")).collect()}
    assert all(p["score"] is not None and 0 <= p["score"] <= 1 for p in by_row.values())
    assert [by_row[i]["lang_pred"] for i in (0, 2, 3)] == ["en", "de", "en"]
    assert abs(by_row[0]["score"] - by_row[3]["score"]) < 1e-6 and by_row[0]["score"] > 0.9


def test_long_words_sum_all_segmentations():
    """With resets or without, the forward pass gives the same sums."""
    import numpy as np

    from residua.llm import langid

    words = ["unbelievablywonderful" * 3, "x", "internationalisation" * 12, "ወa" * 90]
    lattice = langid.lattice(words, langid.VOCABULARY)
    size = langid.piece_table(langid.VOCABULARY)[1]
    chance = langid.normalised(np.random.default_rng(1).random((size + 1, 2)) ** 8)
    got = lattice.log_chance(chance)
    for w, row in enumerate(got):
        rows = np.flatnonzero(lattice.word == w)
        for lang in (0, 1):
            total = np.full(lattice.sizes[w] + 1, -np.inf)
            total[0] = 0.0
            for i in rows:  # ordered by end
                step = total[lattice.start[i]] + np.log(chance[lattice.piece[i], lang])
                total[lattice.end[i]] = np.logaddexp(total[lattice.end[i]], step)
            assert abs(total[-1] - row[lang]) < 1e-6 * abs(total[-1])


def test_rows_that_share_an_id_leave_the_least_text(spark):
    rows = [(1, "b b b b b b", "en", "s", 11), (1, "a a a a a a", "en", "t", 11), (1, "c", "en", "u", 1), (2, "other words", "en", "s", 11)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string, source string, n_chars long")
        kept = corpus_pipeline.near_duplicates(spark, docs, "")
        assert sorted((r["doc_id"], r["text"], r["source"]) for r in kept.collect()) == [(1, "a a a a a a", "t"), (2, "other words", "s")]
