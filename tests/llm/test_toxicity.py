"""The label model on votes drawn from a known one, the classifier on held-out labels, voters and edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.llm import toxicity as X
from residua.llm.queries import all_queries

HELD_OUT = "crc32(CAST(doc_id AS STRING)) % 5 = 0"
DOCS, LABELS = "doc_id long, text string, lang string, source string", "doc_id long, quality int, toxic int"


def drawn(rng, n, prior, fires, copies=()):
    """Votes of a known model; voter j of a pair (j, k) mostly repeats voter k."""
    y = rng.random(n) < prior
    bits = rng.random((n, fires.shape[1])) < fires[y.astype(int)]
    for j, k in copies:
        again = rng.random(n) < 0.8
        bits[again, j] = bits[again, k]
    return y, bits @ (1 << np.arange(fires.shape[1]))


def counted(votes, label):
    keys, n = np.unique(np.stack([votes, label]), axis=1, return_counts=True)
    return keys[0], keys[1], n.astype(float)


FIRES = np.array([[0.02, 0.05, 0.1, 0.3, 0.05], [0.9, 0.7, 0.6, 0.35, 0.7]])


@pytest.mark.parametrize("share", [0.0, 0.2])
def test_label_model_finds_accuracies(share):
    rng = np.random.default_rng(1)
    y, votes = drawn(rng, 60_000, 0.2, FIRES)
    label = np.where(rng.random(len(y)) < share, y ^ (rng.random(len(y)) < 0.05), -1).astype(int)
    model = X.fit_label_model(*counted(votes, label), voters=5)
    assert np.abs(model.fires() - FIRES).max() < 0.05 and abs(model.prior - 0.2) < 0.03
    if share:
        assert abs(model.label_error - 0.05) < 0.02
    posterior = model.posterior(votes, np.full(len(votes), -1))
    assert ((posterior >= 0.5) == y).mean() > 0.95


def test_label_model_does_not_count_a_copied_voter_twice():
    rng = np.random.default_rng(2)
    y, votes = drawn(rng, 80_000, 0.3, FIRES, copies=[(4, 1)])
    label = np.where(rng.random(len(y)) < 0.3, y, -1).astype(int)
    model = X.fit_label_model(*counted(votes, label), voters=5)
    assert (1, 4) in model.pairs and model.correlation[model.pairs.index((1, 4))] > 1
    both = votes == (1 << 1 | 1 << 4)
    truth, told = y[both].mean(), model.posterior(votes[both], np.full(both.sum(), -1)).mean()
    naive = X.fit_label_model(*counted(votes, label), voters=5, related=2.0)
    apart = naive.posterior(votes[both], np.full(both.sum(), -1)).mean()
    assert abs(told - truth) < 0.05 < abs(apart - truth)


def test_posterior_is_bayes_rule_over_all_patterns():
    rng = np.random.default_rng(3)
    model = X.LabelModel(0.25, rng.normal(size=(2, 4)), [(0, 2), (1, 3)], rng.normal(size=2), 0.1)

    def joint(bits, y):
        energy = sum(model.accuracy[y, j] * b for j, b in enumerate(bits))
        return np.exp(energy + sum(c * bits[j] * bits[k] for (j, k), c in zip(model.pairs, model.correlation)))

    every = [[(v >> j) & 1 for j in range(4)] for v in range(16)]
    norm = [sum(joint(b, y) for b in every) for y in (0, 1)]
    for v, bits in enumerate(every):
        for label, witness in ((-1, (1, 1)), (1, (0.1, 0.9)), (0, (0.9, 0.1))):
            up = 0.25 * joint(bits, 1) / norm[1] * witness[1]
            down = 0.75 * joint(bits, 0) / norm[0] * witness[0]
            assert model.posterior(np.array([v]), np.array([label]))[0] == pytest.approx(up / (up + down))


def test_linear_classifier_separates():
    rng = np.random.default_rng(4)
    at = [sorted(rng.choice(20, 5, replace=False).tolist()) for _ in range(2000)]
    target = np.array([float(3 in a or 7 in a) for a in at])
    w, base = X.fit_linear(at, [[1.0] * 5] * 2000, target, 20)
    told = np.array([base + sum(w[i] for i in a) for a in at]) > 0
    assert (told == target).mean() > 0.99 and X.fit_linear([], [], np.zeros(0), 3)[0].tolist() == [0, 0, 0]


def test_voters():
    reader = X.Reader({"=grobu": 4.0, "^gro": 2.0, "^xyzab": 5.0})

    def fired(text):
        bits = reader.read(text)[0]
        return {name for i, name in enumerate(X.VOTERS) if bits >> i & 1}

    assert fired(None) == fired("") == fired("words of no list at all") == set()
    assert fired("Grobu") == {"word_strong", "short_medium"}
    assert fired("a xyzabc there") == {"middle_strong"}
    assert fired("You are an IDIOT") == {"public_list", "addressed_insult"}
    assert fired("idiot " + "word " * 400) == set()
    assert fired("WHAT IS THIS THING") == {"shouting"}
    assert fired("no!!!") == fired("sh**t happens") == {"marks_or_masks"}


BAD = ["grobu", "miklar", "vontes"]


def corpus(n, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulrnst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 150))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(max(2, len(text) // 30)):
                text.insert(rng.randrange(len(text)), rng.choice(BAD) + rng.choice(["", "el", "ant", "isch"]))
        docs.append((i, " ".join(text), "xx", "s"))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic != (rng.random() < 0.01))))
    return docs, labels, {i for i, t, *_ in docs if any(b in t for b in BAD)}


def run(spark, folder, docs, labels):
    spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS votes", "2 AS id", "3 AS toxic").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' AS text").write.parquet(f"{folder}/labels.parquet")
    return all_queries()["op12_toxicity"](spark, str(folder))


def test_query_on_labels_it_never_saw(spark, tmp_path):
    docs, labels, bad = corpus(3000)
    docs += [(5000, None, None, None), (5001, "", None, None), (None, docs[0][1], None, None)]
    got = run(spark, tmp_path / "a", docs + docs[:3], labels)
    rows = got.collect()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == 3006
    by_id = {r["doc_id"]: r for r in rows}
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 3000]
    caught = [r["predicted"] for r in held if r["doc_id"] in bad]
    blamed = [r["predicted"] for r in held if r["doc_id"] not in bad]
    assert np.mean(caught) > 0.97 and np.mean(blamed) < 0.01
    assert by_id[5000]["score"] == by_id[5001]["score"] < 0.5
    assert len({r["score"] for r in rows if r["doc_id"] in (None, 0)}) == 1

    # labels of held-out documents change nothing
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = {r["doc_id"]: r["score"] for r in run(spark, tmp_path / "b", docs + docs[:3], turned).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in by_id.items())


def test_a_group_of_copies_does_not_make_its_words_toxic(spark):
    docs, labels, _ = corpus(1500, seed=6)
    text = "perfectly ordinary sentence about gardens " * 3
    docs += [(10_000 + i, text, None, None) for i in range(800)]
    labels += [(10_000 + i, 1, 1) for i in range(800)]
    _, model = X.toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), HELD_OUT)
    assert not any("garden" in e or "perfec" in e for e in model.lexicon) and any("grobu" in e for e in model.lexicon)


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "you idiot", None, None), (2, "kind words", None, None), (3, None, None, None)], DOCS)
    nothing = spark.createDataFrame([], LABELS)
    scored, model = X.toxicity(docs, nothing, HELD_OUT)
    found = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert model.lexicon == {} and found[1] > found[2] == found[3]
    assert X.toxicity(docs.limit(0), nothing)[0].count() == 0
    nulls = spark.createDataFrame([(1, 1, None), (2, 1, 0), (2, 1, 1), (None, 1, 1)], LABELS)
    assert X.toxicity(docs, nulls)[0].where(F.col("score").isNull()).count() == 0
