"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A document is the bag of its shingles: ``WIDTH`` consecutive words, or all its words if it has fewer.  A shingle weighs
its count in the document times ln(documents / frequency), where texts with the same words count as one document, so
that a large group of copies does not make its own shingles light.  Two documents are linked if the weighted Jaccard
similarity of their bags, sum of minima over sum of maxima, is ``THRESHOLD`` or more; a class is what links connect.

Frequencies are kept in a table of ``COUNTERS`` counters that every shingle of every document is hashed into: a count
sketch of one row, a fixed 2 MB at any input.  A counter holds the shingles of a fixed share of a document
beside those it is asked for, so rare shingles all weigh alike at any corpus size, and the shingles
of passages that many documents share weigh little.  Weights are at least ``LEAST``, so no shingle vanishes.

Signature: for each of BANDS x ROWS draws, every shingle gets a random age that depends on shingle, weight and
draw alone, and the youngest (with its quantised weight) is the sample; two documents agree in a draw with
probability equal to their similarity.  At 0.8 a pair shares no band with probability 2e-4.

Candidates lose nothing to large groups: documents with the same words are one node; each bucket is compared with its
most central node, what is linked is contracted, and only buckets that are still in several classes are
compared in full, as matrix products over blocks that yield one link for two classes.  A group of copies costs
its size, not its square, and pairs are never listed.

Null text, or text without a word, is in no group.  A null id is in no group and has a null class.  Rows that share
an id are one document (its least text counts for the links).  Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.llm.batches import batches_of
from residua.llm.components import components
from residua.llm.words import in_pieces, pieces, runs, scramble, words_of
from residua.session import stored

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3
COUNTERS = 1 << 18
LEAST = 0.05
POOL_BITS = 14
BLOCK = 256
FEATURES = 4096  # columns of a matrix product
TEXTS = 1000  # pairs of texts handed over at once
CHUNK = 400_000  # characters worked on at once
PAIRED = 8_000_000  # characters of pairs of texts compared at once


def all_words(words, n: np.ndarray) -> np.ndarray:
    """A hash of all words of each text, 0 for none; n: words per text."""
    order = np.zeros(len(n), np.uint64)
    if len(words.hash):
        mixed = scramble(words.hash + scramble(np.arange(len(words.hash), dtype=np.uint64) - words.first[words.text].astype(np.uint64)))
        full = np.flatnonzero(n)
        order[full] = scramble(np.add.reduceat(mixed, words.first[full]))
    return order


def shingles(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) sorted by both, one row per different shingle of a text; and a hash of all words per text."""
    words = words_of(texts)
    n = np.diff(words.first)
    at, bags = [], []
    if len(words.hash) >= WIDTH:
        whole = words.text[: len(words.text) - WIDTH + 1] == words.text[WIDTH - 1 :]
        at.append(words.text[: len(whole)][whole])
        bags.append(runs(words.hash, WIDTH)[whole])
    order = all_words(words, n)
    short = np.flatnonzero((n > 0) & (n < WIDTH))
    at.append(short)
    bags.append(order[short])
    text, bag = np.concatenate(at).astype(np.int64), np.concatenate(bags)
    by = np.lexsort((bag, text))
    text, bag = text[by], bag[by]
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (bag[1:] != bag[:-1])]) if len(text) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    return text[begin], bag[begin], np.diff(np.append(begin, len(text))), order


def bucket_of(bag: np.ndarray) -> np.ndarray:
    return (bag % np.uint64(COUNTERS)).astype(np.int64)


def different(docs: DataFrame) -> DataFrame:
    """(text) one text for each sequence of words."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in in_pieces(batch["text"], CHUNK):
                texts = list(batch["text"][s])
                words = words_of(texts)
                yield pd.DataFrame({"words": all_words(words, np.diff(words.first)).view(np.int64), "text": texts})

    named = docs.select("text").where("text IS NOT NULL").mapInPandas(of, "words long, text string")
    return named.groupBy("words").agg(F.min("text").alias("text")).select("text")


def frequencies(docs: DataFrame) -> np.ndarray:
    """ln(documents / frequency) for every counter, from the whole text of every different document."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        texts = 0
        for batch in batches:
            column = batch["text"]
            for s in in_pieces(column, CHUNK):
                text, bag, _, _ = shingles(list(column[s]))
                total += np.bincount(bucket_of(bag), minlength=COUNTERS)
                texts += len(np.unique(text))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"counter": np.append(at, -1).astype(np.int32), "n": np.append(total[at], texts)})

    sums = different(docs).mapInPandas(counted, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    total = np.ones(COUNTERS)
    places = found["counter"] >= 0
    total[found["counter"][places]] = found["n"][places]
    texts = max(2, int(found["n"][~places].sum()))
    return np.maximum(LEAST, np.log(texts / total)).astype(np.float32)


@lru_cache(maxsize=1)
def pool() -> list[tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray]]:
    """For each draw an odd factor, and tables of r, ln c and beta that a shingle's hash picks from."""
    rng = np.random.default_rng(2010)
    size = 1 << POOL_BITS
    factors = rng.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return [
        (
            f,
            rng.gamma(2.0, size=size).astype(np.float32),
            np.log(rng.gamma(2.0, size=size)).astype(np.float32),
            rng.random(size=size).astype(np.float32),
        )
        for f in factors
    ]


def signatures(text: np.ndarray, bag: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have shingles, and their BANDS band hashes."""
    begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else np.zeros(0, np.int64)
    bands = np.zeros((len(begin), BANDS), np.uint64)
    if not len(begin):
        return text[begin], bands
    size = np.diff(np.append(begin, len(text)))
    rank = np.repeat(np.arange(len(begin)), size)
    log_weight = np.log(weight)
    for k, (factor, r, log_c, beta) in enumerate(pool()):
        pick = ((bag * factor) >> np.uint64(64 - POOL_BITS)).astype(np.int64)
        step, shift = r[pick], beta[pick]
        t = np.floor(log_weight / step + shift)
        age = log_c[pick] - step * (t - shift + 1)
        least = np.minimum.reduceat(age, begin)
        youngest = np.flatnonzero(age == least[rank])
        youngest = youngest[np.concatenate([[True], rank[youngest[1:]] != rank[youngest[:-1]]])]
        draw = scramble(bag[youngest] + scramble(t[youngest].astype(np.int64).astype(np.uint64)))
        bands[:, k // ROWS] = scramble(bands[:, k // ROWS] * np.uint64(3) + draw + np.uint64(k))
    return text[begin], bands


def sketch(docs: DataFrame, idf) -> DataFrame:
    """(id, words, bands): a hash of all words, and the band hashes; nothing for a text without words."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in in_pieces(batch["text"], CHUNK):
                part = batch.iloc[s]
                text, bag, count, order = shingles(list(part["text"]))
                weight = count * idf.value[bucket_of(bag)]
                here, bands = signatures(text, bag, weight.astype(np.float32))
                yield pd.DataFrame(
                    {"id": part["id"].to_numpy()[here], "words": order[here].view(np.int64), "bands": list(bands.view(np.int64))}
                )

    return docs.mapInPandas(of, "id long, words long, bands array<long>")


def weighted(texts: Sequence[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count, weight of one) of all texts, sorted by text and shingle."""
    parts = []
    for s in in_pieces(texts, CHUNK):
        text, bag, count, _ = shingles(texts[s])
        parts.append((text + s.start, bag, count, idf[bucket_of(bag)].astype(np.float64)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def similar(pairs: DataFrame, idf, threshold: float) -> DataFrame:
    """(a, b) of the (a, b, text_a, text_b) rows with at least the threshold as weighted Jaccard similarity."""

    def good(batch: pd.DataFrame) -> list[bool]:
        texts = dict(zip(batch["a"], batch["text_a"])) | dict(zip(batch["b"], batch["text_b"]))
        text, bag, count, one = weighted(list(texts.values()), idf.value)
        edge = np.searchsorted(text, np.arange(len(texts) + 1))
        place = {name: slice(edge[i], edge[i + 1]) for i, name in enumerate(texts)}
        found = []
        for a, b in zip(batch["a"], batch["b"]):
            p, q = place[a], place[b]
            u, v = count[p] * one[p], count[q] * one[q]
            at = np.minimum(np.searchsorted(bag[p], bag[q]), len(u) - 1)
            both = bag[p][at] == bag[q]
            low = np.minimum(u[at[both]], v[both]).sum()
            found.append(low >= threshold * (u.sum() + v.sum() - low) * (1 - 1e-12))
        return found

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in pieces((batch["text_a"].str.len() + batch["text_b"].str.len()).tolist(), PAIRED):
                part = batch.iloc[s]
                yield part.loc[good(part), ["a", "b"]]

    return pairs.mapInPandas(of, "a long, b long")


def overlaps(n: int, text: np.ndarray, bag: np.ndarray, count: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Sum of minima of every two of ``n`` texts.

    A shingle that stands c times counts as c features, the first, second and so on, so that the minimum of two
    counts is the number of common features, and all sums of minima are one matrix product.
    """
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    text, one = np.repeat(text, count), np.repeat(one, count)
    names = scramble(np.repeat(bag, count) + nth.astype(np.uint64))
    _, column, times = np.unique(names, return_inverse=True, return_counts=True)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[column]
    order = np.argsort(column, kind="stable")
    text, column, one = text[order], column[order], np.sqrt(one[order])
    total = np.zeros((n, n))
    for low in range(0, int(column.max(initial=-1)) + 1, FEATURES):
        s = slice(*np.searchsorted(column, [low, low + FEATURES]))
        dense = np.zeros((n, FEATURES))
        dense[text[s], column[s] - low] = one[s]
        total += dense @ dense.T
    return total


def block_links(rows: DataFrame, idf, threshold: float) -> DataFrame:
    """Links between different classes within each block of (band, value, one, two, node, part, text) rows.

    Of several links between the same two classes one is enough.
    """

    def of(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("node")
        if len(block) < 2:
            return pd.DataFrame({"a": [], "b": []})
        text, bag, count, one = weighted(list(block["text"]), idf.value)
        low = overlaps(len(block), text, bag, count, one)
        size = np.bincount(text, count * one, minlength=len(block))
        near = low >= threshold * (size[:, None] + size[None, :] - low) * (1 - 1e-12)
        part, node = block["part"].to_numpy(), block["node"].to_numpy()
        a, b = np.nonzero(near & (part[:, None] < part[None, :]))
        _, first = np.unique(np.stack([part[a], part[b]]), axis=1, return_index=True)
        return pd.DataFrame({"a": node[a[first]], "b": node[b[first]]})

    return rows.groupBy("band", "value", "one", "two").applyInPandas(of, "a long, b long")


def classes_of(buckets: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """(id, component) of the nodes with links, from (band, value, node, rank) rows and (id, text) rows.

    The node of highest rank in each bucket is compared with the whole bucket, and what is linked is contracted.
    Buckets whose nodes are then still in several classes are compared in full, in blocks of two times
    BLOCK nodes, without listing their pairs.
    """
    key = ["band", "value"]
    top = F.max(F.struct("rank", (-F.col("node")).alias("minus"))).alias("top")
    heads = buckets.groupBy(*key).agg(top).select(*key, (-F.col("top.minus")).alias("a"))
    pairs = buckets.join(heads, key).where("node <> a").select("a", F.col("node").alias("b")).distinct()
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    links = stored(similar(pairs.join(one, "a").join(two, "b"), idf, threshold), "minhash-links")
    parts = stored(components(links), "minhash-parts").withColumnRenamed("id", "node")
    within = buckets.join(parts, "node", "left").select(*key, "node", F.coalesce("component", "node").alias("part"))
    sizes = within.groupBy(*key).agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    live = within.join(sizes.where("low < high").select(*key, "blocks"), key)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    live = live.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    live = stored(live.where("blocks = 1 OR own <> other"), "minhash-open")
    blocks = live.select(
        *key, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "part", F.col("node").alias("id")
    )
    rest = stored(block_links(blocks.join(texts, "id").withColumnRenamed("id", "node"), idf, threshold), "minhash-rest")
    return stored(components(links.union(rest)), "minhash-parts")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, class_id, keep) of every row: class_id is the smallest id of its class, which ``keep`` marks.

    Bands are made for similarities of 0.8 and more; a smaller threshold would miss pairs.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    idf = spark.sparkContext.broadcast(frequencies(rows))
    named = rows.where("id IS NOT NULL AND text IS NOT NULL")
    sketched = stored(sketch(named, idf), "minhash")
    one = F.min(F.struct("words", "bands")).alias("s")
    nodes = stored(sketched.groupBy("id").agg(one).select("id", "s.*"), "minhash-documents")
    classes = nodes.groupBy("words").agg(F.min("id").alias("node"), F.first("bands").alias("bands"))
    classes = stored(classes, "minhash-nodes")
    hashed = classes.select("node", F.posexplode("bands").alias("band", "value"))
    groups = hashed.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    grouped = stored(hashed.join(groups, ["band", "value"]), "minhash-grouped")
    # a node that shares its bands with many is the likeliest to be linked with many
    rank = grouped.groupBy("node").agg(F.sum("n").alias("rank"))
    buckets = stored(grouped.drop("n").join(rank, "node"), "minhash-buckets")
    involved = buckets.select(F.col("node").alias("id")).distinct()
    texts = named.join(involved, "id").groupBy("id").agg(F.min("text").alias("text"))
    texts = stored(texts, "minhash-texts")

    with batches_of(spark, TEXTS):
        parts = classes_of(buckets, texts, idf, threshold)
    by_node = classes.select("words", "node").join(parts, F.col("node") == F.col("id"), "left")
    by_node = by_node.select("words", F.coalesce("component", "node").alias("class_id"))
    by_id = nodes.select("id", "words").join(by_node, "words").select("id", "class_id")
    out = rows.select("id").join(by_id, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))
    keep = F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("keep")
    return out.select(F.col("id").alias(id_col), "class_id", keep)
