"""Repeated passages across documents, by sparse suffix arrays over words.

Suffixes are kept only at minimisers: of every ``REACH`` consecutive ``GRAM``-word runs, the place of the least hash.
The choice depends on content alone, so each passage of ``PASSAGE`` words has a kept suffix among its first
REACH words, at the same place in every copy, and its first ``KEY`` words lie inside the passage.

1. Suffixes are brought together by their first KEY words, as neighbours in a suffix array are, and only those that
   stand in more than one document go on.  Groups are aggregated before they are shuffled, so a passage
   that every document holds costs each task one row.
2. Matches are extended to the left and the right.  Where all suffixes of a group go on alike, REACH - 1 words to the
   left and PASSAGE to the right, that whole stretch repeats.  Elsewhere every stretch of PASSAGE words that belongs
   to the suffix (whose first REACH runs choose it) is compared the same way.  A word is repeated if and only if a stretch of PASSAGE words around it is.

Each repeated stretch belongs to the smallest doc_id that holds it, where it stays; it repeats in all others.
Overlapping stretches of one document are joined to the longest span.  A passage that only one document
repeats within itself is left alone.

Texts are worked on whole.  Null text, and text under PASSAGE words, has no spans.  A null id takes no part.  Rows
that share an id are copies of one row: none repeats because of the others.  Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.llm.batches import batches_of
from residua.llm.words import Words, in_pieces, runs, utf8, windows, words_of
from residua.session import stored

PASSAGE = 51
GRAM, REACH = 8, 40
KEY = PASSAGE - REACH + 1
CHUNK = 400_000
TEXTS = 500  # texts handed over at once
SPAN = "array<struct<start:int,end:int,owner:bigint>>"


def minimisers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Start of every REACH-run window that lies in one text, and its kept suffix; both as word indexes."""
    grams = runs(words.hash, GRAM)
    if len(grams) < REACH:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, REACH)
    start = np.flatnonzero(words.text[: len(view)] == words.text[REACH + GRAM - 2 :][: len(view)])
    picked = [a + view[a].argmin(axis=1) for a in np.array_split(start, max(1, len(start) // 20_000))]
    return start, np.concatenate(picked)


def suffix_keys(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word index, key, hash of the surroundings, whether there are such) of every suffix with KEY words."""
    at = np.unique(minimisers(words)[1])
    at = at[at + KEY <= words.first[words.text[at] + 1]]
    key = runs(words.hash, KEY)[at] if len(at) else np.empty(0, np.uint64)
    wide = np.zeros(len(at), np.uint64)
    begin = at - (REACH - 1)
    full = (begin >= words.first[words.text[at]]) & (at + PASSAGE <= words.first[words.text[at] + 1])
    if full.any():
        wide[full] = windows(words.hash, REACH - 1 + PASSAGE)[begin[full]]
    return at, key, wide, full


def suffixes(docs: DataFrame) -> DataFrame:
    """(id, place, key, wide) of every kept suffix; place counts words; wide is null near the text's ends."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in in_pieces(batch["text"], CHUNK):
                part = batch.iloc[s]
                words = words_of(list(part["text"]))
                at, key, wide, full = suffix_keys(words)
                text = words.text[at]
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy()[text],
                        "place": (at - words.first[text]).astype(np.int32),
                        "key": key.view(np.int64),
                        "wide": pd.array(wide.view(np.int64), dtype="Int64"),
                    }
                ).assign(wide=lambda d, full=full: d["wide"].where(full))

    return docs.mapInPandas(of, "id long, place int, key long, wide long")


def stretches(marked: DataFrame) -> DataFrame:
    """(hash, id, start) of the PASSAGE-word stretches that belong to the suffixes at ``places``."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in in_pieces(batch["text"], CHUNK):
                part = batch.iloc[s]
                words = words_of(list(part["text"]))
                start, kept = minimisers(words)
                sizes = [len(p) for p in part["places"]]
                first = np.repeat(words.first[:-1], sizes)
                wanted = np.concatenate([np.asarray(p, np.int64) for p in part["places"]]) + first
                start = start[np.isin(kept, wanted)]
                start = start[start + PASSAGE <= words.first[words.text[start] + 1]]
                if len(start):
                    text = words.text[start]
                    found = {
                        "hash": windows(words.hash, PASSAGE)[start].view(np.int64),
                        "id": part["id"].to_numpy()[text],
                        "start": (start - words.first[text]).astype(np.int32),
                    }
                    yield pd.DataFrame(found)

    return marked.mapInPandas(of, "hash long, id long, start int")


def shared(rows: DataFrame, key: str, *more) -> DataFrame:
    """Keys that stand in several documents, with the smallest of these as ``owner``.

    Written out: a join with it then has one row per key on this side and plain rows on the other, so that the rows
    of a key with very many of them can be split.
    """
    groups = rows.groupBy(key).agg(F.min("id").alias("owner"), F.max("id").alias("last"), *more)
    return stored(groups.where("owner < last").drop("last"), f"shared-{key}")


def joined_spans(stretched: DataFrame) -> DataFrame:
    """Overlapping or touching stretches of a document (array column) as its longest spans, with their owners."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, found in zip(batch["id"], batch["spans"]):
                found = sorted((x["start"], x["end"], x["owner"]) for x in found)
                begin, end, owners = found[0][0], found[0][1], set()
                for start, stop, owner in found:
                    if start > end:
                        out.append((name, begin, end - begin, sorted(owners)))
                        begin, end, owners = start, stop, set()
                    end = max(end, stop)
                    owners.add(owner)
                out.append((name, begin, end - begin, sorted(owners)))
            yield pd.DataFrame(out, columns=["id", "first_word", "n_words", "kept_in"])

    return stretched.mapInPandas(of, "id long, first_word int, n_words int, kept_in array<long>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first_word, n_words, kept_in) per repeated span; kept_in: the documents in which its parts stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL")
    with batches_of(docs.sparkSession, TEXTS):
        kept = stored(suffixes(rows), "suffixes")
    alike = F.count("*") == F.count("wide")
    alike = (alike & (F.min("wide") == F.max("wide"))).alias("alike")
    met = stored(kept.select("id", "place", "key").join(shared(kept, "key", alike), "key"), "suffix-matches")
    whole = met.where("alike AND id <> owner").select(
        "id", (F.col("place") - REACH + 1).alias("start"), (F.col("place") + PASSAGE).alias("end"), "owner"
    )
    marked = met.where("NOT alike").groupBy("id").agg(F.collect_list("place").alias("places"))
    with batches_of(docs.sparkSession, TEXTS):
        parts = stored(stretches(rows.join(marked, "id")), "stretches")
    cut = parts.join(shared(parts, "hash"), "hash").where("id <> owner")
    cut = cut.select("id", "start", (F.col("start") + PASSAGE).alias("end"), "owner")
    spans = whole.union(cut).groupBy("id").agg(F.collect_list(F.struct("start", "end", "owner")).alias("spans"))
    return joined_spans(spans).withColumnRenamed("id", id_col)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words (first, number) of each span and what stands between them."""
    words = words_of([text])
    raw, out, at = utf8(text), [], 0
    for first, n in sorted(spans):
        if first >= len(words.start):
            break
        last = min(first + n, len(words.start)) - 1
        out.append(raw[at : words.start[first]])
        at = max(at, int(words.end[last]))
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def cut_repeats(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of their texts, in the same columns."""
    by_doc = spans.groupBy(id_col).agg(F.collect_list(F.struct("first_word", "n_words")).alias("__spans"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        done = [
            t if t is None or s is None else without(t, [(x["first_word"], x["n_words"]) for x in s])
            for t, s in zip(texts, spans)
        ]
        return pd.Series(done, dtype=object)

    both = docs.join(by_doc, id_col, "left")
    changed = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(cut(text_col, "__spans"))
    return both.withColumn(text_col, changed).select(*docs.columns)
