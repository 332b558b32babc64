"""Language identification by unigram pieces, summed over all segmentations of each word.

The pieces are those of a fixed public vocabulary.  For each language the model has one probability per
piece.  The probability of a word is the sum over all its segmentations of the product of its pieces'
probabilities, which a forward pass gives without listing them; a text is the product of its words.
The posterior over the languages, all equally likely beforehand, is the score.

Learning is expectation-maximisation: a forward-backward pass spreads every word of the labelled sample over its
pieces, and the pieces' expected counts, smoothed, give the next probabilities.  The sample is about
``sample_docs`` labelled documents of each language (a documented bound, 300; drawn by a hash of id and text), and
only the model is fitted on it: every document is scored, and whole.  What reaches the driver is the
piece table, at most pieces x languages numbers.

A word is a run of letters, lower-cased, with the mark U+2581 before it, whatever its length.  A character that no piece
covers has one small probability, the same for every language.  The forward pass works on probabilities times a
constant for every character, and sets them back to about 1 every few characters of a long word, so
that no product leaves the range of doubles.  (Only learning cuts words over 40 letters into parts of 40.)

Null text, or text without a letter: ``und`` with score 0.  With nothing to learn from, every text is ``und``.
A tie of two languages goes to the one first in alphabetical order.  Repeated rows give repeated results; a
document without an id takes no part in learning.  Other columns do not matter.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.llm.token_counts import MARK, VOCABULARY, vocabulary
from residua.llm.words import in_pieces
from residua.session import stored

UNDETERMINED = "und"
SAMPLE_DOCS = 300
ROUNDS = 3
SMOOTH = 0.05
LOST = 1e-9  # probability of a character that no piece covers
LONGEST = 40
LONGEST_PIECE = 64
SCALE = 1e4  # for every character; between the chance of a letter and that of a lost one
SCALES = SCALE ** np.arange(LONGEST_PIECE + 1.0)
RESET_EVERY = 16
POSITIONS = 200_000  # of words worked on together
BREAK = "\n"  # in no word and in no piece
WORD = regex.compile(r"\p{L}+")
CHUNK = 500_000
REMEMBERED = 250_000


def whole_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_list(text: str | None) -> list[str]:
    """Words to learn from: long ones in parts."""
    found = whole_words(text)
    if max(map(len, found), default=0) <= LONGEST:
        return found
    return [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]


def usable(piece: str) -> bool:
    return bool(regex.fullmatch(rf"{MARK}?\p{{L}}*", piece)) and piece == piece.lower() and piece != ""


class Lattice:
    """All places where pieces stand in marked words, as arrays ordered by their end.

    Row i says: piece ``piece[i]`` stands in word ``word[i]`` from ``start[i]`` to ``end[i]``; piece -1 is a
    character that no piece covers by itself.
    """

    def __init__(self, automaton: ahocorasick.Automaton, words: Sequence[str]):
        text = BREAK.join([MARK + w for w in words])
        self.sizes = np.array([len(w) + 1 for w in words], np.int64)
        begins = np.cumsum(self.sizes + 1) - self.sizes - 1
        found = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
        end, size, piece = found[:, 0] + 1, found[:, 1] % LONGEST_PIECE, found[:, 1] // LONGEST_PIECE
        lost = np.ones(len(text), bool)
        lost[(begins - 1)[1:]] = False
        lost[end[size == 1] - 1] = False
        alone = np.flatnonzero(lost)
        start = np.concatenate([end - size, alone])
        end = np.concatenate([end, alone + 1])
        piece = np.concatenate([piece, np.full(len(alone), -1)])
        word = np.searchsorted(begins, start, side="right") - 1
        start, end = start - begins[word], end - begins[word]
        order = np.argsort(end * len(words) + word, kind="stable")
        self.end, self.word, self.start, self.piece = end[order], word[order], start[order], piece[order]
        self.longest = int(self.sizes.max(initial=0))
        self.steps = np.searchsorted(self.end, np.arange(self.longest + 2))

    def forward(self, chance: np.ndarray) -> np.ndarray:
        """Summed probability of every beginning of every word, times ``SCALE`` for each of its characters.

        chance: pieces (last: lost) x languages.
        """
        total = np.zeros((self.longest + 1, len(self.sizes), chance.shape[1]))
        total[0] = 1.0
        for e in range(1, self.longest + 1):
            self.step(total, e, chance)
        return total

    def step(self, total: np.ndarray, e: int, chance: np.ndarray) -> None:
        s = slice(self.steps[e], self.steps[e + 1])
        scale = SCALES[e - self.start[s]]
        self.add(total[e], self.word[s], total[self.start[s], self.word[s]] * chance[self.piece[s]] * scale[:, None])

    @staticmethod
    def add(target: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
        """target[at] += values; equal places in ``at`` stand together."""
        if len(at):
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            target[at[cut]] += np.add.reduceat(values, cut, axis=0)

    def log_chance(self, chance: np.ndarray) -> np.ndarray:
        """Log probability of every word by language; words of any length."""
        if self.longest <= LONGEST + 1:
            total = self.forward(chance)
            return np.log(total[self.sizes, np.arange(len(self.sizes))]) - self.sizes[:, None] * np.log(SCALE)
        total = np.zeros((self.longest + 1, len(self.sizes), chance.shape[1]))
        total[0] = 1.0
        lifted, result = np.zeros(total.shape[1:]), np.zeros(total.shape[1:])
        ending = np.argsort(self.sizes, kind="stable")
        ends = np.searchsorted(self.sizes[ending], np.arange(self.longest + 2))
        for e in range(1, self.longest + 1):
            self.step(total, e, chance)
            done = ending[ends[e] : ends[e + 1]]
            result[done] = np.log(total[e, done]) + lifted[done]
            if e % RESET_EVERY == 0:
                size = np.where(total[e] > 0, total[e], 1.0)
                total[max(0, e - LONGEST_PIECE) : e + 1] /= size
                lifted += np.log(size)
        return result - self.sizes[:, None] * np.log(SCALE)

    def expected(self, chance: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected count of every piece; chance: one language's column; weight: copies of every word."""
        ahead = self.forward(chance)[:, :, 0]
        behind = np.zeros_like(ahead)
        behind[self.sizes, np.arange(len(self.sizes))] = 1.0
        whole = ahead[self.sizes, np.arange(len(self.sizes))]
        for e in range(self.longest, 0, -1):
            s = slice(self.steps[e], self.steps[e + 1])
            scaled = chance[self.piece[s], 0] * SCALES[e - self.start[s]]
            np.add.at(behind, (self.start[s], self.word[s]), behind[e, self.word[s]] * scaled)
        scaled = chance[self.piece, 0] * SCALES[self.end - self.start]
        share = ahead[self.start, self.word] * scaled * behind[self.end, self.word]
        counts = np.zeros(len(chance))
        np.add.at(counts, self.piece, share / whole[self.word] * weight[self.word])
        return counts


@lru_cache(maxsize=2)
def piece_table(path: str) -> tuple[ahocorasick.Automaton, int]:
    """The pieces' automaton, whose values hold a piece's number and length, and how many there are."""
    pieces = [p for p, _ in vocabulary(path) if usable(p) and len(p) < LONGEST_PIECE]
    automaton = ahocorasick.Automaton()
    for i, piece in enumerate(pieces):
        automaton.add_word(piece, i * LONGEST_PIECE + len(piece))
    automaton.make_automaton()
    return automaton, len(pieces)


def lattice(words: Sequence[str], path: str) -> Lattice:
    return Lattice(piece_table(path)[0], words)


def normalised(counts: np.ndarray) -> np.ndarray:
    """Expected counts to probabilities, one column per language; the last row is the lost character."""
    chance = counts + SMOOTH
    chance /= chance[:-1].sum(axis=0)
    chance[-1] = LOST
    return chance


def sampled(labelled: DataFrame, sample_docs: int) -> DataFrame:
    """About ``sample_docs`` rows of each language, drawn by a hash of the row."""
    counts = labelled.groupBy("lang").agg(F.count("*").alias("there"))
    drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < F.lit(float((1 << 30) * sample_docs)) / F.col("there")
    # written out: a handful of rows whose size is known, so that the texts stay where they are
    return labelled.join(stored(counts, "langid-counts"), "lang").where(drawn).select("lang", "text")


def learn(
    labelled: DataFrame, path: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS
) -> tuple[list[str], np.ndarray]:
    """Languages, and probabilities of pieces by language, from (id, text, lang) rows."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in in_pieces(batch["text"], CHUNK):
                rows = Counter((lang, w) for lang, t in zip(batch["lang"][s], batch["text"][s]) for w in word_list(t))
                yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["lang", "word", "n"])

    sample = sampled(labelled, sample_docs).mapInPandas(counted, "lang string, word string, n long")
    words = stored(sample.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    _, size = piece_table(path)
    chance = normalised(np.ones((size + 1, max(1, len(langs)))))
    for _ in range(rounds if langs else 0):
        sent = words.sparkSession.sparkContext.broadcast(chance)

        def expected(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for lang, part in batch.groupby("lang"):
                    column = sent.value[:, [langs.index(lang)]]
                    for i in range(0, len(part), 5000):
                        rows = part.iloc[i : i + 5000]
                        counts = lattice(list(rows["word"]), path).expected(column, rows["n"].to_numpy(float))
                        at = np.flatnonzero(counts[:-1])
                        yield pd.DataFrame({"lang": lang, "piece": at, "n": counts[at]})

        totals = words.mapInPandas(expected, "lang string, piece long, n double")
        found = totals.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros_like(chance)
        counts[found["piece"], [langs.index(x) for x in found["lang"]]] = found["n"]
        chance = normalised(counts)
    return langs, chance


class Scorer:
    """Log probability of texts by language; remembers words it has seen, up to a bound."""

    def __init__(self, langs: list[str], chance: np.ndarray, path: str):
        self.langs, self.chance, self.path = langs, chance, path
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, len(self.langs)))

    def learn_words(self, new: list[str]) -> None:
        new = sorted(new, key=len)  # words of like length together
        parts, at = [], 0
        while at < len(new):
            size = max(1, min(5000, POSITIONS // (len(new[at]) + 1)))
            group = new[at : at + size]
            while len(group) > 1 and len(group) * (len(group[-1]) + 1) > 2 * POSITIONS:
                group = group[: len(group) // 2]
            parts.append(lattice(group, self.path).log_chance(self.chance))
            at += len(group)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.table = np.concatenate([self.table, *parts])

    def scores(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        lists = [whole_words(t) for t in texts]
        if len(self.place) > REMEMBERED:
            self.forget()
        new = list(dict.fromkeys(w for words in lists for w in words if w not in self.place))
        if new and self.langs:
            self.learn_words(new)
        langs, best = [], np.zeros(len(lists))
        for i, words in enumerate(lists):
            if not words or not self.langs:
                langs.append(UNDETERMINED)
                continue
            total = self.table[[self.place[w] for w in words]].sum(axis=0)
            k = int(total.argmax())
            langs.append(self.langs[k])
            best[i] = 1.0 / np.exp(total - total[k]).sum()
        return langs, best


@lru_cache(maxsize=1)
def scorer(model: bytes) -> Scorer:
    return Scorer(*pickle.loads(model))


def predictor(
    spark: SparkSession, langs: list[str], chance: np.ndarray, path: str = VOCABULARY
) -> Callable[[Column], Column]:
    """From a text column to a struct of lang_pred and score.  Row by row, no shuffle."""
    model = spark.sparkContext.broadcast(pickle.dumps((langs, chance, path)))

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = scorer(model.value)
        for texts in batches:
            parts = [known.scores(list(texts[s])) for s in in_pieces(texts, CHUNK)]
            names = [name for found, _ in parts for name in found]
            values = np.concatenate([np.zeros(0), *(value for _, value in parts)])
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": values})
        known.forget()  # the worker lives on

    return of


def fitted(
    docs: DataFrame, learnable: str = "TRUE", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS, path: str = VOCABULARY
) -> tuple[list[str], np.ndarray]:
    """The model learned from the rows with text and lang for which the SQL condition ``learnable`` holds."""
    labelled = docs.where(learnable).where("lang IS NOT NULL AND text IS NOT NULL")
    return learn(labelled.select(F.col(id_col).alias("id"), "text", "lang"), path, sample_docs)
