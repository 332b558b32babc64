"""Token counts of a unigram tokenizer, without the tokens: count-only Viterbi.

An Aho-Corasick automaton lists all vocabulary pieces inside a word, and dynamic programming carries for
each place only the best score and its piece count.  The rules are those of the ``Unigram`` model with
byte fallback behind a ``Metaspace`` pre-tokenizer in the ``tokenizers`` library:

* a space starts a new word, and every word begins with the mark U+2581; the text begins one word;
* of two segmentations with the same score, the one whose last piece starts first wins, at every place;
* a character that is no piece by itself may be taken as unknown for the lowest score less 10, and then
  counts as its UTF-8 bytes.

Null text and empty text have 0 tokens.  Texts are counted whole, a word at a time; a word of any length costs
time and memory in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task remembers; it forgets all when there are more, so memory stays bounded.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64


def vocabulary(path: str) -> list[tuple[str, float]]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Number of tokens by word (mark included)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.single = {piece for piece, _ in pieces if len(piece) == 1}

    def __missing__(self, word: str) -> int:
        count = self.viterbi(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count

    def viterbi(self, word: str) -> int:
        lowest = float("-inf")
        score = [0.0] + [lowest] * len(word)
        count = [0] * (len(word) + 1)
        done = 0
        for end, (size, gain) in self.automaton.iter(word):
            while done < end:  # the places before this end are settled once unknowns are tried
                self.unknown_at(word, done, score, count)
                done += 1
            start = end + 1 - size
            if (value := score[start] + gain) > score[end + 1]:
                score[end + 1] = value
                count[end + 1] = count[start] + 1
        while done < len(word):
            self.unknown_at(word, done, score, count)
            done += 1
        return count[-1]

    def unknown_at(self, word: str, i: int, score: list[float], count: list[int]) -> None:
        if word[i] not in self.single and (value := score[i] + self.unknown) > score[i + 1]:
            score[i + 1] = value
            count[i + 1] = count[i] + len(word[i].encode("utf-8", "surrogatepass"))

    def tokens(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:  # a text that begins with a space or the mark gets no further mark
            del words[0]
        return sum(map(self.__getitem__, [MARK + w for w in words]))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str = VOCABULARY
) -> DataFrame:
    """(id, n_tokens) of every row of ``docs``.  Row by row, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(vocabulary_path).tokens
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"].array, "n_tokens": [count(t) for t in batch["text"]]})

    narrow = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return narrow.mapInPandas(of, f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)
