"""Licence scans: one Aho-Corasick pass finds notice phrases and identifier tags.

A phrase stands where its words stand one after the other.  A tag is the word sequence
``spdx license identifier``; the rest of its line is a licence expression, which a shunting-yard parser
turns into postfix order and evaluates: ``and`` needs both sides, ``or`` the freer one, ``with`` a
licence that an exception relaxes.

Score: 0 without a label, else how free the document may be used, from 1 (asks for nothing) down: the
value of the least free notice, and of the tags' expressions (``and``: least, ``or``: largest,
``with``: halfway to 1).  Identifiers that no family covers count 0.5 and have no label.

Null text counts as empty: no words, no labels, score 0.  Repeated rows give repeated results; other columns
do not matter.  A text of any length is scanned whole, in time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

from residua.llm.words import FOLD, utf8

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: The method's own phrases.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: Identifier beginnings (the longest that fits counts) and their labels.
FAMILIES = {
    "gpl": "gpl",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "apache": "apache",
    "mit": "mit",
    "bsd": "bsd",
    "isc": "isc",
    "mpl": "mpl",
    "epl": "epl",
    "cc-by": "cc-by",
    "cc0": "cc0",
    "unlicense": "unlicense",
}
FREEDOM = {
    "unlicense": 1.0,
    "cc0": 1.0,
    "mit": 0.9,
    "isc": 0.9,
    "bsd": 0.85,
    "apache": 0.8,
    "cc-by": 0.7,
    "mpl": 0.5,
    "epl": 0.5,
    "lgpl": 0.4,
    "gpl": 0.3,
    "agpl": 0.2,
    "proprietary": 0.1,
}
UNKNOWN = 0.5
STRENGTH = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[0-9a-z.+\-:]+")
COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "expressions array<string>"
)


def family(identifier: str) -> str | None:
    fits = [f for f in FAMILIES if identifier == f or identifier.startswith(f + "-")]
    return FAMILIES[max(fits, key=len)] if fits else None


def postfix(expression: str) -> list[str] | None:
    """The expression's tokens in postfix order, by the shunting-yard method; None if it is malformed.

    Of a line that goes on after a whole expression (``MIT */``, ``MIT see the file``) the longest
    beginning that is well formed counts.
    """
    output: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in TOKEN.findall(expression.lower()):
        if token == "(":
            if not operand_next:
                break
            waiting.append(token)
        elif token == ")":
            if operand_next or "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                output.append(top)
        elif token in STRENGTH:
            if operand_next:
                break
            while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[token]:
                output.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        else:
            if not operand_next:
                break
            output.append(token)
            operand_next = False
    if operand_next and waiting and waiting[-1] in STRENGTH:
        waiting.pop()
        operand_next = False
    if operand_next or "(" in waiting or not output:
        return None
    return output + waiting[::-1]


def evaluate(order: list[str]) -> tuple[float, frozenset[str]]:
    """Freedom and labels of an expression in postfix order."""
    stack: list[tuple[float, frozenset[str]]] = []
    for token in order:
        if token not in STRENGTH:
            label = family(token)
            stack.append((FREEDOM.get(label, UNKNOWN), frozenset([label] if label else [])))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if token == "with":
            stack.append(((a + 1) / 2, left))
        else:
            stack.append(((min if token == "and" else max)(a, b), left | right))
    return stack[0]


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**BASE, **MORE, TAG: ""}.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


def expressions(text: str) -> list[str]:
    """What follows each identifier tag on its line."""
    tag = re.compile(r"spdx[^\nA-Za-z0-9]+license[^\nA-Za-z0-9]+identifier[^\nA-Za-z0-9(]+([^\n]*)", re.I | re.A)
    return tag.findall(text)


def scan(text: str | None) -> tuple:
    text = text or ""
    words = utf8(text).translate(FOLD).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    n_base, first, last = 0, None, None
    base: set[str] = set()
    notices: set[str] = set()
    tagged = False
    at = word = 0
    for end, (phrase, label) in automaton().iter(line):
        if phrase == TAG:
            tagged = True
            continue
        notices.add(label)
        if phrase in BASE:
            start = end - len(phrase)  # the phrase's first character
            word += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            place = word - 1
            n_base += 1
            base.add(label)
            first = place if first is None else min(first, place)
            last = place if last is None else max(last, place)
    found = expressions(text) if tagged else []
    labels = set(notices)
    values = [FREEDOM[x] for x in notices]
    for expression in found:
        if (order := postfix(expression)) is not None:
            value, inner = evaluate(order)
            values.append(value)
            labels |= inner
    score = min(values) if values else 0.0
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, found


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, and what the scan found in its whole text (``COLUMNS``).

    Row by row: no shuffle, and memory for one batch of texts.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"]

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([scan(t) for t in batch["text"]], columns=names, dtype=object)
            out["first_word"] = out["first_word"].astype("Int64")
            out["last_word"] = out["last_word"].astype("Int64")
            out.insert(0, "id", batch["id"].array)
            yield out

    narrow = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return narrow.mapInPandas(of, f"id {kind}, {COLUMNS}").withColumnRenamed("id", id_col)
