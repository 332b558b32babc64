"""Simple tree matching of two block trees: the most nodes that an order-preserving match of roots and children pairs.

Two text runs count 1, with equal texts 2; two elements of the same tag count 1 and the best match of their
children; other pairs count nothing.

Every subtree gets a number for its tags and texts, and one for its tags alone.  Equal subtrees match whole, and equal
children at the ends of two lists are paired first, which loses nothing as no other pair counts more.  Two subtrees
without a text in common count what their shapes count, so a score is worked out once for two shapes and not
once for two nodes.  What is left of two lists of children is a table, worked out row by row: the steps are kept as
bits up to ``CELLS`` cells, larger tables are split in half (Hirschberg), so memory stays linear.  Time is linear for lists that
differ in a few places; the cells of a table are simple array operations.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np

CELLS = 1 << 28
FEW = 64


class Matching:
    """Scores of the subtrees of two trees, whose nodes have ``tag``, ``text`` and ``children``."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.whole: dict[int, int] = {}
        self.shape: dict[int, int] = {}
        self.size: dict[int, int] = {}  # nodes below and with it
        self.most: dict[int, int] = {}  # its match with a copy of itself
        self.shares: dict[int, bool] = {}  # whether it holds a text that both trees have
        self.known: dict[tuple[bool, int, int], int] = {}
        below_a, below_b = self._below_first(a), self._below_first(b)
        self.common = {x.text for x in below_a if not x.tag} & {x.text for x in below_b if not x.tag}
        wholes: dict[tuple, int] = {}
        shapes: dict[tuple, int] = {}
        whole, shape, size, most, shares = self.whole, self.shape, self.size, self.most, self.shares
        for node in below_a + below_b:
            name, tag = id(node), node.tag
            if not node.children:
                whole[name] = wholes.setdefault((tag, "" if tag else node.text), len(wholes))
                shape[name] = shapes.setdefault((tag,), len(shapes))
                size[name], most[name] = 1, 1 if tag else 2
                shares[name] = not tag and node.text in self.common
                continue
            kids = [id(c) for c in node.children]
            whole[name] = wholes.setdefault((tag, "", *[whole[c] for c in kids]), len(wholes))
            shape[name] = shapes.setdefault((tag, *[shape[c] for c in kids]), len(shapes))
            size[name] = 1 + sum([size[c] for c in kids])
            most[name] = 1 + sum([most[c] for c in kids])
            shares[name] = True in [shares[c] for c in kids]

    @staticmethod
    def _below_first(tree) -> list:
        order, pending = [], [tree]
        while pending:
            order.append(pending.pop())
            pending += order[-1].children
        return order[::-1]

    def _key(self, x, y) -> tuple[bool, int, int]:
        """Pairs of the same key have the same score; the mark says that texts matter."""
        if self.shares[id(x)] and self.shares[id(y)]:
            return True, self.whole[id(x)], self.whole[id(y)]
        return False, self.shape[id(x)], self.shape[id(y)]

    def _plain(self, x, y, texts: bool) -> int | None:
        """The score, if it needs no table."""
        if x.tag != y.tag:
            return 0
        if texts and self.whole[id(x)] == self.whole[id(y)]:
            return self.most[id(x)]
        if not texts and self.shape[id(x)] == self.shape[id(y)]:
            return self.size[id(x)]
        if not x.children or not y.children:
            return 1
        return None

    def _trimmed(self, xs: list, ys: list, texts: bool) -> tuple[int, int]:
        """How many children at the beginning and at the end of both lists are equal."""
        names = self.whole if texts else self.shape
        n, first, last = min(len(xs), len(ys)), 0, 0
        while first < n and names[id(xs[first])] == names[id(ys[first])]:
            first += 1
        while last < n - first and names[id(xs[-1 - last])] == names[id(ys[-1 - last])]:
            last += 1
        return first, last

    def _sharing(self, xs: list, ys: list) -> list[tuple[int, int]]:
        """Places (i, j) of different subtrees of both lists that may have a text in common."""
        left = {self.whole[id(x)]: i for i, x in enumerate(xs) if self.shares[id(x)]}
        right = {self.whole[id(y)]: j for j, y in enumerate(ys) if self.shares[id(y)]}
        if len(left) * len(right) <= FEW:
            return [(i, j) for i in left.values() for j in right.values()]
        holders = defaultdict(set)
        for j in right.values():
            for text in self._texts(ys[j]):
                holders[text].add(j)
        return [(i, j) for i in left.values() for j in set().union(*(holders[t] for t in self._texts(xs[i])))]

    def _texts(self, node) -> set[str]:
        return {x.text for x in self._below_first(node) if not x.tag and x.text in self.common}

    def _rows(self, xs: list, ys: list, texts: bool):
        """A function that gives the scores of the i-th of xs with all ys; or the pairs that must be scored before."""
        lack = []

        def score(x, y, with_texts):
            plain = self._plain(x, y, with_texts)
            if plain is not None:
                return plain
            key = (with_texts, *((self.whole if with_texts else self.shape)[id(n)] for n in (x, y)))
            if key not in self.known:
                lack.append((x, y, with_texts))
                return 0
            return self.known[key]

        shapes_x = {self.shape[id(x)]: x for x in xs}
        shapes_y = {self.shape[id(y)]: y for y in ys}
        place_x = {s: k for k, s in enumerate(shapes_x)}
        place_y = {s: k for k, s in enumerate(shapes_y)}
        by_shape = np.array([[score(x, y, False) for y in shapes_y.values()] for x in shapes_x.values()], np.int64)
        own = [place_x[self.shape[id(x)]] for x in xs]
        columns = np.array([place_y[self.shape[id(y)]] for y in ys])
        special = defaultdict(list)
        if texts:
            for i, j in self._sharing(xs, ys):
                special[self.whole[id(xs[i])]].append((self.whole[id(ys[j])], score(xs[i], ys[j], True)))
        if lack:
            return None, lack
        same = defaultdict(list)
        for j, y in enumerate(ys if special else ()):
            same[self.whole[id(y)]].append(j)

        def row(i: int) -> np.ndarray:
            weights = by_shape[own[i]][columns]
            for whole, weight in special.get(self.whole[id(xs[i])], ()):
                weights[same[whole]] = weight
            return weights

        return row, lack

    @staticmethod
    def _last(row, rows, low: int, high: int, back: bool = False) -> np.ndarray:
        """Best sums of some rows with the first columns of low to high, or with the last ones."""
        best = np.zeros(high - low + 1, np.int64)
        for i in rows:
            weights = row(i)[low:high]
            now = np.maximum(best[1:], best[:-1] + (weights[::-1] if back else weights))
            best[1:] = np.maximum.accumulate(now)
        return best

    def _score(self, x, y, texts: bool) -> None:
        """Works out the score of two elements with children, with all that it needs; a stack stands for the depth."""
        pending = [(x, y, texts)]
        names = {True: self.whole, False: self.shape}
        while pending:
            x, y, texts = pending[-1]
            key = (texts, names[texts][id(x)], names[texts][id(y)])
            if key in self.known:
                pending.pop()
                continue
            first, last = self._trimmed(x.children, y.children, texts)
            xs = x.children[first : len(x.children) - last]
            ys = y.children[first : len(y.children) - last]
            total = 0
            if xs and ys:
                row, lack = self._rows(xs, ys, texts)
                if lack:
                    pending += lack
                    continue
                total = int(self._last(row, range(len(xs)), 0, len(ys))[-1])
            ends = self.most if texts else self.size
            total += sum(ends[id(c)] for c in x.children[:first] + x.children[len(x.children) - last :])
            self.known[key] = 1 + total
            pending.pop()

    def score(self) -> int:
        """The match of the two trees."""
        texts = self._key(self.a, self.b)[0]
        plain = self._plain(self.a, self.b, texts)
        if plain is not None:
            return plain
        self._score(self.a, self.b, texts)
        return self.known[self._key(self.a, self.b)]

    def _steps(self, row, rows: range, low: int, high: int) -> Iterator[tuple[int, int]]:
        """The pairs (i, j) of a best match of some rows and columns."""
        pending = [(rows, low, high)]
        while pending:
            rows, low, high = pending.pop()
            if not rows or low == high:
                continue
            if len(rows) == 1 or len(rows) * (high - low) <= CELLS:
                yield from self._walk(row, rows, low, high)
                continue
            half = len(rows) // 2
            begin, end = rows[:half], rows[half:]
            sums = self._last(row, begin, low, high) + self._last(row, end[::-1], low, high, back=True)[::-1]
            cut = low + int(sums.argmax())
            pending += [(end, cut, high), (begin, low, cut)]

    @staticmethod
    def _walk(row, rows: range, low: int, high: int) -> Iterator[tuple[int, int]]:
        best = np.zeros(high - low + 1, np.int64)
        paired, upward = [], []
        for i in rows:
            weights = row(i)[low:high]
            pair = best[:-1] + weights
            now = np.zeros_like(best)
            now[1:] = np.maximum.accumulate(np.maximum(best[1:], pair))
            paired.append(np.packbits((now[1:] == pair) & (weights > 0)))
            upward.append(np.packbits(now[1:] == best[1:]))
            best = now
        k, j = len(rows) - 1, high - low - 1
        while k >= 0 and j >= 0:
            bit = 128 >> (j & 7)
            if paired[k][j >> 3] & bit:
                yield rows[k], low + j
                k, j = k - 1, j - 1
            elif upward[k][j >> 3] & bit:
                k -= 1
            else:
                j -= 1

    def pairs(self) -> Iterator[tuple]:
        """The pairs of nodes of a best match."""
        pending = [(self.a, self.b)] if self.a.tag == self.b.tag else []
        while pending:
            x, y = pending.pop()
            yield x, y
            if not x.children or not y.children:
                continue
            texts = self._key(x, y)[0]
            first, last = self._trimmed(x.children, y.children, texts)
            pending += zip(x.children[:first], y.children[:first])
            if last:
                pending += zip(x.children[-last:], y.children[-last:])
            xs = x.children[first : len(x.children) - last]
            ys = y.children[first : len(y.children) - last]
            if not xs or not ys:
                continue
            row, lack = self._rows(xs, ys, texts)
            while lack:
                for pair in lack:
                    self._score(*pair)
                row, lack = self._rows(xs, ys, texts)
            pending += [(xs[i], ys[j]) for i, j in self._steps(row, range(len(xs)), 0, len(ys))]


def matched(a, b) -> Iterator[tuple]:
    """The pairs of nodes of a best simple tree matching."""
    return Matching(a, b).pairs()
