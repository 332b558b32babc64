"""The prefix trie of conversations, by truncation peeling.

Every distinct beginning of a conversation is a node: the first d turns, d from 0 (the root) to the whole.
Conversations are sorted by their turns over all tasks, so that a task reads neighbours in the trie one after
another and keeps open only the nodes on the path of the last one.  Where the next conversation leaves that path,
the open nodes are peeled from the greatest depth up: conversations that ended at a node have been merged with what
survived from below, its sums are complete, it is written, and with its last turn stripped it regroups with its siblings
in the node above.  One pass finds the nodes and aggregates them.  Nodes on the first or last path of a task may go on
in another task; they (at most twice the tasks times the longest path) are summed by node and
peeled by the same rule afterwards.  Conversations with the same turns are told apart by id in the sort, so that a group of
them is shared by as many tasks as it needs.

A turn is its role and text, null counting as empty; the key of a turn is 128 bits of SHA-256 over
both, the key of a node the same over the keys of its parent and its last turn.  Turns stand in the order of their
number, null first; equal numbers in the order of their keys.

Rows without a conversation id belong to no conversation.  Repeated rows are turns like others.  Without a
conversation there is no node, not even the root.  Other columns do not matter.  A conversation is one row of 20 bytes a
turn; nothing else is gathered, however many conversations share a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import stored

KEY_BYTES = 16
ROOT = bytes(KEY_BYTES)
SUMS = ["n_convs", "n_children", "n_leaves", "saved"]
FIELDS = (
    "kind string, node binary, parent binary, depth long, size long, conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved long"
)
COLUMNS = [f.split()[0] for f in FIELDS.split(", ")]
INNER, BORDER, END = "inner", "border", "end"
ROWS = 5000  # rows handed back at once


def paths_of(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv_id, path)``: per conversation its turns in order, each a ``key`` and the ``size`` of its text."""
    who, said = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    content = F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said)
    key = F.substring(F.unhex(F.sha2(content.cast("binary"), 256)), 1, KEY_BYTES)
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), key.alias("key"), F.char_length(said).alias("size")).alias("t"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return listed.select(
        "conv_id", F.transform("ts", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("path")
    )


class _Node:
    """An open node: what has been merged into it so far."""

    __slots__ = ("key", "parent", "depth", "turn", "size", "border", "conv_id", *SUMS)

    def __init__(self, key: bytes, parent: bytes | None, depth: int, turn: bytes, size: int, border: bool):
        self.key, self.parent, self.depth, self.turn, self.size, self.border = key, parent, depth, turn, size, border
        self.conv_id: int | None = None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0

    def member(self, conv_id: int | None) -> None:
        if conv_id is not None and (self.conv_id is None or conv_id < self.conv_id):
            self.conv_id = conv_id

    def complete(self) -> None:
        if not self.n_children:
            self.n_leaves = 1
        self.saved += (self.n_convs - 1) * self.size

    def take(self, child: _Node) -> None:
        """The child without its last turn is this node."""
        self.member(child.conv_id)
        self.n_convs += child.n_convs
        self.n_children += 1
        self.n_leaves += child.n_leaves
        self.saved += child.saved

    def row(self, kind: str) -> tuple:
        sums = (self.n_convs, self.n_children, self.n_leaves, self.saved)
        return (kind, self.key, self.parent, self.depth, self.size, self.conv_id, *sums)


def child_key(parent: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(parent + turn).digest()[:KEY_BYTES]


class Peeler:
    """Takes conversations in the order of their turns; gives back nodes as soon as they are complete."""

    def __init__(self):
        self.open: list[_Node] = []

    def _peel(self, depth: int) -> Iterator[tuple]:
        """Ends all open nodes below ``depth``, the deepest first."""
        while len(self.open) > depth + 1:
            node = self.open.pop()
            if node.border:
                yield node.row(BORDER)
            else:
                node.complete()
                self.open[-1].take(node)
                yield node.row(INNER)

    def add(self, conv_id: int, turns: list[tuple[bytes, int]]) -> Iterator[tuple]:
        first = not self.open
        if first:
            self.open.append(_Node(ROOT, None, 0, b"", 0, True))
        shared = 0
        for (turn, _), node in zip(turns, self.open[1:]):
            if node.turn != turn:
                break
            shared += 1
        yield from self._peel(shared)
        for turn, size in turns[shared:]:
            above = self.open[-1]
            self.open.append(_Node(child_key(above.key, turn), above.key, above.depth + 1, turn, size, first))
        end = self.open[-1]
        end.member(conv_id)
        end.n_convs += 1
        yield (END, end.key, None, None, None, conv_id, None, None, None, None)

    def finish(self) -> Iterator[tuple]:
        """What is open at the end may go on in the next task."""
        while self.open:
            yield self.open.pop().row(BORDER)


def _frame(rows: list[tuple], columns: list[str] = COLUMNS) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns, dtype=object)


def _peeled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    peeler, rows = Peeler(), []
    for batch in batches:
        for conv_id, path in zip(batch["conv_id"], batch["path"]):
            rows.extend(peeler.add(int(conv_id), [(t["key"], t["size"]) for t in path]))
            if len(rows) >= ROWS:
                yield _frame(rows)
                rows = []
    rows.extend(peeler.finish())
    if rows:
        yield _frame(rows)


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Peels the border nodes, the deepest first; each comes once, with the sums of all tasks."""
    nodes: dict[bytes, _Node] = {}
    for batch in batches:
        for r in batch.itertuples(index=False):
            node = nodes[r.node] = _Node(r.node, r.parent, int(r.depth), b"", int(r.size), True)
            node.conv_id = None if pd.isna(r.conv_id) else int(r.conv_id)
            for name in SUMS:
                setattr(node, name, int(getattr(r, name)))
    rows = []
    for node in sorted(nodes.values(), key=lambda n: -n.depth):
        node.complete()
        if node.parent is not None:
            nodes[node.parent].take(node)
        rows.append(node.row(INNER))
    for i in range(0, len(rows), ROWS):
        yield _frame(rows[i : i + ROWS])


def prefix_trie(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and where each conversation ends, from ``(conv_id, path)``, one row per conversation.

    Nodes: ``(node, parent, depth, size, conv_id, n_convs, n_children, n_leaves, saved)``, ``conv_id`` being the smallest
    member, ``size`` that of the last text, ``n_leaves`` and ``saved`` sums over the subtree.  Ends: ``(conv_id, node)``.
    """
    sorted_paths = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = stored(sorted_paths.mapInPandas(_peeled, FIELDS), "trie", ["kind"])
    border = found.where(F.col("kind") == BORDER)
    summed = border.groupBy("node").agg(
        F.first("parent").alias("parent"),  # the same in all rows of a node, as are depth and size
        F.first("depth").alias("depth"),
        F.first("size").alias("size"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in SUMS],
    )
    merged = summed.repartition(1).mapInPandas(_merged, FIELDS)
    nodes = found.where(F.col("kind") == INNER).select(*COLUMNS).unionByName(merged).drop("kind")
    return nodes, found.where(F.col("kind") == END).select("conv_id", "node")


# --- what the registered query makes of it

LENT_TURNS = 6  # conversations take fewer than so many turns from the first of their hundred


def with_lent_turns(paths: DataFrame) -> DataFrame:
    """Every conversation with its first turns replaced by those of the first conversation of its hundred."""
    hundred = F.col("conv_id") - F.col("conv_id") % 100
    lent = paths.where(F.col("conv_id") % 100 == 0).select(
        F.col("conv_id").alias("lender"), F.slice("path", 1, LENT_TURNS - 1).alias("lent")
    )
    count = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT_TURNS).cast("int")
    both = paths.select("conv_id", "path", hundred.alias("lender"), count.alias("h")).join(lent, "lender", "left")
    taken = F.coalesce(F.slice("lent", F.lit(1), F.col("h")), F.slice("path", 1, 0))
    own = F.slice("path", F.col("h") + 1, F.size("path"))
    return both.select("conv_id", F.concat(taken, own).alias("path"))


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash per node over its ids, which come sorted; no list of them is made."""
    node, digest, rows = None, None, []
    for batch in batches:
        for key, conv_id in zip(batch["node"], batch["conv_id"]):
            if key != node:
                if node is not None:
                    rows.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(b",%d" % conv_id)
        if len(rows) >= ROWS:
            yield _frame(rows, ["node", "ends_sha256"])
            rows = []
    if node is not None:
        rows.append((node, digest.hexdigest()))
    if rows:
        yield _frame(rows, ["node", "ends_sha256"])


def digests(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes with their parent's smallest member and a hash of the conversations that end there."""
    nodes = stored(nodes, "trie-nodes")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    in_order = ends.repartition("node").sortWithinPartitions("node", "conv_id")
    hashes = in_order.mapInPandas(_hashed, "node binary, ends_sha256 string")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(hashes, "node", "left")
        .join(above, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            *SUMS[:3],
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
