"""The prefix trie of conversations: which turns conversations share from their start on, and what that saves.

Turns are encoded by a dictionary, conversations are sorted by their turn ids
and cut into range shards, and each shard becomes a ternary search tree.  What
lies inside a shard is finished there.  Only nodes on the path of a shard's
first or last conversation can go on in a neighbour; these boundary nodes are
merged over neighbouring shards, round by round, until one shard is left.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, text_of

# Turns of a shard, and shards whose boundary nodes one task merges.
SHARD_TURNS, FAN = 20_000, 32
NONE = hashlib.sha256(b"").hexdigest()
ROOT = bytes(16)

FINISHED, BOUNDARY, ENDS = 0, 1, 2
FIELDS = ["kind", "shard", "node", "up", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
          "saved_tokens", "words", "ends_sha256", "ends", "first", "last"]
SCHEMA = ("kind int, shard long, node binary, up binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, ends binary, "
          "first boolean, last boolean")
ARROW = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string(), pa.binary(), pa.bool_(), pa.bool_()]


def encoded(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id, ids, words`` of every conversation: its turns in order, by dictionary id, and each one's number of words.

    Null role and text count as empty, a null turn comes first; equal turn
    numbers follow a digest of role and text.  Rows without an id belong to no
    conversation; repeated rows are turns of their own; other columns are
    ignored.  Texts don't move, their digests do.  A conversation's ids (16
    bytes a turn with the words) are held by one task, as a text is.
    """
    role, text = text_of(f"`{role_col}`"), text_of(f"`{text_col}`")
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                                 digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    turns = materialise(turns.where("conv_id is not null"), "trie-turns")
    names = materialise(turns.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-names")
    turns = turns.join(names, "digest").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "digest", "id", "words"))).alias("t"))
    return materialise(turns.select("conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words")), "trie-sequences")


def rebuilt(sequences: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of c - c % ``every``; h = crc32(decimal c) % ``most``."""
    heads = sequences.where(F.col("conv_id") % every == 0)
    heads = heads.select(F.col("conv_id").alias("_base"), *(F.slice(c, 1, most - 1).alias(f"_{c}") for c in ("ids", "words")))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    rows = sequences.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")

    def joined(c: str) -> Column:
        kind = sequences.schema[c].dataType
        head = F.coalesce(F.slice(f"_{c}", F.lit(1), h), F.array().cast(kind))
        return F.concat(head, F.slice(c, h + 1, F.greatest(F.size(c), F.lit(1)))).alias(c)

    return rows.select("conv_id", joined("ids"), joined("words"))


class TernaryTree:
    """A ternary search tree over sequences of turn ids; node 0 is the trie's root, every other one a prefix."""

    def __init__(self) -> None:
        self.turn, self.words, self.up, self.depth = [0], [0], [-1], [0]
        self.low, self.same, self.high = [-1], [-1], [-1]

    def insert(self, ids: list[int], words: list[int]) -> int:
        """The node of the whole sequence."""
        turn, low, same, high = self.turn, self.low, self.same, self.high
        node = 0
        for t, w in zip(ids, words):
            at, link, owner = same[node], same, node
            while at >= 0 and turn[at] != t:
                link, owner = (low if t < turn[at] else high), at
                at = link[owner]
            if at < 0:
                at = link[owner] = len(turn)
                for column, value in ((turn, t), (self.words, w), (self.up, node), (self.depth, self.depth[node] + 1),
                                      (low, -1), (same, -1), (high, -1)):
                    column.append(value)
            node = at
        return node

    def path(self, node: int) -> list[int]:
        """The nodes from the root down to ``node``."""
        out = [node]
        while self.up[node] >= 0:
            node = self.up[node]
            out.append(node)
        return out[::-1]

    def walk(self) -> list[int]:
        """All nodes, each one before its children."""
        out, stack = [], [0]
        while stack:
            at = stack.pop()
            out.append(at)
            level = [self.same[at]] if self.same[at] >= 0 else []
            while level:  # the children of a node are a binary tree
                at = level.pop()
                stack.append(at)
                level += [x for x in (self.low[at], self.high[at]) if x >= 0]
        return out


def by_medians(n: int) -> Iterator[int]:
    """0 .. n-1, the middle before the middles of both halves, so that what is inserted in this order is balanced."""
    spans = deque([(0, n)])
    while spans:
        a, b = spans.popleft()
        if a < b:
            m = (a + b) // 2
            yield m
            spans += ((a, m), (m + 1, b))


def shard_nodes(shard: int, ids: list[list[int]], words: list[list[int]], members: list[list[int]]) -> Iterator[tuple]:
    """Rows of FIELDS for a shard of distinct sorted sequences, each with its members (ascending conversation ids)."""
    tree, end = TernaryTree(), [0] * len(ids)
    for k in by_medians(len(ids)):
        end[k] = tree.insert(ids[k], words[k])
    own = dict(zip(end, members))
    size = len(tree.turn)
    n, first = [0] * size, [1 << 63] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    left, right = tree.path(end[0]), tree.path(end[-1])
    edge = set(left) | set(right)
    key = {0: ROOT}
    for node in (*left[1:], *right[1:]):
        key[node] = hashlib.blake2b(key[tree.up[node]] + tree.turn[node].to_bytes(8, "little"), digest_size=16).digest()
    order = tree.walk()
    for node in reversed(order):
        mine, up = own.get(node), tree.up[node]
        if mine:
            n[node] += len(mine)
            first[node] = min(first[node], mine[0])
        if node not in edge:
            leaves[node] = leaves[node] or 1
            saved[node] += (n[node] - 1) * tree.words[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if up >= 0:
            n[up] += n[node]
            first[up] = min(first[up], first[node])
    left, right = set(left), set(right)
    for node in order:
        up, ends = tree.up[node], ",".join(map(str, own.get(node, ()))).encode()
        counts = (tree.depth[node], first[node])
        sums = (n[node], children[node], leaves[node], saved[node], tree.words[node])
        if node in edge:
            yield (BOUNDARY, shard, key[node], key.get(up), *counts, None, *sums, None, None, node in left, node in right)
            if ends:
                yield (ENDS, shard, key[node], *[None] * 10, ends, None, None)
        else:
            known = None if up in edge else first[up]
            yield (FINISHED, shard, None, key.get(up), *counts, known, *sums, hashlib.sha256(ends).hexdigest(), *[None] * 3)


def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's sorted rows (``conv_id, ids, words``) to rows of FIELDS."""
    ids: list[list[int]] = []
    words: list[list[int]] = []
    members: list[list[int]] = []
    for b in batches:
        for conv, i, w in zip(b.column("conv_id").to_pylist(), b.column("ids").to_pylist(), b.column("words").to_pylist()):
            if ids and ids[-1] == i:
                members[-1].append(conv)
            else:
                ids.append(i)
                words.append(w)
                members.append([conv])
    rows = shard_nodes(TaskContext.get().partitionId(), ids, words, members) if ids else iter(())
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), ARROW)], FIELDS)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), ARROW)], FIELDS)


def merge_boundaries(rows: pd.DataFrame, final: bool) -> pd.DataFrame:
    """Boundary nodes of neighbouring shards as those of one: nodes inside are finished, those on its outer paths go on."""
    group = int(rows["shard"].iloc[0]) // FAN
    left, right = rows["shard"].min(), rows["shard"].max()
    nodes: dict[bytes, list] = {}  # up, depth, conv_id, n_convs, n_children, n_leaves, saved_tokens, words, first, last
    for r in rows.itertuples(index=False):
        first, last = r.first and r.shard == left, r.last and r.shard == right
        v = nodes.setdefault(r.node, [r.up, r.depth, r.conv_id, 0, 0, 0, 0, r.words, False, False])
        v[2] = min(v[2], r.conv_id)
        for k, x in ((3, r.n_convs), (4, r.n_children), (5, r.n_leaves), (6, r.saved_tokens)):
            v[k] += int(x)
        v[8], v[9] = v[8] or first, v[9] or last
    out = []
    for node, v in sorted(nodes.items(), key=lambda x: -x[1][1]):  # the deepest first
        up, depth, conv, n, _, _, _, words, first, last = v
        inside = final or not (first or last)
        if inside:
            v[5], v[6] = v[5] or 1, v[6] + (n - 1) * words
            if node != ROOT:
                for k, x in ((4, 1), (5, v[5]), (6, v[6])):
                    nodes[up][k] += x
        out.append((FINISHED if inside else BOUNDARY, group, node, up, depth, conv, None, n, v[4], v[5], v[6], words, None, None,
                    first, last))
    return pd.DataFrame(out, columns=FIELDS)


def merge_some(rows: pd.DataFrame) -> pd.DataFrame:
    return merge_boundaries(rows, False)


def merge_all(rows: pd.DataFrame) -> pd.DataFrame:
    return merge_boundaries(rows, True)


def ends_digests(chunks: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of boundary nodes: their members are hashed shard by shard, none held but the shard's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done = []
            for k, ends in zip(b.column("node").to_pylist(), b.column("ends")):
                if k != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.as_buffer())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), (pa.binary(), pa.string()))],
                                                 ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    rows = chunks.select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard")
    return rows.select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the prefix trie of ``conv_id, ids, words`` (unique ids): see ``conversation_trie``."""
    turns = sequences.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(1, -(-turns // shard_turns))
    order = ["ids", "conv_id"]
    ranges = sequences.select("conv_id", "ids", "words").repartitionByRange(shards, *order).sortWithinPartitions(*order)
    rows = materialise(ranges.mapInArrow(build, SCHEMA), "trie-nodes")
    shards = (rows.agg(F.max("shard")).first()[0] or 0) + 1
    edges, finished = rows.where(F.col("kind") == BOUNDARY), []
    while True:
        final = shards <= FAN
        groups = edges.groupBy(F.floor(F.col("shard") / FAN).alias("group"))
        merged = materialise(groups.applyInPandas(merge_all if final else merge_some, SCHEMA), "trie-boundaries")
        finished.append(merged.where(F.col("kind") == FINISHED))
        if final:
            break
        edges, shards = merged.where(F.col("kind") == BOUNDARY), -(-shards // FAN)
    boundary = finished[0]
    for more in finished[1:]:
        boundary = boundary.union(more)
    digests = ends_digests(rows.where(F.col("kind") == ENDS))
    boundary = boundary.drop("ends_sha256").join(digests, "node", "left")
    boundary = materialise(boundary.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE))), "trie-merged")

    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parents = boundary.select(F.col("node").alias("up"), F.col("conv_id").alias("_parent"))
    inner = rows.where(F.col("kind") == FINISHED)
    waiting = inner.where("up is not null").select("up", *cols).union(boundary.select("up", *cols))
    named = waiting.drop("parent_conv_id").join(parents, "up", "left").withColumnRenamed("_parent", "parent_conv_id")
    return inner.where("up is null").select(*cols).union(named.select(*cols))


def conversation_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """One row for each distinct sequence of first turns of the conversations, from the empty one (depth 0) on.

    ``conv_id`` is the smallest member (a conversation that starts so),
    ``parent_conv_id`` that of the sequence without its last turn (null for the
    empty one), ``n_convs`` the number of members, ``n_children`` of sequences
    one turn longer, ``n_leaves`` of those in its subtree that none continues,
    ``saved_tokens`` the words that members after the first repeat, over the
    subtree, ``ends_sha256`` of the ids of the members that end there, ascending
    and comma-joined.  Rows are read as ``encoded`` says; an empty table has no node.
    """
    return trie(encoded(conversations, id_col, turn_col, role_col, text_col))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that they share first turns."""
    return trie(rebuilt(encoded(table(spark, sf_dir, "conversations"))))
