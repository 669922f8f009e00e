"""The conversation trie against plain dictionaries, in one shard and in many."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from spokes.llm import conversation_trie as ct
from spokes.llm import registry

SF = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def sequences(rows):
    """{id: [(role, text)]} of [(id, turn, role, text)]."""
    out = defaultdict(list)
    for i, turn, role, text in rows:
        if i is not None:
            role, text = role or "", text or ""
            out[i].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    return {i: [t[3:] for t in sorted(ts)] for i, ts in out.items()}


def rebuild(seqs):
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in seqs}
    return {c: seqs.get(c - c % 20, [])[:h[c]] + ts[h[c]:] for c, ts in seqs.items()}


def brute(seqs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[tuple(seqs[c][:d])].append(c)
        ends[tuple(seqs[c])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * words(p[-1][1]) if p else 0
    return Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_op13(spark):
    t = pq.read_table(f"{SF}/conversations.parquet").to_pydict()
    rows = list(zip(t["conv_id"], t["turn"], t["role"], t["text"]))
    assert got(registry.QUERIES["op13_conversation_trie"](spark, SF)) == brute(rebuild(sequences(rows)))


def test_ternary_tree():
    assert sorted(ct.by_medians(10)) == list(range(10)) and next(ct.by_medians(7)) == 3
    rng = random.Random(2)
    seqs = sorted({tuple(rng.randint(-3, 3) for _ in range(rng.randint(0, 6))) for _ in range(300)})
    tree = ct.TernaryTree()
    end = {}
    for k in ct.by_medians(len(seqs)):
        end[seqs[k]] = tree.insert(list(seqs[k]), [1] * len(seqs[k]))
    assert len(tree.turn) == len({s[:d] for s in seqs for d in range(len(s) + 1)})
    order = tree.walk()
    assert sorted(order) == list(range(len(tree.turn)))
    at = {v: k for k, v in enumerate(order)}
    for s, node in end.items():
        path = tree.path(node)
        assert tuple(tree.turn[v] for v in path[1:]) == s and tree.insert(list(s), [1] * len(s)) == node
        assert [at[v] for v in path] == sorted(at[v] for v in path)
    wide = ct.TernaryTree()
    for k in ct.by_medians(1023):
        wide.insert([k], [1])
    depth, level = 0, [wide.same[0]]
    while level:
        depth, level = depth + 1, [x for v in level for x in (wide.low[v], wide.high[v]) if x >= 0]
    assert depth == 10  # balanced


@pytest.mark.parametrize("seed", range(3))
def test_many_shards(spark, seed):
    """Shards of a few turns and two rounds of merging; a third of all conversations are the same."""
    rng = random.Random(seed)
    rows = []
    for c in range(200):
        ts = [(rng.choice("ab"), f"t{rng.randint(0, 2)} x") for _ in range(rng.randint(0, 6))] if c % 3 else [("a", "t0 x"), ("b", "t1 x")]
        rows += [(c, k, *t) for k, t in enumerate(ts)]
        if c == 100:
            rows += [(c, 100 + k, "a", f"long {k} x") for k in range(120)]
    seqs = ct.encoded(table(spark, rows).repartition(3))
    want = brute(sequences(rows))
    assert got(ct.trie(seqs)) == want
    assert got(ct.trie(seqs, shard_turns=12)) == want  # some 70 shards
    rebuilt = brute(rebuild(sequences(rows)))
    assert got(ct.trie(ct.rebuilt(seqs), shard_turns=25)) == rebuilt


def test_edges(spark):
    rows = [(None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 0, "", ""),
            (20, 5, "user", "a  b\tc"), (20, 1, "us", "er"), (21, 1, "u", "ser"), (22, 0, "user", "x " * 50_000),
            (39, 0, "user", "only one"), (-5, 0, "user", "x"), (-20, 0, "user", "y"), (41, 7, "a", "b"), (2 ** 60, 0, "user", "x")]
    df = table(spark, rows)
    for c in ("id", "ids", "words", "digest", "shard", "node", "up", "t", "kind"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    assert got(ct.conversation_trie(df)) == brute(sequences(rows))
    positive = [r for r in rows if r[0] is None or r[0] >= 0]
    assert got(ct.trie(ct.rebuilt(ct.encoded(table(spark, positive))))) == brute(rebuild(sequences(positive)))
    turnless = ct.trie(ct.rebuilt(ct.encoded(table(spark, [(39, 0, "user", "x"), (21, 0, "a", "b"), (22, 0, "c", "d")]))))
    assert got(turnless) == brute(rebuild(sequences([(39, 0, "user", "x"), (21, 0, "a", "b"), (22, 0, "c", "d")])))
    assert ct.conversation_trie(df.limit(0)).count() == 0
    assert ct.conversation_trie(df.where("conv_id is null")).count() == 0
