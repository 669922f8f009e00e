"""The mix against brute force: targets by exact fractions, fits by trying all sets, choices by sorting."""

import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spokes.llm import mixing, registry

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """sizes: [(source, size)]; the excess of those above their cap goes to the others, one after the other."""
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(order)}
    size, done, left = dict(order), {}, Fraction(sum(n for _, n in order))
    while len(done) < len(size):
        rest = [s for s in size if s not in done]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > most * size[s]]
        if not above:
            return done | share
        for s in above:
            done[s] = Fraction(most * size[s])
            left -= done[s]
    return done


def check(rows, texts):
    """rows: of the query; texts: [(id, source, text)] of the table."""
    size = defaultdict(int)
    for _, s, t in texts:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    targets = brute_targets(list(size.items()))
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter(
        (i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in texts)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == size[r.source] and 0 <= r.taken <= 3 * r.size
        assert r.taken == r.size * r.copies
        assert r.target == pytest.approx(float(targets[r.source]), rel=1e-12, abs=1e-9)
        taken[r.source] += r.taken
    return {s: (taken[s], float(targets[s])) for s in size}


@given(st.lists(st.text(alphabet=" \t\n\x0b\x0c\ra\x1c\x85é\xa0", max_size=8), max_size=12), st.integers(1, 9), st.integers(0, 3))
@settings(max_examples=200, deadline=None)
def test_words(texts, step, skip):
    want = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts][skip:]
    for kind in (pa.string(), pa.large_string()):
        assert mixing.count_words(pa.array(texts, kind).slice(skip), step).tolist() == want


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), min_size=1, max_size=5), st.integers(0, 120))
@settings(max_examples=300, deadline=None)
def test_fit_is_the_best(lengths, budget):
    """While the window holds the whole budget, no set of documents comes nearer."""
    ns, cs = list(lengths), list(lengths.values())
    got = mixing.fit(ns, cs, budget)
    assert all(0 <= g <= c for g, c in zip(got, cs))
    sums = {sum(k * n for k, n in zip(ks, ns)) for ks in itertools.product(*(range(c + 1) for c in cs))}
    assert abs(sum(g * n for g, n in zip(got, ns)) - budget) == min(abs(s - budget) for s in sums)


def test_fit_beyond_the_window():
    rng = random.Random(1)
    lengths = {rng.randint(1, 2000): rng.randint(1, 50) for _ in range(300)}
    ns, cs = list(lengths), list(lengths.values())
    whole = sum(n * c for n, c in lengths.items())
    for budget in (whole // 9, whole // 3, whole // 2, whole * 9 // 10):
        got = mixing.fit(ns, cs, budget, window=4000)
        assert all(0 <= g <= c for g, c in zip(got, cs))
        assert sum(g * n for g, n in zip(got, ns)) == budget
    # the bulk follows the lengths' distribution
    got = mixing.fit(ns, cs, whole // 2, window=4000)
    long = sum(g * n for g, n in zip(got, ns) if n > 1000) / sum(n * c for n, c in lengths.items() if n > 1000)
    assert 0.45 < long < 0.55
    # only giants are left: the nearest one, if it is nearer than none
    assert mixing.fit([1000, 10 ** 9], [5, 1], 600_000_000, window=100) == [5, 1]
    assert mixing.fit([1000, 10 ** 9], [5, 1], 400_000_000, window=100) == [5, 0]


def test_op12(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "source", "text"]).to_pydict()
    rows = registry.QUERIES["op12_mixing"](spark, SF).collect()
    for taken, target in check(rows, list(zip(t["doc_id"], t["source"], t["text"]))).values():
        assert abs(taken - target) < 60  # ten documents a source
    again = registry.QUERIES["op12_mixing"](spark, SF).collect()
    assert Counter(rows) == Counter(again)


ROWS = [(None, None, "a null source"), (None, None, None), (1, "a", ""), (2, "a", " \n"), (3, "b", "x " * 50_000), (4, "b", "one"),
        (5, "\U0001f600", "beyond the plane"), (6, "￿", "two words"), (7, "Z", "z"), (7, "Z", "z"), (7, "Z", "z"), (8, "", "no name")]


def test_edges(spark):
    clash = ("source_size", "target", "copies", "taken", "pos", "rank", "uid", "key", "size", "n", "part", "_source", "_size")
    docs = spark.createDataFrame([(*r, *["clash"] * len(clash)) for r in ROWS],
                                 "doc_id long, source string, text string, " + ", ".join(f"`{c}` string" for c in clash))
    mix = mixing.mix_sources(docs)
    rows = mix.select("doc.doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()
    for source, (taken, target) in check(rows, [(i, s, t) for i, s, t in ROWS]).items():
        assert source == "b" or abs(taken - target) <= 3
    mixed = mixing.mixed_rows(mix)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    nothing = mixing.mix_sources(docs.where("doc_id < 3")).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


def test_hot_group_over_ranges(spark, monkeypatch):
    """A third of all rows are one document, many share a length: ranks run on over ranges, the smallest hashes are taken."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 40)
    rows = [(0, "a", "same same")] * 300 + [(i, "a", f"w{i} w") for i in range(1, 301)] + [(i, "b", "w " * (i % 7)) for i in range(301, 601)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    mix = mixing.mix_sources(docs, ["doc_id", "text"]).select("doc.*", "source", "size", "source_size", "target", "copies", "taken").collect()
    for taken, target in check(mix, rows).values():
        assert abs(taken - target) <= 1
    keys = {(r.doc_id, r.text): r.key for r in mixing.sized(docs, ["doc_id", "text"], "doc_id", "text", "source", mixing.SEED)
            .select("doc.*", "key").collect()}
    for size in range(1, 7):
        for source in "ab":
            group = sorted((r for r in mix if r.source == source and r.size == size), key=lambda r: (keys[r.doc_id, r.text], -r.copies))
            assert [r.copies for r in group] == sorted((r.copies for r in group), reverse=True)
    once = mixing.mix_sources(docs.repartition(3), ["doc_id"]).select("doc.doc_id", "taken").collect()
    assert Counter(once) == Counter((r.doc_id, r.taken) for r in mix)
