"""Long repeated passages across documents, found by recompression.

Each round names runs of equal symbols and pairs of a left-class and a
right-class symbol by one new symbol.  Classes and names are hashes of what they
stand for, so every task gives the same substring the same names without an
exchange.  Whether two neighbours are joined depends on at most one symbol on
either side, so a symbol comes with the stretch of words that determines it:
wherever these words stand again, so does the symbol.

A window's key is the longest symbol that its own words determine.  Equal
windows have equal keys, so

1. blocks of documents send their keys to key buckets; a bit for each key comes
   back: whether two documents have it,
2. blocks send 96-bit hashes of the windows with such keys, with the smallest
   document id of each, to hash buckets; a bit comes back: whether a document of
   another block has the window and a smaller id,
3. a window that also starts in a document with a smaller id covers its words.

A block sends a key once however often it occurs, so a passage in a third of all
rows is no heavier than another; buckets and blocks have a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks as pieces
from .common import materialise, mix, table, text_of

# Three rounds: more make keys that select hardly better (11 % of the windows stay on test data instead of 12 %) but
# a third more of them.
WINDOW, ROUNDS = 13, 3
BLOCK_TEXT, BUCKET_TEXT = 4 << 20, 32 << 20
# Documents are taken together up to so many words, whose arrays fit a core's cache.
CHUNK_WORDS = 60_000
FAR = np.int64(1) << 40
NO_ID = np.iinfo(np.int64).max  # a null id: larger than any other


def _factors(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def word_names(data: bytes) -> np.ndarray:
    """Two 64-bit hashes of every word of a text: shape (n, 2)."""
    out = [np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, p.split())), "<u8") for p in pieces(data)]
    return np.concatenate(out).reshape(-1, 2)


def window_hashes(names: np.ndarray, window: int) -> np.ndarray:
    """128 bits of every run of ``window`` words (by its first word): shape (n - window + 1, 2)."""
    n = max(0, len(names) - window + 1)
    out = np.zeros((n, 2), np.uint64)
    for half in (0, 1):
        word, sum_ = np.ascontiguousarray(names[:, half]), np.zeros(n, np.uint64)
        for j, f in enumerate(_factors(window, half + 1)):
            sum_ += word[j:j + n] * f
        out[:, half] = mix(sum_)
    return out


def window_keys(names: np.ndarray, ends: np.ndarray, window: int, rounds: int = ROUNDS) -> np.ndarray:
    """The key of the window that starts at each word (of no use where it would leave its document).

    ``names`` are the words' hashes of some documents after each other, ``ends``
    where each document ends.
    """
    n = len(names)
    s = mix(names)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    a = np.arange(n)  # words [a, b) of each symbol, and the words [lo, hi) that determine it
    b, lo, hi = a + 1, a.copy(), a + 1
    best = (np.uint64(1) << np.uint64(58)) | (s >> np.uint64(6))  # a window's first word determines itself
    for r in range(rounds):
        if len(s) < 2:
            break
        left = mix(s ^ np.uint64(0xA5A5A5A5 + r)) >> np.uint64(63) == 1
        near = doc[1:] == doc[:-1]  # between i and i + 1
        pair = left[:-1] & ~left[1:] & near
        paired = np.zeros(len(s), bool)
        paired[:-1] |= pair
        paired[1:] |= pair
        run = (s[1:] == s[:-1]) & near & ~paired[1:] & ~paired[:-1]
        first = np.flatnonzero(np.concatenate([[True], ~(pair | run)]))
        last = np.concatenate([first[1:], [len(s)]]) - 1
        is_pair, length = paired[first], (last - first + 1).astype(np.uint64)
        named = np.where(is_pair, mix(mix(s[first] ^ np.uint64(2 * r + 1)) + s[last]),
                         np.where(length > 1, mix(s[first] ^ mix(length)), s[first]))
        # a pair is determined by its two symbols, a run or a lone symbol also by what stands around it: by the
        # neighbour, and where that is equal but joined to another symbol, by the other symbol
        k = np.maximum(first - 1, 0)
        k = np.where((first > 1) & (s[k] == s[first]), first - 2, k)
        before = np.where((first > 0) & near[np.maximum(first - 1, 0)], lo[k], -FAR)
        k = np.minimum(last + 1, len(s) - 1)
        k = np.where((last + 2 < len(s)) & (s[k] == s[last]), np.minimum(last + 2, len(s) - 1), k)
        after = np.where((last < len(s) - 1) & near[np.minimum(last, len(near) - 1)], hi[k], FAR)
        lo, hi = np.where(is_pair, lo[first], before), np.where(is_pair, hi[last], after)
        a, b, s, doc = a[first], b[last], named, doc[first]
        fit = np.flatnonzero((hi - lo <= window) & (b - a > 1))
        size = np.minimum(b[fit] - a[fit], 63).astype(np.uint64)
        rank = (size << np.uint64(58)) | (s[fit] >> np.uint64(6))
        at, room = lo[fit], window - (hi[fit] - lo[fit])
        for back in range(window - 1):
            some = room >= back
            if not some.any():
                break
            at, room, rank = at[some], room[some], rank[some]
            inside = at >= back
            np.maximum.at(best, at[inside] - back, rank[inside])
    return best


class Block:
    """Some documents: ids, texts, and their words' names after each other."""

    def __init__(self, blob: bytes, window: int):
        t = pa.ipc.open_stream(blob).read_all()
        self.ids = t.column("id")
        self.texts = [x.as_py().encode() for x in t.column("text")]
        each = [word_names(x) for x in self.texts]
        self.sizes = np.array([len(x) for x in each], np.int64)
        self.names = np.concatenate(each)
        self.ends = np.cumsum(self.sizes)
        self.order = self.ids.fill_null(NO_ID).to_numpy().astype(np.int64)
        self.doc = np.repeat(np.arange(len(each)), self.sizes)  # document number by word
        start = np.arange(len(self.names))
        self.starts = np.flatnonzero(start + window <= self.ends[self.doc])  # words where a window starts

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Names and document ends of some documents at a time."""
        first, at = 0, 0
        while first < len(self.ends):
            last = max(first + 1, int(np.searchsorted(self.ends, at + CHUNK_WORDS)))
            end = int(self.ends[min(last, len(self.ends)) - 1])
            yield self.names[at:end], self.ends[first:last] - at
            first, at = last, end

    def keys(self, window: int) -> np.ndarray:
        """The keys of the windows."""
        return np.concatenate([window_keys(n[:, 0], e, window) for n, e in self.chunks()])[self.starts]




class Distinct:
    """The distinct keys of a block (equal arrays side by side), with the smallest and largest id of each, by bucket."""

    def __init__(self, keys: list[np.ndarray], ids: np.ndarray, buckets: int):
        order = np.lexsort((ids, *keys[::-1]))
        new = np.ones(len(ids), bool)
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(ids)]])[:len(first)] - 1
        bucket = (mix(keys[0][order[first]]) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        self.of = np.empty(len(ids), np.int64)  # where each key given stands among the distinct ones
        self.of[order] = place[np.cumsum(new) - 1]
        self.keys = [k[order[first]][by] for k in keys]
        self.least, self.most = ids[order[first]][by], ids[order[last]][by]
        bucket = bucket[by]
        start = np.flatnonzero(np.diff(bucket, prepend=-1))
        self.cells = {int(bucket[i]): slice(i, j) for i, j in zip(start, [*start[1:], len(bucket)])}

    def flags(self, answers: list[tuple[int, bytes]]) -> np.ndarray:
        """The buckets' answers (bucket, a bit for each key) by distinct key."""
        out = np.zeros(len(self.least), bool)
        for bucket, bits in answers:
            cell = self.cells[bucket]
            out[cell] = np.unpackbits(np.frombuffer(bits, np.uint8), count=cell.stop - cell.start)
        return out


# What a block sends to a bucket: keys (64 bits, and 32 more of window hashes), and of each key either whether two
# documents of the block have it (a bit) or its smallest id (from ``base``, in as many bytes as the block needs).
SENT = "bucket long, block long, high binary, low binary, base long, kind string, of_key binary"
SENT_ARROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("high", pa.binary()), ("low", pa.binary()),
                        ("base", pa.int64()), ("kind", pa.string()), ("of_key", pa.binary())])
ANSWERED = "block long, bucket long, bits binary"


def _send_keys(d: Distinct, block: int) -> Iterator[dict]:
    for bucket, c in d.cells.items():
        several = np.packbits(d.least[c] < d.most[c]).tobytes()
        yield {"bucket": bucket, "block": block, "high": d.keys[0][c].tobytes(), "low": b"", "base": 0, "kind": "",
               "of_key": several}


def _send_windows(d: Distinct, block: int) -> Iterator[dict]:
    base = int(d.least.min()) if len(d.least) else 0
    kind = "<u4" if len(d.least) and int(d.least.max()) - base < 2**32 else "<u8"
    for bucket, c in d.cells.items():
        yield {"bucket": bucket, "block": block, "high": d.keys[0][c].tobytes(), "low": d.keys[1][c].tobytes(),
               "base": base, "kind": kind, "of_key": (d.least[c].astype(np.uint64) - np.uint64(base % 2**64)).astype(kind).tobytes()}


def _answer(t: pa.Table, judge) -> pa.Table:
    """For one bucket: ``judge`` gives a bit for each key of each row from the groups of equal keys."""
    rows = t.to_pylist()
    high = [np.frombuffer(r["high"], np.uint64) for r in rows]
    sizes = [len(x) for x in high]
    keys = [np.concatenate(high)]
    if any(r["low"] for r in rows):
        keys.append(np.concatenate([np.frombuffer(r["low"], np.uint32) for r in rows]))
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    bits = np.split(judge(rows, sizes, group, order, np.flatnonzero(new)), np.cumsum(sizes)[:-1])
    out = [(r["block"], r["bucket"], np.packbits(x).tobytes()) for r, x in zip(rows, bits) if x.any()]
    block, bucket, packed = zip(*out) if out else ((), (), ())
    return pa.table({"block": pa.array(block, pa.int64()), "bucket": pa.array(bucket, pa.int64()),
                     "bits": pa.array(packed, pa.binary())})


def _shared(t: pa.Table) -> pa.Table:
    """Keys that two blocks have, or two documents of one block."""
    def judge(rows, sizes, group, order, first):
        several = np.concatenate([np.unpackbits(np.frombuffer(r["of_key"], np.uint8), count=n).astype(bool)
                                  for r, n in zip(rows, sizes)])
        shared = np.bincount(group, minlength=len(first)) > 1
        shared |= np.bincount(group, several, minlength=len(first)) > 0
        return shared[group]

    return _answer(t, judge)


def _earlier(t: pa.Table) -> pa.Table:
    """Windows that a document of another block has whose id is smaller than all of this block's that have it."""
    def judge(rows, sizes, group, order, first):
        least = np.concatenate([(np.frombuffer(r["of_key"], r["kind"]).astype(np.uint64) + np.uint64(r["base"] % 2**64))
                                .astype(np.int64) for r in rows])
        return np.minimum.reduceat(least[order], first)[group] < least

    return _answer(t, judge)


def _pairs(answers: pa.Table) -> list[tuple[int, bytes]]:
    return list(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``block, blob``: the documents in compressed blocks of bounded size, each row in one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, size
            t = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t)
            row = pa.RecordBatch.from_arrays([pa.array([part << 32 | number], pa.int64()),
                                              pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "blob"])
            number, held, size = number + 1, [], 0
            return row

        for b in batches:
            # cut the batch where a block is full
            lengths = b.column("n").to_numpy()
            b = b.select(["id", "text"])
            at = 0
            for i, n in enumerate(lengths):
                size += int(n)
                if size >= BLOCK_TEXT:
                    held.append(b.slice(at, i + 1 - at))
                    at = i + 1
                    yield flush()
            if at < len(lengths):
                held.append(b.slice(at))
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.withColumn("n", F.octet_length("text")).mapInArrow(run, "block long, blob binary")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, kept`` for every row: the text without the words that a window covers whose
    words also start in a document with a smaller id.

    ``kept`` has the other words joined by one space.  Ids are longs; a null id
    counts as larger than any other.  Rows that share an id don't remove each
    other's words.  Null text has no words; other columns are ignored.
    """
    blocks = materialise(_blocks(docs, id_col, text_col), "blocks")
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
    buckets = max(16, -(-n_bytes // BUCKET_TEXT))

    def keys_of(b: Block) -> Distinct:
        return Distinct([b.keys(window)], b.order[b.doc[b.starts]], buckets)

    def windows_of(b: Block, answers: list[tuple[int, bytes]]) -> tuple[np.ndarray, Distinct]:
        """Where the windows start whose keys are shared, and their hashes."""
        d = keys_of(b)
        at = b.starts[d.flags(answers)[d.of]]
        h = window_hashes(b.names, window)[at]
        return at, Distinct([h[:, 0], (h[:, 1] >> np.uint64(32)).astype(np.uint32)], b.order[b.doc[at]], buckets)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("block").to_pylist(), batch.column("blob").to_pylist()):
                for row in _send_keys(keys_of(Block(blob, window)), number):
                    yield pa.RecordBatch.from_pylist([row], SENT_ARROW)

    def windows(mine: pa.Table, answers: pa.Table) -> pa.Table:
        rows, said = [], _pairs(answers)
        if said:
            for number, blob in zip(mine.column("block").to_pylist(), mine.column("blob").to_pylist()):
                rows += _send_windows(windows_of(Block(blob, window), said)[1], number)
        return pa.Table.from_pylist(rows, SENT_ARROW)

    def clean(mine: pa.Table, answers: pa.Table) -> pa.Table:
        first = answers.filter(pc.equal(answers.column("step"), 1))
        second = answers.filter(pc.equal(answers.column("step"), 2))
        ids, n_words, n_removed, kept = [], [], [], []
        for blob in mine.column("blob").to_pylist():
            b = Block(blob, window)
            gone = np.zeros(len(b.names) + 1, np.int32)
            if first.num_rows:
                at, d = windows_of(b, _pairs(first))
                hit = at[d.flags(_pairs(second))[d.of] | (b.order[b.doc[at]] > d.least[d.of])]
                gone[hit] += 1  # a word starts at most one window
                np.subtract.at(gone, hit + window, 1)
            gone = np.cumsum(gone[:-1]) > 0
            for i, text in enumerate(b.texts):
                mask = gone[b.ends[i] - b.sizes[i]:b.ends[i]]
                words = text.split()
                n_words.append(len(words))
                n_removed.append(int(mask.sum()))
                if n_removed[-1]:
                    words = [w for w, g in zip(words, mask) if not g]
                kept.append(b" ".join(words).decode())
            ids += b.ids.to_pylist()
        return pa.table({id_col: pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    def with_blocks(answers: DataFrame):
        return blocks.groupBy("block").cogroup(answers.groupBy("block"))

    shared = materialise(blocks.mapInArrow(keys, SENT).groupBy("bucket").applyInArrow(_shared, ANSWERED), "shared")
    sent = with_blocks(shared).applyInArrow(windows, SENT)
    earlier = sent.groupBy("bucket").applyInArrow(_earlier, ANSWERED)
    answers = shared.withColumn("step", F.lit(1)).union(earlier.withColumn("step", F.lit(2)))
    schema = T._parse_datatype_string(f"`{id_col}` long, n_words long, n_removed long, kept string")
    return with_blocks(answers).applyInArrow(clean, schema)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages that a smaller document has."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
