"""Benchmark decontamination by a prefix-filtered set join, in DataFrame expressions.

A window is ten consecutive words of a benchmark item (all of a shorter item).
A document that contains a window contains every shingle of it, so one shingle
is a sufficient prefix; the window's rarest one over the corpus is joined.  A
meeting at document position ``p`` with a shingle at offset ``o`` places the
window at ``p - o``; it must lie within the document (position and length
bounds), and then its words are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, text_of, unlike
from .url_filter import LOWER, UPPER

WINDOW, SHINGLE = 10, 3
# Fixed value: what is not part of a word, after lower-casing.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Shingle hashes are broadcast in blocks of about this many (8 bytes each).
BLOCK_HASHES = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATOR), "")


def shingle_hashes(words: str, size: int) -> Column:
    """Hashes of the runs of ``size`` words by position (none where there are fewer words)."""
    w = F.col(words)
    starts = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(size), *(F.get(w, i + k) for k in range(size))))


def benchmark_windows(items: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``w, size, items, same, hashes``: distinct windows, the ids of their items (as strings) and their shingles.

    ``same`` names the set of items: windows that occur in the same items share it.
    """
    it = items.select(F.col(id_col).cast("string").alias("item"), words_of(text_of(text_col)).alias("words"))
    it = it.where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    each = it.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("w"))
    wins = each.groupBy("w").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hashes = shingle_hashes("w", shingle)
    size = F.lit(shingle)
    for k in range(shingle - 1, 0, -1):  # windows shorter than a shingle
        hashes = F.when(F.size("w") == k, shingle_hashes("w", k)).otherwise(hashes)
        size = F.when(F.size("w") == k, F.lit(k)).otherwise(size)
    return wins.select("w", "items", F.sha2(F.to_json("items"), 256).alias("same"), size.alias("size"),
                       hashes.alias("hashes"))


def _meetings(texts: DataFrame, wanted: DataFrame, cols: list) -> DataFrame:
    """Rows (size, hash, pos and ``cols`` of texts) for every document shingle in ``wanted`` (size, hash).

    ``wanted`` is broadcast in blocks of a bounded number of hashes; another
    block is another pass over the texts.
    """
    sizes = [r.size for r in wanted.select("size").distinct().collect()]  # at most SHINGLE numbers
    out = []
    for size in sorted(sizes):
        mine = wanted.where(F.col("size") == size).select(F.col("hash").alias("_hash"))
        n_blocks = -(-mine.count() // BLOCK_HASHES)
        # Hashed in a projection of its own, so that explode and join are compiled together and the words aren't
        # copied for every position.  The outer form keeps the optimizer from inferring filters on the whole
        # expression, over which it would not come to an end; null hashes meet nothing.
        found = texts.select("*", shingle_hashes("words", size).alias("hashes"))
        found = found.select("*", F.posexplode_outer("hashes").alias("pos", "hash"))
        for block in range(n_blocks):
            part = mine.where(F.pmod("_hash", F.lit(n_blocks)) == block) if n_blocks > 1 else mine
            out.append(found.join(F.broadcast(part), F.col("hash") == F.col("_hash"))
                       .select(F.lit(size).alias("size"), "hash", "pos", *cols))
    if not out:
        empty = texts.limit(0).select("*", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("hash"))
        return empty.select(F.lit(0).alias("size"), "hash", "pos", *cols)
    whole = out[0]
    for more in out[1:]:
        whole = whole.union(more)
    return whole


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_hit, n_items, items, spans`` for every row of ``docs``.

    ``items`` are the ids (as strings, sorted) of the items with a window that
    occurs, ``spans`` the word ranges covered, merged, as (start, end).  Null
    and empty texts have no words and contain nothing; items without words have
    no window; an empty benchmark hits nothing.  Repeated rows and null ids keep
    their rows; other columns are ignored.
    """
    texts, wins, found = _hits(docs, items, window, shingle, id_col, text_col, item_col, item_text_col)
    by = _by_document(wins, found).alias("h")
    sizes = texts.select("id", "key", F.size("words").cast("long").alias("n_words")).alias("d")
    same = F.col("d.id").eqNullSafe(F.col("h.id")) & (F.col("d.key") == F.col("h.key"))
    none = F.array().cast("array<string>")
    return sizes.join(by, same, "left").select(
        F.col("d.id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"), "spans")


def _hits(docs: DataFrame, items: DataFrame, window: int, shingle: int, id_col: str, text_col: str, item_col: str,
          item_text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``id, key, words`` of all documents; the windows; and ``id, key, start, end, sets`` of each range hit.

    ``sets`` are the names of the item sets of the windows found there.
    """
    wins = materialise(benchmark_windows(items, window, shingle, item_col, item_text_col), "windows")
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    texts = rows.select("id", F.xxhash64("text").alias("key"), words_of(F.col("text")).alias("words"))

    # how often each shingle of the benchmark occurs in the corpus
    every = wins.select("size", F.explode("hashes").alias("hash")).distinct()
    often = _meetings(texts, every, []).groupBy("size", "hash").agg(F.count("*").alias("n"))
    often = materialise(often, "shingle-counts")
    at = wins.select("w", "same", "size", F.posexplode("hashes").alias("offset", "hash"))
    # a shingle the corpus lacks rules its window out
    ranked = at.join(often, ["size", "hash"], "left").groupBy("w", "same", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("rarest"))
    prefix = ranked.where("rarest.n > 0").groupBy("size", F.col("rarest.hash").alias("hash")).agg(
        F.collect_list(F.struct(F.col("rarest.offset").alias("offset"), "w", "same")).alias("wins"))
    prefix = materialise(prefix, "prefix")

    # the words around a meeting, enough for any window that holds the shingle
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    around = F.slice("words", first + 1, F.col("pos") - first + window)
    met = _meetings(texts, prefix.select("size", "hash"), ["id", "key", F.size("words").alias("n_words"),
                                                          first.alias("first"), around.alias("around")])
    met = materialise(met, "meetings")

    def fits(x: Column) -> Column:
        start = F.col("pos") - x.offset
        inside = (start >= 0) & (start + F.size(x.w) <= F.col("n_words"))
        return inside & (F.slice("around", F.greatest(start - F.col("first"), F.lit(0)) + 1, F.size(x.w)) == x.w)

    found = met.join(prefix, ["size", "hash"]).select("id", "key", "pos", F.filter("wins", fits).alias("found"))
    # all of these windows hold the shingle, so together they cover one range
    found = found.where(F.size("found") > 0).select(
        "id", "key", F.array_min(F.transform("found", lambda x: F.col("pos") - x.offset)).alias("start"),
        F.array_max(F.transform("found", lambda x: F.col("pos") - x.offset + F.size(x.w))).alias("end"),
        F.array_distinct(F.transform("found", lambda x: x.same)).alias("sets"))
    return texts, wins, materialise(found, "found")


def _by_document(wins: DataFrame, found: DataFrame) -> DataFrame:
    """``id, key, spans, items, n_hit`` of the documents that contain a window.

    A document's item sets are made distinct before their items are looked up.
    """
    by = found.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    by = by.select("id", "key", _merged("spans").alias("spans"))
    sets = found.select("id", "key", F.explode("sets").alias("same")).distinct()
    items_of = wins.select("same", "items").dropDuplicates(["same"])
    items = sets.join(items_of, "same").select("id", "key", F.explode("items").alias("item"))
    items = items.groupBy("id", "key").agg(F.array_sort(F.collect_set("item")).alias("items")).alias("i")
    same = F.col("b.id").eqNullSafe(F.col("i.id")) & (F.col("b.key") == F.col("i.key"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s.end - s.start)
    return materialise(by.alias("b").join(items, same).select("b.id", "b.key", "spans", "items", hits.alias("n_hit")),
                       "hits")


def _merged(spans: str) -> Column:
    """Sorted ranges with overlapping and touching ones made one."""
    kind = "array<struct<start:int,end:int>>"

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last.start.alias("start"), F.greatest(last.end, s.end).alias("end"))
        return (F.when((F.size(acc) > 0) & (s.start <= F.try_element_at(acc, F.lit(-1)).end),
                       F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined)))
                .otherwise(F.concat(acc, F.array(s))))

    return F.aggregate(spans, F.array().cast(kind), add)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, shingle: int = SHINGLE, item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no window of ``items``; all columns stay.

    A row goes by its own text, also where others share its id or have none.
    """
    _, _, found = _hits(docs, items, window, shingle, id_col, text_col, item_col, item_text_col)
    hit_id, hit_key = unlike(docs, "_hit_id", "_hit_key")
    gone = materialise(found.select(F.col("id").alias(hit_id), F.col("key").alias(hit_key)).distinct(), "contaminated")
    same = F.col(id_col).eqNullSafe(F.col(hit_id)) & (F.xxhash64(text_of(text_col)) == F.col(hit_key))
    return docs.join(gone, same, "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))
