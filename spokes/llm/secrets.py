"""Secret scan: fixed patterns plus a battery of randomness tests.

Besides the patterns, every long run of key characters whose encoding can be
inferred is tested for randomness: a chi-squared test of the uniform use of its
alphabet, a runs test about the alphabet's middle and a test of the serial
correlation of neighbours.  The three p-values are combined (Bonferroni).  A run
is reported as a secret of kind ``random`` if "it is words" is rejected and "it
is random" isn't.  Both are decided over all documents by Benjamini-Hochberg
within each encoding and band of lengths (on p-values rounded to a hundredth of a
power of ten): the first keeps the share of words among the secrets below
``q_words`` (``wordlike``), the second the share of random runs among those that
are passed over below ``q``.  A run that no alphabet holds, such as a
token of base64url in the path of a url, is tested by its parts (``parts``), whose
spans can lie within each other.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, table, text_of
from .wordlike import WordModel, corpus_pairs

# The base patterns, and the least length of what counts.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("passw", "secret", "token", "apikey", "api_key")

RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
UP, LOW, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# alphabets in the order in which they are tried; the first that holds a run is its encoding
ALPHABETS = {"lowers": LOW, "uppers": UP, "letters": UP + LOW, "hex": DIGIT + "abcdef", "HEX": DIGIT + "ABCDEF", "base32": UP + "234567", "upper": DIGIT + UP,
             "lower": DIGIT + LOW, "alnum": UP + LOW + DIGIT, "base64": UP + LOW + DIGIT + "+/",
             "base64url": UP + LOW + DIGIT + "-_"}
INDEX = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
# where a run that no alphabet holds is split: between base64url, between base64, and between letters and digits alone
SPLITS = tuple(re.compile(p) for p in (r"[^+/]{20,}", r"[^_-]{20,}", r"[^+/_-]{20,}"))
BANDS = (20, 32, 48, 64, 96, 128, 256)
FINEST, LAST_BIN = 100, 30_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def encoding(run: str) -> str | None:
    """The first alphabet that holds the run; None for digits alone, which say nothing, and where there is none."""
    if run.isdigit():
        return None
    chars = set(run)
    return next((name for name, index in INDEX.items() if chars <= index.keys()), None)


def parts(run: str) -> list[tuple[int, int]]:
    """(start, end) of what is tested of a run: all of it or, where it mixes '+' or '/' with '-' or '_', its long parts."""
    if not (("+" in run or "/" in run) and ("-" in run or "_" in run)):
        return [(0, len(run))]
    return sorted({m.span() for split in SPLITS for m in split.finditer(run)})


def _normal(z: float) -> float:
    """Two-sided p-value."""
    return math.erfc(abs(z) / math.sqrt(2))


def p_random(run: str, name: str) -> float:
    """Combined p-value of the battery under "each character is drawn evenly from the alphabet"."""
    k, n = len(ALPHABETS[name]), len(run)
    x = np.array([INDEX[name][c] for c in run])
    # chi-squared over equal stretches of the alphabet, so many that each expects four characters or more
    cells = max(2, min(k, n // 4))
    share = np.diff([-(-k * i // cells) for i in range(cells + 1)]) / k
    seen = np.bincount(x * cells // k, minlength=cells)
    stat, df = float(((seen - n * share) ** 2 / (n * share)).sum()), cells - 1
    z = ((stat / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))  # Wilson and Hilferty
    p_uniform = 0.5 * math.erfc(z / math.sqrt(2))
    # runs above and below the middle
    high = 2 * x >= k
    a = int(high.sum())
    b = n - a
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if a and b:
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _normal((abs(runs - mean) - 0.5 if abs(runs - mean) > 0.5 else 0) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    # serial correlation of neighbours, with the alphabet's own mean and variance
    y = (x - (k - 1) / 2) / math.sqrt((k * k - 1) / 12)
    p_serial = _normal(float((y[1:] * y[:-1]).sum()) / math.sqrt(n - 1))
    return min(1.0, 3 * min(p_uniform, p_runs, p_serial))


def _bin(p: float) -> int:
    return min(LAST_BIN, int(-math.log10(p) * FINEST)) if p > 0 else LAST_BIN


def candidates(text: str, base: list[tuple[int, int, int]], words: WordModel) -> list[tuple[int, int, int, int, int]]:
    """(start, end, stratum, bin of "random", bin of "words") of the tested runs that no base span touches."""
    out = []
    for m in RUN.finditer(text):
        for a, b in parts(m[0]):
            start, end = m.start() + a, m.start() + b
            if any(s < end and start < e for s, _, e in base):
                continue
            name = encoding(m[0][a:b])
            if name is None:
                continue
            stratum = list(ALPHABETS).index(name) * len(BANDS) + bisect_right(BANDS, end - start) - 1
            run = m[0][a:b]
            out.append((start, end, stratum, _bin(p_random(run, name)), _bin(words.p_words(run))))
    return out


def thresholds(bins: DataFrame, q: float, col: str = "bin") -> dict[int, int]:
    """For each stratum the smallest bin that is rejected, from rows ``stratum, col``.

    The table of counts is bounded by strata and bins, whatever the corpus.
    """
    counts: dict[int, dict[int, int]] = {}
    n = F.sum("n") if "n" in bins.columns else F.count("*")
    for stratum, b, n in bins.groupBy("stratum", col).agg(n).collect():
        counts.setdefault(stratum, {})[b] = n
    out = {}
    for stratum, by in counts.items():
        m, above = sum(by.values()), 0
        out[stratum] = LAST_BIN + 1
        for b in sorted(by, reverse=True):
            above += by[b]
            if 10 ** (-b / FINEST) <= q * above / m:
                out[stratum] = b
    return out


SPANS = "struct<start:int,kind:int,end:int>"
TESTED_FIELDS = ("start", "end", "stratum", "bin", "words")
TESTED = f"struct<{','.join(f'{c}:int' for c in TESTED_FIELDS)}>"


def _scan(docs: DataFrame, id_col: str, text_col: str, words: WordModel) -> DataFrame:
    """``id``, base spans and tested runs of every row."""
    schema = T._parse_datatype_string(f"id {docs.schema[id_col].dataType.simpleString()}, "
                                      f"base array<{SPANS}>, tested array<{TESTED}>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        test = pa.list_(pa.struct([(c, pa.int32()) for c in TESTED_FIELDS]))
        for b in batches:
            base, tested = [], []
            for x in b.column("text"):
                text = x.as_py()
                base.append(base_spans(text))
                tested.append(candidates(text, base[-1], words))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"),
                 pa.array([[dict(zip(("start", "kind", "end"), s)) for s in row] for row in base], span),
                 pa.array([[dict(zip(TESTED_FIELDS, s)) for s in row] for row in tested], test)],
                ["id", "base", "tested"])

    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def find_secrets(docs: DataFrame, q: float = 0.05, q_words: float = 0.02, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, base, found`` for every row: the base spans, and these with the ``random`` ones.

    Spans are structs (start, kind, end) of code points, ``kind`` numbering
    ``KINDS``, in order of start and kind.  Null text counts as empty; null ids
    and repeated rows keep their rows; other columns are ignored.
    """
    rows = materialise(_scan(docs, id_col, text_col, WordModel.of(corpus_pairs(docs, text_col))), "secrets")
    tested = rows.select(F.inline("tested"))
    limit, least = thresholds(tested, q), thresholds(tested, q_words, "words")
    more = F.expr("array()").cast(f"array<{SPANS}>")
    if limit:
        by, words = (F.create_map(*chain(*((F.lit(s), F.lit(b)) for s, b in of.items()))) for of in (limit, least))
        random = F.filter("tested", lambda t: (t.bin < F.element_at(by, t.stratum)) & (t.words >= F.element_at(words, t.stratum)))
        more = F.transform(random, lambda t: F.struct(t.start.alias("start"), F.lit(3).alias("kind"),
                                                      t.end.alias("end")))
    return rows.select(F.col("id").alias(id_col), "base",
                       F.array_sort(F.concat("base", more)).alias("found"))


def redact_secrets(docs: DataFrame, q: float = 0.05, q_words: float = 0.02, mark: str = "[secret]",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with every span found replaced by ``mark``; overlapping spans become one.

    All columns stay; a null text stays null, rows without a span are untouched.
    """
    words = WordModel.of(corpus_pairs(docs, text_col))
    tested = _scan(docs.select(F.lit(0).alias("id"), text_col), "id", text_col, words).select(F.inline("tested"))
    tested = materialise(tested.groupBy("stratum", "bin", "words").agg(F.count("*").alias("n")), "secret-bins")
    limit, least = thresholds(tested, q), thresholds(tested, q_words, "words")
    never = LAST_BIN + 1

    def clean(text: str) -> str:
        base = base_spans(text)
        spans = [(s, e) for s, _, e in base]
        spans += [(s, e) for s, e, stratum, b, w in candidates(text, base, words) if b < limit.get(stratum, never) and w >= least.get(stratum, never)]
        out, at = [], 0
        for s, e in sorted(spans):
            if s >= at:
                out += [text[at:s], mark]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index(text_col)
            col = b.column(i)
            done = pa.array([clean(x.as_py()) if x.is_valid else None for x in col], pa.string())
            yield b.set_column(i, pa.field(text_col, pa.string()), done)

    kept = docs.withColumn(text_col, F.col(text_col).cast("string"))
    return kept.mapInArrow(run, kept.schema)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: counts and digest of the base patterns, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, KINDS))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(kinds, s.kind + 1), s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"))
