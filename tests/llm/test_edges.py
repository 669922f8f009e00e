"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing extra columns."""

import random

import public_tokenizers
import pytest

from spokes.llm import (decontaminate, fingerprint, packing, quality, recompression, secrets, simhash, surrogates,
                        token_counts, url_filter)

TOKENS = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(random.Random(0).choice(["alpha", "beta", "Gamma,", "delta\n", "épsilon"]) for _ in range(60_000))
EXTRA = ("id", "fp", "h", "key", "words", "spans", "part", "guest", "n", "length", "block", "node", "root", "digest",
         "maybe", "hash", "pos", "size", "doc", "label", "first", "u", "keep")
ROWS = [(None, "a null id"), (None, None), (1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, LONG), (6, "x" * 200_000),
        (7, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (7, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (8, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (9, "a a a a a a a a a a a a a a a a a a a a a a a a a"), (9, "the same id, another text"),
        (10, "secret=abcdef123 mail me@example.org <|endoftext|> \U0001f600 \ufb03")]
COPIED = [4, 7, 7, 8]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *["clash"] * len(EXTRA)) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in EXTRA))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "nine ten", "x"), (None, "word", "x"), (4, "Nowhere to be seen", "x"),
            (5, "two three four five six seven eight nine ten eleven twelve", "x"), (5, "FOUR five", "x")]
    return spark.createDataFrame(rows, "item_id long, text string, words string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (7, 1, 0), (7, 0, 1), (9, 0, None), (None, 1, 1), (99, 1, 0), (5, None, 1)],
                                 "doc_id long, quality int, toxic int")


def everything(spark, docs, items, labels, folder):
    return {
        "surrogates": lambda: surrogates.replace_personal(docs, b"k"),
        "simhash": lambda: simhash.simhash_groups(docs),
        "decontaminate": lambda: decontaminate.contamination(docs, items),
        "secrets": lambda: secrets.find_secrets(docs),
        "redact": lambda: secrets.redact_secrets(docs),
        "tokens": lambda: token_counts.token_counts(docs, TOKENS, f"{folder}/cache"),
        "fingerprint": lambda: fingerprint.fingerprints(docs),
        "with_next": lambda: fingerprint.with_next(docs),
        "repeats": lambda: recompression.remove_repeats(docs),
        "quality": lambda: quality.resample(docs, quality.fit(docs, labels)),
        "urls": lambda: url_filter.url_filter(docs, url_filter.RULES, url_filter.UrlModel([0.0] * 8, -1.0), "doc_id", "text"),
    }


NAMES = list(everything(None, None, None, None, None))


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_row(spark, docs, items, labels, tmp_path, name):
    assert everything(spark, docs, items, labels, tmp_path)[name]().count() == len(ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs, items, labels, tmp_path, name):
    none = docs.limit(0)
    assert everything(spark, none, items.limit(0), labels.limit(0), tmp_path)[name]().count() == 0


def test_packing_edges(spark, docs):
    rows = packing.pack_documents(docs, TOKENS).collect()
    assert len({(r.doc_id, r.piece) for r in rows if r.doc_id is not None}) == len(rows) - 2 - 2  # ids 7 and 9 twice
    assert [r.length for r in rows if r.doc_id == 2] == [1]
    assert packing.pack_documents(docs.limit(0), TOKENS).count() == 0


def test_simhash_dedup_edges(spark, docs):
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.select("doc_id", "text").collect())
    # null, empty and blank texts are one group (fingerprint zero), led by id 1; 7, 7 and 8 are another
    assert [(i, t[:10]) for n, i, t in ids if not n] == [
        (1, ""), (4, "word"), (5, LONG[:10]), (6, "x" * 10), (7, "one two th"), (9, "a a a a a "), (9, "the same i"),
        (10, "secret=abc")]
    assert [t for n, _, t in ids if n] == ["a null id"]
    assert simhash.simhash_dedup(docs.limit(0)).count() == 0


def test_filters_keep_columns(spark, docs, items, labels):
    for out in (decontaminate.decontaminate(docs, items), quality.keep_good(docs, labels), secrets.redact_secrets(docs)):
        assert out.columns == docs.columns
    left = {r.doc_id for r in decontaminate.decontaminate(docs, items).select("doc_id").collect()}
    assert left == {None, 1, 2, 3, 5, 6, 9, 10}
    assert quality.keep_good(docs, labels.limit(0)).count() == len(ROWS)


HELPERS = ("_hit_id", "_hit_key", "_gone_id", "_gone_key", "_label_id", "_label_good", "_label_fit", "_keep_id", "_KEEP_FP", "_several_id",
           "_keep_fp_of", "key", "text_key")


def test_filters_with_clashing_helper_names(spark, docs, items, labels):
    plain = docs.select("doc_id", "text")
    clash = plain.selectExpr("*", *(f"'clash' AS `{c}`" for c in HELPERS))
    for run in (lambda d: simhash.simhash_dedup(d), lambda d: decontaminate.decontaminate(d, items), lambda d: quality.keep_good(d, labels)):
        out = run(clash)
        assert out.columns == clash.columns
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
        assert sorted(map(key, out.select("doc_id", "text").collect())) == sorted(map(key, run(plain).collect()))


def test_rows_without_or_with_a_shared_id_are_judged_by_their_own_text(spark, labels):
    text = "one two three four five six seven eight nine ten eleven"
    rows = [(None, text), (None, "clean"), (None, None), (7, text), (7, "clean too"), (8, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    left = [tuple(r) for r in decontaminate.decontaminate(docs, items).collect()]
    assert sorted(left, key=str) == sorted([r for r in rows if r[1] != text], key=str)

    good, bad = "good words here and there", "junk junk $$$ junk"
    rows = [(i, f"{good} {i}") for i in range(60)] + [(i, f"{bad} {i}") for i in range(60, 120)]
    rows += [(None, f"{good} x"), (None, f"{bad} x"), (5, f"{bad} y"), (70, f"{good} y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120) if i not in (5, 70)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    judged = {(r.id, r.text): r.keep for r in quality.resample(docs.withColumnRenamed("text", "body"), model, text_col="body", carry=["body"])
              .withColumnRenamed("body", "text").collect()}
    left = {tuple(r) for r in quality.keep_good(docs, labels).collect()}
    assert left == {r for r, keep in judged.items() if keep} and len({judged[r] for r in rows[-4:]}) == 2


def test_dedup_of_equal_ids_and_texts_is_determined(spark):
    rows = [(1, "same text", f"v{k}") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    kept = {tuple(simhash.simhash_dedup(docs.repartition(n)).collect()) for n in (1, 3, 7)}
    assert len(kept) == 1


def test_pages_edges(spark):
    urls = [None, "", "no scheme", "https://", "HTTP://WWW.Example.com/en/x", "http://a.net/es/", "http://a.net", "x://com/?q=://b",
            "http://com/en", "http://example.com/en/", "http://xexample.com/en/", "http://org/" + "a" * 50_000]
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    got = [tuple(r) for r in url_filter.url_filter(pages, url_filter.RULES, url_filter.UrlModel([0.0] * 8, -1.0))
           .orderBy("page_id").select("host", "path", "rule", "verdict").collect()]
    none = ("", "", None, "allow")
    assert got[:4] == [none, none, none, none]
    assert got[4:11] == [("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("a.net", "/es/", "net/es/", "block"),
                         ("a.net", "", None, "allow"), ("com", "/", "com/", "allow"), ("com", "/en", "com/", "allow"),
                         ("example.com", "/en/", "example.com/en/", "block"), ("xexample.com", "/en/", "com/", "allow")]
    model = url_filter.train(url_filter.labelled_by_rules(pages, url_filter.RULES), dim=64, steps=2)
    assert url_filter.url_filter(pages, url_filter.RULES, model).count() == len(urls)
    none = url_filter.labelled_by_rules(pages.limit(0), url_filter.RULES)
    assert url_filter.train(none, dim=8).bias < 0
