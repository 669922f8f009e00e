"""Surrogates: detection, formats, distinctness, coreference."""

import random
import re

from spokes.llm import surrogates as s


def test_detection():
    text = ("Mail Ann.Lee+x@mail.example.co.uk, call +1 (739) 555-3368 or 212-555-0100, pay 4242 4242 4242 4242, host "
            "10.0.0.1. Mr. John Smith; MARY JONES. IBAN GB82WEST12345698765432, no 078-05-1120. v1.2.3 1999.12.31.5")
    found = [(text[a:b], kind) for a, b, kind, _ in s.detect(text)]
    assert found == [("Ann.Lee+x", "local"), ("mail.example.co.uk", "domain"), ("+1 (739) 555-3368", "phone1"),
                     ("212-555-0100", "phone1"), ("4242 4242 4242 4242", "card"), ("10.0.0.1", "ip"),
                     ("John", "given:m:latin"), ("Smith", "family:latin"), ("MARY", "given:f:latin"),
                     ("JONES", "family:latin"), ("GB82WEST12345698765432", "iban"), ("078-05-1120", "ssn")]


def test_printed_and_national_forms():
    cases = {"GB82 WEST 1234 5698 7654 32": "iban", "DE89 3704 0044 0532 0130 00": "iban", "BE68 5390 0754 7034": "iban",
             "NO93 8601 1117 947": "iban", "555 123 4567": "phone1", "1-800-555-1234": "phone1", "1 800 555 1234": "phone1",
             "020 7946 0958": "phone1", "01 42 68 53 00": "phone1", "01.42.68.53.00": "phone1", "030/1234567": "phone1",
             "0044 20 7946 0958": "phone2", "+44 (0)20 7946 0958": "phone2", "2001:db8::1": "ip6", "fe80::1ff:fe23:4567:890a": "ip6",
             "2001:0DB8:85A3:0000:0000:8A2E:0370:7334": "ip6", "2a00:1450::1.2.3.4": "ip6"}
    for shown, kind in cases.items():
        for text in (f"so {shown} is", f"so {shown}", f"so {shown}, REF", f"so {shown} OK"):
            found = [(text[a:b], k) for a, b, k, _ in s.detect(text)]
            assert found == [(shown, kind)], text
        (_, _, _, norm), = s.detect(shown)
        new = s.render(shown, kind, s.surrogate(b"k", kind, norm, 0))
        assert new != shown and [k for *_, k, _ in s.detect(new)] == [kind], new
        if kind == "iban":
            assert s.detect(shown.replace(" ", ""))[0][3] == norm and [c == " " for c in new] == [c == " " for c in shown]
    # a group of four before it, a colon behind it, and a card that only looks like the rest of an IBAN
    text = "AB12 GB82 WEST 1234 5698 7654 32; 2001:db8::1: no; AB12 4242 4242 4242 4242"
    assert [text[a:b] for a, b, _, _ in s.detect(text)] == ["GB82 WEST 1234 5698 7654 32", "2001:db8::1", "4242 4242 4242 4242"]
    for text in ("on 01-02-2024 10:30", "on 01/02/2024 at", "on 05.06.2023 11", "at 12:30:45", "mac aa:bb:cc:dd:ee:ff",
                 "std::add ::bad1 a::b1", "no 0000012345", "0.1234 5678"):
        assert s.detect(text) == [], text


def test_one_number_has_one_surrogate(spark):
    forms = ["555-123-4567", "1-555-123-4567", "(555) 123-4567", "+1 555 123 4567", "+15551234567", "555.123.4567"]
    df = spark.createDataFrame([(i, f"call {t} now") for i, t in enumerate(forms)], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in s.replace_personal(df, b"k").collect()}
    digits = {re.sub(r"\D", "", rows[i])[-10:] for i in range(len(forms))}
    assert len(digits) == 1 and digits != {"5551234567"}
    other = spark.createDataFrame([(0, "+4930123456"), (1, "+49 30 123456"), (2, "+49 (0)30 123456")], "doc_id long, text string")
    rest = {re.sub(r"\D", "", r.text.replace("(0)", "")) for r in s.replace_personal(other, b"k").collect()}
    assert len(rest) == 1 and all(x.startswith("49") for x in rest)
    assert [re.sub(r"\d", "9", rows[i]) for i in range(len(forms))] == [re.sub(r"\d", "9", f"call {t} now") for t in forms]


def test_addresses_of_any_length(spark):
    local, domain = "x" * 40 + "." + "y" * 300, ".".join(f"part{i}" for i in range(30)) + ".example.org"
    assert [t[:3] for t in s.detect(f"to <{local}@{domain}>")] == [(4, 345, "local"), (346, 346 + len(domain), "domain")]
    assert s.detect("..%@example.org") == [] and s.detect("@example.org") == []
    assert [text for text in [f"-.{'a.' * 200_000}@{'b.' * 200_000}"] if s.detect(text)] == []  # linear, no address


def test_every_kind_is_replaced(spark):
    rows = ["x@y.org", "+49 30 123456", "(212) 555-0100", "212.555.0100", "4242424242424242", "371449635398431", "1.2.3.4",
            "GB82WEST12345698765432", "078-05-1120", "Mr Smith", "Mary Jones", "MARY JONES", "Анна Петрова", "+4930123456"]
    df = spark.createDataFrame([(i, f"so {t} is") for i, t in enumerate(rows)], "doc_id long, text string")
    out = s.replace_personal(df, b"k").collect()
    assert [r.doc_id for r in out if not r.n_units] == []
    for r in out:
        assert rows[r.doc_id] not in r.text


def test_formats():
    rng = random.Random(1)
    for k in range(300):
        digits = "".join(rng.choices("0123456789", k=10))
        norm = "1" + digits
        p = s.render(f"+1 ({digits[:3]}) {digits[3:6]}-{digits[6:]}", "phone1", s.surrogate(b"k", "phone1", norm, k % 9))
        assert re.fullmatch(r"\+1 \([2-9]\d\d\) \d{3}-\d{4}", p)
        body = "4" + "".join(rng.choices("0123456789", k=14))
        card = s.surrogate(b"k", "card", body + str(s._luhn(body)), k)
        assert card[0] == "4" and s._luhn(card[:-1]) == int(card[-1])
        other = s.surrogate(b"k", "cardlike", body + str((s._luhn(body) + 1) % 10), k)
        assert s._luhn(other[:-1]) != int(other[-1])
        assert s._mod97(s.surrogate(b"k", "iban", "GB82WEST12345698765432", k)) == 1
        ip = s.surrogate(b"k", "ip", "192.168.3.4", k)
        assert ip.startswith("192.168.") and all(0 <= int(x) < 256 for x in ip.split("."))
    for word in ("Smith", "Петрова", "Μαρία"):
        script = s.script_of(word)
        assert s.script_of(s.surrogate(b"k", f"family:{script}", word.casefold(), 0)) == script
    assert s.surrogate(b"k", "given:f:cyrillic", "анна", 0)[-1] in "ая"
    assert s.surrogate(b"k", "given:f:latin", "mary", 0)[-1] == "a"


def test_distinct_coreferent_and_keyed(spark):
    mails = [f"{a}{b}@x.org" for a in "abcdefghij" for b in "0123456789"]
    rows = [(i, f"{m} and {m.upper()} of Mr. Smith{'' if i % 2 else ' and Smith'}") for i, m in enumerate(mails)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text.split() for r in s.replace_personal(df, b"k").collect()}
    assert all(t[0].upper() == t[2] for t in out.values())
    assert len({t[0] for t in out.values()}) == len(mails)
    assert not {t[0] for t in out.values()} & set(mails)
    assert len({t[5] for t in out.values()}) == 1 and "Smith" not in str(out)
    other = {r.doc_id: r.text.split() for r in s.replace_personal(df, b"another").collect()}
    assert sum(out[i] != other[i] for i in out) > 90


def test_small_pools_grow(spark):
    """More one-letter addresses than letters: later draws get longer, all stay distinct."""
    units = spark.createDataFrame([("local", f"{c}@{d}.org") for c in "abcdefghijklmnopqrstuvwxyz" for d in "xy"],
                                  "kind string, norm string")
    drawn = s.assign(units, b"k").collect()
    assert len(drawn) == 52 and len({r.drawn for r in drawn}) == 52


def test_fixed_pools_widen(spark):
    """More private addresses, and numbers of a short form, than their forms have free values: it ends, all distinct."""
    ips = spark.range(40_000).selectExpr("'ip' kind", "concat('192.168.', id div 256, '.', id % 256) norm")
    phones = spark.range(50_000).selectExpr("'phone3' kind", "concat('376', 20000 + id) norm")
    units = ips.union(phones)
    drawn = s.assign(units, b"k").collect()
    assert len(drawn) == 90_000 and len({(r.kind, r.drawn) for r in drawn}) == 90_000
    assert {(r.kind, r.norm) for r in drawn} == {tuple(r) for r in units.collect()}
    assert not {(r.kind, r.drawn) for r in drawn} & {(r.kind, r.norm) for r in drawn}
    assert {r.drawn.split(".")[0] for r in drawn if r.kind == "ip"} == {"192", "10"}
    assert s.render("+376 20-123", "phone3", "376987654") == "+376 98-7654"
    for kind, norm in (("ssn", "078051120"), ("card", "4242424242424242"), ("iban", "GB82WEST12345698765432"),
                       ("ip", "10.1.2.3"), ("ip", "127.0.0.1")):
        assert s.surrogate(b"k", kind, norm, 8, 2)[:3] != norm[:3] or len(s.surrogate(b"k", kind, norm, 8, 2)) > len(norm)
    assert s._mod97(s.surrogate(b"k", "iban", "GB82WEST12345698765432", 8, 2)) == 1
