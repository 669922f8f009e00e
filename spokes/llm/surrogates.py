"""Keyed surrogates for personal data.

Detection finds e-mail addresses, phone and card numbers, IPv4 and IPv6 addresses,
social security numbers, IBANs and names of persons with a listed title or given
name (README has the exact forms), and splits them into units that are replaced by
themselves: the local part and the domain of an address, the
given and the family name of a person.  A unit's surrogate is drawn by HMAC from
the key, the unit's kind and its normal form, so one unit has one surrogate in
every document and every spelling (coreference), of the same format, script and
gender.  A corpus-wide check lets no two units of a kind share a surrogate and
no surrogate be a unit of the corpus; whoever loses draws again.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, table, text_of

# Patterns, titles and given names that name persons.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")
# Ten digits in threes and a four: a number of the North American plan, with or without its country code.
NANP = re.compile(r"\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}", re.ASCII)
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# An IBAN as it is printed, in groups of four.
PRINTED_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ \xa0][A-Z0-9]{4}){2,7}(?:[ \xa0][A-Z0-9]{1,4})?(?![A-Za-z0-9])",
                          re.ASCII)
NUMBERS = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9]))"
    rf"|(?P<ip>(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d))"
    rf"|(?P<ip6>(?<![\w:.])[0-9A-Fa-f]{{1,4}}:(?:[0-9A-Fa-f]{{0,4}}:){{1,7}}(?:(?:{OCTET}\.){{3}}{OCTET}|[0-9A-Fa-f]{{1,4}})?(?!\w))"
    r"|(?P<card>(?<!\d)(?:\d{4}(?P<a>[ -]?)\d{4}(?P=a)\d{4}(?P=a)\d{4}|3[47]\d{2}(?P<b>[ -]?)\d{6}(?P=b)\d{5})(?!\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,8}){1,4}(?!\d)|(?<![\w+])\+\d{8,15}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}[ .-]?\(0\)[ .-]?\d{1,5}(?:[ .-]?\d{2,8}){1,4}(?!\d)"
    r"|(?<![\w.+-])(?:1[ .-])?\d{3}(?P<c>[ .-])\d{3}(?P=c)\d{4}(?![\w-])"
    # with a trunk prefix, in at least two groups; no date
    r"|(?<![\w.+/-])(?!\d\d(?P<d>[./-])\d\d(?P=d)\d{2,4}(?!\d|(?P=d)\d))0\d{1,4}[ ./-]\d{2,8}(?:[ .-]?\d{2,8}){0,4}"
    r"(?![\w-]))", re.ASCII)
LEAST_TRUNK = 9
TITLES = {
    "m": "Mr Sir Herr Monsieur Señor Signor господин кύριος Κύριος Господин",
    "f": "Mrs Ms Miss Frau Madame Mademoiselle Señora Señorita Signora госпожа Госпожа Κυρία",
    "x": "Dr Prof Doctor Professor Доктор",
}
GIVEN = {
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul "
         "Andrew Peter George Henry Hans Karl Friedrich Wolfgang Jürgen Pierre Jean Jacques François Louis Antoine "
         "José Juan Carlos Miguel Antonio Luis Pedro Иван Пётр Сергей Алексей Дмитрий Николай Γιώργος Νίκος Δημήτρης",
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Emily Anna "
         "Alice Emma Helen Laura Ursula Ingrid Greta Sabine Marie Jeanne Claire Camille Juliette María Carmen Isabel "
         "Lucía Elena Анна Мария Елена Ольга Наталья Татьяна Μαρία Ελένη Σοφία",
}
TITLE_OF = {t: g for g, names in TITLES.items() for t in names.split()}
GIVEN_OF = {n: g for g, names in GIVEN.items() for n in names.split()}
UPPER = r"A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫЀ-Я"
CAP = rf"[{UPPER}][\w'’-]*\w"
TITLED = re.compile(rf"(?<!\w)({'|'.join(sorted(TITLE_OF, key=len, reverse=True))})\b\.? ({CAP})(?: ({CAP}))?")
PAIR = re.compile(rf"(?<!\w)({CAP}) ({CAP})")
# Quick tests that a text passes if it holds a number or a title of the kinds above.
SOME_NUMBER = re.compile(r"\d[\d ./()-]{5,}\d|[A-Z]{2}\d{2}[ \xa0]?[A-Z0-9]{4}|[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:", re.ASCII)
SOME_TITLE = [t for t in TITLE_OF if not any(u != t and u in t for u in TITLE_OF)]
# Syllables of invented names, and how names of either gender end.
SYLLABLES = {"latin": ("b c d f g h j k l m n p r s t v w z br dr gr kl st tr".split(), "a e i o u".split()),
             "cyrillic": ("б в г д ж з к л м н п р с т ф х бр гр ст".split(), "а е и о у".split()),
             "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ στ τρ".split(), "α ε ι ο υ".split())}
ENDINGS = {"latin": {"m": "n r s l k", "f": "a ia ina", "x": "y e i"},
           "cyrillic": {"m": "н р м л", "f": "а я ина", "x": "о и"},
           "greek": {"m": "ος ης ας", "f": "α η ω", "x": "ι ο"}}


def script_of(word: str) -> str:
    c = word[0]
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _luhn(digits: str) -> int:
    """The digit that makes ``digits`` plus it a valid number."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 else (2 * d if d < 5 else 2 * d - 9)
    return -total % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _printed_ibans(text: str) -> list[tuple[int, int, str, str]]:
    """Valid IBANs in groups; a word in capitals behind the last group, or a code before the first, isn't part of it."""
    out, m = [], PRINTED_IBAN.search(text)
    while m:
        end = m.end()
        while end > m.start() + 4 and _mod97(norm := re.sub(r"[ \xa0]", "", text[m.start():end])) != 1:
            end = max(text.rfind(" ", m.start(), end), text.rfind("\xa0", m.start(), end))
        valid = end > m.start() + 4 and len(norm) >= 15
        if valid:
            out.append((m.start(), end, "iban", norm))
        m = PRINTED_IBAN.search(text, end if valid else m.start() + 4)
    return out


def _ip6(seen: str) -> tuple[str, str] | None:
    """An IPv6 address without a colon of the sentence, and its normal form; None for times, scopes of names and the like."""
    if seen.endswith(":") and not seen.endswith("::"):
        seen = seen[:-1]
    if len(seen.split(":", 1)[0]) < 3 and seen.count(":") < 7 or not any(c.isdigit() for c in seen):
        return None
    try:
        return seen, ipaddress.IPv6Address(seen).exploded
    except ValueError:
        return None


# Country codes of one and of two digits; all others have three.
CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                  "81 82 84 86 90 91 92 93 94 95 98".split())


def _code_length(digits: str) -> int:
    """How many digits the country code of an international number has, however it is spaced."""
    return next((n for n in (1, 2) if digits[:n] in CODES), 3)


def _local_start(text: str, at: int) -> int:
    """Where the local part before the ``@`` at ``at`` begins: at a letter or digit; ``at`` where there is none."""
    begin = at
    while begin and text[begin - 1] in LOCAL:
        begin -= 1
    while begin < at and text[begin] in "._%+-":
        begin += 1
    return begin


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Units (start, end, kind, normal form), in order, none overlapping another."""
    found: list[list[tuple[int, int, str, str]]] = []
    at = text.find("@")
    while at >= 0:
        begin, domain = _local_start(text, at), DOMAIN.match(text, at + 1)
        if begin < at and domain:
            found.append([(begin, at, "local", text[begin:domain.end()].lower()),
                          (at + 1, domain.end(), "domain", domain[0].lower())])
        at = text.find("@", at + 1)
    some, rest = SOME_NUMBER.search(text), text
    if ibans := _printed_ibans(text) if some else []:
        found += [[unit] for unit in ibans]
        # no other number lies within
        rest = "".join("x" * (b - a) + text[b:c] for (a, b), c in zip(
            [(0, 0), *((a, b) for a, b, *_ in ibans)], [*(a for a, *_ in ibans), len(text)]))
    for m in NUMBERS.finditer(rest) if some else ():
        kind, end = m.lastgroup, m.end()
        if kind == "ip6":
            if not (ip6 := _ip6(m[0])):
                continue
            end, norm = m.start() + len(ip6[0]), ip6[1]
        elif kind == "iban":
            if _mod97(m[0]) != 1:
                continue
            norm = m[0]
        else:
            norm = m[0] if kind == "ip" else re.sub(r"\D", "", m[0].replace("(0)", ""))
        if kind == "card":
            kind = "card" if _luhn(norm[:-1]) == int(norm[-1]) else "cardlike"
        elif kind == "phone":
            if not 8 <= len(norm) <= 15:
                continue
            plus = m[0][0] == "+"  # the country code stays, and so does a trunk prefix
            trunk = "" if plus else re.match("0{0,2}", norm)[0] or re.match(r"(?:1(?=[ .-]))?", m[0])[0]
            if trunk[:1] == "0" and m[0][0] == "0" and len(norm) < LEAST_TRUNK:
                continue
            kind = f"phone{_code_length(norm) if plus else len(trunk)}"
            if not plus and not trunk and NANP.fullmatch(m[0]):
                kind, norm = "phone1", f"1{norm}"  # one number with or without its 1
        found.append([(m.start(), end, kind, norm)])
    found += _persons(text)
    out, end = [], 0
    for group in sorted(found):
        if group[0][0] >= end:
            out += group
            end = group[-1][1]
    return out


def _persons(text: str) -> list[list[tuple[int, int, str, str]]]:
    groups, known = [], {}

    def unit(m: re.Match, g: int, role: str) -> tuple[int, int, str, str]:
        word = m[g]
        if word.lower().endswith(("'s", "’s")):
            word = word[:-2]
        kind = f"{role}:{script_of(word)}"
        known[word] = known[word.upper()] = kind
        return m.start(g), m.start(g) + len(word), kind, word.casefold()

    for m in TITLED.finditer(text) if any(t in text for t in SOME_TITLE) else ():
        gender = TITLE_OF[m[1]]
        if m[3]:
            gender = GIVEN_OF.get(m[2], gender)
            groups.append([unit(m, 2, f"given:{gender}"), unit(m, 3, "family")])
        else:
            groups.append([unit(m, 2, "family")])
    at = 0
    while m := PAIR.search(text, at):
        if gender := GIVEN_OF.get(m[1].capitalize() if m[1].isupper() else m[1]):
            groups.append([unit(m, 1, f"given:{gender}"), unit(m, 2, "family")])
            at = m.end()
        else:
            at = m.start(2)
    if known:  # the same persons, named by one of their names alone
        alone = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(known, key=len, reverse=True)))})(?!\w)")
        taken = {(s, e) for g in groups for s, e, _, _ in g}
        groups += [[(*m.span(), known[m[0]], m[0].casefold())] for m in alone.finditer(text) if m.span() not in taken]
    return groups


class Draw:
    """Numbers from HMAC-SHA256 of the key and a label, as many as are asked for."""

    def __init__(self, key: bytes, label: str):
        self.key, self.label, self.i, self.rest = key, label.encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.rest) < 4:
            self.rest = hmac.new(self.key, self.i.to_bytes(4, "big") + self.label, hashlib.sha256).digest()
            self.i += 1
        x, self.rest = self.rest[:4], self.rest[4:]
        return int.from_bytes(x, "big") * n >> 32

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))

    def shaped(self, s: str) -> str:
        """Letters for letters, digits for digits, the rest as it is."""
        return "".join(chr(97 + self.below(26)) if c.isalpha() else str(self.below(10)) if c.isdigit() else c
                       for c in s)


def surrogate(key: bytes, kind: str, norm: str, attempt: int, wider: int = 0) -> str:
    """The ``attempt``-th surrogate of a unit in normal form; later attempts on short forms grow longer.

    Forms of a fixed size keep it unless ``wider``: private addresses are then drawn from
    10.0.0.0/8 (1) and from all public ones (2), numbers get so many digits more.
    """
    d = Draw(key, f"{kind}\0{norm}\0{attempt}")
    longer = attempt // 4
    if kind == "local":
        return d.shaped(norm.rpartition("@")[0] + "a" * longer)
    if kind == "domain":
        name, _, top = norm.rpartition(".")
        return d.shaped(name + "a" * longer) + "." + top
    if kind == "ip":
        first = int(norm.split(".")[0])
        private = norm.startswith("192.168.")
        if first in (10, 127) and wider < 2:
            head = [first]
        elif private and wider < 2:
            head = [10] if wider else [192, 168]
        else:
            head = [next(x for x in iter(lambda: 1 + d.below(223), None) if x not in (10, 127, 172, 192))]
        return ".".join(map(str, head + [d.below(256) for _ in range(4 - len(head))]))
    if kind == "ip6":
        first = int(norm[:4], 16)
        head = norm[:9] if norm.startswith("2001:0db8") else norm[:4] if first >= 0xFC00 else f"{0x2000 + d.below(0x2000):04x}"
        return ":".join([head, *(f"{d.below(1 << 16):04x}" for _ in range(7 - head.count(":")))])
    if kind.startswith("phone"):
        code = int(kind[5:])
        return norm[:code] + str(2 + d.below(8)) + d.digits(len(norm) - code - 1 + wider)
    if kind == "card":
        body = norm[:1] + d.digits(len(norm) - 2 + wider)
        return body + str(_luhn(body))
    if kind == "cardlike":
        body = norm[:1] + d.digits(len(norm) - 2 + wider)
        return body + str((_luhn(body) + 1 + d.below(9)) % 10)
    if kind == "ssn":
        return f"{1 + d.below(665):03d}{1 + d.below(99):02d}{1 + d.below(9999):04d}" + d.digits(wider)
    if kind == "iban":
        body = d.shaped(norm[4:].lower()).upper() + d.digits(wider)
        return f"{norm[:2]}{98 - _mod97(norm[:2] + '00' + body):02d}{body}"
    role, script = kind.rsplit(":", 1)
    heads, vowels = SYLLABLES[script]
    n = (1 if role.startswith("given") else 2) + d.below(2) + longer
    name = "".join(heads[d.below(len(heads))] + vowels[d.below(len(vowels))] for _ in range(n))
    ends = ENDINGS[script][role[-1] if role.startswith("given") else "x"].split()
    return name + heads[d.below(len(heads))] + (vowels[d.below(len(vowels))] if role.endswith("m") and script != "greek"
                                                 else "") + ends[d.below(len(ends))]


def render(seen: str, kind: str, drawn: str) -> str:
    """The surrogate in the spelling of what it replaces: its punctuation and case."""
    if kind == "phone1" and NANP.fullmatch(seen):
        drawn = drawn[1:]
    if kind.startswith(("phone", "card")) or kind == "ssn":
        digits, trunk = iter(drawn), seen.find("(0)")
        out = "".join(next(digits) if c.isascii() and c.isdigit() and not 0 <= trunk == i - 1 else c
                      for i, c in enumerate(seen))
        return out + "".join(digits)  # a later draw can be longer
    if kind == "iban":
        signs = iter(drawn)
        return "".join(next(signs) if c.isalnum() else c for c in seen) + "".join(signs)
    if kind == "ip6":
        short = ipaddress.IPv6Address(drawn).compressed
        return short.upper() if seen.isupper() else short
    if kind == "ip":
        return drawn
    if len(seen) > 1 and seen.isupper():
        return drawn.upper()
    return drawn[:1].upper() + drawn[1:] if seen[:1].isupper() else drawn


UNIT = "struct<start:int,end:int,kind:string,norm:string>"


def _scan(docs: DataFrame) -> DataFrame:
    """``docs`` (id, h, text) with the ``units`` of every row."""
    schema = T._parse_datatype_string(
        f"id {docs.schema['id'].dataType.simpleString()}, h long, text string, units array<{UNIT}>")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()),
                               ("norm", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units = [[dict(zip(("start", "end", "kind", "norm"), u)) for u in detect(x.as_py() or "")]
                     for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(units, kind)], [*b.schema.names, "units"])

    return docs.select("id", "h", "text").mapInArrow(run, schema)


# After so many attempts at a time the forms of a fixed size are drawn from a larger pool.
FEW = 4


def _draw(units: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("kind", "norm", "attempt")))
            drawn = [surrogate(key, kind, norm, n, n // FEW) for kind, norm, n in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(drawn, pa.string())], [*b.schema.names, "drawn"])

    return units.select("kind", "norm", "attempt").mapInArrow(run, "kind string, norm string, attempt int, drawn string")


def normal_of_drawn(kind: str = "kind", drawn: str = "drawn", norm: str = "norm"):
    """What the surrogate would be as a unit: an address's local part comes with its domain."""
    return F.when(F.col(kind) == "local", F.concat(drawn, F.lit("@"), F.substring_index(norm, "@", -1))).otherwise(
        F.col(drawn))


def assign(units: DataFrame, key: bytes) -> DataFrame:
    """``kind, norm, drawn`` for distinct ``units`` (kind, norm): distinct surrogates, none of them a unit itself.

    In each round the smallest unit that draws a surrogate gets it, unless it is
    taken or real; the others draw again, from larger and larger pools (``FEW``),
    so it ends also where a kind's form has fewer free values than units.
    """
    units = materialise(units.select("kind", "norm").distinct(), "units")
    todo, done = units.withColumn("attempt", F.lit(0)), None
    while True:
        now = _draw(todo, key)
        now = materialise(now.withColumn("as_unit", normal_of_drawn()), "drawn")
        best = now.groupBy("kind", "drawn").agg(F.min("norm").alias("norm"))
        won = now.join(best, ["kind", "drawn", "norm"], "left_semi")
        real = units.select("kind", F.col("norm").alias("as_unit"))
        won = won.join(real, ["kind", "as_unit"], "left_anti").select("kind", "norm", "drawn")
        if done is not None:
            won = won.join(done.select("kind", "drawn"), ["kind", "drawn"], "left_anti")
        won = materialise(won.select("kind", "norm", "drawn"), "won")  # the join puts its columns first
        lost = materialise(now.join(won, ["kind", "norm"], "left_anti")
                           .select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), "lost")
        done = won if done is None else done.union(won)
        if lost.isEmpty():
            return done
        todo = lost


def replace_personal(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text, n_units`` for every row: the text with surrogates, and how many units were replaced.

    A null text stays null, an empty one empty, with no unit.  Repeated rows and
    null ids keep their rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # every text is searched once; the texts without a unit, most of them, go no further
    rows = materialise(_scan(rows.withColumn("h", F.xxhash64("text"))), "personal")
    found = rows.where(F.size("units") > 0)
    each = found.select("id", "h", F.inline("units"))
    drawn = assign(each.select("kind", "norm"), key)
    spans = F.sort_array(F.collect_set(F.struct("start", "end", "kind", "drawn")))
    by = each.join(drawn, ["kind", "norm"]).groupBy("id", "h").agg(spans.alias("spans"))
    by = by.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "spans")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    changed = _apply(found.join(by, same).select("id", "text", "spans"))
    plain = rows.where(F.size("units") == 0).select("id", "text", F.lit(0).cast("long").alias("n_units"))
    return plain.union(changed).select(F.col("id").alias(id_col), "text", "n_units")


def _apply(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n = [], []
            for x, spans in zip(b.column("text"), b.column("spans").to_pylist()):
                text, out, at = x.as_py(), [], 0
                for s in spans or ():
                    out += [text[at:s["start"]], render(text[s["start"]:s["end"]], s["kind"], s["drawn"])]
                    at = s["end"]
                texts.append("".join([*out, text[at:]]) if spans else text)
                n.append(len(spans or ()))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string()), pa.array(n, pa.int64())],
                                             ["id", "text", "n_units"])

    schema = T.StructType([rows.schema["id"], T.StructField("text", T.StringType()),
                           T.StructField("n_units", T.LongType())])
    return rows.mapInArrow(run, schema)


# The queries' key; a user passes a secret one.
QUERY_KEY = b"surrogates of the registered query"


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    return replace_personal(table(spark, sf_dir, "documents"), QUERY_KEY)
