"""PII: candidate spans from patterns, boosted trees over format and context, calibrated thresholds."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import saved, table, text_or_empty

#: The kinds of the base patterns, and those that the trees alone find.
KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret", "iban")

#: The base patterns. Possessive repeats and the look behind keep long runs linear and change no match: a match
#: that begins inside a run of its first class ends as the one from the run's start does.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: The generators of candidates: whatever could be meant as one of the kinds, also spelt out, split or cut.
WIDE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?:(?:\.| ?(?:\(dot\)|\[dot\]|\bdot\b) ?)[A-Za-z0-9-]{1,63}+){1,8}+"
        r"| at [A-Za-z0-9-]{1,63}+(?: ?(?:\(dot\)|\[dot\]|\bdot\b) ?[A-Za-z0-9-]{1,63}+){1,8}+)"
    ),
    "ip": r"(?<![0-9])[0-9]{1,3}+(?: ?(?:\.|\[\.\]|\(dot\)) ?[0-9]{1,3}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[ .-]{0,3}+[0-9]){11,22}+",
    "phone": r"(?:\+|\b00)?+\(?+[0-9]{1,4}+\)?+(?:[ ./-]{0,2}+\(?+[0-9]{2,4}+\)?+){2,5}+",
    # three dotted parts of a signed token, or a run with a digit or a capital after a small letter; words have neither
    "secret": (
        r"(?<![A-Za-z0-9+/_-])(?:eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++"
        r"|(?=[A-Za-z+/_-]*?(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_-]{12,}+)"
    ),
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Words before a span of the kind, in English, German, French and Spanish.
HINTS = {
    "email": r"(?i)mail|contact|write|reach|schreib|kontakt|courriel|[ée]cri|correo|escrib", "ip": r"(?i)\bip\b|host|server|address|adresse|serveur|servidor",
    "card": r"(?i)card|visa|credit|pay|karte|carte|tarjeta|pago", "phone": r"(?i)phone|call|tel|mobile|fax|ruf|handy|appel|llam|m[óo]vil",
    "secret": r"(?i)(?:token|secret|passw|pwd|api.?key|\bkey|auth|credential|passwort|motdepasse|contrase)[a-z_]{0,8}[\"']?\s*(?:[:=]|=>|is)?\s*[\"']?$",
    "iban": r"(?i)iban|account|bank|konto|compte|cuenta",
}
#: Words before a span that name a digest, or a number that is no telephone's.
DIGEST = r"(?i)sha-?[0-9]{1,3}|md5|digest|checksum|hash|commit|etag|fingerprint|revision|uuid|guid"
COUNTER = r"(?i)\b(?:is[bs]n|imei|pages?|pp|seiten?|p[áa]ginas?|parts?|version|v|no|nr|n[ºo]|numbers?|nummer|order|invoice|ref|id|doi|years?|from|chapter|item|sku|serial|model)\b[^A-Za-z]{0,6}$"
#: Top-level domains that a spelt-out address ends in, for what an address of one's own may be.
TOPS = r"(?i)\b(?:com|org|net|edu|gov|io|info|[a-z]{2})$"
CONTEXT = 24
#: Spans are planted by tasks of that many documents; a small table is spread over PARTS tasks all the same.
PLANT_ROWS, PARTS = 1 << 13, 32
#: Thresholds are multiples of 1 / GRID.
GRID = 10_000


#: Elements of an array that are gone through at once; appending to an array copies it.
BLOCK = 256


def let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scan(items: Column, zero: Column, step, kind: str) -> Column:
    """What step gives for each item from left to right: step(state, item) is (state, out), and out has the type kind.

    Blocks are gone through one by one, and so is each block, so that the time follows the length to the power of 1.5 at most.
    """

    def cut(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda c: F.slice(xs, c * BLOCK + 1, BLOCK))

    def one(acc: Column, x: Column) -> Column:
        state, out = step(acc["a"], x)
        return F.struct(state.alias("a"), F.array_append(acc["o"], out).alias("o"))

    def block(acc: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, F.struct(acc["a"].alias("a"), F.expr(f"cast(array() as array<{kind}>)").alias("o")), one)
        return let(inner, lambda r: F.struct(r["a"].alias("a"), F.array_append(acc["o"], r["o"]).alias("o")))

    start = F.struct(zero.alias("a"), F.expr(f"cast(array() as array<array<{kind}>>)").alias("o"))
    return F.flatten(F.aggregate(let(items, cut), start, block, lambda acc: acc["o"]))


def located(text: Column, pattern: str, context: bool = False) -> Column:
    """array<struct<s, e, m>>: matches left to right, s and e in code points. context adds pre, the CONTEXT code points before, and post, the one after."""
    size, more = F.char_length, ",pre:string,post:string" if context else ""
    kind = f"struct<s:int,e:int,m:string{more}>"

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        s = state["at"] + size(x["gap"])
        e = s + size(x["m"])
        out = [s.alias("s"), e.alias("e"), x["m"].alias("m")]
        if not context:
            return F.struct(e.alias("at")), F.struct(*out)
        pre = F.right(F.concat(state["tail"], x["gap"]), F.lit(CONTEXT))
        post = F.left(F.concat(x["next"], F.coalesce(x["then"], F.lit(""))), F.lit(1))
        return F.struct(e.alias("at"), F.right(F.concat(pre, x["m"]), F.lit(CONTEXT)).alias("tail")), F.struct(*out, pre.alias("pre"), post.alias("post"))

    def places(found: Column) -> Column:
        def zipped(gaps: Column) -> Column:
            ahead = [F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"), F.slice(found, F.lit(2), F.size(found)).alias("then")] if context else []
            return F.filter(F.arrays_zip(found.alias("m"), gaps.alias("gap"), *ahead), lambda x: x["m"].isNotNull())

        zero = F.struct(F.lit(0).alias("at"), *([F.lit("").alias("tail")] if context else []))
        return F.when(F.size(found) > 0, scan(let(F.split(text, pattern, -1), zipped), zero, step, kind)).otherwise(F.expr(f"cast(array() as array<{kind}>)"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), places)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The sum of a number's digits from the right, each second one doubled, less 9 where that is over 9."""
    back, n = F.reverse(digits), F.char_length(digits)

    def value(i: Column) -> Column:
        v = F.substring(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), value), F.lit(0), lambda a, v: a + v)


def luhn(m: Column) -> Column:
    digits = digits_of(m)
    return F.when(F.char_length(digits) > 0, luhn_sum(digits) % 10 == 0).otherwise(False)


def iban_holds(m: Column) -> Column:
    """Whether the check digits of an IBAN hold: the number made of its letters' places, the first four signs last, leaves 1 after division by 97."""
    packed = F.replace(m, F.lit(" "), F.lit(""))
    return rest97(F.concat(F.substring(packed, 5, 40), F.substring(packed, 1, 4))) == 1


def rest97(signs: Column) -> Column:
    """What the number leaves after division by 97, with A as 10 to Z as 35."""
    digits = F.array_join(F.transform(F.split(signs, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    step = lambda a, x: F.concat(a.cast("string"), x).cast("long") % 97
    return F.aggregate(F.regexp_extract_all(digits, F.lit("[0-9]{1,9}"), F.lit(0)), F.lit(0).cast("long"), step)


def valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    n = F.char_length(digits_of(m))
    return F.when(n.between(13, 19), luhn(m)).otherwise(False) if kind == "card" else n.between(9, 15)


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as array<struct<{kind}>>)")


def _base_of(text: Column, k: int, kind: str) -> Column:
    hits = F.filter(located(text, BASE[kind]), lambda x: valid(kind, x["m"]))
    return F.transform(hits, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))


def base_spans(text: Column) -> Column:
    """array<struct<k, s, e>> of the base matches that hold, by kind and start. No pattern runs over a text without its first sign."""
    may = {"email": text.contains("@"), "phone": text.contains("+")}
    each = [F.when(may.get(kind, text.rlike("[0-9]")), _base_of(text, k, kind)).otherwise(_none("k:int,s:int,e:int")) for k, kind in enumerate(KINDS)]
    return F.concat(*each)


def _wide_of(text: Column, k: int, kind: str) -> Column:
    each = located(text, WIDE[kind], context=True)
    return F.transform(each, lambda x: F.struct(F.lit(k).alias("k"), *[x[n].alias(n) for n in ("s", "e", "m", "pre", "post")]))


def candidates(text: Column) -> Column:
    """array<struct<k, s, e, m, pre, post>> of all generators; spans of different kinds may overlap."""
    may = {"email": text.rlike(r"@|\(at\)|\[at\]|\bat\b"), "secret": text.rlike(WIDE["secret"]), "iban": text.rlike(WIDE["iban"])}
    none = _none("k:int,s:int,e:int,m:string,pre:string,post:string")
    return F.concat(*[F.when(may.get(kind, text.rlike("[0-9]")), _wide_of(text, k, kind)).otherwise(none) for k, kind in enumerate(ALL_KINDS)])


def features(c: Column) -> list[Column]:
    """Format and context of a candidate, as doubles."""
    m, pre, post = c["m"], c["pre"], c["post"]
    count = lambda pattern: F.regexp_count(m, F.lit(pattern))
    n = F.char_length(digits_of(m))
    last = F.regexp_extract(m, r"([A-Za-z]*)[^A-Za-z]*$", 1)
    cols = [
        *[c["k"] == k for k in range(len(ALL_KINDS))],
        F.char_length(m), n, count("[A-Za-z]"), count("[A-Z]"), count(r"\."), count(" "), count("-"), count("[()]"), m.contains("@"), m.startswith("+"),
        m.rlike(r"\[|\(at|\(dot|\bat\b|\bdot\b"), n.between(9, 15), F.when(n.between(12, 24), luhn(m)).otherwise(False),
        m.rlike(rf"^{OCTET}(?:[^0-9]+{OCTET}){{3}}$"), pre.rlike("[A-Za-z0-9]$"), post.rlike("[A-Za-z0-9]"), pre.rlike("[0-9.][ .-]?$"),
        F.char_length(last), F.size(F.array_distinct(F.split(F.substring(m, 1, 64), ""))), m.rlike("[0-9].*[A-Za-z].*[0-9]"), pre.rlike("[\"'=:] ?$"),
        count("[0-9]{2,4}"), count("[0-9]{5,}"), *[pre.rlike(HINTS[k]) for k in ALL_KINDS],
        pre.rlike(DIGEST), pre.rlike(COUNTER), m.rlike(r"^(?:(?:19|20)[0-9]{2}[^0-9]*)+$"), m.rlike("^97[89]"), (c["k"] == 0) & m.rlike(TOPS), m.rlike("^(?:19|20)[0-9]{2}[^0-9]"),
        m.rlike("^[0-9a-fA-F]+$"), m.rlike("^[A-Za-z]+$"), m.startswith("eyJ"), m.rlike("[a-z][A-Z]"), F.when(c["k"] == ALL_KINDS.index("iban"), iban_holds(m)).otherwise(False),
    ]
    return [F.coalesce(x.cast("double"), F.lit(0.0)) for x in cols]


def truth(c: Column) -> Column:
    """Whether the candidate as it stands is a base match that holds: those stay without the trees."""
    out = F.lit(False)
    for k, kind in enumerate(KINDS):
        out = F.when(c["k"] == k, c["m"].rlike(f"^(?:{BASE[kind]})$") & valid(kind, c["m"])).otherwise(out)
    return out


def untold(c: Column) -> Column:
    """Whether a document's own candidate may well be personal data, so that nothing teaches it as wrong: its form holds, and a word before it or the form itself says so."""
    k, m, n = c["k"], c["m"], F.char_length(digits_of(c["m"]))
    hinted = lambda kind: c["pre"].rlike(HINTS[kind])
    out = F.lit(True)  # secrets: no pattern tells them apart
    for kind, may in (
        ("email", m.rlike(TOPS)), ("ip", m.rlike(rf"^{OCTET}(?:[^0-9]+{OCTET}){{3}}$")), ("card", F.when(n.between(13, 19), luhn(m)).otherwise(False)),
        ("phone", n.between(9, 15) & (hinted("phone") | m.rlike(r"^(?:\+|00|\()")) & ~c["pre"].rlike(COUNTER)), ("iban", iban_holds(m)),
    ):
        out = F.when(k == ALL_KINDS.index(kind), may).otherwise(out)
    return out


#: What stands before planted spans, by kind; and before what only looks like one.
LEADS = {
    "email": ("", "mail me at ", "contact: ", "schreib an ", "écrire à ", "correo "), "ip": ("", "host ", "server ", "adresse "),
    "card": ("", "card ", "visa: ", "tarjeta ", "Karte "), "phone": ("", "call ", "tel. ", "Handy ", "appeler "),
    "secret": ('token = "', "api_key: ", "password=", "secret '", 'auth_token="', "key = ", "Bearer token "), "iban": ("", "IBAN ", "account: ", "Konto ", "compte "),
}
PLAIN_LEADS = ("", "commit ", "see ", "id ", "file ", "(", "= ")
DIGEST_LEADS = ("sha1 key: ", "sha256 key = ", "md5: ", 'checksum = "', "digest key: ", "commit key: ", "fingerprint key ", "etag: ", "hash key = ")
NAME_LEADS = (*LEADS["secret"], "the key ", "key ", "The token ")
BOOK_LEADS = ("ISBN ", "ISBN: ", "isbn ", "ISBN-13 ", "")
YEAR_LEADS = ("", "in ", "from ", "years ", "(", "seit ")
COUNT_LEADS = ("pages ", "page ", "pp. ", "Seite ", "part no. ", "part number ", "version ", "No. ", "Nr. ", "order ", "invoice ", "ref. ", "id ", "serial ", "item ")


def planted(h: Column) -> list[tuple]:
    """(kind, whether it is personal data, text, what may stand before it) of spans made from a hash: forms that no base pattern has, and near misses of each."""
    digits = lambda n, i: F.substring(F.lpad(F.abs(F.xxhash64(h, F.lit(i))).cast("string"), 19, "4"), 2, n)
    letters = lambda n, i: F.substring(F.translate(F.lower(F.lpad(F.hex(F.xxhash64(h, F.lit(i))), 16, "7")), "0123456789", "ghijklmnop"), 1, n)
    octet = lambda i, of=256: F.pmod(F.xxhash64(h, F.lit(i)), F.lit(of)).cast("string")
    pick = lambda xs, i: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.pmod(F.xxhash64(h, F.lit(i)), F.lit(len(xs))) + 1).cast("int"))
    top = pick(("com", "org", "net", "de", "fr", "es", "io", "edu"), 0)
    cat, groups = F.concat, lambda d, sep: F.regexp_replace(d, "(?<=^.{4}|^.{8}|^.{12})", sep)
    body = digits(15, 1)
    card = cat(body, ((10 - luhn_sum(cat(body, F.lit("0"))) % 10) % 10).cast("string"))
    wrong = cat(body, ((13 - luhn_sum(cat(body, F.lit("0"))) % 10) % 10).cast("string"))
    area, office, line = digits(3, 2), digits(3, 3), digits(4, 4)
    part = lambda least, i: F.substring(letters(16, i), F.lit(1), (F.pmod(F.xxhash64(h, F.lit(i)), F.lit(7)) + least).cast("int"))
    site, t = part(4, 6), F.lit
    user = cat(part(3, 5), F.when(F.pmod(h, F.lit(3)) == 0, cat(t("."), part(3, 21))).otherwise(""))
    token = F.lower(cat(F.hex(F.xxhash64(h, F.lit(7))), F.lpad(F.hex(F.xxhash64(h, F.lit(8))), 16, "3")))
    mixed = F.translate(cat(F.hex(F.xxhash64(h, F.lit(9))), token), "ABCdef0123", "xQzRtWm7Kb")
    name, digest = cat(letters(6, 15), F.initcap(letters(7, 16))), cat(token, F.substring(token, 3, 8))
    year = lambda i: cat(pick(("19", "20"), i), digits(2, i))
    bank, country = digits(18, 18), pick(("DE", "ES", "IT", "PT"), 19)
    named = cat(F.upper(letters(4, 20)), digits(14, 18))
    check = lambda more, bban: F.lpad(((97 + more - rest97(cat(bban, country, t("00")))) % 97 + 1).cast("string"), 2, "0")
    iban = lambda more, bban=bank: cat(country, check(more, bban), bban)
    fours = lambda x: F.rtrim(F.regexp_replace(x, "(.{4})", "$1 "))
    spans = [
        ("email", True, cat(user, t(" at "), site, t(" dot "), top)), ("email", True, cat(user, t("(at)"), site, t("."), top)),
        ("email", True, cat(user, t(" [at] "), site, t(" [dot] "), top)), ("email", True, cat(user, t("@"), site, t(" dot "), top)),
        ("email", False, cat(user, t(" at "), site, t(" dot "), letters(8, 10))), ("email", False, cat(user, t(" at "), letters(2, 10), t(" dot "), letters(9, 11))),
        ("ip", True, cat(octet(20), t("[.]"), octet(21), t("[.]"), octet(22), t("[.]"), octet(23))), ("ip", True, cat(octet(20), t("(dot)"), octet(21), t("(dot)"), octet(22), t("(dot)"), octet(23))),
        ("ip", True, cat(octet(20), t(" . "), octet(21), t(" . "), octet(22), t(" . "), octet(23))),
        ("ip", False, cat(octet(20), t("[.]"), (octet(21).cast("int") + 300).cast("string"), t("[.]"), octet(22), t("[.]"), octet(23))),
        ("ip", False, cat(octet(20, 9), t("."), octet(21, 9), t("."), octet(22, 9), t("."), (octet(23).cast("int") + 256).cast("string"))),
        ("card", True, groups(card, ".")), ("card", True, groups(card, " - ")), ("card", True, groups(card, "  ")),
        ("card", False, groups(wrong, ".")), ("card", False, groups(wrong, " - ")), ("card", False, wrong), ("card", False, groups(wrong, "  ")),
        ("phone", True, cat(t("("), area, t(") "), office, t("-"), line)), ("phone", True, cat(area, t("-"), office, t("-"), line)),
        ("phone", True, cat(t("0049 "), area, t(" "), office, line)), ("phone", True, cat(area, t("."), office, t("."), line)),
        ("phone", False, cat(t("20"), digits(2, 12), t("-0"), octet(13, 9), t("-1"), octet(14, 9))), ("phone", False, cat(digits(4, 12), t("-"), digits(4, 13))),
        ("phone", False, cat(digits(2, 12), t(" "), digits(3, 13), t(" "), digits(3, 14))), ("phone", False, cat(digits(2, 12), t("/"), digits(2, 13), t("/"), digits(4, 14))),
        ("phone", False, cat(t("978-"), digits(1, 12), t("-"), digits(2, 13), t("-"), digits(6, 14), t("-"), digits(1, 15)), BOOK_LEADS),
        ("phone", False, cat(digits(1, 12), t("-"), digits(3, 13), t("-"), digits(5, 14), t("-"), digits(1, 15)), BOOK_LEADS),
        ("phone", False, cat(year(12), t("-"), year(13), t("-"), year(14)), YEAR_LEADS), ("phone", False, cat(year(12), t(", "), year(13), t(" "), year(14)), YEAR_LEADS),
        ("phone", False, cat(area, t("-"), office, t("-"), line), COUNT_LEADS), ("phone", False, cat(area, t("."), office, t("."), line), COUNT_LEADS),
        ("phone", False, cat(area, t(" "), office, t(" "), line), COUNT_LEADS),
        ("secret", True, digest), ("secret", True, F.upper(token)), ("secret", True, mixed), ("secret", True, F.substring(mixed, 1, 24)),
        ("secret", True, cat(t("eyJ"), mixed, t("."), token, F.reverse(mixed), t("."), F.reverse(token))),
        ("secret", True, cat(t("eyJ"), F.substring(mixed, 1, 20), t("."), *[cat(mixed, token)] * 5, t("."), F.reverse(token)), ("", *LEADS["secret"])),
        ("secret", False, digest, PLAIN_LEADS), ("secret", False, mixed, PLAIN_LEADS), ("secret", False, digest, DIGEST_LEADS), ("secret", False, token, DIGEST_LEADS),
        ("secret", False, cat(name, F.initcap(letters(5, 17))), NAME_LEADS), ("secret", False, cat(name, F.initcap(part(2, 17)), F.initcap(part(3, 22)), F.initcap(part(2, 23))), NAME_LEADS),
        ("secret", False, cat(part(3, 15), F.initcap(part(8, 16))), NAME_LEADS), ("secret", False, cat(letters(6, 15), t("_"), letters(6, 16), digits(1, 17)), NAME_LEADS),
        ("secret", False, cat(letters(8, 15), t("-"), year(12), t("-"), letters(5, 16)), NAME_LEADS), ("secret", False, digits(16, 15), PLAIN_LEADS),
        ("secret", False, cat(letters(8, 15), t("/"), letters(8, 16), t("_"), digits(3, 17)), (*PLAIN_LEADS, *NAME_LEADS)),
        ("iban", True, iban(0)), ("iban", True, fours(iban(0))), ("iban", True, iban(0, named)), ("iban", True, fours(iban(0, named))), ("iban", False, iban(7, named)), ("iban", False, iban(7)), ("iban", False, fours(iban(7))), ("iban", False, fours(iban(31)), COUNT_LEADS),
    ]
    return [(*x, LEADS[x[0]])[:4] for x in spans]


def planted_rows(docs: DataFrame, forms: int | None = None, parts: int = PARTS) -> DataFrame:
    """_text, _u to _text, _u, _k, _s, _e, _good: planted spans, each in a stretch of a document, at a place that a hash picks. A document gets
    all forms, or as many draws of one as forms says; parts tasks share the work."""
    every = planted(F.col("_h"))
    lead_of = lambda i, leads: F.element_at(F.array(*[F.lit(x) for x in leads]), (F.pmod(F.xxhash64("_h", F.lit(100 + i)), F.lit(len(leads))) + 1).cast("int"))
    span = lead = kind = good = F.lit(None)
    for i, (name, right, value, leads) in enumerate(every):
        it = F.col("_i") == i
        span, lead = F.when(it, value).otherwise(span), F.when(it, lead_of(i, leads)).otherwise(lead)
        kind, good = F.when(it, ALL_KINDS.index(name)).otherwise(kind), F.when(it, F.lit(right)).otherwise(good)
    draws = F.sequence(F.lit(0), F.lit((forms or len(every)) - 1))
    if forms:
        draws = F.array_distinct(F.transform(draws, lambda j: F.pmod(F.xxhash64("_h", j), F.lit(len(every))).cast("int")))
    at = F.pmod(F.col("_h"), F.greatest(F.char_length("_text"), F.lit(1))).cast("int")
    near = docs.select("_text", "_u", F.xxhash64("_text", F.lit(21)).alias("_h")).select(
        "_u", "_h", F.regexp_replace(F.substring("_text", F.greatest(at - 60, F.lit(0)) + 1, F.least(at, F.lit(60))), r"\S*$", "").alias("_pre"),
        F.regexp_replace(F.substring("_text", at + 1, F.lit(60)), r"^\S*", "").alias("_post"),
    ).repartition(parts)
    near = near.select("_u", "_h", "_pre", "_post", F.explode(draws).alias("_i"))
    near = near.select("*", kind.alias("_k"), good.alias("_good"), lead.alias("_lead"), span.alias("_span"))
    tail = F.element_at(F.array(*[F.lit(x) for x in (" ", ". ", ", ", "\n", "")]), (F.pmod(F.xxhash64("_h", F.col("_k")), F.lit(5)) + 1).cast("int"))
    tail = F.when(F.col("_lead").rlike("[\"']$"), F.substring("_lead", -1, 1)).otherwise(tail)
    begin = F.char_length("_pre") + F.char_length("_lead")
    return near.select(
        F.concat("_pre", "_lead", "_span", tail, "_post").alias("_text"), "_u", "_k", begin.alias("_s"), (begin + F.char_length("_span")).alias("_e"), "_good"
    )


@dataclass
class SpanModel:
    """Trees as (feature, threshold, left, right) or a leaf's value, their weights, and a threshold for each kind."""

    trees: list
    weights: list[float]
    thresholds: list[float]


def _read_tree(node):
    """The nodes of a fitted tree, read through the model's own accessors."""
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _read_tree(node.leftChild()), _read_tree(node.rightChild()))


def _tree_column(tree, x: list[Column]) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    f, at, low, high = tree
    return F.when(x[f] <= at, _tree_column(low, x)).otherwise(_tree_column(high, x))


def probability(model: SpanModel, x: list[Column]) -> Column:
    margin = sum((F.lit(w) * _tree_column(t, x) for t, w in zip(model.trees, model.weights, strict=True)), F.lit(0.0))
    return 1 / (1 + F.exp(-2 * margin))


def fit_spans(
    docs: DataFrame, plants: int = 36_000, trees: int = 16, depth: int = 4, precision: float = 0.98, least: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> SpanModel | None:
    """Boosted trees from the candidates of all documents, whole texts, and spans planted in each of them, or None without any.

    Base matches need no trees and are left out. Right are planted forms that no base pattern has, found from end to end; wrong are planted near
    misses, all other candidates around them, and what the documents' own texts offer, but for what may well be right (untold): that teaches nothing.
    Three quarters of the documents (by a hash of the id) grow the trees; the others calibrate: a kind's threshold is the lowest
    multiple of 1 / GRID, 0.5 at least, from which its candidates reach the precision. A kind with under least of them selects nothing.
    Each document gets one draw of the forms at least. In tables of fewer than plants documents it gets as many more as make some plants spans, or each form once where that
    is fewer. Rows that agree in all features are one with a weight. Where trees may split is found from all these rows: with the square root of their number as bins, Spark's trees draw no sample of them.
    """
    n_docs = docs.count()
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(10)), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select(text_or_empty(text_col).alias("_text"), draw.alias("_u"))
    own = rows.select("_u", F.explode(candidates(F.col("_text"))).alias("_c")).filter(~untold(F.col("_c"))).withColumn("_label", F.lit(False))
    forms, parts = max(1, round(plants / max(n_docs, 1))), max(PARTS, n_docs // PLANT_ROWS)
    made = planted_rows(rows, forms if forms < 50 else None, parts).select("_u", "_k", "_s", "_e", "_good", F.explode(candidates(F.col("_text"))).alias("_c"))
    whole = (F.col("_c.k") == F.col("_k")) & (F.col("_c.s") == F.col("_s")) & (F.col("_c.e") == F.col("_e"))
    told = (F.col("_c.s") < F.col("_e")) & (F.col("_s") < F.col("_c.e"))
    each = own.unionByName(made.filter(told).select("_u", "_c", (whole & F.col("_good")).alias("_label"))).filter(~truth(F.col("_c")))
    x = features(F.col("_c"))
    names = [f"f{i}" for i in range(len(x))]
    each = each.select((F.col("_u") >= 0.75).alias("_check"), F.col("_c.k").alias("_k"), F.col("_label").cast("double").alias("label"), *[c.alias(n) for c, n in zip(x, names, strict=True)])
    data = saved(each.groupBy(*each.columns).agg(F.count(F.lit(1)).cast("double").alias("weight")))
    grow = data.filter(~F.col("_check"))
    sizes = {r["label"]: r["count"] for r in grow.groupBy("label").count().collect()}
    if sizes.keys() != {0.0, 1.0}:
        return None
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(grow).select("features", "label", "weight")
    bins = max(48, math.isqrt(sum(sizes.values())) + 1)  # Spark looks at bins ** 2 rows for the places of its splits; a feature has no more bins than values
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=bins, stepSize=0.3, seed=1, weightCol="weight").fit(ready)
    jtrees = list(fitted._call_java("trees"))
    model = SpanModel([_read_tree(t.rootNode()) for t in jtrees], list(fitted.treeWeights), [2.0] * len(ALL_KINDS))
    p = F.floor(probability(model, [F.col(n) for n in names]) * GRID).cast("long")
    held = data.filter("_check").groupBy("_k", p.alias("p")).agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")).collect()  # GRID + 1 cells a kind at most
    for k in range(len(ALL_KINDS)):
        cells = sorted(((r["p"], r["good"], r["n"]) for r in held if r["_k"] == k), reverse=True)
        good = n = 0.0
        for p, g, m in cells:
            good, n = good + g, n + m
            if good >= precision * n and n >= least:
                model.thresholds[k] = max(p / GRID, 0.5)
    return model


def find_pii(docs: DataFrame, model: SpanModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, spans array<struct<k, s, e, base>> by kind and start; k is the place in ALL_KINDS, offsets are code points.

    Base matches always stay. A candidate that reaches its kind's threshold is added if it overlaps no base
    match; of those that overlap each other the likelier stays (ties: the first), as decided from left to right. All is computed in the row, with no shuffle,
    in passes over sorted spans. A null text is empty; whole texts of any length are read; rows that repeat give a row each. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    marked = lambda xs, base: F.transform(xs, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(base).alias("base")))
    if model is None or min(model.thresholds) > 1:
        return rows.select(F.col("_id").alias(id_col), F.array_sort(marked(base_spans(F.col("_text")), True)).alias("spans"))
    found = rows.select("_id", base_spans(F.col("_text")).alias("_base"), candidates(F.col("_text")).alias("_wide"))
    n_features = len(features(F.col("_c")))
    level = lambda c: F.element_at(F.array(*[F.lit(float(t)) for t in model.thresholds]), c["k"] + 1)
    likely = lambda c: let(F.array(*features(c)), lambda x: probability(model, [x[i] for i in range(n_features)]))
    scored = F.transform("_wide", lambda c: F.struct(c["s"].alias("s"), F.lit(1).alias("w"), c["e"].alias("e"), c["k"].alias("k"), likely(c).alias("p")))
    good = F.filter(scored, lambda c: c["p"] >= level(c))
    base = F.transform("_base", lambda b: F.struct(b["s"].alias("s"), F.lit(0).alias("w"), b["e"].alias("e"), b["k"].alias("k"), F.lit(1.0).alias("p")))
    kind = "struct<s:int,w:int,e:int,k:int,p:double>"
    at = found.select("_id", "_base", base.alias("_b"), good.alias("_good"))

    def upto(end: Column, x: Column) -> tuple[Column, Column]:
        """Marks (w = 2) what begins before the end of an earlier base match."""
        met = x.withField("w", F.when((x["w"] == 1) & (end > x["s"]), 2).otherwise(x["w"]))
        return F.when(x["w"] == 0, F.greatest(end, x["e"])).otherwise(end), met

    def after(begin: Column, x: Column) -> tuple[Column, Column]:
        """From the right: marks what ends after the start of a later base match."""
        met = x.withField("w", F.when((x["w"] == 1) & (begin < x["e"]), 2).otherwise(x["w"]))
        return F.when(x["w"] == 0, x["s"]).otherwise(begin), met

    def chosen(now: Column, x: Column) -> tuple[Column, Column]:
        """The likelier of spans that overlap; now is the last one, given out once a span begins after it."""
        apart = x["s"] >= now["e"]
        return F.when(apart | (x["p"] > now["p"]), x).otherwise(now), F.when(apart, now).otherwise(now.withField("w", F.lit(2)))

    first = scan(F.array_sort(F.concat("_b", "_good")), F.lit(-1), upto, kind)
    free = F.filter(scan(F.reverse(first), F.lit(2**31 - 1), after, kind), lambda x: x["w"] == 1)
    none, end = (F.expr(f"named_struct('s', {s}, 'w', 2, 'e', {s}, 'k', -1, 'p', -1.0D)") for s in (-1, 2**31 - 1))
    best = F.filter(scan(F.array_append(F.reverse(free), end), none, chosen, kind), lambda x: x["w"] == 1)
    added = F.when(F.size("_good") > 0, marked(best, False)).otherwise(F.expr("cast(array() as array<struct<k:int,s:int,e:int,base:boolean>>)"))
    return at.select(F.col("_id").alias(id_col), F.array_sort(F.concat(marked(F.col("_base"), True), added)).alias("spans"))


def span_list(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kind, x["k"] + 1), x["s"], x["e"])), ",")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = find_pii(docs, fit_spans(docs))
    base = F.filter("spans", lambda x: x["base"])
    of = lambda k: F.size(F.filter(base, lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return got.select("doc_id", *[of(k) for k in range(len(KINDS))], F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
