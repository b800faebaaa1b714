"""Text functions as Column builders: normal form, spoken callsigns, token distance."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spoken digits and the radiotelephony alphabet.
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
LETTERS = (
    "alfa", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliett", "kilo", "lima", "mike", "november",
    "oscar", "papa", "quebec", "romeo", "sierra", "tango", "uniform", "victor", "whiskey", "xray", "yankee", "zulu",
)
SPOKEN = {**{str(i): w for i, w in enumerate(DIGITS)}, **{chr(65 + i): w for i, w in enumerate(LETTERS)}}
#: Names by which some airlines are called. Callers pass their own table for more.
AIRLINES = {"AAL": "american", "DAL": "delta", "JBU": "jetblue", "SWA": "southwest", "UAL": "united"}


def normalize(text: Column) -> Column:
    """Lower case, digits spoken one by one, no punctuation, single spaces. Spoken text comes back as it is; null stays null."""
    spoken = reduce(lambda c, d: F.replace(c, F.lit(str(d)), F.lit(f" {DIGITS[d]} ")), range(10), F.lower(text))
    return F.trim(F.regexp_replace(F.regexp_replace(spoken, r"'", ""), r"[^\p{L}\p{M}]+", " "))


def tokens(text: Column) -> Column:
    """Words by white space; no words for blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def _spell(code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SPOKEN.items() for x in pair])
    return F.array_join(F.transform(F.filter(F.split(code, ""), lambda c: c != ""), lambda c: F.element_at(table, c)), " ")


def expand_callsign(tail: Column, airlines: dict[str, str] | None = None) -> Column:
    """N172SP: november one seven two sierra papa. DAL12: delta one two. Null for what has other signs than letters and digits."""
    code = F.upper(tail)
    names = F.create_map(*[F.lit(x) for pair in (AIRLINES if airlines is None else airlines).items() for x in pair])
    prefix = F.regexp_extract(code, "^([A-Z]{3})[0-9]", 1)
    name = F.try_element_at(names, prefix)
    named = F.concat_ws(" ", name, _spell(F.substring(code, 4, 100)))
    return F.when(code.rlike("^[A-Z0-9]+$"), F.when((prefix != "") & name.isNotNull(), named).otherwise(_spell(code)))


def spoken_realizations(tail: Column, airlines: dict[str, str] | None = None) -> Column:
    """The whole callsign as spoken, then what begins with its first digit; normal forms, without blanks."""
    suffix = F.regexp_extract(tail, r"(\d.*)$", 1)
    both = F.array(normalize(expand_callsign(tail, airlines)), normalize(expand_callsign(F.nullif(suffix, F.lit("")), airlines)))
    return F.array_distinct(F.filter(both, lambda x: F.coalesce(x, F.lit("")) != ""))


def canonical_callsigns(tails: Column, airlines: dict[str, str] | None = None) -> Column:
    """Spoken forms of an array of tails, in order, once each; blanks dropped."""
    spoken = F.transform(present_tails(tails), lambda t: normalize(F.coalesce(expand_callsign(t, airlines), F.lit(""))))
    return F.array_distinct(F.filter(spoken, lambda s: s != ""))


def present_tails(tails: Column) -> Column:
    """The tails that are neither null nor empty; none for a null array."""
    return F.filter(F.coalesce(tails, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once a row, however often use names it."""
    return F.transform(F.array(value), use)[0]


def token_distance(a: Column, b: Column) -> Column:
    """Edit distance between two arrays of words, by the built-in distance of strings with a character for each distinct word."""

    def measure(x: Column) -> Column:
        def sign(word: Column) -> Column:
            code = F.lpad(F.hex(F.array_position(x["all"], word) + 19967), 4, "0")
            return F.decode(F.unhex(code), "UTF-16BE")

        return F.levenshtein(F.array_join(F.transform(x["a"], sign), ""), F.array_join(F.transform(x["b"], sign), ""))

    both = F.array_distinct(F.concat(a, b))
    return bound(F.struct(a.alias("a"), b.alias("b"), both.alias("all")), measure)


def similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length over the words of the normal forms; 1 for two blank texts. Null counts as blank."""

    def measure(x: Column) -> Column:
        longest = F.greatest(F.size(x["a"]), F.size(x["b"]))
        return F.when(longest == 0, F.lit(1.0)).otherwise(1 - token_distance(x["a"], x["b"]) / longest)

    return bound(F.struct(tokens(normalize(a)).alias("a"), tokens(normalize(b)).alias("b")), measure)


def shard_stem(index: Column) -> Column:
    return F.format_string("shard-%05d", index)


def shard_index(name: Column) -> Column:
    return F.regexp_extract(name, r"shard-(\d+)", 1).try_cast("int")
