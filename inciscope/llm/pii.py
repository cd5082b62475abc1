"""Personal data in text, with built-in functions only.

Regular expressions propose spans, checksums (Luhn, mod 97) and number ranges confirm them, and words in the gaps beside
a span raise its score. One pass over each row: no shuffle, no Python.

Patterns are written so that Java's matcher neither rescans a run from each of its characters nor recurses: a run is
entered at its start only (or where the last match ended) and taken possessively. They match the same spans as the plain
forms named beside them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import keyed_text

#: Characters of the gap before and after a span that are searched for context words.
BEFORE, AFTER = 40, 20
#: Prefix sums over the spans of a text go by blocks of this many.
BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's checksum."""

    def weigh(chars: Column) -> Column:
        n = F.size(chars)

        def one(c: Column, i: Column) -> Column:
            d = c.cast("long")
            doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return F.when((n - i) % 2 == 0, doubled).otherwise(d)

        return total(F.transform(chars, one)) % 10 == 0

    return let(F.filter(F.split(number, ""), lambda c: c != ""), weigh)


def mod97(account: Column) -> Column:
    """Whether an account number passes the mod 97 check: its head goes to the end, letters count from 10."""
    turned = F.concat(F.substr(account, F.lit(5)), F.left(account, F.lit(4)))
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    def step(rest: Column, c: Column) -> Column:
        place = F.position(c, letters)
        return F.when(place > 0, (rest * 100 + place + 9) % 97).otherwise((rest * 10 + F.coalesce(c.cast("long"), F.lit(0))) % 97)

    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0).cast("long"), step) == 1


@dataclass(frozen=True)
class Kind:
    """``gate``: a text without it has no span."""

    name: str
    gate: str
    pattern: str
    valid: Callable[[Column], Column]
    base_score: float
    context: str
    least_score: float = 0.0


def _digit_count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda v: F.length(digits(v)).between(low, high)


#: Base kinds, in the order in which spans are listed. Plain forms:
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#: ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#: card [0-9]([ -]?[0-9])+ of 13 to 19 digits: such a span is a whole run, so shorter and longer runs are not proposed
#: phone \+[0-9][ ().0-9-]+[0-9]
BASE_KINDS = (
    Kind(
        "email", "@",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda v: F.lit(True), 0.8, "mail|contact|kontakt|correo|write to",
    ),
    Kind(
        "ip", ".",
        r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}+",
        lambda v: v.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|$)){4}$"),
        0.6, r"\bip\b|address|host|server|client|login",
    ),
    Kind(
        "card", "",
        r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){12,18}+(?![ -]?+[0-9])",
        lambda v: luhn(digits(v)), 0.7, "card|visa|master|amex|credit|karte|carte|tarjeta|payment",
    ),
    Kind(
        "phone", "+",
        r"\+[0-9][ ().0-9-]+[0-9]",
        _digit_count(9, 15), 0.5, r"phone|call|\btel\b|mobile|fax|telefon|t\u00e9l",
    ),
)
#: What the checksums and context words add to them.
ADDED_KINDS = (
    Kind(
        "iban", "",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        lambda v: mod97(F.translate(v, " ", "")), 0.9, "iban|account|konto|compte|cuenta|bank",
    ),
    Kind(
        "ssn", "-",
        r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda v: ~v.rlike("^(?:000|666|9[0-9]{2})|-00-|-0000$"),
        0.3, r"\bssn\b|social security", 0.5,
    ),
)
CONTEXT_BONUS = 0.2
SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def spans_of(text: Column, kind: Kind) -> Column:
    """Spans of one kind: leftmost, not overlapping, the invalid dropped. ``end`` is exclusive, places are code points.

    Splitting the text by the pattern gives the gaps between the matches; the lengths of gaps and matches add up to
    their places.
    """
    pattern = F.lit(kind.pattern)
    none = F.lit(None).cast(SPAN)

    def places(found: Column) -> Column:
        return let(F.split(text, kind.pattern, -1), lambda gaps: placed(found, gaps))

    def placed(found: Column, gaps: Column) -> Column:
        index = F.sequence(F.lit(0), F.size(found) - 1)

        def step(i: Column) -> Column:
            before = F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0)
            return (F.length(F.get(gaps, i)) + before).cast("long")

        def offsets(steps: Column) -> Column:
            block_index = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int"))
            sums = F.transform(block_index, lambda b: total(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
            return let(sums, lambda known: F.transform(index, lambda i: one(steps, known, i)))

        def one(steps: Column, known: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            start = total(F.slice(known, F.lit(1), block)) + total(
                F.slice(steps, block * BLOCK + 1, F.pmod(i, F.lit(BLOCK)) + 1)
            )
            value = F.get(found, i)
            beside = F.concat(F.right(F.get(gaps, i), F.lit(BEFORE)), F.lit(" "), F.left(F.get(gaps, i + 1), F.lit(AFTER)))
            bonus = F.when(F.lower(beside).rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
            return F.struct(
                F.lit(kind.name).alias("kind"), start.cast("int").alias("start"),
                (start + F.length(value)).cast("int").alias("end"), value.alias("value"),
                F.least(F.lit(1.0), F.round(F.lit(kind.base_score) + bonus, 2)).alias("score"),
            )

        return let(F.transform(index, step), offsets)

    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind.gate:
        matches = F.when(F.contains(text, F.lit(kind.gate)), matches).otherwise(F.array().cast("array<string>"))
    spans = let(matches, lambda found: F.when(F.size(found) > 0, places(found)).otherwise(none))
    kept = F.filter(spans, lambda s: kind.valid(s["value"]) & (s["score"] >= kind.least_score))
    return F.coalesce(kept, F.array().cast(SPAN))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): all spans of each row with value and score, by kind and then place.

    A null or empty text has none; repeated rows and rows without doc_id are judged one by one; an empty table gives an
    empty result; other columns are not read.
    """
    text = F.col("text")
    found = [spans_of(text, k).alias(f"found_{k.name}") for k in (*BASE_KINDS, *ADDED_KINDS)]
    each = keyed_text(docs, id_col, text_col).select("doc_id", *found)
    return each.select("doc_id", F.concat(*(f"found_{k.name}" for k in (*BASE_KINDS, *ADDED_KINDS))).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their places, and the places of all spans."""
    names = [k.name for k in BASE_KINDS]
    spans = F.col("spans")

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter(spans, lambda s: s["kind"].isin(names))
    scores = F.transform(spans, lambda s: s["score"])
    return found.select(
        "doc_id", *map(count, names), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"),
        F.array_join(scores.cast("array<string>"), ",").alias("scores"),
    )
