"""Personal data in texts, in DataFrame operations only.

A regular expression proposes spans, a validator confirms them, and words
nearby adjust the score. Every row is handled on its own, so nothing is
shuffled. Positions come from the stretches between matches: the text is split
at the same expression that extracts them. The expressions never retry inside
a run of characters that they have refused, and repeat groups possessively, so
they take linear time and no stack on very long texts. The running sums behind
the positions take a pass over the matches for each doubling of their number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Powers of two up to the most matches of a text.
_STEPS = [1 << i for i in range(31)]
BEFORE, AFTER = 48, 24
NEARBY = 0.1


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits is right."""
    doubled = F.transform(_characters(F.reverse(digits)), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number in capitals and digits has the right check digits."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    return F.aggregate(
        _characters(turned), F.lit(0),
        lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + F.ascii(c) - 48) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97),
    ) == 1


def _four_bytes(value: Column) -> Column:
    small = "^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    return F.forall(F.split(value, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike(small))


def _length_within(value: Column, least: int, most: int) -> Column:
    return F.length(_digits(value)).between(least, most)


def _alone(span: Column) -> Column:
    return ~span["before"].rlike("[A-Za-z0-9]$") & ~span["after"].rlike("^[A-Za-z0-9]")


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap condition on the text without which there is no match."""

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    context: str
    least: float = 0.0


# The first four are the base kinds, in the order in which spans are listed.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: t.contains("@"), lambda s: F.lit(True), 0.9, "mail|contact|write to|kontakt|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
         lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), lambda s: _four_bytes(s["value"]), 0.6,
         "ip|address|host|server|login|adresse"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){15}"),
         lambda s: F.when(_length_within(s["value"], 16, 19), luhn(_digits(s["value"]))).otherwise(False), 0.8,
         "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda t: t.contains("+"),
         lambda s: _length_within(s["value"], 8, 15), 0.7, "phone|tel|call|mobile|fax|anruf|llamar|appel"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
         lambda t: t.rlike("[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11}| [A-Z0-9]{4} )"),
         lambda s: _alone(s) & mod_97(F.regexp_replace(s["value"], " ", "")), 0.8, "iban|account|bank|konto|cuenta|compte"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
         lambda s: _alone(s) & ~s["value"].rlike("^(?:000|666|9)|-00-|-0000$"), 0.4, "ssn|social security|taxpayer", 0.5),
)
BASE = tuple(k.name for k in KINDS[:4])


def _spans(text: Column, kind: Kind) -> tuple[Column, Column]:
    """Matches of the text, and the stretches around them."""
    nothing = F.array().cast("array<string>")
    hint = kind.hint(text)
    return (F.when(hint, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(nothing),
            F.when(hint, F.split(text, kind.pattern, -1)).otherwise(nothing))


def _ends(matches: Column, gaps: Column) -> Column:
    """Where each match ends: running sums of the lengths of stretches and matches.

    After the step of width w every entry is the sum of the 2 w lengths up to it, so no array grows entry by entry.
    """
    lengths = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
    steps = F.filter(F.array(*map(F.lit, _STEPS)), lambda w: w < F.size(matches))
    return F.aggregate(steps, lengths, lambda sums, w: F.transform(
        sums, lambda x, i: F.when(i >= w, x + F.get(sums, i - w)).otherwise(x)))


def _placed(matches: Column, gaps: Column, ends: Column) -> Column:
    return F.transform(matches, lambda m, i: F.struct(
        (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value"),
        F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("after")))


def _judged(spans: Column, kind: Kind) -> Column:
    def score(s: Column) -> Column:
        near = F.lower(F.concat(s["before"], F.lit(" "), s["after"]))
        return F.lit(kind.score) + F.when(near.rlike(rf"(?:^|[^a-z])(?:{kind.context})"), F.lit(NEARBY)).otherwise(F.lit(0.0))

    kept = F.transform(F.filter(spans, kind.valid), lambda s: F.struct(
        F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        score(s).alias("score")))
    return F.filter(kept, lambda s: s["score"] >= kind.least) if kind.least else kept


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``found``: an array of ``kind, start, end, value, score``, by kind and then by start.

    One row per row of ``docs``, repeated rows and null keys included. Positions
    are code points, the end is exclusive; a null or empty text has no spans.
    Spans of one kind do not overlap, spans of different kinds may. Kinds
    without a checksum count only with a score of ``least``. Other columns are
    ignored.
    """
    rows = docs.select(F.col(key).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    for kind in KINDS:
        matches, gaps = _spans(F.col("body"), kind)
        rows = rows.withColumn(f"m_{kind.name}", matches).withColumn(f"g_{kind.name}", gaps)
    rows = rows.drop("body")
    rows = rows.withColumns({f"e_{k.name}": _ends(F.col(f"m_{k.name}"), F.col(f"g_{k.name}")) for k in KINDS})
    rows = rows.select("row", *[
        _placed(*(F.col(f"{part}_{k.name}") for part in "mge")).alias(f"s_{k.name}") for k in KINDS])
    return rows.select(F.col("row").alias(key), F.concat(*[_judged(F.col(f"s_{k.name}"), k) for k in KINDS]).alias("found"))


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
