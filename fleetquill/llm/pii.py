"""Personal data in texts, found with built-in functions only.

Regular expressions propose spans; checksums (Luhn for cards, modulo 97 for account numbers)
or number ranges confirm them; words nearby raise a span's score. Kinds in ``BASE`` are kept
once confirmed, others need a score of ``KEEP``: an account number has it by its checksum, a
social security number only next to a word that names it.

The patterns are written for linear time: a run of characters is tried once, from its first
character, and never given back (possessive quantifiers, look-behinds).

Defined results: a null or empty text has no spans; a null text stays null when redacted;
repeated rows are treated each; spans of different kinds may overlap, redaction masks their
union once; an empty table gives an empty table; other columns are kept, but for a column
named like the result's, which it replaces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import shared

KEEP = 0.7
NEAR = 32
CHUNK = 1024
FOLD = 256
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Luhn's checksum: from the right, every second digit is doubled, less 9 above 9."""
    number = F.reverse(digits(match))

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(number, place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(1), F.length(number))
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(match: Column) -> Column:
    """Account number check: the first four characters moved to the end, letters read as 10
    to 35, the whole number leaves 1."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substr(moved, place, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


#: Characters of an account number by country.
LENGTHS = {
    code: n
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
        26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for code in codes.split()
}


def account(rest: Column) -> Column:
    """The account number that the text starts with: of the stretches of whole groups that
    modulo 97 confirms, the one of its country's length, else the longest."""
    near = F.substr(rest, F.lit(1), F.lit(68))  # 34 characters, 33 spaces, and what follows
    run = F.regexp_extract(near, r"^[A-Z]{2}[0-9]{2}[A-Z0-9]*+(?![a-z])(?: [A-Z0-9]++(?![a-z]))*+", 0)
    lengths = F.create_map(*[F.lit(x) for pair in LENGTHS.items() for x in pair])

    def stretches(groups: Column) -> Column:
        prefixes = F.transform(
            F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), " ")
        )
        return F.filter(prefixes, lambda s: F.length(F.replace(s, F.lit(" "))).between(15, 34) & mod97(s))

    def best(valid: Column) -> Column:
        own = F.filter(
            valid, lambda s: F.length(F.replace(s, F.lit(" "))) == F.try_element_at(lengths, F.substr(s, F.lit(1), F.lit(2)))
        )
        return F.coalesce(F.get(own, F.lit(0)), F.try_element_at(valid, F.lit(-1)))

    return bound(bound(F.split(run, " "), stretches), best)


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of the value, which is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def small_parts(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


@dataclass(frozen=True)
class Kind:
    name: str
    hint: Callable[[Column], Column]  # cheap; false where no span can be
    pattern: str
    confirm: Callable[[Column], Column] | None
    checked: bool  # confirmed by a checksum
    words: str  # that name it, nearby
    whole: Callable[[Column], Column] | None = None  # the match, from the text at its start; null if none


KINDS = [
    Kind(
        "email",
        lambda text: text.contains("@"),
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        None,
        False,
        "mail|e-mail|email|contact",
    ),
    Kind(
        "ip",
        lambda text: text.rlike(r"[0-9]\.[0-9]"),
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        small_parts,
        False,
        "ip|host|server|address",
    ),
    Kind(
        "card",
        lambda text: text.rlike(r"[0-9][ -]?[0-9][ -]?[0-9]"),
        # whole chains of digits, of the lengths that a card can have
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
        luhn,
        True,
        "card|visa|credit|mastercard|payment",
    ),
    Kind(
        "phone",
        lambda text: text.contains("+"),
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda match: F.length(digits(match)).between(9, 15),
        False,
        "phone|tel|call|mobile|fax",
    ),
    Kind(
        "iban",
        lambda text: text.rlike("[A-Z][A-Z][0-9][0-9]"),
        r"(?<![A-Za-z0-9])[A-Z]{2}(?=[0-9]{2}(?: ?[A-Z0-9]){11})",  # where one can start
        None,
        True,
        "iban|account|bank|konto",
        account,
    ),
    Kind(
        "ssn",
        lambda text: text.rlike("[0-9]-[0-9]"),
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        None,
        False,
        "ssn|social security",
    ),
]
BASE = [kind.name for kind in KINDS[:4]]


def chunks(text: Column) -> Column:
    """The text cut into stretches of ``CHUNK`` characters, for looking at places in it
    without counting from its start each time."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))


def window(pieces: Column, start: Column, length: Column) -> Column:
    """At most CHUNK characters from a place on."""
    k = F.floor(start / CHUNK).cast("int")
    both = F.concat(F.coalesce(F.get(pieces, k), F.lit("")), F.coalesce(F.get(pieces, k + 1), F.lit("")))
    return F.substr(both, start % CHUNK + 1, length)


def stretch(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from start to end, however many."""
    k = F.floor(start / CHUNK).cast("int")
    whole = F.array_join(F.slice(pieces, k + 1, F.floor(end / CHUNK).cast("int") - k + 1), "")
    return F.substr(whole, start % CHUNK + 1, end - start)


def folded(items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """Fold a list from its start and keep what each step gives: (state, item) -> struct of
    the next ``state`` and an ``out`` of the given type, null for nothing.

    A list that grows is copied at every step, so it is folded in blocks of ``FOLD`` items
    and only the blocks' results are lined up: time in proportion to the items.
    """
    none = F.array().cast(f"array<{kind}>")
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(FOLD))
    blocks = F.transform(starts, lambda k: F.slice(items, k + 1, FOLD))

    def one(held: Column, item: Column) -> Column:
        def keep(new: Column) -> Column:
            out = F.when(new["out"].isNull(), held["out"]).otherwise(F.concat(held["out"], F.array(new["out"])))
            return F.struct(new["state"].alias("state"), out.alias("out"))

        return bound(step(held["state"], item), keep)

    def block(held: Column, own: Column) -> Column:
        def keep(new: Column) -> Column:
            return F.struct(new["state"].alias("state"), F.concat(held["out"], F.array(new["out"])).alias("out"))

        return bound(F.aggregate(own, F.struct(held["state"].alias("state"), none.alias("out")), one), keep)

    begin = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.flatten(F.aggregate(blocks, begin, block, lambda held: held["out"]))


MATCH = "struct<start:int,end:int,match:string>"


def places(text: Column, kind: Kind) -> Column:
    """All matches with their places: what lies between them gives the distances."""
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pairs = F.zip_with(gaps, matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))

    def place(at: Column, pair: Column) -> Column:
        start = at + pair["gap"]
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("state"), span.alias("out"))

    found = bound(F.filter(pairs, lambda pair: pair["match"].isNotNull()), lambda own: folded(own, F.lit(0), place, MATCH))
    return F.when(kind.hint(text), extended(text, found, kind.whole) if kind.whole else found)


def extended(text: Column, starts: Column, whole: Callable[[Column], Column]) -> Column:
    """Whole matches in place of their starts; what starts inside an earlier match is left out."""

    def extend(start: Column, pieces: Column) -> Column:
        return bound(
            whole(window(pieces, start["start"], F.lit(68))),
            lambda match: F.struct(
                start["start"].alias("start"), (start["start"] + F.length(match)).alias("end"), match.alias("match")
            ),
        )

    def apart(end: Column, span: Column) -> Column:
        free = span["start"] >= end
        return F.struct(
            F.when(free, span["end"]).otherwise(end).alias("state"), F.when(free, span).alias("out")
        )

    every = bound(chunks(text), lambda pieces: F.transform(starts, lambda start: extend(start, pieces)))
    matches = F.filter(every, lambda span: span["match"].isNotNull())
    return bound(matches, lambda own: folded(own, F.lit(0), apart, MATCH))


def scored(pieces: Column, kind: Kind, rank: int, spans: Column) -> Column:
    """Confirmed spans of one kind, scored by checksum and words nearby."""
    start = F.greatest(F.lit(0), spans["start"] - NEAR)
    before = window(pieces, start, spans["start"] - start)
    around = F.concat(before, spans["match"], window(pieces, spans["end"], F.lit(NEAR + 1)))
    named = F.coalesce(around.rlike(rf"(?i)(?<![\p{{L}}])(?:{kind.words})(?![\p{{L}}])"), F.lit(False))
    score = F.lit(0.8 if kind.checked else 0.5) + F.when(named, 0.2).otherwise(0.0)
    return F.struct(
        spans["start"].alias("start"),
        F.lit(rank).alias("rank"),
        spans["end"].alias("end"),
        F.lit(kind.name).alias("kind"),
        score.alias("score"),
    )


def confirmed(pieces: Column, found: Column, kind: Kind, rank: int) -> Column:
    """The spans of one kind that stay."""
    spans = F.coalesce(found, F.array().cast(f"array<{MATCH}>"))
    if kind.confirm:
        spans = F.filter(spans, lambda s: kind.confirm(s["match"]))
    spans = F.transform(spans, lambda s: scored(pieces, kind, rank, s))
    return spans if kind.name in BASE else F.filter(spans, lambda s: s["score"] >= KEEP)


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns and ``pii``: spans in order of start, then kind; code points, end exclusive."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    at = {kind.name: shared.fresh(f"at_{kind.name}", docs) for kind in KINDS}
    located = docs.withColumns({at[kind.name]: places(text, kind) for kind in KINDS})
    some = F.greatest(*[F.coalesce(F.size(F.col(name)), F.lit(0)) for name in at.values()]) > 0

    def spans(pieces: Column) -> Column:
        parts = [confirmed(pieces, F.col(at[kind.name]), kind, rank) for rank, kind in enumerate(KINDS)]
        return F.array_sort(F.concat(*parts)).cast(SPAN)

    # a lambda's variable, unlike a column, is never put in as the expression it stands for
    every = F.when(some, bound(chunks(text), spans)).otherwise(F.array().cast(SPAN))
    return located.withColumn("pii", every).select(*[c for c in docs.columns if c != "pii"], "pii")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def redact(found: DataFrame, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """The text with the union of its spans masked, each stretch by the name of its first
    span; the spans' column goes."""
    text, spans = F.col(text_col).cast("string"), F.col(spans_col)

    def mask(pieces: Column, at: Column, span: Column) -> Column:
        """``at`` is the end of what is masked so far, -1 before anything is."""
        label = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        kept = stretch(pieces, F.greatest(at, F.lit(0)), span["start"])
        new = F.when(span["start"] > at, F.concat(kept, label))
        return F.struct(F.greatest(at, span["end"]).alias("state"), new.alias("out"))

    def masked(pieces: Column) -> Column:
        own = folded(spans, F.lit(-1), lambda at, span: mask(pieces, at, span), "string")
        return F.array_join(own, "")

    last = F.array_max(F.transform(spans, lambda span: span["end"]))
    # a lambda's variable, unlike a column, is never put in as the expression it stands for
    clean = F.concat(bound(chunks(text), masked), F.substr(text, last + 1))
    return found.withColumn(text_col, F.when(F.size(spans) > 0, clean).otherwise(text)).drop(spans_col)
