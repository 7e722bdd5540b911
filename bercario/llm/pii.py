"""Personal data: regular expressions propose, checksums confirm, context words weigh.

Five kinds of span. Each expression is searched from left to right without overlap, and a match
that its validator refuses is dropped and not tried again in another way (but see iban):

* email, phone: the shape and, for phones, 10 to 15 digits
* ip: four numbers of at most 255
* card: 14 to 19 digits that pass Luhn
* iban: two capitals, two digits and more characters, 15 to 34 in all, which pass mod 97; not
  inside a longer run of letters and digits. It ends at the length of its country, whatever
  follows after a blank; without a known length, at the end of the run. Every place where one may
  start is tried, so a refused match hides none behind it

A span's score is the prior of its kind, raised if one of the kind's context words stands in the
40 characters before it, of which no more is looked at than back to the second match of the kind
before. Scores do not decide which spans are reported.

Offsets count code points; the end is exclusive. All expressions take time in proportion to the
text, however many spans it has: they give nothing back, start a long run only at its beginning,
and places are running sums of the lengths of matches and of what lies between, see ``folding``.

Defined results: a null or empty text has no spans. Every row gives one row, ids repeated, null or
not. Columns besides id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bercario.llm.folding import bound, folded, indices, running_sums

# Characters of an account number by country, of the registry of ISO 13616 and of
# countries that use the format without being in it.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE BI",
    18: "DK FK FI FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BF BJ CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM SN TD TG",
    28: "AL AZ BY CI CY DO GT HN HU LB MA ML NE NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _iban() -> str:
    """The first letter of each account number that may start here; group 1 is all of it."""
    known = "|".join(
        f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}"
        for length, names in IBAN_LENGTHS.items()
    )
    whole = rf"(?:{known})(?![A-Za-z0-9])"
    # A run of an unknown length does not reach into a number of a known one.
    run = rf"[A-Z]{{2}}[0-9]{{2}}(?:(?! {whole}) ?[A-Z0-9]){{11,30}}+(?![A-Za-z0-9])"
    return rf"(?<![A-Za-z0-9])(?=({whole}|{run}))[A-Z]"


# Kind: expression, cheap test that every match passes, prior, context words. Order matters.
# The look-behind or \G (the end of the match before) allows a start only where a run begins;
# a start further inside could only find the same end.
KINDS = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda text: F.contains(text, F.lit("@")),
        0.8,
        ("mail", "contact", "write", "reach"),
    ),
    "ip": (
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda text: text.rlike(r"[0-9]\.[0-9]"),
        0.5,
        ("ip", "host", "server", "address", "login"),
    ),
    "card": (
        r"[0-9](?:[ -]?[0-9])++",
        lambda text: text.rlike(r"[0-9](?:[ -]?[0-9]){13}"),
        0.6,
        ("card", "visa", "credit", "payment", "account"),
    ),
    "phone": (
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda text: F.contains(text, F.lit("+")),
        0.5,
        ("phone", "call", "tel", "mobile", "fax"),
    ),
    "iban": (
        _iban(),
        lambda text: text.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]"),
        0.6,
        ("iban", "bank", "account", "transfer"),
    ),
}
BASE = ("email", "ip", "card", "phone")
CONTEXT_CHARS = 40


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """True if the digits of the text pass the Luhn checksum."""
    digits = F.reverse(_digits(text))

    def weight(place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(place % 2 == 1, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(text: Column) -> Column:
    """True if an account number passes mod 97: first four characters last, A = 10, ..."""
    bare = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
    characters = F.transform(
        F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substring(turned, i, F.lit(1)))
    )

    def add(rest: Column, code: Column) -> Column:
        digit = (rest * 10 + code - 48) % 97
        return F.when(code < 58, digit).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(characters, F.lit(0), add) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return F.length(_digits(match)).between(14, 19) & luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return mod97(match) if kind == "iban" else F.lit(True)


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


_PLACES = "array<struct<start:int,end:int,near:boolean>>"


def spans_of(kind: str, text: Column) -> Column:
    """The confirmed spans of one kind, in order."""
    expression, may_match, prior, words = KINDS[kind]
    rank = list(KINDS).index(kind)
    # Of an account number only the first letter is consumed, so its matches may overlap.
    consumed = (lambda match: F.left(match, F.lit(1))) if kind == "iban" else (lambda match: match)
    context_words = r"\b(?:" + "|".join(words) + ")"

    def located(found: Column) -> Column:
        # The text is: between[0] match[0] between[1] match[1] ... between[n].
        between, matches = found["between"], found["matches"]

        def advance(i: Column) -> Column:
            before = F.coalesce(F.length(consumed(F.get(matches, i - 1))), F.lit(0))
            return F.length(F.get(between, i)) + before

        def place(i: Column, starts: Column) -> Column:
            match, start = F.get(matches, i), F.get(starts, i)
            last = F.lit(CONTEXT_CHARS)
            pieces = [F.get(between, i - 1), consumed(F.get(matches, i - 1)), F.get(between, i)]
            context = F.concat(*[F.coalesce(F.right(piece, last), F.lit("")) for piece in pieces])
            return F.struct(
                start.alias("start"),
                (start + F.length(match)).alias("end"),
                F.lower(F.right(context, last)).rlike(context_words).alias("near"),
                _valid(kind, match).alias("valid"),
            )

        def placed(starts: Column) -> Column:
            return F.filter(F.transform(indices(matches), lambda i: place(i, starts)), lambda s: s["valid"])

        return bound(running_sums(F.transform(indices(matches), advance)), placed)

    def scored(span: Column) -> Column:
        score = F.when(span["near"], round((prior + 1) / 2, 3)).otherwise(prior)
        return F.struct(
            span["start"].alias("start"),
            F.lit(rank).alias("rank"),
            span["end"].alias("end"),
            F.lit(kind).alias("kind"),
            score.cast("double").alias("score"),
        )

    def first_of_overlapping(end: Column, span: Column) -> tuple[Column, Column]:
        stays = span["start"] >= end
        kept = F.struct(*[span[name].alias(name) for name in ("start", "end", "near")])
        nothing = F.array().cast(_PLACES)
        return F.when(stays, F.array(kept)).otherwise(nothing), F.when(stays, span["end"]).otherwise(end)

    found = F.struct(
        F.split(text, expression, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(expression), F.lit(int(kind == "iban"))).alias("matches"),
    )
    spans = bound(found, located)
    if kind == "iban":
        spans = folded(spans, F.lit(0), _PLACES, first_of_overlapping)
    return F.coalesce(F.when(may_match(text), F.transform(spans, scored)), F.array()).cast(_SPANS)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id, and pii_spans by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("body"))
    spans = [spans_of(kind, F.col("body")) for kind in KINDS]
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("pii_spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and texts of ``personal_data``, a row per row."""

    def written(spans: Column) -> Column:
        line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(spans, line), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    spans = F.col("pii_spans")
    counts = [count(kind).alias(f"n_{kind}") for kind in KINDS]
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(base), 256).alias("base_sha256"),
        written(spans).alias("spans"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
