"""Personal data in texts, on DataFrame functions alone.

Regular expressions propose spans, validators (Luhn, mod-97, ranges, digit counts) confirm them,
and words nearby move the score. Places come from splitting a text by the same expression
that extracts its matches: the lengths of gaps and matches add up to positions. Words nearby are looked up in
short pieces of the text, so the work for a span does not grow with the text, but for the square root of the
number of spans that texts of places take to grow.

The expressions are written so that a run of letters or digits is tried once, from its
start or from where the last match ended; they find what the plain form finds, in linear time.

Defined results: NULL text reads as empty and has no spans; kinds may overlap; repeated rows are
answered each; other columns pass or are ignored as the function says.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexlake.llm.stage import unused

CONTEXT_CHARS = 40
PIECE_BITS = 8  # a text is looked up in pieces of 256 characters


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digit sums added: divisible by ten."""
    at = F.sequence(F.lit(1), F.length(digits))
    backwards = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.ascii(F.substring(backwards, i, F.lit(1))) - 48
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(at, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """The first four characters moved behind, letters as numbers from 10: one modulo 97."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    name: str
    marker: str  # an expression without which no match can be; cheap to search
    pattern: str
    score: float
    context: str = ""  # words nearby that raise the score
    against: str = ""  # words nearby that lower it

    def valid(self, match: Column) -> Column:
        if self.name == "ip":
            part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
            return match.rlike(rf"^{part}(\.{part}){{3}}$")
        if self.name == "card":
            digits = _digits(match)
            return F.length(digits).between(12, 19) & luhn(digits)
        if self.name == "phone":
            return F.length(_digits(match)).between(9, 15)
        if self.name == "iban":
            account = F.regexp_replace(match, "[\\x20-]", "")
            return F.length(account).between(15, 34) & mod97(account)
        return F.lit(True)


BASE = (
    Kind(
        "email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9,
        r"mail|contact|kontakt|correo|courriel",
    ),
    Kind("ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"\bip\b|address|host|server", r"version|release|section"),
    Kind("card", r"(?:[0-9][\x20-]?){12}", r"[0-9]++(?:[\x20-][0-9]++)*+", 0.8, r"card|visa|karte|carte|tarjeta|credit", r"order|invoice|isbn|serial"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, r"phone|call|mobile|telefon|t[eé]l[eé]fono?"),
)
# The registered lengths of accounts by country: where a printed one ends cannot be told from its form.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU",
}
# Unbroken ones are as long as their run, whatever the country; printed ones have one space or hyphen in places.
_UNBROKEN = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
_PRINTED = "|".join(rf"(?:{'|'.join(lands.split())})(?:[\x20-]?[0-9]){{2}}(?:[\x20-]?[A-Z0-9]){{{n - 4}}}" for n, lands in IBAN_LENGTHS.items())
ADDED = (
    Kind(
        "iban", r"[A-Z]{2}(?:[\x20-]?[0-9]){2}(?:[\x20-]?[A-Z0-9]){11}", rf"(?<![A-Za-z0-9])(?:(?:{_PRINTED})(?![A-Za-z0-9])|{_UNBROKEN})",
        0.8, r"iban|konto|account|bank|compte|cuenta",
    ),
)
KINDS = BASE + ADDED


def _walk(count: Column, step: Callable[[Column, Column], Column], last: Callable[[Column], Column] | None = None) -> Column:
    """What ``step`` appends to ``out`` for 0 .. ``count`` - 1, split at commas; ``at`` goes on from one to the next.

    A string is copied whenever it grows, so it grows for about sqrt(count) steps only and then joins
    ``done``. ``last`` gives one more piece from the final ``at``.
    """
    size = F.ceil(F.sqrt(count)).cast("int")
    none = F.array().cast("array<string>")

    def state(at: Column, out: Column, done: Column) -> Column:
        return F.struct(at.alias("at"), out.alias("out"), done.alias("done"))

    def block(seen: Column, k: Column) -> Column:
        places = F.sequence(k * size, F.least(k * size + size, count) - 1)
        return F.aggregate(places, seen, step, lambda s: state(s["at"], F.lit(""), F.concat(s["done"], F.array(s["out"]))))

    end = (lambda s: F.concat(s["done"], F.array(last(s["at"])))) if last else (lambda s: s["done"])
    blocks = F.sequence(F.lit(0), F.ceil(count / size).cast("int") - 1)
    done = F.aggregate(blocks, state(F.lit(0), F.lit(""), none), block, end)
    return F.when(count > 0, F.array_remove(F.split(F.array_join(done, ""), ","), "")).otherwise(none)


def _pieces(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(f"(?s).{{1,{1 << PIECE_BITS}}}"), F.lit(0))


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` to ``end`` of the text that ``pieces`` hold, without a walk from its start."""
    first = F.shiftright(start, PIECE_BITS)
    places = F.sequence(first, F.greatest(F.shiftright(end - 1, PIECE_BITS), first))
    near = F.array_join(F.transform(places, lambda k: F.get(pieces, k)), "")
    return F.substring(near, start - F.shiftleft(first, PIECE_BITS) + 1, end - start)


def _parts(body: Column, kind: Kind) -> Column:
    """(gap, match): the length before every match and the match, and a last gap without one."""
    gaps = F.transform(F.split(body, kind.pattern, -1), F.length)
    matches = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast("array<struct<gap: int, match: string>>")
    return F.when(body.rlike(kind.marker), F.arrays_zip(gaps.alias("gap"), matches.alias("match"))).otherwise(none)


def _places(parts: Column, kind: Kind) -> Column:
    """'start:end' of every confirmed match."""

    def step(seen: Column, k: Column) -> Column:
        match = F.get(parts, k)["match"]
        start = seen["at"] + F.get(parts, k)["gap"]
        end = start + F.length(match)
        found = F.concat(F.lit(","), start.cast("string"), F.lit(":"), end.cast("string"))
        out = F.when(kind.valid(match), F.concat(seen["out"], found)).otherwise(seen["out"])
        return F.struct(end.alias("at"), out.alias("out"), seen["done"].alias("done"))

    return _walk(F.size(parts) - 1, step)


def find_spans(docs: DataFrame, text: str = "text", alias: str = "spans") -> DataFrame:
    """``docs`` with an array of (start, rank, end, kind, score), by start and then by kind.

    Positions count code points from 0, the end is exclusive. The score is the kind's own, moved by
    words within ``CONTEXT_CHARS`` characters on either side.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names, pieces = [unused(docs, f"_parts{rank}") for rank in range(len(KINDS))], unused(docs, "_pieces")
    # columns named more than once by what follows, or a lambda would work them out for every element
    found = docs.withColumns({name: _parts(body, kind) for name, kind in zip(names, KINDS)})
    some = F.greatest(*[F.size(name) for name in names]) > 1
    found = found.withColumn(pieces, F.when(some, _pieces(body)).otherwise(F.array().cast("array<string>")))
    parts = [
        _spans(_places(F.col(name), kind), F.col(pieces), rank, kind)
        for rank, (name, kind) in enumerate(zip(names, KINDS))
    ]
    return found.withColumn(alias, F.array_sort(F.concat(*parts))).drop(*names, pieces)


def _spans(places: Column, pieces: Column, rank: int, kind: Kind) -> Column:
    """Spans of 'start:end'; one step after the other, so that each is worked out once."""

    def numbers(place: Column) -> Column:
        return F.struct(F.substring_index(place, ":", 1).cast("int").alias("start"), F.substring_index(place, ":", -1).cast("int").alias("end"))

    def words(s: Column) -> Column:
        before = _cut(pieces, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"])
        near = F.lower(F.concat(before, F.lit(" "), _cut(pieces, s["end"], s["end"] + CONTEXT_CHARS)))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), near.alias("near"))

    def span(s: Column) -> Column:
        score = F.lit(kind.score)
        if kind.context:
            score = score + F.when(s["near"].rlike(kind.context), 0.15).otherwise(0.0)
        if kind.against:
            score = score - F.when(s["near"].rlike(kind.against), 0.3).otherwise(0.0)
        return F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind.name).alias("kind"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    return F.transform(F.transform(F.transform(places, numbers), words), span)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, minimum: float = 0.0, text: str = "text", spans: str = "spans") -> DataFrame:
    """``text`` with every span of at least ``minimum`` replaced by its kind in brackets.

    Of overlapping spans the first one names the replacement and all of them go.
    """
    body = F.col(text).cast("string")
    pieces, used = unused(docs, "_pieces"), unused(docs, "_used")
    done = docs.withColumn(used, F.filter(F.col(spans), lambda s: s["score"] >= minimum))
    done = done.withColumn(pieces, F.when(F.size(used) > 0, _pieces(body)).otherwise(F.array().cast("array<string>")))

    def step(seen: Column, k: Column) -> Column:
        s = F.get(F.col(used), k)
        found = F.concat(F.lit(","), seen["at"].cast("string"), F.lit(":"), s["start"].cast("string"), F.lit(":"), F.upper(s["kind"]))
        out = F.when(s["start"] >= seen["at"], F.concat(seen["out"], found)).otherwise(seen["out"])
        return F.struct(F.greatest(s["end"], seen["at"]).alias("at"), out.alias("out"), seen["done"].alias("done"))

    def replace(place: Column) -> Column:
        """The text up to a span, and its mark; no mark behind the last one."""
        at = F.split(place, ":")
        mark = F.when(F.get(at, F.lit(2)) != "", F.concat(F.lit("["), F.get(at, F.lit(2)), F.lit("]"))).otherwise(F.lit(""))
        return F.concat(_cut(F.col(pieces), F.get(at, F.lit(0)).cast("int"), F.get(at, F.lit(1)).cast("int")), mark)

    rest = lambda at: F.concat(F.lit(","), at.cast("string"), F.lit(":"), F.length(body).cast("string"), F.lit(":"))
    replaced = F.array_join(F.transform(_walk(F.size(used), step, rest), replace), "")
    return done.withColumn(text, F.when(F.size(pieces) > 0, replaced).otherwise(F.col(text))).drop(pieces, used)


def redacted(docs: DataFrame, minimum: float = 0.25) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars`` of the new text where there is one."""
    spans = unused(docs, "_spans")
    done = redact(find_spans(docs, alias=spans), minimum, spans=spans).drop(spans)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
