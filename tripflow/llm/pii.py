"""Personal data in whole texts: patterns propose, checksums confirm, context adjusts.

DataFrame operations only. Spark finds all matches of a pattern but not their
places; the pieces that the same pattern splits off give them, as pieces and
matches alternate through the text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """``pattern`` matches greedily from the left; ``confirm`` drops matches that fail.

    Patterns use possessive repeats and may only start where their first run starts
    (or where the last match ended), which finds the same matches in linear time.
    """

    name: str
    pattern: str
    confirm: Callable[[Column], Column] | None
    score: float
    context: tuple[str, ...]


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits ends in 0."""
    mirrored = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(mirrored, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number's rearranged digits leave 1 modulo 97; letters count from 10."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def fold(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 65, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), fold) == 1


def _small_parts(address: Column) -> Column:
    """Whether each dotted part is at most 255; leading zeros don't count."""

    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return F.when(F.length(bare) > 3, F.lit(False)).otherwise(F.concat(F.lit("0"), bare).cast("int") <= 255)

    return F.forall(F.split(address, r"\."), small)


KINDS: tuple[Kind, ...] = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        None,
        0.8,
        ("mail", "contact", "write"),
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _small_parts, 0.6, ("ip", "host", "server", "address")),
    Kind(
        "card",
        r"[0-9](?:[ -]?[0-9])++",
        lambda hit: F.when(F.length(_digits(hit)).between(13, 19), luhn(_digits(hit))).otherwise(F.lit(False)),
        0.7,
        ("card", "visa", "credit", "payment"),
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda hit: F.length(_digits(hit)).between(9, 15),
        0.5,
        ("phone", "tel", "call", "mobile", "fax"),
    ),
)

#: Spans beyond the base kinds: international account numbers, confirmed by mod-97.
ACCOUNT = Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])", mod97, 0.8, ("iban", "account", "bank"))

_CONTEXT_BEFORE, _CONTEXT_BONUS = 40, 0.2
_TOGETHER = 256  # hits whose spans are gathered in one array before they join the others


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _score(kind: Kind, before: Column) -> Column:
    near = F.lower(before)
    hinted = F.lit(False)
    for word in kind.context:
        hinted = hinted | F.contains(near, F.lit(word))
    return F.when(hinted, kind.score + _CONTEXT_BONUS).otherwise(F.lit(kind.score))


def _spans(kind: Kind, text: Column, hits: Column) -> Column:
    """(kind, start, end, score) of the confirmed hits.

    One walk over the pieces between hits: it carries the place, and the characters before it that a score looks at, and
    never goes back into the text. Spans gather in arrays of ``_TOGETHER``, so the work is in proportion to the hits.
    """
    pieces = F.split(text, kind.pattern, -1)
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    ending = lambda text: F.substring(text, -_CONTEXT_BEFORE, _CONTEXT_BEFORE)

    def step(state: Column, i: Column, pieces: Column) -> Column:
        hit, piece = F.get(hits, i), F.get(pieces, i)

        def place(known: Column) -> Column:
            start, end = known["start"], known["start"] + F.length(hit)
            span = lambda: F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), _score(kind, known["before"]).alias("score"))
            more = F.concat(state["out"], F.array(span()))
            out = more if kind.confirm is None else F.when(kind.confirm(hit), more).otherwise(state["out"])
            return F.struct(end.alias("at"), ending(F.concat(known["before"], hit)).alias("before"), out.alias("out"))

        here = F.struct((state["at"] + F.length(piece)).alias("start"), ending(F.concat(state["before"], piece)).alias("before"))
        return _with(here, place)

    def stretch(state: Column, first: Column, pieces: Column) -> Column:
        start = F.struct(state["at"].alias("at"), state["before"].alias("before"), none.alias("out"))
        each = F.sequence(first, F.least(first + _TOGETHER, F.size(hits)) - 1)
        walked = F.aggregate(each, start, lambda inner, i: step(inner, i, pieces))
        return _with(walked, lambda w: F.struct(w["at"].alias("at"), w["before"].alias("before"), F.concat(state["out"], F.array(w["out"])).alias("out")))

    def walk(pieces: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.array().cast("array<array<struct<kind:string,start:int,end:int,score:double>>>").alias("out"))
        firsts = F.sequence(F.lit(0), F.size(hits) - 1, F.lit(_TOGETHER))
        return F.aggregate(firsts, start, lambda state, first: stretch(state, first, pieces), lambda state: F.flatten(state["out"]))

    return F.when(F.size(hits) > 0, _with(pieces, walk)).otherwise(none)


def find_personal_data(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", kinds: Sequence[Kind] = (*KINDS, ACCOUNT)
) -> DataFrame:
    """One row per document: doc_id and spans, an array of (kind, start, end, score).

    Starts and ends are code points, the end exclusive. Spans come by kind as listed,
    then by start. A null text counts as empty and has no spans; null ids and rows
    that repeat pass through; other columns are not read; an empty table gives no rows. Each row is worked on
    alone: no shuffle, and no group meets in one task.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", "text", *(F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)).alias(f"hits_{k.name}") for k in kinds)
    )
    return rows.select("doc_id", F.concat(*(_spans(k, F.col("text"), F.col(f"hits_{k.name}")) for k in kinds)).alias("spans"))
