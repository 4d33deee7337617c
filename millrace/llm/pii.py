"""Personal data in texts: patterns propose, checksums confirm, context adjusts the score.

Everything is a built-in function over the row, so there is no shuffle and no
Python.  A kind's matches come from ``regexp_extract_all``; ``split`` by the same
pattern gives the text between them, hence their places and the words before
them, in time that is linear in the text.  Patterns are written so that Java's
matcher neither recurses (possessive groups) nor tries a run of characters from
each of its positions (a look behind); they match what the plain forms match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import compute_once

# Kinds in the order of reports, their patterns and context words.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+\-])|\G)[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
}
#: A text without a match of this has none of the kind.
NEEDED = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "ssn": "[0-9]-[0-9]"}
CONTEXT = {
    "email": "(?i)e-?mail|contact|write|@",
    "ip": "(?i)\\bip\\b|address|server|host|client",
    "card": "(?i)card|visa|master|amex|payment|credit|debit",
    "phone": "(?i)phone|tel|call|mobile|fax|cell",
    "iban": "(?i)iban|account|bank|transfer",
    "ssn": "(?i)ssn|social security",
}
SCORE = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27,
    "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SK": 24,
}

#: What nearby context words add, and the score from which an added kind is reported.
CONTEXT_BONUS, ENOUGH = 0.25, 0.5
#: Code points before a match that are searched for context words.
NEARBY = 48
#: Code points that are masked at a time.
PIECE = 4096


def find(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, ``text`` and, per kind, ``array<struct<kind, start, end, score>>``.

    Places are code points from 0, end exclusive, in order.  Base kinds are
    leftmost and do not overlap; failing matches are dropped without a retry.
    Added kinds need a valid checksum or a context word.  Null and empty texts
    have no spans.  Repeated rows stay, other columns are not carried.
    """
    rows = docs.select(*carry, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    seen = {}
    for kind in KINDS:
        pattern = F.lit(PATTERNS[kind])
        here = F.col("text").contains("@") if kind == "email" else F.col("text").rlike(NEEDED[kind])
        seen[f"{kind}_hits"] = F.when(here, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(
            F.array().cast("array<string>")
        )
    rows = compute_once(rows, **seen)
    between = {
        f"{kind}_gaps": F.when(
            F.size(f"{kind}_hits") > 0,
            F.transform(
                F.split("text", PATTERNS[kind], -1),
                lambda p: F.struct(F.char_length(p).alias("n"), F.substring(p, -NEARBY, NEARBY).alias("before")),
            ),
        )
        for kind in KINDS
    }
    rows = compute_once(rows, **between)
    return compute_once(rows, **{kind: _spans(kind) for kind in KINDS}).select(*carry, "text", *KINDS)


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of spans per row of ``docs``.

    ``n_<kind>`` for all kinds; ``base_sha256`` digests the base spans written as
    kind:start:end and joined by commas (none: the empty text); ``spans`` lists
    those and the added kinds.
    """
    found = find(docs)
    listed = {kind: F.transform(kind, _written) for kind in KINDS}
    base = F.array_join(F.concat(*[listed[k] for k in BASE_KINDS]), ",")
    added = F.array_join(F.concat(*[listed[k] for k in KINDS]), ",")
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        added.alias("spans"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ADDED_KINDS],
    )


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span replaced by its kind in brackets.

    Overlapping spans become one mark.  Columns are those of ``docs``;
    ``n_chars``, where there is one, follows the new text.  Null texts stay null.
    """
    held = {f"column_{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    placed = docs.select(*[c.alias(name) for name, c in held.items()], F.col("text").cast("string").alias("text"))
    found = find(placed, tuple(held))
    spans = F.array_sort(
        F.concat(
            *[
                F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
                for k in KINDS
            ]
        )
    )
    found = compute_once(found.select(*held, "text", spans.alias("spans")), masked=_masked())
    kept = dict(zip(docs.columns, map(F.col, held), strict=True))
    kept["text"] = F.when(F.size("spans") > 0, F.col("masked")).otherwise(kept["text"])
    if "n_chars" in kept:
        kept["n_chars"] = F.char_length(kept["text"]).cast(docs.schema["n_chars"].dataType)
    return found.select(*[value.alias(c) for c, value in kept.items()])


def _written(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))


def _spans(kind: str) -> Column:
    """The confirmed matches of a kind with their places and scores."""
    hits, gaps = F.col(f"{kind}_hits"), F.col(f"{kind}_gaps")
    steps = F.zip_with(gaps, hits, lambda g, h: g["n"] + F.coalesce(F.char_length(h), F.lit(0)))
    placed = F.zip_with(
        F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("hit"), g["before"].alias("before"))),
        running(steps),
        lambda x, end: F.struct(x["hit"].alias("hit"), x["before"].alias("before"), end.alias("end")),
    )
    good = F.filter(placed, lambda x: F.coalesce(_valid(kind, x["hit"]), F.lit(False)))
    scored = F.transform(
        good,
        lambda x: F.struct(
            F.lit(kind).alias("kind"),
            (x["end"] - F.char_length(x["hit"])).alias("start"),
            x["end"].alias("end"),
            F.round(F.lit(SCORE[kind]) + F.when(x["before"].rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0), 2).alias("score"),
        ),
    )
    if kind in ADDED_KINDS:
        scored = F.filter(scored, lambda s: s["score"] >= ENOUGH)
    return F.when(F.size(hits) > 0, scored).otherwise(
        F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    )


def running(steps: Column, block: int = 128) -> Column:
    """Running sums of an array of numbers.

    A fold copies what it has built at each step, so it runs on blocks, and once
    over the sums of the blocks.
    """

    def fold(array: Column) -> Column:
        return F.aggregate(
            array,
            F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("all")),
            lambda acc, x: F.struct(
                (acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + x)).alias("all")
            ),
            lambda acc: acc["all"],
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(steps) - 1) / block), F.lit(0)).cast("int")),
        lambda b: fold(F.slice(steps, b * block + 1, block)),
    )
    ends = fold(F.transform(blocks, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0))))
    shifted = F.zip_with(
        blocks,
        ends,
        lambda b, end: F.transform(b, lambda x: x + end - F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0))),
    )
    return F.flatten(shifted)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", "")), small)
    if kind == "card":
        return F.when(F.length(hit) >= 13, F.length(_digits(hit)).between(13, 19) & _luhn(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind == "iban":
        return _mod97(F.regexp_replace(hit, " ", ""))
    if kind == "ssn":
        return ~F.substring(hit, 1, 3).isin("000", "666") & (F.substring(hit, 1, 1) != "9")
    return hit.isNotNull()


def _luhn(hit: Column) -> Column:
    """The digits' Luhn sum ends in 0: every second digit from the right counts double."""

    def add(acc: Column, x: Column, i: Column) -> Column:
        twice = x * 2
        return acc + F.when(i % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(x)

    digits = F.reverse(F.slice(F.split(_digits(hit), "(?<=.)(?=.)"), 1, 20))
    weighed = F.transform(digits, lambda d, i: add(F.lit(0), d.cast("int"), i))
    return F.aggregate(weighed, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def _mod97(code: Column) -> Column:
    """The country's length, and remainder 1 with the first four characters moved to the end."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTH.items() for x in pair])
    moved = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.pmod(F.when(digit, acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55), F.lit(97))

    rest = F.aggregate(F.split(moved, "(?<=.)(?=.)"), F.lit(0), step)
    return (lengths[F.substring(code, 1, 2)] == F.length(code)) & (rest == 1)


def _masked() -> Column:
    """The text with its spans replaced, piece by piece, so a cut never counts from the text's start."""
    pieces = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % PIECE), F.lit(0))

    def one(piece: Column, i: Column) -> Column:
        low = i.cast("bigint") * PIECE
        near = F.filter("spans", lambda s: (s["end"] > low) & (s["start"] < low + PIECE))

        def step(acc: Column, s: Column) -> Column:
            fresh = s["start"] >= acc["at"]
            before = F.substring(piece, acc["at"] - low + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
            mark = F.when(fresh, F.concat(before, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], mark).alias("out"))

        start = F.struct(low.alias("at"), F.lit("").alias("out"))
        return F.aggregate(
            near, start, step, lambda acc: F.concat(acc["out"], F.substring(piece, acc["at"] - low + 1, F.lit(PIECE)))
        )

    return F.when(F.size("spans") > 0, F.array_join(F.transform(pieces, one), ""))
