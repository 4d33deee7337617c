"""Text, size, URL, hash and markdown expressions."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import strip

# Unit names of the two size styles.
SHORT_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB")
LONG_UNITS = ("Bytes", "KB", "MB", "GB", "TB", "PB")


def truncate_text(text: Column, n: int, suffix: str = "...") -> Column:
    """At most ``n`` characters, the suffix included."""
    cut = F.concat(F.substring(text, 1, max(n - len(suffix), 0)), F.lit(suffix))
    return F.when(F.length(text) <= n, text).otherwise(cut)


@F.arrow_udf(T.StringType())
def _nfkd(text: pa.Array) -> pa.Array:
    return pc.utf8_normalize(text, form="NFKD")


def url_slug(text: Column) -> Column:
    """Lower-case ASCII words joined by dashes; accents are folded.

    Spark has no compatibility decomposition, so that one step is an Arrow
    function, which gets only texts with other than ASCII characters and makes no
    Python objects of them; the rest are built-in expressions.
    """
    other = F.when(F.octet_length(text) != F.length(text), text)
    ascii_text = F.lower(F.regexp_replace(F.coalesce(_nfkd(other), text), r"[^\x00-\x7F]", ""))
    return dashed(ascii_text, r"[^\w\s-]")


def dashed(text: Column, dropped: str) -> Column:
    joined = F.regexp_replace(F.regexp_replace(text, dropped, ""), r"(?U)[-\s]+", "-")
    return F.regexp_replace(joined, "^-+|-+$", "")


def _power(size: Column, top: int) -> Column:
    """How many times the size can be divided by 1024, at most ``top``."""
    step = F.lit(0)
    for i in range(1, top + 1):
        step = F.when(size >= F.lit(1024**i), F.lit(i)).otherwise(step)
    return step


def _divisor(power: Column) -> Column:
    return F.element_at(F.array(*[F.lit(1024**i).cast("bigint") for i in range(7)]), power + 1)


def human_bytes(size: Column) -> Column:
    """``1.0 KB`` style, one decimal, ties to even (integer arithmetic, so exact)."""
    power = _power(size, 6)
    d = _divisor(power)
    tenths = size.cast("decimal(38,0)") * 10
    left = tenths % d
    q = ((tenths - left) / d).cast("bigint")
    q = q + F.when((left * 2 > d) | ((left * 2 == d) & (q % 2 == 1)), 1).otherwise(0)
    unit = F.element_at(F.array(*[F.lit(u) for u in SHORT_UNITS]), power + 1)
    return F.concat(F.floor(q / 10), F.lit("."), q % 10, F.lit(" "), unit)


def pretty_bytes(size: Column) -> Column:
    """``1.18 MB`` style: up to two decimals, no trailing zeros, ties up."""
    power = _power(size, 5)
    d = _divisor(power)
    twice = size.cast("decimal(38,0)") * 200 + d
    q = ((twice - twice % (d * 2)) / (d * 2)).cast("bigint")
    number = F.format_string("%d.%02d", F.floor(q / 100), q % 100)
    number = F.regexp_replace(number, r"\.?0+$", "")
    unit = F.element_at(F.array(*[F.lit(u) for u in LONG_UNITS]), power + 1)
    return F.when(size == 0, "0 Bytes").otherwise(F.concat(number, F.lit(" "), unit))


def hash_text(text: Column, algorithm: str) -> Column:
    """Lower-case hex digest: md5, sha1, sha256 or sha512."""
    if algorithm == "md5":
        return F.md5(text)
    if algorithm == "sha1":
        return F.sha1(text)
    return F.sha2(text, {"sha256": 256, "sha512": 512}[algorithm])


def pseudonymise_id(text: Column) -> Column:
    """Nine digits derived from the md5 of the text."""
    digest = F.md5(text)

    def part(start: int, length: int, span: int, base: int) -> Column:
        return (F.conv(F.substring(digest, start, length), 16, 10).cast("bigint") % span + base).cast("string")

    return F.concat(part(1, 3, 900, 100), part(4, 2, 90, 10), part(6, 4, 9000, 1000))


def pad_key(number: Column, width: int = 9) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def url_params(url: Column) -> Column:
    """Query string as a map; for a repeated name the last value counts."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.try_url_decode(F.regexp_extract(p, "^[^=]*", 0)).alias("k"),
            F.try_url_decode(F.regexp_replace(p, "^[^=]*=?", "")).alias("v"),
        ),
    )
    names = F.transform(entries, lambda e: e["k"])
    last = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["k"]),
    )
    return F.map_from_entries(last)


def url_encode(text: Column) -> Column:
    """Percent-encode everything but letters, digits and ``_ . - ~``."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def tag_line_endings(text: Column) -> Column:
    """Make line ends visible as ``<<CR>>`` and ``<<LF>>``."""
    tagged = F.replace(text, F.lit("\r"), F.lit("<<CR>>"))
    return F.replace(tagged, F.lit("\n"), F.lit("<<LF>>"))


def markdown_title(text: Column, fallback: Column) -> Column:
    """Text of the first heading, closing marks removed."""
    heading = r"(?m)^[ \t]{0,3}#{1,6}[ \t]+(.+?)[ \t]*#*[ \t]*\r?$"
    title = strip(F.regexp_extract(text, heading, 1))
    return F.when(title != "", title).otherwise(fallback)


def markdown_toc(text: Column) -> Column:
    """Array of (line_no, level, text, slug) for every ATX heading."""
    lines = F.transform(F.split(text, "\n"), lambda l, i: F.struct((i + 1).alias("line_no"), strip(l).alias("line")))
    headings = F.filter(lines, lambda x: x["line"].rlike(r"^#{1,6}\s+.+$"))

    def entry(x: Column) -> Column:
        title = strip(F.regexp_replace(x["line"], r"^#{1,6}\s+", ""))
        return F.struct(
            x["line_no"].alias("line_no"),
            F.length(F.regexp_extract(x["line"], "^#{1,6}", 0)).alias("level"),
            title.alias("text"),
            dashed(F.lower(title), r"(?U)[^\w\s-]").alias("slug"),
        )

    return F.transform(headings, entry)
