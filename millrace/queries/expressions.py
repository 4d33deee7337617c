"""String, date, size, hash, URL and number expressions, registered functions and loans."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import functions as F

from ..functions import moments, text
from ..operators import loans
from ..session import compute_once
from .registry import query


@query(
    "truncate_text",
    "F1",
    """SELECT doc_id, CASE WHEN length(text) <= 300 THEN text ELSE substring(text, 1, 297) || '...' END AS short FROM documents""",
)
def truncate_text(t):
    return t.documents.select("doc_id", text.truncate_text(F.col("text"), 300).alias("short"))


@query(
    "url_slug",
    "F2",
    r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')),
          '[^\w\s-]', '', 'g'), '[-\s]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM documents""",
)
def url_slug(t):
    return t.spread("documents").select("doc_id", F.md5(text.url_slug(F.col("text"))).alias("slug"))


_SIZES = "SELECT o_orderkey, (o_totalprice * 100)::BIGINT * (1024 ** (o_orderkey % 4))::BIGINT // 512 * (o_orderkey % 11) AS size FROM orders"
_POW = "CASE " + " ".join(f"WHEN size >= {1024**i} THEN {i}" for i in range(5, 0, -1)) + " ELSE 0 END"


@query(
    "human_bytes",
    "F3",
    f"""
    WITH s AS ({_SIZES}), p AS (SELECT o_orderkey, size, {_POW} AS p FROM s),
    d AS (SELECT *, (1024 ** p)::HUGEINT AS d FROM p),
    q AS (SELECT *, size::HUGEINT * 10 // d AS a, (size::HUGEINT * 10) % d AS m, (size::HUGEINT * 200 + d) // (2 * d) AS h FROM d),
    r AS (SELECT *, a + CASE WHEN 2 * m > d OR (2 * m = d AND a % 2 = 1) THEN 1 ELSE 0 END AS t FROM q)
    SELECT o_orderkey, size, (t // 10) || '.' || (t % 10) || ' ' || ['B', 'KB', 'MB', 'GB', 'TB', 'PB'][p + 1] AS short_text,
      CASE WHEN size = 0 THEN '0 Bytes' ELSE regexp_replace((h // 100) || '.' || lpad((h % 100)::VARCHAR, 2, '0'), '\\.?0+$', '') || ' ' ||
        ['Bytes', 'KB', 'MB', 'GB', 'TB', 'PB'][p + 1] END AS long_text
    FROM r""",
)
def human_bytes(t):
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    scale = F.element_at(F.array(*[F.lit(1024**i).cast("bigint") for i in range(4)]), (k % 4 + 1).cast("int"))
    size = F.shiftright(cents * scale, 9) * (k % 11)
    sized = compute_once(t.orders.select(k, "o_totalprice"), size=size).drop("o_totalprice")
    return sized.select(
        "o_orderkey", "size",
        text.human_bytes(F.col("size")).alias("short_text"),
        text.pretty_bytes(F.col("size")).alias("long_text"),
    )


@query(
    "date_arithmetic",
    "F4 F5",
    """
    SELECT o_orderkey, o_orderdate + INTERVAL 2 YEAR AS y, o_orderdate - INTERVAL 1 MONTH AS mo, o_orderdate + INTERVAL 3 WEEK AS w,
      o_orderdate - INTERVAL 10 DAY AS d, o_orderdate + INTERVAL 30 HOUR AS h, o_orderdate + INTERVAL 90 MINUTE AS mi, o_orderdate - INTERVAL 5 SECOND AS s,
      floor((epoch_us(TIMESTAMP '1997-03-04 05:06:07') - epoch_us(o_orderdate)) / 86400000000)::BIGINT AS days,
      floor((epoch_us(TIMESTAMP '1997-03-04 05:06:07') - epoch_us(o_orderdate)) / 2592000000000)::BIGINT AS months,
      floor((epoch_us(TIMESTAMP '1997-03-04 05:06:07') - epoch_us(o_orderdate)) / 31536000000000)::BIGINT AS years
    FROM orders""",
)
def date_arithmetic(t):
    d = F.col("o_orderdate")
    pivot = F.lit("1997-03-04 05:06:07").cast("timestamp_ntz")
    shifts = {"y": (2, "years"), "mo": (-1, "months"), "w": (3, "weeks"), "d": (-10, "days"), "h": (30, "hours"), "mi": (90, "minutes"), "s": (-5, "seconds")}
    return t.orders.select(
        "o_orderkey",
        *[moments.add_time(d, n, unit).alias(name) for name, (n, unit) in shifts.items()],
        *[moments.date_diff(d, pivot, unit).alias(unit) for unit in ("days", "months", "years")],
    )


@query(
    "format_date",
    "F6",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS plain, strftime(ts, '%b %d, %Y at %H:%M:%S') AS long, strftime(ts, '%a %d/%m') AS short FROM events""",
)
def format_date(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        moments.format_date(ts).alias("plain"),
        moments.format_date(ts, "MMM DD, YYYY at HH:mm:ss").alias("long"),
        moments.format_date(ts, "ddd DD/MM").alias("short"),
    )


@query(
    "valid_dates",
    "F7",
    """SELECT event_id, event_id % 4 < 2 AS valid FROM events""",
)
def valid_dates(t):
    k = F.col("event_id") % 4
    shown = (
        F.when(k == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(k == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 2, F.concat(F.lit("2024-13-"), F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0")))
        .otherwise(F.col("event_type"))
    )
    return t.events.select("event_id", moments.is_valid_date(shown).alias("valid"))


_AGO_UNITS = (("year", 31536000), ("month", 2592000), ("week", 604800), ("day", 86400), ("hour", 3600), ("minute", 60))
_AGO = " ".join(
    f"WHEN s >= {n} THEN (s // {n}) || ' {u}' || CASE WHEN s // {n} > 1 THEN 's' ELSE '' END || ' ago'" for u, n in _AGO_UNITS
)


@query(
    "time_ago",
    "F8",
    f"""
    WITH e AS (SELECT event_id, floor((epoch_us(TIMESTAMP '2024-01-20 00:00:00' ) - epoch_us(ts)) / 1000000)::BIGINT AS s FROM events),
    o AS (SELECT o_orderkey, floor((epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(o_orderdate)) / 1000000)::BIGINT AS s FROM orders)
    SELECT 'event' AS kind, event_id AS id, CASE {_AGO} ELSE 'just now' END AS age FROM e
    UNION ALL SELECT 'order', o_orderkey, CASE {_AGO} ELSE 'just now' END FROM o""",
)
def time_ago(t):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    events = t.events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), moments.time_ago(F.col("ts"), now).alias("age"))
    orders = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), moments.time_ago(F.col("o_orderdate"), now).alias("age"))
    return events.unionByName(orders)


@query(
    "expand_order_dates",
    "F9",
    """SELECT o_orderkey, year(o_orderdate)::INTEGER AS o_orderdate_year, month(o_orderdate)::INTEGER AS o_orderdate_month,
         day(o_orderdate)::INTEGER AS o_orderdate_day, (isodow(o_orderdate) - 1)::INTEGER AS o_orderdate_dayofweek,
         (isodow(o_orderdate) >= 6)::INTEGER AS o_orderdate_is_weekend FROM orders""",
)
def expand_order_dates(t):
    return t.orders.select("o_orderkey", "o_orderdate").withColumns(moments.expand_dates("o_orderdate")).drop("o_orderdate")


@query(
    "hash_text",
    "F10",
    "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents",
)
def hash_text(t):
    return t.documents.select("doc_id", *[text.hash_text(F.col("text"), a).alias(a) for a in ("md5", "sha1", "sha256")])


@query("hash_sha512", "F10")
def hash_sha512(t):
    return t.documents.select("doc_id", text.hash_text(F.col("text"), "sha512").alias("sha512"))


_SHA512 = ", ".join(f"({k}, '{hashlib.sha512(str(k).encode()).hexdigest()}')" for k in range(100))


@query(
    "hash_sha512_keys",
    "F10",
    f"""SELECT o_orderkey, h.digest AS sha512 FROM orders JOIN (VALUES {_SHA512}) h(k, digest) ON o_orderkey % 100 = k""",
)
def hash_sha512_keys(t):
    """SHA-512 of the keys' last two digits, against digests from another implementation."""
    return t.orders.select("o_orderkey", text.hash_text((F.col("o_orderkey") % 100).cast("string"), "sha512").alias("sha512"))


@query(
    "pseudonymise_customer",
    "F11",
    """
    SELECT c_custkey, (('0x' || substring(h, 1, 3))::BIGINT % 900 + 100)::VARCHAR || (('0x' || substring(h, 4, 2))::BIGINT % 90 + 10)
       || (('0x' || substring(h, 6, 4))::BIGINT % 9000 + 1000) AS pseudonym FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""",
)
def pseudonymise_customer(t):
    return t.customer.select("c_custkey", text.pseudonymise_id(F.col("c_name")).alias("pseudonym"))


@query(
    "url_params",
    "F13",
    """
    WITH u AS (SELECT page_id, url || CASE WHEN contains(url, '#') THEN '' WHEN contains(url, '?') THEN '&page=9&q=a%20b+c' ELSE '?x=&y=1=2' END AS url FROM pages),
    q AS (SELECT page_id, regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS q FROM u),
    p AS (SELECT page_id, i, ps[i] AS p FROM (SELECT page_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT page_id, string_split(q, '&') AS ps FROM q)) WHERE ps[i] <> ''),
    e AS (SELECT page_id, i, url_decode(replace(regexp_extract(p, '^[^=]*'), '+', ' ')) AS name, url_decode(replace(regexp_replace(p, '^[^=]*=?', ''), '+', ' ')) AS value FROM p)
    SELECT page_id, name, arg_max(value, i) AS value FROM e GROUP BY page_id, name""",
)
def url_params(t):
    more = F.when(F.contains("url", F.lit("#")), "").when(F.contains("url", F.lit("?")), "&page=9&q=a%20b+c").otherwise("?x=&y=1=2")
    return t.pages.select("page_id", F.explode(text.url_params(F.concat("url", more))).alias("name", "value"))


@query(
    "url_encode",
    "F13",
    "SELECT doc_id, md5(url_encode(text || '~*')) AS encoded FROM documents",
)
def url_encode(t):
    return t.documents.select("doc_id", F.md5(text.url_encode(F.concat("text", F.lit("~*")))).alias("encoded"))


@query(
    "null_arithmetic",
    "F14 A4",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END * 2 AS doubled FROM events""",
)
def null_arithmetic(t):
    present = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", (present * 2).alias("doubled"))


@query(
    "registered_function",
    "X1",
    "SELECT event_id, value > 90 AS elite FROM events",
)
def registered_function(t):
    @F.pandas_udf("boolean")
    def is_elite(scores: pd.Series) -> pd.Series:
        return scores > 90

    t.spark.udf.register("is_elite", is_elite)
    t.events.createOrReplaceTempView("scored_events")
    return t.spark.sql("SELECT event_id, is_elite(value) AS elite FROM scored_events")


@query(
    "sql_row_function",
    "X2",
    "SELECT l_orderkey, sum(l_quantity::DECIMAL(10,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(24,4)::VARCHAR AS net FROM lineitem GROUP BY l_orderkey",
)
def sql_row_function(t):
    t.lineitem.createOrReplaceTempView("net_lines")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION net_quantity(q DOUBLE, d DOUBLE) RETURNS DECIMAL(18,4)
           RETURN CAST(q AS DECIMAL(10,2)) * (1 - CAST(d AS DECIMAL(4,2)))"""
    )
    return t.spark.sql(
        """SELECT l_orderkey, CAST(CAST(sum(net_quantity(l_quantity, l_discount)) AS DECIMAL(24,4)) AS STRING) AS net
           FROM net_lines GROUP BY l_orderkey"""
    )


@query(
    "loan_schedule",
    "F22",
    """
    WITH RECURSIVE l AS (SELECT o_orderkey AS id, (o_totalprice * 100)::BIGINT AS p, (o_orderkey % 9 + 3) * 100 AS r,
        CASE WHEN o_orderkey % 500 = 0 THEN 1 ELSE (o_totalprice * 100)::BIGINT // (o_orderkey % 40 + 6) + 5000 END AS pay FROM orders),
    s AS (SELECT id, 0 AS m, p AS left_, 0::BIGINT AS interest, 0::BIGINT AS paid, r, pay FROM l
      UNION ALL SELECT id, m + 1,
        CASE WHEN left_ + (2 * left_ * r + 120000) // 240000 <= pay THEN 0 ELSE left_ - (pay - (2 * left_ * r + 120000) // 240000) END,
        (2 * left_ * r + 120000) // 240000,
        CASE WHEN left_ + (2 * left_ * r + 120000) // 240000 <= pay THEN left_ + (2 * left_ * r + 120000) // 240000 ELSE pay END, r, pay
      FROM s WHERE left_ > 0 AND m < 1000)
    SELECT id AS loan_id, max(m)::INTEGER AS months, sum(interest)::BIGINT AS total_interest, sum(paid)::BIGINT AS total_paid, arg_max(left_, m)::BIGINT AS remaining
    FROM s WHERE m > 0 GROUP BY id""",
)
def loan_schedule(t):
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    payment = F.when(k % 500 == 0, 1).otherwise(F.expr("CAST(round(o_totalprice * 100) AS BIGINT) div (o_orderkey % 40 + 6)") + 5000)
    book = t.spread("orders").select(
        k.alias("loan_id"), cents.alias("principal"), ((k % 9 + 3) * 100).alias("rate_bp"), payment.cast("bigint").alias("payment")
    )
    return loans.loan_schedule(book).groupBy("loan_id").agg(
        F.max("month").alias("months"),
        F.sum("interest").alias("total_interest"),
        F.sum("paid").alias("total_paid"),
        F.max_by("remaining", "month").alias("remaining"),
    )
