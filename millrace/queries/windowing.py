"""Group counts, ordinals, last rows, numbering, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups, joins, numbering
from .registry import query


@query(
    "count_over_group",
    "W1",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, count(*) OVER (PARTITION BY l_returnflag, l_suppkey) AS members FROM lineitem""",
)
def count_over_group(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_suppkey")
    return joins.with_group_count(lines, ["l_returnflag", "l_suppkey"], "members").drop("l_suppkey")


@query(
    "latest_per_key",
    "W3",
    """SELECT user_id, event_type, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_per_key(t):
    last = groups.latest_per_key(t.events, ["user_id", "event_type"], ["ts", "event_id"])
    return last.select("user_id", "event_type", "event_id", "value")


@query(
    "previous_row",
    "W6",
    """
    WITH p AS (SELECT event_id, user_id, lag(user_id) OVER (ORDER BY event_id) AS previous FROM events)
    SELECT event_id, previous, CASE WHEN ('0x' || substring(md5('move' || event_id), 1, 15))::BIGINT % 10 < 2 AND previous IS NOT NULL
                      THEN previous ELSE user_id END AS owner
    FROM p WHERE NOT (('0x' || substring(md5('move' || event_id), 1, 15))::BIGINT % 10 < 2 AND previous IS NULL)""",
)
def previous_row(t):
    from ..plans.generate import choice

    rows = numbering.with_previous(t.events.select("event_id", "user_id"), ["event_id"], {"user_id": "previous"})
    moved = choice("move", F.col("event_id"), 10) < 2
    kept = rows.where(~(moved & F.col("previous").isNull()))
    owner = F.when(moved, F.col("previous")).otherwise(F.col("user_id"))
    return kept.select("event_id", "previous", owner.alias("owner"))


@query(
    "numbered_keys",
    "W7 F12",
    """SELECT o_orderkey, lpad((1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1)::VARCHAR, 9, '0') AS number FROM orders""",
)
def numbered_keys(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    numbered = numbering.number_rows(rows, ["o_orderdate", "o_orderkey"], "n", start=1000)
    return numbered.select("o_orderkey", F.lpad(F.col("n").cast("string"), 9, "0").alias("number"))


@query(
    "batch_ids",
    "S13",
    """SELECT batch_id, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM (
         SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS batch_id FROM orders) GROUP BY batch_id""",
)
def batch_ids(t):
    batches = numbering.batch_ids(t.orders.select("o_orderkey"), ["o_orderkey"], 4000)
    return batches.groupBy("batch_id").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "ordered_catalog",
    "T1 T4",
    "SELECT p_brand, p_type, p_partkey FROM part ORDER BY p_brand, p_type DESC, p_partkey",
)
def ordered_catalog(t):
    return t.part.select("p_brand", "p_type", "p_partkey").orderBy("p_brand", F.desc("p_type"), "p_partkey")


@query("first_n", "T2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500")
def first_n(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").limit(500).select("o_orderkey", "o_totalprice")


@query(
    "top_orders",
    "T3",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_orders(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "union_columns",
    "U1 U4",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_columns(t):
    left = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    right = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "set_difference",
    "U3 U2",
    """SELECT DISTINCT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""",
)
def set_difference(t):
    buyers = t.orders.where("o_orderstatus = 'F'").select("o_custkey")
    return t.customer.select("c_custkey").subtract(buyers)
