"""Profiles of the input tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import profile, quantiles
from ..plans.spec import ColumnSpec, TableSpec
from .registry import query


@query(
    "value_counts_event_type",
    "A6",
    """
    SELECT event_type, count(*) AS count,
           count(*)::DOUBLE / (SELECT count(event_type) FROM events) * 100 AS percentage
    FROM events WHERE event_type IS NOT NULL GROUP BY event_type
    """,
)
def value_counts_event_type(t):
    return profile.value_counts(t.events, "event_type")


@query(
    "missing_stats_orders",
    "A5",
    """
    WITH o AS (
      SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus,
             nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_totalprice FROM orders),
    n AS (SELECT count(*) AS n FROM o)
    SELECT column_name, missing_count, missing_count::DOUBLE / n * 100 AS percentage FROM (
      SELECT 'o_orderkey' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS missing_count FROM o
      UNION ALL SELECT 'o_orderstatus', count(*) FILTER (o_orderstatus IS NULL) FROM o
      UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority IS NULL) FROM o
      UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_totalprice IS NULL) FROM o), n
    """,
)
def missing_stats_orders(t):
    dirty = t.orders.select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("o_orderstatus"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
        "o_totalprice",
    )
    return profile.missing_stats(dirty)


@query(
    "record_and_null_counts",
    "S12 A3",
    """
    SELECT (SELECT count(*) FROM orders) AS record_count,
           (SELECT count(*) FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL) AS null_count,
           (SELECT count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)) AS priorities
    """,
)
def record_and_null_counts(t):
    dirty = t.orders.select(F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    nulls = profile.null_count(dirty, "status").scalar()
    kinds = t.orders.select("o_orderpriority").distinct().agg(F.count("*")).scalar()
    return profile.record_count(t.orders).select(
        "record_count", nulls.alias("null_count"), kinds.alias("priorities")
    )


@query(
    "ranges_lineitem",
    "A7",
    """
    SELECT 'l_quantity' AS column_name, min(l_quantity) AS min_value, max(l_quantity) AS max_value,
           max(l_quantity) - min(l_quantity) AS extent FROM lineitem
    UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice),
           max(l_extendedprice) - min(l_extendedprice) FROM lineitem
    UNION ALL SELECT 'l_linenumber', min(l_linenumber)::DOUBLE, max(l_linenumber)::DOUBLE,
           (max(l_linenumber) - min(l_linenumber))::DOUBLE FROM lineitem
    """,
)
def ranges_lineitem(t):
    return profile.value_ranges(t.lineitem, ["l_quantity", "l_extendedprice", "l_linenumber"])


@query(
    "extrema_flags_customer",
    "A7",
    """
    SELECT c_custkey, c_acctbal,
           c_acctbal = (SELECT min(c_acctbal) FROM customer) AS c_acctbal_is_min,
           c_acctbal = (SELECT max(c_acctbal) FROM customer) AS c_acctbal_is_max
    FROM customer
    """,
)
def extrema_flags_customer(t):
    return profile.flag_extrema(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"])


@query(
    "null_mean_events",
    "A4",
    """
    SELECT event_type, count(v) AS present, avg(v)::DECIMAL(18,6)::VARCHAR AS mean_value
    FROM (SELECT event_type, CASE WHEN value > 0 THEN value::DECIMAL(18,2) END AS v FROM events)
    GROUP BY event_type
    """,
)
def null_mean_events(t):
    v = F.when(F.col("value") > 0, F.col("value").cast("decimal(18,2)"))
    return t.events.groupBy("event_type").agg(
        F.count(v).alias("present"), F.avg(v).cast("decimal(18,6)").cast("string").alias("mean_value")
    )


@query(
    "type_profile_event_props",
    "A8",
    """
    SELECT k AS member,
           CASE json_type(v) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(v) END
             AS value_type,
           count(*) AS occurrences, min(length(v::VARCHAR))::INTEGER AS min_size,
           max(length(v::VARCHAR))::INTEGER AS max_size
    FROM (SELECT k, json_extract(props, '$.' || k) AS v
          FROM (SELECT props, unnest(json_keys(props)) AS k FROM events))
    GROUP BY 1, 2
    """,
)
def type_profile_event_props(t):
    return profile.member_types(t.events, "props")


_DIRTY_CUSTOMER = """
    SELECT c_custkey,
      CASE WHEN c_custkey % 7 = 0 THEN 'n/a' WHEN c_custkey % 11 = 0 THEN NULL
           ELSE c_acctbal::DECIMAL(18,2)::VARCHAR END AS balance,
      CASE WHEN c_custkey % 5 = 0 THEN c_nationkey || ', x' ELSE c_nationkey || ', ' || c_custkey END AS codes,
      CASE WHEN c_custkey % 3 = 0 THEN 'true' WHEN c_custkey % 3 = 1 THEN 'maybe' ELSE 'false' END AS flag
    FROM customer"""


def dirty_customer(t):
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.when(key % 7 == 0, "n/a")
        .when(key % 11 == 0, F.lit(None))
        .otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
        .alias("balance"),
        F.when(key % 5 == 0, F.concat("c_nationkey", F.lit(", x")))
        .otherwise(F.concat("c_nationkey", F.lit(", "), key))
        .alias("codes"),
        F.when(key % 3 == 0, "true").when(key % 3 == 1, "maybe").otherwise("false").alias("flag"),
    )


@query(
    "conform_report_customer",
    "P22",
    f"""
    WITH d AS ({_DIRTY_CUSTOMER})
    SELECT column_name, expected_type, checked, mismatched, mismatched = 0 AS conforms FROM (
      SELECT 'c_custkey' AS column_name, 'bigint' AS expected_type, count(*) AS checked, 0::BIGINT AS mismatched FROM d
      UNION ALL SELECT 'balance', 'decimal(18,2)', count(*),
        count(*) FILTER (balance IS NOT NULL AND try_cast(balance AS DECIMAL(18,2)) IS NULL) FROM d
      UNION ALL SELECT 'codes', 'array<bigint>', count(*),
        count(*) FILTER (len(list_filter(string_split(codes, ','), lambda x: try_cast(trim(x) AS BIGINT) IS NULL)) > 0) FROM d
      UNION ALL SELECT 'flag', 'boolean', count(*),
        count(*) FILTER (flag IS NOT NULL AND try_cast(flag AS BOOLEAN) IS NULL) FROM d)
    """,
)
def conform_report_customer(t):
    return profile.conform_report(
        dirty_customer(t),
        {"c_custkey": "bigint", "balance": "decimal(18,2)", "codes": "array<bigint>", "flag": "boolean"},
    )


@query(
    "narrow_types_part",
    "P20",
    """
    WITH b AS (SELECT min(p_partkey) a, max(p_partkey) b, min(p_size) c, max(p_size) d,
                      min(p_retailprice) e, max(p_retailprice) f FROM part)
    SELECT 'p_partkey' AS column_name, 'bigint' AS old_type,
      CASE WHEN a > -128 AND b < 127 THEN 'tinyint' WHEN a > -32768 AND b < 32767 THEN 'smallint'
           WHEN a > -2147483648 AND b < 2147483647 THEN 'int' ELSE 'bigint' END AS new_type,
      a::DOUBLE AS min_value, b::DOUBLE AS max_value FROM b
    UNION ALL SELECT 'p_size', 'int',
      CASE WHEN c > -128 AND d < 127 THEN 'tinyint' WHEN c > -32768 AND d < 32767 THEN 'smallint' ELSE 'int' END,
      c::DOUBLE, d::DOUBLE FROM b
    UNION ALL SELECT 'p_retailprice', 'double', 'float', e, f FROM b
    """,
)
def narrow_types_part(t):
    return profile.narrowing_report(t.part)


@query(
    "narrowed_part_values",
    "P20",
    """SELECT p_partkey::BIGINT AS p_partkey, p_size::INTEGER AS p_size,
              round(p_retailprice::FLOAT::DOUBLE, 1) AS price FROM part""",
)
def narrowed_part_values(t):
    slim = profile.narrow_types(t.part.select("p_partkey", "p_size", "p_retailprice"))
    return slim.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        F.col("p_size").cast("int").alias("p_size"),
        F.round(F.col("p_retailprice").cast("double"), 1).alias("price"),
    )


@query(
    "iqr_outliers_events",
    "P19",
    """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events),
    k AS (SELECT event_id, user_id, value FROM events, q
          WHERE value BETWEEN a - 1.5::DOUBLE * (b - a) AND b + 1.5::DOUBLE * (b - a)),
    r AS (SELECT quantile_cont(user_id::DOUBLE, 0.25) AS a, quantile_cont(user_id::DOUBLE, 0.75) AS b FROM k)
    SELECT event_id, user_id, value FROM k, r
    WHERE user_id BETWEEN a - 1.5::DOUBLE * (b - a) AND b + 1.5::DOUBLE * (b - a)
    """,
)
def iqr_outliers_events(t):
    return quantiles.remove_outliers(t.events.select("event_id", "user_id", "value"), ["value", "user_id"])


@query(
    "describe_tables",
    "M21",
    """
    SELECT 'region' AS table_name, 'r_regionkey' AS column_name, 1 AS column_id, 'int' AS data_type,
      true AS primary_key, count(*) AS row_count, count(*) - count(r_regionkey) AS null_count,
      count(*) = count(DISTINCT r_regionkey) AS key_is_unique FROM region
    UNION ALL SELECT 'region', 'r_name', 2, 'string', false, count(*), count(*) - count(r_name), NULL FROM region
    UNION ALL SELECT 'customer', 'c_custkey', 1, 'bigint', true, count(*), count(*) - count(c_custkey),
      count(*) = count(DISTINCT c_custkey) FROM customer
    UNION ALL SELECT 'customer', 'c_name', 2, 'string', false, count(*), count(*) - count(c_name), NULL FROM customer
    UNION ALL SELECT 'customer', 'c_nationkey', 3, 'int', false, count(*), count(*) - count(c_nationkey), NULL FROM customer
    UNION ALL SELECT 'customer', 'c_acctbal', 4, 'double', false, count(*), count(*) - count(c_acctbal), NULL FROM customer
    UNION ALL SELECT 'customer', 'c_mktsegment', 5, 'string', false, count(*), count(*) - count(c_mktsegment), NULL FROM customer
    UNION ALL SELECT 'lineitem', 'l_orderkey', 1, 'bigint', true, count(*), count(*) - count(l_orderkey),
      count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_linenumber', 2, 'int', true, count(*), count(*) - count(l_linenumber),
      count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    """,
)
def describe_tables(t):
    parts = [
        profile.describe_frame(t.region, "region", ["r_regionkey"]),
        profile.describe_frame(t.customer, "customer", ["c_custkey"]),
        profile.describe_frame(
            t.lineitem.select("l_orderkey", "l_linenumber"), "lineitem", ["l_orderkey", "l_linenumber"]
        ),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "assert_one_order",
    "A16",
    """SELECT 'order 7 present once' AS expectation, count(*) FILTER (o_orderkey = 7) AS observed,
              1::BIGINT AS expected,
              CASE WHEN count(*) FILTER (o_orderkey = 7) = 1 THEN 'SUCCESS' ELSE 'FAIL' END AS outcome FROM orders""",
)
def assert_one_order(t):
    return profile.expect_count(t.orders, F.col("o_orderkey") == 7, 1, "order 7 present once")


@query(
    "quantiles_with_infinities",
    "P19",
    """
    WITH v AS (SELECT CASE WHEN l_linenumber = 7 THEN 'Infinity'::DOUBLE WHEN l_linenumber = 6 AND l_quantity < 3 THEN '-Infinity'::DOUBLE
                      ELSE l_extendedprice END AS v FROM lineitem),
    k AS (SELECT list(v ORDER BY v) AS vs, count(*) AS n FROM v)
    SELECT vs[1] AS low, vs[((n - 1) // 2 + 1)::INTEGER] / 2 + vs[(n // 2 + 1)::INTEGER] / 2 AS middle, vs[n::INTEGER] AS high FROM k""",
)
def quantiles_with_infinities(t):
    odd = F.when(F.col("l_linenumber") == 7, float("inf")).when((F.col("l_linenumber") == 6) & (F.col("l_quantity") < 3), float("-inf"))
    values = t.lineitem.select(odd.otherwise(F.col("l_extendedprice")).alias("v"))
    low, middle, high = quantiles.exact_quantiles(values, "v", [0.0, 0.5, 1.0])
    return t.spark.range(1).select(F.lit(low).alias("low"), F.lit(middle).alias("middle"), F.lit(high).alias("high"))


_NESTED = """
    SELECT c_custkey, '{"a":' || c_nationkey || ',"b":' || CASE WHEN c_custkey % 13 = 0 THEN '"x"' ELSE '2' END || '}' AS members,
           '[' || c_custkey || ',"' || CASE WHEN c_custkey % 17 = 0 THEN 'no date' ELSE '2024-01-02' END || '"' || CASE WHEN c_custkey % 19 = 0 THEN ',1' ELSE '' END || ']' AS pair,
           CASE WHEN c_custkey % 7 = 0 THEN 'true' WHEN c_custkey % 11 = 0 THEN 'neither' ELSE c_custkey::VARCHAR END AS either,
           '[[1,' || c_custkey || '],[' || CASE WHEN c_custkey % 23 = 0 THEN '"q"' ELSE '3' END || ']]' AS nested FROM customer"""


@query(
    "conform_report_nested",
    "P22",
    f"""
    WITH d AS ({_NESTED}), n AS (SELECT count(*) AS checked, count_if(c_custkey % 13 = 0) AS a, count_if(c_custkey % 17 = 0 OR c_custkey % 19 = 0) AS b,
      count_if(c_custkey % 11 = 0 AND c_custkey % 7 > 0) AS c, count_if(c_custkey % 23 = 0) AS e FROM d)
    SELECT column_name, expected_type, checked, mismatched, mismatched = 0 AS conforms FROM (
      SELECT 'members' AS column_name, 'map<string,int>' AS expected_type, checked, a AS mismatched FROM n
      UNION ALL SELECT 'pair', 'tuple<bigint, date>', checked, b FROM n
      UNION ALL SELECT 'either', 'bigint | boolean', checked, c FROM n
      UNION ALL SELECT 'nested', 'array<array<int>>', checked, e FROM n)""",
)
def conform_report_nested(t):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    last = F.when(k % 13 == 0, '"x"').otherwise("2")
    day = F.when(k % 17 == 0, "no date").otherwise("2024-01-02")
    rows = t.customer.select(
        F.concat(F.lit('{"a":'), n, F.lit(',"b":'), last, F.lit("}")).alias("members"),
        F.concat(F.lit("["), k, F.lit(',"'), day, F.lit('"'), F.when(k % 19 == 0, ",1").otherwise(""), F.lit("]")).alias("pair"),
        F.when(k % 7 == 0, "true").when(k % 11 == 0, "neither").otherwise(k.cast("string")).alias("either"),
        F.concat(F.lit("[[1,"), k, F.lit("],["), F.when(k % 23 == 0, '"q"').otherwise("3"), F.lit("]]")).alias("nested"),
    )
    expected = {"members": "map<string,int>", "pair": "tuple<bigint, date>", "either": "bigint | boolean", "nested": "array<array<int>>"}
    return profile.conform_report(rows, expected)


@query(
    "describe_declared",
    "M21",
    """
    SELECT column_name, column_id, logical_type, d.primary_key, indexed, nullable, foreign_key, default_value, max_length, null_count FROM (VALUES
      ('o_orderkey', 1, 'integer', true, true, false, NULL, NULL, NULL), ('o_custkey', 2, 'integer', false, true, false, 'customer.c_custkey', NULL, NULL),
      ('o_orderstatus', 3, 'string', false, false, true, NULL, 'O', 1))
      d(column_name, column_id, logical_type, primary_key, indexed, nullable, foreign_key, default_value, max_length)
    JOIN (SELECT 'o_orderkey' AS c, count(*) - count(o_orderkey) AS null_count FROM orders UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM orders
          UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM orders) ON c = column_name""",
)
def describe_declared(t):
    spec = TableSpec(
        "orders",
        (
            ColumnSpec("o_orderkey", "integer", primary_key=True),
            ColumnSpec("o_custkey", "integer", nullable=False, references="customer.c_custkey", indexed=True),
            ColumnSpec("o_orderstatus", default="O", max_length=1),
        ),
    )
    seen = profile.describe_frame(t.orders.select(*spec.names), "orders", ["o_orderkey"]).select("column_name", "null_count")
    return profile.describe_declared(t.spark, spec).join(seen, "column_name").drop("table_name", "allowed")
