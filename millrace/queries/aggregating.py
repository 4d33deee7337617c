"""Aggregates that build lists, documents and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups, joins
from .registry import query


@query(
    "composite_key_report",
    "A1 A2 W1",
    """
    SELECT l_orderkey, string_agg('P' || l_partkey, ' ' ORDER BY l_linenumber, 'P' || l_partkey) AS columns,
           count(*) AS column_count, CASE WHEN count(*) > 1 THEN 'YES' ELSE 'NO' END AS composite
    FROM lineitem GROUP BY l_orderkey""",
)
def composite_key_report(t):
    columns = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("P"), "l_partkey").alias("column"))
    lists = groups.ordered_list(
        columns, ["l_orderkey"], "column", ["l_linenumber", "column"], " ", "columns", count="column_count"
    )
    return lists.withColumn("composite", F.when(F.col("column_count") > 1, "YES").otherwise("NO"))


@query(
    "distinct_owners",
    "A3",
    "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
)
def distinct_owners(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query(
    "nested_region_json",
    "J12 A9 JS9 JS10",
    """
    WITH s AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer),
    c AS (SELECT n_nationkey, n_name, n_regionkey, (SELECT to_json(list(c_mktsegment ORDER BY c_mktsegment))
            FROM s WHERE c_nationkey = n_nationkey) AS segs FROM nation)
    SELECT r_name AS region, '{"region":"' || r_name || '","countries":[' ||
      string_agg(json_object('code', n_nationkey, 'name', n_name, 'segments', segs)::VARCHAR, ',' ORDER BY n_name) || ']}' AS doc
    FROM region JOIN c ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def nested_region_json(t):
    segments = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    by_nation = groups.json_array_agg(
        segments, ["c_nationkey"], F.col("c_mktsegment"), ["c_mktsegment"], "segments"
    )
    nations = t.nation.join(by_nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    country = F.struct(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"),
        F.from_json("segments", "array<string>").alias("segments"),
    )
    by_region = groups.json_array_agg(nations, ["n_regionkey"], country, ["n_name"], "countries")
    doc = F.concat(F.lit('{"region":"'), "r_name", F.lit('","countries":'), "countries", F.lit("}"))
    return t.region.join(by_region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("region"), doc.alias("doc")
    )


@query(
    "arrayagg_nulls",
    "A9",
    """
    SELECT o_custkey, '[' || string_agg(coalesce('"' || nullif(o_orderstatus, 'F') || '"', 'null'), ',' ORDER BY o_orderkey) || ']' AS with_nulls
    FROM orders GROUP BY o_custkey""",
)
def arrayagg_nulls(t):
    orders = t.orders.select("o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("s"))
    return groups.json_array_agg(
        orders, ["o_custkey"], F.col("s"), ["o_orderkey"], "with_nulls", null_on_null=True
    )


@query(
    "objectagg_nations",
    "A10",
    """
    SELECT r_name, '{' || string_agg('"' || n_name || '":' || n, ',' ORDER BY n_name) || '}' AS object FROM (
      SELECT n_regionkey, n_name, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2)
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def objectagg_nations(t):
    sizes = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    named = (
        sizes.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return groups.json_object_agg(named, ["r_name"], "n_name", "n", unique_keys=True)


@query(
    "having_count",
    "A11",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) > 600",
)
def having_count(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).where("n > 600")


@query(
    "order_totals",
    "A12",
    """SELECT l_orderkey, sum(l_quantity)::DECIMAL(18,2)::VARCHAR AS total_quantity,
              sum(l_quantity::DECIMAL(10,2) * l_extendedprice::DECIMAL(14,2))::DECIMAL(30,4)::VARCHAR AS total_amount
       FROM lineitem GROUP BY l_orderkey""",
)
def order_totals(t):
    quantity = F.col("l_quantity").cast("decimal(10,2)")
    amount = quantity * F.col("l_extendedprice").cast("decimal(14,2)")
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sum(quantity).cast("decimal(18,2)").cast("string").alias("total_quantity"),
        F.sum(amount).cast("decimal(30,4)").cast("string").alias("total_amount"),
    )


@query(
    "duplicate_documents",
    "A13",
    """SELECT digest, doc_id, copies FROM (
         SELECT md5(text) AS digest, doc_id, count(*) OVER (PARTITION BY md5(text)) AS copies FROM documents) WHERE copies > 1""",
)
def duplicate_documents(t):
    digests = t.documents.select("doc_id", F.md5("text").alias("digest"))
    return joins.with_group_count(digests, ["digest"], "copies").where("copies > 1")


@query(
    "load_totals",
    "A14",
    """
    SELECT o_orderpriority AS chunk, count(*) FILTER (o_orderstatus <> 'P') AS processed,
           count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) AS total FROM orders GROUP BY 1
    UNION ALL SELECT 'ALL', count(*) FILTER (o_orderstatus <> 'P'), count(*) FILTER (o_orderstatus = 'P'), count(*) FROM orders""",
)
def load_totals(t):
    chunks = t.orders.groupBy(F.col("o_orderpriority").alias("chunk")).agg(
        F.count_if(F.col("o_orderstatus") != "P").alias("processed"),
        F.count_if(F.col("o_orderstatus") == "P").alias("failed"),
        F.count("*").alias("total"),
    )
    every = chunks.agg(
        F.lit("ALL").alias("chunk"),
        *[F.sum(c).alias(c) for c in ("processed", "failed", "total")],
    )
    return chunks.unionByName(every)
