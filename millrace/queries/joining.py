"""Joins over the order tables and catalogs derived from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups, joins
from ..session import work_folder
from .registry import query


@query(
    "join_renamed_key",
    "J1",
    """SELECT o_orderkey, o_totalprice, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_renamed_key(t):
    joined = joins.equi_join(t.orders, t.customer, [("o_custkey", "c_custkey")])
    return joined.select("o_orderkey", "o_totalprice", "o_custkey", "c_name")


@query(
    "composite_join",
    "J2",
    """
    SELECT l_returnflag, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(18,2) AS price FROM lineitem l
    JOIN (SELECT DISTINCT l_partkey AS pk, l_suppkey AS sk FROM lineitem WHERE l_quantity > 45) s
      ON l_partkey = pk AND l_suppkey = sk GROUP BY l_returnflag""",
)
def composite_join(t):
    pairs = t.lineitem.where("l_quantity > 45").select(
        F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk")
    ).distinct()
    joined = joins.equi_join(t.lineitem, pairs, [("l_partkey", "pk"), ("l_suppkey", "sk")])
    price = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)")
    return joined.groupBy("l_returnflag").agg(F.count("*").alias("n"), price.alias("price"))


@query(
    "safe_merge_report",
    "J3",
    """
    WITH l AS (SELECT nullif(l_suppkey, 3) AS k FROM lineitem), r AS (SELECT s_suppkey AS k FROM supplier WHERE s_acctbal > 0
               UNION ALL SELECT s_suppkey FROM supplier WHERE s_nationkey < 5),
    b AS (SELECT count(*) AS n FROM l)
    SELECT how, n AS rows_before, rows_after, rows_after - n AS change FROM b, (
      SELECT 'inner' AS how, count(*) AS rows_after FROM l JOIN r USING (k)
      UNION ALL SELECT 'left', count(*) FROM l LEFT JOIN r USING (k)
      UNION ALL SELECT 'right', count(*) FROM l RIGHT JOIN r USING (k)
      UNION ALL SELECT 'outer', count(*) FROM l FULL JOIN r USING (k))""",
)
def safe_merge_report(t):
    left = t.lineitem.select(F.nullif("l_suppkey", F.lit(3)).alias("k"))
    right = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("k")).unionAll(
        t.supplier.where("s_nationkey < 5").select("s_suppkey")
    )
    return joins.all_join_row_counts(left, right, ["k"])


@query(
    "safe_merge_observed",
    "J3 A14",
    """SELECT how, rows_before, rows_after, rows_after - rows_before AS change FROM (
         SELECT 'inner' AS how, (SELECT count(*) FROM orders) AS rows_before, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 > 0) AS rows_after
         UNION ALL SELECT 'outer', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders FULL JOIN (SELECT * FROM customer WHERE c_custkey % 3 > 0) ON o_custkey = c_custkey))""",
)
def safe_merge_observed(t):
    """Merged rows are written once; what they count comes from the same job."""
    left = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey")
    right = t.customer.where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("k"), "c_name")
    rows = []
    for how in ("inner", "outer"):
        merged, report = joins.observed_merge(left, right, ["k"], how)
        merged.write.parquet(work_folder(t.spark, "merged"))
        rows.append((how, *report().values()))
    return t.spark.createDataFrame(rows, "how string, rows_before long, rows_after long, change long")


@query(
    "safe_merge_rows",
    "J3",
    """SELECT o_custkey AS k, o_orderkey, c_name FROM orders FULL JOIN customer ON o_custkey = c_custkey
       WHERE o_custkey IS NOT NULL
       UNION ALL SELECT c_custkey, NULL, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def safe_merge_rows(t):
    left = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey")
    right = t.customer.select(F.col("c_custkey").alias("k"), "c_name")
    return joins.safe_merge(left, right, ["k"], "outer")[0]


# A catalog as large as the data: one constraint per order, one constraint column
# per order line, referencing a part.
_CONSTRAINTS = """
    SELECT o_orderkey, 'CK_' || o_orderkey AS constraint_name,
           CASE o_orderstatus WHEN 'F' THEN 'P' WHEN 'O' THEN 'R' ELSE 'C' END AS constraint_type,
           o_custkey AS owner FROM orders"""
_COLUMNS = """
    SELECT l_orderkey AS o_orderkey, 'C' || l_partkey AS column_name, l_linenumber AS position, l_partkey FROM lineitem"""


def constraints(t):
    kind = F.when(F.col("o_orderstatus") == "F", "P").when(F.col("o_orderstatus") == "O", "R").otherwise("C")
    return t.orders.select(
        "o_orderkey",
        F.concat(F.lit("CK_"), "o_orderkey").alias("constraint_name"),
        kind.alias("constraint_type"),
        F.col("o_custkey").alias("owner"),
    )


def constraint_columns(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat(F.lit("C"), "l_partkey").alias("column_name"),
        F.col("l_linenumber").alias("position"),
        "l_partkey",
    )


@query(
    "fk_catalog",
    "J4",
    f"""
    SELECT constraint_name, column_name, position, p_name AS referenced FROM ({_CONSTRAINTS})
    JOIN ({_COLUMNS}) USING (o_orderkey) LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey
    WHERE constraint_type = 'R'""",
)
def fk_catalog(t):
    refs = constraints(t).where("constraint_type = 'R'").join(constraint_columns(t), "o_orderkey")
    parts = t.part.where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("referenced"))
    return refs.join(parts, "l_partkey", "left").select("constraint_name", "column_name", "position", "referenced")


@query(
    "fk_self_join",
    "J5",
    f"""
    SELECT a.constraint_name, b.constraint_name AS referenced_name, c.column_name FROM ({_CONSTRAINTS}) a
    JOIN ({_CONSTRAINTS}) b ON a.owner = b.o_orderkey JOIN ({_COLUMNS}) c ON c.o_orderkey = b.o_orderkey
    WHERE a.constraint_type = 'R'""",
)
def fk_self_join(t):
    a = constraints(t).where("constraint_type = 'R'").select("constraint_name", "owner")
    b = constraints(t).select(F.col("o_orderkey").alias("owner"), F.col("constraint_name").alias("referenced_name"))
    c = constraint_columns(t).select(F.col("o_orderkey").alias("owner"), "column_name")
    return a.join(b, "owner").join(c, "owner").select("constraint_name", "referenced_name", "column_name")


@query(
    "fk_by_position",
    "J6",
    f"""
    SELECT f.column_name AS fk_column, p.column_name AS pk_column, f.position, f.o_orderkey AS fk, p.o_orderkey AS pk
    FROM ({_COLUMNS}) f JOIN orders o ON o.o_orderkey = f.o_orderkey
    JOIN ({_COLUMNS}) p ON p.o_orderkey = o.o_custkey AND p.position = f.position""",
)
def fk_by_position(t):
    f = constraint_columns(t).select(F.col("o_orderkey").alias("fk"), F.col("column_name").alias("fk_column"), "position")
    o = t.orders.select(F.col("o_orderkey").alias("fk"), F.col("o_custkey").alias("pk"))
    p = constraint_columns(t).select(F.col("o_orderkey").alias("pk"), F.col("column_name").alias("pk_column"), "position")
    return f.join(o, "fk").join(p, ["pk", "position"]).select("fk_column", "pk_column", "position", "fk", "pk")


@query(
    "index_columns",
    "J7",
    f"""
    SELECT 'IX_' || o_orderkey AS index_name, column_name, o_orderpriority = '1-URGENT' AS is_unique
    FROM orders JOIN ({_COLUMNS}) USING (o_orderkey)
    WHERE o_orderstatus <> 'P' AND column_name NOT LIKE 'C1%'""",
)
def index_columns(t):
    # Large-object indexes (status P here) and generated columns (C1...) are left out.
    indexes = t.orders.where("o_orderstatus <> 'P'").select(
        "o_orderkey",
        F.concat(F.lit("IX_"), "o_orderkey").alias("index_name"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_unique"),
    )
    columns = constraint_columns(t).where(~F.col("column_name").startswith("C1"))
    return indexes.join(columns, "o_orderkey").select("index_name", "column_name", "is_unique")


@query(
    "unique_rollup",
    "A15",
    f"""
    SELECT column_name, bool_or(is_unique) AS is_unique FROM (
      SELECT column_name, o_orderpriority = '1-URGENT' AS is_unique FROM orders JOIN ({_COLUMNS}) USING (o_orderkey))
    GROUP BY column_name""",
)
def unique_rollup(t):
    indexes = t.orders.select("o_orderkey", (F.col("o_orderpriority") == "1-URGENT").alias("u"))
    joined = indexes.join(constraint_columns(t), "o_orderkey")
    return joined.groupBy("column_name").agg(F.bool_or("u").alias("is_unique"))


@query(
    "word_pattern_candidates",
    "J8 J9 U2",
    """
    WITH a AS (SELECT DISTINCT lower(r_name) AS w FROM region),
    b AS (SELECT DISTINCT lower(replace(p_brand, '#', '')) AS w FROM part),
    c AS (SELECT DISTINCT lower(c_mktsegment) AS w FROM customer),
    p AS (SELECT a.w || b.w AS d FROM a, b UNION SELECT b.w || b2.w FROM b, b b2
          UNION SELECT a.w || b.w || c.w FROM a, b, c)
    SELECT d || '.com' AS candidate FROM p
    WHERE d || '.com' NOT IN (SELECT lower(r_name) || 'brand' || n_nationkey || '.com' FROM region JOIN nation ON n_regionkey = r_regionkey)""",
)
def word_pattern_candidates(t):
    lists = {
        "first": t.region.select("r_name"),
        "root": t.part.select(F.replace("p_brand", F.lit("#"), F.lit(""))),
        "second": t.customer.select("c_mktsegment"),
    }
    patterns = [("first", "root"), ("root", "root"), ("first", "root", "second")]
    candidates = joins.word_patterns(lists, patterns, ".com")
    history = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat("r_name", F.lit("Brand"), "n_nationkey", F.lit(".COM")).alias("seen")
    )
    return joins.not_in_history(candidates, "candidate", history, "seen")


@query(
    "semi_filter",
    "J10",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def semi_filter(t):
    wanted = t.customer.where("c_mktsegment = 'BUILDING'")
    return joins.equi_join(t.orders, wanted, [("o_custkey", "c_custkey")], "left_semi").select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "manager_reports",
    "J11 A9 A11 JS9",
    """
    WITH e AS (SELECT c_custkey AS id, c_name AS name, c_custkey // 10 AS manager_id FROM customer WHERE c_custkey <> 0)
    SELECT m.id AS manager_id, json_object('manager_id', m.id, 'manager', m.name, 'report_count', count(*),
           'reports', to_json(list(r.id ORDER BY r.id)))::VARCHAR AS doc
    FROM (SELECT c_custkey AS id, c_name AS name FROM customer) m JOIN e r ON r.manager_id = m.id
    GROUP BY m.id, m.name HAVING count(*) > 6""",
)
def manager_reports(t):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    # Each person reports to the one numbered a tenth of theirs, so a manager has at most ten.
    reports = people.where("id <> 0").select(F.floor(F.col("id") / 10).alias("manager_id"), F.col("id").alias("report"))
    lists = groups.json_array_agg(reports, ["manager_id"], F.col("report"), ["report"], "reports")
    sizes = reports.groupBy("manager_id").agg(F.count("*").alias("report_count")).where("report_count > 6")
    doc = F.to_json(
        F.struct(
            "manager_id", F.col("name").alias("manager"), "report_count",
            F.from_json("reports", "array<bigint>").alias("reports"),
        )
    )
    return (
        people.withColumnRenamed("id", "manager_id").join(sizes, "manager_id").join(lists, "manager_id")
        .select("manager_id", doc.alias("doc"))
    )


@query(
    "snapshot_diff_customer",
    "J14",
    """
    WITH o AS (SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey AS n FROM customer WHERE c_custkey % 10 <> 9),
    n AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
            CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
            CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS n FROM customer WHERE c_custkey % 10 <> 8),
    j AS (SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
            CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
            o.c_acctbal AS a1, n.c_acctbal AS a2, o.c_mktsegment AS m1, n.c_mktsegment AS m2, o.n AS n1, n.n AS n2
          FROM o FULL JOIN n ON o.c_custkey = n.c_custkey)
    SELECT c_custkey, change, 'c_acctbal' AS field, a1::DECIMAL(18,2)::VARCHAR AS old_value, a2::DECIMAL(18,2)::VARCHAR AS new_value
      FROM j WHERE a1 IS DISTINCT FROM a2
    UNION ALL SELECT c_custkey, change, 'c_mktsegment', m1, m2 FROM j WHERE m1 IS DISTINCT FROM m2
    UNION ALL SELECT c_custkey, change, 'home.nation', n1::VARCHAR, n2::VARCHAR FROM j WHERE n1 IS DISTINCT FROM n2""",
)
def snapshot_diff_customer(t):
    k = F.col("c_custkey")
    balance = F.col("c_acctbal").cast("decimal(18,2)")

    def shape(df, balance, segment, nation):
        return df.select(
            k, balance.cast("decimal(18,2)").alias("c_acctbal"), segment.alias("c_mktsegment"),
            F.struct(nation.alias("nation")).alias("home"),
        )

    old = shape(t.customer.where(k % 10 != 9), balance, F.col("c_mktsegment"), F.col("c_nationkey"))
    new = shape(
        t.customer.where(k % 10 != 8),
        F.when(k % 4 == 0, balance + 1).otherwise(balance),
        F.when(k % 6 != 0, F.col("c_mktsegment")),
        F.when(k % 5 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")),
    )
    return joins.snapshot_diff(old, new, ["c_custkey"])
