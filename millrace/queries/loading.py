"""Loads, validation, alignment, staging and migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import align, load, migrate, staging
from ..plans.spec import ColumnSpec, TableSpec
from ..session import compute_once, spread_in_order, work_folder
from ..sources import publish
from .registry import query

AT = "2024-05-01 10:00:00"


def at():
    return F.lit(AT).cast("timestamp_ntz")


_DELTA = """
    SELECT o_orderkey + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 10000000 END AS o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'X' END AS o_orderstatus, 1 AS seq FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, o_custkey + 1, 'Y', 2 FROM orders WHERE o_orderkey % 6 = 0
    UNION ALL SELECT NULL, o_custkey, 'N', 3 FROM orders WHERE o_orderkey % 10 = 0"""


def order_delta(t):
    k = F.col("o_orderkey")
    a = t.orders.where(k % 3 == 0).select(
        (k + F.when(k % 2 == 0, 0).otherwise(10000000)).alias("o_orderkey"),
        "o_custkey",
        F.when(k % 9 != 0, "X").alias("o_orderstatus"),
        F.lit(1).alias("seq"),
    )
    b = t.orders.where(k % 6 == 0).select(k, F.col("o_custkey") + 1, F.lit("Y"), F.lit(2))
    c = t.orders.where(k % 10 == 0).select(F.lit(None).cast("bigint"), "o_custkey", F.lit("N"), F.lit(3))
    return a.unionAll(b).unionAll(c)


def order_target(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


_TARGET = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"


@query(
    "insert_orders",
    "M1",
    f"{_TARGET} UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, NULL FROM ({_DELTA})",
)
def insert_orders(t):
    return load.load(order_target(t), order_delta(t).drop("seq"), "insert")


_LAST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn FROM ({_DELTA})
            WHERE o_orderkey IS NOT NULL) WHERE rn = 1"""


@query(
    "upsert_orders",
    "M2",
    f"""
    WITH s AS ({_LAST}), t AS ({_TARGET})
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
           CASE WHEN rn = 1 THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
           CASE WHEN rn = 1 THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus, o_orderpriority
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
    UNION ALL SELECT NULL, o_custkey, o_orderstatus, NULL FROM ({_DELTA}) WHERE o_orderkey IS NULL""",
)
def upsert_orders(t):
    return load.load(order_target(t), order_delta(t), "upsert", ["o_orderkey"], ["seq"])


@query(
    "update_orders",
    "M3",
    f"""
    WITH s AS ({_LAST}), t AS ({_TARGET})
    SELECT t.o_orderkey, CASE WHEN rn = 1 THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
           CASE WHEN rn = 1 THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus, o_orderpriority
    FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey""",
)
def update_orders(t):
    return load.load(order_target(t), order_delta(t), "update", ["o_orderkey"], ["seq"])


@query(
    "reset_orders",
    "M4",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, NULL::VARCHAR AS o_orderpriority FROM ({_DELTA})",
)
def reset_orders(t):
    return load.load(order_target(t), order_delta(t), "reset")


@query(
    "delete_orders",
    "M5",
    f"SELECT * FROM ({_TARGET}) WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)",
)
def delete_orders(t):
    ids = t.lineitem.where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return load.delete(order_target(t), ids, "o_orderkey")


PART_SPEC = TableSpec(
    "part",
    (
        ColumnSpec("p_partkey", "integer", primary_key=True, nullable=False),
        ColumnSpec("p_name", "string", max_length=11, nullable=False),
        ColumnSpec("p_brand", "string", enum_values=tuple(f"Brand#{i}" for i in range(1, 21))),
        ColumnSpec("p_code", "string", unique=True),
        ColumnSpec("p_type", "string", enum_values=("PROMO", "SMALL", "LARGE"), enforced=False),
        ColumnSpec("p_nation", "integer", references="nation.n_nationkey"),
    ),
)

_PARTS = """
    SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS p_name, p_brand,
           CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'same' ELSE 'c' || p_partkey END AS p_code,
           p_type, (p_size % 30)::BIGINT AS p_nation FROM part"""


def dirty_parts(t):
    k = F.col("p_partkey")
    return t.part.select(
        k,
        F.when(k % 13 != 0, F.col("p_name")).alias("p_name"),
        "p_brand",
        F.when(k % 17 == 0, F.lit(None)).when(k % 5 == 0, "same").otherwise(F.concat(F.lit("c"), k)).alias("p_code"),
        "p_type",
        (F.col("p_size") % 30).cast("bigint").alias("p_nation"),
    )


_VALIDATED = f"""
    SELECT p_partkey, p_nation, nullif(concat_ws('; ',
        CASE WHEN p_name IS NULL THEN 'p_name is null' END,
        CASE WHEN length(p_name) > 11 THEN 'p_name is longer than 11' END,
        CASE WHEN p_brand NOT IN ({", ".join(f"'Brand#{i}'" for i in range(1, 21))}) THEN 'p_brand is not an allowed value' END,
        CASE WHEN p_code IS NOT NULL AND count(*) OVER (PARTITION BY p_code) > 1 THEN 'p_code is repeated' END,
        CASE WHEN p_nation NOT IN (SELECT n_nationkey FROM nation) THEN 'p_nation has no parent' END), '') AS error_msg,
      CASE WHEN p_type NOT IN ('PROMO', 'SMALL', 'LARGE') THEN 'p_type is not an allowed value' END AS warning_msg
    FROM ({_PARTS})"""


def validated_parts(t):
    parents = {"p_nation": (t.nation.select(F.col("n_nationkey").cast("bigint").alias("n")), "n")}
    return load.validate(dirty_parts(t), PART_SPEC, parents)


@query("validate_rejects", "M10 M11", f"SELECT p_partkey, error_msg, warning_msg FROM ({_VALIDATED})")
def validate_rejects(t):
    return validated_parts(t).select("p_partkey", "error_msg", "warning_msg")


@query(
    "load_report",
    "M6 A14",
    f"""
    WITH v AS ({_VALIDATED}), d AS (SELECT p_nation FROM v GROUP BY 1 HAVING count(error_msg) > 50)
    SELECT 'failed' AS outcome, p_partkey, error_msg FROM v WHERE error_msg IS NOT NULL
    UNION ALL SELECT CASE WHEN p_nation IN (SELECT p_nation FROM d) THEN 'unprocessed' ELSE 'successful' END, p_partkey, NULL
      FROM v WHERE error_msg IS NULL""",
)
def load_report(t):
    sets = load.load_report(validated_parts(t), "p_nation", 50)
    out = None
    for name, rows in zip(("successful", "failed", "unprocessed"), sets):
        part = rows.select(F.lit(name).alias("outcome"), "p_partkey", "error_msg")
        out = part if out is None else out.unionByName(part)
    return out


_LONG = """
    SELECT c_custkey, repeat(c_name, CASE WHEN c_custkey % 50 = 0 THEN 300 ELSE c_custkey::INTEGER % 4 + 1 END) AS c_name,
           c_mktsegment FROM customer"""


def long_names(t):
    k = F.col("c_custkey")
    times = F.when(k % 50 == 0, 300).otherwise((k % 4 + 1).cast("int"))
    return t.customer.select(k, F.repeat("c_name", times).alias("c_name"), "c_mktsegment")


LENGTH_SPEC = TableSpec(
    "customer",
    (
        ColumnSpec("c_custkey", "integer", primary_key=True),
        ColumnSpec("c_name", "string", max_length=20),
        ColumnSpec("c_mktsegment", "string", max_length=40),
    ),
)


@query(
    "widen_lengths",
    "M8 M9",
    f"""
    WITH d AS ({_LONG}), g AS (SELECT * FROM d WHERE length(c_name) <= 4000)
    SELECT c_custkey, 'fits' AS outcome, length(c_name)::INTEGER AS length,
           (SELECT least(max(length(c_name)) + 50, 4000) FROM g)::INTEGER AS name_limit, 40 AS segment_limit FROM g
    UNION ALL SELECT c_custkey, 'rejected', length(c_name)::INTEGER, (SELECT least(max(length(c_name)) + 50, 4000) FROM g)::INTEGER, 40
    FROM d WHERE length(c_name) > 4000""",
)
def widen_lengths(t):
    good, rejected, spec = align.widen_on_overflow(long_names(t), LENGTH_SPEC)
    limits = {c.name: c.max_length for c in spec.columns}
    both = good.withColumn("outcome", F.lit("fits")).unionByName(rejected.withColumn("outcome", F.lit("rejected")))
    return both.select(
        "c_custkey", "outcome", F.length("c_name").alias("length"),
        F.lit(limits["c_name"]).alias("name_limit"), F.lit(limits["c_mktsegment"]).alias("segment_limit"),
    )


SOURCE_PART = TableSpec(
    "part",
    (
        ColumnSpec("p_partkey", "integer", primary_key=True, nullable=False),
        ColumnSpec("p_name", "string", max_length=5),
        ColumnSpec("p_brand", "string", nullable=False),
        ColumnSpec("p_type", "integer"),
        ColumnSpec("p_size", "integer"),
        ColumnSpec("p_retailprice", "float", precision=15, scale=2),
    ),
)
TARGET_PART = TableSpec(
    "part",
    (
        ColumnSpec("p_partkey", "integer", nullable=False),
        ColumnSpec("p_name", "string", max_length=12, nullable=False),
        ColumnSpec("p_brand", "string", max_length=200),
        ColumnSpec("p_type", "string", max_length=30),
        ColumnSpec("p_retailprice", "float"),
    ),
)


@query(
    "align_schema_report",
    "M7 M8",
    """
    WITH p AS (SELECT count(*) AS n, max(length(p_name)) AS ln, max(length(p_brand)) AS lb FROM part)
    SELECT 0 AS ordinal, 'p_partkey' AS column_name, n AS row_count, 0::BIGINT AS null_count, 0::BIGINT AS failed_casts,
           NULL::INTEGER AS declared_length, 'keep' AS action, true AS is_key FROM p
    UNION ALL SELECT 1, 'p_name', n, 0, 0, (ln + 50)::INTEGER, 'widen to ' || (ln + 50) || ', allow null', false FROM p
    UNION ALL SELECT 2, 'p_brand', n, 0, 0, (lb + 50)::INTEGER, 'forbid null', false FROM p
    UNION ALL SELECT 3, 'p_type', n, 0, n, NULL, 'change type to integer', false FROM p
    UNION ALL SELECT 4, 'p_size', n, 0, 0, NULL, 'add column', false FROM p
    UNION ALL SELECT 5, 'p_retailprice', n, 0, 0, NULL, 'keep', false FROM p""",
)
def align_schema_report(t):
    return align.schema_drift(t.part, SOURCE_PART, TARGET_PART)


@query(
    "align_frame",
    "M7",
    """SELECT p_partkey, p_name, try_cast(p_type AS BIGINT) AS p_type, p_retailprice::DECIMAL(15,2)::VARCHAR AS p_retailprice,
              NULL::DATE AS p_since FROM part""",
)
def align_frame(t):
    target = TableSpec(
        "part",
        (
            ColumnSpec("p_partkey", "integer"),
            ColumnSpec("p_name", "string"),
            ColumnSpec("p_type", "integer"),
            ColumnSpec("p_retailprice", "float", precision=15, scale=2),
            ColumnSpec("p_since", "date"),
        ),
    )
    aligned = align.align_frame(t.part, target)
    return aligned.withColumn("p_retailprice", F.col("p_retailprice").cast("string"))


# A payload of one or two records per customer.  Ids repeat, some emails, phones and
# cities are missing and some sexes are not numbers.
_STAGED = """
    SELECT row_number() OVER (ORDER BY c_custkey, i) - 1 AS stage_order, c_custkey, i, id, email_addr, first_name, last_name,
           try_cast(sex AS INTEGER) AS sex, CASE WHEN try_cast(sex AS INTEGER) IS NULL THEN 'sex is not int: ' || sex END AS error_msg,
           phone_type, phone, address_type, address1, city
    FROM (SELECT c_custkey, i, lpad((c_custkey % 400)::VARCHAR, 9, '0') AS id,
            CASE WHEN c_custkey % 11 <> 0 THEN 'u' || (c_custkey % 400) || '@x.org' END AS email_addr,
            'F' || c_custkey || '_' || i AS first_name, c_name AS last_name,
            CASE WHEN c_custkey % 97 = 0 THEN 'bad' ELSE i::VARCHAR END AS sex,
            CASE (c_custkey + i) % 3 WHEN 0 THEN 'MAIN' WHEN 1 THEN 'MOBILE' END AS phone_type,
            CASE WHEN c_custkey % 5 <> 0 THEN '555-' || c_custkey || i END AS phone, 'HOME' AS address_type,
            CASE WHEN c_custkey % 4 > 1 THEN c_custkey || ' Main St' END AS address1,
            CASE WHEN c_custkey % 4 > 0 THEN 'C' || c_nationkey END AS city
          FROM (SELECT *, unnest(range(c_custkey % 2 + 1)) AS i FROM customer))"""

FIELDS = {
    **{n: "string" for n in ("id", "email_addr", "first_name", "middle_name", "last_name", "name_prefix", "name_suffix")},
    "birthdate": "date", "dt_of_death": "date", "email_type": "string", "sex": "int", "mar_status": "int",
    **{n: "string" for n in ("phone_type", "phone", "address_type")},
    **{n: "string" for n in staging.ADDRESS_FIELDS},
}


def payloads(t):
    k = F.col("c_custkey")

    def record(i):
        code = k % 400
        return F.struct(
            F.lpad(code.cast("string"), 9, "0").alias("id"),
            F.when(k % 11 != 0, F.concat(F.lit("u"), code, F.lit("@x.org"))).alias("email_addr"),
            F.concat(F.lit("F"), k, F.lit("_"), i).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(k % 97 == 0, "bad").otherwise(i.cast("string")).alias("sex"),
            F.when((k + i) % 3 == 0, "MAIN").when((k + i) % 3 == 1, "MOBILE").alias("phone_type"),
            F.when(k % 5 != 0, F.concat(F.lit("555-"), k, i)).alias("phone"),
            F.lit("HOME").alias("address_type"),
            F.when(k % 4 > 1, F.concat(k, F.lit(" Main St"))).alias("address1"),
            F.when(k % 4 > 0, F.concat(F.lit("C"), "c_nationkey")).alias("city"),
        )

    customers = spread_in_order(t.customer.select("c_custkey", "c_name", "c_nationkey"), "c_custkey")
    payload = F.to_json(F.transform(F.sequence(F.lit(0), k % 2), record))
    return compute_once(customers, payload=payload).select("c_custkey", "payload")


def staged_rows(t):
    return staging.settle(staging.stage_payloads(payloads(t), "payload", FIELDS, ["c_custkey"], at()))


@query(
    "stage_bulk",
    "M12 M13 M14",
    f"""SELECT '20240501100000' || lpad((stage_order % 999999 + 1)::VARCHAR, 6, '0') AS stage_id, id, first_name, email_addr, sex,
          CASE WHEN error_msg IS NULL THEN 'SUCCESS' ELSE 'ERROR' END AS status, error_msg FROM ({_STAGED})""",
)
def stage_bulk(t):
    return staged_rows(t).select("stage_id", "id", "first_name", "email_addr", "sex", "status", "error_msg")


@query(
    "stage_broken_payloads",
    "M12",
    f"""SELECT c_custkey, id, status, error_msg FROM (
          SELECT c_custkey, i, CASE WHEN c_custkey % 7 > 0 THEN id END AS id, CASE WHEN c_custkey % 7 > 0 AND error_msg IS NULL THEN 'SUCCESS' ELSE 'ERROR' END AS status,
                 CASE WHEN c_custkey % 7 = 0 THEN 'payload is not a JSON array' ELSE error_msg END AS error_msg FROM ({_STAGED}))
        WHERE c_custkey % 7 > 0 OR i = 0""",
)
def stage_broken_payloads(t):
    """Every seventh payload is cut short: each gives one ERROR row and none is lost."""
    cut = F.when(F.col("c_custkey") % 7 == 0, F.expr("substr(payload, 1, 20)")).otherwise(F.col("payload"))
    settled = staging.settle(staging.stage_payloads(payloads(t).withColumn("payload", cut), "payload", FIELDS, ["c_custkey"], at()))
    return settled.select("c_custkey", "id", "status", "error_msg")


_PERSON = f"""
    st AS (SELECT * FROM ({_STAGED}) WHERE error_msg IS NULL),
    held AS (SELECT lpad((500 + s_suppkey)::VARCHAR, 9, '0') AS person_id, lpad(s_suppkey::VARCHAR, 9, '0') AS id,
                    'u' || s_suppkey || '@x.org' AS email_addr, s_name AS first_name FROM supplier),
    grp AS (SELECT id, email_addr, arg_max(first_name, stage_order) AS first_name, min(stage_order) AS first_seen,
                   NULL::BIGINT AS own FROM st WHERE email_addr IS NOT NULL GROUP BY id, email_addr
            UNION ALL SELECT id, email_addr, first_name, stage_order, stage_order FROM st WHERE email_addr IS NULL),
    known AS (SELECT grp.*, held.person_id FROM grp LEFT JOIN held USING (id, email_addr)),
    numbered AS (SELECT id, email_addr, first_name, own, lpad((111110 + row_number() OVER (ORDER BY first_seen))::VARCHAR, 9, '0') AS person_id
                 FROM known WHERE person_id IS NULL),
    links AS (SELECT id, email_addr, own, person_id, first_name, true AS fresh FROM numbered
              UNION ALL SELECT id, email_addr, own, person_id, first_name, false FROM known WHERE person_id IS NOT NULL),
    placed AS (SELECT st.*, links.person_id FROM st JOIN links ON st.id = links.id
               AND ((st.email_addr = links.email_addr AND links.own IS NULL) OR (links.own = st.stage_order)))"""


def person_tables(t):
    s = F.col("s_suppkey").cast("string")
    stamp = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    empty = {f: F.lit(None).cast(FIELDS[f]) for f in staging.PERSON_FIELDS if f != "first_name"}
    person = t.supplier.select(
        F.lpad((F.col("s_suppkey") + 500).cast("string"), 9, "0").alias("person_id"),
        F.lpad(s, 9, "0").alias("id"),
        F.concat(F.lit("u"), s, F.lit("@x.org")).alias("email_addr"),
        F.col("s_name").alias("first_name"),
        *[v.alias(k) for k, v in empty.items()],
        stamp.alias("created_at"), F.lit("OLD").alias("created_by"),
        stamp.alias("updated_at"), F.lit("OLD").alias("updated_by"),
    )
    phone = person.select(
        "person_id", F.lit("MAIN").alias("phone_type"), F.lit("000").alias("phone"), *staging.AUDIT
    )
    address = person.select(
        "person_id", F.lit("HOME").alias("address_type"),
        *[(F.lit("old") if f == "city" else F.lit(None).cast("string")).alias(f) for f in staging.ADDRESS_FIELDS],
        *staging.AUDIT,
    )
    return person, phone, address


@query(
    "upsert_person",
    "M15 F12 P25",
    f"""
    WITH {_PERSON}
    SELECT person_id, id, email_addr, first_name, 'LOADER' AS created_by, 'LOADER' AS updated_by FROM links WHERE fresh
    UNION ALL SELECT held.person_id, held.id, held.email_addr, coalesce(links.first_name, held.first_name), 'OLD',
      CASE WHEN links.person_id IS NULL THEN 'OLD' ELSE 'LOADER' END FROM held LEFT JOIN links ON links.person_id = held.person_id AND NOT fresh""",
)
def upsert_person(t):
    good = staged_rows(t).where("status = 'SUCCESS'")
    person = staging.upsert_person(person_tables(t)[0], good, at(), "LOADER")[0]
    return person.select("person_id", "id", "email_addr", "first_name", "created_by", "updated_by")


@query(
    "merge_phone",
    "M16",
    f"""
    WITH {_PERSON},
    w AS (SELECT person_id, phone_type, arg_max(phone, stage_order) AS phone FROM placed
          WHERE phone IS NOT NULL AND phone_type IS NOT NULL GROUP BY 1, 2)
    SELECT coalesce(h.person_id, w.person_id) AS person_id, coalesce(h.phone_type, w.phone_type) AS phone_type,
           coalesce(w.phone, h.phone) AS phone, CASE WHEN h.person_id IS NULL THEN 'LOADER' ELSE 'OLD' END AS created_by
    FROM (SELECT person_id, 'MAIN' AS phone_type, '000' AS phone FROM held) h FULL JOIN w
      ON h.person_id = w.person_id AND h.phone_type = w.phone_type
    UNION ALL SELECT person_id, NULL, phone, 'LOADER' FROM placed WHERE phone IS NOT NULL AND phone_type IS NULL""",
)
def merge_phone(t):
    good = staged_rows(t).where("status = 'SUCCESS'")
    person, phone, _ = person_tables(t)
    links = staging.link_people(person, good)
    return staging.merge_phone(phone, good, links, at(), "LOADER").select("person_id", "phone_type", "phone", "created_by")


@query(
    "merge_address",
    "M17",
    f"""
    WITH {_PERSON},
    w AS (SELECT person_id, address_type, arg_max({{'a': address1, 'c': city}}, stage_order) AS v FROM placed
          WHERE address1 IS NOT NULL OR city IS NOT NULL GROUP BY 1, 2)
    SELECT coalesce(h.person_id, w.person_id) AS person_id, 'HOME' AS address_type, v.a AS address1,
           CASE WHEN w.person_id IS NULL THEN 'old' ELSE v.c END AS city
    FROM held h FULL JOIN w ON h.person_id = w.person_id""",
)
def merge_address(t):
    good = staged_rows(t).where("status = 'SUCCESS'")
    person, _, address = person_tables(t)
    links = staging.link_people(person, good)
    merged = staging.merge_address(address, good, links, at(), "LOADER")
    return merged.select("person_id", "address_type", "address1", "city")


@query(
    "merge_people",
    "M15 M16 M17",
    f"""
    WITH {_PERSON}, n AS (SELECT count(*) AS c FROM links WHERE fresh)
    SELECT 'person' AS which, (SELECT count(*) FROM held) + (SELECT c FROM n) AS n_rows
    UNION ALL SELECT 'phone', (SELECT count(*) FROM held) + (SELECT count(*) FROM placed WHERE phone IS NOT NULL AND phone_type IS NULL)
      + (SELECT count(*) FROM (SELECT DISTINCT person_id, phone_type FROM placed WHERE phone IS NOT NULL AND phone_type IS NOT NULL) x
         WHERE NOT (phone_type = 'MAIN' AND person_id IN (SELECT person_id FROM held)))
    UNION ALL SELECT 'address', (SELECT count(*) FROM held) + (SELECT count(DISTINCT person_id) FROM placed
      WHERE (address1 IS NOT NULL OR city IS NOT NULL) AND person_id NOT IN (SELECT person_id FROM held))""",
)
def merge_people(t):
    """All three tables from one matching of people."""
    good = staged_rows(t).where("status = 'SUCCESS'")
    tables = staging.merge_people(*person_tables(t), good, at(), "LOADER")
    named = [df.agg(F.count("*").alias("n_rows")).select(F.lit(which).alias("which"), "n_rows") for which, df in zip(("person", "phone", "address"), tables, strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2])


def nightly_table(t):
    return t.supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("integration_id"),
        F.col("s_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.lit(None).cast("date").alias("birthdate"),
        F.lit(None).cast("int").alias("sex"),
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("created_at", "updated_at")],
        F.lit("OLD").alias("created_by"),
        F.lit("OLD").alias("updated_by"),
    )


def nightly_sql(extra: str) -> str:
    return f"""
    WITH st AS (SELECT * FROM ({_STAGED}) WHERE error_msg IS NULL),
    w AS (SELECT id, arg_max(first_name, stage_order) AS first_name, arg_max(sex, stage_order) AS sex FROM st GROUP BY id),
    h AS (SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS id, s_name FROM supplier)
    SELECT coalesce(h.id, w.id) AS integration_id, coalesce(w.first_name, s_name) AS first_name, w.sex,
           CASE WHEN h.id IS NULL THEN 'SYNC' ELSE 'OLD' END AS created_by,
           CASE WHEN w.id IS NULL THEN 'OLD' ELSE 'SYNC' END AS updated_by
    FROM h {extra} JOIN w ON h.id = w.id"""


_NIGHTLY_COLUMNS = ("integration_id", "first_name", "sex", "created_by", "updated_by")


@query("nightly_sync", "M18", nightly_sql("FULL"))
def nightly_sync(t):
    good = staged_rows(t).where("status = 'SUCCESS'")
    return staging.sync_nightly(nightly_table(t), good, at(), "SYNC").select(*_NIGHTLY_COLUMNS)


@query("nightly_update_only", "M18", nightly_sql("LEFT"))
def nightly_update_only(t):
    good = staged_rows(t).where("status = 'SUCCESS'")
    return staging.sync_nightly(nightly_table(t), good, at(), "SYNC", insert_new=False).select(*_NIGHTLY_COLUMNS)


@query(
    "bucket_rows",
    "M19 R3",
    """SELECT o_orderkey, o_custkey, ('0x' || substring(md5(o_custkey::VARCHAR), 1, 8))::BIGINT % 3 AS bucket FROM orders""",
)
def bucket_rows(t):
    return staging.bucket_rows(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 3, ["o_orderkey"])


@query(
    "migrate_report",
    "M20 P2 P3",
    """
    SELECT 'Region' AS table_name, 'SF_REGION' AS target_name, 'migrated' AS status, 'reset' AS action, '' AS added_columns, count(*) AS row_count FROM region
    UNION ALL SELECT 'saleOrder', 'SF_SALE_ORDER', 'migrated', 'reset', '', count(*) FROM orders
    UNION ALL SELECT 'ora_supplier__c', 'SUPPLIER', 'migrated', 'reset', '', count(*) FROM supplier
    UNION ALL SELECT 'missing', 'SF_MISSING', 'skipped', 'reset', '', NULL""",
)
def migrate_report(t):
    source = {
        "Region": f"{t.folder}/region.parquet",
        "saleOrder": f"{t.folder}/orders.parquet",
        "ora_supplier__c": f"{t.folder}/supplier.parquet",
        "missing": f"{t.folder}/no_such_table.parquet",
    }
    return migrate.migrate(t.spark, source, work_folder(t.spark, "migrate"), "20240501_100000")


@query(
    "migrate_upsert_rows",
    "M20 M2",
    """
    SELECT c_custkey AS "C_CUSTKEY", CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'old' END AS "C_NAME",
           CASE WHEN c_custkey % 2 = 0 THEN 2 END AS "FEED_NO" FROM customer
    UNION ALL SELECT 1000000000 + s_suppkey, s_name, 2 FROM supplier""",
)
def migrate_upsert_rows(t):
    """A second migration with repeated keys and a new column upserts into the table the first one made."""
    base = work_folder(t.spark, "migrate-upsert")
    t.customer.select("c_custkey", F.lit("old").alias("c_name")).write.parquet(f"{base}/in1")
    even = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("C Name"))
    new = t.supplier.select((F.col("s_suppkey") + 1000000000).alias("C_CUSTKEY"), F.col("s_name").alias("C Name"))
    last = even.unionByName(new).withColumn("feedNo", F.lit(2))
    first = last.withColumn("C Name", F.lit("first")).withColumn("feedNo", F.lit(1))
    first.unionByName(last).write.parquet(f"{base}/in2")
    migrate.migrate(t.spark, {"people": f"{base}/in1"}, base, "1")
    migrate.migrate(
        t.spark, {"people": f"{base}/in2"}, base, "2", action="upsert", keys={"people": ["C_CUSTKEY"]},
        order_by={"people": ["FEED_NO"]},
    )
    return publish.current(t.spark, base, "SF_PEOPLE")


@query(
    "publish_versions",
    "S15 T3",
    """
    SELECT '3' AS version, count(*) AS row_count, true AS is_current FROM nation
    UNION ALL SELECT '2', count(*), false FROM nation WHERE n_regionkey < 3""",
)
def publish_versions(t):
    base = work_folder(t.spark, "publish")

    def refuse(_):
        raise ValueError("not good enough")

    publish.publish_version(t.nation.where("n_regionkey < 2"), base, "nation_copy", "1", retain=2)
    publish.publish_version(t.nation.where("n_regionkey < 3"), base, "nation_copy", "2", retain=2)
    publish.publish_version(t.nation, base, "nation_copy", "3", retain=2)
    try:
        publish.publish_version(t.nation.where("n_regionkey < 1"), base, "nation_copy", "4", retain=2, check=refuse)
    except ValueError:
        pass
    return publish.version_rows(t.spark, base, "nation_copy")


@query(
    "run_log",
    "M22",
    """
    SELECT 'part' AS source, 'rows ' || count(*) AS message FROM part
    UNION ALL SELECT 'part', 'rejected ' || count(*) FROM part WHERE length(p_name) > 8
    UNION ALL SELECT 'run', 'failed: stop here'""",
)
def run_log(t):
    log = migrate.RunLog(t.spark, work_folder(t.spark, "log"), "TEST_1")
    log.write("part", f"rows {t.part.count()}")
    log.write("part", f"rejected {t.part.where('length(p_name) > 8').count()}", "p_name")
    try:
        raise ValueError("stop here")
    except ValueError as error:
        log.write("run", f"failed: {error}")
    return log.read().select("source", "message")


