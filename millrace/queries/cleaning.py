"""Names, filters, decoding and cell cleaning over the input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import (
    LEDGER_HEADER,
    RESERVED_WORDS,
    SKIPPED_ENDINGS,
    SKIPPED_OBJECTS,
    SSN_PATTERN,
)
from ..functions import cells, names
from ..operators import clean
from ..session import compute_once
from .registry import query


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_canonical(x: str) -> str:
    s = sql_strip(x)
    for border in ("([a-z0-9])([A-Z])", "([A-Za-z])([0-9])", "([0-9])([A-Za-z])"):
        s = rf"regexp_replace({s}, '{border}', '\1_\2', 'g')"
    s = f"regexp_replace({s}, '[^A-Za-z0-9_]+', '_', 'g')"
    return f"upper(regexp_replace({s}, '^_+|_+$', '', 'g'))"


_IDENTIFIERS = """
    SELECT p_partkey, CASE p_partkey % 7
        WHEN 0 THEN p_name || ' ' || p_brand
        WHEN 1 THEN 'part' || p_type || p_size
        WHEN 2 THEN p_size || p_type
        WHEN 3 THEN CASE p_size % 4 WHEN 0 THEN 'order' WHEN 1 THEN '  ' WHEN 2 THEN 'Level' ELSE '__' END
        WHEN 4 THEN repeat(p_name || '_', 20)
        WHEN 5 THEN 'retailPrice2' || p_type || ' (' || p_brand || ')'
        ELSE '  ' || lower(p_type) || 'Kind-' || p_name END AS identifier
    FROM part"""


def part_identifiers(t):
    k, size = F.col("p_partkey") % 7, F.col("p_size").cast("string")
    word = (
        F.when(F.col("p_size") % 4 == 0, "order")
        .when(F.col("p_size") % 4 == 1, "  ")
        .when(F.col("p_size") % 4 == 2, "Level")
        .otherwise("__")
    )
    identifier = (
        F.when(k == 0, F.concat("p_name", F.lit(" "), "p_brand"))
        .when(k == 1, F.concat(F.lit("part"), "p_type", size))
        .when(k == 2, F.concat(size, "p_type"))
        .when(k == 3, word)
        .when(k == 4, F.repeat(F.concat("p_name", F.lit("_")), 20))
        .when(k == 5, F.concat(F.lit("retailPrice2"), "p_type", F.lit(" ("), "p_brand", F.lit(")")))
        .otherwise(F.concat(F.lit("  "), F.lower("p_type"), F.lit("Kind-"), "p_name"))
    )
    return t.part.select("p_partkey", identifier.alias("identifier"))


_CANONICAL = f"""
    WITH raw AS ({_IDENTIFIERS}),
    s AS (SELECT p_partkey, identifier, {sql_canonical('identifier')} AS w FROM raw),
    d AS (SELECT p_partkey, identifier, CASE WHEN w = '' THEN 'COL' WHEN regexp_matches(w, '^[0-9]') THEN 'C_' || w
                 ELSE w END AS w FROM s),
    r AS (SELECT p_partkey, identifier,
                 CASE WHEN w IN ({sql_list(RESERVED_WORDS)}) THEN w || '_COL' ELSE w END AS w FROM d)
    SELECT p_partkey, identifier, CASE WHEN length(w) <= 128 THEN w
           ELSE regexp_replace(substring(w, 1, 128), '_+$', '') END AS canonical FROM r"""


@query("canonical_columns", "P1", f"SELECT p_partkey, canonical FROM ({_CANONICAL})")
def canonical_columns(t):
    return part_identifiers(t).select(
        "p_partkey", names.canonical_snake(F.col("identifier")).alias("canonical")
    )


@query(
    "canonical_collisions",
    "P1",
    f"""SELECT canonical, count(*) AS identifiers FROM (SELECT DISTINCT identifier, canonical FROM ({_CANONICAL}))
        GROUP BY canonical HAVING count(*) > 1""",
)
def canonical_collisions(t):
    # Lower-cased twins of the identifiers make some names meet.
    both = part_identifiers(t).select("identifier")
    return names.name_collisions(both, "identifier")


@query(
    "rename_to_target",
    "P2",
    """SELECT c_custkey AS "C_CUSTKEY", c_name AS "cName", c_nationkey, c_acctbal AS "C-ACCTBAL", c_mktsegment
       FROM customer""",
)
def rename_to_target(t):
    return names.rename_to_target(t.customer, ["C_CUSTKEY", "cName", "C-ACCTBAL", "other"])


@query(
    "cross_names",
    "P3",
    f"""
    WITH n AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'ora_' || lower(c_mktsegment) || c_nationkey || '__c'
                      WHEN 1 THEN 'My' || c_mktsegment || 'Object' ELSE 'SF_' || c_mktsegment END AS name FROM customer)
    SELECT c_custkey,
      CASE WHEN lower(name) LIKE 'ora!_%' ESCAPE '!'
           THEN {sql_canonical("regexp_replace(regexp_replace(name, '(?i)^ora_', ''), '(?i)__c$', '')")}
           ELSE 'SF_' || {sql_canonical('name')} END AS in_relational,
      CASE WHEN upper(name) LIKE 'SF!_%' ESCAPE '!' THEN substring(name, 4)
           ELSE 'ora_' || lower(name) || '__c' END AS in_crm
    FROM n""",
)
def cross_names(t):
    k = F.col("c_custkey") % 3
    name = (
        F.when(k == 0, F.concat(F.lit("ora_"), F.lower("c_mktsegment"), "c_nationkey", F.lit("__c")))
        .when(k == 1, F.concat(F.lit("My"), "c_mktsegment", F.lit("Object")))
        .otherwise(F.concat(F.lit("SF_"), "c_mktsegment"))
    )
    return t.customer.select(
        "c_custkey",
        names.cross_system_name(name, "crm", "relational").alias("in_relational"),
        names.cross_system_name(name, "relational", "crm").alias("in_crm"),
    )


@query(
    "slug_columns",
    "P4",
    "SELECT s_suppkey AS supp_key, s_name AS full_name, s_acctbal AS acct_bal_usd FROM supplier",
)
def slug_columns(t):
    odd = t.supplier.select(
        F.col("s_suppkey").alias(" Supp  Key "),
        F.col("s_name").alias("Full-Name"),
        F.col("s_acctbal").alias("Acct Bal (USD)!"),
    )
    return names.slugify_columns(odd)


def nested_orders(t):
    return t.orders.select(
        "o_orderkey",
        F.struct(
            F.col("o_custkey").alias("id"),
            F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("state"),
        ).alias("cust"),
        F.col("o_totalprice").alias("total"),
    )


@query(
    "flatten_header",
    "P5",
    """SELECT o_orderkey, o_custkey AS cust_id, o_orderstatus AS cust_state_status,
              o_orderpriority AS cust_state_priority, o_totalprice AS total FROM orders""",
)
def flatten_header(t):
    return names.flatten_columns(nested_orders(t))


@query(
    "flatten_unflatten",
    "JS25 P5",
    """SELECT o_orderkey, json_object('id', o_custkey, 'state',
              json_object('status', o_orderstatus, 'priority', o_orderpriority))::VARCHAR AS cust, o_totalprice AS total
       FROM orders""",
)
def flatten_unflatten(t):
    flat = names.flatten_columns(nested_orders(t), ".")
    return names.unflatten_columns(flat).withColumn("cust", F.to_json("cust"))


@query(
    "isin_include",
    "P6",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def isin_include(t):
    return clean.filter_isin(
        t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["1-URGENT", "2-HIGH"]
    )


@query(
    "isin_exclude",
    "P6",
    """SELECT o_orderkey, s FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS s FROM orders)
       WHERE s IS NULL OR s NOT IN ('F')""",
)
def isin_exclude(t):
    orders = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("s"))
    return clean.filter_isin(orders, "s", ["F"], exclude=True)


@query(
    "isin_key_table",
    "P6 J10",
    "SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def isin_key_table(t):
    debtors = t.customer.where("c_acctbal < 0").select("c_custkey")
    return clean.filter_isin(t.orders, "o_custkey", debtors, exclude=True).agg(F.count("*").alias("n"))


@query(
    "mask_filter",
    "P7",
    """SELECT event_id, value FROM events
       WHERE nullif(event_type, 'click') = 'purchase' AND value > 80""",
)
def mask_filter(t):
    active = F.nullif("event_type", F.lit("click")) == "purchase"
    return t.events.where(active & (F.col("value") > 80)).select("event_id", "value")


@query(
    "table_read_binds",
    "S10 P8",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
def table_read_binds(t):
    picked = clean.filter_equal(t.orders, {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})
    return picked.select("o_orderkey", "o_totalprice")


@query(
    "status_decode",
    "P9",
    """SELECT status, count(*) AS n FROM (
         SELECT CASE o_orderstatus WHEN 'F' THEN 'FILLED' WHEN 'O' THEN 'OPEN'
                ELSE 'UNKNOWN (' || o_orderstatus || ')' END AS status FROM orders) GROUP BY status""",
)
def status_decode(t):
    labels = clean.decode(F.col("o_orderstatus"), {"F": "FILLED", "O": "OPEN"})
    return t.orders.groupBy(labels.alias("status")).agg(F.count("*").alias("n"))


_CATALOG = """
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_mktsegment || '__History' WHEN 1 THEN 'CaseFeed'
             WHEN 2 THEN c_mktsegment || '__mdt' ELSE c_mktsegment || c_custkey || '__c' END AS name,
           c_custkey % 7 <> 0 AS queryable, c_custkey % 11 <> 0 AS retrieveable,
           c_custkey % 3 = 0 AS layoutable, c_custkey % 2 = 0 AS searchable
    FROM customer"""


@query(
    "eligible_objects",
    "P10",
    f"""SELECT c_custkey, name FROM ({_CATALOG}) WHERE queryable AND retrieveable AND (layoutable OR searchable)
        AND NOT regexp_matches(name, '({"|".join(SKIPPED_ENDINGS)})$') AND name NOT IN ({sql_list(SKIPPED_OBJECTS)})""",
)
def eligible_objects(t):
    k = F.col("c_custkey")
    name = (
        F.when(k % 5 == 0, F.concat("c_mktsegment", F.lit("__History")))
        .when(k % 5 == 1, "CaseFeed")
        .when(k % 5 == 2, F.concat("c_mktsegment", F.lit("__mdt")))
        .otherwise(F.concat("c_mktsegment", k, F.lit("__c")))
    )
    catalog = t.customer.select(
        "c_custkey",
        name.alias("name"),
        (k % 7 != 0).alias("queryable"),
        (k % 11 != 0).alias("retrieveable"),
        (k % 3 == 0).alias("layoutable"),
        (k % 2 == 0).alias("searchable"),
    )
    return clean.eligible_objects(catalog).select("c_custkey", "name")


_NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


@query(
    "normalise_cells",
    "P11",
    rf"""
    WITH d AS (SELECT o_orderkey AS k,
        CASE o_orderkey % 5 WHEN 0 THEN ' ' || format('{{:,.2f}}', o_totalprice) WHEN 1 THEN 'abc' WHEN 2 THEN '   '
             WHEN 3 THEN '-' || o_orderkey ELSE 'Infinity' END AS amount,
        CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN 'soon'
             ELSE strftime(o_orderdate, ' %Y-%m-%d ') END AS day,
        CASE o_orderkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN '' ELSE 'TRUE' END AS flag,
        '  ' || o_orderpriority || ' ' AS label FROM orders)
    SELECT k, CASE WHEN regexp_matches({sql_strip("replace(amount, ',', '')")}, '{_NUM}')
                THEN try_cast(trim(replace(amount, ',', '')) AS DOUBLE) END AS amount,
        try_cast(CASE WHEN regexp_matches(substring(trim(day), 1, 10), '^\d{{4}}-\d{{2}}-\d{{2}}$')
                 THEN substring(trim(day), 1, 10) END AS DATE) AS day,
        CASE WHEN trim(flag) = '' THEN NULL WHEN lower(flag) IN ('true','1','yes','on','y') THEN 'Y' ELSE 'N' END AS flag,
        trim(label) AS label, label AS note
    FROM d""",
)
def normalise_cells(t):
    k = F.col("o_orderkey")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    dirty = t.spread("orders").select(
        k.alias("k"),
        F.when(k % 5 == 0, F.concat(F.lit(" "), F.format_number("o_totalprice", 2)))
        .when(k % 5 == 1, "abc")
        .when(k % 5 == 2, "   ")
        .when(k % 5 == 3, F.concat(F.lit("-"), k))
        .otherwise("Infinity")
        .alias("amount"),
        F.when(k % 3 == 0, iso)
        .when(k % 3 == 1, "soon")
        .otherwise(F.date_format("o_orderdate", "' 'yyyy-MM-dd' '"))
        .alias("day"),
        F.when(k % 4 == 0, "Yes").when(k % 4 == 1, "n").when(k % 4 == 2, "").otherwise("TRUE").alias("flag"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" \x00")).alias("label"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit("\x00 ")).alias("note"),
    )
    kinds = {"amount": "number", "day": "date", "flag": "boolean", "label": "text", "note": "clob"}
    return clean.normalise_cells(dirty, kinds)


@query(
    "known_columns",
    "P12",
    """
    WITH p AS (SELECT CASE event_id % 3 WHEN 0 THEN replace(props, '}', ', "zz": 1}')
                      WHEN 1 THEN replace(props, '}', ', "' || event_type || '": 1}') ELSE props END AS doc FROM events)
    SELECT 'events' AS table_name, field, count(*) AS rows_with_field
    FROM (SELECT unnest(json_keys(doc)) AS field FROM p) WHERE field NOT IN ('k', 'click') GROUP BY field""",
)
def known_columns(t):
    k = F.col("event_id") % 3
    doc = (
        F.when(k == 0, F.replace("props", F.lit("}"), F.lit(', "zz": 1}')))
        .when(k == 1, F.replace("props", F.lit("}"), F.concat(F.lit(', "'), "event_type", F.lit('": 1}'))))
        .otherwise(F.col("props"))
    )
    return clean.unknown_fields(t.events.select(doc.alias("doc")), "doc", ["k", "click"], "events")


@query(
    "cast_record",
    "P13",
    r"""
    WITH d AS (SELECT o_orderkey,
        CASE o_orderkey % 4 WHEN 0 THEN o_custkey::VARCHAR WHEN 1 THEN o_custkey || '.5' WHEN 2 THEN '' ELSE 'x' END AS n,
        CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00' WHEN 1 THEN 'later' END AS d,
        CASE o_orderkey % 2 WHEN 0 THEN 'True' ELSE 'no' END AS b FROM orders)
    SELECT o_orderkey,
      CASE WHEN try_cast(n AS DOUBLE) = floor(try_cast(n AS DOUBLE)) THEN try_cast(n AS DOUBLE)::BIGINT END AS n,
      try_cast(nullif(regexp_extract(d, '^(\d{4}-\d{2}-\d{2})', 1), '') AS DATE) AS d,
      lower(b) = 'true' AS b,
      CASE WHEN n <> '' AND (try_cast(n AS DOUBLE) IS NULL OR try_cast(n AS DOUBLE) <> floor(try_cast(n AS DOUBLE)))
           THEN n END AS n__raw,
      CASE WHEN d = 'later' THEN d END AS d__raw, NULL::VARCHAR AS b__raw,
      (CASE WHEN n <> '' AND (try_cast(n AS DOUBLE) IS NULL OR try_cast(n AS DOUBLE) <> floor(try_cast(n AS DOUBLE)))
           THEN 1 ELSE 0 END + CASE WHEN d = 'later' THEN 1 ELSE 0 END)::INTEGER AS cast_failures
    FROM d""",
)
def cast_record(t):
    k = F.col("o_orderkey")
    text = t.orders.select(
        k,
        F.when(k % 4 == 0, F.col("o_custkey").cast("string"))
        .when(k % 4 == 1, F.concat("o_custkey", F.lit(".5")))
        .when(k % 4 == 2, "")
        .otherwise("x")
        .alias("n"),
        F.when(k % 3 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00")))
        .when(k % 3 == 1, "later")
        .alias("d"),
        F.when(k % 2 == 0, "True").otherwise("no").alias("b"),
    )
    return clean.cast_record(text, {"n": "int", "d": "date", "b": "boolean"})


@query(
    "prepare_for_write",
    "P14",
    """
    SELECT o_orderkey,
      '{' || CASE WHEN o_orderkey % 4 = 0 THEN '"status":null,' WHEN o_orderstatus <> 'F' THEN
                  '"status":"' || o_orderstatus || '",' ELSE '' END
          || '"open":"' || CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END || '","ordered":"'
          || strftime(o_orderdate, '%Y-%m-%d') || '"}' AS record
    FROM orders""",
)
def prepare_for_write(t):
    rows = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        (F.col("o_orderstatus") == "O").alias("open"),
        F.to_date("o_orderdate").alias("ordered"),
        F.when(F.col("o_orderkey") % 4 == 0, F.array(F.lit("status"))).otherwise(F.array()).alias("cleared"),
    )
    return clean.prepare_for_write(rows, ["status", "open", "ordered"], "cleared").select("o_orderkey", "record")


@query("null_bytes", "P15", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def null_bytes(t):
    dirty = t.customer.select(
        "c_custkey",
        F.concat(F.lit("\x00"), "c_name").alias("c_name"),
        F.concat(F.substring("c_mktsegment", 1, 2), F.lit("\x00\x00"), F.substring("c_mktsegment", 3, 50)).alias("c_mktsegment"),
    )
    return dirty.withColumns({c: cells.without_null_bytes(F.col(c)) for c in ("c_name", "c_mktsegment")})


_SSN_TEXT = """
    SELECT doc_id, text || CASE doc_id % 5 WHEN 0 THEN ' SSN: 123-45-' || lpad(doc_id::VARCHAR, 4, '0')
        WHEN 1 THEN ' id ' || (100000000 + doc_id) || ' end' WHEN 2 THEN ' social security number 123 45 6789'
        WHEN 3 THEN ' call 555-1234 now' ELSE ' 321.54.9876,' END AS text FROM documents"""


def ssn_text(t):
    k = F.col("doc_id")
    tail = (
        F.when(k % 5 == 0, F.concat(F.lit(" SSN: 123-45-"), F.lpad(k.cast("string"), 4, "0")))
        .when(k % 5 == 1, F.concat(F.lit(" id "), 100000000 + k, F.lit(" end")))
        .when(k % 5 == 2, " social security number 123 45 6789")
        .when(k % 5 == 3, " call 555-1234 now")
        .otherwise(" 321.54.9876,")
    )
    return t.spread("documents").select("doc_id", F.concat("text", tail).alias("text"))


@query(
    "redact_ssn",
    "P16",
    f"SELECT doc_id, md5(regexp_replace(text, '{SSN_PATTERN}', '[REDACTED]', 'g')) AS redacted FROM ({_SSN_TEXT})",
)
def redact_ssn(t):
    return ssn_text(t).select("doc_id", F.md5(cells.redact_ssn(F.col("text"))).alias("redacted"))


@query(
    "nine_digits",
    "P17",
    rf"""SELECT DISTINCT unnest(regexp_extract_all(regexp_replace(text, '[ -]', '', 'g'), '\d{{9}}')) AS candidate
         FROM ({_SSN_TEXT})""",
)
def nine_digits(t):
    runs = ssn_text(t).select(F.explode(cells.nine_digit_runs(F.col("text"))).alias("candidate"))
    return runs.distinct().orderBy("candidate")


_LEDGER = """
    SELECT l_orderkey, l_partkey, l_linenumber,
      CASE WHEN l_partkey % 50 = 0 THEN 'page total' || '  ' || l_quantity::BIGINT
      ELSE strftime(l_shipdate, '%m/%d/%Y') || g || l_extendedprice::DECIMAL(18,2) || g
        || strftime(l_shipdate, '%m/%d/%Y') || g || 'PAYMENT ' || l_returnflag || g
        || CASE WHEN l_linenumber = 1 THEN '-' ELSE '' END || '$' || l_quantity::DECIMAL(18,2) || g
        || l_discount::DECIMAL(18,2) || g || l_tax::DECIMAL(18,2) || g || '0.00' || g
        || l_extendedprice::DECIMAL(18,2) || g || '1.50' END AS line
    FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN chr(9) ELSE '   ' END AS g FROM lineitem)"""


def ledger_lines(t):
    g = F.when(F.col("l_linenumber") % 2 == 0, "\t").otherwise("   ")
    day = F.date_format("l_shipdate", "MM/dd/yyyy")

    def money(c):
        return F.col(c).cast("decimal(18,2)").cast("string")

    minus = F.when(F.col("l_linenumber") == 1, "-").otherwise("")
    fields = [
        day, money("l_extendedprice"), day, F.concat(F.lit("PAYMENT "), "l_returnflag"),
        F.concat(minus, F.lit("$"), money("l_quantity")), money("l_discount"), money("l_tax"),
        F.lit("0.00"), money("l_extendedprice"), F.lit("1.50"),
    ]
    glued = [fields[0]]
    for f in fields[1:]:
        glued += [g, f]
    broken = F.concat(F.lit("page total  "), F.col("l_quantity").cast("bigint"))
    line = F.when(F.col("l_partkey") % 50 == 0, broken).otherwise(F.concat(*glued))
    return compute_once(t.spread("lineitem"), line=line).select("l_orderkey", "l_partkey", "l_linenumber", "line")


def _sql_money(x: str) -> str:
    return (
        f"(CASE WHEN {x} LIKE '-%' THEN '-' ELSE '' END || '$' || "
        f"format('{{:,.2f}}', regexp_replace({x}, '[$,-]', '', 'g')::DOUBLE))"
    )


_FIELDS = [h.lower().replace(" ", "_") for h in LEDGER_HEADER]


@query(
    "ledger_parse",
    "P18",
    f"""
    WITH f AS (SELECT l_orderkey, l_partkey, l_linenumber, regexp_split_to_array(line, '(\\t+|\\s{{2,}})') AS p
               FROM ({_LEDGER}))
    SELECT l_orderkey, l_partkey, l_linenumber,
      {", ".join((_sql_money(f"p[{i + 1}]") if i in (1, 4, 5, 6, 7, 8, 9) else f"trim(p[{i + 1}])") + f" AS {n}"
                 for i, n in enumerate(_FIELDS))}
    FROM f WHERE len(p) = 10""",
)
def ledger_parse(t):
    return clean.parse_ledger_lines(ledger_lines(t), "line")[0]


@query(
    "ledger_rejects",
    "P18",
    f"SELECT l_orderkey, l_partkey, l_linenumber, line FROM ({_LEDGER}) WHERE line LIKE 'page total%'",
)
def ledger_rejects(t):
    return clean.parse_ledger_lines(ledger_lines(t), "line")[1]


@query(
    "ledger_headers",
    "P18",
    f"""SELECT p_partkey, CASE p_partkey % 3
          WHEN 0 THEN array_to_string(list_transform(range(10), lambda i: 'H' || p_size || '_' || i), '|')
          ELSE '{"|".join(LEDGER_HEADER)}' END AS header FROM part""",
)
def ledger_headers(t):
    k = F.col("p_partkey") % 3
    tabbed = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit(" H"), F.col("p_size"), F.lit("_"), i)),
        "\t",
    )
    first = F.when(k == 0, F.concat(F.lit("﻿"), tabbed)).when(k == 1, "a,b,c").otherwise("one  two")
    return t.part.select("p_partkey", F.array_join(clean.ledger_header(first), "|").alias("header"))


@query(
    "coerce_columns",
    "P21",
    """
    SELECT c_custkey, try_cast(CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE ' ' || c_nationkey END AS BIGINT) AS n,
      CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END AS b,
      c_nationkey + c_custkey AS total, c_mktsegment AS s
    FROM customer""",
)
def coerce_columns(t):
    k = F.col("c_custkey")
    text = t.customer.select(
        k,
        F.when(k % 3 == 0, "x").otherwise(F.concat(F.lit(" "), "c_nationkey")).alias("n"),
        F.when(k % 4 == 0, "Yes").when(k % 4 == 1, "on").when(k % 4 == 2, "off").alias("b"),
        F.concat("c_nationkey", F.lit(" , "), k).alias("items"),
        F.col("c_mktsegment").alias("s"),
    )
    kinds = {"n": "bigint", "b": "boolean", "items": "array<bigint>", "s": "string"}
    typed = text.withColumns({c: cells.coerce(F.col(c), kind) for c, kind in kinds.items()})
    total = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return typed.select("c_custkey", "n", "b", total.alias("total"), "s")


@query(
    "blank_flags",
    "P23",
    """SELECT c_custkey, c_custkey % 3 <> 2 AS text_blank, c_custkey % 2 = 0 AS list_blank FROM customer""",
)
def blank_flags(t):
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, " \t ").when(k % 3 == 2, F.col("c_name"))
    items = F.when(k % 4 == 0, F.array().cast("array<string>")).when(k % 2 == 1, F.array("c_name"))
    return t.customer.select(
        "c_custkey",
        cells.is_blank(text).alias("text_blank"),
        cells.is_blank(items, "collection").alias("list_blank"),
    )


@query(
    "lookup_replace",
    "P24",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 100000 WHEN 'SMALL' THEN 100001 END AS type_code,
              CASE p_type WHEN 'PROMO' THEN 'p' ELSE '?' END AS letter FROM part""",
)
def lookup_replace(t):
    kind = F.col("p_type")
    return t.part.select(
        "p_partkey",
        clean.lookup_replace(kind, {"PROMO": 100000, "SMALL": 100001}).alias("type_code"),
        clean.lookup_replace(kind, {"PROMO": "p"}, "?").alias("letter"),
    )


@query(
    "audit_columns",
    "P25",
    """
    SELECT o_orderkey, TIMESTAMP '2024-05-01 10:00:00' AS created_at, 'LOADER' AS created_by,
      CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2024-06-01 10:00:00' ELSE TIMESTAMP '2024-05-01 10:00:00' END AS updated_at,
      CASE WHEN o_orderstatus = 'F' THEN 'SYNC' ELSE 'LOADER' END AS updated_by FROM orders""",
)
def audit_columns(t):
    def at(text):
        return F.lit(text).cast("timestamp_ntz")

    fresh = clean.add_audit_columns(
        t.orders.select("o_orderkey", "o_orderstatus"), "LOADER", at("2024-05-01 10:00:00")
    )
    changed = clean.add_audit_columns(
        fresh.where("o_orderstatus = 'F'"), "SYNC", at("2024-06-01 10:00:00"), existing=True
    )
    return fresh.where("o_orderstatus <> 'F'").unionByName(changed).drop("o_orderstatus")


@query(
    "cast_record_exact",
    "P13",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 9007199254740993 + o_orderkey WHEN 1 THEN 1500 WHEN 2 THEN NULL ELSE NULL END AS amount,
         CASE o_orderkey % 4 WHEN 2 THEN '9223372036854775808' WHEN 3 THEN o_orderkey || '.5' END AS amount__raw,
         (o_orderkey % 4 > 1)::INTEGER AS cast_failures FROM orders""",
)
def cast_record_exact(t):
    """Longs beyond 2 ** 53 stay as they are; what is no long is kept aside."""
    k = F.col("o_orderkey")
    text = (
        F.when(k % 4 == 0, (F.lit(9007199254740993) + k).cast("string")).when(k % 4 == 1, "1.5e3")
        .when(k % 4 == 2, "9223372036854775808").otherwise(F.concat(k.cast("string"), F.lit(".5")))
    )
    return clean.cast_record(t.orders.select("o_orderkey", text.alias("amount")), {"amount": "long"})


@query(
    "normalise_long_numbers",
    "P11",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN o_orderkey + 0.25::DOUBLE ELSE 1234567 END AS as_number,
         CASE WHEN o_orderkey % 3 = 0 THEN '90071992547409' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || '12345678901' WHEN o_orderkey % 3 = 2 THEN '1234567' END AS as_whole,
         CASE WHEN o_orderkey % 3 = 0 THEN '90071992547409' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || '12345678901' WHEN o_orderkey % 3 = 1 THEN o_orderkey || '.25' ELSE '1,234,567' END AS as_text
       FROM orders""",
)
def normalise_long_numbers(t):
    """A double never takes a whole number that it would change; the exact kinds keep it."""
    k = F.col("o_orderkey")
    long = F.concat(F.lit("90071992547409"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("12345678901"))
    text = F.when(k % 3 == 0, long).when(k % 3 == 1, F.concat(k.cast("string"), F.lit(".25"))).otherwise("1,234,567")
    rows = t.orders.select("o_orderkey", *[text.alias(c) for c in ("as_number", "as_whole", "as_text")])
    out = clean.normalise_cells(rows, {"as_number": "number", "as_whole": "whole", "as_text": "string"})
    return out.withColumn("as_whole", F.col("as_whole").cast("string"))


@query(
    "ledger_oversized",
    "P18",
    """SELECT l_orderkey, l_linenumber, count(*) AS n, CASE WHEN l_linenumber = 2 THEN 'rejected' ELSE 'parsed' END AS outcome
       FROM lineitem WHERE l_linenumber < 4 GROUP BY ALL""",
)
def ledger_oversized(t):
    """Amounts of 17 digits are amounts; those that no decimal holds reject their line and stop nothing."""
    rows = t.lineitem.where("l_linenumber < 4")
    amount = F.when(F.col("l_linenumber") == 1, "12345678901234567.00").when(F.col("l_linenumber") == 2, F.concat(F.repeat(F.lit("9"), F.lit(40)), F.lit(".00"))).otherwise("10.00")
    day = F.lit("01/02/2024")
    fields = [day, amount, day, F.lit("PAYMENT"), *[F.lit("1.00")] * 6]
    line = F.concat_ws("\t", *fields)
    parsed, rejects = clean.parse_ledger_lines(rows.select("l_orderkey", "l_linenumber", line.alias("line")), "line")
    both = parsed.select("l_orderkey", "l_linenumber", F.lit("parsed").alias("outcome")).unionByName(
        rejects.select("l_orderkey", "l_linenumber", F.lit("rejected").alias("outcome"))
    )
    return both.groupBy("l_orderkey", "l_linenumber", "outcome").agg(F.count("*").alias("n"))
