"""JSON documents: one purchase order per order row, and the event properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import jsondoc as js
from ..functions import jsonrows
from ..functions.names import flatten_columns
from ..operators import groups
from ..session import compute_once, task_count
from .registry import query

PO_SCHEMA = (
    "PONumber bigint, Reference string, Requestor string, User string, AllowPartialShipment boolean, "
    "OrderDate string, ShippingInstructions struct<name: string, Address: struct<street: string, zipCode: bigint>, "
    "Phone: array<struct<type: string, number: string>>>, "
    "LineItems array<struct<ItemNumber: bigint, Quantity: bigint, "
    "Part: struct<Description: string, UnitPrice: bigint, UPCCode: string>>>"
)

PO = """
    SELECT o_orderkey, to_json({
      'PONumber': o_orderkey, 'Reference': 'R-' || o_custkey || '-' || o_orderkey, 'Requestor': 'Customer ' || o_custkey,
      'User': o_orderpriority, 'AllowPartialShipment': o_orderkey % 2 = 0, 'OrderDate': strftime(o_orderdate, '%Y-%m-%d'),
      'ShippingInstructions': {'name': 'Ship ' || o_custkey,
        'Address': {'street': (o_custkey % 100) || ' Main St', 'zipCode': CASE WHEN o_custkey % 3 <> 0 THEN 10000 + o_custkey END},
        'Phone': list_transform(range(o_custkey % 3), lambda i: {'type': CASE WHEN i = 0 THEN 'Office' ELSE 'Mobile' END,
                                                                 'number': '555-' || o_custkey || '-' || i})},
      'LineItems': list_transform(range(o_orderkey % 4), lambda i: {'ItemNumber': i + 1,
          'Quantity': (o_orderkey * 7 + i * 3) % 20 + 1,
          'Part': {'Description': 'Part ' || (o_orderkey + i) % 50, 'UnitPrice': (o_custkey + i * 13) % 100 + 1,
                   'UPCCode': lpad(((o_orderkey * 31 + i) % 1000)::VARCHAR, 6, '8')}})
    })::VARCHAR AS doc FROM orders"""


def purchase_orders(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def upto(n):
        return F.filter(F.sequence(F.lit(0).cast("bigint"), n), lambda i: i < n)

    phone = F.transform(
        upto(c % 3),
        lambda i: F.struct(
            F.when(i == 0, "Office").otherwise("Mobile").alias("type"),
            F.concat(F.lit("555-"), c, F.lit("-"), i).alias("number"),
        ),
    )
    lines = F.transform(
        upto(k % 4),
        lambda i: F.struct(
            (i + 1).alias("ItemNumber"),
            ((k * 7 + i * 3) % 20 + 1).alias("Quantity"),
            F.struct(
                F.concat(F.lit("Part "), (k + i) % 50).alias("Description"),
                ((c + i * 13) % 100 + 1).alias("UnitPrice"),
                F.lpad(((k * 31 + i) % 1000).cast("string"), 6, "8").alias("UPCCode"),
            ).alias("Part"),
        ),
    )
    doc = F.struct(
        k.alias("PONumber"),
        F.concat(F.lit("R-"), c, F.lit("-"), k).alias("Reference"),
        F.concat(F.lit("Customer "), c).alias("Requestor"),
        F.col("o_orderpriority").alias("User"),
        (k % 2 == 0).alias("AllowPartialShipment"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("OrderDate"),
        F.struct(
            F.concat(F.lit("Ship "), c).alias("name"),
            F.struct(
                F.concat(c % 100, F.lit(" Main St")).alias("street"),
                F.when(c % 3 != 0, c + 10000).alias("zipCode"),
            ).alias("Address"),
            phone.alias("Phone"),
        ).alias("ShippingInstructions"),
        lines.alias("LineItems"),
    )
    text = F.to_json(doc, {"ignoreNullFields": "false"})
    return compute_once(t.spread("orders"), doc=text).select("o_orderkey", "doc")


def parsed_orders(t):
    """Documents parsed once into a typed struct ``d``."""
    return compute_once(purchase_orders(t), d=F.from_json("doc", PO_SCHEMA))


def variant_orders(t):
    return compute_once(purchase_orders(t), v=F.parse_json("doc"))


@query("json_documents", "JS9", PO)
def json_documents(t):
    return purchase_orders(t)


_ODD = """
    SELECT event_id, CASE event_id % 7 WHEN 0 THEN props WHEN 1 THEN substring(props, 1, length(props) - 1)
      WHEN 2 THEN '{"k":1,"k":2}' WHEN 3 THEN event_id::VARCHAR WHEN 4 THEN NULL WHEN 5 THEN '[' || event_id || ', 2]' ELSE '' END AS doc FROM events"""


def odd_documents(t):
    k = F.col("event_id") % 7
    doc = (
        F.when(k == 0, F.col("props"))
        .when(k == 1, F.expr("substring(props, 1, length(props) - 1)"))
        .when(k == 2, '{"k":1,"k":2}')
        .when(k == 3, F.col("event_id").cast("string"))
        .when(k == 4, F.lit(None))
        .when(k == 5, F.concat(F.lit("["), "event_id", F.lit(", 2]")))
        .otherwise("")
    )
    return t.events.select("event_id", doc.alias("doc"))


@query(
    "is_json",
    "JS1",
    f"""
    SELECT event_id, doc IS NOT NULL AND json_valid(doc) AND json_type(CASE WHEN json_valid(doc) THEN doc END) IN ('OBJECT', 'ARRAY') AS is_json,
      doc IS NOT NULL AND json_valid(doc) AND json_type(CASE WHEN json_valid(doc) THEN doc END) IN ('OBJECT', 'ARRAY')
        AND NOT doc = '{{"k":1,"k":2}}' AS is_strict,
      doc IS NOT NULL AND NOT (json_valid(doc) AND coalesce(json_type(CASE WHEN json_valid(doc) THEN doc END) IN ('OBJECT', 'ARRAY'), false)) AS is_not_json,
      doc IS NOT NULL AND json_valid(doc) AS is_any FROM ({_ODD})""",
)
def is_json(t):
    doc = F.col("doc")
    return odd_documents(t).select(
        "event_id",
        js.is_json(doc).alias("is_json"),
        js.is_json(doc, strict=True).alias("is_strict"),
        js.is_not_json(doc).alias("is_not_json"),
        js.is_json(doc, scalars=True).alias("is_any"),
    )


@query(
    "json_clean_bad",
    "JS1",
    f"""SELECT event_id, doc FROM ({_ODD}) WHERE doc IS NULL OR (json_valid(doc)
        AND json_type(CASE WHEN json_valid(doc) THEN doc END) IN ('OBJECT', 'ARRAY'))""",
)
def json_clean_bad(t):
    return odd_documents(t).where(~js.is_not_json(F.col("doc")) | F.col("doc").isNull())


@query(
    "json_dot_access",
    "JS2",
    f"""
    SELECT o_orderkey, doc->>'$.PONumber' AS po, doc->>'$.ShippingInstructions.name' AS name,
           doc->>'$.LineItems[0].Part.Description' AS first_part, doc->>'$.ponumber' AS wrong_case,
           to_json(doc->>'$.LineItems[*].Part.Description')::VARCHAR AS parts
    FROM ({PO})""",
)
def json_dot_access(t):
    v = F.col("v")
    return variant_orders(t).select(
        "o_orderkey",
        F.try_variant_get(v, "$.PONumber", "string").alias("po"),
        F.try_variant_get(v, "$.ShippingInstructions.name", "string").alias("name"),
        F.try_variant_get(v, "$.LineItems[0].Part.Description", "string").alias("first_part"),
        F.try_variant_get(v, "$.ponumber", "string").alias("wrong_case"),
        F.to_json(F.from_json("doc", PO_SCHEMA)["LineItems"]["Part"]["Description"]).alias("parts"),
    )


@query(
    "json_value",
    "JS3 JS22",
    f"""
    SELECT o_orderkey, doc->>'$.Requestor' AS requestor, (doc->>'$.PONumber')::BIGINT AS number, (doc->>'$.OrderDate')::DATE AS ordered,
           'Normal' AS priority, doc->>'$.AllowPartialShipment' AS partial, NULL::VARCHAR AS not_scalar,
           -1::BIGINT AS not_number, NULL::BIGINT AS no_number, NULL::VARCHAR AS json_null_or_zip
    FROM ({PO})""",
)
def json_value(t):
    v = F.col("v")
    zip_text = js.json_value(v, "$.ShippingInstructions.Address.zipCode", default_on_empty="none")
    return variant_orders(t).select(
        "o_orderkey",
        js.json_value(v, "$.Requestor").alias("requestor"),
        js.json_value(v, "$.PONumber", "bigint", on_error="error").alias("number"),
        js.json_value(v, "$.OrderDate", "date").alias("ordered"),
        js.json_value(v, "$.Priority", default_on_empty="Normal").alias("priority"),
        js.json_value(v, "$.AllowPartialShipment").alias("partial"),
        js.json_value(v, "$.ShippingInstructions").alias("not_scalar"),
        js.json_value(v, "$.Requestor", "bigint", default_on_error=-1).alias("not_number"),
        js.json_value(v, "$.Requestor", "bigint").alias("no_number"),
        F.nullif(zip_text, zip_text).alias("json_null_or_zip"),
    )


@query(
    "json_query",
    "JS4",
    f"""
    WITH d AS (SELECT o_orderkey, doc, doc->>'$.ShippingInstructions.Phone[*].type' AS types FROM ({PO}))
    SELECT o_orderkey, (doc->'$.ShippingInstructions.Address')::VARCHAR AS address, (doc->'$.LineItems')::VARCHAR AS lines,
      CASE WHEN len(types) > 0 THEN to_json(types)::VARCHAR END AS wrapped,
      CASE len(types) WHEN 0 THEN NULL WHEN 1 THEN '"' || types[1] || '"' ELSE to_json(types)::VARCHAR END AS conditional,
      CASE WHEN len(types) = 1 THEN '"' || types[1] || '"' END AS unwrapped,
      to_json(types)::VARCHAR AS empty_array
    FROM d""",
)
def json_query(t):
    types = F.col("d")["ShippingInstructions"]["Phone"]["type"]
    keep = {"ignoreNullFields": "false"}
    return parsed_orders(t).select(
        "o_orderkey",
        F.to_json(F.col("d")["ShippingInstructions"]["Address"], keep).alias("address"),
        F.to_json(F.col("d")["LineItems"], keep).alias("lines"),
        js.json_query(types, "with").alias("wrapped"),
        js.json_query(types, "conditional").alias("conditional"),
        js.json_query(types).alias("unwrapped"),
        js.json_query(types, "with", empty="array").alias("empty_array"),
    )


@query(
    "json_exists",
    "JS5 JS20",
    f"""
    WITH d AS (SELECT o_orderkey, doc, from_json(doc->'$.LineItems', '[{{"Quantity":"BIGINT","Part":{{"UnitPrice":"BIGINT","UPCCode":"VARCHAR"}}}}]') AS li FROM ({PO}))
    SELECT o_orderkey, (doc->'$.ShippingInstructions.Address.zipCode') IS NOT NULL AS has_member,
      len(list_filter(li, lambda x: x.Quantity > 10 AND x.Part.UnitPrice > 50)) > 0 AS same_item,
      len(list_filter(li, lambda x: x.Quantity > 10)) > 0 AND len(list_filter(li, lambda x: x.Part.UnitPrice > 50)) > 0 AS any_items,
      len(list_filter(li, lambda x: x.Part.UPCCode = '888031')) > 0 AS bound,
      (doc->>'$.User') = '1-URGENT' AND len(list_filter(li, lambda x: x.Quantity > 3)) > 0 AS nested
    FROM d""",
)
def json_exists(t):
    lines = F.col("d")["LineItems"]
    upc = F.lit("888031")
    big, dear = (lambda x: x["Quantity"] > 10), (lambda x: x["Part"]["UnitPrice"] > 50)
    return parsed_orders(t).select(
        "o_orderkey",
        F.try_variant_get(F.parse_json("doc"), "$.ShippingInstructions.Address.zipCode", "variant").isNotNull().alias("has_member"),
        F.exists(lines, lambda x: big(x) & dear(x)).alias("same_item"),
        (F.exists(lines, big) & F.exists(lines, dear)).alias("any_items"),
        F.exists(lines, lambda x: x["Part"]["UPCCode"] == upc).alias("bound"),
        ((F.col("d")["User"] == "1-URGENT") & F.exists(lines, lambda x: x["Quantity"] > 3)).alias("nested"),
    )


@query(
    "json_table_lines",
    "JS6 J13 W2",
    f"""
    WITH d AS (SELECT doc FROM ({PO})),
    x AS (SELECT doc, unnest(CASE WHEN json_array_length(doc, '$.LineItems') = 0 THEN [NULL] ELSE range(json_array_length(doc, '$.LineItems')::BIGINT) END) AS i FROM d)
    SELECT (doc->>'$.PONumber')::BIGINT AS po_num, doc->>'$.Requestor' AS requestor, (i + 1)::INTEGER AS rn,
      (json_extract(doc, '$.LineItems[' || i || '].ItemNumber'))::BIGINT AS item_no,
      json_extract_string(doc, '$.LineItems[' || i || '].Part.Description') AS description,
      (json_extract(doc, '$.LineItems[' || i || '].Quantity'))::BIGINT AS qty
    FROM x""",
)
def json_table_lines(t):
    return js.json_table(
        purchase_orders(t), "doc", PO_SCHEMA,
        {"po_num": lambda d: d["PONumber"], "requestor": lambda d: d["Requestor"]},
        nested=lambda d: d["LineItems"],
        nested_columns={
            "item_no": lambda e: e["ItemNumber"],
            "description": lambda e: e["Part"]["Description"],
            "qty": lambda e: e["Quantity"],
        },
        ordinality="rn",
    )


@query(
    "json_table_mixed",
    "JS6 JS4",
    f"""
    SELECT doc->>'$.Requestor' AS requestor, (doc->'$.ShippingInstructions.Phone')::VARCHAR AS phones,
           to_json(doc->>'$.ShippingInstructions.Phone[*].number')::VARCHAR AS phone_numbers
    FROM ({PO}) WHERE (doc->>'$.AllowPartialShipment') = 'true' AND (doc->>'$.ShippingInstructions.Address.zipCode') IS NOT NULL""",
)
def json_table_mixed(t):
    rows = js.json_table(
        purchase_orders(t), "doc", PO_SCHEMA,
        {
            "requestor": lambda d: d["Requestor"],
            "phones": lambda d: F.to_json(d["ShippingInstructions"]["Phone"]),
            "phone_numbers": lambda d: js.json_query(d["ShippingInstructions"]["Phone"]["number"], "with", "array"),
            "partial": lambda d: d["AllowPartialShipment"],
            "has_zip": lambda d: d["ShippingInstructions"]["Address"]["zipCode"].isNotNull(),
        },
    )
    return rows.where("partial and has_zip").drop("partial", "has_zip")


@query(
    "lateral_lines",
    "J13 JS28 X3",
    f"""
    WITH d AS (SELECT o_orderkey, doc FROM ({PO})),
    x AS (SELECT o_orderkey, doc, unnest(range(json_array_length(doc, '$.LineItems')::BIGINT)) AS i FROM d)
    SELECT o_orderkey AS po_number, doc->>'$.ShippingInstructions.name' AS ship_to_name,
      json_extract_string(doc, '$.LineItems[' || i || '].Part.UPCCode') AS upc,
      (json_extract(doc, '$.LineItems[' || i || '].Quantity'))::BIGINT * (json_extract(doc, '$.LineItems[' || i || '].Part.UnitPrice'))::BIGINT AS amount
    FROM x""",
)
def lateral_lines(t):
    purchase_orders(t).createOrReplaceTempView("purchase_order_docs")
    t.spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY VIEW purchase_order_lines AS
        SELECT d.PONumber AS po_number, d.ShippingInstructions.name AS ship_to_name, item.*
        FROM (SELECT from_json(doc, '{PO_SCHEMA}') AS d FROM purchase_order_docs) LATERAL VIEW explode(d.LineItems) i AS item
        """
    )
    return t.spark.sql(
        """SELECT po_number, ship_to_name, Part.UPCCode AS upc, Quantity * Part.UnitPrice AS amount FROM purchase_order_lines"""
    )


@query(
    "json_serialize",
    "JS7",
    """SELECT event_id, replace(props, ' ', '') AS compact, '{' || chr(10) || '  "k" : ' || (props->>'$.k') || chr(10) || '}' AS pretty FROM events""",
)
def json_serialize(t):
    return t.events.select(
        "event_id", js.compact(F.col("props")).alias("compact"), js.pretty(F.col("props"), "k bigint").alias("pretty")
    )


@query(
    "json_equal",
    "JS8",
    """SELECT event_id, event_id % 2 = 0 AS same FROM events""",
)
def json_equal(t):
    k = F.get_json_object("props", "$.k")
    a = F.concat(F.lit('{"a": {"x": 1, "y": [1, 2]}, "k": '), k, F.lit("}"))
    b = F.concat(F.lit('{"k":'), k, F.lit(',"a":{"y":[1,2],"x":'), 1 + F.col("event_id") % 2, F.lit("}}"))
    return t.events.select("event_id", js.json_equal(a, b).alias("same"))


@query(
    "json_build",
    "JS9 JS10 JS30",
    """
    SELECT o_orderkey,
      '{"id":' || o_orderkey || ',"status":' || coalesce('"' || nullif(o_orderstatus, 'F') || '"', 'null') || ',"ordered":"'
        || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') || '"}' AS full_object,
      '{' || concat_ws(',', '"id":' || o_orderkey, '"status":"' || nullif(o_orderstatus, 'F') || '"') || '}' AS slim_object,
      '[' || concat_ws(',', '"' || o_orderpriority || '"', '"' || nullif(o_orderstatus, 'F') || '"', o_custkey::VARCHAR) || ']' AS slim_array,
      '["' || o_orderpriority || '",' || coalesce('"' || nullif(o_orderstatus, 'F') || '"', 'null') || ',' || o_custkey || ']' AS full_array,
      '{"name":"' || o_orderpriority || '","active":' || (o_orderstatus = 'O') || '}' AS with_json,
      '{"raw":"' || hex(o_orderstatus) || '","odd":' || CASE o_orderkey % 3 WHEN 0 THEN '"Inf"' WHEN 1 THEN '"Nan"' ELSE '1.5' END || '}' AS special
    FROM orders""",
)
def json_build(t):
    status = F.nullif("o_orderstatus", F.lit("F"))
    active = F.when(F.col("o_orderstatus") == "O", "true").otherwise("false")
    odd = F.when(F.col("o_orderkey") % 3 == 0, float("inf")).when(F.col("o_orderkey") % 3 == 1, float("nan")).otherwise(1.5)
    frame = t.orders.select("*", F.col("o_orderstatus").cast("binary").alias("raw"), odd.alias("odd"))
    schema = frame.schema
    return frame.select(
        "o_orderkey",
        js.json_object({"id": F.col("o_orderkey"), "status": status, "ordered": F.col("o_orderdate")}).alias("full_object"),
        js.json_object({"id": F.col("o_orderkey"), "status": status}, absent_on_null=True).alias("slim_object"),
        js.json_array([F.col("o_orderpriority"), status, F.col("o_custkey")]).alias("slim_array"),
        js.json_array([F.col("o_orderpriority"), status, F.col("o_custkey")], null_on_null=True).alias("full_array"),
        js.json_object({"name": F.col("o_orderpriority"), "active": js.embedded(active)}).alias("with_json"),
        js.json_object(
            {n: js.rendered(F.col(n), schema[n].dataType) for n in ("raw", "odd")}
        ).alias("special"),
    )


@query(
    "json_mergepatch",
    "JS11",
    f"""
    WITH d AS (SELECT o_orderkey, json_object('a', json_object('x', o_orderkey, 'y', 2), 'b', o_orderstatus, 'c', 3) AS doc,
      CASE o_orderkey % 3 WHEN 0 THEN '{{"a":{{"x":null,"z":9}},"c":null}}' WHEN 1 THEN '{{"b":[1,2],"d":{{"n":null}}}}' ELSE '{{"a":5}}' END AS patch FROM orders)
    SELECT o_orderkey, json_merge_patch(doc, patch)->>'$.a' AS a, json_merge_patch(doc, patch)->>'$.b' AS b,
      json_merge_patch(doc, patch)->>'$.c' AS c, json_merge_patch(doc, patch)->>'$.d' AS d,
      CASE o_orderkey % 3 WHEN 0 THEN '{{"a":{{"x":null,"y":2,"z":9}},"b":"' || (doc->>'b') || '","c":null}}'
        WHEN 1 THEN '{{"a":{{"x":' || o_orderkey || ',"y":2}},"b":[1,2],"c":3,"d":{{"n":null}}}}'
        ELSE '{{"a":5,"b":"' || (doc->>'b') || '","c":3}}' END AS merged FROM d""",
)
def json_mergepatch(t):
    k = F.col("o_orderkey")
    doc = F.to_json(
        F.struct(F.struct(k.alias("x"), F.lit(2).alias("y")).alias("a"), F.col("o_orderstatus").alias("b"), F.lit(3).alias("c"))
    )
    patch = (
        F.when(k % 3 == 0, '{"a":{"x":null,"z":9},"c":null}').when(k % 3 == 1, '{"b":[1,2],"d":{"n":null}}').otherwise('{"a":5}')
    )
    both = t.spread("orders").select(
        "o_orderkey", js.merge_patch(doc, patch).alias("patched"), js.deep_merge(doc, patch).alias("merged")
    )
    return both.select(
        "o_orderkey", *[F.get_json_object("patched", f"$.{c}").alias(c) for c in "abcd"], "merged"
    )


@query(
    "json_edit",
    "JS12 JS13 JS14",
    """
    WITH d AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_custkey AS c FROM orders)
    SELECT k, '{"id":' || k || ',"status":"' || s || '","cust":' || c || ',"price":5}' AS put,
      '{"id":' || k || ',"cust":' || c || ',"status":null}' AS put_null,
      '{"id":' || k || ',"status":"' || s || '","cust":' || c || ',"tags":[1,{"a":true}]}' AS put_array,
      '{"id":' || k || ',"cust":' || c || '}' AS removed, '{"key":' || k || ',"status":"' || s || '","cust":' || c || '}' AS renamed,
      '{"id":' || k || ',"cust":' || c || ',"status":"Z","more":true}' AS merged,
      '{"id":' || k || ',"cust":' || c || '}' AS picked, '{"status":"' || s || '","cust":' || c || '}' AS omitted
    FROM d""",
)
def json_edit(t):
    text = F.to_json(
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"))
    )
    docs = compute_once(t.spread("orders").select(F.col("o_orderkey").alias("k"), text.alias("doc")), m=js.members(F.col("doc")))
    m = F.col("m")
    other = js.members(F.lit('{"status":"Z","more":true}'))
    return docs.select(
        "k",
        js.text_of(js.put(m, "price", F.lit(5))).alias("put"),
        js.text_of(js.put(m, "status", F.lit(None).cast("string"))).alias("put_null"),
        js.text_of(js.put_json(m, "tags", F.lit('[1,{"a":true}]'))).alias("put_array"),
        js.text_of(js.remove(m, "status")).alias("removed"),
        js.text_of(js.rename_key(m, "id", "key")).alias("renamed"),
        js.text_of(js.merge_in(m, other)).alias("merged"),
        js.text_of(js.pick(m, ["id", "cust", "nothing"])).alias("picked"),
        js.text_of(js.remove(m, "id", "nothing")).alias("omitted"),
    )


@query(
    "json_inspect",
    "JS15",
    f"""
    SELECT o_orderkey, array_to_string(json_keys(doc), ',') AS names, true AS has_user, false AS has_other,
      'object' AS type_shipping, 'array' AS type_lines, 'boolean' AS type_partial, 'number' AS type_number,
      CASE WHEN (doc->>'$.ShippingInstructions.Address.zipCode') IS NULL THEN 'null' ELSE 'number' END AS type_zip,
      8 AS size, json_array_length(doc, '$.LineItems')::INTEGER AS line_size,
      CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS partial_text
    FROM ({PO})""",
)
def json_inspect(t):
    v, doc = F.col("v"), F.col("doc")

    def kind(path):
        return js.json_type(F.try_variant_get(v, path, "variant"))

    return variant_orders(t).select(
        "o_orderkey",
        F.array_join(F.json_object_keys("doc"), ",").alias("names"),
        F.array_contains(F.json_object_keys("doc"), "User").alias("has_user"),
        F.array_contains(F.json_object_keys("doc"), "Other").alias("has_other"),
        kind("$.ShippingInstructions").alias("type_shipping"),
        kind("$.LineItems").alias("type_lines"),
        kind("$.AllowPartialShipment").alias("type_partial"),
        kind("$.PONumber").alias("type_number"),
        kind("$.ShippingInstructions.Address.zipCode").alias("type_zip"),
        js.json_size(doc).alias("size"),
        js.json_size(F.get_json_object("doc", "$.LineItems")).alias("line_size"),
        js.json_value(v, "$.AllowPartialShipment").alias("partial_text"),
    )


@query(
    "json_array_edits",
    "JS16 JS17",
    """
    WITH d AS (SELECT o_orderkey AS k, [o_orderkey, o_custkey, 30, 40, 50] AS a FROM orders)
    SELECT k, to_json(list_append(a, 42))::VARCHAR AS appended, to_json([7::BIGINT] || a[2:])::VARCHAR AS overwritten,
      to_json(a[1:1] || [7::BIGINT] || a[2:])::VARCHAR AS inserted, to_json(a[1:2] || a[4:])::VARCHAR AS removed,
      to_json([a[1]])::VARCHAR AS at_index, to_json([a[5], a[1], a[2]])::VARCHAR AS listed, to_json(a[2:4])::VARCHAR AS ranged,
      to_json([a[1]] || a[3:4])::VARCHAR AS mixed FROM d""",
)
def json_array_edits(t):
    array = F.array("o_orderkey", "o_custkey", *[F.lit(n).cast("bigint") for n in (30, 40, 50)])
    docs = t.orders.select(F.col("o_orderkey").alias("k"), F.to_json(array).alias("doc"))
    a = F.from_json("doc", "array<bigint>")
    seven = F.lit(7).cast("bigint")
    shown = {
        "appended": F.array_append(a, F.lit(42).cast("bigint")),
        "overwritten": js.array_put(a, 0, seven),
        "inserted": js.array_insert(a, 1, seven),
        "removed": js.array_remove_at(a, 2),
        "at_index": js.steps(a, [0]),
        "listed": js.steps(a, [4, 0, 1]),
        "ranged": js.steps(a, [(1, 3)]),
        "mixed": js.steps(a, [0, (2, 3)]),
    }
    return docs.select("k", *[F.to_json(c).alias(n) for n, c in shown.items()])


@query(
    "json_descendants",
    "JS18",
    """SELECT o_orderkey, '["' || o_custkey || '","2","' || o_orderkey || '"]' AS found FROM orders""",
)
def json_descendants(t):
    doc = F.concat(
        F.lit('{"a":{"b":{"z":'), "o_custkey", F.lit('},"c":[5,{"z":2}],"z":'), "o_orderkey", F.lit('},"z":4}')
    )
    schema = "a struct<b: struct<z: bigint>, c: array<variant>, z: bigint>, z bigint"
    parsed = t.orders.select("o_orderkey", F.from_json(doc, schema).alias("d"))
    inner = parsed.schema["d"].dataType["a"].dataType
    return parsed.select("o_orderkey", F.to_json(js.descendants(F.col("d.a"), inner, "z")).alias("found"))


@query(
    "json_relaxed",
    "JS19",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id::VARCHAR ELSE event_id || ',7' END AS ids, event_id AS first_id FROM events""",
)
def json_relaxed(t):
    k = F.col("event_id")
    doc = F.when(k % 2 == 0, F.concat(F.lit('{"id":'), k, F.lit("}"))).otherwise(F.concat(F.lit('{"id":['), k, F.lit(",7]}")))
    ids = js.relaxed_items(F.parse_json(doc), "id", "bigint")
    return t.events.select("event_id", F.array_join(ids.cast("array<string>"), ",").alias("ids"), F.get(ids, F.lit(0)).alias("first_id"))


@query(
    "json_predicates",
    "JS20 JS22",
    f"""
    WITH d AS (SELECT o_orderkey, from_json(doc->'$.LineItems', '[{{"Quantity":"BIGINT","Part":{{"Description":"VARCHAR","UPCCode":"VARCHAR"}}}}]') AS li FROM ({PO}))
    SELECT o_orderkey, len(list_filter(li, lambda x: x.Quantity <> 5 AND x.Quantity >= 3 AND NOT x.Quantity > 15))::INTEGER AS ranged,
      len(list_filter(li, lambda x: contains(x.Part.Description, 't 1')))::INTEGER AS has_substring,
      len(list_filter(li, lambda x: starts_with(x.Part.Description, 'Part 2')))::INTEGER AS starts,
      len(list_filter(li, lambda x: x.Part.Description LIKE 'Part _'))::INTEGER AS liked,
      len(list_filter(li, lambda x: regexp_matches(x.Part.Description, '[37]')))::INTEGER AS like_regex,
      len(list_filter(li, lambda x: regexp_full_match(x.Part.Description, 'Part [0-9]')))::INTEGER AS eq_regex,
      len(list_filter(li, lambda x: x.Quantity IN (1, 4, 7)))::INTEGER AS listed,
      len(list_filter(li, lambda x: x.Part.UPCCode::BIGINT > 888500))::INTEGER AS reconciled
    FROM d""",
)
def json_predicates(t):
    lines = F.col("d")["LineItems"]

    def n(f):
        return F.size(F.filter(lines, f))

    def text(x):
        return x["Part"]["Description"]

    return parsed_orders(t).select(
        "o_orderkey",
        n(lambda x: (x["Quantity"] != 5) & (x["Quantity"] >= 3) & ~(x["Quantity"] > 15)).alias("ranged"),
        n(lambda x: text(x).contains("t 1")).alias("has_substring"),
        n(lambda x: text(x).startswith("Part 2")).alias("starts"),
        n(lambda x: text(x).like("Part _")).alias("liked"),
        n(lambda x: text(x).rlike("[37]")).alias("like_regex"),
        n(lambda x: text(x).rlike("^(?:Part [0-9])$")).alias("eq_regex"),
        n(lambda x: x["Quantity"].isin(1, 4, 7)).alias("listed"),
        n(lambda x: x["Part"]["UPCCode"].try_cast("bigint") > 888500).alias("reconciled"),
    )


@query(
    "json_item_methods",
    "JS21",
    """
    SELECT o_orderkey, o_orderstatus || ',' || lower(o_orderpriority) AS strings, '-2,' || o_custkey || '.5' AS numbers, 'true' AS booleans,
      2 + o_custkey + 1 AS ceilings, 2 + o_custkey AS floors, length(o_orderstatus) + length(o_orderpriority) AS lengths, 2 AS inner_size,
      '17' AS text_number
    FROM orders""",
)
def json_item_methods(t):
    doc = F.concat(
        F.lit('["'), "o_orderstatus", F.lit('",-2,true,null,{"a":1,"b":2},['), "o_custkey", F.lit('],"'),
        F.lower("o_orderpriority"), F.lit('",'), "o_custkey", F.lit(".5]"),
    )
    items = F.from_json(doc, "array<variant>")

    def cast(kind, t_):
        return F.transform(js.only(items, kind), lambda v: F.try_variant_get(v, "$", t_))

    rows = t.orders.select(
        "o_orderkey", cast("string", "string").alias("s"), cast("number", "decimal(20,1)").alias("n"),
        cast("boolean", "string").alias("b"), F.get(js.only(items, "object"), F.lit(0)).alias("o"),
    )

    def total(f):
        return F.aggregate(F.transform("n", lambda x: f(F.abs(x)).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)

    return rows.select(
        "o_orderkey",
        F.array_join("s", ",").alias("strings"),
        F.array_join(F.transform("n", lambda x: F.regexp_replace(x.cast("string"), r"\.0$", "")), ",").alias("numbers"),
        F.array_join("b", ",").alias("booleans"),
        total(F.ceil).alias("ceilings"),
        total(F.floor).alias("floors"),
        F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("lengths"),
        js.json_size(F.to_json("o")).alias("inner_size"),
        F.try_variant_get(F.parse_json(F.lit("17")), "$", "string").alias("text_number"),
    )


@query(
    "json_iso_forms",
    "JS23",
    """
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('second', ts)
      WHEN 3 THEN date_trunc('second', ts) + INTERVAL 330 MINUTE ELSE ts END AS moment FROM events""",
)
def json_iso_forms(t):
    k = F.col("event_id") % 5
    seconds = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(k == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(k == 1, seconds)
        .when(k == 2, F.concat(seconds, F.lit("Z")))
        .when(k == 3, F.concat(seconds, F.lit("-05:30")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    )
    return t.events.select("event_id", js.iso_timestamp(text).alias("moment"))


@query(
    "flatten_json_column",
    "JS24",
    """SELECT event_id, (props->>'$.k')::BIGINT AS "doc_k", event_type AS "doc_e.type", user_id AS "doc_e.user.id" FROM events""",
)
def flatten_json_column(t):
    inner = F.struct(F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user"))
    doc = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "e":'), F.to_json(inner), F.lit("}"))
    frame = t.events.select("event_id", doc.alias("doc"))
    # No schema is given: one aggregate finds the shape of the column.
    flat = js.flatten_json_column(frame, "doc")
    return flat.select("event_id", "doc_k", F.col("`doc_e.type`"), F.col("`doc_e.user.id`"))


@query(
    "safe_get",
    "JS26",
    f"""
    SELECT o_orderkey, coalesce(doc->>'$.ShippingInstructions.Address.zipCode', 'none') AS zip,
           coalesce(doc->>'$.LineItems[1].Part.UPCCode', 'none') AS second_upc, 'none' AS missing FROM ({PO})""",
)
def safe_get(t):
    v = F.col("v")
    return variant_orders(t).select(
        "o_orderkey",
        js.safe_get(v, "ShippingInstructions.Address.zipCode", "none").alias("zip"),
        js.safe_get(v, "LineItems.1.Part.UPCCode", "none").alias("second_upc"),
        js.safe_get(v, "Nothing.here.0", "none").alias("missing"),
    )


@query(
    "convert_json_csv",
    "JS27 S8",
    """SELECT c_custkey, c_custkey || ',' || c_mktsegment AS csv, '{"id":' || c_custkey || ',"seg":"' || c_mktsegment || '"}' AS back FROM customer""",
)
def convert_json_csv(t):
    schema = "id bigint, seg string"
    text = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg")))
    csv = t.customer.select("c_custkey", js.convert(text, "json", "csv", schema).alias("csv"))
    return csv.withColumn("back", js.convert(F.col("csv"), "csv", "json", schema))


@query(
    "convert_json_xml",
    "JS27",
    """SELECT c_custkey, '{"id":' || c_custkey || ',"seg":"' || c_mktsegment || '"}' AS back FROM customer""",
)
def convert_json_xml(t):
    schema = "id bigint, seg string"
    text = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg")))
    xml = t.customer.select("c_custkey", js.convert(text, "json", "xml", schema).alias("xml"))
    return xml.select("c_custkey", js.convert(F.col("xml"), "xml", "json", schema).alias("back"))


@query(
    "json_enrich_orders",
    "A12 JS29 X2",
    f"""
    WITH d AS (SELECT o_orderkey, doc, from_json(doc->'$.LineItems', '[{{"Quantity":"BIGINT","Part":{{"UnitPrice":"BIGINT"}}}}]') AS li FROM ({PO}))
    SELECT o_orderkey, substring(doc, 1, length(doc) - 1) || ',"TotalQuantity":' || coalesce(list_sum(list_transform(li, lambda x: x.Quantity)), 0)
      || ',"TotalAmount":' || coalesce(list_sum(list_transform(li, lambda x: x.Quantity * x.Part.UnitPrice)), 0) || '}}' AS doc
    FROM d""",
)
def json_enrich_orders(t):
    zero = F.lit(0).cast("bigint")
    lines = F.col("d")["LineItems"]
    quantity = F.aggregate(lines, zero, lambda a, x: a + x["Quantity"])
    amount = F.aggregate(lines, zero, lambda a, x: a + x["Quantity"] * x["Part"]["UnitPrice"])
    enriched = F.col("d").withField("TotalQuantity", quantity).withField("TotalAmount", amount)
    return parsed_orders(t).select("o_orderkey", F.to_json(enriched, {"ignoreNullFields": "false"}).alias("doc"))


@query(
    "purchase_order_documents",
    "A9 JS9 J12",
    """
    SELECT l_orderkey, '[' || string_agg(json_object('ItemNumber', l_linenumber, 'Part', l_partkey, 'Quantity', l_quantity::BIGINT)::VARCHAR, ','
             ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) || ']' AS lines
    FROM lineitem GROUP BY l_orderkey""",
)
def purchase_order_documents(t):
    line = F.struct(
        F.col("l_linenumber").alias("ItemNumber"), F.col("l_partkey").alias("Part"), F.col("l_quantity").cast("bigint").alias("Quantity")
    )
    return groups.json_array_agg(
        t.lineitem, ["l_orderkey"], line, ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "lines"
    )


@query(
    "typed_document_leaves",
    "JS24 P5",
    f"""SELECT (doc->>'$.PONumber')::BIGINT AS "PONumber", doc->>'$.ShippingInstructions.Address.street' AS street,
               (doc->>'$.ShippingInstructions.Address.zipCode')::BIGINT AS zip FROM ({PO})""",
)
def typed_document_leaves(t):
    flat = flatten_columns(parsed_orders(t).select("d.*"), ".")
    return flat.select(
        "PONumber",
        F.col("`ShippingInstructions.Address.street`").alias("street"),
        F.col("`ShippingInstructions.Address.zipCode`").alias("zip"),
    )


@query(
    "json_mergepatch_numbers",
    "JS11",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN '{"a":1234567890123456' || o_orderkey || '.10,"b":' || o_orderkey || 'e400,"c":1.50}' END AS patched FROM orders""",
)
def json_mergepatch_numbers(t):
    """Digits stay as written; a text that is no JSON gives null."""
    k = F.col("o_orderkey")
    doc = F.concat(F.lit('{"a":1234567890123456'), k, F.lit('.10,"b":7'), F.when(k % 5 > 0, "}").otherwise("")).alias("doc")
    patch = F.concat(F.lit('{"b":'), k, F.lit('e400,"c":1.50}')).alias("patch")
    rows = t.spread("orders").select("o_orderkey", doc, patch)
    return rows.select("o_orderkey", js.merge_patch(F.col("doc"), F.col("patch")).alias("patched"))


@query(
    "json_mergepatch_odd",
    "JS11",
    r"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '{"a":1,"b":"\u0000number:5"}' WHEN 1 THEN '{"a":1,"\u0000number:x":2}'
          WHEN 2 THEN '{"a":"\ud800","b":' || o_orderkey || '}' WHEN 3 THEN '{"a":1,"q\"\\":{"deep":["x"]}}' END AS patched,
          o_orderkey % 5 = 4 AS refused FROM orders""",
)
def json_mergepatch_odd(t):
    """Any character in names and values, an escaped lone surrogate, and a text that is no JSON, which is reported."""
    k = F.col("o_orderkey") % 5
    doc = F.when(k == 2, r'{"a":"\ud800"}').when(k == 4, '{"a":1').otherwise('{"a":1}').alias("doc")
    patch = (
        F.when(k == 0, r'{"b":"\u0000number:5"}').when(k == 1, r'{"\u0000number:x":2}')
        .when(k == 3, r'{"q\"\\":{"deep":["x"],"gone":null}}').otherwise(F.concat(F.lit('{"b":'), "o_orderkey", F.lit("}"))).alias("patch")
    )
    rows = t.spread("orders").select("o_orderkey", doc, patch)
    both = compute_once(rows, done=js.merge_patch_checked(F.col("doc"), F.col("patch")))
    return both.select("o_orderkey", F.col("done.result").alias("patched"), F.col("done.error").startswith("document: ").alias("refused")).fillna({"refused": False})


@query(
    "json_deep_descendants",
    "JS18",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN '[]' ELSE '["' || o_custkey || '","{' || '\\"y\\":[{' || '\\"z\\":5}]}","5","[1,{' || '\\"z\\":' || o_orderkey || '}]","' || o_orderkey || '","null"]' END AS found
       FROM orders""",
)
def json_deep_descendants(t):
    """Members called z at depths one to seven, inside objects, arrays and each other; a shape per document."""
    deep = F.concat(
        F.lit('{"a":{"b":[[{"c":{"d":[{"z":'), "o_custkey", F.lit('}]}}],3],"c":{"z":{"y":[{"z":5}]}}},"z":[1,{"z":'), "o_orderkey", F.lit('}],"zz":{"z":null}}')
    )
    doc = F.when(F.col("o_orderkey") % 4 == 3, F.lit('{"x":[{"y":"z"}]}')).otherwise(deep)
    rows = t.spread("orders").select("o_orderkey", F.parse_json(doc).alias("doc"))
    return js.deep_descendants(rows, "doc", "z").select("o_orderkey", F.to_json("found").alias("found"))


@query(
    "json_rows_function",
    "X3 JS6",
    """WITH f AS (SELECT l_orderkey, l_linenumber, min(row(l_partkey, l_suppkey, l_quantity)) AS r FROM lineitem GROUP BY 1, 2),
       n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS e FROM f)
       SELECT o_orderkey, e::INTEGER AS element_no, l_linenumber::BIGINT AS line, r[3] AS quantity, 'P' || r[1] AS part,
         CASE WHEN l_linenumber % 2 = 0 THEN '{"n":' || l_linenumber || '}' END AS extra
       FROM orders LEFT JOIN n ON l_orderkey = o_orderkey AND o_orderkey % 7 > 0""",
)
def json_rows_function(t):
    """The lines of order documents by a table function called from SQL; orders without lines keep a row."""
    line = F.struct(
        F.col("l_linenumber").alias("no"), F.col("l_quantity").alias("qty"),
        F.struct(F.concat(F.lit("P"), "l_partkey").alias("code")).alias("part"),
        F.when(F.col("l_linenumber") % 2 == 0, F.struct(F.col("l_linenumber").alias("n"))).alias("extra"),
    )
    first = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min_by(line, F.struct("l_partkey", "l_suppkey", "l_quantity")).alias("line"))
    lines = first.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    # the join's tasks call Python too, so their number follows the orders and not the bytes
    dealt = t.orders.repartition(task_count(t.spark, t.orders.count()), "o_orderkey")
    orders = dealt.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.to_json(F.struct(F.struct("lines").alias("order")))).alias("doc")
    )
    jsonrows.register(t.spark)
    return t.spark.sql(
        "SELECT * FROM json_rows(TABLE({docs}), '$.order.lines[*]', "
        "'line bigint no, quantity double qty, part string part.code, extra string')",
        docs=orders,
    )
