"""Worked examples with known answers."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import cells, html, jsondoc, moments, names, text
from millrace.operators import clean, lines, loans
from millrace.plans import generate
from millrace.plans.spec import (
    ColumnSpec, TableSpec, declared_length, external_key, logical_of_crm, logical_of_relational, spec_of, writable,
)


def one(spark, column, value=None, kind="string"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "name,wanted",
    [
        ("LastName", "LAST_NAME"), ("  ", "COL"), ("2ndPhone", "C_2_ND_PHONE"), ("order", "ORDER_COL"),
        ("a--b c", "A_B_C"), ("___", "COL"), ("HTTPServer", "HTTPSERVER"), ("addr1Line2", "ADDR_1_LINE_2"),
    ],
)
def test_canonical_names(spark, name, wanted):
    got = one(spark, names.canonical_snake(F.col("v")), name)
    assert got == wanted
    assert one(spark, names.canonical_snake(F.col("v")), got) == got


def test_canonical_name_limits(spark):
    assert len(one(spark, names.canonical_snake(F.col("v")), "x" * 300)) == 128
    assert one(spark, names.canonical_snake(F.col("v"), max_len=8), "abcdefg_hij") == "ABCDEFG"
    assert one(spark, names.canonical_snake(F.col("v"), max_len=9, reserved=["ABCDEFGHI"]), "abcdefghi") == "ABCDE_COL"
    assert one(spark, names.canonical_snake(F.col("v"), forced_prefix="T"), "1a") == "T_1_A"
    assert one(spark, names.canonical_snake(F.col("v"), forced_prefix="T"), "date") == "T_DATE"


def test_round_trip_names(spark):
    there = names.cross_system_name(F.col("v"), "crm", "relational")
    back = names.cross_system_name(F.col("v"), "relational", "crm")
    assert one(spark, there, "Contact") == "SF_CONTACT"
    assert one(spark, back, "SF_CONTACT") == "CONTACT"
    assert one(spark, back, "CONTACT") == "ora_contact__c"
    assert one(spark, there, "ora_contact__c") == "CONTACT"
    assert one(spark, names.cross_system_name(F.col("v"), "crm", "crm"), "Any") == "Any"


def test_text_examples(spark):
    assert one(spark, text.truncate_text(F.col("v"), 8), "Hello World") == "Hello..."
    assert one(spark, text.url_slug(F.col("v")), "Hello World!") == "hello-world"
    assert one(spark, text.url_slug(F.col("v")), "Ünïcödé Têxt ﬁne") == "unicode-text-fine"
    sizes = {1024: ("1.0 KB", "1 KB"), 1234567: ("1.2 MB", "1.18 MB"), 0: ("0.0 B", "0 Bytes"), 1280: ("1.2 KB", "1.25 KB"), 1536 * 1024: ("1.5 MB", "1.5 MB")}
    for size, (short, long) in sizes.items():
        assert one(spark, text.human_bytes(F.col("v")), size, "bigint") == short
        assert one(spark, text.pretty_bytes(F.col("v")), size, "bigint") == long
    assert one(spark, text.url_params(F.col("v")), "https://example.com?foo=bar&baz=123&foo=last#x") == {"foo": "last", "baz": "123"}
    assert one(spark, text.url_encode(F.col("v")), "a b/~*") == "a%20b%2F~%2A"
    assert one(spark, text.tag_line_endings(F.col("v")), "a\r\nb") == "a<<CR>><<LF>>b"
    assert one(spark, text.markdown_title(F.col("v"), F.lit("none")), "intro\n  ## The Title ##\n# Next") == "The Title"


def test_date_examples(spark):
    def at(s):
        return F.lit(s).cast("timestamp_ntz")

    assert one(spark, moments.date_diff(at("2024-01-01"), at("2024-12-31"))) == 365
    assert one(spark, moments.date_diff(at("2024-01-02"), at("2024-01-01 12:00:00"))) == -1
    assert one(spark, moments.add_time(at("2024-01-31"), 1, "months")) == datetime.datetime(2024, 2, 29)
    assert one(spark, moments.format_date(at("2024-01-15 14:30:00"), "MMM DD, YYYY")) == "Jan 15, 2024"
    assert one(spark, moments.format_date(at("2024-01-15 14:30:00"), "DD/MM/YYYY HH:mm")) == "15/01/2024 14:30"
    now = at("2024-03-01")
    assert one(spark, moments.time_ago(at("2024-02-29 23:59:00"), now)) == "1 minute ago"
    assert one(spark, moments.time_ago(at("2024-01-01"), now)) == "2 months ago"
    assert one(spark, moments.time_ago(at("2024-02-29 23:59:30"), now)) == "just now"
    assert one(spark, moments.is_valid_date(F.col("v")), "2024-01-15") and not one(spark, moments.is_valid_date(F.col("v")), "invalid")


def test_cells(spark):
    assert one(spark, cells.coerce(F.col("v"), "array<bigint>"), "1, 2,3") == [1, 2, 3]
    assert one(spark, cells.coerce(F.col("v"), "bigint"), "123") == 123
    assert one(spark, cells.coerce(F.col("v"), "boolean"), "YES") is True
    assert one(spark, cells.is_blank(F.col("v")), " \t") and not one(spark, cells.is_blank(F.col("v")), "hello")
    for label in ("SSN: 123-45-6789", "social security number 123456789", "ss# 123 45 6789", "123.45.6789", "987654321"):
        assert one(spark, cells.redact_ssn(F.col("v")), f"x {label}, y") == "x [REDACTED], y"
    assert one(spark, cells.redact_ssn(F.col("v")), "call 555-1234") == "call 555-1234"
    assert one(spark, cells.nine_digit_runs(F.col("v")), "12-34 56789\n1234567890") == ["123456789", "123456789"]
    assert one(spark, cells.normalise_cell(F.col("v"), "number"), " 1,234.50 ") == 1234.5
    assert one(spark, cells.normalise_cell(F.col("v"), "number"), "1d") is None
    assert one(spark, cells.normalise_cell(F.col("v"), "boolean"), "false") == "N"
    assert one(spark, clean.decode(F.col("v"), {"P": "PRIMARY"}), "Z") == "UNKNOWN (Z)"


def test_ledger_strict_stops(spark):
    frame = spark.createDataFrame([("not a ledger line",)], "line string")
    parsed, _ = clean.parse_ledger_lines(frame, "line", strict=True)
    with pytest.raises(Exception, match="could not parse line"):
        parsed.collect()


def test_json_examples(spark):
    assert one(spark, jsondoc.json_equal(F.col("v"), F.lit('{"b":2,"a":1}')), '{"a":1, "b":2}')
    assert one(spark, jsondoc.json_array([F.lit(1), F.lit(None).cast("int"), F.lit(3)], null_on_null=True)) == "[1,null,3]"
    assert one(spark, jsondoc.json_array([F.lit(1), F.lit(None).cast("int"), F.lit(3)])) == "[1,3]"
    assert one(spark, jsondoc.json_object({"city": F.lit("Singapore"), "province": F.lit(None).cast("string")}, True)) == '{"city":"Singapore"}'
    phones = F.from_json(F.col("v"), "array<string>")
    assert one(spark, jsondoc.json_query(phones, "with"), '["Office","Mobile"]') == '["Office","Mobile"]'
    assert one(spark, jsondoc.json_query(phones, "conditional"), '["Office"]') == '"Office"'
    doc = '{"a":{"b":{"z":1},"c":[5,{"z":2}],"z":3},"z":4}'
    parsed = spark.createDataFrame([(doc,)], "v string").select(
        F.from_json("v", "a struct<b: struct<z: int>, c: array<variant>, z: int>, z int").alias("d")
    )
    kind = parsed.schema["d"].dataType["a"].dataType
    assert parsed.select(jsondoc.descendants(F.col("d.a"), kind, "z")).first()[0] == ["1", "2", "3"]
    assert one(spark, jsondoc.safe_get(F.parse_json("v"), "user.tags.1", "Anonymous"), '{"user":{"tags":["x","y"]}}') == "y"


@pytest.mark.parametrize(
    "base,patch,wanted",
    [
        ('{"a":"b"}', '{"a":"c"}', '{"a":"c"}'), ('{"a":"b"}', '{"b":"c"}', '{"a":"b","b":"c"}'),
        ('{"a":"b"}', '{"a":null}', "{}"), ('{"a":["b"]}', '{"a":"c"}', '{"a":"c"}'),
        ('{"a":{"b":"c"}}', '{"a":{"b":"d","c":null}}', '{"a":{"b":"d"}}'), ('["a","b"]', '["c"]', '["c"]'),
        ('{"a":"foo"}', '"bar"', '"bar"'), ('{"e":null}', '{"a":1}', '{"e":null,"a":1}'),
        ("[1,2]", '{"a":"b","c":null}', '{"a":"b"}'), ("{}", '{"a":{"bb":{"ccc":null}}}', '{"a":{"bb":{}}}'),
    ],
)
def test_merge_patch_examples(spark, base, patch, wanted):
    assert one(spark, jsondoc.merge_patch(F.col("v"), F.lit(patch)), base) == wanted


def test_flatten_unflatten_identity(spark):
    frame = spark.createDataFrame([((1, (2, "x")), 3)], "a struct<b: int, c: struct<d: int, e: string>>, f int")
    back = names.unflatten_columns(names.flatten_columns(frame, "."))
    assert back.collect() == frame.collect()


def test_html(spark):
    page = (
        "<h1>Hello</h1><p>This is <strong>bold</strong> and <em>it</em><br>x</p><script>bad()</script>"
        '<pre><code class="language-py">a = 1</code></pre><ol><li>one</li><li>two</li></ol><ul><li>dot</li></ul>'
        '<blockquote>a\nb</blockquote><hr><img src="i.png" alt="pic"><a href="/x">go <b>there</b></a><code>c</code>'
    )
    got = one(spark, html.html_to_markdown(F.col("v")), page)
    assert got == (
        "# Hello\n\nThis is **bold** and *it*  \nx\n\n```py\na = 1\n```\n\n1. one\n2. two\n\n- dot\n\n"
        "> a\n> b\n\n---\n\n![pic](i.png)[go **there**](/x)`c`"
    )
    links = one(spark, html.internal_links(F.col("v"), F.lit("http://h.org/")), page + '<a href="http://o.org">no</a><a href="/e"></a>')
    assert [(r["text"], r["absolute"]) for r in links] == [("gothere", "http://h.org/x")]


def test_lines_between_like_a_range(spark):
    doc = "a\nSTART 1\nb\nEND\nc\nSTART END\nd\nEND x\nSTART\nlast"
    frame = spark.createDataFrame([(1, doc)], "k int, t string")
    rows = lines.lines_between(frame, "k", "t", "START", "END").orderBy("range_no", "line_in_range").collect()
    assert [(r["range_no"], r["line"]) for r in rows] == [
        (1, "START 1"), (1, "b"), (1, "END"), (2, "START END"), (2, "d"), (2, "END x"), (3, "START"), (3, "last"),
    ]


def test_loan_that_never_clears(spark):
    frame = spark.createDataFrame([(1, 100_00, 1200, 50), (2, 100_00, 0, 40_00)], "loan_id bigint, principal bigint, rate_bp bigint, payment bigint")
    rows = loans.loan_schedule(frame).groupBy("loan_id").agg(F.max("month").alias("m"), F.sum("paid").alias("p")).collect()
    got = {r["loan_id"]: (r["m"], r["p"]) for r in rows}
    assert got[1][0] == 1000 and got[2] == (3, 100_00)


def test_specs(spark):
    spec = TableSpec("t", (ColumnSpec("Id", primary_key=True, read_only=False), ColumnSpec("price", "float", precision=15, scale=2), ColumnSpec("ext", external_key=True, max_length=20), ColumnSpec("auto", computed=True)))
    frame = spark.createDataFrame([("a", None, "x", "y")], "Id string, price decimal(15,2), ext string, auto string")
    back = spec_of(spec.apply(frame), "t")
    assert back.primary_key == ["Id"] and back.column_map["price"].scale == 2 and back.column_map["ext"].max_length == 20
    assert external_key(spec) == "ext" and external_key(spec, "other") == "other" and external_key(TableSpec("u", ())) == "Id"
    assert writable(spec, "insert") == ["price", "ext"] and writable(spec, "update") == ["Id", "price", "ext"]
    assert [c.target_type for c in spec.columns] == ["CLOB", "NUMBER(15, 2)", "VARCHAR2(20 CHAR)", "CLOB"]
    assert logical_of_crm("picklist") == "string" and logical_of_crm("unheard") == "string" and logical_of_crm("currency") == "float"
    assert logical_of_relational("NUMBER", 0) == "integer" and logical_of_relational("TIMESTAMP(6)") == "datetime"
    assert declared_length(10) == 60 and declared_length(3990) == 4000
    with pytest.raises(ValueError):
        declared_length(4001)


def test_generated_types_are_unique_per_owner(spark):
    who = spark.range(1000, 3000).select(F.col("id").alias("demographic_id"))
    for made, kind in ((generate.gen_phone(who), "phone_type_id"), (generate.gen_address(who), "address_type_id")):
        assert made.groupBy("demographic_id", kind).count().where("count > 1").count() == 0
        assert made.count() >= 1999
