"""Files in and out: delimited text, JSON lines, parquet, folders, schema notes."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import work_folder
from ..sources import delimited, files
from .registry import query

_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def customer_lines(t):
    k = F.col("c_custkey")
    date = (
        F.when(k % 17 == 0, "not a date")
        .when(k % 23 == 0, "")
        .otherwise(F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 700).cast("int")), "yyyy-MM-dd"))
    )
    name = F.concat(F.lit('"'), "c_name", F.lit(', ""the'), F.when(k % 29 == 0, F.repeat(F.lit("x"), 4100)).otherwise(""), F.lit('"""'))
    short = F.concat_ws(",", k, name)
    full = F.concat_ws(",", k, name, date, F.col("c_acctbal").cast("decimal(15,2)"))
    return t.customer.select(F.when(k % 19 == 0, short).otherwise(full).alias("value"))


EXTERNAL = {"id": "bigint", "name": "string", "since": "date", "balance": "decimal(15,2)"}


def external_table(t):
    path = work_folder(t.spark, "external")
    customer_lines(t).write.text(path)
    return delimited.read_delimited(t.spark, path, EXTERNAL, header=False)


@query(
    "csv_read_good",
    "S1",
    """
    SELECT c_custkey AS id, c_name || ', "the"' AS name, CASE WHEN c_custkey % 23 <> 0 AND c_custkey % 19 <> 0
             THEN DATE '2020-01-01' + (c_custkey % 700)::INTEGER END AS since,
           CASE WHEN c_custkey % 19 <> 0 THEN c_acctbal::DECIMAL(15,2)::VARCHAR END AS balance
    FROM customer WHERE c_custkey % 29 <> 0 AND (c_custkey % 17 <> 0 OR c_custkey % 19 = 0)""",
)
def csv_read_good(t):
    return external_table(t)[0].withColumn("balance", F.col("balance").cast("string"))


@query(
    "csv_read_rejects",
    "S1",
    """
    SELECT c_custkey::VARCHAR AS id, concat_ws('; ', CASE WHEN c_custkey % 29 = 0 THEN 'name too long' END,
             CASE WHEN c_custkey % 17 = 0 AND c_custkey % 19 <> 0 THEN 'since is not date' END) AS reject_reason
    FROM customer WHERE c_custkey % 29 = 0 OR (c_custkey % 17 = 0 AND c_custkey % 19 <> 0)""",
)
def csv_read_rejects(t):
    return external_table(t)[1].select("id", "reject_reason")


@query(
    "filler_append",
    "S2",
    """SELECT c_custkey AS id, count(*) AS loads FROM customer WHERE c_custkey % 29 <> 0 AND (c_custkey % 17 <> 0 OR c_custkey % 19 = 0)
       GROUP BY 1 UNION ALL SELECT -1 - s_suppkey, 1 FROM supplier""",
)
def filler_append(t):
    path = work_folder(t.spark, "append")
    good = external_table(t)[0]
    delimited.append_load(good, path, filler=["name", "since", "balance"])
    more = t.supplier.select((-1 - F.col("s_suppkey")).alias("id"), F.col("s_name").alias("skipped"))
    delimited.append_load(more, path, filler=["skipped"])
    return t.spark.read.parquet(path).groupBy("id").agg(F.count("*").alias("loads"))


@query(
    "union_csv_dir",
    "S3 U1 S7",
    """SELECT c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment, NULL::VARCHAR AS nation FROM customer
       UNION ALL SELECT s_suppkey::VARCHAR, s_name, NULL, s_nationkey::VARCHAR FROM supplier""",
)
def union_csv_dir(t):
    path = work_folder(t.spark, "folder")
    one = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    two = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    delimited.export_csv(one.repartition(3, "id"), path)
    delimited.export_csv(two, path, mode="append")
    return delimited.load_all_csvs(t.spark, path)


@query(
    "csv_export_text",
    "S7",
    """
    SELECT value FROM (SELECT DISTINCT 'id;text;amount' || chr(13) AS value FROM customer)
    UNION ALL SELECT c_custkey || ';' || CASE c_custkey % 4 WHEN 0 THEN '"a;b"' WHEN 1 THEN '"say ' || '""hi""' || '"' WHEN 2 THEN '' ELSE ' plain ' END || ';'
       || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_nationkey::VARCHAR END || chr(13) FROM customer""",
)
def csv_export_text(t):
    k = F.col("c_custkey")
    path = work_folder(t.spark, "export")
    text = F.when(k % 4 == 0, "a;b").when(k % 4 == 1, 'say "hi"').when(k % 4 == 2, F.lit(None)).otherwise(" plain ")
    rows = t.customer.select(k.alias("id"), text.alias("text"), F.when(k % 5 != 0, F.col("c_nationkey")).alias("amount"))
    delimited.export_csv(rows, path, "semicolon", "CRLF")
    lines = t.spark.read.option("lineSep", "\n").text(path)
    # every file has the header; it is listed once
    return lines.where(~F.col("value").startswith("id;")).union(lines.where(F.col("value").startswith("id;")).distinct())


@query(
    "csv_column_parse",
    "S8",
    """
    SELECT c_custkey, i::INTEGER AS record_no, 'r' || i AS id, CASE i WHEN 1 THEN 'x,"' || c_name || '"' || chr(10) || 'y' ELSE '' END AS note, '' AS missing
    FROM (SELECT c_custkey, c_name, unnest(range(1, c_custkey % 3 + 1)) AS i FROM customer)""",
)
def csv_column_parse(t):
    k = F.col("c_custkey")
    first = F.concat(F.lit('"x,""'), "c_name", F.lit('""\ny",r1\r\n'))
    body = F.when(k % 3 == 0, "").when(k % 3 == 1, first).otherwise(F.concat(first, F.lit(",r2\r\n")))
    text = t.customer.select(k, F.concat(F.lit("note,id\r\n"), body).alias("text"))
    return delimited.parse_csv_column(text, "text", ["id", "note", "missing"])


@query("jsonl_roundtrip", "S4 S9", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def jsonl_roundtrip(t):
    path = work_folder(t.spark, "jsonl")
    files.write_json_array(t.part, ["p_partkey", "p_name", "p_size", "p_retailprice"], path)
    return files.read_jsonl(t.spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query("csv_typed_read", "S5 S7", "SELECT p_partkey::INTEGER AS p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_typed_read(t):
    path = work_folder(t.spark, "typed")
    delimited.export_csv(t.part.select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    return files.read_fast(t.spark, path)


@query(
    "rows_to_json",
    "S9",
    """SELECT o_orderkey, '{"o_custkey":' || o_custkey || ',"nothing":null,"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
          || '","o_orderkey":"' || o_orderkey || '","raw":"' || base64(encode(o_orderstatus)) || '"}' AS record FROM orders""",
)
def rows_to_json(t):
    frame = t.orders.withColumn("raw", F.col("o_orderstatus").cast("binary"))
    record = files.rows_to_json(frame, ["o_custkey", "nothing", "o_orderdate", "o_orderkey", "raw"], as_text=["o_orderkey"])
    return frame.select("o_orderkey", record.alias("record"))


@query("parquet_convert", "S6 S3", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def parquet_convert(t):
    path = work_folder(t.spark, "convert")
    delimited.export_csv(t.nation, f"{path}/csv")
    files.convert_dir_to_parquet(t.spark, f"{path}/csv", f"{path}/parquet")
    return t.spark.read.parquet(f"{path}/parquet")


@query(
    "batched_files",
    "S13",
    "SELECT count(*) AS row_count, true AS within_size FROM orders",
)
def batched_files(t):
    path = work_folder(t.spark, "batches")
    files.write_batches(t.orders, path, 1000)
    per_file = t.spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("row_count"), (F.max("n") <= 1000).alias("within_size"))


@query(
    "submissions_append",
    "S14",
    """SELECT count(*) AS row_count, count(*) AS ids FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier)""",
)
def submissions_append(t):
    path = work_folder(t.spark, "submissions")
    for _ in range(2):
        files.append_submission(t.supplier, path)
    rows = t.spark.read.parquet(path)
    return rows.agg(F.count("*").alias("row_count"), F.count_distinct("id").alias("ids"))


@query("file_inventory", "S16", "SELECT 'txt' AS extension, count(DISTINCT l_returnflag) AS files FROM lineitem")
def file_inventory(t):
    path = work_folder(t.spark, "inventory")
    rows = t.lineitem.select("l_returnflag", F.col("l_orderkey").cast("string").alias("value"))
    files.write_folders(rows, path, "l_returnflag")
    found = files.read_files_as_rows(t.spark, path, "*.txt", larger_than=0)
    return found.groupBy("extension").agg(F.count("*").alias("files"))


@query(
    "schema_metadata",
    "S17",
    """SELECT n_nationkey, 'nightly' AS source FROM nation""",
)
def schema_metadata(t):
    path = work_folder(t.spark, "noted")
    files.write_parquet(files.attach_schema_metadata(t.nation, {"source": "nightly", "rows": "all"}), path)
    back = t.spark.read.parquet(path)
    return back.select("n_nationkey", F.lit(files.schema_metadata(back)["source"]).alias("source"))


@query(
    "read_listed_columns",
    "S10",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'",
)
def read_listed_columns(t):
    return files.read_table(
        t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey"], {"o_orderstatus": "O"}
    )


@query(
    "sorted_export",
    "T4 S6",
    "SELECT count(*) AS row_count, true AS sorted_files FROM orders",
)
def sorted_export(t):
    """Every written file is sorted by key: neighbours never step down.

    The number of files follows the input.  Rows are compared within blocks of a file,
    then the blocks' ends with each other.
    """
    path = work_folder(t.spark, "sorted")
    slim = t.orders.select("o_orderkey", "o_custkey")
    files.write_parquet(slim.repartitionByRange("o_custkey").sortWithinPartitions("o_custkey"), path)
    place = F.col("_metadata.row_index")
    back = t.spark.read.parquet(path).select("o_custkey", F.col("_metadata.file_path").alias("file"), place.alias("place"), F.floor(place / 8192).alias("block"))
    before = F.lag("o_custkey").over(W.partitionBy("file", "block").orderBy("place"))
    steps = back.withColumn("up", F.coalesce(before, F.col("o_custkey")) <= F.col("o_custkey"))
    ends = steps.groupBy("file", "block").agg(
        F.count("*").alias("n"), F.every("up").alias("up"), F.min_by("o_custkey", "place").alias("first"), F.max_by("o_custkey", "place").alias("last")
    )
    last = F.lag("last").over(W.partitionBy("file").orderBy("block"))
    joined = ends.select("n", (F.col("up") & (F.coalesce(last, F.col("first")) <= F.col("first"))).alias("up"))
    return joined.agg(F.sum("n").alias("row_count"), F.every("up").alias("sorted_files"))


@query(
    "csv_line_ends",
    "S1 S3 S5 S7",
    """SELECT how, c_custkey AS id, c_name || chr(10) || '"x",' || chr(10) || 'y' AS note FROM customer
       CROSS JOIN (SELECT unnest(['typed', 'folder', 'fast']) AS how)""",
)
def csv_line_ends(t):
    """Text with line ends, quotes and delimiters survives an export and all three readers."""
    path = work_folder(t.spark, "line-ends")
    note = F.concat("c_name", F.lit('\n"x",\ny'))
    delimited.export_csv(t.customer.select(F.col("c_custkey").alias("id"), note.alias("note")), path)
    typed, _ = delimited.read_delimited(t.spark, path, {"id": "bigint", "note": "string"})
    folder = delimited.load_all_csvs(t.spark, path)
    fast = files.read_fast(t.spark, path, "id bigint, note string")
    ways = {"typed": typed, "folder": folder, "fast": fast}
    rows = [df.select(F.lit(how).alias("how"), F.col("id").cast("bigint").alias("id"), "note") for how, df in ways.items()]
    return rows[0].union(rows[1]).union(rows[2])


@query(
    "csv_long_field",
    "S8",
    """SELECT s_suppkey, 1 AS record_no, length(s_name) * 20000 + 2 AS note_length, 'k' || s_suppkey AS id FROM supplier""",
)
def csv_long_field(t):
    """Quoted fields of some hundred thousand characters, doubled quotes inside."""
    long = F.concat(F.lit('"'), F.expr("repeat(s_name, 20000)"), F.lit('""\n"'))
    text = F.concat(F.lit("note,id\n"), long, F.lit(",k"), "s_suppkey", F.lit("\n"))
    rows = delimited.parse_csv_column(t.spread("supplier").select("s_suppkey", text.alias("text")), "text", ["note", "id"])
    return rows.select("s_suppkey", "record_no", F.length("note").alias("note_length"), "id")


@query(
    "csv_column_unclosed",
    "S8",
    """SELECT c_custkey, 1::INTEGER AS record_no, c_custkey::VARCHAR AS id, 'open' || chr(10) || '5,z' || c_custkey AS note FROM customer
       UNION ALL SELECT c_custkey, 0, 'x', '"' FROM customer WHERE false""",
)
def csv_column_unclosed(t):
    """A quote that is never closed runs to the end of the text; no record appears that was not there."""
    text = F.concat(F.lit("id,note\n"), "c_custkey", F.lit(',"open\n5,z'), "c_custkey")
    rows = delimited.parse_csv_column(t.customer.select("c_custkey", text.alias("text")), "text", ["id", "note"])
    return rows.select("c_custkey", F.col("record_no").cast("int").alias("record_no"), "id", "note")
