"""Staged rows and the relational tables fed from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.groups import latest_per_key
from ..operators.numbering import number_rows
from ..session import compute_once, cut_lineage
from . import load

# Staging sequence limit and first person number.
STAGE_SEQUENCE_MAX = 999_999
FIRST_PERSON = 111_111

PERSON_FIELDS = (
    "first_name middle_name last_name name_prefix name_suffix birthdate dt_of_death email_type sex mar_status"
).split()
ADDRESS_FIELDS = "address1 address2 address3 address4 city state county postal country".split()
AUDIT = "created_at created_by updated_at updated_by".split()


def shred_payload(
    payloads: DataFrame, column: str, fields: dict[str, str], fail_fast: bool = False
) -> DataFrame:
    """One NEW row per element of a JSON array; numeric fields must convert.

    Every field is read as text first.  A numeric field that does not convert
    stops the job with ``fail_fast``, else the row carries an error message.  So
    does a payload that is no JSON array: it gives one row without fields.
    A payload is parsed once, whatever is asked of it.
    """
    item = "array<struct<" + ", ".join(f"{n}: string" for n in fields) + ">>"
    carried = [c for c in payloads.columns if c != column]
    parsed = F.col("__parsed")
    broken = F.col(column).isNotNull() & parsed.isNull()
    lost = F.lit("payload is not a JSON array")
    if fail_fast:
        parsed = F.when(broken, F.raise_error(lost).cast(item)).otherwise(parsed)
    items = F.coalesce(parsed, F.when(broken, F.array(F.lit(None).cast(item[6:-1]))))
    rows = compute_once(payloads, __parsed=F.from_json(column, item)).select(
        *carried, F.when(broken, lost).alias("__lost"), F.posexplode(items).alias("item_no", "item")
    ).select(*carried, "__lost", "item_no", "item.*")
    typed, bad = {}, [F.col("__lost")]
    for name, kind in fields.items():
        if kind == "string":
            continue
        value = F.col(name).try_cast(kind)
        failed = F.col(name).isNotNull() & value.isNull()
        message = F.concat(F.lit(f"{name} is not {kind}: "), F.col(name))
        if fail_fast:
            value = F.when(failed, F.raise_error(message).cast(kind)).otherwise(value)
        typed[name] = value
        bad.append(F.when(failed, message))
    error = F.concat_ws("; ", *bad)
    return rows.withColumn("error_msg", F.when(error != "", error)).withColumns(
        {**typed, "status": F.lit("NEW")}
    ).drop("__lost")


def stage_records(df: DataFrame, order_by: Sequence[str], at: Column, placed: bool = False) -> DataFrame:
    """Give rows status NEW and a stage id: time stamp plus a six-digit cyclic number.

    ``placed`` is that of ``number_rows``.
    """
    numbered = number_rows(df, order_by, "__n", start=0, placed=placed)
    serial = (F.col("__n") % STAGE_SEQUENCE_MAX) + 1
    stamp = F.date_format(at, "yyyyMMddHHmmss")
    stage_id = F.concat(stamp, F.lpad(serial.cast("string"), 6, "0"))
    out = numbered.withColumns({"stage_id": stage_id, "stage_order": F.col("__n"), "status": F.lit("NEW")})
    return out.drop("__n")


def stage_payloads(
    payloads: DataFrame, column: str, fields: dict[str, str], order_by: Sequence[str], at: Column, fail_fast: bool = False
) -> DataFrame:
    """Staged rows of the payloads' elements, in the order of the payloads and then of the elements.

    A range sort reads its input twice, so it is the payloads that are sorted, as text;
    each is parsed once, where it lies then, and its rows are kept in the shared folder.
    """
    rows = cut_lineage(shred_payload(payloads.orderBy(*order_by), column, fields, fail_fast))
    return stage_records(rows, [*order_by, "item_no"], at, placed=True)


def settle(df: DataFrame) -> DataFrame:
    """SUCCESS or ERROR by error message; a bad row does not stop the others."""
    return df.withColumns(
        {
            "status": F.when(F.col("error_msg").isNull(), "SUCCESS").otherwise("ERROR"),
            "error_msg": F.substring("error_msg", 1, 4000),
        }
    )


def _stamped(df: DataFrame, at: Column, user: str) -> DataFrame:
    return df.withColumns(
        {"created_at": at, "created_by": F.lit(user), "updated_at": at, "updated_by": F.lit(user)}
    )


def upsert_person(person: DataFrame, staged: DataFrame, at: Column, user: str) -> tuple[DataFrame, DataFrame]:
    """(new person snapshot, person_id of every matchable (id, email) and of every other row).

    People match on (id, email_addr).  A match keeps its key, id and email; the
    last staged row wins.  New people are numbered in the order they first
    appear.  A row with a null part of the key never matches, so it is a new
    person of its own.
    """
    whole = F.col("id").isNotNull() & F.col("email_addr").isNotNull()
    row = F.struct(*PERSON_FIELDS)
    grouped = (
        staged.where(whole)
        .groupBy("id", "email_addr")
        .agg(F.max_by(row, "stage_order").alias("r"), F.min("stage_order").alias("first_seen"))
    )
    lone = staged.where(~whole).select("id", "email_addr", row.alias("r"), F.col("stage_order").alias("first_seen"))
    held = person.select("id", "email_addr", "person_id")
    # Read four times below, and one row per person: worth keeping.
    known = cut_lineage(grouped.join(held, ["id", "email_addr"], "left"))
    fresh = known.where("person_id is null").drop("person_id").withColumn("lone", F.lit(False))
    fresh = fresh.unionByName(lone.withColumn("lone", F.lit(True)))
    top = person.agg(F.max(F.col("person_id").cast("bigint"))).first()[0]
    start = FIRST_PERSON if top is None else max(FIRST_PERSON, top + 1)
    numbered = number_rows(fresh, ["first_seen"], "n", start).withColumn(
        "person_id", F.lpad(F.col("n").cast("string"), 9, "0")
    )
    incoming = known.where("person_id is not null").select("person_id", "id", "email_addr", "r.*").unionByName(
        numbered.select("person_id", "id", "email_addr", "r.*")
    )
    snapshot = load.upsert(
        person, _stamped(incoming, at, user), ["person_id"],
        insert_only=("id", "email_addr", "created_at", "created_by"),
    )
    # How staged rows find their person: by key, or by their own place for lone rows.
    by_key = known.where("person_id is not null").select("id", "email_addr", "person_id").unionByName(
        numbered.where(~F.col("lone")).select("id", "email_addr", "person_id")
    )
    nothing = F.lit(None).cast("bigint")
    links = by_key.withColumn("stage_order", nothing).unionByName(
        numbered.where("lone").select("id", "email_addr", "person_id", F.col("first_seen").alias("stage_order"))
    )
    return snapshot, links


def link_people(person: DataFrame, staged: DataFrame) -> DataFrame:
    """The links of ``upsert_person`` alone, made from key columns only.

    For child tables: no person row is built or merged, and only new people are
    numbered, on rows of a few columns.  Kept in the shared folder, so that several
    children can use the same links.
    """
    whole = F.col("id").isNotNull() & F.col("email_addr").isNotNull()
    nothing = F.lit(None).cast("bigint")
    seen = staged.where(whole).groupBy("id", "email_addr").agg(F.min("stage_order").alias("first_seen"))
    held = person.select("id", "email_addr", "person_id")
    known = cut_lineage(seen.join(held, ["id", "email_addr"], "left").withColumn("stage_order", nothing))
    lone = staged.where(~whole).select("id", "email_addr", F.col("stage_order").alias("first_seen"), nothing.alias("person_id"), "stage_order")
    fresh = known.where("person_id is null").unionByName(lone).drop("person_id")
    top = person.agg(F.max(F.col("person_id").cast("bigint"))).first()[0]
    start = FIRST_PERSON if top is None else max(FIRST_PERSON, top + 1)
    numbered = number_rows(fresh, ["first_seen"], "n", start).withColumn("person_id", F.lpad(F.col("n").cast("string"), 9, "0"))
    names = ["id", "email_addr", "person_id", "stage_order"]
    return known.where("person_id is not null").select(*names).unionByName(numbered.select(*names))


def merge_people(
    person: DataFrame, phone: DataFrame, address: DataFrame, staged: DataFrame, at: Column, user: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New snapshots of the three tables; people are matched and numbered once for all of them."""
    snapshot, links = upsert_person(person, staged, at, user)
    return snapshot, merge_phone(phone, staged, links, at, user), merge_address(address, staged, links, at, user)


def _with_person(rows: DataFrame, links: DataFrame) -> DataFrame:
    keyed = links.where("stage_order is null").drop("stage_order")
    own = links.where("stage_order is not null").select("stage_order", "person_id")
    whole = F.col("id").isNotNull() & F.col("email_addr").isNotNull()
    return rows.where(whole).join(keyed, ["id", "email_addr"]).unionByName(
        rows.where(~whole).join(own, "stage_order"), allowMissingColumns=True
    )


def _merge_child(
    child: DataFrame, staged: DataFrame, links: DataFrame, kind: str, fields: Sequence[str], at: Column, user: str
) -> DataFrame:
    """Merge the last staged values per (person, kind).

    Rows are reduced per (id, email, kind) before the person is looked up, so a
    person with very many staged rows costs one row in the join.
    """
    whole = F.col("id").isNotNull() & F.col("email_addr").isNotNull() & F.col(kind).isNotNull()
    slim = staged.select("id", "email_addr", "stage_order", kind, *fields)
    last = latest_per_key(slim.where(whole), ["id", "email_addr", kind], ["stage_order"])
    rows = last.unionByName(slim.where(~whole))
    incoming = _stamped(_with_person(rows, links).select("person_id", kind, *fields), at, user)
    return load.upsert(child, incoming, ["person_id", kind], insert_only=("created_at", "created_by"))


def merge_phone(phone: DataFrame, staged: DataFrame, links: DataFrame, at: Column, user: str) -> DataFrame:
    """Only rows that carry a phone number count."""
    return _merge_child(phone, staged.where("phone is not null"), links, "phone_type", ["phone"], at, user)


def merge_address(address: DataFrame, staged: DataFrame, links: DataFrame, at: Column, user: str) -> DataFrame:
    """Rows with a first address line or a city; nulls overwrite too."""
    rows = staged.where("address1 is not null or city is not null")
    return _merge_child(address, rows, links, "address_type", ADDRESS_FIELDS, at, user)


def sync_nightly(
    nightly: DataFrame, staged: DataFrame, at: Column, user: str, insert_new: bool = True
) -> DataFrame:
    """Merge the last staged row per integration id into the export table."""
    fields = ["first_name", "last_name", "birthdate", "sex"]
    rows = staged.select(F.col("id").alias("integration_id"), "stage_order", *fields)
    return load.upsert(
        nightly, _stamped(rows, at, user), ["integration_id"], ["stage_order"],
        insert_new=insert_new, insert_only=("created_at", "created_by"),
    )


def bucket(key: Column, n: int) -> Column:
    """Stable bucket number of a key: equal keys share a bucket on every run."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % n


def bucket_rows(df: DataFrame, key: str, n: int, order_by: Sequence[str]) -> DataFrame:
    """Rows of equal keys together, each bucket in stage order."""
    return (
        df.withColumn("bucket", bucket(F.col(key), n))
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", *order_by)
    )
