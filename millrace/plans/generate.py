"""Deterministic synthetic relations derived from input rows.

Nothing is drawn at random: every choice is a digest of a salt and the row's
key, so a lost task makes the same rows again and SQL can reproduce them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pseudonymise_id
from ..operators.numbering import number_rows, with_previous

# First numbers of the generated keys.
STARTS = {"demographic": 1000, "phone": 2000, "address": 3000, "account": 4000, "employment": 5000}
# Lookup categories, their labels and first codes; account types come from the data.
LOOKUPS = {
    "GENDER": (1, ("MALE", "FEMALE", "UNKNOWN")),
    "MAR_STATUS": (10, ("MARRIED", "SINGLE", "UNKNOWN")),
    "NAME_PREFIX": (21, ("MR", "MS", "DR", "PROF")),
    "NAME_SUFFIX": (31, ("JR", "SR", "II", "III")),
    "ADDRESS_TYPE": (41, ("HOME", "WORK", "MAILING")),
    "PHONE_TYPE": (51, ("MAIN", "MOBILE", "FAX")),
    "DELETED_STATUS": (61, ("ACTIVE", "INACTIVE", "PENDING")),
    "ACCOUNT_STATUS": (71, ("ACTIVE", "SUSPENDED", "CLOSED")),
}
ACCOUNT_TYPE_START = 100000
# Parts of an address.
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA MD MA MI MN MS MO MT NE NV NH NJ NM "
    "NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
COUNTY_WORDS = ("County", "Parish", "Borough")
STREET_WORDS = ("St", "Ave", "Blvd", "Ln", "Dr", "Ct", "Way")
# Tenths. A fifth of rows move to the row before; the rest are shares of a pattern.
MOVED_TENTHS = 2
LETTER_ABOVE = 8
ZIP4_FROM = 5


def choice(salt: str, key: Column, n: int) -> Column:
    """A number in [0, n) that depends only on the salt and the key."""
    digest = F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 15)
    return F.conv(digest, 16, 10).cast("bigint") % n


def pick(salt: str, key: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (choice(salt, key, len(values)) + 1).cast("int"))


def code(salt: str, key: Column, category: str) -> Column:
    start, labels = LOOKUPS[category]
    return choice(salt, key, len(labels)) + start


def capitals(salt: str, key: Column, shortest: int, longest: int) -> Column:
    """A word of capital letters; the length varies within the limits."""
    letters = F.translate(F.md5(F.concat(F.lit(salt), key.cast("string"))), "0123456789abcdef", "GHIJKLMNOPABCDEF")
    return F.substr(letters, F.lit(1), (choice(f"{salt}-n", key, longest - shortest + 1) + shortest).cast("int"))


def digits(salt: str, key: Column, n: int) -> Column:
    return F.lpad(choice(salt, key, 10**n).cast("string"), n, "0")


def address_line(key: Column) -> Column:
    letter = F.when(choice("alpha", key, 10) > LETTER_ABOVE - 1, pick("letter", key, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise("")
    number = choice("number", key, 9900) + 100
    return F.concat(number, letter, F.lit(" "), capitals("street", key, 5, 10), F.lit(" "), pick("way", key, STREET_WORDS))


def county(key: Column) -> Column:
    return F.concat(capitals("county", key, 6, 12), F.lit(" "), pick("kind", key, COUNTY_WORDS))


def zip_code(key: Column) -> Column:
    plus4 = F.when(choice("plus4", key, 10) >= ZIP4_FROM, F.concat(F.lit("-"), digits("zip4", key, 4))).otherwise("")
    return F.concat(digits("zip5", key, 5), plus4)


def gen_lookup(industries: DataFrame, column: str) -> DataFrame:
    """Codes of all categories; account types are the distinct industries of the data."""
    spark = industries.sparkSession
    fixed = spark.createDataFrame(
        [(start + i, name, label) for name, (start, labels) in LOOKUPS.items() for i, label in enumerate(labels)],
        "lookup_id bigint, category string, lookup_desc string",
    )
    kinds = industries.select(F.col(column).alias("lookup_desc")).distinct()
    numbered = number_rows(kinds, ["lookup_desc"], "lookup_id", ACCOUNT_TYPE_START)
    return fixed.unionByName(
        numbered.select("lookup_id", F.lit("ACCOUNT_TYPE").alias("category"), "lookup_desc")
    )


def people(customers: DataFrame, key: str, name: str, order_by: str) -> DataFrame:
    """Customers with their person number and hashed id."""
    numbered = number_rows(customers.select(key, name, order_by) if order_by != key else customers.select(key, name),
                           [order_by], "demographic_id", STARTS["demographic"])
    return numbered.withColumn("employee_id", F.substring(F.md5(name), 1, 16))


def gen_employee(who: DataFrame) -> DataFrame:
    return who.select("employee_id", pseudonymise_id(F.col("employee_id")).alias("ssn"))


def birthdate(key: Column, as_of: Column) -> Column:
    """Between 19 and 70 years (of 365 days) before the given day."""
    return F.date_add(F.date_sub(as_of, 365 * 70), choice("birth", key, 365 * 51 + 1).cast("int"))


def gen_demographic(who: DataFrame, name: str, as_of: Column) -> DataFrame:
    k = F.col("demographic_id")
    return who.select(
        "demographic_id",
        "employee_id",
        F.col(name).alias("first_name"),
        code("prefix", k, "NAME_PREFIX").alias("prefix_id"),
        code("suffix", k, "NAME_SUFFIX").alias("suffix_id"),
        birthdate(k, as_of).alias("birthdate"),
        code("gender", k, "GENDER").alias("gender_id"),
        code("marital", k, "MAR_STATUS").alias("mar_status_id"),
        F.lit(LOOKUPS["DELETED_STATUS"][0]).alias("deleted_status"),
    )


def _owned(who: DataFrame, salt: str, category: str) -> DataFrame:
    """Rows with their owner and an unused type of that owner.

    A fifth of the rows move to the person before; the first has none and is
    left out.  An owner gets at most two rows, their own and the next person's,
    so the second one only has to step to another type.
    """
    moved = choice(salt, F.col("demographic_id"), 10) < MOVED_TENTHS
    # people come in order of their number, and so do their rows
    rows = with_previous(who, ["demographic_id"], {"demographic_id": "before"}, placed=True).withColumn("moved", moved)
    rows = rows.where(~(F.col("moved") & F.col("before").isNull()))
    owner = F.when(F.col("moved"), F.col("before")).otherwise(F.col("demographic_id"))
    owner_has_own = ~(choice(salt, owner, 10) < MOVED_TENTHS)
    second = (F.col("moved") & owner_has_own).cast("int")
    start, labels = LOOKUPS[category]
    n = len(labels)
    kind = (choice(f"{salt}-type", owner, n) + second * (1 + choice(f"{salt}-step", owner, n - 1))) % n + start
    return rows.select(owner.alias("owner_id"), F.col("demographic_id").alias("row_id"), kind.alias("type_id"))


def gen_phone(who: DataFrame) -> DataFrame:
    owned = number_rows(_owned(who, "phone", "PHONE_TYPE"), ["row_id"], "phone_id", STARTS["phone"], placed=True)
    number = F.concat(digits("area", F.col("row_id"), 3), F.lit("-"), digits("line", F.col("row_id"), 4))
    return owned.select(
        "phone_id", F.col("owner_id").alias("demographic_id"), number.alias("phone"), F.col("type_id").alias("phone_type_id")
    )


def gen_address(who: DataFrame) -> DataFrame:
    owned = number_rows(_owned(who, "address", "ADDRESS_TYPE"), ["row_id"], "address_id", STARTS["address"], placed=True)
    k = F.col("row_id")
    return owned.select(
        "address_id",
        F.col("owner_id").alias("demographic_id"),
        address_line(k).alias("address1"),
        county(k).alias("county"),
        pick("state", k, STATES).alias("state"),
        zip_code(k).alias("postal"),
        F.lit("USA").alias("country"),
        F.col("type_id").alias("address_type_id"),
    )


def gen_account(orgs: DataFrame, key: str, name: str, industry: str, lookup: DataFrame) -> DataFrame:
    """Accounts numbered by key; the industry label becomes its code, unknown ones null."""
    types = lookup.where("category = 'ACCOUNT_TYPE'").select(
        F.col("lookup_desc").alias(industry), F.col("lookup_id").alias("account_type_id")
    )
    numbered = number_rows(orgs.select(key, name, industry), [key], "account_id", STARTS["account"])
    return numbered.join(types, industry, "left").select(
        "account_id", F.col(key).alias("account_code"), F.col(name).alias("account_name"),
        code("account", F.col("account_id"), "ACCOUNT_STATUS").alias("account_status_id"), "account_type_id",
    )


def gen_employment(demographic: DataFrame, accounts: DataFrame, as_of: Column) -> DataFrame:
    """One employment per person: an account picked by number and a hire date.

    People are hired up to ten years after turning 18, never after ``as_of``.
    """
    total = accounts.count()
    first = STARTS["account"]
    k = F.col("demographic_id")
    numbered = number_rows(demographic.select("demographic_id", "birthdate"), ["demographic_id"], "employment_id", STARTS["employment"])
    chosen = numbered.withColumn("account_id", choice("job", k, max(total, 1)) + first)
    hired = F.least(F.date_add("birthdate", (choice("hired", k, 365 * 10 + 1) + 365 * 18).cast("int")), as_of)
    return chosen.join(accounts.select("account_id", "account_code"), "account_id").select(
        "employment_id", "demographic_id", "account_code", hired.alias("hire_dt")
    )
