"""Synthetic relations grown from customers and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import generate as g
from .registry import query

AS_OF = "2024-05-01"


def ch(salt: str, key: str, n: int) -> str:
    return f"(('0x' || substring(md5('{salt}' || {key}), 1, 15))::BIGINT % {n})"


def pk(salt: str, key: str, values) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"[{items}][{ch(salt, key, len(values))} + 1]"


def caps(salt: str, key: str, lo: int, hi: int) -> str:
    return f"substring(translate(md5('{salt}' || {key}), '0123456789abcdef', 'GHIJKLMNOPABCDEF'), 1, {ch(salt + '-n', key, hi - lo + 1)} + {lo})"


def dg(salt: str, key: str, n: int) -> str:
    return f"lpad({ch(salt, key, 10**n)}::VARCHAR, {n}, '0')"


_PEOPLE = """SELECT c_custkey, c_name, 999 + row_number() OVER (ORDER BY c_custkey) AS demographic_id, substring(md5(c_name), 1, 16) AS employee_id FROM customer"""


def people(t):
    return g.people(t.customer, "c_custkey", "c_name", "c_custkey")


def as_of():
    return F.lit(AS_OF).cast("date")


_LOOKUP_ROWS = ", ".join(
    f"({start + i}::BIGINT, '{name}', '{label}')" for name, (start, labels) in g.LOOKUPS.items() for i, label in enumerate(labels)
)


@query(
    "gen_lookup",
    "G1",
    f"""SELECT * FROM (VALUES {_LOOKUP_ROWS}) v(lookup_id, category, lookup_desc)
        UNION ALL SELECT 99999 + row_number() OVER (ORDER BY s), 'ACCOUNT_TYPE', s FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)""",
)
def gen_lookup(t):
    return g.gen_lookup(t.customer, "c_mktsegment")


@query(
    "gen_employee",
    "G2 F11",
    f"""SELECT employee_id, (('0x' || substring(md5(employee_id), 1, 3))::BIGINT % 900 + 100)::VARCHAR
          || (('0x' || substring(md5(employee_id), 4, 2))::BIGINT % 90 + 10) || (('0x' || substring(md5(employee_id), 6, 4))::BIGINT % 9000 + 1000) AS ssn
        FROM ({_PEOPLE})""",
)
def gen_employee(t):
    return g.gen_employee(people(t))


_DEMOGRAPHIC = f"""
    SELECT demographic_id, employee_id, c_name AS first_name, {ch('prefix', 'demographic_id', 4)} + 21 AS prefix_id,
      {ch('suffix', 'demographic_id', 4)} + 31 AS suffix_id,
      (DATE '{AS_OF}' - 25550 + {ch('birth', 'demographic_id', 18616)}::INTEGER)::DATE AS birthdate,
      {ch('gender', 'demographic_id', 3)} + 1 AS gender_id, {ch('marital', 'demographic_id', 3)} + 10 AS mar_status_id, 61 AS deleted_status
    FROM ({_PEOPLE})"""


@query("gen_demographic", "G2", _DEMOGRAPHIC)
def gen_demographic(t):
    return g.gen_demographic(people(t), "c_name", as_of())


def owned(salt: str, start: int) -> str:
    """Sequential reading of the rule: types in order of arrival at the owner."""
    return f"""
    SELECT row_id, owner_id, row_number() OVER (ORDER BY row_id) AS n,
      ({ch(salt + '-type', 'owner_id', 3)} + (row_number() OVER (PARTITION BY owner_id ORDER BY row_id) - 1)
        * (1 + {ch(salt + '-step', 'owner_id', 2)})) % 3 + {start} AS type_id
    FROM (SELECT demographic_id AS row_id, CASE WHEN {ch(salt, 'demographic_id', 10)} < 2
            THEN lag(demographic_id) OVER (ORDER BY demographic_id) ELSE demographic_id END AS owner_id FROM ({_PEOPLE}))
    WHERE owner_id IS NOT NULL"""


@query(
    "gen_phone",
    "G3 W6",
    f"""SELECT 1999 + n AS phone_id, owner_id AS demographic_id, {dg('area', 'row_id', 3)} || '-' || {dg('line', 'row_id', 4)} AS phone,
               type_id AS phone_type_id FROM ({owned('phone', 51)})""",
)
def gen_phone(t):
    return g.gen_phone(people(t))


@query(
    "gen_address",
    "G3 G5",
    f"""
    SELECT 2999 + n AS address_id, owner_id AS demographic_id,
      ({ch('number', 'row_id', 9900)} + 100) || CASE WHEN {ch('alpha', 'row_id', 10)} > 7 THEN {pk('letter', 'row_id', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')} ELSE '' END
        || ' ' || {caps('street', 'row_id', 5, 10)} || ' ' || {pk('way', 'row_id', g.STREET_WORDS)} AS address1,
      {caps('county', 'row_id', 6, 12)} || ' ' || {pk('kind', 'row_id', g.COUNTY_WORDS)} AS county, {pk('state', 'row_id', g.STATES)} AS state,
      {dg('zip5', 'row_id', 5)} || CASE WHEN {ch('plus4', 'row_id', 10)} >= 5 THEN '-' || {dg('zip4', 'row_id', 4)} ELSE '' END AS postal,
      'USA' AS country, type_id AS address_type_id
    FROM ({owned('address', 41)})""",
)
def gen_address(t):
    return g.gen_address(people(t))


_ACCOUNT = f"""
    SELECT 3999 + row_number() OVER (ORDER BY s_suppkey) AS account_id, s_suppkey AS account_code, s_name AS account_name, s_nationkey FROM supplier"""


def organisations(t):
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("industry"))
    return t.supplier.join(nation, "s_nationkey", "left")


@query(
    "gen_account",
    "G4 P24",
    f"""
    WITH k AS (SELECT s, 99999 + row_number() OVER (ORDER BY s) AS id FROM (SELECT DISTINCT n_name AS s FROM nation JOIN supplier ON n_nationkey = s_nationkey))
    SELECT account_id, account_code, account_name, {ch('account', 'account_id', 3)} + 71 AS account_status_id, id AS account_type_id
    FROM ({_ACCOUNT}) LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN k ON s = n_name""",
)
def gen_account(t):
    orgs = organisations(t)
    return g.gen_account(orgs, "s_suppkey", "s_name", "industry", g.gen_lookup(orgs, "industry"))


@query(
    "gen_employment",
    "G4",
    f"""
    SELECT 4999 + row_number() OVER (ORDER BY demographic_id) AS employment_id, demographic_id, account_code,
      least((birthdate + ({ch('hired', 'demographic_id', 3651)} + 6570)::INTEGER)::DATE, DATE '{AS_OF}') AS hire_dt
    FROM ({_DEMOGRAPHIC}) JOIN ({_ACCOUNT}) ON account_id = 4000 + {ch('job', 'demographic_id', '(SELECT count(*) FROM supplier)')}""",
)
def gen_employment(t):
    orgs = organisations(t)
    accounts = g.gen_account(orgs, "s_suppkey", "s_name", "industry", g.gen_lookup(orgs, "industry"))
    return g.gen_employment(g.gen_demographic(people(t), "c_name", as_of()), accounts, as_of())
