"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import caps, fptree, lengths, lm, merkle, mixing, neighbours, packing, pii, simhash, topk, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@_query("op8_simhash")
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op6_pii")
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(_table(spark, folder, "documents"))


@_query("op9_mixing")
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


@_query("op3_lengths")
def op3_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.at_every_limit(lengths.histogram(lengths.encoded_lengths(_table(spark, folder, "documents"))))


@_query("op4_neighbours")
def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return neighbours.score(docs, neighbours.fit(docs, _table(spark, folder, "labels")))


@_query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


@_query("op7_caps")
def op7_caps(spark: SparkSession, folder: str) -> DataFrame:
    return caps.near_vectors(_table(spark, folder, "embeddings"))


OP10_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


@_query("op10_top_k", OP10_SQL)
def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


OP2_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(encode(coalesce(html, ''))) AS hex FROM pages
), digests AS (
  SELECT page_id, octet_length(body) AS n, min(page_id) OVER (PARTITION BY hex) AS first_id, hex FROM payloads
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + CAST(((CAST('0x' || substr(hex, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT)) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM digests
"""


@_query("op2_warc", OP2_SQL)
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(_table(spark, folder, "pages"))


@_query("op1_gated_lm")
def op1_gated_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(_table(spark, folder, "documents"))


OP11_SQL = r"""
WITH folded AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS held FROM documents
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), sized AS (
  SELECT r, doc_id, len(held) AS n, held FROM folded WHERE len(held) > 0
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized
), counted AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(held) AS term FROM sized) GROUP BY r, term
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM counted GROUP BY term), totals
), scored AS (
  SELECT a.item_id, s.r, any_value(s.doc_id) AS doc_id,
         CAST(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (100 - 50 + (50 * s.n * t.all_docs) // t.all_terms)))) AS BIGINT) AS score
  FROM asked a JOIN counted c ON a.term = c.term JOIN weighed w ON w.term = a.term JOIN sized s ON s.r = c.r, totals t
  GROUP BY a.item_id, s.r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""


@_query("op11_fp_tree", OP11_SQL)
def op11_fp_tree(spark: SparkSession, folder: str) -> DataFrame:
    return fptree.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query("op12_levenshtein")
def op12_levenshtein(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, folder, "labels")))


def _op13_sql(levels: int = 8) -> str:
    """The tree level by level; a tree of up to 8 ** ``levels`` leaves, and as many of trees."""
    fields = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = (
        "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: "
        "list_reduce(range(8), lambda s, i: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, xor(c, b)), 4294967295), 4294967295)"
    )
    parts = [f"""
WITH leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256({fields.format(text="text")}) AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN sha256({fields.format(text=lowered)}) END AS changed
  FROM documents
), t0 AS (
  SELECT r, doc_id, lang, leaf, coalesce(changed, leaf) AS folded, '' AS proof,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves
), n0 AS (
  SELECT lang, p, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM t0
)"""]
    step = """, runs{k} AS (
  SELECT lang, p // 8 AS q, list(h ORDER BY p) AS hs, any_value(n) AS n FROM n{k} GROUP BY lang, p // 8
), n{j} AS (
  SELECT lang, q AS p, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h,
         (any_value(n) OVER (PARTITION BY lang) + 7) // 8 AS n FROM runs{k}
), t{j} AS (
  SELECT t.* REPLACE (
    CASE WHEN n > 1 THEN sha256(array_to_string(hs[:p % 8] || [folded] || hs[p % 8 + 2:], '')) ELSE folded END AS folded,
    CASE WHEN n > 1 THEN proof || array_to_string(hs[:p % 8] || hs[p % 8 + 2:], '') ELSE proof END AS proof, p // 8 AS p)
  FROM t{k} t JOIN runs{k} r ON t.lang IS NOT DISTINCT FROM r.lang AND t.p // 8 = r.q
)"""
    parts += [step.format(k=k, j=k + 1) for k in range(levels)]
    j = levels + 1
    parts.append(f""", n{j} AS (
  SELECT '' AS lang, lang AS of_lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, h, count(*) OVER () AS n FROM n{levels}
), t{j} AS (
  SELECT r, doc_id, '' AS lang, leaf, folded, proof, o.p AS p, o.h AS subroot
  FROM t{levels} t JOIN n{j} o ON t.lang IS NOT DISTINCT FROM o.of_lang
)""")
    parts += [step.format(k=k, j=k + 1) for k in range(j, j + levels)]
    last = j + levels
    parts.append(f"""
SELECT doc_id, leaf, subroot, n.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = n.h AS verified
FROM t{last} t JOIN n{last} n ON t.lang = n.lang""")
    return "".join(parts)


@_query("op13_rank_manifest", _op13_sql())
def op13_rank_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(_table(spark, folder, "documents"))
