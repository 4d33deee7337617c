"""Line search, blocks, markdown and web pages over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html, text
from ..operators import lines
from .registry import query

_LINES = """
    SELECT doc_id, i AS line_no, ls[i] AS line, len(ls) AS n FROM (
      SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""


@query(
    "search_lines",
    "F19",
    f"SELECT doc_id, line_no::INTEGER AS line_no, line FROM ({_LINES}) WHERE regexp_matches(line, 'tion[a-z]* of')",
)
def search_lines(t):
    return lines.search_lines(t.documents, "doc_id", "text", "tion[a-z]* of")


@query(
    "search_document_count",
    "F19",
    f"SELECT count(DISTINCT doc_id) AS documents FROM ({_LINES}) WHERE regexp_matches(line, 'tion[a-z]* of')",
)
def search_document_count(t):
    return lines.matching_documents(t.documents, "doc_id", "text", "tion[a-z]* of")


@query(
    "line_counts_top20",
    "A17 T3",
    """SELECT doc_id, (length(text) - length(replace(text, chr(10), '')))::BIGINT AS line_count FROM documents
       ORDER BY line_count DESC, doc_id LIMIT 20""",
)
def line_counts_top20(t):
    return lines.count_lines(t.documents, "doc_id", "text").orderBy(F.desc("line_count"), "doc_id").limit(20)


@query(
    "line_count_total",
    "A17",
    f"SELECT sum(n - 1)::BIGINT AS total_lines, count(*) AS documents FROM (SELECT DISTINCT doc_id, n FROM ({_LINES}))",
)
def line_count_total(t):
    counts = lines.count_lines(t.documents, "doc_id", "text")
    return counts.agg(F.sum("line_count").alias("total_lines"), F.count("*").alias("documents"))


@query(
    "grep_context",
    "W4",
    f"""
    SELECT doc_id, line_no::INTEGER AS line_no, line, is_match FROM (
      SELECT doc_id, line_no, line, m AS is_match, bool_or(m) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near
      FROM (SELECT *, regexp_matches(line, 'entr[a-z]+ ') AS m FROM ({_LINES}))) WHERE near""",
)
def grep_context(t):
    return lines.context_lines(t.documents, "doc_id", "text", "entr[a-z]+ ", 2)


# The state after a line is set by the last marker line at or before it; a line that
# carries both markers flips it.
@query(
    "extract_between",
    "W5",
    f"""
    WITH m AS (SELECT doc_id, line_no, line, regexp_matches(line, '[Tt]ion') AS s, regexp_matches(line, 'ou') AS e FROM ({_LINES})),
    c AS (SELECT *, sum(CASE WHEN s AND e THEN 1 ELSE 0 END) OVER w AS flips,
            last_value(CASE WHEN s <> e THEN line_no END IGNORE NULLS) OVER w AS mark FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
    f AS (SELECT c.doc_id, c.line_no, c.line, coalesce(k.s, false) <> ((c.flips - coalesce(k.flips, 0)) % 2 = 1) AS inside
          FROM c LEFT JOIN c k ON k.doc_id = c.doc_id AND k.line_no = c.mark),
    g AS (SELECT *, lag(inside, 1, false) OVER (PARTITION BY doc_id ORDER BY line_no) AS was FROM f),
    r AS (SELECT *, sum(CASE WHEN inside AND NOT was THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS range_no FROM g WHERE inside OR was)
    SELECT doc_id, range_no::INTEGER AS range_no, row_number() OVER (PARTITION BY doc_id, range_no ORDER BY line_no)::INTEGER AS line_in_range, line FROM r""",
)
def extract_between(t):
    return lines.lines_between(t.documents, "doc_id", "text", "[Tt]ion", "ou")


@query(
    "replace_text",
    "F20",
    """SELECT doc_id, md5(CASE WHEN regexp_matches(text, 'qu[ei]') THEN regexp_replace(text, 'qu[ei]', 'k', 'g') ELSE text END) AS text,
              regexp_matches(text, 'qu[ei]') AS changed, CASE WHEN regexp_matches(text, 'qu[ei]') THEN md5(text) END AS text_before FROM documents""",
)
def replace_text(t):
    out = lines.replace_text(t.documents.select("doc_id", "text"), "text", "qu[ei]", "k")
    return out.select("doc_id", F.md5("text").alias("text"), "changed", F.md5("text_before").alias("text_before"))


@query(
    "split_blocks",
    "F21",
    r"""
    WITH d AS (SELECT doc_id, chr(10) || regexp_replace(text, '\.\n', '.' || chr(10) || '  ' || chr(10), 'g') || chr(10) || ' ' AS text FROM documents),
    b AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(text, '^([ \t]*\n)+', ''), '(\n[ \t]*)+$', ''), '\n([ \t]*\n)+'),
                                     lambda x: NOT regexp_full_match(x, '\s*')) AS bs FROM d)
    SELECT doc_id, i::INTEGER AS block_no, md5(bs[i]) AS block FROM (SELECT doc_id, bs, unnest(range(1, len(bs) + 1)) AS i FROM b)""",
)
def split_blocks(t):
    spaced = F.regexp_replace("text", r"\.\n", ".\n  \n")
    docs = t.documents.select("doc_id", F.concat(F.lit("\n"), spaced, F.lit("\n ")).alias("text"))
    return lines.split_blocks(docs, "doc_id", "text").withColumn("block", F.md5("block"))


@query(
    "split_sections",
    "F21",
    r"""
    WITH d AS (SELECT doc_id, regexp_replace(text, '\n([a-zà-ÿ])', chr(10) || '  \1', 'g') AS text FROM
                 (SELECT doc_id, regexp_replace(text, '(of|que) ', '\1' || chr(10), 'g') AS text FROM documents)),
    s AS (SELECT doc_id, string_split(regexp_replace(text, '\n([^\s])', chr(1) || '\1', 'g'), chr(1)) AS ss FROM d)
    SELECT doc_id, i::INTEGER AS section_no, md5(ss[i]) AS section FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM s)""",
)
def split_sections(t):
    broken = F.regexp_replace("text", "(of|que) ", "$1\n")
    docs = t.documents.select("doc_id", F.regexp_replace(broken, r"\n([a-zà-ÿ])", "\n  $1").alias("text"))
    return lines.split_sections(docs, "doc_id", "text").withColumn("section", F.md5("section"))


@query(
    "line_ending_tags",
    "F18",
    """SELECT doc_id, md5(replace(replace(replace(text, '. ', '.' || chr(13) || chr(10)), chr(13), '<<CR>>'), chr(10), '<<LF>>')) AS tagged FROM documents""",
)
def line_ending_tags(t):
    mixed = F.replace("text", F.lit(". "), F.lit(".\r\n"))
    return t.documents.select("doc_id", F.md5(text.tag_line_endings(mixed)).alias("tagged"))


_MARKDOWN = r"""
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN text ELSE '# ' || upper(lang) || ' Title: ' || doc_id || ' ##' || chr(10)
       || regexp_replace(text, '\n', chr(10) || repeat('#', (doc_id % 7 + 1)::INTEGER) || ' ', 'g') END AS text FROM documents"""


def markdown_documents(t):
    k = F.col("doc_id")
    marks = F.concat(F.lit("\n"), F.repeat(F.lit("#"), (k % 7 + 1).cast("int")), F.lit(" "))
    headed = F.concat(
        F.lit("# "), F.upper("lang"), F.lit(" Title: "), k, F.lit(" ##\n"), F.replace("text", F.lit("\n"), marks)
    )
    return t.spread("documents").select("doc_id", F.when(k % 4 == 0, F.col("text")).otherwise(headed).alias("text"))


@query(
    "markdown_title",
    "F15",
    f"SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'untitled' ELSE regexp_extract(text, '^# (.*) ##', 1) END AS title FROM ({_MARKDOWN})",
)
def markdown_title(t):
    return markdown_documents(t).select("doc_id", text.markdown_title(F.col("text"), F.lit("untitled")).alias("title"))


@query(
    "markdown_toc",
    "F15",
    rf"""
    WITH l AS (SELECT doc_id, i AS line_no, trim(ls[i], ' ' || chr(9) || chr(13)) AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
                 FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM ({_MARKDOWN})))),
    h AS (SELECT doc_id, line_no, length(regexp_extract(line, '^#+'))::INTEGER AS level, trim(regexp_replace(line, '^#+\s+', '')) AS t
          FROM l WHERE regexp_matches(line, '^#{{1,6}}\s+.+$'))
    SELECT doc_id, line_no::INTEGER AS line_no, level, md5(t) AS text,
      md5(regexp_replace(regexp_replace(regexp_replace(lower(t), '[^\pL\pN\pM_\s-]', '', 'g'), '[-\s]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM h""",
)
def markdown_toc(t):
    rows = markdown_documents(t).select("doc_id", F.inline(text.markdown_toc(F.col("text"))))
    return rows.withColumns({"text": F.md5("text"), "slug": F.md5("slug")})


@query(
    "extract_links",
    "F16",
    r"""
    WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?s)<a href="[^"]*"[^>]*>.*?</a>')) AS a FROM pages),
    p AS (SELECT page_id, url, regexp_extract(a, '<a href="([^"]*)"', 1) AS href,
            trim(regexp_replace(regexp_extract(a, '(?s)<a[^>]*>(.*)</a>', 1), '<[^>]*>', '', 'g')) AS text FROM a)
    SELECT page_id, replace(text, '&amp;', '&') AS text, regexp_replace(url, '/+$', '') || replace(href, '&amp;', '&') AS absolute
    FROM p WHERE text <> '' AND href LIKE '/%'""",
)
def extract_links(t):
    return t.spread("pages").select("page_id", F.inline(html.internal_links(F.col("html"), F.col("url"))))


@query("html_to_markdown", "F17")
def html_to_markdown(t):
    return t.spread("pages").select("page_id", html.html_to_markdown(F.col("html")).alias("markdown"))


@query(
    "markdown_of_built_pages",
    "F17",
    """
    SELECT c_custkey, '# ' || c_name || chr(10) || chr(10) || 'In **' || c_mktsegment || '** since *' || c_nationkey || '* see [page ' || c_custkey
             || '](/c/' || c_custkey || ')' || chr(10) || chr(10) || '- one' || chr(10) || '- ' || c_nationkey || chr(10) || chr(10) || '## End' || chr(10) || chr(10)
             || CASE WHEN c_custkey % 2 = 0 THEN 'a & b' ELSE '`' || c_name || '`' END AS markdown
    FROM customer""",
)
def markdown_of_built_pages(t):
    """Pages made of table values, whose markdown can be written down by hand."""
    k = F.col("c_custkey").cast("string")
    last = F.when(F.col("c_custkey") % 2 == 0, "a &amp; b").otherwise(F.concat(F.lit("<code>"), "c_name", F.lit("</code>")))
    page = F.concat(
        F.lit("<html><head><style>p{}</style></head><body><h1>"), "c_name", F.lit("</h1><p>In <b>"), "c_mktsegment",
        F.lit("</b> since <i>"), F.col("c_nationkey").cast("string"), F.lit('</i> see <a href="/c/'), k, F.lit('">page '), k,
        F.lit("</a></p><script>var x = '<p>no</p>';</script><ul><li>one</li><li>"), F.col("c_nationkey").cast("string"),
        F.lit("</li></ul><h2>End</h2><p>"), last, F.lit("</p></body></html>"),
    )
    return t.spread("customer").select("c_custkey", html.html_to_markdown(page).alias("markdown"))


@query(
    "null_byte_lines",
    "P15 F19",
    "SELECT doc_id, length(text)::INTEGER AS length FROM documents",
)
def null_byte_lines(t):
    from ..functions.cells import without_null_bytes

    dirty = F.replace("text", F.lit("\n"), F.lit("\x00\n"))
    return t.documents.select("doc_id", F.length(without_null_bytes(dirty)).alias("length"))


@query(
    "search_lines_anchored",
    "F19",
    f"SELECT doc_id, line_no::INTEGER AS line_no, line FROM ({_LINES}) WHERE regexp_matches(line, '^Th.*[a-z]\\.$')",
)
def search_lines_anchored(t):
    """Anchors stand for the ends of a line, wherever it is in its document."""
    return lines.search_lines(t.documents, "doc_id", "text", r"^Th.*[a-z]\.$")


@query(
    "grep_context_anchored",
    "W4",
    f"""
    SELECT doc_id, line_no::INTEGER AS line_no, line, is_match FROM (
      SELECT doc_id, line_no, line, m AS is_match, bool_or(m) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near
      FROM (SELECT *, regexp_matches(line, '^An') AS m FROM ({_LINES}))) WHERE near""",
)
def grep_context_anchored(t):
    return lines.context_lines(t.documents, "doc_id", "text", "^An", 1)
