"""Queries of the general training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import compare, history, nested
from pagewright.session import once, table
from pagewright.sources.extractions import reference_records

REFERENCE_NAMES = {
    "contents": "content", "pages": "page", "content.words": "content_word", "page.words": "word", "paragraphs": "paragraph",
    "sections": "section", "tables": "table", "cells": "cell", "figures": "figure", "lines": "line",
}
META_NAMES = {"pages": "page", "variant_agreement": "agreement", "numeric_conflicts": "conflict", "other_counts": "other_count", "doubts": "doubt"}
META_INLINE = {"numeric_directions", "variant_scores", "observed"}
META_NODES = ("page", "agreement", "per_variant", "excluded", "conflict", "other_count")


def reference_graph(df: DataFrame) -> nested.Relation:
    return nested.schema_graph(df.schema["contents"].dataType, "contents", REFERENCE_NAMES)


def meta_graph(df: DataFrame) -> nested.Relation:
    return nested.schema_graph(df.schema["pages"].dataType, "pages", META_NAMES, META_INLINE)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    az = reference_records(once(table(spark, d, "azure_gz").select("az_id", "contents", "contents_raw"), "az_id"))
    dm = once(table(spark, d, "docling_meta").select("meta_id", "pages"), "meta_id")
    left = nested.keys(az, "az_id", reference_graph(az)).withColumn("src", F.lit("azure_gz"))
    right = nested.keys(dm, "meta_id", meta_graph(dm)).where(F.col("node").isin(*META_NODES)).withColumn("src", F.lit("docling_meta"))
    return left.unionByName(right).select("src", "rec_id", "node", "path")


def p1_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """One typed relation as a user reads it: numeric conflicts with the agreement they belong to."""
    dm = once(table(spark, d, "docling_meta").select("meta_id", "pages"), "meta_id")
    return nested.relation(dm, "meta_id", meta_graph(dm), "conflict")


def p1_words(spark: SparkSession, d: str) -> DataFrame:
    """The shared table of words: elements of one type, under pages and under contents."""
    az = reference_records(once(table(spark, d, "azure_gz").select("az_id", "contents", "contents_raw"), "az_id"))
    return nested.relation_table(az, "az_id", reference_graph(az), "word")


def _typed(name: str, source: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        if source == "azure_gz":
            az = reference_records(once(table(spark, d, "azure_gz").select("az_id", "contents", "contents_raw"), "az_id"))
            return nested.relation(az, "az_id", reference_graph(az), name)
        dm = once(table(spark, d, "docling_meta").select("meta_id", "pages"), "meta_id")
        return nested.relation(dm, "meta_id", meta_graph(dm), name)

    query.__name__ = f"p1_table_{name}"
    return query


# One typed table for every other relation of the two records.
P1_TABLES = [_typed(n, "azure_gz") for n in ("content", "page", "paragraph", "section", "table", "cell", "figure", "line")] + [_typed(n, "docling_meta") for n in ("agreement", "per_variant", "excluded", "other_count")]


ATTRS = ["company", "project", "filing_number", "name"]


def _versions(spark: SparkSession, d: str, values: bool) -> DataFrame:
    rows = table(spark, d, "catalogue_row").select("document_id", "crawl_no", "loaded_at", "row_id", *ATTRS)
    return history.history(rows, "document_id", "crawl_no", ATTRS, "loaded_at", "row_id", values=values)


def p4_history(spark: SparkSession, d: str) -> DataFrame:
    return _versions(spark, d, True)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _versions(spark, d, False).select("document_id", F.col("from_snapshot").alias("from_crawl"), F.coalesce("to_snapshot", F.lit(0)).alias("to_crawl"))


def _digits(c: str):
    return F.regexp_replace(F.regexp_extract(c, r"(\d+)", 1), "^0+(?=.)", "")


def _copies(spark: SparkSession, d: str) -> list[tuple[str, DataFrame, DataFrame, list[str]]]:
    key = lambda c: F.when(_digits(c) != "", _digits(c)).alias("key")
    # Later of the run's rows; ties fall to the row that sorts last as a whole, so that the result is stable.
    az = table(spark, d, "azure_meta").select(key("doc_id"), "created_at", "page_count", F.col("counts.pages").alias("pages"), F.col("counts.tables").alias("table_count"), F.col("counts.sections").alias("section_count"))
    az = az.groupBy("key").agg(F.max(F.struct(*az.columns[1:])).alias("r")).select("key", "r.*")
    dm = table(spark, d, "docling_meta").select(key("doc_id"), "ingested_at", "meta_id", "page_count", F.size(F.array_compact(F.array_distinct(F.coalesce(F.col("pages.page"), F.array().cast("array<int>"))))).alias("pages"))
    dm = dm.groupBy("key").agg(F.max(F.struct(*dm.columns[1:])).alias("r")).select("key", "r.*")
    an = table(spark, d, "analyses").where(F.col("status") == "SUCCEEDED").select(key("document_id"), "id", "page_count", "table_count", "section_count")
    an = an.groupBy("key").agg(F.max(F.struct(*an.columns[1:])).alias("r")).select("key", "r.*")
    return [("docling_meta", az, dm, ["page_count", "pages"]), ("analyses", az, an, ["page_count", "table_count", "section_count"])]


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Every difference with both values."""
    out = None
    for other, here, there, fields in _copies(spark, d):
        part = compare.differences(here, there, fields).withColumn("other", F.lit(other))
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("key").alias("doc_id"), "other", "field", "kind", "here", "there")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_report(spark, d).select("doc_id", "other", "field", "kind")


def queries() -> dict:
    return {q.__name__: q for q in (p1_found, p1_conflicts, p1_words, *P1_TABLES, p4_found, p4_history, p5_found, p5_report)}


_CHILDREN = [("pages", "page"), ("paragraphs", "paragraph"), ("sections", "section"), ("tables", "table"), ("figures", "figure"), ("lines", "line"), ("words", "content_word")]
_KEPT = "json_type(x) <> 'NULL'"


def _each(source: str, key: str, prefix: str, field: str, node: str) -> str:
    return f"SELECT {key}, '{node}' AS node, {prefix} || i::VARCHAR AS path, x FROM (SELECT {key}, {prefix.split(' ')[0]}, i, json_extract(x, '$.{field}[' || i || ']') AS x FROM (SELECT *, unnest(range(coalesce(json_array_length(x, '$.{field}'), 0)::BIGINT)) AS i FROM {source})) WHERE {_KEPT}"


P1_SQL = f"""WITH az AS (SELECT * FROM azure_gz QUALIFY row_number() OVER (PARTITION BY az_id ORDER BY doc_id) = 1),
raw AS (SELECT az_id, CASE WHEN contents IS NOT NULL THEN to_json(contents) WHEN json_type(contents_raw) = 'OBJECT' AND json_exists(contents_raw, '$.contents') THEN json_extract(contents_raw, '$.contents')
  WHEN json_type(contents_raw) = 'OBJECT' AND json_exists(contents_raw, '$.result') THEN coalesce(json_extract(contents_raw, '$.result.contents'), json_extract(contents_raw, '$.result')) ELSE contents_raw::JSON END AS j FROM az),
listed AS (SELECT az_id, CASE WHEN json_type(j) = 'OBJECT' THEN json_array(j) ELSE j END AS j FROM raw),
content AS (SELECT az_id, i::VARCHAR AS path, x FROM (SELECT az_id, i, json_extract(j, '$[' || i || ']') AS x FROM (SELECT *, unnest(range(coalesce(json_array_length(j), 0)::BIGINT)) AS i FROM listed)) WHERE {_KEPT}),
child AS ({" UNION ALL ".join(_each("content", "az_id", "path || '.'", f, n) for f, n in _CHILDREN)}),
grandchild AS ({_each("(SELECT * FROM child WHERE node = 'page')", "az_id", "path || '.'", "words", "word")} UNION ALL {_each("(SELECT * FROM child WHERE node = 'table')", "az_id", "path || '.'", "cells", "cell")}),
dm AS (SELECT * FROM docling_meta QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY doc_id) = 1),
pg AS (SELECT meta_id, i - 1 AS i, pages[i] AS p FROM (SELECT *, unnest(range(1, len(pages) + 1)) AS i FROM dm) WHERE pages[i] IS NOT NULL),
ag AS (SELECT meta_id, i, p.variant_agreement AS a FROM pg WHERE p.variant_agreement IS NOT NULL),
cf AS (SELECT meta_id, i, k - 1 AS k, l[k] AS c FROM (SELECT *, unnest(range(1, len(l) + 1)) AS k FROM (SELECT meta_id, i, a.numeric_conflicts AS l FROM ag)) WHERE l[k] IS NOT NULL)
SELECT 'azure_gz' AS src, az_id AS rec_id, node, path FROM (SELECT az_id, 'content' AS node, path FROM content UNION ALL SELECT az_id, node, path FROM child UNION ALL SELECT az_id, node, path FROM grandchild)
UNION ALL SELECT 'docling_meta', meta_id, 'page', i::VARCHAR FROM pg UNION ALL SELECT 'docling_meta', meta_id, 'agreement', i::VARCHAR FROM ag
UNION ALL SELECT 'docling_meta', meta_id, 'per_variant', i::VARCHAR || '.' || e.key FROM (SELECT meta_id, i, unnest(map_entries(a.per_variant)) AS e FROM ag) WHERE e.value IS NOT NULL
UNION ALL SELECT 'docling_meta', meta_id, 'excluded', i::VARCHAR || '.' || e.key FROM (SELECT meta_id, i, unnest(map_entries(a.excluded)) AS e FROM ag) WHERE e.value IS NOT NULL
UNION ALL SELECT 'docling_meta', meta_id, 'conflict', i::VARCHAR || '.' || k::VARCHAR FROM cf
UNION ALL SELECT 'docling_meta', meta_id, 'other_count', i::VARCHAR || '.' || k::VARCHAR || '.' || e.key FROM (SELECT meta_id, i, k, unnest(map_entries(c.other_counts)) AS e FROM cf) WHERE e.value IS NOT NULL"""

_SPACE = r"[\s\x{00a0}\x{0085}\x{1680}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]+"
_NORM = {a: f"regexp_replace(lower(nfc_normalize({a})), '" + _SPACE + "', '', 'g')" for a in ATTRS}
_VALUE = {a: f"CASE WHEN regexp_matches({n}, '[\\p{{L}}\\p{{N}}]') AND {n} NOT IN ('na', 'n/a', 'n.a', 'n.a.', 'nil', 'none', 'null', 's/o', 's.o.', 'nd', 'n/d') THEN {n} END" for a, n in _NORM.items()}
P4_SQL = (
    "WITH d AS (SELECT * FROM catalogue_row WHERE document_id IS NOT NULL AND crawl_no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id, crawl_no ORDER BY loaded_at DESC NULLS LAST, row_id DESC) = 1), "
    "n AS (SELECT document_id, crawl_no, " + ", ".join(f"{v} AS {a}" for a, v in _VALUE.items()) + " FROM d), "
    "k AS (SELECT document_id, crawl_no, " + ", ".join(f"last_value({a} IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY crawl_no) AS {a}" for a in ATTRS) + " FROM n), "
    "b AS (SELECT *, row_number() OVER w AS i, " + ", ".join(f"lag({a}) OVER w AS o_{a}" for a in ATTRS) + " FROM k WINDOW w AS (PARTITION BY document_id ORDER BY crawl_no)) "
    "SELECT document_id, crawl_no AS from_crawl, coalesce(lead(crawl_no) OVER (PARTITION BY document_id ORDER BY crawl_no), 0) AS to_crawl FROM b WHERE i = 1 OR " + " OR ".join(f"{a} IS DISTINCT FROM o_{a}" for a in ATTRS)
)
P4_HISTORY_SQL = (
    "WITH d AS (SELECT * FROM catalogue_row WHERE document_id IS NOT NULL AND crawl_no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id, crawl_no ORDER BY loaded_at DESC NULLS LAST, row_id DESC) = 1), "
    "m AS (SELECT document_id, crawl_no, " + ", ".join(f"{v} AS n_{a}, {a} AS v_{a}" for a, v in _VALUE.items()) + " FROM d), "
    "p AS (SELECT *, " + ", ".join(f"last_value(n_{a} IGNORE NULLS) OVER w AS p_{a}" for a in ATTRS) + " FROM m WINDOW w AS (PARTITION BY document_id ORDER BY crawl_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
    "n AS (SELECT document_id, crawl_no, " + ", ".join(f"n_{a}, CASE WHEN n_{a} IS NOT NULL AND n_{a} IS DISTINCT FROM p_{a} THEN v_{a} END AS v_{a}" for a in ATTRS) + " FROM p), "
    "k AS (SELECT document_id, crawl_no, " + ", ".join(f"last_value(n_{a} IGNORE NULLS) OVER w AS n_{a}, last_value(v_{a} IGNORE NULLS) OVER w AS v_{a}" for a in ATTRS) + " FROM n WINDOW w AS (PARTITION BY document_id ORDER BY crawl_no)), "
    "b AS (SELECT *, row_number() OVER w AS i, " + ", ".join(f"lag(n_{a}) OVER w AS o_{a}" for a in ATTRS) + " FROM k WINDOW w AS (PARTITION BY document_id ORDER BY crawl_no)), "
    "c AS (SELECT * FROM b WHERE i = 1 OR " + " OR ".join(f"n_{a} IS DISTINCT FROM o_{a}" for a in ATTRS) + ") "
    "SELECT document_id, crawl_no AS from_snapshot, lead(crawl_no) OVER (PARTITION BY document_id ORDER BY crawl_no) AS to_snapshot, " + ", ".join(f"v_{a} AS {a}" for a in ATTRS) + " FROM c"
)
_SIDE = "(SELECT {0}, * FROM {1} QUALIFY row_number() OVER (PARTITION BY {2} ORDER BY {3} DESC NULLS LAST) = 1)"
_ID = "ltrim(regexp_extract({0}, '(\\d+)', 1), '0') AS k"
P5_SQL = f"""WITH a AS {_SIDE.format(_ID.format("doc_id"), "azure_meta", "ltrim(regexp_extract(doc_id, '(\\d+)', 1), '0')", "created_at")},
dm AS {_SIDE.format(_ID.format("doc_id"), "docling_meta", "ltrim(regexp_extract(doc_id, '(\\d+)', 1), '0')", "ingested_at")},
an AS {_SIDE.format(_ID.format("document_id"), "(SELECT * FROM analyses WHERE status = 'SUCCEEDED')", "ltrim(regexp_extract(document_id, '(\\d+)', 1), '0')", "id")},
d AS (SELECT k, page_count, CAST(len(list_distinct(list_filter(list_transform(pages, lambda p: p.page), lambda x: x IS NOT NULL))) AS INT) AS pages FROM dm),
f AS (SELECT a.k AS doc_id, 'docling_meta' AS other, unnest([{{'f': 'page_count', 'x': a.page_count, 'y': d.page_count}}, {{'f': 'pages', 'x': a.counts.pages, 'y': coalesce(d.pages, 0)}}]) AS v FROM a JOIN d ON a.k = d.k
  UNION ALL SELECT a.k, 'analyses', unnest([{{'f': 'page_count', 'x': a.page_count, 'y': an.page_count}}, {{'f': 'table_count', 'x': a.counts.tables, 'y': an.table_count}}, {{'f': 'section_count', 'x': a.counts.sections, 'y': an.section_count}}]) FROM a JOIN an ON a.k = an.k)
SELECT doc_id, other, v.f AS field, 'differs' AS kind FROM f WHERE v.x IS DISTINCT FROM v.y
UNION ALL SELECT k, 'docling_meta', 'row', 'missing_there' FROM a WHERE k NOT IN (SELECT k FROM d) UNION ALL SELECT k, 'docling_meta', 'row', 'missing_here' FROM d WHERE k NOT IN (SELECT k FROM a)
UNION ALL SELECT k, 'analyses', 'row', 'missing_there' FROM a WHERE k NOT IN (SELECT k FROM an) UNION ALL SELECT k, 'analyses', 'row', 'missing_here' FROM an WHERE k NOT IN (SELECT k FROM a)"""
P5_REPORT_SQL = P5_SQL.replace("'differs' AS kind FROM f", "'differs' AS kind, v.x::VARCHAR AS here, v.y::VARCHAR AS there FROM f").replace("'missing_there' FROM", "'missing_there', NULL, NULL FROM").replace("'missing_here' FROM", "'missing_here', NULL, NULL FROM")
P1_CONFLICTS_SQL = """WITH dm AS (SELECT * FROM docling_meta QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY doc_id) = 1),
pg AS (SELECT meta_id, i - 1 AS i, pages[i].variant_agreement.numeric_conflicts AS l FROM (SELECT *, unnest(range(1, len(pages) + 1)) AS i FROM dm)),
cf AS (SELECT meta_id, i, k - 1 AS k, l[k] AS c FROM (SELECT *, unnest(range(1, len(l) + 1)) AS k FROM pg) WHERE l[k] IS NOT NULL)
SELECT meta_id AS rec_id, i::VARCHAR || '.' || k::VARCHAR AS path, 'agreement' AS parent_node, i::VARCHAR AS parent, c.token AS token, c.winner_count AS winner_count, c.kind AS kind, c.direction AS direction FROM cf"""


_HEAD_SQL = P1_SQL[: P1_SQL.index("SELECT 'azure_gz' AS src")]
_TEXT = "json_extract_string(x, '$.{0}')".format
_NUMBER = "TRY_CAST(json_extract_string(x, '$.{0}') AS {1})".format
# Words and lines may be bare strings.
_WORD = "CASE WHEN json_type(x) = 'OBJECT' THEN json_extract_string(x, '$.content') ELSE json_extract_string(x, '$') END AS content"
_PARENT = "regexp_replace(path, '[.][^.]*$', '')"
P1_WORDS_SQL = _HEAD_SQL + f"""SELECT az_id AS rec_id, node, path, CASE node WHEN 'word' THEN 'page' ELSE 'content' END AS parent_node, {_PARENT} AS parent, {_WORD}, CASE WHEN json_type(x) = 'OBJECT' THEN {_NUMBER('confidence', 'DOUBLE')} END AS confidence
FROM (SELECT az_id, node, path, x FROM child WHERE node = 'content_word' UNION ALL SELECT az_id, node, path, x FROM grandchild WHERE node = 'word')"""


def _table_sql(source: str, parent: str, columns: str) -> str:
    return _HEAD_SQL + f"SELECT az_id AS rec_id, path, {parent} AS parent_node, {_PARENT if not parent.startswith('NULL') else parent} AS parent, {columns} FROM {source}"


_CHILD = "(SELECT * FROM child WHERE node = '{0}')".format
_AGREEMENT = ["text_min", "numeric_min", "numeric_exact_agree", "numeric_token_differences", "numeric_count_differences", "verdict", "numeric_conflicts_truncated", "compared_against"]


def _map_sql(name: str, columns: str) -> str:
    return _HEAD_SQL + f"SELECT meta_id AS rec_id, i::VARCHAR || '.' || e.key AS path, 'agreement' AS parent_node, i::VARCHAR AS parent, {columns} FROM (SELECT meta_id, i, unnest(map_entries(a.{name})) AS e FROM ag) WHERE e.value IS NOT NULL"


P1_TABLE_SQL = {
    "p1_table_content": _table_sql("content", "NULL::VARCHAR", f"{_TEXT('markdown')} AS markdown, {_NUMBER('endPageNumber', 'INT')} AS endPageNumber"),
    "p1_table_page": _table_sql(_CHILD("page"), "'content'", f"{_NUMBER('pageNumber', 'INT')} AS pageNumber"),
    "p1_table_paragraph": _table_sql(_CHILD("paragraph"), "'content'", f"{_TEXT('role')} AS role, {_TEXT('content')} AS content"),
    "p1_table_section": _table_sql(_CHILD("section"), "'content'", "CAST(json_extract(x, '$.elements') AS VARCHAR[]) AS elements"),
    "p1_table_table": _table_sql(_CHILD("table"), "'content'", f"{_NUMBER('rowCount', 'INT')} AS rowCount, {_NUMBER('columnCount', 'INT')} AS columnCount"),
    "p1_table_cell": _table_sql("(SELECT * FROM grandchild WHERE node = 'cell')", "'table'", f"{_TEXT('kind')} AS kind, {_NUMBER('rowIndex', 'INT')} AS rowIndex, {_NUMBER('columnIndex', 'INT')} AS columnIndex, {_TEXT('content')} AS content"),
    "p1_table_figure": _table_sql(_CHILD("figure"), "'content'", f"{_TEXT('id')} AS id, {_TEXT('caption.content')} AS caption_content"),
    "p1_table_line": _table_sql(_CHILD("line"), "'content'", _WORD),
    "p1_table_agreement": _HEAD_SQL + "SELECT meta_id AS rec_id, i::VARCHAR AS path, 'page' AS parent_node, i::VARCHAR AS parent, " + ", ".join(f"a.{c} AS {c}" for c in _AGREEMENT) + " FROM ag",
    "p1_table_per_variant": _map_sql("per_variant", "e.value.text AS text, e.value.numeric AS numeric"),
    "p1_table_excluded": _map_sql("excluded", "e.value.chars AS chars, e.value.alnum_ratio AS alnum_ratio, e.value.reason AS reason"),
    "p1_table_other_count": _HEAD_SQL + "SELECT meta_id AS rec_id, i::VARCHAR || '.' || k::VARCHAR || '.' || e.key AS path, 'conflict' AS parent_node, i::VARCHAR || '.' || k::VARCHAR AS parent, e.value AS value FROM (SELECT meta_id, i, k, unnest(map_entries(c.other_counts)) AS e FROM cf) WHERE e.value IS NOT NULL",
}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p1_conflicts": P1_CONFLICTS_SQL, "p1_words": P1_WORDS_SQL, **P1_TABLE_SQL, "p4_found": P4_SQL, "p4_history": P4_HISTORY_SQL, "p5_found": P5_SQL, "p5_report": P5_REPORT_SQL}
