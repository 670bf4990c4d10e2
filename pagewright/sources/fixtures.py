"""Inputs of the reading operators, derived from documents the same way in Spark and in SQL.

A document's line is a page; four readings of each page differ in fixed ways.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.session import once, table

VARIANTS = ("as-is", "raster", "raster-sml", "raster-hi")


def lines(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.length("line") > 0).select("doc_id", (F.col("pos") + 1).alias("page_no"), "line")


LINES_SQL = """lines AS (SELECT doc_id, CAST(i AS INT) AS page_no, parts[i] AS line FROM (
  SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)) WHERE length(parts[i]) > 0)"""


def readings(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, page_no, ord, variant, text): four readings of each page."""
    line, page = F.col("line"), F.col("page_no")
    forms = [
        F.when(F.col("doc_id") % 11 == 0, F.translate(line, "aeiou", "#@!%^")).otherwise(line), F.translate(line, ".", ","),
        F.substr(line, F.lit(1), F.floor(F.length(line) * 9 / 10).cast("int")), F.when(page % 7 == 0, F.concat(line, F.lit(" <0.010 12.5 extra tokens"))).otherwise(line),
    ]
    each = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(v).alias("variant"), f.alias("text")) for i, (v, f) in enumerate(zip(VARIANTS, forms))])
    return lines(spark, d).select("doc_id", "page_no", F.explode(each).alias("r")).select("doc_id", "page_no", "r.*")


READINGS_SQL = LINES_SQL + """, readings AS (
  SELECT doc_id, page_no, 0 AS ord, 'as-is' AS variant, CASE WHEN doc_id % 11 = 0 THEN translate(line, 'aeiou', '#@!%^') ELSE line END AS text FROM lines
  UNION ALL SELECT doc_id, page_no, 1, 'raster', translate(line, '.', ',') FROM lines
  UNION ALL SELECT doc_id, page_no, 2, 'raster-sml', substr(line, 1, CAST(floor(length(line) * 9 / 10) AS INT)) FROM lines
  UNION ALL SELECT doc_id, page_no, 3, 'raster-hi', CASE WHEN page_no % 7 = 0 THEN line || ' <0.010 12.5 extra tokens' ELSE line END FROM lines)"""


def meta_pages(spark: SparkSession, d: str) -> DataFrame:
    """(meta_id, doc_id, run_id, pos, p): page entries of every run."""
    return once(table(spark, d, "docling_meta").select("meta_id", "doc_id", "run_id", "pages"), "meta_id").select("meta_id", "doc_id", "run_id", F.posexplode("pages").alias("pos", "p")).where(F.col("p").isNotNull())


META_SQL = """metas AS (SELECT * FROM docling_meta QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY doc_id) = 1),
pages AS (SELECT meta_id, doc_id, run_id, i - 1 AS pos, pages[i] AS p FROM (SELECT *, unnest(range(1, len(pages) + 1)) AS i FROM metas) WHERE pages[i] IS NOT NULL)"""


def cells(spark: SparkSession, d: str) -> DataFrame:
    """(gz_id, t, page, text, header, r, c): table cells of the extraction documents."""
    gz = once(table(spark, d, "docling_gz").select("gz_id", "tables"), "gz_id")
    tables = gz.select("gz_id", F.posexplode("tables").alias("t", "tb")).where(F.col("tb").isNotNull())
    return tables.select("gz_id", "t", F.try_element_at(F.col("tb.prov"), F.lit(1))["page_no"].alias("page"), F.explode("tb.data.table_cells").alias("x")).where(F.col("x").isNotNull()).select(
        "gz_id", "t", "page", F.col("x.text").alias("text"), F.coalesce("x.column_header", F.lit(False)).alias("header"), F.col("x.start_row_offset_idx").alias("r"), F.col("x.start_col_offset_idx").alias("c"), F.col("x.bbox").alias("bbox"))


CELLS_SQL = """gz AS (SELECT * FROM docling_gz QUALIFY row_number() OVER (PARTITION BY gz_id ORDER BY doc_id) = 1),
tabs AS (SELECT gz_id, i - 1 AS t, tables[i] AS tb FROM (SELECT *, unnest(range(1, len(tables) + 1)) AS i FROM gz) WHERE tables[i] IS NOT NULL),
cells AS (SELECT gz_id, t, page, x.text AS text, coalesce(x.column_header, false) AS header, x.start_row_offset_idx AS r, x.start_col_offset_idx AS c, x.bbox AS bbox FROM (
  SELECT gz_id, t, tb.prov[1].page_no AS page, unnest(tb.data.table_cells) AS x FROM tabs) WHERE x IS NOT NULL)"""

# Reader warnings, made from the event stream: every kind, notices of the code itself, and one logger that is left out.
LOGGER = "docling.datamodel.stage_model_specs"


def warnings(spark: SparkSession, d: str) -> DataFrame:
    e, k = table(spark, d, "events"), F.col("event_id")
    text = lambda c: c.cast("string")
    msg = (
        F.when(k % 6 == 0, F.concat(text(k % 90), F.lit(" of "), text(k % 90 + k % 13), F.lit(" pdf cells matched neither a row nor a column band of the "), text(k % 7), F.lit("x4 grid were dropped")))
        .when(k % 6 == 1, F.concat(F.lit("a box on page "), text(k % 40), F.lit(" is outside page bounds"))).when(k % 6 == 2, F.concat(F.lit("region "), text(k % 40), F.lit(" returned empty result")))
        .when(k % 6 == 3, F.concat(F.lit("processing timeout after "), text(k % 90), F.lit(" s"))).when((k % 6 == 4) & (k % 4 == 0), F.concat(F.lit("FutureWarning: call "), text(k))).otherwise(F.concat(F.lit("plain notice "), text(k)))
    )
    return e.select("event_id", (k % 25).alias("doc_id"), (k % 40 + 1).alias("page_no"), F.when(k % 17 == 0, LOGGER).otherwise("reader.core").alias("logger"), msg.alias("message"))


WARNINGS_SQL = f"""warns AS (SELECT event_id, event_id % 25 AS doc_id, event_id % 40 + 1 AS page_no, CASE WHEN event_id % 17 = 0 THEN '{LOGGER}' ELSE 'reader.core' END AS logger,
  CASE WHEN event_id % 6 = 0 THEN (event_id % 90)::VARCHAR || ' of ' || (event_id % 90 + event_id % 13)::VARCHAR || ' pdf cells matched neither a row nor a column band of the ' || (event_id % 7)::VARCHAR || 'x4 grid were dropped'
       WHEN event_id % 6 = 1 THEN 'a box on page ' || (event_id % 40)::VARCHAR || ' is outside page bounds' WHEN event_id % 6 = 2 THEN 'region ' || (event_id % 40)::VARCHAR || ' returned empty result'
       WHEN event_id % 6 = 3 THEN 'processing timeout after ' || (event_id % 90)::VARCHAR || ' s' WHEN event_id % 6 = 4 AND event_id % 4 = 0 THEN 'FutureWarning: call ' || event_id::VARCHAR ELSE 'plain notice ' || event_id::VARCHAR END AS message FROM events)"""


def item_cells(spark: SparkSession, d: str) -> DataFrame:
    """Table cells with misread digits and lone non-numbers, made from line items: a supplier is a table."""
    li = table(spark, d, "lineitem")
    price, k = F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.col("l_orderkey")
    forms = F.array(
        F.struct(F.lit(0).alias("c"), F.when(k % 97 == 0, F.translate(price, "1", "l")).otherwise(price).alias("text")),
        F.struct(F.lit(1).alias("c"), F.when(k % 997 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("text")),
    )
    return li.select(F.col("l_suppkey").alias("gz_id"), F.lit(0).alias("t"), F.explode(forms).alias("x")).select("gz_id", "t", "x.c", "x.text", F.lit(False).alias("header"))


ITEM_CELLS_SQL = """cells AS (SELECT l_suppkey AS gz_id, 0 AS t, 0 AS c, CASE WHEN l_orderkey % 97 = 0 THEN translate(l_extendedprice::DECIMAL(12,2)::VARCHAR, '1', 'l') ELSE l_extendedprice::DECIMAL(12,2)::VARCHAR END AS text, false AS header FROM lineitem
  UNION ALL SELECT l_suppkey, 0, 1, CASE WHEN l_orderkey % 997 = 0 THEN 'n/a' ELSE l_quantity::INT::VARCHAR END, false FROM lineitem)"""


def item_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Opposing conflicts of every kind of operation, made from line items."""
    li = table(spark, d, "lineitem")
    v, k = F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.col("l_partkey") % 8
    other = (
        F.when(k == 0, F.concat(F.lit("<"), v)).when(k == 1, F.concat(F.lit("-"), v)).when(k == 2, F.concat(v, F.lit("E2"))).when(k == 3, (F.col("l_extendedprice") * 10).cast("decimal(14,2)").cast("string"))
        .when(k == 4, F.translate(v, ".", ",")).when(k == 5, F.concat(F.lit("1"), v)).when(k == 6, F.translate(v, "3", "8")).otherwise(F.concat(v, v))
    )
    both = F.array(
        F.struct(v.alias("token"), F.lit("others_missing").alias("direction"), F.create_map(F.lit("raster"), F.lit(0)).alias("other_counts")),
        F.struct(other.alias("token"), F.lit("winner_missing").alias("direction"), F.create_map(F.lit("raster"), F.lit(1)).alias("other_counts")),
    )
    return li.select((-F.col("l_orderkey")).alias("meta_id"), F.col("l_linenumber").alias("pos"), F.posexplode(both).alias("ix", "x")).select("meta_id", "pos", "ix", "x.token", "x.direction", F.lit("token_difference").alias("kind"), "x.other_counts")


ITEM_CONFLICTS_SQL = """li AS (SELECT -l_orderkey AS meta_id, l_linenumber AS pos, l_extendedprice::DECIMAL(12,2)::VARCHAR AS v, l_partkey % 8 AS k, (l_extendedprice * 10)::DECIMAL(14,2)::VARCHAR AS ten FROM lineitem),
item_nc AS (SELECT meta_id, pos, 0 AS ix, v AS token, 'others_missing' AS direction, 'token_difference' AS kind, MAP {'raster': 0} AS other_counts FROM li
  UNION ALL SELECT meta_id, pos, 1, CASE k WHEN 0 THEN '<' || v WHEN 1 THEN '-' || v WHEN 2 THEN v || 'E2' WHEN 3 THEN ten WHEN 4 THEN translate(v, '.', ',') WHEN 5 THEN '1' || v WHEN 6 THEN translate(v, '3', '8') ELSE v || v END, 'winner_missing', 'token_difference', MAP {'raster': 1} FROM li)"""
