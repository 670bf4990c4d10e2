"""Reference extractions and run metas as uniform nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.session import once, table

# Words stay text here: an element is an object or a bare word.
LOOSE = (
    "ARRAY<STRUCT<markdown:STRING,endPageNumber:STRING,"
    "pages:ARRAY<STRUCT<pageNumber:STRING,words:ARRAY<STRING>>>,"
    "paragraphs:ARRAY<STRUCT<role:STRING,content:STRING>>,sections:ARRAY<STRUCT<elements:ARRAY<STRING>>>,"
    "tables:ARRAY<STRUCT<rowCount:STRING,columnCount:STRING,cells:ARRAY<STRUCT<kind:STRING,rowIndex:STRING,columnIndex:STRING,content:STRING>>>>,"
    "figures:ARRAY<STRUCT<id:STRING,caption:STRUCT<content:STRING>>>,lines:ARRAY<STRING>,words:ARRAY<STRING>>>"
)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _word(w: Column) -> Column:
    """A word from its JSON text: an object with content and confidence, or a bare string."""
    is_object = F.substring(w, 1, 1) == "{"
    return F.when(w.isNotNull(), F.struct(
        F.when(is_object, F.get_json_object(w, "$.content")).otherwise(w).alias("content"),
        F.when(is_object, F.get_json_object(w, "$.confidence").try_cast("double")).alias("confidence"),
    ))


def _line(w: Column) -> Column:
    is_object = F.substring(w, 1, 1) == "{"
    return F.when(w.isNotNull(), F.struct(F.when(is_object, F.get_json_object(w, "$.content")).otherwise(w).alias("content")))


def parse_contents(raw: Column) -> Column:
    """``contents`` out of loosely typed JSON text, whichever wrapping it came in.

    Known wrappings: the list itself, {"contents": ...}, {"result": {"contents": ...}}, a JSON
    string holding any of these, and a single content object, which becomes a list of one.
    Numbers may be strings, words may be bare strings. Text that is no JSON gives null.
    """
    text = F.trim(raw)
    text = F.when(text.startswith('"'), F.get_json_object(F.concat(F.lit('{"s":'), text, F.lit("}")), "$.s")).otherwise(text)
    names = F.json_object_keys(F.when(F.ltrim(text).startswith("{"), text))
    inner = (
        F.when(F.array_contains(names, "contents"), F.get_json_object(text, "$.contents"))
        .when(F.array_contains(names, "result"), F.coalesce(F.get_json_object(text, "$.result.contents"), F.get_json_object(text, "$.result")))
        .otherwise(text)
    )
    inner = F.ltrim(inner)
    listed = F.when(inner.startswith("{"), F.concat(F.lit("["), inner, F.lit("]"))).otherwise(inner)
    loose = F.from_json(listed, LOOSE)

    def page(p: Column) -> Column:
        return F.when(p.isNotNull(), F.struct(_int(p["pageNumber"]).alias("pageNumber"), F.transform(p["words"], _word).alias("words")))

    def table(t: Column) -> Column:
        cell = lambda c: F.when(c.isNotNull(), F.struct(c["kind"].alias("kind"), _int(c["rowIndex"]).alias("rowIndex"), _int(c["columnIndex"]).alias("columnIndex"), c["content"].alias("content")))
        return F.when(t.isNotNull(), F.struct(_int(t["rowCount"]).alias("rowCount"), _int(t["columnCount"]).alias("columnCount"), F.transform(t["cells"], cell).alias("cells")))

    def content(c: Column) -> Column:
        return F.when(c.isNotNull(), F.struct(
            c["markdown"].alias("markdown"), _int(c["endPageNumber"]).alias("endPageNumber"),
            F.transform(c["pages"], page).alias("pages"), c["paragraphs"].alias("paragraphs"), c["sections"].alias("sections"),
            F.transform(c["tables"], table).alias("tables"), c["figures"].alias("figures"),
            F.transform(c["lines"], _line).alias("lines"), F.transform(c["words"], _word).alias("words"),
        ))

    return F.transform(loose, content)


def reference_records(azure_gz: DataFrame) -> DataFrame:
    """azure_gz with ``contents`` filled from ``contents_raw`` where it came as text."""
    kind = azure_gz.schema["contents"].dataType.simpleString()
    parsed = parse_contents(F.when(F.col("contents").isNull(), F.col("contents_raw"))).cast(kind)
    return azure_gz.withColumn("contents", F.coalesce("contents", parsed)).drop("contents_raw")


def references(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """(az_id, *cols, contents): every reference record once, in whichever wrapping its contents came."""
    return reference_records(once(table(spark, d, "azure_gz").select("az_id", *cols, "contents", "contents_raw"), "az_id"))
