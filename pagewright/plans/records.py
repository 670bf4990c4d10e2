"""Queries over records, artifacts and small helpers: folding scrapes, dates by the filing, reconciling, crash marks, migration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.functions import scalars as S
from pagewright.operators import catalog, tables
from pagewright.plans import catalogue as C
from pagewright.plans import quality as Q
from pagewright.plans.registry import Registry
from pagewright.session import once, table
from pagewright.sources import fixtures as fx
from pagewright.sources.extractions import references

R = Registry()

# ------------------------------------------------------------------ records

HALF = 32  # crawls up to this one made the record, later ones are the scrape folded into it
IN_RANGE = 60  # an item seen from this crawl on lies in the range scraped
_FIRST = f"""c AS (SELECT document_id, crawl_no, row_id, company, project, filing_number FROM catalogue_row WHERE document_id IS NOT NULL AND crawl_no IS NOT NULL),
l AS (SELECT document_id, crawl_no, row_id, 'company' AS field, company AS value FROM c UNION ALL SELECT document_id, crawl_no, row_id, 'project', project FROM c UNION ALL SELECT document_id, crawl_no, row_id, 'filing_number', filing_number FROM c),
f AS (SELECT document_id, field, value, min((crawl_no, row_id)) FILTER (crawl_no <= {HALF}) AS b, min((crawl_no, row_id)) FILTER (crawl_no > {HALF}) AS a, max(crawl_no) AS last FROM l WHERE value IS NOT NULL GROUP BY ALL),
t AS (SELECT DISTINCT filing_number AS value FROM c WHERE crawl_no > {HALF} AND filing_number IS NOT NULL),
r AS (SELECT document_id, max(last) AS last FROM f GROUP BY document_id),
g AS (SELECT f.*, r.last AS seen, t.value IS NOT NULL AND field = 'filing_number' AS cleared FROM f JOIN r ON r.document_id = f.document_id LEFT JOIN t ON t.value = f.value)"""


@R.query("WITH " + _FIRST + f""" SELECT document_id, coalesce(string_agg(value, '|' ORDER BY b IS NULL, coalesce(b, a)) FILTER (field = 'company'), '') AS company,
  coalesce(CASE WHEN max(seen) >= {IN_RANGE} AND count(*) FILTER (field = 'project' AND a IS NOT NULL) > 0 THEN string_agg(value, '|' ORDER BY a) FILTER (field = 'project' AND a IS NOT NULL) ELSE string_agg(value, '|' ORDER BY b IS NULL, coalesce(b, a)) FILTER (field = 'project') END, '') AS project,
  coalesce(string_agg(value, '|' ORDER BY b IS NULL OR cleared, CASE WHEN b IS NULL OR cleared THEN a ELSE b END) FILTER (field = 'filing_number' AND (a IS NOT NULL OR NOT cleared)), '') AS containers FROM g GROUP BY document_id""")
def record_fold(spark: SparkSession, d: str) -> DataFrame:
    """Facets and memberships of each record after a scrape that searched companies in part and projects in full.

    Projects of an item in range are replaced, companies only grow; a membership ends where its
    container was traversed without the item.
    """
    c = table(spark, d, "catalogue_row").where("document_id IS NOT NULL AND crawl_no IS NOT NULL")
    long = c.select("document_id", F.struct("crawl_no", "row_id").alias("at"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("company", "project", "filing_number")])).alias("x")).select("document_id", "at", "x.*").where("value IS NOT NULL")
    first = long.groupBy("document_id", "field", "value").agg(F.min(F.when(F.col("at.crawl_no") <= HALF, F.col("at"))).alias("b"), F.min(F.when(F.col("at.crawl_no") > HALF, F.col("at"))).alias("a"), F.max("at.crawl_no").alias("last"))
    traversed = c.where(F.col("crawl_no") > HALF).where("filing_number IS NOT NULL").select(F.lit("filing_number").alias("field"), F.col("filing_number").alias("value"), F.lit(True).alias("cleared")).distinct()
    j = first.join(traversed, ["field", "value"], "left")
    listed = lambda f, c: F.transform(F.array_sort(F.collect_list(F.when((F.col("field") == f) & F.col(c).isNotNull(), F.struct(F.col(c).alias("at"), "value")))), lambda x: x["value"])
    g = j.groupBy("document_id").agg(*[listed(f, c).alias(f"{f}_{c}") for f in ("company", "project", "filing_number") for c in ("b", "a")], F.collect_set(F.when(F.col("cleared"), F.col("value"))).alias("cleared"), F.max("last").alias("last"))
    both = lambda c: F.map_filter(F.create_map(F.lit("company"), F.col(f"company_{c}"), F.lit("project"), F.col(f"project_{c}")), lambda k, v: F.size(v) > 0)
    facets = catalog.merge_facets(both("b"), both("a"), F.when(F.col("last") >= IN_RANGE, F.array(F.lit("project"))))
    out = g.select("document_id", facets.alias("facets"), catalog.merge_containers(F.col("filing_number_b"), F.col("filing_number_a"), F.col("cleared")).alias("containers"))
    text = lambda k: F.coalesce(F.array_join(F.try_element_at("facets", F.lit(k)), "|"), F.lit("")).alias(k)
    return out.select("document_id", text("company"), text("project"), F.array_join("containers", "|").alias("containers"))


@R.query("WITH d AS (SELECT DISTINCT document_id FROM documents WHERE document_id IS NOT NULL), p AS (SELECT document_id, filing_id FROM catalogue_row WHERE document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY crawl_no DESC NULLS LAST, row_id DESC) = 1), "
         "m AS (SELECT filing_id, document_id, date, kind FROM catalogue_row WHERE filing_id IS NOT NULL AND document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY filing_id, document_id ORDER BY crawl_no, row_id) = 1), "
         "j AS (SELECT d.document_id, p.document_id IS NOT NULL AS page, p.filing_id, nullif(trim(m.date), '') AS date, contains(lower(coalesce(m.kind, '')), 'pdf') AS pdf FROM d LEFT JOIN p ON p.document_id = d.document_id LEFT JOIN m ON m.filing_id = p.filing_id AND m.document_id = d.document_id) "
         "SELECT document_id, CASE WHEN date IS NOT NULL AND pdf THEN date END AS date, CASE WHEN NOT page THEN 'no page' WHEN filing_id IS NULL THEN 'no filing' WHEN date IS NULL THEN 'no date' WHEN NOT pdf THEN 'not a PDF' ELSE 'found' END AS how FROM j")
def find_date(spark: SparkSession, d: str) -> DataFrame:
    """A document's date from its row among the members of the filing its page names, or why there is none."""
    docs = table(spark, d, "documents").where("document_id IS NOT NULL").select("document_id").distinct()
    c = table(spark, d, "catalogue_row").where("document_id IS NOT NULL")
    page = catalog.latest(c.select("document_id", "crawl_no", "row_id", "filing_id"), ["document_id"], ["crawl_no", "row_id"]).select("document_id", "filing_id", F.lit(True).alias("page"))
    member = catalog.first_seen(c.where("filing_id IS NOT NULL").select("filing_id", "document_id", "crawl_no", "row_id", "date", "kind"), ["filing_id", "document_id"], ["crawl_no", "row_id"]).select("filing_id", "document_id", F.nullif(F.trim("date"), F.lit("")).alias("date"), S.is_pdf(F.coalesce("kind", F.lit(""))).alias("pdf"))
    j = docs.join(page, "document_id", "left").join(member, ["filing_id", "document_id"], "left")
    how = F.when(F.col("page").isNull(), "no page").when(F.col("filing_id").isNull(), "no filing").when(F.col("date").isNull(), "no date").when(~F.coalesce("pdf", F.lit(False)), "not a PDF").otherwise("found")
    return j.select("document_id", F.when(how == "found", F.col("date")).alias("date"), how.alias("how"))


@R.query("SELECT CAST(filed_at AS DATE)::VARCHAR AS day, string_agg(document_id, ' ' ORDER BY coalesce(try_cast(document_id AS BIGINT), 0), document_id) AS ids, count(*) AS n FROM (SELECT DISTINCT filed_at, document_id FROM documents WHERE filed_at IS NOT NULL AND document_id IS NOT NULL) GROUP BY ALL".replace("DISTINCT filed_at,", "DISTINCT CAST(filed_at AS DATE) AS filed_at,"))
def shared_scouts(spark: SparkSession, d: str) -> DataFrame:
    """Documents to be looked up on the same day share one search."""
    docs = table(spark, d, "documents").where("filed_at IS NOT NULL AND document_id IS NOT NULL").select(F.to_date("filed_at").cast("string").alias("day"), "document_id").distinct()
    order = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("document_id").try_cast("bigint"), F.lit(0)).alias("n"), "document_id")))
    return docs.groupBy("day").agg(F.array_join(F.transform(order, lambda x: x["document_id"]), " ").alias("ids"), F.count(F.lit(1)).alias("n"))


@R.query(C.R.oracle_sql()["container_complete"].replace("SELECT box, members, total, ok AND", "SELECT DISTINCT member FROM m0 WHERE member IS NOT NULL AND member NOT IN (SELECT m0.member FROM j JOIN m0 ON m0.box = j.box WHERE m0.member IS NOT NULL AND m0.member <> m0.box AND ok AND").replace(" AS complete FROM j", ")").replace(", m AS (", f", m0 AS (SELECT * FROM (VALUES {C._values(C.MEMBERS)}) AS v(box, member)), m AS (", 1))
def uncontained(spark: SparkSession, d: str) -> DataFrame:
    """Members of no container that was read in full."""
    members = spark.createDataFrame(C.MEMBERS, "box string, member string").where("member IS NOT NULL")
    complete = C.container_complete(spark, d).where("complete").select("box")
    return members.select("member").distinct().join(members.where("member <> box").join(complete, "box").select("member").distinct(), "member", "left_anti")


# ------------------------------------------------------------------ ledger

_AN = C._AN
API_VERSION = "2024-12-01"  # what rows from before versions were kept are taken to have used


@R.query("WITH " + _AN + ", crash AS (SELECT DISTINCT doc_id, analyzer_id, api_version FROM an WHERE status = 'RUNNING'), last AS (SELECT max(an.id) AS id FROM an JOIN crash ON an.doc_id = crash.doc_id AND an.analyzer_id = crash.analyzer_id AND an.api_version = crash.api_version GROUP BY an.doc_id, an.analyzer_id, an.api_version) "
         "SELECT an.id, CASE WHEN last.id IS NOT NULL THEN 'FAILED' ELSE status END AS status, CASE WHEN last.id IS NOT NULL THEN 'WORKER_CRASH' ELSE error_code END AS error_code FROM an LEFT JOIN last ON last.id = an.id")
def mark_crashes(spark: SparkSession, d: str) -> DataFrame:
    """The ledger after workers died on the filings still running: the last attempt of the same analyzer and version has failed."""
    a = C._ledger(spark, d)
    key = ["doc_id", "analyzer_id", "api_version"]
    crashed = a.where("status = 'RUNNING'").select(*key).distinct()
    last = a.select(*key, "id").join(crashed, key, "left_semi").groupBy(*key).agg(F.max("id").alias("id")).select("id", F.lit(True).alias("crashed"))
    return a.join(last, "id", "left").select("id", F.when(F.col("crashed"), F.lit("FAILED")).otherwise(F.col("status")).alias("status"), F.when(F.col("crashed"), F.lit("WORKER_CRASH")).otherwise(F.col("error_code")).alias("error_code"))


@R.query("WITH " + _AN + f", m AS (SELECT id, doc_id, file_sha256, analyzer_id, coalesce(CASE WHEN id % 5 = 0 THEN NULL ELSE api_version END, '{API_VERSION}') AS api_version FROM an) SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, file_sha256, analyzer_id, api_version ORDER BY id) = 1")
def migrate_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Rows from before versions were kept get the default; of one identity the first row stays. A fifth of the rows is stripped of its version here."""
    key = ["doc_id", "file_sha256", "analyzer_id", "api_version"]
    a = C._ledger(spark, d).select("id", "doc_id", "file_sha256", "analyzer_id", F.coalesce(F.when(F.col("id") % 5 != 0, F.col("api_version")), F.lit(API_VERSION)).alias("api_version"))
    return a.groupBy(*key).agg(F.min("id").alias("id"))


@R.query("WITH " + _AN + ", want AS (SELECT analyzer_id, api_version FROM an ORDER BY id DESC LIMIT 1), files AS (SELECT DISTINCT doc_id, file_sha256 FROM an WHERE doc_id <> ''), ok AS (SELECT DISTINCT an.doc_id, an.file_sha256 FROM an JOIN want ON an.analyzer_id = want.analyzer_id AND an.api_version = want.api_version WHERE status = 'SUCCEEDED') "
         "SELECT f.doc_id, f.file_sha256, row_number() OVER (ORDER BY coalesce(try_cast(f.doc_id AS BIGINT), 0), f.doc_id, f.file_sha256) AS place FROM files f LEFT JOIN ok ON ok.doc_id = f.doc_id AND ok.file_sha256 = f.file_sha256 WHERE ok.doc_id IS NULL")
def candidates(spark: SparkSession, d: str, limit: int | None = None) -> DataFrame:
    """Files without a success under the current analyzer and version, by number; identities without a number sort as 0. ``limit`` takes the first."""
    a = C._ledger(spark, d)
    want = a.orderBy(F.col("id").desc()).select("analyzer_id", "api_version").limit(1)
    ok = a.where("status = 'SUCCEEDED'").join(F.broadcast(want), ["analyzer_id", "api_version"], "left_semi").select("doc_id", "file_sha256").distinct()  # one row
    open_ = a.where("doc_id <> ''").select("doc_id", "file_sha256").distinct().join(ok, ["doc_id", "file_sha256"], "left_anti")
    order = [F.coalesce(F.col("doc_id").try_cast("bigint"), F.lit(0)), F.col("doc_id"), F.col("file_sha256")]
    if limit is not None:
        open_ = open_.orderBy(*order).limit(limit)
    return catalog.numbered(open_, order, "place")


_KINDS = ("db_path", "canonical", "legacy")  # fixed values: where an artifact is looked for, in this order


@R.query("WITH " + C._LISTED + ", v AS (SELECT doc_id, az_id, CAST(az_id % 3 AS INT) AS prio, coalesce(json_type(j) = 'ARRAY' AND json_array_length(j) > 0, false) AS valid FROM azl WHERE doc_id IS NOT NULL) SELECT doc_id, " + "CASE min(prio) FILTER (valid) " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END AS source, arg_min(az_id, (prio, az_id)) FILTER (valid) AS az_id, count(*) FILTER (NOT valid) AS invalid FROM v GROUP BY doc_id")
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    """The first valid artifact of a filing by where it lies, and how many were invalid. Where a record lies is made from its id."""
    v = references(spark, d, "doc_id").where("doc_id IS NOT NULL").select("doc_id", "az_id", (F.col("az_id") % 3).cast("int").alias("prio"), F.coalesce(F.size("contents") > 0, F.lit(False)).alias("valid"))
    best = F.min(F.when(F.col("valid"), F.struct("prio", "az_id")))
    return v.groupBy("doc_id").agg(best.alias("b"), F.count_if(~F.col("valid")).alias("invalid")).select("doc_id", F.element_at(F.array(*[F.lit(k) for k in _KINDS]), F.col("b.prio") + 1).alias("source"), F.col("b.az_id").alias("az_id"), "invalid")


@R.query("WITH " + C._LISTED.replace("SELECT az_id, doc_id, analyzer_id, CASE WHEN contents", "SELECT az_id, doc_id, analyzer_id, warnings, CASE WHEN contents").replace("SELECT az_id, doc_id, analyzer_id, CASE WHEN json_type(j) = 'OBJECT'", "SELECT az_id, doc_id, analyzer_id, warnings, CASE WHEN json_type(j) = 'OBJECT'")
         + ", x AS (SELECT az_id, warnings, json_extract(j, '$[' || i || ']') AS x FROM (SELECT *, unnest(range(json_array_length(j)::BIGINT)) AS i FROM azl WHERE json_type(j) = 'ARRAY')) SELECT a.az_id, " + ", ".join(f"CAST(coalesce(sum(json_array_length(x, '$.{f}')), 0) AS BIGINT) AS {f}" for f in ("pages", "tables", "sections"))
         + ", CAST(coalesce(max(len(a.warnings)), 0) AS BIGINT) AS warnings, CAST(coalesce(sum(length(json_extract_string(x, '$.markdown'))), 0) AS BIGINT) AS markdown_chars FROM azl a LEFT JOIN x ON x.az_id = a.az_id GROUP BY a.az_id")
def result_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pages, tables and sections over all content objects of a record, its warnings and its text."""
    az = references(spark, d, "warnings")
    total = lambda f: F.coalesce(F.aggregate("contents", F.lit(0).cast("bigint"), lambda a, c: a + F.coalesce(f(c), F.lit(0))), F.lit(0).cast("bigint"))
    size = lambda c: F.when(c.isNotNull(), F.size(c))
    return az.select("az_id", *[total(_of(f)).alias(f) for f in ("pages", "tables", "sections")], F.coalesce(size(F.col("warnings")), F.lit(0)).cast("bigint").alias("warnings"), total(lambda c: F.length(c["markdown"])).alias("markdown_chars"))


def _of(f: str):
    return lambda c: F.when(c[f].isNotNull(), F.size(c[f]))


_PRIO = ("imported", "parts", "whole")


@R.query("WITH s AS (SELECT DISTINCT doc_id, 0 AS prio, run_id AS name, NULL::INT AS part_no FROM azure_meta WHERE doc_id IS NOT NULL AND run_id IS NOT NULL UNION ALL SELECT DISTINCT doc_id, CASE WHEN part_no > 0 THEN 1 ELSE 2 END, az_id::VARCHAR, part_no FROM azure_gz WHERE doc_id IS NOT NULL), "
         "b AS (SELECT *, min(prio) OVER (PARTITION BY doc_id) AS best FROM s) SELECT doc_id, CASE best " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_PRIO)) + " END AS source, CASE WHEN best = 0 THEN max(name) ELSE string_agg(name, ' ' ORDER BY part_no, name) END AS files FROM b WHERE prio = best GROUP BY doc_id, best")
def reference_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Where a filing's reference is read from: the last imported one, else its parts in order, else whole files."""
    none = F.lit(None).cast("int")
    imported = table(spark, d, "azure_meta").where("doc_id IS NOT NULL AND run_id IS NOT NULL").select("doc_id", F.lit(0).alias("prio"), F.col("run_id").alias("name"), none.alias("part_no")).distinct()
    parts = table(spark, d, "azure_gz").where("doc_id IS NOT NULL").select("doc_id", F.when(F.col("part_no") > 0, 1).otherwise(2).alias("prio"), F.col("az_id").cast("string").alias("name"), "part_no").distinct()
    return catalog.by_priority(imported.unionByName(parts), _PRIO)


# ------------------------------------------------------------------ pages, tables, pairs

@R.query(Q.PAIR_SQL + ", one AS (SELECT meta_id, pos, kept, other, operation FROM pairs QUALIFY row_number() OVER (PARTITION BY meta_id, pos ORDER BY priority, holder, lacker, kept, other) = 1) SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY pos) <= 3")
def pair_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first pair of the first three pages that have one, per filing."""
    best = Q._pairs(spark, d).groupBy("meta_id", "pos").agg(F.min_by(F.struct("kept", "other", "operation"), F.struct("priority", "holder", "lacker", "kept", "other")).alias("x"))
    w = Window.partitionBy("meta_id").orderBy("pos")
    return best.withColumn("n", F.row_number().over(w)).where("n <= 3").select("meta_id", "pos", "x.*")


@R.query(Q.I_SQL + """, v AS (SELECT DISTINCT gz_id, t, c, trim(text) AS value FROM cells WHERE NOT header AND length(trim(text)) >= 3), s AS (SELECT DISTINCT a.gz_id, a.c, a.value AS suspect, b.value AS sibling FROM v a JOIN v b ON a.gz_id = b.gz_id AND a.t = b.t AND a.c = b.c AND length(a.value) = length(b.value) AND a.value <> b.value
WHERE len(list_filter(range(1, length(a.value) + 1), lambda i: substr(a.value, i, 1) <> substr(b.value, i, 1))) = 1 AND len(list_filter(range(1, length(a.value) + 1), lambda i: regexp_matches(substr(a.value, i, 1), '^\\p{Nd}$') AND regexp_matches(substr(b.value, i, 1), '^\\p{L}$'))) = 1),
p AS (SELECT *, CASE WHEN c = 0 AND gz_id % 3 = 0 THEN NULL ELSE gz_id % 4 + c END AS page FROM s) SELECT gz_id, page, c, suspect, sibling, n, over FROM (SELECT *, row_number() OVER (PARTITION BY gz_id ORDER BY page IS NULL, page, c, suspect, sibling) AS n, greatest(count(*) OVER (PARTITION BY gz_id) - 2000, 0) AS over FROM p) WHERE n <= 2000""")
def suspect_list(spark: SparkSession, d: str) -> DataFrame:
    """A filing's suspect cells as they are listed: by page, pages unknown last, then column; 2000 at most with the number left out."""
    s = tables.suspect_confusions(fx.item_cells(spark, d)).withColumn("page", F.when(~((F.col("c") == 0) & (F.col("gz_id") % 3 == 0)), F.col("gz_id") % 4 + F.col("c")))
    return tables.listed(s, ["gz_id"], 2000).select("gz_id", "page", "c", "suspect", "sibling", "n", "over")


@R.query("WITH " + fx.CELLS_SQL + ", n AS (SELECT gz_id, t, sum(length(coalesce(text, ''))) AS chars FROM cells GROUP BY ALL), j AS (SELECT tabs.gz_id, tabs.t, tb, coalesce(chars, 0) AS chars FROM tabs LEFT JOIN n ON n.gz_id = tabs.gz_id AND n.t = tabs.t) SELECT gz_id, CAST(sum(chars) AS BIGINT) AS table_text, string_agg(coalesce(tb.data.num_rows::VARCHAR, '?') || 'x' || coalesce(tb.data.num_cols::VARCHAR, '?'), ' ' ORDER BY t) AS shapes FROM j GROUP BY gz_id")
def table_totals(spark: SparkSession, d: str) -> DataFrame:
    """Characters held in a filing's tables, and the rows and columns of each in order."""
    gz = once(table(spark, d, "docling_gz").select("gz_id", "tables"), "gz_id")
    t = gz.select("gz_id", F.posexplode("tables").alias("t", "tb")).where("tb IS NOT NULL")
    size = F.aggregate(F.coalesce("tb.data.table_cells", F.array().cast(t.schema["tb"].dataType["data"].dataType["table_cells"].dataType)), F.lit(0).cast("bigint"), lambda a, c: a + F.coalesce(F.length(c["text"]), F.lit(0)))
    shape = F.concat(F.coalesce(F.col("tb.data.num_rows").cast("string"), F.lit("?")), F.lit("x"), F.coalesce(F.col("tb.data.num_cols").cast("string"), F.lit("?")))
    g = t.select("gz_id", "t", size.alias("n"), shape.alias("shape")).groupBy("gz_id").agg(F.sum("n").alias("table_text"), F.array_sort(F.collect_list(F.struct("t", "shape"))).alias("s"))
    return g.select("gz_id", "table_text", F.array_join(F.transform("s", lambda x: x["shape"]), " ").alias("shapes"))


@R.query(Q.Q_SQL + ", u AS (SELECT doc_id, page_no, chars < 100 OR alnum_ratio < 0.35 AS unmapped FROM scored WHERE variant = 'as-is') SELECT s.doc_id, s.page_no, s.variant, row_number() OVER (PARTITION BY s.doc_id, s.page_no ORDER BY (s.variant <> 'as-is') <> unmapped, s.ord) AS trial FROM scored s JOIN u ON u.doc_id = s.doc_id AND u.page_no = s.page_no")
def trial_order(spark: SparkSession, d: str) -> DataFrame:
    """The order readings of a page are tried in: images first where the text layer can't be read, else the text layer first."""
    s = Q._scored(spark, d)
    w = Window.partitionBy(*Q.PAGE)
    unmapped = F.max(F.when(F.col("variant") == "as-is", (F.col("chars") < 100) | (F.col("alnum_ratio") < 0.35))).over(w)
    return s.withColumn("_u", unmapped).where("_u IS NOT NULL").select(*Q.PAGE, "variant", F.row_number().over(w.orderBy((F.col("variant") != "as-is") != F.col("_u"), "ord")).alias("trial"))


# Scores of a page as the reader gives them: made from its recorded measures; a null or NaN is no score.
_SCORES = {"parse": "alnum_ratio", "layout": "text_agreement", "table": "numeric_agreement", "ocr": "win_margin"}
_S_SQL = Q.P_SQL + ", sc AS (" + " UNION ALL ".join(f"SELECT meta_id, pos, '{k}' AS name, round(p.{c}, 4) AS score FROM pages WHERE p.{c} IS NOT NULL AND NOT isnan(p.{c})" for k, c in _SCORES.items()) + ")"


def _scores(spark: SparkSession, d: str) -> DataFrame:
    every = F.array(*[F.struct(F.lit(k).alias("name"), F.col(f"p.{c}").alias("score")) for k, c in _SCORES.items()])
    return fx.meta_pages(spark, d).select("meta_id", "pos", F.explode(every).alias("x")).where(F.col("x.score").isNotNull() & ~F.isnan("x.score")).select("meta_id", "pos", "x.name", F.round("x.score", 4).alias("score"))


@R.query(_S_SQL + " SELECT * FROM sc")
def confidence_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d)


@R.query(_S_SQL + " SELECT meta_id, pos, name, score FROM sc WHERE score < 0.5")
def low_confidence_pages(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).where("score < 0.5")


@R.query(_S_SQL + " SELECT meta_id, name, floor(sum(CAST(round(score * 10000) AS BIGINT))::DOUBLE / count(*) + 0.5) / 10000 AS mean FROM sc GROUP BY ALL")
def confidence_means(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).groupBy("meta_id", "name").agg((F.floor(F.sum(F.round(F.col("score") * 10000).cast("bigint")) / F.count(F.lit(1)) + 0.5) / 10000).alias("mean"))


# ------------------------------------------------------------------ helpers

RUN_IDS = [(-1, "az-1.2_b"), (-2, "-x"), (-3, ""), (-4, "a" * 40), (-5, "a" * 41), (-6, "a b"), (-7, None)]


@R.query("SELECT row_id, coalesce(regexp_full_match(run_id, '[A-Za-z0-9][A-Za-z0-9._-]{0,39}'), false) AND run_id NOT IN (SELECT run_id FROM azure_meta WHERE run_id IS NOT NULL) AS valid FROM (SELECT DISTINCT meta_id AS row_id, run_id FROM docling_meta UNION ALL SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, {'NULL' if v is None else repr(v)})" for i, v in RUN_IDS) + ") AS v(row_id, run_id))")
def run_id_valid(spark: SparkSession, d: str) -> DataFrame:
    """Whether a run may have this name: of the allowed characters, and not a reference's."""
    rows = table(spark, d, "docling_meta").select(F.col("meta_id").alias("row_id"), "run_id").distinct().unionByName(spark.createDataFrame(RUN_IDS, "row_id long, run_id string"))
    taken = table(spark, d, "azure_meta").where("run_id IS NOT NULL").select("run_id").distinct().withColumn("taken", F.lit(True))
    return rows.join(taken, "run_id", "left").select("row_id", (F.coalesce(F.col("run_id").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]{0,39}\z"), F.lit(False)) & F.col("taken").isNull()).alias("valid"))


EXTENSIONS = "pdf png jpg jpeg tif tiff bmp heif docx xlsx pptx txt html htm md rtf xml json csv tsv eml msg".split()  # fixed values
GUESSED = {"pdf": "application/pdf", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "tif": "image/tiff", "tiff": "image/tiff", "html": "text/html", "htm": "text/html", "txt": "text/plain", "csv": "text/csv", "json": "application/json", "xml": "text/xml"}  # fixed values
FILES = [(-1, "a.PDF", "application/pdf; charset=binary"), (-2, "b.tif", "application/octet-stream"), (-3, "c.xyz", None), (-4, "d.html", ""), (-5, "noext", "text/plain"), (-6, "e.tar.msg", None), (-7, None, None)]
_FILE_SQL = "(VALUES " + ", ".join(f"({i}, {'NULL' if n is None else repr(n)}, {'NULL' if m is None else repr(m)})" for i, n, m in FILES) + ") AS v(file_id, name, mime)"


@R.query(f"WITH f AS (SELECT *, lower(regexp_extract(coalesce(name, ''), '[.]([^.]*)$', 1)) AS ext FROM {_FILE_SQL}) SELECT file_id, ext IN ({', '.join(repr(e) for e in EXTENSIONS)}) AS supported, CASE WHEN coalesce(mime, '') NOT IN ('', 'application/octet-stream') THEN trim(split_part(mime, ';', 1)) ELSE coalesce(CASE ext " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GUESSED.items()) + " END, 'application/octet-stream') END AS mime FROM f")
def file_types(spark: SparkSession, d: str) -> DataFrame:
    """Whether a file's ending is supported, and its type: as stored unless that says nothing, else by the ending."""
    f = spark.createDataFrame(FILES, "file_id int, name string, mime string").withColumn("ext", F.lower(F.regexp_extract(F.coalesce("name", F.lit("")), r"[.]([^.]*)$", 1)))
    guess = F.try_element_at(F.create_map(*[F.lit(x) for kv in GUESSED.items() for x in kv]), F.col("ext"))
    stored = ~F.coalesce("mime", F.lit("")).isin("", "application/octet-stream")
    return f.select("file_id", F.col("ext").isin(*EXTENSIONS).alias("supported"), F.when(stored, F.trim(F.split_part("mime", F.lit(";"), F.lit(1)))).otherwise(F.coalesce(guess, F.lit("application/octet-stream"))).alias("mime"))


SIGNALS = {1: "SIGHUP", 2: "SIGINT", 3: "SIGQUIT", 4: "SIGILL", 6: "SIGABRT", 7: "SIGBUS", 8: "SIGFPE", 9: "SIGKILL", 11: "SIGSEGV", 13: "SIGPIPE", 14: "SIGALRM", 15: "SIGTERM"}  # fixed values


@R.query("SELECT k AS code, CASE WHEN k >= 0 THEN NULL ELSE coalesce(CASE -k " + " ".join(f"WHEN {n} THEN '{s}'" for n, s in SIGNALS.items()) + " END, (-k)::VARCHAR) END AS signal, left(repeat('x', 3990 + k), 4000) AS message FROM (SELECT unnest([0, 1, 30, -1, -6, -9, -11, -15, -200]) AS k)")
def exit_signals(spark: SparkSession, d: str) -> DataFrame:
    """The signal a negative exit code stands for, and an error text cut to 4000 characters."""
    k = spark.createDataFrame([(x,) for x in (0, 1, 30, -1, -6, -9, -11, -15, -200)], "code int")
    name = F.try_element_at(F.create_map(*[F.lit(x) for kv in SIGNALS.items() for x in kv]), -F.col("code"))
    return k.select("code", F.when(F.col("code") < 0, F.coalesce(name, (-F.col("code")).cast("string"))).alias("signal"), F.left(F.expr("repeat('x', 3990 + code)"), F.lit(4000)).alias("message"))


def queries() -> dict:
    return R.queries()


def oracle_sql() -> dict[str, str]:
    return R.oracle_sql()
