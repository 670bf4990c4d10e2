"""Queries over the catalogue, the runs and the analysis ledger, and the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import scalars as S
from pagewright.operators import catalog
from pagewright.plans.registry import Registry
from pagewright.session import once, table
from pagewright.sources import fixtures as fx
from pagewright.sources.extractions import references

R = Registry()


def _rows(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(spark, d, "catalogue_row").select("row_id", *cols)


# ------------------------------------------------------------------ scalar functions

_CLEAN = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x{{00a0}}]+', ' ', 'g'))"


@R.query("SELECT row_id, " + _CLEAN.format("name") + " AS cleaned FROM catalogue_row")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "name").select("row_id", S.clean_text(F.col("name")).alias("cleaned"))


@R.query("SELECT row_id, regexp_replace(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM catalogue_row")
def slug(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "name").select("row_id", S.slug(F.col("name")).alias("slug"))


def _cased(spark: SparkSession, rows: DataFrame, cases: list[tuple[int, str]], name: str) -> DataFrame:
    """Rows of the table and fixed cases (negative ids) that exercise every rule."""
    return rows.unionByName(spark.createDataFrame(cases, f"row_id long, {name} string"))


def _cased_sql(cases: list[tuple[int, str]], name: str) -> str:
    quoted = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"(SELECT row_id, {name} FROM catalogue_row UNION ALL SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, {quoted(v)})" for i, v in cases) + f") AS v(row_id, {name}))"


LABELS = [(-1, "Company  Name ::"), (-2, "[Project] (old) {id}:"), (-3, "  "), (-4, "filing-number: date")]


@R.query(r"SELECT row_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(" + _CLEAN.format("submitter") + r"), ':+$', ''), '[(){}\[\]]', ' ', 'g'), '[^0-9a-z]+', ' ', 'g')) AS label FROM " + _cased_sql(LABELS, "submitter"))
def norm_label(spark: SparkSession, d: str) -> DataFrame:
    return _cased(spark, _rows(spark, d, "submitter"), LABELS, "submitter").select("row_id", S.norm_label(F.col("submitter")).alias("label"))


URLS = [(-1, "https://x/File/Download/a%20b%2Bc.PDF?x=1"), (-2, "https://x/%E2%82%AC.pdf#p"), (-3, "https://x/"), (-4, "https://x/a+b.pdf"), (-5, "https://x/" + "long-name-" * 12)]


@R.query(r"SELECT row_id, CASE WHEN s = '' THEN 'download' ELSE s END AS stem FROM (SELECT row_id, substr(regexp_replace(regexp_replace(regexp_replace(url_decode(list_last(string_split(regexp_replace(coalesce(url, ''), '[?#].*$', ''), '/'))), '(?i)\.pdf$', ''), '[^0-9A-Za-z._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), 1, 80) AS s FROM " + _cased_sql(URLS, "url") + ")")
def url_stem(spark: SparkSession, d: str) -> DataFrame:
    return _cased(spark, _rows(spark, d, "url"), URLS, "url").select("row_id", S.url_stem(F.col("url")).alias("stem"))


@R.query(r"SELECT row_id, CASE WHEN coalesce(name, '') = '' THEN 'unknown' ELSE regexp_replace(name, '[^\p{L}\p{N}._-]', '_', 'g') END AS safe FROM catalogue_row")
def safe_component(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "name").select("row_id", S.safe_component(F.col("name")).alias("safe"))


DATES = [(-1, "January 5, 2026"), (-2, "Jan 5, 2026"), (-3, "5 March 2026"), (-4, "05 mar 2026"), (-5, "2026/1/5"), (-6, "2026.01.05"), (-7, "13/25/2026"), (-8, "03/04/2026"), (-9, "04/13/2026"), (-10, "filed 2026-07-09 by mail"), (-11, "2026-02-30"), (-12, ""), (-13, "2026-01-05T10:00:00Z"), (-14, "May 7, 2031"), (-15, "1899-01-01 and more")]
_FORMATS = [(r"^\d{4}-\d{1,2}-\d{1,2}$", "%Y-%m-%d"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "%Y/%m/%d"), (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "%Y.%m.%d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "%d/%m/%Y"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "%m/%d/%Y"),
            (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "%B %d, %Y"), (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "%b %d, %Y"), (r"^\d{1,2} [A-Za-z]+ \d{4}$", "%d %B %Y"), (r"^\d{1,2} [A-Za-z]+ \d{4}$", "%d %b %Y")]
_TOKEN = r"\b((?:19|20)\d{2})[-/.](\d{1,2})[-/.](\d{1,2})\b"


@R.query("WITH t AS (SELECT row_id, regexp_replace(" + _CLEAN.format("date") + ", 'T.*$', '') AS s FROM " + _cased_sql(DATES, "date") + ") SELECT row_id, strftime(coalesce(" + ", ".join(f"CASE WHEN regexp_matches(s, '{rx}') THEN try_strptime(s, '{f}') END" for rx, f in _FORMATS)
         + f", try_strptime(regexp_extract(s, '{_TOKEN}', 1) || '-' || regexp_extract(s, '{_TOKEN}', 2) || '-' || regexp_extract(s, '{_TOKEN}', 3), '%Y-%m-%d')), '%Y-%m-%d') AS iso FROM t")
def normalize_date(spark: SparkSession, d: str) -> DataFrame:
    return _cased(spark, _rows(spark, d, "date"), DATES, "date").select("row_id", S.normalize_date(F.col("date")).alias("iso"))


@R.query(r"""WITH raw AS (SELECT row_id, (1985 + row_id % 60)::VARCHAR || '-' || (row_id % 14)::VARCHAR || '-' || (row_id % 33)::VARCHAR AS s FROM catalogue_row), p AS (SELECT row_id, CAST(split_part(s, '-', 1) AS INT) AS y, CAST(split_part(s, '-', 2) AS INT) AS m, CAST(split_part(s, '-', 3) AS INT) AS dd FROM raw)
SELECT row_id, CASE WHEN y BETWEEN 1990 AND 2032 AND m BETWEEN 1 AND 12 AND dd >= 1 THEN strftime(make_date(y, m, least(dd, day(last_day(make_date(y, m, 1)))::INT)), '%Y-%m-%d') END AS day FROM p""")
def parse_day(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("row_id")
    s = F.concat_ws("-", (k % 60 + 1985).cast("string"), (k % 14).cast("string"), (k % 33).cast("string"))
    return _rows(spark, d).select("row_id", S.parse_day(s, 2032).alias("day"))


TITLES = [
    (-1, "C41000-12 Letter A7K2M3 and A1B2C3D4 - Order AO-001-XG-C123-01-2020 EN"), (-2, "GH-001-2019 Hearing Order OH-001-2014 Français"), (-3, "c12345 XO-2020-15 and Certificate GC-125 - FR"), (-4, "AB-CD 123-45, NEB-ORDER-12-34, C1234-55"),
    (-5, "GPSO-12-2019 MO-005-2021 gpso-12-2019"), (-6, "ABCDEF without digits, A12345"), (-7, "plain title"), (-8, None), (-9, "Report FRENCH version"), (-10, "RH-3-2011 RH 003-2011 A9Z9Z9"),
]
_ORDERED = lambda l: f"list_filter({l}, lambda x, i: list_position({l}, x) = i)"
_ALL = lambda rx: _ORDERED(f"regexp_extract_all(upper(t), '{rx}', 1)")
_ACT = "list_filter(list_transform(" + _ALL(r"\b([A-Z]{2,8}(?:-[A-Z]{2,8})*[- ]?\d{2,4}(?:-\d{1,4})+)\b") + ", lambda x: replace(x, ' ', '-')), lambda x: NOT regexp_matches(x, '^C[0-9-]*$'))"


@R.query("WITH a AS (SELECT row_id, " + _CLEAN.format("name") + " AS t FROM " + _cased_sql(TITLES, "name") + r"), b AS (SELECT row_id, t, nullif(regexp_extract(upper(t), '\b(C\d{4,})(?:-(\d{1,4}))?\b', 1), '') AS filing_number, nullif(regexp_extract(upper(t), '\b(C\d{4,})(?:-(\d{1,4}))?\b', 2), '') AS filing_sequence, "
         + "list_filter(" + _ALL(r"\b(A[0-9A-Z]{5,})\b") + ", lambda x: regexp_matches(x, '[0-9]')) AS exhibits, " + _ALL(r"\b((?:AO|GO|GPSO|EPR|MO|RO|XG|GC|GH|OH|MH|RH|OF|OM)[A-Z0-9]*(?:-[A-Z0-9]+)+)\b") + " AS r0, " + _ACT + " AS a0 FROM a), "
         "c AS (SELECT *, list_filter(r0, lambda x: NOT list_contains(exhibits, x) AND x IS DISTINCT FROM filing_number AND x IS DISTINCT FROM filing_sequence) AS reg FROM b), "
         "d AS (SELECT *, list_filter(a0, lambda x: NOT list_contains(exhibits, x) AND NOT list_contains(reg, x) AND x IS DISTINCT FROM filing_number AND x IS DISTINCT FROM filing_sequence) AS a1 FROM c), e AS (SELECT *, " + _ORDERED("a1") + " AS act FROM d) "
         "SELECT row_id, filing_number, filing_sequence, array_to_string(exhibits, ' ') AS exhibits, array_to_string(list_filter(reg, lambda x: regexp_matches(x, '^(AO|GO|GPSO|EPR|MO|RO)-')) || list_filter(act, lambda x: regexp_matches(x, 'ORDER|GPSO|AO-|GO-')), ' ') AS instruments, "
         "array_to_string(list_filter(reg, lambda x: NOT regexp_matches(x, '^(AO|GO|GPSO|EPR|MO|RO)-')) || list_filter(act, lambda x: NOT regexp_matches(x, 'ORDER|GPSO|AO-|GO-')), ' ') AS activities, "
         r"CASE WHEN regexp_matches(' ' || upper(t) || ' ', '(^|\s|[-–—_/])(FR|FRENCH|FRANÇAIS)(\s|[-–—_/]|$)') THEN 'fr' WHEN regexp_matches(' ' || upper(t) || ' ', '(^|\s|[-–—_/])(EN|ENGLISH|ANGLAIS)(\s|[-–—_/]|$)') THEN 'en' END AS language FROM e")
def title_identifiers(spark: SparkSession, d: str) -> DataFrame:
    rows = _cased(spark, _rows(spark, d, "name"), TITLES, "name").select("row_id", S.title_identifiers(F.col("name")).alias("x"))
    text = lambda c: F.array_join(F.col(f"x.{c}"), " ").alias(c)
    return rows.select("row_id", "x.filing_number", "x.filing_sequence", text("exhibits"), text("instruments"), text("activities"), "x.language")


KINDS = [(-1, "Compound  Document"), (-2, "folder"), (-3, "Letter"), (-4, "Paper only"), (-5, "papier seulement (archives)"), (-6, "Adobe PDF"), (-7, "paper"), (-8, None)]
_KIND = "lower(" + _CLEAN.format("kind") + ")"


@R.query(f"SELECT row_id, {_KIND} IN ('compound document', 'folder') AS container, contains({_KIND}, 'paper only') OR contains({_KIND}, 'papier seulement') AS paper_only, contains({_KIND}, 'pdf') AS pdf FROM " + _cased_sql(KINDS, "kind"))
def kind_predicates(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("kind")
    return _cased(spark, _rows(spark, d, "kind"), KINDS, "kind").select("row_id", S.is_container(k).alias("container"), S.is_paper_only(k).alias("paper_only"), S.is_pdf(k).alias("pdf"))


@R.query("SELECT DISTINCT id, least(60.0, 2.0 * pow(2.0, greatest(0, attempt_count - 1))) AS seconds FROM analyses WHERE attempt_count IS NOT NULL")
def retry_delay(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "analyses").where("attempt_count IS NOT NULL").select("id", S.retry_delay(F.col("attempt_count")).alias("seconds")).distinct()


@R.query("SELECT DISTINCT id, error_code IN ('408', '429', '500', '502', '503', '504', 'SERVICE_REQUEST_ERROR') AS retryable FROM analyses WHERE error_code IS NOT NULL")
def retryable(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "analyses").where("error_code IS NOT NULL").select("id", F.col("error_code").isin(*S.RETRYABLE).alias("retryable")).distinct()


RANGE = 300  # pages of one request
_RANGES = "SELECT DISTINCT doc_id, CAST(s AS INT) AS first_page, CAST(least(s + {0} - 1, page_count) AS INT) AS last_page FROM (SELECT doc_id, page_count, unnest(range(1, page_count + 1, {0})) AS s FROM azure_meta WHERE page_count > 0)".format


def split_pages(meta: DataFrame, width: int = RANGE) -> DataFrame:
    """(doc_id, first_page, last_page): a filing's pages cut into ranges of ``width``; none without pages."""
    m = meta.where("page_count > 0")
    return m.select("doc_id", "page_count", F.explode(F.sequence(F.lit(1), "page_count", F.lit(width))).alias("first_page")).select("doc_id", "first_page", F.least(F.col("first_page") + width - 1, "page_count").alias("last_page")).distinct()


@R.query(_RANGES(RANGE))
def page_ranges(spark: SparkSession, d: str) -> DataFrame:
    return split_pages(table(spark, d, "azure_meta"))


@R.query(_RANGES(30))
def part_ranges(spark: SparkSession, d: str) -> DataFrame:
    return split_pages(table(spark, d, "azure_meta"), 30)


@R.query("SELECT DISTINCT id, coalesce(nullif(regexp_replace(trim(document_id), '[^0-9A-Za-z._-]', '_', 'g'), ''), 'unknown') || '/' || file_sha256 || '/pages-' || printf('%04d-%04d', 1, coalesce(page_count, 0)) || '.json' AS path FROM analyses WHERE document_id IS NOT NULL")
def artifact_paths(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "analyses").where("document_id IS NOT NULL")
    return a.select("id", F.concat(S.safe_component(F.trim("document_id")), F.lit("/"), "file_sha256", F.format_string("/pages-%04d-%04d.json", F.lit(1), F.coalesce("page_count", F.lit(0)))).alias("path")).distinct()


@R.query("""SELECT DISTINCT id, substr(sha256('{"analyzer":"' || analyzer_id || '","api":"' || api_version || '","file":"' || file_sha256 || '"}'), 1, 8) AS signature FROM analyses""")
def run_signature(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat(F.lit('{"analyzer":"'), "analyzer_id", F.lit('","api":"'), "api_version", F.lit('","file":"'), "file_sha256", F.lit('"}'))
    return table(spark, d, "analyses").select("id", F.left(F.sha2(body, 256), F.lit(8)).alias("signature")).distinct()


# Leading bytes in hexadecimal: every type, near misses, a page behind white space and a page known by a tag further on.
HEADS = [(-1, "255044462D312E37"), (-2, "504B030414"), (-3, "89504E470D0A"), (-4, "FFD8FFE0"), (-5, "49492A0008"), (-6, "4D4D002A00"), (-7, "4D4D4D4D"), (-8, "20200A3C21444F43545950452048544D4C3E"), (-9, "3C3F786D6C3F3E3C68746D6C3E"), (-10, "68656C6C6F203C424F44593E"), (-11, ""), (-12, None), (-13, "2025504446")]


@R.query("WITH b AS (SELECT row_id, hex(name) AS h, lower(name) AS low FROM catalogue_row UNION ALL SELECT row_id, h, lower(decode(unhex(h))) FROM (SELECT row_id, url AS h FROM " + _cased_sql(HEADS, "url") + """ WHERE row_id < 0) WHERE h NOT LIKE 'FF%' AND h NOT LIKE '89%' UNION ALL SELECT row_id, url, '' FROM """ + _cased_sql(HEADS, "url") + """ WHERE row_id < 0 AND (url LIKE 'FF%' OR url LIKE '89%') UNION ALL SELECT -12, NULL, NULL)
SELECT row_id, CASE WHEN starts_with(h, '255044462D') THEN 'application/pdf' WHEN starts_with(h, '504B0304') THEN 'application/zip' WHEN starts_with(h, '89504E47') THEN 'image/png' WHEN starts_with(h, 'FFD8FF') THEN 'image/jpeg' WHEN starts_with(h, '49492A00') OR starts_with(h, '4D4D002A') THEN 'image/tiff'
  WHEN starts_with(ltrim(low, chr(32) || chr(10)), '<!doctype html') OR contains(substr(low, 1, 1024), '<html') OR contains(substr(low, 1, 1024), '<body') THEN 'text/html' ELSE 'application/octet-stream' END AS mime FROM b""")
def sniff_mime(spark: SparkSession, d: str) -> DataFrame:
    names = _rows(spark, d, "name").select("row_id", F.encode("name", "UTF-8").alias("b"))
    cases = spark.createDataFrame(HEADS, "row_id long, h string").select("row_id", F.unhex("h").alias("b"))
    return names.unionByName(cases).select("row_id", S.sniff(F.col("b")).alias("mime"))


@R.query("SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size_bytes FROM documents WHERE text IS NOT NULL")
def file_digest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))


PAGES = [
    (-1, "<table><tbody><tr><td>x</td></tr></tbody></table>"), (-2, "<p>Item(s) - 1 to 20 out of about 1,234</p>"), (-3, "<p>Aucun  résultat</p>"), (-4, "<b>Service unavailable</b>"), (-5, "<p>There are no documents</p>"), (-6, "<p>No <i>items</i> were found</p>"), (-7, "   "), (-8, None),
    (-9, "<p>no results to display</p>"), (-10, "<p>1 to 20 out of about 30</p>"), (-11, "<p>Aucune document n’a été trouvé</p>"), (-12, "<TBODY></TBODY>"),
]
_PLAIN = r"trim(regexp_replace(regexp_replace(coalesce(name, ''), '<[^>]*>', ' ', 'g'), '[\s\x{00a0}]+', ' ', 'g'))"
_NONE = r"(?i)(no\s+(items?|results?|records?|documents?)\s+((were|are)\s+)?(found|available)|there\s+(are|were)\s+no\s+(items?|results?|records?|documents?)|no\s+(items?|results?|records?|documents?)\s+to\s+display|aucune?\s+(élément|résultat|document)(\s+n[''’]a\s+été\s+trouvé)?)"
_OUT_OF = r"(?i)Item\(s\)\s*-\s*[\d,]+\s*to\s*[\d,]+\s*out of about\s*([\d,]+)"


@R.query("WITH h AS (SELECT row_id, name, " + _PLAIN + " AS t, try_cast(replace(regexp_extract(coalesce(name, ''), '" + _OUT_OF + "', 1), ',', '') AS INT) AS total FROM " + _cased_sql(PAGES, "name") + f"), n AS (SELECT *, {_CLEAN.format('name')} <> '' AS filled, {_CLEAN.format('name')} <> '' AND regexp_matches(t, '{_NONE}') AS none FROM h) SELECT row_id, filled AND (contains(lower(coalesce(name, '')), '<tbody') OR total IS NOT NULL OR none) AS recognized, none AS empty, total FROM n")
def html_recognized(spark: SparkSession, d: str) -> DataFrame:
    return _cased(spark, _rows(spark, d, "name"), PAGES, "name").select("row_id", S.result_page(F.coalesce("name", F.lit(""))).alias("x")).select("row_id", "x.recognized", "x.empty", "x.total")


@R.query("SELECT document_id FROM (SELECT DISTINCT document_id FROM catalogue_row WHERE document_id IS NOT NULL) ORDER BY try_cast(document_id AS BIGINT) NULLS LAST, lower(document_id), document_id")
def doc_order(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "catalogue_row").where("document_id IS NOT NULL").select("document_id").distinct()
    return ids.orderBy(F.col("document_id").try_cast("bigint").asc_nulls_last(), F.lower("document_id"), "document_id")


_LOG = "log AS (SELECT event_id % 50 AS run, event_id AS line_no, CASE WHEN event_id % 3 = 0 THEN '[ingest] ' || (event_id % 20)::VARCHAR || '/20 pages' ELSE 'note ' || event_id::VARCHAR END AS line FROM events)"


@R.query("WITH " + _LOG + r", m AS (SELECT run, line_no, try_cast(regexp_extract(line, '\[ingest\] (\d+)/(\d+) pages', 1) AS INT) AS done FROM log) SELECT run, arg_max(done, line_no) AS done FROM m WHERE done IS NOT NULL GROUP BY run")
def last_logged_page(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    line = F.when(e % 3 == 0, F.concat(F.lit("[ingest] "), (e % 20).cast("string"), F.lit("/20 pages"))).otherwise(F.concat(F.lit("note "), e.cast("string")))
    m = table(spark, d, "events").select((e % 50).alias("run"), e.alias("line_no"), F.regexp_extract(line, r"\[ingest\] (\d+)/(\d+) pages", 1).try_cast("int").alias("done")).where("done IS NOT NULL")
    return m.groupBy("run").agg(F.max_by("done", "line_no").alias("done"))


@R.query("WITH " + fx.LINES_SQL + r", w AS (SELECT doc_id, page_no, upper(unnest(regexp_extract_all(line, '[A-Za-z]{6,}'))) AS word FROM lines), h AS (SELECT DISTINCT doc_id, page_no, word FROM w WHERE page_no % 2 = 1), g AS (SELECT DISTINCT doc_id, page_no - 1 AS page_no, word FROM w WHERE page_no % 2 = 0) SELECT * FROM g ANTI JOIN h USING (doc_id, page_no, word)")
def figure_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of a figure (here: the next line) that its page does not have yet."""
    w = fx.lines(spark, d).select("doc_id", "page_no", F.explode(F.regexp_extract_all("line", F.lit("([A-Za-z]{6,})"), F.lit(1))).alias("word")).withColumn("word", F.upper("word"))
    page, figure = w.where("page_no % 2 = 1").distinct(), w.where("page_no % 2 = 0").select("doc_id", (F.col("page_no") - 1).alias("page_no"), "word").distinct()
    return figure.join(page, ["doc_id", "page_no", "word"], "left_anti")


# ------------------------------------------------------------------ catalogue


@R.query("SELECT document_id, crawl_no, row_id, name FROM catalogue_row QUALIFY row_number() OVER (PARTITION BY document_id, crawl_no ORDER BY observed_at, row_id) = 1")
def crawl_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return catalog.first_seen(table(spark, d, "catalogue_row").select("document_id", "crawl_no", "observed_at", "row_id", "name"), ["document_id", "crawl_no"], ["observed_at", "row_id"]).drop("observed_at")


@R.query("WITH c AS (SELECT *, count(*) OVER (PARTITION BY filing_id, crawl_no, document_id) > 1 OR regexp_matches(lower(coalesce(name, '') || ' ' || coalesce(kind, '')), 'paper only|papier seulement') AS made FROM catalogue_row WHERE filing_id IS NOT NULL) SELECT row_id, CASE WHEN made THEN 'row:' || filing_id || ':' || substr(sha256(coalesce(name, '')), 1, 12) ELSE document_id END AS item_id, made AS synthetic FROM c")
def synthetic_ids(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a container whose id repeats within it, or that exist on paper only, get an id made from the container and the name."""
    c = table(spark, d, "catalogue_row").where("filing_id IS NOT NULL").select("row_id", "document_id", "filing_id", "crawl_no", "name", "kind")
    # The count is pre-aggregated and joined, so a filing of any size needs no window of its own.
    n = c.groupBy("filing_id", "crawl_no", "document_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("filing_id").alias("_f"), F.col("crawl_no").alias("_c"), F.col("document_id").alias("_d"), F.lit(True).alias("again"))
    j = c.join(n, (F.col("filing_id") == F.col("_f")) & F.col("crawl_no").eqNullSafe(F.col("_c")) & F.col("document_id").eqNullSafe(F.col("_d")), "left")
    paper = S.is_paper_only(F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("kind", F.lit(""))))
    made = F.coalesce("again", F.lit(False)) | paper
    text = F.concat(F.lit("row:"), "filing_id", F.lit(":"), F.left(F.sha2(F.coalesce("name", F.lit("")), 256), F.lit(12)))
    return j.select("row_id", F.when(made, text).otherwise(F.col("document_id")).alias("item_id"), made.alias("synthetic"))


# Pages read of some containers: fetched well or not, the total printed, whether they say there is nothing; and the members on them.
BOXES = [("b1", 1, True, 3, False), ("b1", 2, True, None, False), ("b2", 1, True, 4, False), ("b3", 1, True, None, True), ("b4", 1, True, None, False), ("b5", 1, True, 2, False), ("b5", 2, False, None, False), ("b6", 1, True, 1, False), ("b7", 1, True, 2, True), ("b7", 2, True, 3, False)]
MEMBERS = [("b1", "a"), ("b1", "b"), ("b1", "c"), ("b1", "c"), ("b1", "b1"), ("b2", "a"), ("b2", "b"), ("b4", "a"), ("b5", "a"), ("b5", "b"), ("b6", "b6"), ("b7", "a"), ("b7", "b"), ("b7", "c"), ("b7", None)]
_values = lambda rows: ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in rows)


@R.query(f"WITH p AS (SELECT * FROM (VALUES {_values(BOXES)}) AS v(box, page_no, ok, total, empty)), m AS (SELECT box, count(DISTINCT member) AS members FROM (VALUES {_values(MEMBERS)}) AS v(box, member) WHERE member <> box GROUP BY box), g AS (SELECT box, bool_and(ok) AS ok, max(total) AS total, bool_or(empty) AS empty FROM p GROUP BY box), "
         "j AS (SELECT g.box, ok, coalesce(members, 0) AS members, CASE WHEN total IS NULL AND coalesce(members, 0) = 0 AND empty THEN 0 ELSE total END AS total FROM g LEFT JOIN m ON m.box = g.box) SELECT box, members, total, ok AND total IS NOT NULL AND members >= coalesce(total, 0) AS complete FROM j")
def container_complete(spark: SparkSession, d: str) -> DataFrame:
    return catalog.completeness(spark.createDataFrame(BOXES, "box string, page_no int, ok boolean, total int, empty boolean"), spark.createDataFrame(MEMBERS, "box string, member string"))


_EDGES = "edges AS (SELECT c_custkey // 3 AS parent, c_custkey AS child FROM customer UNION SELECT 7, 2)"


@R.query("WITH RECURSIVE " + _EDGES + ", walk AS (SELECT n_nationkey::BIGINT AS root, n_nationkey::BIGINT AS node, 0 AS depth FROM nation UNION SELECT root, child, depth + 1 FROM walk JOIN edges ON parent = node WHERE depth < 20) SELECT root, node, min(depth) AS depth FROM walk GROUP BY root, node")
def container_walk(spark: SparkSession, d: str) -> DataFrame:
    """Nested containers with a deliberate cycle, walked from every nation key."""
    k = F.col("c_custkey")
    edges = table(spark, d, "customer").select(F.floor(k / 3).cast("long").alias("parent"), k.alias("child"))
    edges = edges.unionByName(spark.sql("SELECT 7L AS parent, 2L AS child"))
    return catalog.container_walk(edges, table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("root")))


@R.query("SELECT document_id, list_sort(list(DISTINCT filing_number)) AS containers FROM catalogue_row WHERE filing_number IS NOT NULL AND document_id IS NOT NULL GROUP BY document_id")
def container_membership(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "catalogue_row").where("filing_number IS NOT NULL AND document_id IS NOT NULL").groupBy("document_id").agg(F.array_sort(F.collect_set("filing_number")).alias("containers"))


_SEEN = "seen AS (SELECT project, kind, min((crawl_no, row_id)) FILTER (crawl_no <= 32) AS b, min((crawl_no, row_id)) FILTER (crawl_no > 32) AS a FROM catalogue_row WHERE project IS NOT NULL AND kind IS NOT NULL AND crawl_no IS NOT NULL GROUP BY ALL)"


@R.query("WITH " + _SEEN + " SELECT project, string_agg(kind, '|' ORDER BY b IS NULL, coalesce(b, a)) AS kinds FROM seen GROUP BY project")
def facet_union(spark: SparkSession, d: str) -> DataFrame:
    """What earlier crawls saw in that order, then what later ones add in theirs."""
    c = table(spark, d, "catalogue_row").where("project IS NOT NULL AND kind IS NOT NULL AND crawl_no IS NOT NULL")
    at = F.struct("crawl_no", "row_id")
    seen = c.groupBy("project", "kind").agg(F.min(F.when(F.col("crawl_no") <= 32, at)).alias("b"), F.min(F.when(F.col("crawl_no") > 32, at)).alias("a"))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(c, "kind")))), lambda x: x["kind"]).alias(c)
    return seen.groupBy("project").agg(listed("b"), listed("a")).select("project", F.array_join(catalog.grown(F.col("b"), F.col("a")), "|").alias("kinds"))


FIELDS = ["name", "company", "project", "filing_number"]
_SNAPS = """old AS (SELECT document_id, name, company, project, filing_number FROM catalogue_row WHERE crawl_no <= 32 AND document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY crawl_no DESC, loaded_at DESC, row_id DESC) = 1),
new AS (SELECT document_id, name, company, project, filing_number FROM catalogue_row WHERE crawl_no > 32 AND document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY crawl_no DESC, loaded_at DESC, row_id DESC) = 1)"""
_strip = lambda f: f"nullif(regexp_replace(n.{f}, '^[\\s\\x{{00a0}}]+|[\\s\\x{{00a0}}]+$', '', 'g'), '')"
_PICK = {f: f"coalesce({_strip(f)}, o.{f})" for f in FIELDS}
_MERGED = "WITH " + _SNAPS + ", merged AS (SELECT coalesce(o.document_id, n.document_id) AS document_id, " + ", ".join(f"{p} AS {f}" for f, p in _PICK.items()) + ", CASE WHEN o.document_id IS NULL THEN 'new' WHEN n.document_id IS NULL THEN 'absent' WHEN " + " OR ".join(f"{p} IS DISTINCT FROM o.{f}" for f, p in _PICK.items()) + " THEN 'updated' ELSE 'unchanged' END AS status FROM old o FULL JOIN new n ON o.document_id = n.document_id)"


def _snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "catalogue_row").where("document_id IS NOT NULL").select("document_id", "crawl_no", "loaded_at", "row_id", *FIELDS)
    return tuple(catalog.latest(c.where(w), ["document_id"], ["crawl_no", "loaded_at", "row_id"]).select("document_id", *FIELDS) for w in ("crawl_no <= 32", "crawl_no > 32"))


@R.query(_MERGED + " SELECT * FROM merged")
def record_merge(spark: SparkSession, d: str) -> DataFrame:
    return catalog.merge(*_snapshots(spark, d), "document_id", FIELDS)


@R.query("WITH " + _SNAPS + " SELECT * FROM (" + " UNION ALL ".join(f"SELECT o.document_id, '{f}' AS field, o.{f} AS old, {_strip(f)} AS new FROM old o JOIN new n ON o.document_id = n.document_id" for f in FIELDS) + ") WHERE new IS NOT NULL AND new IS DISTINCT FROM old")
def record_changes(spark: SparkSession, d: str) -> DataFrame:
    return catalog.changes(*_snapshots(spark, d), "document_id", FIELDS)


@R.query("SELECT CASE WHEN NOT is_file THEN 'not a file' WHEN synthetic THEN 'synthetic' WHEN NOT regexp_matches(document_id, '^[0-9]+$') THEN 'no numeric id' WHEN url IS NULL THEN 'no url' ELSE 'eligible' END AS reason, count(*) AS n FROM catalogue_row GROUP BY ALL")
def scout_tally(spark: SparkSession, d: str) -> DataFrame:
    reason = F.when(~F.col("is_file"), "not a file").when(F.col("synthetic"), "synthetic").when(~F.col("document_id").rlike("^[0-9]+$"), "no numeric id").when(F.col("url").isNull(), "no url").otherwise("eligible")
    return table(spark, d, "catalogue_row").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@R.query("SELECT doc_id, coalesce(nullif(title, ''), document_id, 'untitled') AS title, try_cast(document_id AS BIGINT) AS item FROM documents d WHERE NOT EXISTS (SELECT 1 FROM docling_gz g WHERE g.doc_id = d.document_id)")
def seed_records(spark: SparkSession, d: str) -> DataFrame:
    docs, have = table(spark, d, "documents"), table(spark, d, "docling_gz").select(F.col("doc_id").alias("document_id")).distinct()
    return docs.join(have, "document_id", "left_anti").select("doc_id", F.coalesce(F.nullif("title", F.lit("")), "document_id", F.lit("untitled")).alias("title"), F.col("document_id").try_cast("bigint").alias("item"))


@R.query("SELECT DISTINCT doc_id FROM docling_gz g WHERE NOT EXISTS (SELECT 1 FROM azure_gz a WHERE a.doc_id = g.doc_id)")
def missing_records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "docling_gz").select("doc_id").distinct().join(table(spark, d, "azure_gz").select("doc_id").distinct(), "doc_id", "left_anti")


# ------------------------------------------------------------------ runs

_RUNS = "runs AS (SELECT *, page_count IS NOT NULL AND meta_id % 9 <> 0 AS finished, run_id = 'r2b94d5f' AS pinned FROM docling_meta QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY doc_id) = 1)"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    m = once(table(spark, d, "docling_meta").select("meta_id", "doc_id", "run_id", "ingested_at", "page_count", "warning_total", "elapsed_seconds"), "meta_id")
    return m.withColumn("finished", F.col("page_count").isNotNull() & (F.col("meta_id") % 9 != 0)).withColumn("pinned", F.col("run_id") == "r2b94d5f")


@R.query("WITH " + _RUNS + " SELECT doc_id, run_id, meta_id FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY run_id, meta_id) = 1")
def pick_run_first(spark: SparkSession, d: str) -> DataFrame:
    return catalog.first_seen(_runs(spark, d).select("doc_id", "run_id", "meta_id"), ["doc_id"], ["run_id", "meta_id"])


@R.query("WITH " + _RUNS + " SELECT doc_id, run_id, meta_id FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY run_id DESC, meta_id DESC) = 1")
def pick_run_last(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest(_runs(spark, d).select("doc_id", "run_id", "meta_id"), ["doc_id"], ["run_id", "meta_id"])


@R.query("WITH " + _RUNS + " SELECT doc_id, meta_id FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ingested_at DESC NULLS LAST, meta_id DESC) = 1")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest(_runs(spark, d).select("doc_id", "ingested_at", "meta_id"), ["doc_id"], ["ingested_at", "meta_id"]).select("doc_id", "meta_id")


@R.query("WITH " + _RUNS + " SELECT meta_id, doc_id, CASE WHEN NOT finished THEN 'untouched' WHEN row_number() OVER (PARTITION BY doc_id, finished ORDER BY pinned DESC, ingested_at DESC, meta_id DESC) = 1 THEN 'keep' ELSE 'remove' END AS action FROM runs")
def retention_plan(spark: SparkSession, d: str) -> DataFrame:
    return catalog.retention(_runs(spark, d).select("meta_id", "doc_id", "ingested_at", "finished", "pinned"), "doc_id", ["ingested_at", "meta_id"], "pinned").select("meta_id", "doc_id", "action")


@R.query("WITH " + _RUNS + " SELECT doc_id, count(*) AS runs, count(*) FILTER (finished) AS finished, CAST(sum(warning_total) AS BIGINT) AS warnings FROM runs GROUP BY doc_id")
def run_index(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if("finished").alias("finished"), F.sum("warning_total").alias("warnings"))


@R.query("WITH " + _RUNS + " SELECT DISTINCT g.doc_id FROM docling_gz g ANTI JOIN (SELECT doc_id, run_id FROM runs WHERE finished) r ON g.doc_id = r.doc_id AND g.run_id = r.run_id")
def resume_plan(spark: SparkSession, d: str) -> DataFrame:
    """Filings whose run is not finished under the same signature."""
    done = _runs(spark, d).where("finished").select("doc_id", "run_id")
    return table(spark, d, "docling_gz").select("doc_id", "run_id").distinct().join(done, ["doc_id", "run_id"], "left_anti").select("doc_id").distinct()


@R.query("WITH " + _RUNS + ", s AS (SELECT doc_id, bool_or(finished) AS f, max(page_count) AS p FROM runs GROUP BY doc_id) SELECT g.doc_id, CASE WHEN s.doc_id IS NULL THEN 'not started' WHEN coalesce(p, 0) = 0 THEN 'EMPTY' WHEN f THEN 'complete' ELSE 'INCOMPLETE' END AS status FROM (SELECT DISTINCT document_id AS doc_id FROM documents WHERE document_id IS NOT NULL) g LEFT JOIN s ON s.doc_id = g.doc_id")
def run_status(spark: SparkSession, d: str) -> DataFrame:
    s = _runs(spark, d).groupBy("doc_id").agg(F.bool_or("finished").alias("f"), F.max("page_count").alias("p"), F.lit(True).alias("has"))
    w = table(spark, d, "documents").where("document_id IS NOT NULL").select(F.col("document_id").alias("doc_id")).distinct().join(s, "doc_id", "left")
    return w.select("doc_id", F.when(F.col("has").isNull(), "not started").when(F.coalesce("p", F.lit(0)) == 0, "EMPTY").when(F.col("f"), "complete").otherwise("INCOMPLETE").alias("status"))


# ------------------------------------------------------------------ ledger

_AN = "an AS (SELECT *, ltrim(regexp_extract(document_id, '(\\d+)', 1), '0') AS doc_id FROM analyses QUALIFY row_number() OVER (PARTITION BY id ORDER BY run_id) = 1)"


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    a = once(table(spark, d, "analyses"), "id")
    return a.withColumn("doc_id", F.regexp_replace(F.regexp_extract("document_id", r"(\d+)", 1), "^0+", ""))


@R.query("SELECT DISTINCT g.doc_id, g.run_id FROM docling_gz g JOIN (SELECT DISTINCT document_id FROM catalogue_row WHERE is_file) c ON c.document_id = g.doc_id")
def current_files(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "catalogue_row").where("is_file").select(F.col("document_id").alias("doc_id")).distinct()
    return table(spark, d, "docling_gz").select("doc_id", "run_id").distinct().join(files, "doc_id", "left_semi")


@R.query("WITH " + _AN + " SELECT doc_id, id, status FROM an QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY id DESC) = 1")
def latest_analysis(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest(_ledger(spark, d).select("doc_id", "id", "status"), ["doc_id"], ["id"])


@R.query("WITH " + _AN + " SELECT DISTINCT doc_id FROM docling_gz g WHERE NOT EXISTS (SELECT 1 FROM an WHERE an.doc_id = g.doc_id AND status = 'SUCCEEDED')")
def eligible_candidates(spark: SparkSession, d: str) -> DataFrame:
    done = _ledger(spark, d).where("status = 'SUCCEEDED'").select("doc_id").distinct()
    return table(spark, d, "docling_gz").select("doc_id").distinct().join(done, "doc_id", "left_anti")


# Contents in whichever wrapping they came, once a record.
_LISTED = """azr AS (SELECT * FROM azure_gz QUALIFY row_number() OVER (PARTITION BY az_id ORDER BY doc_id) = 1),
azj AS (SELECT az_id, doc_id, analyzer_id, CASE WHEN contents IS NOT NULL THEN to_json(contents) WHEN json_type(contents_raw) = 'OBJECT' AND json_exists(contents_raw, '$.contents') THEN json_extract(contents_raw, '$.contents')
  WHEN json_type(contents_raw) = 'OBJECT' AND json_exists(contents_raw, '$.result') THEN coalesce(json_extract(contents_raw, '$.result.contents'), json_extract(contents_raw, '$.result')) ELSE contents_raw::JSON END AS j FROM azr),
azl AS (SELECT az_id, doc_id, analyzer_id, CASE WHEN json_type(j) = 'OBJECT' THEN json_array(j) ELSE j END AS j FROM azj)"""
_VALID = _LISTED + ", az AS (SELECT doc_id, analyzer_id, CAST(sum(json_array_length(j)) AS BIGINT) AS parts FROM azl WHERE json_type(j) = 'ARRAY' GROUP BY ALL)"


@R.query("WITH " + _AN + ", " + _VALID + " SELECT an.id, CASE WHEN az.doc_id IS NULL THEN 'no artifact' WHEN an.analyzer_id IS DISTINCT FROM az.analyzer_id THEN 'other analyzer' WHEN coalesce(parts, 0) = 0 THEN 'empty contents' WHEN an.page_count IS NULL THEN 'no page count' END AS invalid_reason FROM an LEFT JOIN (SELECT doc_id, min(analyzer_id) AS analyzer_id, CAST(sum(parts) AS BIGINT) AS parts FROM az GROUP BY doc_id) az ON az.doc_id = an.doc_id")
def artifact_validate(spark: SparkSession, d: str) -> DataFrame:
    return _validated(spark, d).select("id", "invalid_reason")


def _validated(spark: SparkSession, d: str) -> DataFrame:
    az = references(spark, d, "doc_id", "analyzer_id").where("contents IS NOT NULL").select("doc_id", "analyzer_id", F.size("contents").alias("n")).groupBy("doc_id").agg(F.min("analyzer_id").alias("az_analyzer"), F.sum("n").alias("parts"), F.lit(True).alias("has"))
    j = _ledger(spark, d).join(az, "doc_id", "left")
    reason = F.when(F.col("has").isNull(), "no artifact").when(~F.col("analyzer_id").eqNullSafe(F.col("az_analyzer")), "other analyzer").when(F.coalesce("parts", F.lit(0)) == 0, "empty contents").when(F.col("page_count").isNull(), "no page count")
    return j.withColumn("invalid_reason", reason)


@R.query("WITH " + _AN + ", " + _VALID + ", ok AS (SELECT doc_id, CAST(sum(parts) AS BIGINT) AS parts FROM az GROUP BY doc_id) SELECT an.id, CASE WHEN status = 'SUCCEEDED' AND (ok.doc_id IS NULL OR coalesce(parts, 0) = 0) THEN 'STALE_ARTIFACTS' ELSE status END AS status FROM an LEFT JOIN ok ON ok.doc_id = an.doc_id")
def audit_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """A success whose artifact is gone or empty is stale."""
    stale = (F.col("status") == "SUCCEEDED") & (F.col("has").isNull() | (F.coalesce("parts", F.lit(0)) == 0))
    return _validated(spark, d).select("id", F.when(stale, "STALE_ARTIFACTS").otherwise(F.col("status")).alias("status"))


_KEY = ["doc_id", "file_sha256", "analyzer_id", "api_version"]


@R.query("WITH " + _AN + " SELECT doc_id, file_sha256, analyzer_id, api_version, max(id) AS id, arg_max(status, id) AS status, count(*) AS writes FROM an GROUP BY doc_id, file_sha256, analyzer_id, api_version")
def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Last write wins on the four-column identity."""
    return _ledger(spark, d).groupBy(*_KEY).agg(F.max("id").alias("id"), F.max_by("status", "id").alias("status"), F.count(F.lit(1)).alias("writes"))


@R.query("WITH " + _AN + ", ok AS (SELECT doc_id, max(id) AS good FROM an WHERE status = 'SUCCEEDED' GROUP BY doc_id) SELECT an.id, an.error_code, good IS NOT NULL AND good > an.id AS resolved FROM an LEFT JOIN ok ON ok.doc_id = an.doc_id WHERE error_code IS NOT NULL")
def resolve_errors(spark: SparkSession, d: str) -> DataFrame:
    """An error is resolved by a later success of the same filing."""
    a = _ledger(spark, d)
    ok = a.where("status = 'SUCCEEDED'").groupBy("doc_id").agg(F.max("id").alias("good"))
    return a.where("error_code IS NOT NULL").join(ok, "doc_id", "left").select("id", "error_code", F.coalesce(F.col("good") > F.col("id"), F.lit(False)).alias("resolved"))


@R.query("WITH " + _AN + " SELECT run_id, count(*) FILTER (status = 'SUCCEEDED') AS ok, count(*) FILTER (status = 'FAILED') AS failed, CASE WHEN count(*) FILTER (status = 'FAILED') = 0 THEN 'SUCCEEDED' ELSE 'COMPLETED_WITH_ERRORS' END AS outcome FROM an GROUP BY run_id")
def run_outcome(spark: SparkSession, d: str) -> DataFrame:
    g = _ledger(spark, d).groupBy("run_id").agg(F.count_if(F.col("status") == "SUCCEEDED").alias("ok"), F.count_if(F.col("status") == "FAILED").alias("failed"))
    return g.withColumn("outcome", F.when(F.col("failed") == 0, "SUCCEEDED").otherwise("COMPLETED_WITH_ERRORS"))


@R.query("WITH " + _LISTED + ", azn AS (SELECT doc_id, j, unnest(range(json_array_length(j)::BIGINT)) AS i FROM azl WHERE json_type(j) = 'ARRAY'), s AS (SELECT doc_id, CAST(sum(coalesce(json_array_length(json_extract(j, '$[' || i || ']'), '$.pages'), 0)) AS BIGINT) AS got FROM azn GROUP BY doc_id), m AS (SELECT doc_id, arg_max(page_count, created_at) AS want FROM azure_meta WHERE page_count IS NOT NULL GROUP BY doc_id) SELECT s.doc_id, got, want FROM s JOIN m ON s.doc_id = m.doc_id WHERE got <> want")
def range_audit(spark: SparkSession, d: str) -> DataFrame:
    """Filings whose parts together hold another number of pages than the import recorded."""
    az = references(spark, d, "doc_id")
    n = F.aggregate("contents", F.lit(0), lambda a, c: a + F.coalesce(F.size(F.when(c["pages"].isNotNull(), c["pages"])), F.lit(0)))
    got = az.select("doc_id", n.alias("n")).groupBy("doc_id").agg(F.sum("n").alias("got"))
    want = table(spark, d, "azure_meta").where("page_count IS NOT NULL").groupBy("doc_id").agg(F.max_by("page_count", "created_at").alias("want"))
    return got.join(want, "doc_id").where("got <> want").select("doc_id", "got", "want")


def queries() -> dict:
    return R.queries()


def oracle_sql() -> dict[str, str]:
    return R.oracle_sql()
