"""Queries over readings, agreement, page quality, tables, pairing, triage and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.functions import scalars as S
from pagewright.operators import coverage, readings, tables
from pagewright.plans.registry import Registry
from pagewright.session import once, spread, table
from pagewright.sources import fixtures as fx
from pagewright.sources.extractions import references

R = Registry()
PAGE = ["doc_id", "page_no"]
NUM = S.NUMBER
Q_SQL = "WITH " + fx.READINGS_SQL + """, q AS (SELECT *, CAST(length(text) AS INT) AS chars, CAST(length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) AS INT) AS alnum FROM readings),
scored AS (SELECT *, CASE WHEN chars > 0 THEN round(alnum / chars, 4) ELSE 0.0 END AS alnum_ratio FROM q)"""
W_SQL = Q_SQL + """, tried AS (SELECT doc_id, page_no, list({'ord': ord, 'variant': variant, 'score': alnum} ORDER BY ord) AS l FROM scored GROUP BY ALL),
folded AS (SELECT doc_id, page_no, list_reduce(l, lambda b, x: CASE WHEN x.score > b.score * 1.02 THEN x ELSE b END) AS w, CAST(len(l) AS INT) AS attempts, l[1].variant AS first_tried FROM tried),
winners AS (SELECT doc_id, page_no, w.variant AS variant, w.score AS score, attempts, first_tried FROM folded),
others AS (SELECT s.* FROM scored s JOIN winners w USING (doc_id, page_no) WHERE s.variant <> w.variant AND NOT (s.chars < 50 OR s.alnum_ratio < 0.35))"""
A_SQL = W_SQL + """, wtok AS (SELECT doc_id, page_no, variant, token, count(*) AS n FROM (SELECT doc_id, page_no, variant, unnest(regexp_split_to_array(text, '[ \\t\\n\\x0b\\f\\r]+')) AS token FROM scored) WHERE token <> '' GROUP BY ALL),
tot AS (SELECT s.doc_id, s.page_no, s.variant, CAST(coalesce(sum(n), 0) AS INT) AS total FROM scored s LEFT JOIN wtok USING (doc_id, page_no, variant) GROUP BY ALL),
shared AS (SELECT t.doc_id, t.page_no, t.variant, sum(least(t.n, x.n)) AS shared FROM wtok t JOIN winners w USING (doc_id, page_no) JOIN wtok x ON x.doc_id = t.doc_id AND x.page_no = t.page_no AND x.variant = w.variant AND x.token = t.token GROUP BY ALL),
agr AS (SELECT o.doc_id, o.page_no, o.variant, CAST(coalesce(s.shared, 0) AS BIGINT) AS shared, t.total AS total, wt.total AS winner_total, CASE WHEN greatest(t.total, wt.total) = 0 THEN 1.0 ELSE round(coalesce(s.shared, 0)::DOUBLE / greatest(t.total, wt.total), 4) END AS ratio
  FROM others o JOIN tot t USING (doc_id, page_no, variant) JOIN winners w USING (doc_id, page_no) JOIN tot wt ON wt.doc_id = o.doc_id AND wt.page_no = o.page_no AND wt.variant = w.variant LEFT JOIN shared s ON s.doc_id = o.doc_id AND s.page_no = o.page_no AND s.variant = o.variant)"""
N_SQL = A_SQL + f""", nums AS (SELECT doc_id, page_no, variant, token, count(*) AS n FROM (SELECT doc_id, page_no, variant, regexp_replace(unnest(regexp_extract_all(text, '{NUM}')), '\\s+', '', 'g') AS token FROM scored) GROUP BY ALL),
win AS (SELECT n.doc_id, n.page_no, token, n FROM nums n JOIN winners w USING (doc_id, page_no, variant)),
own AS (SELECT n.doc_id, n.page_no, n.variant, token, n FROM nums n JOIN others o USING (doc_id, page_no, variant)),
univ AS (SELECT o.doc_id, o.page_no, o.variant, token FROM others o JOIN win USING (doc_id, page_no) UNION SELECT doc_id, page_no, variant, token FROM own),
conf AS (SELECT u.doc_id, u.page_no, u.variant, u.token, coalesce(w.n, 0) AS winner_count, coalesce(o.n, 0) AS other_count FROM univ u LEFT JOIN win w USING (doc_id, page_no, token) LEFT JOIN own o USING (doc_id, page_no, variant, token) WHERE coalesce(w.n, 0) <> coalesce(o.n, 0)),
dirs AS (SELECT doc_id, page_no, token, winner_count, min(other_count) AS least_other, count(*) AS variants, CASE WHEN max((winner_count = 0 OR other_count = 0)::INT) = 1 THEN 'token_difference' ELSE 'count_difference' END AS kind,
  CASE WHEN max((winner_count = 0 OR other_count = 0)::INT) = 1 THEN CASE WHEN winner_count = 0 THEN 'winner_missing' WHEN max(other_count) = 0 THEN 'others_missing' ELSE 'bidirectional' END END AS direction FROM conf GROUP BY doc_id, page_no, token, winner_count)"""


AGREE_SQL = N_SQL + """, ntot AS (SELECT doc_id, page_no, variant, sum(n) AS n FROM nums GROUP BY ALL),
nshared AS (SELECT t.doc_id, t.page_no, t.variant, sum(least(t.n, x.n)) AS n FROM own t JOIN win x USING (doc_id, page_no, token) GROUP BY ALL),
agreed AS (SELECT a.*, CASE WHEN greatest(coalesce(t.n, 0), coalesce(wt.n, 0)) = 0 THEN 1.0 ELSE round(coalesce(s.n, 0)::DOUBLE / greatest(coalesce(t.n, 0), coalesce(wt.n, 0)), 4) END AS numeric_ratio
  FROM agr a JOIN winners w USING (doc_id, page_no) LEFT JOIN ntot t ON t.doc_id = a.doc_id AND t.page_no = a.page_no AND t.variant = a.variant LEFT JOIN ntot wt ON wt.doc_id = a.doc_id AND wt.page_no = a.page_no AND wt.variant = w.variant
  LEFT JOIN nshared s ON s.doc_id = a.doc_id AND s.page_no = a.page_no AND s.variant = a.variant),
fulldirs AS (SELECT d.*, x.other_counts FROM dirs d JOIN (SELECT doc_id, page_no, token, string_agg(variant || '=' || other_count, ',' ORDER BY variant) AS other_counts FROM conf GROUP BY ALL) x USING (doc_id, page_no, token)),
low AS (SELECT doc_id, page_no, string_agg(variant, '+' ORDER BY variant) AS compared_against, min(ratio) AS text_min, min(numeric_ratio) AS numeric_min FROM agreed GROUP BY ALL),
tally AS (SELECT doc_id, page_no, count(*) FILTER (kind = 'token_difference') AS token_differences, count(*) FILTER (kind = 'count_difference') AS count_differences, count(*) FILTER (direction = 'winner_missing') AS winner_missing,
  count(*) FILTER (direction = 'others_missing') AS others_missing, count(*) FILTER (direction = 'bidirectional') AS bidirectional FROM dirs GROUP BY ALL),
verdicts AS (SELECT l.doc_id, l.page_no, compared_against, text_min, numeric_min, coalesce(token_differences, 0) AS token_differences, coalesce(count_differences, 0) AS count_differences, coalesce(winner_missing, 0) AS winner_missing, coalesce(others_missing, 0) AS others_missing,
  coalesce(bidirectional, 0) AS bidirectional, greatest(coalesce(token_differences, 0) + coalesce(count_differences, 0) - 40, 0) AS truncated, CASE WHEN token_differences > 0 THEN 'numbers_differ' WHEN text_min < 0.98 THEN 'text_differs_numbers_agree' ELSE 'agree' END AS verdict
  FROM low l LEFT JOIN tally t ON t.doc_id = l.doc_id AND t.page_no = l.page_no)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return readings.page_quality(spread(fx.readings(spark, d)))


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return readings.token_counts(readings.compared(fx.readings(spark, d)))


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = _scored(spark, d)
    return s, readings.select_reading(s)


@R.query(Q_SQL + " SELECT doc_id, page_no, variant, chars, alnum, alnum_ratio FROM scored")
def page_quality(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select(*PAGE, "variant", "chars", "alnum", "alnum_ratio")


@R.query(Q_SQL + " SELECT doc_id, page_no, variant, chars FROM scored WHERE chars < 50 OR alnum_ratio < 0.35")
def broken_readings(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where(readings.looks_broken(F.col("chars"), F.col("alnum_ratio"))).select(*PAGE, "variant", "chars")


@R.query(W_SQL + " SELECT * FROM winners")
def select_reading(spark: SparkSession, d: str) -> DataFrame:
    return _both(spark, d)[1]


@R.query(W_SQL + " SELECT s.doc_id, s.page_no, s.variant, CASE WHEN chars < 50 THEN 'almost_no_text' ELSE 'not_character_like' END AS reason FROM scored s JOIN winners w USING (doc_id, page_no) WHERE s.variant <> w.variant AND (chars < 50 OR alnum_ratio < 0.35)")
def excluded_readings(spark: SparkSession, d: str) -> DataFrame:
    return readings.excluded(*_both(spark, d))


@R.query(W_SQL + " SELECT doc_id, page_no, first_tried, variant FROM winners WHERE attempts >= 2 AND variant <> first_tried")
def restaged_pages(spark: SparkSession, d: str) -> DataFrame:
    return _both(spark, d)[1].where("attempts >= 2 AND variant <> first_tried").select(*PAGE, "first_tried", "variant")


@R.query(N_SQL + " SELECT * FROM nums")
def numeric_tokens(spark: SparkSession, d: str) -> DataFrame:
    return readings.numeric_tokens(fx.readings(spark, d))


@R.query(AGREE_SQL + " SELECT * FROM agreed")
def text_agreement(spark: SparkSession, d: str) -> DataFrame:
    return readings.text_agreement(_tokens(spark, d))


@R.query(N_SQL + " SELECT * FROM conf")
def numeric_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return readings.conflicts(_tokens(spark, d)).select(*PAGE, F.explode("other_counts").alias("variant", "other_count"), "token", "winner_count")


def _directed(spark: SparkSession, d: str) -> DataFrame:
    """Conflicts with their counts as text, since maps have no order."""
    c = readings.conflicts(_tokens(spark, d))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("other_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return c.withColumn("other_counts", text)


@R.query(AGREE_SQL + " SELECT * FROM fulldirs")
def conflict_directions(spark: SparkSession, d: str) -> DataFrame:
    return _directed(spark, d)


@R.query(AGREE_SQL + """ SELECT doc_id, page_no, token, winner_count, least_other, variants, kind, direction, other_counts, rank, greatest(n - 40, 0) AS truncated FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, page_no) AS n,
  row_number() OVER (PARTITION BY doc_id, page_no ORDER BY (kind <> 'token_difference')::INT, -abs(winner_count - least_other), token) AS rank FROM fulldirs) WHERE rank <= 40""")
def conflict_top40(spark: SparkSession, d: str) -> DataFrame:
    return readings.conflict_top(_directed(spark, d))


@R.query(AGREE_SQL + " SELECT * FROM verdicts")
def verdicts(spark: SparkSession, d: str) -> DataFrame:
    return readings.page_agreement(_tokens(spark, d))


@R.query("WITH " + fx.LINES_SQL + r" SELECT doc_id, page_no FROM (SELECT doc_id, page_no, length(line) AS n, length(line) - length(regexp_replace(line, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS k FROM lines) WHERE n < 100 OR k / n > 0.2")
def unmapped_pages(spark: SparkSession, d: str) -> DataFrame:
    n, kept = F.length("line"), F.length(F.regexp_replace("line", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""))
    return fx.lines(spark, d).where((n < 100) | ((n - kept) / n > 0.2)).select(*PAGE)


@R.query("SELECT doc_id, regexp_replace(lower(text), '[^0-9a-z]', '', 'g') AS norm FROM documents WHERE text IS NOT NULL")
def coverage_norm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", S.coverage_norm(F.col("text")).alias("norm"))


# ------------------------------------------------------------------ pages of finished runs

P_SQL = "WITH " + fx.META_SQL


@R.query(P_SQL + """, s AS (SELECT meta_id, pos, list_sort(map_values(p.variant_scores), 'DESC') AS v FROM pages)
SELECT meta_id, pos, CASE WHEN v[1] > 0 THEN (v[1] - v[len(v)]) / v[1] ELSE 0.0 END AS spread, CASE WHEN v[1] > 0 THEN (v[1] - v[2]) / v[1] END AS margin FROM s""")
def page_spread(spark: SparkSession, d: str) -> DataFrame:
    return readings.spread(fx.meta_pages(spark, d).select("meta_id", "pos", F.col("p.variant_scores").alias("scores")), ["meta_id", "pos"])


@R.query(P_SQL + ", ps AS (SELECT meta_id, pos, p.chars AS chars, p.extracted_shape AS shape FROM pages) SELECT a.meta_id, a.pos, a.chars, a.shape, b.peer FROM ps a JOIN (SELECT meta_id, shape, quantile_cont(nullif(chars, 0), 0.5) AS peer FROM ps GROUP BY ALL) b ON a.meta_id = b.meta_id AND a.shape IS NOT DISTINCT FROM b.shape WHERE peer > 0 AND a.chars < 0.3 * peer")
def thin_pages(spark: SparkSession, d: str) -> DataFrame:
    return readings.thin_pages(fx.meta_pages(spark, d).select("meta_id", "pos", F.col("p.chars").alias("chars"), F.col("p.extracted_shape").alias("shape")))


D_SQL = P_SQL + """, doubts AS (
  SELECT meta_id, pos, 1 AS ord, 'almost_no_text' AS code FROM pages WHERE coalesce(p.chars, 0) < 50
  UNION ALL SELECT meta_id, pos, 2, 'not_character_like' FROM pages WHERE coalesce(nullif(p.alnum_ratio, 0), 1.0) < 0.35
  UNION ALL SELECT meta_id, pos, 3, 'variants_disagree_on_numbers' FROM pages WHERE p.variant_agreement.numeric_token_differences > 0
  UNION ALL SELECT meta_id, pos, 4, x.code FROM (SELECT meta_id, pos, unnest(p.doubts) AS x FROM pages) WHERE x.code IS NOT NULL),
d1 AS (SELECT meta_id, pos, code, min(ord) AS ord FROM doubts GROUP BY ALL)"""


def _doubts(spark: SparkSession, d: str) -> DataFrame:
    p = fx.meta_pages(spark, d)
    none = F.lit(None).cast("struct<ord:int,code:string>")
    mark = lambda i, code, cond: F.when(cond, F.struct(F.lit(i).alias("ord"), F.lit(code).alias("code"))).otherwise(none)
    own = F.array(
        mark(1, "almost_no_text", F.coalesce("p.chars", F.lit(0)) < 50), mark(2, "not_character_like", F.coalesce(F.nullif(F.col("p.alnum_ratio"), F.lit(0.0)), F.lit(1.0)) < 0.35),
        mark(3, "variants_disagree_on_numbers", F.col("p.variant_agreement.numeric_token_differences") > 0),
    )
    noted = F.transform(F.coalesce("p.doubts", F.expr("cast(array() as array<struct<code:string,observed:map<string,string>>>)")), lambda x: F.when(x["code"].isNotNull(), F.struct(F.lit(4).alias("ord"), x["code"].alias("code"))))
    every = p.select("meta_id", "pos", F.explode(F.array_compact(F.concat(own, noted))).alias("x"))
    return every.groupBy("meta_id", "pos", F.col("x.code").alias("code")).agg(F.min("x.ord").alias("ord"))


@R.query(D_SQL + " SELECT * FROM d1")
def page_doubts(spark: SparkSession, d: str) -> DataFrame:
    return _doubts(spark, d)


@R.query(D_SQL + " SELECT meta_id, code, list_sort(list(pos)) AS positions FROM d1 GROUP BY ALL")
def doubt_index(spark: SparkSession, d: str) -> DataFrame:
    return _doubts(spark, d).groupBy("meta_id", "code").agg(F.array_sort(F.collect_list("pos")).alias("positions"))


@R.query(D_SQL + " SELECT DISTINCT meta_id, pos FROM d1")
def reprocess_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages with any doubt."""
    return _doubts(spark, d).select("meta_id", "pos").distinct()


@R.query(P_SQL + " SELECT meta_id, p.staging AS variant, count(*) AS wins FROM pages GROUP BY ALL")
def variant_wins(spark: SparkSession, d: str) -> DataFrame:
    return fx.meta_pages(spark, d).groupBy("meta_id", F.col("p.staging").alias("variant")).agg(F.count(F.lit(1)).alias("wins"))


@R.query(P_SQL + """ SELECT meta_id, count(*) AS pages, CAST(sum(p.chars) AS BIGINT) AS chars, min(nullif(p.seconds, 0)) AS min_seconds, quantile_cont(nullif(p.seconds, 0), 0.5) AS median_seconds, max(nullif(p.seconds, 0)) AS max_seconds,
  count(*) FILTER (p.agreement = 'agree') AS agree, count(*) FILTER (p.agreement = 'numbers_differ') AS numbers_differ FROM pages GROUP BY ALL""")
def doc_quality(spark: SparkSession, d: str) -> DataFrame:
    sec = F.nullif(F.col("p.seconds"), F.lit(0.0))
    return fx.meta_pages(spark, d).groupBy("meta_id").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("p.chars").alias("chars"), F.min(sec).alias("min_seconds"), F.percentile(sec, F.lit(0.5)).alias("median_seconds"), F.max(sec).alias("max_seconds"),
        F.count_if(F.col("p.agreement") == "agree").alias("agree"), F.count_if(F.col("p.agreement") == "numbers_differ").alias("numbers_differ"))


@R.query(P_SQL + ", s AS (SELECT meta_id, list_sort(list(p.seconds)) AS v FROM pages WHERE p.seconds IS NOT NULL GROUP BY ALL) SELECT meta_id, v[len(v) // 2 + 1] AS seconds FROM s")
def upper_median(spark: SparkSession, d: str) -> DataFrame:
    v = F.array_sort(F.collect_list("p.seconds"))
    return fx.meta_pages(spark, d).where("p.seconds IS NOT NULL").groupBy("meta_id").agg(v.alias("v")).select("meta_id", F.element_at("v", (F.floor(F.size("v") / 2) + 1).cast("int")).alias("seconds"))


@R.query(P_SQL + " SELECT coalesce(p.variant_agreement.verdict, 'none') AS verdict, count(*) AS pages, count(DISTINCT doc_id) AS filings, CAST(sum(coalesce(p.variant_agreement.numeric_token_differences, 0)) AS BIGINT) AS differences FROM pages GROUP BY ALL")
def agreement_report(spark: SparkSession, d: str) -> DataFrame:
    return fx.meta_pages(spark, d).groupBy(F.coalesce("p.variant_agreement.verdict", F.lit("none")).alias("verdict")).agg(F.count(F.lit(1)).alias("pages"), F.countDistinct("doc_id").alias("filings"), F.sum(F.coalesce("p.variant_agreement.numeric_token_differences", F.lit(0))).alias("differences"))


C_SQL = P_SQL + """, c0 AS (SELECT meta_id, pos, p.variant_agreement.numeric_conflicts AS l FROM pages),
nc AS (SELECT meta_id, pos, i - 1 AS ix, l[i].token AS token, l[i].direction AS direction, l[i].kind AS kind, l[i].other_counts AS other_counts FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM c0) WHERE l[i] IS NOT NULL)"""


def _recorded(spark: SparkSession, d: str) -> DataFrame:
    return fx.meta_pages(spark, d).select("meta_id", "pos", F.posexplode("p.variant_agreement.numeric_conflicts").alias("ix", "x")).where(F.col("x").isNotNull()).select("meta_id", "pos", "ix", "x.token", "x.direction", "x.kind", "x.other_counts")


@R.query(C_SQL + ", e AS (SELECT meta_id, pos, unnest(map_keys(other_counts)) AS variant FROM nc) SELECT variant, count(*) AS conflicts, count(DISTINCT (meta_id, pos)) AS pages FROM e GROUP BY ALL")
def dissent(spark: SparkSession, d: str) -> DataFrame:
    return _recorded(spark, d).select("meta_id", "pos", F.explode(F.map_keys("other_counts")).alias("variant")).groupBy("variant").agg(F.count(F.lit(1)).alias("conflicts"), F.countDistinct("meta_id", "pos").alias("pages"))


# Written from the description of the operations, with DuckDB's own functions.
_OP = """CASE WHEN ac <> bc AND asg = bsg AND ar = br THEN 'comparator_change' WHEN asg <> bsg AND ac = bc AND ar = br THEN 'sign_change'
  WHEN contains(lower(ar), 'e') <> contains(lower(br), 'e') THEN 'exponent_change'
  WHEN least(av, bv) > 0 AND (abs(greatest(av, bv) / least(av, bv) - 10) < 0.01 OR abs(greatest(av, bv) / least(av, bv) - 100) < 0.1 OR abs(greatest(av, bv) / least(av, bv) - 1000) < 1.0) THEN 'magnitude_shift'
  WHEN replace(ar, '.', '') = replace(br, '.', '') AND ar <> br THEN 'decimal_shift'
  WHEN length(ar) = length(br) AND len(list_filter(range(1, length(ar) + 1), lambda i: substr(ar, i, 1) <> substr(br, i, 1))) = 1
    AND len(list_filter(range(1, length(ar) + 1), lambda i: substr(ar, i, 1) <> substr(br, i, 1) AND regexp_matches(substr(ar, i, 1), '^[0-9]$') AND regexp_matches(substr(br, i, 1), '^[0-9]$'))) = 1 THEN 'digit_substitution'
  WHEN abs(length(ar) - length(br)) = 1 AND len(list_filter(range(1, greatest(length(ar), length(br)) + 1), lambda i: CASE WHEN length(ar) > length(br) THEN substr(ar, 1, i - 1) || substr(ar, i + 1) = br ELSE substr(br, 1, i - 1) || substr(br, i + 1) = ar END)) > 0 THEN 'digit_insertion' END"""
_CAUSE = """CASE WHEN operation = 'magnitude_shift' THEN CASE WHEN length(ar) = length(br) AND len(list_filter(range(1, length(ar) + 1), lambda i: substr(ar, i, 1) <> substr(br, i, 1))) = 1
  AND len(list_filter(range(1, length(ar) + 1), lambda i: substr(ar, i, 1) <> substr(br, i, 1) AND substr(ar, i, 1) IN ('.', ',') AND substr(br, i, 1) IN ('.', ','))) = 1 THEN 'separator_substitution'
  WHEN regexp_replace(ar, '[.,]', '', 'g') = regexp_replace(br, '[.,]', '', 'g') THEN 'separator_moved' WHEN length(regexp_replace(ar, '[.,]', '', 'g')) <> length(regexp_replace(br, '[.,]', '', 'g')) THEN 'digit_added_or_lost' ELSE 'value_differs' END END"""
PAIR_SQL = C_SQL + f""", {fx.ITEM_CONFLICTS_SQL}, rare AS (SELECT * FROM (SELECT * FROM nc UNION ALL SELECT * FROM item_nc) WHERE NOT regexp_matches(token, '{S.COMMON}')),
holds AS (SELECT meta_id, pos, ix AS holder, token AS other, x.key AS variant FROM (SELECT meta_id, pos, ix, token, unnest(map_entries(other_counts)) AS x FROM rare WHERE direction = 'winner_missing') WHERE x.value > 0),
lacks AS (SELECT meta_id, pos, ix AS lacker, token AS kept, x.key AS variant FROM (SELECT meta_id, pos, ix, token, unnest(map_entries(other_counts)) AS x FROM rare WHERE direction = 'others_missing') WHERE x.value = 0),
j AS (SELECT meta_id, pos, kept, other, holder, lacker, string_agg(variant, '+' ORDER BY variant) AS variants FROM holds JOIN lacks USING (meta_id, pos, variant) GROUP BY ALL),
parts AS (SELECT *, regexp_extract(kept, '^([<>]?)\\s*([+-]?)(.*)$', 1) AS ac, regexp_extract(kept, '^([<>]?)\\s*([+-]?)(.*)$', 2) AS asg, regexp_extract(kept, '^([<>]?)\\s*([+-]?)(.*)$', 3) AS ar,
  regexp_extract(other, '^([<>]?)\\s*([+-]?)(.*)$', 1) AS bc, regexp_extract(other, '^([<>]?)\\s*([+-]?)(.*)$', 2) AS bsg, regexp_extract(other, '^([<>]?)\\s*([+-]?)(.*)$', 3) AS br FROM j),
vals AS (SELECT *, try_cast(replace(ar, ',', '') AS DOUBLE) AS av, try_cast(replace(br, ',', '') AS DOUBLE) AS bv FROM parts),
ops AS (SELECT *, {_OP} AS operation FROM vals),
pairs AS (SELECT meta_id, pos, kept, other, operation, CAST(list_position({list(S.OPERATIONS)}, operation) - 1 AS INT) AS priority, {_CAUSE} AS cause, variants, holder, lacker FROM ops WHERE operation IS NOT NULL)"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return readings.pairing(_recorded(spark, d).unionByName(fx.item_conflicts(spark, d)), ["meta_id", "pos"])


@R.query(PAIR_SQL + " SELECT meta_id, pos, kept, other, operation, priority, cause, variants FROM pairs")
def pairing(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).drop("holder", "lacker")


@R.query(PAIR_SQL + " SELECT operation, count(*) AS pairs, count(DISTINCT (meta_id, pos)) AS pages FROM pairs GROUP BY ALL")
def pairing_ops(spark: SparkSession, d: str) -> DataFrame:
    per = _pairs(spark, d).groupBy("operation", "meta_id", "pos").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("operation").agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("pages"))


@R.query(PAIR_SQL + " SELECT cause, count(*) AS pairs FROM pairs WHERE operation = 'magnitude_shift' GROUP BY cause")
def magnitude_causes(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).where("operation = 'magnitude_shift'").groupBy("cause").agg(F.count(F.lit(1)).alias("pairs"))


# Which doubts send a page to which review.
STRUCTURAL = ("table_grid_disputed", "table_mostly_dropped")
COMPLETENESS = ("almost_no_text", "not_character_like")
DIAGNOSTIC = ("bbox_clamped", "needed_retry", "ocr_empty", "thin_for_this_document", "variants_disagree_on_numbers")
_in = lambda codes: ", ".join(f"'{c}'" for c in codes)
_codes = lambda codes: f"list_filter(codes, lambda c: c IN ({_in(codes)}))"
T_SQL = PAIR_SQL + f""", ranked AS (SELECT meta_id, pos, operation || ': kept ' || chr(39) || kept || chr(39) || ' vs ' || chr(39) || other || chr(39) || ' (' || variants || ')' AS why, row_number() OVER (PARTITION BY meta_id, pos ORDER BY priority, holder, lacker, kept, other) AS n FROM pairs),
num AS (SELECT meta_id, pos, list(why ORDER BY n) FILTER (n <= 6) AS why FROM ranked GROUP BY ALL),
noted AS (SELECT meta_id, pos, list_sort(list(DISTINCT code)) AS codes FROM (SELECT meta_id, pos, unnest(p.doubts).code AS code FROM pages) WHERE code IS NOT NULL GROUP BY ALL),
every AS (SELECT coalesce(num.meta_id, noted.meta_id) AS meta_id, coalesce(num.pos, noted.pos) AS pos, num.why AS pairs, coalesce(codes, []) AS codes FROM num FULL JOIN noted ON num.meta_id = noted.meta_id AND num.pos = noted.pos),
review AS (SELECT meta_id, pos, list_filter([CASE WHEN pairs IS NOT NULL THEN 'review_numeric' END, CASE WHEN len({_codes(STRUCTURAL)}) > 0 THEN 'review_structural' END, CASE WHEN len({_codes(COMPLETENESS)}) > 0 THEN 'review_completeness' END], lambda x: x IS NOT NULL) AS tiers,
  coalesce(pairs, []) || {_codes(STRUCTURAL)} || {_codes(COMPLETENESS)} AS why, {_codes(DIAGNOSTIC)} AS diagnostic FROM every),
tiers AS (SELECT meta_id, pos, CASE WHEN len(tiers) > 0 THEN tiers ELSE ['diagnostic'] END AS tiers, CASE WHEN len(tiers) > 0 THEN why ELSE diagnostic END AS why FROM review WHERE len(tiers) > 0 OR len(diagnostic) > 0)"""


def _triage(spark: SparkSession, d: str) -> DataFrame:
    """(meta_id, pos, tiers, why): a pair sends a page to numeric review, the doubts noted on it to the others; diagnostic doubts count alone."""
    text = F.concat("operation", F.lit(": kept '"), "kept", F.lit("' vs '"), "other", F.lit("' ("), "variants", F.lit(")"))
    none = F.lit(None).cast("string")
    pairs = _pairs(spark, d).select("meta_id", "pos", F.struct("priority", "holder", "lacker", text.alias("text")).alias("pair"), none.alias("code"))
    noted = fx.meta_pages(spark, d).select("meta_id", "pos", F.explode("p.doubts").alias("x")).where(F.col("x.code").isNotNull()).select("meta_id", "pos", F.lit(None).cast(pairs.schema["pair"].dataType).alias("pair"), F.col("x.code").alias("code"))
    g = pairs.unionByName(noted).groupBy("meta_id", "pos").agg(F.array_sort(F.collect_list("pair")).alias("pairs"), F.array_sort(F.collect_set("code")).alias("codes"))
    of = lambda codes: F.filter("codes", lambda c: c.isin(*codes))
    tiers = F.array_compact(F.array(F.when(F.size("pairs") > 0, F.lit("review_numeric")), F.when(F.size(of(STRUCTURAL)) > 0, F.lit("review_structural")), F.when(F.size(of(COMPLETENESS)) > 0, F.lit("review_completeness"))))
    why = F.concat(F.transform(F.slice("pairs", 1, 6), lambda x: x["text"]), of(STRUCTURAL), of(COMPLETENESS))
    t = g.select("meta_id", "pos", tiers.alias("tiers"), why.alias("why"), of(DIAGNOSTIC).alias("diagnostic")).where((F.size("tiers") > 0) | (F.size("diagnostic") > 0))
    found = F.size("tiers") > 0
    return t.select("meta_id", "pos", F.when(found, F.col("tiers")).otherwise(F.array(F.lit("diagnostic"))).alias("tiers"), F.when(found, F.col("why")).otherwise(F.col("diagnostic")).alias("why"))


@R.query(T_SQL + " SELECT meta_id, pos, array_to_string(tiers, '+') AS tiers, array_to_string(why, '; ') AS why FROM tiers")
def triage(spark: SparkSession, d: str) -> DataFrame:
    return _triage(spark, d).select("meta_id", "pos", F.array_join("tiers", "+").alias("tiers"), F.array_join("why", "; ").alias("why"))


@R.query(T_SQL + " SELECT tier, count(*) AS pages FROM (SELECT unnest(tiers) AS tier FROM tiers) GROUP BY ALL UNION ALL SELECT 'queue', count(*) FILTER (starts_with(tier, 'review')) FROM (SELECT unnest(tiers) AS tier FROM tiers)")
def triage_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pages a tier, and the review queue of all tiers together."""
    tier = F.explode(F.concat("tiers", F.transform(F.filter("tiers", lambda t: t.startswith("review")), lambda t: F.lit("queue"))))
    return _triage(spark, d).select(tier.alias("tier")).groupBy("tier").agg(F.count(F.lit(1)).alias("pages"))


# ------------------------------------------------------------------ tables, shapes, warnings

X_SQL = "WITH " + fx.CELLS_SQL
I_SQL = "WITH " + fx.ITEM_CELLS_SQL


@R.query(I_SQL + """, v AS (SELECT DISTINCT gz_id, t, c, trim(text) AS value FROM cells WHERE NOT header AND length(trim(text)) >= 3)
SELECT DISTINCT a.gz_id, a.t, a.c, a.value AS suspect, b.value AS sibling FROM v a JOIN v b ON a.gz_id = b.gz_id AND a.t = b.t AND a.c IS NOT DISTINCT FROM b.c AND length(a.value) = length(b.value) AND a.value <> b.value
WHERE a.c IS NOT NULL AND len(list_filter(range(1, length(a.value) + 1), lambda i: substr(a.value, i, 1) <> substr(b.value, i, 1))) = 1 AND len(list_filter(range(1, length(a.value) + 1), lambda i: regexp_matches(substr(a.value, i, 1), '^\\p{Nd}$') AND regexp_matches(substr(b.value, i, 1), '^\\p{L}$'))) = 1""")
def suspect_confusions(spark: SparkSession, d: str) -> DataFrame:
    return tables.suspect_confusions(fx.item_cells(spark, d))


@R.query(I_SQL + f", b AS (SELECT *, regexp_matches(trim(text), '{S.NUMERIC_CELL}') AS ok FROM cells WHERE NOT header AND trim(text) <> '') SELECT gz_id, t, c, count(*) AS n, max(trim(text)) FILTER (NOT ok) AS value FROM b GROUP BY gz_id, t, c HAVING count(*) >= 10 AND count(*) FILTER (NOT ok) = 1")
def numeric_column_outliers(spark: SparkSession, d: str) -> DataFrame:
    return tables.numeric_column_outliers(fx.item_cells(spark, d))


@R.query(X_SQL + " SELECT CAST(round(bbox.r - bbox.l) AS INT) AS w, CAST(round(bbox.b - bbox.t) AS INT) AS h, count(*) AS n FROM cells WHERE bbox IS NOT NULL GROUP BY ALL")
def geometry_hist(spark: SparkSession, d: str) -> DataFrame:
    return fx.cells(spark, d).where("bbox IS NOT NULL").groupBy(F.round(F.col("bbox.r") - F.col("bbox.l")).cast("int").alias("w"), F.round(F.col("bbox.b") - F.col("bbox.t")).cast("int").alias("h")).agg(F.count(F.lit(1)).alias("n"))


@R.query("WITH " + fx.CELLS_SQL.split("tabs AS")[0].rstrip().rstrip(",") + """, has AS (SELECT DISTINCT gz_id, page, kind FROM (SELECT gz_id, unnest(tables).prov[1].page_no AS page, 'table' AS kind FROM gz UNION ALL SELECT gz_id, unnest(pictures).prov[1].page_no, 'picture' FROM gz UNION ALL SELECT gz_id, unnest(texts).prov[1].page_no, 'text' FROM gz) WHERE page IS NOT NULL)
SELECT gz_id, page, CASE WHEN bool_or(kind = 'table') AND bool_or(kind = 'picture') THEN 'table+picture' WHEN bool_or(kind = 'table') THEN 'table' WHEN bool_or(kind = 'picture') THEN 'picture' ELSE 'text' END AS shape FROM has GROUP BY ALL""")
def page_shapes(spark: SparkSession, d: str) -> DataFrame:
    gz = once(table(spark, d, "docling_gz").select("gz_id", "tables", "pictures", "texts"), "gz_id")
    first = lambda c, kind: F.transform(F.coalesce(c, F.expr(f"cast(array() as {gz.schema[c].dataType.simpleString()})")), lambda x: F.struct(F.try_element_at(x["prov"], F.lit(1))["page_no"].alias("page"), F.lit(kind).alias("kind")))
    h = gz.select("gz_id", F.explode(F.array_distinct(F.concat(first("tables", "table"), first("pictures", "picture"), first("texts", "text")))).alias("x")).where("x.page IS NOT NULL")
    g = h.groupBy("gz_id", F.col("x.page").alias("page")).agg(F.max(F.col("x.kind") == "table").alias("t"), F.max(F.col("x.kind") == "picture").alias("p"))
    return g.select("gz_id", "page", F.when(F.col("t") & F.col("p"), "table+picture").when(F.col("t"), "table").when(F.col("p"), "picture").otherwise("text").alias("shape"))


# What tells a warning's kind, the first that fits; warnings of the code itself; loggers left out.
KINDS = (("table_cells_dropped", "matched neither a row nor a column band"), ("ocr_empty", "returned empty result"), ("timeout", "processing timeout"), ("bbox_clamped", "is outside page bounds"))
OF_THE_CODE = ("DeprecationWarning", "FutureWarning", "PendingDeprecationWarning", "Using padding='same' with even kernel lengths")
LOGGERS = (fx.LOGGER,)
DROPPED, ON_PAGE = r"(\d+) of (\d+) pdf cells .*? of the (\d+x\d+) grid", r"on page (\d+)"
_str = lambda v: "'" + v.replace("'", "''") + "'"
V_SQL = "WITH " + fx.WARNINGS_SQL + ", k AS (SELECT *, CASE " + " ".join(f"WHEN contains(message, {_str(n)}) THEN '{k}'" for k, n in KINDS) + " ELSE 'other' END AS kind FROM warns WHERE NOT (" + " OR ".join([f"starts_with(logger, {_str(x)})" for x in LOGGERS] + [f"contains(message, {_str(x)})" for x in OF_THE_CODE]) + f""")),
m AS (SELECT *, CASE WHEN kind = 'table_cells_dropped' THEN regexp_extract(message, '{DROPPED}', ['d', 't', 'g']) END AS x FROM k),
l AS (SELECT event_id, doc_id, page_no, logger, message, kind, try_cast(x.d AS INT) AS dropped, try_cast(x.t AS INT) AS total, nullif(x.g, '') AS grid, CASE WHEN kind = 'bbox_clamped' THEN try_cast(regexp_extract(message, '{ON_PAGE}', 1) AS INT) END AS clamped_page, CASE WHEN try_cast(x.t AS INT) > 0 THEN round(try_cast(x.d AS INT) / try_cast(x.t AS INT), 4) END AS ratio FROM m)"""


def _warned(spark: SparkSession, d: str) -> DataFrame:
    """Warnings about filings with their kind and the numbers in them."""
    m = F.col("message")
    out = F.lit(False)
    for x in LOGGERS:
        out = out | F.col("logger").startswith(x)
    for x in OF_THE_CODE:
        out = out | m.contains(x)
    kind = F.lit("other")
    for name, needle in reversed(KINDS):
        kind = F.when(m.contains(needle), name).otherwise(kind)
    w = fx.warnings(spark, d).where(~out).withColumn("kind", kind)
    part = lambda i: F.when(F.col("kind") == "table_cells_dropped", F.nullif(F.regexp_extract(m, DROPPED, i), F.lit("")))
    w = w.withColumns({"dropped": part(1).try_cast("int"), "total": part(2).try_cast("int"), "grid": part(3), "clamped_page": F.when(F.col("kind") == "bbox_clamped", F.regexp_extract(m, ON_PAGE, 1).try_cast("int"))})
    return w.withColumn("ratio", F.when(F.col("total") > 0, F.round(F.col("dropped") / F.col("total"), 4)))


@R.query(V_SQL + " SELECT event_id, kind FROM l")
def warning_kinds(spark: SparkSession, d: str) -> DataFrame:
    return _warned(spark, d).select("event_id", "kind")


@R.query(V_SQL + " SELECT doc_id, kind, count(*) AS n FROM l GROUP BY ALL")
def warning_counts(spark: SparkSession, d: str) -> DataFrame:
    return _warned(spark, d).groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@R.query(V_SQL + " SELECT event_id, dropped, total, ratio, grid, clamped_page FROM l WHERE dropped IS NOT NULL OR clamped_page IS NOT NULL")
def drop_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _warned(spark, d).where("dropped IS NOT NULL OR clamped_page IS NOT NULL").select("event_id", "dropped", "total", "ratio", "grid", "clamped_page")


@R.query(V_SQL + " SELECT doc_id, CAST(sum(dropped) AS BIGINT) AS dropped_total, count(*) AS losses, count(*) FILTER (ratio > 0.5) AS severe, max(ratio) AS worst FROM l WHERE ratio IS NOT NULL GROUP BY ALL")
def table_losses(spark: SparkSession, d: str) -> DataFrame:
    return _warned(spark, d).where("ratio IS NOT NULL").groupBy("doc_id").agg(F.sum("dropped").alias("dropped_total"), F.count(F.lit(1)).alias("losses"), F.count_if(F.col("ratio") > 0.5).alias("severe"), F.max("ratio").alias("worst"))


@R.query(V_SQL + " SELECT doc_id, page_no, event_id, over FROM (SELECT doc_id, page_no, event_id, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY event_id) AS n, greatest(count(*) OVER (PARTITION BY doc_id, page_no) - 500, 0) AS over FROM l) WHERE n <= 500")
def warning_cap(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("doc_id", "page_no")
    return _warned(spark, d).select("doc_id", "page_no", "event_id", F.row_number().over(w.orderBy("event_id")).alias("n"), F.greatest(F.count(F.lit(1)).over(w) - 500, F.lit(0)).alias("over")).where("n <= 500").drop("n")


M_SQL = "WITH modes AS (SELECT o_orderkey, o_orderkey % 7 AS dropped, o_custkey % 7 AS alt_dropped, o_orderkey % 11 AS text, o_custkey % 11 AS alt_text, o_orderkey % 3 AS shape, o_custkey % 3 AS alt_shape FROM orders)"


def _modes(spark: SparkSession, d: str) -> DataFrame:
    o, k, c = table(spark, d, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    m = o.select(k, (k % 7).alias("dropped"), (c % 7).alias("alt_dropped"), (k % 11).alias("text"), (c % 11).alias("alt_text"), (k % 3).alias("shape"), (c % 3).alias("alt_shape"))
    return tables.mode_choice(m, ["o_orderkey"])


@R.query(M_SQL + " SELECT o_orderkey, CASE WHEN alt_dropped < dropped OR (alt_dropped = dropped AND alt_text > text) THEN 'alternate' ELSE 'first' END AS kept, shape = alt_shape AS shapes_agree FROM modes WHERE dropped > 0")
def table_mode_choice(spark: SparkSession, d: str) -> DataFrame:
    return _modes(spark, d)


@R.query(M_SQL + " SELECT o_orderkey FROM modes WHERE dropped > 0 AND shape <> alt_shape")
def grid_disputes(spark: SparkSession, d: str) -> DataFrame:
    return _modes(spark, d).where("NOT shapes_agree").select("o_orderkey")


# ------------------------------------------------------------------ coverage and reference parts

_hist = lambda p: ", ".join(f"sum(length(norm) - length(replace(norm, '{ch}', ''))) AS {p}_{ch}" for ch in coverage.LETTERS)
_RAW_SQL = """WITH az AS (SELECT * FROM azure_gz QUALIFY row_number() OVER (PARTITION BY az_id ORDER BY doc_id) = 1),
raw AS (SELECT az_id, doc_id, part_no, CASE WHEN contents IS NOT NULL THEN to_json(contents) WHEN json_type(contents_raw) = 'OBJECT' AND json_exists(contents_raw, '$.contents') THEN json_extract(contents_raw, '$.contents')
  WHEN json_type(contents_raw) = 'OBJECT' AND json_exists(contents_raw, '$.result') THEN coalesce(json_extract(contents_raw, '$.result.contents'), json_extract(contents_raw, '$.result')) ELSE contents_raw::JSON END AS j FROM az),
listed AS (SELECT az_id, doc_id, part_no, CASE WHEN json_type(j) = 'OBJECT' THEN json_array(j) ELSE j END AS j FROM raw),
content AS (SELECT az_id, doc_id, part_no, i, x FROM (SELECT az_id, doc_id, part_no, i, json_extract(j, '$[' || i || ']') AS x FROM (SELECT *, unnest(range(coalesce(json_array_length(j), 0)::BIGINT)) AS i FROM listed)) WHERE json_type(x) <> 'NULL')"""
_SIZE = "coalesce(json_array_length(x, '$.{0}'), 0)::BIGINT".format
COV_SQL = _RAW_SQL + """, gz AS (SELECT * FROM docling_gz QUALIFY row_number() OVER (PARTITION BY gz_id ORDER BY doc_id) = 1),
pg AS (SELECT az_id, doc_id, part_no, i, k, json_extract(x, '$.pages[' || k || ']') AS p FROM (SELECT *, unnest(range(""" + _SIZE("pages") + """)) AS k FROM content)),
rp AS (SELECT doc_id, try_cast(json_extract_string(p, '$.pageNumber') AS INT) AS page_no, part_no, az_id, i, k, (SELECT string_agg(CASE WHEN json_type(w) = 'OBJECT' THEN coalesce(json_extract_string(w, '$.content'), '') ELSE coalesce(json_extract_string(w, '$'), '') END, '') FROM (SELECT unnest(json_extract(p, '$.words[*]')) AS w)) AS text FROM pg WHERE json_type(p) <> 'NULL'),
rl AS (SELECT * FROM rp WHERE page_no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY part_no DESC NULLS LAST, az_id DESC, i DESC, k DESC) = 1),
op AS (SELECT doc_id, t.prov[1].page_no AS page_no, t.text AS text FROM (SELECT doc_id, unnest(texts) AS t FROM gz) UNION ALL
  SELECT doc_id, page_no, c.text FROM (SELECT doc_id, tb.prov[1].page_no AS page_no, unnest(tb.data.table_cells) AS c FROM (SELECT doc_id, unnest(tables) AS tb FROM gz))),
rn AS (SELECT doc_id, page_no, regexp_replace(lower(coalesce(text, '')), '[^0-9a-z]', '', 'g') AS norm FROM rl), onn AS (SELECT doc_id, page_no, regexp_replace(lower(coalesce(text, '')), '[^0-9a-z]', '', 'g') AS norm FROM op),
""" + f"rh AS (SELECT doc_id, page_no, {_hist('r')} FROM rn GROUP BY doc_id, page_no), oh AS (SELECT doc_id, page_no, {_hist('o')} FROM onn GROUP BY doc_id, page_no),\n" + \
    f"cov AS (SELECT rh.doc_id, rh.page_no, CAST({' + '.join(f'r_{ch}' for ch in coverage.LETTERS)} AS BIGINT) AS ref_chars, CAST({' + '.join(f'least(r_{ch}, coalesce(o_{ch}, 0))' for ch in coverage.LETTERS)} AS BIGINT) AS shared FROM rh LEFT JOIN oh ON rh.doc_id = oh.doc_id AND rh.page_no = oh.page_no),\n"


def _covered_sql(least: int) -> str:
    return COV_SQL + f"covered AS (SELECT * FROM cov WHERE ref_chars >= {least})"


def _coverage(spark: SparkSession, d: str, least: int) -> DataFrame:
    az = references(spark, d, "doc_id", "part_no")
    pages = az.select("az_id", "doc_id", "part_no", F.posexplode("contents").alias("i", "c")).select("az_id", "doc_id", "part_no", "i", F.posexplode("c.pages").alias("k", "p")).where(F.col("p").isNotNull() & F.col("p.pageNumber").isNotNull())
    words = F.array_join(F.transform(F.coalesce(F.col("p.words"), F.array().cast("array<struct<content:string,confidence:double>>")), lambda w: F.coalesce(w["content"], F.lit(""))), "")
    ref = pages.select("doc_id", F.col("p.pageNumber").alias("page_no"), words.alias("text"), F.struct("part_no", "az_id", "i", "k").alias("place"))
    gz = once(table(spark, d, "docling_gz").select("gz_id", "doc_id", "texts", "tables"), "gz_id")
    # Items and table cells of a filing, each with the page it is placed on first.
    first = lambda prov: F.try_element_at(prov, F.lit(1))["page_no"]
    piece = "array<struct<page_no:int,text:string>>"
    texts = F.transform("texts", lambda t: F.struct(first(t["prov"]).alias("page_no"), t["text"].alias("text")))
    cells = F.flatten(F.transform("tables", lambda t: F.transform(F.coalesce(t["data"]["table_cells"], F.array().cast(gz.schema["tables"].dataType.elementType["data"].dataType["table_cells"].dataType)), lambda c: F.struct(first(t["prov"]).alias("page_no"), c["text"].alias("text")))))
    none = F.array().cast(piece)
    ours = gz.select("doc_id", F.explode(F.concat(F.coalesce(texts.cast(piece), none), F.coalesce(cells.cast(piece), none))).alias("x")).select("doc_id", "x.page_no", "x.text")
    return coverage.page_coverage(ours, ref, least)


# A page of these reference tables holds few words; the operator's own least size is 100 characters.
SMALL = 20


@R.query(_covered_sql(coverage.LEAST) + " SELECT * FROM covered")
def coverage_pages(spark: SparkSession, d: str) -> DataFrame:
    return _coverage(spark, d, coverage.LEAST)


@R.query(_covered_sql(SMALL) + " SELECT * FROM covered")
def coverage_small_pages(spark: SparkSession, d: str) -> DataFrame:
    return _coverage(spark, d, SMALL)


@R.query(_covered_sql(SMALL) + """ SELECT doc_id, count(*) AS pages, round(avg(shared / ref_chars), 6) AS mean, round(quantile_cont(shared / ref_chars, 0.5), 6) AS median, count(*) FILTER (shared / ref_chars >= 0.95) AS ge95,
  count(*) FILTER (shared / ref_chars >= 0.8 AND shared / ref_chars < 0.95) AS ge80, count(*) FILTER (shared / ref_chars >= 0.5 AND shared / ref_chars < 0.8) AS ge50, count(*) FILTER (shared / ref_chars < 0.5) AS lt50
  FROM (SELECT * FROM covered UNION ALL SELECT 'ALL', page_no, ref_chars, shared FROM covered) GROUP BY doc_id""")
def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    return coverage.summary(_coverage(spark, d, SMALL))


# The first content object is the one whose lists are counted; an audit of the first and last page goes by what the pages say.
@R.query(_RAW_SQL + ", f AS (SELECT az_id, json_extract(j, '$[0]') AS x FROM listed WHERE json_type(j) = 'ARRAY') SELECT az_id, " + ", ".join(f"{_SIZE(f)} AS {f}" for f in ("pages", "paragraphs", "sections", "tables", "figures")) + " FROM f")
def reference_counts(spark: SparkSession, d: str) -> DataFrame:
    az = references(spark, d).where("contents IS NOT NULL").withColumn("c", F.try_element_at("contents", F.lit(1)))
    return az.select("az_id", *[F.coalesce(F.size(F.when(F.col(f"c.{f}").isNotNull(), F.col(f"c.{f}"))), F.lit(0)).cast("long").alias(f) for f in ("pages", "paragraphs", "sections", "tables", "figures")])


LISTS = ("pages", "paragraphs", "sections", "tables", "figures", "lines", "words")


@R.query(_RAW_SQL + f", e AS (SELECT doc_id, part_no, i, x, json_extract_string(x, '$.markdown') AS markdown, try_cast(json_extract_string(x, '$.endPageNumber') AS INT) AS end_page FROM content) SELECT doc_id, i AS content_ix, string_agg(markdown, '' ORDER BY part_no, az_id) AS markdown, "
         .replace("SELECT doc_id, part_no, i, x", "SELECT az_id, doc_id, part_no, i, x") + ", ".join(f"CAST(sum({_SIZE(f)}) AS BIGINT) AS {f}" for f in LISTS) + ", arg_max(end_page, (part_no, az_id)) FILTER (end_page IS NOT NULL) AS end_page FROM e GROUP BY doc_id, i")
def merge_parts(spark: SparkSession, d: str) -> DataFrame:
    """The merged record's text, the sizes of its lists and its last page, per content object."""
    m = merged_parts(spark, d)
    return m.select("doc_id", "content_ix", "markdown", *[F.size(f).cast("long").alias(f) for f in LISTS], "end_page")


def merged_parts(spark: SparkSession, d: str) -> DataFrame:
    """One record per filing and content object: the parts' lists joined end to end, nothing renumbered or dropped, texts joined, the last end page kept.

    A filing's parts hold 30 pages each at most, so a merged record is as large as the filing.
    """
    az = references(spark, d, "doc_id", "part_no")
    e = az.select("doc_id", F.struct("part_no", "az_id").alias("place"), F.posexplode("contents").alias("content_ix", "c")).where("c IS NOT NULL")
    g = e.groupBy("doc_id", "content_ix").agg(F.collect_list(F.struct("place", "c")).alias("x"), F.max_by("c.endPageNumber", F.when(F.col("c.endPageNumber").isNotNull(), F.col("place"))).alias("end_page"))
    parts = F.array_sort("x", lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0))
    g = g.select("doc_id", "content_ix", parts.alias("x"), "end_page")

    def joined(f: str):
        return F.flatten(F.transform("x", lambda v: F.coalesce(v["c"][f], F.array().cast(e.schema["c"].dataType[f].dataType)))).alias(f)

    text = F.filter(F.transform("x", lambda v: v["c"]["markdown"]), lambda m: m.isNotNull())
    return g.select("doc_id", "content_ix", F.when(F.size(text) > 0, F.array_join(text, "")).alias("markdown"), *[joined(f) for f in LISTS], "end_page")


def queries() -> dict:
    return R.queries()


def oracle_sql() -> dict[str, str]:
    return R.oracle_sql()
