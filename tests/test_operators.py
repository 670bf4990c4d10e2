"""Golden cases of the reading, table, pairing, coverage, catalogue and run operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from pagewright.functions import scalars as S
from pagewright.operators import catalog, coverage, readings, tables


def _col(spark, values, f, kind="string"):
    return [r.o for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(f(F.col("v")).alias("o")).collect()]


def test_dates(spark):
    assert _col(spark, ["03/04/2026", "January 5, 2026", "2026.1.5", "2026-01-05T10:00:00", "x", None, "13/25/2026"], S.normalize_date) == ["2026-04-03", "2026-01-05", "2026-01-05", "2026-01-05", None, None, None]
    assert _col(spark, ["2026-09-31", "2026-13-01", "1989-01-01", "26-01-01", None], lambda c: S.parse_day(c, 2032)) == ["2026-09-30", None, None, None, None]


def test_names(spark):
    assert _col(spark, [" a  b\n", None], S.clean_text) == ["a b", ""]
    assert _col(spark, ["https://x/a b.pdf", "", None], S.url_stem) == ["a_b", "download", "download"]
    assert _col(spark, ["a/b", "", None], S.safe_component) == ["a_b", "unknown", "unknown"]


def test_number_tokens(spark):
    assert _col(spark, ["1,234.56 < 0.010 1.2E-05", ""], S.number_tokens) == [["1,234.56", "<0.010", "1.2E-05"], []]


@pytest.mark.parametrize("a,b,want", [("<0.010", "0.010", "comparator_change"), ("-5.5", "5.5", "sign_change"), ("24,25", "24.25", "magnitude_shift"), ("12.5", "12.6", "digit_substitution"), ("12.5", "112.5", "digit_insertion"), ("12.5E2", "12.5", "exponent_change"), ("<0.10", "0.010", "magnitude_shift"), ("0.10", "0.010", "magnitude_shift"), ("1.25", "12.6", None), ("1.234", "12.34", "magnitude_shift"), ("1.5", "1,5", "magnitude_shift"), ("1E2", "1E3", "magnitude_shift"), ("-7.5", "7.6", "digit_substitution"), ("884.5", "17.25", None)])
def test_operation(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    parts = df.select(*[F.struct(*S.number_parts(F.col(c))).alias(c) for c in ("a", "b")])
    assert parts.select(S.operation(F.col("a"), F.col("b")).alias("o")).first().o == want


@pytest.mark.parametrize("a,b,want", [("24,25", "24.25", "separator_substitution"), ("1.50", "15.0", "separator_moved"), ("0.10", "0.010", "digit_added_or_lost"), ("<10.0", "1.00", "separator_moved"), ("12", "34", "value_differs")])
def test_magnitude_cause(spark, a, b, want):
    parts = spark.createDataFrame([(a, b)], "a string, b string").select(*[F.struct(*S.number_parts(F.col(c))).alias(c) for c in ("a", "b")])
    assert parts.select(S.magnitude_cause(F.col("a"), F.col("b")).alias("o")).first().o == want


def test_agreement_on_one_page(spark):
    long = "the water of the well was tested on the first day of the month with care "
    rows = [(1, 1, 0, "a", long + "5 0.010 7 7"), (1, 1, 1, "b", long + "5 <0.010 7"), (1, 1, 2, "c", long + "5 0.010 7 7"), (1, 1, 3, "d", "x"), (2, 1, 0, "a", long), (3, 1, 0, "a", None), (3, 1, 1, "b", "")]
    df = spark.createDataFrame(rows, "doc_id long, page_no int, ord int, variant string, text string")
    tokens = readings.token_counts(readings.compared(df))
    got = {r.token: (r.kind, r.direction, r.other_counts) for r in readings.conflicts(tokens).collect()}
    assert got == {"0.010": ("token_difference", "others_missing", {"b": 0}), "<0.010": ("token_difference", "winner_missing", {"b": 1}), "7": ("count_difference", None, {"b": 1})}
    page = readings.page_agreement(tokens).collect()
    assert [(r.doc_id, r.compared_against, r.numeric_min, r.token_differences, r.count_differences, r.verdict) for r in page] == [(1, "b+c", 0.5, 2, 1, "numbers_differ")]


@pytest.mark.parametrize("scores,want", [([100, 101, 103], 2), ([100, 103, 104], 1), ([100, 102], 0), ([0], 0)])
def test_selection_is_a_guarded_fold(spark, scores, want):
    df = spark.createDataFrame([(1, 1, i, f"v{i}", s) for i, s in enumerate(scores)], "doc_id long, page_no int, ord int, variant string, alnum int")
    assert readings.select_reading(df.orderBy(F.rand(1))).first().variant == f"v{want}"


def test_page_quality_of_empty_text(spark):
    df = spark.createDataFrame([(1, 1, 0, "v", None), (1, 2, 0, "v", "")], "doc_id long, page_no int, ord int, variant string, text string")
    assert {(r.chars, r.alnum_ratio) for r in readings.page_quality(df).collect()} == {(0, 0.0)}


def test_pairing_needs_a_shared_reading(spark):
    kind = "doc long, ix int, token string, direction string, other_counts map<string,int>"
    good = [(1, 0, "24.25", "winner_missing", {"sml": 1, "hi": 1}), (1, 1, "24,25", "others_missing", {"sml": 0, "hi": 0})]
    bad = [(2, 0, "884.5", "winner_missing", {"raster": 1}), (2, 1, "17.25", "others_missing", {"hi": 0})]
    got = readings.pairing(spark.createDataFrame(good + bad, kind), ["doc"]).collect()
    assert [(r.doc, r.kept, r.other, r.operation, r.cause, r.variants) for r in got] == [(1, "24,25", "24.25", "magnitude_shift", "separator_substitution", "hi+sml")]


def test_thin_pages_keep_null_shapes_together(spark):
    df = spark.createDataFrame([(1, 0, 1000, None), (1, 1, 1000, None), (1, 2, 299, None), (1, 3, 5, "table")], "meta_id long, pos int, chars int, shape string")
    assert [r.pos for r in readings.thin_pages(df).collect()] == [2]


def test_table_checks(spark):
    cells = [(1, 0, 0, v, False) for v in ("<31T", "<3hT", "12.5", "12.6", "A1", "AI", None, "")] + [(1, 0, 1, str(i), False) for i in range(9)] + [(1, 0, 1, "n/a", False), (1, 0, 2, "n/a", False)]
    df = spark.createDataFrame(cells, "gz_id long, t int, c int, text string, header boolean")
    assert [(r.suspect, r.sibling) for r in tables.suspect_confusions(df).collect()] == [("<31T", "<3hT")]
    assert [(r.c, r.value) for r in tables.numeric_column_outliers(df).collect()] == [(1, "n/a")]


def test_coverage(spark):
    ref = spark.createDataFrame([("d", 1, "c" * 200, 0), ("d", 1, "a" * 120, 1), ("d", 2, "b" * 99, 0), ("e", 1, None, 0)], "doc_id string, page_no int, text string, place int")
    ours = spark.createDataFrame([("d", 1, "A" * 60 + "é")], "doc_id string, page_no int, text string")
    got = coverage.page_coverage(ours, ref)
    assert [(r.doc_id, r.page_no, r.ref_chars, r.shared) for r in got.collect()] == [("d", 1, 120, 60)]
    assert {(r.doc_id, r.mean, r.median, r.ge50) for r in coverage.summary(got).collect()} == {("d", 0.5, 0.5, 1), ("ALL", 0.5, 0.5, 1)}


def test_walk_survives_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (None, 9), (1, None)], "parent long, child long")
    got = {(r.node, r.depth) for r in catalog.container_walk(edges, spark.createDataFrame([(1,)], "root long")).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (4, 3)}


def test_merge_keeps_what_is_not_replaced(spark):
    old = spark.createDataFrame([("a", "X", "p"), ("b", "X", "p")], "id string, company string, project string")
    new = spark.createDataFrame([("a", " ", "q"), ("c", "Y", None)], "id string, company string, project string")
    got = {r.id: (r.company, r.project, r.status) for r in catalog.merge(old, new, "id", ["company", "project"]).collect()}
    assert got == {"a": ("X", "q", "updated"), "b": ("X", "p", "absent"), "c": ("Y", None, "new")}
    assert [(r.id, r.field, r.old, r.new) for r in catalog.changes(old, new, "id", ["company", "project"]).collect()] == [("a", "project", "p", "q")]


def test_retention(spark):
    t = datetime.datetime(2031, 1, 1)
    rows = [("d", 1, t, True, False), ("d", 2, t + datetime.timedelta(1), True, False), ("d", 3, t, False, False), ("e", 4, t, True, True), ("e", 5, t + datetime.timedelta(1), True, False)]
    got = {r.m: r.action for r in catalog.retention(spark.createDataFrame(rows, "k string, m long, at timestamp, finished boolean, pinned boolean"), "k", ["at", "m"], "pinned").collect()}
    assert got == {1: "remove", 2: "keep", 3: "untouched", 4: "keep", 5: "remove"}


def test_every_query_has_a_name_and_sql_matches():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 90
