"""Queries over reference extractions whose contents came as JSON text."""

import json

import pytest

from pagewright.plans import catalogue, quality

CONTENT = "struct<markdown:string,endPageNumber:int,pages:array<struct<pageNumber:int,words:array<struct<content:string,confidence:double>>>>,paragraphs:array<struct<role:string,content:string>>,sections:array<struct<elements:array<string>>>,tables:array<struct<rowCount:int,columnCount:int,cells:array<struct<kind:string,rowIndex:int,columnIndex:int,content:string>>>>,figures:array<struct<id:string,caption:struct<content:string>>>,lines:array<struct<content:string>>,words:array<struct<content:string,confidence:double>>>"
AZURE = f"az_id long, doc_id string, part_no int, analyzer_id string, contents array<{CONTENT}>, contents_raw string"


def content(markdown, page):
    none = dict.fromkeys(("sections", "tables", "figures", "lines", "words"))
    return none | {"markdown": markdown, "endPageNumber": page, "pages": [{"pageNumber": page, "words": [{"content": "abcdefghij" * 3, "confidence": 0.9}]}], "paragraphs": [{"role": None, "content": "x"}]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Filing a has one part of each kind, b only JSON text, c neither kind, d only parsed contents; b's row is repeated."""
    at = str(tmp_path_factory.mktemp("references"))
    raw = lambda *x: json.dumps({"result": {"contents": list(x)}})
    b = (3, "b", 1, "z", None, raw(content("B", 1)))
    rows = [(1, "a", 1, "z", [content("A1 ", 1)], None), (2, "a", 2, "z", None, raw(content("A2", 2))), b, b, (4, "c", 1, "z", None, "nonsense"), (5, "c", 2, "z", None, None), (6, "d", 1, "z", [content("D", 1)], None)]
    spark.createDataFrame(rows, AZURE).write.parquet(f"{at}/azure_gz.parquet")
    gz = [(1, "b", [{"text": "abcdefgh", "prov": [{"page_no": 1}]}], [{"prov": [{"page_no": 1}], "data": {"table_cells": [{"text": "i J"}, None]}}])]
    spark.createDataFrame(gz, "gz_id long, doc_id string, texts array<struct<text:string,prov:array<struct<page_no:int>>>>, tables array<struct<prov:array<struct<page_no:int>>,data:struct<table_cells:array<struct<text:string>>>>>").write.parquet(f"{at}/docling_gz.parquet")
    return at


def test_coverage_sees_contents_that_came_as_text(spark, folder):
    got = {(r.doc_id, r.page_no): (r.ref_chars, r.shared) for r in quality.coverage_small_pages(spark, folder).collect()}
    assert got == {("a", 1): (30, 0), ("a", 2): (30, 0), ("b", 1): (30, 10), ("d", 1): (30, 0)}
    assert {r.doc_id: r.pages for r in quality.coverage_summary(spark, folder).collect()} == {"a": 2, "b": 1, "d": 1, "ALL": 4}


def test_counts_see_contents_that_came_as_text(spark, folder):
    assert {r.az_id: (r.pages, r.paragraphs, r.tables) for r in quality.reference_counts(spark, folder).collect()} == {1: (1, 1, 0), 2: (1, 1, 0), 3: (1, 1, 0), 6: (1, 1, 0)}


def test_merge_sees_contents_that_came_as_text(spark, folder):
    got = {r.doc_id: (r.content_ix, r.markdown, r.pages, r.end_page) for r in quality.merge_parts(spark, folder).collect()}
    assert got == {"a": (0, "A1 A2", 2, 2), "b": (0, "B", 1, 1), "d": (0, "D", 1, 1)}


def test_audits_see_contents_that_came_as_text(spark, folder):
    ledger = [(i, f"doc-{k}", 1, "z", "SUCCEEDED", 1) for i, k in enumerate(("1", "2", "3", "4"))]
    at = f"{folder}/audits"
    azure = spark.read.parquet(f"{folder}/azure_gz.parquet").replace({"a": "1", "b": "2", "c": "3", "d": "4"}, subset=["doc_id"])
    azure.write.parquet(f"{at}/azure_gz.parquet")
    spark.createDataFrame(ledger, "id long, document_id string, run_id int, analyzer_id string, status string, page_count int").write.parquet(f"{at}/analyses.parquet")
    spark.createDataFrame([("1", 2, 1), ("2", 5, 1), ("3", 1, 1), ("4", 1, 1)], "doc_id string, page_count int, created_at int").write.parquet(f"{at}/azure_meta.parquet")
    assert {r.id: r.invalid_reason for r in catalogue.artifact_validate(spark, at).collect()} == {0: None, 1: None, 2: "no artifact", 3: None}
    assert {r.id: r.status for r in catalogue.audit_artifacts(spark, at).collect()} == {0: "SUCCEEDED", 1: "SUCCEEDED", 2: "STALE_ARTIFACTS", 3: "SUCCEEDED"}
    assert [(r.doc_id, r.got, r.want) for r in catalogue.range_audit(spark, at).collect()] == [("2", 1, 5)]
