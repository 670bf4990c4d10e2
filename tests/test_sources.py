"""Markup parsing, and the stream extension against the batch result."""

from pyspark.sql import functions as F

from pagewright.sources import html
from pagewright.streaming.fold import fold_new

PAGE = """<nav class="breadcrumb"><a href="/Item/View/1">Home</a><a href="/Item/View/22">Volume</a><a href="/Item/View/5">This</a></nav>
<select id="kind"><option value="">All</option><option value="7">Letters</option></select>
<table><tbody><tr><td><img title="PDF"></td><td><a href="/File/Download/91">A &amp; B</a></td><td>x</td></tr>
<tr><td><a href="/Item/View/92">Short</a></td><td>y</td></tr><tr><td>a</td><td>b</td><td>no link</td></tr></tbody></table><a class="next" href="?p=2">more</a>"""


def test_markup(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<tr><td>")], "page long, html string")
    rows = html.result_rows(df).collect()
    assert [(r.page, r.pos, r.document_id, r.name, r.is_file, r.kind, r.cells) for r in rows] == [(1, 0, "91", "A & B", True, "PDF", ["", "A & B", "x"])]
    clash = html.result_rows(df.withColumn("name", F.lit("n"))).first()
    assert clash.page.name == "n" and clash.name == "A & B"
    got = {r.page: r for r in html.page_links(df).withColumn("parent", html.breadcrumb_parent(F.col("breadcrumb_ids"), F.lit("5"))).collect()}
    assert got[1].parent == "22" and got[1].next_url == "?p=2" and got[1].facets == {"kind": {"7": "Letters"}}
    assert got[2].parent is None and got[3].facets == {}


def test_stream_equals_batch(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, v string")
    df.write.mode("append").parquet(src)
    fold_new(spark, src, df.schema, out, mark, ["id"])
    spark.createDataFrame([(2, "b"), (3, "c")], df.schema).write.mode("append").parquet(src)
    fold_new(spark, src, df.schema, out, mark, ["id"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "b"), (3, "c")]
