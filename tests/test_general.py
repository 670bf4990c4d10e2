"""Nested records, history and comparison against brute force, with the awkward cases."""

import json
import random
import unicodedata

from pyspark.sql import functions as F

from pagewright.operators import compare, history, nested
from pagewright.plans import problems
from pagewright.sources.extractions import parse_contents

KINDS = "struct<pages:array<struct<pageNumber:int,words:array<struct<content:string,confidence:double>>>>,figures:array<struct<id:string,caption:struct<content:string>>>,words:array<struct<content:string,confidence:double>>>"


def _raw(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, raw string").select("id", parse_contents(F.col("raw")).alias("contents"))


def test_wrappings_give_the_same_contents(spark):
    one = {"markdown": "m", "endPageNumber": "2", "pages": [{"pageNumber": "1", "words": ["a", {"content": "b", "confidence": 0.5}, None]}, None]}
    forms = [[one], one, {"contents": [one]}, {"contents": one}, {"result": {"contents": [one]}, "status": "ok"}, json.dumps([one])]
    got = [r.contents for r in _raw(spark, [json.dumps(f) for f in forms]).orderBy("id").collect()]
    assert all(g == got[0] for g in got)
    page = got[0][0].pages[0]
    assert page.pageNumber == 1 and [w and (w.content, w.confidence) for w in page.words] == [("a", None), ("b", 0.5), None] and got[0][0].pages[1] is None


def test_no_json_gives_null(spark):
    assert [r.contents for r in _raw(spark, ["", "nonsense", None]).collect()] == [None, None, None]


def test_keys_keep_positions_and_skip_nulls(spark):
    rows = [(1, [None, {"pages": [{"pageNumber": None, "words": None}, None, {"pageNumber": 3, "words": [None, {"content": "x", "confidence": None}]}], "figures": [{"id": None, "caption": None}], "words": []}]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, f"az_id long, contents array<{KINDS}>").withColumn("path", F.lit("clash"))
    got = {(r.rec_id, r.node, r.path, r.parent) for r in nested.keys(df, "az_id", problems.reference_graph(df)).collect()}
    assert got == {(1, "content", "1", None), (1, "page", "1.0", "1"), (1, "page", "1.2", "1"), (1, "word", "1.2.1", "1.2"), (1, "figure", "1.0", "1")}


def test_relations_are_typed_and_inline_singletons(spark):
    rows = [(1, [{"pages": [], "figures": [{"id": "f", "caption": {"content": "c"}}], "words": [{"content": "w", "confidence": 0.1}]}])]
    df = spark.createDataFrame(rows, f"az_id long, contents array<{KINDS}>")
    fig = nested.relation(df, "az_id", problems.reference_graph(df), "figure").first()
    assert (fig.parent, fig.id, fig.caption_content) == ("0", "f", "c")
    assert nested.relation(df, "az_id", problems.reference_graph(df), "content_word").first().content == "w"


def test_empty_tables(spark):
    df = spark.createDataFrame([], f"az_id long, contents array<{KINDS}>")
    assert nested.keys(df, "az_id", problems.reference_graph(df)).count() == 0
    h = spark.createDataFrame([], "k string, s int, l long, t long, a string")
    assert history.history(h, "k", "s", ["a"], "l", "t").count() == 0
    e = spark.createDataFrame([], "key string, a int")
    assert compare.differences(e, e, ["a"]).count() == 0


def _history(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, s int, l long, t long, a string, b string, _n0 string")
    return sorted((r.k, r.from_snapshot, r.to_snapshot, r.a, r.b) for r in history.history(df, "k", "s", ["a", "b"], "l", "t", **kw).collect())


def test_history_cases(spark):
    rows = [
        ("x", 1, 1, 1, None, "p", ""), ("x", 2, 1, 2, "A b", "p", ""), ("x", 3, 1, 3, "a B ", "P", ""), ("x", 4, 1, 4, "n/a", "—", ""), ("x", 6, 1, 5, "c", "p", ""), ("x", 7, 1, 6, "A B", "p", ""),
        ("y", 1, 1, 7, "é", None, ""), ("y", 2, 1, 8, unicodedata.normalize("NFD", "É"), " ", ""), (None, 1, 1, 9, "q", "q", ""), ("z", None, 1, 10, "q", "q", ""),
        ("w", 1, 5, 11, "late", "p", ""), ("w", 1, 4, 12, "early", "p", ""), ("w", 1, None, 13, "never", "p", ""), ("w", 1, 5, 14, "tie", "p", ""),
    ]
    assert ("x", 7, None, "A B", "p") in _history(spark, rows + rows) and ("w", 1, None, "tie", "p") in _history(spark, rows)
    got = {g[:3] for g in _history(spark, rows)}
    assert got == {("x", 1, 2), ("x", 2, 6), ("x", 6, 7), ("x", 7, None), ("y", 1, None), ("w", 1, None)}


def test_history_equals_brute_force_whatever_the_tree(spark):
    rng = random.Random(3)
    rows, t = [], 0
    for k in range(60):
        for s in range(12):
            if rng.random() < 0.8:
                t += 1
                rows.append((f"k{k}", s, rng.randrange(5), t, rng.choice(["u", "U ", "v", None, "-"]), rng.choice(["p", "q", ""]), ""))
    want = set()
    for k in {r[0] for r in rows}:
        best = {}
        for r in rows:
            if r[0] == k and (r[1] not in best or (r[2], r[3]) > best[r[1]][:2]):
                best[r[1]] = (r[2], r[3], r[4], r[5])
        cur, starts = [None, None], []
        for s in sorted(best):
            norm = [(v or "").strip().lower() for v in best[s][2:]]
            new = [n if n and n != "-" else c for n, c in zip(norm, cur)]
            if not starts or new != cur:
                starts.append(s)
            cur = new
        want |= {(k, a, b) for a, b in zip(starts, starts[1:] + [None])}
    for bits in ((20, 8), (4, 2), (2, 1)):
        assert {g[:3] for g in _history(spark, rows, leaf_bits=bits[0], branch_bits=bits[1])} == want


def test_differences_equal_brute_force(spark):
    rng = random.Random(5)
    a = {f"{i:05d}": (rng.randrange(3), None if i % 7 == 0 else i) for i in range(900) if i % 11}
    b = {k: (v[0], v[1] if int(k) % 50 else 7) for k, v in a.items() if int(k) % 97}
    b["zz"] = (1, 1)
    mk = lambda x: spark.createDataFrame([(k, *v, "extra") for k, v in x.items()] + [(None, 1, 1, "x")], "key string, p int, q int, side string")
    got = {(r.key, r.field, r.kind) for r in compare.differences(mk(a), mk(b).union(mk(b)), ["p", "q"], mean_chunk=8).collect()}
    want = {(k, "row", "missing_there") for k in a.keys() - b.keys()} | {(k, "row", "missing_here") for k in b.keys() - a.keys()}
    want |= {(k, f, "differs") for k in a.keys() & b.keys() for i, f in enumerate(("p", "q")) if a[k][i] != b[k][i]}
    assert got == want


def test_one_empty_side(spark):
    a = spark.createDataFrame([("1", 1), ("2", None)], "key string, p int")
    assert {(r.key, r.kind) for r in compare.differences(a, a.limit(0), ["p"]).collect()} == {("1", "missing_there"), ("2", "missing_there")}
    assert compare.differences(a, a, ["p"]).count() == 0


def test_elements_of_one_type_share_a_table(spark):
    rows = [(1, [{"pages": [{"words": [{"content": "p", "confidence": 0.5}, None]}], "words": [{"content": "c", "confidence": None}], "lines": [{"content": "l"}]}])]
    df = spark.createDataFrame(rows, "az_id long, contents array<struct<pages:array<struct<words:array<struct<content:string,confidence:double>>>>,words:array<struct<content:string,confidence:double>>,lines:array<struct<content:string>>>>")
    g = problems.reference_graph(df)
    assert {k: [r.name for r in v] for k, v in nested.shared(g).items() if len(v) > 1} == {"word": ["word", "content_word"]}
    got = {tuple(r) for r in nested.relation_table(df, "az_id", g, "word").select("node", "path", "parent_node", "parent", "content").collect()}
    assert got == {("word", "0.0.0", "page", "0.0", "p"), ("content_word", "0.0", "content", "0", "c")}
