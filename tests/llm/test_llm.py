"""Operators for text against brute force, round trips and held-out accuracy, with the awkward cases."""

import itertools
import random

from pyspark.sql import functions as F

from pagewright.llm import language, mixing, packing, pii, repair, tokens

# ------------------------------------------------------------------ personal information


def _kinds(text):
    return [(k, text[s:e]) for k, s, e, _ in pii.find(text)]


def test_validators():
    assert pii.luhn("046454286") and not pii.luhn("046454287")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    assert pii.dialable("2505550123") and not pii.dialable("1505550123")


def test_places():
    text = "Dear Ms. Harlow,\nMy SIN is 046-454-286. Call (250) 555-0123 or write to jo.b (at) mail.test.\nWe live at 12 Oak Street, Fernhill, BC  V0A 1B0.\n\nSincerely,\nJo Barley\n"
    assert _kinds(text) == [("name", "Harlow"), ("id_number", "046-454-286"), ("phone", "(250) 555-0123"), ("email", "jo.b (at) mail.test"), ("address", "12 Oak Street, Fernhill, BC  V0A 1B0"), ("name", "Jo Barley")]
    clean = pii.redact(text)
    assert "[NAME]" in clean and "[ADDRESS]" in clean and not any(x in clean for x in ("Harlow", "Barley", "046", "555", "Oak", "mail.test"))


def test_numbers_of_things_are_no_places():
    for text in ("The sample 071-108-249 was sent under work order 418 113 398.", "Invoice 9146840502 was filed.", "Follow @prairiewatch03 for notices.", "Flow was 403.555 m3 at post 003+839 @ 15 degrees.", "A notice was posted at Ferrier Point before dawn.", "Grant Hale Holdings Inc. supplied 20 Station Road mats."):
        assert _kinds(text) == [], text


def test_places_of_odd_rows(spark):
    long = "No one here. " * 40_000 + "Write to a@b.test today."
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, long, "x"), (None, "a@b.test", "x")], "doc_id long, text string, kind string")
    assert [(r.doc_id, r.kind, r.start_pos) for r in pii.places(df).collect()] == [(3, "email", 13 * 40_000 + 10)]
    assert {r.doc_id: r.text for r in pii.redacted(df.where("doc_id < 3")).collect()} == {1: None, 2: ""}
    assert pii.places(df.limit(0)).count() == 0


def test_code_points(spark):
    df = spark.createDataFrame([(1, "😀 é a@b.test")], "doc_id long, text string")
    assert pii.places(df).first().start_pos == 5


# ------------------------------------------------------------------ language

TEXT = {
    "en": "The company will restore the land after the work is finished and report every month to the landowners who live near the road",
    "fr": "La société remettra les terres en état après la fin des travaux et fera rapport chaque mois aux propriétaires qui vivent près de la route",
    "es": "La empresa restaurará los terrenos cuando terminen las obras e informará cada mes a los propietarios que viven cerca del camino",
    "de": "Das Unternehmen wird das Land nach dem Ende der Arbeiten wiederherstellen und den Eigentümern an der Straße jeden Monat berichten",
    "pt": "A empresa vai recuperar os terrenos depois do fim das obras e informar todos os meses os proprietários que vivem perto da estrada",
}


def _phrases(text, sample):
    """Greedy longest phrases by substring search."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in sample:
            j += 1
        n, i = n + 1, j
    return n


def test_parsing_equals_substring_search():
    rng = random.Random(2)
    samples = {k: "".join(rng.choice("abc ") for _ in range(300)) for k in ("x", "y")}
    model = language.Model(samples)
    pieces = ["".join(rng.choice("abc ") for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    h = model.entropy(pieces)
    for p, row in zip(pieces, h):
        for k, got, bits in zip(samples, row, model.bits):
            assert round(got * len(p) / bits) == _phrases(p, language.clean(samples[k])), (p, k)


def test_five_languages_from_the_built_in_text():
    model = language.Model(language.SEED)
    assert [model.langs[i] for i in model.entropy(list(TEXT.values())).argmin(axis=1)] == list(TEXT)


def test_filings_and_items(spark):
    item = lambda t: {"text": t, "prov": None}
    rows = [
        (1, "a", "anglais", [item(TEXT["en"] + "."), item(TEXT["en"] + ". " + TEXT["fr"] + "."), item(None), item("")]), (1, "a", "anglais", [item(TEXT["en"] + "."), item(TEXT["en"] + ". " + TEXT["fr"] + "."), item(None), item("")]),
        (2, "b", "en", [item(TEXT["de"] + ".")] * 3), (3, "c", None, None), (4, "d", "zxx", [None, item(TEXT["pt"] + ".")]),
    ]
    gz = spark.createDataFrame(rows, "gz_id long, doc_id string, lang_label string, texts array<struct<text:string,prov:array<struct<page_no:int>>>>")
    found = language.pieces(gz, language.SEED)
    mains = language.documents(found)
    assert {r.doc_id: r.lang for r in mains.collect()} == {"a": "en", "b": "de", "d": "pt"}
    assert [(r.doc_id, r.text_ix, r.lang) for r in language.foreign(found, mains).collect()] == [("a", 1, "fr")]
    assert {(r.text_ix, r.lang) for r in language.segments(found).where("doc_id = 'a'").collect()} == {(0, "en"), (1, "en"), (1, "fr")}
    empty = gz.limit(0)
    assert language.pieces(empty).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("en_US",), ("français",), ("??",), (None,), (" DE ",)], "l string")
    assert [r.x for r in df.select(language.label_language(F.col("l")).alias("x")).collect()] == ["en", "fr", None, None, "de"]


# ------------------------------------------------------------------ repair

WORDS = "construction follow-up measures operation community monitoring pipeline residents surface water samples collected upstream downstream crossing environment".split()


def _editor():
    rng = random.Random(1)
    made = {"".join(rng.choice("bdgklmnprstv") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))): (200, 400) for _ in range(300)}
    return repair.Editor(made | {w: (200, 400) for w in WORDS})


EDITOR = _editor()
FURNITURE = repair.Furniture()


def test_held_out_misreads():
    rng, right, kept, n = random.Random(9), 0, 0, 0
    for w in list(EDITOR.lex)[::2]:
        if "-" in w:
            continue
        seen = (EDITOR._spoil(w, rng) or ("", None))[0]
        if seen and seen not in EDITOR.lex and not seen.isdigit():
            n += 1
            right += EDITOR.fix(seen) == w
        kept += EDITOR.fix(w) == w
    assert right / n > 0.85 and kept == len([w for w in list(EDITOR.lex)[::2] if "-" not in w])


def test_numbers():
    assert EDITOR.fix("2O5") == "205" and EDITOR.fix("205") == "205"
    assert EDITOR.decimals("12.O and 233,5 or v2.O1x") == "12.0 and 233,5 or v2.O1x" and not EDITOR.clean("233.O", {})


def test_line_ends():
    assert EDITOR.joined("the cons-\ntruction of a follow-\nup and 12-\nday") == ("the construction of a follow-up and 12-day", True)
    assert EDITOR.joined("moni\xad\ntoring") == ("monitoring", True)
    assert EDITOR.joined("plain\ntext") == ("plain text", False)


def test_furniture_and_paragraphs():
    texts, pages = [], []
    for p in (1, 2, 3):
        texts += [f"Northern Crossing Report   Page {p}", "The construction of the pipeline. " * 3, f"measures {p}", "7", f"- {p + 3} -"]
        pages += [p] * 5
    texts[6] = "water samples collected up-"
    texts[11] = "stream of the crossing"
    texts += [None, "   "]
    pages += [3, None]
    found, text = repair.repair(texts, pages, EDITOR, FURNITURE)
    assert {i for i, k in found if k == "running_header"} == {0, 5, 10} and {i for i, k in found if k == "page_number"} == {4, 9, 14}
    assert "Northern" not in text and "- 4 -" not in text
    assert repair.repair([], [], EDITOR, FURNITURE) == ([], "") and repair.repair([None, ""], [None, 1], EDITOR, FURNITURE) == ([], "")


def test_found_on_tables(spark):
    gz_t = "gz_id long, doc_id string, run_id string, texts array<struct<text:string,prov:array<struct<page_no:int>>>>, kind string"
    meta_t = "doc_id string, run_id string, pages array<struct<page:int,staging:string>>"
    item = lambda t, p=1: {"text": t, "prov": [{"page_no": p}]}
    clean = [item("The construction of the pipeline near the water crossing was delayed")] * 30
    rows = [(1, "a", "r", clean, "x"), (1, "a", "r", clean, "x"), (2, "b", "r", [item("The constructi0n of the\npipeline near the wa-\nter crossing"), {"text": None, "prov": None}], "x"), (3, "c", None, None, "x")]
    gz = spark.createDataFrame(rows, gz_t)
    meta = spark.createDataFrame([("a", "r", [{"page": 1, "staging": "as-is"}]), ("b", "r", None)], meta_t)
    got = {(r.doc_id, r.text_ix, r.kind) for r in repair.found(gz, meta).collect()}
    assert got == {("b", 0, "hyphenation"), ("b", 0, "misread")}
    texts = {r.doc_id: r.text for r in repair.repaired(gz, meta).collect()}
    assert texts["b"] == "The construction of the pipeline near the water crossing"
    # More decisions than are broadcast: the same rows by a join.
    assert {(r.doc_id, r.text_ix, r.kind) for r in repair.found(gz, meta, most_fixes=0).collect()} == got
    assert repair.repaired(gz, meta, most_fixes=0).where("doc_id = 'b'").first().text == texts["b"]
    assert repair.found(gz.limit(0), meta.limit(0)).count() == 0


def test_the_same_texts_more_often_give_the_same_decisions():
    rng, seen = random.Random(3), {}
    for w in list(EDITOR.lex)[:150]:
        spoiled = EDITOR._spoil(w, rng)
        if spoiled and spoiled[0] not in EDITOR.lex:
            seen[spoiled[0]] = (0, rng.choice((1, 2)))
    small = EDITOR.lex | seen
    decided = []
    for times in (1, 10, 100):
        e = repair.Editor({w: (c * times, n * times) for w, (c, n) in small.items()})
        decided.append({w: e.fix(w) for w in small})
    assert decided[0] == decided[1] == decided[2]
    assert sum(decided[0][w] != w for w in seen) > 0.85 * len(seen)


def test_edits_off_the_list():
    assert EDITOR.fix("constrxction") == "construction" and EDITOR.fix("enviroment") == "environment" and EDITOR.fix("piipeline") == "pipeline"


def test_short_filings_have_furniture_too():
    got = FURNITURE(["Interim Statement", "The well was tested.", "Page 4", "Interim Statement", "It was dry.", "Page 5"], [1, 1, 1, 2, 2, 2])
    assert got == {0: "running_header", 2: "page_number", 3: "running_header", 5: "page_number"}


# ------------------------------------------------------------------ packing and mixing


def test_fullest_equals_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        items = [rng.randrange(1, 20) for _ in range(rng.randrange(0, 9))]
        cap = rng.randrange(0, 45)
        stock = [items.count(i) for i in range(25)]
        best = max(sum(c) for r in range(len(items) + 1) for c in itertools.combinations(items, r) if sum(c) <= cap)
        got = packing.fullest(stock, cap)
        assert sum(got) == best and all(got.count(x) <= stock[x] for x in got)


def test_packets_hold_every_token_once(spark):
    rng = random.Random(6)
    sizes = [(i, rng.choice([0, 3, 40, 100, 101, 260, rng.randrange(1, 90)])) for i in range(500)] + [(900, None)]
    docs = spark.createDataFrame(sizes + [(None, 5)], "doc_id long, tokens int")
    budgets = spark.createDataFrame([(1, 100), (2, 64), (3, 0), (4, None), (1, 100)], "budget_id int, capacity_tokens int")
    rows = packing.packets(docs, budgets, block_items=120).collect()
    for b, cap in ((1, 100), (2, 64)):
        mine = [r for r in rows if r.budget_id == b]
        fill, members = {}, {}
        for r in mine:
            fill[r.packet_id] = fill.get(r.packet_id, 0) + r.tokens
            members.setdefault(r.doc_id, []).append(r.tokens)
        assert {k: sum(v) for k, v in members.items()} == {k: v or 0 for k, v in sizes}
        assert max(fill.values()) <= cap and (cap != 100 or sum(fill.values()) / (cap * len(fill)) > 0.97)
        assert all(len(v) == 1 for k, v in members.items() if (dict(sizes)[k] or 0) <= cap)
    assert packing.packets(docs.limit(0), budgets).count() == 0


def test_mix_reaches_its_shares(spark):
    rng = random.Random(8)
    docs = [(i, "big" if i % 10 else "small", rng.randrange(20, 60)) for i in range(4000)] + [(9001, None, 5), (9002, "other", 5), (9003, "big", 0), (None, "big", 5)]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens int").withColumn("share", F.lit(1))
    targets = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 3), ("gone", 0.0, None)], "source string, target_share double, max_repeats int")
    draws, shares = mixing.draw(df, targets)
    s = {r.source: r for r in shares.collect()}
    assert abs(s["big"].reached_share - 0.7) < 0.01 and abs(s["small"].reached_share - 0.3) < 0.01 and s["gone"].draws == 0
    rows = draws.collect()
    assert len(rows) == len({(r.doc_id, r.repeat_no) for r in rows}) and max(r.repeat_no for r in rows if r.source == "small") <= 2 and all(r.repeat_no == 0 for r in rows if r.source == "big")
    assert [r.position for r in rows] == sorted(r.position for r in rows) and 0 <= rows[0].position and rows[-1].position <= 1
    assert {r.source for r in rows} == {"big", "small"}
    assert mixing.draw(df.limit(0), targets)[0].count() == 0
    assert mixing.draw(df, targets, total_tokens=10_000)[0].agg(F.sum("tokens")).first()[0] in range(9_800, 10_200)


def test_token_counts(spark):
    assert tokens.count(None) == tokens.count("") == 0 and tokens.count("hello world") == 2
    df = spark.createDataFrame([(1, None, 7), (2, "hello world", 7)], "doc_id long, text string, tokens int")
    assert {r.doc_id: r.tokens for r in tokens.with_tokens(df).collect()} == {1: 0, 2: 2}
