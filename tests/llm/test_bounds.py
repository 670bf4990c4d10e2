"""Text operators on inputs that a bound would cut."""

from pyspark.sql import functions as F

from pagewright.llm import language, mixing, packing, pii, repair


def test_words_of_short_items_count(spark):
    rows = spark.createDataFrame([(["Easements", "The Easements of the pipeline", "7", None, ""], [1, 1, 1, 1, 1], [1])], "texts array<string>, pages array<int>, clean array<int>")
    got = {r.word: (r.clean, r.n) for r in repair.word_counts(rows).collect()}
    assert got["Easements"] == (2, 2) and got["pipeline"] == (1, 1)


def test_copies_do_not_fill_the_sample(spark):
    many = ["The water of well %s was tested by the company and it has not been in use for years." % w for w in ("one", "two", "three", "four", "five", "six")]
    # The text that sorts first by its hash is copied often enough to fill the sample alone.
    first = spark.createDataFrame([(t,) for t in many], "t string").orderBy(F.xxhash64("t")).first().t
    item = lambda t: {"text": t, "prov": None}
    rows = [(i, "a", "en", [item(first)]) for i in range(20)] + [(100 + i, "b", "en", [item(t)]) for i, t in enumerate(many)]
    gz = spark.createDataFrame(rows, "gz_id long, doc_id string, lang_label string, texts array<struct<text:string,prov:array<struct<page_no:int>>>>")
    sample = language.training_sample(gz, sample_items=6)["en"]
    assert all(t in sample for t in many)


def test_a_long_closing_formula_has_its_signer():
    text = "Bonjour,\nLe puits est sec.\n\nVeuillez agréer, Madame, Monsieur, l'expression de mes sentiments les plus distingués,\nLuc Fernet\n"
    assert [text[s:e] for k, s, e, _ in pii.find(text) if k == "name"] == ["Luc Fernet"]


def test_disguised_addresses_with_any_white_space():
    for text in ("Write to jo.b at mail dot\ntest today.", "Write to jo.b at mail dot test today."):
        assert [k for k, *_ in pii.find(text)] == ["email"], text


def _kinds(text):
    return {(k, text[s:e]) for k, s, e, _ in pii.find(text)}


def test_validators_turn_rows_on_and_off():
    assert ("id_number", "046 454 286") in _kinds("My SIN is 046 454 286, please keep it.")
    assert not _kinds("My SIN is 046 454 287, please keep it.")
    assert not _kinds("The sample 046 454 286 was sent.")
    assert ("id_number", "GB82 WEST 1234 5698 7654 32") in _kinds("My IBAN: GB82 WEST 1234 5698 7654 32 for the deposit.")
    assert not any(k == "id_number" for k, _ in _kinds("My IBAN: GB82 WEST 1234 5698 7654 33 for the deposit."))
    assert ("phone", "403-555-0142") in _kinds("Call 403-555-0142.") and not _kinds("Call 103-155-0142.")


def test_context_moves_names_and_addresses():
    assert ("name", "Ada Munro") in _kinds("Yesterday Mrs. Ada Munro spoke.") and not _kinds("Yesterday Mrs. Ada Munro Drilling spoke.")
    assert any(k == "address" for k, _ in _kinds("I live at 12 Elm Street, Birch Hollow, AB T0L 1Z0.")) and not any(k == "address" for k, _ in _kinds("Work order 12 Elm Street, Birch Hollow."))


def test_disguised_addresses_over_line_ends():
    assert ("email", "jo.b at mail\ndot test") in _kinds("write to jo.b at mail\ndot test\n") and ("email", "jo.b [at]\nmail.test") in _kinds("write to jo.b [at]\nmail.test now")


def test_starts_change_no_result():
    text = "Dr. Ada Munro told us. Contact: Joe Blake, 12 Main Street, Ferrier, AB T0L 1Z0, 403-555-0142; (403) 555-0177, +1 403 555 0188. My SIN is 046 454 286. selon M. Guy Roy, dit-il."
    starts, shift = pii._starts(text), pii._shifted
    digits = [m.start() for m in pii.DIGIT.finditer(text)]
    spans = lambda ms: [m.span() for m in ms]
    assert spans(pii._at(pii.PHONE, text, shift(text, digits, "+("))) == spans(pii.PHONE.finditer(text)) and len(spans(pii.PHONE.finditer(text))) == 3
    for name, pattern in (("titled", pii.TITLED), ("list", pii.LIST), ("by", pii.BY)):
        assert spans(pii._at(pattern, text, starts[name])) == spans(pattern.finditer(text))
    assert spans(pii._does(text, starts["does"])) == spans(pii.DOES.finditer(text))
    assert pii._starts("İ shifts places") is None and ("phone", "403-555-0142") in _kinds("İ 403-555-0142")


def test_short_pieces_get_a_language(spark):
    item = lambda t: {"text": t, "prov": None}
    english = ["The water of the well was tested by the company before the work began.", "We have lived here for many years and the road was closed."]
    german = ["Das ist nicht wahr.", "Wir haben das nicht gewusst."]
    gz = spark.createDataFrame([(1, "a", "en", [item(t) for t in english] + [item(None), item(""), item("123 456")]), (2, "b", None, [item(t) for t in german])], "gz_id long, doc_id string, lang_label string, texts array<struct<text:string,prov:array<struct<page_no:int>>>>")
    pieces = language.pieces(gz, language.SEED)
    mains = {r.doc_id: r.lang for r in language.documents(pieces).collect()}
    assert mains == {"a": "en", "b": "de"}
    assert {(r.doc_id, r.text_ix) for r in language.segments(pieces).collect()} == {("a", 0), ("a", 1), ("b", 0), ("b", 1)}
    mixed = spark.createDataFrame([(3, "c", "en", [item(english[0] + " Das ist nicht wahr. " + english[1])])], gz.schema)
    assert [r.lang for r in language.segments(language.pieces(mixed, language.SEED)).collect()]


def test_any_number_of_budgets(spark):
    docs = spark.createDataFrame([(i, 3 + i % 5) for i in range(40)], "doc_id long, tokens int")
    budgets = spark.createDataFrame([(b, 10 + b) for b in range(5)], "budget_id int, capacity_tokens int")
    got = packing.packets(docs, budgets, group=2)
    fill = got.groupBy("budget_id", "capacity_tokens", "packet_id").agg(F.sum("tokens").alias("n"))
    assert fill.where("n > capacity_tokens").count() == 0 and got.groupBy("budget_id").count().where("count = 40").count() == 5


def test_shares_say_what_sets_the_total(spark):
    docs = spark.createDataFrame([(i, "a" if i < 10 else "b", 10) for i in range(60)], "doc_id long, source string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    rows = {r.source: r for r in mixing.draw(docs, targets)[1].collect()}
    assert rows["a"].sets_total and not rows["b"].sets_total and rows["a"].wanted == rows["b"].wanted == 100
    assert {r.source: r.tokens for r in mixing.draw(docs, targets, total_tokens=60)[1].collect()} == {"a": 30, "b": 30}
