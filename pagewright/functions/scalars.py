"""Scalar functions as column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number tokens as written, with an optional comparator.
NUMBER = r"[<>]?\s*[+-]?(?:(?:\d{1,3}(?:,\d{3})+|\d+)(?:[.,]\d+)?|[.,]\d+)(?:[eE][+-]?\d+)?"
COMMON = r"^[+-]?(?:\d|1\d|19\d\d|20\d\d)$"
NUMERIC_CELL = r"^[<>]?\s*-?\d+(?:[.,]\d+)?$"
RETRYABLE = ("408", "429", "500", "502", "503", "504", "SERVICE_REQUEST_ERROR")


def clean_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end; null where nothing is left."""
    return F.nullif(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def norm_label(c: Column) -> Column:
    """A form label in small letters, words apart by one blank, without brackets, marks and a colon at the end."""
    low = F.regexp_replace(F.lower(clean_text(c)), r":+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(low, r"[(){}\[\]]", " "), r"[^0-9a-z]+", " "))


def url_stem(c: Column) -> Column:
    """A file name out of an address: its last part unquoted, without .pdf, other characters as underscores, 80 at most."""
    last = F.element_at(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"[?#].*$", ""), "/"), -1)
    # A plus stays a plus in a path; broken escapes stay as they are.
    plain = F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last)
    safe = F.substring(F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"(?i)\.pdf$", ""), r"[^0-9A-Za-z._-]+", "_"), r"^[._-]+|[._-]+$", ""), 1, 80)
    return F.when(safe == "", F.lit("download")).otherwise(safe)


def safe_component(c: Column) -> Column:
    """A path component: letters and digits of any script, dot, dash and underscore stay."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}._-]", "_")
    return F.when(s == "", F.lit("unknown")).otherwise(s)


# Date formats in the order they are tried, day before month, then a token anywhere in the text.
DATE_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"), (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"), (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"), (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
)
DATE_TOKEN = r"\b((?:19|20)\d{2})[-/.](\d{1,2})[-/.](\d{1,2})\b"


def normalize_date(c: Column) -> Column:
    """ISO date of the first format that fits, else of a year-month-day token in the text; null where none does."""
    s = F.regexp_replace(clean_text(c), r"T.*$", "")
    tidy = F.initcap(F.lower(s))
    tries = [F.when(s.rlike(rx), F.to_date(F.try_to_timestamp(tidy if "MMM" in f else s, F.lit(f)))) for rx, f in DATE_SHAPES]
    token = F.concat_ws("-", *[F.regexp_extract(s, DATE_TOKEN, i) for i in (1, 2, 3)])
    return F.date_format(F.coalesce(*tries, F.to_date(F.try_to_timestamp(F.when(s.rlike(DATE_TOKEN), token), F.lit("yyyy-M-d")))), "yyyy-MM-dd")


def parse_day(c: Column, last_year: int) -> Column:
    """Strict Y-M-D between 1990 and ``last_year``; a day past the month's end is clamped, anything else is null."""
    y, m, d = (F.regexp_extract(c, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", i).try_cast("int") for i in (1, 2, 3))
    ok = y.between(1990, last_year) & m.between(1, 12) & (d >= 1)
    first = F.make_date(F.when(ok, y), F.when(ok, m), F.when(ok, F.lit(1)))
    return F.date_format(F.date_add(first, F.least(d, F.dayofmonth(F.last_day(first))) - 1), "yyyy-MM-dd")


def coverage_norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^0-9a-z]", "")


def alnum_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def number_tokens(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(f"({NUMBER})"), F.lit(1)), lambda t: F.regexp_replace(t, r"\s+", ""))


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


# Leading bytes of a file, in hexadecimal, and its type; a page is known by its tags.
MAGIC = (("255044462D", "application/pdf"), ("504B0304", "application/zip"), ("89504E47", "image/png"), ("FFD8FF", "image/jpeg"), ("49492A00", "image/tiff"), ("4D4D002A", "image/tiff"))


def sniff(c: Column) -> Column:
    """Media type by leading bytes (binary); null and empty are of no known type."""
    head = F.hex(F.substring(c, 1, 8))
    out = F.when(head.startswith(MAGIC[0][0]), MAGIC[0][1])
    for bytes_, kind in MAGIC[1:]:
        out = out.when(head.startswith(bytes_), kind)
    low = F.lower(F.substring(F.regexp_replace(F.decode(c, "ISO-8859-1"), r"^[ \t\n\r\x0b\f]+", ""), 1, 1024))
    return out.when(low.startswith("<!doctype html") | low.contains("<html") | low.contains("<body"), "text/html").otherwise("application/octet-stream")


def is_container(kind: Column) -> Column:
    """Kinds that hold other items."""
    return F.lower(clean_text(kind)).isin("compound document", "folder")


def is_paper_only(text: Column) -> Column:
    low = F.lower(clean_text(text))
    return low.contains("paper only") | low.contains("papier seulement")


def is_pdf(kind: Column) -> Column:
    return F.lower(clean_text(kind)).contains("pdf")


# Identifiers as printed in titles, and what tells their type.
FILING = r"(?i)\b(C\d{4,})(?:-(\d{1,4}))?\b"
EXHIBIT = r"(?i)\b(A(?=[0-9A-Z]{5,}\b)(?=[0-9A-Z]*\d)[0-9A-Z]{5,})\b"
REGULATORY = r"(?i)\b((?:AO|GO|GPSO|EPR|MO|RO|XG|GC|GH|OH|MH|RH|OF|OM)[A-Z0-9]*(?:-[A-Z0-9]+)+)\b"
ACTIVITY = r"(?i)\b([A-Z]{2,8}(?:-[A-Z]{2,8})*[- ]?\d{2,4}(?:-\d{1,4})+)\b"
INSTRUMENT = r"^(?:AO|GO|GPSO|EPR|MO|RO)-"
ORDERED = r"ORDER|GPSO|AO-|GO-"
FRENCH = r"(?iu)(?:^|\s|[-–—_/])(?:FR|FRENCH|FRANÇAIS)(?:\s|[-–—_/]|$)"
ENGLISH = r"(?iu)(?:^|\s|[-–—_/])(?:EN|ENGLISH|ANGLAIS)(?:\s|[-–—_/]|$)"


def title_identifiers(title: Column) -> Column:
    """struct of the identifiers a title prints: lists in order of appearance, none of them twice, and a language marker.

    A regulatory number is an instrument by its first letters, otherwise an activity; an activity
    number by the words in it; what was found as one type is not listed again as another.
    """
    t = clean_text(title)
    every = lambda rx: F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(rx), F.lit(1)), lambda x: F.upper(x)))
    number = F.upper(F.nullif(F.regexp_extract(t, FILING, 1), F.lit("")))
    sequence = F.nullif(F.regexp_extract(t, FILING, 2), F.lit(""))
    exhibits = every(EXHIBIT)
    known = F.array_compact(F.concat(F.array(number, sequence), exhibits))
    regulatory = F.array_except(every(REGULATORY), known)
    activity = F.filter(F.transform(every(ACTIVITY), lambda x: F.replace(x, F.lit(" "), F.lit("-"))), lambda x: ~x.rlike(r"^C[0-9-]*$"))
    activity = F.array_except(F.array_distinct(activity), F.concat(known, regulatory))
    first, second = lambda rx: F.filter(regulatory, lambda x: x.rlike(rx)), lambda rx: F.filter(activity, lambda x: x.rlike(rx))
    instruments = F.concat(first(INSTRUMENT), second(ORDERED))
    activities = F.concat(F.filter(regulatory, lambda x: ~x.rlike(INSTRUMENT)), F.filter(activity, lambda x: ~x.rlike(ORDERED)))
    padded = F.concat(F.lit(" "), t, F.lit(" "))
    return F.struct(
        number.alias("filing_number"), sequence.alias("filing_sequence"), exhibits.alias("exhibits"), instruments.alias("instruments"), activities.alias("activities"),
        F.when(padded.rlike(FRENCH), "fr").when(padded.rlike(ENGLISH), "en").alias("language"),
    )


# A page of results that says it has none, or how many there are.
NO_RESULTS = (
    r"(?iu)(?:no\s+(?:items?|results?|records?|documents?)\s+(?:(?:were|are)\s+)?(?:found|available)|there\s+(?:are|were)\s+no\s+(?:items?|results?|records?|documents?)|"
    r"no\s+(?:items?|results?|records?|documents?)\s+to\s+display|aucune?\s+(?:élément|résultat|document)(?:\s+n['’]a\s+été\s+trouvé)?)"
)
TOTAL = r"(?i)Item\(s\)\s*-\s*[\d,]+\s*to\s*[\d,]+\s*out of about\s*([\d,]+)"


def result_page(html: Column) -> Column:
    """struct<recognized, empty, total> of a page of results: one with rows, a total or an explicit none, not an error page served as success."""
    text = clean_text(F.regexp_replace(html, r"<[^>]*>", " "))
    total = F.replace(F.regexp_extract(html, TOTAL, 1), F.lit(","), F.lit("")).try_cast("int")
    some = clean_text(html) != ""
    none = some & text.rlike(NO_RESULTS)
    return F.struct((some & (F.lower(html).contains("<tbody") | total.isNotNull() | none)).alias("recognized"), none.alias("empty"), total.alias("total"))


def retry_delay(attempt: Column, base: float = 2.0, cap: float = 60.0, asked: Column | None = None) -> Column:
    own = F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempt - 1)))
    return own if asked is None else F.coalesce(F.least(F.lit(cap), asked), own)


# How one number token turned into another, the most consequential first.
OPERATIONS = ("comparator_change", "magnitude_shift", "decimal_shift", "exponent_change", "sign_change", "digit_substitution", "digit_insertion")


def number_parts(t: Column) -> list[Column]:
    """c, s, d: comparator, sign and the rest of a number token; v its value, null where the rest is no number."""
    c, s, d = (F.regexp_extract(t, r"^([<>]?)\s*([+-]?)(.*)$", i) for i in (1, 2, 3))
    return [c.alias("c"), s.alias("s"), d.alias("d"), F.regexp_replace(d, ",", "").try_cast("double").alias("v")]


def operation(a: Column, b: Column) -> Column:
    """How one number token, given by its parts, would change to become the other; null if in no listed way.

    Checked in this order: the comparator or the sign alone; an exponent on one side only; values a
    factor of 10, 100 or 1000 apart, whatever the characters did; the same digits with a point
    moved; one digit in the place of another; one character more.
    """
    same = a["d"] == b["d"]
    power_of = lambda x: F.lower(x["d"]).contains("e")
    high, low = F.greatest(a["v"], b["v"]), F.least(a["v"], b["v"])
    times = high / F.when(low > 0, low)
    shifted = F.lit(False)
    for k in (10, 100, 1000):
        shifted = shifted | (F.abs(times - k) < k * 0.001)
    size_a, size_b = F.length(a["d"]), F.length(b["d"])
    one = F.levenshtein(a["d"], b["d"]) == 1
    blind = lambda x: F.regexp_replace(x["d"], r"\d", "0")
    return (
        F.when((a["c"] != b["c"]) & (a["s"] == b["s"]) & same, "comparator_change").when((a["s"] != b["s"]) & (a["c"] == b["c"]) & same, "sign_change").when(power_of(a) != power_of(b), "exponent_change")
        .when(F.coalesce(shifted, F.lit(False)), "magnitude_shift").when(~same & (F.translate(a["d"], ".", "") == F.translate(b["d"], ".", "")), "decimal_shift")
        .when((size_a == size_b) & one & (blind(a) == blind(b)), "digit_substitution").when((F.abs(size_a - size_b) == 1) & one, "digit_insertion")
    )


def magnitude_cause(a: Column, b: Column) -> Column:
    """Why two values differ in magnitude: a separator read as the other, one that moved or went, a digit more or less, or neither."""
    bare = lambda x: F.translate(x["d"], ",.", "")
    swapped = (F.length(a["d"]) == F.length(b["d"])) & (F.levenshtein(a["d"], b["d"]) == 1) & (F.translate(a["d"], ",", ".") == F.translate(b["d"], ",", "."))
    return F.when(swapped, "separator_substitution").when(bare(a) == bare(b), "separator_moved").when(F.length(bare(a)) != F.length(bare(b)), "digit_added_or_lost").otherwise("value_differs")
