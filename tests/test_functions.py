from __future__ import annotations

import random
import struct
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirelake.functions import links, markup, numeric, scoring, text


def test_clean_price(column):
    cases = {
        "£51.77": 51.77, "12.5 EUR": 12.5, "12,50 EUR": 1250.0, "-5": 5.0, "1.2.3": None, "Rs. 500": 0.5,
        "free": None, "  ": None, "": None, None: None, "0": 0.0, "1,234.50": 1234.5, "5.": 5.0, ".": None,
    }
    assert column(numeric.clean_price, list(cases)) == list(cases.values())


def test_clean_author(column):
    values = ["Unknown", "UNKNOWN ", "\t", "", None, " Ann Lee ", "unknown\n", "Unknown Writer"]
    assert column(text.clean_author, values) == [None, None, None, None, None, "Ann Lee", None, "Unknown Writer"]


def test_whitespace_is_what_python_strips(column):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert column(text.trim_ws, [f"{s}a{s}b{s}" for s in spaces]) == [f"a{s}b" for s in spaces]
    others = ["​", "﻿", "᠎", "\x00"]
    assert column(text.trim_ws, others) == others


COPY = "A sentence of thirty-six characters."


def test_drop_repeated_half(column):
    values = [COPY * 2, f"{COPY} {COPY}", COPY, "short short", "", None, "   ", f"  {COPY * 2}\n", "é" * 80]
    expected = [COPY, f"{COPY} {COPY}", COPY, "short short", None, None, "", COPY, "é" * 40]
    assert column(text.drop_repeated_half, values) == expected


def python_halves(value):
    if not value:
        return None
    stripped = value.strip()
    middle = len(stripped) // 2
    if middle > 30 and stripped[:20].strip() == stripped[middle : middle + 20].strip():
        return stripped[:middle].strip()
    return stripped


def test_halves_by_brute_force(column):
    rng = random.Random(3)
    values = []
    for _ in range(400):
        base = "".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 45)))
        values += [base, base * 2, base + " " + base, " " + base * 2 + rng.choice(["", " ", "x"])]
    assert column(text.drop_repeated_half, values) == [python_halves(v) for v in values]


def test_residue_test_does_not_trim(column):
    spaced = " " + "x" * 18 + " tail of the first part" + "  " + "x" * 18 + " tail of the first part"
    assert column(text.has_repeated_half, [COPY * 2, COPY, None, "", spaced]) == [True, False, False, False, False]


def test_join_lines(column):
    assert column(text.join_lines, ["a\r\n\r\nb\n", "", "\n ", None, "a b"]) == ["a b", None, "", None, "a b"]


def test_normalize_language(column):
    values = [" ENG ", "fre", "swe", "en", "pt-BR", "", None, "chi"]
    assert column(text.normalize_language, values) == ["en", "fr", "sw", "en", "pt-br", "", None, "zh"]


def test_normalize_availability(column):
    values = ["In stock (22 available)", "Out of stock", "without", "N/A", "FOR_SALE", "", None, "out, IN STOCK"]
    expected = ["available", "unavailable", "unavailable", "unknown", "unknown", "unknown", "unknown", "available"]
    assert column(text.normalize_availability, values) == expected


def test_fix_category(column):
    values = ["Add a comment", " default ", "", None, "DEFAULT", " Science ", "Add_a_comment", "Default"]
    expected = ["Unknown", "Unknown", "Unknown", "Unknown", "DEFAULT", "Science", "Unknown", "Unknown"]
    assert column(text.fix_category, values) == expected


def test_small_text_rules(column):
    assert column(text.blank_to_null, [" x ", "  ", "", None]) == ["x", None, None, None]
    assert column(text.capitalize, ["historical FICTION", "", None]) == ["Historical fiction", "", None]
    assert column(text.path_key, ["A B/C"]) == ["A_B_C"]
    assert column(lambda c: text.path_key(c, ". "), ["books.toscrape.com x"]) == ["books_toscrape_com_x"]
    assert column(text.is_blank, ["a", " \t", "", None]) == [False, True, True, True]


def test_safe_timestamp(column):
    values = [
        "2026-05-01T10:00:00.123456+00:00", "2026-05-01T10:00:00+00:00", "bad", None, "", "2026-05-01T12:00:00+02:00",
    ]
    parsed = column(lambda c: text.utc_wall_clock(text.safe_timestamp(c)).cast("string"), values)
    assert parsed == ["2026-05-01 10:00:00.123456", "2026-05-01 10:00:00", None, None, None, "2026-05-01 10:00:00"]


def test_safe_numbers(column):
    values = ["3.9", "-3.9", "x", None, "nan", "", "1e12", "3d", "0x1p3", " 7 ", "+5", "inf", "1e30"]
    expected = [3, -3, 0, 0, 0, 0, 10**12, 0, 0, 7, 5, 0, numeric.TOO_LARGE]
    assert column(lambda c: numeric.safe_int(c, from_text=True), values) == expected
    assert column(lambda c: numeric.safe_float(c, from_text=True), ["nan", "x", None, "2.675", "0.125", "3d"]) == [
        None, None, None, 2.67, 0.12, None,
    ]
    assert column(numeric.safe_float, [float("nan"), 2.5, None], "double") == [None, 2.5, None]
    assert column(lambda c: numeric.safe_text(c, "-"), ["nan", "NaT", "None", "", None, "x"]) == ["-"] * 5 + ["x"]


def bits(values):
    return [None if v is None else struct.pack("d", v) for v in values]


@pytest.mark.parametrize("digits", [1, 2])
def test_exact_rounding_equals_pythons(column, digits):
    rng = random.Random(5)
    values = [round(rng.uniform(-1000, 1000), 3) for _ in range(20000)]
    values += [rng.randint(-(10**6), 10**6) / 8 for _ in range(5000)]
    values += [rng.uniform(-1e9, 1e9) for _ in range(5000)] + [i / 200 for i in range(-4000, 4000)]
    values += [rng.choice([-1, 1]) * rng.uniform(2.0**e, 2.0 ** (e + 1)) for e in range(40, 58) for _ in range(300)]
    values += [2.0**e + d for e in range(43, 54) for d in (-0.5, -0.25, 0.0, 0.125, 0.375, 0.5, 0.625)]
    values += [0.0, -0.0, -0.001, 1e-300, 2.675, 1.005, 2.5, 0.125, 0.375, 1e15, -1e300, None]
    rounded = column(lambda c: numeric.round_exact(c, digits), values, "double")
    assert bits(rounded) == bits([None if v is None else round(v, digits) for v in values])


def test_half_even_scales_first(column):
    rng = random.Random(9)
    values = [rng.uniform(-500, 500) for _ in range(5000)] + [i / 1000 for i in range(-5000, 5000, 5)]
    assert bits(column(numeric.round_half_even, values, "double")) == bits(np.round(np.array(values), 2))


def test_half_up_rounds_the_decimal(column):
    assert column(numeric.round_half_up, [2.675, 0.125, 1.005, -0.125, None], "double") == [2.68, 0.13, 1.01, -0.13, None]


def test_score_bins(column):
    assert column(scoring.score_bin, [0, 20, 21, 40, 41, 100, 101, -1, None], "int") == [1, 1, 2, 2, 3, 5, None, None, None]


def test_quality_score(spark):
    columns = "titre string, auteur string, prix double, note_etoiles double, annee_publication int, isbn string"
    rows = [
        ("t", "a", 1.0, 1.0, 2000, "i"), ("", None, 1.0, 1.0, 2000, "i"), ("t", "a", 0.0, 0.0, 2000, ""),
        (None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, columns)
    assert [r[0] for r in df.select(scoring.quality_score()).collect()] == [100, 60, 90, 0]


def test_word_rating(column):
    values = ["star-rating Two", "", "star-rating", "star-rating  Five ", "Two star-rating", None]
    assert column(markup.word_rating, values) == [2, 0, 0, 5, 0, 0]


def test_character_references(column):
    values = [
        "a &amp;lt; b", "&pound;5", "&#163;5 &#xA3; &#x1F600;", "&unknown; &", "&#;", None, "plain", "&#0000039;&#1114109;",
        "&aacute;&Eacute;&times;&apos;", "&#1114112;&#xD800;&#0;&#99999999999999999999;",
    ]
    expected = [
        "a &lt; b", "£5", "£5 £ 😀", "&unknown; &", "&#;", None, "plain", "'\U0010fffd", "áÉ×'", "\ufffd" * 4,
    ]
    assert column(markup.decode_references, values) == expected


BASES = ["http://h.example/a/b/c.html?q=1#f", "https://h.example", "https://h.example/", "https://h.example/x/y/"]
TARGETS = [
    "d.html", "./d.html", "../d.html", "../../d.html", "../../../../d.html", "/r/s.html", "/r/../s.html", "?z=2", "#g",
    "", "//other.example/p", "https://else.example/p/../q", "mailto:a@b.example", "d/./e/../f/", "..", ".", "../",
    "d.html?x=1#y", "/", "page-2.html", "catalogue/page-2.html?a=b/../c", "/a/b/..",
]


def test_resolved_links_equal_the_standard_library(spark):
    pairs = [(b, t) for b in BASES for t in TARGETS]
    df = spark.createDataFrame([(i, b, t) for i, (b, t) in enumerate(pairs)], "i int, b string, t string")
    mine = [r[0] for r in df.orderBy("i").select(links.resolve_url(F.col("b"), F.col("t"))).collect()]
    wrong = [(p, m, urljoin(*p)) for p, m in zip(pairs, mine) if m != urljoin(*p)]
    assert wrong == []


def test_schema_widths_are_consistent():
    from quirelake.operators.warehouse import WAREHOUSE
    from quirelake.schemas import GOLD_COLUMNS

    for table, names in GOLD_COLUMNS.items():
        assert {f.name for f in WAREHOUSE[table]} == set(names)
