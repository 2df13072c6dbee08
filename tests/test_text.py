import random
import time
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tariffmill.functions import compose
from tariffmill.functions import text as X
from tariffmill.patterns import Rules

def T():
    return F.col("t")


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("a\xa0b", "a b"),
        ("  a \n\t b ", "a b"),
        (" \n ", None),
        ("", None),
        (None, None),
        ("FranÃ§ais Ã\xa0 l’Ã©tÃ©", "Français à l'été"),
        ("NÂ° 5", "N° 5"),
        ("lâ€™eau â€“ fin", "l'eau – fin"),
        ("Âge d'or", "Âge d'or"),
        ("ﬁn ＡＢ", "fin AB"),
        ("e\u0301te\u0301", "été"),
    ],
)
def test_normalize(value, raw, clean):
    assert value(X.normalize_text(T()), t=raw) == clean


def test_boilerplate(value):
    rules = Rules(boilerplate=("Nouvelle recherche", "a.b"))
    got = value(X.strip_boilerplate(T(), rules), t="NOUVELLE RECHERCHE x 01/02/2026 14:37:33 a.b axb *** -- ----")
    assert got == "x axb --"
    assert value(X.strip_boilerplate(T(), Rules(boilerplate=())), t="***") is None


def test_label(value):
    assert value(X.clean_label(T()), t=" - - Chevaux :") == "Chevaux"


@pytest.mark.parametrize(
    ("raw", "number"),
    [("2,5 %", 2.5), ("2.5", 2.5), ("1\u202f234,5", 1234.5), ("abc", None), ("1.234,5", None), ("", None), (None, None)],
)
def test_percentage(value, raw, number):
    assert value(X.parse_percentage(T()), t=raw) == number


@pytest.mark.parametrize(
    ("raw", "iso"),
    [
        ("01/02/2026", "2026-02-01"),
        ("1 janvier 2026", "2026-01-01"),
        ("1er août 2025", "2025-08-01"),
        ("31/02/2026", None),
        ("abc", None),
        ("2026-03-04", "2026-03-04"),
        ("5 brumaire 2026", None),
    ],
)
def test_french_date(value, raw, iso):
    assert value(X.parse_french_date(T()), t=raw) == iso


@pytest.mark.parametrize(("raw", "padded"), [("1", "01"), ("NA", "NA"), ("123", "123"), ("", "00")])
def test_zfill(value, raw, padded):
    assert value(X.zfill_code(T()), t=raw) == padded


@pytest.mark.parametrize(
    ("raw", "text", "number"),
    [("12,5 %", "12,5 %", 0.125), ("abc%", "abc%", None), ("1.234,5%", "1.234,5%", None), ("  ", "", None)],
)
def test_cell(value, raw, text, number):
    assert value(X.normalize_cell(T()), t=raw) == {"text": text, "number": number}


def test_whitespace_like_python(spark):
    @settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text(alphabet="ab \t\n\xa0\u3000\x1c\u2028", max_size=12), min_size=1, max_size=20))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [tuple(r) for r in df.select(X.strip(T()), X.collapse_whitespace(T())).collect()]
        assert got == [(t.strip(), " ".join(t.split())) for t in texts]

    check()


def _composed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.c for r in df.select("i", compose.compose_unicode(T()).alias("c")).sort("i").collect()]


def test_composition_of_latin_letters_and_marks(spark):
    letters = [chr(i) for i in [*range(0x41, 0x250), *range(0x1E00, 0x1F00)] if chr(i).isalpha()]
    texts = ["x".join(b + chr(m) for m in range(0x300, 0x370)) for b in letters]
    assert _composed(spark, texts) == [unicodedata.normalize("NFC", t) for t in texts]


def test_composition_like_python(spark):
    rng = random.Random(3)
    odd = [chr(i) for i in range(0x300, 0x30000) if not unicodedata.is_normalized("NFC", chr(i))]
    marks = [chr(i) for i in range(0x300, 0x20000) if unicodedata.category(chr(i)) in ("Mn", "Mc")]
    whole = [chr(i) for i in range(0xC0, 0x12000) if unicodedata.decomposition(chr(i))]
    korean = [chr(i) for i in [*range(0x1100, 0x1113), *range(0x1161, 0x1176), *range(0x11A7, 0x11C4), 0xAC00, 0xAC01]]
    kinds = [odd, marks, whole, korean, list("ae\n "), ["\U0001f600"]]
    texts = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    texts += ["".join(rng.choice(korean) for _ in range(12)) for _ in range(2000)] + odd + whole
    texts += [unicodedata.normalize("NFD", t) for t in whole]
    assert _composed(spark, texts) == [unicodedata.normalize("NFC", t) for t in texts]
    assert _composed(spark, [None, "", "plain"]) == [None, "", "plain"]


@pytest.mark.parametrize("text", ["e" + "\u0301" * 500_000, "e\u0301" * 100_000, "\u09be" * 300_000, "\u4e00" * 300_000])
def test_composition_is_linear(spark, text):
    began = time.monotonic()
    assert _composed(spark, [text]) == [unicodedata.normalize("NFC", text)]
    assert time.monotonic() - began < 15


def test_composition_of_few_and_of_very_many_different_clusters(spark):
    syllables = [unicodedata.normalize("NFD", chr(0xAC00 + 28 * i)) for i in range(0, 390)]
    latin = [b + chr(m) for b in "aeiou" for m in range(0x300, 0x314)]
    many = " x".join(syllables + latin + [s + "\u11a8" for s in syllables] + [s + "\u11ab" for s in syllables]) * 3
    texts = [many, " x".join(latin) * 50, "".join(syllables[:5]) * 200, ("mot e\u0301te\u0301 o\u0302\u0323 " * 50).strip()]
    assert _composed(spark, texts) == [unicodedata.normalize("NFC", t) for t in texts]


def test_composition_forms_each_cluster_of_a_text_once(spark):
    text = " ".join("a" + "\u0301\u0323\u0300"[: 1 + i % 3] + "o\u0302" for i in range(400_000))
    began = time.monotonic()
    assert _composed(spark, [text]) == [unicodedata.normalize("NFC", text)]
    assert time.monotonic() - began < 25
