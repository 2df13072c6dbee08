import time

import pytest
from pyspark.sql import functions as F

from tariffmill.functions import html as H
from tariffmill.functions import lines, parse
from tariffmill.operators.tables import extract_tables, read_tables


def T():
    return F.col("t")


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p> a <b>b</b></p>", "a\nb"),
        ("<script>var a='<b>';</script>x<style>p{}</style><!-- c --> y", "x\ny"),
        ("<SCRIPT>never closed", ""),
        ("<a title='x > y'>z</a>", "z"),
        ("a < b &amp; c &lt;i&gt; &eacute;&#233;&#xE9;&nbsp;", "a < b & c <i> ééé"),
        ("&amp;lt; &unknown; &#128512;", "&lt; &unknown; 😀"),
        ("<td>l'eau<br>d'ici</td>", "l'eau\nd'ici"),
        ("<!DOCTYPE html><p>a\n  b</p>", "a\n  b"),
        ("", ""),
        (None, ""),
    ],
)
def test_text(value, page, text):
    assert value(H.html_to_text(T()), t=page) == text


def test_metadata(value):
    page = "Position tarifaire : 0101\nSOURCE ADII\nSituation du: 01/02/2026\n"
    assert value(H.extract_metadata(T()), t=page) == {"position": "0101", "source": "ADII", "date": "01/02/2026"}
    assert value(H.extract_metadata(T()), t="rien") == {}


def test_key_values(value):
    page = f"b : 1\na (note) : x\nsuite\nlong : y\nb : 2\nz : {'v' * 200}\nw : {'v' * 199}\n : vide\nfin"
    got = value(F.map_entries(H.extract_key_values(T())), t=page)
    assert [tuple(e.values()) for e in got] == [("b", "2"), ("a", "x"), ("suite\nlong", "y"), ("w", "v" * 199)]
    assert value(H.extract_key_values(T()), t="sans deux-points") == {}
    assert value(H.extract_key_values(T()), t="cle:") == {}


def test_key_values_without_colon_is_linear(value):
    assert value(H.extract_key_values(T()), t="mot " * 200_000) == {}
    assert value(H.extract_key_values(T()), t="a : b\n" + "mot " * 200_000) == {"a": "b"}


@pytest.mark.parametrize(
    ("name", "content", "kind"),
    [
        ("Droits et Taxes", "", "financial"),
        ("Historique Droit d'Importation", "", "statistics"),
        ("Accords et Convention", "", "regulatory"),
        ("Documents et Normes", "", "regulatory"),
        ("Quelconque", "", "geography"),
        ("Position tarifaire", "Droit d'importation 2,5 %, taxe", "financial"),
        ("Position tarifaire", "abc", "general_info"),
        ("Position tarifaire", "droit accord", "financial"),
    ],
)
def test_section_type(value, name, content, kind):
    assert value(H.section_type(F.col("n"), F.col("c")), n=name, c=content) == kind


def test_nav_links(value):
    page = (
        "<a href=1> Droits\n et <b>Taxes</b></a><a>Accueil</a><a></a><a>Droits et Taxes</a>"
        "<abbr>non</abbr><A>Nouvelle Recherche</A><a>Caf&eacute;</a>"
    )
    assert value(H.nav_links(T()), t=page) == ["Droits et Taxes", "Café"]


def test_scrape_status(value):
    status = H.scrape_status(F.col("e"), F.col("h"))
    assert [value(status, e=e, h=h) for e, h in (("x", None), (None, None), (None, "<p>"))] == ["error", "partial", "success"]


def test_tables():
    page = "<table><tr><th>Pays</th><th>Taux</th></tr><tr><td>UE</td><td>2,5%</td></tr><tr><td> </td><td>0%</td></tr></table>"
    assert read_tables(page) == [(["Pays", "Taux"], [{"Pays": "UE", "Taux": "0.025"}], [{"Taux": 0.025}])]
    assert read_tables("<table><tr><td>a</td></tr></table>") == []
    assert read_tables("<table><tr><td></td></tr><tr><td>a</td></tr></table>") == []
    nested = "<table><tr><td>A</td></tr><tr><td>x<table><tr><td>y</td></tr></table></td></tr></table>"
    assert read_tables(nested) == [(["A"], [{"A": "xy"}, {"A": "y"}], [{}, {}])]
    assert read_tables(None) == []


def test_tables_of_pages(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>A</td></tr><tr><td>1</td></tr></table>"), (2, "x"), (3, None)], "page_id long, html string")
    rows = extract_tables(pages).collect()
    assert [(r["page_id"], r["table_no"], r["headers"], r["rows"], r["row_count"]) for r in rows] == [(1, 0, ["A"], [{"A": "1"}], 1)]


def test_designation(value):
    def run(text, pairs=None):
        return value(
            parse.extract_designation(F.col("t"), F.col("p"), F.lit("0101210000")), t=text, p=pairs or {}
        )

    assert run("0101.21\n00\n00\n- - Reproducteurs\nU") == "Reproducteurs"
    assert run("0101.21\n99\n00\n- - Autre\n0101.21\n00\n00\n- - Deux") == "Autre"
    assert run("rien", {"DESIGNATION DU PRODUIT": "Cheval"}) == "Cheval"
    assert run("rien") == "NA"


def test_section_and_chapter(value):
    def run(fn, text="", pairs=None):
        return tuple(value(fn(F.col("t"), F.col("p")), t=text, p=pairs or {}).values())

    assert run(parse.extract_section, pairs={"SECTION": "IX-Bois"}) == ("IX", "Bois")
    assert run(parse.extract_chapter, pairs={"CHAPITRE": "01 - Animaux vivants"}) == ("01", "Animaux vivants")
    assert run(parse.extract_chapter) == ("NA", "NA")
    assert run(parse.extract_section, pairs={"SECTION": "sans"}) == ("NA", "NA")
    assert run(parse.extract_section, "x SECTION : 04 - Produits\ny") == ("04", "Produits")


def test_taxes(value):
    text = "Position tarifaire : 0101210000\n*Droit d'importation ( DI ) : 2,5 %\nTaxe 2020 ( TPI ) :\n0,25 % TVA ( TVA ) : 20"
    got = [tuple(t.values()) for t in value(parse.parse_taxes(T()), t=text)]
    assert got == [("DI", "Droit d'importation", "2,5 %"), ("TPI", "Taxe 2020", "0,25 %"), ("TVA", "TVA", "20")]
    pairs = {"Source": "x", "- Droit (DI)": "5 %", "Taxe*": "1"}
    got = sorted(tuple(t.values()) for t in value(parse.parse_taxes_kv(F.col("m")), m=pairs))
    assert got == [("DI", "Droit", "5 %"), ("NA", "Taxe", "1")]


def test_numbered_references_of_any_length(value):
    def text(t):
        return value(H.decode_entities(F.col("t")), t=t)

    assert text("a&#00000233;b &#x00000E9; &#233;") == "aéb é é"
    assert text("&colon;&lpar;x&rpar; &eacute;") == ":(x) é"
    assert text("&#0; &#xD800; &#1114112; &#99999999999999; &#x110000;") == " ".join(["\ufffd"] * 5)
    assert text("&#128; &#x80; &nothing; & &#;") == "€ € &nothing; & &#;"


def test_no_break_space_counts_as_white_space(value):
    assert value(H.section_type(F.lit(None).cast("string"), F.col("t")), t="20\u00a0%") == "financial"
    found = value(lines.parse_agreements(F.col("t")), t="Maroc\nFRANCHISE\n2,5\u00a0%\n0")
    assert [(a["country"], a["DI"], a["TPI"]) for a in found] == [("Maroc", "2,5\u00a0%", "0")]
    none = F.create_map().cast("map<string,string>")
    assert value(parse.extract_section(F.col("t"), none), t="SECTION\u00a0: 04 - x")["code"] == "04"


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a \"" * 260_000, "<a '\"x> " * 110_000, "text <!-- " * 100_000])
def test_hostile_pages_take_linear_time(value, page):
    began = time.monotonic()
    value(H.html_to_text(F.col("t")), t=page)
    value(H.nav_links(F.col("t")), t=page)
    assert time.monotonic() - began < 10


def test_open_brackets_take_linear_time(value):
    began = time.monotonic()
    assert value(H.extract_key_values(F.col("t")), t="(" * 1_000_000 + " a (b) : c") == {"(": "c"}
    assert value(H.extract_key_values(F.col("t")), t="x (n) : 1\ny ( z : 2") == {"x": "1", "y ( z": "2"}
    assert time.monotonic() - began < 10


def test_text_behind_the_last_tag(value):
    def text(t):
        return value(H.html_to_text(F.col("t")), t=t)

    assert text("a<b>c</b> 1 < 2") == "a\nc\n1 < 2"
    assert text("a<script>x > y") == "a" and text("a <!-- b > c") == "a" and text("a <!-- b") == "a" and text("plain") == "plain"
