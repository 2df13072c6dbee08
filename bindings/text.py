"""Queries on document text and landed pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, spread_table, table
from bindings.render import joined, page
from tariffmill.functions import compose, html, lines, text
from tariffmill.operators.tables import extract_tables
from tariffmill.patterns import Rules
from tariffmill.sources.readers import src_pages

# Site words for the documents table, which has none of the real site's.
RULES = Rules(boilerplate=("the of", "of the", "de la"))
_WORD_RULES = [(r"[0-9]+", "#"), (r"([a-z]+)\.", "$1!"), (r"[,;]", "")]
_CLEAN = "nullif(trim(regexp_replace({}, '\\s+', ' ', 'g')), '')"


def _documents(spark, d, **columns):
    return spread_table(spark, d, "documents", "doc_id", "text").select("doc_id", *[c.alias(n) for n, c in columns.items()])


@query("explode_lines", """
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos, trim(line) AS line
  FROM (SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
  WHERE trim(line) <> ''""")
def explode_lines(spark, d):
    return lines.explode_lines(spread_table(spark, d, "documents", "doc_id", "text"), "text", "doc_id")


@query("unit_of_measure", """
  SELECT doc_id, CASE WHEN len(ls) = 0 THEN 'NA' WHEN length(ls[-1]) <= 5 THEN ls[-1] WHEN doc_id % 2 = 0 THEN 'KG' ELSE 'U' END AS unit
  FROM (SELECT doc_id, list_filter(list_transform(string_split(CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || ' kg ' ELSE text END, chr(10)),
    lambda x: trim(x)), lambda x: x <> '') AS ls FROM documents)""")
def unit_of_measure(spark, d):
    with_unit = F.when(F.col("doc_id") % 3 == 0, joined(F.col("text"), "\n kg ")).otherwise(F.col("text"))
    metadata = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("unit"), F.lit("KG"))).otherwise(
        F.create_map(F.lit("source"), F.lit("ADII"))
    )
    return _documents(spark, d, unit=lines.unit_of_measure(with_unit, metadata))


@query("normalize_text", f"SELECT doc_id, {_CLEAN.format('text')} AS clean FROM documents")
def normalize_text(spark, d):
    return _documents(spark, d, clean=text.normalize_text(F.col("text")))


@query("compose_unicode", """
  SELECT doc_id, nfc_normalize(replace(replace(replace(text, 'e', 'e' || chr(769)), 'o', 'o' || chr(770) || chr(803)), 'x', chr(8491))) AS composed
  FROM documents""")
def compose_unicode(spark, d):
    """Documents whose letters come apart: marks behind letters, in any order, and a sign that has another form."""
    apart = F.replace(F.replace(F.col("text"), F.lit("e"), F.lit("e\u0301")), F.lit("o"), F.lit("o\u0302\u0323"))
    return _documents(spark, d, composed=compose.compose_unicode(F.replace(apart, F.lit("x"), F.lit("\u212b"))))


@query("regex_rules", r"""
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), '([a-z]+)\.', '\1!', 'g'), '[,;]', '', 'g') AS ruled
  FROM documents""")
def regex_rules(spark, d):
    return _documents(spark, d, ruled=text.regex_rules(F.col("text"), _WORD_RULES))


@query("strip_boilerplate", "SELECT doc_id, " + _CLEAN.format(r"""
  regexp_replace(regexp_replace(regexp_replace('01/02/2026 14:37:33 ' || text, 'the of|of the|de la', '', 'gi'),
    '[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}', '', 'g'), '[*-]{3,}', '', 'g')""") + " AS clean FROM documents")
def strip_boilerplate(spark, d):
    return _documents(spark, d, clean=text.strip_boilerplate(joined("01/02/2026 14:37:33 ", F.col("text")), RULES))


@query("clean_label", "SELECT doc_id, " + _CLEAN.format(
    r"regexp_replace(regexp_replace('- - ' || text || ' :', '^[\s\-–]+', ''), '[\s:;]+$', '')") + " AS label FROM documents")
def clean_label(spark, d):
    return _documents(spark, d, label=text.clean_label(joined("- - ", F.col("text"), " :")))


@query("content_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS length FROM documents")
def content_length(spark, d):
    return _documents(spark, d, length=html.content_length(F.col("text")))


@query("parse_percentage", """
  SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size + 0.5 END AS number FROM
    (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size FROM part)""")
def parse_percentage(spark, d):
    written = F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).otherwise(joined(F.col("p_size").cast("string"), ",5 %"))
    return table(spark, d, "part").select("p_partkey", text.parse_percentage(written).alias("number"))


@query("parse_french_date", """
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders""")
def parse_french_date(spark, d):
    months = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]
    day = F.col("o_orderdate")
    worded = F.concat_ws(
        " ", F.dayofmonth(day).cast("string"), F.element_at(F.array(*map(F.lit, months)), F.month(day)), F.year(day).cast("string")
    )
    written = (
        F.when(F.col("o_orderkey") % 7 == 0, "31/02/2020")
        .when(F.col("o_orderkey") % 2 == 0, worded)
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )
    return spread_table(spark, d, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", text.parse_french_date(written).alias("date"))


@query("clean_cell", "SELECT c_custkey, c_name || ' du ' || c_mktsegment AS cell FROM customer")
def clean_cell(spark, d):
    written = joined(" ", F.col("c_name"), "\xa0 du\n", F.col("c_mktsegment"), "\n")
    return table(spark, d, "customer").select("c_custkey", text.clean_cell(written).alias("cell"))


@query("normalize_cell", """
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN (c_custkey % 100) || ',5 %' WHEN 1 THEN c_name WHEN 2 THEN c_name || '%' ELSE '' END AS text,
    CASE WHEN c_custkey % 4 = 0 THEN CAST((c_custkey % 100) || '.5' AS DOUBLE) / 100 END AS number FROM customer""")
def normalize_cell(spark, d):
    key, name = F.col("c_custkey"), F.col("c_name")
    written = (
        F.when(key % 4 == 0, joined(" ", (key % 100).cast("string"), ",5 % "))
        .when(key % 4 == 1, name)
        .when(key % 4 == 2, joined(name, "%"))
        .otherwise("  ")
    )
    return table(spark, d, "customer").select("c_custkey", text.normalize_cell(written).alias("c")).select("c_custkey", "c.*")


# --- Pages ----------------------------------------------------------------------------------------

_NO_MARKUP = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', chr(1), 'g'), "
    r"'(?is)<script\b[^>]*>.*?</script>', chr(1), 'g'), '(?is)<style\b[^>]*>.*?</style>', chr(1), 'g'), '<[^>]*>', {}, 'g')"
)
_ENTITIES = "replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
_TEXT = (
    "list_reduce(list_concat([''], list_filter(list_transform(string_split("
    + _NO_MARKUP.format("chr(1)") + ", chr(1)), lambda x: trim(" + _ENTITIES.format("x")
    + ", ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> '')), lambda a, b: CASE WHEN a = '' THEN b ELSE a || chr(10) || b END)"
)


@query("src_pages", "SELECT page_id, url, html FROM pages")
def src_pages_query(spark, d):
    return src_pages(spark, f"{d}/pages.parquet")


@query("html_to_text", f"SELECT page_id, {_TEXT} AS raw_text FROM pages")
def html_to_text(spark, d):
    return spread_table(spark, d, "pages", "page_id", "html").select("page_id", html.html_to_text(F.col("html")).alias("raw_text"))


@query("nav_links", """
  WITH anchors AS (SELECT page_id, generate_subscripts(a, 1) AS i, unnest(a) AS link
    FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a(?:\\s[^>]*)?>(.*?)</a>', 1) AS a FROM pages)),
  texts AS (SELECT page_id, i, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(link, '<[^>]*>', '', 'g'),
    '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g')) AS name FROM anchors),
  firsts AS (SELECT page_id, name, min(i) AS i FROM texts WHERE name <> '' AND NOT regexp_matches(lower(name), 'recherche|retour|accueil|home')
    GROUP BY page_id, name)
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS "order", name FROM firsts""".replace("\\\\", "\\"))
def nav_links(spark, d):
    links = html.nav_links(F.col("html"))
    return spread_table(spark, d, "pages", "page_id", "html").select("page_id", F.posexplode(links).alias("order", "name"))


_NAMES = ["Droits et Taxes", "Historique Droit d'Importation", "Accords et Convention", "Position tarifaire", "Imprimer"]


@query("section_type", r"""
  WITH scored AS (SELECT page_id, clean,
      regexp_matches(clean, '[0-9]{4}.*[0-9]{4}')::INT + contains(clean, 'importation')::INT + contains(clean, 'exportation')::INT
        + contains(clean, 'statistique')::INT AS s,
      regexp_matches(clean, '[0-9]+\.?[0-9]*\s*%')::INT + contains(clean, 'droit')::INT + contains(clean, 'taxe')::INT + contains(clean, 'tva')::INT AS f,
      contains(clean, 'pays')::INT + contains(clean, 'country')::INT + contains(clean, 'ue')::INT + contains(clean, 'agadir')::INT
        + contains(clean, 'turquie')::INT AS g,
      contains(clean, 'accord')::INT + contains(clean, 'restriction')::INT + contains(clean, 'prohibition')::INT
        + contains(clean, 'document')::INT + contains(clean, 'norme')::INT AS r
    FROM (SELECT page_id, lower(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS clean FROM pages))
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'financial' WHEN 1 THEN 'statistics' WHEN 2 THEN 'regulatory' ELSE
    CASE greatest(s, f, g, r) WHEN 0 THEN 'general_info' WHEN s THEN 'statistics' WHEN f THEN 'financial' WHEN g THEN 'geography'
      ELSE 'regulatory' END END AS section_type FROM scored""")
def section_type(spark, d):
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("page_id") % 5 + 1).cast("int"))
    return spread_table(spark, d, "pages", "page_id", "html").select("page_id", html.section_type(name, F.col("html")).alias("section_type"))


@query("scrape_status", """
  SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'error' WHEN page_id % 7 = 0 THEN 'partial' ELSE 'success' END AS scrape_status FROM pages""")
def scrape_status(spark, d):
    error = F.when(F.col("page_id") % 10 == 0, "timed out")
    main = F.when(F.col("page_id") % 7 != 0, F.col("html"))
    return spread_table(spark, d, "pages", "page_id", "html").select("page_id", html.scrape_status(error, main).alias("scrape_status"))


@query("extract_tables", """
  SELECT c_custkey, 0 AS table_no, 0 AS row_no, c_name || ' & fils' AS pays, 'x' AS taux, NULL::DOUBLE AS taux_number, 2 AS row_count FROM customer
  UNION ALL SELECT c_custkey, 0, 1, c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(CAST((c_custkey % 4) || '.5' AS DOUBLE) / 100 AS VARCHAR) END,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST((c_custkey % 4) || '.5' AS DOUBLE) / 100 END, 2 FROM customer""")
def extract_tables_query(spark, d):
    key = F.col("c_custkey")
    rate = F.when(key % 4 == 0, "").otherwise(joined((key % 4).cast("string"), ",5 %"))
    markup = joined(
        "<p>avant</p><table><tr><td>une seule ligne</td></tr></table><TABLE class='a>b'><tr><th> Pays\n</th><th>Taux</th><th></th></tr>",
        "<tr><td><b>", F.col("c_name"), "</b> &amp; fils</td><td>x<td></tr><tr><td></td><td>0%</td></tr>",
        "<tr><td>", F.col("c_mktsegment"), "<script>var a;</script></td><td>", rate, "</td><td>hors</td></tr></TABLE>",
    )
    pages = spread_table(spark, d, "customer").select("c_custkey", markup.alias("html"))
    tables = extract_tables(pages, "c_custkey", "html")
    rows = tables.select(
        "c_custkey", "table_no", "row_count", F.posexplode(F.arrays_zip("rows", "numbers")).alias("row_no", "cell")
    )
    return rows.select(
        "c_custkey", "table_no", "row_no", F.col("cell.rows")["Pays"].alias("pays"), F.col("cell.rows")["Taux"].alias("taux"),
        F.try_element_at(F.col("cell.numbers"), F.lit("Taux")).alias("taux_number"), "row_count",
    )


@query("extract_key_values", """
  SELECT p_partkey, 'Marque' AS key, p_brand AS value FROM part
  UNION ALL SELECT p_partkey, p_type, 'dernier' FROM part
  UNION ALL SELECT p_partkey, 'suite' || chr(10) || 'Nom', p_name FROM part""")
def extract_key_values(spark, d):
    col = F.col
    written = page(
        joined(col("p_type"), " ( DI ) : ", col("p_size").cast("string"), " %"),
        joined("Marque: ", col("p_brand")),
        joined(col("p_type"), " : dernier"),
        "suite",
        joined("Nom (fr:en) :  ", col("p_name")),
        joined("Long : ", F.repeat(F.lit("x"), F.lit(200))),
        "reste sans valeur",
    )
    pairs = html.extract_key_values(written)
    return spread_table(spark, d, "part").select("p_partkey", F.explode(pairs).alias("key", "value"))
