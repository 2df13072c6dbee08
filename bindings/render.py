"""Record text made from rows of the given tables.

Each row becomes one record of its own, so rendering needs no grouping and grows with the table.
The SQL beside each piece states the facts that parsing has to bring back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill import patterns as P
from tariffmill.functions.html import extract_metadata
from tariffmill.schemas import CONTENT_TYPE, RAW_SCHEMA, SECTION_TYPE

_MODULUS = 10_000_000_000
_FACTOR = 7_919_317

SQL_HS10 = f"lpad(CAST((p_partkey * {_FACTOR}) % {_MODULUS} AS VARCHAR), 10, '0')"


def hs10() -> Column:
    code = F.pmod((F.col("p_partkey") % _MODULUS) * _FACTOR, F.lit(_MODULUS))
    return F.lpad(code.cast("string"), 10, "0")


def joined(*parts: Column | str) -> Column:
    """Concatenation of columns and literal texts."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def page(*lines: Column | str) -> Column:
    """Lines joined by line breaks; NULL lines are left out."""
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


# --- Parts as tariff records ------------------------------------------------------------------

# Facts of a part record, as DuckDB sees them.
SQL_PART_FACTS = f"""
  SELECT part.*, hs10, substr(hs10,1,4) AS hs4, substr(hs10,1,6) AS hs6, substr(hs10,1,8) AS hs8,
    lpad(CAST(p_partkey % 21 + 1 AS VARCHAR), 2, '0') AS sec, 'Produits ' || p_brand AS sec_label,
    substr(hs10,1,2) AS chap, 'Chapitre des ' || p_type AS chap_label,
    p_partkey % 3 = 0 AS compact, p_partkey % 2 = 1 AS by_key,
    p_brand AS hs4_label,
    CASE WHEN p_partkey % 3 = 0 THEN 'NA' ELSE p_type END AS hs6_label,
    CASE WHEN p_partkey % 3 = 0 THEN 'NA' ELSE p_name END AS hs8_label,
    p_name || ' fini' AS designation,
    CASE WHEN p_size % 2 = 0 THEN 'KG' WHEN p_size % 4 = 1 THEN 'L' ELSE 'U' END AS unit,
    lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS doc_code
  FROM part, LATERAL (SELECT {SQL_HS10} AS hs10) code
"""


def part_facts(part: DataFrame) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return part.withColumn("hs10", hs10()).withColumns({
        "sec": F.lpad((key % 21 + 1).cast("string"), 2, "0"),
        "chap": F.substring("hs10", 1, 2),
        "compact": key % 3 == 0,
        "by_key": key % 2 == 1,
        "unit_line": F.when(size % 2 == 0, "KG").otherwise("Kilogramme net"),
        "unit_note": F.when(size % 4 == 1, "Unité L"),
        "doc_code": F.lpad((key % 100000).cast("string"), 5, "0"),
    })


def position_text() -> Column:
    col = F.col
    hs4 = joined(F.substring("hs10", 1, 2), ".", F.substring("hs10", 3, 2))
    hs6 = joined(F.substring("hs10", 1, 4), ".", F.substring("hs10", 5, 2))
    return page(
        joined("Position tarifaire : ", col("hs10")),
        "Situation du : 01/02/2026",
        "Source : ADII",
        col("unit_note"),
        F.when(~col("by_key"), joined("SECTION : ", col("sec"), " - Produits ", col("p_brand"))),
        F.when(~col("by_key"), joined("CHAPITRE : ", col("chap"), " - Chapitre des ", col("p_type"))),
        "Codification",
        hs4,
        col("p_brand"),
        hs6,
        F.when(~col("compact"), col("p_type")),
        F.substring("hs10", 7, 2),
        F.when(~col("compact"), col("p_name")),
        F.substring("hs10", 9, 2),
        joined("- - ", col("p_name"), " fini"),
        col("unit_line"),
    )


def position_pairs() -> Column:
    """Section and chapter as key-values, for every second part."""
    col = F.col
    empty = F.create_map().cast("map<string,string>")
    return F.when(
        col("by_key"),
        F.create_map(
            F.lit("SECTION"), joined(col("sec"), " - Produits ", col("p_brand")),
            F.lit("CHAPITRE"), joined(col("chap"), "-Chapitre des ", col("p_type")),
        ),
    ).otherwise(empty)


def tax_text() -> Column:
    """Three taxes as text; every second part has none."""
    col = F.col
    text = page(
        joined("Position tarifaire : ", col("hs10")),
        joined("*", col("p_type"), " ( DI ) : ", col("p_size").cast("string"), " %"),
        joined("Taxe ", col("p_brand"), " ( TPI ) : 0,25 %"),
        "Taxe sur la valeur ( TVA ) : 20",
    )
    return F.when(~col("by_key"), text).otherwise("")


def tax_pairs() -> Column:
    col = F.col
    return F.create_map(
        F.lit("Position tarifaire"), col("hs10"),
        col("p_type"), joined(col("p_size").cast("string"), " %"),
        joined("- Taxe ", col("p_brand"), " (TPI)"), F.lit("0,25 %"),
    )


SQL_TAXES = """
  SELECT p_partkey, hs10, 0 AS pos, 'DI' AS code, p_type AS label, CAST(p_size AS VARCHAR) || ' %' AS raw FROM facts WHERE NOT by_key
  UNION ALL SELECT p_partkey, hs10, 1, 'TPI', 'Taxe ' || p_brand, '0,25 %' FROM facts WHERE NOT by_key
  UNION ALL SELECT p_partkey, hs10, 2, 'TVA', 'Taxe sur la valeur', '20' FROM facts WHERE NOT by_key
"""
SQL_TAXES_KV = """
  SELECT p_partkey, hs10, 0 AS pos, 'NA' AS code, p_type AS label, CAST(p_size AS VARCHAR) || ' %' AS raw FROM facts
  UNION ALL SELECT p_partkey, hs10, 1, 'TPI', 'Taxe ' || p_brand, '0,25 %' FROM facts
"""


def record_documents_text() -> Column:
    col = F.col
    return page(
        "DOCUMENTS EXIGES", "AD", col("doc_code"), joined("Certificat ", col("p_type")), joined("ORG ", col("p_brand")),
        col("doc_code"), joined("Certificat ", col("p_type")), joined("ORG ", col("p_brand")),
    )


RECORD_AGREEMENTS = "Accords\nListe\nÉmirats\nLISTE A\n2,5 %\n0\n(*) Taux du Régime du Droit Commun"


def record_history_text() -> Column:
    """A valid date, and for every fifth part one that no calendar has."""
    rate = joined(F.col("p_size").cast("string"), " %")
    return page("Titre", "15/01/2020", "x", rate, F.when(F.col("p_partkey") % 5 == 0, "31/02/2020"))


def content(text: Column, pairs: Column | None = None, metadata: Column | None = None) -> Column:
    empty = F.create_map().cast("map<string,string>")
    return F.struct(
        text.alias("raw_text"),
        (empty if metadata is None else metadata).alias("metadata"),
        (empty if pairs is None else pairs).alias("key_values"),
        F.array().cast(CONTENT_TYPE["tables"].dataType).alias("tables"),
        F.length(text).alias("length"),
    ).cast(CONTENT_TYPE)


def raw_records(part: DataFrame) -> DataFrame:
    """Parts as raw records with five sections, one of them named twice."""
    text = position_text()
    sections = [
        (P.SECTION_DOCUMENTS, "regulatory", content(F.lit("99999\nAncien\nANCIEN"))),
        (P.SECTION_POSITION, "general_info", content(text, position_pairs(), extract_metadata(text))),
        (P.SECTION_TAXES, "financial", content(tax_text(), tax_pairs())),
        (P.SECTION_DOCUMENTS, "regulatory", content(record_documents_text())),
        (P.SECTION_AGREEMENTS, "regulatory", content(F.lit(RECORD_AGREEMENTS))),
        (P.SECTION_HISTORY, "statistics", content(record_history_text())),
    ]
    stamp = "2026-01-31T22:43:39.621994"
    facts = part_facts(part)
    return facts.select(
        F.col("hs10").alias("hs_code"),
        F.lit(stamp).alias("scraped_at"),
        F.when(F.col("p_partkey") % 10 == 0, "partial").when(F.col("p_partkey") % 10 != 1, "success").alias("scrape_status"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast(CONTENT_TYPE).alias("main_content"),
        F.array(*[
            F.struct(
                F.lit(name).alias("section_name"),
                F.lit(kind).alias("section_type"),
                body.alias("content"),
                F.lit(i).alias("order"),
                F.lit(stamp).alias("scraped_at"),
            ).cast(SECTION_TYPE)
            for i, (name, kind, body) in enumerate(sections)
        ]).alias("sections"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("error"),
    ).select(*RAW_SCHEMA.fieldNames())


def landed_pages(part: DataFrame) -> DataFrame:
    """Parts as landed HTML pages: a main page and one page per section, or a single failed visit."""
    key = F.col("p_partkey") % 10
    failed = key == 1

    def markup(text: Column | str) -> Column:
        lines = F.replace(F.lit(text) if isinstance(text, str) else text, F.lit("\n"), F.lit("</p>\n<p>"))
        return joined("<html><script>x()</script><body><p>", lines, "</p></body></html>")

    texts = {
        P.SECTION_POSITION: position_text(),
        P.SECTION_TAXES: tax_text(),
        P.SECTION_DOCUMENTS: record_documents_text(),
        P.SECTION_AGREEMENTS: F.lit(RECORD_AGREEMENTS),
        P.SECTION_HISTORY: record_history_text(),
    }
    pages = [("main", None, -1, F.when(key > 1, markup("Accueil")))]
    pages += [("section", name, i, F.when(~failed, markup(text))) for i, (name, text) in enumerate(texts.items())]
    exploded = part_facts(part).select(
        F.col("hs10").alias("hs_code"),
        F.lit("2026-01-31T22:43:39").alias("scraped_at"),
        F.when(failed, "timed out").alias("error"),
        F.inline(F.array(*[
            F.struct(
                F.lit(kind).alias("kind"), F.lit(name).cast("string").alias("section_name"), F.lit(i).alias("order"), html.alias("html")
            )
            for kind, name, i, html in pages
        ])),
    )
    return exploded


# Item lists of a part record as text, and the text that its hash covers.
SQL_PART_ITEMS = f"""
  SELECT facts.*,
    CASE WHEN by_key THEN 'NA|' || p_type || '|' || p_size || ' %;TPI|Taxe ' || p_brand || '|0,25 %'
      ELSE 'DI|' || p_type || '|' || p_size || ' %;TPI|Taxe ' || p_brand || '|0,25 %;TVA|Taxe sur la valeur|20' END AS taxes,
    doc_code || '|Certificat ' || p_type || '|ORG ' || p_brand AS docs,
    'Émirats|LISTE A|2,5 %|0' AS agreements,
    '2020-01-15|Taux: ' || p_size || ' %' || CASE WHEN p_partkey % 5 = 0 THEN ';NULL|Taux: ' ELSE '' END AS history,
    CASE WHEN p_partkey % 10 = 0 THEN 'partial' ELSE 'success' END AS status,
    '{{"agreements": [{{"DI": "2,5 %", "TPI": "0", "country": "\\u00c9mirats", "list": "LISTE A", "raw": "\\u00c9mirats"}}], '
      || '"designation": "' || designation || '", "documents": [{{"code": "' || doc_code || '", "issuer": "ORG ' || p_brand
      || '", "name": "Certificat ' || p_type || '", "raw": "' || doc_code || '"}}], "history": [{{"date": "2020-01-15", "raw": "Taux: '
      || p_size || ' %"}}' || CASE WHEN p_partkey % 5 = 0 THEN ', {{"date": null, "raw": "Taux: "}}' ELSE '' END
      || '], "taxation": [' ||
      CASE WHEN by_key THEN '{{"code": "NA", "label": "' || p_type || '", "raw": "' || p_size || ' %"}}, {{"code": "TPI", "label": "Taxe '
        || p_brand || '", "raw": "0,25 %"}}'
      ELSE '{{"code": "DI", "label": "' || p_type || '", "raw": "' || p_size || ' %"}}, {{"code": "TPI", "label": "Taxe ' || p_brand
        || '", "raw": "0,25 %"}}, {{"code": "TVA", "label": "Taxe sur la valeur", "raw": "20"}}' END
      || ']}}' AS payload
  FROM facts
"""


# --- Sections on their own ----------------------------------------------------------------------


def line_documents_text() -> Column:
    """Documents of a lineitem row: two documents, a repeat, and one with another issuer."""
    col = F.col
    first = F.lpad((col("l_partkey") % 100000).cast("string"), 5, "0")
    second = F.lpad((col("l_suppkey") % 1000).cast("string"), 3, "0")
    name = joined("Certificat ", col("l_returnflag"))
    return page(
        "DOCUMENTS EXIGES", "Texte", "AD", first, name, joined("ORG ", col("l_linestatus")), "suite",
        second, joined("  Licence ", col("l_linestatus"), " "), "", first, name, joined("ORG ", col("l_linestatus")),
        first, name, "ORG X",
    )


SQL_LINE_DOCUMENTS = """
  SELECT l_orderkey, l_linenumber, pos, code, name, issuer FROM (
    SELECT *, lpad(CAST(l_partkey % 100000 AS VARCHAR), 5, '0') AS one, lpad(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') AS two
    FROM lineitem) l,
  LATERAL (
    SELECT 0 AS pos, one AS code, 'Certificat ' || l_returnflag AS name, 'ORG ' || l_linestatus AS issuer
    UNION ALL SELECT 1, two, 'Licence ' || l_linestatus, 'NA'
    UNION ALL SELECT 2, one, 'Certificat ' || l_returnflag, 'ORG X') items
"""


def agreements_text() -> Column:
    """Agreements of a customer row, with every kind of noise line."""
    col = F.col
    key = col("c_custkey")
    return page(
        "Accords", "Liste", "DI", "TPI", "Position tarifaire : 1", "x", col("c_name"),
        joined("LISTE ", (key % 5).cast("string")), F.when(key % 2 == 0, "ANNEXE 1"),
        joined((key % 40).cast("string"), " %"), "0,25", "9", "UE", "FRANCHISE", "0", "01/02/2026 14:37:33",
        "(*) Taux du Régime du Droit Commun", "(*)",
    )


SQL_AGREEMENTS = """
  SELECT c_custkey, 0 AS pos, c_name AS country,
    'LISTE ' || (c_custkey % 5) || CASE WHEN c_custkey % 2 = 0 THEN ' ANNEXE 1' ELSE '' END AS liste,
    (c_custkey % 40) || ' %' AS di, '0,25' AS tpi FROM customer
  UNION ALL SELECT c_custkey, 1, 'UE', 'FRANCHISE', '0', 'NA' FROM customer
"""


def history_text() -> Column:
    col = F.col
    later = F.date_add(col("o_orderdate").cast("date"), 30)
    return page(
        "Titre", F.date_format("o_orderdate", "dd/MM/yyyy"), "x", joined((col("o_orderkey") % 40).cast("string"), " %"),
        F.date_format(later, "dd/MM/yyyy"),
    )


SQL_HISTORY = """
  SELECT o_orderkey, 0 AS pos, strftime(o_orderdate, '%Y-%m-%d') AS date, 'Taux: ' || (o_orderkey % 40) || ' %' AS raw FROM orders
  UNION ALL SELECT o_orderkey, 1, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d'), 'Taux: ' FROM orders
"""
