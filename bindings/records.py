"""Queries that render records, parse them, and bring the facts back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bindings import render as R
from bindings.registry import query, spread_table, table
from tariffmill.functions import html, lines, parse
from tariffmill.functions.jsontext import json_text, spaced_json_text
from tariffmill.operators import flatten, report
from tariffmill.plans import product as PR
from tariffmill.plans import records as RC
from tariffmill.session import shared_dir
from tariffmill.sources import readers, sinks

AS_OF = datetime(2026, 2, 1)
_FACTS = f"WITH facts AS ({R.SQL_PART_FACTS})"


def _part(spark, d):
    """Part facts with the rendered position text and key-values."""
    return R.part_facts(spread_table(spark, d, "part")).withColumn("text", R.position_text()).withColumn("pairs", R.position_pairs())


def _raw(spark, d):
    return R.raw_records(spread_table(spark, d, "part"))


def _products(spark, d):
    return PR.assemble_product(_raw(spark, d), F.lit(AS_OF).cast("timestamp_ntz"))


# --- Line parsers ---------------------------------------------------------------------------------


def _line_items(spark, d):
    docs = lines.parse_documents(R.line_documents_text())
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    return spread_table(spark, d, "lineitem", *columns).select("l_orderkey", "l_linenumber", F.posexplode(docs).alias("pos", "item"))


@query("parse_documents", R.SQL_LINE_DOCUMENTS)
def parse_documents(spark, d):
    return _line_items(spark, d).select("l_orderkey", "l_linenumber", "pos", "item.code", "item.name", "item.issuer")


@query("dedupe_items", """
  SELECT l_orderkey, l_returnflag, l_linestatus, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1, 2, 3""")
def dedupe_items(spark, d):
    kept = flatten.dedupe_items(
        table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus"], ["l_linenumber"]
    )
    return kept.select("l_orderkey", "l_returnflag", "l_linestatus", F.col("first.l_linenumber").alias("first_line"))


def _agreements(spark, d):
    return spread_table(spark, d, "customer").withColumn("text", R.agreements_text())


@query("parse_agreements", R.SQL_AGREEMENTS)
def parse_agreements(spark, d):
    found = lines.parse_agreements(F.col("text"))
    return _agreements(spark, d).select("c_custkey", F.posexplode(found).alias("pos", "a")).select(
        "c_custkey", "pos", "a.country", F.col("a.list").alias("liste"), F.col("a.DI").alias("di"), F.col("a.TPI").alias("tpi")
    )


_AGREEMENT_LINES = """
  SELECT c_custkey, unnest(['Accords', 'Liste', 'DI', 'TPI', 'Position tarifaire : 1', 'x', c_name, 'LISTE ' || (c_custkey % 5),
    CASE WHEN c_custkey % 2 = 0 THEN 'ANNEXE 1' END, (c_custkey % 40) || ' %', '0,25', '9', 'UE', 'FRANCHISE', '0',
    '01/02/2026 14:37:33', '(*) Taux du Régime du Droit Commun', '(*)']) AS line FROM customer
"""


@query("classify_agreement_line", f"""
  SELECT c_custkey, line, CASE WHEN regexp_matches(line, '^[0-9.,]+(\\s*%)?$') OR line = '(*)' THEN 'rate'
    WHEN regexp_matches(line, 'FRANCHISE|ANNEXE|^LISTE') OR line = 'Liste' THEN 'regime' ELSE 'country' END AS kind
  FROM ({_AGREEMENT_LINES}) WHERE line IS NOT NULL""")
def classify_agreement_line(spark, d):
    split = lines.explode_lines(_agreements(spark, d), "text", "c_custkey")
    return split.select("c_custkey", "line", lines.classify_agreement_line(F.col("line")).alias("kind"))


@query("filter_agreement_noise", f"""
  SELECT c_custkey, line FROM ({_AGREEMENT_LINES}) WHERE line NOT IN ('Accords', 'Liste', 'DI', 'TPI', 'Position tarifaire : 1', 'x',
    '01/02/2026 14:37:33', '(*) Taux du Régime du Droit Commun', '(*)')""")
def filter_agreement_noise(spark, d):
    kept = lines.agreement_lines(F.col("text"))
    return _agreements(spark, d).select("c_custkey", F.explode(lines.text_lines(kept)).alias("line"))


@query("parse_history", R.SQL_HISTORY)
def parse_history(spark, d):
    found = lines.parse_history(R.history_text())
    return spread_table(spark, d, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", F.posexplode(found).alias("pos", "h")).select(
        "o_orderkey", "pos", "h.date", "h.raw"
    )


@query("parse_hierarchy_labels", f"""{_FACTS}
  SELECT hs10, hs4_label, hs6_label, hs8_label, designation AS hs10_label FROM facts""")
def parse_hierarchy_labels(spark, d):
    labels = lines.hierarchy_labels(F.col("text"), F.col("hs10"), F.lit("NA"))
    return _part(spark, d).select("hs10", labels.alias("l")).select("hs10", "l.*")


# --- Sections, chapters, designations, taxes ------------------------------------------------------


@query("extract_section", f"{_FACTS} SELECT hs10, sec AS code, sec_label AS label FROM facts")
def extract_section(spark, d):
    found = parse.extract_section(F.col("text"), F.col("pairs"))
    return _part(spark, d).select("hs10", found.alias("s")).select("hs10", "s.code", "s.label")


@query("extract_chapter", f"{_FACTS} SELECT hs10, chap AS code, chap_label AS label FROM facts")
def extract_chapter(spark, d):
    found = parse.extract_chapter(F.col("text"), F.col("pairs"))
    return _part(spark, d).select("hs10", found.alias("s")).select("hs10", "s.code", "s.label")


@query("extract_designation", f"""{_FACTS}
  SELECT hs10, CASE WHEN p_partkey % 11 = 0 THEN p_name WHEN p_partkey % 11 = 1 THEN 'NA' ELSE designation END AS designation FROM facts""")
def extract_designation(spark, d):
    key = F.col("p_partkey") % 11
    pairs = F.create_map(F.when(key == 0, "DESIGNATION DU PRODUIT").otherwise("AUTRE"), F.col("p_name"))
    text = F.when(key > 1, F.col("text")).otherwise("rien")
    return _part(spark, d).select("hs10", parse.extract_designation(text, pairs, F.col("hs10")).alias("designation"))


@query("final_designation", f"""{_FACTS}
  SELECT hs10, CASE WHEN p_partkey % 2 = 0 THEN hs8_label ELSE p_name END AS final FROM
    (SELECT * REPLACE (CASE WHEN hs8_label = 'NA' THEN p_name ELSE hs8_label END AS hs8_label) FROM facts)""")
def final_designation(spark, d):
    hs10_label = F.when((F.col("p_partkey") % 2 == 0) & ~F.col("compact"), F.col("p_name")).otherwise("NA")
    return _part(spark, d).select("hs10", lines.final_designation(hs10_label, F.col("p_name")).alias("final"))


@query("parse_taxes", f"{_FACTS} SELECT hs10, pos, code, label, raw FROM ({R.SQL_TAXES})")
def parse_taxes(spark, d):
    found = parse.parse_taxes(R.tax_text())
    return _part(spark, d).select("hs10", F.posexplode(found).alias("pos", "t")).select("hs10", "pos", "t.code", "t.label", "t.raw")


@query("parse_taxes_kv", f"{_FACTS} SELECT hs10, pos, code, label, raw FROM ({R.SQL_TAXES_KV})")
def parse_taxes_kv(spark, d):
    found = parse.parse_taxes_kv(R.tax_pairs())
    return _part(spark, d).select("hs10", F.posexplode(found).alias("pos", "t")).select(
        "hs10", "pos", "t.code", "t.label", "t.raw"
    )


@query("extract_metadata", f"""{_FACTS}
  SELECT hs10, hs10 AS position, 'ADII' AS source, '01/02/2026' AS date, CASE WHEN p_size % 4 = 1 THEN 'L' END AS unit FROM facts""")
def extract_metadata(spark, d):
    found = _part(spark, d).select("hs10", html.extract_metadata(F.col("text")).alias("m"))
    return found.select("hs10", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("position", "source", "date", "unit")])


# --- Products -------------------------------------------------------------------------------------


def _item_text(items, *fields):
    """Items as text: fields joined by '|', items by ';'."""
    return F.array_join(
        F.transform(items, lambda x: F.concat_ws("|", *[F.coalesce(x[f], F.lit("NULL")) for f in fields])), ";"
    )


@query("assemble_product", f"""{_FACTS}
  SELECT hs10 AS hs_code, sec_label AS section_label, chap_label AS chapter_label, hs4_label, hs6_label, hs8_label, designation,
    unit AS unit_of_measure, sec AS section_code, chap AS chapter_code, hs8_label <> 'NA' AS hs8_present,
    taxes, docs, agreements, history, status FROM ({R.SQL_PART_ITEMS})""")
def assemble_product(spark, d):
    return _products(spark, d).select(
        "hs_code", "section_label", "chapter_label", "hs4_label", "hs6_label", "hs8_label", "designation", "unit_of_measure",
        "hierarchy.section_code", "hierarchy.chapter_code", F.col("hierarchy.hs8.present").alias("hs8_present"),
        _item_text(F.col("taxation.taxes"), "code", "label", "raw").alias("taxes"),
        _item_text(F.col("documents.documents"), "code", "name", "issuer").alias("docs"),
        _item_text(F.col("accord_convention.accord_convention"), "country", "list", "DI", "TPI").alias("agreements"),
        _item_text(F.col("historique.items"), "date", "raw").alias("history"),
        F.col("lineage.status").alias("status"),
    )


@query("build_lineage", f"""{_FACTS}
  SELECT hs10 AS hs_code, '{{"scraped_at": "2026-01-31T22:43:39.621994", "status": "' || status || '", "url": null, "http": {{"status_code": 200, "etag": null, "last_modified": null}}, "pipeline": {{"scraper": "selenium-scraper", "parser_version": "v1.4", "schema_version": "v1.0"}}, "quality": {{"encoding_fixed": true, "missing_sections": [], "warnings": []}}, "sources": ["ADII"], "errors": []}}' AS lineage,
    '{{"source": "ADII", "scraped_at": "2026-01-31T22:43:39.621994", "parser_version": "v1.4", "lang": "fr"}}' AS meta FROM ({R.SQL_PART_ITEMS})""")
def build_lineage(spark, d):
    raw = _raw(spark, d)
    return raw.select(
        "hs_code",
        spaced_json_text(PR.lineage_struct(F.col("scraped_at"), F.col("scrape_status"), F.col("url"))).alias("lineage"),
        spaced_json_text(PR.meta_struct(F.col("scraped_at"))).alias("meta"),
    )


@query("scraped_at_default", """
  SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '2026-01-31T22:43:39' ELSE '2026-02-01T00:00:00.000000Z' END AS scraped_at FROM customer""")
def scraped_at_default(spark, d):
    given = F.when(F.col("c_custkey") % 2 == 0, "2026-01-31T22:43:39").when(F.col("c_custkey") % 3 == 0, "")
    stamp = PR.scraped_at_or(given, F.lit(AS_OF).cast("timestamp_ntz"))
    return table(spark, d, "customer").select("c_custkey", stamp.alias("scraped_at"))


@query("canonical_hash", f"{_FACTS} SELECT hs10 AS hs_code, sha256(payload) AS canonical_hash FROM ({R.SQL_PART_ITEMS})")
def canonical_hash(spark, d):
    return _products(spark, d).select("hs_code", "canonical_hash")


@query("canonical_text", f"{_FACTS} SELECT hs10 AS hs_code, 'Designation: ' || designation || chr(10) AS canonical_text FROM facts")
def canonical_text(spark, d):
    return _products(spark, d).select("hs_code", "canonical_text")


@query("section_map", f"""{_FACTS}
  SELECT hs10 AS hs_code, 'Documents et Normes' AS name, 'DOCUMENTS EXIGES' AS first_line FROM facts
  UNION ALL SELECT hs10, 'Position tarifaire', 'Position tarifaire : ' || hs10 FROM facts
  UNION ALL SELECT hs10, 'Droits et Taxes', CASE WHEN by_key THEN '' ELSE 'Position tarifaire : ' || hs10 END FROM facts
  UNION ALL SELECT hs10, 'Accords et Convention', 'Accords' FROM facts
  UNION ALL SELECT hs10, 'Historique Droit d''Importation', 'Titre' FROM facts""")
def section_map(spark, d):
    named = _raw(spark, d).select("hs_code", F.explode(PR.section_map(F.col("sections"))).alias("name", "content"))
    return named.select("hs_code", "name", F.split("content.raw_text", "\n")[0].alias("first_line"))


@query("order_sections", f"""{_FACTS}
  SELECT hs10 AS hs_code, 'Documents et Normes;Position tarifaire;Droits et Taxes;Documents et Normes;Accords et Convention;Historique Droit d''Importation' AS names FROM facts""")
def order_sections(spark, d):
    shuffled = _raw(spark, d).withColumn("sections", F.reverse("sections"))
    ordered = PR.order_sections(F.col("sections"))
    return shuffled.select("hs_code", F.array_join(F.transform(ordered, lambda s: s["section_name"]), ";").alias("names"))


@query("validate_product", f"""{_FACTS}
  SELECT hs10 AS hs_code, CASE WHEN p_partkey % 5 = 0 THEN 'historique.items.date: missing' ELSE '' END AS warnings FROM facts""")
def validate_product(spark, d):
    checked = PR.validate_product(_products(spark, d))
    return checked.select("hs_code", F.array_join("warnings", ";").alias("warnings"))


@query("json_columns", """
  SELECT p_partkey, '{"name":"' || p_name || '","tags":["' || p_brand || '","É"],"size":' || p_size || ',"none":null}' AS js, p_brand AS first_tag FROM part""")
def json_columns(spark, d):
    value = F.struct(
        F.col("p_name").alias("name"), F.array("p_brand", F.lit("É")).alias("tags"), F.col("p_size").alias("size"),
        F.lit(None).cast("string").alias("none"),
    )
    texts = table(spark, d, "part").select("p_partkey", json_text(value).alias("js"))
    return texts.withColumn("first_tag", F.variant_get(F.parse_json("js"), "$.tags[0]", "string"))


RECORDS_SQL = f"""{_FACTS}
  SELECT hs10 AS hs_code, CASE p_partkey % 10 WHEN 0 THEN 'partial' WHEN 1 THEN 'error' ELSE 'success' END AS scrape_status,
    CASE WHEN p_partkey % 10 = 1 THEN 0 ELSE 5 END AS n_sections,
    CASE WHEN p_partkey % 10 = 1 THEN 'NA' ELSE designation END AS designation,
    CASE WHEN p_partkey % 10 = 1 THEN 'NA' ELSE unit END AS unit_of_measure,
    CASE WHEN p_partkey % 10 = 1 OR by_key THEN 'NA' ELSE sec END AS section_code,
    CASE WHEN p_partkey % 10 = 1 OR by_key THEN 0 ELSE 3 END AS n_taxes,
    CASE WHEN p_partkey % 10 = 1 THEN NULL ELSE doc_code END AS document,
    CASE WHEN p_partkey % 10 = 1 THEN NULL ELSE 'Émirats' END AS country FROM facts"""


def parsed_records(records):
    """What is compared of records that were put together from pages."""
    products = PR.assemble_product(records, F.lit(AS_OF).cast("timestamp_ntz"))
    n_sections = F.coalesce(F.size(F.from_json("raw", "sections array<struct<order int>>")["sections"]), F.lit(0))
    return products.select(
        "hs_code", F.col("lineage.status").alias("scrape_status"), n_sections.alias("n_sections"), "designation",
        "unit_of_measure", "hierarchy.section_code", F.size("taxation.taxes").alias("n_taxes"),
        F.get("documents.documents", F.lit(0))["code"].alias("document"),
        F.get("accord_convention.accord_convention", F.lit(0))["country"].alias("country"),
    )


@query("records_from_pages", RECORDS_SQL)
def records_from_pages(spark, d):
    """Parts landed as one HTML page per section, put together again and parsed."""
    return parsed_records(RC.records_from_pages(R.landed_pages(spread_table(spark, d, "part"))))


# --- Flattened items ------------------------------------------------------------------------------


def _tables(spark, d):
    """Products with the column names of the products table."""
    return _products(spark, d).select(
        F.col("hs_code").alias("hs10"), "taxation", "documents", F.col("accord_convention").alias("agreements"),
        F.col("historique").alias("import_duty_history"),
    )


@query("flatten_taxation", f"""{_FACTS}
  SELECT hs10, pos, code, label, raw FROM ({R.SQL_TAXES} UNION ALL
    SELECT * FROM ({R.SQL_TAXES_KV}) WHERE p_partkey IN (SELECT p_partkey FROM facts WHERE by_key))""")
def flatten_taxation(spark, d):
    return flatten.flatten_taxation(_tables(spark, d))


@query("flatten_documents", f"""{_FACTS}
  SELECT hs10, 0 AS pos, doc_code AS code, 'Certificat ' || p_type AS name, 'ORG ' || p_brand AS issuer, doc_code AS raw FROM facts""")
def flatten_documents(spark, d):
    return flatten.flatten_documents(_tables(spark, d))


@query("flatten_agreements", f"""{_FACTS}
  SELECT hs10, 0 AS pos, 'Émirats' AS country, 'LISTE A' AS liste, '2,5 %' AS di, '0' AS tpi, 'Émirats' AS raw FROM facts""")
def flatten_agreements(spark, d):
    return flatten.flatten_agreements(_tables(spark, d))


@query("flatten_history", f"{_FACTS} SELECT hs10, 0 AS pos, DATE '2020-01-15' AS date, 'Taux: ' || p_size || ' %' AS raw FROM facts")
def flatten_history(spark, d):
    return flatten.flatten_history(_tables(spark, d))


@query("undated_history", f"{_FACTS} SELECT hs10, 1 AS pos, 'Taux: ' AS raw FROM facts WHERE p_partkey % 5 = 0")
def undated_history(spark, d):
    return flatten.undated_history(_tables(spark, d))


@query("build_rag_chunks", f"""{_FACTS}, chunks AS (
    SELECT hs10, 0 AS chunk_index, 'designation' AS topic, p_name AS chunk_text FROM facts
    UNION ALL SELECT hs10, 1, 'taxation', p_type FROM facts UNION ALL SELECT hs10, 2, 'documents', p_brand FROM facts)
  SELECT hs10, chunk_index, topic, chunk_text, sha256(chunk_text) AS chunk_hash FROM chunks
  QUALIFY row_number() OVER (PARTITION BY sha256(chunk_text) ORDER BY hs10, chunk_index) = 1""")
def build_rag_chunks(spark, d):
    blank = F.concat(F.lit("  "), F.lit(" "))
    topics = {"designation": F.col("p_name"), "texts": blank, "taxation": F.col("p_type"), "documents": F.col("p_brand")}
    return flatten.build_rag_chunks(R.part_facts(spread_table(spark, d, "part")), topics)


@query("json_containment", f"{_FACTS} SELECT hs10 FROM facts WHERE NOT by_key AND p_type = 'ECONOMY'")
def json_containment(spark, d):
    return flatten.containing_item(_tables(spark, d), "taxation.taxes", {"code": "DI", "label": "ECONOMY"}).select("hs10")


# --- Sources and sinks ----------------------------------------------------------------------------


@query("src_code_list", f"SELECT {R.SQL_HS10} AS hs_code FROM part WHERE p_partkey % 5 <> 0")
def src_code_list(spark, d):
    """Codes written with blanks around them and with empty ones between."""
    key, path = F.col("p_partkey"), shared_dir(spark, "codes")
    written = F.when(key % 10 == 0, "").when(key % 5 == 0, "   ").otherwise(R.joined("  ", R.hs10(), " "))
    listed = table(spark, d, "part").select(F.col("p_name").alias("other"), written.alias("hs_code"))
    listed.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.src_code_list(spark, path).select("hs_code")


@query("src_raw_json", f"""{_FACTS}
  SELECT hs10 AS hs_code, status AS scrape_status, CAST(6 AS INTEGER) AS n_sections FROM
    (SELECT hs10, CASE WHEN p_partkey % 10 = 0 THEN 'partial' WHEN p_partkey % 10 <> 1 THEN 'success' END AS status FROM facts)""")
def src_raw_json(spark, d):
    path = shared_dir(spark, "raw")
    _raw(spark, d).write.json(path)
    raw = readers.src_raw_json(spark, path, multi_line=False)
    return raw.select("hs_code", "scrape_status", F.size("sections").alias("n_sections"))


@query("src_table_scan", "SELECT * FROM orders")
def src_table_scan(spark, d):
    return readers.src_table_scan(spark, f"{d}/orders.parquet")


def _export(spark, d):
    path = shared_dir(spark, "export")
    table_rows = table(spark, d, "part").select(
        R.hs10().alias("hs10"),
        R.joined("- ", F.col("p_name"), "; \"cité\" :").alias("designation"),
        F.col("p_brand").alias("section_label"),
        (F.col("p_size") % 2 == 0).alias("present"),
        F.struct(F.col("p_name").alias("source"), F.lit("fr").alias("lang")).alias("meta"),
        F.lit(datetime(2026, 1, 31, 21, 44, 9, 802540)).cast("timestamp_ntz").alias("updated_at"),
    )
    sinks.sink_csv_export(table_rows, path)
    return sinks.read_csv_export(spark, path)


@query("sink_csv_export", f"""
  SELECT {R.SQL_HS10} AS hs10, p_name || '; "cité"' AS designation, p_brand AS section_label,
    CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS present,
    '{{"source": "' || p_name || '", "lang": "fr"}}' AS meta, '2026-01-31 21:44:09.802540' AS updated_at FROM part""")
def sink_csv_export(spark, d):
    return _export(spark, d)


@query("export_preview", f"""
  SELECT {R.SQL_HS10} AS hs10, p_name || '; "cité"' AS designation, p_brand AS section_label, (SELECT count(*) FROM part) AS total FROM part ORDER BY hs10 DESC LIMIT 5""")
def export_preview(spark, d):
    return report.export_preview(_export(spark, d))
