"""Queries on refresh state, the audit log, checks, upserts and ids."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bindings.registry import query, table
from bindings.render import SQL_HS10, SQL_PART_FACTS, hs10, part_facts
from tariffmill.functions.text import zfill_code
from tariffmill.operators import checks, delta, flatten, merge, report
from tariffmill.plans.product import derive_prefixes, present_in_record, present_in_table
from tariffmill.session import shared_dir
from tariffmill.sources.sinks import sink_audit_append
from tariffmill.sources.store import TABLES, CatalogueStore, product_part

AS_OF = datetime(2024, 1, 31)

# --- Refresh state --------------------------------------------------------------------------------

_STATE = "SELECT CAST(user_id AS VARCHAR) AS hs10, max(ts) AS updated_at FROM events GROUP BY user_id"


def _recent_sql(days: int) -> str:
    return f"SELECT hs10 FROM ({_STATE}) WHERE updated_at > TIMESTAMP '2024-01-31' - INTERVAL {days} DAY"


def _state(spark, d):
    events = table(spark, d, "events")
    return events.groupBy(F.col("user_id").cast("string").alias("hs10")).agg(F.max("ts").alias("updated_at"))


def _codes(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("hs_code"), F.col("c_custkey").alias("input_pos")
    )


@query("recent_keys", f"SELECT 1 AS days, hs10 FROM ({_recent_sql(1)}) UNION ALL SELECT 25, hs10 FROM ({_recent_sql(25)})")
def recent_keys(spark, d):
    recent = [delta.recent_keys(_state(spark, d), AS_OF, n).select(F.lit(n).alias("days"), "hs10") for n in (1, 25)]
    return recent[0].unionByName(recent[1])


def _catalogue(spark, d) -> CatalogueStore:
    """A catalogue whose products have the keys and times of the events."""
    store = CatalogueStore(spark, shared_dir(spark, "catalogue"))
    schema = TABLES["hs_products"]
    known = _state(spark, d).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    rows = known.select(*[F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    store.insert("hs_products", rows.withColumn("part", product_part(F.col("hs10"))))
    return store


_ALL_CODES = "SELECT CAST(c_custkey AS VARCHAR) AS hs_code FROM customer"
_STALE_CODES = f"{_ALL_CODES} c WHERE NOT EXISTS (SELECT 1 FROM ({_recent_sql(25)}) r WHERE r.hs10 = CAST(c.c_custkey AS VARCHAR))"


@query("recent_keys_fallback", f"SELECT 'none' AS store, hs_code FROM ({_ALL_CODES}) UNION ALL SELECT 'recent', hs_code FROM ({_STALE_CODES})")
def recent_keys_fallback(spark, d):
    """Codes to fetch without a catalogue, and with one that holds recent keys."""
    stores = {"none": CatalogueStore(spark, shared_dir(spark, "no-catalogue")), "recent": _catalogue(spark, d)}
    found = [
        delta.delta_anti_join(_codes(spark, d), delta.keys_to_skip(store, AS_OF)).select(F.lit(name).alias("store"), "hs_code")
        for name, store in stores.items()
    ]
    return found[0].unionByName(found[1])


@query("force_refresh", f"SELECT true AS forced, hs_code FROM ({_ALL_CODES}) UNION ALL SELECT false, hs_code FROM ({_STALE_CODES})")
def force_refresh(spark, d):
    """Codes to fetch from one catalogue with recent keys, forced and not."""
    store = _catalogue(spark, d)
    found = [
        delta.delta_anti_join(_codes(spark, d), delta.keys_to_skip(store, AS_OF, force=forced)).select(F.lit(forced).alias("forced"), "hs_code")
        for forced in (True, False)
    ]
    return found[0].unionByName(found[1])


_DELTA = f"""
  SELECT CAST(c_custkey AS VARCHAR) AS hs_code, c_custkey FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM ({_recent_sql(1)}) r WHERE r.hs10 = CAST(c.c_custkey AS VARCHAR))
"""


@query("delta_anti_join", f"SELECT hs_code FROM ({_DELTA})")
def delta_anti_join(spark, d):
    return delta.delta_anti_join(_codes(spark, d), delta.recent_keys(_state(spark, d), AS_OF, 1)).select("hs_code")


@query("limit_codes", f"SELECT hs_code FROM ({_DELTA}) ORDER BY c_custkey LIMIT 100")
def limit_codes(spark, d):
    stale = delta.delta_anti_join(_codes(spark, d), delta.recent_keys(_state(spark, d), AS_OF, 1))
    return delta.limit_codes(stale, 100).select("hs_code")


@query("run_counts", f"""
  SELECT count(*) AS listed, count(*) - (SELECT count(*) FROM ({_DELTA})) AS skipped,
    (SELECT count(*) FROM ({_DELTA})) AS processed FROM customer""")
def run_counts(spark, d):
    return delta.run_counts(_codes(spark, d), delta.recent_keys(_state(spark, d), AS_OF, 1))


# --- Audit log ------------------------------------------------------------------------------------

_AUDIT = """
  SELECT lpad(CAST(user_id AS VARCHAR), 10, '0') AS hs10,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'VALIDATION_ERROR' ELSE 'SUCCESS' END AS status,
    CASE WHEN event_type IN ('error', 'signup') THEN event_type || ' ' || props END AS message,
    CAST(floor(value * 100) AS INTEGER) AS duration_ms
  FROM events
"""


def _audit(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.lpad(F.col("user_id").cast("string"), 10, "0").alias("hs10"),
        F.when(kind == "error", "FAILED").when(kind == "signup", "VALIDATION_ERROR").otherwise("SUCCESS").alias("status"),
        F.when(kind.isin("error", "signup"), F.concat(kind, F.lit(" "), F.col("props"))).alias("message"),
        F.floor(F.col("value") * 100).cast("int").alias("duration_ms"),
    )


@query("audit_success_rate", f"""
  SELECT count(*) AS total, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS success,
    round(count(CASE WHEN status = 'SUCCESS' THEN 1 END) / count(*) * 100, 6) AS success_rate FROM ({_AUDIT})""")
def audit_success_rate(spark, d):
    return report.audit_success_rate(_audit(spark, d)).withColumn("success_rate", F.round("success_rate", 6))


@query("audit_avg_duration",
       f"SELECT round(coalesce(avg(duration_ms), 0), 6) AS avg_ms FROM ({_AUDIT}) WHERE status = 'SUCCESS'")
def audit_avg_duration(spark, d):
    return report.audit_avg_duration(_audit(spark, d)).select(F.round("avg_ms", 6).alias("avg_ms"))


@query("audit_eta", f"""
  SELECT round(avg_ms / 1000, 6) AS avg_seconds, round(avg_ms / 1000 * 13000 / 3600, 6) AS eta_hours
  FROM (SELECT coalesce(avg(duration_ms), 0) AS avg_ms FROM ({_AUDIT}) WHERE status = 'SUCCESS')""")
def audit_eta(spark, d):
    return report.audit_eta(_audit(spark, d)).select(
        F.round("avg_seconds", 6).alias("avg_seconds"), F.round("eta_hours", 6).alias("eta_hours")
    )


@query("audit_top_errors", f"""
  SELECT status, substring(message, 1, 100) AS msg, count(*) AS n FROM ({_AUDIT}) WHERE status <> 'SUCCESS'
  GROUP BY 1, 2 ORDER BY n DESC, status, msg LIMIT 5""")
def audit_top_errors(spark, d):
    return report.audit_top_errors(_audit(spark, d))


@query("audit_status", """
  SELECT event_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'VALIDATION_ERROR'
    WHEN 'view' THEN 'VALIDATION_ERROR' ELSE 'SUCCESS' END AS status FROM events""")
def audit_status(spark, d):
    kind = F.col("event_type")
    failure = (
        F.when(kind == "error", F.concat(F.lit("violates check constraint "), F.col("props")))
        .when(kind == "signup", "Validation failed")
        .when(kind == "view", "ValueError: bad literal")
    )
    return table(spark, d, "events").select("event_id", report.audit_status(failure).alias("status"))


@query("sink_audit_append", _AUDIT)
def sink_audit_append_query(spark, d):
    path, audit, now = shared_dir(spark, "audit"), _audit(spark, d), F.lit(AS_OF).cast("timestamp_ntz")
    sink_audit_append(audit.where("status = 'SUCCESS'"), path, now)
    sink_audit_append(audit.where("status <> 'SUCCESS'"), path, now)
    return spark.read.parquet(path).drop("created_at")


# --- Codes ----------------------------------------------------------------------------------------


@query("derive_prefixes", f"""
  SELECT hs10, substr(hs10, 1, 4) AS hs4, substr(hs10, 1, 6) AS hs6, substr(hs10, 1, 8) AS hs8
  FROM (SELECT {SQL_HS10} AS hs10 FROM part)""")
def derive_prefixes_query(spark, d):
    part = table(spark, d, "part").select(hs10().alias("hs10"))
    return part.select("hs10", *[c.alias(n) for n, c in derive_prefixes(F.col("hs10")).items()])


@query("zfill_code", """
  SELECT p_partkey, CASE WHEN length(c) < 2 THEN lpad(c, 2, '0') ELSE c END AS code
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'NA' ELSE CAST(p_size * 3 AS VARCHAR) END AS c FROM part)""")
def zfill_code_query(spark, d):
    code = F.when(F.col("p_partkey") % 9 == 0, "NA").otherwise((F.col("p_size") * 3).cast("string"))
    return table(spark, d, "part").select("p_partkey", zfill_code(code).alias("code"))


@query("present_flag", """
  SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN false ELSE true END AS in_record,
    CASE WHEN p_size % 3 = 1 THEN false ELSE true END AS in_table FROM part""")
def present_flag(spark, d):
    label = F.when(F.col("p_size") % 3 == 0, "NA").when(F.col("p_size") % 3 == 2, F.col("p_name"))
    return table(spark, d, "part").select(
        "p_partkey", present_in_record(label).alias("in_record"), present_in_table(label).alias("in_table")
    )


@query("check_code_format", f"""
  WITH codes AS (SELECT CASE WHEN p_partkey % 7 = 0 THEN substr({SQL_HS10}, 1, 9) WHEN p_partkey % 11 = 0 THEN 'NA'
    ELSE {SQL_HS10} END AS hs10, CASE WHEN p_size * 3 < 10 THEN '0' || (p_size * 3)
    ELSE CAST(p_size * 3 AS VARCHAR) END AS sec FROM part)
  SELECT 'hs10' AS "column", hs10 AS value, count(*) AS n FROM codes WHERE NOT regexp_full_match(hs10, '[0-9]{{10}}') GROUP BY hs10
  UNION ALL SELECT 'sec', sec, count(*) FROM codes WHERE NOT regexp_full_match(sec, '[0-9]{{2}}') GROUP BY sec""")
def check_code_format(spark, d):
    key = F.col("p_partkey")
    codes = table(spark, d, "part").select(
        F.when(key % 7 == 0, F.substring(hs10(), 1, 9)).when(key % 11 == 0, "NA").otherwise(hs10()).alias("hs10"),
        zfill_code((F.col("p_size") * 3).cast("string")).alias("sec"),
    )
    return checks.check_code_format(codes, {"hs10": "hs10", "sec": "section_code"})


@query("assign_surrogate_ids", f"""
  WITH codes AS (SELECT DISTINCT p_partkey, {SQL_HS10} AS hs10 FROM part)
  SELECT hs10, (SELECT max(p_partkey + 1) FROM codes WHERE p_partkey % 3 = 0) + row_number() OVER (ORDER BY hs10) AS id
  FROM codes WHERE p_partkey % 3 <> 0""")
def assign_surrogate_ids(spark, d):
    codes = table(spark, d, "part").select("p_partkey", hs10().alias("hs10"))
    existing = codes.where("p_partkey % 3 = 0").select("hs10", (F.col("p_partkey") + 1).alias("id"))
    new = codes.where("p_partkey % 3 <> 0").select("hs10").distinct()
    return merge.assign_surrogate_ids(new, existing, ["hs10"], "hs10")


@query("resolve_parent_ids", """
  SELECT c_custkey, n_regionkey + 1 AS section_id, n_nationkey + 100 AS chapter_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 7 <> 0""")
def resolve_parent_ids(spark, d):
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    sections = region.select((F.col("r_regionkey") + 1).alias("id"), F.col("r_name").alias("section_code"))
    chapters = nation.where("n_nationkey % 7 <> 0").select(
        (F.col("n_nationkey") + 100).alias("id"),
        (F.col("n_regionkey") + 1).alias("section_id"),
        F.col("n_name").alias("chapter_code"),
    )
    names = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(names, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("r_name").alias("section_code"), F.col("n_name").alias("chapter_code")
    )
    with_section = merge.resolve_parent_ids(rows, sections, {"section_code": "section_code"}, "section_id")
    on = {"section_id": "section_id", "chapter_code": "chapter_code"}
    return merge.resolve_parent_ids(with_section, chapters, on, "chapter_id").select(
        "c_custkey", "section_id", "chapter_id"
    )


@query("catalogue_denormalize", f"""
  WITH facts AS ({SQL_PART_FACTS})
  SELECT hs10, designation, sec AS section_code, 'Section ' || sec AS section_label, chap AS chapter_code,
    'Chapitre ' || chap AS chapter_label, hs4, 'Position ' || hs4 AS hs4_label, hs6, 'Sous-position ' || hs6 AS hs6_label FROM facts""")
def catalogue_denormalize(spark, d):
    part = part_facts(table(spark, d, "part"))
    codes = derive_prefixes(F.col("hs10"))
    flat = part.select(
        "hs10", F.concat("p_name", F.lit(" fini")).alias("designation"),
        F.col("sec").alias("section_code"), F.col("chap").alias("chapter_code"),
        codes["hs4"].alias("hs4"), codes["hs6"].alias("hs6"),
    )

    def nodes(keys, id_col, parent, code, name):
        """Distinct nodes of a level with their own and their parent's id."""
        ids = flat.select(*keys).distinct().withColumn("id", F.xxhash64(*keys))
        if parent:
            ids = ids.withColumn(parent, F.xxhash64(*keys[:-1]))
        return ids.select("id", *([parent] if parent else []), code, F.concat(F.lit(f"{name} "), code).alias("label"))

    keys = ["section_code", "chapter_code", "hs4", "hs6"]
    sections = nodes(keys[:1], "section_id", None, "section_code", "Section")
    chapters = nodes(keys[:2], "chapter_id", "section_id", "chapter_code", "Chapitre")
    hs4 = nodes(keys[:3], "hs4_id", "chapter_id", "hs4", "Position")
    hs6 = nodes(keys, "hs6_id", "hs4_id", "hs6", "Sous-position")
    products = flat.select("hs10", "designation", F.xxhash64(*keys).alias("hs6_id"))
    return flatten.catalogue_denormalize(products, hs6, hs4, chapters, sections)


# --- Rules ----------------------------------------------------------------------------------------


@query("orphan_check", "SELECT c_nationkey AS parent, count(*) AS n FROM customer WHERE c_nationkey % 7 = 0 GROUP BY 1")
def orphan_check(spark, d):
    parents = table(spark, d, "nation").where("n_nationkey % 7 <> 0")
    children = table(spark, d, "customer").withColumnRenamed("c_nationkey", "parent")
    return checks.orphan_check(children, "parent", parents, "n_nationkey")


@query("check_not_null", """
  SELECT 'parent' AS "column", count(CASE WHEN c_nationkey % 7 = 0 THEN 1 END) AS nulls FROM customer
  UNION ALL SELECT 'c_name', count(CASE WHEN c_name IS NULL THEN 1 END) FROM customer""")
def check_not_null(spark, d):
    customers = table(spark, d, "customer").withColumn(
        "parent", F.when(F.col("c_nationkey") % 7 != 0, F.col("c_nationkey"))
    )
    return checks.check_not_null(customers, ["parent", "c_name"])


@query("check_unique",
       "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, d):
    return checks.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("parent_delete_policy", """
  SELECT 'blocked' AS outcome, c_nationkey AS nation, count(*) AS n FROM customer WHERE c_nationkey % 7 = 0 GROUP BY 2
  UNION ALL SELECT 'remaining', c_nationkey, count(*) FROM customer WHERE c_nationkey % 7 <> 0 GROUP BY 2""")
def parent_delete_policy(spark, d):
    customers = table(spark, d, "customer").withColumnRenamed("c_nationkey", "nation")
    doomed = table(spark, d, "nation").where("n_nationkey % 7 = 0").select(F.col("n_nationkey").alias("nation"))
    blocked = merge.delete_blockers(doomed, customers, "nation", "nation")
    remaining = merge.cascade_delete(customers, doomed, "nation", "nation").groupBy("nation").agg(F.count("*").alias("n"))
    return blocked.select(F.lit("blocked").alias("outcome"), "nation", F.col("children").alias("n")).unionByName(
        remaining.select(F.lit("remaining").alias("outcome"), "nation", "n")
    )


@query("error_isolation", f"""WITH facts AS ({SQL_PART_FACTS}),
  codes AS (SELECT CASE WHEN p_partkey % 4 = 0 THEN left(hs10, 6) ELSE hs10 END AS hs10 FROM facts)
  SELECT hs10, CASE WHEN length(hs10) < 10 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN length(hs10) < 10 THEN 'hs10 violates its format: ' || hs10 END AS message FROM codes""")
def error_isolation(spark, d):
    """Products of which every fourth has a code that is too short: these are set aside, the others are loaded."""
    short = F.when(F.col("p_partkey") % 4 == 0, F.substring("hs10", 1, 6)).otherwise(F.col("hs10"))
    node = lambda n: F.struct(F.substring("hs10", 1, n).alias("code"))
    products = part_facts(table(spark, d, "part")).select(
        short.alias("hs_code"),
        F.struct(
            F.lit("01").alias("section_code"), F.lit("A").alias("section_label"), F.lit("01").alias("chapter_code"),
            F.lit("B").alias("chapter_label"), node(4).alias("hs4"), node(6).alias("hs6"),
        ).alias("hierarchy"),
    )
    good, bad = checks.split_good_bad(products, checks.product_failure())
    audit = good.select("hs_code", F.lit(None).cast("string").alias("failure")).unionByName(bad.select("hs_code", "failure"))
    return audit.select(
        F.col("hs_code").alias("hs10"), report.audit_status(F.col("failure")).alias("status"), F.col("failure").alias("message")
    )


# --- Upserts --------------------------------------------------------------------------------------

_CUT = "TIMESTAMP '2024-01-16'"
_NOW = "TIMESTAMP '2024-01-31'"
_UPS = f"""
  WITH ev AS (SELECT user_id, ts, event_id, event_type AS label, sha256(event_type) AS hash, props FROM events),
  tgt AS (SELECT * FROM ev WHERE ts < {_CUT} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
  inc AS (SELECT * FROM ev WHERE ts >= {_CUT}),
  fst AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
  lst AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
  kinds AS (SELECT user_id, count(DISTINCT hash) AS kinds FROM inc GROUP BY user_id)
"""


def _ups(spark, d):
    """(target, incoming): the last event per user before the cut, and all events after it."""
    rows = table(spark, d, "events").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("label"),
        F.sha2("event_type", 256).alias("hash"), F.col("props").alias("meta"),
    )
    cut = F.lit(datetime(2024, 1, 16)).cast("timestamp_ntz")
    target = merge.last_per_key(rows.where(F.col("ts") < cut), ["user_id"], ["ts", "event_id"])
    return target, rows.where(F.col("ts") >= cut)


@query("upsert_insert_only", f"""{_UPS}
  SELECT coalesce(t.user_id, f.user_id) AS user_id, coalesce(t.label, f.label) AS label,
    coalesce(t.event_id, f.event_id) AS event_id FROM tgt t FULL JOIN fst f ON t.user_id = f.user_id""")
def upsert_insert_only(spark, d):
    target, incoming = _ups(spark, d)
    fresh = merge.upsert_insert_only(target, incoming, ["user_id"], ["ts", "event_id"])
    return merge.apply_touched(target, fresh, ["user_id"]).select("user_id", "label", "event_id")


@query("upsert_overwrite_labels", f"""{_UPS}
  SELECT coalesce(t.user_id, l.user_id) AS user_id, coalesce(l.label, t.label) AS label,
    coalesce(l.label, t.label) IS NOT NULL AS present, coalesce(t.props, f.props) AS meta,
    coalesce(t.ts, {_NOW}) AS updated_at
  FROM tgt t FULL JOIN lst l ON t.user_id = l.user_id LEFT JOIN fst f ON f.user_id = l.user_id""")
def upsert_overwrite_labels(spark, d):
    target, incoming = _ups(spark, d)
    present = present_in_table(F.col("label"))
    columns = ["user_id", "label", "present", "meta", "updated_at"]
    old = target.withColumn("present", present).withColumn("updated_at", F.col("ts")).select(*columns)
    now = F.lit(AS_OF).cast("timestamp_ntz")
    new = incoming.withColumn("present", present).withColumn("updated_at", now).select(*columns, "ts", "event_id")
    touched = merge.upsert_overwrite_labels(old, new, ["user_id"], ["ts", "event_id"])
    return merge.apply_touched(old, touched, ["user_id"])


@query("upsert_on_hash_change", f"""{_UPS}
  SELECT coalesce(t.user_id, l.user_id) AS user_id, coalesce(l.label, t.label) AS label, coalesce(l.hash, t.hash) AS hash,
    coalesce(t.event_id, f.event_id) AS hs6_id,
    CASE WHEN l.user_id IS NULL THEN t.ts WHEN t.user_id IS NULL OR kinds > 1 OR t.hash <> l.hash THEN {_NOW} ELSE t.ts END AS updated_at
  FROM tgt t FULL JOIN lst l ON t.user_id = l.user_id LEFT JOIN fst f ON f.user_id = l.user_id
  LEFT JOIN kinds k ON k.user_id = l.user_id""")
def upsert_on_hash_change(spark, d):
    target, incoming = _ups(spark, d)
    columns = ["user_id", "label", "hash", F.col("event_id").alias("hs6_id")]
    old = target.select(*columns, F.col("ts").alias("updated_at"))
    touched = merge.upsert_on_hash_change(
        old, incoming.select(*columns, F.struct("ts", "event_id").alias("at")), ["user_id"], ["at"],
        F.lit(AS_OF).cast("timestamp_ntz"), hash_col="hash",
    )
    return merge.apply_touched(old, touched.drop("at"), ["user_id"])


@query("classify_changes", f"""{_UPS}
  SELECT coalesce(t.user_id, l.user_id) AS user_id, CASE WHEN l.user_id IS NULL THEN 'untouched' WHEN t.user_id IS NULL THEN 'new'
    WHEN t.hash = l.hash THEN 'unchanged' ELSE 'changed' END AS change
  FROM tgt t FULL JOIN lst l ON t.user_id = l.user_id""")
def classify_changes(spark, d):
    target, incoming = _ups(spark, d)
    return merge.classify_changes(target, incoming, ["user_id"], ["ts", "event_id"], "hash")


@query("replay_upserts", """
  SELECT user_id, max(CASE WHEN before IS DISTINCT FROM event_type THEN ts END) AS updated_at
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
  GROUP BY user_id""")
def replay_upserts(spark, d):
    return merge.replay_upserts(table(spark, d, "events"), ["user_id"], "ts", "event_id", "event_type")
