"""Upserts, ids, checks and reports on small frames, against plain Python replays."""

import json
import random
from datetime import datetime

from pyspark.sql import functions as F

from tariffmill.functions.jsontext import canonical_json
from tariffmill.operators import checks, delta, flatten, merge, report
from tariffmill.plans import product as PR
from tariffmill.plans.records import records_from_pages
from tariffmill.sources import readers, sinks
from tariffmill.sources.store import CatalogueStore

NOW = datetime(2030, 1, 1)


def events(seed, n=300, keys=12):
    rng = random.Random(seed)
    return [(rng.randrange(keys), i // 2, i, rng.choice("abc"), i) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, ts int, tie int, hash string, node int")


def test_replay_against_loop(spark):
    rows = events(1)
    rows += [(99, i, 1000 + i, "a" if i < 150 else "b", i) for i in range(300)]  # a hot key
    expected, last = {}, {}
    for k, ts, tie, h, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        if last.get(k) != h:
            expected[k] = ts
        last[k] = h
    got = merge.replay_upserts(frame(spark, rows), ["k"], "ts", "tie", "hash").collect()
    assert {r["k"]: r["updated_at"] for r in got} == expected


def test_upserts_against_loop(spark):
    target_rows = [(k, h, 1000 + k, datetime(2020, 1, 1)) for k, h in enumerate("abcabc")]
    incoming = events(2, n=60)
    table = {k: [h, node, at] for k, h, node, at in target_rows}
    for k, ts, tie, h, node in sorted(incoming, key=lambda r: (r[1], r[2])):
        if k not in table:
            table[k] = [h, node, NOW]
        else:
            if table[k][0] != h:
                table[k][2] = NOW
            table[k][0] = h
    target = spark.createDataFrame(target_rows, "k int, hash string, node int, updated_at timestamp_ntz")
    touched = merge.upsert_on_hash_change(
        target, frame(spark, incoming).select("k", "hash", "node", F.struct("ts", "tie").alias("at")), ["k"], ["at"],
        F.lit(NOW).cast("timestamp_ntz"), hash_col="hash", keep=("node",),
    ).drop("at")
    whole = merge.apply_touched(target, touched, ["k"])
    assert {r["k"]: [r["hash"], r["node"], r["updated_at"]] for r in whole.collect()} == table
    again = merge.upsert_on_hash_change(
        whole, touched.select("k", "hash", "node", F.lit(1).alias("at")), ["k"], ["at"], F.lit(datetime(2031, 1, 1)).cast("timestamp_ntz"),
        hash_col="hash", keep=("node",),
    ).drop("at")
    assert sorted(map(tuple, merge.apply_touched(whole, again, ["k"]).collect())) == sorted(map(tuple, whole.collect()))


def test_insert_only_and_classify(spark):
    target = spark.createDataFrame([(1, "old"), (2, "same")], "k int, label string")
    incoming = spark.createDataFrame([(1, "new", 1), (3, "b", 2), (3, "a", 1), (2, "same", 1)], "k int, label string, at int")
    fresh = merge.upsert_insert_only(target, incoming, ["k"], ["at"])
    assert [tuple(r) for r in fresh.collect()] == [(3, "a", 1)]
    kinds = merge.classify_changes(target, incoming, ["k"], ["at"], "label").collect()
    assert {r["k"]: r["change"] for r in kinds} == {1: "changed", 2: "unchanged", 3: "new"}


def test_ids_are_dense(spark):
    new = spark.createDataFrame([(f"{i * 37 % 9973:06d}",) for i in range(500)], "code string")
    got = merge.assign_surrogate_ids(new, spark.createDataFrame([(41,)], "id long"), ["code"], "code").orderBy("code").collect()
    assert [r["id"] for r in got] == list(range(42, 542))
    empty = spark.createDataFrame([], "id long")
    assert merge.assign_surrogate_ids(new, empty, ["code"], "code").agg(F.min("id")).first()[0] == 1


def test_checks(spark):
    df = spark.createDataFrame([("0101",), ("010",), (None,), ("010",)], "hs4 string")
    assert [tuple(r) for r in checks.check_code_format(df, {"hs4": "hs4"}).collect()] == [("hs4", "010", 2)]
    assert [tuple(r) for r in checks.check_not_null(df, ["hs4"]).collect()] == [("hs4", 1)]
    assert [tuple(r) for r in checks.check_unique(df, ["hs4"]).collect()] == [("010", 2)]
    parents = spark.createDataFrame([("0101",)], "id string")
    assert [tuple(r) for r in checks.orphan_check(df, "hs4", parents, "id").collect()] == [("010", 2)]


def test_delta(spark):
    state = spark.createDataFrame([("a", datetime(2029, 12, 20)), ("b", datetime(2029, 11, 1))], "hs10 string, updated_at timestamp_ntz")
    codes = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3), ("b", 4)], "hs_code string, input_pos int")
    skip = delta.recent_keys(state, NOW)
    stale = delta.delta_anti_join(codes, skip)
    assert [r["hs_code"] for r in delta.limit_codes(stale, 2).collect()] == ["b", "c"]
    assert delta.limit_codes(stale, None).count() == 3
    assert tuple(delta.run_counts(codes, skip).first()) == (4, 1, 3)
    assert delta.keys_to_skip(CatalogueStore(spark, "/nowhere/at/all"), NOW).count() == 0


def test_report(spark, value):
    log = spark.createDataFrame([("SUCCESS", None, 1500), ("SUCCESS", None, 500), ("FAILED", "x" * 150, 9)], "status string, message string, duration_ms int")
    assert tuple(report.audit_success_rate(log).first())[:2] == (3, 2)
    assert report.audit_success_rate(log.limit(0)).count() == 0
    assert report.audit_avg_duration(log.limit(0)).first()[0] == 0
    assert round(report.audit_eta(log).first()["eta_hours"], 3) == 3.611
    assert report.audit_top_errors(log).first()["msg"] == "x" * 100
    assert report.health_report(log).first()["avg_seconds"] == 1.0
    status = report.audit_status(F.col("m"))
    assert [value(status, m=m) for m in (None, "Validation failed", "violates check constraint")] == ["SUCCESS", "VALIDATION_ERROR", "FAILED"]


def test_canonical_json_like_python(spark):
    rows = [
        ('dit "oui"', "a, b: c"), ("é\\n", "😀 [x]: {y}"), ("tab\there", None), ("ünï,", ":"),
    ]
    df = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", canonical_json(F.struct(F.array(F.struct("a", "b")).alias("items"), F.lit(True).alias("ok"))).alias("js")
    )
    for r in df.collect():
        assert r["js"] == json.dumps({"items": [{"a": r["a"], "b": r["b"]}], "ok": True}, sort_keys=True)


def test_hash_ignores_labels_and_unit(spark):
    from tests.test_store import raw, record

    def hashes(*records):
        return [r[0] for r in PR.assemble_product(raw(spark, *records), F.lit(NOW)).select("canonical_hash").collect()]

    a, b, c = hashes(record("0101210000"), record("0101210000", hs4="Autre", chap="02 - X", at="2029"), record("0101210000", rate="3 %"))
    assert a == b != c


def test_flatten_defaults(spark):
    df = spark.sql("SELECT '1' hs10, named_struct('accord_convention', array(named_struct('country','UE','list',null,'DI',null,'TPI','1','raw','UE'))) agreements")
    assert tuple(flatten.flatten_agreements(df).first())[2:6] == ("UE", "", "0%", "1")


def test_export(spark, tmp_path):
    empty = spark.createDataFrame([], "hs10 string")
    assert sinks.sink_csv_export(empty, str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()
    df = spark.sql("SELECT '0101' hs4, 'NA' label, true present, named_struct('lang','fr','n',null) meta, timestamp_ntz'2026-01-31 21:44:09.802544' updated_at, cast(null as string) note")
    path = tmp_path / "out"
    assert sinks.sink_csv_export(df, str(path))
    text = next(path.glob("part-*.csv")).read_text(encoding="utf-8")
    assert text.splitlines() == [
        "﻿hs4;label;present;meta;updated_at;note",
        '0101;NA;True;"{""lang"": ""fr"", ""n"": null}";2026-01-31 21:44:09.802544;',
    ]
    assert sinks.read_csv_export(spark, str(path)).first()["hs4"] == "0101"


def test_code_list(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("n,hs_code\n1, 0101 \n2,\n3,  \n4,0202\n\n5,0101\n", encoding="utf-8")
    codes = readers.src_code_list(spark, str(tmp_path / "codes.csv"))
    assert [r["hs_code"] for r in codes.orderBy("input_pos").collect()] == ["0101", "0202", "0101"]
    assert readers.src_code_list(spark, str(tmp_path / "absent.csv")).count() == 0


def test_raw_json_array(spark, tmp_path):
    (tmp_path / "raw.json").write_text(json.dumps([{"hs_code": "01", "sections": []}, {"hs_code": "02"}]), encoding="utf-8")
    assert [r["hs_code"] for r in readers.src_raw_json(spark, str(tmp_path / "raw.json")).collect()] == ["01", "02"]


def test_pages_stream(spark, tmp_path):
    spark.createDataFrame([(1, "u", "<p>a</p>")], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages"))
    query = readers.stream_pages(spark, str(tmp_path / "pages")).writeStream.format("memory").queryName("pages_seen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("pages_seen").count() == 1


def test_order_and_map_sections(spark):
    df = spark.sql("SELECT array(named_struct('section_name','b','content',1,'order',2), named_struct('section_name','a','content',2,'order',1), named_struct('section_name','b','content',3,'order',3)) s")
    ordered = df.select(PR.order_sections(F.col("s")).alias("o")).first()["o"]
    assert [r["order"] for r in ordered] == [1, 2, 3]
    assert df.select(PR.section_map(F.col("s")).alias("m")).first()["m"] == {"b": 3, "a": 2}


def test_chosen_pages_of_a_visit(spark):
    at = "2026-01-01T00:00:00"
    table = "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>5 %</td></tr></table>"
    rows = [
        ("1", at, "main", None, None, f"<p>Main</p>{table}", None),
        ("1", at, "section", "S", None, "<p>first</p>", None),
        ("1", at, "section", "S", 2, "<p>good</p>", None),
        ("1", at, "section", "S", 3, None, None),  # a failed retry
    ]
    pages = spark.createDataFrame(rows, "hs_code string, scraped_at string, kind string, section_name string, order int, html string, error string")
    got = records_from_pages(pages).collect()[0]
    assert got["scrape_status"] == "success"
    assert [s["content"]["raw_text"] for s in got["sections"]] == ["good"]
    assert got["main_content"]["raw_text"].startswith("Main") and len(got["main_content"]["tables"]) == 1


def test_containing_item_is_tested_above_the_shuffle(spark):
    """The test of an item stays above the shuffle that spreads its rows."""
    from tariffmill.operators.flatten import containing_item

    rows = spark.range(20).repartition(3)
    items = F.array(F.struct(F.col("id").cast("string").alias("code")))
    made = rows.select("id", F.transform(items, lambda i: F.struct(F.concat(i["code"], F.lit("x")).alias("code"))).alias("items"))
    found = containing_item(made, "items", {"code": "7x"})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "exists" in plan and plan.index("exists") < plan.index("Repartition")
    assert [r["id"] for r in found.collect()] == [7] and found.columns == ["id", "items"]
