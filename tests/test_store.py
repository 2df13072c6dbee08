"""Batches into the catalogue: ids, first and last wins, changed hashes, bad rows, replays, streams."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tariffmill import patterns as P
from tariffmill.plans.sync import sync_batch
from tariffmill.schemas import RAW_SCHEMA
from tariffmill.sources import store as store_module
from tariffmill.sources.readers import src_raw_json
from tariffmill.sources.store import TABLES, CatalogueStore
from tariffmill.streaming.ingest import read_landing, stream_ingest

T1, T2, T3 = (datetime(2026, m, 1) for m in (1, 2, 3))


def section(name, text="", pairs=None):
    content = {"raw_text": text, "metadata": {}, "key_values": pairs or {}, "tables": [], "length": len(text)}
    return {"section_name": name, "section_type": "x", "content": content, "order": 0, "scraped_at": None}


def record(code, at="2026-01-01", sec="01 - Animaux", chap="01 - Vivants", hs4="Chevaux", rate="2,5 %"):
    body = "\n".join([
        "Codification", f"{code[:2]}.{code[2:4]}", hs4, f"{code[:4]}.{code[4:6]}", code[6:8], code[8:10], f"- - Nom {code}", "U",
    ])
    pairs = {k: v for k, v in (("SECTION", sec), ("CHAPITRE", chap)) if v}
    return {
        "hs_code": code, "scraped_at": at, "scrape_status": "success", "url": None, "main_content": None,
        "sections": [
            section(P.SECTION_POSITION, body, pairs), section(P.SECTION_TAXES, f"Droit ( DI ) : {rate}"),
        ],
        "summary": None, "error": None,
    }


def write(path, *records):
    path.mkdir(exist_ok=True)
    name = path / f"part-{len(list(path.iterdir())):03d}.json"
    name.write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    stamp = 1_700_000_000 + 10 * len(list(path.iterdir()))
    os.utime(name, (stamp, stamp))  # the stream takes the oldest file first
    return str(path)


def raw(spark, *records):
    return spark.createDataFrame([json.dumps(r) for r in records], "string").select(
        F.from_json("value", RAW_SCHEMA).alias("r")
    ).select("r.*")


def natural(store):
    """Tables by natural keys, without ids."""
    names = {"sections": ["section_code", "label"], "chapters": ["chapter_code", "label"],
             "hs4_nodes": ["hs4", "label", "present"], "hs6_nodes": ["hs6", "label", "present"],
             "hs_products": ["hs10", "designation", "canonical_hash", "updated_at", "chapter_label"]}
    return {t: sorted(tuple(r) for r in store.read(t, c).collect()) for t, c in names.items()}


def test_sync(spark, tmp_path):
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    first = raw(
        spark,
        record("0101210000"),
        record("0101290000", at="2026-01-02", chap="01 - Autre", hs4="Anes"),
        record("020110", sec="01 - A"),  # short code
        record("0301110000", sec=None, chap=None),  # no section anywhere
    )
    sync_batch(first, store, "tests", 0, T1)
    got = natural(store)
    assert got["sections"] == [("01", "Animaux")]
    assert got["chapters"] == [("01", "Vivants")]  # first wins
    assert got["hs4_nodes"] == [("0101", "Anes", True)]  # last wins
    assert [r[0] for r in got["hs6_nodes"]] == ["010121", "010129"]
    assert [r[:2] for r in got["hs_products"]] == [("0101210000", "Nom 0101210000"), ("0101290000", "Nom 0101290000")]
    audit = {r["hs10"]: (r["status"], r["message"]) for r in store.read("audit_logs").collect()}
    assert audit["0101210000"] == ("SUCCESS", None)
    assert audit["020110"][0] == "FAILED" and "hs10" in audit["020110"][1]
    assert audit["0301110000"][0] == "FAILED" and "section_code" in audit["0301110000"][1]
    assert {r["hs10"] for r in store.read("quarantine").collect()} == {"020110", "0301110000"}

    second = raw(
        spark,
        record("0101210000", at="2026-02-01", chap="01 - Neuf", hs4="Equides"),  # same hash, new labels
        record("0101290000", at="2026-02-01", rate="10 %"),  # new hash
        record("0201100000", at="2026-02-01", chap="02 - Viandes"),  # new key
    )
    sync_batch(second, store, "tests", 1, T2)
    got = natural(store)
    assert got["chapters"] == [("01", "Vivants"), ("02", "Viandes")]
    assert ("0101", "Chevaux", True) in got["hs4_nodes"] or ("0101", "Equides", True) in got["hs4_nodes"]
    times = {r[0]: (r[3], r[4]) for r in got["hs_products"]}
    assert times["0101210000"] == (T1, "Neuf")  # label moves, time stays
    assert times["0101290000"][0] == T2 and times["0201100000"][0] == T2
    ids = {t: sorted(r[0] for r in store.read(t, ["id"]).collect()) for t in list(TABLES)[:4]}
    assert ids["sections"] == [101] and ids["chapters"] == [10101, 10102]
    assert ids["hs4_nodes"] == [101010101, 101020201]
    parents = {r["hs6_id"] for r in store.read("hs_products").collect()}
    assert parents == set(ids["hs6_nodes"])

    before = natural(store)
    sync_batch(raw(spark, record("0909090909")), store, "tests", 1, T3)  # a committed version does nothing
    assert natural(CatalogueStore(spark, store.root)) == before
    sync_batch(second, store, "tests", 2, T3)  # the same records again change no hash and no time
    assert natural(store) == before
    store.recover()  # nothing is pending
    assert natural(CatalogueStore(spark, store.root)) == before


def test_lost_batch_leaves_no_trace(spark, tmp_path, monkeypatch):
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    sync_batch(raw(spark, record("0101210000")), store, "tests", 0, T1)
    before = natural(store)
    batch = raw(spark, record("0101210000", rate="9 %"), record("0201100000", chap="02 - V"))
    with monkeypatch.context() as patch:
        patch.setattr(CatalogueStore, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            sync_batch(batch, store, "tests", 1, T2)
    assert natural(CatalogueStore(spark, store.root)) == before
    sync_batch(batch, store, "tests", 1, T2)
    again = natural(store)["hs_products"]
    assert [(r[0], r[3]) for r in again] == [("0101210000", T2), ("0201100000", T2)]


def test_batch_lost_after_its_mark_is_finished(spark, tmp_path, monkeypatch):
    """Lost with its nodes put back and its products not: the next batch of any source finishes it first."""
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    sync_batch(raw(spark, record("0101210000"), record("0102210000")), store, "tests", 0, T1)
    batch = raw(spark, record("0101210000", rate="9 %"), record("0201100000", chap="02 - V"), record("12"))
    move = store_module.replace_folders
    with monkeypatch.context() as patch:
        patch.setattr(store_module, "replace_folders", lambda spark, source, *a: (_ for _ in ()).throw(OSError("lost")) if "hs_products" in source else move(spark, source, *a))
        with pytest.raises(OSError, match="lost"):
            sync_batch(batch, store, "tests", 1, T2)
    again = CatalogueStore(spark, store.root)
    assert sync_batch(batch, again, "tests", 1, T3) is None
    assert [(r[0], r[3]) for r in natural(again)["hs_products"]] == [("0101210000", T2), ("0102210000", T1), ("0201100000", T2)]
    assert again.read("audit_logs").count() == 5 and again.read("quarantine").count() == 1
    assert not os.path.exists(f"{store.root}/pending")


def test_same_key_twice_in_a_batch(spark, tmp_path):
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    sync_batch(raw(spark, record("0101210000")), store, "tests", 0, T1)
    there_and_back = raw(
        spark, record("0101210000", at="2026-02-01", rate="9 %"), record("0101210000", at="2026-02-02")
    )
    sync_batch(there_and_back, store, "tests", 1, T2)
    rows = store.read("hs_products").collect()
    assert len(rows) == 1 and rows[0]["updated_at"] == T2  # the hash moved in between
    assert rows[0]["taxation"]["taxes"][0]["raw"] == "2,5 %"


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    parts = [
        [record("0101210000", at="2026-01-01"), record("0201100000", at="2026-01-01", chap="02 - V")],
        [record("0101290000", at="2026-01-02", chap="01 - Autre", hs4="Anes")],
        [record("0101210000", at="2026-01-03", rate="9 %")],
    ]
    landing, root = tmp_path / "landing", str(tmp_path / "stream")

    def run():
        stream_ingest(
            read_landing(spark, str(landing), max_files=1), root, str(tmp_path / "checkpoint"), clock=lambda: T1
        ).awaitTermination()

    for part in parts[:2]:
        write(landing, *part)
    run()
    write(landing, *parts[2])
    run()
    batch = CatalogueStore(spark, str(tmp_path / "batch"))
    sync_batch(src_raw_json(spark, str(landing), multi_line=False), batch, "tests", 0, T1)
    assert natural(CatalogueStore(spark, root)) == natural(batch)


def test_batches_are_known_by_source(spark, tmp_path):
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    assert sync_batch(raw(spark, record("0101210000")), store, "a", 0, T1)
    assert sync_batch(raw(spark, record("0201100000", chap="02 - V")), store, "b", 0, T1)  # same number, other source
    assert {r[0] for r in natural(store)["hs_products"]} == {"0101210000", "0201100000"}
    assert not sync_batch(raw(spark, record("0909090909")), store, "b", 0, T2)
    with pytest.raises(ValueError, match="does not follow"):
        sync_batch(raw(spark, record("0909090909")), store, "a", 5, T2)
    again = CatalogueStore(spark, store.root)
    assert again.has("a", 0) and again.has("b", 0) and not again.has("c", 0) and not again.has("a", 1)


def files_of(store, *without):
    return [f"{d}/{f}" for d, _, names in os.walk(store.root) for f in names if f.startswith("part-") and not any(w in d for w in without)]


def test_replays_do_not_grow_the_store(spark, tmp_path):
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    batch = raw(spark, record("0101210000"), record("0201100000", chap="02 - V"))
    sizes = []
    for i in range(5):
        sync_batch(batch, store, "a", i, T1)
        sizes.append(len(files_of(store, "audit_logs")))
    # one file per chapter of products, one of nodes by first digit, one of sections and chapters, one of loaded batches
    assert sizes == [5] * 5
    assert not os.path.exists(f"{store.root}/pending")


def test_a_batch_writes_its_own_chapters(spark, tmp_path):
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    sync_batch(raw(spark, *[record(f"{c:02d}01210000", chap=f"{c:02d} - C") for c in range(1, 9)]), store, "a", 0, T1)
    before = set(files_of(store, "audit_logs", "loaded", "nodes"))
    assert len(before) == 8
    counts = sync_batch(raw(spark, record("0301210000", chap="03 - C", rate="9 %"), record("9901210000", chap="99 - C"), record("1")), store, "a", 1, T2)
    assert (counts.processed, counts.quarantined, counts.warned) == (3, 1, 0)
    after = set(files_of(store, "audit_logs", "loaded", "nodes", "quarantine"))
    assert {f.split("part=")[1][:2] for f in before ^ after} == {"03", "99"} and len(after) == 9
    assert store.read("hs6_nodes", ["hs6"]).count() == 9


def test_a_batch_reads_its_own_chapters(spark, tmp_path):
    store = CatalogueStore(spark, str(tmp_path / "cat"))
    sync_batch(raw(spark, record("0101210000"), record("0201100000", chap="02 - V")), store, "a", 0, T1)
    plan = store.read("hs_products", ["hs10"], ["02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part" in plan.split("PartitionFilters")[1][:80]
    assert [r["hs10"] for r in store.read("hs_products", ["hs10"], ["02"]).collect()] == ["0201100000"]


def test_restart_parses_no_loaded_code(spark, tmp_path):
    """After a crash, here one that also lost the checkpoint, records of loaded codes are left out before parsing."""
    landing, root, seen = tmp_path / "landing", str(tmp_path / "cat"), []

    def run(checkpoint, clock):
        stream_ingest(
            read_landing(spark, str(landing), max_files=1), root, str(tmp_path / checkpoint), clock=lambda: clock, skip_days=25, on_load=seen.append
        ).awaitTermination()

    write(landing, record("0101210000"), record("0201100000", chap="02 - V"), record("77"))
    run("one", T1)
    write(landing, record("0101210000", at="2026-01-05", rate="9 %"), record("0301110000", chap="03 - P"))
    run("two", T1)
    # the first file again: only the record that failed; the second file: the code that is not loaded
    assert [(c.processed, c.quarantined) for c in seen] == [(3, 1), (1, 1), (1, 0)]
    assert {r[0]: r[3] for r in natural(CatalogueStore(spark, root))["hs_products"]} == dict.fromkeys(["0101210000", "0201100000", "0301110000"], T1)
    run("three", datetime(2026, 3, 1))  # by then all are due again
    assert sum(c.processed for c in seen[3:]) == 5


def test_unreadable_store_starts_afresh(spark, tmp_path):
    from tariffmill.operators.delta import keys_to_skip

    store = CatalogueStore(spark, str(tmp_path / "cat"))
    sync_batch(raw(spark, record("0101210000")), store, "a", 0, T1)
    assert [r[0] for r in keys_to_skip(store, T1).collect()] == ["0101210000"]
    (broken,) = [f for f in files_of(store) if "hs_products" in f]
    with open(broken, "r+b") as f:
        f.truncate(20)
    for crc in (tmp_path / "cat").rglob("*.crc"):
        crc.unlink()
    assert keys_to_skip(store, T1).collect() == []


def page(code, at, section, text, order=0, error=None):
    html = None if text is None else f"<p>{text}</p>"
    return {"hs_code": code, "scraped_at": at, "kind": "section" if section else "main", "section_name": section, "order": order, "html": html, "error": error}


def test_visits_over_files(spark, tmp_path):
    """Pages of a visit in several files, late and repeated, give the batch's record; its state goes when it is closed."""
    from tariffmill.plans.records import records_from_pages
    from tariffmill.schemas import LANDED_SCHEMA
    from tariffmill.streaming.ingest import read_landed_pages, stream_records

    a, b, c = "2026-01-01T10:00:00", "2026-01-01T10:30:00", "2026-01-01T12:00:00"
    files = [
        [page("1", a, None, "main"), page("1", a, "S1", "old", 0), page("2", b, None, None, error="timed out")],
        [page("1", a, "S2", "two", 1), page("3", c, None, "other")],
        [page("1", a, "S1", "new", 2), page("1", a, "S2", "two", 1), page("1", None, "S3", "no time")],
        [page("4", "2026-01-02T00:00:00", None, "closes the others")],
        [page("1", a, "S9", "too late"), page("5", "2026-01-03T00:00:00", None, "closes the one before")],
    ]
    landing, out = tmp_path / "landing", tmp_path / "out"

    def run():
        stream = stream_records(read_landed_pages(spark, str(landing), 1), late="3 hours").writeStream.format("parquet")
        query = stream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(out))
        query.awaitTermination()
        states = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
        return states[-1][-1]["numRowsTotal"], sum(s["numRowsDroppedByWatermark"] for ops in states for s in ops)

    def rows(df):
        return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())

    for rows_ in files[:3]:
        write(landing, *rows_)
    run()
    write(landing, *files[3])
    run()
    write(landing, *files[4])
    left, dropped = run()
    whole = spark.createDataFrame([json.dumps(p) for f in files[:3] for p in f if p["scraped_at"]], "string")
    whole = whole.select(F.from_json("value", LANDED_SCHEMA).alias("p")).select("p.*")
    got = spark.read.schema(RAW_SCHEMA).parquet(str(out))
    assert rows(got.where("hs_code < '4'")) == rows(records_from_pages(whole))
    assert got.where("hs_code = '4'").count() == 1 and got.where("hs_code = '5'").count() == 0
    assert left <= 2 and dropped >= 1


def test_state_of_open_visits_lies_on_disk(spark, tmp_path, monkeypatch):
    """The query of visits keeps its state in stores on local disk, and leaves the session's settings as they were."""
    from bindings import stream
    from tariffmill.streaming import ingest

    queries, write_records, provider = [], ingest.write_records, next(iter(ingest.STATE))
    before = spark.conf.get(provider, None)
    monkeypatch.setattr(stream, "write_records", lambda *a: queries.append(write_records(*a)) or queries[-1])
    assert stream.stream_visits(spark, _parts(spark, tmp_path, 30)).count() == 30
    assert spark.conf.get(provider, None) == before
    operators = [s for q in queries for p in q.recentProgress for s in p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in operators) > 30
    assert all(any(name.startswith("rocksdb") for name in s["customMetrics"]) for s in operators)


def _parts(spark, tmp_path, n):
    """A folder with a part table of one file."""
    folder = tmp_path / "tables"
    rows = spark.range(n).selectExpr(
        "id AS p_partkey", "concat('n', id) AS p_name", "'Brand#1' AS p_brand", "'ECONOMY' AS p_type", "cast(id % 50 + 1 AS int) AS p_size"
    )
    rows.coalesce(1).write.parquet(str(folder / "part.parquet"))
    return str(folder)


def test_landings_are_written_and_read_by_all_cores(spark, tmp_path):
    from bindings import stream

    folder, cores = _parts(spark, tmp_path, 400), spark.sparkContext.defaultParallelism
    landing = str(tmp_path / "landing")
    stream._land(spark, folder, 2, landing)
    assert len(list((tmp_path / "landing").glob("part-*.json"))) == 2 * cores
    assert len(stream._run_stream(spark, landing, str(tmp_path / "root"))) == 2


def test_a_run_renders_its_pages_on_all_cores(spark, tmp_path, monkeypatch):
    from bindings import stream

    seen = []

    def refresh(codes, pages, *rest, **named):
        seen.append(pages.rdd.getNumPartitions())
        raise StopIteration

    monkeypatch.setattr(stream, "refresh", refresh)
    with pytest.raises(StopIteration):
        stream.run_pipeline(spark, _parts(spark, tmp_path, 40))
    assert seen == [spark.sparkContext.defaultParallelism]
