"""Files through all three jobs, in batch and as streams."""

import csv
import io
import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from batchlake.plans import curation, ingest, loading
from batchlake.plans.loading import Serving
from batchlake.schemas import QUARANTINE
from batchlake.sources import delimited
from batchlake.sources.delimited import read_clean, read_raw
from batchlake.sources.manifests import read_handoffs, read_manifests
from batchlake.sources.tables import (
    add_partitions,
    catalogue_tables,
    create_curated_table,
    curated_objects,
    read_curated,
    with_file,
)
from batchlake.streaming import jobs

T0, T1, T2, T3 = [f"2026-07-01T{h:02d}:00:00Z" for h in (10, 11, 12, 13)]

FILES = {
    "uploads/a.csv": (
        "customer_id,name,email,sales,region\n"
        "101,Ada Lovelace,ada@example.com,1500,EMEA\n"
        "102,Grace Hopper,grace@navy.mil,2750.50,AMER\n"
        "103,  katherine   JOHNSON, KJ@Example.com ,   3200,AMER\n"
        "104,Negative,neg@example.com,-250,AMER\n"
        "105,,no.name@example.com,500,EMEA\n"
        "106,Comma,comma@example.com,\"1,500\",EMEA\n"
        ",No Id,id@example.com,600,AMER\n"
        "101,Again,again@example.com,1,AMER\n"
        "201,Bad First,not-an-email,100,APAC\n"
        "201,Then Good,good@example.com,200,APAC\n"
        "None,Token,token@example.com,1,APAC\n"
    ),
    "uploads/sub dir/b+c.csv": (
        "sales,plan,email,customer_id,name\n700,x,ada@new.org,101,Ada Again\n5,y,z@z.zz,301,Zed\n"
    ),
    "short.csv": "\n\ncustomer_id,name,email,sales\n401,Short,s@s.ss\n402,Full,f@f.ff,4\n\n",
    "quoted.csv": 'customer_id,name,email,sales\n501,"two\nlines",t@t.tt,6\n502,"say ""hi""",h@h.hh,7\n',
    "header_only.csv": "customer_id,name,email,sales\n",
    "long.csv": "customer_id,name,email,sales\n601,Long,l@l.ll,8\n602,Too,t@t.tt,9,MORE\n",
    "quoted_long.csv": 'customer_id,name,email,sales\n701,"a\nb",l@l.ll,8\n702,"c\nd",t@t.tt,9,MORE\n',
    "no_sales.csv": "customer_id,name,email\n1,a,a@b.c\n",
    "empty.csv": "",
}


def put(lake, files):
    for key, body in files.items():
        path = os.path.join(lake.zone("raw"), key)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(body)


def run_all(spark, lake):
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    return loading.load(spark, lake, T2)


def test_ingest(spark, lake):
    put(lake, FILES)
    made = {r.raw_key: r for r in ingest.ingest(spark, lake, T0).collect()}
    counts = {k: (r.total_records, r.valid_records) for k, r in made.items()}
    assert counts == {
        "uploads/a.csv": (11, 4),
        "uploads/sub dir/b+c.csv": (2, 2),
        "short.csv": (2, 1),
        "quoted.csv": (2, 2),
        "header_only.csv": (0, 0),
    }
    failed = {r.raw_key: r.reason for r in spark.read.parquet(lake.zone("failed_files")).collect()}
    assert failed == {
        "long.csv": "row longer than header",
        "quoted_long.csv": "row longer than header",
        "no_sales.csv": "missing required columns: sales",
        "empty.csv": "empty file",
    }
    clean = read_clean(spark, lake.zone("clean"))
    names = {r.customer_id: r.name for r in clean.collect()}
    assert names["501"] == "two\nlines" and names["502"] == 'say "hi"'
    assert clean.where("customer_id = '103'").first().sales == "   3200"
    rejected = spark.read.option("header", True).csv(lake.zone("rejected"))
    assert clean.count() + rejected.count() == 17
    tries = {r.raw_key: r.attempts for r in ingest.redrive(spark, lake).collect()}
    assert tries["long.csv"] == 1


def _listed(folder):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs)


def test_a_second_run_does_nothing(spark, lake):
    put(lake, FILES)
    first = ingest.ingest(spark, lake, T0, files=2)
    assert first.count() == 5
    zones = [lake.zone(z) for z in ("clean", "rejected", "metadata", "failed_files")]
    before = [_listed(z) for z in zones]
    assert ingest.ingest(spark, lake, T1).count() == 0
    assert [_listed(z) for z in zones] == before
    put(lake, {"new.csv": FILES["short.csv"]})
    assert [r.raw_key for r in ingest.ingest(spark, lake, T2).collect()] == ["new.csv"]
    # The stream goes on where the batch job stopped.
    put(lake, {"newer.csv": FILES["short.csv"]})
    jobs.ingest_stream(spark, lake, once=True).awaitTermination()
    assert read_manifests(spark, lake.zone("metadata")).count() == 7
    assert ingest.ingest(spark, lake, T3).count() == 0


def test_redrive(spark, lake):
    put(lake, FILES)
    ingest.ingest(spark, lake, T0)
    state = lambda f: {r.raw_key: (r.attempts, r.state) for r in f.collect()}
    first = state(ingest.failures(spark, lake))
    assert first == dict.fromkeys(["long.csv", "quoted_long.csv", "no_sales.csv", "empty.csv"], (1, "WAITING"))
    put(lake, {"long.csv": FILES["short.csv"], "empty.csv": FILES["header_only.csv"]})
    os.remove(os.path.join(lake.zone("raw"), "no_sales.csv"))
    again = state(ingest.redrive_files(spark, lake, T1, max_attempts=2, files=3))
    assert again == {
        "long.csv": (1, "RESOLVED"),
        "empty.csv": (1, "RESOLVED"),
        "quoted_long.csv": (2, "GIVEN_UP"),
        "no_sales.csv": (2, "GIVEN_UP"),
    }
    reasons = {r.raw_key: r.reason for r in ingest.failures(spark, lake).collect()}
    assert reasons["no_sales.csv"] == "file is gone" and reasons["quoted_long.csv"] == "row longer than header"
    manifests = read_manifests(spark, lake.zone("metadata"))
    assert manifests.where("raw_key = 'long.csv'").count() == 1
    # What is resolved or given up is not tried again.
    assert state(ingest.redrive_files(spark, lake, T2, max_attempts=2)) == again
    assert ingest.redrive(spark, lake, max_attempts=2).count() == 0
    assert ingest.redrive(spark, lake).count() == 2


def _cell(r):
    quoted = ["", "q", "a,b", 'say ""hi""', '""', "two\nlines", "\n\n", 'e"",\n""f', '"",""']
    return r.choice(["", "a", '5" pipe', 'x"y"', "z", str(r.random()), *[f'"{q}"' for q in quoted]])


def test_files_with_line_breaks_are_split(spark, lake):
    r = random.Random(5)
    head = "customer_id,name,email,sales"
    bodies = {f"f{n}.csv": [head, *(",".join(_cell(r) for _ in range(4)) for _ in range(600))] for n in range(3)}
    bodies["open.csv"] = [*bodies["f0.csv"][:300], '1,2,3,"never closed', *["x,y,z"] * 50]
    files = {k: "\n".join(v) + "\n" * (k != "open.csv") for k, v in bodies.items()}
    files["crlf.csv"] = files["f1.csv"].replace("\n", "\r\n")
    os.makedirs(lake.zone("raw"), exist_ok=True)
    for key, body in files.items():
        with open(os.path.join(lake.zone("raw"), key), "w", newline="") as f:
            f.write(body)
    sizes = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "3000"}
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        found, endless = delimited.records(spark, [lake.zone("raw")], lake.zone("raw"))
        rows = found.orderBy("raw_key", "ord").collect()
        raw, failed = read_raw(spark, lake.zone("raw"))
        cells = raw.orderBy("raw_key", "ord").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert endless.count() == failed.count() == 0
    for key, body in files.items():
        text = body.replace("\r\n", "\n")
        want = [w for w in csv.reader(io.StringIO(text, newline="")) if w]
        have = [x for x in rows if x.raw_key == key]
        assert [next(csv.reader(io.StringIO(x.record, newline=""))) for x in have] == want
        assert [x.cells for x in have] == list(map(len, want))
        clean = [(x.customer_id, x.name, x.email, x.sales) for x in cells if x.raw_key == key]
        assert clean == [tuple(c or None for c in w) for w in want[1:]]


def test_an_endless_record_fails_its_file(spark, lake, monkeypatch):
    monkeypatch.setattr(delimited, "MAX_RECORD", 500)
    put(lake, {"open.csv": 'customer_id,name,email,sales\n1,"a\nb",c,4\n1,2,3,"never' + "\nx,y,z" * 200})
    rows, failed = read_raw(spark, lake.zone("raw"))
    assert rows.count() == 0
    assert [tuple(r) for r in failed.collect()] == [("open.csv", "quote that is not closed")]


def test_profile_is_hashed(spark, lake):
    put(lake, {"a.csv": FILES["quoted.csv"], "b.csv": "\ufeff\n" + FILES["short.csv"], "c.csv": FILES["short.csv"]})
    profile = delimited.profile_files(spark, [lake.zone("raw")])
    assert "SortAggregate" not in profile._jdf.queryExecution().executedPlan().toString()
    facts = {r.file[-5:]: (r.cells, r.multi_line) for r in profile.collect()}
    assert facts == {"a.csv": (4, True), "b.csv": (4, False), "c.csv": (4, False)}
    assert list(delimited.header_lines(spark, profile).values()) == ["customer_id,name,email,sales"]


def test_batch_ids_are_made_once_a_file(spark, lake):
    put(lake, {k: FILES[k] for k in ("uploads/a.csv", "uploads/sub dir/b+c.csv", "short.csv")})
    rows, _ = read_raw(spark, lake.zone("raw"))
    # No step that handles cells handles paths, too.
    steps = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("sha2" in s and "null" in s and "c0#" in s for s in steps)
    made = ingest.ingest(spark, lake, T0)
    found = {(r.raw_key, r.batch_id) for r in rows.select("raw_key", "batch_id").distinct().collect()}
    assert found == {(r.raw_key, r.phase1_batch_id) for r in made.collect()} and len(found) == 3


def test_rows_are_dealt_out_before_they_are_curated(spark, lake, monkeypatch):
    put(lake, {"uploads/a.csv": FILES["uploads/a.csv"]})
    ingest.ingest(spark, lake, T0)
    plans, write = [], curation.writers.write_curated

    def noted(frame, *rest, **more):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        write(frame, *rest, **more)

    monkeypatch.setattr(curation.writers, "write_curated", noted)
    curation.curate(spark, lake, T1, max_invalid_percent=100)
    (plan,) = plans
    assert 0 <= plan.find("initcap") < plan.find("RepartitionByExpression")
    names = [r.name for r in read_curated(spark, lake.zone("curated")).collect()]
    assert names == ["Ada Lovelace", "Katherine Johnson", "Negative"]  # in file order


def test_keys_are_made_once_an_object(spark, lake):
    put(lake, {"uploads/a.csv": FILES["uploads/a.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=100)
    root = lake.zone("curated")
    held = curated_objects(with_file(read_curated(spark, root)), root)
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    grouped = [step.split("Aggregate [")[1].split("]")[0] for step in plan.splitlines() if "Aggregate [" in step]
    assert "_file#" in grouped[-1]  # of the rows, by path; keys come after it
    (handed,) = spark.read.parquet(lake.zone("serving_batches")).collect()
    (listed,) = held.collect()
    assert handed.curated_object_keys == listed.curated_object_keys
    assert all(os.path.isfile(f"{root}/{k}") for k in listed.curated_object_keys)


def test_manifest_documents(spark, lake):
    put(lake, {"uploads/a.csv": FILES["uploads/a.csv"]})
    ingest.ingest(spark, lake, T0)
    found = [
        os.path.join(d, f) for d, _, fs in os.walk(lake.zone("metadata")) for f in fs if f.endswith(".json")
    ]
    assert len(found) == 1
    document = json.load(open(found[0]))
    assert list(document) == sorted(document)
    assert document["source_filename"] == "a.csv" and document["invalid_records"] == 7
    with open(os.path.join(lake.zone("metadata"), "broken.json"), "w") as f:
        f.write("{not json")
    assert read_manifests(spark, lake.zone("metadata")).count() == 1
    assert read_manifests(spark, lake.zone("metadata"), "uploads").count() == 1
    assert read_manifests(spark, lake.zone("metadata"), "other").count() == 0
    assert ingest.manifest_key("uploads/a.csv") == "metadata/uploads/a.csv.json"


def test_order_survives_splits(spark, lake):
    lines = ["customer_id,name,email,sales"] + [f"{i % 700},n{i},a@b.c,{i}" for i in range(20_000)]
    put(lake, {"big.csv": "\n".join(lines) + "\n"})
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(size, "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        raw, _ = read_raw(spark, lake.zone("raw"))
        assert raw.rdd.getNumPartitions() > 3
        rows = raw.orderBy("ord").collect()
    finally:
        spark.conf.set(size, before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert [r.sales for r in rows] == [str(i) for i in range(20_000)]
    assert len({r.ord for r in rows}) == 20_000


def test_declared_header_reads_the_same(spark, lake):
    put(lake, {"a.csv": FILES["quoted.csv"].replace("two\nlines", "two"), "b.csv": FILES["header_only.csv"]})
    profiled, _ = read_raw(spark, lake.zone("raw"))
    declared, _ = read_raw(spark, lake.zone("raw"), header=["customer_id", "name", "email", "sales"])
    key = lambda f: sorted(map(tuple, f.drop("ord").collect()))
    assert key(profiled) == key(declared)


def test_curation_is_incremental_and_replayable(spark, lake):
    put(lake, {"uploads/a.csv": FILES["uploads/a.csv"]})
    ingest.ingest(spark, lake, T0)
    with pytest.raises(curation.QualityGateError):
        curation.curate(spark, lake, T1)  # 1 of 4 quarantined, limit 10 %
    assert not os.path.exists(lake.zone("serving_batches"))
    assert read_curated(spark, lake.zone("curated")).count() == 3
    stats = curation.curate(spark, lake, T1, max_invalid_percent=25)
    assert stats == {"rows_read": 4, "rows_written": 3, "rows_quarantined": 1}
    assert read_curated(spark, lake.zone("curated")).count() == 3  # replaced, not doubled
    assert spark.read.schema(QUARANTINE).json(lake.zone("quarantine")).count() == 1
    assert spark.read.parquet(lake.zone("metrics")).count() == 6
    put(lake, {"uploads/b.csv": FILES["uploads/sub dir/b+c.csv"]})
    raw_b = os.path.join(lake.zone("raw"), "uploads/b.csv")
    ingest.ingest(spark, lake, T2, paths=[raw_b])
    assert curation.curate(spark, lake, T2)["rows_read"] == 2


def test_load(spark, lake):
    put(lake, FILES)
    rows = {r.source_file: r for r in run_all(spark, lake).collect()}
    assert {r.status for r in rows.values()} == {"SUCCESS"}
    assert rows["a.csv"].records_failed == 1
    total = sum(r.records_loaded for r in rows.values()), sum(r.records_updated for r in rows.values())
    assert total == (6, 1)
    serving = Serving(spark, lake)
    people = {r.customer_id: r for r in serving.customers().collect()}
    assert sorted(people) == ["101", "103", "301", "402", "501", "502"]
    assert people["103"].name == "Katherine Johnson" and people["103"].email == "kj@example.com"
    assert serving.sales().count() == 7
    assert [r.error_message for r in serving.errors().collect()] == ["sales must be non-negative"]

    before = sorted(map(tuple, serving.customers().collect()), key=str)
    assert loading.load(spark, lake, T3).count() == 0
    assert sorted(map(tuple, serving.customers().collect()), key=str) == before
    tries = {r.status: r["count"] for r in serving.attempts().groupBy("status").count().collect()}
    assert tries == {"SUCCESS": 5, "SKIPPED": 5}  # one of them has no rows
    audit = {r.status: r.duration_ms for r in serving.audit().collect()}
    assert list(audit) == ["SUCCESS"] and 0 <= audit["SUCCESS"] < 600_000
    serving.compact()
    assert sorted(map(tuple, serving.customers().collect()), key=str) == before


def test_tampered_batch_fails_and_stays_invisible(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"], "b.csv": FILES["uploads/sub dir/b+c.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=20)
    sound = spark.read.parquet(lake.zone("serving_batches"))
    forged = sound.withColumn(
        "source_checksum",
        F.when(F.col("source_filename") == "a.csv", "0").otherwise(F.col("source_checksum")),
    )
    rows = {r.source_file: r.status for r in loading.load(spark, lake, T2, forged).collect()}
    assert rows == {"a.csv": "FAILED", "b.csv": "SUCCESS"}
    serving = Serving(spark, lake)
    assert sorted(r.customer_id for r in serving.customers().collect()) == ["101", "301"]
    fault = serving.errors().where("customer_id IS NULL").collect()
    assert [r.error_message for r in fault] == ["checksum mismatch"]
    assert loading.redrive(spark, lake).count() == 1
    again = {r.source_file: r.status for r in loading.load(spark, lake, T3, sound).collect()}
    assert again == {"a.csv": "SUCCESS"}
    assert serving.customers().where("customer_id = '101'").first().name == "Ada Lovelace"


def test_objects_are_checked_against_the_handoff(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"], "b.csv": FILES["uploads/sub dir/b+c.csv"]})
    ingest.ingest(spark, lake, T0)
    manifests = {r.source_filename: r for r in read_manifests(spark, lake.zone("metadata")).collect()}
    for r in manifests.values():
        for zone, first, keys in (("clean", r.clean_key, r.clean_object_keys), ("rejected", r.rejected_key, r.rejected_object_keys)):
            assert first == (keys[0] if keys else None)
            assert all(os.path.isfile(os.path.join(lake.zone(zone), k)) for k in keys)
    assert manifests["a.csv"].rejected_object_keys and not manifests["b.csv"].rejected_object_keys
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    handed = spark.read.parquet(lake.zone("serving_batches"))
    for r in handed.collect():
        assert os.path.isfile(os.path.join(lake.root, r.source_manifest_key))
        assert all(os.path.isfile(os.path.join(lake.zone("curated"), k)) for k in r.curated_object_keys)
    more = F.when(F.col("source_filename") == "a.csv", F.array_append("curated_object_keys", F.lit("gone.parquet")))
    changed = handed.withColumn("curated_object_keys", F.coalesce(more, "curated_object_keys"))
    rows = {r.source_file: r.status for r in loading.load(spark, lake, T2, changed).collect()}
    assert rows == {"a.csv": "FAILED", "b.csv": "SUCCESS"}
    fault = Serving(spark, lake).errors().where("customer_id IS NULL").first()
    assert fault.error_message == "objects differ from those handed on"


def test_malformed_documents_do_not_stop_a_load(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    for name, body in (("torn.json", "{not json"), ("bare.json", '{"phase3_batch_id": "x"}')):
        with open(os.path.join(lake.zone("handoffs"), name), "w") as f:
            f.write(body)
    for clock in (T2, T3):  # the second run adds no rows
        loading.load_documents(spark, lake, clock)
        faults = Serving(spark, lake).errors().where("customer_id IS NULL").collect()
        assert {r.source_file: r.error_message for r in faults} == {
            "torn.json": "unreadable document",
            "bare.json": "curated_object_keys is not a list",
        }
        assert len(faults) == 2
    assert [r.status for r in Serving(spark, lake).audit().collect()] == ["SUCCESS"]


def test_two_loads_share_the_batches(spark, lake, monkeypatch):
    put(lake, {"a.csv": FILES["uploads/a.csv"], "b.csv": FILES["uploads/sub dir/b+c.csv"], "c.csv": FILES["short.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    monkeypatch.setattr(loading, "ROUND", 2)
    began, inner = loading._load_batches, []

    def interrupted(*given):
        if not inner:  # a second load comes while the first holds two of the three batches
            inner.append(None)
            inner[0] = [r.batch_id for r in loading.load(spark, lake, T3).collect()]
        return began(*given)

    monkeypatch.setattr(loading, "_load_batches", interrupted)
    outer = [r.batch_id for r in loading.load(spark, lake, T2).collect()]
    assert (len(outer), len(inner[0])) == (2, 1) and not set(outer) & set(inner[0])
    serving = Serving(spark, lake)
    assert {r.status for r in serving.audit().collect()} == {"SUCCESS"} and serving.audit().count() == 3
    assert serving.attempts().where("status = 'SUCCESS'").count() == 3


def test_only_one_takes_a_round_and_dead_ones_expire(spark, lake, monkeypatch):
    first, second = (loading.Rounds(spark, lake.zone("serving")) for _ in range(2))
    assert first.open_batches() == (0, None)
    assert first.begin(["x", "y"], 0) == 1 and second.begin(["x"], 0) is None
    last, held = second.open_batches()
    assert last == 1 and sorted(r.batch_id for r in held.collect()) == ["x", "y"]
    monkeypatch.setattr(loading, "LEASE", -1)
    assert second.open_batches()[1].count() == 0
    first.end(1)
    assert second.open_batches() == (1, None)


def test_discovery_leaves_documents_out(spark, lake):
    put(lake, {"sales/a.csv": "id,amount\n1,2.5\n", "metadata/m.csv": "key,value,more,other\na,b,c,d\n"})
    found = delimited.infer_columns(spark, lake.zone("raw"))
    assert [tuple(r) for r in found.collect()] == [("id", "int"), ("amount", "double")]


def test_compaction_rewrites_touched_buckets_only(spark, lake):
    rows = "".join(f"{i},N{i},n{i}@x.org,{i}\n" for i in range(300))
    put(lake, {"all.csv": "customer_id,name,email,sales\n" + rows})
    run_all(spark, lake)
    serving = Serving(spark, lake)
    serving.compact()
    base = os.path.join(serving.root, "customers_base")
    assert len(os.listdir(os.path.join(base, "version=1"))) > 32
    put(lake, {"one.csv": "customer_id,name,email,sales\n7,Seven,s@x.org,1\n"})
    ingest.ingest(spark, lake, T2)
    curation.curate(spark, lake, T2)
    touched = serving.spark.range(1).select(F.lit("7").alias("customer_id")).select(loading._bucket()).first()[0]
    keys = [r.customer_id for r in serving.customer_keys([touched]).collect()]
    assert "7" in keys and len(keys) < 30
    row = loading.load(spark, lake, T3).first()
    assert (row.records_loaded, row.records_updated) == (0, 1)
    before = sorted(map(tuple, serving.customers().collect()), key=str)
    serving.compact()
    folders = [n for n in os.listdir(os.path.join(base, "version=2")) if n.startswith("bucket=")]
    assert folders == [f"bucket={touched}"]
    assert sorted(map(tuple, serving.customers().collect()), key=str) == before and len(before) == 300
    serving.compact()  # nothing to fold
    assert not os.path.exists(os.path.join(base, "version=3"))


def test_a_later_batch_corrects_a_customer(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"]})
    run_all(spark, lake)
    put(lake, {"b.csv": FILES["uploads/sub dir/b+c.csv"]})
    ingest.ingest(spark, lake, T2, paths=[os.path.join(lake.zone("raw"), "b.csv")])
    curation.curate(spark, lake, T2)
    row = loading.load(spark, lake, T3).first()
    assert (row.records_loaded, row.records_updated) == (1, 1)
    ada = Serving(spark, lake).customers().where("customer_id = '101'").first()
    assert ada.name == "Ada Again" and ada.sales == 700
    assert (ada.created_at.hour, ada.updated_at.hour) == (12, 13)
    assert Serving(spark, lake).sales().where("customer_id = '101'").count() == 2


def test_handoff_documents(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"phase3_batch_id": "a", "curated_object_keys": ["x"]}))
    (tmp_path / "nokeys.json").write_text(json.dumps({"phase3_batch_id": "b"}))
    (tmp_path / "broken.json").write_text("{")
    good, bad = read_handoffs(spark, str(tmp_path))
    assert [r.phase3_batch_id for r in good.collect()] == ["a"]
    assert {r.manifest_key for r in bad.collect()} == {"nokeys.json", "broken.json"}


def test_partitioned_table_and_pruning(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    create_curated_table(spark, "curated_t", lake.zone("curated"))
    try:
        assert spark.table("curated_t").count() == 3
        day = read_curated(spark, lake.zone("curated")).first()
        some = spark.table("curated_t").where(f"year = '{day.year}' AND month = '{day.month}'")
        assert some.count() == 3 and day.month.startswith(("0", "1"))
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year" in plan
        assert catalogue_tables(spark).where("table_name = 'curated_t'").first().column_count == 16
    finally:
        spark.sql("DROP TABLE curated_t")


def test_partitions_of_a_run_are_added(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"], "b.csv": FILES["uploads/sub dir/b+c.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    name = {r.source_filename: r.phase1_batch_id for r in read_manifests(spark, lake.zone("metadata")).collect()}
    create_curated_table(spark, "added_t", lake.zone("curated"), repair=False)
    try:
        assert spark.table("added_t").count() == 0
        for _ in range(2):
            assert add_partitions(spark, "added_t", lake.zone("curated"), [name["a.csv"], "no such batch"]) == 1
        assert spark.table("added_t").count() == 3
        add_partitions(spark, "added_t", lake.zone("curated"), [name["b.csv"]])
        one = spark.table("added_t").where(F.col("phase3_batch_id") == name["b.csv"])
        assert one.count() == 2 and spark.table("added_t").count() == 5
        plan = one._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters:")[1].split("]")[0]
        assert f"= {name['b.csv'][:20]}" in filters
        assert len(one.inputFiles()) == 1
    finally:
        spark.sql("DROP TABLE added_t")


def test_streams_give_the_batch_result(spark, lake, tmp_path_factory):
    from batchlake.plans.lake import Lake

    other = Lake(str(tmp_path_factory.mktemp("batch")))
    small = {k: v for k, v in FILES.items() if k != "empty.csv"}
    put(lake, small)
    put(other, small)
    run_all(spark, other)
    steps = [
        lambda c: jobs.ingest_stream(spark, lake, c, True, files=3),
        lambda c: jobs.curate_stream(spark, lake, c, True, max_invalid_percent=60),
        lambda c: jobs.load_stream(spark, lake, c, True),
        lambda c: jobs.load_stream(spark, lake, c, True),
    ]
    for i, step in enumerate(steps):
        step(lake.zone(f"checkpoints/{i}")).awaitTermination()
    facts = lambda s: sorted((r.customer_id, r.sales_amount) for r in s.sales().collect())
    assert facts(Serving(spark, lake)) == facts(Serving(spark, other))
    people = lambda s: sorted(r.customer_id for r in s.customers().collect())
    assert people(Serving(spark, lake)) == people(Serving(spark, other))


def test_curated_objects_read_back_one_batch(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"], "b.csv": FILES["uploads/sub dir/b+c.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    for batch in spark.read.parquet(lake.zone("serving_batches")).collect():
        rows = read_curated(spark, lake.zone("curated"), batch.curated_object_keys)
        assert rows.count() == batch.records_written
        assert {r.phase3_batch_id for r in rows.collect()} == {batch.phase3_batch_id}


def test_report_is_written_as_json(spark, tmp_path):
    from batchlake.operators import checks
    from batchlake.sinks import writers

    table = spark.createDataFrame([(1,), (1,)], "id int")
    report = checks.run_suite(spark, checks.Suite(primary_keys=[("t", "id")]), {"t": table})
    facts = {"row_counts": checks.table_counts({"t": table})}
    document = checks.report_document(report, facts, "r1", T0)
    writers.write_report(document, str(tmp_path / "reports"))
    back = spark.read.json(str(tmp_path / "reports")).first()
    assert back.overall_status == "FAIL" and back.summary.failed_checks == 1
    assert back.results.primary_keys[0].check_name == "t.id"
    assert back.row_counts[0].row_count == 2


def test_batches_without_rows_are_handed_on_once(spark, lake):
    put(lake, {"none.csv": "customer_id,name,email,sales\n1,n,a@b.c,1.5\n", "head.csv": FILES["header_only.csv"]})
    ingest.ingest(spark, lake, T0)
    assert curation.pending(spark, lake).count() == 2
    curation.curate(spark, lake, T1, max_invalid_percent=100)
    assert curation.pending(spark, lake).count() == 0
    handed = spark.read.parquet(lake.zone("serving_batches")).collect()
    assert [(r.records_written, r.curated_object_keys) for r in handed] == [(0, [])] * 2
    assert {r.status for r in loading.load(spark, lake, T2).collect()} == {"SUCCESS"}


def test_a_failing_batch_is_parked_and_holds_up_no_other(spark, lake):
    put(lake, {"uploads/a.csv": FILES["uploads/a.csv"], "b.csv": FILES["uploads/sub dir/b+c.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, gate="batch")
    names = lambda: {r.source_filename for r in spark.read.parquet(lake.zone("serving_batches")).collect()}
    assert names() == {"b.csv"}
    assert curation.curate(spark, lake, T2, gate="batch")["rows_read"] == 0
    curation.curate(spark, lake, T2, gate="batch", max_invalid_percent=25)
    assert names() == {"a.csv", "b.csv"}


def test_rounds_do_all_batches(spark, lake, monkeypatch):
    monkeypatch.setattr(curation, "ROUND", 2)
    monkeypatch.setattr(loading, "ROUND", 2)
    put(lake, {f"{k}.csv": f"customer_id,name,email,sales\n{k},n,a@b.c,{k}\n" for k in range(5)})
    ingest.ingest(spark, lake, T0)
    assert curation.curate(spark, lake, T1)["rows_written"] == 5
    assert loading.load(spark, lake, T2).count() == 5
    assert Serving(spark, lake).customers().count() == 5


def test_rounds_load_by_ingestion_time(spark, lake, tmp_path, tmp_path_factory, monkeypatch):
    """Customers shared between batches: the audit does not depend on the size of a round."""
    for k in range(6):
        rows = "".join(f"{c},n{k},a@b.c,{k}\n" for c in range(6 - k, 10 - k))
        put(lake, {f"{k}.csv": "customer_id,name,email,sales\n" + rows})
        os.utime(os.path.join(lake.zone("raw"), f"{k}.csv"), (1_700_000_000 - 9000 * k,) * 2)
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1)
    other = shutil.copytree(tmp_path, tmp_path_factory.mktemp("copy") / "lake")
    found = []
    for size, here in ((1_000, lake), (2, type(lake)(str(other)))):
        monkeypatch.setattr(loading, "ROUND", size)
        rows = loading.load(spark, here, T2).collect()
        found.append({r["batch_id"]: (r["records_loaded"], r["records_updated"], r["source_file"]) for r in rows})
    assert len(found[0]) == 6 and found[0] == found[1]
    assert len({x[:2] for x in found[0].values()}) > 1


def test_a_load_that_breaks_off(spark, lake, monkeypatch):
    put(lake, {"b.csv": FILES["uploads/sub dir/b+c.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1)
    seen = []

    def torn(*_):
        seen.extend(r.status for r in Serving(spark, lake).audit().collect())
        raise ValueError("torn")

    with monkeypatch.context() as m:
        m.setattr(loading.op, "merge_counts", torn)
        with pytest.raises(ValueError, match="torn"):
            loading.load(spark, lake, T2)
    serving = Serving(spark, lake)
    assert seen == ["IN_PROGRESS"]
    assert [r.status for r in serving.audit().collect()] == ["FAILED"]
    fault = serving.errors().first()
    assert fault.customer_id is None and fault.error_message == "ValueError: torn"
    assert serving.customers().count() == 0 and loading.redrive(spark, lake).count() == 1
    assert [r.status for r in loading.load(spark, lake, T3).collect()] == ["SUCCESS"]
    assert serving.customers().count() == 2


def test_scans_are_limited_to_the_batches_of_the_run(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"], "b.csv": FILES["uploads/sub dir/b+c.csv"]})
    run_all(spark, lake)
    one = spark.read.parquet(lake.zone("serving_batches")).first().phase3_batch_id
    frames = [
        read_curated(spark, lake.zone("curated")).where(F.col("phase3_batch_id").isin([one])),
        Serving(spark, lake).staging().where(F.col("batch_id").isin([one])),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and one[:20] in plan.split("PartitionFilters")[1]


def test_keys_below_a_repeated_folder(spark):
    from batchlake.sources.listing import key_below

    got = spark.range(1).select(key_below(F.lit("file:/lake/raw/lake/raw/f.csv"), "/lake/raw")).first()[0]
    assert got == "lake/raw/f.csv"


def test_a_hand_off_lists_the_objects_of_its_batches_only(spark, lake):
    from batchlake.sources.tables import read_batches

    root = lake.zone("curated")
    assert read_batches(spark, root, ["b1"]) is None
    rows = [(f"b{i}", f"C{i}", "2026", "07", f"0{i}") for i in range(1, 6)] + [("b x", "C9", "2026", "07", "01")]
    frame = spark.createDataFrame(rows, "phase3_batch_id string, customer_id string, year string, month string, day string")
    frame.write.partitionBy("year", "month", "day", "phase3_batch_id").parquet(root)
    got = read_batches(spark, root, ["b2", "b4", "b77"])
    assert sorted(r.customer_id for r in got.collect()) == ["C2", "C4"]
    assert sorted((r.phase3_batch_id, r.day) for r in got.collect()) == [("b2", "02"), ("b4", "04")]
    assert len(got.inputFiles()) == 2
    assert read_batches(spark, root, ["b77"]) is None
    assert [r.customer_id for r in read_batches(spark, root, ["b x"]).collect()] == ["C9"]


def test_load_order_moves_no_row(spark, lake):
    put(lake, {"a.csv": FILES["uploads/a.csv"]})
    ingest.ingest(spark, lake, T0)
    curation.curate(spark, lake, T1, max_invalid_percent=25)
    rows = with_file(read_curated(spark, lake.zone("curated")))
    plan = loading.with_load_order(rows)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_steps_run_together_and_faults_come_last(spark):
    import threading

    from batchlake.session import together

    both = threading.Barrier(2, timeout=30)
    assert together(spark, lambda: both.wait() * 0, lambda: both.wait() * 0 + 1) == [0, 1]
    ended = []

    def fails():
        raise ValueError("torn")

    with pytest.raises(ValueError, match="torn"):
        together(spark, fails, lambda: ended.append(spark.range(3).count()))
    assert ended == [3]
