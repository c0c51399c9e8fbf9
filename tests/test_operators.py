"""Row rules, skew-safe joins, merge, as-of join and checks, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from batchlake.operators import checks, curate, load, merge, skew, validate
from batchlake.operators.asof import first_at_or_after
from batchlake.plans import order_checks

ROWS = "batch_id string, ord bigint, customer_id string, name string, email string, sales string"


def raw(spark, *rows, batch="b"):
    return spark.createDataFrame([(batch, i, *r) for i, r in enumerate(rows)], ROWS)


def tagged(spark, *rows):
    got = validate.tag_rows(raw(spark, *rows)).orderBy("ord").collect()
    return [(r.is_valid, list(r.reject_reasons)) for r in got]


GOOD = ("1", "Ada", "ada@x.org", "5")


def test_one_fault_at_a_time(spark):
    got = tagged(
        spark,
        GOOD,
        (None, "a", "a@b.c", "1"),
        ("  ", "a", "a@b.c", "1"),
        ("2", " ", "a@b.c", "1"),
        ("3", "a", "a@b", "1"),
        ("4", "a", "a@b.c", "1,5"),
        ("1", "a", "a@b.c", "1"),
    )
    assert got == [
        (True, []),
        (False, ["missing_customer_id"]),
        (False, ["missing_customer_id"]),
        (False, ["missing_name"]),
        (False, ["invalid_email"]),
        (False, ["non_numeric_sales"]),
        (False, ["repeated_customer_id"]),
    ]


def test_an_invalid_first_row_uses_up_its_id(spark):
    got = tagged(spark, ("7", "a", "bad", "1"), ("7", "b", "b@c.d", "2"))
    assert [v for v, _ in got] == [False, False]


def test_ids_are_compared_per_batch_and_as_written(spark):
    rows = raw(spark, GOOD, (" 1", "a", "a@b.c", "1")).unionByName(raw(spark, GOOD, batch="c"))
    assert validate.tag_rows(rows).where("is_valid").count() == 3


def _random_rows(spark, n=3000):
    """A third of the rows share one id, many ids are blank."""
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        draw = rnd.random()
        key = "hot" if draw < 0.34 else None if draw < 0.5 else "  " if draw < 0.6 else str(rnd.randint(0, 400))
        rows.append((f"b{rnd.randint(0, 2)}", i, key, "n", "a@b.c" if rnd.random() < 0.8 else "x", rnd.choice(["1", "2.5", "-4", "y", None])))
    return rows, spark.createDataFrame(rows, ROWS).repartition(7)


@pytest.mark.parametrize("hot_rows", [1, 50, skew.HOT_ROWS])
def test_validation_equals_brute_force_with_hot_ids(spark, hot_rows):
    rows, frame = _random_rows(spark)
    seen, expected = set(), {}
    for b, i, key, _, email, sales in rows:
        known = key is not None and key.strip() != ""
        first = (b, key) not in seen
        seen.add((b, key))
        expected[i] = known and email == "a@b.c" and sales not in ("y", None) and first
    got = validate.tag_rows(frame, hot_rows=hot_rows).collect()
    assert {r.ord: r.is_valid for r in got} == expected


@pytest.mark.parametrize("hot_rows", [1, 50, skew.HOT_ROWS])
def test_load_rules_equal_brute_force_with_hot_ids(spark, hot_rows):
    rows, frame = _random_rows(spark)
    faults = {"1": None, "2.5": load.SALES_NOT_WHOLE, "-4": load.SALES_NEGATIVE,
              "y": load.SALES_NOT_NUMBER, None: load.SALES_MISSING}
    accepted, expected = set(), {}
    for b, i, key, *_, sales in rows:
        if key is None or key.strip() == "":
            expected[i] = load.MISSING_ID
        elif (b, key) in accepted:
            expected[i] = load.DUPLICATE_ID
        else:
            expected[i] = faults[sales]
            if faults[sales] is None:
                accepted.add((b, key))
    got = load.tag_load(frame, hot_rows=hot_rows).collect()
    assert {r.ord: r.error_message for r in got} == expected


def test_join_groups_is_the_plain_join(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 7 % 4).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("j"), "id"
    )
    groups = rows.groupBy("k", "j").agg(F.count(F.lit(1)).alias("n")).where("k != 2")
    for how in ("left", "inner"):
        plain = rows.join(groups, ["k", "j"], how).select("k", "j", "id", "n")
        for hot in (1, 60, 10**9):
            got = skew.join_groups(rows, groups, ["k", "j"], "n", F.col("id"), how=how, hot_rows=hot)
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def _with_lineage(spark, frame):
    names = ["ingestion_timestamp", "processed_timestamp", "phase1_batch_id", "phase3_batch_id",
             "source_filename", "source_raw_key", "source_clean_key", "pipeline_version"]
    stamps = {"ingestion_timestamp": "2026-07-01T23:30:00-05:00"}
    return frame.withColumns({n: F.lit(stamps.get(n, n)) for n in names})


def test_curation(spark):
    rows = _with_lineage(spark, raw(
        spark,
        (" 1 ", "  ada   LOVELACE", " A@B.C ", " 500 "),
        ("2", "b", "b@c.d", "2750.50"),
        ("3", "c", "c@d.e", "-250"),
        ("4", "d", "d@e.f", "inf"),
    ))
    t = curate.tag_curation(rows)
    good = {r.customer_id: r for r in curate.curated_rows(t).collect()}
    assert good["1"].name == "Ada Lovelace" and good["1"].email == "a@b.c"
    assert (good["1"].sales, good["1"].sales_category) == (500, "Medium")
    assert (good["3"].sales, good["3"].sales_category) == (-250, "Low")
    assert (good["1"].year, good["1"].month, good["1"].day) == ("2026", "07", "01")
    bad = curate.quarantine_rows(t).collect()
    assert {r.raw_record["customer_id"] for r in bad} == {"2", "4"}
    assert {r.reason for r in bad} == {curate.INVALID_SALES}
    assert bad[0].raw_record.keys() == {"customer_id", "name", "email", "sales"}


def test_reason_precedence(spark):
    rows = raw(spark, ("1", "a", "a@b.c", "x.5"), ("2", "a", "a@b.c", "5"), ("3", "a", "a@b.c", "5"))
    dated = _with_lineage(spark, rows).withColumn(
        "joined", F.when(F.col("ord") == 1, "2026-40-40").otherwise("7/1/26")
    )
    t = curate.tag_curation(dated, "joined")
    assert [r.error_reason for r in t.orderBy("ord").collect()] == [
        curate.INVALID_SALES, curate.DATE_PARSE_ERROR, None,
    ]
    assert curate.curated_rows(t, "joined").first().joined == "2026-07-01"
    gone = curate.tag_curation(_with_lineage(spark, rows), "joined")
    assert [r.error_reason for r in gone.orderBy("ord").collect()] == [
        curate.INVALID_SALES, curate.SCHEMA_MISMATCH, curate.SCHEMA_MISMATCH,
    ]


@pytest.mark.parametrize("bad, total, passed", [(1, 20, True), (3, 20, False), (2, 20, True), (0, 0, True)])
def test_gate(spark, bad, total, passed):
    stats = spark.createDataFrame([(total, total - bad, bad)], "rows_read bigint, rows_written bigint, rows_quarantined bigint")
    assert curate.quality_gate(stats, 10).first().passed is passed


def test_load_messages(spark):
    got = load.tag_load(raw(spark, ("101", "", "", "500"), ("102", "", "", "bad"), ("", "", "", "100"),
                            (" 101 ", "", "", "bad"), ("102", "", "", "7"), ("103", "", "", ""),
                            ("104", "", "", "nan")))
    assert [r.error_message for r in got.orderBy("ord").collect()] == [
        None, load.SALES_NOT_NUMBER, load.MISSING_ID, load.DUPLICATE_ID, None,
        load.SALES_MISSING, load.SALES_NOT_WHOLE,
    ]


def test_upsert_keeps_creation_and_last_change_wins(spark):
    schema = "customer_id string, sales bigint, created int, updated int"
    target = spark.createDataFrame([("a", 1, 1, 1), ("b", 2, 1, 1)], schema)
    changes = spark.createDataFrame(
        [("b", 20, 5, 5, "s1"), ("b", 30, 6, 6, "s2"), ("c", 4, 5, 5, "s1"), ("c", 5, 6, 6, "s2")],
        schema + ", seq string",
    )
    got = merge.fold_upserts(target, changes, ["customer_id"], "seq", created="created")
    assert sorted(map(tuple, got.collect())) == [("a", 1, 1, 1), ("b", 30, 1, 6), ("c", 5, 5, 6)]
    again = merge.fold_upserts(got, changes, ["customer_id"], "seq", created="created")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_upsert_can_set_null(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v bigint")
    source = spark.createDataFrame([("a", None)], "k string, v bigint")
    assert merge.upsert(target, source, ["k"]).first().v is None


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_asof_equals_brute_force(spark, ranges):
    rnd = random.Random(3)
    left = [(rnd.choice(["j0", "j0", "j0", "j1", None]), i, rnd.choice([None, *range(0, 900, 3)])) for i in range(200)]
    left += [("j0", 200 + i, 450) for i in range(50)]  # a hot moment
    right = [(rnd.choice(["j0", "j0", "j1", "j2", None]), i, rnd.choice([None, *range(0, 900, 7)])) for i in range(60)]
    left_rows = spark.createDataFrame(left, "job string, i int, s bigint").withColumn("at", F.timestamp_seconds("s"))
    right_rows = spark.createDataFrame(right, "job string, run int, s bigint")
    right_rows = right_rows.withColumn("started", F.timestamp_seconds("s")).drop("s")
    settings = {"spark.sql.shuffle.partitions": str(ranges), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = first_at_or_after(left_rows, right_rows, "job", "at", "started", ["started", "run"], 30_000).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.i for r in got) == list(range(250))
    for r in got:
        known = r.s is not None and r.job is not None
        later = sorted((s, run) for job, run, s in right if known and s is not None and job == r.job and s >= r.s - 30)
        assert r.run == (later[0][1] if later else None)


def test_asof_without_rows(spark):
    left = spark.createDataFrame([], "job string, at timestamp")
    right = spark.createDataFrame([], "job string, started timestamp, run int")
    assert first_at_or_after(left, right, "job", "at", "started", ["run"]).count() == 0
    one = spark.createDataFrame([("a",)], "job string").withColumn("at", F.current_timestamp())
    assert first_at_or_after(one, right, "job", "at", "started", ["run"]).first()["run"] is None


def test_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "x")], "id int, k string")
    parent = spark.createDataFrame([("a",), ("b",)], "pk string")
    assert sorted(r.id for r in checks.orphans(child, "k", parent, "pk").collect()) == [2, 4]
    assert sorted(r.id for r in checks.orphans(child, "k", parent, "pk", True).collect()) == [2, 3, 4]
    assert checks.orphan_count(child, "k", parent, "pk").first()[0] == 2


def test_duplicate_keys_are_spread_by_rows(spark, monkeypatch):
    monkeypatch.setattr(checks, "KEYS_PER_TASK", 250, raising=False)
    keys = [(k % 997,) for k in range(1994)] + [(None,), (None,), (5000,)]
    found = checks.duplicate_keys(spark.createDataFrame(keys, "k bigint"), "k")
    parts = found.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(parts) == 8 and max(r["n"] for r in parts) < 250  # adaptive execution does not merge them
    assert {tuple(r) for r in found.collect()} == {(k, 2) for k in [*range(997), None]}
    first = checks.duplicate_sample(spark.createDataFrame(keys, "k bigint"), "k", 3)
    assert [tuple(r) for r in first.collect()] == [(None, 2), (0, 2), (1, 2)]


def test_empty_table_checksum(spark):
    import hashlib

    empty = spark.createDataFrame([], "id bigint")
    row = checks.table_checksum(empty, "id").first()
    assert row.checksum == hashlib.md5(b"0|None|None|None").hexdigest()


def test_status_mismatch_keeps_every_pair(spark):
    t = {
        "orders": spark.createDataFrame([(1, "n", "DELIVERED"), (2, "m", "SHIPPED")], "order_id int, order_number string, order_status string"),
        "shipments": spark.createDataFrame([(1, "LOST"), (1, "LOST"), (1, None), (2, "IN_TRANSIT")], "order_id int, shipment_status string"),
        "payments": spark.createDataFrame([(1, "A"), (1, "A"), (1, "B")], "order_id int, payment_status string"),
    }
    got = {(r.shipment_status, r.payment_status): r.occurrences for r in order_checks.status_mismatch(t).collect()}
    assert got == {("LOST", "A"): 4, ("LOST", "B"): 2}


def test_suite_reports_errors_and_goes_on(spark):
    suite = checks.Suite(
        primary_keys=[("t", "id"), ("gone", "id")],
        not_null=[("t", "v"), ("t", "nope")],
        predicates={"positive": ("t", "v < 0")},
    )
    table = spark.createDataFrame([(1, 2), (1, None)], "id int, v int")
    report = {r.check_name: r for r in checks.run_suite(spark, suite, {"t": table}).collect()}
    assert report["t.id"].status == "FAIL" and report["t.id"].issue_count == 1
    assert report["gone.id"].status == "ERROR"
    assert report["t.nope"].status == "ERROR" and "nope" in report["t.nope"].error
    assert report["t.v"].status == "FAIL" and report["positive"].status == "PASS"
    total = checks.summarize(checks.run_suite(spark, suite, {"t": table})).first()
    assert (total.overall_status, total.passed_checks, total.failed_checks, total.errors) == ("FAIL", 1, 2, 2)


def test_a_check_that_fails_at_run_time_leaves_the_others(spark):
    def broken(tables):
        return tables["t"].where(F.raise_error(F.lit("torn file")).isNotNull())

    suite = checks.Suite(
        primary_keys=[("t", "id")],
        not_null=[("t", "v")],
        predicates={"ratio": ("t", "id / (v - v) > 1"), "positive": ("t", "v < 0")},
        custom={"torn": broken},
    )
    table = spark.createDataFrame([(1, 2), (1, 3)], "id int, v int")
    report = {r.check_name: r for r in checks.run_suite(spark, suite, {"t": table}).collect()}
    assert {n: r.status for n, r in report.items()} == {
        "t.id": "FAIL", "t.v": "PASS", "positive": "PASS", "ratio": "ERROR", "torn": "ERROR"
    }
    assert "zero" in report["ratio"].error and "torn file" in report["torn"].error
    assert report["ratio"].issue_count is None


def test_single_batch_check(spark):
    rows = spark.createDataFrame(
        [("u1", "a"), ("u1", None), ("u2", ""), ("u3", "a"), ("u3", "b")], "unit string, phase3_batch_id string"
    )
    got = {r.unit: r.error for r in load.single_batch_check(rows, "unit").collect()}
    assert got == {"u1": None, "u2": "no batch id", "u3": "several batch ids"}


def test_suite_size():
    s = order_checks.SUITE
    sizes = [len(s.primary_keys), len(s.foreign_keys), len(s.not_null), len(s.predicates) + len(s.custom)]
    assert sizes == [10, 11, 17, 5]


def test_join_groups_sorts_by_a_number_first(spark):
    rows = spark.createDataFrame([("a" * 64, i % 5, i) for i in range(50)], "k string, j long, id long")
    groups = rows.groupBy("k", "j").agg(F.count(F.lit(1)).alias("n"))
    got = skew.join_groups(rows, groups.hint("merge"), ["k", "j"], "n", F.col("id"))
    assert got.columns == ["k", "j", "id", "n"] and {r.n for r in got.collect()} == {10}
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [_hash" in plan
