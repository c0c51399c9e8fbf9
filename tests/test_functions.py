"""Column expressions against the plain Python meaning of each rule."""

import hashlib
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from batchlake.functions import dates, digests, numbers, text

ALPHABET = ["a", "B", " ", "\t", "\n", "@", ".", "\x1c", "\x1f", "\xa0", "\u3000", "\x85", "1", "é"]
EMAIL = re.compile(r"[^@\s]+@[^@\s]+\.[^@\s]+")


def values(spark, items, name="v"):
    rows = [(i, v) for i, v in enumerate(items)]
    return spark.createDataFrame(rows, f"i int, {name} string")


def test_text_rules_match_python(spark):
    rnd = random.Random(5)
    items = ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 9))) for _ in range(4000)]
    items += ["a@b.c\n", " a@b.c ", "a@b.c\n\n", "a b@c.d", "a@@b.c", "@b.c", "a@b.", "a@b"]
    c = F.col("v")
    got = values(spark, items).select(
        "v",
        text.ustrip(c).alias("strip"),
        text.collapse(c).alias("collapse"),
        text.present(c).alias("present"),
        text.is_email(c).alias("email"),
    )
    for r in got.collect():
        assert r.strip == r.v.strip()
        assert r.collapse == " ".join(r.v.split())
        assert r.present == (r.v.strip() != "")
        assert r.email == bool(EMAIL.fullmatch(r.v.strip()))


def test_rules_are_never_null(spark):
    c = F.col("v")
    row = (
        values(spark, [None])
        .select(text.present(c), text.is_email(c), numbers.is_number(c), dates.date_unparsed(c))
        .first()
    )
    assert list(row) == [False, False, False, False]


@pytest.mark.parametrize(
    "raw, name",
    [
        ("  ada   LOVELACE ", "Ada Lovelace"),
        ("o'brien holdings", "O'brien Holdings"),
        ("Renée DUBOIS-LAPOINTE", "Renée Dubois-lapointe"),
        ("   ", None),
        (None, None),
    ],
)
def test_normalize_name(spark, raw, name):
    assert values(spark, [raw]).select(text.normalize_name(F.col("v"))).first()[0] == name


def test_normalize_email(spark):
    got = values(spark, [" Ada@X.ORG ", " ", None]).select(text.normalize_email(F.col("v")))
    assert [r[0] for r in got.collect()] == ["ada@x.org", None, None]


def test_null_tokens(spark):
    items = ["", "N/A", "None", "nan", "NaN", "null", " ", "na", "Nathan", None]
    got = values(spark, items).select("i", text.null_tokens(F.col("v")).alias("x"))
    kept = {items[r.i] for r in got.collect() if r.x is not None}
    assert kept == {" ", "na", "Nathan"}


def test_numbers(spark):
    good = {
        "5.": 5.0, " 12": 12.0, "1e3": 1000.0, "-250": -250.0, "0": 0.0, ".5": 0.5, "+7": 7.0,
        "2750.50": 2750.5, "inf": float("inf"), "-Infinity": float("-inf"), "1e400": float("inf"),
    }
    bad = ["1,500", "$5", "15%", "1d", "1f", "0x1A", "NaN", "nan", "TBC", "", "1_000", "--1", "1e"]
    got = values(spark, [*good, *bad]).select("v", numbers.parse_number(F.col("v")).alias("n"))
    for r in got.collect():
        assert r.n == good.get(r.v), r.v


def test_whole_numbers(spark):
    expected = {"1e3": 1000, "5.0": 5, "-3": -3, "2.5": None, "inf": None, "1e300": None, "x": None}
    got = values(spark, list(expected)).select("v", numbers.parse_whole(F.col("v")).alias("n"))
    assert {r.v: r.n for r in got.collect()} == expected


def test_sales_category_edges(spark):
    got = spark.createDataFrame(
        [(-1,), (0,), (499,), (500,), (999,), (1000,), (None,)], "s bigint"
    ).select("s", numbers.sales_category(F.col("s")).alias("c"))
    assert {r.s: r.c for r in got.collect()} == {
        -1: "Low", 0: "Low", 499: "Low", 500: "Medium", 999: "Medium", 1000: "High", None: None,
    }


def test_dates_match_python(spark):
    formats = ["%Y-%m-%d", "%m/%d/%y", "%m/%d/%Y", "%Y/%m/%d"]
    items = [
        "2026-07-01", "2026-7-1", "07/01/26", "7/1/69", "7/1/68", "12/31/99", "1/2/2024",
        "2024/2/29", "2023/2/29", "2026-13-01", "26-07-01", "1/2/024", "0000-01-01", " 2026-07-01 ",
        "x", "2026-07-01T00:00", "13/01/2024",
    ]

    def python(v):
        for f in formats:
            try:
                return datetime.strptime(v.strip(), f).date()
            except ValueError:
                pass
        return None

    got = values(spark, items).select(
        "v",
        dates.standardize_date(F.col("v")).alias("d"),
        dates.date_unparsed(F.col("v")).alias("bad"),
    )
    for r in got.collect():
        assert r.d == python(r.v), r.v
        assert r.bad == (python(r.v) is None), r.v


def test_event_timestamp(spark):
    items = ["2026-07-01T10:00:00Z", "2026-07-01T10:00:00+00:00", "2026-07-01T10:00:00+02:00", "no", None]
    got = values(spark, items).select(dates.event_timestamp(F.col("v"), "RUN"))
    assert [r[0] for r in got.collect()] == [
        "2026-07-01T10:00:00Z", "2026-07-01T10:00:00Z", "2026-07-01T10:00:00+02:00", "RUN", "RUN",
    ]


def test_partition_parts_use_the_texts_own_offset(spark):
    parts = dates.partition_parts(F.col("v"))
    row = values(spark, ["2026-01-01T00:30:00+05:00"]).select(
        *[c.alias(p) for p, c in parts.items()]
    ).first()
    assert row.asDict() == {"year": "2026", "month": "01", "day": "01"}


def test_safe_file_name(spark):
    items = ["C:\\temp\\a b.csv", "/x/y/Ünï.CSV", "plain.txt", "dir/../e$.csv"]
    got = values(spark, items).select(text.safe_file_name(F.col("v")))
    assert [r[0] for r in got.collect()] == ["a_b.csv", "_n_.CSV", None, "e_.csv"]


def test_checksum(spark):
    rows = spark.createDataFrame(
        [("b", "102", 600), ("b", "101", 500)], "batch_id string, customer_id string, sales bigint"
    )
    row = digests.batch_digests(rows).first()
    hashes = [int(hashlib.md5(t).hexdigest()[:15], 16) for t in (b"101:500", b"102:600")]
    assert row.source_checksum == f"2-{hashes[0] ^ hashes[1]}-{sum(hashes)}"
    assert row.records == 2


def test_digests_do_not_depend_on_order_or_partitions(spark):
    rows = spark.range(500).select(
        F.concat(F.lit("b"), F.col("id") % 3).alias("batch_id"),
        F.col("id").cast("string").alias("customer_id"),
        (F.col("id") * 7 % 101).alias("sales"),
    )
    one = digests.batch_digests(rows.coalesce(1)).collect()
    two = digests.batch_digests(rows.repartition(13).orderBy(F.desc("sales"))).collect()
    assert sorted(one) == sorted(two)


@pytest.mark.parametrize("parts", [1, 50])
def test_one_checksum_for_every_size(spark, parts):
    """However a large and a small batch are cut, their checksums stay; a changed row shows."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 29_990, "big").otherwise("small").alias("batch_id"),
        F.col("id").cast("string").alias("customer_id"),
        F.col("id").alias("sales"),
    )
    want = {r.batch_id: r.source_checksum for r in digests.batch_digests(rows).collect()}
    cut = digests.batch_digests(rows.repartition(parts))
    assert {r.batch_id: r.source_checksum for r in cut.collect()} == want
    assert "collect_list" not in cut._jdf.queryExecution().optimizedPlan().toString()
    changed = rows.withColumn("sales", F.when(F.col("customer_id") == "3", 99).otherwise(F.col("sales")))
    other = {r.batch_id: r.source_checksum for r in digests.batch_digests(changed).collect()}
    assert other["big"] != want["big"] and other["small"] == want["small"]


def test_printable_cells_take_the_plain_rules(spark):
    rnd = random.Random(11)
    letters = [chr(n) for n in range(0x1F, 0x81)] + [" ", "@", "."] * 12
    items = ["".join(rnd.choices(letters, k=rnd.randint(0, 12))) for _ in range(4000)]
    items += ["  a@b.c  ", "a@b..c", "a@.b", "a@b.c.", "a@b.c\x7f", "a  b", "a" * 9 + "@" + "b.c" * 9]
    c = F.col("v")
    general = rf"^[{text._WS}]*{text._ADDRESS}[{text._WS}]*\z"
    frame = values(spark, items + [None]).select(
        text.is_email(c).alias("email"),
        F.coalesce(c.rlike(general), F.lit(False)).alias("email_was"),
        text.collapse(c).alias("collapse"),
        F.regexp_replace(text.ustrip(c), f"[{text._WS}]+", " ").alias("collapse_was"),
    )
    for r in frame.collect():
        assert (r.email, r.collapse) == (r.email_was, r.collapse_was)
    for rule in (text.is_email(c), text.collapse(c)):
        assert "x7e]*" in rule._jc.toString().split("THEN")[0]  # the costly class is left to the cells that need it
