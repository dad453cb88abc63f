"""Landed CSV with rejected lines, stored tables by key, code lists, first by id, indicator ids."""

import pytest

from conftest import SF_SMALL, d, ts
from tidemark import catalog, schemas
from tidemark.operators import quality
from tidemark.operators.dedup import first_by_id
from tidemark.operators.materialize import materialize_by_key
from tidemark.operators.upsert import upsert
from tidemark.plans import posts
from tidemark.sources import files

HEADER = ",".join(schemas.CRIME.fieldNames())
GOOD = "I{0},00619,Larceny,LARCENY,D14,808,,{1},2018,9,Sunday,13,1,ST,42.35,-71.13,loc"


def write(path, *lines):
    with open(path, "w") as fh:
        fh.write("\n".join((HEADER, *lines)) + "\n")


def test_rejected_lines_are_kept_and_counted(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", GOOD.format(1, "2018-09-02 13:00:00"), GOOD.format(2, "junk"), "I3,only two", GOOD.format(4, "2018-09-03") + ",one,too many")
    write(f"{tmp_dir}/b.csv", GOOD.format(5, "").replace("42.35", "north"))
    write(f"{tmp_dir}/c.csv")
    good, rejected, seen = files.land_incidents(spark, *(f"{tmp_dir}/{x}.csv" for x in "abc"))
    rows = {r.INCIDENT_NUMBER: r for r in good.collect()}
    assert sorted(rows) == ["I1", "I2", "I5"] and good.schema == schemas.CRIME
    assert rows["I1"].OCCURRED_ON_DATE == d("2018-09-02") and rows["I2"].OCCURRED_ON_DATE is None
    assert rows["I5"].Lat is None and rows["I5"].Long == -71.13
    assert {r.INCIDENT_NUMBER: r.line for r in rejected.collect()} == {"I3": "I3,only two", "I4": GOOD.format(4, "2018-09-03") + ",one,too many"}
    assert seen.get == {"lines": 5, "rejected": 2, "no_date": 2}


def test_mart_from_csv_equals_the_mart(spark):
    got, want = (sorted(map(tuple, catalog.QUERIES[q](spark, SF_SMALL).collect())) for q in ("district_mart_csv", "district_mart"))
    assert got == want and got


def rows(spark, given):
    return spark.createDataFrame(given, "k string, n int, v int, e int")


def stored(spark, given):
    t = rows(spark, given).selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' as created_at", "timestamp_ntz'2024-01-01 00:00:00' as updated_at")
    return t, materialize_by_key(t, "test", ["k", "n"], buckets=8)


@pytest.mark.parametrize("options", [{}, {"keep": ("e",)}, {"update": ["v"]}, {"only_if_newer": "v"}])
def test_stored_by_key_gives_the_same_rows(spark, options):
    t, by_key = stored(spark, [(f"k{i % 5}", i, i, None if i % 3 else i) for i in range(40)])
    batch = rows(spark, [(f"k{i % 5}", i, 50 - i, -i) for i in range(25, 60)])
    now = ts("2024-01-02 00:00:00")
    want = sorted(map(repr, upsert(t, batch, ["k", "n"], now, **options).collect()))
    got = upsert(by_key, batch, ["k", "n"], now, stored_by_key=True, **options)
    assert sorted(map(repr, got.collect())) == want and len(want) == 60
    part = batch.drop("e")      # a batch without one of the columns
    assert sorted(map(repr, upsert(by_key, part, ["k", "n"], now, stored_by_key=True).collect())) == \
        sorted(map(repr, upsert(t, part, ["k", "n"], now).collect()))


def test_the_stored_side_is_not_shuffled(spark):
    """With automatic broadcast off, the stored quotes are scanned once and never exchanged."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES["upsert_quotes"](spark, SF_SMALL)
        df.collect()
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
        lines = lines[:next((k for k, x in enumerate(lines) if "Initial Plan" in x), len(lines))]
        join = next(k for k, x in enumerate(lines) if "SortMergeJoin" in x and "FullOuter" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        children = [k for k in range(join + 1, len(lines)) if depth(lines[k]) == depth(lines[join]) + 3]
        left = lines[children[0]:children[1]]
        assert any("FileScan" in x and "Bucketed: true" in x for x in left) and not any("Exchange" in x for x in left)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_by_id_counts_numbers(spark):
    df = spark.createDataFrame([("A", "10", 1), ("A", "9", 2), ("A", "x", 3), ("B", None, 4), ("B", "7", 5), ("C", "b", 6), ("C", "a", 7)], "k string, id string, v int")
    got = {r.k: r.v for r in first_by_id(df, ["k"], "id").collect()}
    assert got["A"] == 2 and got["B"] == 5
    assert {r.k: r.v for r in first_by_id(df.filter("k = 'C'"), ["k"], "id").collect()} == {"C": 7}


def test_codes_of_forecasts(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (1, 4), (None, None), (2, -1)], "forecast_direction int, forecast_result int")
    assert sorted(map(tuple, quality.code_violations(df, quality.FORECAST_CODES).collect())) == [(1, 4), (2, -1), (3, 1)]


def test_indicator_ids(spark):
    f = spark.createDataFrame([("RSI1",), ("RSI1",), ("MACD",), (None,), ("new",)], "indicator_name string")
    ind = spark.createDataFrame([("RSI1", 50), ("MACD", 60)], "indicator_name string, success_proc int")
    got = [(r.indicator_name, r.indicator_id) for r in posts.with_indicator_ids(f, ind).collect()]
    ids = dict(got)
    assert len(got) == 5 and ids["new"] is None and ids[None] is None and ids["RSI1"] != ids["MACD"] and min(ids["RSI1"], ids["MACD"]) > 0
    assert quality.key_violations(posts.indicator_ids(ind), ["indicator_id"]).count() == 0
