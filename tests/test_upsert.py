"""DOM-8 keyed upsert properties (T3) and the change table."""

import pytest

from conftest import ts
from tidemark import schemas
from tidemark.operators.upsert import DuplicateKeyError, assert_unique, upsert
from tidemark.sinks.tables import ChangeTable, compact

T0, T1, T2 = ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00"), ts("2024-01-03 00:00:00")
SCHEMA = "k string, v int, ev int, created_at timestamp_ntz, updated_at timestamp_ntz"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_update_untouched(spark):
    target = spark.createDataFrame([("a", 1, 10, T0, T0), ("b", 2, 20, T0, T0)], SCHEMA)
    batch = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    out = rows(upsert(target, batch, ["k"], T1))
    assert out == [("a", 1, 10, T0, T0), ("b", 3, 20, T0, T1), ("c", 4, None, T1, T1)]


def test_keep_columns_are_not_overwritten(spark):
    # Q20: re-ingested parsed rows must not reset evaluation columns
    target = spark.createDataFrame([("a", 1, 10, T0, T0)], SCHEMA)
    batch = spark.createDataFrame([("a", 5, None), ("n", 6, None)], "k string, v int, ev int")
    out = rows(upsert(target, batch, ["k"], T1, keep=["ev"]))
    assert out == [("a", 5, 10, T0, T1), ("n", 6, None, T1, T1)]


def test_idempotent(spark):
    target = spark.createDataFrame([("a", 1, 10, T0, T0), ("b", 2, 20, T0, T0)], SCHEMA)
    batch = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = upsert(target, batch, ["k"], T1)
    twice = upsert(once, batch, ["k"], T2)
    strip = lambda df: sorted(tuple(r) for r in df.drop("updated_at").collect())
    assert strip(once) == strip(twice)


def test_duplicate_batch_key_raises(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(DuplicateKeyError):
        assert_unique(batch, ["k"])


def test_change_table_replay_and_new_streams(spark, tmp_dir):
    t = ChangeTable(spark, f"{tmp_dir}/quotes", schemas.QUOTES, ["ticker", "datetime_start"])
    assert t.read().count() == 0

    def batch(*rows):
        return spark.createDataFrame(list(rows), "ticker string, datetime_start timestamp_ntz, volume int")

    def now():
        return sorted((r["ticker"], r["volume"], r["created_at"], r["updated_at"]) for r in t.read().collect())

    t.append(batch(("A", T0, 1), ("B", T0, 2)), "s", 0, T0)
    t.append(batch(("B", T0, 3)), "s", 1, T1)
    first = now()
    assert first == [("A", 1, T0, T0), ("B", 3, T0, T1)]
    t.append(batch(("B", T0, 3)), "s", 1, T1)                      # a replay replaces its own partition
    assert now() == first and t.changes().count() == 3
    t.append(batch(("A", T0, 9), ("C", T0, 4)), "again", 0, T2)    # a new checkpoint counts from 0 and loses nothing
    assert now() == [("A", 9, T0, T2), ("B", 3, T0, T1), ("C", 4, T2, T2)]
    assert ChangeTable(spark, t.root, schemas.QUOTES, t.keys).read().count() == 3      # opening a stored table keeps it
    small = compact(t, f"{tmp_dir}/small")
    assert sorted(map(tuple, small.read().collect())) == sorted(map(tuple, t.read().collect())) and small.changes().count() == 3
    with pytest.raises(DuplicateKeyError):
        t.append(batch(("D", T0, 1), ("D", T0, 2)), "s", 2, T2)


def test_change_table_keeps_the_newest_post(spark, tmp_dir):
    t = ChangeTable(spark, f"{tmp_dir}/f", schemas.FORECASTS, ["analyst_company_id", "ticker", "start_date"], order=["date_inserted"])

    def batch(at, term):
        return spark.createDataFrame([(1, "A", T0.date(), at, term)], "analyst_company_id int, ticker string, start_date date, date_inserted timestamp_ntz, external_id string")

    t.append(batch(T1, "new"), "s", 0, T1)
    t.append(batch(T0, "late"), "s", 1, T2)
    r = t.read().first()
    assert (r["external_id"], r["created_at"], r["updated_at"]) == ("new", T1, T1)


def test_older_record_never_overwrites_newer(spark):
    target = spark.createDataFrame([("a", 1, T1, T0, T0)], "k string, v int, t timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
    batch = spark.createDataFrame([("a", 9, T0), ("b", 2, T0)], "k string, v int, t timestamp_ntz")
    out = rows(upsert(target, batch, ["k"], T2, only_if_newer="t"))
    assert out == [("a", 1, T1, T0, T0), ("b", 2, T0, T2, T2)]
