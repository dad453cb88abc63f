"""Dyadic cells: the same rows as the other strategies, few cells for long spans, hot days spread out."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import ts
from tidemark.operators import spans

BASE = ts("2024-01-01 00:00:00")


def measures():
    t = F.col("t")
    return {"n_max": spans.Measure(F.col("v"), "max"), "n_min": spans.Measure(F.col("v"), "min"),
            "last_t": spans.Measure(t, "max"), "last_v": spans.Measure(F.col("v"), "max_by", "last_t")}


def run(spark, sp, rows, strategy):
    s = spark.createDataFrame(sp, "id int, k string, a timestamp_ntz, b timestamp_ntz")
    r = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int")
    out = spans.span_aggregate(s, r, key="k", span_id="id", lo=F.col("a"), hi=F.col("b"), time_col="t", measures=measures(), strategy=strategy)
    return sorted(map(tuple, out.collect()))


def plain(sp, rows):
    out = []
    for i, k, a, b in sp:
        hit = [(t, v) for rk, t, v in rows if rk == k and k is not None and None not in (a, b, t) and a <= t <= b]
        if hit:
            vs = [v for _, v in hit]
            out.append((i, max(vs), min(vs), *max(hit)))
    return sorted(out)


def test_dyadic_equals_the_others_on_skewed_rows(spark):
    rng = random.Random(5)
    day, units = 86400, (60, 2700, 21600, 86400)
    times = set()
    while len(times) < 1500:        # a third of the rows on one key and day, the rest over 60 days, some long before 1970
        hot = rng.random() < 0.34
        times.add(("hot" if hot else rng.choice("ab"), BASE + dt.timedelta(seconds=rng.randrange(day) if hot else rng.randrange(-3 * day, 60 * day))))
    times |= {("a", ts("1966-03-04 05:06:07")), ("a", ts("1967-01-01 00:00:00")), ("b", BASE)}
    rows = [(k, t, i) for i, (k, t) in enumerate(sorted(times))] + [("a", None, -1), (None, BASE, -2)]
    sp = []
    for i in range(400):
        unit = rng.choice(units)
        a = BASE + dt.timedelta(seconds=rng.randrange(-2 * day, 40 * day) // unit * unit)
        length = rng.choice([0, 2699, 2700, 2701, rng.randrange(day), *(rng.randrange(40 * day) for _ in range(6))])
        sp.append((i, rng.choice(["hot", "a", "b", "none"]), a, a + dt.timedelta(seconds=length, microseconds=rng.choice([0, 0, 1]))))
    sp += [(1000, "a", ts("1965-01-01 00:00:00"), ts("2030-01-01 00:00:00")), (1001, "a", BASE, BASE - dt.timedelta(seconds=1)),
           (1002, "a", None, BASE), (1003, None, BASE, BASE + dt.timedelta(days=9)), (1004, "b", BASE, BASE),
           (1005, "a", ts("1966-03-04 05:06:07"), ts("1966-12-31 23:59:59"))]
    want = plain(sp, rows)
    assert run(spark, sp, rows, "dyadic") == want and len(want) > 150
    assert run(spark, [s for s in sp if s[0] < 1000], rows, "rollup") == [w for w in want if w[0] < 1000]


def test_every_span_is_filled_once(spark):
    """The cells of a span cover it without gap or overlap; only its ends meet raw rows."""
    rng = random.Random(9)
    sp = [(i, BASE + dt.timedelta(microseconds=rng.randrange(10**13)), rng.choice([0, 10**6, 2700 * 10**6, 10**10, 10**12, 10**14])) for i in range(300)]
    df = spark.createDataFrame([(i, a, a + dt.timedelta(microseconds=rng.randrange(n) if n else 0)) for i, a, n in sp], "id int, a timestamp_ntz, b timestamp_ntz")
    parts = {spans.FIRST_PART + j: spans.DAY_MICROS // n for j, n in enumerate(spans.DAY_PARTS)}
    unit = spans.DAY_MICROS // spans.DAY_PARTS[-1]
    for r in df.select("a", "b", spans.span_cells(F.col("a"), F.col("b")).alias("cells")).collect():
        lo, hi = ((x - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for x in (r.a, r.b))
        ends = []
        for c in r.cells:
            size = unit if c._tier == spans.RAW else parts.get(c._tier) or spans.DAY_MICROS << c._tier
            s, e = c._cell * size, (c._cell + 1) * size
            assert c._tier == spans.RAW or lo <= s and e <= hi + 1
            ends.append((max(s, lo), min(e, hi + 1)))
        ends.sort()
        assert ends[0][0] == lo and ends[-1][1] == hi + 1 and all(x[1] == y[0] for x, y in zip(ends, ends[1:]))
        assert sum(c._tier == spans.RAW for c in r.cells) <= 2


def test_long_spans_meet_few_cells(spark):
    """2,000 days: about 2 log2 of that many cells, not 2,000 rows."""
    df = spark.createDataFrame([(i, BASE + dt.timedelta(minutes=7 * i), BASE + dt.timedelta(days=2000, minutes=11 * i)) for i in range(200)],
                               "id int, a timestamp_ntz, b timestamp_ntz")
    most = df.select(F.max(F.size(spans.span_cells(F.col("a"), F.col("b"))))).first()[0]
    assert most <= 2 * 11 + 2 * (3 + 7) + 2


def test_a_hot_day_is_spread(spark):
    """A third of all rows on one key and day: no task reads more than a small multiple of the median."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.timestamp_micros(F.when(F.col("id") % 3 == 0, F.col("id") * 2_880_000).otherwise(F.col("id") * 86_400_000)).cast("timestamp_ntz").alias("_t"),
        F.col("id").alias("v"))
    cells = spans.row_cells(rows, "k", [F.max("v").alias("v")], ["v"]).repartition(16, "k", "_tier", "_cell")
    n = sorted(r[0] for r in cells.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).select("n").collect())
    assert len(n) == 16 and n[-1] <= 3 * n[8]
    by_day = rows.repartition(16, "k", F.to_date("_t")).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    assert by_day.agg(F.max("n")).first()[0] >= 10000     # what one cell a day does


@pytest.mark.parametrize("strategy", spans.STRATEGIES)
def test_exploded_spans_are_not_broadcast(spark, strategy):
    """Spark takes a few spans of years to be small, whatever number of pieces they have."""
    s = spark.createDataFrame([(1, "a", BASE, BASE + dt.timedelta(days=700))], "id int, k string, a timestamp_ntz, b timestamp_ntz")
    r = spark.createDataFrame([("a", BASE, 1), ("a", BASE + dt.timedelta(days=3), 2)], "k string, t timestamp_ntz, v int")
    out = spans.span_aggregate(s, r, key="k", span_id="id", lo=F.col("a"), hi=F.col("b"), time_col="t", measures=measures(), strategy=strategy)
    out.collect()
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_long_spans_over_few_rows_take_the_cells_of_the_rows(spark):
    s = spark.createDataFrame([(1, "a", BASE - dt.timedelta(days=900, minutes=7), BASE + dt.timedelta(days=900, minutes=11)),
                               (2, "none", BASE, BASE)], "_id int, k string, _lo timestamp_ntz, _hi timestamp_ntz")
    r = spark.createDataFrame([("a", BASE + dt.timedelta(hours=5)), ("a", BASE + dt.timedelta(days=3, hours=5))], "k string, _t timestamp_ntz")
    cut = spans.within_rows(s, r, "k")
    assert [(x._id, x._lo, x._hi) for x in cut.collect()] == [(1, BASE, BASE + dt.timedelta(days=4, microseconds=-1))]
    assert cut.select(F.size(spans.span_cells(F.col("_lo"), F.col("_hi")))).first()[0] <= 4


@pytest.mark.parametrize("strategy", spans.STRATEGIES)
def test_extrema_read_from_their_keys(spark, strategy):
    """Prices and times come back exactly: negative and null prices, ties, times before 1970."""
    rng = random.Random(3)
    prices = [None, "-5.000001", "-0.000001", "0", "0.000001", "9999999999.999999", "-9999999999.999999", "7.5", "7.5"]
    price = lambda: (lambda p: p and Decimal(p))(rng.choice(prices))
    rows = [(k, ts("1969-12-25 00:00:00") + dt.timedelta(seconds=rng.randrange(14 * 86400), microseconds=rng.randrange(10**6)), price(), price())
            for k in "abc" for _ in range(40)] + [("null", ts("1970-01-01 00:00:00"), None, None)]
    r = spark.createDataFrame(rows, "k string, datetime_end timestamp_ntz, high_price decimal(16,6), low_price decimal(16,6)")
    begin = ts("1969-12-24 00:00:00")
    sp = [(i, k, begin + dt.timedelta(minutes=rng.randrange(15000)), begin + dt.timedelta(minutes=rng.randrange(30000))) for i, k in enumerate("abc" * 10)]
    s = spark.createDataFrame([*sp, (99, "null", begin, begin + dt.timedelta(days=30))], "id int, k string, a timestamp_ntz, b timestamp_ntz")
    given = dict(key="k", span_id="id", lo=F.col("a"), hi=F.col("b"), strategy=strategy)
    cols = ["id", "max_p", "max_t", "min_p", "min_t"]
    want = spans.span_aggregate(s, r, time_col="datetime_end", measures=spans.extrema_measures(), **given).select(*cols)
    got = spans.span_extrema(s, r, **given)
    assert got.schema == want.schema and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
