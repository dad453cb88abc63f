"""DOM-5 parsing, DUP-6 / DUP-5 de-duplication, JON-7 known tickers, SRC-5 feed."""

import json

import pytest

from conftest import ts
from tidemark.plans import posts
from tidemark.sources import feeds

NL = "\n"


def block(ticker, pot="Потенциал роста 12.5%", term="Срок 30 дней", pct="В 64% случаев",
          ind="по сигналу индикатора RSI2"):
    return NL.join([f"Бумага Компания {{${ticker}}}", pot, term, pct, ind])


def items(spark, rows):
    return spark.createDataFrame(rows, "analyst_company_id int, external_id string, inserted string, text string")


def parse(spark, rows, hwm=None):
    return posts.parse_forecasts(items(spark, rows), hwm)


def test_good_block(spark):
    r = parse(spark, [(1, "p1", "2024-03-01T10:11:12.123456+03:00", "intro" + NL + block("SBER"))]).first()
    assert (r["ticker"], r["company"], r["forecast_direction"], r["price_delta_forecast"]) == ("SBER", "Компания ", 1, 12.5)
    assert (r["term"], r["success_procent"], r["indicator_name"]) == (30, 64, "RSI2")
    assert r["date_inserted"] == ts("2024-03-01 10:11:12")
    assert str(r["start_date"]) == "2024-03-01" and str(r["end_date"]) == "2024-03-31"
    assert r["block_pos"] == 1


def test_fall_block_is_negative(spark):
    r = parse(spark, [(1, "p1", "2024-03-01T10:00:00.0", block("GAZP", pot="Потенциал падения 7%"))]).first()
    assert r["forecast_direction"] == 2 and r["price_delta_forecast"] == -7.0


def test_two_blocks_in_one_post(spark):
    text = NL.join(["x", block("AAA"), "between", block("BBB", ind="по сигналу индикатора MACD1")])
    out = sorted((r["ticker"], r["block_pos"], r["indicator_name"]) for r in parse(spark, [(1, "p", "2024-01-01T00:00:00.0", text)]).collect())
    assert out == [("AAA", 1, "RSI2"), ("BBB", 7, "MACD1")]


def test_rejected_block_skips_its_five_lines(spark):
    # a decimal comma rejects the first block; the marker line inside its five
    # lines is not a block start; the block right after them is read.
    bad = NL.join(["Бумага Плохая {$BAD}", "Потенциал роста 1,5%", "Бумага Внутри {$INN}", "В 5% x", "y"])
    text = NL.join([bad, block("OK1")])
    rows = [(1, "p", "2024-01-01T00:00:00.0", text)]
    good = [(r["ticker"], r["block_pos"]) for r in parse(spark, rows).collect()]
    rejected = [(r["block_pos"], r["reason"]) for r in posts.rejected_blocks(items(spark, rows)).collect()]
    assert good == [("OK1", 5)]
    assert rejected == [(0, "bad_potential")]


def test_good_block_advances_one_line(spark):
    # after a good block the next line is examined again, so a marker inside
    # its five lines (here in the indicator line) starts another block
    text = NL.join(["Бумага A {$A1}", "Потенциал роста 3%", "Срок 5 дней", "В 50% x",
                    "по сигналу индикатора Бумага C {$C1}", "Потенциал роста 4%", "Срок 6 дней", "В 40% y",
                    "по сигналу индикатора Q"])
    rows = [(1, "p", "2024-01-01T00:00:00.0", text)]
    out = sorted((r["ticker"], r["block_pos"], r["indicator_name"]) for r in parse(spark, rows).collect())
    assert out == [("A1", 0, "Бумага C {$C1}"), ("C1", 4, "Q")]


def test_rejected_block_hides_marker_in_its_lines(spark):
    text = NL.join(["Бумага A {$A1}", "Бумага B {$B1}", "Потенциал роста 3%", "Срок 5 дней", "В 50% x",
                    "по сигналу индикатора Z"])
    rows = [(1, "p", "2024-01-01T00:00:00.0", text)]
    rej = [(r["block_pos"], r["reason"]) for r in posts.rejected_blocks(items(spark, rows)).collect()]
    assert parse(spark, rows).count() == 0 and rej == [(0, "no_potential")]


@pytest.mark.parametrize("text,reason", [
    (NL.join(["Бумага X {$X}", "Потенциал роста 5%", "Срок 3 дней"]), "short_block"),
    (block("Y").replace("{$Y}", "Y"), "no_security"),
    (block("Y", pot="Потенциал роста 5"), "no_potential"),
    (block("Y", pct="В много% x"), "bad_percent"),
    (block("Y", term="Срок 3дней"), "bad_term"),
    (block("Y", ind="по сигналу RSI"), "bad_indicator"),
])
def test_quarantine_reasons(spark, text, reason):
    rows = [(1, "p", "2024-01-01T00:00:00.0", text)]
    assert [r["reason"] for r in posts.rejected_blocks(items(spark, rows)).collect()] == [reason]
    assert parse(spark, rows).count() == 0


def test_newest_post_wins_per_key(spark):
    rows = [(1, "10", "2024-01-01T09:00:00.0", block("AAA", pot="Потенциал роста 1%")),
            (1, "11", "2024-01-01T15:00:00.0", block("AAA", pot="Потенциал роста 2%")),
            (2, "12", "2024-01-01T08:00:00.0", block("AAA", pot="Потенциал роста 3%")),
            (1, "13", "2024-01-02T08:00:00.0", block("AAA", pot="Потенциал роста 4%"))]
    out = sorted((r["analyst_company_id"], str(r["start_date"]), r["price_delta_forecast"])
                 for r in posts.latest_forecasts(parse(spark, rows)).collect())
    assert out == [(1, "2024-01-01", 2.0), (1, "2024-01-02", 4.0), (2, "2024-01-01", 3.0)]


def test_high_water_mark_is_exclusive(spark):
    rows = [(1, "a", "2024-01-01T10:00:00.0", block("AAA")), (1, "b", "2024-01-01T10:00:01.0", block("BBB"))]
    out = [r["ticker"] for r in parse(spark, rows, hwm=ts("2024-01-01 10:00:00")).collect()]
    assert out == ["BBB"]
    hw = spark.createDataFrame([(1, ts("2024-01-01 10:00:01"))], "analyst_company_id int, hwm timestamp_ntz")
    assert parse(spark, rows, hwm=hw).count() == 0


def test_new_indicators_and_known_tickers(spark):
    rows = [(1, "1", "2024-01-01T09:00:00.0", block("AAA", pct="В 40% x", ind="по сигналу индикатора NEW")),
            (1, "2", "2024-01-02T09:00:00.0", block("BBB", pct="В 70% x", ind="по сигналу индикатора NEW")),
            (1, "3", "2024-01-02T09:00:00.0", block("CCC", ind="по сигналу индикатора OLD"))]
    f = posts.latest_forecasts(parse(spark, rows))
    known = spark.createDataFrame([("OLD",)], "indicator_name string")
    assert [tuple(r) for r in posts.new_indicators(f, known).collect()] == [("NEW", 70)]
    stocks = spark.createDataFrame([("AAA",), ("CCC",)], "ticker string")
    assert sorted(r["ticker"] for r in posts.known_tickers(f, stocks).collect()) == ["AAA", "CCC"]
    assert [r["ticker"] for r in posts.unknown_tickers(f, stocks).collect()] == ["BBB"]


def test_post_feed_json(spark):
    pages = [json.dumps({"analyst_company_id": 1, "payload": {"items": [
        {"id": "9", "inserted": "2024-01-01T00:00:00.5Z", "content": {"text": block("ZZZ")}}], "nextCursor": "c"}}),
        json.dumps({"analyst_company_id": 1, "payload": {"items": []}}),
        json.dumps({"analyst_company_id": 1}),
        "not json"]
    df = spark.createDataFrame([(p,) for p in pages], "value string")
    it = feeds.post_items(df).collect()
    assert [(r["external_id"], r["inserted"]) for r in it] == [("9", "2024-01-01T00:00:00.5Z")]


def test_posts_stay_where_they_are_beside_the_last_runs(spark):
    """One last run a company: by an exchange all posts of a company would meet in one task."""
    rows = [(c, f"p{c}", "2024-03-01T10:00:00.0", block("SBER")) for c in (1, 2)]
    hwm = spark.createDataFrame([(1, ts("2024-03-02 00:00:00"))], "analyst_company_id int, hwm timestamp_ntz")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = posts.blocks(items(spark, rows), hwm)
        assert [r["external_id"] for r in out.collect()] == ["p2"]
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
