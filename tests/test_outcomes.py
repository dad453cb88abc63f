"""T1 truth tables for the scoring rules (DOM-1, DOM-2) with hand-computed values.

Rise, delta 10, start price 100: stop 95, targets 105 / 109 / 110.
Fall, delta -10, start price 100: stop 105, targets 95 / 91 / 90.
Start 2024-01-01, end 2024-01-11 (10 days).
"""

import pytest

from conftest import d, ts
from tidemark.plans import outcomes

SCHEMA = ("case string, forecast_direction int, start_date date, end_date date, price_start double, "
          "price_delta_forecast double, price_end double, price_max_real double, price_max_date timestamp_ntz, "
          "price_min_real double, price_min_date timestamp_ntz, forecast_result smallint")
S, E = d("2024-01-01"), d("2024-01-11")


def day(n, hour=10):
    return ts(f"2024-01-{1 + n:02d} {hour:02d}:00:00")


ROWS = [
    # case, dir, ps, delta, pe, mx, mxd, mn, mnd
    ("R-1", 1, 100.0, 10.0, 103.0, 104.0, day(5), 94.0, day(3)),
    ("R-2", 1, 100.0, 10.0, 99.0, 104.0, day(5), 96.0, day(3)),
    ("R+1", 1, 100.0, 10.0, 103.0, 106.0, day(2), 96.0, day(4)),
    ("R+2", 1, 100.0, 10.0, 102.0, 104.0, day(2), 96.0, day(4)),
    ("R0", 1, 100.0, 10.0, 102.0, 105.0, day(2), 96.0, day(4)),
    ("R100", 1, 100.0, 10.0, 103.0, 111.0, day(0), 96.0, day(4)),
    ("Rtie", 1, 100.0, 10.0, 103.0, 106.0, day(3), 94.0, day(3)),
    ("F-1", 2, 100.0, -10.0, 101.0, 106.0, day(2), 96.0, day(4)),
    ("F-2", 2, 100.0, -10.0, 101.0, 104.0, day(2), 96.0, day(4)),
    ("F+1", 2, 100.0, -10.0, 98.0, 104.0, day(5), 94.0, day(2)),
    ("F+2", 2, 100.0, -10.0, 98.0, 104.0, day(5), 96.0, day(2)),
    ("F100", 2, 100.0, -10.0, 98.0, 104.0, day(5), 89.0, day(4)),
    ("Fpe=ps", 2, 100.0, -10.0, 100.0, 104.0, day(5), 96.0, day(2)),
    ("null", 1, None, 10.0, 103.0, 106.0, day(2), 96.0, day(4)),
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(c, dr, S, E, ps, dl, pe, mx, mxd, mn, mnd, 1) for c, dr, ps, dl, pe, mx, mxd, mn, mnd in ROWS]
    df = spark.createDataFrame(rows, SCHEMA)
    out = outcomes.score(df).select("case", "res50", "proc50", "res90", "proc90", "res100", "proc100").collect()
    return {r["case"]: r for r in out}


def check(r, expected):
    got = (r["res50"], r["proc50"], r["res90"], r["proc90"], r["res100"], r["proc100"])
    assert got[0::2] == expected[0::2]
    for g, e in zip(got[1::2], expected[1::2]):
        assert g == pytest.approx(e, abs=1e-12)


def test_rise_stop_loss(scored):
    # stop hit first (day 3 before the max on day 5): -0.5*10/3
    check(scored["R-1"], (-1, -5 / 3, 2, 3 / 10, 2, 3 / 10))


def test_rise_end_loss(scored):
    check(scored["R-2"], (-2, -1 / 10, -1, -1 / 10, -1, -1 / 10))


def test_rise_target(scored):
    # 106 > 105 on day 2: 0.5*10/2; 90 % and 100 % targets (109, 110) missed: end 3 % over 10 days
    check(scored["R+1"], (1, 2.5, 2, 0.3, 2, 0.3))


def test_rise_end_gain(scored):
    check(scored["R+2"], (2, 0.2, 2, 0.2, 2, 0.2))


def test_rise_exactly_on_target_is_code_zero(scored):
    # Q6: a max equal to the target is neither a hit nor a miss at exit 50
    check(scored["R0"], (0, 0.0, 2, 0.2, 2, 0.2))


def test_rise_same_day_hit_counts_one_day(scored):
    # max on the start date: 0 days become 1
    check(scored["R100"], (1, 5.0, 1, 9.0, 1, 10.0))


def test_rise_tied_dates_stop_loss_wins(scored):
    check(scored["Rtie"], (-1, -5 / 3, 2, 0.3, 2, 0.3))


def test_fall_stop_loss(scored):
    check(scored["F-1"], (-1, -2.5, -1, -0.1, -1, -0.1))


def test_fall_end_loss_reported_positive(scored):
    # Q5: the exit-50 loss keeps the sign of the price move (+0.1)
    check(scored["F-2"], (-2, 0.1, -1, -0.1, -1, -0.1))


def test_fall_target(scored):
    check(scored["F+1"], (1, 2.5, 2, 0.2, 2, 0.2))


def test_fall_end_gain(scored):
    check(scored["F+2"], (2, 0.2, 2, 0.2, 2, 0.2))


def test_fall_full_target(scored):
    # 89 < 90 on day 4: 1*10/4
    check(scored["F100"], (1, 1.25, 1, 2.25, 1, 2.5))


def test_fall_unchanged_price_is_loss_code(scored):
    # pe = ps without a hit: code -2 wins over 2
    check(scored["Fpe=ps"], (-2, 0.0, 2, 0.0, 2, 0.0))


def test_null_input_gives_null_outcome(scored):
    r = scored["null"]
    assert r["res50"] is None and r["proc100"] is None


def test_negate_loss_option(spark):
    row = [(c, dr, S, E, ps, dl, pe, mx, mxd, mn, mnd, 1) for c, dr, ps, dl, pe, mx, mxd, mn, mnd in ROWS
           if c == "F-2"]
    out = outcomes.score(spark.createDataFrame(row, SCHEMA), negate_loss=True).first()
    assert out["res50"] == -2 and out["proc50"] == pytest.approx(-0.1)


def test_scoring_stays_in_jvm(spark):
    df = spark.createDataFrame([(c, dr, S, E, ps, dl, pe, mx, mxd, mn, mnd, 1)
                                for c, dr, ps, dl, pe, mx, mxd, mn, mnd in ROWS], SCHEMA)
    plan = outcomes.score(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_evaluated_treats_zero_as_not_computed(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (3,)], "forecast_result smallint")
    assert sorted(r[0] for r in outcomes.evaluated(df).collect()) == [1, 3]
