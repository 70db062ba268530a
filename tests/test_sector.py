import datetime as dt

import pytest

from candlewick.plans import sector


def _d(i):
    return (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat()


def test_sector_daily_edge_cases(spark):
    bars = spark.createDataFrame([
        # A and B priced; C has no stock_info row (volume only); D trades alone on day 3
        ("A", _d(0), 10.0, 100.0), ("A", _d(1), 11.0, 100.0), ("A", _d(2), 11.0, None),
        ("B", _d(0), 20.0, 50.0), ("B", _d(1), 18.0, 50.0), ("B", _d(2), 18.0, 50.0),
        ("C", _d(1), 5.0, 7.0), ("C", _d(4), 5.0, 9.0),
        ("D", _d(3), 3.0, 1.0), ("D", "not-a-date", 4.0, 1.0),
    ], "symbol string, trade_date string, close_price double, volume double")
    members = spark.createDataFrame([("s", x) for x in "ABCD"], "sector string, symbol string")
    shares = spark.createDataFrame([("A", 1.0), ("B", 1.0), ("D", 2.0)],
                                   "symbol string, shares_outstanding double")
    out = {r.date.isoformat(): r for r in
           sector.sector_daily(bars, members, shares).collect()}
    # day 0: both first bars, returns null -> 0.0 and index 100
    assert out[_d(0)].weighted_sector_returns == 0.0 and out[_d(0)].sector_index == 100.0
    assert out[_d(0)].n_stocks_contributing == 2.0
    # day 1: caps 11 and 18 -> (10% * 11 + (-10%) * 18) / 29
    exp = (10.0 * 11 + (-10.0) * 18) / 29
    assert out[_d(1)].weighted_sector_returns == pytest.approx(exp)
    assert out[_d(1)].n_stocks_contributing == 2.0
    assert out[_d(1)].sector_volume == 157.0          # C's volume counts, its return does not
    assert out[_d(1)].sector_index == pytest.approx(100 * (1 + exp / 100))
    # day 2: A's volume is null -> sum of the rest; unchanged prices -> 0 return
    assert out[_d(2)].sector_volume == 50.0 and out[_d(2)].weighted_sector_returns == 0.0
    # day 3: one member only (D's first bar) ; day 4: only C traded -> no priced member -> dropped
    assert out[_d(3)].n_stocks_contributing == 1.0
    assert _d(4) not in out
    # the bad date row is dropped from every aggregate
    assert len(out) == 4
