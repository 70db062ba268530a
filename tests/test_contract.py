import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from compare import compare, duckdb_views
from conftest import SF01

# every query of the core library that has an oracle; those of the document operators are
# compared in tests/llm
CHECKED = [q for q in E.oracle_sql() if not q.startswith("op") and q != "pipeline"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "stock_RSI" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    duckdb_views(con, SF01)
    got = E.queries()[name](spark, SF01).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    r = compare(got, exp)
    assert r["values_match"], r


def test_long_symbol_keys_stay_distinct(spark):
    from candlewick.sources import standins as S
    ids = [7, 99_999, 100_000, 100_001, 100_002]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "k long")
           .select(S.symbol_of(F.col("k"))).collect()]
    assert got == ["T00007", "T99999", "T100000", "T100001", "T100002"]
    members = S.sector_members(spark, SF01)
    assert members.count() == members.select("symbol").distinct().count()


def test_sector_index_stays_finite(spark):
    sx = E.queries()["sector_daily"](spark, SF01)
    bad = F.count_if(F.isnan("sector_index") | (F.abs("sector_index") == float("inf")) | F.isnull("sector_index"))
    assert sx.agg(bad).first()[0] == 0


def test_correlation_expands_no_pairs_before_its_shuffle(spark):
    from candlewick.operators import stats
    df = spark.createDataFrame([(1, 1.0, 2.0, float("nan")), (1, 2.0, 1.0, None)], "g int, a double, b double, c double")
    plan = stats.corr_screen(df, ["a", "b", "c"], 0.5, ["g"])._jdf.queryExecution().executedPlan().toString()
    # blocks of moments are formed before the one shuffle, which window and sums share
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("MapInArrow")


def test_unset_checkpoint_folder_is_an_error_on_a_cluster():
    from types import SimpleNamespace
    from candlewick.session import checkpoint_dir

    def fake(master):
        conf = SimpleNamespace(get=lambda *a: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: None, getConf=lambda: conf))
    for master in ("yarn", "spark://host:7077", "k8s://x"):
        with pytest.raises(ValueError):
            checkpoint_dir(fake(master))


def test_single_reader_queries_write_nothing_while_they_are_built(spark, monkeypatch):
    monkeypatch.setattr(E, "cut_lineage", lambda df: pytest.fail("a table was written"))
    for name in ("training_frame", "corr_matrix", "describe", "label_counts", "holdout", "fold_report"):
        E.queries()[name](spark, SF01)


def test_ticker_plan_has_one_symbol_exchange(spark):
    from candlewick.plans import ticker
    from candlewick.sources import standins as S
    plan = ticker.ticker_features(S.bars(spark, SF01))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    # one exchange for the (symbol, day) bar aggregation, one for the per-symbol windows
    assert text.count("Exchange hashpartitioning") == 2, text


def test_date_range_reaches_the_parquet_scan(spark):
    from candlewick.sources import standins as S
    b = S.bars(spark, SF01, start="1997-01-01", end="1997-12-31")
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan, plan
    assert "LessThan(l_shipdate" in plan
    # column pruning: only the six used columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int," in plan
    days = b.selectExpr("min(trade_date) lo", "max(trade_date) hi").first()
    assert days.lo.isoformat() >= "1997-01-01" and days.hi.isoformat() <= "1997-12-31"
