import os

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from candlewick.functions.columns import by_suffix, col, drop_checked, normalise_names
from candlewick.functions.nulls import info, null_counts
from candlewick.plans import ticker
from candlewick.sources import files

WEIRD = [" gdp_Fishing_quarterly", "A. GDP_AGRICULTURE(agric)_quarterly",
         "Exchange_Rate(USD-EOP)_monthly", "bank reserves, M&A_monthly"]


def test_extensionless_csv_and_weird_names(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "macro_data(csv)")
    with open(path, "w") as f:
        f.write(",".join(["month"] + [f'"{c}"' for c in WEIRD]) + "\n")
        f.write("january,1.5,,3,4\n")
        f.write("february,,2.5,NaN,5\n")
    schema = StructType([StructField("month", StringType())]
                        + [StructField(c, DoubleType()) for c in WEIRD])
    df = files.read_csv(spark, path, schema)
    assert df.count() == 2
    assert by_suffix(df, "_quarterly") == WEIRD[:2]
    i = {r.column: (r.non_null, r.dtype) for r in info(df).collect()}
    assert i[" gdp_Fishing_quarterly"] == (1, "double") and i["month"] == (2, "string")
    nulls = null_counts(df).first()
    assert nulls["Exchange_Rate(USD-EOP)_monthly"] == 1          # the NaN counts as missing
    assert df.select(F.sum(col("bank reserves, M&A_monthly"))).first()[0] == 9.0
    renamed = normalise_names(df)
    assert "gdp_Fishing_quarterly" in renamed.columns
    assert "A_GDP_AGRICULTURE(agric)_quarterly" in renamed.columns
    try:
        drop_checked(df, ["absent"])
        raise AssertionError("expected KeyError")
    except KeyError:
        pass


def test_clean_and_save_partitions_by_symbol(spark, tmpdir_path):
    # 60 bars: the MACD signal needs 34 before the first complete row survives dropna
    rows = [("gtco", d, 1.0 + d + (d % 3), 10.0) for d in range(60)]
    bars = (spark.createDataFrame(rows, "symbol string, d int, close_price double, volume double")
                 .withColumn("trade_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")))
                 .drop("d"))
    feats = ticker.ticker_features(bars, min_rows=None, ma_items=(5,), vol_items=(5,),
                                   lag_items=(1,), volume_items=(5,))
    out = os.path.join(tmpdir_path, "stocks_FE")
    ticker.clean_and_save(feats, out)
    assert os.path.isdir(os.path.join(out, "symbol=GTCO"))       # upper-cased key folder
    back = spark.read.parquet(out)
    assert back.count() == feats.count() > 0


def test_null_rows_are_dropped_by_columns_of_any_name(spark):
    from candlewick.functions.nulls import drop_all_null, drop_any_null
    names = ["A. b (c)_quarterly", "d`e", " f"]
    df = spark.createDataFrame([(1.0, None, 2.0), (None, None, 1.0), (1.0, 2.0, None)], "a double, b double, c double").toDF(*names)
    assert drop_any_null(df, names[:2]).count() == 1
    assert drop_all_null(df, names[:2]).count() == 2
    assert drop_any_null(df).count() == 0
