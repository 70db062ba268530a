import json
import os

from pyspark.sql import functions as F

from candlewick.sources import files
from candlewick.streaming.ingest import start_price_ingest

HEADER = "id,symbol,trade_date,open_price,high_price,low_price,close_price,volume,created_at\n"


def test_csv_keeps_infinity_ticker_and_coerces_bad_dates(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "stock_data")
    os.makedirs(folder)
    with open(os.path.join(folder, "INFINITY.csv"), "w") as f:
        f.write(HEADER)
        f.write("1,INFINITY,2020-01-02,1,2,0.5,1.5,100,2020-01-02T10:00:00+01:00\n")
        f.write("2,INFINITY,not-a-date,1,2,0.5,1.6,,2020-01-03T10:00:00+01:00\n")
    with open(os.path.join(folder, "GTCO.csv"), "w") as f:
        f.write(HEADER)
        f.write("3,,2020-01-02,1,2,0.5,30,5,2020-01-02T10:00:00Z\n")
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("not a price file\n")
    df = files.read_price_folder(spark, folder).orderBy("id").collect()
    assert [r.symbol for r in df] == ["INFINITY", "INFINITY", "GTCO"]   # text, file-name fallback
    assert df[0].trade_date is not None and df[1].trade_date is None
    assert df[1].volume is None


def test_sector_tree_and_payloads(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "stocks_sectors")
    for sector, names in {"agriculture": ["OKOMUOIL_ENGINEERED", "PRESCO.csv"],
                          "services_": ["ABC_x"]}.items():
        os.makedirs(os.path.join(root, sector))
        for n in names:
            open(os.path.join(root, sector, n), "w").write("x\n")
    tree = {(r.sector, r.symbol) for r in files.read_sector_tree(spark, root).collect()}
    assert tree == {("agriculture", "OKOMUOIL"), ("agriculture", "PRESCO"), ("services_", "ABC")}

    payloads = spark.createDataFrame(
        [(json.dumps({"prices": [{"symbol": "A", "trade_date": "2020-01-01", "close_price": 1.0}]}),),
         (json.dumps({"error": "no data"}),), ("{bad json",)], "value string")
    rows, rejects = files.explode_payload(payloads, "prices", files.PRICE_SCHEMA)
    assert rows.count() == 1 and rejects.count() == 2


def test_spines(spark):
    d = files.date_spine(spark, "2020-02-27", "2020-03-02").collect()
    assert len(d) == 5
    m = [r.date_text for r in files.month_end_spine(spark, "2017-01-15", "2017-04-30")
         .orderBy("date").collect()]
    assert m == ["2017-01-31", "2017-02-28", "2017-03-31", "2017-04-30"]


def test_streaming_ingest(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    for i, sym in enumerate(["AAA", "BBB"]):
        with open(os.path.join(landing, f"p{i}.json"), "w") as f:
            json.dump({"prices": [{"id": i, "symbol": sym, "trade_date": "2021-05-0%d" % (d + 1),
                                   "close_price": 1.0 + d} for d in range(3)]}, f)
    with open(os.path.join(landing, "empty.json"), "w") as f:
        json.dump({"stocks": []}, f)
    table, rej = os.path.join(tmpdir_path, "bars"), os.path.join(tmpdir_path, "rejects")
    q = start_price_ingest(spark, landing, table, rej,
                           checkpoint=os.path.join(tmpdir_path, "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    bars = spark.read.parquet(table)
    assert bars.count() == 6
    assert bars.where(F.col("trade_date").isNull()).count() == 0
    assert spark.read.parquet(rej).count() == 1


def test_symbol_batches_have_no_gaps_over_partitions(spark):
    from candlewick.sources import files
    names = [f"S{k:04d}" for k in range(137)]
    got = files.symbol_batches(spark.createDataFrame([(n,) for n in names * 2], "symbol string"), 10)
    assert sorted((r.symbol, r.batch) for r in got.collect()) == [(n, k // 10) for k, n in enumerate(names)]
    assert files.symbol_batches(got.limit(0).select("symbol"), 10).count() == 0


def test_lookup_first_takes_whole_rows(spark):
    from candlewick.operators.joins import lookup_first
    ref = spark.createDataFrame([("a", 2, 1.0, "x"), ("a", 1, 9.0, "z"), ("b", 5, None, "q")],
                                "k string, at int, v double, w string")
    assert sorted(map(tuple, lookup_first(ref, "k", ["v", "w"], "at").collect())) == [("a", 9.0, "z"), ("b", None, "q")]


def test_sector_tree_path_is_not_a_pattern(spark, tmp_path):
    from candlewick.sources import files
    root = tmp_path / "a.b (c)+" / "x"
    (root / "ICT").mkdir(parents=True)
    (root / "ICT" / "ABC_ENGINEERED").write_text("x")
    assert [tuple(r) for r in files.read_sector_tree(spark, str(root)).collect()] == [("ICT", "ABC")]


def test_macro_csv_feeds_the_alignment(spark, tmp_path):
    from candlewick.plans.macro import fill_year
    from candlewick.sources import files
    path = tmp_path / "macro_data(csv)"
    path.write_text("year,month,month_idx, oil price (USD), avg._monthly,gdp & co_quarterly,FR_Date\n"
                    "2017.0,January ,1,1.5,,01/31/2017\n,february,2,x,,02/28/2017\n"
                    ",march,3,2.5,7.25,\n2018.0,january,1,3,,13/45/2018\n".replace("1.5,,", "1.5,,,").replace("x,,", "x,,,")
                    .replace("2.5,7.25,", "2.5,,7.25,").replace("3,,13", "3,,,13"))
    df = files.read_macro(spark, str(path))
    assert df.columns == ["line_no", "year", "month", "month_idx", "oil price (USD)", "avg._monthly",
                          "gdp & co_quarterly", "FR_Date"]
    got = [tuple(r) for r in fill_year(df).orderBy("line_no").collect()]
    import datetime as dt
    assert got == [(1, 2017, "january", 1, 1.5, None, None, dt.date(2017, 1, 31)),
                   (2, 2017, "february", 2, None, None, None, dt.date(2017, 2, 28)),
                   (3, 2017, "march", 3, 2.5, None, 7.25, None),
                   (4, 2018, "january", 1, 3.0, None, None, None)]


def test_scan_routes_lines_that_do_not_parse_to_rejects(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "bars")
    for name, lines in {"symbol=007": ["1,,2020-01-02,1,2,0.5,1.5,100,", "2,,2020-01-03,1,2,0.5,n/a,100,"],
                        "symbol=INFINITY": ["3,,2020-01-02,1,2,0.5,7,5,"]}.items():
        os.makedirs(os.path.join(folder, name))
        with open(os.path.join(folder, name, "part-0.csv"), "w") as f:
            f.write(HEADER + "\n".join(lines) + "\n")
    rows, rejects = files.scan_price_folder(spark, folder, key_from="folder")
    got = {r.id: (r.symbol, r.close_price) for r in rows.collect()}
    assert got == {1: ("007", 1.5), 2: ("007", None), 3: ("INFINITY", 7.0)}
    assert [(r.symbol, r.file, r.line.split(",")[6]) for r in rejects.collect()] == [("007", "part-0.csv", "n/a")]


def test_sector_tree_reports_files_at_another_depth(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "tree")
    for p in ("a/X_1.csv", "a/Y.csv", "top.csv", "a/deep/Z_1.csv"):
        os.makedirs(os.path.dirname(os.path.join(root, p)), exist_ok=True)
        open(os.path.join(root, p), "w").write("x\n")
    members, rejects = files.scan_sector_tree(spark, root)
    assert {tuple(r) for r in members.collect()} == {("a", "X"), ("a", "Y")}
    assert {r.path.rsplit("/", 1)[1] for r in rejects.collect()} == {"top.csv", "Z_1.csv"}
    folders, _ = files.scan_sector_tree(spark, root, leaf="folder")
    assert [tuple(r) for r in folders.collect()] == [("a", "deep")]


def test_publish_is_idempotent_and_partitions_are_pruned(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    df = spark.createDataFrame([("007", 1), ("INFINITY", 2), ("A", 3)], "symbol string, v int")
    write = lambda d, p: files.write_partitioned(d, p, "symbol")
    files.publish(df, path, write)
    files.publish(df.where("v > 1"), path, write)                    # is there already: stays
    back = files.read_partitioned(spark, path, df.schema)
    assert {(r.symbol, r.v) for r in back.collect()} == {("007", 1), ("INFINITY", 2), ("A", 3)}
    assert not [n for n in os.listdir(tmpdir_path) if "draft" in n]
    plan = back.where("symbol = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and back.where("symbol = '007'").count() == 1


def test_a_date_range_reads_few_rows_of_a_clustered_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "clustered")
    files.write_by_range(spark.range(100_000).select((F.col("id") % 997).alias("d"), "id"), path, "d", 10)
    part = spark.read.parquet(path).where("d BETWEEN 100 AND 120")
    n = part.count()
    assert n == sum(1 for i in range(100_000) if 100 <= i % 997 <= 120)
    query = part.select("id", "d")
    plan = query._jdf.queryExecution().executedPlan()
    query._jdf.toLocalIterator().hasNext()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,100), LessThanOrEqual(d,120)]" in plan.toString()
    rows = query._jdf.queryExecution()
    rows.toRdd().count()
    leaves = rows.executedPlan().collectLeaves()
    read = sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    assert 0 < read < 100_000 / 2


def test_folders_of_few_bytes_are_written_by_several_tasks(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    keys = spark.range(300).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"), F.lit(1).alias("one"))
    files.write_partitioned(keys, path, ["a", "b"])
    found = [n for _, _, names in os.walk(path) for n in names if n.startswith("part-")]
    assert len(found) == 300 and len({n[:10] for n in found}) > 4       # one file a folder, of many tasks
    assert files.read_partitioned(spark, path, keys.schema).count() == 300


def _widest_stage(spark, group):
    status = spark.sparkContext.statusTracker()
    stages = [s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds]
    return max(status.getStageInfo(s).numTasks for s in stages)


def test_listing_a_tree_takes_few_tasks(spark, tmpdir_path):
    name, n = "spark.sql.sources.parallelPartitionDiscovery.parallelism", files.LISTING_TASKS + 50
    before = spark.conf.get(name)
    for k in range(n):
        os.makedirs(os.path.join(tmpdir_path, "a", f"T{k}_bars"))
        open(os.path.join(tmpdir_path, "a", f"T{k}_bars", "x.csv"), "w").write("x\n")
    spark.sparkContext.setJobGroup("tree-listing", "")
    try:
        members, _ = files.scan_sector_tree(spark, tmpdir_path, leaf="folder")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert _widest_stage(spark, "tree-listing") == files.LISTING_TASKS and spark.conf.get(name) == before
    assert {r.symbol for r in members.collect()} == {f"T{k}" for k in range(n)}


def test_symbol_of_a_row_is_cut_from_its_folder_without_a_pattern(spark, tmpdir_path):
    names = {"symbol=007": "007", "plain": "plain", "a=b=c": "c", "symbol=": "", "symbol=A B%2F": "A B%2F"}
    for name in names:
        os.makedirs(os.path.join(tmpdir_path, "k=v", name))
        with open(os.path.join(tmpdir_path, "k=v", name, "part-0.csv"), "w") as f:
            f.write("trade_date,volume\n2020-01-02,1\n")
    fields = [f for f in files.PRICE_FIELDS if f.name in ("trade_date", "volume")]
    rows = files.read_price_folder(spark, tmpdir_path, schema=files.StructType(fields), key_from="folder")
    read = rows.select("symbol")
    assert sorted(r.symbol for r in read.collect()) == sorted(names.values())
    assert "regexp" not in read._jdf.queryExecution().optimizedPlan().toString().lower()


def test_listing_price_folders_takes_few_tasks(spark, tmpdir_path):
    n = files.LISTING_TASKS + 50
    for k in range(n):
        os.makedirs(os.path.join(tmpdir_path, f"symbol=T{k}"))
    with open(os.path.join(tmpdir_path, "symbol=T7", "part-0.csv"), "w") as f:
        f.write(HEADER + "1,,2020-01-02,1,2,0.5,1.5,100,\n")
    spark.sparkContext.setJobGroup("price-listing", "")
    try:
        rows = files.read_price_folder(spark, tmpdir_path, key_from="folder")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert _widest_stage(spark, "price-listing") == files.LISTING_TASKS
    assert [r.symbol for r in rows.collect()] == ["T7"]


def test_intermediate_tables_go_with_the_session(tmpdir_path):
    import subprocess
    import sys
    import time
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
from candlewick.session import cut_lineage
s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
     .config("spark.checkpoint.dir", {tmpdir_path!r}).getOrCreate())
t = cut_lineage(s.range(10))
import glob
assert t.count() == 10 and glob.glob({tmpdir_path!r} + "/**/part-*", recursive=True)
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
    for _ in range(100):                                  # the JVM ends after its Python process
        left = [f for _, _, names in os.walk(tmpdir_path) for f in names]
        if not left:
            break
        time.sleep(0.2)
    assert left == []
