import os
from datetime import timedelta
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.dataframe import DataFrame

from tablewright.plans import maintenance
from tablewright.plans.inventory import inventory_report, table_inventory
from tablewright.plans.jobs import export_tables, fan_out
from tablewright.plans.maintenance import compact_table, remove_superseded, table_files
from tablewright.sources import (
    create_table,
    drop_table,
    insert_select,
    read_csv_text,
    read_json_records,
    read_keyed,
    read_log,
    read_table,
    rebucket_keyed,
    register_path,
    upsert_keyed,
    write_collection,
    write_counted,
    write_parquet,
    write_relationalized,
    write_table,
)
from tablewright.functions import parse_double
from tablewright.operators import relationalize, resolve_choice
from tablewright.operators.relational import tagged_rows
from tablewright.sources.tables import is_at
from tablewright.streaming import incremental_load, read_loaded, reset_bookmark
from tablewright.plans.programs import SERVICE_LOG_PATTERN
from tablewright.session import fresh_path, remove_staged, shared_folder
from tablewright.sources.files import file_heads, read_csv_named
from tablewright.sources.keyed import divided, even_bits, parts_of
from tablewright.sources.schema import common_type
from tablewright.sources.tables import table_properties
from tablewright.streaming import store_load
from tests import fixtures
from tests.test_operators import tuples


def parquet_files(folder):
    return [p for p in Path(folder).rglob("*.parquet")]


# scans

def test_csv_is_text_with_quoted_commas_and_null_cells(spark, lake):
    df = read_csv_text(spark, lake["orders"])
    assert df.dtypes == [(c, "string") for c in fixtures.HEADER]
    expected = [tuple(v or None for v in row) for row in fixtures.orders()]
    assert tuples(df) == sorted(expected, key=repr)
    assert tuples(read_csv_text(spark, [lake["orders"]], fixtures.HEADER)) == tuples(df)
    assert df.filter(F.col("status") == "shipped, partial").count() == sum("partial" in r[3] for r in fixtures.orders())


def test_json_and_log_scans(spark, lake):
    assert dict(read_json_records(spark, lake["customers"]).dtypes)["loyalty_points"] == "variant"
    parsed, rejects = read_log(spark, lake["serverlog"], SERVICE_LOG_PATTERN)
    assert (parsed.count(), rejects.count()) == (9, 2)


def test_malformed_json_line_gives_a_row_of_nulls(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"a":1}\nnot json\n{"a":"x"}\n')
    df = read_json_records(spark, str(tmp_path / "j"))
    assert df.count() == 3 and df.filter("a is null").count() == 1


def test_registered_tables(spark, lake, db, tmp_path):
    assert read_table(spark, "raw", "orders").count() == 60
    customers = read_table(spark, "raw", "customers")
    assert dict(customers.dtypes)["address"] == "struct<city:string,zip:string>"
    spark.range(20).selectExpr("id", "id % 3 AS p").write.partitionBy("p").parquet(f"{tmp_path}/parts")
    register_path(spark, db, "parts", f"{tmp_path}/parts", "parquet")
    assert read_table(spark, db, "parts").count() == 20
    assert spark.sql(f"SHOW PARTITIONS {db}.parts").count() == 3
    register_path(spark, db, "parts", f"{tmp_path}/parts", "parquet")
    assert read_table(spark, db, "parts").count() == 20
    write_table(spark.range(3), db, "owned")
    with pytest.raises(ValueError, match="owns its files"):
        register_path(spark, db, "owned", f"{tmp_path}/parts", "parquet")
    assert read_table(spark, db, "owned").count() == 3
    with pytest.raises(ValueError):
        read_table(spark, db, "parts; drop table x")
    with pytest.raises(AnalysisException):
        read_table(spark, db, "nope")


# sinks

def test_write_table_partitioned_appends_and_follows_the_schema(spark, db, tmp_path):
    df = spark.createDataFrame([("a", 1.0, "2026-01-01"), ("b", 2.0, "2026-01-02")], "k string, x double, d string")
    write_table(df, db, "t", f"{tmp_path}/t", ["d"])
    write_table(df.withColumn("extra", F.lit(7)), db, "t", f"{tmp_path}/t", ["d"])
    out = read_table(spark, db, "t")
    assert dict(out.dtypes) == {"k": "string", "x": "double", "extra": "int", "d": "string"}
    first, second = "2026-01-01", "2026-01-02"
    assert tuples(out.select("k", "extra", "d")) == [
        ("a", 7, first), ("a", None, first), ("b", 7, second), ("b", None, second),
    ]
    write_table(df.select("d", "k"), db, "t", partition_by=["d"], mode="overwrite")
    assert tuples(read_table(spark, db, "t").select("k", "x")) == [("a", None), ("b", None)]
    with pytest.raises(TypeError):
        write_table(df.withColumn("x", F.lit("text")), db, "t", partition_by=["d"])
    with pytest.raises(ValueError):
        write_table(df, db, "t")
    with pytest.raises(ValueError):
        write_table(df, db, "t", f"{tmp_path}/elsewhere", ["d"])


def test_partition_columns_with_odd_names(spark, db, tmp_path):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "`order date` string, v int")
    for _ in range(2):
        write_table(df, db, "t", f"{tmp_path}/t", ["order date"])
    assert read_table(spark, db, "t").count() == 4
    assert compact_table(spark, db, "t") == 2
    assert tuples(read_table(spark, db, "t")) == [(1, "x"), (1, "x"), (2, "y"), (2, "y")]


def test_a_hot_partition_value_is_written_by_several_tasks(spark, db, tmp_path):
    sizes = {"advisoryPartitionSizeInBytes": "200k", "coalescePartitions.minPartitionSize": "50k"}
    for name, value in sizes.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    try:
        df = spark.range(0, 60000, 1, 6).selectExpr("sha2(cast(id as string), 256) AS s", "if(id % 3 = 0, 'hot', cast(id % 5 as string)) AS p")
        write_table(df, db, "t", f"{tmp_path}/t", ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {r["p"]: r["count"] for r in table_files(spark, db, "t").groupBy("p").count().collect()}
    assert files["hot"] > 2 and read_table(spark, db, "t").count() == 60000


def test_choices_are_not_written(spark, db, tmp_path):
    for df in (spark.sql("SELECT parse_json('1') AS v"), spark.sql("SELECT array(parse_json('1')) AS v")):
        with pytest.raises(TypeError, match="unresolved"):
            write_table(df, db, "t", f"{tmp_path}/t")
        with pytest.raises(TypeError):
            write_parquet(df, f"{tmp_path}/p")


def test_ddl(spark, db, tmp_path):
    for _ in range(2):
        create_table(spark, db, "t", "k string, x double, d string", f"{tmp_path}/t", {"note": "it's"}, ["d"])
    df = spark.createDataFrame([("2026-01-01", "a")], "d string, k string")
    insert_select(df, db, "t")
    insert_select(df, db, "t")
    assert tuples(read_table(spark, db, "t")) == [("a", None, "2026-01-01")] * 2
    insert_select(df, db, "t", overwrite=True)
    assert read_table(spark, db, "t").count() == 1
    with pytest.raises(ValueError):
        insert_select(df.withColumn("nope", F.lit(1)), db, "t")


def test_drop_keeps_files_and_purge_removes_rows(spark, db, tmp_path):
    for purge, rows in ((False, 3), (True, 0)):
        path = f"{tmp_path}/t{purge}"
        write_table(spark.range(3), db, "t", path)
        drop_table(spark, db, "t", purge)
        assert not spark.catalog.tableExists(f"{db}.t")
        assert spark.read.schema("id bigint").parquet(path).count() == rows
    drop_table(spark, db, "t")


def test_locations_are_compared_without_what_a_path_leaves_out():
    version = "0" * 32
    assert is_at("file:/a/b", "/a/b/") and is_at("hdfs://nn:8020/a/b", "/a/b") and is_at("s3://x/a", "s3://x/a/")
    assert is_at(f"hdfs://nn/a/b.v/{version}", "/a/b")
    assert not is_at("s3://x/a", "s3://y/a") and not is_at("hdfs://nn/a", "s3://nn/a") and not is_at("/a/b", "/a/bc")


def test_write_collection(spark, db, tmp_path):
    write_collection({"one": spark.range(1), "two": spark.range(2)}, db, str(tmp_path))
    assert [read_table(spark, db, t).count() for t in ("one", "two")] == [1, 2]


# keyed table

def test_upsert_replaces_whole_rows_and_only_touched_parts(spark, db, tmp_path):
    first = spark.createDataFrame([(f"k{i}", i, 0) for i in range(40)], "k string, a int, seq int")
    upsert_keyed(first, db, "t", "k", f"{tmp_path}/t", "seq", buckets=8)
    assert read_keyed(spark, db, "t").count() == 40
    before = {r[0] for r in table_files(spark, db, "t").select("file_path").collect()}
    batch = spark.createDataFrame([("k1", 5, "new"), ("k1", 4, "old"), ("k99", 1, "x")], "k string, seq int, b string")
    for _ in range(2):
        upsert_keyed(batch, db, "t", "k", f"{tmp_path}/t", "seq")
        rows = {r.k: (r.a, r.seq, r.b) for r in read_keyed(spark, db, "t").collect()}
        assert len(rows) == read_keyed(spark, db, "t").count() == 41
        # The put replaced k1 whole: its old attribute is gone.
        assert (rows["k1"], rows["k99"], rows["k2"]) == ((None, 5, "new"), (None, 1, "x"), (2, 0, None))
    after = {r[0] for r in table_files(spark, db, "t").select("file_path").collect()}
    assert len(before & after) >= len(before) - 2


def test_upsert_errors(spark, db, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    with pytest.raises(PySparkException, match="is NULL"):
        upsert_keyed(df, db, "t", "k", f"{tmp_path}/t")
    upsert_keyed(df.dropna(), db, "u", "k", f"{tmp_path}/u")
    with pytest.raises(ValueError):
        upsert_keyed(df.dropna(), db, "u", "v", f"{tmp_path}/u")
    with pytest.raises(TypeError):
        upsert_keyed(df.dropna().withColumn("v", F.lit("x")), db, "u", "k", f"{tmp_path}/u")
    upsert_keyed(df.dropna().limit(0), db, "u", "k", f"{tmp_path}/u")
    assert read_keyed(spark, db, "u").count() == 1


# incremental loads

def load(spark, db, tmp_path, transform=lambda df: df, ctx="src", **more):
    return incremental_load(
        spark, f"{tmp_path}/in", "`cust id` string, `order total` string, `order date` string, status string",
        lambda b: transform(b.withColumnsRenamed({"cust id": "k", "order total": "x", "order date": "d"})),
        db, "t", "job", ctx, f"{tmp_path}/state", f"{tmp_path}/t", ["d"], **more,
    )


def test_incremental_load(spark, db, tmp_path):
    def rows():
        return read_loaded(spark, db, "t").count()

    fixtures.write_orders(f"{tmp_path}/in", "1.csv", fixtures.orders(48))
    assert load(spark, db, tmp_path) == 1 and rows() == 48
    assert load(spark, db, tmp_path) == 0 and rows() == 48
    fixtures.write_orders(f"{tmp_path}/in", "2.csv", fixtures.orders(22, 12))
    # Old modification times must not make a new file invisible.
    old = Path(f"{tmp_path}/in/2.csv")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    assert load(spark, db, tmp_path) == 1 and rows() == 70
    expected = [(r[0], r[1] or None, r[3], r[2]) for r in fixtures.orders(48) + fixtures.orders(22, 12)]
    assert tuples(read_loaded(spark, db, "t")) == sorted(expected, key=repr)
    reset_bookmark(spark, "job", "src", f"{tmp_path}/state")
    assert load(spark, db, tmp_path) == 1 and rows() == 140
    assert load(spark, db, tmp_path) == 0 and rows() == 140
    assert load(spark, db, tmp_path, ctx="other", max_files_per_batch=1) == 2 and rows() == 210
    assert load(spark, db, tmp_path, ctx=None) == 1 and load(spark, db, tmp_path, ctx=None) == 1
    assert rows() == 350
    first_day = sum(row[2] == "2026-03-01" for row in fixtures.orders(48) + fixtures.orders(22, 12))
    assert spark.table(f"{db}.t").filter("d = '2026-03-01'").count() == 5 * first_day


def test_failed_load_is_repeated_and_not_doubled(spark, db, tmp_path):
    fixtures.write_orders(f"{tmp_path}/in", "1.csv", fixtures.orders(20))
    with pytest.raises(PySparkException):
        load(spark, db, tmp_path, lambda df: df.withColumn("boom", F.raise_error(F.lit("boom")).cast("string")))
    assert load(spark, db, tmp_path) == 1
    assert read_loaded(spark, db, "t").count() == 20


def test_load_that_dies_after_its_write_is_not_doubled(spark, db, tmp_path, monkeypatch):
    from tablewright.streaming import incremental

    fixtures.write_orders(f"{tmp_path}/in", "1.csv", fixtures.orders(20))
    store = incremental.store_load

    def store_and_die(*args):
        store(*args)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(incremental, "store_load", store_and_die)
    with pytest.raises(PySparkException):
        load(spark, db, tmp_path)
    assert read_loaded(spark, db, "t").count() == 20
    monkeypatch.setattr(incremental, "store_load", store)
    assert load(spark, db, tmp_path) == 1
    assert read_loaded(spark, db, "t").count() == 20


# maintenance, inventory, jobs

def small_files(spark, db, tmp_path, parts=()):
    df = spark.range(1000).selectExpr("id", "cast(id % 4 as string) AS p", "id * 7 % 100 AS x").repartition(12)
    write_parquet_small(df, db, f"{tmp_path}/t", parts)


def write_parquet_small(df, db, path, parts):
    (df.write.partitionBy(*parts) if parts else df.write).parquet(path)
    register_path(df.sparkSession, db, "t", path, "parquet")


@pytest.mark.parametrize("sort_by", [(), ("x",)])
@pytest.mark.parametrize("parts", [(), ("p",)])
def test_compaction_keeps_rows_and_leaves_few_files(spark, db, tmp_path, parts, sort_by):
    small_files(spark, db, tmp_path, parts)
    before = tuples(read_table(spark, db, "t"))
    assert table_files(spark, db, "t").count() >= 12
    expected = compact_table(spark, db, "t", sort_by=sort_by)
    assert expected == (4 if parts else 1)
    assert table_files(spark, db, "t").count() == expected
    assert tuples(read_table(spark, db, "t")) == before
    # Nothing is left to do, but a wish for an order is always met.
    assert compact_table(spark, db, "t", sort_by=sort_by) == (expected if sort_by else 0)
    # Appending and compacting again goes on from the new folder.
    write_table(read_table(spark, db, "t").limit(10), db, "t", partition_by=parts)
    assert compact_table(spark, db, "t") > 0
    assert len(tuples(read_table(spark, db, "t"))) == len(before) + 10


def test_compaction_splits_a_hot_partition_and_leaves_good_ones_alone(spark, db, tmp_path):
    df = spark.range(4000).selectExpr("id", "sha2(cast(id as string), 512) AS s", "if(id < 3900, 'hot', 'cold') AS p")
    df.repartition(10, "id").write.partitionBy("p").parquet(f"{tmp_path}/t")
    df.filter("id < 10").selectExpr("id", "s", "'good' AS p").coalesce(1).write.mode("append").partitionBy("p").parquet(f"{tmp_path}/t")
    register_path(spark, db, "t", f"{tmp_path}/t", "parquet")
    files = table_files(spark, db, "t")
    good = files.filter("p = 'good'").first().file_path
    hot = files.filter("p = 'hot'").agg(F.sum("file_size")).first()[0]
    compact_table(spark, db, "t", target_bytes=hot // 3)
    counts = {r["p"]: r["count"] for r in table_files(spark, db, "t").groupBy("p").count().collect()}
    assert counts["cold"] == 1 and 2 <= counts["hot"] <= 4
    assert table_files(spark, db, "t").filter("p = 'good'").first().file_path == good
    assert read_table(spark, db, "t").count() == 4010


def test_compaction_of_two_partition_columns_and_clashing_names(spark, db, tmp_path):
    df = spark.range(240).selectExpr("id AS needed", "id * 2 AS first", "id % 2 AS p", "id % 3 AS q").repartition(6)
    df.write.partitionBy("p", "q").parquet(f"{tmp_path}/t")
    register_path(spark, db, "t", f"{tmp_path}/t", "parquet")
    before = tuples(read_table(spark, db, "t"))
    assert compact_table(spark, db, "t") == 6 == table_files(spark, db, "t").count()
    assert tuples(read_table(spark, db, "t")) == before


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_a_sorted_file_is_strung_together_from_small_ranges(spark, db, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(maintenance, "_SORTED_ROWS", 50)
    small_files(spark, db, tmp_path, parts)
    before = tuples(read_table(spark, db, "t"))
    sizes, write = [], DataFrame.sortWithinPartitions

    def watched(df, *by):
        out = write(df, *by)
        sizes.extend(r[0] for r in out.groupBy(F.spark_partition_id(), *(["p"] if parts else [])).count().select("count").collect())
        return out

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", watched)
    assert compact_table(spark, db, "t", sort_by=("x", "id")) == (4 if parts else 1)
    assert sum(sizes) == 1000 and max(sizes) <= 150
    assert table_files(spark, db, "t").count() == (4 if parts else 1)
    rows = read_table(spark, db, "t").select("*", "_metadata.file_path", "_metadata.row_index")
    assert tuples(rows.drop("file_path", "row_index")) == before
    for file in {r.file_path for r in rows.collect()}:
        own = [(r.x, r.id) for r in sorted(rows.where(F.col("file_path") == file).collect(), key=lambda r: r.row_index)]
        assert own == sorted(own)


def test_compacting_partitions_sorts_nothing(spark, db, tmp_path, monkeypatch):
    """Spark sorts what it writes by partition columns, unless files of several may be open."""
    small_files(spark, db, tmp_path, ("p",))
    open_files, write = [], DataFrameWriter.partitionBy
    limit = "spark.sql.maxConcurrentOutputFileWriters"
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *columns: open_files.append(spark.conf.get(limit)) or write(self, *columns))
    assert compact_table(spark, db, "t") == 4
    assert open_files == ["1"] and spark.conf.get(limit) == "0"


def test_only_parquet_is_compacted(spark, lake):
    with pytest.raises(ValueError, match="csv"):
        compact_table(spark, "raw", "orders")


def test_compaction_with_odd_partition_values(spark, db, tmp_path):
    df = spark.createDataFrame([("a b:c/d%", 1), ("ü=1", 2), (None, 3)] * 4, "p string, x int").repartition(4, "x", F.rand(3))
    df.unionAll(df).write.partitionBy("p").parquet(f"{tmp_path}/t")
    df.write.mode("append").partitionBy("p").parquet(f"{tmp_path}/t")
    register_path(spark, db, "t", f"{tmp_path}/t", "parquet")
    before = tuples(read_table(spark, db, "t"))
    assert compact_table(spark, db, "t") == 3
    assert table_files(spark, db, "t").count() == 3
    assert tuples(read_table(spark, db, "t")) == before


def test_overwriting_and_purging_a_compacted_table(spark, db, tmp_path):
    small_files(spark, db, tmp_path, ("p",))
    compact_table(spark, db, "t")
    write_table(spark.range(6).selectExpr("id", "id AS x", "cast(id % 3 AS int) AS p"), db, "t", partition_by=["p"], mode="overwrite")
    assert tuples(read_table(spark, db, "t").select("id", "p")) == [(i, i % 3) for i in range(6)]
    compact_table(spark, db, "t")
    assert read_table(spark, db, "t").count() == 6
    drop_table(spark, db, "t", purge=True)
    assert not spark.catalog.tableExists(f"{db}.t")


def test_inventory(spark, db, tmp_path):
    small_files(spark, db, tmp_path, ("p",))
    write_table(spark.range(5).coalesce(1), db, "plain", f"{tmp_path}/plain")
    create_table(spark, db, "empty", "a int", f"{tmp_path}/empty")
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_text("x\n")
    register_path(spark, db, "lines", f"{tmp_path}/lines", "text")
    spark.sql(f"CREATE VIEW {db}.v AS SELECT 1 AS one")
    compact_table(spark, db, "t")
    rows = {r.table_name: r for r in table_inventory(spark, [db]).collect()}
    assert {t: (r.partitions, r.has_data, r.files) for t, r in rows.items()} == {
        "t": (4, True, 4), "plain": (0, True, 1), "empty": (0, False, 0), "lines": (0, True, 1), "v": (0, None, None),
    }
    assert rows["lines"].bytes == 2
    report = [r.value for r in inventory_report(table_inventory(spark, [db])).collect()]
    assert report[0].startswith(f"{db}.empty: 0 partitions") and report[0].endswith("no data at the location")
    assert len(report) == 5
    inventory_report(table_inventory(spark, [db])).write.text(f"{tmp_path}/report")
    assert spark.read.text(f"{tmp_path}/report").count() == 5


def test_inventory_after_the_files_are_gone(spark, db, tmp_path):
    write_table(spark.range(5), db, "gone", f"{tmp_path}/gone")
    (tmp_path / "gone").rename(tmp_path / "moved")
    assert table_inventory(spark, [db]).first().has_data is False


def test_export_tables(spark, lake, tmp_path):
    names = export_tables(spark, "raw", "processed", f"{tmp_path}/out")
    assert names == ["customers", "orders", "orders_bad", "serverlog"]
    assert tuples(read_table(spark, "processed", "orders")) == tuples(read_table(spark, "raw", "orders"))
    customers = read_table(spark, "processed", "customers")
    assert dict(customers.dtypes)["loyalty_points"] == "struct<long:bigint,double:double,string:string,boolean:boolean,struct:string,array:string>"
    assert customers.filter("loyalty_points.string = 'gold'").count() == 1


def test_fan_out_computes_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def mark(x):
        seen.add(1)
        return x

    df = spark.range(10).select(F.udf(mark, "bigint")("id").alias("id"))
    counts = fan_out(df, [lambda d: d.count(), lambda d: d.agg(F.sum("id")).first()[0]], str(tmp_path))
    assert counts == [10, 45] and seen.value == 10
    assert fan_out(df, [lambda d: d.agg(F.sum("id")).first()[0]] * 2) == [45, 45] and seen.value == 20
    assert not df.is_cached


# files that differ from each other

def _csv(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_columns_are_matched_by_header(spark, db, tmp_path):
    _csv(tmp_path / "in/a.csv", "cust id,order total,order date,status\nC1,1.5,2026-06-01,new\n")
    _csv(tmp_path / "in/b b.csv", "status,cust id,order total,extra,order date\n\"x, y\",C2,7.0,e,2026-06-02\n")
    _csv(tmp_path / "in/c.csv", "cust id,order total\nC3,2.5\n")
    _csv(tmp_path / "in/empty.csv", "")
    want = [("C1", "1.5", "2026-06-01", "new"), ("C2", "7.0", "2026-06-02", "x, y"), ("C3", "2.5", None, None)]
    columns = ["cust id", "order total", "order date", "status"]
    got = read_csv_text(spark, f"{tmp_path}/in", columns)
    assert got.columns == columns and sorted(map(tuple, got.collect())) == want
    assert set(read_csv_text(spark, f"{tmp_path}/in").columns) == {*columns, "extra"}
    assert load(spark, db, tmp_path) == 1
    loaded = read_loaded(spark, db, "t").select(*columns) if "cust id" in read_loaded(spark, db, "t").columns else read_loaded(spark, db, "t")
    assert loaded.count() == 3 and {r[0] for r in loaded.collect()} >= {"C1", "C2", "C3"}
    register_path(spark, db, "raw", f"{tmp_path}/in", "csv")
    with pytest.raises(Exception, match="CSV header"):
        read_table(spark, db, "raw").collect()
    _csv(tmp_path / "twice/a.csv", "a,a\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv_text(spark, f"{tmp_path}/twice")


def test_json_table_whose_fields_change(spark, db, tmp_path):
    _csv(tmp_path / "j/1.json", '{"a": 1, "n": 123456789012345678}\n')
    register_path(spark, db, "j", f"{tmp_path}/j", "json")
    assert dict(read_table(spark, db, "j").dtypes) == {"a": "bigint", "n": "bigint"}
    _csv(tmp_path / "j/2.json", '{"a": "x", "b": true, "n": 0.5, "big": 123456789012345678901234}\n')
    spark.catalog.refreshTable(f"{db}.j")
    df = read_table(spark, db, "j")
    assert dict(df.dtypes) == {"a": "variant", "b": "boolean", "n": "variant", "big": "decimal(24,0)"}
    rows = resolve_choice(df, choice="cast:string").collect()
    assert {(r.a, r.n, str(r.big)) for r in rows} == {("1", "123456789012345678", "None"), ("x", "0.5", "123456789012345678901234")}


def test_overwrite_and_purge_with_dynamic_partition_overwrite(spark, db, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(df, db, "t", f"{tmp_path}/t", ["p"])
        write_table(df.where("p = 'a'"), db, "t", partition_by=["p"], mode="overwrite")
        assert tuples(read_table(spark, db, "t")) == [(1, "a")]
        drop_table(spark, db, "t", purge=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert spark.read.schema("x int").parquet(f"{tmp_path}/t").count() == 0


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_table_over_files_that_are_there(spark, db, tmp_path, parts):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    write_table(df, db, "t", f"{tmp_path}/t", parts)
    drop_table(spark, db, "t")
    write_table(df.selectExpr("x + 2 AS x", "p"), db, "t", f"{tmp_path}/t", parts)
    assert sorted(r.x for r in read_table(spark, db, "t").collect()) == [1, 2, 3, 4]
    write_table(df, db, "t", f"{tmp_path}/t", parts, mode="overwrite")
    assert sorted(r.x for r in read_table(spark, db, "t").collect()) == [1, 2]


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_types_are_widened(spark, db, tmp_path, parts):
    write_table(spark.createDataFrame([(1, "a")], "x int, p string"), db, "t", f"{tmp_path}/t", parts)
    write_table(spark.createDataFrame([(1 << 40, "b")], "x bigint, p string"), db, "t", f"{tmp_path}/t", parts)
    write_table(spark.createDataFrame([(3, "b")], "x smallint, p string"), db, "t", f"{tmp_path}/t", parts)
    assert dict(read_table(spark, db, "t").dtypes)["x"] == "bigint"
    assert sorted(r.x for r in read_table(spark, db, "t").collect()) == [1, 3, 1 << 40]
    with pytest.raises(TypeError):
        write_table(spark.createDataFrame([("3", "b")], "x string, p string"), db, "t", f"{tmp_path}/t", parts)


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_compaction_notices_a_writer(spark, db, tmp_path, monkeypatch, parts):
    from tablewright.plans import maintenance

    small_files(spark, db, tmp_path, parts)
    listed, calls = maintenance.files_in_use, []

    def meanwhile(spark_, *names):
        calls.append(1)
        if len(calls) == 2:  # after the copy
            write_table(read_table(spark, db, "t").limit(5), db, "t", partition_by=parts)
        return listed(spark_, *names)

    monkeypatch.setattr(maintenance, "files_in_use", meanwhile)
    with pytest.raises(maintenance.ConcurrentWrite):
        compact_table(spark, db, "t")
    monkeypatch.undo()
    assert read_table(spark, db, "t").count() == 1005


def test_files_are_listed_without_reading_rows(spark, db, tmp_path):
    small_files(spark, db, tmp_path, ("p",))
    files = table_files(spark, db, "t")
    assert "parquet" not in files._jdf.queryExecution().executedPlan().toString().lower().replace("/t/", "")
    counted = table_files(spark, db, "t", rows=True)
    assert counted.agg(F.sum("rows")).first()[0] == 1000
    assert tuples(counted.drop("rows")) == tuples(files)


def test_inventory_of_relocated_partitions_and_empty_databases(spark, db, tmp_path):
    for name, text in (("t/p=1", "a\n1\n"), ("elsewhere", "a\n2\n")):
        _csv(tmp_path / name / "f.csv", text)
    spark.sql(f"CREATE TABLE {db}.t (a string, p string) USING csv OPTIONS (header 'true') PARTITIONED BY (p) LOCATION '{tmp_path}/t'")
    spark.sql(f"ALTER TABLE {db}.t ADD PARTITION (p = '1') PARTITION (p = '2') LOCATION '{tmp_path}/elsewhere'")
    row = table_inventory(spark, [db]).first()
    assert (row.partitions, row.files, row.has_data) == (2, 2, True)
    spark.sql(f"CREATE DATABASE {db}_empty LOCATION '{tmp_path}/none'")
    try:
        report = [r.value for r in inventory_report(table_inventory(spark, [db, f"{db}_empty"])).collect()]
    finally:
        spark.sql(f"DROP DATABASE {db}_empty")
    assert report[-1] == f"{db}_empty: no tables"


def test_a_large_part_is_written_by_several_tasks_and_parts_can_change(spark, db, tmp_path):
    df = spark.range(20_000).selectExpr("cast(id as string) AS k", "sha2(cast(id as string), 512) AS v")
    sizes = {"advisoryPartitionSizeInBytes": "200k", "coalescePartitions.minPartitionSize": "50k"}
    for name, value in sizes.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    try:
        for _ in range(2):
            upsert_keyed(df, db, "t", "k", f"{tmp_path}/t", buckets=1)
        assert table_files(spark, db, "t").count() > 3
    finally:
        for name in sizes:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    rebucket_keyed(spark, db, "t", f"{tmp_path}/t", 6)
    assert spark.sql(f"SHOW PARTITIONS {db}.t").count() == 6
    upsert_keyed(df.limit(10), db, "t", "k", f"{tmp_path}/t")
    assert read_keyed(spark, db, "t").count() == read_keyed(spark, db, "t").select("k").distinct().count() == 20_000


def test_export_again_when_a_class_appears(spark, db, tmp_path):
    _csv(tmp_path / "j/1.json", '{"a": 1}\n{"a": "x"}\n')
    register_path(spark, db, "j", f"{tmp_path}/j", "json")
    spark.sql(f"CREATE DATABASE {db}_out LOCATION '{tmp_path}/db'")
    try:
        export_tables(spark, db, f"{db}_out", f"{tmp_path}/out")
        _csv(tmp_path / "j/2.json", '{"a": true}\n')
        spark.catalog.refreshTable(f"{db}.j")
        export_tables(spark, db, f"{db}_out", f"{tmp_path}/out", mode="overwrite")
        assert {(r.a.long, r.a.string, r.a.boolean) for r in read_table(spark, f"{db}_out", "j").collect()} == {(1, None, None), (None, "x", None), (None, None, True)}
    finally:
        spark.sql(f"DROP DATABASE {db}_out CASCADE")


def test_log_view_matches_a_line_once(spark, lake):
    from tablewright.sources import register_log

    register_log(spark, "raw", "typed", lake["serverlog"], SERVICE_LOG_PATTERN)
    plan = read_table(spark, "raw", "typed").select("level", "amount")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(value") == 1
    parsed, _ = read_log(spark, lake["serverlog"], SERVICE_LOG_PATTERN)
    assert tuples(read_table(spark, "raw", "typed")) == tuples(parsed)


# schemas that grow

def _type(text):
    return T.DataType.fromDDL(text)


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("float", "int", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"),
        ("struct<a:int,b:string>", "struct<B:string,c:date,A:bigint>", "struct<a:bigint,b:string,c:date>"),
        ("array<struct<a:int>>", "array<struct<a:int,b:array<int>>>", "array<struct<a:int,b:array<int>>>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("void", "struct<a:int>", "struct<a:int>"),
    ],
)
def test_common_types(a, b, want):
    assert common_type(_type(a), _type(b)).simpleString().lower() == want
    assert common_type(_type(b), _type(a)).simpleString().replace("B:", "b:").lower().count(":") == want.count(":")


@pytest.mark.parametrize(("a", "b"), [("bigint", "double"), ("string", "int"), ("struct<x:string>", "struct<x:int>"), ("array<int>", "int"), ("decimal(38,0)", "decimal(38,10)")])
def test_types_without_a_common_one(a, b):
    with pytest.raises(TypeError, match="no type holds both"):
        common_type(_type(a), _type(b), "c")


@pytest.mark.parametrize("path", [True, False])
def test_nested_growth_keeps_rows_and_properties(spark, db, tmp_path, path):
    where = f"{tmp_path}/t" if path else None
    location = f"LOCATION '{where}'" if path else ""
    spark.sql(
        f"CREATE TABLE {db}.t (s STRUCT<a: INT> COMMENT 'what it is', xs ARRAY<STRUCT<n: INT>>, m MAP<STRING, INT>, p STRING) USING parquet "
        f"PARTITIONED BY (p) {location} TBLPROPERTIES ('owner_team' = 'sales')"
    )
    first = spark.sql("SELECT named_struct('a', 1) AS s, array(named_struct('n', 1), NULL) AS xs, map('k', 1) AS m, 'x' AS p")
    write_table(first, db, "t", partition_by=["p"])
    large = 1 << 40
    second = spark.sql(
        f"SELECT 'y' AS p, map('k', {large}L) AS m, array(named_struct('more', 'z', 'n', {large}L)) AS xs, named_struct('b', 'new', 'a', {large}L) AS s, 7 AS extra"
    )
    write_table(second, db, "t", partition_by=["p"])
    write_table(first, db, "t", partition_by=["p"])
    out = read_table(spark, db, "t")
    assert out.schema.simpleString() == (
        "struct<s:struct<a:bigint,b:string>,xs:array<struct<n:bigint,more:string>>,m:map<string,bigint>,extra:int,p:string>"
    )
    old = ((1, None), [(1, None), None], {"k": 1}, None, "x")
    assert tuples(out) == sorted([old, old, ((large, "new"), [(large, "z")], {"k": large}, 7, "y")], key=repr)
    assert table_properties(spark, f"{db}.t")["owner_team"] == "sales"
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {db}.t").collect()}
    assert comments["s"] == "what it is"
    with pytest.raises(TypeError, match="s.a"):
        write_table(second.withColumn("s", F.struct(F.lit("text").alias("a"))), db, "t", partition_by=["p"])


def test_partition_types_of_files_that_are_there(spark, db, tmp_path):
    df = spark.createDataFrame([(1, 7, "007", None), (2, 8, "8", 5)], "x int, n int, code string, k int")
    write_table(df, db, "t", f"{tmp_path}/t", ["n", "code", "k"])
    drop_table(spark, db, "t")
    again = spark.createDataFrame([(3, 9, 9, 6)], "x int, n int, code int, k int")
    write_table(again, db, "t", f"{tmp_path}/t", ["n", "code", "k"])
    out = read_table(spark, db, "t")
    # 007 is no number that Spark would spell so.
    assert dict(out.dtypes) == {"x": "int", "n": "int", "code": "string", "k": "int"}
    assert tuples(out) == [(1, 7, "007", None), (2, 8, "8", 5), (3, 9, "9", 6)]
    with pytest.raises(TypeError, match="'n'"):
        write_table(again.withColumn("n", F.lit("text")), db, "t", partition_by=["n", "code", "k"])


def test_files_with_different_columns_become_a_table(spark, db, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/t")
    spark.createDataFrame([(2, True)], "x int, z boolean").write.mode("append").parquet(f"{tmp_path}/t")
    write_table(spark.createDataFrame([(1 << 40,)], "x bigint"), db, "t", f"{tmp_path}/t")
    assert tuples(read_table(spark, db, "t").select("x", "y", "z")) == [(1, "a", None), (1 << 40, None, None), (2, None, True)]


def test_a_replayed_load_replaces_all_of_it_under_dynamic_overwrite(spark, db, tmp_path):
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "dynamic")
    try:
        df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
        store_load(df, db, "t", f"{tmp_path}/t", ["p"], "one")
        store_load(df, db, "t", f"{tmp_path}/t", ["p"], "two")
        store_load(df.where("p = 'a'"), db, "t", f"{tmp_path}/t", ["p"], "one")
        assert spark.conf.get(mode) == "dynamic"
    finally:
        spark.conf.unset(mode)
    assert tuples(spark.table(f"{db}.t").select("load_id", "x")) == [("one", 1), ("two", 1), ("two", 2)]


# the census of JSON files

def test_only_new_files_are_looked_into(spark, db, tmp_path):
    _csv(tmp_path / "j/1.json", '{"a": 1 , "l": [{"n": 1}]}\n')
    register_path(spark, db, "j", f"{tmp_path}/j", "json")
    assert dict(read_table(spark, db, "j").dtypes) == {"a": "bigint", "l": "array<struct<n:bigint>>"}
    # Another text of the same length and time would be noticed by reading it only.
    first = tmp_path / "j/1.json"
    seen = first.stat()
    first.write_text('{"a":"x", "l": [{"n": 1}]}\n')
    os.utime(first, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    _csv(tmp_path / "j/2.json", '{"a": 2, "l": [{"n": 0.5, "m": [123456789012345678, 0.5]}]}\n')
    _csv(tmp_path / "j/empty.json", "")
    spark.catalog.refreshTable(f"{db}.j")
    assert dict(read_table(spark, db, "j").dtypes) == {"a": "bigint", "l": "array<struct<m:array<variant>,n:variant>>"}
    os.utime(first, (2_000_000_000, 2_000_000_000))
    spark.catalog.refreshTable(f"{db}.j")
    assert dict(read_table(spark, db, "j").dtypes)["a"] == "variant"
    first.unlink()
    spark.catalog.refreshTable(f"{db}.j")
    assert dict(read_table(spark, db, "j").dtypes)["a"] == "bigint"
    assert read_table(spark, db, "j").count() == 1


def test_census_of_a_path(spark, tmp_path):
    _csv(tmp_path / "j/1.json", '{"a": {"b": [[1], [2, "x"]]}}\n')
    for _ in range(2):
        df = read_json_records(spark, f"{tmp_path}/j", census=f"{tmp_path}/census")
        assert df.dtypes == [("a", "struct<b:array<array<variant>>>")]
    deep = '{"v": ' * 9 + "1" + "}" * 9
    _csv(tmp_path / "j/2.json", deep + "\n")
    df = read_json_records(spark, f"{tmp_path}/j", census=f"{tmp_path}/census")
    assert dict(df.dtypes)["v"].count("struct<v:") == 8
    _csv(tmp_path / "none/1.json", "[1, 2]\n")
    with pytest.raises(ValueError, match="no JSON objects"):
        read_json_records(spark, f"{tmp_path}/none")


# headers and loads

def test_headers_come_from_the_heads_of_files(spark, tmp_path):
    import gzip

    _csv(tmp_path / "in/a b,ü.csv", "\ufeffx,y\r\n1,2\r\n")
    (tmp_path / "in/z.csv.gz").write_bytes(gzip.compress(b"x,y\n3,4\n"))
    _csv(tmp_path / "in/empty.csv", "")
    assert {r.head for r in file_heads(spark, f"{tmp_path}/in").collect()} == {"x,y"}  # Spark lists no empty file
    df = read_csv_named(spark, f"{tmp_path}/in", "x int, y int")
    assert tuples(df) == [(1, 2), (3, 4)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "text" not in plan.replace(str(tmp_path), "").lower()


def test_headers_where_python_cannot_open_the_store(spark, tmp_path, monkeypatch):
    from tablewright.sources import files

    _csv(tmp_path / "in/a.csv", "x,y\n1,2\n")
    _csv(tmp_path / "in/b.csv", "\ufeffy,x\n4,3\n")
    nothing = lambda batches: (pa.RecordBatch.from_arrays([b.column("file"), pa.nulls(b.num_rows, pa.string())], names=["file", "head"]) for b in batches)
    monkeypatch.setattr(files, "_first_lines", nothing)
    assert tuples(read_csv_text(spark, f"{tmp_path}/in")) == [("1", "2"), ("3", "4")]


def test_a_failed_load_keeps_its_files_and_name(spark, db, tmp_path):
    from tablewright.streaming import incremental

    fixtures.write_orders(f"{tmp_path}/in", "1.csv", fixtures.orders(5))
    with pytest.raises(incremental.LoadFailed, match="boom"):
        load(spark, db, tmp_path, lambda df: df.withColumn("boom", F.raise_error(F.lit("boom")).cast("string")))
    state = f"{tmp_path}/state/job/src/generation=0"
    planned = spark.read.parquet(f"{state}/planned").collect()
    # What arrives meanwhile is another load.
    fixtures.write_orders(f"{tmp_path}/in", "2.csv", fixtures.orders(7))
    assert load(spark, db, tmp_path) == 2
    names = {r.load_id: r["count"] for r in spark.table(f"{db}.t").groupBy("load_id").count().collect()}
    assert names[f"load_{planned[0].name}"] == 5 and sorted(names.values()) == [5, 7]
    ledger = spark.read.parquet(f"{state}/ledger")
    assert ledger.count() == 2 and ledger.select("name").distinct().count() == 2
    plan = incremental._new_files(spark, f"{tmp_path}/in", state, {})._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and load(spark, db, tmp_path) == 0


# parts of keyed tables

def test_bits_of_parts():
    assert even_bits(1) == [""] and even_bits(2) == ["0", "1"] and even_bits(3) == ["00", "01", "1"] and len(even_bits(6)) == 6
    assert divided("01", 100, 100) == ["01"] and divided("01", 101, 100) == ["010", "011"] and len(divided("", 700, 100)) == 8


def test_only_the_part_that_outgrew_its_size_divides(spark, db, tmp_path):
    df = spark.range(4000).selectExpr("cast(id as string) AS k", "sha2(cast(id as string), 512) AS v")
    upsert_keyed(df, db, "t", "k", f"{tmp_path}/t", buckets=4)
    spark.sql(f"ALTER TABLE {db}.t SET TBLPROPERTIES ('owner_team' = 'sales')")
    name = f"{db}.t"
    before = {p.bits: p for p in parts_of(spark, name)}
    assert list(before) == ["00", "01", "10", "11"] and min(p.bytes for p in before.values()) > 50_000
    files = {r[0] for r in table_files(spark, db, "t").select("file_path").collect()}
    upsert_keyed(df.limit(1), db, "t", "k", f"{tmp_path}/t", part_bytes=min(p.bytes for p in before.values()) // 2)
    after = {p.bits: p for p in parts_of(spark, name)}
    same = [b for b in before if after.get(b) == before[b]]
    assert len(same) == 3 and len(after) == 7
    assert len(files & {r[0] for r in table_files(spark, db, "t").select("file_path").collect()}) >= 3
    assert table_properties(spark, name)["owner_team"] == "sales"
    assert read_keyed(spark, db, "t").count() == read_keyed(spark, db, "t").select("k").distinct().count() == 4000
    upsert_keyed(spark.createDataFrame([("5", "new"), ("x", "y")], "k string, v string"), db, "t", "k", f"{tmp_path}/t")
    assert {r.k: r.v for r in read_keyed(spark, db, "t").where("k IN ('5', 'x')").collect()} == {"5": "new", "x": "y"}
    assert read_keyed(spark, db, "t").count() == 4001


def test_an_upsert_that_dies_changes_nothing(spark, db, tmp_path, monkeypatch):
    from tablewright.sources import keyed

    df = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int")
    upsert_keyed(df, db, "t", "k", f"{tmp_path}/t", buckets=3)

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(keyed, "_commit", dies)
    with pytest.raises(RuntimeError):
        upsert_keyed(df.withColumn("v", -F.col("v")), db, "t", "k", f"{tmp_path}/t")
    monkeypatch.undo()
    assert tuples(read_keyed(spark, db, "t")) == tuples(df)
    upsert_keyed(df.limit(1).withColumn("v", F.lit(-1)), db, "t", "k", f"{tmp_path}/t")
    assert spark.table(f"{db}.t").count() == 50 and spark.sql(f"SHOW PARTITIONS {db}.t").count() == 3


def test_compaction_without_order_shuffles_nothing(spark, db, tmp_path):
    small_files(spark, db, tmp_path, ("p",))
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("compact", "compact")
    try:
        assert compact_table(spark, db, "t") == 4
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    names = [seen.getStageInfo(s).name for j in seen.getJobIdsForGroup("compact") for s in (seen.getJobInfo(j).stageIds if seen.getJobInfo(j) else ()) if seen.getStageInfo(s)]
    writes = [n for n in names if n.startswith("parquet at")]
    # One stage writes; a shuffle would have put another before it.
    assert len(writes) == 1


def test_listing_of_single_files_missing_folders_and_old_copies(spark, db, tmp_path):
    _csv(tmp_path / "one file.csv", "a\n1\n")
    spark.sql(f"CREATE TABLE {db}.single (a string) USING csv OPTIONS (header 'true') LOCATION '{tmp_path}/one file.csv'")
    small_files(spark, db, tmp_path, ("p",))
    compact_table(spark, db, "t")
    compact_table(spark, db, "t", sort_by=["x"])
    spark.sql(f"ALTER TABLE {db}.t ADD PARTITION (p = 99) LOCATION '{tmp_path}/nowhere'")
    rows = {r.table_name: (r.partitions, r.files, r.has_data) for r in table_inventory(spark, [db]).collect()}
    assert rows == {"single": (0, 1, True), "t": (5, 4, True)}


def test_counts_are_of_what_was_committed(spark, tmp_path):
    """Tasks that fail after they have counted leave no count behind."""
    rules = {"x": parse_double}
    df = spark.createDataFrame([(str(i) if i % 3 else "bad",) for i in range(300)], "x string").repartition(4)
    dies = df.withColumn("boom", F.when(F.col("x") == "299", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(PySparkException):
        write_counted(dies, f"{tmp_path}/out", rules)
    assert write_counted(df, f"{tmp_path}/out", rules) == {"rows": 300, "parsed_x": 200, "failed_x": 100}
    assert write_counted(df.limit(0), f"{tmp_path}/none", rules) == {"rows": 0, "parsed_x": 0, "failed_x": 0}


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_old_copies_are_removed(spark, db, tmp_path, parts):
    small_files(spark, db, tmp_path, parts)
    for _ in range(3):
        compact_table(spark, db, "t", sort_by=["x"])
    before = tuples(read_table(spark, db, "t"))
    assert len(list((tmp_path / "t.v").iterdir())) == 3
    assert remove_superseded(spark, db, "t", timedelta(hours=1)) == 0
    (tmp_path / "t.v" / "notes").mkdir()
    assert remove_superseded(spark, db, "t", timedelta(0)) == 2
    assert len(list((tmp_path / "t.v").iterdir())) == 2 and len(list((tmp_path / "t").rglob("*.parquet"))) > 0
    spark.catalog.refreshTable(f"{db}.t")
    assert tuples(read_table(spark, db, "t")) == before


def test_staged_copies_are_removed(spark, tmp_path):
    copy = fresh_path(spark, "stage")
    spark.range(3).write.parquet(copy)
    other = Path(shared_folder(spark)) / "not-ours"
    other.mkdir()
    assert remove_staged(spark, timedelta(hours=1)) == 0 and Path(copy).exists()
    os.utime(copy, (1_000_000_000, 1_000_000_000))
    assert remove_staged(spark, timedelta(days=365)) == 1
    assert not Path(copy).exists() and other.exists()


def test_collections_are_written_by_one_pass(spark, db, tmp_path):
    df = spark.sql(
        "SELECT * FROM VALUES (1, named_struct('c', 'x'), array(named_struct('v', 1, 'tags', array('p', 'q')), NULL), map('k', 1.5D), array(array(1, 2), array(3))), "
        "(2, NULL, array(), NULL, NULL), (3, named_struct('c', 'z'), NULL, map('a', 0.5D, 'b', 2.5D), array(NULL, array(4))) AS t(id, s, items, m, grid)"
    )
    want = relationalize(df, "r", "id")
    names = write_relationalized(df, "r", db, f"{tmp_path}/r", "id", {"r": "root"})
    assert set(names) == {"root", *(n for n in want if n != "r")}
    for name, frame in want.items():
        out = read_table(spark, db, "root" if name == "r" else name)
        assert out.schema.simpleString() == frame.schema.simpleString() and tuples(out) == tuples(frame)
    # Types that clash (a value is a number here, text there) divide the tables among as few frames as needed.
    groups = tagged_rows(df, "r", "id")
    assert [rows._jdf.queryExecution().optimizedPlan().toString().count("Generate") for rows, _ in groups] == [1] * len(groups)
    assert sum(len(members) for _, members in groups) == len(want) > len(groups)
    more = df.withColumn("extra", F.lit(1)).withColumn("id", F.col("id").cast("bigint") + (1 << 40))
    write_relationalized(more, "r", db, f"{tmp_path}/r", "id", {"r": "root"})
    root = read_table(spark, db, "root")
    assert root.count() == 6 and dict(root.dtypes)["id"] == "bigint" and root.where("extra = 1").count() == 3
    with pytest.raises(ValueError, match="not at"):
        write_relationalized(df, "r", db, f"{tmp_path}/elsewhere", "id", {"r": "root"})
