import pytest
import shop
from pyspark.sql import functions as F

from tablespoon.operators import bronze as B
from tablespoon.session import scratch_dir, shared_dir
from tablespoon.sources import LANDING_SCHEMAS, Layout, jdbc_options, load_landing, read_table, write_table


def test_csv_keeps_text_commas_and_newlines(spark, tmp_path):
    header = ",".join(LANDING_SCHEMAS["order_item_options"].names)
    (tmp_path / "a.csv").write_text(f'{header}\n1,l1,"Size, big\nor small",Large,007.50,2\n2,,g,o,,1\n')
    for schema in (LANDING_SCHEMAS["order_item_options"], None):
        df = load_landing(spark, str(tmp_path), "csv", schema)
        assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 6
        assert shop.rows(df) == [
            ("1", "l1", "Size, big\nor small", "Large", "007.50", "2"),
            ("2", None, "g", "o", None, "1"),
        ]


def test_parquet_and_unknown_format(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert load_landing(spark, str(tmp_path / "p"), "parquet").count() == 3
    with pytest.raises(ValueError):
        load_landing(spark, "x", "orc")


def test_jdbc_options_split_the_read():
    options = jdbc_options("jdbc:x://h/db", "orders", "D", "me", "pw", ("id", 0, 100, 8))
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert options["lowerBound"] == "0" and options["upperBound"] == "100" and options["user"] == "me"
    assert "partitionColumn" not in jdbc_options("u", "t", "D")


def test_layout_paths():
    layout = Layout("/data/", (("landing", "/in"),))
    assert layout.path("gold", "dim_date") == "/data/gold/dim_date"
    assert layout.path("landing", "x") == "/in/x"
    with pytest.raises(ValueError):
        layout.path("platinum", "x")


def test_partitioned_sink_round_trip_and_rerun_of_one_day(spark, tmp_path):
    layout = Layout(str(tmp_path))
    df = spark.range(10).select("id", F.expr("date_add(DATE '2023-01-01', CAST(id % 3 AS INT))").alias("day"))
    write_table(df, layout, "gold", "t", ["day"])
    assert shop.rows(read_table(spark, layout, "gold", "t"), "id", "day") == shop.rows(df)
    fixed = df.filter("day = DATE '2023-01-02'").withColumn("id", F.col("id") + 100)
    write_table(fixed, layout, "gold", "t", ["day"], only_touched_partitions=True)
    ids = {r[0] for r in read_table(spark, layout, "gold", "t").select("id").collect()}
    assert ids == {0, 3, 6, 9, 101, 104, 107, 2, 5, 8}
    write_table(fixed, layout, "gold", "t", ["day"])
    assert read_table(spark, layout, "gold", "t").count() == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark).startswith(("file:" + spark.conf.get("spark.checkpoint.dir"), spark.conf.get("spark.checkpoint.dir")))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_bronze_adds_metadata_only(spark):
    source = shop.landing(spark, "order_items", [{"ORDER_ID": "1", "CREATION_TIME_UTC": "2023-03-08T11:03:32.223Z"}])
    row = B.bronze_order_items(source, "now").first()
    assert (row.ingestion_timestamp, row.order_date_partition, row.USER_ID) == ("now", "2023-03-08", None)
    assert B.bronze_order_items(source, "now").columns[:13] == LANDING_SCHEMAS["order_items"].names
