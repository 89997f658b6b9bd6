import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from patronage import schemas, session
from patronage.sources import mapping, piped, scans
from patronage.streaming import feed


def test_jdbc_options_partition_only_with_both_bounds():
    plain = scans.jdbc_options("jdbc:x", "log_conversion", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "log_conversion", "fetchsize": "10000", "user": "u"}
    cut = scans.jdbc_options("jdbc:x", "t", lower="2020-01-01", upper="2021-01-01", partitions=8)
    assert cut["partitionColumn"] == "server_time" and cut["numPartitions"] == "8"


def test_kafka_options():
    got = feed.kafka_options("h:9092", ["a", "b"], group="g", offsets="earliest")
    assert got["subscribe"] == "a,b" and got["kafka.group.id"] == "g"
    assert got["startingOffsets"] == "earliest"


def test_scan_drops_and_counts_rows_without_a_key(spark):
    t = dt.datetime(2020, 1, 2)
    rows = [(1, b"\1", t, "a", 1, 1.0, 1.0, False), (1, None, t, "b", 1, 1.0, 1.0, False),
            (1, b"\1", t, None, 1, 1.0, 1.0, False), (2, b"\1", t, "c", 1, 1.0, 1.0, False)]
    df = spark.createDataFrame(rows, schemas.CONVERSION_ITEM)
    kept = scans.scan_conversion_item(df, 1, "2020-01-01", "2020-01-03").collect()
    assert [r.idorder for r in kept] == ["a"]
    lost = scans.dropped_rows(df, "conversion_item").first()
    assert (lost.idvisitor, lost.idorder, lost.idsite) == (1, 1, 0)


def test_scan_rejects_wrong_schema(spark):
    with pytest.raises(ValueError, match="missing"):
        scans.scan_conversion(spark.range(1), 1, "2020-01-01", "2020-01-02")
    bad = spark.createDataFrame([], schemas.VISIT_ACTION).withColumn("idvisit", F.lit("x"))
    with pytest.raises(ValueError, match="idvisit"):
        scans.scan_visit_action(bad, 1, "2020-01-01", "2020-01-02")


def test_no_fields_means_all(spark):
    df = spark.range(1).withColumn("b", F.lit(1))
    assert scans.project_fields(df).columns == ["id", "b"]
    assert scans.project_fields(df, ["b"]).columns == ["b"]


def test_piped_round_trip_with_missing_values(spark):
    path = tempfile.mkdtemp(prefix="patronage-test-") + "/lines"
    rows = [(1, "ab", "7", 5, 1.5, -0.25), (2, "c", "8", 6, None, 180.0)]
    df = spark.createDataFrame(rows, schemas.LOCATION_LINE)
    piped.write_piped(df, path)
    back = piped.read_piped(spark, path, schemas.LOCATION_LINE)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_bad_fields_become_null(spark):
    lines = spark.createDataFrame([("1|x|2.5",), ("1|x|oops",), ("1",)], "value string")
    got = piped.pick_fields(lines, {"v": (2, "double"), "n": (1, "string")}).collect()
    assert [(r.v, r.n) for r in got] == [(2.5, "x"), (None, "x"), (None, None)]


def test_mapping_reads_only_what_is_asked(spark, small):
    plan = mapping.log_conversion(spark, small, ["idsite", "idorder"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in text and "Join" not in text


def test_mapping_has_the_declared_schema(spark, small):
    schemas.conform(mapping.log_conversion(spark, small), schemas.CONVERSION)
    schemas.conform(mapping.log_conversion_item(spark, small), schemas.CONVERSION_ITEM)
    schemas.conform(mapping.log_link_visit_action(spark, small), schemas.VISIT_ACTION)


def test_narrower_types_are_cast(spark):
    wide = schemas.CONVERSION_ITEM
    names = {f.name: "NULL" for f in wide.fields} | {
        "idsite": "CAST(1 AS INT)", "idvisitor": "X'01'", "server_time": "TIMESTAMP'2020-01-02'", "idorder": "'a'", "idaction_sku": "CAST(5 AS INT)",
        "price": "CAST(2.5 AS FLOAT)", "quantity": "CAST(3.25 AS DECIMAL(8,2))", "deleted": "CAST(1 AS TINYINT)",
    }
    df = spark.sql("SELECT " + ", ".join(f"{v} AS {k}" for k, v in names.items()))
    row = schemas.conform(df, wide).first()
    assert (row.idsite, row.idaction_sku, row.price, row.quantity, row.deleted) == (1, 5, 2.5, 3.25, True)
    with pytest.raises(ValueError, match="price is string"):
        schemas.conform(df.withColumn("price", F.lit("x")), wide)


def test_rows_without_flags_count_as_plain_orders(spark):
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, deleted boolean")
    assert [r.id for r in scans.filter_not_deleted(flags).orderBy("id").collect()] == [2, 3]
    goals = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id int, idgoal int")
    assert [r.id for r in scans.filter_orders(goals).orderBy("id").collect()] == [1, 3]


def test_a_parallel_database_scan_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        scans.read_jdbc(spark, "jdbc:x", "t")


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
