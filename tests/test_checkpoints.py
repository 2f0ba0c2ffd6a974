from chronicell.operators import augment
from chronicell.sources import checkpoints, payloads
from pyspark.sql import functions as F

FIRST = {"timestamp": 1, "server_id": 7, "gtid": "u:1", "gtid_set": "u:1-5", "file": "f", "position": 4}


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "checkpoint")
    assert checkpoints.load(spark, path) is None
    for c in (FIRST, FIRST | {"gtid_set": "u:1-9"}):
        checkpoints.save(spark, path, c)
        assert checkpoints.load(spark, path) == c


def test_order_of_starts():
    assert checkpoints.resolve(("f", 3), "u:1-2", FIRST, {}) == {"file": "f", "position": 3}
    assert checkpoints.resolve(None, "u:1-2", FIRST, {}) == {"gtid_set": "u:1-2"}
    assert checkpoints.resolve(None, None, FIRST, {"a": 1}) == FIRST and checkpoints.resolve(default={"a": 1}) == {"a": 1}


def test_safe_checkpoint(spark):
    make = lambda *rows: checkpoints.safe_checkpoint(spark.createDataFrame(rows, "gtid_set string, timestamp bigint"))
    assert make(("u:1-10", 50), ("u:1-11", 60), ("u:1-12", 70), ("u:1-14", 80), (None, 5), ("u:1-2", 0)) == {"gtid_set": "u:1-12", "timestamp": 70}
    assert make(("u:1-10", 50), ("u:1-10,v:1-3", 60)) == {"gtid_set": "u:1-10,v:1-3", "timestamp": 60}
    assert make((None, 3)) is None


def test_messages_without_brokers(spark):
    rows = spark.createDataFrame([("ALTER TABLE t ADD b INT", "a int", "a int, b int"), ("ALTER TABLE t MODIFY a TEXT", "a int", "a text")], "query string, before string, after string")
    made = payloads.ddl_records(rows, "db", "t").orderBy("query").collect()
    assert [r.isCompatibleSchemaChange for r in made] == [True, False]


def test_columns_of_a_message(spark):
    df = spark.createDataFrame([([("a", "int", "PRI"), ("b", "text", "")],)], "columns array<struct<name:string,column_type:string,key:string>>")
    assert [tuple(c) for c in df.select(augment.columns_projection(F.col("columns")).alias("c")).first().c] == [("a", "int"), ("b", "text")]
