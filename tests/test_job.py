"""From binary log files to written cells, by settings."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from chronicell import config, job
from chronicell.operators import augment, ddl, read
from chronicell.sources import checkpoints, payloads
from chronicell.streaming import replicate
from tests.test_logfile import UUID, Log

INT, TEXT = (3, b""), (15, struct.pack("<H", 60))
_columns = lambda *types: [(("", "", ""), code, meta, b"", "") for code, meta in types]


def row(no, *texts):
    return b"\0" + struct.pack("<i", no) + b"".join(bytes([len(t.encode())]) + t.encode() for t in texts)


@pytest.fixture
def folder(tmp_path):
    """A table that is made, filled, altered and filled again over two files; a table of another schema; an open tail."""
    one, two = Log(), Log()
    one.query("CREATE TABLE bill (no INT UNSIGNED, city VARCHAR(20), PRIMARY KEY (no)) DEFAULT CHARSET=utf8")
    one.query("CREATE TABLE other.bill (id INT, PRIMARY KEY (id))", db="other")
    for k, (kind, images) in enumerate([(30, [row(1, "Oslo"), row(2, "Rom")]), (31, [row(1, "Oslo"), row(1, "Bergen")]), (32, [row(2, "Rom")])]):
        one.gtid(k + 1)
        one.query("BEGIN")
        one.table(5, "bill_201901", _columns(INT, TEXT)) if k == 0 else one.table(5, "bill", _columns(INT, TEXT))
        one.rows(kind, images, 5, 2)
        one.add(16, struct.pack("<Q", k))
    one.add(4, struct.pack("<Q", 4) + b"log.02")
    two.query("ALTER TABLE bill ADD COLUMN note VARCHAR(20)")
    two.gtid(4)
    two.query("BEGIN")
    two.table(6, "bill", _columns(INT, TEXT, TEXT))
    two.rows(30, [row(3, "Bonn", "new")], 6, 3)
    two.query("COMMIT")
    two.gtid(5)
    two.query("BEGIN")
    two.table(6, "bill", _columns(INT, TEXT, TEXT))
    two.rows(30, [row(9, "open", "tail")], 6, 3)
    path = tmp_path / "logs"
    path.mkdir()
    (path / "log.01").write_bytes(bytes(one.data))
    (path / "log.02").write_bytes(bytes(two.data))
    return path


def test_replication(spark, folder, tmp_path):
    start = ddl.SchemaState().load([("shop.bill_201901", 1, "no", "int(11)", False, "PRI"), ("shop.bill_201901", 2, "city", "varchar(20)", True, "")])
    settings = {
        "source.path": str(folder), "source.schema": "shop", "sink.path": str(tmp_path / "cells"), "filter.type": "TABLE_MERGE_PATTERN", "filter.pattern": r"_\d{6}$", "namespace": "ns",
        "checkpoint.path": str(tmp_path / "checkpoint"),
    }
    job.run(spark, settings, start)
    cells = replicate.read_cells(spark, str(tmp_path / "cells"))
    state = {r.row_key.split(";")[1]: (r.city, r.note) for r in read.latest_state(cells, ["city", "note"]).collect()}
    assert state == {"1": ("Bergen", None), "3": ("Bonn", "new")} and {r.tbl for r in cells.select("tbl").distinct().collect()} == {"ns:bill"}
    ids = {r.value for r in cells.filter("qualifier = '_transaction_uuid'").select("value").distinct().collect()}
    assert ids == {f"{UUID}:{k}" for k in (1, 2, 3, 4)}
    last = checkpoints.load(spark, str(tmp_path / "checkpoint"))
    assert last["gtid"] == f"{UUID}:5" and last["file"] == "log.02"
    again = job.read_source(spark, settings)
    assert again.isEmpty()
    with pytest.raises(Exception, match="no schema is known for rows of shop.bill"):
        job.run(spark, settings | {"start.file": "log.01", "start.position": 250, "checkpoint.path": None, "sink.path": str(tmp_path / "never")})


def test_sinks_by_settings(spark, folder, tmp_path, capfd):
    settings = {"source.path": str(folder), "tables.exclude_pattern": "_", "transactions.enabled": True}
    for sink in ("COUNT", "DRY_RUN", "CONSOLE"):
        job.run(spark, settings | {"sink.type": sink})
    with pytest.raises(ValueError, match="unknown sink"):
        job.run(spark, settings | {"sink.type": "nowhere"})
    with pytest.raises(Exception, match="spark-sql-kafka"):
        job.run(spark, settings | {"sink.type": "KAFKA", "kafka.topic": "t"})
    job.run(spark, settings | {"sink.storage": "orc", "sink.path": str(tmp_path / "orc"), "transactions.enabled": False})
    assert spark.read.orc(str(tmp_path / "orc")).filter("qualifier = 'row_status'").count() == 4


def test_settings(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"source": {"path": "/a", "schema": "x"}, "sink": {"type": "COUNT"}}))
    (tmp_path / "secret.json").write_text(json.dumps({"kafka": {"password": "p"}}))
    found = config.from_arguments(["--config-file", str(tmp_path / "s.json"), "--secret-file", str(tmp_path / "secret.json"), "--config", "source.schema=y", "--config", "transactions.enabled=false"])
    assert found == {"source.path": "/a", "source.schema": "y", "sink.type": "COUNT", "kafka.password": "p", "transactions.enabled": False}
    assert config.with_prefix(found, "source.") == {"path": "/a", "schema": "y"}
    with pytest.raises(SystemExit):
        config.from_arguments(["--config", "nothing"])


def test_small_pieces(spark, tmp_path):
    rows = spark.createDataFrame([("e1", "t"), ("e1", "t"), ("e2", "u")], "event string, tbl string")
    assert augment.one_table(rows, ["event"]).count() == 3
    with pytest.raises(Exception, match="several tables"):
        augment.one_table(rows.union(spark.createDataFrame([("e2", "t")])), ["event"]).collect()
    entry = spark.range(1).select(augment.entry_of(F.create_map(F.lit("CiTy"), F.lit("Oslo")), "city").alias("a"), augment.entry_of(F.create_map(F.lit("a"), F.lit("b")), "c").alias("b")).first()
    assert tuple(entry) == ("Oslo", None)
    state = ddl.SchemaState()
    state.apply("CREATE TABLE a (x INT, y VARCHAR(9) CHARACTER SET latin1, z TEXT) CHARSET=utf8mb4", "d")
    assert state.names("d") == ["d.a"] and [c.collation for c in state.columns("d.a")] == ["utf8mb4", "latin1", "utf8mb4"]
    other = state.copy()
    other.apply("DROP TABLE a", "d")
    assert other.names() == [] and state.names() == ["d.a"]
    with pytest.raises(ValueError, match="no schema"):
        other.columns("d.a")
    ids = spark.createDataFrame([(f"u:{n}",) for n in (1, 2, 3, 7, 8, 3)] + [("v:5",), (None,)], "gtid string")
    assert checkpoints.executed_set(ids) == "u:1-3:7-8,v:5-5"
    checkpoints.writer(spark, str(tmp_path / "c"))(spark.createDataFrame([("u:1-4", 9), ("u:1-5", 10)], "gtid_set string, timestamp bigint"))
    assert checkpoints.load(spark, str(tmp_path / "c")) == {"gtid_set": "u:1-5", "timestamp": 10}
    change = spark.createDataFrame([("t", "INSERT", None, {"a": "1"}, 5, "x")], "tbl string, op string, before map<string,string>, after map<string,string>, commit_ts_ms bigint, db string")
    assert json.loads(change.select(payloads.event_json(change, pretty=True)).first()[0])["data"] == {"eventType": "INSERT", "before": None, "after": {"a": "1"}}
    assert tuple(change.select(payloads.message_key(change).alias("k")).first().k) == ("t", "x", "INSERT", 5)
    opaque = payloads.opaque_message(spark.createDataFrame([(bytearray(b"\0\1"),)], "data binary")).first()
    assert opaque.key is None and bytes(opaque.value) == b"\0\1"
