"""Binary logs that are written here byte by byte, read as files, in batches and as a stream."""

import io
import struct
import zlib
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from chronicell.functions import decode
from chronicell.operators import augment, txn
from chronicell.sources import logfile
from chronicell.sources.binlog import start_filter
from chronicell.sources.datasource import ChangeLogSource

SID = bytes(range(16))
UUID = "00010203-0405-0607-0809-0a0b0c0d0e0f"
TS = 1_575_566_080
#: (name, column type, collation), type byte, metadata, written value, value as it is decoded
COLUMNS = [
    (("id", "int(11) unsigned", ""), 3, b"", struct.pack("<i", -2), "4294967294"),
    (("tiny", "tinyint(4)", ""), 1, b"", struct.pack("<b", -5), "-5"),
    (("medium", "mediumint(9)", ""), 9, b"", (-3).to_bytes(3, "little", signed=True), "-3"),
    (("big", "bigint(20) unsigned", ""), 8, b"", struct.pack("<q", -1), "18446744073709551615"),
    (("price", "decimal(9,2)", ""), 246, bytes([9, 2]), bytes([0x80, 0x12, 0xD6, 0x87, 5]), "1234567.05"),
    (("name", "varchar(30)", "utf8"), 15, struct.pack("<H", 90), bytes([7]) + "Ñandú".encode(), "Ñandú"),
    (("old", "varchar(300)", "latin1_swedish_ci"), 15, struct.pack("<H", 300), struct.pack("<H", 4) + "d\xed\xe1!".encode("latin1"), "díá!"),
    (("code", "binary(4)", ""), 254, bytes([254, 4]), bytes([2]) + b"\x0a\x0b", "0A0B0000"),
    (("kind", "enum('Open','Paid')", ""), 254, bytes([247, 1]), bytes([2]), "Paid"),
    (("tags", "set('a','b','c')", ""), 254, bytes([248, 1]), bytes([5]), "a,c"),
    (("flags", "bit(10)", ""), 16, struct.pack("<H", 1 << 8 | 2), (0b1000000101).to_bytes(2, "big"), "1000000101"),
    (("day", "date", ""), 10, b"", (2019 << 9 | 12 << 5 | 5).to_bytes(3, "little"), "2019-12-05"),
    (("at", "timestamp(3)", ""), 17, bytes([3]), struct.pack(">I", TS) + (1230).to_bytes(2, "big"), f"{TS}123"),
    (("clock", "time", ""), 19, bytes([0]), ((1 << 23) + (17 << 12 | 21 << 6 | 20)).to_bytes(3, "big"), "17:21:20.000"),
    (("when", "datetime", ""), 18, bytes([0]), ((1 << 39) + ((2019 * 13 + 12) << 22 | 5 << 17 | 17 << 12 | 21 << 6 | 20)).to_bytes(5, "big"), str(int(datetime(2019, 12, 5, 17, 21, 20, tzinfo=UTC).timestamp()) * 1000)),
    (("share", "double", ""), 5, bytes([8]), struct.pack("<d", 0.5), "0.5"),
    (("doc", "json", ""), 245, bytes([4]), None, '{"k":1}'),
    (("data", "blob", ""), 252, bytes([2]), struct.pack("<H", 2) + b"\xff\x00", "FF00"),
    (("year", "year(4)", ""), 13, b"", bytes([119]), "2019"),
]
_JSON = bytes([0]) + struct.pack("<HHHH", 1, 12, 11, 1) + bytes([5]) + struct.pack("<h", 1) + b"k"
_DOC = struct.pack("<I", len(_JSON)) + _JSON


class Log:
    """A log file as it is written, with checksums or without."""

    def __init__(self, checksums=True):
        self.data, self.checksums = bytearray(logfile.MAGIC), checksums
        self.add(15, struct.pack("<H50sIB", 4, b"8.0", TS, 19) + bytes(40) + bytes([checksums]) + bytes(4), own_sum=True)

    def add(self, kind, body, own_sum=False):
        body = body + (bytes(4) if self.checksums and not own_sum else b"")
        at = len(self.data)
        event = struct.pack("<IBIIIH", TS, kind, 7, 19 + len(body), at + 19 + len(body), 0) + body
        if self.checksums and not own_sum:
            event = event[:-4] + struct.pack("<I", zlib.crc32(event[:-4]))
        self.data += event
        return len(self.data)

    def gtid(self, n):
        return self.add(33, b"\1" + SID + struct.pack("<q", n))

    def query(self, sql, db="shop"):
        return self.add(2, struct.pack("<IIBHH", 1, 0, len(db), 0, 3) + b"abc" + db.encode() + b"\0" + sql.encode())

    def table(self, table_id=9, tbl="invoice", columns=COLUMNS):
        meta = b"".join(c[2] for c in columns)
        types = bytes(c[1] for c in columns)
        return self.add(19, table_id.to_bytes(6, "little") + b"\1\0" + bytes([4]) + b"shop\0" + bytes([len(tbl)]) + tbl.encode() + b"\0" + bytes([len(types)]) + types + bytes([len(meta)]) + meta + bytes((len(types) + 7) // 8))

    def rows(self, kind, images, table_id=9, n=len(COLUMNS)):
        has = ((1 << n) - 1).to_bytes((n + 7) // 8, "little")
        extra = struct.pack("<H", 2) if kind >= 30 else b""
        return self.add(kind, table_id.to_bytes(6, "little") + b"\1\0" + extra + bytes([n]) + has * (2 if kind in (24, 31) else 1) + b"".join(images))


def image(null=(), **changed):
    names = [c[0][0] for c in COLUMNS]
    bits = sum(1 << names.index(x) for x in null)
    values = b"".join(changed.get(c[0][0], _DOC if c[3] is None else c[3]) for c in COLUMNS if c[0][0] not in null)
    return bits.to_bytes((len(COLUMNS) + 7) // 8, "little") + values


def a_log(checksums=True, first=1):
    log = Log(checksums)
    log.gtid(first)
    log.query("BEGIN")
    log.table()
    log.rows(30, [image(), image(null=["name", "doc"])])
    log.rows(24, [image(), image(tiny=b"\7")])
    log.rows(32, [image()])
    log.add(16, struct.pack("<Q", 77))
    log.query("ALTER TABLE invoice ADD x INT")
    log.add(4, struct.pack("<Q", 4) + b"binlog.000002")
    return log


@pytest.mark.parametrize("checksums", [True, False])
def test_events_of_a_file(checksums):
    log = a_log(checksums)
    events = list(logfile.read_events(io.BytesIO(bytes(log.data)), "f"))
    assert [e["event_type"] for e in events] == ["FORMAT_DESCRIPTION", "GTID", "QUERY", "TABLE_MAP", "EXT_WRITE_ROWS", "UPDATE_ROWS", "EXT_DELETE_ROWS", "XID", "QUERY", "ROTATE"]
    assert {e["gtid"] for e in events[1:]} == {f"{UUID}:1"} and events[2]["sql"] == "BEGIN" and events[2]["db"] == "shop" and events[7]["xid"] == 77
    assert (events[3]["tbl"], events[4]["table_id"], events[9]["file"], events[9]["position"]) == ("invoice", 9, "binlog.000002", 4)
    (none, first), (_, second) = events[4]["rows"]
    assert none is None and first["@2"] == "-5" and second["@6"] is None and second["@17"] is None
    before, after = events[5]["rows"][0]
    assert before["@2"] == "-5" and after["@2"] == "7" and events[6]["rows"][0][1] is None


def test_starting_inside_a_file_and_files_that_are_being_written():
    log = a_log()
    whole = list(logfile.read_events(io.BytesIO(bytes(log.data)), "f"))
    rest = list(logfile.read_events(io.BytesIO(bytes(log.data)), "f", start=whole[4]["position"]))
    assert rest == whole[5:]  # the table map and the transaction id before the start are known
    torn = bytes(log.data)[:-3]
    assert list(logfile.read_events(io.BytesIO(torn), "f")) == whole[:-1]
    assert logfile.last_boundary(io.BytesIO(torn)) == whole[-2]["position"]
    with pytest.raises(ValueError, match="not a binary log"):
        list(logfile.read_events(io.BytesIO(b"nothing"), "f"))
    orphan = Log()
    orphan.rows(30, [image()])
    with pytest.raises(ValueError, match="before the map"):
        list(logfile.read_events(io.BytesIO(bytes(orphan.data)), "f"))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("logs")
    for k in (1, 2, 3):
        (path / f"binlog.{k:06d}").write_bytes(bytes(a_log(k != 2, k).data))
    (path / "binlog.index").write_text("binlog.000001\n")
    return path


def test_batches(spark, folder):
    spark.dataSource.register(ChangeLogSource)
    log = spark.read.format("change_log").load(str(folder))
    assert log.rdd.getNumPartitions() == 3 and log.count() == 30
    typed = logfile.typed_images(log.filter("event_type = 'EXT_WRITE_ROWS' AND file = 'binlog.000001'"), [c[0] for c in COLUMNS])
    rows = typed.orderBy("row_idx").collect()
    assert rows[0].after == {c[0][0]: c[4] for c in COLUMNS} and rows[0].before is None
    assert rows[1].after["name"] is None and rows[1].after["doc"] is None
    with pytest.raises(Exception, match="differ in width"):
        logfile.typed_images(log.filter("event_type = 'UPDATE_ROWS'"), [c[0] for c in COLUMNS[:-1]]).collect()
    kind = F.when(F.col("sql") == "BEGIN", "BEGIN").when(F.col("event_type") == "XID", "XID").when(F.col("rows").isNotNull(), "ROW")
    whole = txn.stamp_commits(txn.assemble(log.withColumn("kind", kind).filter("kind IS NOT NULL")))
    done = whole.filter("kind = 'ROW'").groupBy("commit_gtid", "commit_xid", "seq").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in done.collect()} == {(f"{UUID}:{k}", 77, k - 1, 3) for k in (1, 2, 3)}
    assert log.select(augment.operation(F.col("event_type")).alias("op")).filter("op IS NOT NULL").groupBy("op").count().count() == 4
    later = spark.read.format("change_log").option("startFile", "binlog.000002").load(str(folder))
    assert later.count() == 20
    one = spark.read.format("change_log").load(f"file://{folder}/binlog.000003")
    assert one.count() == 10 and start_filter(one, {"gtid_set": f"{UUID}:1-3"}).filter("gtid IS NOT NULL").count() == 0


def test_streams_go_on_where_they_stopped(spark, folder, tmp_path):
    spark.dataSource.register(ChangeLogSource)
    live = tmp_path / "live"
    live.mkdir()
    out = str(tmp_path / "out")
    files = sorted(folder.glob("binlog.0*"))

    def run():
        log = spark.readStream.format("change_log").load(str(live))
        log.select("file", "position", "event_type").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out).awaitTermination(60)
        return sorted((r.file, r.position) for r in spark.read.parquet(out).collect())

    data = files[0].read_bytes()
    (live / "binlog.000001").write_bytes(data[: len(data) // 2])  # inside of an event
    half = run()
    assert 0 < len(half) < 10
    (live / "binlog.000001").write_bytes(data)
    (live / "binlog.000002").write_bytes(files[1].read_bytes())
    everything = run()
    assert len(everything) == 20 == len(set(everything)) + everything.count(("binlog.000002", 4)) - 1
    assert run() == everything


def test_tables_are_read_in_ranges(spark):
    """Against the embedded database that comes with Spark."""
    from chronicell.operators import ddl
    from chronicell.operators.cells import to_cells
    from chronicell.sources import jdbc

    url = "jdbc:derby:memory:shop;create=true"
    rows = spark.createDataFrame([(k, f"n{k}") for k in [*range(5, 48), 99]], "ID bigint, NAME string")
    try:
        rows.coalesce(1).write.mode("overwrite").jdbc(url, "INVOICE")
    except Exception as e:  # no such driver on the class path
        pytest.skip(str(e)[:100])
    found = jdbc.read_table(spark, url, "INVOICE", "ID", min_chunk=10)
    assert found.rdd.getNumPartitions() == 10 and sorted(r.ID for r in found.collect()) == [*range(5, 48), 99]
    assert jdbc.key_ranges(7, 7) == [(7, 8)] and jdbc.key_ranges(0, 29, 10) == [(0, 10), (10, 20), (20, 30)]
    cells = to_cells(jdbc.snapshot(spark, url, "INVOICE", ["id"], 5, "ID", min_chunk=10))
    assert cells.filter("qualifier = 'name'").count() == 44 and {r.tbl for r in cells.select("tbl").distinct().collect()} == {"invoice"}
    catalog = "SELECT 'shop' AS a, t.TABLENAME, c.COLUMNNUMBER, c.COLUMNNAME, CAST('bigint' AS VARCHAR(9)) AS k, 'YES' AS n, '' AS p FROM SYS.SYSTABLES t JOIN SYS.SYSCOLUMNS c ON t.TABLEID = c.REFERENCEID WHERE t.TABLENAME = 'INVOICE'"
    made = ddl.schema_history(ddl.bootstrap(jdbc.schema_columns(spark, url, query=catalog))).collect()
    assert [(r.tbl, r.after) for r in made] == [("INVOICE", "ID bigint, NAME bigint")]


def test_raw_values_keep_their_null_text():
    assert decode.json_text(_JSON) == '{"k":1}'
