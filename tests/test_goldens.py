"""Golden values of single operators, and scenarios from change to cell."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chronicell.functions import decode, naming
from chronicell.operators import augment, cells, ddl, read, resume, snapshot, txn, validate
from chronicell.sources import binlog, payloads


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "column, want",
    [
        (lambda: decode.integer(F.lit(-1), "tinyint(3) unsigned"), 255),
        (lambda: decode.integer(F.lit(-36), "smallint(5) unsigned"), 65500),
        (lambda: decode.integer(F.lit(-7001), "mediumint unsigned"), 16770215),
        (lambda: decode.integer(F.lit(-672001), "int(10) unsigned"), 4294295295),
        (lambda: decode.integer(F.lit(-7), "int(11)"), -7),
        (lambda: decode.bigint_unsigned(F.lit(-1).cast("long")).cast("string"), "18446744073709551615"),
        (lambda: decode.bigint_unsigned(F.expr("-9223372036854775807L - 1")).cast("string"), "9223372036854775808"),
        (lambda: decode.binary_fixed(F.lit(b"orange"), 10), "6F72616E676500000000"),
        (lambda: decode.blob(F.lit(b"orange")), "6F72616E6765"),
        (lambda: decode.text(F.lit("Buenos días".encode("latin1")), "latin1_swedish_ci"), "Buenos días"),
        (lambda: decode.text(F.lit("Ñandú".encode()), "utf8_general_ci"), "Ñandú"),
        (lambda: decode.bits(F.lit(25).cast("long")), "11001"),
        (lambda: decode.bits(F.lit(0).cast("long")), "0"),
        (lambda: decode.time_text(F.lit(42972123).cast("long")), "11:56:12.123"),
        (lambda: decode.date_text(F.lit(0).cast("long")), "1970-01-01"),
        (lambda: decode.enum_member(F.lit(3), ["apple", "banana", "orange"]), "orange"),
        (lambda: decode.enum_member(F.lit(0), ["apple", "banana", "orange"]), None),
        (lambda: decode.set_members(F.lit(3), ["apple", "banana", "orange"]), "apple,banana"),
        (lambda: decode.set_members(F.lit(7), ["apple", "banana", "orange"]), "apple,banana,orange"),
        (lambda: decode.set_members(F.lit(0), ["apple", "banana", "orange"]), None),
        (lambda: decode.decimal_text(F.lit("100").cast("decimal(27,9)"), 27, 9), "100.000000000"),
        (lambda: decode.value_text(F.lit(None)), "NULL"),
        (lambda: naming.salted_key([F.lit("user"), F.lit(42)]), "ee11cbb1;user;42"),
        (lambda: naming.salted_key([F.lit(123), F.lit(456)]), "202cb962;123;456"),
        (lambda: naming.salted_key([F.lit("first")]), "8b04d5e3;first"),
        (lambda: naming.salted_key([F.lit("A"), F.lit(1)]), "7fc56270;A;1"),
        (lambda: naming.merged_table(F.lit("MyTable_201912"), r"([_][12]\d{3}(0[1-9]|1[0-2]))"), "MyTable"),
        (lambda: naming.plain_table(F.lit("`test`.`animal`")), "animal"),
        (lambda: resume.partition_by_xid(F.lit(-1).cast("long"), 16), 15),
        (lambda: payloads.raw_event_key(F.lit(1575566080000).cast("long")), "0000806655751"),
        (lambda: txn.commit_micros(F.lit(1575566080000).cast("long"), F.lit(100)), 1575566080010000),
    ],
)
def test_values(spark, column, want):
    assert one(spark, column()) == want


REWRITES = [
    ("CREATE TABLE test (i INT, c CHAR(10)) ENGINE = BLACKHOLE;", "CREATE TABLE test (i INT, c CHAR(10)) ENGINE = BLACKHOLE;"),
    ("CREATE TABLE test.test (i INT, c CHAR(10)) ENGINE = BLACKHOLE;", "CREATE TABLE test (i INT, c CHAR(10)) ENGINE = BLACKHOLE;"),
    ("CREATE TABLE `test`.`test` (i INT, c CHAR(10)) ENGINE = BLACKHOLE;", "CREATE TABLE `test` (i INT, c CHAR(10)) ENGINE = BLACKHOLE;"),
    ("use `test`; RENAME TABLE `test`.`a` TO `test`.`a_old`, `test`.`a_new` TO `test`.`a`", "RENAME TABLE `a` TO `a_old`, `a_new` TO `a`"),
    ("use test; RENAME TABLE `test`.`a` TO `test`.`a_old`", "RENAME TABLE `a` TO `a_old`"),
]


@pytest.mark.parametrize("sql, want", REWRITES)
def test_rewrite(spark, sql, want):
    assert one(spark, naming.without_database(F.lit(sql), "test")) == want


@pytest.mark.parametrize(
    "sql, inside",
    [
        ("RENAME TABLE `bill` TO `archive`.`bill_past`, `archive`.bill_next TO `bill`;", False),
        ("rename table archive.bill to bill_elsewhere;", False),
        ("rename table shop.bill to bill_past;", True),
    ],
)
def test_rename_guard(spark, sql, inside):
    assert one(spark, ddl.rename_stays_inside(F.lit(sql), "shop")) is inside


def test_json_from_bytes(spark):
    raw = bytes([0, 3, 0, 77, 0, 25, 0, 2, 0, 27, 0, 4, 0, 31, 0, 10, 0, 12, 41, 0, 12, 49, 0, 0, 57, 0]) + b"osnameresolution" + b"\x07Windows\x07Firefox" + bytes([2, 0, 20, 0, 18, 0, 1, 0, 19, 0, 1, 0, 5, 0, 10, 5, 64, 6]) + b"xy"
    assert decode.json_text(raw) == '{"os":"Windows","name":"Firefox","resolution":{"x":2560,"y":1600}}'
    assert decode.json_text(b"\x00\x01") is None and decode.json_text(None) is None
    assert one(spark, decode.json_column(F.lit(raw))).startswith('{"os"')


def test_member_lists():
    assert decode.member_list("enum('Animalia','plan,tae','it''s)')") == ["Animalia", "plan,tae", "it's)"]
    assert decode.member_list("set('A','b')", compat=True) == ["a", "b"]


GOLDEN_SCHEMA = '{"type":"record","name":"table","namespace":"db","fields":[{"name":"col1","type":["null","int"],"default":null},{"name":"col2","type":["int","null"],"default":10},{"name":"col3","type":["string","null"],"default":"string"}]}'


def test_schema_documents():
    made = payloads.avro_schema("db", "table", [("col1", "int(11)", None), ("col2", "int(11)", "10"), ("col3", "enum('boolean','string')", "string")])
    assert made == GOLDEN_SCHEMA
    wider = payloads.avro_schema("db", "table", [("col1", "bigint(20)", None), ("col2", "int(11)", "10"), ("col3", "varchar(9)", "string"), ("new", "int", None)])
    assert payloads.schemas_compatible(made, wider) and not payloads.schemas_compatible(wider, made)
    registry = payloads.SchemaRegistry()
    assert registry.register("a-value", made) == registry.register("a-value", made) != registry.register("a-value", wider)


def test_ddl_interpreter():
    s = ddl.SchemaState()
    s.apply("/* x */ CREATE TABLE IF NOT EXISTS `db`.`t` (a INT(11) NOT NULL, b VARCHAR(30) DEFAULT 'x, y', KEY k (b), PRIMARY KEY (`a`)) ENGINE=InnoDB;")
    assert [(c.name, c.key, c.default) for c in s.tables["t"]] == [("a", "PRI", None), ("b", "", "x, y")]
    s.apply("ALTER TABLE t ADD COLUMN c DECIMAL(10,2) FIRST, MODIFY b BIGINT(20) UNSIGNED, CHANGE a id INT AFTER b")
    assert [(c.name, c.column_type) for c in s.tables["t"]] == [("c", "decimal(10,2)"), ("b", "bigint(20) unsigned"), ("id", "int")]
    assert [x[0] for x in s.apply("RENAME TABLE t TO t_old, t_old TO u")] == ["t", "t_old", "t_old", "u"]
    s.apply("DROP TABLE IF EXISTS u, nothing")
    assert s.tables == {}


def gtid_sets(spark, *sets):
    return {(r.server, r.lo, r.hi) for r in resume.safe_gtid_set(spark.createDataFrame([(s,) for s in sets], "gtid_set string")).collect()}


def test_safe_gtid_sets(spark):
    assert gtid_sets(spark, "a:1-10", "a:1-11", "a:1-12", "a:1-14") == {("a", 1, 12)}
    assert gtid_sets(spark, "a:1-3:5-9", "a:1-3:5-7:9-9", "a:1-3:5-10", "a:1-3:6-7") == {("a", 1, 3)}
    assert gtid_sets(spark, "a:5,b:1-2", "b:1-3") == {("a", 5, 5), ("b", 1, 3)}


CHANGES = "tbl string, op string, pk array<string>, before map<string,string>, after map<string,string>, ts_us bigint, txn_id string, xid bigint, position bigint, row_idx int"


def test_cells_of_one_row(spark):
    us = 1575566080000 * 1000 + 100 * 100
    image = {"id": "123", "ca": "456", "cb": "789", "cc": None}
    rows = [
        ("T", "INSERT", ["123", "456"], None, image, us, "u:1", 0, 1, 0),
        ("T", "UPDATE", ["123", "456"], image, image | {"cb": "800"}, us + 100, "u:2", 0, 2, 0),
        ("T", "DELETE", ["123", "456"], image, None, us + 200, "u:3", 0, 3, 0),
    ]
    found = cells.to_cells(spark.createDataFrame(rows, CHANGES)).collect()
    by_time = lambda t: {r.qualifier: r.value for r in found if r.ts_us == t}
    assert {r.row_key for r in found} == {"202cb962;123;456"}
    assert by_time(us) == {"id": "123", "ca": "456", "cb": "789", "cc": "NULL", "row_status": "I", "_transaction_uuid": "u:1", "_transaction_xid": "0"}
    assert by_time(us + 100) == {"cb": "800", "row_status": "U", "_transaction_uuid": "u:2", "_transaction_xid": "0"}
    assert by_time(us + 200) == {"row_status": "D", "_transaction_uuid": "u:3", "_transaction_xid": "0"}
    store = cells.to_cells(spark.createDataFrame(rows, CHANGES))
    assert read.latest_state(store, ["cb"]).count() == 0
    assert read.state_as_of(store, ["cb"], us + 199).first().cb == "800"
    assert read.state_as_of(store, ["cb"], us).first().cb == "789"


def test_a_table_without_key_is_an_error(spark):
    rows = spark.createDataFrame([("T", "INSERT", [], None, {"a": "1"}, 1, "t", 0, 1, 0)], CHANGES)
    with pytest.raises(Exception, match="primary key"):
        cells.to_cells(rows).collect()


def test_changes_past_the_span_share_the_last_microsecond(spark):
    """1 insert and 55 updates of one key in one transaction: 51 versions, the newest holds the last value."""
    rows = spark.range(56).select(F.lit("k").alias("key"), F.col("id").alias("position"), F.lit(1_000_000).cast("long").alias("base_us"), F.col("id").cast("string").alias("value"))
    timed = txn.row_micros(rows, ["key"], ["key"], ["position"])
    kept = txn.last_at_same_micros(timed.select("key", "ts_us", "value", "position"), ["key", "ts_us"], ["position"]).orderBy("ts_us").collect()
    assert len(kept) == 51 and kept[-1].value == "55" and kept[-1].ts_us == 1_000_000 and kept[0].ts_us == 999_950


def test_sequence_restarts_after_its_cycle(spark):
    seq = [r.seq for r in txn.commit_sequence(spark.range(20_001).select(F.col("id").alias("position"), F.lit(5).alias("commit_ts_ms"))).orderBy("position").collect()]
    assert seq[:3] == [0, 1, 2] and seq[9999:10002] == [9999, 1, 2] and max(seq) == 9999


def test_assembly(spark):
    kinds = "ROW BEGIN ROW ROW XID BEGIN ROW BEGIN ROW COMMIT BEGIN ROW".split()
    log = spark.createDataFrame([("s", "f", i, k) for i, k in enumerate(kinds)], "server string, file string, position bigint, kind string")
    rows = txn.assemble(log).filter("kind = 'ROW'").orderBy("position").collect()
    assert [(r.position, r.txn_no) for r in rows] == [(0, None), (2, 0), (3, 0), (6, 1), (8, 1)]


def test_width_guard(spark):
    rows = spark.createDataFrame([(["1"], ["a", "b"])], "v array<string>, c array<string>")
    right = spark.createDataFrame([(["1", "2"], ["a", "b"])], rows.schema)
    assert right.select(augment.named_values(F.col("v"), F.col("c")).alias("m")).first().m == {"a": "1", "b": "2"}
    with pytest.raises(Exception, match="width"):
        rows.select(augment.named_values(F.col("v"), F.col("c"))).collect()


def test_seek(spark):
    events = spark.createDataFrame([(0, 5), (0, 6), (1, 1), (2, 9)], "partition int, checkpoint int")
    last = spark.createDataFrame([(0, 5), (2, 9)], "partition int, checkpoint int")
    assert {tuple(r) for r in resume.skip_seen(events, last).collect()} == {(0, 6), (1, 1)}


def test_snapshot_chunks_cover_each_key_once(spark):
    for ids in ([7], list(range(0, 95, 3))):
        rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
        plan = snapshot.chunk_plan(rows, "id", min_chunk=10).collect()
        assert all(sum(c.lo <= i < c.hi for c in plan) == 1 for i in ids)
    assert snapshot.chunk_plan(spark.createDataFrame([], "id bigint"), "id").count() == 0


def test_sampling(spark):
    changes = spark.range(1000).select(F.lit("t").alias("tbl"), F.col("id").alias("position"), F.lit(0).alias("row_idx"))
    assert validate.one_in(changes, 100).count() == 10


def test_start_positions(spark):
    events = spark.createDataFrame([("u:1", "f1", 10), ("u:2", "f1", 20), ("u:7", "f2", 5), (None, "f2", 6)], "gtid string, file string, position bigint")
    count = lambda start: binlog.start_filter(events, start).count()
    assert count(None) == 4 and count({"gtid_set": "u:1-3:7"}) == 1 + 0 and count({"file": "f1", "position": 10}) == 3
    with pytest.raises(ValueError):
        count({"file": "f1"})


def test_settings():
    assert binlog.flatten_config({"a": {"b": 1, "c": {"d": 2}}, "e": 3}) == {"a.b": 1, "a.c.d": 2, "e": 3}


def test_timestamps_are_utc(spark):
    assert one(spark, decode.timestamp(F.lit(0).cast("long"))).replace(tzinfo=timezone.utc) == datetime(1970, 1, 1, tzinfo=timezone.utc)


def test_ddl_of_unknown_tables_and_namesakes():
    s = ddl.SchemaState()
    s.apply("CREATE TABLE t (a INT)", "x")
    s.apply("CREATE TABLE y.t (b INT)", "x")
    assert {t: [c.name for c in cols] for t, cols in s.tables.items()} == {"x.t": ["a"], "y.t": ["b"]}
    s.apply("ALTER TABLE t ADD (c INT, d DECIMAL(4,2)), RENAME COLUMN a TO z, ALTER c SET DEFAULT 5", "x")
    assert [(c.name, c.default) for c in s.tables["x.t"]] == [("z", None), ("c", "5"), ("d", None)]
    assert [c.name for c in s.apply("ALTER TABLE new MODIFY p BIGINT, CHANGE q r INT AFTER nowhere", "x")[0][2]] == ["p", "r"]
    s.apply("ALTER TABLE t ADD PRIMARY KEY (z), DROP d, RENAME TO u", "x")
    assert [(c.name, c.key) for c in s.tables["x.u"]] == [("z", "PRI"), ("c", "")] and "x.t" not in s.tables


def test_schema_history_of_empty_and_odd_logs(spark):
    log = "position bigint, sql string"
    assert ddl.schema_history(spark.createDataFrame([], log)).count() == 0
    assert ddl.schema_snapshots(spark.createDataFrame([(1, None), (2, "TRUNCATE TABLE t")], log)).count() == 0


def test_bootstrap_statements_make_the_tables(spark):
    cols = [("a.t", 2, "b", "varchar(9)", True, ""), ("a.t", 1, "id", "int unsigned", False, "PRI"), ("a.u", 1, "x", "enum('p','q')", True, "")]
    made = ddl.bootstrap(spark.createDataFrame(cols, "tbl string, ordinal int, name string, column_type string, nullable boolean, key string"))
    found = {r.tbl: r.after for r in ddl.schema_history(made.withColumn("db", F.lit("a"))).collect()}
    assert found == {"a.t": "id int unsigned, b varchar(9)", "a.u": "x enum('p','q')"}


def test_sets_of_64_members(spark):
    members = [f"m{k}" for k in range(64)]
    assert one(spark, decode.set_members(F.lit((1 << 62) + 1).cast("long"), members)) == "m0,m62"
    assert one(spark, decode.set_members(F.lit(-1).cast("long"), members)) is None


def test_values_of_other_types_inside_json():
    def document(kind, data):
        body = bytes([kind, len(data)]) + data
        whole = bytes([1, 0]) + (4 + 4 + 3 + 1 + len(body)).to_bytes(2, "little") + (11).to_bytes(2, "little") + bytes([1, 0, 15]) + (12).to_bytes(2, "little") + b"k" + body
        return bytes([0]) + whole

    packed = lambda y, mo, d, h, mi, s: ((((y * 13 + mo) << 5 | d) << 17 | h << 12 | mi << 6 | s) << 24).to_bytes(8, "little")
    assert decode.json_text(document(246, bytes([4, 2, 0x80 | 12, 34]))) == '{"k":"12.34"}'
    assert decode.json_text(document(246, bytes([4, 2, (0x80 | 12) ^ 0xFF, 34 ^ 0xFF]))) == '{"k":"-12.34"}'
    assert decode.json_text(document(246, bytes([14, 4, 0x81, 0, 0, 0, 7, 0, 5]))) == '{"k":"1000000007.0005"}'
    assert decode.json_text(document(12, packed(2019, 12, 5, 17, 21, 20))) == '{"k":"2019-12-05 17:21:20.000000"}'
    assert decode.json_text(document(10, packed(2019, 12, 5, 0, 0, 0))) == '{"k":"2019-12-05"}'
    assert decode.json_text(document(252, b"ab")) == '{"k":"base64:type252:YWI="}'


def test_later_changes_of_a_microsecond_win(spark):
    """60 changes of a key in one transaction, the last a DELETE; of another key, the value written last is not the largest."""
    rows = [("t", "INSERT" if k == 0 else "UPDATE", ["1"], None if k == 0 else {"v": str(k - 1)}, {"v": str(k)}, k) for k in range(59)]
    rows.append(("t", "DELETE", ["1"], {"v": "58"}, None, 59))
    rows += [("t", "INSERT" if k == 0 else "UPDATE", ["2"], None if k == 0 else {"v": f"{99 - k + 1:03d}"}, {"v": f"{99 - k:03d}"}, 100 + k) for k in range(60)]
    changes = spark.createDataFrame(rows, "tbl string, op string, pk array<string>, before map<string,string>, after map<string,string>, position bigint")
    changes = changes.withColumns({"base_us": F.lit(10**15), "txn_id": F.lit("x"), "xid": F.lit(0).cast("long"), "row_idx": F.lit(0)})
    found = cells.to_cells(txn.row_micros(changes, ["txn_id"], ["pk"], ["position"]))
    assert [(r.row_key.split(";")[1], r.v) for r in read.latest_state(found, ["v"]).collect()] == [("2", "040")]
    assert {(r.row_key.split(";")[1], r.last_status) for r in read.daily_changes(found).collect()} == {("1", "D"), ("2", "U")}
    newest = read.newest_versions(found.filter("qualifier = 'v'"), 1).select("row_key", "value").collect()
    assert {(r.row_key.split(";")[1], r.value) for r in newest} == {("1", "58"), ("2", "040")}
    kept = txn.last_at_same_micros(found, ["tbl", "row_key", "qualifier", "ts_us"], ["position", "row_idx"])
    assert [r.v for r in read.latest_state(kept.select("tbl", "row_key", "qualifier", "ts_us", "value"), ["v"]).collect()] == ["040"]


def follow(times):
    """The sequence of commits as the log gives them, one by one."""
    counter, newest, out = 0, -1, []
    for t in times:
        if counter > 9998:
            counter = 0
        if t > newest:
            counter, newest = 0, t
        elif t == newest:
            counter += 1
        out.append(counter)
    return out


@pytest.mark.parametrize("times", [[5, 5, 4, 5, 5], [1, 3, 2, 2, 3, 4, 1, 4], [7] * 10_002 + [6, 7, 7], [7] * 10_000 + [6, 6, 7, 8]])
def test_sequence_follows_the_log(spark, times):
    commits = spark.createDataFrame([("s", f"f{k // 700:03d}", k % 700, t) for k, t in enumerate(times)], "server string, file string, position bigint, commit_ts_ms bigint")
    found = {(r.file, r.position): r.seq for r in txn.commit_sequence(commits).collect()}
    assert [found[f"f{k // 700:03d}", k % 700] for k in range(len(times))] == follow(times)


def test_servers_have_sequences_of_their_own(spark):
    commits = spark.createDataFrame([(s, "f", p, 1) for s in "ab" for p in range(3)], "server string, file string, position bigint, commit_ts_ms bigint")
    assert sorted((r.server, r.position, r.seq) for r in txn.commit_sequence(commits).collect()) == [(s, p, p) for s in "ab" for p in range(3)]


def test_running_values_cross_files(spark):
    from chronicell.operators import running

    rows = [("a", k // 3, k, v) for k, v in enumerate([None, 5, 2, None, None, 1, None, 7, None, None])]
    log = spark.createDataFrame(rows, "s string, f int, p int, v int")
    args = (["s"], ["f"], ["p"], "x")
    assert [r.x for r in running.last_known(log, F.col("v"), *args).orderBy("p").collect()] == [None, 5, 2, 2, 2, 1, 1, 7, 7, 7]
    assert [r.x for r in running.running_max(log, F.col("v"), *args).orderBy("p").collect()] == [None, 5, 5, 5, 5, 5, 5, 7, 7, 7]
    assert [r.x for r in running.running_count(log, *args).orderBy("p").collect()] == list(range(1, 11))


def test_unknown_table_id_is_an_error(spark):
    log = spark.createDataFrame([(1, 7, None), (2, 7, "db.t")], "position int, id int, name string")
    with pytest.raises(Exception, match="no tbl known"):
        augment.known_before(log, F.col("name"), ["id"], ["position"], "tbl", required=True).collect()
    known = augment.known_before(log.filter("position = 2"), F.col("name"), ["id"], ["position"], "tbl", required=True)
    assert [r.tbl for r in known.collect()] == ["db.t"]


def test_registries(spark):
    rows = spark.createDataFrame([("db", "t_201912", 3, "u:1")], "db string, tbl string, xid bigint, txn_id string")
    assert [(r.tbl, r.orig_tbl) for r in augment.event_filter(rows, "TABLE_MERGE_PATTERN", {"pattern": r"_\d{6}"}).collect()] == [("t", "t_201912")]
    assert augment.event_filter(rows).collect() == rows.collect()
    for name in resume.PARTITIONERS:
        assert rows.select(resume.partition_of(name, rows, 4).alias("p")).first().p in range(4)
    for unknown in (lambda: augment.event_filter(rows, "NO"), lambda: resume.partition_of("NO", rows, 4)):
        with pytest.raises(ValueError):
            unknown()


def test_payload_rows_need_a_transaction(spark):
    row = spark.createDataFrame([("ctx", "INSERT", ["1"], None, {"v": "1"}, 1, None, 0, 1, 0)], CHANGES)
    with pytest.raises(Exception, match="needs a transaction id"):
        cells.to_cells(row, payload_table="ctx").collect()


def test_transactions_off(spark):
    log = spark.createDataFrame([("s", "f", 1, "BEGIN"), ("s", "f", 2, "ROW")], "server string, file string, position bigint, kind string")
    assert txn.assemble(log).count() == 0 and [r.txn_no for r in txn.assemble(log, transactions=False).collect()] == [None, None]
