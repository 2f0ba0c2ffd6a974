"""The stream gives the same cells as the batch, also when it stops and goes on."""

import os

import pytest
from pyspark.sql import functions as F

from chronicell.operators import txn
from chronicell.operators.cells import to_cells
from chronicell.operators.running import present
from chronicell.streaming import flow, metrics, replicate

SCHEMA = "server string, file string, position bigint, kind string, op string, tbl string, pk string, image string, ts_ms bigint"


def event(file, position, kind, ts, tbl=None, pk=None, image=None, server="s"):
    return (server, file, position, kind, "INSERT" if kind == "ROW" else None, tbl, pk, image, ts)


def log():
    """Transactions of 1 to 3 rows, some in one second, some with earlier times, over two files whose positions both begin
    at 0; the last of each file stays open, and there are rows outside of transactions."""
    rows = []
    for f in ("f1", "f2"):
        p = 0
        for t in range(12):
            ts = 1000 * (t // 3 if t % 5 else 1)
            rows.append(event(f, p, "BEGIN", ts))
            for k in range(1 + t % 3):
                p += 1
                rows.append(event(f, p, "ROW", ts, f"T{k % 2}", str((t + k) % 4), f"{f}v{p}"))
            p += 1
            if t < 11:
                rows.append(event(f, p, "XID", ts))
            if t == 4:
                p += 1
                rows.append(event(f, p, "ROW", ts, "T0", "alone", "a"))
            p += 1
    return rows


def cells_of(rows):
    base = txn.commit_micros(F.col("commit_ts_ms"), F.coalesce("seq", F.lit(0)))
    timed = txn.row_micros(rows.withColumn("base_us", base), ["server", "file", "txn_no"], ["tbl", "pk"], ["position"])
    return to_cells(
        timed.select(
            "tbl", "op", F.array("pk").alias("pk"), F.lit(None).cast("map<string,string>").alias("before"), F.create_map(F.lit("v"), "image").alias("after"),
            "ts_us", F.concat_ws("-", F.lit("t"), "file", F.col("txn_no").cast("string")).alias("txn_id"), F.lit(0).cast("long").alias("xid"), "file", "position", "row_idx",
        )
    )


def batch_rows(spark, rows):
    whole = txn.stamp_commits(txn.assemble(spark.createDataFrame(rows, SCHEMA)))
    return whole.filter("kind = 'ROW'").withColumns({"row_idx": F.lit(0), "commit_ts_ms": F.coalesce("commit_ts_ms", "ts_ms")})


def batch_cells(spark, rows):
    return txn.last_at_same_micros(cells_of(batch_rows(spark, rows)), ["tbl", "row_key", "qualifier", "ts_us"], ["file", "position", "row_idx"])


def key(r):
    return (r.tbl, r.row_key, r.qualifier, r.ts_us, r.value)


def run_in_pieces(spark, tmp_path, rows, each):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for k in range(0, len(rows), each):  # files that cut through transactions; the query stops after each
        spark.createDataFrame(rows[k : k + each], SCHEMA).coalesce(1).write.mode("append").json(source)
        events = replicate.assemble_stream(spark.readStream.schema(SCHEMA).json(source))
        replicate.write_stream(events, cells_of, out, check).awaitTermination(120)
    return out


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    rows = log()
    out = run_in_pieces(spark, tmp_path, rows, 17)
    streamed = replicate.read_cells(spark, out)
    want = sorted(map(key, batch_cells(spark, rows).collect()))
    assert streamed.count() >= len(want) > 100
    assert sorted(map(key, replicate.newest_only(streamed).collect())) == want
    assert sorted(x for x in os.listdir(out) if x.startswith("tbl=")) == ["tbl=T0", "tbl=T1"]
    replicate.compact(spark, out, str(tmp_path / "whole"))
    whole = spark.read.parquet(str(tmp_path / "whole"))
    assert whole.count() == len(want) and {r.tbl for r in whole.select("tbl").distinct().collect()} == {"t0", "t1"}


def test_batch_over_file_changes(spark, tmp_path):
    """One batch with two files whose positions overlap, and a transaction that spans batches."""
    rows = [event("f1", 5, "BEGIN", 1), event("f1", 6, "ROW", 1, "T", "1", "a"), event("f1", 7, "XID", 1), event("f2", 1, "BEGIN", 1), event("f2", 2, "ROW", 1, "T", "1", "b"), event("f2", 3, "XID", 1)]
    out = run_in_pieces(spark, tmp_path, rows[::-1], len(rows))
    assert [(r.ts_us, r.value) for r in replicate.read_cells(spark, out).filter("qualifier = 'v'").orderBy("ts_us").collect()] == [(950, "a"), (1050, "b")]


@pytest.mark.parametrize("times", [[5] * 10_001, [5, 5, 4, 5, 5], [5] * 10_000 + [4, 5, 5]])
def test_sequence_is_that_of_the_batch(spark, times):
    got, newest, seq = replicate.follow_sequence(times, -1, 0)
    commits = spark.createDataFrame([("s", f"f{k // 900:02d}", k, t) for k, t in enumerate(times)], "server string, file string, position bigint, commit_ts_ms bigint")
    assert got.tolist() == [r.seq for r in txn.commit_sequence(commits).orderBy("position").collect()]
    half = len(times) // 2
    a, n, s = replicate.follow_sequence(times[:half], -1, 0)
    b, *_ = replicate.follow_sequence(times[half:], n, s)
    assert [*a, *b] == got.tolist()


def test_flow(spark, tmp_path):
    rows = spark.createDataFrame([(k, "db", f"t{k % 3}", None if k == 7 else f"v{k}") for k in range(20)], "position bigint, db string, tbl string, v string")
    seen = []
    own = flow.Flow().filter(F.col("position") > 2).filter(F.col("tbl") != "t1").process(lambda df: df.withColumn("w", F.upper("v"))).process(lambda df: df, keep="w")
    assert {r.position for r in own.transformed(rows).collect()} == {p for p in range(3, 20) if p % 3 != 1 and p != 7}
    spread = own.partition("TABLE_NAME", 4).transformed(rows)
    assert spread.rdd.getNumPartitions() == 4 and spread.groupBy("tbl").agg(F.count_distinct("partition").alias("n")).filter("n > 1").isEmpty()
    done = own.sink(lambda df: seen.append(df.count())).post(lambda df: seen.append("post"))
    assert done.run(rows) and seen == [11, "post"]
    refused = own.sink(lambda df: False).sink(lambda df: seen.append("second")).post(lambda df: seen.append("post"))
    assert not refused.run(rows) and seen == [11, "post"]
    source = str(tmp_path / "in")
    rows.write.json(source)
    stream = spark.readStream.schema(rows.schema).json(source)
    out = str(tmp_path / "out")
    own.sink(lambda df: df.write.mode("append").parquet(out)).start(stream, str(tmp_path / "check")).awaitTermination(60)
    assert spark.read.parquet(out).count() == 11
    with pytest.raises(Exception, match="did not take"):
        refused.start(stream, str(tmp_path / "check2")).awaitTermination(60)


def test_metrics(spark):
    rows = spark.createDataFrame([("t", "INSERT", 5), ("t", "INSERT", 9), ("u", "DELETE", 7)], "tbl string, op string, commit_ts_ms bigint")
    assert {(r.tbl, r.op, r.rows) for r in metrics.row_counters(rows).collect()} == {("t", "INSERT", 2), ("u", "DELETE", 1)}
    out, seen = metrics.observed(rows)
    out.collect()
    assert seen.get == {"rows": 3, "insert": 2, "update": 0, "delete": 1, "oldest_ms": 5, "newest_ms": 9}
    assert metrics.delay_ms(9, 20) == 11 and metrics.delay_ms(None, 20) == 0


def test_a_log_without_server_or_file(spark):
    assert present(spark.range(1), "server", "file") == []
