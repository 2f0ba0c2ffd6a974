r"""Line dedup: range-partitioned line hashes, streamed in order, answered by per-document keep bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import SPACE, give_back_memory, materialize, shuffle_width, small_batches, table, text_or_empty

MIN_CHARS, MIN_DOCS = 20, 3
_STRIP = SPACE.encode()
_OCC = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64()), ("pos", pa.int32())])
_OCC_SQL = "h1 bigint, h2 bigint, doc_id bigint, fp bigint, pos int"
_MARK = pa.schema([*_OCC, ("open", pa.bool_())])


def line_key(line: bytes) -> bytes:
    """What makes two lines equal: white space stripped at both ends, A-Z lower-cased (bytes.lower is ASCII only)."""
    return line.strip(_STRIP).lower()


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches cut up, so that only few texts are copied at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _occurrences(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            docs, fps = batch.column("doc_id"), batch.column("fp")
            digests, rows, places = [], [], []
            for r, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                for pos, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    n = len(key)
                    if n >= min_chars and (n >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(r)
                        places.append(pos)
            halves = np.frombuffer(b"".join(digests), ">i8").astype("i8").reshape(-1, 2)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), docs.take(take), fps.take(take), pa.array(places, pa.int32())], schema=_OCC)
        give_back_memory()

    return run


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before (the first row: True)."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _judge(batch: pa.RecordBatch, min_docs: int) -> pa.RecordBatch:
    """Of whole runs of equal keys, in order: the rows that go (the first document of a run is the largest one)."""
    h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
    null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
    doc = batch.column("doc_id").fill_null(0).to_numpy()
    key = _changes(h1, h2)
    new_doc = _changes(h1, h2, doc, null)
    starts = np.flatnonzero(key)
    run = np.cumsum(key) - 1
    n_docs = np.add.reduceat(new_doc.astype("i8"), starts)
    other = (doc != doc[starts][run]) | (null != null[starts][run])
    gone = batch.filter(pa.array((n_docs[run] >= min_docs) & other))
    return pa.RecordBatch.from_arrays([*gone.columns, pa.array(np.zeros(gone.num_rows, bool))], schema=_MARK)


def _stream(min_docs: int):
    """Stream sorted rows; runs that touch an end of the partition may go on in its neighbour and come out open."""

    def opened(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts:
            yield pa.RecordBatch.from_arrays([*p.columns, pa.array(np.ones(p.num_rows, bool))], schema=_MARK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the run that is not known to have ended
        key, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(_changes(batch.column("h1").to_numpy(), batch.column("h2").to_numpy()))
            goes_on = key == (batch.column("h1")[0].as_py(), batch.column("h2")[0].as_py())
            bounds = [*starts.tolist(), batch.num_rows]
            if goes_on:
                held.append(batch.slice(0, bounds[1]))
                bounds = bounds[1:]
            if len(bounds) > 1:  # a new run begins here: what is held has ended
                if first and held:
                    yield from opened(held)
                    first, held = False, []
                elif held:
                    yield _judge(pa.Table.from_batches(held).combine_chunks().to_batches()[0], min_docs)
                if first and len(bounds) > 2:
                    yield from opened([batch.slice(bounds[0], bounds[1] - bounds[0])])
                    first, bounds = False, bounds[1:]
                if len(bounds) > 2:
                    yield _judge(batch.slice(bounds[0], bounds[-2] - bounds[0]), min_docs)
                held = [batch.slice(bounds[-2], bounds[-1] - bounds[-2])]
            key = (batch.column("h1")[batch.num_rows - 1].as_py(), batch.column("h2")[batch.num_rows - 1].as_py())
        yield from opened(held)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, gone = [], []
        for n, places in zip(batch.column("n_lines").to_pylist(), batch.column("places").to_pylist()):
            keep = np.ones(max(places) + 8 & ~7 if n is None else n, np.uint8)  # whole bytes: what pads them must not say 0
            if places:
                keep[places] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            gone.append(len(places or ()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fp"), batch.column("n_lines"), pa.array(gone, pa.int64()), pa.array(maps, pa.binary())], ["doc_id", "fp", "n_lines", "n_dropped", "keep_bitmap"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (null: empty) and fp, which tells apart rows that share an id but not a text."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))


_BITMAPS = "doc_id bigint, fp bigint, n_lines bigint, n_dropped bigint, keep_bitmap binary"


def _n_lines(text: str) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1).cast("long")


def _dropped_places(keyed: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(_doc, _fp, places): the lines that go, of documents that lose any."""
    small_batches(keyed.sparkSession)
    found = materialize(keyed.mapInArrow(_occurrences(min_chars), _OCC_SQL), "line-hashes", narrow=False)
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("fp"), F.col("pos")]
    ranged = found.repartitionByRange(shuffle_width(keyed.sparkSession), *order).sortWithinPartitions(*order)
    marks = materialize(ranged.mapInArrow(_stream(min_docs), f"{_OCC_SQL}, open boolean"), "line-marks")
    ends = marks.filter("open").select("h1", "h2", "doc_id")
    known = ends.distinct().groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("largest")).filter(F.col("n_docs") >= min_docs)
    late = marks.filter("open").join(F.broadcast(known), ["h1", "h2"]).filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("largest")))
    gone = marks.filter("NOT open").select("doc_id", "fp", "pos").unionByName(late.select("doc_id", "fp", "pos"))
    return gone.groupBy("doc_id", "fp").agg(F.collect_set("pos").alias("places")).withColumnsRenamed({"doc_id": "_doc", "fp": "_fp"})


def line_keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    r"""One row for each different (id, text): doc_id, fp, n_lines, n_dropped, keep_bitmap. No text is shuffled.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs`` documents stays only
    in the document with the largest id. Lines travel as 128-bit hashes with document and position. They are
    range-partitioned by (hash, document descending, position) and sorted so; one pass over each partition sees the
    largest document of a key first and marks the rest. The range includes the document, so a key that a third of all
    documents share is split over many partitions; the keys at a partition's two ends are settled afterwards from
    their counts (two keys for each partition at most, hence broadcast).

    keep_bitmap is zlib over big-endian bits, one for each ``\n``-split line, 1 to keep. Null and empty texts are one
    empty line, which stays. A null id counts as one document below all others. Repeated rows share one bitmap. An
    empty table gives none. Other columns are ignored.
    """
    keyed = _keyed(docs, id_col, text_col)
    places = _dropped_places(keyed, min_chars, min_docs)
    sizes = keyed.select("doc_id", "fp", _n_lines("text").alias("n_lines")).distinct()
    joined = sizes.join(places, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("fp") == F.col("_fp")), "left")
    return joined.select("doc_id", "fp", "n_lines", "places").mapInArrow(_bitmaps, _BITMAPS)


def _kept_text(text: bytes, n: int, bitmap: bytes) -> bytes:
    """Lines after the bitmap's last bit stay."""
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n].tolist()
    lines = text.split(b"\n")
    return b"\n".join([line for line, k in zip(lines, keep) if k] + lines[len(keep) :])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        cols = (batch.column(c).to_pylist() for c in ("n_lines", "n_dropped", "keep_bitmap"))
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        out = [_kept_text(t, n, b) if d else t for t, n, d, b in zip(texts, *cols)]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, pa.field("text", pa.string()), pa.array(out, pa.binary()).cast(pa.string()))
    give_back_memory()


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    r"""The documents with their bitmaps applied: all columns, text without the dropped lines, n_lines and n_dropped.

    A null text stays null. A document may end up empty. Columns named n_lines or n_dropped are replaced. Only documents
    that lose lines have a bitmap (up to the last line that goes); texts meet them in a join by document, which is the
    one shuffle of texts.
    """
    lost = _dropped_places(_keyed(docs, id_col, text_col), min_chars, min_docs).select(F.col("_doc").alias("doc_id"), F.col("_fp").alias("fp"), F.lit(None).cast("long").alias("n_lines"), "places")
    maps = materialize(lost.mapInArrow(_bitmaps, _BITMAPS), "line-bitmaps").select(F.col("doc_id").alias("_doc"), F.col("fp").alias("_fp"), F.col("n_dropped").alias("_d"), "keep_bitmap")
    rest = docs.drop("n_lines", "n_dropped")
    fp = F.xxhash64(text_or_empty(text_col))
    own = rest.withColumn("_had_text", F.col(text_col).isNotNull()).withColumn("_key", fp)
    joined = own.join(maps.hint("merge"), F.col(id_col).cast("long").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_fp")), "left")
    joined = joined.select(*[F.col(c) for c in rest.columns if c != text_col], text_or_empty(text_col).alias("text"), "_had_text", F.coalesce("_d", F.lit(0)).cast("long").alias("n_dropped"), "keep_bitmap").withColumn("n_lines", _n_lines("text"))
    out = joined.mapInArrow(_apply, joined.schema)
    text = F.when(F.col("_had_text"), F.col("text")).alias(text_col)
    return out.select(*[text if c == text_col else F.col(c) for c in rest.columns], "n_lines", "n_dropped")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"))


_SP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEY = f"translate(trim(line, {_SP}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def line_dedup_ctes(docs: str) -> str:
    """CTEs up to deduped(rid, n_lines, n_dropped, kept): a row for each row of ``docs`` numbered by rid."""
    return f"""
numbered AS (SELECT row_number() OVER () AS rid, doc_id, text FROM {docs}),
lines AS (SELECT rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM numbered),
keyed AS (SELECT *, {_KEY} AS k FROM lines),
common AS (SELECT k, max(doc_id) AS largest FROM keyed WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= {MIN_DOCS}),
deduped AS (SELECT rid, count(*)::BIGINT AS n_lines, count(*) FILTER (largest > doc_id OR (doc_id IS NULL AND largest IS NOT NULL))::BIGINT AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (largest IS NULL OR largest <= doc_id), '') AS kept
  FROM keyed LEFT JOIN common USING (k) GROUP BY rid)"""


OP7_SQL = f"""
WITH {line_dedup_ctes("documents")}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM numbered JOIN deduped USING (rid)
"""
