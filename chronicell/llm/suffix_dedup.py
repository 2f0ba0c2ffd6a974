"""Suffix-array dedup: removes every byte inside a 100-byte string that starts earlier in the corpus.

All suffixes of a corpus need not be sorted together, only those that can share 100 bytes. Every 100-byte window has an
anchor: the leftmost of its K-byte strings of least hash, which depends on the window's content alone. So equal windows
have equal anchors, at equal distance from the window's start, and the work falls apart by anchor:

1. each run of windows with one anchor (a piece: the bytes of those windows) is described by the hashes of anchor and
   content, 48 bits each, its length and the anchor's place; anchors that occur once are dropped, pieces equal in all of
   these are settled by their first occurrence;
2. of the different pieces of one anchor, the suffixes that start at the anchor are put in order by deep-shallow
   sorting, the reversed prefixes before it likewise. With the common prefix lengths of neighbours in both orders, two
   pieces share the window at distance o when they are in one class of depth 100 - o in the first order and in one of
   depth o in the second;
3. what is not a first occurrence is removed.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import free, give_back_memory, materialize, shuffle_width, small_batches, table, text_or_empty
from chronicell.llm.hashing import _BYTE, _Powers, mix

WINDOW, ANCHOR = 100, 32
#: Bytes that the multikey quicksort looks at before the blind tries take over (a multiple of 8).
SHALLOW = 48
#: An anchor is hot when it has more different pieces than so many mean partitions hold, or than one task should sort.
#: Its pieces are dealt out by whole windows, so that no task gets all of them.
HOT_SHARE, HOT_LEAST, HOT_MOST = 2, 256, 200_000
_HELD = 200_000  # pieces that a Python worker holds before it packs them
_SLICE = 1 << 19  # window starts that are hashed at a time; positions must fit in 20 bits
_U = np.uint64


# --- deep-shallow sorting


def blind_trie_order(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """(order, common prefix with the string before) of the strings, by a trie that stores only branching depths.

    A descent looks at one byte for each branch and so may take a wrong turn; comparing with any leaf below tells how
    far the new string really agrees, and there it is inserted. A string that ends sorts before its continuations.
    """
    at = lambda s, d: s[d] if d < len(s) else -1
    root: list = [-1, None, [0]]  # a node: depth, children by byte, or a leaf's equal strings
    for k in range(1, len(strings)):
        s, node = strings[k], root
        while node[1] is not None:
            node = node[1].get(at(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[2][0]]
        n = min(len(s), len(other))
        if s[:n] == other[:n]:
            if len(s) == len(other):
                node[2].append(k)
                continue
            lcp = n
        else:
            lo, hi = 0, n
            while hi - lo > 1:
                mid = (lo + hi) // 2
                if s[:mid] == other[:mid]:
                    lo = mid
                else:
                    hi = mid
            lcp = lo
        parent, node = None, root
        while node[1] is not None and node[0] < lcp:
            parent, node = node, node[1][at(s, node[0])]
        leaf = [-1, None, [k]]
        if node[1] is not None and node[0] == lcp:
            node[1][at(s, lcp)] = leaf
            continue
        branch = [lcp, {at(s, lcp): leaf, at(other, lcp): node}, None]
        if parent is None:
            root = branch
        else:
            parent[1][at(s, parent[0])] = branch
    order, lcps, todo = [], [], [(root, 0)]
    while todo:
        node, lcp = todo.pop()
        if node[1] is None:
            for k in node[2]:
                lcps.append(lcp if not order or k == node[2][0] else len(strings[k]))
                order.append(k)
            continue
        below = sorted(node[1])
        todo += [(node[1][b], node[0] if k else lcp) for k, b in reversed(list(enumerate(below)))]
    return order, lcps


def multikey_quicksort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, segment of each place) of rows of 8-byte words: ternary partitions around a pivot word, all segments
    at once; the equal part goes on with the next word. Rows equal in all words end up in one segment."""
    n, depth_max = words.shape
    order, segment, depth = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    busy = np.arange(n if depth_max else 0)  # places, in order, of segments that are not sorted yet
    while len(busy):
        own = segment[busy]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(np.append(first, len(busy)))
        value = words[order[busy], depth[busy]]
        a, b, c = value[first], value[first + size // 2], value[first + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), size)
        side = np.where(value < pivot, 0, np.where(value == pivot, 1, 2))
        local = np.repeat(np.arange(len(first)), size)
        stable = np.argsort(local * 3 + side, kind="stable")
        order[busy], side, local = order[busy[stable]], side[stable], local[stable]
        new = np.append(True, (side[1:] != side[:-1]) | (local[1:] != local[:-1]))
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        segment[busy] = busy[start][run]  # a segment is named by its first place
        depth[busy] = depth[busy[np.repeat(first, size)]] + (side == 1)
        length = np.diff(np.append(start, len(busy)))[run]
        busy = busy[(length > 1) & (depth[busy] < depth_max)]
    return order, segment


def deep_shallow_sort(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix length with the string before), within groups; groups come in order of their number.

    The common prefix of two strings of different groups counts as -1.
    """
    n = len(strings)
    padded = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").reshape(n, -1).astype(_U)
    words = np.concatenate([group.astype(_U)[:, None], padded], 1)
    order, segment = multikey_quicksort(words)
    lcp = np.empty(n, np.int64)
    size = np.array([len(s) for s in strings])
    # Across segments the words differ, which gives the common prefix without touching the strings.
    raw = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), np.uint8).reshape(n, -1)
    differs = raw[order[1:]] != raw[order[:-1]]
    common = np.where(differs.any(1), differs.argmax(1), SHALLOW)
    lcp[:] = -1
    start = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    for lo, hi in zip(start.tolist(), np.append(start[1:], n).tolist()):
        if hi - lo > 1:  # equal to the shallow depth: blind trie
            own = order[lo:hi].copy()
            found, lcps = blind_trie_order([strings[k] for k in own.tolist()])
            order[lo:hi] = own[found]
            lcp[lo + 1 : hi] = lcps[1:]
    edge = start[1:]
    short = np.minimum(size[order[edge]], size[order[edge - 1]])  # padding does not count as common
    lcp[edge] = np.where(group[order[edge]] == group[order[edge - 1]], np.minimum(common[edge - 1], short), -1)
    return order, lcp


def repeated_windows(contents: list[bytes], group: np.ndarray, anchor: np.ndarray, n: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """(pieces, WINDOW - ANCHOR + 1) booleans: at distance o, the piece's window there occurs in a piece of lower rank.

    Pieces of one group share their anchor, ``anchor`` bytes after the piece's start; n is the number of windows.
    """
    count, far = len(contents), WINDOW - ANCHOR
    right, right_lcp = deep_shallow_sort([c[a:] for c, a in zip(contents, anchor.tolist())], group)
    left, left_lcp = deep_shallow_sort([c[:a][::-1] for c, a in zip(contents, anchor.tolist())], group)
    out = np.zeros((count, far + 1), bool)
    place_r, place_l = np.empty(count, np.int64), np.empty(count, np.int64)
    place_r[right], place_l[left] = np.arange(count), np.arange(count)
    for o in range(far + 1):
        own = np.flatnonzero((o <= anchor) & (o > anchor - n))  # the window starts at anchor - o, in 0 ... n - 1
        if len(own) < 2:
            continue
        class_r, class_l = np.cumsum(right_lcp < WINDOW - o), np.cumsum(left_lcp < o)
        key = class_r[place_r[own]] * (count + 1) + class_l[place_l[own]]
        by = np.lexsort((rank[own], key))
        again = np.append(False, key[by][1:] == key[by][:-1])
        out[own[by[again]], o] = True
    return out


# --- anchors and pieces


def pieces_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window start in the text, windows, anchor's distance, anchor hash, content hash) of all pieces.

    Texts lie one after another in data, at starts, and are of at least WINDOW bytes. Hashes have 48 bits.
    """
    up, down = _Powers.upto(len(data))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTE[data] * up)])
    h = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(data) - ANCHOR + 1])
    low = _U((1 << 20) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=_U)  # of equal hashes, the leftmost
    width, size = WINDOW - ANCHOR + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(h) - width + 1], least[width - size : width - size + len(h) - width + 1])
    n_windows = sizes - WINDOW + 1
    text = np.repeat(np.arange(len(starts)), n_windows)
    inner = np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    window = starts[text] + inner
    place = (least[window] & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])))
    n = np.diff(np.append(first, len(text)))
    at = window[first]
    content = mix((sums[at + n - 1 + WINDOW] - sums[at]) * down[at] + n.astype(_U))
    return text[first], inner[first], n, place[first] - at, (h[place[first]] >> _U(16)).astype(np.int64), (content >> _U(16)).astype(np.int64)


def _slices(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, offset in the text, start in data, size, data) of parts that cover every window once."""
    parts: list[tuple[int, int, bytes]] = []
    total = 0

    def packed():
        size = np.array([len(p) for _, _, p in parts])
        data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        return np.array([r for r, _, _ in parts]), np.array([o for _, o, _ in parts]), np.cumsum(size) - size, size, data

    for row, text in enumerate(texts):
        for offset in range(0, max(len(text) - WINDOW + 1, 0), _SLICE):
            part = text[offset : offset + _SLICE + WINDOW - 1]
            if parts and total + len(part) > _SLICE:
                yield packed()
                parts, total = [], 0
            parts.append((row, offset, part))
            total += len(part)
    if parts:
        yield packed()


_FIELDS = (("h", 6), ("content", 6), ("doc_id", 8), ("fp", 8), ("s", 4), ("n", 1), ("a", 1))
_PIECE_SQL = "h bigint, content bigint, doc_id bigint, fp bigint, s int, n tinyint, a tinyint"
_PIECE_TYPES = ("i8", "i8", "i8", "i8", "i4", "i1", "i1")


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of whole numbers as byte planes (h, sorted, as differences), compressed."""
    planes = [np.diff(columns[0], prepend=0)] + columns[1:]
    raw = [np.ascontiguousarray(c.astype("<i8")).view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for c, (_, w) in zip(planes, _FIELDS)]
    return zstandard.compress(len(columns[0]).to_bytes(8, "little") + b"".join(raw), 1)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for _, w in _FIELDS:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :w] = np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n).T
        out.append(wide.view("<i8").ravel())
        at += n * w
    out[0] = np.cumsum(out[0])
    return out


def _packed_pieces(found: list, ranges: int, turn: int) -> pa.RecordBatch:
    """Pieces, packed by range of their anchor's hash. What repeats among them is already known to repeat: it goes to
    any range, and the anchor's own range only hears that it does (a piece of 0 windows). So a frequent anchor costs
    its range one entry for each call at most."""
    columns = [np.concatenate(c) for c in zip(*found)]
    by = np.argsort(columns[0], kind="stable")
    columns = [c[by] for c in columns]
    new = np.append(True, columns[0][1:] != columns[0][:-1])
    alone = new & np.append(new[1:], True)
    multi = new & ~alone
    entries = [np.where(multi, 0, c)[new] if k else c[new] for k, c in enumerate(columns)]
    keys, blobs = [], []
    bounds = np.searchsorted(entries[0], (np.arange(ranges + 1) << 48) // ranges)
    for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        if hi > lo:
            keys.append(k)
            blobs.append(_pack([c[lo:hi] for c in entries]))
    known = [c[~alone] for c in columns]
    for lo in range(0, len(known[0]), 1 << 14):
        keys.append(ranges + (turn + lo + int(columns[0][0])) % ranges)
        blobs.append(_pack([c[lo : lo + (1 << 14)] for c in known]))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["part", "packed"])


def _describe(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = []
        n = turn = 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            fps = batch.column("fp").to_numpy()
            for row, offset, starts, sizes, data in _slices(batch.column("text").cast(pa.binary()).to_pylist()):
                text, s, windows, a, h, content = pieces_of(data, starts, sizes)
                found.append((h, content, ids[row[text]], fps[row[text]], s + offset[text], windows, a))
                n += len(h)
                if n >= _HELD:
                    turn += 1
                    yield _packed_pieces(found, ranges, turn)
                    found, n = [], 0
        if found:
            yield _packed_pieces(found, ranges, turn)
        found = []
        give_back_memory()

    return run


def _repeating(ranges: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        give_back_memory()
        columns = [np.concatenate(c) for c in zip(*[_unpack(x.as_py()) for x in group.column("packed")])]
        if key[0].as_py() < ranges:
            by = np.argsort(columns[0], kind="stable")
            columns = [c[by] for c in columns]
            new = np.append(True, columns[0][1:] != columns[0][:-1])
            alone = new & np.append(new[1:], True)
            keep = ~alone & (columns[5] > 0)
            columns = [c[keep] for c in columns]
        return pa.table([c.astype(t) for c, t in zip(columns, _PIECE_TYPES)], names=[f for f, _ in _FIELDS])

    return run


# --- removal


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("fp").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist())
        out = [(w["h"], i, fp, w["s"], w["n"], w["a"], t[w["s"] : w["s"] + w["n"] - 1 + WINDOW]) for i, fp, t, wanted in rows for w in wanted]
        names = ["h", "doc_id", "fp", "s", "n", "a"]
        yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in out], pa.int64()) for k in range(6)), pa.array([r[6] for r in out], pa.binary())], [*names, "content"])


def _intervals(table_: pa.Table) -> pa.RecordBatch:
    """Removed (doc_id, fp, start, stop) of whole groups of pieces."""
    h, doc, fp, s, n, a = (table_.column(c).to_numpy() for c in ("h", "doc_order", "fp", "s", "n", "a"))
    group = np.unique(h, return_inverse=True)[1]
    rank = np.empty(len(h), np.int64)
    rank[np.lexsort((s + a, fp, doc))] = np.arange(len(h))
    again = repeated_windows(table_.column("content").to_pylist(), group, a, n, rank)
    piece, o = np.nonzero(again)
    start = s[piece] + a[piece] - o
    by = np.lexsort((start, piece))
    piece, start = piece[by], start[by]
    new = np.append(True, (piece[1:] != piece[:-1]) | (start[1:] != start[:-1] + 1)) if len(piece) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(piece)) - 1 if len(piece) else first
    owner = pa.array(piece[first])
    return pa.RecordBatch.from_arrays([table_.column("doc_id").combine_chunks().take(owner), pa.array(fp[piece[first]]), pa.array(start[first].astype("i4")), pa.array((start[last] + WINDOW).astype("i4"))], ["doc_id", "fp", "start", "stop"])


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by h; the last group of a batch waits for the next one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        at = int(np.flatnonzero(h == h[-1])[0])
        if at or (held and held[-1].column("h")[0].as_py() != h[0]):
            whole = [*held, batch.slice(0, at)]
            yield _intervals(pa.Table.from_batches(whole))
            held = []
        held.append(batch.slice(at))
    if held:
        yield _intervals(pa.Table.from_batches(held))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        take, start, window = [], [], []
        for k, (s, n, c) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("s", "n", "content")))):
            take += [k] * n
            start += range(s, s + n)
            window += [c[i : i + WINDOW] for i in range(n)]
        take = pa.array(take, pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("fp").take(take), pa.array(start, pa.int32()), pa.array(window, pa.binary())], ["doc_id", "fp", "start", "w"])


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs); runs that touch are one."""
    kept, at, removed, runs = [], 0, 0, 0
    last = -1
    for start, stop in sorted(spans):
        if start > last:
            kept.append(text[max(last, 0) : start])
            runs += 1
            at, last = start, stop
        else:
            last = max(last, stop)
    kept.append(text[max(last, 0) :])
    out = b"".join(kept)
    removed = len(text) - len(out)
    return out, removed, runs


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [remove_spans(t, [(x["start"], x["stop"]) for x in spans or ()]) for t, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist())]
        rest = [batch.column(k) for k, name in enumerate(batch.schema.names) if name != "spans"]
        names = [x for x in batch.schema.names if x != "spans"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array([len(o) + r for o, r, _ in out], pa.int64()), pa.array([r for _, r, _ in out], pa.int64()), pa.array([k for _, _, k in out], pa.int64()), pa.array([o for o, _, _ in out], pa.binary())], [*names, "n_bytes", "n_removed", "n_spans", "kept"])


def _release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that have served, and let Spark's cleaner drop the shuffle files of stages whose result has been
    written. The cleaner acts when the driver's heap is collected, which may not happen for half an hour; it drops only
    shuffles that nothing can read any more, so a lost executor costs no more than without it."""
    free(*tables)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_bytes, n_removed, n_spans, kept (binary); one row for each row.

    Earlier means a smaller id (null ids first; among rows that share an id but not a text, a smaller text hash), or an
    earlier start in the same document. Rows that repeat an id and a text are one document and are treated alike.
    Null texts count as empty; texts under WINDOW bytes lose nothing. A cut may fall inside a character, hence binary.
    An empty table gives no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    shared_ids = not own.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    has_null = not own.filter("doc_id IS NULL").isEmpty()
    if has_null:  # numbers only below: null ids become a number of their own, below all others
        own = own.withColumn("_id", F.col("doc_id")).withColumn("doc_id", F.coalesce("doc_id", F.lit(-(2**63))))
    own = own.withColumn("fp", F.xxhash64("text") if shared_ids else F.lit(0).cast("long"))
    ranges = max(256, 4 * shuffle_width(spark))
    packed = own.select("doc_id", "fp", "text").mapInArrow(_describe(ranges), "part int, packed binary")
    pieces = materialize(packed.groupBy("part").applyInArrow(_repeating(ranges), _PIECE_SQL), "suffix-pieces")
    _release(spark)
    first = F.min(F.struct("doc_id", "fp", "s")).alias("first")
    firsts = materialize(pieces.groupBy("h", "content", "n", "a").agg(first), "suffix-firsts")
    known = firsts.select("h", "content", "first")
    again = pieces.join(known, ["h", "content"]).filter(F.struct("doc_id", "fp", "s") > F.col("first"))
    stop = (F.col("s") + F.col("n") - 1 + WINDOW).cast("int").alias("stop")
    spans = [materialize(again.select("doc_id", "fp", F.col("s").alias("start"), stop), "suffix-copies")]
    sizes = firsts.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1")
    different = materialize(firsts.join(sizes, "h").select("h", "n", "a", "first.*", "m"), "suffix-different")
    _release(spark, pieces, firsts)
    limit = min(HOT_MOST, max(HOT_LEAST, HOT_SHARE * different.count() // shuffle_width(spark)))
    for hot in (False, True):
        chosen = different.filter(F.col("m") > limit if hot else F.col("m") <= limit)
        if chosen.isEmpty():
            continue
        wanted = chosen.groupBy("doc_id", "fp").agg(F.collect_list(F.struct("h", "s", "n", "a")).alias("wanted"))
        read = own.select("doc_id", "fp", "text").dropDuplicates(["doc_id", "fp"]) if shared_ids else own.select("doc_id", "fp", "text")
        cut = read.join(wanted, ["doc_id", "fp"]).mapInArrow(_cut_pieces, "h bigint, doc_id bigint, fp bigint, s bigint, n bigint, a bigint, content binary")
        if hot:
            windows = materialize(cut.mapInArrow(_windows, "doc_id bigint, fp bigint, start int, w binary"), "suffix-windows")
            least = windows.groupBy("w").agg(F.min(F.struct("doc_id", "fp", "start")).alias("first"))
            found = windows.join(least, "w").filter(F.struct("doc_id", "fp", "start") > F.col("first"))
            found = found.select("doc_id", "fp", "start", (F.col("start") + WINDOW).alias("stop"))
        else:
            grouped = cut.withColumn("doc_order", F.col("doc_id")).repartition(shuffle_width(spark), "h").sortWithinPartitions("h")
            found = grouped.mapInArrow(_sort_groups, "doc_id bigint, fp bigint, start int, stop int")
        spans.append(materialize(found, "suffix-spans"))
        _release(spark, *([windows] if hot else []))
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    by_doc = materialize(every.groupBy("doc_id", "fp").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")), "suffix-removed")
    _release(spark, different, *spans)
    joined = own.join(by_doc, ["doc_id", "fp"], "left").select((F.col("_id") if has_null else F.col("doc_id")).alias("doc_id"), "text", "spans")
    return joined.mapInArrow(_remove, "doc_id bigint, text string, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
