"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A document is the weighted set of its 5-word shingles; the weight of a shingle is its count in the document times its
idf. The idf of a shingle is the mean of its words' idf, ln(1 + N / df), with df counted over all N documents by the
hashing trick: one exact count for each of BUCKETS hash values of words, so the table has one size whatever the corpus.
(A shingle's own df would say how often its text was copied: in a group of a thousand near copies what they share would
weigh a third of what tells them apart, and the group would fall apart.) Weights are whole numbers, in units of
1 / IDF_UNIT, so sums and the comparison with the threshold are exact. Two documents are linked at a weighted Jaccard
similarity of at least 0.8; classes are the connected components of the links; equal texts are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import free, give_back_memory, materialize, small_batches, table, text_or_empty
from chronicell.llm.hashing import mix, shingles_of, word_hashes

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 14, 3
#: Hash values of words that have a document frequency each: the size of what is collected and broadcast.
BUCKETS = 1 << 18
#: Weights are multiples of 1 / IDF_UNIT, the mean of whole multiples of 1 / WORD_UNIT, rounded; an idf of up to
#: 255 / IDF_UNIT = 31.9 (N / df = 7e13) has a weight of its own.
IDF_UNIT, WORD_UNIT = 8, 1024
#: Groups of at most so many texts compare every pair that is not in one class; larger ones go on as told below, in
#: blocks of so many texts.
SMALL_BUCKET, BLOCK = 32, 1000
#: Turns in which the texts of a large mixed bucket are compared with one of its largest class, before all is compared that is
#: left: they change no result, but spare most of that work where a bucket is one large group of near copies.
LEADERS = 3
#: In the prefix filter, tokens in at least this share of the sets come last.
OFTEN = 0.005
_SLICE = 1 << 19  # bytes of text that are hashed at a time: the arrays then stay in a core's cache
_U = np.uint64


def _sliced(texts: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, row after the last, lower-cased texts) of slices; only one slice is copied at a time."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    lo = size = 0
    for k in range(len(texts) + 1):
        if k == len(texts) or (size and size + sizes[k] > _SLICE):
            if k > lo:
                yield lo, k, [t.lower().encode() for t in texts.slice(lo, k - lo).to_pylist()]
            lo, size = k, 0
        if k < len(texts):
            size += int(sizes[k])


# --- document frequencies


def word_buckets(words: np.ndarray) -> np.ndarray:
    return (words >> _U(64 - (BUCKETS - 1).bit_length())).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for lo, hi, texts in _sliced(batch.column("text")):
            words, n = word_hashes(texts)
            once = np.unique(np.repeat(np.arange(hi - lo), n) * BUCKETS + word_buckets(words))
            total += np.bincount(once % BUCKETS, minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "df"])
    give_back_memory()


def word_idf(texts: DataFrame) -> np.ndarray:
    """The idf of each of the BUCKETS hash values of words, from all documents (text), in units of 1 / WORD_UNIT; what no
    word has is as rare as can be."""
    n_docs = texts.count()
    found = texts.mapInArrow(_count_words, "bucket int, df bigint").groupBy("bucket").agg(F.sum("df").alias("df")).toArrow()
    df = np.ones(BUCKETS)
    df[found.column("bucket").to_numpy()] = found.column("df").to_numpy()
    return np.rint(np.log1p(n_docs / df) * WORD_UNIT).astype(np.int64)


def weighted_shingles(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, weights, their number for each text): the weighted set of each text, one after another, each sorted."""
    words, counts = word_hashes(texts)
    h, n = shingles_of(words, counts, WIDTH)
    if not len(h):
        return h, np.zeros(0, np.int64), n
    sums = np.append(0, np.cumsum(idf[word_buckets(words)]))
    starts = np.cumsum(counts) - counts
    first = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    width = np.minimum(np.repeat(counts, n), WIDTH)
    per = WORD_UNIT // IDF_UNIT * width
    unit = np.clip((2 * (sums[first + width] - sums[first]) + per) // (2 * per), 1, 255)
    order = np.lexsort((h, np.repeat(np.arange(len(n)), n)))
    h, unit, doc = h[order], unit[order], np.repeat(np.arange(len(n)), n)
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
    return h[new], np.add.reduceat(unit, new), np.bincount(doc[new], minlength=len(n))


# --- signatures


def _gamma_2_1(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of n equal steps, by bisection on 1 - (1 + x) exp(-x)."""
    p, lo, hi = (np.arange(n) + 0.5) / n, np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return lo


class Sampler:
    """Improved consistent weighted sampling (Ioffe 2010): for each of its hash functions, one (shingle, t) of a set.

    r and c are Gamma(2, 1) and beta uniform, all read from 16 bits each of a hash of (shingle, function).
    """

    def __init__(self, samples: int):
        r = _gamma_2_1(1 << 16)
        self.r, self.per_r, self.log_c = r.astype(np.float32), (1 / r).astype(np.float32), np.log(r).astype(np.float32)
        self.beta = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
        self.seeds = mix(np.arange(1, samples + 1, dtype=_U) * _U(0xD6E8FEB86659FD93))

    def sample(self, h: np.ndarray, log_weight: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sets lie one after another in h (none of them empty); returns an array of (sets, samples)."""
        out = np.empty((len(starts), len(self.seeds)), _U)
        low = _U(0xFFFF)
        log_weight = log_weight.astype(np.float32)
        owner = np.repeat(np.arange(len(starts)), counts)
        for k, seed in enumerate(self.seeds):
            x = (h ^ seed) * _U(0xBF58476D1CE4E5B9)
            x ^= x >> _U(32)
            x *= _U(0x94D049BB133111EB)
            i, beta = (x >> _U(48)).astype(np.int32), self.beta[(x >> _U(16) & low).astype(np.int32)]
            r = self.r[i]
            t = np.floor(log_weight * self.per_r[i] + beta)
            log_a = self.log_c[(x >> _U(32) & low).astype(np.int32)] - r * (t - beta + 1)
            least = np.flatnonzero(log_a == np.minimum.reduceat(log_a, starts)[owner])
            doc = owner[least]
            least = least[np.append(True, doc[1:] != doc[:-1])]
            out[:, k] = mix(h[least] ^ mix(t[least].astype(np.int64).view(_U) + seed))
        return out


def pack(h: np.ndarray, weight: np.ndarray) -> bytes:
    """A weighted set as bytes: 32 bits of each sorted hash, as differences by byte planes, and the weights."""
    short = (h >> _U(32)).astype(np.uint32)
    large = np.flatnonzero(weight > 255).astype(np.uint32)
    planes = np.diff(short, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()
    raw = np.array([len(h), len(large)], np.uint32).tobytes() + planes + weight.astype(np.uint8).tobytes() + large.tobytes() + weight[large].astype(np.int64).tobytes()
    return zstandard.compress(raw, 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    n, m = np.frombuffer(raw, np.uint32, 2).tolist()
    planes = np.frombuffer(raw, np.uint8, 4 * n, 8).reshape(4, n)
    short = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)
    weight = np.frombuffer(raw, np.uint8, n, 8 + 4 * n).astype(np.int64)
    weight[np.frombuffer(raw, np.uint32, m, 8 + 5 * n)] = np.frombuffer(raw, np.int64, m, 8 + 5 * n + 4 * m)
    return short, weight


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """(sum of the smaller weights, sum of the larger ones); 0 and 0 for two empty sets."""
    (ha, wa), (hb, wb) = a, b
    at = np.minimum(np.searchsorted(hb, ha), max(len(hb) - 1, 0))
    hit = hb[at] == ha if len(hb) else np.zeros(len(ha), bool)
    common = int(np.minimum(wa[hit], wb[at[hit]]).sum()) if hit.any() else 0
    return common, int(wa.sum()) + int(wb.sum()) - common


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float) -> bool:
    common, union = weighted_jaccard(a, b)
    return common > 0 and common >= threshold * union


def _signatures(idf, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands * rows)
        salt = mix(np.arange(1, bands + 1, dtype=_U))
        for batch in batches:
            first: dict[bytes, int] = {}
            own = [first.setdefault(x, len(first)) for x in batch.column("node").to_pylist()]  # equal texts of a batch are sampled once
            pick = sorted({x: k for k, x in reversed(list(enumerate(own)))}.values())
            mine: list = [None] * batch.num_rows
            for lo, hi, texts in _sliced(batch.column("text").take(pa.array(pick, pa.int32()))):
                h, weight, counts = weighted_shingles(texts, idf.value)
                full = np.flatnonzero(counts)
                if len(full):
                    ends = np.cumsum(counts)
                    samples = sampler.sample(h, np.log(weight), (ends - counts)[full], counts[full]).reshape(len(full), bands, rows)
                    key = np.broadcast_to(salt, (len(full), bands))
                    for k in range(rows):
                        key = mix(key * _U(0x9E3779B97F4A7C15) + samples[:, :, k])
                    for k, row in zip(full.tolist(), key.view(np.int64).tolist()):
                        mine[pick[lo + k]] = row
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(mine, pa.list_(pa.int64()))], ["doc_id", "node", "keys"])
        give_back_memory()

    return run


def _packed(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: list[bytes] = []
            for _, _, texts in _sliced(batch.column("text")):
                h, weight, counts = weighted_shingles(texts, idf.value)
                ends = np.cumsum(counts)
                packed += [pack(h[e - c : e], weight[e - c : e]) for e, c in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], ["node", "packed"])
        give_back_memory()

    return run


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, left = [], None, None
            for a, x, y in zip(*(batch.column(c) for c in ("a", "packed_a", "packed_b"))):  # one row's sets at a time
                if a != last:
                    last, left = a, unpack(x.as_py())
                keep.append(similar(left, unpack(y.as_py()), threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back_memory()

    return run


# --- exact search among the texts of large mixed buckets


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            tokens = np.concatenate([unpack(x)[0] for x in batch.column("packed").to_pylist()])
            token, n = np.unique(tokens, return_counts=True)
            keep = n >= max(4, OFTEN * batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(token[keep].astype(np.int64)), pa.array(n[keep])], ["key", "n"])


def prefix_tokens(tokens: np.ndarray, weight: np.ndarray, often: np.ndarray, times: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of a set, rare ones first, after which less than ``threshold`` of its weight is left; with each
    the weight of the set from there on.

    All sets use one order (how often the token is known to occur, then its hash). Two sets whose prefixes have no token
    in common share less than ``threshold`` of the weight of one of them, hence are less similar than that.
    """
    count = np.zeros(len(tokens), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
        hit = often[at] == tokens
        count[hit] = times[at[hit]]
    order = np.lexsort((tokens, count))
    total = float(weight.sum(dtype=np.float64))
    left = total - np.cumsum(weight[order], dtype=np.float64)
    n = min(len(order), int(np.count_nonzero(left >= threshold * total - 1e-4)) + 1)
    return tokens[order[:n]], left[:n] + weight[order[:n]]


def _prefixes(often, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [prefix_tokens(*unpack(x), *often.value, threshold) for x in batch.column("packed").to_pylist()]
            take = pa.array(np.repeat(np.arange(len(found)), [len(x) for x, _ in found]), pa.int32())
            tokens, left = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0), np.zeros(0))
            shared = np.minimum(left, batch.column("shared").take(take).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), batch.column("node").take(take), batch.column("total").take(take), pa.array(shared)], ["key", "node", "total", "shared"])

    return run


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [unpack(x) for x in batch.column("packed").to_pylist()]
        take = pa.array(np.repeat(np.arange(len(found)), [len(x) for x, _ in found]), pa.int32())
        tokens, weight = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0), np.zeros(0))
        yield pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), batch.column("node").take(take), pa.array(weight.astype(np.float64))], ["key", "node", "w"])


def prefix_groups(sets: DataFrame, threshold: float) -> DataFrame:
    """(key, node, total, shared, n): the sets (node, packed) by the tokens of their prefixes, as far as they can be
    similar to another set of their group; total is a set's weight, shared the most that it can have in common with a
    set that it meets at this token first: the weight from this token on, or that of its tokens that other sets have too.

    The order of tokens only has to be one order, so the frequent ones may be found batch by batch; with those that
    add up to OFTEN / 2 of all sets, the driver holds at most 2 x (mean tokens) / OFTEN of them. Two sets have no more in
    common than the smaller of their shared weights, which rules out most sets that differ by words of their own.
    """
    n = sets.count()
    rows = sets.mapInArrow(_often, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN / 2 * n).collect()
    rows = sorted((r.key, r.n) for r in rows)
    often = sets.sparkSession.sparkContext.broadcast((np.array([k for k, _ in rows], np.uint32), np.array([m for _, m in rows], np.int64)))
    weights = materialize(sets.mapInArrow(_weights, "key bigint, node binary, w double"), "near-weights")
    alone = weights.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("w").alias("w")).filter("n = 1").groupBy("node").agg(F.sum("w").alias("alone"))
    total = weights.groupBy("node").agg(F.sum("w").alias("total")).join(alone, "node", "left")
    stats = total.select("node", "total", (F.col("total") - F.coalesce("alone", F.lit(0.0))).alias("shared"))
    weighed = sets.select("node", "packed").join(materialize(stats, "near-stats"), "node")
    tokens = materialize(weighed.mapInArrow(_prefixes(often, threshold), "key bigint, node binary, total double, shared double"), "near-prefixes")
    least = tokens.groupBy("key").agg(F.min("total").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # A similar set weighs at least threshold times as much, and at least as much as the lightest of the group.
    other = F.greatest("least", threshold * F.col("total"))
    able = tokens.join(least, "key").filter((1 + threshold) * F.col("shared") >= threshold * (F.col("total") + other) - 1e-3)
    able = materialize(able.drop("least"), "near-able")
    sizes = able.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return materialize(able.join(sizes, "key"), "near-prefix-groups")


# --- classes


def connected_components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node of the component.

    Each round points a node at its smallest neighbour, then at that one's, and draws every link between what its ends
    point at; links inside one point go, so a round works on what the one before left open. Tables are written out each
    round, so a lost executor costs one round at most.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{label}-links")
    roots = None
    while True:
        least = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("up"))
        least = materialize(least, f"{label}-least")
        above = least.select(F.col("node").alias("up"), F.col("up").alias("top"))
        ups = materialize(least.join(above, "up").select("node", F.col("top").alias("up")), f"{label}-ups")
        ends = both.join(ups.select(F.col("node").alias("a"), F.col("up").alias("from")), "a").join(ups.select(F.col("node").alias("b"), F.col("up").alias("to")), "b")
        rest = materialize(ends.filter("from <> to").select(F.col("from").alias("a"), F.col("to").alias("b")).distinct(), f"{label}-links")
        new = materialize(_composed(roots, ups), f"{label}-roots")
        free(both, least, ups, *([roots] if roots is not None else []))
        both, roots = rest, new
        if both.isEmpty():
            free(both)
            return roots


def _composed(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """(node, root): the roots by what their roots point at in ``found`` (node, up); without any, ``found`` itself."""
    if roots is None:
        return found.select("node", F.col("up").alias("root"))
    higher = found.select(F.col("node").alias("root"), "up")
    return roots.join(higher, "root", "left").select("node", F.coalesce("up", "root").alias("root"))


def joined_components(roots: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """The components of ``roots`` after more links: only the links between different components are followed."""
    if links.isEmpty():
        return roots
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    named = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    found = connected_components(named.filter("a <> b").distinct(), label)
    moved = _composed(roots, found.withColumnRenamed("root", "up"))
    out = materialize(moved.unionByName(found.join(roots.select("node"), "node", "left_anti")), f"{label}-all-roots")
    free(found, roots)
    return out


def _mixed(groups: DataFrame, roots: DataFrame, label: str) -> DataFrame:
    """The groups that hold several classes, with the root of each text. Which ones do is written first: the join with
    it is then a plain one, in which hot groups are split."""
    classed = groups.join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = materialize(classed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key"), f"{label}-keys")
    out = materialize(classed.join(mixed, "key"), label)
    free(mixed)
    return out


def _pairs(left: DataFrame, right: DataFrame, condition: str, threshold: float = 0.0) -> DataFrame:
    """Different pairs a < b of texts of one group and of different classes that can be similar, where weights tell."""
    cols = [c for c in ("root", "total", "shared") if c in left.columns]
    a = left.select("key", F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in cols])
    b = right.select("key", F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in cols])
    if threshold:
        condition += f" AND {1 + threshold} * least(shared_a, shared_b) >= {threshold} * (total_a + total_b) - 1e-3"
    both = a.join(b, "key").filter(condition)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _leaders(open_: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of a mixed group's leader, any one of its largest class, another each turn, and its texts of other
    classes."""
    classes = open_.groupBy("key", "root").agg(F.count("*").alias("members"), F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("leader"))
    best = classes.groupBy("key").agg(F.max(F.struct("members", "root", "leader")).alias("_best")).select("key", F.col("_best.root").alias("largest"), F.col("_best.leader").alias("a"))
    best = materialize(best, "near-leaders")
    return open_.join(best, "key").filter("root <> largest").select("a", F.col("node").alias("b")).distinct()


def _compare(threshold: float):
    def run(query: pa.Table, block: pa.Table) -> pa.Table:
        names, roots = block.column("node").to_pylist(), block.column("root").to_pylist()
        sets = [unpack(x) for x in block.column("packed").to_pylist()]
        total, shared = block.column("total").to_numpy(), block.column("shared").to_numpy()
        joined: dict[bytes, bytes] = {}

        def top(root: bytes) -> bytes:
            while (up := joined.get(root)) is not None:
                root = up
            return root

        out = []
        for q in query.to_pylist():
            own, able = None, (1 + threshold) * np.minimum(shared, q["shared"]) >= threshold * (total + q["total"]) - 1e-3
            for k in np.flatnonzero(able).tolist():
                a, b = top(q["root"]), top(roots[k])
                if a == b:
                    continue
                own = own or unpack(q["packed"])
                if similar(own, sets[k], threshold):
                    out.append((q["node"], names[k]))
                    joined[max(a, b)] = min(a, b)
        return pa.table([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())], ["a", "b"])

    return run


def _blockwise(open_: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between classes of large groups: the texts outside of a group's largest class, as queries, against all of
    the group in blocks of BLOCK. Every pair of different classes has a side outside of the largest. Classes that a block
    has joined are one from then on, so a block gives fewer links than there are classes. Only links come out."""
    members = open_.groupBy("key", "root").agg(F.count("*").alias("members"))
    largest = members.groupBy("key").agg(F.max(F.struct("members", "root")).alias("_l")).select("key", F.col("_l.root").alias("largest"))
    full = open_.join(materialize(largest, "near-largest"), "key").join(sets, "node").withColumn("_blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    full = materialize(full, "near-open-sets")
    cols = ["key", "block", "node", "root", "total", "shared", "packed"]
    queries = full.filter("root <> largest").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(*cols)
    blocks = full.withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")).select(*cols)
    return queries.groupBy("key", "block").cogroup(blocks.groupBy("key", "block")).applyInArrow(_compare(threshold), "a binary, b binary").distinct()


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each input row: doc_id, node (md5 of its text), class_id (smallest doc_id of its class), root.

    Candidates: ``bands`` bands of ``rows`` samples; two texts of similarity 0.8 share a band but for 1 case in 20,000.
    Links: in every bucket the smallest text is compared with all others, then, where several classes are left, texts
    outside of the largest with some of it. A bucket that still holds several classes goes on: of at most SMALL_BUCKET texts, all pairs not in one class are compared. The texts of larger mixed buckets (which
    share a passage, say) are grouped anew by an exact prefix filter over their sets: two texts that are similar share
    one of the rare tokens that start both, and no more than what both do not have alone. Of those groups the small ones
    compare all pairs of different classes; in the large ones the texts outside of the largest class are queries against
    the whole group, in blocks. So every pair of different classes in a bucket is compared or ruled out exactly; links
    inside a class, which would change nothing, are not looked for. Pairs are made by joins that split hot groups;
    copies are one text.

    Only sample keys are written for every document; texts are shuffled once, one of each kind of copies for each task,
    and only those that share a bucket with another are kept, as weighted sets. Tables that have served are deleted.

    Null texts count as empty; all empty texts are one class, as copies; a text of 1 to 4 words has one shingle.
    Repeated rows are in one class. class_id is null where all ids of a class are; where ids are null or shared by
    different texts only root (the smallest node) tells classes apart. Empty tables give no rows.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text_or_empty(text_col).cast("binary"))).alias("node"), text_or_empty(text_col).alias("text"))
    idf = docs.sparkSession.sparkContext.broadcast(word_idf(own.select("text")))
    signed = materialize(own.mapInArrow(_signatures(idf, bands, rows), "doc_id bigint, node binary, keys array<bigint>"), "near-signatures", narrow=False)
    keyed = signed.filter("keys IS NOT NULL").select("node", "keys").dropDuplicates(["node"]).select("node", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("leader")).filter("n > 1")
    buckets = materialize(keyed.join(sizes, "key"), "near-buckets")
    wanted = buckets.select("node").distinct()
    texts = own.groupBy("node").agg(F.first("text").alias("text"))
    sets = materialize(texts.join(wanted, "node").select("node", "text").mapInArrow(_packed(idf), "node binary, packed binary"), "near-sets", narrow=False)

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        left, right = (sets.select(F.col("node").alias(c), F.col("packed").alias(f"packed_{c}")) for c in "ab")
        joined = pairs.join(right, "b").join(left, "a").select("a", "b", "packed_a", "packed_b")
        return materialize(joined.mapInArrow(_verify(threshold), "a binary, b binary"), label)

    links = verified(buckets.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "near-links-0")
    roots = connected_components(links, "near-0")
    open_ = _mixed(buckets.drop("leader"), roots, "near-open-0")
    free(buckets)
    size = f"n <= {SMALL_BUCKET}"
    for turn in range(LEADERS):
        crowds = open_.filter(f"NOT ({size})")
        if crowds.isEmpty():
            break
        roots = joined_components(roots, verified(_leaders(crowds, turn), f"near-links-{turn}"), f"near-0{turn}")
        left = _mixed(open_.drop("root"), roots, "near-open-0")
        free(open_)
        open_ = left
    small = open_.filter(size)
    pairs = _pairs(small, small, "a < b AND root_a <> root_b")
    large = open_.filter(f"NOT ({size})").select("node").distinct()
    groups = None
    if not large.isEmpty():
        groups = prefix_groups(sets.join(large, "node", "left_semi"), threshold)
        again = _mixed(groups, roots, "near-open-1")
        small = again.filter(size)
        pairs = pairs.unionByName(_pairs(small, small, "a < b AND root_a <> root_b", threshold)).distinct()
        groups = groups.filter(f"NOT ({size})")
    links = verified(pairs, "near-links-1")
    free(open_)
    roots = joined_components(roots, links, "near-1")
    if groups is not None:
        found = _blockwise(_mixed(groups, roots, "near-open-2"), sets, threshold)
        roots = joined_components(roots, materialize(found, "near-links-2"), "near-2")
    free(sets)

    # A text's smallest id, then a class's, each a partial aggregate; hot texts and classes meet them in plain joins.
    ids = signed.groupBy("node").agg(F.min("doc_id").alias("least")).join(roots.select("node", "root"), "node", "left")
    ids = materialize(ids.withColumn("root", F.coalesce("root", "node")), "near-ids")
    classes = materialize(ids.groupBy("root").agg(F.min("least").alias("class_id")), "near-classes")
    placed = materialize(ids.select("node", "root").join(classes, "root"), "near-placed")
    free(ids, classes, roots)
    return signed.select("doc_id", "node").join(placed, "node").select("doc_id", "node", "class_id", "root")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without all of a class but the row of its smallest id, null being the largest; all columns as they are.

    Classes are told apart by root, so that texts whose ids are null or shared by other texts are kept, each class once.
    Repeated rows (one id, one text) are one row afterwards.
    """
    found = near_duplicate_classes(docs, id_col, text_col)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("_least"))
    kept = materialize(least.select(F.col("_least.doc_id").alias("_id"), F.col("_least.node").alias("_kept")), "near-kept")
    keyed = docs.withColumns({"_node": F.unhex(F.md5(text_or_empty(text_col).cast("binary"))), "_key": F.col(id_col).cast("long")})
    once = keyed.dropDuplicates(["_key", "_node"])
    return once.join(kept, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_node") == F.col("_kept")), "left_semi").drop("_node", "_key")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", F.hex("root").alias("class_root"))
