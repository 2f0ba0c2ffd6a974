import random
import re
from collections import Counter
from fractions import Fraction
from math import log1p

import numpy as np
import pytest

from chronicell.llm import near_dedup as N
from chronicell.llm.hashing import word_hashes


def word_bucket(word):
    return int(N.word_buckets(word_hashes([word.encode()])[0])[0])


def weighted_sets(texts):
    """Weighted sets with word tuples instead of hashes; only the bucket of a word is taken from the operator."""
    split = [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (t or "").lower()) for t in texts]
    bucket = {w: word_bucket(w) for words in split for w in words}
    df = Counter(b for words in split for b in {bucket[w] for w in words})
    idf = {w: round(log1p(len(texts) / df[b]) * 1024) for w, b in bucket.items()}
    unit = lambda g: max(1, min(255, (2 * sum(idf[w] for w in g) + 128 * len(g)) // (256 * len(g))))
    out = []
    for words in split:
        grams = Counter([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))
        out.append({g: c * unit(g) for g, c in grams.items()})
    return out


def similarity(a, b):
    common = sum(min(w, b[g]) for g, w in a.items() if g in b)
    return Fraction(common, (sum(a.values()) + sum(b.values()) - common) or 1)


def brute_classes(rows, threshold=Fraction(4, 5)):
    """Class ids from all pairs."""
    n = len(rows)
    weights = weighted_sets([t for _, t in rows])
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = weights[i], weights[j]
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or (a and b and similarity(a, b) >= threshold):
                root[find(i)] = find(j)
    out = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            out[find(i)] = min(out.get(find(i), doc), doc)
    return Counter((rows[i][0], out.get(find(i))) for i in range(n))


def made_up(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    bases = [[word() for _ in range(rng.randint(30, 120))] for _ in range(n // 6)]
    licence = [word() for _ in range(40)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join(words + licence * (i % 3 == 0))))
    return rows


def test_classes_match_all_pairs(docs_of):
    rows = made_up(3, 150) + [(900, None), (901, ""), (902, "one two"), (903, "One, two!"), (None, "one two"), (5, None), (904, "x " * 3000)]
    rows += rows[:3]  # repeated rows
    got = Counter((r.doc_id, r.class_id) for r in N.near_duplicate_classes(docs_of(rows)).collect())
    assert got == brute_classes(rows)


def test_large_buckets_go_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(N, "SMALL_BUCKET", 3)
    monkeypatch.setattr(N, "BLOCK", 4)
    rows = made_up(5, 60)
    got = Counter((r.doc_id, r.class_id) for r in N.near_duplicate_classes(docs_of(rows)).collect())
    assert got == brute_classes(rows)


@pytest.mark.parametrize("seed", range(4))
def test_similar_sets_share_a_prefix_token(seed):
    rng = np.random.default_rng(seed)
    often = np.arange(0, 60, 3).astype(np.uint32)
    times = rng.integers(5, 50, len(often))
    for _ in range(200):
        base = np.sort(rng.choice(120, 40, replace=False)).astype(np.uint32)
        keep = base[rng.random(40) > rng.choice([0.05, 0.15, 0.3])]
        other = np.unique(np.append(keep, rng.choice(120, rng.integers(0, 6)))).astype(np.uint32)
        a, b = (base, np.ones(len(base), np.int64)), (other, np.ones(len(other), np.int64))
        if N.similar(a, b, 0.8):
            (x, rx), (y, ry) = (N.prefix_tokens(*z, often, times, 0.8) for z in (a, b))
            common = [k for k in x if k in y]
            assert common  # and what is left from the first one on is enough
            left = min(rx[list(x).index(common[0])], ry[list(y).index(common[0])])
            assert 1.8 * left >= 0.8 * (len(base) + len(other)) - 1e-3


def test_keep_one_row_of_each_class(docs_of):
    rows = made_up(7, 60)
    rows += rows[:2]
    kept = N.keep_one_of_each(docs_of(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute_classes(rows)})


def test_empty_table(docs_of):
    assert N.near_duplicate_classes(docs_of([])).count() == 0


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64))
    weight = np.where(rng.random(len(h)) < 0.2, rng.integers(256, 10**9, len(h)), rng.integers(1, 256, len(h)))
    short, back = N.unpack(N.pack(h, weight))
    assert (short == (h >> np.uint64(32)).astype(np.uint32)).all() and (back == weight).all()


def test_sample_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(2)
    h = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
    wa, wb = rng.gamma(2, 1, 300), rng.gamma(2, 1, 300)
    sampler = N.Sampler(600)
    at, n = np.array([0]), np.array([300])
    agree = (sampler.sample(h, np.log(wa), at, n) == sampler.sample(h, np.log(wb), at, n)).mean()
    assert abs(agree - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()) < 0.08


def test_similarity_of_exactly_the_threshold_links(docs_of):
    """Of 5k shingles, 4k in common: in float32 sums these came out below 0.8 for many k."""
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [(100 * k + i, words(k, n)) for k in range(1, 9) for i, n in enumerate((5 * k + 4, 4 * k + 4))]
    rows += [(100 * k + 2, " ".join(f"w{k}x{i}" for i in range(4 * k + 4, 5 * k + 4))) for k in range(1, 9)]  # every word in two texts
    found = {r.doc_id: r.class_id for r in N.near_duplicate_classes(docs_of(rows + [(10_000 + j, words(f"o{j}", 30)) for j in range(40)])).collect()}
    assert [found[100 * k + 1] for k in range(1, 9)] == [100 * k for k in range(1, 9)]


def test_classes_with_null_or_shared_ids_are_kept_apart(docs_of):
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(30)) for c in "abcd")
    rows = [(None, one), (None, one + " end"), (None, two), (7, three), (7, four), (8, four + " end"), (9, one)]
    kept = [(r.doc_id, r.text) for r in N.keep_one_of_each(docs_of(rows)).collect()]
    assert sorted(kept, key=str) == sorted([(9, one), (None, two), (7, three), (7, four)], key=str)


def test_every_shingle_has_the_idf_of_its_words():
    texts = ["common word again and more of it", "common word again and less of it", "common rare", ""]
    found = weighted_sets(texts)
    idf = np.full(N.BUCKETS, round(log1p(4) * 1024), np.int64)
    for w, df in {"common": 3, "word": 2, "again": 2, "and": 2, "of": 2, "it": 2}.items():
        idf[word_bucket(w)] = round(log1p(4 / df) * 1024)
    h, weight, n = N.weighted_shingles([t.encode() for t in texts], idf)
    assert n.tolist() == [3, 3, 1, 0] and len(h) == 7
    ends = np.cumsum(n)
    assert [sorted(weight[e - k : e].tolist()) for e, k in zip(ends, n)] == [sorted(s.values()) for s in found]
    assert len(set(weight.tolist())) == 2


def test_recall_of_planted_near_copies(docs_of):
    """Copies with 0.3 to 1.5 words in a hundred replaced, among unrelated texts and a class of hundreds of near copies."""
    rng = random.Random(17)
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 7))) for _ in range(4000)]
    word = lambda: vocabulary[int(len(vocabulary) * rng.random() ** 3)]
    rows, pairs = [], []
    hot = [word() for _ in range(200)]
    for i in range(120):
        base = [word() for _ in range(rng.randint(60, 400))]
        copy = [word() if rng.random() < rng.choice([0.003, 0.008, 0.015]) else w for w in base]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
        pairs.append((2 * i, 2 * i + 1))
    for i in range(240):
        rows.append((1000 + i, " ".join(word() if rng.random() < 0.008 else w for w in hot)))
    sets = dict(zip((i for i, _ in rows), weighted_sets([t for _, t in rows])))
    due = [(a, b) for a, b in pairs if similarity(sets[a], sets[b]) >= Fraction(4, 5)]
    found = {r.doc_id: r.class_id for r in N.near_duplicate_classes(docs_of(rows)).collect()}
    assert len(due) > 90 and all(found[a] == found[b] for a, b in due)
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)
    assert Counter(found[1000 + i] for i in range(240)).most_common(1)[0][1] >= 0.9 * 240
    assert len({c for c in found.values()}) >= 120  # unrelated texts are left alone


def test_components_join_over_chains_stars_and_later_links(spark):
    node = lambda k: bytes([k])
    chain = [(k, k + 1) for k in range(0, 20)]
    star = [(60, k) for k in range(40, 60)]
    pair = [(80, 81)]
    table = lambda links: spark.createDataFrame([(node(a), node(b)) for a, b in links], "a binary, b binary")
    found = N.connected_components(table(chain + star + pair), "test")
    of = lambda df: {r.node[0]: r.root[0] for r in df.collect()}
    want = {k: 0 for k in range(21)} | {k: 40 for k in range(40, 61)} | {80: 80, 81: 80}
    assert of(found) == want
    later = N.joined_components(found, table([(5, 81), (81, 90), (100, 101)]), "test")
    assert of(later) == want | {80: 0, 81: 0, 90: 0, 100: 100, 101: 100}
    assert of(N.connected_components(table([]), "test")) == {}
