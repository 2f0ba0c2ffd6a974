import random

import numpy as np
import pytest

from chronicell.llm import suffix_dedup as S


def brute(rows):
    """Every 100-byte window of every document in order; the bytes of those seen before go."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for doc, text in order:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            w = data[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc, text] = (len(data), sum(gone), runs, kept)
    return sorted(((doc, *out[doc, text]) for doc, text in rows), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcdé \n") for _ in range(k))
    shared = [text(rng.randint(60, 300)) for _ in range(6)] + ["la " * 80, "x" * 400]
    rows = []
    for i in range(n):
        t = text(rng.randint(0, 200))
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(shared)
            cut = rng.randint(0, 40)
            t += p[cut : len(p) - rng.randint(0, 40)] + text(rng.randint(0, 60))
        rows.append((i, t))
    rows += [(n + i, rows[i][1]) for i in range(5)]
    return rows


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


def test_matches_brute_force(docs_of):
    rows = corpus(1, 80) + [(500, None), (501, ""), (502, "é" * 60), (None, "z" * 150 + "q"), (503, "z" * 150)]
    rows += [rows[3]]  # a repeated row is the same document
    assert result(S.remove_repeated_strings(docs_of(rows))) == brute(rows)


def test_hot_anchors_go_by_windows(docs_of, monkeypatch):
    monkeypatch.setattr(S, "HOT_MOST", 2)
    rows = corpus(2, 60)
    assert result(S.remove_repeated_strings(docs_of(rows))) == brute(rows)


def test_long_texts_are_cut_into_slices(docs_of, monkeypatch):
    monkeypatch.setattr(S, "_SLICE", 150)
    rows = corpus(3, 30)
    assert result(S.remove_repeated_strings(docs_of(rows))) == brute(rows)


def test_empty_table(docs_of):
    assert S.remove_repeated_strings(docs_of([])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_deep_shallow_sort(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 12))) + b"q" * rng.choice([0, 50, 60]) + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    group = np.array([rng.randrange(4) for _ in strings])
    order, lcp = S.deep_shallow_sort(strings, group)
    got = [(group[k], strings[k]) for k in order]
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert sorted(got) == sorted(zip(group, strings)) and [g for g, _ in got] == sorted(group)
    for k in range(1, len(got)):
        want = common(got[k][1], got[k - 1][1]) if got[k][0] == got[k - 1][0] else -1
        assert lcp[k] == want
    # equal strings and equal prefixes are neighbours, which is what the classes need
    for d in range(1, 70):
        keys = [(g, s[:d]) for g, s in got if len(s) >= d]
        runs = [k for i, k in enumerate(keys) if i == 0 or keys[i - 1] != k]
        assert len(runs) == len(set(runs))
