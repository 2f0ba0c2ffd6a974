"""The pipeline against a brute-force version of its stages, on a made-up corpus."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from chronicell.llm import byte_bpe, quality_rules
from tests.llm.test_near_dedup import brute_classes

SPACE = " \t\n\x0b\x0c\r"
PHRASES = quality_rules.BOILERPLATE


def line_fails(x):
    words = len(re.findall(r"[^\x20\x09-\x0D]+", x))
    pipes = x.count("|")
    return (
        (pipes >= 2 and pipes * 4 >= words)
        or (words <= 3 and not any(c in ".!?:;," for c in x))
        or sum(c in "#*$%&<>!" for c in x) * 3 > words
        or (words >= 5 and sum("A" <= c <= "Z" for c in x) * 2 > len(x))
        or any(p in x.lower() for p in PHRASES)
    )


def brute_rules(docs):
    out = {}
    for i, t in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {p for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        if len(words) < 50 or 100 * len(covered) > 50 * len(words):
            continue
        lines = t.split("\n")
        worded = [x for x in lines if x.strip(SPACE)]
        gone = sum(len(x) for x in worded if line_fails(x))
        if gone * 100 <= sum(map(len, worded)) * 50:
            out[i] = "\n".join(x for x in lines if not x.strip(SPACE) or not line_fails(x))
    return out


def brute_lines(docs):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACE))
    holders = defaultdict(set)
    for i, t in docs.items():
        for x in t.split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(i)
    gone = lambda i, x: len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != i
    return {i: "\n".join(x for x in t.split("\n") if not gone(i, x)) for i, t in docs.items()}


def brute_near(docs):
    kept = {c for _, c in brute_classes(list(docs.items()))}
    return {i: t for i, t in docs.items() if i in kept}


def brute_leaks(docs, items):
    def grams(t, width=5):
        w = [x for x in re.split(r"[^\w]+|_", (t or "").lower()) if x]
        return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}

    def leaks(t, item):
        width = min(5, len([x for x in re.split(r"[^\w]+|_", (item or "").lower()) if x]))
        due = grams(item, width) if width else set()
        return due and len(due & grams(t, width)) * 100 >= 80 * len(due)

    return {i: t for i, t in docs.items() if not any(leaks(t, item) for item in items)}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    shared = [sentence(9) for _ in range(4)]
    items = [sentence(14) for _ in range(5)] + [None, "short one"]
    docs = {}
    for i in range(90):
        kind = i % 9
        lines = [sentence(rng.randint(8, 16)) for _ in range(rng.randint(5, 9))]
        if kind == 1:
            lines.insert(2, rng.choice(shared))
        if kind == 2:
            lines.insert(1, rng.choice(items[:5])[:-1] + " and more.")
        if kind == 3:
            lines = [" | ".join(word() for _ in range(30))] * 2 + lines[:1]
        if kind == 4:
            lines += ["Home", "Home     about", "Terms of use apply here, and more.", "Alle Rechte vorbehalten, hier und dort.", ""]
        if kind == 5:
            lines = [" ".join([word()] * 40)] * 2
        if kind == 6 and i > 9:
            lines = docs[i - 6].split("\n")
            lines[-1] = sentence(5) if rng.random() < 0.5 else lines[-1]
        if i == 80:
            lines.insert(1, "This is, as it were, a short one, no more than that.")
        docs[i] = "\n".join(lines) if kind != 7 else sentence(9)
    return docs, items


def test_stages_match_brute_force(spark, docs_of, corpus, tmp_path):
    docs, items = corpus
    docs_of(list(docs.items())).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = docs
    for (name, stage), brute in zip(P.STAGES, (brute_rules, brute_lines, brute_near, lambda d: brute_leaks(d, items))):
        table, want = P.materialize(stage(spark, table, str(tmp_path)), "test"), brute(want)
        assert table.columns == list(P.COLUMNS)
        got = {r.doc_id: r for r in table.collect()}
        assert {i: r.text for i, r in got.items()} == want, name
        assert all(r.n_chars == len(r.text) for r in got.values())
    assert 20 < len(want) < 80
    ranks = byte_bpe.vocabulary(public_tokenizers.path(byte_bpe.RANKS)).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = {r.doc_id: r.ids for r in P.STAGES[-1][1](spark, table, str(tmp_path)).collect()}
    assert last == {i: library.encode_ordinary(t) for i, t in want.items()}
    assert {r.doc_id: r.ids for r in P.run(spark, str(tmp_path)).collect()} == last


def test_empty_tables(spark, docs_of, tmp_path):
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_null_shared_and_repeated_ids(spark, docs_of, tmp_path):
    """Every text that passes stays once, whatever its id; of near copies one stays; a repeated row is one row."""
    text = lambda c: "\n".join(" ".join(f"{c}{k}x{i}" for i in range(14)) + "." for k in range(6))
    rows = [(None, text("a")), (None, text("b")), (None, None), (7, text("c")), (7, text("d")), (8, text("e")), (8, text("e")), (9, text("f")), (10, text("f") + " more"), (11, "")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "an item that no document holds, of many words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 7), (False, 7), (False, 8), (False, 9), (True, 0), (True, 0)]
    assert len({r.decoded_sha256 for r in out}) == 6 and all(r.ids_sha256 for r in out)


def test_the_library_does_without_this_subpackage():
    root = Path(P.__file__).parent
    for f in (root / "chronicell").rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "chronicell.llm" not in f.read_text()
    for f in [*(root / "chronicell" / "llm").glob("*.py"), root / "corpus_pipeline.py"]:
        assert "ImportError" not in f.read_text() and "localCheckpoint" not in f.read_text()
