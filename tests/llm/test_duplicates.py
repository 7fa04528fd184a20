"""The duplicate operators against brute force, on small tables with every odd case."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scanweave.llm import anchors, substring
from scanweave.llm.components import components
from scanweave.llm.jaccard import near_duplicates, one_of_each
from scanweave.llm.substring import Automaton, remove_repeats
from scanweave.llm.suffix import remove_earlier

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Names that the operators use inside, as columns of the input.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, n int, cls string, ranges int"


def _texts(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéxyz") for _ in range(rng.randint(1, 6)))
    make = lambda n: [word() for _ in range(n)]
    base, passage, other = make(160), make(70), make(120)
    texts = [None, "", " \t\n", "one", "One two\x0bthree", "one TWO three", "same line\n" * 60]
    texts += [" ".join(base)] * 3
    for k in range(12):  # near copies
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += [" ".join(make(30) + passage + make(rng.randint(0, 80))) for _ in range(8)]
    texts += ["  ".join(other[:60] + passage[:36] + other[60:] + passage[20:60])]
    texts.append(" ".join(make(20_000) + passage + make(10)))
    return texts


@pytest.fixture(scope="module")
def rows():
    out = [(i + 10, t) for i, t in enumerate(_texts())]
    out += [out[10], out[30], (None, out[12][1]), (None, "a text without an id " * 9)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    odd = [(i, t, None, "s", None, "x", 1, "y", 2) for i, t in rows]
    return spark.createDataFrame(odd, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def _components(rows):
    sets = [_shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return [(d, len(s), least.get(g) if s else d) for (d, _), s, g in zip(rows, sets, group)]


@pytest.mark.parametrize("limit", [256, 2])
def test_near_duplicates(docs, rows, limit, monkeypatch):
    from scanweave.llm import jaccard

    # Short lists and blocks take the ways that are meant for very large groups.
    monkeypatch.setattr(jaccard, "BLOCK", 4 if limit == 2 else 1024)
    found = near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == Counter(_components(rows))


def test_near_duplicates_of_nothing(none):
    assert near_duplicates(none).count() == 0


def test_blocks_are_multiplied_one_after_the_other():
    from scanweave.llm import jaccard

    read, grams = [], [np.arange(k, 40 + k, dtype=np.uint64).tobytes() for k in (0, 1, 90)]

    def batches():
        for cluster in range(5):  # three sets a block, of which two are near; cut across batches
            for cls in range(3):
                read.append(cluster)
                yield jaccard._block_rows([(cluster, 0, 0, 0, 10 * cluster + cls, grams[cls])])

    held, found = [], []
    for batch in jaccard._multiply(batches()):
        held.append(read[-1])
        found += batch.to_pylist()
    assert held == [1, 2, 3, 4, 4]  # not all blocks before the first result
    assert found == [{"a": 10 * k + c, "b": 10 * k + (c == 2) * 2, "links": int(c < 2)} for k in range(5) for c in range(3)]


def _posted(texts, parts):
    from types import SimpleNamespace

    from scanweave.llm import jaccard

    levels = SimpleNamespace(value=np.zeros(1 << jaccard.CELL_BITS, np.uint8))
    found = {}
    for k in range(0, len(texts), 4):
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts[k : k + 4])})
        for out in jaccard._postings([batch], levels, parts):
            for r in out.to_pylist():
                found.setdefault(r["bucket"], []).append(pa.RecordBatch.from_pydict({"data": [r["data"]]}))
    return [r for b in found.values() for out in jaccard._pairs(b) for r in out.to_pylist()]


def test_pairs_of_near_copies_are_few_and_count_what_is_shared():
    from scanweave.llm import jaccard

    rng = random.Random(3)
    base, texts = [f"w{rng.random()}" for _ in range(600)], []
    for k in range(8):
        words = list(base)
        for _ in range((k + 2) // 3):
            words[rng.randrange(600)] = f"x{rng.random()}"
        texts.append(" ".join(words))
    sets = {jaccard.set_class(g): g for g in jaccard._sets(pa.array(texts))}
    prefix = {c: set((g >> np.uint64(16))[: jaccard.prefix_size(len(g))].tolist()) for c, g in sets.items()}
    rows = _posted(texts, 64)
    shared = Counter()
    for r in rows:
        shared[r["a"], r["b"]] += r["shared"]
    want = {(a, b): len(prefix[a] & prefix[b]) for a in sets for b in sets if a < b}
    assert dict(shared) == want and sum(want.values()) > 1500
    assert len(rows) < 20 * len(want)  # not one for each shared column and bucket: 52 buckets a pair


def test_pairs_with_a_missing_end_stay(spark):
    from scanweave.llm import jaccard

    rows = [(1, 2, 100, 100, jaccard._OPEN + 3), (1, 3, 100, 100, -jaccard._OPEN - 3), (1, 4, 100, 100, 3), (1, 5, 100, 100, None)]
    rows += [(1, 6, 100, 100, -jaccard._OPEN), (1, 6, 100, 100, jaccard._OPEN + 12)]
    found = jaccard._candidates(spark.createDataFrame(rows, jaccard.PAIRS)).collect()
    assert sorted(r.b for r in found) == [2, 3, 5, 6]


def test_only_texts_of_clusters_travel_and_sealed():
    from types import SimpleNamespace

    from scanweave.llm import jaccard

    keys = np.array([5, -7, 2**62, -(2**63), 99], np.int64)
    texts = ["one two three four five six", "alone", None, "é " * 50, "and so on"]
    near = pa.RecordBatch.from_pydict({"row": pa.array(keys[[0, 3]])})
    marks = np.zeros((64, 1 << 7), np.uint8)
    for out in jaccard._marked([near], 16):
        for r in out.to_pylist():
            marks[r["block"]] |= np.frombuffer(r["bits"], np.uint8)
    batch = pa.RecordBatch.from_pydict({"row": pa.array(keys), "text": pa.array(texts)})
    sent = [r for out in jaccard._sealed([batch], SimpleNamespace(value=marks.ravel())) for r in out.to_pylist()]
    assert {r["row"] for r in sent} == {5, 99, -(2**63)}  # 99 begins like 5
    rows = pa.RecordBatch.from_pylist([{"cluster": 1, "i": 0, "j": 0, "own": 0, "cls": r["row"], "text": r["text"]} for r in sent])
    opened = {r["cls"]: r["grams"] for out in jaccard._opened([rows]) for r in out.to_pylist()}
    want = dict(zip(keys.tolist(), jaccard._sets(pa.array(texts))))
    assert opened == {k: want[k].tobytes() for k in opened}


def test_one_of_each(docs, rows):
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in kept.collect())
    groups = {}
    for (d, t), (_, n, c) in zip(rows, _components(rows)):
        groups.setdefault(("none", d, t) if not n else ("group", c) if c is not None else ("alone", t), []).append((d, t))
    assert sum(kept.values()) == len(groups)
    assert all(sum(k in own for k in kept) == 1 for own in groups.values())


def test_one_of_each_keeps_every_column(spark):
    rows = [(1, "a b c", 7, 70), (2, "a b c", 8, 80), (3, None, 9, 90), (3, None, 9, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ROW int, _row int")
    assert sorted(tuple(r) for r in one_of_each(docs).collect()) == [rows[0], rows[2]]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(120)]
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {v: x for v, x in label.items() if v in found}
    assert set(found) == {v for a, b in edges if a != b for v in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _without_repeats(rows, window=35):
    split = [WORD.findall(t or "") for _, t in rows]
    counts = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot", [False, True])
def test_remove_repeats(docs, rows, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(substring, "LIMIT", 2)
    found = remove_repeats(docs).drop("kept").collect()
    assert Counter(map(tuple, found)) == _without_repeats(rows)


def test_remove_repeats_of_nothing(none):
    assert remove_repeats(none).count() == 0


def test_automaton_counts_windows():
    rng = random.Random(3)
    shard = [[rng.randrange(3) for _ in range(rng.randint(4, 40))] for _ in range(12)]
    automaton = Automaton()
    for words in shard:
        automaton.add(words, 1)
    automaton.finish()
    counts = Counter(tuple(w[i : i + 4]) for w in shard for i in range(len(w) - 3))
    for words in shard:
        assert automaton.repeats(words, 4) == [i for i in range(len(words) - 3) if counts[tuple(words[i : i + 4])] > 1]


def _without_earlier(rows, length=100):
    places, data = {}, [(d, (t or "").encode()) for d, t in rows]
    order = lambda d: -1 if d is None else d
    for d, x in data:
        for i in range(len(x) - length + 1):
            places.setdefault(x[i : i + length], set()).add((order(d), i))
    first = {k: min(v) for k, v in places.items()}
    out = []
    for d, x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if first[x[i : i + length]] < (order(d), i):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(x)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((d, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_remove_earlier(docs, rows):
    found = remove_earlier(docs).drop("kept").collect()
    assert Counter(map(tuple, found)) == _without_earlier(rows)


def test_remove_earlier_when_an_anchor_is_very_common(spark, rows, monkeypatch):
    monkeypatch.setattr(anchors, "CONTENTS", 1)
    some = [r for r in rows if len(r[1] or "") < 5000]
    found = remove_earlier(spark.createDataFrame(some, "doc_id long, text string").coalesce(1)).drop("kept").collect()
    assert Counter(map(tuple, found)) == _without_earlier(some)


def test_remove_earlier_keeps_columns_and_text(spark, none):
    assert remove_earlier(none).count() == 0
    text = "é" * 120
    rows = [(1, text, "a"), (2, "x" + text, "b"), (3, None, None)]
    kept = remove_earlier(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep=("source",))
    found = {r.doc_id: (r.source, r.kept) for r in kept.collect()}
    # Of 240 equal bytes, strings of 100 start at 141 places and repeat after the first two.
    assert found[2] == ("b", "x") and found[3] == (None, None) and found[1][0] == "a"
