"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import pytest

from scanweave.llm import ranking
from scanweave.llm.ranking import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id long, score string, query int, rank int, terms string"
ITEMS = "item_id long, text string, doc_id long, score string, query int, rank int, terms string"


def _terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _plain(docs, items, k):
    of = [(d, Counter(_terms(t)), len(_terms(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in of), sum(n for *_, n in of)
    df = Counter(t for _, tf, _ in of for t in tf)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scores = []
        for d, tf, n in of:
            m = 75 + 25 * n * n_docs // max(n_terms, 1)
            score = sum(weight[t] * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in _terms(text) if t in tf)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def _corpus(seed, n):
    rng = random.Random(seed)
    common = ["the", "of", "É", "naïve", "x1"]
    rare = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(common if rng.random() < 0.6 else rare) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    texts += ["The, THE--the_of", None, "", " \t!", "\x00w1\x7fw2", "of " * 5000, "日本 É é", "w7 w7"]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [docs[3], docs[3], (5, "w1 w2 another text of one id"), (None, "w1 of nobody"), (None, "w1 of nobody")]
    items = [(i, " ".join(rng.choice(common + rare) for _ in range(rng.randint(0, 25)))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "zzz unknown"), (93, "w1 w1 W1 the"), (94, "of"), (94, "of"), (95, "the of É"), (None, "w1 w2"), (96, "日本, w7")]
    return docs, items


def _tables(spark, docs, items):
    more = (1, "s", 2, 3, "t")
    return (
        spark.createDataFrame([(*r, *more) for r in docs], DOCS).repartition(4),
        spark.createDataFrame([(*r, *more) for r in items], ITEMS).repartition(2),
    )


@pytest.mark.parametrize("block, short, vocabulary, k", [(16384, 1 / 64, 1 << 25, 20), (64, 0.1, 1 << 25, 5), (50, 1.0, 4000, 3), (7, 0.0, 1 << 25, 20)])
def test_same_as_scoring_every_document(spark, monkeypatch, block, short, vocabulary, k):
    for name, value in (("DOCS", block), ("SHORT", short), ("VOCABULARY", vocabulary)):
        monkeypatch.setattr(ranking, name, value)
    docs, items = _corpus(block, 700)
    got = Counter(map(tuple, ranked(*_tables(spark, docs, items), k=k).collect()))
    assert got == _plain(docs, items, k)


def test_empty_tables(spark):
    docs, items = _corpus(1, 5)
    none_docs, none_items = _tables(spark, docs[:0], items[:0])
    some_docs, some_items = _tables(spark, docs, items)
    for d, i in ((none_docs, some_items), (some_docs, none_items), (none_docs, none_items)):
        assert ranked(d, i).collect() == []


def test_lists_that_cannot_matter_are_skipped():
    best = ranking.Best(2)
    best.add(ranking.np.array([9, 5, 5, 5]), ranking.np.array([4, 8, 2, 6]))
    assert best.scores.tolist() == [9, 5] and best.ids.tolist() == [4, 2] and best.bar == 5
    best.add(ranking.np.array([5, 4]), ranking.np.array([1, 0]))
    assert best.ids.tolist() == [4, 1]
