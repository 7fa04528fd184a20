"""The operators that look at one document at a time, packing, mixing and search."""

import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scanweave.llm import langid, lm, mixing
from scanweave.llm.ann import nearest, perturbations
from scanweave.llm.packing import pack_documents, plan
from scanweave.llm.quality import Policy, ablation, judged, ledger, with_policies
from scanweave.llm.queries import ORACLES, QUERIES
from scanweave.llm.tokens import PRE_TOKEN, UNSETTLED, count_tokens

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, row string, n_tokens int, score string, epoch int"
TEXTS = [
    None, "", " \n\t", "word", "It's 12,5% — naïve café!  \n\n twice", "<|endoftext|> in a text <|endoftext|>", "ΣΊΣΥΦΟΣ İstanbul",
    "՘ \U0001f600 漢字 \x1c x", "a b c d e " * 40, "tab\tand\x0bmore\r\nlines\nlines\nlines", "#### $$ %% <b>|</b>", "x" * 3000,
    "The long text goes on and on, don't it? " * 6000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s1", "x", 1, "y", 0) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, "a text without an id", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_token_counts(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    expected = Counter()
    for d, t in _rows(docs):
        n = len(own.encode(t or "", add_special_tokens=False).ids)
        expected[d, len((t or "").encode()), n, n > 512] += 1
    assert Counter(map(tuple, count_tokens(docs, path, frequent=8).collect())) == expected
    assert count_tokens(none, path).count() == 0


def test_pre_tokens_agree_outside_the_unsettled_range():
    import regex

    cut = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).pre_tokenizer
    odd = regex.compile(f"[{UNSETTLED}]")
    for code in [*range(0x20, 0x3100), *range(0xA000, 0xD800, 7), *range(0xE000, 0x10000, 3)]:
        c = chr(code)
        if not odd.match(c):
            text = f"a{c}1{c}.{c}{c} {c}b"
            assert [x[1] for x in cut.pre_tokenize_str(text)] == [m.span() for m in PRE_TOKEN.finditer(text)], hex(code)


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    own, size = Tokenizer.from_file(path), 256
    ids = [(d, own.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in _rows(docs)]
    found = pack_documents(docs, path, size=size, grain=8).collect()
    expected = Counter(
        (d, s, len(x[s : s + size]), zlib.crc32(np.array(x[s : s + size], "<u4").tobytes()), len(x))
        for d, x in ids for s in range(0, len(x), size)
    )
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    assert pack_documents(none, path).count() == 0


def test_plan_places_every_piece_with_little_waste():
    rng = np.random.RandomState(2)
    sizes = Counter(rng.randint(1, 129, 20_000).tolist())
    patterns = plan(dict(sizes), 128)
    used = Counter()
    for p in patterns:
        assert sum(s * n for s, n in p.parts) <= 128
        for s, n in p.parts:
            used[s] += n * p.copies
    assert used == sizes
    assert sum(p.copies for p in patterns) < 1.02 * sum(s * n for s, n in sizes.items()) / 128
    assert plan({}, 128) == []


def test_language(spark, docs, none):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(table)
    found = langid.identify(table, model).join(table, "doc_id").where("held_out AND lang IS NOT NULL").toPandas()
    assert len(found) and (found.lang_pred == found.lang).mean() > 0.95
    odd = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert [odd[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and odd[0].score == 0
    assert odd[None].held_out and odd[3].lang_pred != "und" and 0 <= odd[3].score <= 1
    assert langid.identify(none, model).count() == 0
    unlearned = langid.identify(docs, langid.train(none)).collect()
    assert len(unlearned) == docs.count() and {r.lang_pred for r in unlearned} == {"und"}


@pytest.mark.parametrize("least, segment, room", [(1, 7, 10**6), (3, 1 << 18, 10**6), (2, 64, 60)])
def test_code_lengths_are_those_of_the_trees(spark, monkeypatch, least, segment, room):
    monkeypatch.setattr(langid, "SEGMENT", segment)
    monkeypatch.setattr(langid, "STRINGS", room)
    known = {"a": ["abracadabra", "abra kadabra abra", "", "z"], "b": ["brabant und ab", "ünd brab", "abrab" * 9]}
    rows = [(lang, t) for lang, ts in known.items() for t in ts]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5]
    table = spark.createDataFrame([(i, t, lang) for i, (lang, t) in zip(ids, rows)], "doc_id long, text string, lang string")
    model = langid.train(table, least=least)
    counts = {lang: Counter() for lang in known}  # (context, byte), contexts of 0 to 4 bytes
    for lang, text in rows:
        data = bytes(4) + text.encode()
        counts[lang].update((data[i - o : i], data[i]) for i in range(4, len(data)) for o in range(5))
    seen = Counter()
    for own in counts.values():
        for (context, _), n in own.items():
            seen[context] += n
    limit = least
    while sum(len(c) > 0 and seen[c] >= limit for own in counts.values() for c, _ in own) > room:
        limit += 1
    assert (limit > least) == (room == 60)

    def bits(lang, context, byte):  # longest context first
        total = 0.0
        for o in range(4, -1, -1):
            c = context[4 - o :]
            own = {b: n for (k, b), n in counts[lang].items() if k == c} if not o or seen[c] >= limit else {}
            if byte in own:
                return total + np.log2((sum(own.values()) + len(own)) / own[byte])
            if own:
                total += np.log2((sum(own.values()) + len(own)) / len(own))
        return total + 8

    texts = ["abrakadab", "", "ü", "nothing like it \0\0", "", "abrab" * 7]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    got = langid.code_lengths(model, np.frombuffer(b"".join(data), np.uint8), offsets)
    assert model.languages == ("a", "b")
    for i, d in enumerate(data):
        padded = bytes(4) + d
        want = [sum(bits(lang, padded[j : j + 4], d[j]) for j in range(len(d))) for lang in known]
        assert got[i] == pytest.approx(want, abs=1e-4 * (len(d) + 1))


def test_lm_scores_by_brute_force(spark, docs, none):
    labels = spark.createDataFrame([(8,), (12,), (8,), (None,)], "doc_id long")
    models = lm.train(docs, labels)
    found = {r.doc_id: r for r in lm.cross_entropy_difference(docs, models).collect()}
    assert len(found) == len(TEXTS) + 1
    assert found[0].n_words == 0 and found[0].score == 0
    assert found[8].n_words == 200 and found[8].score < 0 < found[11].score
    one = TEXTS[4].encode()
    word, context, pair, counts = lm.word_cells(np.frombuffer(one, np.uint8), np.array([0, len(one)]))
    assert counts[0] == found[4].n_words
    loss = 0.0
    for w, c, p in zip(word, context, pair):
        alone = models.alone[1][w]
        loss -= np.log2((models.pair[1][p] + lm.PRIOR * alone) / (models.context[1][c] + lm.PRIOR))
    assert found[4].target_loss == pytest.approx(loss / len(word), rel=1e-5)
    assert lm.cross_entropy_difference(none, lm.train(none, labels)).count() == 0
    whole = lm.score_corpus(docs, labels).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, lm.cross_entropy_difference(docs, models).collect()))
    assert lm.score_corpus(none, labels).count() == 0 and lm.score_corpus(docs, none).count() == len(whole)


def test_lm_counts_every_bigram_by_itself(spark, monkeypatch):
    # A million and a half distinct bigrams: no table of fixed size keeps them apart.
    n, size = 300, 2500
    texts = [" ".join(f"w{(i * size + j) * 7919 % 1_000_003}x{j % 3}" for j in range(2 * size)) for i in range(n)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    target = spark.range(0, n, 3).withColumnRenamed("id", "doc_id")
    models = lm.train(table, target)
    words, contexts, pairs = (tuple(Counter() for _ in "01") for _ in range(3))
    for i, t in enumerate(texts):
        own = t.split()
        k = int(i % 3 == 0)
        words[k].update(own)
        contexts[k].update(["", *own[:-1]])
        pairs[k].update(zip(["", *own[:-1]], own))
    total = [sum(w.values()) for w in words]
    scale = [min(total) / t for t in total]
    known = len(words[0] | words[1])
    assert len(pairs[0] | pairs[1]) > 1 << 20 and known > lm.VOCABULARY and models.mass == lm.Mass(tuple(total), known)
    found = {r.doc_id: r for r in lm.cross_entropy_difference(table, models).collect()}
    assert len(found) == n
    monkeypatch.setattr(lm, "BROADCAST_IDS", 5)  # more ids than are broadcast
    assert {r.doc_id: r for r in lm.score_corpus(table, target).collect()} == found
    for i in range(0, n, 37):
        own, losses = texts[i].split(), []
        for k in (0, 1):
            bits = 0.0
            for c, w in zip(["", *own[:-1]], own):
                alone = (words[k][w] * scale[k] + lm.UNIFORM) / (total[k] * scale[k] + lm.UNIFORM * max(lm.VOCABULARY, known + 1))
                top = pairs[k][c, w] * scale[k] + lm.PRIOR * alone
                assert pairs[k][c, w] <= contexts[k][c]
                bits -= np.log2(top / (contexts[k][c] * scale[k] + lm.PRIOR))
            losses.append(bits / len(own))
        assert (found[i].background_loss, found[i].target_loss) == pytest.approx(losses, rel=1e-9)


def test_lm_texts_are_sealed_while_the_jvm_holds_them(spark, docs):
    # As arrays of plain texts, chunks took an executor over its memory.
    labels = spark.createDataFrame([(8,)], "doc_id long")
    chunks = lm._stored_chunks(docs, labels)
    assert dict(chunks.dtypes) == {"chunk": "bigint", "size": "bigint", "docs": "binary"}
    found, size = Counter(), sum(len((t or "").encode()) for _, t in _rows(docs))
    for r in chunks.collect():
        own = lm._opened(pa.scalar(bytes(r["docs"]), pa.binary())).to_pylist()
        assert r["size"] == sum(len((d["text"] or "").encode()) for d in own)
        found.update((d["doc_id"], d["text"], d["target"]) for d in own)
    assert found == Counter((d, t, d == 8) for d, t in _rows(docs))
    assert sum(len(r["docs"]) for r in chunks.collect()) < size / 4


def test_budgets_go_to_siblings_before_ancestors():
    leaves = {("a", "x", "1"): 10, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 1000}
    got = mixing.budgets(leaves, mixing.Target(total=800))
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 190, ("a", "y", "1"): 200, ("b", "x", "1"): 400}
    leaves["a", "x", "2"] = 20
    got = mixing.budgets(leaves, mixing.Target(total=800))
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 20, ("a", "y", "1"): 370, ("b", "x", "1"): 400}
    assert sum(mixing.budgets(leaves, mixing.Target(total=10**6, epochs=2)).values()) == 2 * sum(leaves.values())


@pytest.mark.parametrize("seed", [17, 1, 2, 3])
def test_mixing_reads_no_leaf_more_often_than_its_epochs(spark, seed):
    rows = [(i, "" if i % 3 else f"word {i}", "en", f"s{i % 2}", 1, "x") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, whole int, cut string")
    taken = mixing.mix_sources(table, mixing.Target(seed=seed))
    assert taken.columns == [*table.columns, "_leaf", "_tokens", "_row", "epoch"]
    assert sorted(r.doc_id for r in taken.collect()) == list(range(300))
    assert {r.epoch for r in taken.collect()} == {0} and {r.cut for r in taken.collect()} == {"x"}
    # Two epochs of what has tokens: a third, begun, would take texts without any.
    twice = mixing.mix_sources(table, mixing.Target(seed=seed, total=400, epochs=2)).groupBy("doc_id").count()
    assert {r["count"] for r in twice.collect()} == {2}


def test_mixing_takes_a_prefix_of_each_order(spark, docs, none):
    rows = [(i, "w " * (i % 7), "en" if i % 3 else None, f"s{i % 2 if i % 4 else 0}") for i in range(400)]
    table = spark.createDataFrame([*rows, rows[9]], "doc_id long, text string, lang string, source string")
    target = mixing.Target(weights={"lang": {"en": 3.0}}, share=0.7, epochs=2)
    taken = [r.asDict() for r in mixing.mix_sources(table, target).collect()]
    everything = mixing.placed(table).collect()
    leaves = Counter()
    for r in everything:
        leaves[tuple(r["_leaf"])] += r["_tokens"]
    budget = mixing.budgets(leaves, target)
    for leaf, most in budget.items():
        own = [r for r in taken if tuple(r["_leaf"]) == leaf]
        used = sum(r["_tokens"] for r in own)
        assert used <= most and most - used < 7
        last = max((r["epoch"] for r in own), default=0)
        for e in range(last):
            assert sum(r["epoch"] == e for r in own) == sum(tuple(r["_leaf"]) == leaf for r in everything)
    assert mixing.mix_sources(none, target).count() == 0
    assert mixing.mix_sources(docs, mixing.Target()).count() == docs.count()


@pytest.mark.parametrize("seed", range(3))
def test_large_trees_are_filled_alike(spark, monkeypatch, seed):
    rng = np.random.RandomState(seed)
    paths = {(f"d{a}", f"l{b}", f"s{c}") for a, b, c in rng.randint(0, (4, 5, 12), (150, 3))}
    leaves = {p: int(n) for p, n in zip(sorted(paths), rng.choice([0, 1, 7, 50, 900, 20_000], len(paths)))}
    table = spark.createDataFrame(list(leaves.items()), "_leaf struct<domain string, lang string, source string>, tokens long")
    weights = {"domain": {"d1": 2.5, "d2": 0.0}, "lang": {"l0": 0.1, "l3": 7.0}, "source": {"s4": 0.0, "s5": 3.0}}
    for share in (0.0, 0.1, 0.6, 1.0, 3.0):
        target = mixing.Target(weights=weights, share=share, epochs=2)
        got = {tuple(r["_leaf"]): r["budget"] for r in mixing.flowed(table, target).collect()}
        want = mixing.budgets(leaves, target)
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) <= 1
    assert mixing.flowed(table.limit(0), mixing.Target()).count() == 0
    rows = [(i, "w " * (i % 5), f"l{i % 3}", f"s{i % 11}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    target = mixing.Target(weights=weights, total=500 + seed, epochs=2, seed=seed)
    taken = sorted((r.doc_id, r.epoch) for r in mixing.mix_sources(docs, target).collect())
    monkeypatch.setattr(mixing, "SMALL_TREE", 2)
    assert sorted((r.doc_id, r.epoch) for r in mixing.mix_sources(docs, target).collect()) == taken


def test_quality_ledger(spark, docs, none):
    found = {r.doc_id: r for r in judged(docs).collect()}
    assert found[0].n_words == 0 and found[0].base_failed and not found[0].kept
    assert found[9].n_dup_lines == 2 and found[10].n_symbols == 13
    assert found[8].n_repeat_words == 200 and found[8].base_failed
    assert judged(none).count() == 0
    book = ledger(docs)
    soft = Policy("soft", 2, ("few_words", "symbols"))
    kept = with_policies(book, soft).where("soft_v2").count()
    rows = {r.rule: r for r in ablation(book, soft).collect()}
    assert {r.kept for r in rows.values()} == {kept}
    bits = [r.fail_bits for r in book.collect()]
    assert rows["symbols"].kept_without == sum(not b & 1 for b in bits)
    assert rows["few_words"].failed_alone == sum(b & 9 == 1 for b in bits)


def test_quality_by_sql(spark):
    import duckdb

    own = QUERIES["op2_quality"](spark, SMALL).toPandas()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    other = db.execute(ORACLES["op2_quality"]).df()[list(own.columns)]
    order = list(own.columns)
    assert (own.sort_values(order).to_numpy() == other.sort_values(order).to_numpy()).all()


def test_perturbations_ascend():
    inside = np.array([0.2, 0.6, 0.45])
    sets = perturbations(inside, 1000)
    cost = [sum((inside[i] if d < 0 else 1 - inside[i]) ** 2 for i, d in s) for s in sets]
    assert len(sets) == len(set(map(frozenset, sets))) == 27 and cost == sorted(cost)


def test_nearest(spark):
    rng = np.random.RandomState(0)
    base = rng.standard_normal((1500, 16)).astype(np.float32)
    base[700:1000] = base[3] + 0.01 * rng.standard_normal((300, 16))
    base[1100] = base[1101] = base[50]
    rows = [(i, x.tolist(), 0) for i, x in enumerate(base)]
    rows += [(5000, None, 0), (5050, [0.0] * 16, 0), (5100, [float("nan")] * 16, 0), (5150, [None] + [1.0] * 15, 0), (5200, [1.0] * 3, 0), (None, [1.0] * 16, 0), rows[60]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = nearest(table, lambda v: v % 50 == 0).collect()
    unit = base.astype(float) / np.linalg.norm(base.astype(float), axis=1, keepdims=True)
    hits = 0
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r)
        assert r.score == pytest.approx(float(unit[r.query_id] @ unit[r.vec_id]), abs=1e-12) and r.query_id != r.vec_id
    for q in range(0, 1500, 50):
        exact = unit @ unit[q]
        exact[q] = -9
        best = sorted(range(1500), key=lambda i: (-exact[i], i))[:5]
        hits += len(set(best) & {r.vec_id for r in by[q]})
        assert [r["rank"] for r in by[q]] == [1, 2, 3, 4, 5]
    assert set(by) == set(range(0, 1500, 50)) and hits >= 0.9 * 150
    few = nearest(table.where("vec_id < 4"), lambda v: v == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    assert nearest(table.where("vec_id = 5000"), lambda v: v % 50 == 0).count() == 0


def test_nearest_with_very_large_and_small_components(spark):
    rng = np.random.RandomState(2)
    base = rng.standard_normal((120, 8))
    rows = [(i, (x * (1e-200, 1.0, 1e200)[i % 3]).tolist()) for i, x in enumerate(base)] + [(0, [9.0] * 8)]
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = nearest(table, lambda v: v % 50 == 0).collect()
    assert len(found) == 15 and all(0 <= r.recall <= 1 for r in found)
    asked = {q: unit[q] for q in (50, 100)} | {0: min((tuple(rows[0][1]), unit[0]), (tuple([9.0] * 8), np.ones(8) / 8**0.5))[1]}
    for r in found:
        assert r.score == pytest.approx(float(asked[r.query_id] @ unit[r.vec_id]), abs=1e-12)


def test_nearest_is_exhaustive_where_probes_do_not_reach(spark, monkeypatch):
    from scanweave.llm import ann

    monkeypatch.setattr(ann, "PROBES", 1)
    base = np.random.RandomState(3).standard_normal((400, 12))
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(base)], "vec_id long, embedding array<double>")
    found = {(r.query_id, r["rank"]): r.vec_id for r in nearest(table, lambda v: v % 50 == 0).collect()}
    for q in range(0, 400, 50):
        best = [i for i in sorted(range(400), key=lambda i: (-(unit[i] @ unit[q]), i)) if i != q][:5]
        assert [found[q, k] for k in range(1, 6)] == best


def test_nearest_counts_repeated_rows_once(spark):
    rng = np.random.RandomState(1)
    base = rng.standard_normal((300, 8))
    for i in range(1, 8):  # ascending distance from the query
        base[i] = base[0] + 0.02 * i * rng.choice([-1, 1], 8)
    rows = [(i, x.tolist()) for i, x in enumerate(base)] + 40 * [(1, base[1].tolist())] + 7 * [(2, base[2].tolist())]
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    best = sorted(range(1, 300), key=lambda i: (-(unit[i] @ unit[0]), i))[:5]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    for part in (table, table.where("vec_id < 8")):
        found = sorted(nearest(part, lambda v: v == 0).collect(), key=lambda r: r["rank"])
        assert [r.vec_id for r in found] == best


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == list(corpus_pipeline.COLUMNS), name
        before = spark.createDataFrame(after.toPandas(), docs.schema)
    kept = {r.doc_id for r in before.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert {r.doc_id for r in packed.collect()} == kept
    assert kept < {r.doc_id for r in docs.collect()}


def test_pipeline_stages_on_odd_rows(spark, docs, none, tmp_path):
    import corpus_pipeline

    def through(table, folder):
        table.withColumn("n_chars", F.length("text").cast("long")).write.parquet(str(folder / "documents.parquet"))
        rows, out = spark.read.parquet(str(folder / "documents.parquet")), []
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, rows, str(folder)).write.parquet(str(folder / name))
            rows = spark.read.parquet(str(folder / name))
            out.append(rows)
        return out

    found = through(docs, tmp_path / "odd")
    assert all(tuple(t.columns) == corpus_pipeline.COLUMNS for t in found[:-1])
    language, copies, strings, mixed, packed = (t.collect() for t in found)
    # Texts without a letter have no language; the repeated row is there twice until copies go.
    lettered = [i for i, t in enumerate(TEXTS) if t and any(c.isalpha() for c in t)]
    assert Counter(r.doc_id for r in language) == Counter([*lettered, 4, None])
    assert Counter(r.doc_id for r in copies) == Counter([*lettered, None])
    # Every byte goes that a string of 100 bytes covers which starts earlier as well.
    seen, left = set(), {}
    for i in lettered:
        data = TEXTS[i].encode()
        keep, until = bytearray(), 0
        for at in range(len(data)):
            string = data[at : at + 100]
            until = at + 100 if len(string) == 100 and string in seen else until
            seen.add(string if len(string) == 100 else None)
            if at >= until:
                keep.append(data[at])
        left[i] = keep.decode("utf-8", "ignore")
    assert len(left[11]) == 1 and len(left[12]) < 200  # repeats of a letter, of a phrase
    assert {r.doc_id: r.text for r in strings if r.doc_id is not None} == left
    assert len(strings) == len(copies) and all(r.n_chars == len(r.text) for r in strings)
    assert Counter(r.doc_id for r in mixed) <= Counter(r.doc_id for r in strings)
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter(r.doc_id for r in mixed)
    placed = Counter()
    for r in packed:
        placed[r.doc_id] += r.length
    for r in mixed:
        placed[r.doc_id] -= len(own.encode(r.text, add_special_tokens=False).ids) + 1
    assert wanted.keys() == {r.doc_id for r in packed} and not any(placed.values())
    assert [t.count() for t in through(none, tmp_path / "none")] == [0] * len(corpus_pipeline.STAGES)
