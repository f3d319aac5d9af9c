import collections
import random
import re

import duckdb
import numpy as np
import pyarrow as pa

import __spark_entry__ as driver
from bundlescope.llm import decontamination as d

FOLDER = "/root/testdata/sf0.01"


def words_of(text):
    return [w for w in (x.strip(d._OUTER) for x in re.findall("[^\x20\x09-\x0d]+", (text or "").lower())) if w]


def verbatim(docs, items):
    """Documents that hold all words of an item in a row."""
    grams = collections.defaultdict(set)
    for item, text in items:
        grams[tuple(words_of(text)[:4])].add(item)
    found, whole = set(), {i: words_of(t) for i, t in items}
    for doc, text in docs:
        words = words_of(text)
        for k in range(len(words) - 3):
            for item in grams.get(tuple(words[k : k + 4]), ()):
                if words[k : k + len(whole[item])] == whole[item]:
                    found.add((doc, item))
    return found


def test_finds_verbatim_items(spark):
    docs, items = (
        duckdb.sql(f"SELECT {c}, text FROM '{FOLDER}/{n}.parquet'").fetchall()
        for c, n in (("doc_id", "documents"), ("item_id", "benchmark"))
    )
    got = {(r.doc_id, r.item_id) for r in driver.queries()["op10_benchmark_decontamination"](spark, FOLDER).collect()}
    want = verbatim(docs, items)
    assert len(want) > 10 and len(want & got) >= 0.95 * len(want)
    assert len(got - want) <= 0.05 * len(want)


def made(n_docs=300):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(4000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(rng.randrange(20, 60)) for _ in range(15)]
    docs = [(n, text(200)) for n in range(n_docs)]
    planted = set()
    for n in range(0, 90):
        item = n % len(items)
        copy = list(items[item])
        if n % 3 == 1:  # a paraphrase: every fifth word replaced
            copy[::5] = text(len(copy[::5]))
        if n % 3 == 2:  # words put in
            copy = [w for x in copy for w in ((x, rng.choice(vocabulary)) if rng.random() < 0.15 else (x,))]
        at = rng.randrange(0, 150)
        docs[n][1][at:at] = copy
        planted.add((n, item))
    return [(n, " ".join(w).capitalize()) for n, w in docs], [(n, " ".join(w)) for n, w in enumerate(items)], planted


def test_finds_paraphrases(spark):
    docs, items, planted = made()
    found = d.leaks(
        spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id bigint, text string, terms int").repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    got = {(r.doc_id, r.item_id): r.lcs for r in found.collect()}
    assert set(got) <= planted and len(got) >= 0.9 * len(planted)


def test_finds_replaced_words_in_real_documents(spark):
    """By the number of words left in order each copy is a leak."""
    rng = random.Random(9)
    docs, items = (
        duckdb.sql(f"SELECT {c}, text FROM '{FOLDER}/{n}.parquet' ORDER BY ALL").fetchall()
        for c, n in (("doc_id", "documents"), ("item_id", "benchmark"))
    )
    texts = {doc: (text or "").split() for doc, text in docs}
    hosts = rng.sample([doc for doc, words in texts.items() if len(words) > 100], 320)
    other = [w for doc in hosts for w in texts[doc]]
    planted = collections.defaultdict(set)
    for n, doc in enumerate(hosts):
        item, text = rng.choice([i for i in items if len(i[1].split()) >= 16])
        share, copy = (0.1, 0.2, 0.3, 0.4)[n % 4], text.split()
        for k in rng.sample(range(len(copy)), int(share * len(copy))):
            copy[k] = rng.choice(other)
        at = rng.randrange(len(texts[doc]))
        texts[doc][at:at] = copy
        planted[share].add((doc, item))
    found = d.leaks(
        spark.createDataFrame([(doc, " ".join(words)) for doc, words in texts.items()], "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    recall = {share: len(want & got) / len(want) for share, want in planted.items()}
    assert min(recall[share] for share in (0.1, 0.2, 0.3)) >= 0.95 and recall[0.4] >= 0.85, recall


def test_odd_rows(spark):
    docs, items, _ = made(91)
    shape = "doc_id bigint, text string"
    rows = [*docs, (None, items[0][1]), (500, None), (500, None), (501, ""), (502, "... !!"), (503, "x " * 40000), (504, items[1][1]), (504, items[1][1])]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "!")], "item_id bigint, text string")
    got = d.leaks(spark.createDataFrame(rows, shape), bench).collect()
    assert (None, 0) in {(r.doc_id, r.item_id) for r in got}
    assert [r.lcs for r in got if (r.doc_id, r.item_id) == (504, 1)] == [1.0]
    assert d.leaks(spark.createDataFrame([], shape), bench).collect() == []
    assert d.leaks(spark.createDataFrame(rows, shape), bench.where("false")).collect() == []
    kept = d.without_leaks(spark.createDataFrame([(*r, 1) for r in rows], f"{shape}, item_id int"), bench)
    assert kept.columns == ["doc_id", "text", "item_id"] and {500, 501, 502, 503} <= {r.doc_id for r in kept.collect()}


def test_rows_without_id_that_leak_are_removed(spark):
    docs, items, _ = made(91)
    leak, clean = items[0][1], docs[90][1]
    rows = [*docs, (None, leak), (None, clean), (None, None), (None, ""), (None, clean)]
    shape = "doc_id bigint, text string"
    kept = d.without_leaks(spark.createDataFrame(rows, shape), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((r.text for r in kept.collect() if r.doc_id is None), key=str) == sorted([clean, clean, None, ""], key=str)


def test_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(1, 20)).tolist() for _ in "ab")
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *np.maximum.accumulate([max(row[k + 1], row[k] + (x == y)) for k, y in enumerate(b)])]
        bits = {}
        for k, x in enumerate(a):
            bits[x] = bits.get(x, 0) | 1 << k
        assert d.common_subsequence(bits, len(a), b) == row[-1]


def test_a_large_benchmark_is_searched_in_blocks(spark):
    docs, items, planted = made(120)
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame([*items, (50, None), (51, "")], "item_id bigint, text string")
    whole = {(r.doc_id, r.item_id): r.answered for r in d.leaks(rows, bench).collect()}
    parts = {(r.doc_id, r.item_id): r.answered for r in d.leaks(rows, bench, max_words=200).collect()}
    assert set(whole) == set(parts) and len(parts) >= 0.9 * len(planted)


def test_only_regions_that_can_leak_are_compared_word_by_word(monkeypatch):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrst", k=2)) for _ in range(n))
    items = [text(40) for _ in range(30)]
    # A quarter of an item's words in a row: alike, but never a leak.
    texts = [f"{text(50)} {' '.join(items[n].split()[:10])} {text(50)}" for n in range(20)]
    texts += [f"{text(50)} {items[3]} {text(50)}"]
    bench = d.Benchmark([{"item_id": n, "text": t} for n, t in enumerate(items)])
    found = d.located(pa.array(texts, pa.large_string()), bench.known)
    ones = np.ones(len(bench.known), np.float32)
    space = d.latent_space(d.random_matrix(len(bench.known)), ones)
    bench.place(space, ones)
    rows = d.candidates(d.Passages(*found, ones), space, bench)
    compared, verified = [], d.Benchmark.verified
    monkeypatch.setattr(d.Benchmark, "verified", lambda *a: compared.append(a) or verified(*a))
    leaked = d.leaks_in(*found, ones, space, bench)
    assert (20, 3, 1.0, True) in leaked
    assert 0 < len(compared) < len(rows) / 2


def test_segments_are_summed_like_their_terms():
    found = d.Passages(
        np.array([1, 0, 2, 1, 1], np.int32), np.array([0, 3, 15, 16, 2], np.int32), np.array([0, 4, 5]), np.ones(3, np.float32)
    )
    vectors = np.arange(6, dtype=np.float32).reshape(3, 2)
    assert found.sums(vectors).tolist() == [[6, 9], [2, 3], [2, 3]]


def test_regions_hold_enough_of_their_item():
    """The regions left are those whose words could make up half of the item, each once."""
    rng = np.random.default_rng(10)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (3, 40, 200, 900)] + ["w1 w1 w1 w2"]
    bench = d.Benchmark([{"item_id": n, "text": t} for n, t in enumerate(texts)])
    terms = rng.integers(0, len(bench.known), 500).astype(np.int32)
    item, low = rng.integers(0, len(texts), 4000), rng.integers(0, 450, 4000)
    high = np.minimum(low + rng.integers(0, 500, 4000), len(terms))
    may, must = set(), set()
    for i, a, b in zip(item.tolist(), low.tolist(), high.tolist()):
        words, region = collections.Counter(bench.words[i]), collections.Counter(terms[a:b].tolist())
        if 2 * sum(n for w, n in words.items() if w in region) >= words.total():
            may.add((i, a, b))
        if 2 * (words & region).total() >= words.total():
            must.add((i, a, b))
    twice = [np.concatenate([x, x]) for x in (item, low, high)]
    found = list(map(tuple, d.holding_enough(*twice, terms, bench).tolist()))
    assert len(set(found)) == len(found) and must <= set(found) <= may
    assert 0 < len(must) < 3000
