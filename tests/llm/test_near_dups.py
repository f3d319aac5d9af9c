import collections
import random
import re

import duckdb
import numpy as np
import pyarrow as pa

import __spark_entry__ as driver
from bundlescope.llm import near_dups
from bundlescope.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def plain_components(rows, size, percent):
    """Every pair that shares a shingle is compared."""
    sets = {}
    for doc, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x20\x09-\x0d]+", text)
        sets[doc] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    holders = collections.defaultdict(list)
    common = collections.Counter()
    for doc, found in sets.items():
        for shingle in found:
            common.update((other, doc) for other in holders[shingle])
            holders[shingle].append(doc)
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return sorted((d, len(s), top(d), top(d) == d) for d, s in sets.items())


def compared(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


def test_matches_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    got = driver.queries()["op2_minhash_near_dedup"](spark, FOLDER)
    assert compared(got) == plain_components(rows, 3, 85)


def made_copies():
    """Near copies, copies of copies, a chain, and pairs on either side of the limit."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = []
    for length in (12, 60, 400):
        base = [word() for _ in range(length)]
        for _ in range(60):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, length // 20))):
                copy[rng.randrange(length)] = word()
            rows.append(" ".join(copy))
        chain = [word() for _ in range(length)]
        for _ in range(25):
            chain[rng.randrange(length)] = word()
            rows.append("\n".join(chain))
    rows += [None, "", " \t", "One", "one", "ONE two", "one  two", "É é", "é é", "x " * 30000]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_copies_of_copies(spark):
    rows = made_copies()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, node int")
    for words, percent in ((3, 85), (5, 80)):
        got = near_dups.near_duplicate_components(docs, words, percent)
        assert compared(got) == plain_components(rows, words, percent)
    kept = near_dups.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, _, k in plain_components(rows, 5, 80) if k}
    assert {r.doc_id for r in kept.collect()} == want


def test_unlucky_estimates_are_confirmed(spark):
    """Pairs at exactly 0.85 whose estimates are four to six standard errors below it."""
    error = (0.85 * 0.15 / near_dups.REGISTERS) ** 0.5
    rows = []
    for seed in (36561, 43851):
        rng = random.Random(seed)
        text = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(22)]
        pair = [" ".join(text[:19]), " ".join(text)]
        a, b = map(near_dups.registers, near_dups.shingle_sets(pa.array(pair, pa.large_string()), 3))
        assert 4 * error < 0.85 - near_dups.estimated((a == b).mean()) < 6 * error
        rows += enumerate(pair, len(rows))
    got = near_dups.near_duplicate_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85)
    assert compared(got) == [(0, 17, 0, True), (1, 20, 0, False), (2, 17, 2, True), (3, 20, 2, False)]


def test_odd_rows(spark):
    shape = "doc_id bigint, text string"
    assert near_dups.near_duplicate_components(spark.createDataFrame([], shape)).collect() == []
    rows = [(None, "a b c"), (None, "a b c"), (4, "a b c"), (4, "a b c"), (9, "A b C")]
    got = near_dups.near_duplicate_components(spark.createDataFrame(rows, shape), 3, 85).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(None, 1, None, True)] * 2 + [(4, 1, 4, True)] * 2 + [(9, 1, 4, False)], key=repr
    )


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(3)
    assert 0 < near_dups.chance_of_equal_registers() < 0.01
    for share in (0.0, 0.5, 0.85):
        errors = []
        for _ in range(30):
            both, a, b = (rng.integers(0, 1 << 63, n, np.uint64) for n in (int(2000 * share / (1 + share) + 1), 0, 0))
            rest = int(1000 - len(both) / 1)
            a, b = (np.concatenate([both, rng.integers(0, 1 << 63, max(1, rest), np.uint64)]) for _ in "ab")
            a, b = a << np.uint64(1), b << np.uint64(1)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            equal = (near_dups.registers(a) == near_dups.registers(b)).mean()
            errors.append(near_dups.estimated(equal) - true)
        assert abs(np.mean(errors)) < 0.02


def test_components_of_chains_and_stars(spark):
    links = [(n, n + 1) for n in range(100, 160)] + [(7, n) for n in range(1000, 1200)] + [(5, 5), (3, 7)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {n: 100 for n in range(100, 161)} | {n: 3 for n in (3, 7, *range(1000, 1200))}


def family(copies, share, length=200, seed=3):
    """Copies of one text, each with a share of its words replaced by words of its own."""
    rng = random.Random(seed)
    base = [f"base{k}" for k in range(length)]
    rows = []
    for n in range(copies):
        at = set(rng.sample(range(length), int(length * share)))
        rows.append((n, " ".join(f"own{n}x{k}" if k in at else w for k, w in enumerate(base))))
    return rows


def test_prefixes_lose_no_pair(spark):
    """All classes in one open bucket: pairs that can be alike meet, at any size."""
    rng = random.Random(11)
    rows = family(40, 0.03) + [(1000 + n, t) for n, t in family(30, 0.05, 60, 4)] + [(2000, "base1 base2 base3"), (2001, "one")]
    rows += [(3000 + n, " ".join(rng.sample(rows[n][1].split(), 190))) for n in range(10)]
    rows += [(4000 + n, " ".join(rows[n][1].split()[: 200 - 4 * n])) for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {n: {tuple(t.split()[k : k + 3]) for k in range(max(1, len(t.split()) - 2))} for n, t in rows}
    shared = spark.createDataFrame([(1, n, len(sets[n])) for n in sets], "band bigint, node bigint, n bigint")
    alone = spark.createDataFrame([], "node bigint, component bigint")
    for percent in (50, 80, 85):
        met = {tuple(r) for r in near_dups._apart(near_dups._open_buckets(shared, alone), docs, 3, percent).collect()}
        alike = {
            (a, b)
            for a in sets
            for b in sets
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        }
        assert alike <= met and len(alike) >= 5
        assert len(met) < len(sets) * (len(sets) - 1) / 2


def test_near_copies_below_the_limit_do_not_meet(spark):
    """Pairs grow with a family's members, not with their square."""
    found = []
    for copies in (50, 100, 200):
        rows = family(copies, 0.06)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        shared = spark.createDataFrame([(1, n, 196) for n, _ in rows], "band bigint, node bigint, n bigint")
        alone = spark.createDataFrame([], "node bigint, component bigint")
        found.append(near_dups._apart(near_dups._open_buckets(shared, alone), docs, 5, 80).count())
        got = near_dups.near_duplicate_components(docs)
        assert got.where("kept").count() == copies
    assert found[-1] <= 200, found


def test_parities_bound_the_difference():
    rng = np.random.default_rng(2)
    for size in (1, 100, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size, np.uint64))
        b = np.unique(np.concatenate([a[: size * 9 // 10], rng.integers(0, 1 << 63, size // 10 + 1, np.uint64)]))
        differ = sum(int(x).bit_count() for x in (near_dups.parities(a) ^ near_dups.parities(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and (differ > 0.7 * len(np.setxor1d(a, b)) or size > 1000)
        assert not (near_dups.parities(a) ^ near_dups.parities(a)).any()
