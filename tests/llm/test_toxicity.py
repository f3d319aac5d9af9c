import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as driver
from bundlescope.llm import toxicity

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = driver.queries()["op5_toxicity"](spark, FOLDER).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{FOLDER}/labels.parquet'").fetchall())
    assert len(rows) == 1000
    right = total = found = toxic = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.7)
        if r.held_out and r.doc_id in labels:
            total += 1
            right += r.predicted == labels[r.doc_id]
            toxic += labels[r.doc_id]
            found += labels[r.doc_id] and r.predicted
    assert right / total >= 0.94 and found / toxic >= 0.65, (right, total, found, toxic)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, "x"), (1, None), (1, ""), (2, "idiot " * 30000), (3, "nice day"), (4, "you idiot"), (4, "you idiot")],
        "doc_id bigint, text string",
    )
    labels = spark.createDataFrame([(2, 1), (2, 0), (3, 0), (4, None), (None, 1)], "doc_id bigint, toxic int")
    got = toxicity.scored(docs, toxicity.trained(docs, labels)).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    none = toxicity.trained(docs, labels.where("false"))
    assert {r.score for r in toxicity.scored(docs, none).collect()} == {0.5}
    assert toxicity.scored(docs.where("false"), none).collect() == []


def test_held_out_accuracy_on_the_larger_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = driver.queries()["op5_toxicity"](spark, folder).where("held_out").collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    right = sum(p == t for p, t in judged) / len(judged)
    recall = sum(p and t for p, t in judged) / sum(t for _, t in judged)
    precision = sum(p and t for p, t in judged) / sum(p for p, _ in judged)
    assert right >= 0.95 and recall >= 0.80 and precision >= 0.95, (right, recall, precision)


def plain_ftrl(rows, toxic):
    """Each coordinate by itself, in Python numbers."""
    size = 1 << toxicity.BITS
    z, n = {}, {}

    def weight(at):
        l1 = 0.0 if at == size else toxicity.L1
        if abs(z.get(at, 0.0)) <= l1:
            return 0.0
        step = (toxicity.BETA + math.sqrt(n.get(at, 0.0))) / toxicity.ALPHA + toxicity.L2
        return -(z[at] - math.copysign(l1, z[at])) / step

    for _ in range(toxicity.EPOCHS):
        for first in range(0, len(rows), toxicity.BATCH):
            gradients, squares = {}, {}
            for row, label in zip(rows[first : first + toxicity.BATCH], toxic[first:]):
                score = sum(weight(at) for at in row) + weight(size)
                error = 1 / (1 + math.exp(-max(-35.0, min(35.0, score)))) - label
                error *= toxicity.TOXIC_WEIGHT if error < 0 else 1.0
                for at in (*row, size):
                    gradients[at] = gradients.get(at, 0.0) + error
                    squares[at] = squares.get(at, 0.0) + error * error
            before = {at: weight(at) for at in gradients}
            for at in gradients:
                old = n.get(at, 0.0)
                n[at] = old + squares[at]
                z[at] = z.get(at, 0.0) + gradients[at] - (math.sqrt(n[at]) - math.sqrt(old)) / toxicity.ALPHA * before[at]
    found = {at: weight(at) for at in z if at != size and weight(at)}
    return weight(size), found


def test_training_equals_plain_ftrl():
    rng = random.Random(4)
    rows, toxic = [], []
    for n in range(150):
        bad = n % 4 == 0
        row = {rng.randrange(300) for _ in range(12)} | ({1000 + rng.randrange(4), 2000} if bad else {3000 + rng.randrange(4)})
        rows.append(np.array(sorted(row), np.int32))
        toxic.append(float(bad))
    bias, places, weights = toxicity.ftrl(rows, np.array(toxic))
    want_bias, want = plain_ftrl([r.tolist() for r in rows], toxic)
    assert bias == pytest.approx(want_bias) and set(places.tolist()) == set(want) and len(want) > 3
    assert dict(zip(places.tolist(), weights.tolist())) == pytest.approx(want, rel=1e-5)


def plain_features(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    words = [w.strip(toxicity._OUTER) for w in words]
    hashes = [xxhash.xxh3_64_intdigest(w) for w in words]
    found = list(hashes)
    for length in toxicity.STEMS:
        found += [xxhash.xxh3_64_intdigest(w[:length], length) for w in words if len(w) >= length]
    for gap in (1, 2, 3):
        for a, b in zip(hashes, hashes[gap:]):
            x = (a * 0x9E3779B97F4A7C15 + b + gap) % 2**64
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
            x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
            found.append(x ^ x >> 31)
    return {x >> (64 - toxicity.BITS) for x in found}


def test_scores_equal_a_plain_scorer(spark):
    texts = ["You idiot, you!", "a  nice\tday", "", None, "IDIOTIC people; hate", "é è idiot", "one", "x " * 50 + "idiot"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rng = random.Random(9)
    places = sorted({p for t in texts for p in plain_features(t or "")})
    weights = np.array([rng.uniform(-1, 1) for _ in places], np.float32)
    model = {"bias": -0.25, "places": places, "weights": weights.tolist()}
    known = dict(zip(places, weights.tolist()))
    for r in toxicity.scored(docs, model).collect():
        score = -0.25 + sum(known[p] for p in plain_features(texts[r.doc_id] or ""))
        assert r.score == pytest.approx(1 / (1 + math.exp(-score)), rel=1e-5)
