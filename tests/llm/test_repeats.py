import collections
import hashlib
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bundlescope.llm import repeats

FOLDER = "/root/testdata/sf0.001"


def plain(rows, length=repeats.LENGTH):
    """Every window of every text, counted."""
    seen = collections.Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    cut = lambda t: (hashlib.blake2b(t[k : k + length], digest_size=12).digest() for k in range(len(t) - length + 1))
    for _, text in texts:
        seen.update(cut(text))
    out = []
    for doc, text in texts:
        gone = bytearray(len(text))
        for k, window in enumerate(cut(text)):
            if seen[window] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def compared(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()), key=repr)


def test_matches_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert compared(driver.queries()["op8_repeated_strings"](spark, FOLDER)) == plain(rows)


def test_odd_texts(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(1, 8)))
    passage = " ".join(word() for _ in range(200))
    mixed = [passage[: rng.randrange(300, 900)] + word() for _ in range(15)]
    mixed += [word() * 3 + passage[rng.randrange(0, 300) :][: rng.randrange(395, 600)] for _ in range(15)]
    exact = passage.encode()[:400].decode(errors="ignore")
    rows = list(enumerate([
        None, "", "x" * 399, "x" * 400, "y" * 401, "ab" * 1000, "z" * 50_000, exact, f"{exact}1", f"2{exact}", passage, passage,
        *mixed, "".join(mixed), "é" * 200, "é" * 199 + "ee", "q" + "é" * 200,
    ]))
    rows += [(None, passage), (3, passage)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, whole int")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    assert compared(driver.queries()["op8_repeated_strings"](spark, str(tmp_path))) == plain(rows)


def test_no_rows(spark):
    assert repeats.without_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def near_copies(rng, count=40):
    """Texts of their own, and versions of one text that differ in a few places."""
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    rows = [" ".join(word() for _ in range(300)) for _ in range(count)]
    words = rows[0].split()
    for _ in range(6):
        changed = list(words)
        for at in rng.sample(range(300), 2):
            changed[at] = word()
        rows.append(" ".join(changed))
    return list(enumerate(rows))


def test_rows_are_written_of_what_repeats(spark, monkeypatch):
    rows = near_copies(random.Random(3), 200)
    written = []

    def counted(df, label):
        frame = stored(df, label)
        written.append(frame.count())
        return frame

    stored = repeats.stored
    monkeypatch.setattr(repeats, "stored", counted)
    found = repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = found.withColumn("kept_sha256", F.sha2("kept", 256))
    assert compared(got) == plain(rows)
    assert any(r[2] for r in compared(got))
    # A row per block would be 7,154 rows, and one per window of the blocks that differ 5,025 more.
    assert sum(written) < 3_000


def test_full_bits_lose_nothing(spark, monkeypatch):
    rows = near_copies(random.Random(4))
    docs = spark.createDataFrame([*rows, (None, None), (99, rows[1][1])], "doc_id bigint, text string")
    full = lambda keys, column: spark.sparkContext.broadcast(np.full(4096, 255, np.uint8))
    monkeypatch.setattr(repeats, "bits_of", full)
    got = repeats.without_repeats(docs).withColumn("kept_sha256", F.sha2("kept", 256))
    assert compared(got) == plain([*rows, (None, None), (99, rows[1][1])])


def test_bits_of_keys(spark):
    rng = np.random.default_rng(5)
    keys = rng.integers(-(1 << 63), 1 << 63, 9_000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "key bigint")
    bits = repeats.bits_of(frame, "key").value
    assert len(bits) * 8 == 1 << 18
    assert repeats.perhaps(bits, keys).all()
    assert repeats.perhaps(bits, rng.integers(-(1 << 63), 1 << 63, 100_000)).mean() < 0.05
    fewer = repeats.bits_of(frame, "key", 1 << 16).value
    assert len(fewer) * 8 == 1 << 16 and repeats.perhaps(fewer, keys).all()
    assert not repeats.perhaps(repeats.bits_of(frame.where("false"), "key").value, keys).any()
