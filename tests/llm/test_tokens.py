import collections
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from bundlescope.llm import packing, token_files
from bundlescope.llm.tokens import Encoder, library_path
from bundlescope.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
PATH = library_path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\n", "a", "it's 'tis we'll", "x<|endoftext|>y", " <|startoftext|> z ", "Áé ́b",
    " a b　c", "don't,stop. now", "12 345abc\tdef\x0bghi\x0cj\x1ck", "\U0001f600\U0001f601 Kİ", "word " * 5000, "x" * 3000,
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def documents(folder=FOLDER):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def test_chunks_encode_as_whole_texts(plain):
    texts = [t or "" for t in ODD] + [t for _, t in documents()]
    for cached in (1, 10_000):
        encoder = Encoder(PATH, cached)
        for n in range(0, len(texts), 7):
            part = texts[n : n + 7]
            ids, bounds = encoder.encode(pa.array(part, pa.large_string()))
            for k, text in enumerate(part):
                assert ids[bounds[k] : bounds[k + 1]].tolist() == ids_of(plain, text)


def check_files(rows, texts, plain):
    start = 0
    assert [r.doc_id for r in rows] == [d for d, _ in texts]
    for row, (_, text) in zip(rows, texts, strict=True):
        ids = [*ids_of(plain, text), 1]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_files_hold_every_document(spark, plain):
    rows = driver.queries()["op1_token_files"](spark, FOLDER).collect()
    check_files(sorted(rows, key=lambda r: r.start), documents(), plain)


def test_files_of_odd_rows(spark, plain):
    rows = [(n, t, "x", 7) for n, t in enumerate(ODD)] + [(None, "null id", "x", 7), (3, "twice", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, start int").repartition(3)
    folder = scratch_path(spark, "odd")
    token_files.write(docs, folder, PATH, partitions=4)
    got = token_files.read(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([d for d, *_ in rows], key=lambda d: -1 if d is None else d)
    want = collections.Counter((d, tuple([*ids_of(plain, t), 1])) for d, t, *_ in rows)
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_files_of_no_rows(spark):
    folder = scratch_path(spark, "none")
    token_files.write(spark.createDataFrame([], "doc_id bigint, text string"), folder, PATH)
    assert token_files.read(spark, folder).collect() == []


def check_packing(rows, texts, plain, capacity):
    by_doc, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts:
        ids = [*ids_of(plain, text), 0]
        got = sorted(by_doc.pop(doc), key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(-(-len(ids) // capacity)))
        for r in got:
            part = ids[r.piece * capacity : (r.piece + 1) * capacity]
            assert (r.start, r.length, r.ids_crc32) == (r.piece * capacity, len(part), crc(part))
    assert not by_doc
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r.length for r in rows)


def test_packing_is_whole_and_tight(spark, plain):
    rows = driver.queries()["op3_best_fit_packing"](spark, FOLDER).collect()
    n, total = check_packing(rows, documents(), plain, packing.CAPACITY)
    assert n <= -(-total // packing.CAPACITY) + 1


def test_packing_odd_rows(spark, plain):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string").repartition(3)
    rows = packing.packed_digest(docs).collect()
    check_packing(rows, list(enumerate(ODD)), plain, packing.CAPACITY)
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.packed_digest(none).collect() == []
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id bigint, text string")
    assert sorted(r.length for r in packing.pack(twice, PATH).collect()) == [1, 3, 3]


def test_plan_finds_the_fullest_combination():
    patterns = packing.plan({6: 2, 5: 1, 4: 3, 3: 2}, 10)
    assert sum(t for t, _ in patterns) == 4
    total = collections.Counter()
    for times, pattern in patterns:
        assert sum(n * c for n, c in pattern.items()) <= 10
        for n, c in pattern.items():
            total[n] += times * c
    assert total == {6: 2, 5: 1, 4: 3, 3: 2}


def test_chunks_that_share_half_a_hash_are_told_apart(monkeypatch):
    known = Encoder(library_path("word_bpe_49k.json"))
    hashes = Encoder._hashes

    def same_first_half(self, chunks):
        found = hashes(self, chunks).copy()
        if self.seed == 0:
            found[:, 0] = 7
        return found

    monkeypatch.setattr(Encoder, "_hashes", same_first_half)
    texts = ["some words, more", "words and Wörter"]
    ids, bounds = known.encode(pa.array(texts, pa.large_string()))
    assert known.seed == 1
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == known.library.encode(text, add_special_tokens=False).ids


def test_words_that_are_parted_or_marked_in_odd_ways_get_the_same_ids():
    known = Encoder(library_path("word_bpe_49k.json"), cached=40)
    texts = ["İİ Straße ǅ ﬁn x² don't ''s it's### l'été--", "a_b foo'll'' ª º éa ́x ()", "", "word" * 3000 + " 's"]
    for _ in range(3):
        ids, bounds = known.encode(pa.array(texts, pa.large_string()))
        for k, text in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == known.library.encode(text, add_special_tokens=False).ids
