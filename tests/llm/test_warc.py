import io

import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bundlescope.llm import warc

PAGES = "page_id bigint, url string, html string"


def archive(*records, dictionary=None):
    one = zstandard.ZstdCompressor(dict_data=dictionary) if dictionary else zstandard.ZstdCompressor()
    lead = warc.leading_frame(dictionary.as_bytes()) if dictionary else b""
    return lead + b"".join(one.compress(r) for r in records)


def read(data):
    return [found for _, found in warc.read_archive(io.BytesIO(data))]


def sample(n=200):
    return [warc.page_record(k, f"http://x/{k}", f"<p>{'word ' * (k % 50)}{k}</p>".encode(), None) for k in range(n)]


def test_dictionary_comes_from_the_leading_frame():
    records = sample()
    known = warc.learned(records)
    found = read(archive(*records, dictionary=known))
    assert [f.fields["Page-Id"] for f in found] == [str(k) for k in range(200)]
    raw = warc.SKIPPABLE_MAGIC.to_bytes(4, "little") + len(known.as_bytes()).to_bytes(4, "little") + known.as_bytes()
    frames = archive(*records, dictionary=known)[len(warc.leading_frame(known.as_bytes())):]
    assert [f.payload for f in read(raw + frames)] == [f.payload for f in found]
    [problem] = read(frames)  # without its dictionary
    assert isinstance(problem, warc.BadRecord)


def test_frames_in_between_that_are_skipped_and_long_records():
    long = warc.page_record(1, None, b"x" * 5_000_000 + bytes(range(256)) * 4000, None)
    skipped = (0x184D2A53).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc"
    found = read(archive(long) + skipped + archive(sample(1)[0]))
    assert [f.payload_bytes for f in found] == [5_000_000 + 256 * 4000, 8]


@pytest.mark.parametrize(
    "old, new, said",
    [
        (b"WARC/1.1", b"WARC/9.9", "version"),
        (b"WARC-Date: ", b"WARC-Data: ", "without WARC-Date"),
        (b"<p>0", b"<p>00", "bytes is said"),
        (b"<p>0", b"<p>1", "WARC-Block-Digest"),
        (b"WARC-Type: response", b"WARC-Type response", "not a named field"),
        (b"HTTP/1.1 200", b"JUNK/1.1 200", "WARC-Block-Digest"),
    ],
)
def test_bad_records_are_told_and_the_next_is_read(old, new, said):
    good = sample(2)
    assert old in good[0]
    problem, fine = read(archive(good[0].replace(old, new, 1), good[1]))
    assert isinstance(problem, warc.BadRecord) and said in str(problem)
    assert fine.fields["Page-Id"] == "1"


def test_http_length_and_payload_digest_are_checked():
    payload = b"<p>hello</p>"
    good = warc.page_record(1, "u", payload, None)
    block = good.partition(b"\r\n\r\n")[2][:-4]
    named = {"WARC-Record-ID": "<urn:x>", "Content-Type": "application/http; msgtype=response"}
    short = warc.record("response", named, block.replace(b"Content-Length: 12", b"Content-Length: 11"))
    wrong = warc.record("response", named | {"WARC-Payload-Digest": "sha1:AAAA"}, block)
    any_case = warc.record("response", named, block).replace(b"Content-Type: app", b"content-TYPE: app")
    odd = warc.record("warcinfo", {"WARC-Record-ID": "<urn:y>"}, b"software: x\r\n")
    found = read(archive(short, wrong, any_case, odd))
    assert "payload of 11" in str(found[0]) and "WARC-Payload-Digest" in str(found[1])
    assert found[2].payload == payload and found[3].payload == b"software: x\r\n"


def test_damaged_archives():
    data = archive(*sample(3))
    *fine, problem = read(data[:-5])
    assert len(fine) == 2 and "ends within a frame" in str(problem)
    assert isinstance(read(b"not an archive at all")[0], warc.BadRecord)
    assert isinstance(read(warc.SKIPPABLE_MAGIC.to_bytes(4, "little") + b"\xff\xff")[0], warc.BadRecord)
    assert read(b"") == []


ODD = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://a\n/4", None), (5, "", ""),
    (None, "n", "same"), (None, "n", "alone"), (6, "http://é/", "é" * 3), (7, "7", "twice"), (7, "8", "twice"),
    (8, "long", "long text " * 300_000), (9, "9", " \r\n\r\n "), (-1, "neg", "neg"),
]


def test_round_trip_with_odd_rows(spark, duck, tmp_path):
    names = ("payload", "key", "_key", "top", "refers_to", "record_id", "fields", "a.b", "archive", "offset")
    pages = spark.createDataFrame(ODD, PAGES).withColumns({c: F.lit("mine") for c in names})
    pages.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    found = warc.op12_warc(spark, str(tmp_path))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    connection = duck.cursor()
    connection.execute(f"CREATE TEMP VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cursor = connection.execute(warc.OP12_SQL)
    assert [d[0] for d in cursor.description] == found.columns
    assert got == sorted(cursor.fetchall(), key=repr)
    assert [r[3:] for r in got if r[0] == 7] == [("response", None)] * 2
    assert ("revisit", 3) in [r[3:] for r in got if r[0] is None]


def test_whole_pages_come_back(spark, tmp_path):
    pages = spark.createDataFrame(ODD, PAGES)
    warc.write(pages.repartition(2), str(tmp_path / "w"), date="2020-02-02T00:00:00Z")
    rows = warc.read(spark, str(tmp_path / "w")).collect()
    held = {r.payload_digest: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert sorted(held.values()) == sorted({(h or "").encode() for _, _, h in ODD})
    assert {r.date for r in rows} == {"2020-02-02T00:00:00Z"} and len(rows) == len(ODD)
    for row in rows:
        assert len(held[row.payload_digest]) == row.payload_bytes
        assert (row.payload is None) == (row.record_type == "revisit")


def test_files_are_in_the_format(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://x/{k}", f"<p>{'word ' * (k % 50)}{k}") for k in range(300)], PAGES)
    warc.write(pages.coalesce(1), str(tmp_path / "w"))
    [file] = (tmp_path / "w").glob("*.warc.zst")
    data = file.read_bytes()
    assert data[:4] == warc.SKIPPABLE_MAGIC.to_bytes(4, "little")
    assert [f.fields["Page-Id"] for f in read(data)] == [str(k) for k in range(300)]
    offsets = [r.offset for r in warc.read(spark, str(tmp_path / "w")).orderBy("offset").collect()]
    size = int.from_bytes(data[4:8], "little")
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    for at in offsets[::50]:  # a reader may begin at any frame
        one = zstandard.ZstdDecompressor(dict_data=known).decompressobj().decompress(data[at:])
        assert warc.parsed(one).fields["Page-Id"] == str(offsets.index(at))


def test_small_payloads_are_not_revisited(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], PAGES)
    warc.write(pages, str(tmp_path / "w"), min_bytes=3)
    kinds = {r.fields["Page-Id"]: r.record_type for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "revisit", "4": "response"}


def test_problems_are_rows_when_asked_for(spark, tmp_path):
    (tmp_path / "bad.warc.zst").write_bytes(archive(*sample(2))[:-5])
    loose = warc.read_archives(spark, str(tmp_path), ["bad.warc.zst"], strict=False).collect()
    assert [r.problem is None for r in loose] == [True, False]
    with pytest.raises(Exception, match="ends within a frame"):
        warc.read_archives(spark, str(tmp_path), ["bad.warc.zst"]).collect()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op12_warc(spark, str(tmp_path)).collect() == []


def test_matches_sql(spark, duck):
    duck.execute("CREATE OR REPLACE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    frame = driver.queries()["op12_warc"](spark, "/root/testdata/sf0.001")
    cursor = duck.execute(driver.oracle_sql()["op12_warc"])
    want = sorted(cursor.fetchall())
    assert want and sorted(tuple(r) for r in frame.collect()) == want
