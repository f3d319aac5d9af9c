import collections
import re

import pytest

import __spark_entry__ as driver
from bundlescope.llm import line_dedup, quality

FOLDER = "/root/testdata/sf0.001"
LONG = "A line that is long enough "
ODD = [
    (1, f"{LONG}\nshort\n  {LONG.upper()}\t", "s", 0),
    (2, f"x\n{LONG}\r\ny", "s", 0),
    (3, f"{LONG.lower()}\nlast holder", "s", 0),
    (3, "the same id again", "s", 0),
    (4, None, None, 0),
    (5, "", "", 0),
    (6, "\n\n", "s", 0),
    (None, f"{LONG}\nno id", "s", 0),
    (7, f"{'É' * 20}\n{'é' * 20}", "s", 0),
    (8, f"{'É' * 20}", "s", 0),
    (9, f"{'É' * 20}\n" * 2000 + "end", "s", 0),
    (10, f"{'É' * 19}", "s", 0),
    (11, f"{'É' * 19}", "s", 0),
    (12, f"{'É' * 19}", "s", 0),
    (13, "a b c d e f g h " * 3000, "s", 0),
    (14, "one two three", "s", 0),
]
SCHEMA = "doc_id bigint, text string, source string, line int"


@pytest.mark.parametrize("name", ["op6_quality_rules", "op7_line_dedup"])
def test_matches_sql(spark, duck, name):
    frame = driver.queries()[name](spark, FOLDER)
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    want = sorted(cursor.fetchall())
    assert sorted(tuple(r) for r in frame.select(*names).collect()) == want


def plain_lines(rows):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return re.sub("[A-Z]", lambda m: m[0].lower(), line)

    held = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 20:
                held[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        lost = [
            doc is not None and len(held.get(key(x), ())) >= 3 and max(held[key(x)]) != doc for x in lines
        ]
        kept = "\n".join(x for x, gone in zip(lines, lost) if not gone)
        out.append((doc, kept, len(lines), sum(lost)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 7])
def test_odd_lines(spark, batches):
    docs = spark.createDataFrame(ODD, SCHEMA)
    got = line_dedup.without_common_lines(docs, batches)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    rows = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
    assert sorted(rows, key=repr) == plain_lines([r[:2] for r in ODD])


def test_no_lines(spark):
    assert line_dedup.without_common_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for n in range(5):
        batch = spark.createDataFrame([(b"a", 1, n), (bytes([n]), 1, n)], "line binary, docs bigint, last bigint")
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    found = {bytes(r.line): (r.docs, r.last) for r in runs.lines().collect()}
    assert found == {b"a": (5, 4)} | {bytes([n]): (1, n) for n in range(5)}


def test_each_key_is_in_one_run_by_the_anti_join(spark):
    runs = line_dedup.LineRuns(spark, fanout=3)
    rows = collections.defaultdict(list)
    for n in range(6):
        listed = [(bytes([k]), 1 + k % 3, 10 * n + k) for k in range(n, n + 4)]
        for line, docs, last in listed:
            rows[line].append((docs, last))
        runs.add(spark.createDataFrame(listed, "line binary, docs bigint, last bigint"))
    held = [bytes(r.line) for level in runs.levels for run in level for r in run.collect()]
    assert sorted(held) == sorted(rows) and len(runs.hits) == 5
    found = {bytes(r.line): (r.docs, r.last) for r in runs.lines().collect()}
    assert found == {k: (sum(d for d, _ in v), max(x for _, x in v)) for k, v in rows.items()}


def test_joins_of_runs_shuffle_nothing(spark):
    runs = line_dedup.LineRuns(spark)
    batch = spark.createDataFrame([(b"a", 1, 1), (b"b", 1, 2)], "line binary, docs bigint, last bigint")
    runs.add(batch)
    dealt = runs._dealt(batch, "line_batch")
    plan = dealt.join(runs.levels[0][0].select("line").hint("merge"), "line", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "LeftAnti" in text and "Exchange" not in text


def plain_quality(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_odd_quality(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = quality.measured(docs).withColumn("failed", quality.base_failed())
    got = [
        (r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines, r._n_repeat_words, r.failed)
        for r in rows.collect()
    ]
    assert sorted(got) == sorted(plain_quality(r[1]) for r in ODD)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and kept.collect() == []
    assert quality.kept_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bad_hosts_take_their_documents_along(spark):
    good = " ".join(f"word{n}" for n in range(40))
    rows = [(n, "too short", "bad", 0) for n in range(90)] + [(n, good, "bad", 0) for n in range(90, 100)]
    rows += [(n, good, f"host{n % 9}", 0) for n in range(100, 1000)]
    rows += [(1000, "too short", "new", 0), (1001, good, "new", 0), (1002, good, None, 0)]
    kept = {r.doc_id for r in quality.kept_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not kept & set(range(100)) and set(range(100, 1000)) <= kept and {1001, 1002} <= kept
