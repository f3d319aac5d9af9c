import hashlib
import re
import time

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as driver
from bundlescope.llm import pii

FOLDER = "/root/testdata/sf0.001"


def plain(text):
    """The four base kinds by regular expressions."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 13 <= len(d) <= 19 and sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def base(text):
    return [s for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS]


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="aZ0125@.+-%_ ()\néß\U0001f600", max_size=40))
def test_any_text(text):
    assert base(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "256.1.1.1", "a@b.c", "@", ".", " ", "-", "+", "7",
     "+49 (30) 123-456.78", "x", "é", "1", "..", "@@", "a.b@c-d.e.f", "\n", "00.0.0.255", "+1", "((("]), max_size=12))
def test_joined_pieces(parts):
    text = "".join(parts)
    assert base(text) == plain(text)


@pytest.mark.parametrize("part", ["a", "1.", "+1", "a@", "1 ", "(", "://", "token=", "AA11", "a@b."])
def test_long_texts(part):
    text = "+1" + part * 40_000
    started = time.perf_counter()
    found = base(text)
    assert time.perf_counter() - started < 3
    assert part in ("1 ", "(") or found == plain(text)


def test_more_kinds():
    text = 'DE89 3704 0044 0532 0130 00, token = "b44e15e09fd3", https://ann:pw@example.org/x. https://example.org'
    more = [(k, text[a:b]) for k, a, b in pii.spans_of(text) if k not in pii.BASE_KINDS]
    assert more == [("iban", "DE89 3704 0044 0532 0130 00"), ("secret", "b44e15e09fd3"), ("url", "https://ann:pw@example.org/x")]
    assert pii.mask_text("to a@b.cd, now") == "to <email>, now"


def test_query_against_expressions(spark):
    rows = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    got = driver.queries()["op4_pii"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        want = plain(rows[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in want) for k in pii.BASE_KINDS]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert r.spans.startswith(line) or not want
    assert any(r.n_email for r in got) and any(r.n_card for r in got)


def test_odd_rows(spark):
    shape = "doc_id bigint, text string, spans int"
    assert pii.with_spans(spark.createDataFrame([], shape)).collect() == []
    got = pii.with_spans(spark.createDataFrame([(None, "a@b.c", 1), (1, None, 1), (1, None, 1)], shape)).collect()
    assert sorted((str(r.doc_id), len(r.spans)) for r in got) == [("1", 0), ("1", 0), ("None", 1)]
    masked = pii.masked(spark.createDataFrame([(1, "a@b.c", 1)], shape)).first()
    assert masked.text == "<email>"
