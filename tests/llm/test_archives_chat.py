"""WARC round trips and chat formatting."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, warc
from tidemark.llm.common import shared_folder

PAGES = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/", "<p>one</p>"),
    (3, "http://c/ d\r\nX: y", "body\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (4, None, None),
    (5, "http://e/", ""),
    (6, "", "é€😀" * 3),
    (7, "http://g/", "x" * 300_000),
    (8, "http://h/", "x" * 300_000),
    (9, "http://i/", "\n"),
    (9, "http://i/", "\n"),
    (10, "http://j/", "\n"),
    (11, "http://k/", "\n"),
    (11, "http://k/", "other"),
    (None, "http://l/", "lonely"),
    (None, "http://m/", "<p>one</p>"),
]


def pages(spark, rows):
    full = [(*r, "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, "page_id bigint, url string, html string, payload string, key string, refers_to string").repartition(3)


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        keeper = first.get(html or "")
        revisit = len(data) >= least and keeper is not None and keeper != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(map(repr, out))


@pytest.mark.parametrize("least", [0, 5, 10**6])
def test_round_trip(spark, least):
    folder = shared_folder(spark)
    warc.write_archives(warc.page_records(pages(spark, PAGES), least_bytes=least), folder)
    read = warc.read_archives(spark, folder)
    rows = warc.resolve_revisits(read).collect()
    got = sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows)
    assert got == expected(PAGES, least)
    assert all(r.digest_holds for r in rows)
    payloads = {(r.page_id, bytes(r.payload)) for r in read.where("payload is not null").collect()}
    want = {(None if i is None else str(i), (h or "").encode()) for i, _, h in PAGES}
    assert payloads <= want and (least or len(payloads) == len({h or "" for _, _, h in PAGES}))


def test_a_payload_of_a_third_of_all_pages(spark):
    rows = [(i, f"http://p/{i}", "same" if i % 3 == 0 else f"page {i}") for i in range(300)]
    folder = shared_folder(spark)
    warc.write_archives(warc.page_records(pages(spark, rows)), folder)
    got = warc.resolve_revisits(warc.read_archives(spark, folder)).collect()
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(rows)


def test_no_pages(spark):
    folder = shared_folder(spark)
    warc.write_archives(warc.page_records(pages(spark, PAGES).limit(0)), folder)
    assert warc.resolve_revisits(warc.read_archives(spark, folder)).collect() == []


def test_digest_equals_base32(spark):
    texts = ["", "a", "é", "x" * 1000, "\x00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", warc.payload_digest(F.col("t")).alias("d")).collect()
    assert all(r.d == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode() for r in rows)


def test_archives_of_many_members_and_plain_ones():
    record = lambda body: b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    bodies = [b"", b"\r\n\r\n", b"WARC/1.0\r\n", b"z" * 3_000_000]
    plain = b"".join(map(record, bodies))
    members = b"".join(gzip.compress(record(b)) for b in bodies)
    for data in (plain, members, gzip.compress(plain)):
        assert [block for _, block in warc.parse_archive(data)] == bodies
    with pytest.raises(ValueError):
        list(warc.parse_archive(plain[:-10]))
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"HTTP/1.1 200 OK\r\n\r\n"))


def test_a_revisit_without_its_original_stays_unresolved(spark):
    folder = shared_folder(spark)
    records = warc.page_records(pages(spark, PAGES)).where("record_type = 'revisit'")
    warc.write_archives(records, folder)
    rows = warc.resolve_revisits(warc.read_archives(spark, folder)).collect()
    assert rows and all(r.payload_bytes is None and r.refers_to is None for r in rows)


CALL = "array<struct<id string, name string, arguments string>>"
SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}, "now": {}}


def messages(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", "y") for r in rows],
        f"conv_id bigint, turn bigint, role string, text string, tool_calls {CALL}, tool_call_id string, call string, chat string",
    )


def steps(spark, rows):
    return chat.in_order(chat.format_chats(messages(spark, rows), SCHEMAS)).collect()


def test_calls_stand_behind_the_results_they_name(spark):
    rows = [
        (1, 0, "user", "hi", None, None),
        (1, 1, "assistant", None, [("late", "add", '{"a":1,"b":"$result:early"}'), ("last", "add", '{"b":"$result:late","a":2}')], None),
        (1, 2, "tool", "two", None, "late"),
        (1, 3, "assistant", None, [("early", "now", "{}")], None),
        (1, 4, "tool", "one", None, "early"),
        (1, 5, "tool", "three", None, "last"),
    ]
    got = [(r.kind, r.call_id) for r in steps(spark, rows) if r.kind != "message"]
    assert got == [(k, c) for c in ("early", "late", "last") for k in ("call", "result")]


def test_statuses(spark):
    rows = [
        (1, 0, "assistant", "a", [("x", "now", "{}"), ("x", "now", "{}"), ("y", "now", None), (None, None, None)], None),
        (1, 1, "tool", "first", None, "x"),
        (1, 2, "tool", "second", None, "x"),
        (1, 3, "tool", "nobody asked", None, "z"),
        (2, 0, "assistant", None, [("p", "now", '{"q":"$result:r"}'), ("r", "now", '{"q":"$result:p"}'), ("s", "now", '{"q":"$result:r"}')], None),
        (2, 1, "assistant", None, [("t", "now", '{"q":"$result:unknown"}')], None),
        (None, None, None, None, [("x", "now", "{}")], None),
        (None, 1, "tool", "of no conversation", None, "x"),
        (3, 0, "user", "", [], None),
        (3, 0, "user", "", [], None),
    ]
    got = steps(spark, rows)
    by = lambda kind, conv: sorted((r.call_id, r.status) for r in got if r.kind == kind and r.conv_id == conv)
    assert by("call", 1) == [("", "no result"), ("x", "linked"), ("x", "repeated"), ("y", "no result")]
    assert by("result", 1) == [("x", "linked"), ("x", "repeated"), ("z", "no call")]
    assert by("call", 2) == [("p", "cycle"), ("r", "cycle"), ("s", "cycle"), ("t", "no result")]
    assert by("call", None) == by("result", None) == [("x", "linked")]
    assert sum(r.kind == "message" for r in got) == 6
    assert all(json.loads(r.json) is not None for r in got)


@pytest.mark.parametrize(
    "name, arguments, errors",
    [
        ("add", '{"a": 1, "b": 2.5}', ""),
        ("add", '{"a": 1, "b": 2, "note": "x"}', ""),
        ("add", '{"a": "1", "b": null}', "a is not integer; b is not number"),
        ("add", '{"b": 1, "z": 0, "c": 0}', "a is missing; c is unknown; z is unknown"),
        ("add", '{"a": 1.5, "b": true, "note": 3}', "a is not integer; b is not number; note is not string"),
        ("now", "{}", ""),
        ("now", "[1]", "arguments are not a JSON object"),
        ("now", "{", "arguments are not a JSON object"),
        ("now", None, "arguments are not a JSON object"),
        ("other", "{}", "tool is unknown"),
        (None, "{}", "tool is unknown"),
    ],
)
def test_arguments_are_validated(spark, name, arguments, errors):
    call = [r for r in steps(spark, [(1, 0, "assistant", None, [("i", name, arguments)], None)]) if r.kind == "call"]
    assert [r.errors for r in call] == [errors]


def test_json_is_canonical(spark):
    text = 'q " \\ \n \t \u0001 é 😀 /'
    rows = [(1, 0, "user", text, [("i", "add", '{ "b" : 1, "a" : {"z": [1, 2],"y":"é"} }'), ("j", "add", "no { json")], None)]
    got = {(r.kind, r.call_id): r.json for r in steps(spark, rows)}
    assert got["call", "i"] == '{"arguments":{"a":{"y":"é","z":[1,2]},"b":1},"id":"i","name":"add"}'
    assert got["call", "j"] == '{"arguments":"no { json","id":"j","name":"add"}'
    plain = got["message", None]
    assert json.loads(plain) == {"content": text, "role": "user"} and plain.startswith('{"content":')


def test_a_long_chain_and_a_hot_conversation(spark):
    chain = [(1, 60 - i, "assistant", None, [(f"c{i}", "now", f'{{"after":"$result:c{i - 1}"}}' if i else "{}")], None) for i in range(6)]
    hot = [(2, i, "user", str(i), [(f"h{i % 50}", "now", "{}")], None) for i in range(300)]
    got = steps(spark, chain + hot)
    assert [r.call_id for r in got if r.kind == "call" and r.conv_id == 1] == [f"c{i}" for i in range(6)]
    assert sum(r.status == "repeated" for r in got) == 250
    assert len(got) == 2 * 306


def test_no_messages(spark):
    assert steps(spark, []) == []
