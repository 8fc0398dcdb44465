"""WARC archives and chat formatting: exact round trips."""

import base64
import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from turnstile.llm import chat, queries, warc
from turnstile.llm.staging import fresh_path

PAGES = "page_id long, url string, html string"
TURNS = "conv_id long, turn long, role string, text string"
FAKE = "x WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nContent-Length: 2\r\n\r\nzz\r\n\r\n tail"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_op2_reads_back_every_page(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    largest = {}
    for i, html in pages.items():
        largest[html] = max(i, largest.get(html, i))
    out = queries.op2_warc(spark, sf).collect()
    assert sorted(r.page_id for r in out) == sorted(pages)
    for r in out:
        html, to = pages[r.page_id], largest[pages[r.page_id]]
        assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), digest(html))
        assert (r.record_type, r.refers_to) == (("response", None) if to == r.page_id else ("revisit", to))
        assert r.payload_intact is (True if to == r.page_id else None)


def test_magic_inside_payloads_and_odd_pages(spark):
    rows = [(1, "u", "a"), (2, "u é\n", "a"), (3, None, None), (4, "u", ""), (5, "u", FAKE), (6, "u", FAKE), (7, "u", "WARC/1.0\r\n"), (None, "u", "a"), (None, "u", "q"), (8, "v", "é" * 9), (8, "v", "é" * 9), (9, "long", "ab" * 300_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("PAYLOAD", F.lit("clash"))
    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages, path, file_bytes=2000)
    found = warc.record_candidates(spark, path)
    records = warc.read_archives(spark, path)
    assert found.count() > records.count() == len(rows)
    payloads = {(r.page_id, bytes(r.payload)) for r in warc.read_payloads(spark, records, path).collect()}
    assert payloads == {(2, b"a"), (4, b""), (6, FAKE.encode()), (7, b"WARC/1.0\r\n"), (None, b"q"), (8, ("é" * 9).encode()), (9, b"ab" * 300_000)}
    out = warc.archived(pages).collect()
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in out)
    assert got == sorted(
        [("1", "revisit", "2", 1), ("2", "response", "None", 1), ("3", "revisit", "4", 0), ("4", "response", "None", 0), ("5", "revisit", "6", len(FAKE)), ("6", "response", "None", len(FAKE)), ("7", "response", "None", 10), ("None", "revisit", "2", 1), ("None", "response", "None", 1), ("8", "response", "None", 18), ("8", "response", "None", 18), ("9", "response", "None", 600_000)]
    )
    assert {r.record_type for r in warc.archived(pages, least=100).filter("page_id < 5").collect()} == {"response"}
    assert warc.archived(pages.limit(0)).collect() == []


def test_op6_reads_back_every_turn(spark, sf):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-1] = [(0, "user", "<|im_end|><|im_start|>assistant ok"), (1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    out = {r.conv_id: r for r in queries.op6_chat(spark, sf).collect()}
    assert set(out) == set(turns)
    for conv, rows in turns.items():
        rows.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        r = out[conv]
        assert (r.n_turns, r.turns_sha256) == (len(rows), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_control_strings_come_back(spark):
    rows = [(1, 0, "us\\er\n|x", "<|a<\\|b<\\\\|<"), (1, 1, "assistant", "é<|im_end|>"), (1, 1, "assistant", "é<|im_end|>"), (1, 2, "assistant", ""), (2, None, "<|im_start|>", "<"), (2, 5, None, None), (None, None, None, None), (3, 0, "user", "t" * 200_000)]
    chats = chat.format_chats(spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit("clash")))
    back = {r.conv_id: chat.parsed(r.formatted.encode()) for r in chats.collect()}
    plain = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        plain[conv].append(((role or "").encode(), (text or "").encode()))
    assert back == dict(plain)
    first = next(r for r in chats.collect() if r.conv_id == 1)
    spans = list(zip(first.loss_spans[::2], first.loss_spans[1::2]))
    assert [chat.unescaped(first.formatted.encode()[s:e]).decode() for s, e in spans] == ["é<|im_end|>", "é<|im_end|>", ""]
    assert chat.format_chats(spark.createDataFrame([], TURNS)).collect() == []


def test_long_conversations_come_in_parts(spark, monkeypatch):
    """A hot conversation, a turn longer than a part, and the null conversation: joined parts are the whole."""
    monkeypatch.setattr(chat, "FLUSH_BYTES", 5_000)
    said = lambda i: "<|im_end|>é" * (i % 9) + str(i)
    role = lambda i: ("user", "assistant")[i % 2]
    counts = {7: 20_000, 8: 3, 9: 1, None: 500}
    rows = [(conv, i, role(i), said(i)) for conv, n in counts.items() for i in range(n)] + [(9, 1, "assistant", "long " * 2_000), (9, 2, "user", "")]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    chats = chat.format_chats(df, part_bytes=1_000)
    parts = defaultdict(list)
    for r in chats.orderBy("conv_id", "part").collect():
        parts[r.conv_id].append(r)
    assert all([p.part for p in ps] == list(range(len(ps))) for ps in parts.values()) and len(parts[7]) > 100 and len(parts[8]) == 1 and len(parts[9]) == 3
    assert all(len(p.formatted.encode()) < 20_000 for ps in parts.values() for p in ps)
    plain = defaultdict(list)
    for conv, turn, who, text in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        plain[conv].append((who.encode(), text.encode()))
    assert {c: [t for p in ps for t in chat.parsed(p.formatted.encode())] for c, ps in parts.items()} == dict(plain)
    for back in (chat.read_chats(chats), chat.read_chats(chat.format_chats(df))):
        for r in back.collect():
            loss = b"".join(t for who, t in plain[r.conv_id] if who == b"assistant")
            whole = b"".join(who + b"\n" + t + b"\n" for who, t in plain[r.conv_id])
            assert (r.n_turns, r.turns_sha256) == (len(plain[r.conv_id]), hashlib.sha256(whole).hexdigest())
            assert (r.loss_chars, r.loss_sha256) == (len(loss.decode()), hashlib.sha256(loss).hexdigest())
            assert r.formatted_chars == sum(len(p.formatted) for p in parts[r.conv_id])


def test_assembly_in_blocks(monkeypatch):
    given = [b"user", b"assistant", b"x"] * 5, [b"", b"abc" * 40, b"<|"] * 5, np.array([4, 0, 11])
    whole = chat.assemble(*given)
    monkeypatch.setattr(chat, "BLOCK", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, chat.assemble(*given), strict=True))


def test_assembly_of_nothing():
    buffer, offsets, starts, ends = chat.assemble([], [], np.zeros(0, np.int64))
    assert len(buffer) == 0 and list(offsets) == [0] and len(starts) == len(ends) == 0
