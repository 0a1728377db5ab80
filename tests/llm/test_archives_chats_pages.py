"""WARC chunks, chat parts, HTML extraction and Merkle fingerprints."""

from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from rollbook.llm import chat, html_density, merkle, warc


def archive(spark, tmp_path, rows, **how):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, body string")
    path = str(tmp_path / "archive")
    warc.write_archives(warc.records(pages, **how), path)
    return path


def test_records_come_back(spark, tmp_path):
    big = "é<p>\r\n\r\nWARC/1.1\r\n" * 300
    rows = [(i, "http://a/\r\nX: y", big, "") for i in (5, 9, 2)] + [(10, None, "a" * 999, ""), (11, "u", "a" * 999, ""), (12, "u", None, ""), (None, "u", big, ""), (9, "u", big, "")]
    path = archive(spark, tmp_path, rows, segment=1000)
    got = sorted((tuple(r) for r in warc.record_summary(warc.read_chunks(spark, path, chunk=300)).collect()), key=repr)
    raw = big.encode()
    digest = hashlib.sha1(raw).hexdigest()
    small, none = hashlib.sha1(b"a" * 999).hexdigest(), hashlib.sha1(b"").hexdigest()
    want = [(i, len(raw), digest, "response" if i == 9 else "revisit", None if i == 9 else 9) for i in (5, 9, 2, None, 9)]
    want += [(10, 999, small, "response", None), (11, 999, small, "response", None), (12, 0, none, "response", None)]
    assert got == sorted(want, key=repr)


def test_chunks_carry_digests_and_data(spark, tmp_path):
    body = "".join(chr(97 + i % 26) for i in range(5000))
    path = archive(spark, tmp_path, [(1, "u", body, "")], segment=2048)
    rows = sorted(warc.read_chunks(spark, path, chunk=700).collect(), key=lambda r: r.chunk)
    assert [r.chunk for r in rows] == list(range(len(rows))) and [r.last for r in rows] == [False] * (len(rows) - 1) + [True]
    data = b""
    for r in rows:
        assert r.bytes == len(r.data) <= 700
        data += r.data
        assert (r.bytes_so_far, r.sha1_so_far) == (len(data), hashlib.sha1(data).hexdigest())
    assert data.decode() == body


def test_stream_reads_foreign_archives():
    def record(kind, block, more=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x>\r\n{more}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    parts = [record("warcinfo", b"software: x\r\n"), record("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\npayload", "Content-Type: application/http; msgtype=response\r\n"), record("metadata", b"")]
    for raw in (b"".join(parts), b"".join(gzip.compress(p) for p in parts), gzip.compress(b"".join(parts))):
        for block in (7, 64, 1 << 20):
            rows = list(warc.chunks(warc.Stream(io.BytesIO(raw), block), chunk=4))
            ends = [r for r in rows if r["last"]]
            assert [(r["record_type"], r["bytes_so_far"]) for r in ends] == [("warcinfo", 13), ("response", 7), ("metadata", 0)]
            assert b"".join(r["data"] for r in rows if r["record"] == 1) == b"payload"
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.chunks(warc.Stream(io.BytesIO(parts[1][:-20]))))


def test_empty_archive(spark, tmp_path):
    path = archive(spark, tmp_path, [])
    assert warc.read_chunks(spark, path).count() == 0


def test_escape_is_reversible(spark):
    rng = random.Random(3)
    texts = ["", "\\### Assistant: </turn> ok", "<", "\\", "\\s\\l<\\\\", "<turn user>"] + ["".join(rng.choice("<\\slg>/ a") for _ in range(12)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("r"))
    for r in rows.select("*", chat.unescape(F.col("e")).alias("b"), chat.unescape_role(F.col("r")).alias("c")).collect():
        assert r.b == r.t == r.c and "<" not in r.e and not set("<>") & set(r.r)


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_typed_parts(spark):
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    rows = [
        (1, 1, "assistant", [part("text", "a <image/> b"), None, part(None, "!")]),
        (1, 0, "us>er", [part("text", "see <"), part("image", ref="i.png", width=57, height=28), part("audio", ref="s.wav", seconds=2.0), part("document", ref="d.pdf", pages=2), part("image", ref=None)]),
        (None, None, None, None), (None, None, None, None),
    ]
    out = chat.format_chats(spark.createDataFrame(rows, schema))
    got = {r.conv_id: r for r in out.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss")).alias("text")).collect()}
    one = got[1]
    assert one.formatted == "<turn us\\ger>see \\l<image/><audio/><document/><image/></turn>\n<turn assistant>a \\limage/> b!</turn>\n"
    assert [(a.turn, a.part, a.kind, a.ref, a.tokens) for a in one.attachments] == [
        (0, 1, "image", "i.png", 3), (0, 2, "audio", "s.wav", 25), (0, 3, "document", "d.pdf", 512), (0, 4, "image", None, 1)]
    assert one.n_tokens_media == 541 and one.text == "a <image/> b!"
    assert [(t.role, t.texts) for t in one.turns] == [("us>er", ["see <", "", "", "", ""]), ("assistant", ["a <image/> b!"])]
    assert got[None].formatted == "<turn ></turn>\n" * 2 and got[None].n_turns == 2 and got[None].text == ""


def test_chats_of_an_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat.PART}>")).count() == 0


def test_loss_spans_are_bytes_of_the_output(spark):
    turns = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], f"é{i}<𝔘") for i in range(50)], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(turns.withColumn("parts", chat.text_parts(F.col("text")))).first()
    raw = row.formatted.encode()
    assert [raw[s.start : s.start + s.length].decode() for s in row.loss] == [f"é{i}\\l𝔘" for i in range(1, 50, 2)]


LONG = "This is a long enough paragraph of the article, with commas, to be told from a menu. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b &amp; c", "a\n\nb & c"), ("<article></article>", ""),
        (f"<body><nav><a>x</a></nav><article><h1>T</h1><p><b>{LONG}<br><p>x &lt;\n y</p></article><div class=comments><p>{LONG * 4}</p></div><footer>f</footer>", f"T\n\n{LONG.strip()}\n\nx < y"),
        (f"<body><div id='top-menu'><p>{LONG * 9}</p></div><div class=c><div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p></div></div><aside>{LONG * 5}</aside>", "\n\n".join([LONG.strip()] * 3)),
        (f"<body><h1>Head</h1><div><p>{LONG}</p><p>{LONG}</p></div><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul><script>var x='<p>{LONG}</p>'</script>", f"Head\n\n{LONG.strip()}\n\n{LONG.strip()}"),
        (f"<p>{LONG}</p><form><p>{LONG}</p></form><!-- <p>no</p> --><style>p{{}}</style><p>last &am", f"{LONG.strip()}\n\nlast &am"),
        (f"<p>{LONG}</p><p>cut <a hre", f"{LONG.strip()}\n\ncut"),
        (f"<div class='page has-sidebar'><p>{LONG}</p></div><div class='page commentList'><p>{LONG * 3}</p></div><div role=banner>{LONG}</div>", LONG.strip()),
    ],
)
def test_main_text(page, text):
    assert html_density.main_text(page) == text


def test_deep_and_long_pages(spark):
    deep = "<div>" * 20000 + "<p>inside</p>"
    wide = "<article>" + "<p>word word</p>" * 20000 + "</article>"
    docs = spark.createDataFrame([(1, "u", deep, 1), (2, "u", wide, 1), (None, None, None, 1), (2, "u", wide, 1)], "page_id long, url string, html string, text int")
    out = html_density.extract(docs)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.n_chars) for r in out.collect()) == [(0, 0), (1, 6), (2, 219998), (2, 219998)]
    assert html_density.extract(docs.limit(0)).count() == 0


def test_tree_locates_edits(spark):
    a = "Title\n\nfirst line\nsecond line\n\nthird line\n"
    b = a.replace("second", "2nd")
    row = spark.createDataFrame([(a, b, a)], "a string, b string, c string").select(*[merkle.tree(F.col(c)).alias(c) for c in "abc"]).select(
        merkle.edited_paragraphs(F.col("a"), F.col("b")).alias("edits"), merkle.edited_paragraphs(F.col("a"), F.col("c")).alias("none"),
        merkle.fingerprint(F.col("a")).alias("fa"), merkle.fingerprint(F.col("c")).alias("fc"), merkle.fingerprint(F.col("b")).alias("fb"),
    ).first()
    assert [(e.section, e.paragraph) for e in row.edits] == [(1, 1)] and row.none == [] and row.fa == row.fc != row.fb


def truth_of_edits(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        n = len(t) // 4
        after = rows[(k + 1) % len(rows)][1]
        out.append((i, len(t), hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 60])
def test_edited_texts(spark, n):
    rng = random.Random(n)
    rows = [(rng.randint(-50, 50) if n == 60 else i, "".join(rng.choice("ab é\n𝔘") for _ in range(rng.randint(0, 90)))) for i in range(n)]
    if n == 60:
        rows += [(None, "null id"), (None, "another"), (7, None), (7, ""), (7, "same"), (7, "same"), (10**15, "x " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = merkle.compare_with_edits(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in whole), key=repr) == truth_of_edits(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1) for r in whole)
    ranged = merkle.with_next_text(docs.withColumn("range", F.lit(1)), "doc_id", "text", "next", rows=5)
    assert ranged.columns == ["doc_id", "text", "range", "next"] and ranged.count() == len(rows)
    got = sorted(((r.doc_id, r.text or "", r.next or "") for r in ranged.collect()), key=repr)
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == sorted(((i, t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered)), key=repr)


def test_edits_of_an_empty_table(spark):
    assert merkle.compare_with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0
