import base64
import gzip
import hashlib
import json

import pytest
from pyarrow import fs

from newsprep.llm import warc_members as W
from newsprep.session import new_path
from tests.llm.rows import CLASHING, collected, ordered

PAGES = [
    (5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"),
    (9, None, "<p>same</p>"), (None, "http://a/n", "<p>same</p>"),
    (1, "http://a/1\r\nX-Page: 77", None), (2, "", ""), (4, "http://a/4", "é" * 200_000),
    (6, "http://a/6", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "no id"), (None, "v", "no id"),
    (7, "http://a/7", "twice"), (7, "http://a/7", "twice"), (8, "http://a/8", "twice"),
]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.selectExpr("*", *(f"'{c}' AS {c}" for c in CLASHING))


def expected(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        to = first.get(html or "", page_id)
        again = to != page_id and len(data) >= least
        kind = "revisit" if again else "response"
        out.append((page_id, len(data), digest, kind, to if again else None))
    return ordered(out)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize(("parts", "least"), [(1, 0), (4, 0), (2, 8)])
def test_round_trip(spark, parts, least):
    found = W.warc_round_trip(pages(spark).repartition(parts), least=least)
    assert collected(found, *COLUMNS) == expected(PAGES, least)


def test_given_pages(spark, small):
    df = spark.read.parquet(f"{small}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in df.collect()]
    assert collected(W.warc_round_trip(df), *COLUMNS) == expected(rows)
    assert W.warc_round_trip(pages(spark, [])).count() == 0


def test_each_member_stands_alone(spark):
    """A whole-file stream becomes members; the index leads to each, any reader reads all."""
    folder = new_path(spark, "warc-test")
    typed = W.with_revisits(pages(spark).coalesce(1), least=0, id_col="page_id", url_col="url", html_col="html")
    whole = W.write_archives(typed, f"{folder}/whole").collect()
    files, path = W._files(whole[0]["path"])
    stream = files.open_input_stream(path, compression=None).read()
    paths = spark.createDataFrame([(w["path"],) for w in whole], "path string")
    done = W.normalise_archives(paths, f"{folder}/members").collect()
    assert [d["records"] for d in done] == [w["records"] for w in whole] == [len(PAGES)]
    files, path = W._files(done[0]["path"])
    members = files.open_input_stream(path, compression=None).read()
    assert gzip.decompress(members) == gzip.decompress(stream)
    assert stream.count(b"\x1f\x8b\x08") < members.count(b"\x1f\x8b\x08")
    _, index = W._files(done[0]["index"])
    lines = [json.loads(x) for x in files.open_input_stream(index, compression=None).read().splitlines()]
    end = 0
    for line in lines:
        assert line["offset"] == end
        end += line["length"]
        record = gzip.decompress(members[line["offset"] : end])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert W.fields_of(record.partition(b"\r\n\r\n")[0])["warc-record-id"] == line["id"]
    assert end == len(members)
    # Members are read as well as a single stream.
    again = W.normalise_archives(
        spark.createDataFrame([(done[0]["path"],)], "path string"), f"{folder}/again"
    ).collect()
    assert again[0]["records"] == len(PAGES)


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_reading_in_pieces(size, monkeypatch, tmp_path):
    monkeypatch.setattr(W, "READ", size)
    made = [W.record(i, "http://x", b"payload %d" % i, False, None) for i in range(5)]
    for name, data in (
        ("whole", gzip.compress(b"".join(made))),
        ("members", b"".join(map(gzip.compress, made))),
    ):
        (tmp_path / name).write_bytes(data)
        source = fs.LocalFileSystem().open_input_stream(str(tmp_path / name), compression=None)
        assert [r for _, r in W.records(W.inflated(source))] == made
    (tmp_path / "cut").write_bytes(gzip.compress(b"".join(made))[:-30])
    with pytest.raises(ValueError):
        source = fs.LocalFileSystem().open_input_stream(str(tmp_path / "cut"), compression=None)
        list(W.records(W.inflated(source)))


def test_many_archives(spark):
    rows = [(i, f"http://a/{i}", f"page {i % 40} " * 50) for i in range(200)]
    assert collected(W.warc_round_trip(pages(spark, rows).repartition(9)), *COLUMNS) == expected(rows)
