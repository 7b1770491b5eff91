"""Archives of other writers, archives as files, and the bounded memory of token counting."""

import base64
import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from tessera.llm import op01_warc as warc, op02_token_counts as counts
from tessera.llm.tokens import tokenizer_path

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def record(kind, block, *more, version="WARC/1.0", length=None):
    head = [version, f"warc-type: {kind}", f"Warc-Record-Id: <urn:uuid:{kind}>", "WARC-DATE: 2020-01-01T00:00:00Z",
            f"content-length: {len(block) if length is None else length}", *more]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


RECORDS = [
    record("warcinfo", b"software: x\r\n"),
    record("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request", "WARC-Concurrent-To: <a>",
           "WARC-Concurrent-To: <b>"),
    record("response", HTTP + b"body", "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{sha1(b'body')}",
           f"WARC-Block-Digest: SHA-256:{hashlib.sha256(HTTP + b'body').hexdigest()}", "WARC-Target-URI: http://a/", "X-Note: one,", "\ttwo"),
    record("resource", b"plain", "WARC-Payload-Digest: md5:" + hashlib.md5(b"plain").hexdigest(), version="WARC/1.1"),
    record("metadata", b"odd", "WARC-Payload-Digest: blake3:00"),
    record("revisit", b"", "WARC-Refers-To: <urn:uuid:response>", f"WARC-Payload-Digest: sha1:{sha1(b'body').lower()}"),
    record("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nbody\r\n0\r\n\r\n", "Content-Type: application/http",
           f"WARC-Payload-Digest: sha1:{sha1(b'body')}"),
    record("response", HTTP + b"bo", "Content-Type: application/http", "WARC-Truncated: length", f"WARC-Payload-Digest: sha1:{sha1(b'body')}"),
]


def archive(dictionary=None, compressed=False, gap=b""):
    pack = zstandard.ZstdCompressor(dict_data=dictionary) if dictionary else zstandard.ZstdCompressor()
    out = b""
    if dictionary:
        raw = dictionary.as_bytes()
        raw = zstandard.compress(raw) if compressed else raw
        out = warc.SKIPPABLE.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw
    return out + gap + gap.join(pack.compress(r) for r in RECORDS)


def test_archives_of_other_writers(spark):
    trained = zstandard.train_dictionary(2048, [r * (k % 5 + 1) + b"%d" % k for k in range(200) for r in RECORDS])
    gap = (0x184D2A50).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc"
    kinds = {"none": archive(), "plain": archive(trained), "compressed": archive(trained, True), "gaps": archive(trained, gap=gap)}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in kinds.items()], "archive string, content binary")
    got = warc.read_warc(df).collect()
    assert len(got) == len(RECORDS) * 4
    for kind in kinds:
        own = [(r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got if r.archive == kind]
        assert own[:2] == [("warcinfo", 13, sha1(b"software: x\r\n"), None), ("request", 0, sha1(b""), None)]
        assert own[2:4] == [("response", 4, sha1(b"body"), None), ("resource", 5, sha1(b"plain"), None)]
        assert own[5] == ("revisit", None, sha1(b"body"), "<urn:uuid:response>")
        assert own[7] == ("response", 2, sha1(b"bo"), None)
    headers, _ = warc.parse_record(RECORDS[2])
    assert headers["x-note"] == "one, two" and warc.parse_record(RECORDS[1])[0]["warc-concurrent-to"] == "<a> <b>"


@pytest.mark.parametrize("raw, message", [
    (record("response", b"x", version="WARC/2.0"), "not a record"),
    (record("response", b"x", length=2), "Content-Length"),
    (record("response", b"x", length="+1"), "Content-Length"),
    (record("response", b"x", "content-type: a", "Content-Type: b"), "twice"),
    (record("response", b"x", "no colon"), "bad header"),
    (record("response", b"x", "WARC-Block-Digest: md5:00"), "block digest"),
    (record("response", HTTP + b"x", "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{sha1(HTTP + b'x')}"), "payload digest"),
    (record("response", b"x", "WARC-Payload-Length: 2"), "payload length"),
    (record("revisit", b"", "WARC-Payload-Length: many"), "payload length")])
def test_damaged_records(raw, message):
    with pytest.raises(warc.WarcError, match=message):
        warc.parse_record(raw)


def test_damaged_archives():
    good = archive()
    assert len(list(warc.frames(good))) == len(RECORDS)
    for bad in (b"", b"short", good[:-3], good + b"tail", good + warc.MAGIC, good + (0x184D2A51).to_bytes(4, "little") + b"\xff\0\0\0"):
        with pytest.raises(warc.WarcError):
            list(warc.frames(bad))
    trained = zstandard.train_dictionary(2048, [r * (k % 5 + 1) + b"%d" % k for k in range(200) for r in RECORDS])
    with_dictionary = archive(trained)
    with pytest.raises(warc.WarcError, match="decoded"):
        list(warc.frames(with_dictionary[8 + len(trained.as_bytes()):]))


def test_archives_as_files(spark, tmp_dir):
    rows = [(k, f"http://a/{k}", None if k == 3 else f"page {k % 7} " * 50) for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = warc.write_warc(pages)
    folder = tmp_dir + "/archives"
    written = {r.archive: r.n_bytes for r in warc.write_files(archives, folder).collect()}
    assert written == {r.archive: len(r.content) for r in archives.collect()}
    again = warc.write_files(archives, "file://" + folder).count()  # a repeated write changes nothing
    back = warc.read_files(spark, folder)
    assert again == len(written) and sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, warc.read_warc(archives).collect()), key=repr)
    assert back.where(F.col("record_type") == "response").count() == 8


def test_token_counts_with_many_ranges_and_little_room(spark, monkeypatch, tmp_dir):
    texts = [(k, " ".join(f"word{(k * 7 + j) % 90}" for j in range(k % 40)) if k % 9 else None) for k in range(200)]
    path = tmp_dir + "/docs.parquet"
    spark.createDataFrame(texts, "doc_id long, text string").repartition(4).write.parquet(path)
    from tokenizers import Tokenizer
    name = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(name)
    want = sorted((k, len(tok.encode(t or "", add_special_tokens=False).ids)) for k, t in texts)
    monkeypatch.setattr(counts, "RANGE_BYTES", 50)
    monkeypatch.setattr(counts, "KNOWN_BYTES", 300)
    got = counts.token_counts(spark.read.parquet(path), name)
    assert sorted((r.doc_id, r.n_tokens) for r in got.collect()) == want
