"""WARC round trip, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import defaultdict

import public_tokenizers
import pytest
from test_matching import brute_components, shingle_words
from test_text_operators import check_pieces

import __spark_entry__ as entry
import corpus_pipeline
from flowlab.llm import queries, warc
from flowlab.session import fresh_folder


def expected(rows, least=0):
    latest = defaultdict(list)
    for page, html in rows:
        latest[html or ""].append(page)
    for page, html in rows:
        data = (html or "").encode()
        top = max((p for p in latest[html or ""] if p is not None), default=None)
        revisit = len(data) >= least and page is not None and page < top
        yield (page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
               "revisit" if revisit else "response", top if revisit else None)


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def test_warc_query(spark, sf):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    rows = [tuple(r) for r in queries.op4_warc(spark, sf).collect()]
    assert sorted(rows) == sorted(expected(pages))


PAGES = "page_id bigint, url string, html string, payload string"


def odd_pages():
    return [(1, "u", "same"), (2, "u", "same"), (3, None, None), (4, "u\r\nWARC-Type: x", ""), (None, "u", "same"), (5, "u", "é" * 40_000),
            (6, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n0\r\n\r\n"), (7, "u", "z" * 200_000), (8, "u", "z" * 200_000), (9, "u", "single"),
            (9, "u", "other of page nine")]


@pytest.mark.parametrize("least", [0, 5])
def test_warc_of_odd_pages(spark, least):
    pages = odd_pages()
    frame = spark.createDataFrame([(*p, "x") for p in pages], PAGES).repartition(3)
    rows = warc.archive_and_read(frame, least).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=key) == sorted(expected([(p, h) for p, _, h in pages], least), key=key)
    html = defaultdict(set)
    for p, _, h in pages:
        html[p].add((h or "").encode())
    assert all(bytes(r.payload) in html[r.page_id] for r in rows if r.record_type == "response")


def test_empty_archive(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).collect() == []


def test_broken_archives_are_refused(spark):
    pages = [(7, "u", "z" * 100_000)]
    records = list(warc.page_records("row", 7, "u", b"z" * 100_000, None))
    assert len(records) > 2

    def read(some):
        path = fresh_folder(spark, "broken")
        spark.createDataFrame([(r,) for r in some], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
        return warc.read_pages(spark, path).collect()

    assert bytes(read(records)[0].payload) == pages[0][2].encode()
    assert bytes(read(records[::-1])[0].payload) == pages[0][2].encode()
    for broken in (records[:-1], records[:1] + records[2:], [*records, records[-1]], [r.replace("z", "y", 1) for r in records]):
        with pytest.raises(Exception, match="segments of a record|does not fit|longer or shorter"):
            read(broken)


@pytest.mark.parametrize("pages", [
    [(1, "u", "x" * 40_000), (1, "u", "x" * 40_000)], [(None, "u", "x" * 40_000), (None, "u", "y" * 40_000)],
    [(1, "u", "x" * 40_000), (1, "u", "y" * 40_000), (2, None, "x" * 40_000), (2, "v", "x" * 40_000)]])
def test_long_pages_that_share_an_id(spark, pages):
    rows = warc.archive_and_read(spark.createDataFrame([(*p, "x") for p in pages], PAGES)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=key) == sorted(expected([(p, h) for p, _, h in pages]), key=key)


def test_foreign_archives(spark, tmp_path):
    """A gzip member per record, other types among them, plain bodies with and without a digest, a revisit without length."""
    def record(kind, block, **more):
        lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k.replace('_', '-')}: {v}" for k, v in more.items()), f"Content-Length: {len(block)}", "", ""]
        return "\r\n".join(lines).encode() + block + b"\r\n\r\n"

    body = b"plain \xff body"
    good = {"WARC_Payload_Digest": f"sha1:{warc.base32_sha1(body)}", "WARC_Target_URI": "http://a"}
    http = b"HTTP/1.1 200 OK\r\nContent-Type:text/html\r\n\r\n"
    members = [record("warcinfo", b"software: x"), record("response", http + body, **good), record("request", b"GET / HTTP/1.1\r\n\r\n"),
               record("response", http + b"no digest"), record("revisit", http, **good)]
    (tmp_path / "crawl.warc.gz").write_bytes(b"".join(map(gzip.compress, members)))
    (tmp_path / "plain.warc").write_bytes(b"".join(members))
    rows = warc.read_pages(spark, str(tmp_path)).collect()
    assert sorted((r.record_type, bytes(r.payload or b""), r.payload_bytes) for r in rows) == sorted(
        2 * [("response", body, len(body)), ("response", b"no digest", 9), ("revisit", b"", None)], key=lambda x: x[:2])
    (tmp_path / "plain.warc").write_bytes(record("response", http + b"other", **good))
    with pytest.raises(Exception, match="does not fit its digest"):
        warc.read_pages(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="inside a gzip member"):
        warc.unpacked(gzip.compress(b"x" * 100)[:-9])


def test_dechunk():
    assert warc.dechunked(b"3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n") == b"abcde"
    assert warc.dechunked(warc.chunked("é".encode() * 9000)) == "é".encode() * 9000
    with pytest.raises(ValueError, match="chunk"):
        warc.dechunked(b"2\r\nabc\r\n0\r\n\r\n")


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [shingle_words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "decontamination", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    for name in ("language_id", "toxicity", "near_dedup", "decontamination"):
        out = stages[name](spark, docs, sf)
        assert out.columns == docs.columns
        kept = {r.doc_id for r in out.collect()}
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "language_id":
            assert kept == {d for d, t in texts if any(c.isalpha() for c in t)}
        elif name == "toxicity":
            assert len(kept) > 0.7 * len(texts)
        elif name == "near_dedup":
            assert kept == {c if c is not None else d for d, _, c in brute_components(texts, 80)}
        else:
            leaks = {d for d, t in texts for own in items if own and 100 * len(own & shingle_words(t)) >= 80 * len(own)}
            assert leaks and kept == {d for d, _ in texts} - leaks
        docs = out


def test_language_stage_without_labels(spark, sf):
    rows = [(i, t, None, None, None) for i, t in enumerate(["one two", "数据", "12 ...", "", None])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, sf).collect()} == {0, 1}
    unlearned = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 5 = 0 then 'en' end as lang",
                                "source", "n_chars")
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, unlearned, sf).collect()} == {0, 1}


def test_run(spark, sf):
    from tokenizers import Tokenizer

    rows = corpus_pipeline.run(spark, sf).collect()
    kept = {r.doc_id for r in rows}
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.doc_id in kept]
    check_pieces(rows, documents, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_stages_take_small_batches(spark, sf, monkeypatch):
    """Workers get a bounded number of texts at once; a smaller setting stays, and run leaves the session as it was."""
    import pyarrow as pa

    docs = spark.range(2000).selectExpr("id doc_id", "'one two' text", "'en' lang", "'a' source", "7L n_chars").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    def counted(spark, docs, sf_dir):
        return docs.mapInArrow(sizes, "n bigint")

    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    try:
        for name, stage in corpus_pipeline.STAGES:
            for own, most in (("0", 512), ("10000", 512), ("100", 100)):
                spark.conf.set(corpus_pipeline.BATCH_SETTING, own)
                stage(spark, docs.limit(0), sf)
                assert max(r.n for r in counted(spark, docs, sf).collect()) == most, name
        spark.conf.set(corpus_pipeline.BATCH_SETTING, "9999")
        monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", corpus_pipeline.small_batches(counted))])
        monkeypatch.setattr(corpus_pipeline, "parquet", lambda *_: docs)
        rows = [r.n for r in corpus_pipeline.run(spark, sf).collect()]
        assert sum(rows) == 2000 and max(rows) == 512
        assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == "9999"
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)


def test_stages_on_odd_rows(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()


def test_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
