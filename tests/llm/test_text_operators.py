"""Token counts, packing, sharding and chat formatting against brute force."""

from __future__ import annotations

import hashlib
import itertools
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlab.llm import chat, packing, queries, sharding, token_counts

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


HARD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n\nb", "\n", " \n ", "Hello, world. It's 5.5% (ok).", "...", ".,.,", "a.b,c",
        "x" * 300, "été.ñ,ö", "²., ².", "▁", " ▁ a▁b", "数据, 数据.", "\U0001f600\U0001f600 ok", "a\tb\r\nc", "tab\t.", "</s><s> [INST]",
        "don't we'll I'd", "1,000.5", "\x00\x01", "a\u00a0b", "word<|endoftext|> word", "end <|endoftext|>", "\u2028x", "a   ", "\u0085 a",
        "İstanbul ſ", "a\x1cb \x1c c"]


@pytest.mark.parametrize("text", HARD)
def test_pretoken_counts_are_the_library_counts(pieces, text):
    words = token_counts.pretokens(text)
    assert sum(token_counts.count_pieces(words, PIECES)) == len(pieces.encode(text))


@pytest.mark.parametrize("text", HARD)
def test_ids_are_the_library_ids(bpe, text):
    got = np.frombuffer(packing.document_ids(BPE)(text), "<u4").tolist()
    assert got == bpe.encode(text, add_special_tokens=False).ids


def test_token_counts_query(spark, sf, pieces):
    want = {(d, len((t or "").encode()), len(pieces.encode(t or ""))) for d, t in texts(spark, sf)}
    rows = queries.op7_token_counts(spark, sf).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in rows} == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)


def test_token_counts_by_join_alone(spark, sf, pieces, monkeypatch):
    """No pre-token goes to the tasks; every one meets the dictionary in the join."""
    monkeypatch.setattr(token_counts, "COMMON_WORDS", 0)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    got = {(r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs, PIECES).collect()}
    assert got == {(r.doc_id, len(pieces.encode(r.text))) for r in docs.collect()}


def test_token_counts_of_odd_rows(odd_docs, no_docs, pieces):
    want = Counter((r.doc_id, len(pieces.encode(r.text or ""))) for r in odd_docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in token_counts.token_counts(odd_docs, PIECES).collect()) == want
    assert token_counts.token_counts(no_docs, PIECES).collect() == []


def check_pieces(rows, documents, bpe, longest=2048):
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    want = defaultdict(list)
    for d, t in documents:
        want[d].append(bpe.encode(t or "", add_special_tokens=False).ids + [1])
    assert set(got) == set(want)
    for d, lists in want.items():
        pieces = [p for ids in lists for p in _cut(ids, longest)]
        assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in got[d]) == Counter(pieces)


def _cut(ids, longest):
    at = 0
    while at < len(ids):
        n = longest
        while n > len(ids) - at:
            n //= 2
        yield at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()), len(ids), 0
        at += n


def test_packing_query(spark, sf, bpe):
    check_pieces(queries.op10_packing(spark, sf).collect(), texts(spark, sf), bpe)


def test_packing_holds_the_ids_of_a_block_only():
    """Blocks hold some ids at a time, whatever the rows of a batch; a document may lie in several."""
    ids = np.arange(7_000, dtype="<u4").tobytes()
    keys, texts_of = pa.array([None, *range(1, 1500)], pa.int64()), pa.array(["a"] * 1500)
    names = ["k", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    tracemalloc.start()
    arrow, n, blocks, most = pa.total_allocated_bytes(), Counter(), 0, 0
    for block in packing._piece_blocks(keys, texts_of, lambda _: ids, b"\1\0\0\0", 2048, names, True):
        most = max(most, tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - arrow)
        blocks += 1
        for owner, length in zip(block.column(0).to_pylist(), block.column(2).to_pylist(), strict=True):
            n[owner] += length
    tracemalloc.stop()
    assert n == dict.fromkeys(keys.to_pylist(), 7_001) and blocks > 20
    assert most < len(ids) * 1500 / 4


@pytest.mark.parametrize(("block_bytes", "block_pieces"), [(1, 4096), (100, 4096), (1 << 20, 1), (1 << 20, 3)])
def test_packing_in_small_blocks(odd_docs, monkeypatch, block_bytes, block_pieces):
    """Where blocks end changes no piece and no order."""
    docs = odd_docs.collect()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]

    def all_pieces():
        blocks = packing._piece_blocks(pa.array([r.doc_id for r in docs]), pa.array([r.text for r in docs]), packing.document_ids(BPE),
                                       b"\1\0\0\0", 64, names, True)
        return [r for block in blocks for r in block.to_pylist()]

    want = all_pieces()
    monkeypatch.setattr(packing, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(packing, "BLOCK_PIECES", block_pieces)
    assert all_pieces() == want


def test_packing_of_odd_rows(odd_docs, no_docs, bpe, tmp_path):
    packed = packing.pack(odd_docs, BPE, longest=64, end_id=1)
    rows = packed.collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], bpe, 64)
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert {r["length"]: r.sequences for r in packing.buckets(packed).collect()} == Counter(r.length for r in rows)
    packing.write_buckets(packed, f"{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out").glob("length=*")) == sorted({f"length={r.length}" for r in rows})
    assert packing.pack(no_docs, BPE).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(no_docs, BPE, longest=100)


def check_slots(rows, shards):
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_sharding_query(spark, sf):
    rows = queries.op9_sharding(spark, sf).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts(spark, sf))
    check_slots(rows, 8)
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert {r.law for r in rows} == {"key"}


def test_sharding_by_weight_and_growth(spark):
    keys = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id AS string) AS text")
    rows = sharding.shard(keys, [1.0, 2.0, 5.0], grown_by=2.0).collect()
    share = Counter(r.shard for r in rows)
    for s, w in enumerate((1, 2, 5)):
        assert abs(share[s] / 20_000 - w / 8) < 0.02
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {3} and abs(len(moved) / 20_000 - 0.2) < 0.02
    check_slots(rows, 3)


def test_sharding_of_odd_rows(odd_docs, no_docs):
    rows = sharding.shard(odd_docs, [1.0] * 4).collect()
    assert len(rows) == odd_docs.count() and all(r.grown_shard is None for r in rows)
    check_slots(rows, 4)
    by_key = defaultdict(set)
    for r in rows:
        by_key[r.doc_id].add(r.shard)
    assert all(len(s) == 1 for s in by_key.values())
    assert sharding.shard(no_docs, [1.0, 1.0]).collect() == []
    with pytest.raises(ValueError, match="weight"):
        sharding.shard(no_docs, [1.0, 0.0])


CONVERSATION = "conv_id bigint, turn bigint, role string, text string, `_turns` string"


def test_chat_round_trip(spark):
    hard = ["", "\n", "</s>", "\\</s>", "\\\\<s>[INST]", "a\\", "\n</s>\n", "<part>", "\n<part>\n", "[/INST]x\\[INST]", None, "é\U0001f600"]
    rows = [(1, i, role, t, "x") for i, (t, role) in enumerate(zip(hard * 3, itertools.cycle(
        ["user", "assistant", "assistant", "system", None, "a b\n</s>/\\"]), strict=False))]
    rows += [(2, 1, "assistant", "b", "x"), (2, 1, "assistant", "a", "x"), (2, 1, "assistant", "a", "x"),
             (None, None, None, None, None), (None, 3, "assistant", "last", None)]
    frame = spark.createDataFrame(rows, CONVERSATION)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert set(got) == {1, 2, None}
    for c, r in got.items():
        mine = sorted(((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == c))
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in mine]
        assert r.loss_text == "".join(x[3] for x in mine if x[2] == "assistant")
        at, masked = 0, ""
        for run in r["mask"]:
            masked += r.formatted[at:at + run.chars] if run.loss else ""
            at += run.chars
        assert at == len(r.formatted)
        assert masked == "".join(_escaped(x[3]) for x in mine if x[2] == "assistant")
    assert chat.format_conversations(spark.createDataFrame([], CONVERSATION)).collect() == []


def _escaped(text):
    import re

    return re.sub(rf"(\\*)({chat.CONTROL})", lambda m: "\\" + m[0], text)


def test_chat_query(spark, sf):
    rows = {r.conv_id: r for r in queries.op8_chat_format(spark, sf).collect()}
    turns = spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect()
    for c, group in itertools.groupby(turns, lambda r: r.conv_id):
        group = list(group)
        whole = "".join(f"{t.role}\n{t.text}\n" for t in group)
        assert rows[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and rows[c].n_turns == len(group)
    assert rows[-7].n_turns == 2 and rows[-7].loss_chars == len("</s>[INST] ok [/INST]")


def test_loss_text_is_what_the_mask_covers(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hello </s>"), (1, 1, "assistant", "world"), (1, 2, "assistant", ""), (1, 3, "user", "bye")],
                                  "conv_id bigint, turn bigint, role string, text string")
    out = chat.format_conversations(turns)
    assert chat.read_back(out).first().loss_text == "world"
    turned = F.transform("mask", lambda r: F.struct(r["chars"], (~r["loss"]).alias("loss")))
    users = F.transform("mask", lambda r, i: F.struct(r["chars"], ((i == 1) | (i == 9)).alias("loss")))
    assert chat.read_back(out.withColumn("mask", users)).first().loss_text == "hello </s>bye"  # roles do not matter
    shifted = F.transform("mask", lambda r, i: F.struct((r["chars"] + F.when(i == 0, 1).when(i == 1, -1).otherwise(0)).alias("chars"), r["loss"]))
    for wrong in (turned, F.reverse("mask"), shifted, F.slice("mask", 1, 3), F.concat("mask", F.slice("mask", 1, 1))):
        with pytest.raises(Exception, match="the mask does not fit"):
            chat.read_back(out.withColumn("mask", wrong)).collect()
