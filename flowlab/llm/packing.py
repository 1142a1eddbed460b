"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are powers of two: as many of the longest as fit, then the
binary digits of the rest in falling order. Every piece is a sequence of its own, so none crosses a document,
none needs padding, and equal lengths form the buckets that batches are drawn from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

CACHED_WORDS = 400_000
# A worker hands its pieces on when they hold this many bytes of ids or are this many.
BLOCK_BYTES, BLOCK_PIECES = 1 << 20, 4096

# The split pattern of byte-level BPE vocabularies, written for the characters of PLAIN.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼½¾"
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
NOT_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u017f]")


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids of one split of the text, as little-endian 32-bit bytes; filled as words turn up, emptied when full."""

    def __init__(self, tokenizer):
        super().__init__()
        self._pieces, self._letters = tokenizer.model.tokenize, _byte_letters()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        letters = word.encode().decode("latin-1").translate(self._letters)
        self[word] = ids = np.array([t.id for t in self._pieces(letters)], "<u4").tobytes()
        return ids


class DocumentIds:
    """Ids of a whole text as the tokenizer file gives them, without added tokens.

    A byte-level vocabulary splits a text by pattern and merges inside each split only, so the library's model
    is asked once per distinct split. Texts with a special string, or with characters on which pattern engines
    might differ, go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        self._words = WordIds(self._whole)

    def __call__(self, text: str) -> bytes:
        if NOT_PLAIN.search(text) or any(s in text for s in self._special):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self._words.__getitem__, WORDS.findall(text)))


@lru_cache(maxsize=2)
def document_ids(path: str) -> DocumentIds:
    """One per worker process and file."""
    return DocumentIds(path)


def piece_lengths(n: int, longest: int) -> list[int]:
    """Powers of two that add up to n, none above ``longest``, in falling order."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", longest: int = 2048,
         end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, ids.

    ``ids`` is an array of ints, ``ids_crc32`` the checksum of its little-endian 32-bit form, ``length`` the
    bucket. ``end_id`` closes every document. Null and empty texts give one piece that holds ``end_id`` alone;
    null keys stay null; repeated rows are packed once each; other columns are not read. A sequence id is the
    input partition and the place in it, unique without a shuffle, and the same when a lost task runs again.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    fields = [rows.schema["_key"], *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens"))]
    fields += [StructField("ids", ArrayType(IntegerType()))] if with_ids else []
    schema = StructType(fields)
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = document_ids(tokenizer)
        for batch in batches:
            yield from _piece_blocks(batch.column(0), batch.column(1), encode, end, longest, schema.names, with_ids)

    out = rows.mapInArrow(pieces, schema)
    return out.select(F.col("_key").alias(key), *schema.names[1:], F.monotonically_increasing_id().alias("sequence_id"),
                      F.lit(0).cast("bigint").alias("offset"))


def _piece_blocks(keys: pa.Array, texts: pa.Array, encode, end: bytes, longest: int, names: list[str],
                  with_ids: bool) -> Iterator[pa.RecordBatch]:
    """The pieces of a batch of texts in blocks of bounded size, so that the ids of a whole batch are never held at once.
    A document beyond that size is spread over several blocks."""
    owners, starts, lengths, sums, totals, blobs = [], [], [], [], [], []
    held = 0

    def block() -> pa.RecordBatch:
        columns = [keys.take(pa.array(owners, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
        if with_ids:
            cuts = np.concatenate([[0], np.cumsum(lengths)]).astype("i4")
            flat = pa.array(np.frombuffer(b"".join(blobs), "<i4"), pa.int32())
            columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat))
        for x in (owners, starts, lengths, sums, totals, blobs):
            x.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for i, value in enumerate(texts):
        ids = encode(value.as_py() or "") + end
        at = 0
        for n in piece_lengths(len(ids) // 4, longest):
            part = ids[4 * at: 4 * (at + n)]
            owners.append(i)
            starts.append(at)
            lengths.append(n)
            sums.append(zlib.crc32(part))
            totals.append(len(ids) // 4)
            if with_ids:
                blobs.append(part)
            at += n
            held += len(part)
            if held >= BLOCK_BYTES or len(owners) >= BLOCK_PIECES:
                yield block()
                held = 0
    if owners:
        yield block()


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write packed pieces in one folder per length, ready to be read in batches of equal length."""
    pieces.write.partitionBy("length").parquet(path)


def buckets(pieces: DataFrame) -> DataFrame:
    """Sequences and ids per length."""
    return pieces.groupBy("length").agg(F.count("*").alias("sequences"), F.sum("length").alias("tokens"))
