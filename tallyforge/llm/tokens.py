"""Encoding a whole corpus with a public tokenizer, long texts in overlapping chunks.

A text of more than chunk_chars is cut into chunks that overlap. Every chunk is
pre-tokenised by itself, in parallel. The first position in the overlap that is a
pre-token boundary in both chunks is a boundary of the whole text, and from there on
the second chunk's boundaries are the text's own, as a pre-token depends on what
follows it only. Pieces between such positions are encoded and their ids put together.
Where an overlap holds no common boundary (an endless word), the pieces on both sides are
put together before they are encoded, so the ids are always those of the whole text.

A chunk comes with the one before it and finds its two ends by itself, so no task looks
at a whole text again once it is cut, and the work grows in proportion to the text.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import stored

#: Folder of the public vocabulary files; every function takes it as a parameter.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k"
CHUNK_CHARS, OVERLAP = 4096, 512
# Fixed value: the pre-token pattern of this byte-level BPE.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(4)
def encoding(name: str, folder: str):
    import tiktoken

    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(1)
def _pattern():
    import regex

    return regex.compile(PATTERN)


def decode(ids: list[int], name: str = TOKENIZER, folder: str = TOKENIZER_DIR) -> bytes:
    """The raw bytes of the ids, put together."""
    return encoding(name, folder).decode_bytes(ids)


def _encode(batches: Iterator[pa.RecordBatch], name: str, folder: str, count: bool) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, text, by its ids or by their number."""
    enc = encoding(name, folder)
    for b in batches:
        texts = b.column(b.num_columns - 1).to_pylist()
        ids = [enc.encode_ordinary(t) if t else [] for t in texts]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        if count:
            col, field = pa.array(sizes), "n_tokens"
        else:
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum(sizes, out=offsets[1:])
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1]))
            col, field = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), "ids"
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], col], names=[*b.schema.names[:-1], field])


def _boundaries(text: str) -> list[int]:
    """Starts of pre-tokens as far as the end of the text can't change them."""
    out, n = [], len(text)
    for m in _pattern().finditer(text):
        out.append(m.start())
        if m.end() >= n:
            break
    return out


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """The chunks of each text, each with the one before it and the overlap behind it; last marks a text's last one."""
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            h, n = hashlib.md5(t.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest(), -(-len(t) // chunk)
            for at in range(0, n, 256):
                ks = range(at, min(at + 256, n))
                texts = [t[max(0, k - 1) * chunk : (k + 1) * chunk + overlap] for k in ks]
                cols = [pa.array([i] * len(ks), pa.int64()), pa.array([h] * len(ks), pa.binary()), pa.array(ks, pa.int64()), pa.array([k == n - 1 for k in ks]), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "h", "k", "last", "text"])


def _joint(before: str, chunk: int, overlap: int) -> int | None:
    """Where two chunks meet, counted from the second one's start; before is the first chunk with the overlap behind it. None without a common boundary."""
    tail = {x - chunk for x in _boundaries(before) if x >= chunk}
    return min(tail & {*_boundaries(before[chunk : chunk + overlap])}, default=None)


def _pieces(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """The piece of text of each chunk; joined if it goes on with the piece before it, open if the next one goes on with it."""
    for b in batches:
        texts, joined, opened = [], [], []
        for k, last, t in zip(b.column("k").to_pylist(), b.column("last").to_pylist(), b.column("text").to_pylist(), strict=True):
            own = chunk if k else 0
            start = _joint(t[: own + overlap], chunk, overlap) if k else 0
            end = None if last else _joint(t[own:], chunk, overlap)
            texts.append(t[own + (start or 0) :] if last else t[own + (start or 0) : own + chunk + (end or 0)])
            joined.append(start is None)
            opened.append(not last and end is None)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "h", "k")), pa.array(joined), pa.array(opened), pa.array(texts, pa.string())], names=["doc_id", "h", "k", "joined", "open", "text"])


def _encoded(df: DataFrame, keys: str, name: str, folder: str, count: bool = False) -> DataFrame:
    return df.mapInArrow(partial(_encode, name=name, folder=folder, count=count), f"{keys}, {'n_tokens int' if count else 'ids array<int>'}")


def corpus_pieces(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, h, k, n, text): the texts longer than chunk, in pieces that can be encoded each by itself, n times the same."""
    if overlap >= chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    cut = docs.filter(F.length("text") > chunk).mapInArrow(partial(_chunks, chunk=chunk, overlap=overlap), "doc_id long, h binary, k long, last boolean, text string")
    # The chunks of one text go to all tasks.
    pieces = cut.repartition("doc_id", "h", "k").mapInArrow(partial(_pieces, chunk=chunk, overlap=overlap), "doc_id long, h binary, k long, joined boolean, open boolean, text string")
    pieces = stored(pieces)
    single = pieces.filter("not joined and not open").groupBy("doc_id", "h", "k").agg(F.count("*").alias("n"), F.first("text").alias("text"))
    several = pieces.filter("joined or open").withColumn("from", F.max(F.when(~F.col("joined"), F.col("k"))).over(Window.partitionBy("doc_id", "h").orderBy("k")))
    parts = F.array_sort(F.collect_set(F.struct("k", "text")))
    several = several.groupBy("doc_id", "h", "from").agg(F.count_if(F.col("k") == F.col("from")).alias("n"), F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"))
    return single.unionByName(several.withColumnRenamed("from", "k"))


def encode_corpus(docs: DataFrame, name: str = TOKENIZER, folder: str = TOKENIZER_DIR, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids): the ids of every text, without special tokens; empty and null texts have none.

    Each row of docs gives one row, repeated rows included; a null doc_id stays null.
    Only doc_id and text are read. Texts up to chunk characters are encoded where they
    are, without a shuffle.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    short = _encoded(docs.filter((F.length("text") <= chunk) | F.col("text").isNull()), "doc_id long", name, folder)
    pieces = _encoded(corpus_pieces(docs, chunk, overlap), "doc_id long, h binary, k long, n long", name, folder)
    whole = pieces.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("p"), F.max(F.when(F.col("k") == 0, F.col("n"))).cast("int").alias("n"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    whole = whole.select("doc_id", F.explode(F.array_repeat(ids, F.col("n"))).alias("ids"))
    return short.unionByName(whole)


def token_counts(docs: DataFrame, keys: str, name: str = TOKENIZER, folder: str = TOKENIZER_DIR) -> DataFrame:
    """docs with text replaced by n_tokens; keys is the schema of the other columns, text comes last."""
    return _encoded(docs, keys, name, folder, count=True)
