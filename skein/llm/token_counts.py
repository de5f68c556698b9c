"""Token counts: pieces once per distinct pre-token, joined to frequencies.

1. Texts are split into pre-tokens a shard at a time; each distinct pre-token
   of a shard gives one row with its documents and frequencies there, packed.
2. Those rows are shuffled and sorted by pre-token, so all rows of one meet in
   one task: its pieces are counted once by the tokenizers library, joined to
   the frequencies and added up by document. A frequent pre-token has one row
   a shard, whatever its share of all words, and its shards are dealt into
   ``SALTS`` groups, each of which meets in one task.
3. The sums of each shard's documents are added. Ids are never kept.

Defined results: null or empty text has 0 bytes and 0 tokens; repeated rows
and null ids give a row each; special strings inside texts count as the
library's default has them. Other columns of the input are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import postings
from skein.llm.batches import text_pieces
from skein.llm.pretokens import byte_level_pretokens

#: Text bytes of a shard; it is also the bound of what a task holds at once.
SHARD_BYTES = 12 << 20

_ROWS = "kind int, key binary, shard long, payload binary, salt int"
_SUMS = "kind int, shard long, payload binary"
_SCHEMA_ROWS = pa.schema([("kind", pa.int32()), ("key", pa.binary()), ("shard", pa.int64()), ("payload", pa.binary()), ("salt", pa.int32())])
_SCHEMA_SUMS = pa.schema([("kind", pa.int32()), ("shard", pa.int64()), ("payload", pa.binary())])
DOCS, WORDS = 0, 1
#: A pre-token of so many documents of a shard is dealt by shard into so many groups, each of which counts its pieces.
FREQUENT, SALTS = 256, 64


@cache
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    return found, [x.content.encode() for x in found.get_added_tokens_decoder().values()]


def _slices(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    data, offsets = np.ascontiguousarray(data), offsets.astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _shard_rows(shard: int, ids: list[pa.Array], sizes: list[np.ndarray], words: list[pa.Array], docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row with the shard's documents, and one for each distinct pre-token."""
    sizes = np.concatenate(sizes)
    ids = pa.concat_arrays(ids)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    payload = np.stack([ids.fill_null(0).to_numpy(), known, sizes]).astype("<i8").tobytes()
    yield pa.record_batch([pa.array([DOCS], pa.int32()), pa.array([shard.to_bytes(8, "little")], pa.binary()), pa.array([shard]), pa.array([payload], pa.binary()), pa.array([0], pa.int32())], schema=_SCHEMA_ROWS)
    coded = pa.concat_arrays(words).dictionary_encode()
    if not len(coded):
        return
    pairs, counts = np.unique(coded.indices.to_numpy().astype(np.int64) * len(sizes) + np.concatenate(docs), return_counts=True)
    word, doc = np.divmod(pairs, len(sizes))
    first = np.concatenate([[True], word[1:] != word[:-1]])
    step = np.where(first, doc, doc - np.concatenate([[0], doc[:-1]]))
    data, lengths = postings.pack(np.stack([step, counts], 1).reshape(-1))
    ends = np.cumsum(lengths)[1::2]
    last = np.append(np.flatnonzero(first)[1:] - 1, len(word) - 1)
    lists = _slices(data, np.concatenate([[0], ends[last]]))
    n = len(lists)
    n_docs = np.diff(np.append(np.flatnonzero(first), len(word)))
    salt = np.where(n_docs >= FREQUENT, ((shard >> 32) + shard) % SALTS, 0).astype(np.int32)
    yield pa.record_batch([pa.array(np.full(n, WORDS, np.int32)), coded.dictionary.take(pa.array(word[first])), pa.array(np.full(n, shard)), lists, pa.array(salt)], schema=_SCHEMA_ROWS)


def _frequencies(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        _, special = _library(path)
        shard = TaskContext.get().partitionId() << 32
        held: tuple[list, list, list, list] = ([], [], [], [])
        n_bytes = n_docs = 0
        for rows, data, offsets in text_pieces(batches):
            words, edges = byte_level_pretokens(data, offsets, special)
            for to, x in zip(held, (rows.column(0), np.diff(offsets), words, np.repeat(np.arange(len(offsets) - 1), np.diff(edges)) + n_docs), strict=True):
                to.append(x)
            n_bytes, n_docs = n_bytes + len(data), n_docs + rows.num_rows
            if n_bytes >= SHARD_BYTES or n_docs >= 1 << 18:
                yield from _shard_rows(shard, *held)
                held, n_bytes, n_docs, shard = ([], [], [], []), 0, 0, shard + 1
        if n_docs:
            yield from _shard_rows(shard, *held)

    return run


def _packed_sums(shards: np.ndarray, docs: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """A row a shard; the input is sorted by shard and document."""
    first = np.concatenate([[True], shards[1:] != shards[:-1]])
    step = np.where(first, docs, docs - np.concatenate([[0], docs[:-1]]))
    data, lengths = postings.pack(np.stack([step, sums], 1).reshape(-1))
    ends = np.cumsum(lengths)[1::2]
    last = np.append(np.flatnonzero(first)[1:] - 1, len(shards) - 1)
    lists = _slices(data, np.concatenate([[0], ends[last]]))
    return pa.record_batch([pa.array(np.full(len(lists), WORDS, np.int32)), pa.array(shards[first]), lists], schema=_SCHEMA_SUMS)


def _read(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, number) of packed lists."""
    _, offsets, data = lists.buffers()
    at = np.frombuffer(offsets, np.int32, len(lists) + 1, lists.offset * 4).astype(np.int64)
    values, starts = postings.unpack(np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8))
    step, number = values[0::2], values[1::2]
    row = np.searchsorted(at - at[0], starts[0::2], "right") - 1
    total = np.cumsum(step)
    first = np.searchsorted(row, np.arange(len(lists)))
    base = np.concatenate([[0], total])[first]
    return row, total - base[row], number


def _compressed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shard, doc, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((doc, shard))
    shard, doc, n = shard[order], doc[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (doc[1:] != doc[:-1])]))
    return shard[first], doc[first], np.add.reduceat(n, first)


def _join(path: str, held: int = 400_000):
    """Count each distinct pre-token once; add up by document; at most ``held`` sums are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, _ = _library(path)
        last, last_count = None, 0
        parts, kept = [], 0
        for batch in batches:
            kinds = batch.column(0).to_numpy()
            n_docs = int((kinds == DOCS).sum())  # they sort first
            if n_docs:
                yield pa.record_batch([batch.column(i).slice(0, n_docs) for i in (0, 2, 3)], schema=_SCHEMA_SUMS)
            batch = batch.slice(n_docs)
            if not batch.num_rows:
                continue
            coded = batch.column(1).dictionary_encode()
            names = coded.dictionary.to_pylist()
            new = names[1:] if names[0] == last else names
            counts = [len(x) for x in library.encode_batch_fast([x.decode() for x in new], add_special_tokens=False)]
            counts = [last_count, *counts] if names[0] == last else counts
            last, last_count = names[-1], counts[-1]
            row, doc, times = _read(batch.column(3))
            pieces = np.array(counts)[coded.indices.to_numpy()]
            parts.append((batch.column(2).to_numpy()[row], doc, times * pieces[row]))
            kept += len(doc)
            if kept > held:
                parts = [_compressed(parts)]
                kept = len(parts[0][0])
                if kept > held // 2:
                    yield _packed_sums(*parts[0])
                    parts, kept = [], 0
        if parts:
            yield _packed_sums(*_compressed(parts))

    return run


def _totals(table: pa.Table) -> pa.Table:
    """The documents of one shard with their sums."""
    kinds = table.column("kind").to_numpy()
    lists = table.column("payload").combine_chunks()
    docs = lists.filter(pa.array(kinds == DOCS))
    ids, known, sizes = np.frombuffer(docs[0].as_py(), "<i8").reshape(3, -1)
    total = np.zeros(len(ids), np.int64)
    _, doc, n = _read(lists.filter(pa.array(kinds == WORDS)))
    np.add.at(total, doc, n)
    return pa.table({"doc_id": pa.array(ids, mask=known == 0), "n_bytes": sizes, "n_tokens": total})


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = rows.mapInArrow(_frequencies(tokenizer_path), _ROWS)
    met = words.repartition("key", "salt").sortWithinPartitions("kind", "key").drop("salt")
    sums = met.mapInArrow(_join(tokenizer_path), _SUMS)
    return sums.groupBy("shard").applyInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)
