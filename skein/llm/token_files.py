"""Token-id files: raw id payloads with a minimal perfect hash index over document keys.

A file is a table of shards in ascending document order; the shards are cells
of a Parquet table, so that any store Spark reads will do and lost tasks are
written again. A shard holds

* payload: its documents' ids one after another, little-endian, two bytes each
  where the vocabulary fits, else four;
* index: a minimal perfect hash (bit levels with a rank directory) from
  document key to slot, and for each slot a fingerprint of its key, the
  document's first id in the payload and its number of ids. Access to a key
  takes constant time and tells keys that are not there by the fingerprint;
* keys: the keys in order, to list a shard.

A key is a document id and, for ids that occur again in a shard, the number of
earlier occurrences. Null ids come first and are keys as well.

Defined results: null and empty texts hold the end id alone; repeated rows are
documents each; no rows give no shards. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.batches import text_pieces
from skein.llm.pretokens import encoder
from skein.llm.workspace import Workspace, joined

END_ID = 1
#: Ids of a shard before the next one begins, at the end of a block of texts.
SHARD_IDS = 2 << 20
MAGIC = b"SKTK0001"
NULL = 1 << 62

SHARDS = "part int, shard int, before long, n_docs long, n_ids long, first_id long, last_id long, keys binary, index binary, payload binary"
_SHARD_SCHEMA = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
    + [("first_id", pa.int64()), ("last_id", pa.int64()), ("keys", pa.binary()), ("index", pa.binary()), ("payload", pa.binary())]
)
READ = "doc_id long, part int, at long, n_tokens long, ids_crc32 long"
_READ_SCHEMA = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of 64-bit numbers."""
    x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def hashed_keys(ids: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each (id, occurrence); a null id has occurrence NULL and more."""
    return _mixed(_mixed(ids.astype(np.int64).view(np.uint64), 1) + occurrence.astype(np.int64).view(np.uint64), 2)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit numbers: n of them to 0 .. n - 1."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])[:-1].astype(np.uint32) if len(words) else np.zeros(0, np.uint32)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        left, sizes, levels = hashes, [], []
        while len(left):
            if len(sizes) == 64:
                raise ValueError("keys are not distinct")
            size = (len(left) * 3 // 2 + 64) // 64 * 64
            at = (_mixed(left, 10 + len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, "<u8"))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each number; any slot, or -1, for one that is not among the keys."""
        out = np.full(len(hashes), -1, np.int64)
        left, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = base + (_mixed(hashes[left], 10 + level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.ranks[at >> 6] + below)[hit]
            left, base = left[~hit], base + size
        return out


def build_index(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    perfect = PerfectHash.build(hashes)
    slots = np.zeros((len(hashes), 3), "<u4")
    at = perfect.slots(hashes)
    slots[at, 0] = (hashes >> np.uint64(32)).astype(np.uint32)
    slots[at, 1] = starts
    slots[at, 2] = lengths
    head = MAGIC + struct.pack("<III", width, len(hashes), len(perfect.sizes)) + np.array(perfect.sizes, "<u4").tobytes()
    return head + perfect.words.astype("<u8").tobytes() + slots.tobytes()


class Index:
    """An index that was read back."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token index")
        self.width, n, levels = struct.unpack_from("<III", data, 8)
        sizes = np.frombuffer(data, "<u4", levels, 20).tolist()
        words = np.frombuffer(data, "<u8", sum(sizes) // 64, 20 + 4 * levels)
        self.perfect = PerfectHash(sizes, words)
        self.table = np.frombuffer(data, "<u4", 3 * n, 20 + 4 * levels + 8 * len(words)).reshape(n, 3)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, first id, number of ids) for each key."""
        at = self.perfect.slots(hashes)
        if not len(self.table):
            return np.zeros(len(at), bool), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        rows = self.table[np.maximum(at, 0)]
        found = (at >= 0) & (rows[:, 0] == (hashes >> np.uint64(32)).astype(np.uint32))
        return found, rows[:, 1].astype(np.int64), rows[:, 2].astype(np.int64)


def _occurrences(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(id, occurrence) of ids in ascending order, nulls first."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy()
    place = np.arange(len(values))
    same = np.concatenate([[False], (values[1:] == values[:-1]) & (null[1:] == null[:-1])]) if len(values) else np.zeros(0, bool)
    run = np.maximum.accumulate(np.where(same, 0, place)) if len(values) else place
    return values, place - run + np.where(null, NULL, 0)


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, before = TaskContext.get().partitionId(), 0, 0
        coder = encoder(path)
        width = 2 if max(coder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        held, n = [], 0

        def flush():
            ids = pa.concat_arrays([x for x, _, _ in held])
            lengths = np.concatenate([x for _, x, _ in held])
            payload = b"".join(x for _, _, x in held)
            values, occurrence = _occurrences(ids)
            index = build_index(hashed_keys(values, occurrence), np.cumsum(lengths) - lengths, lengths, width)
            known = ids.drop_null()
            ends = [known[0].as_py(), known[-1].as_py()] if len(known) else [None, None]
            row = [part, shard, before, len(ids), n, *ends, np.stack([values, occurrence]).astype("<i8").tobytes(), index, payload]
            return pa.record_batch([pa.array([x], f.type) for x, f in zip(row, _SHARD_SCHEMA, strict=True)], schema=_SHARD_SCHEMA)

        for rows, data, offsets in text_pieces(batches):
            ids, at = coder.encode(data, offsets)
            ids = np.insert(ids, at[1:], end_id)
            held.append((rows.column(0), np.diff(at) + 1, ids.astype(f"<u{width}").tobytes()))
            n += len(ids)
            if n >= SHARD_IDS:
                yield flush()
                shard, before, held, n = shard + 1, before + n, [], 0
        if held:
            yield flush()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, work: Workspace, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode docs in ascending id order into a table of shards; returns the table read back."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    ordered.mapInArrow(_write(tokenizer_path, end_id), SHARDS).write.option("compression", "zstd").parquet(work.path("tokens"))
    return work.read("tokens")


def _read_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every key of every shard, looked up through the index."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
            values, occurrence = np.frombuffer(one["keys"].as_py(), "<i8").reshape(2, -1)
            index = Index(one["index"].as_py())
            found, start, length = index.find(hashed_keys(values, occurrence))
            if not found.all():
                raise ValueError("a key of the shard is not in its index")
            ids = np.frombuffer(one["payload"].as_buffer(), f"<u{index.width}").astype("<u4")
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(start.tolist(), length.tolist(), strict=True)]
            before, part = one["before"].as_py(), one["part"].as_py()
            yield pa.record_batch(
                [pa.array(values, mask=occurrence >= NULL), pa.array(np.full(len(values), part, np.int32)), pa.array(before + start), pa.array(length), pa.array(crc, pa.int64())],
                schema=_READ_SCHEMA,
            )


def read_documents(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document; start counts the ids of all before it."""
    found = tokens.select("keys", "index", "payload", "before", "part").mapInArrow(_read_keys, READ)
    # a row for each writing task: as many as the shuffle has partitions
    parts = tokens.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return found.join(bases, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


#: Shards up to which a lookup names them to the reader, which then skips the others' row groups; of more, rows are chosen as they are read.
NAMED = 1_000


def shards_of(tokens: DataFrame, doc_ids: list[int | None]) -> DataFrame:
    """(part, shard) of the shards that can hold one of the ids: each shard's range of ids is searched in the sorted ids asked for.

    Reads the ranges only, no payload and no index. Documents are in ascending order, so an id is in one shard, or in
    neighbouring ones if it repeats.
    """
    wanted, nulls = np.array(sorted({i for i in doc_ids if i is not None}), np.int64), None in doc_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            first, last = (batch.column(k).fill_null(0).to_numpy() for k in (2, 3))
            holds = known & (np.searchsorted(wanted, last, "right") > np.searchsorted(wanted, first, "left"))
            if nulls:
                holds |= batch.column(4).to_numpy(zero_copy_only=False)
            yield pa.record_batch([batch.column(k).filter(pa.array(holds)) for k in (0, 1)], names=["part", "shard"])

    # nulls come first: the first shard with a known id, and those before it, can hold them
    known = tokens.where("first_id is not null").agg(F.min(F.struct("part", "shard")).alias("at")).first()["at"]
    null_ids = F.lit(True) if known is None else F.struct("part", "shard") <= F.struct(F.lit(known["part"]), F.lit(known["shard"]))
    ranges = tokens.withColumn("null_ids", null_ids)
    return ranges.select("part", "shard", "first_id", "last_id", "null_ids").mapInArrow(run, "part int, shard int")


def lookup(tokens: DataFrame, doc_ids: list[int | None]) -> DataFrame:
    """(doc_id, ids) of every document with one of the given ids, null among them if None is given.

    Only the shards of ``shards_of`` are looked into. Occurrences of an id in a shard are asked for one after another
    until one is not there.
    """
    wanted, nulls = sorted({i for i in doc_ids if i is not None}), None in doc_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index, payload in zip(batch.column(0), batch.column(1), strict=True):
                read = Index(index.as_py())
                ids = np.frombuffer(payload.as_buffer(), f"<u{read.width}")
                keys = np.array([*wanted, *([0] if nulls else [])], np.int64)
                occurrence = np.array([*([0] * len(wanted)), *([NULL] if nulls else [])], np.int64)
                while len(keys):
                    found, start, length = read.find(hashed_keys(keys, occurrence))
                    keys, occurrence = keys[found], occurrence[found]
                    lists = [ids[a : a + n].astype(np.int64) for a, n in zip(start[found].tolist(), length[found].tolist(), strict=True)]
                    yield pa.record_batch([pa.array(keys, mask=occurrence >= NULL), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "ids"])
                    occurrence = occurrence + 1

    chosen = shards_of(tokens, doc_ids)
    named = chosen.limit(NAMED + 1).collect()
    if len(named) <= NAMED:
        holds = F.lit(False)
        for part in sorted({r["part"] for r in named}):
            holds |= (F.col("part") == part) & F.col("shard").isin([r["shard"] for r in named if r["part"] == part])
        held = tokens.where(holds)
    else:
        held = joined(tokens, chosen, ["part", "shard"], "left_semi")
    return held.select("index", "payload").mapInArrow(run, "doc_id long, ids array<long>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_documents(write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), Workspace(spark, "tokens")))
