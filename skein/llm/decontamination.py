"""Benchmark decontamination: an FM-index for each training shard.

Words are runs of digits, letters a-z (upper case lowered) and characters
beyond ASCII. A window is ten consecutive words of a test item, or all words
of an item that has fewer.

1. Every shard of training documents is indexed once, over all its words, and
   its index is written as cells of a row (``index_shards``). The table depends on no
   benchmark and can be searched again.
2. Windows are rows with a digest of their words; equal ones of all items are one.
3. Blocks of windows of bounded size are broadcast in turn. In each shard the
   windows all of whose words it has are searched backwards, occurrences are located by
   sampled suffix positions, and leave as rows by document and window.
4. Of documents with occurrences, the words of each are held against the
   window's digest, since the index numbers words by a 64-bit hash; the spans of
   those that are right are merged.

Defined results: null or empty texts have no words and no hits; an item
without words has no window; items of one id are one item; items with a null id
are searched, and count in n_hit and spans but not in n_items. Repeated rows
are reported each. Empty tables give no rows, or no hits. Other columns of the
inputs are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.batches import release, text_pieces
from skein.llm.fm_index import FMIndex
from skein.llm.workspace import Workspace, joined, met_by_key, numbered

WINDOW = 10
#: Text bytes of a shard, and bytes of the windows that are searched together.
SHARD_BYTES, ITEM_BYTES = 2 << 20, 32 << 20
#: Bytes of a row group of indexes.
GROUP_BYTES = 16 << 20
#: Bytes up to which tables with lists are broadcast.
BROADCAST_BYTES = 64 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SEPARATOR = 1
#: Bytes up to which words are hashed side by side; longer ones are taken one by one.
LONG_WORD = 64


class Words:
    """The words of a block of texts: where they begin and end in its lower-case bytes, and texts' first words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        inside = _WORD[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:n])) if n else np.zeros(0, np.int64)
        ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1 if n else starts
        self.data, self.starts, self.ends, self.texts = _LOWER[data], starts, ends, np.searchsorted(starts, offsets)

    def of_text(self, i: int) -> list[bytes]:
        """The words of one text."""
        some = slice(self.texts[i], self.texts[i + 1])
        return [self.data[a:b].tobytes() for a, b in zip(self.starts[some].tolist(), self.ends[some].tolist(), strict=True)]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes at a step, of a long one by a digest."""
        sizes = self.ends - self.starts
        wide = np.concatenate([self.data, np.zeros(16, np.uint8)])
        out = sizes.astype(np.uint64)
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(self.data[self.starts[i] : self.ends[i]].tobytes(), digest_size=8).digest(), "little")
        live, at = np.flatnonzero(sizes <= LONG_WORD), 0
        while len(live):
            chunk = np.lib.stride_tricks.sliding_window_view(wide, 8)[self.starts[live] + at].copy().view("<u8").reshape(-1)
            short = np.minimum(sizes[live] - at, 8)
            chunk &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - 8 * short).astype(np.uint64)
            h = (out[live] ^ chunk) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out[live] = h ^ (h >> np.uint64(29))
            at += 8
            live = live[sizes[live] > at]
        return out


def digest(words: list[bytes]) -> bytes:
    """By which a window's words are told from others."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


WINDOWS = "win binary, words binary, item_id long"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches):
        words = Words(data, offsets)
        hashes = words.hashes()
        wins, codes, of = [], [], []
        for i in range(rows.num_rows):
            own, first = words.of_text(i), int(words.texts[i])
            size = min(WINDOW, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                wins.append(digest(own[at : at + size]))
                codes.append(hashes[first + at : first + at + size].tobytes())
                of.append(i)
        items = rows.column(0).take(pa.array(of, pa.int64()))
        yield pa.record_batch([pa.array(wins, pa.binary()), pa.array(codes, pa.binary()), items], names=["win", "words", "item_id"])


def windows_of(items: DataFrame) -> DataFrame:
    """(win, words, ids): digest, word hashes and items of each distinct window of items (item_id, text)."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(_windows, WINDOWS)
    return rows.groupBy("win").agg(F.min("words").alias("words"), F.collect_set("item_id").alias("ids"))


class Block:
    """Windows that are searched together, by the number of their words."""

    def __init__(self, table: pa.Table):
        self.wins = table.column("win").combine_chunks()
        codes = [np.frombuffer(x, "<u8") for x in table.column("words").to_pylist()]
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        self.words, numbers = np.unique(np.concatenate([np.zeros(0, np.uint64), *codes]), return_inverse=True)
        first = np.cumsum(sizes) - sizes
        #: Places of windows in ``wins``, and places of their words in ``words``.
        self.by_size = [(which := np.flatnonzero(sizes == n), numbers[first[which][:, None] + np.arange(n)]) for n in np.unique(sizes).tolist()]


INDEX = "files array<long>, places array<long>, firsts array<int>, vocabulary binary, n long, bits binary, smaller binary, sampled binary, samples binary"
_FIELDS = [x.split()[0] for x in INDEX.split(", ")]


def _shard(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """The row of one shard's index."""
    words = Words(data, offsets)
    vocabulary, numbers = np.unique(words.hashes(), return_inverse=True)
    firsts = words.texts[:-1] + np.arange(rows.num_rows)  # with a separator after each text
    index = FMIndex(np.insert(numbers + 2, words.texts[1:], SEPARATOR), len(vocabulary) + 2, texts=firsts)
    key = rows.column(0)
    one = {"files": key.field("file").to_numpy(), "places": key.field("place").to_numpy(), "firsts": firsts, "vocabulary": vocabulary.tobytes(), **index.cells()}
    types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.int64(), *[pa.binary()] * 4]
    return pa.record_batch([pa.array([one[f]], t) for f, t in zip(_FIELDS, types, strict=True)], names=_FIELDS)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, "__text", SHARD_BYTES):
        yield _shard(rows, data, offsets)  # its arrays are gone before memory is given back
    release()


def index_shards(rows: DataFrame, work: Workspace) -> DataFrame:
    """The stored table of indexes of rows (__row, __text), a row for each shard."""
    return work.table(rows.select("__row", "__text").mapInArrow(_index, INDEX), "index", group_bytes=GROUP_BYTES)


def occurrences(index: FMIndex, vocabulary: np.ndarray, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(places, windows, words in the window) of all occurrences of a block's windows in a shard."""
    if not len(vocabulary):
        return
    at = np.minimum(np.searchsorted(vocabulary, block.words), len(vocabulary) - 1)
    symbols = np.where(vocabulary[at] == block.words, at + 2, SEPARATOR)
    for which, words in block.by_size:
        patterns = symbols[words]
        known = (patterns != SEPARATOR).all(1)
        which, patterns = which[known], patterns[known]
        low, high = index.search(patterns)
        counts = high - low
        rows = np.repeat(low, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        yield index.locate(rows), np.repeat(which, counts), patterns.shape[1]


FOUND_IN = "file long, place long, win binary, size int, ats array<int>"


def _in_shard(row: dict, block: Block) -> Iterator[pa.RecordBatch]:
    """The documents' windows of one shard, given as a row of the index, with the words at which they occur."""
    index = FMIndex.of_cells(row["n"].as_py(), **{f: row[f].as_buffer() for f in ("bits", "smaller", "sampled", "samples")})
    firsts = row["firsts"].values.to_numpy()
    for places, windows, size in occurrences(index, np.frombuffer(row["vocabulary"].as_buffer(), "<u8"), block):
        if not len(places):
            continue
        doc = np.searchsorted(firsts, places, "right") - 1
        by = np.lexsort((places, windows, doc))
        places, windows, doc = places[by], windows[by], doc[by]
        group = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (windows[1:] != windows[:-1])]))
        ats = pa.ListArray.from_arrays(pa.array(np.append(group, len(doc)), pa.int32()), pa.array(places - firsts[doc], pa.int32()))
        keys = [row[f].values.take(pa.array(doc[group])) for f in ("files", "places")]
        wins = block.wins.take(pa.array(windows[group]))
        yield pa.record_batch([*keys, wins, pa.array(np.full(len(group), size, np.int32)), ats], names=["file", "place", "win", "size", "ats"])


def _search(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _in_shard({f: batch.column(k)[i] for k, f in enumerate(_FIELDS)}, block.value)
        release()

    return run


def search_index(index: DataFrame, windows: DataFrame, work: Workspace) -> DataFrame:
    """(__row, found) of documents in which windows (win, words, ids) occur: found lists win, size, ats (words) and ids.

    Blocks of windows are searched one after the other, each in all shards.
    """
    spark = index.sparkSession
    total = windows.agg(F.sum(F.octet_length("words") + 64)).first()[0] or 0
    blocks = -(-int(total) // ITEM_BYTES)
    parts = [spark.createDataFrame([], FOUND_IN)]
    for k in range(blocks):
        some = windows.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == k).select("win", "words")
        sent = spark.sparkContext.broadcast(Block(some.orderBy("win").toArrow()))
        parts.append(work.table(index.mapInArrow(_search(sent), FOUND_IN), f"found{k}"))
        sent.destroy()
    hits = reduce(DataFrame.unionByName, parts[1:] or parts)
    known = joined(windows.select("win", "ids"), hits.groupBy("win").agg(F.count("*").alias("times")), "win")
    known = work.table(known, "known")
    size = known.agg(F.sum(F.size("ids") * 8 + 64)).first()[0] or 0
    full = met_by_key(hits, known, ["win"], "times") if size <= BROADCAST_BYTES else hits.join(known, "win")
    key = F.struct("file", "place").alias("__row")
    return work.table(full.groupBy(key).agg(F.collect_list(F.struct("win", "size", "ats", "ids")).alias("found")), "found")


FOUND = "n_words long, n_hit long, item_ids array<long>, spans array<struct<start: long, end: long>>"


def _report(names: list[str], cut: bool = False):
    """For rows (kept columns, __text, found): the kept columns, and those of FOUND or the texts less their spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "__text", SHARD_BYTES):
            words = Words(data, offsets)
            n, n_words = rows.num_rows, len(words.starts)
            change = np.zeros(n_words + 1, np.int64)
            item_lists: list[set[int]] = [set() for _ in range(n)]
            found = rows.column(rows.num_columns - 1)
            for i in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)).tolist():
                own, first = words.of_text(i), int(words.texts[i])
                for one in found[i].as_py():
                    size = one["size"]
                    ats = np.array([at for at in one["ats"] if digest(own[at : at + size]) == one["win"]], np.int64) + first
                    np.add.at(change, ats, 1)
                    np.add.at(change, ats + size, -1)
                    if len(ats):
                        item_lists[i].update(one["ids"])
            hit = np.cumsum(change[:-1]) > 0
            totals = np.concatenate([[0], np.cumsum(hit)])[words.texts]
            # spans end where a text ends, whatever follows in the shard
            edge = np.zeros(n_words + 1, bool)
            edge[words.texts] = True
            opens = np.flatnonzero(hit & (np.concatenate([[True], ~hit])[:n_words] | edge[:-1]))
            closes = np.flatnonzero(hit & (np.concatenate([~hit[1:], [True]])[:n_words] | edge[1:]))
            doc = np.searchsorted(words.texts, opens, "right") - 1
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(words.starts[opens] - offsets[doc]), pa.array(words.ends[closes] - offsets[doc])], ["start", "end"]),
            )
            if cut:
                texts = rows.column(rows.num_columns - 2)
                if len(opens):
                    lists = zip(texts.to_pylist(), spans.to_pylist(), strict=True)
                    texts = pa.array([without_spans(t.encode(), x).decode() if x else t for t, x in lists], pa.string())
                yield pa.record_batch([*rows.columns[:-2], texts], names=names)
                continue
            ids = pa.array([sorted(x) for x in item_lists], pa.list_(pa.int64()))
            yield pa.record_batch([*rows.columns[:-2], pa.array(np.diff(words.texts)), pa.array(np.diff(totals)), ids, spans], names=names)

    return run


def _with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with found or null. If found is large, only texts in which something was found are shuffled."""
    size = F.aggregate("found", F.lit(64), lambda n, x: n + 64 + 4 * F.size(x["ats"]) + 8 * F.size(x["ids"])).cast("long")
    if (found.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(found), "__row", "left")
    hit = joined(rows, found.select("__row"), "__row", "left_semi").join(found, "__row")
    clean = joined(rows, found.select("__row"), "__row", "left_anti")
    return hit.unionByName(clean.withColumn("found", F.lit(None).cast(found.schema["found"].dataType)))


def _reported(docs: DataFrame, items: DataFrame, keep: list, text_col: str, work: Workspace | None) -> DataFrame:
    """(c0, c1, ..., __text, found): the kept columns of docs, their texts, and what was found in them or null."""
    work = work or Workspace(docs.sparkSession, "decontamination")
    rows = numbered(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").alias("__text")), work, "__row")
    windows = work.table(windows_of(items), "windows")
    found = search_index(index_shards(rows, work), windows, work)
    work.drop("index", "windows", "known", *[name for name in work.names if name.startswith("found") and name != "found"])
    return _with_found(rows, found).drop("__row")


def find_contamination(docs: DataFrame, items: DataFrame, keep: list[str], text_col: str = "text", work: Workspace | None = None) -> DataFrame:
    """The kept columns of docs, n_words, n_hit, item_ids and spans, for each row.

    items has item_id and text. Spans are byte ranges of the UTF-8 text that
    hold all hit words, merged where they touch.
    """
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), FOUND])
    names = [*keep, "n_words", "n_hit", "item_ids", "spans"]
    return _reported(docs, items, keep, text_col, work).mapInArrow(_report(names), schema)


def without_spans(text: bytes, spans: list[dict]) -> bytes:
    """The text less its spans, a line feed in the place of each."""
    parts, at = [], 0
    for span in spans:
        parts.append(text[at : span["start"]])
        at = span["end"]
    return b"\n".join([*parts, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", work: Workspace | None = None) -> DataFrame:
    """docs with the spans of occurrences cut out of their texts; every row stays, in its columns.

    A text that is all span becomes a line feed. Other columns are carried
    through as they are.
    """
    kept = [c for c in docs.columns if c != text_col]
    sent = _reported(docs, items, kept, text_col, work)
    schema = sent.drop("found").schema
    done = sent.mapInArrow(_report(schema.names, cut=True), schema)
    names = {text_col: "__text"} | {c: f"c{i}" for i, c in enumerate(kept)}
    return done.select(*[F.col(names[c]).alias(c) for c in docs.columns])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, item_ids, spans."""
    return find_contamination(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), items, ["doc_id"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contamination(docs, items)
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


ORACLE = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
lens AS (SELECT DISTINCT n FROM sized),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lens)),
found AS (SELECT p.r, p.n, p.i, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.win = p.win),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.r = d.r LEFT JOIN named m ON m.r = d.r
"""
