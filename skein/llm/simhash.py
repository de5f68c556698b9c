"""SimHash near-duplicates by anchor points of a covering code.

1. Fingerprints: 64 majority bits over the hashes of a text's word shingles.
   Equal fingerprints are one from here on, whatever their number.
2. Anchors: two fingerprints within four bits are within two bits in the low
   half or within one bit in the high half. For each half, a fingerprint is
   replicated to every anchor of a covering code within covering radius plus
   that threshold, and marked at its nearest anchor. A linked pair meets at the
   nearest anchor of either.
3. At each anchor, the fingerprints at home there are compared with all that
   came. An anchor with more than ``BUCKET`` of them is cut into a grid of cells,
   each comparing one part of the homes with one part of the others. What leaves
   a task are spanning forests of its links, not pairs.
4. Distributed union-find joins the forests.

Defined results: null text counts as empty; a text without words has
fingerprint zero and is linked like any other; rows with a null id take part in
links but give no component id; if all ids of a component are null its id is
null. Repeated rows are kept each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.batches import text_pieces
from skein.llm.components import connected_components, local_components
from skein.llm.covering import Code, anchors, code_for
from skein.llm.workspace import Workspace, joined, met_by_key, numbered, unused

SHINGLE, THRESHOLD, SEED = 4, 4, 42
#: Bits in which the halves may differ: (shift of the half, threshold there).
HALVES = ((0, 2), (32, 1))
#: Fingerprints that are compared at one anchor in one cell, and pairs at once.
BUCKET, PAIRS = 20_000, 2_000_000

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Each byte's bits, a byte each in a 64-bit word.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def shingle_spans(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(clean, starts, ends, counts): lower-case text with one blank between words, and its shingles.

    counts: the shingles of each text. A text with fewer words than a shingle
    has one of all its words; one without words has none.
    """
    n = len(data)
    blank = _BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[True], blank[:-1]]) if n else blank
    keep = ~blank | ~(before | edge[:n])
    clean = np.where(blank, np.uint8(32), _LOWER[data])[keep]
    place = np.concatenate([[0], np.cumsum(keep)])
    begins = ~blank & (before | edge[:n])
    last = ~blank & (np.concatenate([blank[1:], [True]]) | edge[1:]) if n else blank
    word_start, word_end = place[np.flatnonzero(begins)], place[np.flatnonzero(last)] + 1
    words = np.searchsorted(np.flatnonzero(begins), offsets)
    counts = np.diff(words)
    shingles = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    first = np.repeat(words[:-1], shingles) + np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    final = first + np.minimum(np.repeat(counts, shingles), size) - 1
    return clean, word_start[first], word_end[final], shingles


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of hashes, the bits set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    runs = (counts[full] + 254) // 255  # of up to 255 hashes, whose sums fit a byte
    owner = np.repeat(np.arange(len(full)), runs)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = np.repeat(np.cumsum(counts[full]) - counts[full], runs) + 255 * within
    first_run = np.cumsum(runs) - runs
    for k in range(8):
        spread = _SPREAD[((hashes >> np.uint64(8 * k)) & np.uint64(255)).astype(np.int64)]
        sums = np.add.reduceat(spread, starts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        total = np.add.reduceat(sums, first_run, 0)
        byte = np.packbits(2 * total > counts[full][:, None], axis=1, bitorder="little").reshape(-1)
        out[full] |= byte.astype(np.uint64) << np.uint64(8 * k)
    return out


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    import xxhash

    clean, starts, ends, counts = shingle_spans(data, offsets, size)
    text, digest = clean.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    return majority_bits(hashes, counts)


def _fingerprint(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "__text"):
            found = fingerprints_of(data, offsets, size).view(np.int64)
            yield pa.record_batch([*rows.columns[:-1], pa.array(found)], names=[*rows.schema.names[:-1], "fingerprint"])

    return run


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """The kept columns of docs and fingerprint (the 64 bits as a signed number)."""
    schema = docs.select(*keep, F.lit(0).cast("long").alias("fingerprint")).schema
    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(_fingerprint(size), schema)


def _replicate(codes: list[Code]):
    """Every fingerprint at its anchors; a code for each half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                prints = batch.column(0).slice(at, 4096).to_numpy().view(np.uint64)
                for half, ((shift, threshold), code) in enumerate(zip(HALVES, codes, strict=True)):
                    words = ((prints >> np.uint64(shift)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    row, anchor, home = anchors(code, words, threshold)
                    key = anchor.astype(np.int64) | half << 32
                    yield pa.record_batch([pa.array(key), pa.array(prints[row].view(np.int64)), pa.array(home)], names=["anchor", "fingerprint", "home"])

    return run


def _forest(prints: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
    tied = np.flatnonzero(labels != np.arange(len(labels)))
    return pa.record_batch([pa.array(prints[tied].view(np.int64)), pa.array(prints[labels[tied]].view(np.int64))], names=["a", "b"])


def _cell_links(prints: np.ndarray, home: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Labels of rows after linking each home row with the rows of its cell; cells begin at begins."""
    n = len(prints)
    labels = np.arange(n)
    ends = np.append(begins[1:], n)
    cell = np.searchsorted(begins, np.arange(n), "right") - 1
    homes = np.flatnonzero(home)
    sizes = (ends - begins)[cell[homes]]
    pairs = np.cumsum(sizes)
    at = 0
    while at < len(homes):
        base = pairs[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(pairs, base + PAIRS, "right")))
        some, n_pairs = homes[at:to], sizes[at:to]
        a = np.repeat(some, n_pairs)
        b = np.repeat(begins[cell[some]], n_pairs) + np.arange(len(a)) - np.repeat(np.cumsum(n_pairs) - n_pairs, n_pairs)
        linked = np.bitwise_count(prints[a] ^ prints[b]) <= THRESHOLD
        labels = local_components(n, a[linked], b[linked], labels)
        at = to
    return labels


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells arrive one after another; a cell that a batch cuts is held until its end."""
    rest = None
    for batch in _with_end(batches):
        rows = batch if rest is None else (pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0] if batch is not None else rest)
        if rows is None or not rows.num_rows:
            continue
        keys, cells = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (cells[1:] != cells[:-1])]))
        last = len(keys) if batch is None else int(begins[-1])
        rest = rows.slice(last)
        if last:
            prints = rows.column(2).slice(0, last).to_numpy().view(np.uint64)
            home = rows.column(3).slice(0, last).to_numpy(zero_copy_only=False)
            yield _forest(prints, _cell_links(prints, home, begins[begins < last]))


def _with_end(batches):
    yield from batches
    yield None


def link_forest(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect distinct fingerprints as all links of up to THRESHOLD bits do.

    The codes are as fine as the number of fingerprints asks for.
    """
    n = prints.count()
    came = prints.mapInArrow(_replicate([code_for(n, threshold) for _, threshold in HALVES]), "anchor long, fingerprint long, home boolean")
    crowded = came.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
    crowded = crowded.select("anchor", F.ceil(F.col("n") / bucket).cast("int").alias("parts"))
    if crowded.isEmpty():
        cells = came.select("anchor", F.lit(0).alias("cell"), "fingerprint", "home")
    else:
        own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        row = F.transform(every, lambda i: F.struct((own * F.col("parts") + i).alias("cell"), F.lit(True).alias("home")))
        column = F.transform(every, lambda i: F.struct((i * F.col("parts") + own).alias("cell"), F.lit(False).alias("home")))
        plain = F.array(F.struct(F.lit(0).alias("cell"), F.col("home").alias("home")))
        where = F.when(F.col("parts").isNull(), plain).when(F.col("home"), F.concat(row, column)).otherwise(column)
        spread = came.join(crowded, "anchor", "left").select("anchor", "fingerprint", F.explode(where).alias("w"))
        cells = spread.select("anchor", F.col("w.cell").alias("cell"), "fingerprint", F.col("w.home").alias("home"))
    met = cells.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    return met.mapInArrow(_compare, "a long, b long").distinct()


def components(rows: DataFrame, work: Workspace) -> DataFrame:
    """(fingerprint, times, least): for each fingerprint of rows (id, fingerprint), its rows and the least id of its component."""
    distinct = work.table(rows.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count("*").alias("times")), "distinct")
    roots = connected_components(link_forest(distinct.select("fingerprint")), work)
    tied = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
    tied = tied.select("fingerprint", "times", F.coalesce("root", "fingerprint").alias("root"), distinct["least"])
    least = tied.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("n"))
    return met_by_key(tied.select("fingerprint", "times", "root"), least, ["root"], "n").select("fingerprint", "times", F.col("component").alias("least"))


def near_duplicates(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs; fingerprint as a signed number."""
    rows = work.table(fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), ["id"]), "rows")
    groups = work.table(components(rows, work), "groups")
    work.keep_only("rows", "groups")
    return met_by_key(rows, groups, ["fingerprint"], "times").select(F.col("id").alias("doc_id"), "fingerprint", F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs less near-duplicates: of each component one row of the least id stays.

    docs is read twice.
    """
    row = unused("row", docs)
    keyed = numbered(docs, work, row)
    key = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).cast("long").alias("id"), F.col(row).alias("row")).alias("id")
    prints = fingerprints(keyed.select(key, F.col(text_col).alias("text")), ["id"])
    rows = work.table(prints, "rows")
    kept = work.table(components(rows, work).select(F.col("least.row").alias(row)).distinct(), "kept")
    work.keep_only("kept", "numbered")
    return joined(keyed, kept, row, "left_semi").drop(row)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark, "simhash"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
