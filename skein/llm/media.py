"""Media columns: FLAC streams of texts' bytes, and PCM blocks read back from them.

Defined results: a null or empty text is one block of padding; repeated rows
and null ids are coded each; equal texts have equal streams. Other columns of
the input are ignored. A damaged stream raises.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import flac
from skein.llm.batches import text_pieces
from skein.llm.workspace import Workspace

PAD = b"\xff"
#: Bytes of texts or streams that are coded together.
TOGETHER = 4 << 20

BLOCKS = "doc_id long, first_sample long, n_samples int, pcm binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def payload(text: bytes) -> bytes:
    """The text and as many bytes 255 as make a positive multiple of a block."""
    size = max(1, -(-len(text) // flac.BLOCK)) * flac.BLOCK
    return text.ljust(size, PAD)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, limit=TOGETHER):
        raw = data.tobytes()
        streams = flac.encode([payload(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
        yield pa.record_batch([rows.column(0), pa.array(np.diff(offsets)), pa.array(streams, pa.binary())], names=["doc_id", "n_bytes", "media"])


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): a FLAC stream of each text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode, "doc_id long, n_bytes long, media binary")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[tuple[np.ndarray, np.ndarray]]]]:
    for batch in batches:
        media = batch.column(batch.schema.get_field_index("media"))
        sizes = np.fromiter((len(x.as_buffer()) for x in media), np.int64, len(media))
        groups = np.cumsum(sizes) // TOGETHER
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(media)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                streams = media.slice(a, b - a).to_pylist()
                yield batch.slice(a, b - a), streams, flac.decode(streams)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, _, decoded in _decoded(batches):
        counts = [len(first) for first, _ in decoded]
        pcm = np.concatenate([blocks for _, blocks in decoded])
        offsets = np.arange(len(pcm) + 1, dtype=np.int32) * flac.BLOCK
        cells = pa.BinaryArray.from_buffers(pa.binary(), len(pcm), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(pcm))])
        ids = rows.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        first = pa.array(np.concatenate([first for first, _ in decoded]))
        yield pa.record_batch([ids, first, pa.array(np.full(len(pcm), flac.BLOCK, np.int32)), cells], names=["doc_id", "first_sample", "n_samples", "pcm"])


def pcm_blocks(media: DataFrame) -> DataFrame:
    """(doc_id, first_sample, n_samples, pcm): a row for each block of signed 8-bit samples."""
    return media.select("doc_id", "media").mapInArrow(_blocks, BLOCKS)


def _feature(samples: np.ndarray) -> str:
    """Blocks, peak, sum, energy and sign changes of a stream."""
    flat = samples.reshape(-1)
    wide = flat.astype(np.int32)
    negative = flat < 0
    changes = int(np.count_nonzero(negative[1:] != negative[:-1]))
    return f"{len(samples)}:{int(np.abs(wide).max())}:{int(wide.sum())}:{int(np.einsum('i,i->', wide, wide, dtype=np.int64))}:{changes}"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, streams, decoded in _decoded(batches):
        back = [(samples.view(np.uint8) ^ 0x80).tobytes() for _, samples in decoded]
        yield pa.record_batch(
            [
                rows.column(0),
                rows.column(1),
                pa.array([len(x) for x in back], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                pa.array([zlib.crc32(x[-32:]) for x in back], pa.int64()),
                pa.array([len(x) for x in streams], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in streams]),
                pa.array([_feature(samples) for _, samples in decoded]),
            ],
            names=[x.split()[0] for x in FEATURES.split(", ")],
        )


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of streams, from the samples that are read back."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, FEATURES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media of ``documents``, written as a table and read back from it."""
    media = encode_media(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return media_features(Workspace(spark, "media").table(media, "media", compression="zstd"))
