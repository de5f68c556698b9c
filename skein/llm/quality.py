"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes, two at a step, pass through learned filters six bytes wide.
The largest response of each filter in each chunk of 256 bytes (a new chunk
begins every 128) describes the chunk; the mean and the maximum over all
chunks, which cover the whole text, are combined into one probability that the
text is good. Nothing but the text is an input.

The network is fitted here, on a bounded sample of labelled rows (``PER_CLASS``
of each class: of the first ``CANDIDATES`` times as many in the order of a hash of
the id, the first that have a text of up to ``LONGEST`` bytes); held-out ids never are in it. Scoring reads every whole text, block by block.

Defined results: null counts as empty text; an empty text has one chunk of
padding and is scored like any other. Labels that are null, or that
disagree for one id, are not learned from. Without labels of both classes
every score is 0.5. Repeated rows and null ids are scored each. Other columns
of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.batches import text_pieces

FILTERS, WIDTH = 8, 6
#: Bytes of half a chunk.
BLOCK = 128
#: Labelled rows of each class that are learned from, and the longest text (bytes) among them.
PER_CLASS, LONGEST = 300, 16_000
#: Labelled rows that are asked for, for each that is learned from: some have longer texts, or none.
CANDIDATES = 4
EPOCHS, RATE, DECAY, SEED = 30, 0.02, 1e-4, 7


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts on block boundaries with at least four bytes of zeros after each; the first block of each."""
    sizes = np.diff(offsets)
    blocks = (sizes + 4 + BLOCK - 1) // BLOCK
    first = np.cumsum(blocks) - blocks
    out = np.zeros((int(blocks.sum()) + 1) * BLOCK, np.uint8)
    for to, a, b in zip((first * BLOCK).tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        out[to : to + b - a] = data[a:b]
    return out, first


@dataclass
class Network:
    bytes_: np.ndarray  # (WIDTH, 256, FILTERS): the response of each filter to each byte at each place
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS + 1,): of the means, the maxima and the constant

    @classmethod
    def new(cls) -> Network:
        rng = np.random.default_rng(SEED)
        return cls(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, 2 * FILTERS + 1).astype(np.float32))

    def pair_tables(self) -> list[np.ndarray]:
        """Responses to pairs of bytes, as little-endian numbers."""
        return [(self.bytes_[2 * k + 1][:, None, :] + self.bytes_[2 * k][None, :, :]).reshape(1 << 16, FILTERS) for k in range(WIDTH // 2)]

    def responses(self, text: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """(blocks, BLOCK / 2, FILTERS) responses before the bias; the last block of text is a margin."""
        pairs = text.view("<u2")
        n = len(pairs) - BLOCK // 2
        out = tables[0].take(pairs[:n], axis=0)
        for k in range(1, len(tables)):
            out += tables[k].take(pairs[k : n + k], axis=0)
        return out.reshape(-1, BLOCK // 2, FILTERS)

    def pooled(self, tops: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of texts from the block maxima, and for each chunk and filter the block that had the maximum."""
        n = len(tops)
        last = np.append(first[1:], n) - 1
        follows = np.ones(n, bool)
        follows[last] = False
        source = np.repeat(np.arange(n)[:, None], FILTERS, 1)
        at = np.flatnonzero(follows)
        source[at] += tops[at + 1] > tops[at]
        # the last block of a longer text is in the chunk before it
        alone = np.append(first[1:], n) - first == 1
        chunk = follows.copy()
        chunk[last[alone]] = True
        return source, chunk

    def forward(self, text: np.ndarray, first: np.ndarray, tables: list[np.ndarray], training: bool = False) -> dict:
        responses = self.responses(text, tables)
        # the last two places of a text hold nothing but its padding, and reach into the text that follows
        responses[np.append(first[1:], len(responses)) - 1, -(WIDTH // 2 - 1) :] = -np.inf
        where = responses.argmax(1) if training else None
        tops = responses.max(1)
        acts = np.maximum(tops + self.bias, 0)
        source, chunk = self.pooled(acts, first)
        rows = np.flatnonzero(chunk)
        values = np.take_along_axis(acts, source[rows], 0)
        doc = np.searchsorted(first, rows, "right") - 1
        begin = np.searchsorted(doc, np.arange(len(first)))
        counts = np.diff(np.append(begin, len(rows)))
        mean = np.add.reduceat(values, begin, 0) / counts[:, None]
        most = np.maximum.reduceat(values, begin, 0)
        features = np.concatenate([mean, most, np.ones((len(first), 1), np.float32)], 1)
        score = 1 / (1 + np.exp(-np.clip(features @ self.out, -30, 30)))
        return {"score": score, "features": features, "values": values, "most": most, "doc": doc, "counts": counts, "blocks": source[rows], "acts": acts, "where": where}

    def score(self, data: np.ndarray, offsets: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        text, first = padded(data, offsets)
        return self.forward(text, first, tables)["score"]

    def gradients(self, text: np.ndarray, first: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        f = self.forward(text, first, self.pair_tables(), training=True)
        error = ((f["score"] - wanted) * weight).astype(np.float32)
        d_out = error @ f["features"]
        d_mean = error[:, None] * self.out[:FILTERS] / f["counts"][:, None]
        d_most = error[:, None] * self.out[FILTERS : 2 * FILTERS]
        top = f["values"] == f["most"][f["doc"]]
        ties = np.add.reduceat(top, np.searchsorted(f["doc"], np.arange(len(first))), 0)
        d_values = d_mean[f["doc"]] + d_most[f["doc"]] * top / ties[f["doc"]]
        block, column = f["blocks"], np.broadcast_to(np.arange(FILTERS), f["blocks"].shape)
        d_values = np.where(f["acts"][block, column] > 0, d_values, 0)
        d_bias = d_values.sum(0)
        at = block * BLOCK + 2 * f["where"][block, column]
        d_bytes = np.stack([np.bincount((text[at + k].astype(np.int64) * FILTERS + column).reshape(-1), d_values.reshape(-1), 256 * FILTERS).reshape(256, FILTERS) for k in range(WIDTH)])
        return [d_bytes, d_bias, d_out]


def fit(texts: list[bytes], wanted: list[int]) -> Network:
    """A network trained by Adam on texts and their labels, the classes weighted alike."""
    net, rng = Network.new(), np.random.default_rng(SEED)
    wanted = np.array(wanted)
    share = np.bincount(wanted, minlength=2) / len(wanted)
    params = [net.bytes_, net.bias, net.out]
    first_moment, second_moment = [np.zeros(p.shape) for p in params], [np.zeros(p.shape) for p in params]
    step, batch = 0, 64
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            sizes = [len(texts[i]) for i in some]
            text, first = padded(np.frombuffer(b"".join(texts[i] for i in some), np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            weight = 0.5 / share[wanted[some]] / len(some)
            step += 1
            for p, m, v, g in zip(params, first_moment, second_moment, net.gradients(text, first, wanted[some], weight), strict=True):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """Ids that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network | None:
    """Fit on at most per_class labelled rows of each class; None without rows of both."""
    spark = docs.sparkSession
    agreed = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("q"), F.max("quality").alias("most"))
        .where("q = most")
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    asked = {q: [r["doc_id"] for r in agreed.where(F.col("q") == q).orderBy(*order).limit(per_class * CANDIDATES).collect()] for q in (0, 1)}
    if not all(asked.values()):
        return None
    some = F.broadcast(spark.createDataFrame([(i,) for ids in asked.values() for i in ids], "doc_id long"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= LONGEST).join(some, "doc_id")
    texts = {r["doc_id"]: r["text"].encode() for r in rows.groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    wanted = {i: q for q, ids in asked.items() for i in [i for i in ids if i in texts][:per_class]}
    if len(set(wanted.values())) < 2:
        return None
    return fit([texts[i] for i in sorted(wanted)], [wanted[i] for i in sorted(wanted)])


def score_quality(docs: DataFrame, network: Network | None, keep: list[str], text_col: str = "text", out: str = "score") -> DataFrame:
    """The kept columns of docs and the score, for each row; a kept column of the score's name gives way to it."""
    keep = [c for c in keep if c != out]
    if network is None:
        return docs.select(*keep, F.lit(0.5).alias(out))
    schema = docs.select(*keep, F.lit(0.5).alias(out)).schema
    names, column = [*keep, out], text_col if text_col in keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.pair_tables()
        for rows, data, offsets in text_pieces(batches, column):
            scores = np.concatenate(
                [network.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], tables) for a, b in _runs(offsets)]
            )
            yield pa.record_batch([*rows.columns[: len(keep)], pa.array(scores.astype(np.float64))], names=names)

    sent = keep if text_col in keep else [*keep, F.col(text_col).alias(column)]
    return docs.select(*sent).mapInArrow(run, schema)


def _runs(offsets: np.ndarray, limit: int = 256 << 10) -> Iterator[tuple[int, int]]:
    """Texts in runs of about limit bytes, whose responses stay in the cache."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_quality(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
