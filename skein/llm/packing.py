"""Best-fit packing of token pieces into fixed-length sequences, with local search.

Documents are encoded, an end id is added, and those longer than a sequence
are cut into full pieces after a first one that may be shorter. Full pieces
are sequences by themselves. The others are dealt out evenly over groups of
bounded size and packed group by group: best fit, longest first, then local
search between underfull bins. A step moves one piece, exchanges one for one,
or two for one either way, and is taken if it raises the sum of squared fills; the
emptiest bins run dry. Only (document, piece, length) rows are shuffled.

Defined results: null or empty text is the end id alone; repeated rows and
null ids are packed each. Other columns of the input are ignored. No rows give
no sequences. sequence_id is unique over all groups.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.batches import text_pieces
from skein.llm.pretokens import encoder

SEQUENCE = 1024
END_ID = 2
#: Pieces that are packed together; more are packed in several rounds of the same task.
GROUP = 200_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"
_PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _cut(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            ids, at = encoder(path).encode(data, offsets)
            ids = np.insert(ids, at[1:], end_id).astype("<u4")
            at = at + np.arange(len(at))
            lengths = np.diff(at)
            pieces = (lengths + size - 1) // size
            doc = np.repeat(np.arange(len(lengths)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            short = lengths - (pieces - 1) * size  # of the first piece
            start = np.where(piece == 0, 0, short[doc] + (piece - 1) * size)
            length = np.where(piece == 0, short[doc], size)
            begin = at[doc] + start
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.record_batch([rows.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], schema=_PIECE_SCHEMA)

    return run


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of places in lengths: longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    open_gaps = 0  # bit g: some bin has gap g
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        if found := open_gaps >> n:
            gap = n + (found & -found).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
        else:
            gap, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        by_gap[gap - n].append(b)
        open_gaps |= 1 << (gap - n)
    return bins


class Emptiest:
    """Of each length the least full bin that has it to give, and the longest of a range whose bin is below a bound.

    A tree of minima over lengths holds, for each, the fill of that bin less the length; bins of one length lie in
    a heap, where entries of bins that changed since stay until they come to the top.
    """

    NONE = 1 << 30

    def __init__(self, size: int, version: list[int]):
        self.half = 1 << size.bit_length()
        self.tree = [self.NONE] * (2 * self.half)
        self.heaps: dict[int, list[tuple[int, int, int, tuple[int, ...]]]] = defaultdict(list)
        self.version = version

    def build(self) -> None:
        for n, heap in self.heaps.items():
            heapify(heap)
            self.tree[self.half + n] = heap[0][0] - n
        for node in range(self.half - 1, 0, -1):
            self.tree[node] = min(self.tree[2 * node], self.tree[2 * node + 1])

    def put(self, n: int, value: int) -> None:
        node, tree = self.half + n, self.tree
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    def top(self, n: int) -> tuple[int, int, int, tuple[int, ...]] | None:
        heap = self.heaps[n]
        while heap and heap[0][1] != self.version[heap[0][2]]:
            heappop(heap)
        return heap[0] if heap else None

    def refresh(self, n: int) -> None:
        top = self.top(n)
        self.put(n, top[0] - n if top else self.NONE)

    def without(self, n: int, b: int) -> None:
        """Let the tree forget that bin b has length n, until ``refresh``."""
        top = self.top(n)
        if top and top[2] == b:
            heappop(self.heaps[n])
            self.refresh(n)
            heappush(self.heaps[n], top)

    def longest(self, low: int, high: int, bound: int) -> int:
        """The greatest length in (low, high] whose value is below the bound, 0 if there is none."""
        tree, left, right, after = self.tree, low + 1 + self.half, high + 1 + self.half, []
        while left < right:
            if left & 1:
                after.append(left)
                left += 1
            if right & 1:
                right -= 1
                if tree[right] < bound:
                    return self._descend(right, bound)
            left >>= 1
            right >>= 1
        for node in reversed(after):
            if tree[node] < bound:
                return self._descend(node, bound)
        return 0

    def _descend(self, node: int, bound: int) -> int:
        tree, half = self.tree, self.half
        while node < half:
            node = 2 * node + (tree[2 * node + 1] < bound)
        return node - half


class LocalSearch:
    """Moves and exchanges between underfull bins that raise the sum of squared fills: one for one, two given for one, one for two, or none for one.

    A bin whose fill grows by ``gain`` and another's that shrinks by as much raise the sum exactly if the first ends fuller than the
    other was: so only the least full bin that has a length to give needs to be looked at, and a bin finds the
    best of its steps in a logarithm of the size for each of its own choices. A bin that found none is not looked at again
    before a length within its reach can be had from an emptier bin than before.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], size: int):
        self.lengths, self.bins, self.size = lengths, bins, size
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.version = [0] * len(bins)
        self.ones, self.twos = Emptiest(size, self.version), Emptiest(size, self.version)
        self.changed = self.before = 0  # bits of lengths that can be had from an emptier bin, since the pass began and in the last one
        self.reach: dict[int, int] = {}
        for b in range(len(bins)):
            if 0 < self.fill[b] < size:
                for of, sets in self._offers(b):
                    for n, taken in sets.items():
                        of.heaps[n].append((self.fill[b], 0, b, taken))
        self.ones.build()
        self.twos.build()

    def _offers(self, b: int) -> tuple[tuple[Emptiest, dict[int, tuple[int, ...]]], ...]:
        """What bin b has to give: a piece, or two pieces, by length."""
        own, lengths = self.bins[b], self.lengths
        ones = {lengths[i]: (i,) for i in own}
        pairs: dict[int, list[int]] = defaultdict(list)
        for i in own:  # two of a length are enough for any pair
            if len(pairs[lengths[i]]) < 2:
                pairs[lengths[i]].append(i)
        few = [i for same in pairs.values() for i in same]
        twos = {lengths[i] + lengths[j]: (i, j) for k, i in enumerate(few) for j in few[k + 1 :]}
        return (self.ones, ones), (self.twos, twos)

    def _list(self, b: int) -> None:
        for of, sets in self._offers(b):
            for n, taken in sets.items():
                heappush(of.heaps[n], (self.fill[b], self.version[b], b, taken))
                if self.fill[b] - n < of.tree[of.half + n]:
                    of.put(n, self.fill[b] - n)
                    self.changed |= 1 << n

    def _unlist(self, b: int) -> None:
        self.version[b] += 1
        for of, sets in self._offers(b):
            for n in sets:
                of.refresh(n)

    def _step(self, b: int, offers: tuple) -> tuple[int, tuple[int, ...], Emptiest, int] | None:
        """(gain, given, where, length) of the step that fills bin b most, as far as that is known without its own offers."""
        size, fill = self.size, self.fill[b]
        gap = size - fill
        best, most, reach = None, 0, 0
        (_, ones), (_, twos) = offers
        for given, over, wheres in (((), 0, (self.ones,)), *((g, n, (self.ones, self.twos)) for n, g in ones.items()), *((g, n, (self.ones,)) for n, g in twos.items())):
            high = min(over + gap, size - 1)
            reach |= (1 << (high + 1)) - (1 << (over + 1))
            for of in wheres:
                n = of.longest(over + most, high, fill - over)
                if n:
                    best, most = (n - over, given, of, n), n - over
            if most == gap:
                break
        self.reach[b] = reach
        return best

    def improve(self, b: int) -> bool:
        """Fill bin b as far as one step can; whether there was a step."""
        if not 0 < self.fill[b] < self.size:
            return False
        reach = self.reach.get(b)
        if reach is not None and not reach & (self.changed | self.before):
            return False
        offers = self._offers(b)
        for of, sets in offers:
            for n in sets:
                of.without(n, b)
        best = self._step(b, offers)
        entry = None
        if best:
            _, _, of, n = best
            heap, hidden = of.heaps[n], None
            if of.top(n)[2] == b:
                hidden = heappop(heap)
            entry = of.top(n)
            if hidden:
                heappush(heap, hidden)
        for of, sets in offers:
            for n in sets:
                of.refresh(n)
        if entry is None:
            return False
        gain, given, _, _ = best
        _, _, other, taken = entry
        self._unlist(b)
        self._unlist(other)
        self.bins[other] = [x for x in self.bins[other] if x not in taken] + list(given)
        self.bins[b] = [x for x in self.bins[b] if x not in given] + list(taken)
        self.fill[b] += gain
        self.fill[other] -= gain
        for x in (b, other):
            self.reach.pop(x, None)
            if 0 < self.fill[x] < self.size:
                self._list(x)
        return True

    def run(self) -> list[list[int]]:
        """Until a pass over the underfull bins finds no step; each step raises the sum of squared fills, so the search ends."""
        while True:
            under = sorted((b for b in range(len(self.bins)) if 0 < self.fill[b] < self.size), key=lambda b: -self.fill[b])
            self.before, self.changed = self.changed, 0
            steps = 0
            for b in under:  # each is filled as far as it goes before the next
                while self.improve(b):
                    steps += 1
            if not steps:
                return [b for b in self.bins if b]


def pack(lengths: list[int], size: int = SEQUENCE) -> list[list[int]]:
    """Bins of places in lengths, each with a sum of at most size."""
    return LocalSearch(lengths, best_fit(lengths, size), size).run()


def _packed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 36
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= GROUP:
                table = pa.Table.from_batches(held)
                yield from _pack_group(table, at, size)
                at, held, n = at + n, [], 0
        if n:
            yield from _pack_group(pa.Table.from_batches(held), at, size)

    return run


def _pack_group(table: pa.Table, first: int, size: int) -> Iterator[pa.RecordBatch]:
    lengths = table.column("length").to_numpy()
    part = np.flatnonzero(lengths < size)
    bins = pack(lengths[part].tolist(), size)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    place = part[np.fromiter((i for b in bins for i in b), np.int64, len(part))]
    sizes = np.fromiter(map(len, bins), np.int64, len(bins))
    sequence[place] = np.repeat(np.arange(len(bins)), sizes)
    before = np.cumsum(lengths[place]) - lengths[place]
    starts = before[np.cumsum(sizes) - sizes] if len(bins) else before
    offset[place] = before - np.repeat(starts, sizes)
    full = np.flatnonzero(lengths == size)
    sequence[full] = len(bins) + np.arange(len(full))
    out = table.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
    yield from out.combine_chunks().to_batches(max_chunksize=20_000)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = rows.mapInArrow(_cut(tokenizer_path, size, end_id), _PIECES)
    mixed = pieces.repartition(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.monotonically_increasing_id())
    return mixed.mapInArrow(_packed(size), _PACKED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
