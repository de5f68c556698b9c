"""FLAC streams of 8-bit mono samples, coded and decoded many frames side by side.

A stream is cut into frames of 4,608 samples as far as they go, then of 2,304, 1,152
and 576. A frame's subframe is constant, verbatim, a fixed predictor of order 0 to 2
or a linear predictor of order 12 with Rice-coded residuals in partitions of 144
samples, whichever is shortest. Every frame has a seek point (first sample,
byte offset, samples), so that it can be read alone.
The decoder reads constant, verbatim, fixed (0 to 4) and linear (1 to 32)
subframes with any partition order and Rice parameter, including escapes, and
checks the CRC-8 of each header, the CRC-16 of each frame and the MD5 of the
samples.
"""

from __future__ import annotations

import hashlib
import struct
from functools import cache, lru_cache

import numpy as np

#: Samples that every stream is a multiple of, and those of a frame, by the code that its header has for them.
BLOCK = 576
SIZES = {5: 4608, 4: 2304, 3: 1152, 2: 576}
#: Blocks that are coded side by side; that bounds memory whatever a text's length.
BLOCKS = 8192
ORDER, PRECISION = 12, 7
#: Samples of a Rice partition.
PARTITION = 144
RATE = 8000
#: Coefficients of the fixed predictors by order.
FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


@cache
def _crc_table(bits: int, polynomial: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    out = []
    for value in range(256):
        value <<= bits - 8
        for _ in range(8):
            value = (value << 1 ^ polynomial) & mask if value & top else value << 1 & mask
        out.append(value)
    return np.array(out, np.uint16)


def crc8(data: bytes) -> int:
    table, crc = _crc_table(8, 0x07), 0
    for b in data:
        crc = int(table[crc ^ b])
    return crc


def crc16(frames: list[bytes]) -> np.ndarray:
    """CRC-16 of each frame. Bytes of zero before a frame leave the sum as it is."""
    if not frames:
        return np.zeros(0, np.uint16)
    table = _crc_table(16, 0x8005)
    longest = max(map(len, frames))
    lanes = np.frombuffer(b"".join(f.rjust(longest, b"\0") for f in frames), np.uint8).reshape(-1, longest).T.copy()
    crc = np.zeros(len(frames), np.uint16)
    for row in lanes:
        crc = (crc << np.uint16(8)) ^ table[(crc >> np.uint16(8)) ^ row]
    return crc


@lru_cache(65536)
def frame_header(number: int, code: int) -> bytes:
    """Header of the frame with first sample ``number``: its size by code, mono, 8 bits, rate from the stream."""
    if number < 0x80:
        coded = bytes([number])
    else:  # as UTF-8, up to 36 bits
        n = next(n for n in range(2, 8) if number < 1 << (5 * n + 1))
        tail = [0x80 | number >> 6 * i & 0x3F for i in range(n - 2, -1, -1)]
        coded = bytes([(0xFF << (8 - n) & 0xFF) | number >> 6 * (n - 1), *tail])
    head = bytes([0xFF, 0xF9, code << 4, 0x02]) + coded
    return head + bytes([crc8(head)])


def _header_length(frame: bytes) -> int:
    """Length of a frame's header, whose checksum must be right."""
    if len(frame) < 8 or frame[:2] not in (b"\xff\xf8", b"\xff\xf9"):
        raise ValueError("no frame at a seek point")
    lead = frame[4]
    n = 5 + (1 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length())
    _check_header(frame[:n])
    return n


@lru_cache(65536)
def _check_header(head: bytes) -> None:
    if head[2] >> 4 not in SIZES or head[2] & 15 or head[3] != 2:
        raise ValueError("only mono frames of 576, 1152, 2304 or 4608 8-bit samples are read")
    if crc8(head[:-1]) != head[-1]:
        raise ValueError("checksum of a frame header is wrong")


# --- coding


def _zigzag(r: np.ndarray) -> np.ndarray:
    return (r << 1) ^ (r >> 31)


def _fixed_residuals(x: np.ndarray, order: int) -> np.ndarray:
    for _ in range(order):
        x = x[:, 1:] - x[:, :-1]
    return x


def _linear(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients (frames, ORDER) and shifts of linear predictors, by Levinson's recursion."""
    f = x.astype(np.float32)
    auto = np.stack([np.einsum("ij,ij->i", f[:, k:], f[:, : x.shape[1] - k]) for k in range(ORDER + 1)], 1).astype(np.float64)
    auto[:, 0] = auto[:, 0] * (1 + 1e-9) + 1e-9
    error, a = auto[:, 0].copy(), np.zeros((len(x), ORDER))
    for i in range(ORDER):
        reflection = (auto[:, i + 1] - (a[:, :i] * auto[:, i:0:-1]).sum(1)) / error
        a[:, :i], a[:, i] = a[:, :i] - reflection[:, None] * a[:, :i][:, ::-1], reflection
        error *= 1 - reflection**2
        error = np.maximum(error, 1e-9)
    exponent = np.frexp(np.abs(a).max(1))[1]
    shift = np.clip(PRECISION - 1 - exponent, 0, 15)
    limit = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(a * (1 << shift)[:, None]), -limit, limit).astype(np.int32), shift.astype(np.int32)


def _linear_residuals(x: np.ndarray, c: np.ndarray, shift: np.ndarray) -> np.ndarray:
    size = x.shape[1]
    total = np.zeros((len(x), size - ORDER), np.int32)
    for j in range(ORDER):
        total += c[:, j : j + 1] * x[:, ORDER - 1 - j : size - 1 - j]
    return x[:, ORDER:] - (total >> shift[:, None])


def _partitions(u: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Rice parameters (frames, partitions), the best of three by the mean, and the bits of all residuals."""
    n, parts = len(u), (u.shape[1] + order) // PARTITION
    full = np.zeros((n, parts * PARTITION), np.int32)
    full[:, order:] = u
    cut = full.reshape(n, parts, PARTITION)
    sizes = np.full(parts, PARTITION)
    sizes[0] -= order
    least = np.clip(np.floor(np.log2(np.maximum(cut.sum(2, dtype=np.int64) / sizes * 0.7, 1))), 0, 12).astype(np.int32)
    best, bits = least, None
    for more in range(3):
        k = least + more
        need = (cut >> k[:, :, None]).sum(2, dtype=np.int64) + (k + 1) * sizes
        best, bits = (k, need) if bits is None else (np.where(need < bits, k, best), np.minimum(need, bits))
    return best, bits.sum(1) + 4 * parts


class _Bits:
    """Rows of bit fields, written side by side: every field has a value and a width, its leading zeros included."""

    def __init__(self, n: int):
        self.n, self.values, self.widths = n, [], []

    def add(self, values, width) -> None:
        """A (n, m) block of fields, or one field for each row."""
        values = np.broadcast_to(np.asarray(values), (self.n,)) if np.ndim(values) == 0 else np.asarray(values)
        values = values.reshape(self.n, -1).astype(np.int64)
        self.values.append(values)
        self.widths.append(np.broadcast_to(np.asarray(width, np.int64).reshape(-1, 1) if np.ndim(width) == 1 else width, values.shape))

    def rows(self) -> list[bytes]:
        values, widths = np.concatenate(self.values, 1), np.concatenate(self.widths, 1)
        ends = np.cumsum(widths, 1)
        sizes = (ends[:, -1] + 7) // 8
        words = (sizes + 3) // 4 + 1
        base = np.cumsum(words) - words
        ends += base[:, None] * 32
        at, shift = (ends - 1) >> 5, (-ends) & 31
        wide = values.astype(np.uint64) << shift.astype(np.uint64)
        total = int(words.sum())
        # fields are disjoint bits, so their sums are exact
        out = np.bincount(at.reshape(-1), (wide & np.uint64(0xFFFFFFFF)).astype(np.float64).reshape(-1), total)
        high = (wide >> np.uint64(32)).reshape(-1)
        over = np.flatnonzero(high)
        out[: total] += np.bincount(at.reshape(-1)[over] - 1, high[over].astype(np.float64), total)
        data = out.astype(np.uint32).astype(">u4").tobytes()
        return [data[4 * b : 4 * b + n] for b, n in zip(base.tolist(), sizes.tolist(), strict=True)]


def _rice_subframes(x, u, order, kind, c=None, shift=None) -> list[bytes]:
    k, _ = _partitions(u, order)
    out = _Bits(len(x))
    out.add(kind << 1, 8)
    if order:
        out.add(x[:, :order] & 0xFF, 8)
    if c is not None:
        out.add(PRECISION - 1, 4)
        out.add(shift & 31, 5)
        out.add(c & ((1 << PRECISION) - 1), PRECISION)
    parts = k.shape[1]
    out.add(parts.bit_length() - 1, 6)
    at = 0
    for p in range(parts):
        size = PARTITION - (order if p == 0 else 0)
        part, kp = u[:, at : at + size], k[:, p : p + 1]
        out.add(k[:, p], 4)
        out.add((1 << kp) | (part & ((1 << kp) - 1)), (part >> kp) + 1 + kp)
        at += size
    return out.rows()


def encode_blocks(samples: np.ndarray) -> list[bytes]:
    """Subframes of frames (frames, samples) of signed 8-bit samples."""
    x = samples.astype(np.int32)
    n = len(x)
    out: list[bytes] = [b""] * n
    constant = (x == x[:, :1]).all(1)
    for i in np.flatnonzero(constant):
        out[i] = bytes([0, x[i, 0] & 0xFF])
    left = np.flatnonzero(~constant)
    if not len(left):
        return out
    x = x[left]
    c, shift = _linear(x)
    coded = [(o, 8 + o, _zigzag(_fixed_residuals(x, o))) for o in range(3)] + [(ORDER, 32 + ORDER - 1, _zigzag(_linear_residuals(x, c, shift)))]
    head = [8 + 8 * o + 6 for o in range(3)] + [8 + 8 * ORDER + 9 + PRECISION * ORDER + 6]
    bits = np.stack([_partitions(u, o)[1] + h for (o, _, u), h in zip(coded, head, strict=True)] + [np.full(len(x), 8 + 8 * x.shape[1])])
    best = bits.argmin(0)
    for which, (order, kind, u) in enumerate(coded):
        rows = np.flatnonzero(best == which)
        if len(rows):
            linear = (c[rows], shift[rows]) if kind >= 32 else (None, None)
            for i, sub in zip(left[rows].tolist(), _rice_subframes(x[rows], u[rows], order, kind, *linear), strict=True):
                out[i] = sub
    for i in np.flatnonzero(best == len(coded)):
        out[left[i]] = b"\x02" + samples[left[i]].astype(np.int8).tobytes()
    return out


def _cut(blocks: int) -> list[tuple[int, int]]:
    """(first block, size code) of the frames of so many blocks."""
    out, at = [], 0
    for code, size in SIZES.items():
        while blocks - at >= size // BLOCK:
            out.append((at, code))
            at += size // BLOCK
    return out


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream of each payload; unsigned bytes, a positive multiple of 576 of them, become signed samples."""
    counts = [len(p) // BLOCK for p in payloads]
    if any(not n or len(p) != n * BLOCK for n, p in zip(counts, payloads, strict=True)):
        raise ValueError("a payload must be a positive multiple of 576 bytes")
    signed = (np.frombuffer(b"".join(payloads), np.uint8) ^ 0x80).view(np.int8)
    cuts = [_cut(n) for n in counts]
    base = np.cumsum([0, *counts])
    begins = np.array([b + at for b, cut in zip(base.tolist(), cuts, strict=False) for at, _ in cut], np.int64)
    codes = np.array([code for cut in cuts for _, code in cut], np.int64)
    numbers = [at * BLOCK for cut in cuts for at, _ in cut]
    frames: list[bytes] = [b""] * len(codes)
    for code, size in SIZES.items():
        rows = np.flatnonzero(codes == code)
        together = BLOCKS * BLOCK // size
        for a in range(0, len(rows), together):
            some = rows[a : a + together]
            samples = signed[begins[some][:, None] * BLOCK + np.arange(size)]
            bodies = [frame_header(numbers[i], code) + sub for i, sub in zip(some.tolist(), encode_blocks(samples), strict=True)]
            for i, body, crc in zip(some.tolist(), bodies, crc16(bodies), strict=True):
                frames[i] = body + int(crc).to_bytes(2, "big")
    out, at = [], 0
    for n, cut, first in zip(counts, cuts, base.tolist(), strict=False):
        own = frames[at : at + len(cut)]
        at += len(cut)
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        samples = np.array([SIZES[code] for _, code in cut])
        digest = hashlib.md5(signed[first * BLOCK : (first + n) * BLOCK].tobytes()).digest()
        packed = RATE << 44 | 0 << 41 | 7 << 36 | n * BLOCK
        info = struct.pack(">HH", BLOCK, max(SIZES.values())) + int(sizes.min()).to_bytes(3, "big") + int(sizes.max()).to_bytes(3, "big") + packed.to_bytes(8, "big") + digest
        points = np.zeros(len(own), np.dtype([("sample", ">u8"), ("offset", ">u8"), ("size", ">u2")]))
        points["sample"], points["offset"], points["size"] = np.cumsum(samples) - samples, np.cumsum(sizes) - sizes, samples
        table = points.tobytes()
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(own))
    return out


# --- decoding


def read_stream(stream: bytes) -> tuple[np.ndarray, list[bytes], bytes]:
    """(first sample of each frame, frames by seek point, MD5 of the samples)."""
    if stream[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, points, digest, total = 4, False, None, b"", 0
    while not last:
        kind, size = stream[at], int.from_bytes(stream[at + 1 : at + 4], "big")
        body, last = stream[at + 4 : at + 4 + size], kind >= 0x80
        if kind & 0x7F == 0:
            digest, total = body[18:34], int.from_bytes(body[10:18], "big") & ((1 << 36) - 1)
        elif kind & 0x7F == 3:
            points = np.frombuffer(body, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("size", ">u2")]))
        at += 4 + size
    if points is None or int(points["size"].sum(dtype=np.int64)) != total or total % BLOCK:
        raise ValueError("the stream has no seek point for each frame")
    cuts = [*(points["offset"].astype(np.int64) + at).tolist(), len(stream)]
    return points["sample"].astype(np.int64), [stream[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], digest


class _Reader:
    """Bits of many byte strings, read side by side."""

    def __init__(self, rows: list[bytes]):
        longest = max(map(len, rows)) + 16
        data = b"".join(r.ljust(longest, b"\0") for r in rows)
        flat = np.frombuffer(data + bytes(8), np.uint8)
        self.words = np.zeros(len(data), np.uint64)
        for k in range(8):
            self.words |= flat[k : k + len(data)].astype(np.uint64) << np.uint64(56 - 8 * k)
        self.at = np.arange(len(rows), dtype=np.int64) * longest * 8

    def _window(self) -> np.ndarray:
        """At least 57 bits from each place, at the top of a word."""
        return self.words[self.at >> 3] << (self.at & 7).astype(np.uint64)

    def bits(self, width) -> np.ndarray:
        """An unsigned field of each row; the width (0 to 32) may differ by row."""
        width = np.broadcast_to(np.asarray(width, np.int64), self.at.shape)
        out = (self._window() >> np.uint64(1) >> (63 - width).astype(np.uint64)).astype(np.int64)
        self.at = self.at + width
        return out

    def rice(self, k: np.ndarray) -> np.ndarray:
        """A Rice-coded unsigned number of each row."""
        window, quotient = self._window(), 0
        if not (window >> np.uint64(25)).all():  # a run of 39 zeros or more
            quotient = np.zeros(len(k), np.int64)
            while len(long := np.flatnonzero(self._window() >> np.uint64(32) == 0)):
                self.at = self.at.copy()
                self.at[long] += 32
                quotient[long] += 32
                if quotient.max() > 1 << 20:
                    raise ValueError("a Rice code does not end")
            window = self._window()
        # the top 39 bits are exact as floats; the exponent counts the zeros
        zeros = 39 - np.frexp((window >> np.uint64(25)).astype(np.float64))[1].astype(np.int64)
        low = (window << (zeros + 1).astype(np.uint64)) >> np.uint64(1) >> (63 - k).astype(np.uint64)
        self.at = self.at + zeros + 1 + k
        return (quotient + zeros) << k | low.astype(np.int64)


def _signed(values: np.ndarray, width) -> np.ndarray:
    return values - ((values >> (np.asarray(width) - 1) & 1) << np.asarray(width))


def _decode_predicted(rows: list[bytes], order: int, linear: bool, samples: int) -> np.ndarray:
    """Samples (rows, samples) of subframes of one kind."""
    n = len(rows)
    reader = _Reader(rows)
    reader.bits(8)
    out = np.zeros((samples, n), np.int64)
    for t in range(order):
        out[t] = _signed(reader.bits(8), 8)
    if linear:
        precision = reader.bits(4) + 1
        shift = _signed(reader.bits(5), 5)
        c = np.stack([_signed(reader.bits(precision), precision) for _ in range(order)])
    else:
        shift, c = np.zeros(n, np.int64), np.repeat(np.array(FIXED[order], np.int64)[:, None], n, 1)
    if (method := reader.bits(2)).max(initial=0) > 1:
        raise ValueError("unknown residual coding")
    wide = 4 + method
    partition_order = reader.bits(4)
    size = samples >> partition_order
    k = raw = np.zeros(n, np.int64)
    escaped = np.zeros(n, bool)
    begins = {t for p in set(partition_order.tolist()) for t in range(order, samples) if t % (samples >> p) == 0} | {order}
    for t in range(order, samples):
        if t in begins:
            new = (t % size == 0) | (t == order)
            found = reader.bits(np.where(new, wide, 0))
            k = np.where(new, found, k)
            escaped = np.where(new, k == (1 << wide) - 1, escaped)
            raw = np.where(new & escaped, reader.bits(np.where(new & escaped, 5, 0)), raw)
        if escaped.any():
            u = np.zeros(n, np.int64)
            before = reader.at
            u = reader.rice(np.where(escaped, 0, k))
            after = reader.at
            reader.at = before
            plain = _signed(reader.bits(np.where(escaped, raw, 0)), np.maximum(raw, 1))
            reader.at = np.where(escaped, reader.at, after)
            residual = np.where(escaped, plain, (u >> 1) ^ -(u & 1))
        else:
            u = reader.rice(k)
            residual = (u >> 1) ^ -(u & 1)
        if order:
            residual = residual + ((c * out[t - order : t][::-1]).sum(0) >> shift)
        out[t] = residual
    return out.T


def decode_frames(frames: list[bytes]) -> list[np.ndarray]:
    """The samples of each frame, once headers and checksums are found right."""
    if (crc16([f[:-2] for f in frames]) != np.array([int.from_bytes(f[-2:], "big") for f in frames], np.uint16)).any():
        raise ValueError("checksum of a frame is wrong")
    bodies = [f[_header_length(f) : -2] for f in frames]
    sizes = np.fromiter((SIZES[f[2] >> 4] for f in frames), np.int64, len(frames))
    kinds = np.fromiter((b[0] for b in bodies), np.int64, len(bodies))
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(frames)
    for size, kind in sorted(set(zip(sizes.tolist(), kinds.tolist(), strict=True))):
        rows = np.flatnonzero((sizes == size) & (kinds == kind)).tolist()
        some = [bodies[i] for i in rows]
        number = kind >> 1
        if kind & 0x81:
            raise ValueError("wasted bits are not read")
        if number == 0:
            found = np.repeat(np.frombuffer(b"".join(b[1:2] for b in some), np.int8)[:, None], size, 1)
        elif number == 1:
            found = np.frombuffer(b"".join(b[1 : 1 + size] for b in some), np.int8).reshape(-1, size)
        elif 8 <= number <= 12:
            found = _decode_predicted(some, number - 8, False, size).astype(np.int8)
        elif number >= 32:
            found = _decode_predicted(some, number - 31, True, size).astype(np.int8)
        else:
            raise ValueError("reserved subframe type")
        for i, samples in zip(rows, found, strict=True):
            out[i] = samples
    return out


def _sizes(frames: list[bytes]) -> list[int]:
    """Samples of frames, by their headers."""
    return [SIZES.get(f[2] >> 4, BLOCK) if len(f) > 2 else BLOCK for f in frames]


def decode(streams: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each stream its blocks' first samples, and its samples (blocks, 576)."""
    read = [read_stream(s) for s in streams]
    frames = [f for _, own, _ in read for f in own]
    parts: list[np.ndarray] = []
    ends = np.cumsum([n // BLOCK for _, own, _ in read for n in _sizes(own)])
    for group in np.split(np.arange(len(frames)), np.flatnonzero(np.diff(ends // BLOCKS)) + 1):
        parts += decode_frames([frames[i] for i in group.tolist()])
    out, at = [], 0
    for _, own, digest in read:
        samples = np.concatenate(parts[at : at + len(own)])
        if hashlib.md5(samples.tobytes()).digest() != digest:
            raise ValueError("digest of the samples is wrong")
        out.append((np.arange(len(samples) // BLOCK, dtype=np.int64) * BLOCK, samples.reshape(-1, BLOCK)))
        at += len(own)
    return out
