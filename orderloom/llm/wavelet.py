"""A wavelet matrix over token ids, and its file form.

File: magic, bits, number of ids and documents, per plane the number of zero
bits and the compressed length; then document ids with their null flags, ids
per document, per plane the zstandard frame of its bits and of the ones in
each block of ``BLOCK`` bits (the rank directory).  Integers are
little-endian.  Plane 0 holds the highest bit; each next plane is ordered by
the bits before it, zeros first.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard as zstd

MAGIC = b"WMT1"
BLOCK = 512
_HEAD = struct.Struct("<4sBQQ")
_PLANE = struct.Struct("<QQQ")


class WaveletMatrix:
    """Bit planes with rank and select."""

    def __init__(self, n: int, bits: int, planes: list[np.ndarray], blocks: list[np.ndarray], zeros: list[int],
                 doc_ids: np.ndarray, doc_nulls: np.ndarray, counts: np.ndarray):
        self.n, self.bits, self.planes, self.zeros = n, bits, planes, zeros
        self.blocks = blocks  # ones of each block
        self.doc_ids, self.doc_nulls, self.counts = doc_ids, doc_nulls, counts
        self._ranks: list[np.ndarray] | None = None

    @classmethod
    def of(cls, ids: np.ndarray, bits: int, doc_ids: np.ndarray, doc_nulls: np.ndarray,
           counts: np.ndarray) -> WaveletMatrix:
        a = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, blocks, zeros = [], [], []
        for level in range(bits):
            bit = (a >> a.dtype.type(bits - 1 - level) & a.dtype.type(1)).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)])
            planes.append(packed)
            blocks.append(np.bitwise_count(packed).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint16))
            low = a[~bit]
            zeros.append(len(low))
            a = np.concatenate([low, a[bit]])
        return cls(len(ids), bits, planes, blocks, zeros, np.asarray(doc_ids, "<i8"),
                   np.asarray(doc_nulls, np.uint8), np.asarray(counts, "<i8"))

    def to_bytes(self) -> bytes:
        coder = zstd.ZstdCompressor(level=1)
        frames = [(coder.compress(p.tobytes()), coder.compress(b.astype("<u2").tobytes()))
                  for p, b in zip(self.planes, self.blocks, strict=True)]
        head = [_HEAD.pack(MAGIC, self.bits, self.n, len(self.counts))]
        head += [_PLANE.pack(z, len(p), len(b)) for z, (p, b) in zip(self.zeros, frames, strict=True)]
        body = [self.doc_ids.tobytes(), self.doc_nulls.tobytes(), self.counts.tobytes()]
        return b"".join([*head, *body, *[x for f in frames for x in f]])

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        magic, bits, n, docs = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        at = _HEAD.size
        heads = []
        for _ in range(bits):
            heads.append(_PLANE.unpack_from(raw, at))
            at += _PLANE.size
        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            a = np.frombuffer(raw, dtype, count, at)
            at += a.nbytes
            return a
        ids, nulls, counts = take("<i8", docs), take("u1", docs), take("<i8", docs)
        coder = zstd.ZstdDecompressor()
        planes, blocks = [], []
        for _, p, b in heads:
            planes.append(np.frombuffer(coder.decompress(raw[at:at + p]), np.uint8))
            blocks.append(np.frombuffer(coder.decompress(raw[at + p:at + p + b]), "<u2"))
            at += p + b
        return cls(n, bits, planes, blocks, [z for z, _, _ in heads], ids, nulls, counts)

    def decode(self) -> np.ndarray:
        """All ids in order: the partition of each plane undone, last first."""
        dtype = np.uint16 if self.bits <= 16 else np.uint32
        a = np.zeros(self.n, dtype)
        for level in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            out = np.empty(self.n, dtype)
            z = self.zeros[level]
            out[~bit] = a[:z]
            out[bit] = a[z:] | dtype(1 << (self.bits - 1 - level))
            a = out
        return a

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if self._ranks is None:
            self._ranks = [np.concatenate([[0], np.cumsum(b, dtype=np.int64)]) for b in self.blocks]
        block, rest = divmod(i, BLOCK)
        ones = int(self._ranks[level][block])
        if rest:
            piece = self.planes[level][block * (BLOCK // 8):block * (BLOCK // 8) + -(-rest // 8)]
            ones += int(np.unpackbits(piece, count=rest, bitorder="little").sum())
        return ones

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit = self.planes[level][i >> 3] >> (i & 7) & 1
            ones = self._ones(level, i)
            value = value << 1 | int(bit)
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` occurs among the first ``i`` ids."""
        lo, hi = 0, i
        if symbol >> self.bits:
            return 0
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if symbol >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """The position of occurrence ``k`` (from 0) of ``symbol``."""
        if not 0 <= k < self.count(symbol):
            raise IndexError(k)
        lo, hi = 0, self.n  # the answer is the last position with rank <= k
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if self.rank(symbol, mid) <= k:
                lo = mid
            else:
                hi = mid
        return lo
