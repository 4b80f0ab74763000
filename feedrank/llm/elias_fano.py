"""Elias-Fano coding of non-decreasing integer sequences, with select.

The n values of a sequence up to u keep ``l = floor(log2(u / n))`` low bits each
in a packed array; the high parts are written in unary into a bit vector with
one 1 per value. That takes about 2 + log2(u / n) bits a value. Every 64th 1 has
its position sampled (32 bits), so the k-th value is found by scanning a few
words from a sample: no table of full-width offsets exists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 64


def _pack(values: np.ndarray, width: int) -> bytes:
    if width == 0 or len(values) == 0:
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpack(raw: bytes, width: int, index: np.ndarray) -> np.ndarray:
    out = np.zeros(len(index), dtype=np.uint64)
    data = np.frombuffer(raw, dtype=np.uint8)
    for b in range(width):
        at = index * width + b
        bit = (data[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        out |= bit.astype(np.uint64) << np.uint64(b)
    return out


@dataclass
class EliasFano:
    n: int
    width: int          # low bits a value
    low: bytes
    high: bytes         # unary bit vector, padded to whole 64-bit words
    samples: bytes      # position of ones 0, 64, 128, ... as uint32

    @classmethod
    def encode(cls, values) -> "EliasFano":
        """Values: non-decreasing, not negative, below 2**64."""
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        width = max(0, (int(v[-1]) // n).bit_length() - 1)
        ones = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 64 + 1) * 64, dtype=np.uint8)
        bits[ones] = 1
        low = v & np.uint64((1 << width) - 1)
        return cls(n, width, _pack(low, width), np.packbits(bits, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype("<u4").tobytes())

    def select(self, k) -> np.ndarray:
        """Positions of the k-th ones (k an array of indices, 0 first)."""
        k = np.asarray(k, dtype=np.int64)
        words = np.frombuffer(self.high, dtype="<u8")
        start = np.frombuffer(self.samples, dtype="<u4").astype(np.int64)[k // SAMPLE]
        word = start >> 6
        # ones still to pass in the sampled word, counted from its first bit
        before = words[word] & ((np.uint64(1) << (start & 63).astype(np.uint64)) - np.uint64(1))
        left = k % SAMPLE + np.bitwise_count(before).astype(np.int64)
        while True:
            count = np.bitwise_count(words[word]).astype(np.int64)
            on = left >= count
            if not on.any():
                break
            left = np.where(on, left - count, left)
            word = np.where(on, word + 1, word)
        out = np.empty(len(k), dtype=np.int64)
        for s in range(0, len(k), 4096):           # bounded scratch: 64 bytes a value
            w = words[word[s:s + 4096]]
            bits = np.unpackbits(w.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            rank = np.cumsum(bits, axis=1, dtype=np.int16)
            hit = (rank == (left[s:s + 4096] + 1)[:, None]).argmax(axis=1)
            out[s:s + 4096] = (word[s:s + 4096] << 6) + hit
        return out

    def get(self, k) -> np.ndarray:
        """The k-th values as uint64."""
        k = np.asarray(k, dtype=np.int64)
        if len(k) == 0:
            return np.zeros(0, dtype=np.uint64)
        high = (self.select(k) - k).astype(np.uint64)
        return high << np.uint64(self.width) | _unpack(self.low, self.width, k)

    def all(self) -> np.ndarray:
        return self.get(np.arange(self.n))
