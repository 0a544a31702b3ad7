"""Counting quotient filters over invertibly permuted keys: compact counters that lose nothing.

A key of up to 128 bits is a left and a right half. A Feistel network permutes it, so that keys lie
evenly and each can be had back. The permuted key's first bits say which block of the key space it
lies in, the next ones are its quotient and all others its remainder. A filter holds one block: a bit
for each quotient that occurs, a bit at the end of each quotient's run, the remainders in full, and
the counters: a bit for each key that occurs more than once, then one byte for each of those, and
eight for those that need more. Filters are sorted, so those of several shards merge.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Odd multipliers that mix the halves.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
HEADER = np.dtype(
    [("entries", "<u4"), ("quotient", "u1"), ("left", "u1"), ("right", "u1"), ("many", "<u4"), ("large", "<u4")]
)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _shifted(values: np.ndarray, bits: int) -> np.ndarray:
    """Right shift that may be by all 64 bits."""
    return values >> np.uint64(bits) if bits < 64 else np.zeros_like(values)


def _mixed(values: np.ndarray, multiplier: int, bits: int) -> np.ndarray:
    x = (values + np.uint64(1)) * np.uint64(multiplier)
    x ^= x >> np.uint64(29)
    return _shifted(x * np.uint64(MULTIPLIERS[0]), 64 - bits)


@dataclass(frozen=True)
class KeySpace:
    """Keys of ``left`` + ``right`` bits, both at most 64, in ``2 ** block`` blocks."""

    left: int
    right: int
    block: int = 0

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, m in enumerate(MULTIPLIERS):
            if i % 2 == 0:
                left = left ^ _mixed(right, m, self.left)
            else:
                right = right ^ _mixed(left, m, self.right)
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, m in reversed(list(enumerate(MULTIPLIERS))):
            if i % 2 == 0:
                left = left ^ _mixed(right, m, self.left)
            else:
                right = right ^ _mixed(left, m, self.right)
        return left, right

    def distinct(self, left: np.ndarray, right: np.ndarray):
        """Sorted distinct keys, and for each key given the place of its equal among them."""
        if self.left + self.right <= 64:
            both = (left << np.uint64(self.right)) | right if self.right < 64 else right
            values, inverse = np.unique(both, return_inverse=True)
            return _shifted(values, self.right), values & _mask(self.right), inverse
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        return left[new], right[new], inverse

    def edges(self, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The blocks that sorted keys lie in, and where each begins, with the end of all."""
        blocks, starts = np.unique(_shifted(left, self.left - self.block), return_index=True)
        return blocks.astype(np.int64), np.append(starts, len(left))


def _columns(values: np.ndarray, bits: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _values(data: bytes, at: int, entries: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((entries, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, entries * width, at).reshape(entries, width)
    return out.view("<u8").reshape(-1).astype(np.uint64), at + entries * width


def encode(space: KeySpace, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of sorted distinct permuted keys of one block."""
    entries, rest = len(left), space.left - space.block
    quotient_bits = min(rest, max(0, entries - 1).bit_length())
    left = left & _mask(rest)
    quotients = _shifted(left, rest - quotient_bits).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients] = True
    ends = np.ones(entries, bool)
    ends[:-1] = quotients[1:] != quotients[:-1]
    many = counts > 1
    small = np.minimum(counts[many], 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<u8")
    header = np.array((entries, quotient_bits, rest - quotient_bits, space.right, len(small), len(large)), HEADER)
    return b"".join(
        [
            header.tobytes(),
            np.packbits(occupied).tobytes(),
            np.packbits(ends).tobytes(),
            _columns(left & _mask(rest - quotient_bits), rest - quotient_bits),
            _columns(right, space.right),
            np.packbits(many).tobytes(),
            small.tobytes(),
            large.tobytes(),
        ]
    )


def decode(space: KeySpace, block: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts of a filter, in order."""
    header = np.frombuffer(data, HEADER, 1)[0]
    entries, quotient_bits, rest = int(header["entries"]), int(header["quotient"]), int(header["left"])
    at = HEADER.itemsize
    size = -(-(1 << quotient_bits) // 8)
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=1 << quotient_bits))
    at += size
    size = -(-entries // 8)
    ends = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=entries)
    at += size
    quotients = occupied[np.cumsum(ends) - ends].astype(np.uint64)
    low, at = _values(data, at, entries, rest)
    right, at = _values(data, at, entries, int(header["right"]))
    size = -(-entries // 8)
    many = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=entries).astype(bool)
    at += size
    more = np.frombuffer(data, np.uint8, int(header["many"]), at).astype(np.int64)
    at += len(more)
    more[more == 255] = np.frombuffer(data, "<u8", int(header["large"]), at)
    counts = np.ones(entries, np.int64)
    counts[many] = more
    first = np.uint64(block << (space.left - space.block))
    left = first | (quotients << np.uint64(rest) if rest < 64 else np.uint64(0)) | low
    return left, right, counts


def merge(space: KeySpace, filters: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """The sums of several filters of one block, and for each filter the places of its keys."""
    left, right, counts = (np.concatenate(parts) for parts in zip(*filters, strict=True))
    left, right, place = space.distinct(left, right)
    total = np.zeros(len(left), np.int64)
    np.add.at(total, place, counts)
    return left, right, total, np.split(place, np.cumsum([len(f[0]) for f in filters])[:-1])
