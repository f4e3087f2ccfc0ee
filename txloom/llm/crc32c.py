"""CRC-32C of many byte strings at once, as record files use it.

Without its start value the checksum is linear: zero bytes before the data do not change it, and the
checksum of a longer text is the shifted checksum of its front, XOR that of its back. So all strings
are cut into lanes of 64 bytes, the lanes run side by side in numpy, and are then joined pairwise.
"""

from __future__ import annotations

from functools import cache

import numpy as np

POLYNOMIAL = 0x82F63B78
LANE = 64


@cache
def _byte_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(POLYNOMIAL), crc >> 1).astype(np.uint32)
    return crc


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 0xFFFF] ^ tables[1][crc >> 16]


def _tables(columns: np.ndarray) -> np.ndarray:
    """Lookup by 16 bits of the linear map that sends bit k to columns[k]."""
    out = np.zeros((2, 1 << 16), np.uint32)
    for half in range(2):
        for bit in range(16):
            out[half][1 << bit : 2 << bit] = out[half][: 1 << bit] ^ columns[16 * half + bit]
    return out


@cache
def _shift(power: int) -> np.ndarray:
    """The map of a checksum over 2 ** power zero bytes."""
    bits = (np.uint32(1) << np.arange(32, dtype=np.uint32)).astype(np.uint32)
    if power == 0:
        return _tables((bits >> 8) ^ _byte_table()[bits & 0xFF])
    half = _shift(power - 1)
    return _tables(_apply(half, _apply(half, bits)))


@cache
def _word_tables() -> np.ndarray:
    """The map of a checksum over four zero bytes: what a 32-bit word XORed in becomes."""
    return _shift(2)


def _pairwise(crc: np.ndarray, counts: np.ndarray) -> np.ndarray:
    power = LANE.bit_length() - 1
    while len(crc) and counts.max() > 1:
        halves = (counts + 1) // 2
        lead = np.zeros(2 * int(halves.sum()), np.uint32)
        ends = np.cumsum(2 * halves)
        lead[np.repeat(ends - np.cumsum(counts), counts) + np.arange(len(crc))] = crc
        crc, counts = _apply(_shift(power), lead[0::2]) ^ lead[1::2], halves
        power += 1
    return crc


def crc32c(chunks: list[bytes]) -> np.ndarray:
    """The checksum of each chunk; of an empty one it is 0."""
    sizes = np.array([len(x) for x in chunks], np.int64)
    counts = np.maximum(1, -(-sizes // LANE))
    data = b"".join(bytes(int(c) * LANE - len(x)) + x for x, c in zip(chunks, counts, strict=True))
    words = np.frombuffer(data, "<u4").reshape(-1, LANE // 4)
    crc = np.zeros(len(words), np.uint32)
    for k in range(LANE // 4):
        crc = _apply(_word_tables(), crc ^ words[:, k])
    crc = _pairwise(crc, counts)
    start = np.full(len(chunks), 0xFFFFFFFF, np.uint32)
    for bit in range(int(sizes.max(initial=0)).bit_length()):
        on = (sizes >> bit) & 1 == 1
        start[on] = _apply(_shift(bit), start[on])
    return crc ^ start ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum of data that holds checksums stays sound."""
    return (((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)).astype(np.uint32)
