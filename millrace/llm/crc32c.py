"""CRC-32C of many byte strings at once, and the masked form that record files carry."""

from __future__ import annotations

import numpy as np

#: Reversed Castagnoli polynomial and the mask's addend (fixed values of the formats).
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8

#: Bytes per column step of the chunk matrix.
CHUNK = 256


def _byte_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


BYTE = _byte_table()


def _zeros(value: np.ndarray, n: int) -> np.ndarray:
    """The register after ``n`` more zero bytes."""
    for _ in range(n):
        value = BYTE[value & 0xFF] ^ (value >> np.uint32(8))
    return value


#: Two bytes per step.
PAIR = _zeros(np.arange(65536, dtype=np.uint32), 2)
#: The register moved on by a whole chunk, by the value of each of its bytes.
SHIFT = [_zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * b), CHUNK) for b in range(4)]


def crc32c(data: bytes) -> int:
    """CRC-32C of one short string."""
    value = 0xFFFFFFFF
    for byte in data:
        value = int(BYTE[(value ^ byte) & 0xFF]) ^ (value >> 8)
    return value ^ 0xFFFFFFFF


def crc32c_all(data: list[bytes]) -> np.ndarray:
    """CRC-32C of each string.

    Zeros in front of a string do not change a register that starts at zero, so
    strings are padded in front to whole chunks, all chunks are run side by side, and
    the chunks of a string are then joined in order. Inverting the first four bytes
    stands for the usual start value; shorter strings are run alone.
    """
    sizes = np.array([len(d) for d in data], np.int64)
    if not len(sizes):
        return np.empty(0, np.uint32)
    chunks = -(-sizes // CHUNK)
    ends = np.cumsum(chunks)
    whole = np.zeros(int(ends[-1]) * CHUNK, np.uint8)
    for end, d in zip((ends * CHUNK).tolist(), data):
        if d:
            part = whole[end - len(d):end]
            part[:] = np.frombuffer(d, np.uint8)
            part[:4] ^= 0xFF
    pairs = np.ascontiguousarray(whole.view("<u2").reshape(-1, CHUNK // 2).T)
    register = np.zeros(pairs.shape[1], np.uint32)
    for column in pairs:
        register = PAIR[(register ^ column) & np.uint32(0xFFFF)] ^ (register >> np.uint32(16))
    out, first = np.zeros(len(data), np.uint32), ends - chunks
    for j in range(int(chunks.max())):
        live = np.flatnonzero(chunks > j)
        held = out[live]
        moved = SHIFT[0][held & 0xFF] ^ SHIFT[1][held >> 8 & 0xFF] ^ SHIFT[2][held >> 16 & 0xFF] ^ SHIFT[3][held >> 24]
        out[live] = moved ^ register[first[live] + j]
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes < 4):
        out[i] = crc32c(data[i])
    return out


def masked(values: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum of data that holds checksums stays strong."""
    values = values.astype(np.uint32)
    return ((values >> np.uint32(15)) | (values << np.uint32(17))) + np.uint32(MASK)
