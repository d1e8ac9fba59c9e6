"""Arrays of whole numbers as few bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0: their bytes sorted by place, compressed."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    width = data[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(data[1:], width * n, codec="zstd"), np.uint8).reshape(width, n).T
    return out.view("<i8")[:, 0]


def pack_rising(values: np.ndarray) -> bytes:
    """Numbers from 0 that never fall, as Elias-Fano code: the low bits of each, the others in unary."""
    n = len(values)
    low = max(0, (int(values[-1]) // n).bit_length() - 1)
    octets = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(n, 8)
    lows = np.packbits(np.unpackbits(octets, axis=1, count=low, bitorder="little")) if low else np.zeros(0, np.uint8)
    places = (values >> low).astype(np.int64) + np.arange(n)
    highs = np.zeros(int(places[-1]) + 1, np.uint8)
    highs[places] = 1
    return bytes([low]) + lows.tobytes() + np.packbits(highs).tobytes()


def unpack_rising(data: bytes, n: int) -> np.ndarray:
    low, octets = data[0], np.frombuffer(data, np.uint8)[1:]
    size = -(-n * low // 8)
    values = (np.flatnonzero(np.unpackbits(octets[size:]))[:n] - np.arange(n)) << low
    if low:
        bits = np.unpackbits(octets[:size], count=n * low).reshape(n, low)
        lows = np.zeros((n, 8), np.uint8)
        lows[:, : -(-low // 8)] = np.packbits(bits, axis=1, bitorder="little")
        values |= lows.view("<i8")[:, 0]
    return values


def pack_text(lines: list[str]) -> bytes:
    """Texts without line feeds."""
    data = "\n".join(lines).encode()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack_text(data: bytes) -> list[str]:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd").to_pybytes().decode().split("\n")
