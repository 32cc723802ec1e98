"""Elias-Fano sequences in flat arrays that can be memory-mapped, for many queries at once."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

_ONE = np.uint64(1)
_BYTES = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)
#: Place of the k-th set bit of a byte, by 8 times the byte and k.
_IN_BYTE = np.array(
    [([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for byte in range(256) for k in range(8)], np.int64
)


def _select(bits: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit of each word that has ``rank`` (below their number) others below it."""
    two, four = np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
    sums = bits - ((bits >> _ONE) & np.uint64(0x5555555555555555))
    sums = (sums & two) + ((sums >> np.uint64(2)) & two)
    # Each byte: the set bits up to its end.
    sums = ((sums + (sums >> np.uint64(4))) & four) * _BYTES
    rank = rank.astype(np.uint64)
    before = np.bitwise_count(((rank * _BYTES | _TOPS) - sums) & _TOPS).astype(np.uint64) << np.uint64(3)
    rank -= ((sums << np.uint64(8)) >> before) & np.uint64(255)
    byte = (bits >> before) & np.uint64(255)
    return before.astype(np.int64) + _IN_BYTE[(byte << np.uint64(3) | rank).astype(np.int64)]


def _joined(size: int, word: np.ndarray, part: np.ndarray) -> np.ndarray:
    """``size`` words, each with the bits of all its parts; ``word`` rises."""
    out = np.zeros(size, np.uint64)
    if len(word):
        start = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[start]] = np.bitwise_or.reduceat(part, start)
    return out


class Sequence:
    """A rising sequence of numbers below a bound: low bits packed, high parts in unary. About
    two bits and the logarithm of the mean gap for each number."""

    def __init__(self, parts: dict[str, np.ndarray]) -> None:
        self.size, self.low_bits = (int(x) for x in parts["shape"])
        self.low, self.high, self.zeros = parts["low"], parts["high"], parts["zeros"]

    @staticmethod
    def encode(values: np.ndarray, bound: int) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        bits = max(0, int(np.log2(max(bound, 1) / max(n, 1)))) if n else 0
        place = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            low = _joined(len(low), word, part << shift)
            # The last part of a word may reach into the next one.
            over = np.flatnonzero(shift + np.uint64(bits) > np.uint64(64))
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        up = (values >> np.uint64(bits)).astype(np.int64)
        length = n + (bound >> bits) + 2
        ones = up + np.arange(n)
        high = _joined(length // 64 + 1, ones >> 6, _ONE << (ones & 63).astype(np.uint64))
        zeros = 64 - np.bitwise_count(high).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(zeros)[:-1]])
        return {"shape": np.array([n, bits]), "low": low, "high": high, "zeros": before}

    def _low(self, at: np.ndarray) -> np.ndarray:
        place = at.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        # In two steps, as a shift by 64 is none.
        over = (self.low[word + 1] << _ONE) << (shift ^ np.uint64(63))
        return ((self.low[word] >> shift) | over) & np.uint64((1 << self.low_bits) - 1)

    def _zero(self, number: np.ndarray) -> np.ndarray:
        """Places of the given zeros in the unary part."""
        word = np.searchsorted(self.zeros, number, "right") - 1
        return word * 64 + _select(~self.high[word], number - self.zeros[word])

    def _next_zero(self, place: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Places of the given zeros, which are the first at ``place`` or after it."""
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        rest = ~self.high[word] >> shift
        found = place + np.bitwise_count((rest & (~rest + _ONE)) - _ONE)
        far = np.flatnonzero(rest == 0)
        found[far] = self._zero(number[far])
        return found

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number that is not below each of ``wanted``, as far as it has the
        same high part (else the place after those), and whether it is equal."""
        wanted = wanted.astype(np.uint64)
        up = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        rest = wanted & np.uint64((1 << self.low_bits) - 1)
        # Numbers with this high part lie between two zeros.
        before = np.where(up > 0, self._zero(np.maximum(up - 1, 0)), -1)
        last = self._next_zero(before + 1, up) - up
        place = before + 1 - up
        # Only those whose range is not down to nothing are searched on.
        at = np.flatnonzero(place < last)
        low, high, sought = place[at], last[at], rest[at]
        while len(at):
            middle = (low + high) >> 1
            less = self._low(middle) < sought
            low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
            open_ = low < high
            done = ~open_
            place[at[done]] = low[done]
            at, low, high, sought = at[open_], low[open_], high[open_], sought[open_]
        equal = place < last
        equal[equal] = self._low(place[equal]) == rest[equal]
        return place, equal

    def at(self, place: np.ndarray) -> np.ndarray:
        """The numbers at the given places (a rank directory is not needed: by search)."""
        ones_before = np.arange(len(self.high)) * 64 - self.zeros
        word = np.searchsorted(ones_before, place, "right") - 1
        inner = _select(self.high[word], place - ones_before[word])
        up = (word * 64 + inner - place).astype(np.uint64)
        return (up << np.uint64(self.low_bits)) | self._low(place)


def write(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of arrays. It is moved into place when it is whole, so a task that runs again
    or twice leaves the same file."""
    system, path = pafs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    head, place = {}, 0
    for key, array in arrays.items():
        head[key] = (array.dtype.str, place, len(array))
        place += -(-array.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    part = f"{path}/{name}.{np.random.default_rng().integers(2**62)}.part"
    with system.open_output_stream(part) as out:
        out.write(np.array([len(text)], np.int64).tobytes() + text)
        for array in arrays.values():
            data = np.ascontiguousarray(array).tobytes()
            out.write(data + b"\0" * (-len(data) % 8))
    system.move(part, f"{path}/{name}")


def mapped(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The arrays of a file, memory-mapped if the shared folder is a mounted one; None if there
    is no such file."""
    system, path = pafs.FileSystem.from_uri(folder)
    whole = f"{path}/{name}"
    if system.get_file_info(whole).type == pafs.FileType.NotFound:
        return None
    if isinstance(system, pafs.LocalFileSystem):
        data = pa.memory_map(whole).read_buffer()
    else:
        with system.open_input_stream(whole) as file:
            data = file.read_buffer()
    size = int(np.frombuffer(data, np.int64, 1)[0])
    head = json.loads(bytes(data[8 : 8 + size]))
    return {
        key: np.frombuffer(data, np.dtype(kind), length, 8 + size + place)
        for key, (kind, place, length) in head.items()
    }
