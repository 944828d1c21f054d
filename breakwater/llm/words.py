"""Words and word shingles as 64-bit numbers, made task by task with numpy."""

from __future__ import annotations

import numpy as np

# Bound of a task's table of words: it starts anew beyond it, which changes no result.
TABLE_WORDS = 250_000
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Words looked up all at once: a word takes the place of another one in its slot.
_SLOT_BITS = 20
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_IN_WORD = np.array([k != 32 and not 9 <= k <= 13 for k in range(256)])


# Primes of xxHash.
_PRIMES = tuple(map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)))


def _turned(numbers: np.ndarray, bits: int) -> np.ndarray:
    return numbers << np.uint64(bits) | numbers >> np.uint64(64 - bits)


def short_hashes(low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``xxh64_intdigest`` of words of up to 16 bytes, the first and the last eight bytes of which are numbers."""
    p, q, r, s, t = _PRIMES
    found = sizes.astype(np.uint64) + t
    for eight, least in ((low, 8), (high, 16)):
        found = np.where(sizes >= least, _turned(found ^ _turned(eight * q, 31) * p, 27) * p + s, found)
    rest, left = np.where(sizes < 8, low, high), sizes % 8
    four = _turned(found ^ (rest & np.uint64(0xFFFFFFFF)) * p, 23) * q + r
    found, rest = np.where(left >= 4, four, found), np.where(left >= 4, rest >> np.uint64(32), rest)
    for k in range(3):
        found = np.where(left % 4 > k, _turned(found ^ (rest >> np.uint64(8 * k) & np.uint64(0xFF)) * t, 11) * p, found)
    found = (found ^ found >> np.uint64(33)) * q
    found = (found ^ found >> np.uint64(29)) * r
    return found ^ found >> np.uint64(32)


class WordNumbers(dict):
    """Word (bytes) to its 64-bit hash, each distinct word of a task hashed once."""

    def __init__(self):
        import xxhash

        super().__init__()
        self.hash = xxhash.xxh64_intdigest
        self.recent = np.zeros((2, 1 << _SLOT_BITS), np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.hash(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > TABLE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def of_places(self, raw: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The numbers of words in place; words of up to 16 bytes that were met lately are looked up all at once."""
        sizes, padded = ends - begins, raw + bytes(16)
        eights = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
        low, high = (eights[begins + k] & _MASKS[np.clip(sizes - k, 0, 8)] for k in (0, 8))
        names = mixed(mixed(low + sizes.astype(np.uint64) * _STEP) + high)
        slots = (names >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        found, short = self.recent[1][slots], sizes <= 16
        kept, long = np.flatnonzero(short & (self.recent[0][slots] != names)), np.flatnonzero(~short)
        found[kept] = short_hashes(low[kept], high[kept], sizes[kept])
        places = zip(begins[long].tolist(), ends[long].tolist())
        found[long] = np.fromiter((self.hash(raw[i:j]) for i, j in places), np.uint64, len(long))
        self.recent[:, slots[kept]] = names[kept], found[kept]
        return found


def word_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of bytes at which words begin and end."""
    word = np.zeros(len(raw) + 2, bool)
    word[1:-1] = _IN_WORD[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[::2], edges[1::2]


def split_words(text: str, lower: bool = False) -> list[bytes]:
    """Runs of bytes other than ASCII white space, A-Z in lower case if asked for."""
    raw = text.encode()
    return (raw.lower() if lower else raw).split()


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all others."""
    x = numbers ^ (numbers >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; fewer words count as one run, none as none."""
    if not len(numbers):
        return numbers
    size = min(size, len(numbers))
    count = len(numbers) - size + 1
    found = np.full(count, np.uint64(size), np.uint64)
    for k in range(size):
        found = mixed(found * _STEP + numbers[k : k + count])
    return found
