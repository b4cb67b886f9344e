"""Word hashes in numpy, used inside tasks."""

import numpy as np
import pyarrow as pa
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word (bytes) to a 64-bit hash; emptied when it has ``most`` words, so a task's memory is bounded."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lowered(text: str | None) -> list[bytes]:
    """Words between spaces and tab to carriage return; A-Z lowered and no other letter."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


# A word's hash is a polynomial in a random value of each of its bytes, spread by ``mixed``; A-Z count as a-z.
_RNG = np.random.default_rng(20)
BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
BYTE[65:91] = BYTE[97:123]
IN_WORD = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
#: Bytes hashed at once, up to the end of a word.
PIECE = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i for i below ``n`` or more; kept for the usual piece only."""
    size = PIECE if n <= PIECE else n
    if size not in _powers:
        made = []
        for base in (BASE, INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if size > PIECE:
            return made[0], made[1]
        _powers[size] = (made[0], made[1])
    return _powers[size]


def words_in(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word in ``data``, bytes of UTF-8: what stands between spaces and tab to carriage return."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and IN_WORD[data[end - 1]]:  # a word is not cut: on to the next space
            more = np.flatnonzero(~IN_WORD[data[end : end + PIECE]])
            end = end + int(more[0]) + 1 if len(more) else min(len(data), end + PIECE)
        piece = data[at:end]
        inside = np.concatenate(([False], IN_WORD[piece], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        if len(first):
            up, down = powers(len(piece))
            value = BYTE[piece] * up[: len(piece)]
            sums = np.cumsum(value)
            word = (sums[last - 1] - sums[first] + value[first]) * down[first]
            starts.append(first + at)
            hashes.append(mixed(word ^ ((last - first).astype(np.uint64) << np.uint64(40))))
        at = end
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.empty(0, np.int64), np.empty(0, np.uint64))


def grouped_texts(texts: pa.Array, most: int = 1 << 21):
    """(first row, offsets, bytes) of groups of rows with about ``most`` bytes; a longer text is a group by itself.

    Null texts are empty. A space stands between texts.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        end = min(end, len(texts))
        own = offsets[row : end + 1] - offsets[row]
        yield row, own + np.arange(len(own)), np.insert(data[offsets[row] : offsets[end]], own[1:-1], 32)
        row = end


def shingles_of(offsets: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the sorted distinct shingles of row r are ``hashes[bounds[r]:bounds[r + 1]]``.

    Shingles are ``width`` consecutive words; of a row with fewer, all its words are one.
    """
    rows = len(offsets) - 1
    starts, words = words_in(data)
    first = np.searchsorted(starts, offsets[:-1])
    of = np.searchsorted(offsets, starts, "right") - 1
    n = np.bincount(of, minlength=rows)
    with np.errstate(over="ignore"):
        size = len(words) - width + 1
        full = np.flatnonzero(of[: max(size, 0)] == of[width - 1 :]) if size > 0 else np.empty(0, np.int64)
        h = np.full(len(full), np.uint64(width), np.uint64)
        for k in range(width):
            h = h * MULTIPLIER + words[full + k]
        row = of[full]
        short = np.flatnonzero((n > 0) & (n < width))
        whole = np.empty(len(short), np.uint64)
        for i, r in enumerate(short):
            value = np.uint64(n[r])
            for w in words[first[r] : first[r] + n[r]]:
                value = value * MULTIPLIER + w
            whole[i] = value
        h, row = mixed(np.concatenate([h, whole])), np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return np.searchsorted(row, np.arange(rows + 1)), h
