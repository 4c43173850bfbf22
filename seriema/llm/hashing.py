"""64-bit names of words in numpy, equal on every machine."""

from __future__ import annotations

import numpy as np
import xxhash

ODD = np.uint64(0x9E3779B97F4A7C15)


class Names(dict):
    """Word -> 64-bit name, kept for the words met before; emptied when it has grown too large."""

    LIMIT = 1 << 17

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        name = self[word] = xxhash.xxh3_64_intdigest(word)
        return name

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs, in this order."""
    return mixed(mixed(left) * ODD + right)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes.split() parts at space and the control characters 9 to 13."""
    return text.encode("utf-8", "surrogatepass").split() if text else []
