"""Hashes of words and of runs of words, for many texts at a time, and bitmaps of hashes."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)

#: A bitmap has two to this power bits, 16 MB, whatever the data.
BITS = 27


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts laid end to end, with the hash of any run of them in a few steps."""

    def __init__(self, texts: list[bytes]):
        cut = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in cut], dtype=np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.total = int(self.counts.sum())
        flat = np.empty(self.total, dtype=object)
        flat[:] = [w for words in cut for w in words]
        hashes = pd.util.hash_array(flat, categorize=False) if self.total else np.empty(0, dtype=np.uint64)
        steps = np.full(self.total + 1, _BASE, dtype=np.uint64)
        back = np.full(self.total + 1, _BACK, dtype=np.uint64)
        steps[0] = back[0] = 1
        with np.errstate(over="ignore"):
            self._back = np.cumprod(back)
            self._sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * np.cumprod(steps)[:-1])])

    def runs(self, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The hash of the words from `first` up to before `after`, wherever they stand."""
        with np.errstate(over="ignore"):
            return mixed((self._sums[after] - self._sums[first]) * self._back[first] + (after - first).astype(np.uint64))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all runs of `width` words inside one text, and for each the number of its text."""
        n = np.maximum(self.counts - width + 1, 0)
        text = np.repeat(np.arange(len(n)), n)
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.starts, n), text


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Which leading BITS bits occur among 64-bit hashes: a table of fixed size, in words of 64 bits.

    It answers "perhaps" or "no"; with more hashes than bits it says perhaps to
    everything, which costs time but changes no result.
    """
    place = F.shiftrightunsigned(F.col(column), 64 - BITS)
    rows = (
        hashes.groupBy(F.shiftright(place, 6).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{column}`, {64 - BITS}) & 63 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(2 ** (BITS - 6), dtype=np.int64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return table.view(np.uint64)


def perhaps(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - BITS)
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def long(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's long."""
    return x.view(np.int64)


def no_id_last(doc_id: Column) -> Column:
    """An id to compare by: null is larger than all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))
