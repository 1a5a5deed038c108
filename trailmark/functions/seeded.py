"""Reproducible pseudo-random numbers: functions of a key, never of partitioning."""

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 4294967296.0  # 2 ** 32


def _digest_uniform(digest: Column, word: int) -> Column:
    part = F.substring(digest, 8 * word + 1, 8)
    return (F.conv(part, 16, 10).cast("double") + 0.5) / WORD


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the joined parts."""
    return _digest_uniform(F.md5(F.concat_ws("|", *parts).cast("binary")), 0)


def normals(key: Column, count: int, seed: int = 42) -> Column:
    """Array of ``count`` standard normal numbers belonging to a key.

    Each md5 gives four uniform numbers, which Box-Muller turns into four normals.
    """
    blocks = F.sequence(F.lit(0), F.lit(math.ceil(count / 4) - 1))
    digests = F.transform(
        blocks,
        lambda b: F.md5(F.concat_ws("|", F.lit(str(seed)), b.cast("string"), key).cast("binary")),
    )

    def four(digest: Column) -> Column:
        out = []
        for word in (0, 2):
            radius = F.sqrt(-2 * F.ln(_digest_uniform(digest, word)))
            angle = 2 * math.pi * _digest_uniform(digest, word + 1)
            out += [radius * F.cos(angle), radius * F.sin(angle)]
        return F.array(*out)

    return F.slice(F.flatten(F.transform(digests, four)), 1, count)


def weight(seed: int, layer: str, row: int, column: int, dim: int) -> float:
    """A fixed untrained weight, uniform in (-1/sqrt(dim), 1/sqrt(dim))."""
    digest = hashlib.md5(f"{seed}|{layer}|{row}|{column}".encode()).hexdigest()
    u = (int(digest[:8], 16) + 0.5) / WORD
    return (2 * u - 1) / math.sqrt(dim)
