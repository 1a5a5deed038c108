"""Joins that keep working when one key holds a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    salts: int = 8,
) -> DataFrame:
    """Equi-join ``large`` with ``small`` on ``keys``, hot keys split ``salts`` ways.

    ``small`` has few rows per key (an aggregate of ``large`` by those keys,
    typically) and is repeated once per salt; ``large`` rows get their salt from
    a hash of the ``spread`` columns, so the result does not depend on
    partitioning.  Because the shuffle key is not the plain key, an aggregation
    that follows still shuffles, which also leaves adaptive skew splitting free.
    """
    if how not in ("inner", "left"):
        raise ValueError("the repeated side can only be inner or right-hand of a left join")
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return large.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")
