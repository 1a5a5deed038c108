"""Balanced label propagation: documents move to their neighbours' shards under quotas.

Documents are linked by sharing a key.  Each round counts the shards of a key's
documents and moves them all to the shard where most of them are, of those whose
quota still has room for them; keys of very many documents are placed before.  At the
end shards that hold too many rows give unlinked documents to those that hold too few.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.llm.shared import SMALL_ROWS, fraction, running_total, small, stored


def _quota(shard: Column, total: int, shards: int) -> Column:
    """Rows of each shard: all shards equal, the first ones one more if need be."""
    return (F.lit(total // shards) + (shard < total % shards).cast("long")).cast("long")


def _numbered(df: DataFrame, by: str, first: Column, digest: Column, name: str) -> DataFrame:
    """Number the rows of each `by` from 0: rows with small `first` come first, then in order of `digest`.

    `digest` is hex and no value has very many rows; `_tie` breaks ties.  The
    table of counts has a row for each `by` and `first`, and is joined, not collected.
    """
    df = df.withColumn("_key", digest).withColumn("_class", first.cast("int")).withColumn("_one", F.lit(1).cast("long"))
    sizes = df.groupBy(by, "_class").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(by).orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    sizes = small(stored(sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))))
    joined = df.join(sizes, [by, "_class"])
    within = running_total(joined, [by, "_class"], "_key", ["_tie"], "_one", F.col("_rows"), "_number")
    return within.withColumn(name, F.col("_before") + F.col("_number")).drop(
        "_key", "_class", "_one", "_rows", "_before", "_number"
    )


def _free(taken: DataFrame, total: int, shards: int, spark) -> DataFrame:
    """(shard, held, quota): one row per shard."""
    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(taken, "shard", "left").select(
        "shard", F.coalesce("held", F.lit(0)).alias("held"), _quota(F.col("shard"), total, shards).alias("quota")
    )


#: Groups of more than this part of a shard are placed first, largest first; there are about GREAT times shards of them.
GREAT = 8


def _pieces(groups: list[tuple[str, int]], room: dict[int, int]) -> list[tuple[str, int, int, int]]:
    """(group, from, to, shard): the rows from … to of each group go to the shard; `room` is reduced.

    The largest group first, into the shard it fills best; if none has room for the
    rest of a group, the shard with the most room takes what it can.
    """
    placed = []
    for group, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        at = 0
        while at < size:
            fitting = [(free, s) for s, free in room.items() if free >= size - at]
            shard = min(fitting)[1] if fitting else max(room, key=lambda s: (room[s], -s))
            count = min(room[shard], size - at)
            placed.append((group, at, at + count, shard))
            room[shard] -= count
            at += count
    return placed


def _proposed(waiting: DataFrame, counts: DataFrame, room: dict[int, int], own: bool, turn: int) -> DataFrame:
    """Of each waiting group the shard with most of its rows among those with room for all of it.

    Besides the shards of its rows (if `own`), one that a hash draws for this turn is considered.
    """
    spark = waiting.sparkSession
    free = sorted(s for s, n in room.items() if n > 0)
    table = F.broadcast(spark.createDataFrame([(k, s, room[s]) for k, s in enumerate(free)], "_k int, shard int, _room long"))
    drawn = F.pmod(F.xxhash64("_g", F.lit(turn)), F.lit(len(free))).cast("int")
    other = waiting.withColumn("_k", drawn).join(table.select("_k", "shard"), "_k").select("_g", "_size", "shard", F.lit(0).cast("long").alias("n"))
    seen = other.unionByName(waiting.join(counts, "_g").select("_g", "_size", "shard", "n")) if own else other
    best = F.max(F.struct(F.col("n"), (-F.col("shard")).alias("s"), F.col("_room")))
    fits = seen.join(table.drop("_k"), "shard").filter(F.col("_room") >= F.col("_size"))
    return fits.groupBy("_g", "_size").agg(best.alias("_best")).select(
        "_g", "_size", (-F.col("_best.s")).cast("int").alias("_to"), F.col("_best._room").alias("_room")
    )


def balanced_shards(rows: DataFrame, links: str, shards: int, rounds: int = 3, seed: int = 23) -> DataFrame:
    """The rows with `shard` (int) and `slot` (long, from 0 without gaps in each shard).

    Rows that share a value of the column `links` are linked; null links nothing.  The
    numbers of rows of any two shards differ by one at most.  Few links are cut:
    rows start at random; groups that take a large part of a shard, or several,
    are placed first, on as few shards as hold them.  Each other group moves whole to the
    shard where most of its rows are, of those that still have room for it; for `rounds`
    rounds its own shards are proposed, then drawn ones, until no group moves.  The
    last groups are cut only where no shard has room for one.

    Only counts by (link, shard) and by shard meet in one place; ranks are
    running totals over ranges of a hash, so no group is ordered by one task.
    The driver gets one number per shard, about GREAT times `shards` large groups and at most
    SMALL_ROWS of the last ones.
    Repeated rows count each; no rows give no rows.  Columns named shard and
    slot are replaced, names that begin with `_` are the operator's own.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    drawn = rows.select(*kept).withColumn("_tie", F.xxhash64(*kept))
    drawn = drawn.withColumn("_draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_tie").cast("string"))))
    begun = drawn.withColumn("shard", F.floor(fraction(F.col("_draw")) * shards).cast("int"))
    state = stored(begun.withColumn("_g", F.md5(F.col(links).cast("string"))))
    total = state.count()
    counts = stored(state.filter("_g IS NOT NULL").groupBy("_g", "shard").agg(F.count("*").alias("n")))
    waiting = stored(counts.groupBy("_g").agg(F.sum("n").alias("_size")).filter("_size > 1"))
    room = {s: total // shards + (s < total % shards) for s in range(shards)}
    great = F.col("_size") * GREAT > max(1, total // shards)
    pieces = _pieces([(r["_g"], r["_size"]) for r in waiting.filter(great).collect()], room)
    waiting = stored(waiting.filter(~great))
    left, turn, settled = waiting.count(), 0, []
    while left and (turn < rounds or left > SMALL_ROWS) and any(room.values()):
        wished = stored(_proposed(waiting, counts, room, turn < rounds, turn))
        many = wished.groupBy("_to").agg(F.count("*").alias("_rows"))
        ranked = running_total(wished.join(F.broadcast(many), "_to"), ["_to"], "_g", [], "_size", F.col("_rows"), "_before")
        moved = stored(ranked.filter(F.col("_before") + F.col("_size") <= F.col("_room")).select("_g", "_size", "_to"))
        for r in moved.groupBy("_to").agg(F.sum("_size").alias("rows")).collect():
            room[r["_to"]] -= r["rows"]
        settled.append(moved.select("_g", "_to"))
        waiting = stored(waiting.join(moved.select("_g"), "_g", "left_anti"))
        before, left, turn = left, waiting.count(), turn + 1
        if left == before and turn >= rounds:
            break
    if 0 < left <= SMALL_ROWS:
        pieces += _pieces([(r["_g"], r["_size"]) for r in waiting.collect()], room)
    return _even(_at_home(state, pieces, settled, kept), kept, total, shards, spark)


def _at_home(state: DataFrame, pieces: list, settled: list[DataFrame], kept: list[str]) -> DataFrame:
    """The rows in the shards of their groups; `_home` is whether they were given one."""
    spark = state.sparkSession
    table = spark.createDataFrame(pieces, "_g string, _from long, _upto long, _to int")
    table = small(stored(table))
    sizes = small(stored(table.groupBy("_g").agg(F.max("_upto").alias("_rows"))))
    columns = [*kept, "_tie", "_draw", "shard", "_home"]
    apart = state.join(sizes, "_g").withColumn("_one", F.lit(1).cast("long"))
    numbered = running_total(apart, ["_g"], "_draw", ["_tie"], "_one", F.col("_rows"), "_number")
    inside = (F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_upto"))
    cut = numbered.join(table, "_g").filter(inside).withColumn("shard", F.col("_to")).withColumn("_home", F.lit(True))
    rest = state.join(sizes, "_g", "left_anti")
    moves = spark.createDataFrame([], "_g string, _to int")
    for part in settled:
        moves = moves.unionByName(part)
    home = rest.join(moves, "_g", "left").withColumn("_home", F.col("_to").isNotNull())
    home = home.withColumn("shard", F.coalesce("_to", "shard"))
    return stored(cut.select(*columns).unionByName(home.select(*columns)))


def _even(state: DataFrame, kept: list[str], total: int, shards: int, spark) -> DataFrame:
    """Bring every shard to its quota: surplus rows fill free slots.

    Rows that were given their group's shard rank first and are never more than
    its quota; surplus is the end of the others.
    """
    place = F.when(F.col("_home"), 0).otherwise(1)
    ranked = stored(_numbered(state, "shard", place, F.col("_draw"), "slot"))
    held = _free(ranked.groupBy("shard").agg(F.count("*").alias("held")), total, shards, spark)
    # one row per shard: where its free slots begin among all free slots, and how its surplus rows are numbered among all
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    spare, over = F.greatest(F.col("quota") - F.col("held"), F.lit(0)), F.greatest(F.col("held") - F.col("quota"), F.lit(0))
    table = stored(
        held.withColumn("_spare", spare)
        .withColumn("_over", over)
        .withColumn("_spare_from", F.coalesce(F.sum("_spare").over(order), F.lit(0)))
        .withColumn("_over_from", F.coalesce(F.sum("_over").over(order), F.lit(0)))
    )
    table = small(table)
    own = table.select("shard", "quota", F.col("_over_from"))
    marked = ranked.join(own, "shard")
    stay = marked.filter("slot < quota").select(*kept, "shard", "slot")
    go = marked.filter("slot >= quota").withColumn("_at", F.col("_over_from") + F.col("slot") - F.col("quota"))
    # every surplus row finds its shard by equal blocks of numbers: free stretches are cut into them
    gaps = table.filter("_spare > 0").select(
        F.col("shard").alias("_new"), F.col("held").alias("_held"), "_spare_from", F.col("_spare")
    )
    unit = max(1, total // shards)
    cut = gaps.withColumn(
        "_block",
        F.explode(F.sequence(F.floor(F.col("_spare_from") / unit), F.floor((F.col("_spare_from") + F.col("_spare") - 1) / unit))),
    )
    came = (
        go.withColumn("_block", F.floor(F.col("_at") / unit))
        .join(small(stored(cut)), "_block")
        .filter((F.col("_at") >= F.col("_spare_from")) & (F.col("_at") < F.col("_spare_from") + F.col("_spare")))
        .select(*kept, F.col("_new").alias("shard"), (F.col("_held") + F.col("_at") - F.col("_spare_from")).alias("slot"))
    )
    return stay.unionByName(came)
