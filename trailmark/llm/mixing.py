"""Mixing sources to target weights along a curriculum that changes with training time.

Each source has a weight schedule: knots (t, w) over the training time 0 … 1,
linear in between.  The area below it is the source's weight.  Targets are
shares of all words, held below `cap` passes over a source.  A source's words,
pass after pass in a fixed random order, meet its cumulative demand; inverting
that demand gives the time at which each copy of a document is trained on.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.llm.shared import running_total, small, stored, word_count

KNOTS = "array<struct<t: double, w: double>>"

#: Schedules of the default curriculum, in turn for the sources in order of name: their areas are 1, 2 and 3.
CURRICULUM = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)), ((0.0, 4.0), (1.0, 2.0)))


def in_turn(sources: DataFrame, curves=CURRICULUM) -> DataFrame:
    """(source, knots): the curves dealt to the sources by code point, null last, again and again.

    `sources` has one row per source, so one ordered task is enough.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    rows = ", ".join(f"array({', '.join(f'named_struct("t", {t}D, "w", {w}D)' for t, w in curve)})" for curve in curves)
    deal = F.element_at(F.expr(f"array({rows})"), ((place - 1) % len(curves) + 1).cast("int"))
    return sources.select("source", deal.alias("knots"))


def _areas(knots: Column) -> Column:
    """The knots with the area of the schedule up to each of them."""
    knots = F.array_sort(knots)
    start = F.array(F.struct(F.get(knots, F.lit(0))["t"].alias("t"), F.get(knots, F.lit(0))["w"].alias("w"), F.lit(0.0).alias("area")))

    def add(done, knot):
        last = F.try_element_at(done, F.lit(-1))
        area = last["area"] + (knot["t"] - last["t"]) * (knot["w"] + last["w"]) / 2
        return F.concat(done, F.array(F.struct(knot["t"].alias("t"), knot["w"].alias("w"), area.alias("area"))))

    return F.aggregate(F.slice(knots, 2, F.greatest(F.size(knots) - 1, F.lit(0))), start, add)


def _time(curve: Column, share: Column) -> Column:
    """The time at which `share` of a schedule's whole area is reached."""
    wanted = share * F.try_element_at(curve, F.lit(-1))["area"]
    left = F.try_element_at(F.filter(curve, lambda k: k["area"] <= wanted), F.lit(-1))
    right = F.coalesce(F.try_element_at(F.filter(curve, lambda k: k["area"] > wanted), F.lit(1)), left)
    width, rest = right["t"] - left["t"], wanted - left["area"]
    slope = F.when(width > 0, (right["w"] - left["w"]) / width).otherwise(0.0)
    root = left["w"] + F.sqrt(F.greatest(left["w"] * left["w"] + 2 * slope * rest, F.lit(0.0)))
    return left["t"] + F.when(root > 0, 2 * rest / root).otherwise(0.0)


def source_targets(sources: DataFrame, schedules: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, docs, source_size, curve, target): words to take from each source.

    `sources` has (source, docs, source_size), one row each; a source without
    a schedule has weight 0.  All words together are shared out by weight; what
    goes beyond `cap` times a source's size is shared again among the others.
    In order of cap per weight the sources held at their cap come first, so one
    pass over running sums finds the level of the others.
    """
    named = schedules.select(F.col("source").alias("_of"), _areas("knots").alias("curve"))
    all_rows = Window.partitionBy()
    held = F.col("source_size") * F.lit(float(cap))
    by_ratio = Window.orderBy(F.col("_ratio").asc_nulls_last(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        sources.join(named, F.col("source").eqNullSafe(F.col("_of")), "left")
        .drop("_of")
        .withColumn("_w", F.coalesce(F.try_element_at(F.col("curve"), F.lit(-1))["area"], F.lit(0.0)))
        .withColumn("_held", held)
        .withColumn("_ratio", F.when(F.col("_w") > 0, F.col("_held") / F.col("_w")))
        .withColumn("_all", F.sum("source_size").over(all_rows))
        .withColumn("_weights", F.sum("_w").over(rest))
        .withColumn(
            "_level",
            F.when(
                F.col("_weights") > 0,
                (F.col("_all") - F.coalesce(F.sum("_held").over(before), F.lit(0.0))) / F.col("_weights"),
            ),
        )
        .withColumn("_place", F.row_number().over(by_ratio))
        .withColumn(
            "_water",
            F.min(
                F.when(F.col("_held") > F.col("_level") * F.col("_w"), F.struct("_place", "_level"))
            ).over(all_rows)["_level"],
        )
        .select(
            "source",
            "docs",
            "source_size",
            "curve",
            F.least("_held", F.coalesce(F.col("_water") * F.col("_w"), F.col("_held"))).alias("target"),
        )
    )


def allocate(docs: DataFrame, schedules=in_turn, cap: float = 3.0, seed: int = 17, whole: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies.

    `copies` is an array of (pass, words, position), one entry for each time the
    document is trained on; `taken` is the sum of its words.  The last document
    that a target reaches is read up to the word at which the demand ends, so
    the words taken of a source differ from its target by less than one; with
    `whole`, copies are taken whole if their middle lies within the demand.
    `schedules` is a table (source, knots) or a function of the table of sources.

    Null or empty texts have size 0 and no copies; a null source is a source of
    its own, in the last place; an empty table gives no rows; rows with the same
    id count each, in the order of their sizes.  Other columns are ignored.
    """
    return _allocated(stored(_sized(docs, seed)), schedules, cap, whole)


def _sized(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    """(doc_id, source, size, _draw, _tie, …): _draw orders the rows of a source by chance, those without id by their text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"))
    return docs.select(
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), key)).alias("_draw"),
        F.xxhash64("text").alias("_tie"),
        *more,
    )


def _allocated(sized: DataFrame, schedules, cap: float, whole: bool, *more: str) -> DataFrame:
    sources = stored(
        sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    )
    curves = schedules(sources) if callable(schedules) else schedules
    targets = small(stored(source_targets(sources, curves, cap).withColumnRenamed("source", "_of")))
    ranked = running_total(
        sized.join(targets, F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("_named", F.col("source").isNotNull())
        .withColumn("_of", F.coalesce("source", F.lit(""))),
        ["_named", "_of"],
        "_draw",
        ["doc_id", "size", "_tie"],
        "size",
        F.col("docs"),
        "_before",
    )
    size, total, target = F.col("size"), F.col("source_size"), F.col("target")
    passes = F.when(size > 0, F.ceil(target / total)).otherwise(0).cast("int")

    def copy(number):
        start = number * total + F.col("_before")
        if whole:
            words = F.when(start + size / 2 <= target, size).otherwise(0)
        else:
            words = F.greatest(F.least(size, F.floor(target) - start), F.lit(0))
        return F.struct(
            number.cast("int").alias("pass"),
            words.cast("long").alias("words"),
            _time(F.col("curve"), F.least(start / target, F.lit(1.0))).alias("position"),
        )

    numbers = F.when(passes > 0, F.sequence(F.lit(0), passes - 1)).otherwise(F.array().cast("array<int>"))
    copies = F.filter(F.transform(numbers, lambda n: copy(n.cast("long"))), lambda c: c["words"] > 0)
    return ranked.withColumn("copies", copies).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
        "copies",
        *more,
    )


def mix_sources(docs: DataFrame, schedules=in_turn, cap: float = 3.0, seed: int = 17, whole: bool = False) -> DataFrame:
    """The training order: (doc_id, source, pass, words, position), range-sorted by position.

    Takes what `allocate` takes; documents outside the mix have no row.
    """
    return (
        allocate(docs, schedules, cap, seed, whole)
        .select("doc_id", "source", F.inline("copies"))
        .orderBy("position", "doc_id", "pass")
    )


def mixed_documents(docs: DataFrame, schedules=in_turn, cap: float = 3.0, seed: int = 17) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it whole, in training order.

    Every row carries its own copies, so ids may be null or repeat.  Rows without words are in no mix.
    `docs` must give the same rows whenever it is read, as stored tables do.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("_llm_row")
    placed = _allocated(_sized(docs, seed, row), schedules, cap, True, "_llm_row")
    return (
        placed.select("_llm_row", "doc_id", F.inline("copies"))
        .orderBy("position", "doc_id", "pass", F.xxhash64("_llm_row"))
        .select(*[F.col(f"_llm_row.c{k}").alias(c) for k, c in enumerate(docs.columns)])
    )


def in_training_order(docs: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a stored mix with `name`, a long that rises along the training order, from 0 without gaps.

    A range-sorted table is stored in files whose numbers rise with the order, and rows keep their
    places inside a file; both are read back.  A table that does not come from files has
    its rows numbered as they come, with gaps.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_llm_file"), F.col("_metadata.row_index").alias("_llm_at"))
    except AnalysisException:
        return docs.withColumn(name, F.monotonically_increasing_id())
    numbers = [F.regexp_extract("_llm_file", pattern, 1).cast("int") for pattern in (r"part-(\d+)", r"-c(\d+)\.")]
    before = Window.orderBy(*numbers, "_llm_file").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file
    files = placed.groupBy("_llm_file").agg(F.count("*").alias("_llm_rows"))
    starts = small(stored(files.select("_llm_file", F.coalesce(F.sum("_llm_rows").over(before), F.lit(0)).alias("_llm_start"))))
    return placed.join(starts, "_llm_file").select(*[placed[f"`{c}`"] for c in docs.columns if c != name], (F.col("_llm_start") + F.col("_llm_at")).alias(name))
