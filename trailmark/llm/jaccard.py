"""N-gram Jaccard join of whole texts by T-occurrence search.

A text is the set of its word shingles.  Two sets link if their Jaccard similarity
reaches `least`.  Equal sets are one class.  A class of n shingles must share one
of its first n - ceil(least * n) + 1 shingles, in an order that all classes have in common,
with any class it links with; linked classes of about one size must share many of them.

1. Classes that have too few first shingles in common with others of their size are alone.  The others' shingles are
   counted, and put in the order of their count: what only one class holds, then what few hold, then passages
   that many have in common.  Most classes fall out here, since their own shingles come first.
2. Each class is compared in full with one other class of its lists, the one with which it shares
   most of these shingles and which comes before it; that makes large groups of copies one component at little cost.
3. The lists that still hold several components are searched, as far as their classes have enough first shingles in
   common with classes of their size.  Classes whose lists overlap are a neighbourhood, cut into parts of bounded size
   of which every two meet, with their whole sets.  There the classes
   outside the largest component are looked up by DivideSkip: the short inverted lists are
   merged, candidates are then probed for in the long ones by binary search, and those reaching the
   required overlap are links.
4. Components of all links, over classes, give every document its component.
"""

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.skew import salted_join
from trailmark.llm.hashing import BITS, Words, bitmap, long, mixed, no_id_last, perhaps
from trailmark.llm.shared import discard, stored

#: Texts are taken in groups of about so many characters.
CHARACTERS = 3_000_000
#: Shingles of a part of a neighbourhood, about; two parts meet in one task.
BLOCK = 1_000_000
#: A shingle's place in the order is the number of these that its count reaches.
#: The order sets the cost only; any order gives the same links.
LEVELS = (2, 3, 5, 9, 17, 65, 257)
#: A table of the levels of common shingles has two to this power cells.
CELLS = 22
#: Rounds in which lists are cleared of classes that have too few first shingles in common with others of their size.
CLEARED = 2


def _sets(batch: pa.RecordBatch, text: int, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of a batch, each with the sorted distinct shingle hashes of its texts."""
    column = batch.column(text)
    sizes = np.cumsum(pa.compute.coalesce(pa.compute.utf8_length(column), 0).to_numpy() + 1) // CHARACTERS
    for k in np.unique(sizes):
        a, b = np.searchsorted(sizes, [k, k + 1])
        part = batch.slice(a, b - a)
        words = Words([(t or "").encode().lower() for t in part.column(text).to_pylist()])
        starts, _ = words.windows(width)
        hashes = words.runs(starts, starts + width)
        counts = np.maximum(words.counts - width + 1, 0)
        ends = np.concatenate([[0], np.cumsum(counts)])
        short = words.runs(words.starts, words.starts + words.counts)
        yield part, [
            np.unique(hashes[ends[i] : ends[i + 1]]) if counts[i] else short[i : i + bool(words.counts[i])]
            for i in range(part.num_rows)
        ]


def _signature(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mixed(shingles).sum(dtype=np.uint64).view(np.int64))


def _first(n: int, least: float) -> int:
    """How many shingles, from the front of the order, a set of n shares one of with every set it links with."""
    return n - ceil(round(least * n, 9)) + 1


def _prefix(shingles: np.ndarray, common: np.ndarray, least: float) -> np.ndarray:
    """The first shingles of a set where those not in `common` come first, then by hash."""
    order = np.argsort(perhaps(common, shingles), kind="stable")
    return shingles[order[: _first(len(shingles), least)]]


def divide_skip(
    lists: list[np.ndarray], n: int, sizes: np.ndarray, least: float, open_to: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the sets that link with a query of n shingles, ascending, and their overlaps.

    `lists` has, for each shingle of the query that other sets hold, the ascending positions of
    these sets; `sizes` the sets' sizes; `open_to` marks the positions that are of interest.  No partner needs less than
    `floor` common shingles, so the floor - 1 longest lists can be left to binary search.  The short ones are
    merged run by run (a stable sort of sorted runs, where a heap would take a step of Python for each posting).
    """
    floor = ceil(round(least * n, 9))
    none = np.empty(0, dtype=np.int64)
    if len(lists) < floor:
        return none, none
    lists = sorted(lists, key=len)
    short = lists[: len(lists) - floor + 1]
    long_lists = lists[len(short) :]
    merged = np.sort(np.concatenate(short), kind="stable")
    if open_to is not None:
        merged = merged[open_to[merged]]
    if not len(merged):
        return none, none
    heads = np.flatnonzero(np.diff(merged, prepend=-1))
    found, overlap = merged[heads], np.diff(heads, append=len(merged))
    size = sizes[found]
    wanted = np.ceil(np.round(least * (n + size) / (1 + least), 9)).astype(np.int64)
    kept = (size >= least * n - 1e-9) & (n >= least * size - 1e-9)
    for left, held in zip(range(len(long_lists), -1, -1), [*long_lists, none], strict=True):
        kept &= overlap + left >= wanted
        if not kept.all():
            found, overlap, wanted = found[kept], overlap[kept], wanted[kept]
            kept = kept[kept]
        if not len(found):
            break
        if left:
            at = np.minimum(np.searchsorted(held, found), len(held) - 1)
            overlap = overlap + (held[at] == found)
    return found, overlap


class Inverted:
    """For each shingle the ascending positions of the sets that hold it, in three arrays."""

    def __init__(self, sets: list[np.ndarray]):
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.holders = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])[order]
        values = values[order]
        self.starts = np.flatnonzero(np.diff(values, prepend=values[:1] - 1))
        self.shingles = values[self.starts]
        self.ends = np.append(self.starts[1:], len(values))

    def shared(self, query: np.ndarray) -> list[np.ndarray]:
        """The lists of an indexed set's shingles that some other set holds too."""
        at = np.searchsorted(self.shingles, query)
        first, after = self.starts[at], self.ends[at]
        several = after - first > 1
        return [self.holders[a:b] for a, b in zip(first[several].tolist(), after[several].tolist(), strict=True)]


def _search_block(rows: list[tuple[int, int, int, np.ndarray]], least: float) -> list[tuple[int, int]]:
    """Links between components among (class, component, size, shingles); links that join nothing new are left out.

    Shingles that no other set holds may be missing: the size counts them.
    """
    _, label, members = np.unique([component for _, component, *_ in rows], return_inverse=True, return_counts=True)
    largest = members.argmax()
    index = Inverted([x for *_, x in rows])
    sizes, links = np.array([n for _, _, n, _ in rows]), []
    # a link between components has an end outside the largest one
    for k in np.flatnonzero(label != largest).tolist():
        cls, _, n, shingles = rows[k]
        apart = label != label[k]
        if not apart.any():
            continue
        found, _ = divide_skip(index.shared(shingles), n, sizes, least, apart)
        for position in found.tolist():
            if label[position] != label[k]:
                label[label == label[position]] = label[k]
                links.append((cls, rows[position][0]))
    return links


def connected(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id of each id's component; `links` has a and b, only linked ids appear.

    Labels fall to the smallest neighbour's and then to the label's own label,
    so long chains take a number of rounds that grows with the logarithm of their length.
    A large component meets at the id that most of its links lead to: the joins are salted.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("root")))
    while True:
        around = salted_join(both, labels.withColumnRenamed("id", "b"), ["b"], ["a"]).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(around, labels.id == around.a).select("id", "root", F.least("root", "near").alias("low"))
        own = lower.select(F.col("id").alias("low"), F.col("low").alias("_low"))
        now = stored(
            salted_join(lower, own, ["low"], ["id"], "left").select("id", F.least("low", "_low").alias("now"), "root")
        )
        discard(labels)
        if now.filter("now != root").isEmpty():
            discard(both)
            return now.select("id", "root")
        labels = now.select("id", F.col("now").alias("root"))


def _in_several(docs: DataFrame, width: int, least: float, common) -> np.ndarray:
    """A bitmap of the first shingles that stand in several classes."""

    def run(batches):
        for batch in batches:
            for _, sets in _sets(batch, 0, width):
                heads = [_prefix(x, common.value, least) if len(x) else x for x in sets]
                classes = np.repeat(np.array([_signature(x) for x in sets], dtype=np.int64), [len(h) for h in heads])
                yield pa.RecordBatch.from_arrays([pa.array(long(np.concatenate(heads))), pa.array(classes)], ["shingle", "cls"])

    lists = docs.mapInArrow(run, "shingle long, cls long")
    several = stored(lists.groupBy("shingle").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a < b").select("shingle"))
    found = bitmap(several, "shingle")
    discard(several)
    return found


def _described(docs: DataFrame, width: int, least: float, common, shared) -> DataFrame:
    """(doc, tie, n, cls, heads) of every row: the size of its set, the signature that equal sets share, and those of its first
    shingles that perhaps stand in another class."""

    def run(batches):
        for batch in batches:
            for part, sets in _sets(batch, 2, width):
                heads = [_prefix(x, common.value, least) if len(x) else x for x in sets]
                held = [long(h[perhaps(shared.value, h)]) for h in heads]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([_signature(x) for x in sets], pa.int64()),
                        pa.array(held, pa.list_(pa.int64())),
                    ],
                    ["doc", "tie", "n", "cls", "heads"],
                )

    return docs.mapInArrow(run, "doc long, tie long, n long, cls long, heads array<long>")


def _candidates(docs: DataFrame, width: int, wanted) -> DataFrame:
    """(cls, shingles) of the classes that `wanted`, a bitmap of signatures, perhaps holds."""

    def run(batches):
        for batch in batches:
            for _, sets in _sets(batch, 0, width):
                classes = np.array([_signature(x) for x in sets], dtype=np.int64)
                kept = np.flatnonzero(perhaps(wanted.value, classes.view(np.uint64))).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[kept]), pa.array([long(sets[k]) for k in kept], pa.list_(pa.int64()))], ["cls", "shingles"]
                )

    found = docs.mapInArrow(run, "cls long, shingles array<long>").filter(F.size("shingles") > 0)
    return found.groupBy("cls").agg(F.first("shingles").alias("shingles"))


def _levels(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """From (shingle, count): a bitmap of the shingles of several classes, and a table of the higher levels by leading bits."""
    level = sum((F.col("count") >= k).cast("int") for k in LEVELS)
    place = F.shiftrightunsigned("shingle", 64 - CELLS)
    cells = counts.filter(F.col("count") >= LEVELS[2]).groupBy(place.alias("place")).agg(F.max(level).alias("level")).toArrow()
    table = np.zeros(2**CELLS, dtype=np.uint8)
    table[cells["place"].to_numpy()] = cells["level"].to_numpy()
    return bitmap(counts, "shingle"), table


def _ranked(classes: DataFrame, levels, least: float) -> DataFrame:
    """(cls, n, shingles, heads): the size of each set, its shingles that others hold, and those of its first shingles that others hold.

    The order is by level, then by hash.  Sets whose first shingles are all their own are left out.
    """

    def run(batches):
        several, table = levels.value
        for batch in batches:
            column, out = batch.column(1), []
            values = column.flatten().to_numpy().view(np.uint64)
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            for cls, a, b in zip(batch.column(0).to_pylist(), ends, ends[1:], strict=False):
                held = perhaps(several, values[a:b])
                own, n = int((~held).sum()), int(b - a)
                first = _first(n, least) - own
                if first > 0:
                    shingles = values[a:b][held]
                    level = table[(shingles >> np.uint64(64 - CELLS)).astype(np.int64)]
                    out.append((cls, n, long(shingles), long(shingles[np.argsort(level, kind="stable")[:first]])))
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array([row[k] for row in out], pa.int64()) for k in (0, 1)],
                    *[pa.array([row[k] for row in out], pa.list_(pa.int64())) for k in (2, 3)],
                ],
                ["cls", "n", "shingles", "heads"],
            )

    return classes.mapInArrow(run, "cls long, n long, shingles array<long>, heads array<long>")


def _first_links(classes: DataFrame, postings: DataFrame, least: float) -> DataFrame:
    """(a, b): classes linked with the class before them with which they share most lists."""
    leaders = postings.groupBy("shingle").agg(F.min(F.struct("cls", "n")).alias("lead"))
    best = (
        postings.join(leaders, "shingle")
        .filter("lead.cls < cls")
        .filter((F.col("n") >= least * F.col("lead.n") - 1e-9) & (F.col("lead.n") >= least * F.col("n") - 1e-9))
        .groupBy("cls", F.col("lead.cls").alias("leader"))
        .count()
        .groupBy("cls")
        .agg(F.max(F.struct("count", "leader")).alias("best"))
        .select("cls", F.col("best.leader").alias("leader"))
    )
    own = classes.select("cls", "n", "shingles").join(stored(best), "cls")
    theirs = classes.select(F.col("cls").alias("leader"), F.col("n").alias("m"), F.col("shingles").alias("others"))
    overlap = F.size(F.array_intersect("shingles", "others"))
    return (
        own.join(theirs, "leader")
        .filter(overlap >= F.ceil(F.round(least * (F.col("n") + F.col("m")) / (1 + least), 9)))
        .select(F.col("leader").alias("a"), F.col("cls").alias("b"))
    )


def _common_firsts(n, m, least: float):
    """How many first shingles linked sets of n and m have in common at least: what overlap they need, less what can lie behind the first ones."""
    return F.ceil(F.round(least * (n + m) / (1 + least), 9)) - F.ceil(F.round(least * F.greatest(n, m), 9)) + 1


def _open_lists(postings: DataFrame, least: float) -> DataFrame:
    """(shingle, cls, n, component) of the lists that hold several components, without classes that can link with none there; stored.

    Of the sizes a class can link with in a list, the farthest from its own ask for the fewest common first shingles; a class that
    has fewer in all its lists leaves this one.
    """
    held = stored(postings)
    for _ in range(CLEARED):
        lists = held.groupBy("shingle").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("small"), F.max("n").alias("large")
        )
        n = F.col("n")
        near = F.greatest(F.col("small"), F.ceil(F.round(least * n, 9)))
        far = F.least(F.col("large"), F.floor(F.round(n / least, 9)))
        wanted = F.least(_common_firsts(n, near, least), _common_firsts(n, far, least))
        several = held.join(lists.filter("low != high"), "shingle").select(*held.columns, wanted.alias("wanted"))
        owned = several.groupBy("cls").agg(F.count("*").alias("owned"))
        cleared = stored(several.join(owned, "cls").filter("owned >= wanted").select(*held.columns))
        discard(held)
        held = cleared
    return held


def _further_links(classes: DataFrame, postings: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """(a, b): links between components, found in the lists that hold several."""
    components = postings.join(roots.withColumnRenamed("id", "cls"), "cls", "left")
    labelled = _open_lists(components.select("shingle", "cls", "n", F.coalesce("root", "cls").alias("component")), least)
    lists = labelled.groupBy("shingle").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min("cls").alias("lead"),
        F.count("*").alias("members"),
        F.sum(F.xxhash64("cls").cast("decimal(38, 0)")).alias("who"),
    )
    # lists of the same classes are one
    lists = lists.filter("low != high").groupBy("who", "members", "lead").agg(F.min("shingle").alias("shingle"))
    held = stored(labelled.join(lists, "shingle").select("cls", "component", "lead"))
    discard(labelled)
    around = connected(held.filter("cls != lead").select(F.col("lead").alias("a"), F.col("cls").alias("b")))
    placed = stored(
        held.select("cls", "component").distinct().join(around.withColumnRenamed("id", "cls"), "cls").join(classes.select("cls", "n", "shingles"), "cls")
    )
    sizes = placed.groupBy("root").agg(F.sum(F.size("shingles")).alias("total"))
    # a large neighbourhood is cut into parts, every two of which meet
    parts = F.ceil(F.col("total") / BLOCK).cast("int")
    dealt = (
        salted_join(placed.select("cls", "root"), sizes, ["root"], ["cls"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("cls", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    )

    def search(table: pa.Table) -> pa.Table:
        sets = table["shingles"].combine_chunks()
        values, ends = sets.values.to_numpy(), sets.offsets.to_numpy()
        rows = [
            (c, k, n, values[a:b])
            for c, k, n, a, b in zip(*[table[x].to_pylist() for x in ("cls", "component", "n")], ends, ends[1:], strict=False)
        ]
        links = _search_block(rows, least) if rows else []
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    met = placed.join(dealt, "cls").groupBy("root", "i", "j")
    found = stored(met.applyInArrow(search, "a long, b long").distinct())
    discard(held, placed)
    return found


def _grouped(rows: DataFrame, width: int, least: float) -> DataFrame:
    """(doc, tie, n, component) of rows (doc, tie, text); a component is a class or the root of linked ones, null without shingles."""
    context, texts = rows.sparkSession.sparkContext, rows.select("text")
    common = context.broadcast(_in_several(texts, width, least, context.broadcast(np.zeros(2 ** (BITS - 6), dtype=np.uint64))))
    shared = context.broadcast(_in_several(texts, width, least, common))
    described = stored(_described(rows, width, least, common, shared))
    classes = described.filter(F.size("heads") > 0).groupBy("cls").agg(F.first("n").alias("n"), F.first("heads").alias("heads"))
    able = _open_lists(classes.select(F.explode("heads").alias("shingle"), "cls", "n", F.col("cls").alias("component")), least)
    sets = stored(_candidates(texts, width, context.broadcast(bitmap(able.select("cls").distinct(), "cls"))))
    discard(able)
    counts = stored(sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count().filter(F.col("count") >= LEVELS[0]))
    classes = stored(_ranked(sets, context.broadcast(_levels(counts)), least))
    discard(sets, counts)
    postings = stored(classes.select(F.explode("heads").alias("shingle"), "cls", "n"))
    first = stored(_first_links(classes, postings, least))
    further = _further_links(classes, postings, connected(first), least)
    roots = connected(first.union(further))
    discard(classes, postings, first, further)
    joined = described.join(roots.withColumnRenamed("id", "cls"), "cls", "left")
    return joined.select("doc", "tie", "n", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("component"))


def near_duplicates(docs: DataFrame, width: int = 5, least: float = 0.75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id its links lead to, itself included).

    Texts are lower-cased (A-Z) and cut at the white space \\x20 and \\x09 to
    \\x0D; fewer than `width` words are one shingle.  Null texts and those without words
    have no shingles and are alone.  A null id is larger than all others and is the component only of
    rows without ids.  Repeated rows share a component; an empty table gives no rows; other columns are ignored.
    Shingles, and sets of equal size, are compared by 64-bit hashes.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(no_id_last(F.col("doc_id")).alias("doc"), F.lit(0).cast("long").alias("tie"), "text")
    joined = _grouped(rows, width, least)
    least_doc = joined.filter("n > 0").groupBy("component").agg(F.min("doc").alias("first"))
    given = F.when(F.col("doc") < 2**63 - 1, F.col("doc"))
    lead = F.coalesce("first", "doc")
    return joined.join(least_doc, "component", "left").select(
        given.cast(kind).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(lead < 2**63 - 1, lead).cast(kind).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = 5, least: float = 0.75) -> DataFrame:
    """Of each component the row with the smallest id, null last; rows without shingles all stay.

    Of rows that share an id inside a component, the one whose columns have the smallest hash stays; rows that
    are equal in every column are told apart by nothing and stay together.
    """
    own = [no_id_last(F.col("doc_id")).alias("_llm_doc"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_llm_tie")]
    rows = docs.select(*own, "text").toDF("doc", "tie", "text")
    joined = stored(_grouped(rows, width, least))
    kept = joined.filter("n > 0").groupBy("component").agg(F.min(F.struct("doc", "tie")).alias("first")).select("first.*")
    kept = kept.union(joined.filter("n = 0").select("doc", "tie")).toDF("_llm_doc", "_llm_tie")
    return docs.select("*", *own).join(kept, ["_llm_doc", "_llm_tie"], "left_semi").select(*[f"`{c}`" for c in docs.columns])
