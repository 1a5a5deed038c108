"""Ranked lexical search over an index stratified by document length.

A document's length enters its scores only through the normaliser m, a whole number.  Documents of equal m are a
stratum; inside it a term's postings are ordered by falling tf, and the impact of a posting depends on tf alone,
so it is computed once for each tf.  The first posting of a term bounds what the term can add to any
document of the stratum; the sum of these bounds over a query's terms orders the strata to visit.
When the bound falls below the score of the k-th document found, no further stratum can matter.

Documents go to tasks in ranges of m, so that strata are whole but where one is hot; a task indexes
them in blocks of bounded size and gives its best k documents of each query.
Queries come in blocks of bounded size too, each sent to all tasks.
"""

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from trailmark.llm.hashing import no_id_last
from trailmark.llm.shared import stored

#: Documents, and postings, of one block of the index.
DOCUMENTS, POSTINGS = 16_384, 4_000_000
#: Distinct terms of the queries searched together, about.
TERMS = 100_000
#: Groups into which the winners of tasks are dealt before the last round.
SALTS = 32

# all ASCII but digits and letters separates; A-Z are lower-cased; other characters are kept byte by byte
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order; null has none."""
    return (text or "").encode().translate(_FOLDED).split()


def normaliser(n: str, documents: int, total: int, b: int = 90) -> Column:
    """m of a document of `n` terms (a column) among `documents` that hold `total` terms: 100 - b + (b * n * documents) div total."""
    return F.expr(f"{100 - b}L + (cast(`{n}` as decimal(38, 0)) * {b * documents}) div {max(total, 1)}")


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to the score, a whole number that rises with tf."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Queries:
    """A block of queries: the items, their terms' numbers, and the number of each term."""

    items: list
    terms: list[np.ndarray]
    numbers: dict[bytes, int]


def _block(rows: list) -> Queries:
    numbers: dict[bytes, int] = {}
    terms = [np.array([numbers.setdefault(bytes(t), len(numbers)) for t in r.terms], dtype=np.int64) for r in rows]
    return Queries([r.item for r in rows], terms, numbers)


def read_queries(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, terms array<binary>, place) stored: the distinct terms of each item that has one, in order of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item", "terms"])

    kind = items.schema[key].dataType.simpleString()
    terms = items.select(F.col(key).alias("item"), text).mapInArrow(run, f"item {kind}, terms array<binary>")
    return stored(terms.filter(F.size("terms") > 0).withColumn("place", F.monotonically_increasing_id()))


def _matched(docs: DataFrame, key: str, text: str, shared) -> DataFrame:
    """(at, n, terms, tfs) of all documents: the terms of the block of queries that they hold, by their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value.numbers
        for batch in batches:
            n, terms, tfs = [], [], []
            for t in batch.column(1).to_pylist():
                words = terms_of(t)
                held = Counter(map(numbers.get, words))
                held.pop(None, None)
                n.append(len(words))
                terms.append(list(held))
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                ["at", "n", "terms", "tfs"],
            )

    rows = docs.select(no_id_last(F.col(key)).alias("at"), text)
    return rows.mapInArrow(run, "at long, n long, terms array<int>, tfs array<int>")


class Strata:
    """The index of a block of documents: strata of equal m, and in each the postings of a term by falling tf."""

    def __init__(self, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int):
        """Document d has the postings terms[ends[d] : ends[d + 1]] and their tfs."""
        self.m, self.stratum = np.unique(m, return_inverse=True)
        self.members = np.bincount(self.stratum)
        holder = np.repeat(np.arange(len(m)), np.diff(ends))
        place = self.stratum[holder]
        order = np.lexsort((-tfs, place, terms))
        self.documents, tfs, self.place = holder[order], tfs[order], place[order]
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        # one impact for each stratum and tf
        pairs, which = np.unique(self.place.astype(np.int64) << 32 | tfs, return_inverse=True)
        self.impacts = impact(pairs & (2**32 - 1), self.m[pairs >> 32])[which]
        # where a term's postings in a stratum begin, the largest tf first
        heads = np.flatnonzero((np.diff(self.place, prepend=-1) != 0) | np.isin(np.arange(len(order)), self.starts))
        self.heads, self.head_starts = heads, np.searchsorted(heads, self.starts)

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each stratum the most that a document in it can score."""
        most = np.zeros(len(self.m), dtype=np.int64)
        for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
            first = self.heads[self.head_starts[t] : self.head_starts[t + 1]]
            most[self.place[first]] += w * self.impacts[first]
        return most

    def scores(self, terms: np.ndarray, weights: np.ndarray, visited: np.ndarray) -> np.ndarray:
        """For each document its score, 0 outside the strata marked in `visited`."""
        total = np.zeros(len(self.stratum), dtype=np.int64)
        for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
            a, b = self.starts[t], self.starts[t + 1]
            inside = visited[self.place[a:b]]
            # a term has one posting for each document
            total[self.documents[a:b][inside]] += w * self.impacts[a:b][inside]
        return total


def best(index: Strata, terms: np.ndarray, weights: np.ndarray, rank: np.ndarray, held: list, k: int) -> tuple[int, int]:
    """Add a block's documents to `held`, a heap of the k best (score, -rank, …) of one query; the strata visited, and all.

    `rank` orders documents of equal score, the smaller first.  Strata are visited by falling
    bound, in groups that double; equal bounds stay in, since a tie may win by its rank.
    """
    bounds = index.bounds(terms, weights)
    order = np.argsort(-bounds, kind="stable")
    order = order[bounds[order] > 0]
    at, wide = 0, 4
    while at < len(order) and (len(held) < k or bounds[order[at]] >= held[0][0]):
        visited = np.zeros(len(bounds), dtype=bool)
        group = order[at : at + wide]
        visited[group] = True
        total = index.scores(terms, weights, visited)
        near = np.flatnonzero(total >= max(held[0][0] if len(held) == k else 1, 1))
        # the k best of the group are enough
        near = near[np.lexsort((rank[near], -total[near]))[:k]]
        for d in near.tolist():
            entry = (int(total[d]), -int(rank[d]), d)
            if len(held) < k:
                heapq.heappush(held, entry)
            elif entry[:2] > held[0][:2]:
                heapq.heapreplace(held, entry)
        at, wide = at + wide, 2 * wide
    return min(at, len(order)), len(order)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows (at, m, terms, tfs) in blocks of at most DOCUMENTS rows and about POSTINGS postings."""
    rows: list[pa.RecordBatch] = []
    documents = postings = 0
    for batch in batches:
        sizes = np.concatenate([[0], np.cumsum(batch.column(2).value_lengths().to_numpy())])
        a = 0
        while a < batch.num_rows:
            fits = int(np.searchsorted(sizes, sizes[a] + POSTINGS - postings, side="right")) - 1
            after = min(fits, a + DOCUMENTS - documents, batch.num_rows)
            if after <= a and rows:
                yield pa.Table.from_batches(rows)
                rows, documents, postings = [], 0, 0
                continue
            after = max(after, a + 1)
            rows.append(batch.slice(a, after - a))
            documents += after - a
            postings += int(sizes[after] - sizes[a])
            a = after
    if rows:
        yield pa.Table.from_batches(rows)


def _winners(matched: DataFrame, shared, k: int, kind: str) -> DataFrame:
    """(query, item, at, score): the k best documents of each query in each task; rows come in ranges of m."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        held: list[list] = [[] for _ in queries.terms]
        for table in _blocks(batches):
            terms = table["terms"].combine_chunks()
            tfs = table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())])
            index = Strata(table["m"].to_numpy(), ends, terms.flatten().to_numpy(), tfs, len(weights))
            rank = table["at"].to_numpy()
            for own, found in zip(queries.terms, held, strict=True):
                best(index, own, weights[own], rank, found, k)
        rows = [(q, e[0], -e[1]) for q, found in enumerate(held) for e in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([q for q, *_ in rows], pa.int32()),
                pa.array([queries.items[q] for q, *_ in rows], batch_type),
                pa.array([at for *_, at in rows], pa.int64()),
                pa.array([s for _, s, _ in rows], pa.int64()),
            ],
            ["query", "item", "at", "score"],
        )

    batch_type = to_arrow_type(kind)
    return matched.mapInArrow(run, StructType([StructField("query", IntegerType()), StructField("item", kind), StructField("at", LongType()), StructField("score", LongType())]))


def _top(rows: DataFrame, by: list[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "at"))
    return rows.withColumn("rank", place).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """The k documents of highest positive score for each item: item, rank (from 1), key, score.

    Terms are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z lower-cased.
    `key` is a whole number; equal scores are ordered by it, null last.  Null and empty
    texts have no terms: such documents are found by no item and count for nothing, such items have no
    rows.  Rows of one key are documents of their own, rows of one item queries of their
    own.  Other columns are ignored; an empty table on either side gives an empty result.
    """
    kind = items.schema[item].dataType
    context = docs.sparkSession.sparkContext
    queries = read_queries(items, item, item_text)
    blocks = max(1, -(-(queries.agg(F.sum(F.size("terms")).alias("n")).first().n or 0) // TERMS))
    parts = []
    for b in range(blocks):
        block = _block(queries.filter(F.pmod(F.xxhash64("place"), F.lit(blocks)) == b).orderBy("place").collect())
        matched = stored(_matched(docs, key, text, context.broadcast(block)))
        known = matched.agg(F.sum((F.col("n") > 0).cast("long")).alias("documents"), F.sum("n").alias("terms")).first()
        documents, total = known.documents or 0, known.terms or 0
        df = np.zeros(len(block.numbers), dtype=np.int64)
        for r in matched.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r.t] = r["count"]
        weights = np.array([weight(documents, int(x)) for x in df], dtype=np.int64)
        placed = matched.filter(F.size("terms") > 0).select("at", normaliser("n", documents, total).alias("m"), "terms", "tfs")
        # a hot stratum is cut by the hash
        ranged = placed.repartitionByRange("m", F.xxhash64("at")).sortWithinPartitions("m", "at")
        found = _winners(ranged, context.broadcast((block, weights)), k, kind)
        salted = _top(found, [F.col("query"), F.pmod(F.xxhash64("at"), F.lit(SALTS))], k)
        parts.append(stored(_top(salted.drop("rank"), [F.col("query")], k)))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionAll(more)
    doc = F.when(F.col("at") < 2**63 - 1, F.col("at")).cast(docs.schema[key].dataType)
    return rows.select(F.col("item").alias(item), "rank", doc.alias(key), "score")
