"""Scores of texts by a hidden Markov language model.

Tokens are the words of the lower-cased text (A-Z) and one end.  Word counts over all training texts give each
word its base probability.  Latent states emit word classes: the commonest words have a class of their own, the others
share one by their last three bytes; inside a class words keep their base proportions, and each shared class has room for one
unknown word.  Baum-Welch trains the states: tasks add up expected counts of moves and emissions, the cluster sums
them over all tasks, the driver divides.  The likelihood of a text is the exact sum over all paths.

Long texts are cut into spans for the recursion only, so that spans of many texts advance side by side and no text is
shortened.  Spans of the same number wait for those before them; the spans of very long texts do not: products of their
matrices carry the forward vector over them.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import stored

#: Words with a class of their own, the end among them, and classes of endings for all others.
OWN, ENDINGS = 6_144, 2_048
#: Commonest words whose counts are sent to all tasks; counts of the others are joined.
SENT = 131_072
#: Longer words are counted by a digest, so that tables of words have a bounded size.
WIDE = 64
#: Distinct words that a task counts before it passes them on.
HELD = 400_000
#: Bytes of the texts that are cut into words at a time.
PIECE = 4_000_000
#: Tokens of a span of the recursion, and of the spans that advance together.
SPAN, TOGETHER = 512, 131_072
#: Spans of a text up to which each waits for the one before it; those of longer texts are joined by products.
IN_TURN = 64
#: Added to each count of the base distribution.
LEAST = 0.1

_END = b""


def pieces(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about PIECE bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
    part = (np.cumsum(sizes) - sizes) // PIECE
    cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), batch.num_rows]
    for begin, end in pairwise(cuts):
        yield batch.slice(begin, end - begin)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts end to end, lower-cased (A-Z), and how many each has; null has none."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, sizes = split.flatten().cast(pa.binary()), split.value_lengths().to_numpy()
    whole = pc.greater(pc.binary_length(flat), 0)  # white space at a text's ends leaves empty words
    upto = np.concatenate([[0], np.cumsum(whole.to_numpy(zero_copy_only=False))])
    return flat.filter(whole), np.diff(upto[np.concatenate([[0], np.cumsum(sizes)])])


def narrowed(words: pa.Array) -> pa.Array:
    """The words, long ones by their digest."""
    wide = pc.greater(pc.binary_length(words), WIDE)
    digests = [b"\xff" + sha256(w).digest() for w in words.filter(wide).to_pylist()]
    return pc.replace_with_mask(words, wide, pa.array(digests, pa.binary())) if digests else words


def ending(word: bytes, endings: int) -> int:
    return crc32(word[-3:]) % endings


def endings_of(words: pa.Array, endings: int) -> np.ndarray:
    """``ending`` of each word."""
    last = pc.binary_slice(words, -3).dictionary_encode()
    of = np.array([ending(w, endings) for w in last.dictionary.to_pylist()], dtype=np.int32)
    return of[last.indices.to_numpy()]


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word binary, n): how often each token stands in all texts, stored."""

    def summed(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for piece in pieces(batch, 0):
                counted = pc.value_counts(words_of(piece.column(0))[0])
                held.append(pa.table([narrowed(counted.field("values")), counted.field("counts")], ["word", "n"]))
                held.append(pa.table([pa.array([_END], pa.binary()), pa.array([piece.num_rows], pa.int64())], ["word", "n"]))
                if sum(t.num_rows for t in held) >= 2 * HELD:
                    held = [summed(held)]
                    if held[0].num_rows >= HELD:
                        yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()

    return stored(docs.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))


@dataclass
class Vocabulary:
    """What tasks need of the word counts: the commonest words in order, their counts, and the base mass of each class.

    `words` is the whole table of counts, `tokens` and `types` are its sums.
    Class 0 is the end, the classes below `own` are the next words, the others are endings.
    """

    words: DataFrame
    tokens: int
    types: int
    common: list[bytes]
    counts: np.ndarray
    mass: np.ndarray
    own: int

    @property
    def endings(self) -> int:
        return len(self.mass) - self.own

    @property
    def total(self) -> float:
        return self.tokens + LEAST * (self.types + 1)


def vocabulary(words: DataFrame, own: int = OWN, endings: int = ENDINGS, sent: int = SENT) -> Vocabulary:
    """Of a table of word counts; `sent` words at most, `own` of them with a class of their own, go to the driver and all tasks.

    They are all words of the largest counts: a histogram of counts tells from which count on they are few enough.
    """
    known = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).first()
    tokens, types = known.tokens or 0, known.types
    rest = words.filter(F.length("word") > 0)
    # counts are told apart by their twelve leading bits, so that the histogram stays small
    low = F.greatest(F.floor(F.log2("n")).cast("int") - 11, F.lit(0))
    edge = F.expr("n") - F.pmod(F.col("n"), F.pow(F.lit(2.0), low).cast("long"))
    found, held = None, 0
    for r in sorted(rest.groupBy(edge.alias("edge")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r.edge):
        held += r.words
        if held >= sent:
            break
        found = r.edge
    top = sorted(rest.filter(F.col("n") >= found).collect() if found else [], key=lambda r: (-r.n, r.word))
    end = words.filter(F.length("word") == 0).first()
    common = [_END, *[bytes(r.word) for r in top]]
    counts = np.array([end.n if end else 0, *[r.n for r in top]], dtype=np.int64)
    mass = np.full(own + endings, LEAST)
    mass[: len(counts[:own])] += counts[:own]
    mass[len(counts) : own] = 0
    by_ending = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(endings))
    for r in rest.groupBy(by_ending.cast("int").alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        mass[own + r.e] += r.n + LEAST * r.types
    for word, n in zip(common[1:own], counts[1:own].tolist(), strict=True):
        mass[own + ending(word, endings)] -= n + LEAST
    # sums of tenths: what is left without words is the room for one unknown word
    mass[own:] = np.maximum(mass[own:], LEAST)
    return Vocabulary(words, tokens, types, common, counts, mass / (tokens + LEAST * (types + 1)), own)


def encode(docs: DataFrame, known: Vocabulary, text: str = "text") -> DataFrame:
    """The columns of `docs` but the text, with row, n_tokens, n_sent, base_sent, classes, rare, times; stored.

    n_sent and base_sent hold what the words sent to all tasks add to the known tokens and to the base score; `rare`
    and `times` are the other distinct words and how often they stand in the text.
    """
    kept = [f for f in docs.schema if f.name != text]
    names = [*[f.name for f in kept], "row", "n_tokens", "n_sent", "base_sent", "classes", "rare", "times"]
    shared = docs.sparkSession.sparkContext.broadcast((known.common, known.counts, known.total, known.own, known.endings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts, total, own, endings = shared.value
        logs = np.log10((counts + LEAST) / total)
        common = pa.array(common, pa.binary())
        for batch in batches:
            at_text = batch.schema.get_field_index(text)
            for piece in pieces(batch, at_text):
                words, sizes = words_of(piece.column(at_text))
                coded = words.dictionary_encode()
                kinds, kind = narrowed(coded.dictionary), coded.indices.to_numpy()
                place = pc.fill_null(pc.index_in(kinds, common), -1).to_numpy()
                of_kind = np.where((place >= 0) & (place < own), place, own + endings_of(kinds, endings)).astype(np.int32)
                texts = np.repeat(np.arange(len(sizes)), sizes)
                ends = np.concatenate([[0], np.cumsum(sizes + 1)])
                codes = np.zeros(ends[-1], dtype=np.int32)  # the end's class is 0
                codes[np.arange(len(kind)) + texts] = of_kind[kind]
                at = place[kind]
                sent, n = at >= 0, len(sizes)
                n_sent = np.bincount(texts[sent], weights=counts[at[sent]] > 0, minlength=n).astype(np.int64) + int(counts[0] > 0)
                base = np.bincount(texts[sent], weights=logs[at[sent]], minlength=n) + logs[0]
                pairs, times = np.unique(texts[~sent] * max(1, len(kinds)) + kind[~sent], return_counts=True)
                in_text, rare = np.divmod(pairs, max(1, len(kinds)))
                cuts = pa.array(np.searchsorted(in_text, np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[piece.column(piece.schema.get_field_index(c)) for c in names[: len(kept) + 1]],  # with row
                        pa.array(sizes + 1, pa.int64()),
                        pa.array(n_sent),
                        pa.array(base),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes)),
                        pa.ListArray.from_arrays(cuts, kinds.take(pa.array(rare))),
                        pa.ListArray.from_arrays(cuts, pa.array(times, pa.int32())),
                    ],
                    names,
                )

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    types += ["row long, n_tokens long, n_sent long, base_sent double, classes array<int>, rare array<binary>, times array<int>"]
    return stored(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, ", ".join(types)))


@dataclass
class States:
    """start[s] is the chance of state s before the first token, moves[r, s] that of a step, emission[s, c] relative to the base mass of class c."""

    start: np.ndarray
    moves: np.ndarray
    emission: np.ndarray


def first_states(mass: np.ndarray, states: int, seed: int = 7, stay: float = 0.9) -> States:
    """States that differ by chance in what they emit and mostly stay."""
    noise = np.exp(np.random.default_rng(seed).normal(size=(states, len(mass))))
    noise /= noise @ (mass / mass.sum())[:, None]
    moves = np.full((states, states), (1 - stay) / states) + np.eye(states) * stay
    return States(np.full(states, 1 / states), moves / moves.sum(axis=1, keepdims=True), noise / mass.sum())


class Spans:
    """The spans of several texts, laid end to end as in `ends`, with the recursion in numbers of `kind`."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray, states: States, kind=np.float64):
        self.codes, self.k, self.kind = codes, len(states.start), kind
        self.moves, self.by_class = states.moves.astype(kind), np.ascontiguousarray(states.emission.T, dtype=kind)
        sizes = np.diff(ends)
        spans = -(-sizes // SPAN)
        self.first_of = np.cumsum(spans) - spans  # the number of each text's first span
        self.spans, self.text = spans, np.repeat(np.arange(len(sizes)), spans)
        number = np.arange(spans.sum()) - self.first_of[self.text]
        in_turn = spans[self.text] <= IN_TURN
        self.turn = np.where(in_turn, number, 0)
        self.followed = in_turn & (number + 1 < spans[self.text])
        self.begin = ends[:-1][self.text] + number * SPAN
        self.length = np.minimum(SPAN, ends[1:][self.text] - self.begin)
        self.before = np.tile(states.start.astype(kind), (len(self.text), 1))
        self.after = np.ones((len(self.text), self.k), dtype=kind)
        self._carry()

    def groups(self, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Spans, longest first, in groups of about TOGETHER tokens; and for each step how many are not yet at their end."""
        wanted = wanted[np.argsort(-self.length[wanted], kind="stable")]
        while len(wanted):
            group = wanted[: max(1, TOGETHER // int(self.length[wanted[0]]))]
            wanted = wanted[len(group) :]
            yield group, np.searchsorted(-self.length[group], -np.arange(self.length[group[0]]), side="left")

    def emitted(self, group: np.ndarray, steps: int) -> np.ndarray:
        """(step, span, state): what is emitted at each step; past a span's end the values have no meaning."""
        at = np.minimum(self.begin[group][None, :] + np.arange(steps)[:, None], len(self.codes) - 1)
        return self.by_class[self.codes[at]]

    def _carry(self) -> None:
        """Vectors before and after each span of the texts of more than IN_TURN, by the products of their spans."""
        several = np.flatnonzero(self.spans[self.text] > IN_TURN)
        if not len(several):
            return
        products = np.empty((len(several), self.k, self.k), dtype=self.kind)
        place = np.searchsorted(several, np.arange(len(self.text) + 1))
        for group, active in self.groups(several):
            emitted, held = self.emitted(group, len(active)), np.tile(np.eye(self.k, dtype=self.kind), (len(group), 1, 1))
            other = np.empty_like(held)
            for step, n in enumerate(active.tolist()):
                moved = other[:n]
                np.matmul(held[:n].reshape(-1, self.k), self.moves, out=moved.reshape(-1, self.k))
                np.multiply(moved, emitted[step, :n, None, :], out=held[:n])
                if step % 4 == 3:
                    held[:n] /= held[:n].sum(axis=(1, 2), keepdims=True)
            products[place[group]] = held / held.sum(axis=(1, 2), keepdims=True)
        texts = np.flatnonzero(self.spans > IN_TURN)
        texts = texts[np.argsort(-self.spans[texts], kind="stable")]
        for number in range(1, int(self.spans[texts[0]])):
            now = self.first_of[texts[self.spans[texts] > number]] + number
            moved = np.einsum("ni,nij->nj", self.before[now - 1], products[place[now - 1]])
            self.before[now] = moved / moved.sum(axis=1, keepdims=True)
        for number in range(int(self.spans[texts[0]]) - 1, 0, -1):
            now = self.first_of[texts[self.spans[texts] > number]] + number
            back = np.einsum("nij,nj->ni", products[place[now]], self.after[now])
            self.after[now - 1] = back / back.sum(axis=1, keepdims=True)

    def _forward(self, group, active, emitted):
        reached = np.zeros_like(emitted)
        scale = np.ones(emitted.shape[:2], dtype=self.kind)
        now, every = self.before[group], np.ones(self.k, dtype=self.kind)
        for step, n in enumerate(active.tolist()):
            here = reached[step, :n]
            np.matmul(now[:n], self.moves, out=here)
            here *= emitted[step, :n]
            np.matmul(here, every, out=scale[step, :n])
            here /= scale[step, :n, None]
            now = here
        return reached, scale

    def _pass_on(self, group: np.ndarray, reached: np.ndarray) -> None:
        """Let the spans that wait for those of `group` begin where they end."""
        on = np.flatnonzero(self.followed[group])
        self.before[group[on] + 1] = reached[self.length[group[on]] - 1, on]

    def turns(self) -> list[np.ndarray]:
        """The spans by their turn."""
        order = np.argsort(self.turn, kind="stable")
        return np.split(order, np.cumsum(np.bincount(self.turn))[:-1]) if len(order) else []

    def likelihoods(self) -> np.ndarray:
        """The natural logarithm of each text's likelihood, relative to the base masses of its classes."""
        found = np.zeros(len(self.spans))
        for spans in self.turns():
            for group, active in self.groups(spans):
                reached, scale = self._forward(group, active, self.emitted(group, len(active)))
                self._pass_on(group, reached)
                np.add.at(found, self.text[group], np.log(scale).sum(axis=0))
        return found

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often, in expectation, a text starts in each state, each move is made, each state emits each class."""
        start, moves, emission = np.zeros(self.k), np.zeros((self.k, self.k)), np.zeros(self.by_class.T.shape)
        turns = self.turns()
        for spans in turns:
            for group, active in self.groups(spans[self.followed[spans]]):
                self._pass_on(group, self._forward(group, active, self.emitted(group, len(active)))[0])
        for group, active in (found for spans in reversed(turns) for found in self.groups(spans)):
            emitted = self.emitted(group, len(active))
            reached, scale = self._forward(group, active, emitted)
            last = reached[self.length[group] - 1, np.arange(len(group))]
            share = 1 / (last * self.after[group]).sum(axis=1)
            returning = np.ascontiguousarray(self.moves.T)
            back, backs, ahead = self.after[group].copy(), np.zeros_like(emitted), np.zeros_like(emitted)
            for step in range(len(active) - 1, -1, -1):
                n = active[step]
                backs[step, :n] = back[:n]
                here = ahead[step, :n]
                np.multiply(emitted[step, :n], back[:n], out=here)
                here /= scale[step, :n, None]
                np.matmul(here, returning, out=back[:n])
            waiting = np.flatnonzero(self.turn[group])
            self.after[group[waiting] - 1] = back[waiting] / back[waiting].sum(axis=1, keepdims=True)
            held = reached * backs * share[None, :, None]
            inside = np.arange(len(active))[:, None] < self.length[group][None, :]
            codes = self.codes[(self.begin[group][None, :] + np.arange(len(active))[:, None])[inside]]
            for s, weights in enumerate(np.ascontiguousarray(held[inside].T)):
                emission[s] += np.bincount(codes, weights=weights, minlength=emission.shape[1])
            opening = self.first_of[self.text[group]] == group
            start += (self.before[group] * back * share[:, None])[opening].sum(axis=0)
            earlier = np.concatenate([self.before[group][None], reached[:-1]]).reshape(-1, self.k)
            moves += earlier.T @ (ahead * share[None, :, None]).reshape(-1, self.k)
        return start, moves * self.moves, emission


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists without nulls, end to end, and where each list begins and ends."""
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).astype(np.int64)


def _summed(encoded: DataFrame, states: States) -> States | None:
    """Expected counts of all texts: each task's sums as cells (state, cell), added up by the cluster.

    The driver gets states * (classes + states + 1) numbers, whatever the number of texts.
    """
    k, classes = states.emission.shape
    shared = encoded.sparkSession.sparkContext.broadcast(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, classes + k + 1))
        for batch in batches:
            # single precision is enough for expected counts, which are summed in double; scores are in double throughout
            start, moves, emission = Spans(*_flat(batch.column(0)), shared.value, np.float32).expected()
            total += np.concatenate([emission, moves, start[:, None]], axis=1)
        state, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(state.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(total[state, cell])], ["state", "cell", "v"]
        )

    found = encoded.select("classes").mapInArrow(run, "state int, cell int, v double").groupBy("state", "cell").agg(F.sum("v").alias("v")).toArrow()
    if not found.num_rows:
        return None
    total = np.zeros((k, classes + k + 1))
    total[found["state"].to_numpy(), found["cell"].to_numpy()] = found["v"].to_numpy()
    return States(total[:, -1], total[:, classes:-1], total[:, :classes])


def train(encoded: DataFrame, mass: np.ndarray, states: int = 8, rounds: int = 5, prior: float = 500.0) -> States:
    """Baum-Welch over all texts of `encoded`, `rounds` passes.

    Each state's emissions are drawn to the base masses as if it had emitted `prior` tokens of
    them, and each move and start counts once more than expected.  Without texts the first states stay.
    """
    found = first_states(mass, states)
    for _ in range(rounds):
        sums = _summed(encoded, found)
        if sums is None:
            return found
        emission = sums.emission + prior * mass / mass.sum()
        emission /= emission.sum(axis=1, keepdims=True)
        found = States(
            (sums.start + 1) / (sums.start + 1).sum(),
            (sums.moves + 1) / (sums.moves + 1).sum(axis=1, keepdims=True),
            np.divide(emission, mass, out=np.zeros_like(emission), where=mass > 0),
        )
    return found


def _base_of_rare(encoded: DataFrame, known: Vocabulary) -> DataFrame:
    """(row, n_rare, base_rare): what the words that were not sent add, by a join with all counts."""
    pairs = encoded.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("p"))
    pairs = pairs.select("row", F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    joined = pairs.join(known.words, "word", "left")
    return joined.groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).cast("long").alias("n_rare"),
        F.sum(F.col("times") * F.log10((n + LEAST) / known.total)).alias("base_rare"),
    )


def judge(encoded: DataFrame, known: Vocabulary, states: States) -> DataFrame:
    """The rows of `encoded` with n_tokens, n_known, base_score and score in place of what it adds."""
    own = [f for f in encoded.schema if f.name not in ("n_sent", "base_sent", "classes", "rare", "times")]
    kept = [*own, encoded.schema["n_sent"], encoded.schema["base_sent"]]
    shared = encoded.sparkSession.sparkContext.broadcast(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, ends = _flat(batch.column(len(kept)))
            gain = Spans(codes, ends, shared.value).likelihoods() / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(gain)], [*batch.schema.names[: len(kept)], "gain"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    gains = encoded.select(*[f"`{f.name}`" for f in kept], "classes").mapInArrow(run, ", ".join([*types, "gain double"]))
    base = F.col("base_sent") + F.coalesce("base_rare", F.lit(0.0))
    return gains.join(stored(_base_of_rare(encoded, known)), "row", "left").select(
        *[f.name for f in own if f.name not in ("row", "n_tokens")],
        "n_tokens",
        (F.col("n_sent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        base.alias("base_score"),
        (base + F.col("gain")).alias("score"),
    )


def score_documents(
    docs: DataFrame, learn: Column, states: int = 8, rounds: int = 5, own: int = OWN, endings: int = ENDINGS, sent: int = SENT
) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all rows for which `learn` is true (null is false).  base_score sums the logarithms to base 10 of
    the words' base probabilities, (c + 0.1) / (N + 0.1 * (V + 1)) for a word that stands c times among the N
    training tokens of V kinds; `score` is the logarithm of the text's probability in the hidden Markov model.
    Null and empty texts consist of the end alone.  Repeated rows count and come out each; a
    null id stays null; other columns are ignored.  Without training texts all words are unknown; an
    empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    known = vocabulary(count_words(rows.filter("learn")), own, endings, sent)
    encoded = encode(rows, known)
    trained = train(encoded.filter("learn"), known.mass, states, rounds)
    return judge(encoded, known, trained).select(
        "doc_id", "n_tokens", "n_known", F.lit(known.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
