"""Byte-level BPE encoding and decoding by DuckDB queries inside each partition.

Encoding: the pieces of a batch that are new to the worker become rows, one per
token (word, position, id), starting from single bytes.  A recursive query joins
neighbours with the table of merges and contracts each word's minimum-rank pair,
from the left, until no pair can be merged.  Decoding joins token rows with
the vocabulary and concatenates the bytes in order of position.

Nothing is shuffled; a worker holds one batch, two small tables and a bounded
cache of pieces.
"""

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Texts are encoded in groups of about so many characters, tokens decoded in groups of about so many rows.
CHARACTERS, TOKENS = 1_000_000, 250_000
#: Pieces a worker remembers; at this number it starts anew.
REMEMBERED = 500_000

# Letters, numbers and white space among the characters below U+02B0, for the quick form of the pattern.
_LETTERS, _NUMBERS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_QUICK = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
_BEYOND = re.compile(r"[^\x00-ʯ‐-‧€]")

_CONTRACT = """
WITH RECURSIVE step(round, pos, stop, id) AS (
  SELECT 0, pos, stop, id FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT a.pos, a.stop AS middle, b.stop, m.id, a.pos >> 32 AS word
     FROM step a JOIN step b ON b.pos = a.stop JOIN merges m ON m.pair = a.id::BIGINT * 4294967296 + b.id),
   best AS (SELECT word, min(id) AS id FROM pairs GROUP BY word),
   hits AS (SELECT pos, middle, stop, p.id FROM pairs p JOIN best b ON b.word = p.word AND b.id = p.id),
   overlapping AS (
     SELECT * FROM hits WHERE pos IN (SELECT middle FROM hits) OR middle IN (SELECT pos FROM hits)),
   runs AS (
     SELECT *, sum(head::INT) OVER (ORDER BY pos) AS run
     FROM (SELECT *, lag(middle, 1, -1) OVER (ORDER BY pos) <> pos AS head FROM overlapping)),
   -- of pairs that overlap, the first, third, ... are contracted: those that a walk from the left would take
   chosen AS (
     SELECT pos, middle, stop, id FROM hits
     WHERE pos NOT IN (SELECT middle FROM hits) AND middle NOT IN (SELECT pos FROM hits)
     UNION ALL
     SELECT pos, middle, stop, id
     FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY pos) AS k FROM runs) WHERE k % 2 = 1)
   SELECT (SELECT max(round) FROM step) + 1, s.pos, coalesce(c.stop, s.stop), coalesce(c.id, s.id)
   FROM step s SEMI JOIN best l ON l.word = s.pos >> 32 LEFT JOIN chosen c ON c.pos = s.pos
   WHERE s.pos NOT IN (SELECT middle FROM chosen))
)
SELECT step.pos >> 32 AS word, id
FROM step JOIN (SELECT pos >> 32 AS word, max(round) AS round FROM step GROUP BY 1) AS last
  ON last.word = step.pos >> 32 AND last.round = step.round
ORDER BY step.pos
"""

_DECODE = """
SELECT doc, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes, count(*) AS n
FROM tokens JOIN vocab USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class _Tables:
    """A DuckDB in the worker's own memory."""

    def __init__(self):
        import duckdb

        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})

    def _table(self, name: str, **columns) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")


class Encoder(_Tables):
    """The merges of one vocabulary, and the pieces the worker knows."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, quick: bool):
        super().__init__()
        self.pattern, self.quick, self.known = regex.compile(pattern), quick, {}
        pairs = [
            (ranks[token[:i]] * 2**32 + ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self._table("merges", pair=pa.array([p for p, _ in pairs], pa.int64()), id=pa.array([i for _, i in pairs], pa.int32()))
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.whole = ranks

    def pieces(self, text: str) -> list[str]:
        if self.quick and not _BEYOND.search(text):
            return _QUICK.findall(text)
        return self.pattern.findall(text)

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces that are not known yet; ids are remembered as the bytes of int32."""
        rest = []
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            if raw in self.whole:
                self.known[piece] = np.int32(self.whole[raw]).tobytes()
            else:
                rest.append((piece, raw))
        size = 0
        group: list[tuple[str, bytes]] = []
        for item in rest:
            group.append(item)
            size += len(item[1])
            if size >= 300_000:
                self._contract(group)
                group, size = [], 0
        if group:
            self._contract(group)

    def _contract(self, group: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(raw) for _, raw in group], dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        pos = np.repeat((np.arange(len(group), dtype=np.int64) << 32) - first, lengths) + np.arange(lengths.sum())
        ids = self.single[np.frombuffer(b"".join(raw for _, raw in group), dtype=np.uint8)]
        self.con.register("start", pa.table({"pos": pos, "stop": pos + 1, "id": ids}))
        found = self.con.sql(_CONTRACT).to_arrow_table()
        self.con.unregister("start")
        ids = found["id"].to_numpy()
        ends = np.searchsorted(found["word"].to_numpy(), np.arange(len(group) + 1))
        for (piece, _), a, b in zip(group, ends, ends[1:], strict=False):
            self.known[piece] = ids[a:b].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as the bytes of int32."""
        cut = [self.pieces(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.learn({piece for pieces in cut for piece in pieces}.difference(self.known))
        known = self.known
        return [b"".join([known[piece] for piece in pieces]) for pieces in cut]


class Decoder(_Tables):
    """The bytes of one vocabulary's tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self._table(
            "vocab", id=pa.array(ranks.values(), pa.int32()), hex=pa.array([token.hex() for token in ranks], pa.string())
        )

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The bytes of consecutive runs of ids."""
        out = [b""] * len(lengths)
        tokens = {"doc": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), "pos": np.arange(len(ids)), "id": ids}
        self.con.register("tokens", pa.table(tokens))
        rows = self.con.execute(_DECODE).fetchall()
        self.con.unregister("tokens")
        if sum(n for _, _, n in rows) != len(ids):
            raise ValueError("an id is not in the vocabulary")
        for doc, text, _ in rows:
            out[doc] = text
        return out


_OPEN: dict[tuple, _Tables] = {}


def _once(key: tuple, make):
    """One set of tables for each worker process and vocabulary."""
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = make()
    return _OPEN[key]


def _let_go() -> None:
    """Close what `_once` holds, so that a worker that goes on to other stages keeps no vocabulary."""
    for tables in _OPEN.values():
        tables.con.close()
    _OPEN.clear()


def _groups(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive groups of about `most` together."""
    first = total = last = 0
    for last, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield first, last
            first, total = last, 0
    if first < last:
        yield first, last


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: bool = True) -> DataFrame:
    """The rows of `docs` with `text` replaced by `ids` (array of int), as the tiktoken library encodes ordinary text.

    `path` is a rank file, read by the driver; its size bounds what is sent to
    the executors.  Null and empty texts give an empty array; repeated
    rows stay, other columns pass through, an empty table gives no rows.
    Workers keep the vocabulary and known pieces for their next task, unless `keep` is false.
    """
    import public_tokenizers

    shared, key = docs.sparkSession.sparkContext.broadcast(read_ranks(path)), (path, pattern)
    quick = pattern == public_tokenizers.PATTERN
    kept = [c for c in docs.columns if c not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _once(key, lambda: Encoder(shared.value, pattern, quick))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sizes = pa.compute.coalesce(pa.compute.utf8_length(column), 0).to_pylist()
            for a, b in _groups(sizes, CHARACTERS):
                part = batch.slice(a, b - a)
                found = coder.encode([t or "" for t in column.slice(a, b - a).to_pylist()])
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), dtype=np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], lists], [*kept, ids])
        if not keep:
            _let_go()

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept], f"`{ids}` array<int>"])
    return docs.select(*kept, text).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded", keep: bool = True) -> DataFrame:
    """The rows with `ids` replaced by `decoded` (binary), the tokens' bytes in order.

    A null array gives null, an empty one empty bytes; an id outside the
    vocabulary, or a null among the ids, is an error.  Other columns pass through.
    """
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept = [c for c in rows.columns if c not in (ids, decoded)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _once((path,), lambda: Decoder(shared.value))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            lengths = pa.compute.coalesce(pa.compute.list_value_length(column), 0).to_numpy()
            for a, b in _groups(lengths.tolist(), TOKENS):
                part = column.slice(a, b - a)
                flat = pa.compute.list_flatten(part)
                if flat.null_count:
                    raise ValueError("an id is null")
                found = coder.decode(flat.to_numpy().astype(np.int32), lengths[a:b])
                empty = pa.compute.is_null(part).to_pylist()
                out = pa.array([None if no else x for no, x in zip(empty, found, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in kept], out], [*kept, decoded])
        if not keep:
            _let_go()

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept], f"`{decoded}` binary"])
    return rows.select(*kept, ids).mapInArrow(run, schema)
