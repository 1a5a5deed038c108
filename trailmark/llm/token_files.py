"""Token ids in Arrow files of equal-length sequences that can be mapped into memory.

Documents are ordered by id, encoded, ended by `end` and laid end to end.  Each
task writes the stretch of its range as one Arrow IPC file whose batches hold
`ids` (fixed_size_list of uint16, or uint32 for a large vocabulary) and `mask`
(fixed_size_list<bool>, false where the last sequence is padded), and beside it an
index file (doc_id, first, n_tokens).
A sequence is found by its number alone and read without a copy.
"""

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmark.llm.shared import stored

#: Sequences in one record batch.
BATCH = 128
#: Texts are encoded in groups of about so many characters; a worker remembers so many pieces.
CHARACTERS, REMEMBERED = 3_000_000, 500_000

# Letters, numbers and white space among the characters below U+0180.
_LETTERS, _NUMBERS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_BEYOND = re.compile(r"[^\x00-ſ‐-‧€]")


class Encoder:
    """A tokenizer of the tokenizers library.

    If it lower-cases, drops white space and cuts by the pattern below, texts of
    Latin letters are cut here and each distinct piece is encoded by the
    library once; all other texts go to the library as they are, also those
    that may hold an added token, such as <|endoftext|>.
    """

    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PIECES = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
    )

    def __init__(self, definition: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        described = json.loads(definition)
        # an added token is found in the text as it is or in the normalized one, hence in any case here
        added = [x["content"] for x in described.get("added_tokens") or [] if x["content"]]
        self.added = re.compile("|".join(r"\s+".join(map(re.escape, re.split(r"\s+", x))) for x in added), re.I) if added else None
        steps = [x["type"] for x in (described.get("normalizer") or {}).get("normalizers", [])]
        cuts = [
            (x.get("pattern", {}).get("Regex"), x.get("behavior"), x.get("invert"))
            for x in (described.get("pre_tokenizer") or {}).get("pretokenizers", [])
        ]
        self.quick = steps == ["NFC", "Replace", "Lowercase"] and cuts[:1] == [(self.SPLIT, "Removed", True)]
        self.size = self.tokenizer.get_vocab_size()
        self.known: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _by_pieces(self, text: str) -> bool:
        return self.quick and not _BEYOND.search(text) and not (self.added and self.added.search(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        cut = [self.PIECES.findall(t.lower()) if self._by_pieces(t) else None for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({p for pieces in cut if pieces for p in pieces}.difference(self.known))
        self.known.update(zip(new, self._library(new), strict=True))
        known = self.known
        whole = iter(self._library([t for t, pieces in zip(texts, cut, strict=True) if pieces is None]))
        return [next(whole) if pieces is None else b"".join([known[p] for p in pieces]) for pieces in cut]


_ENCODERS: dict[int, Encoder] = {}


def _encoder(definition: str) -> Encoder:
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


class _Writer:
    """One file of sequences and its index, under other names until both are whole."""

    INDEX = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])

    def __init__(self, folder: str, name: str, length: int, vocabulary: int):
        self.system, root = fs.FileSystem.from_uri(folder)
        self.system.create_dir(root, recursive=True)
        self.length = length
        self.names = [f"{root}/{name}.arrow", f"{root}/{name}.index.arrow"]
        self.drafts = [f"{root}/.{name}-{uuid.uuid4().hex}-{k}" for k in range(2)]
        self.type = np.dtype("<u2" if vocabulary <= 2**16 else "<u4")
        ids = pa.from_numpy_dtype(self.type)
        tokens = pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.streams = [self.system.open_output_stream(d) for d in self.drafts]
        self.writers = [ipc.new_file(s, t) for s, t in zip(self.streams, (tokens, self.INDEX), strict=True)]
        self.waiting, self.size, self.total, self.docs = [], 0, 0, 0

    def add(self, doc_ids: pa.Array, encoded: list[bytes]) -> None:
        lengths = np.array([len(x) // 4 for x in encoded], dtype=np.int64)
        first = self.total + np.cumsum(lengths) - lengths
        self.writers[1].write_batch(pa.record_batch([doc_ids, pa.array(first), pa.array(lengths)], schema=self.INDEX))
        self.total += int(lengths.sum())
        self.docs += len(encoded)
        self.waiting.extend(encoded)
        self.size += int(lengths.sum())
        if self.size >= BATCH * self.length:
            flat = np.frombuffer(b"".join(self.waiting), dtype="<u4")
            full = len(flat) // (BATCH * self.length) * BATCH * self.length
            for k in range(0, full, BATCH * self.length):
                self._write(flat[k : k + BATCH * self.length], BATCH * self.length)
            self.waiting, self.size = [flat[full:].tobytes()], len(flat) - full

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids.astype(self.type), mask)]
        self.writers[0].write_batch(pa.record_batch(columns, names=["ids", "mask"]))

    def close(self) -> None:
        flat = np.frombuffer(b"".join(self.waiting), dtype="<u4")
        if len(flat):
            self._write(np.pad(flat, (0, -len(flat) % self.length)), len(flat))
        for part in (*self.writers, *self.streams):
            part.close()
        for draft, name in zip(self.drafts, self.names, strict=True):
            self.system.move(draft, name)


def write_token_files(docs: DataFrame, definition: str, folder: str, end: int = 1, length: int = 2048) -> DataFrame:
    """Encode the texts and write them in ascending order of doc_id; returns the table of files.

    `definition` is a tokenizer in the JSON form of the tokenizers library.  The
    result has one row per file: shard, path, index_path, docs, sequences,
    n_tokens, first (tokens in all files before it).  It is stored, so that
    files are written once; a task that is run again writes the same file anew
    and only then takes its place.  `folder` must be a place that all executors
    reach, by a path or URI that pyarrow.fs can open.

    Null and empty texts give the end id alone; a null doc_id comes first; rows that
    repeat an id are ordered by text; no rows, no files; other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batches = (b for b in batches if b.num_rows)
        opening = next(batches, None)
        if opening is None:
            return
        shard, encoder = TaskContext.get().partitionId(), _encoder(shared.value)
        writer, stop = _Writer(folder, f"part-{shard:06d}", length, max(end + 1, encoder.size)), np.array([end], dtype="<u4").tobytes()
        for batch in chain([opening], batches):
            texts = batch.column(1)
            sizes = np.cumsum(pa.compute.coalesce(pa.compute.utf8_length(texts), 0).to_numpy() + 1) // CHARACTERS
            for k in np.unique(sizes):
                a, b = np.searchsorted(sizes, [k, k + 1])
                ids = encoder.encode([t or "" for t in texts.slice(a, b - a).to_pylist()])
                writer.add(batch.column(0).slice(a, b - a), [x + stop for x in ids])
        writer.close()
        sequences = -(-writer.total // length)
        values = [[shard], [writer.names[0]], [writer.names[1]], [writer.docs], [sequences], [writer.total]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["shard", "path", "index_path", "docs", "sequences", "n_tokens"])

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    files = stored(
        ordered.mapInArrow(
            run, "shard long, path string, index_path string, docs long, sequences long, n_tokens long"
        )
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


class TokenFile:
    """Random access to the sequences of one file; of a local file nothing is copied."""

    def __init__(self, path: str):
        local = path.removeprefix("file://")
        if local.startswith("/"):
            self.reader = ipc.open_file(pa.memory_map(local))
        else:
            system, inner = fs.FileSystem.from_uri(path)
            self.reader = ipc.open_file(system.open_input_file(inner))

    def batch(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and masks of one batch, as rows of equal length; masks are unpacked from bits."""
        batch = self.reader.get_batch(number)
        return tuple(c.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in batch.columns)

    def __getitem__(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the mask of a sequence; all batches but the last hold BATCH of them."""
        ids, mask = self.batch(number // BATCH)
        return ids[number % BATCH], mask[number % BATCH]

    def tokens(self) -> Iterator[np.ndarray]:
        """The ids of each batch in order, without padding."""
        for number in range(self.reader.num_record_batches):
            ids, mask = self.batch(number)
            yield ids.ravel()[: int(mask.sum())].astype("<u4")


def read_token_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The documents in the files: doc_id, start (tokens of all documents before), n_tokens, ids.

    `ids` is binary: little-endian unsigned 32-bit numbers with the end id.  One
    task reads one file, batch after batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids"]
        for row in (r for b in batches for r in b.to_pylist()):
            index = TokenFile(row["index_path"]).reader
            stream, held, offset = TokenFile(row["path"]).tokens(), np.empty(0, dtype="<u4"), 0
            for number in range(index.num_record_batches):
                rows = index.get_batch(number)
                first, counts = rows.column(1).to_numpy(), rows.column(2).to_numpy()
                parts, size, begun = [], 0, 0
                for k, (a, n) in enumerate(zip(first.tolist(), counts.tolist(), strict=True)):
                    pieces = [held[a - offset : a - offset + n]]
                    while (missing := n - sum(map(len, pieces))) > 0:
                        offset, held = offset + len(held), next(stream)
                        pieces.append(held[:missing])
                    parts.append(b"".join(p.tobytes() for p in pieces))
                    size += n
                    if size > 1_000_000 or k + 1 == len(counts):
                        span = slice(begun, k + 1)
                        columns = [rows.column(0)[span], first[span] + row["first"], counts[span], pa.array(parts, pa.binary())]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                        parts, size, begun = [], 0, k + 1

    # a number of parts that is asked for is not put together again: each file has a task
    dealt = files.select("index_path", "path", "first").repartitionByRange(max(1, files.count()), "first", "path")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
