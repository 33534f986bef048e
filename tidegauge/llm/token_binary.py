"""Token-id files with Elias-Fano coded document boundaries.

A file holds the ids of consecutive documents back to back, two bytes each where the
vocabulary allows it, then two Elias-Fano sequences (where each document starts, and the
documents' ids) and a footer. An Elias-Fano sequence stores the low bits of each value as
they are and the high bits in unary, about ``2 + log2(universe / n)`` bits per value; every
512th set bit's place is noted, and a select reads on from there. There is no table of
64-bit offsets. Files are listed in a small table which is written last: a file of a lost
attempt is never listed.
"""

from __future__ import annotations

import io
import json
import pathlib
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm.common import bound_batches, kept, open_folder, pick, stage
from tidegauge.session import scratch_dir

MAGIC = b"TGIDSEF1"
#: Ids per file at most (a longer document has a file by itself), ids read at a time.
FILE_IDS, READ_IDS = 16 << 20, 1 << 20
#: Set bits between two noted places.
SAMPLE = 512
#: Pieces of text a worker remembers, and characters it encodes at a time.
REMEMBERED, AT_ONCE = 700_000, 4 << 20
#: New pieces the library encodes as one text.
TOGETHER = 200
FOOTER = "<QQBB6x8s"  # ids, bytes of the tail, bytes per id, format version, magic


class EliasFano:
    """A sequence of ascending integers below ``universe``."""

    def __init__(self, n: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.base, self.low_bits = n, base, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: list[int]) -> EliasFano:
        base, n = (values[0] if values else 0), len(values)
        shifted = np.array([v - base for v in values], dtype=np.uint64)
        top = int(shifted[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        width = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((shifted[:, None] >> width) & np.uint64(1)).astype(np.uint8), bitorder="little")
        places = (shifted >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[places] = 1
        return cls(n, base, low_bits, low, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def _low(self, at: int, n: int) -> np.ndarray:
        """The low bits of ``n`` values from position ``at`` on."""
        first, last = at * self.low_bits, (at + n) * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : -(-last // 8)], bitorder="little")[first % 8 :][: last - first]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return bits.reshape(n, self.low_bits).astype(np.uint64) @ weights if self.low_bits else np.zeros(n, np.uint64)

    def select(self, i: int) -> int:
        """Value ``i``, read from the nearest noted place on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        left += int(self.high[byte] & ((1 << place % 8) - 1)).bit_count()  # set bits before it in its byte
        while (here := int(self.high[byte]).bit_count()) <= left:
            left -= here
            byte += 1
        bit = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))[left]
        return self.base + ((8 * byte + int(bit) - i) << self.low_bits | int(self._low(i, 1)[0]))

    def slice(self, at: int, n: int) -> list[int]:
        """The ``n`` values from position ``at`` on, read between noted places."""
        if not 0 <= at <= at + n <= self.n:
            raise IndexError(at)
        if not n:
            return []
        first, last = at // SAMPLE, (at + n - 1) // SAMPLE + 1
        byte = int(self.samples[first]) // 8
        stop = int(self.samples[last]) // 8 + 1 if last < len(self.samples) else len(self.high)
        # set bits before the first value: of the noted byte, and of the values before it
        skip = int(self.high[byte] & ((1 << int(self.samples[first]) % 8) - 1)).bit_count() + at - first * SAMPLE
        places = 8 * byte + np.flatnonzero(np.unpackbits(self.high[byte:stop], bitorder="little"))[skip : skip + n]
        high = (places - np.arange(at, at + n)).astype(np.uint64) << np.uint64(self.low_bits)
        return [self.base + v for v in (high | self._low(at, n)).tolist()]

    def all(self) -> list[int]:
        return self.slice(0, self.n)

    def pack(self) -> bytes:
        head = struct.pack("<QqBQQQ", self.n, self.base, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def unpack(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, base, low_bits, *sizes = struct.unpack_from("<QqBQQQ", data, at)
        at += struct.calcsize("<QqBQQQ")
        parts = []
        for kind, size in zip(("u1", "u1", "<u4"), sizes):
            parts.append(np.frombuffer(data, kind, size, at))
            at += parts[-1].nbytes
        return cls(n, base, low_bits, *parts), at

    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes + self.samples.nbytes


class PieceEncoder:
    """Whole texts through the tokenizers library, each distinct piece once while remembered.

    A byte-level pre-tokenizer always starts a token at a space that something other than
    white space follows, so the ids of a text are those of its pieces cut before such spaces.
    """

    _cut = regex.compile(r" (?=\S)").split
    _uncut = regex.compile(r" \s").search

    def __init__(self, spec: str, width: str) -> None:
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = width
        self.first: dict[str, bytes] = {}  # pieces at the start of a text
        self.known: dict[str, bytes] = {}  # pieces behind a space
        names = self.tokenizer.get_vocab()
        added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        #: bytes of text a token stands for; its name has a letter for each
        self.spans = np.zeros(max(names.values(), default=0) + 1, np.int64)
        self.spans[list(names.values())] = [added.get(i, len(name)) for name, i in names.items()]

    def _pieces(self, text: str) -> list[str]:
        """The text cut before spaces, without the spaces it was cut at."""
        return self._cut(text) if self._uncut(text) else text.split(" ")

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        block: list[list[str]] = []
        n = 0
        for text in texts:
            block.append(self._pieces(text) if text else [])
            n += len(text) if text else 0
            if n >= AT_ONCE:
                yield from self._block(block)
                block, n = [], 0
        yield from self._block(block)

    def _block(self, block: list[list[str]]) -> Iterator[bytes]:
        self.first = self._learn(self.first, {pieces[0] for pieces in block if pieces}, "", 1)
        self.known = self._learn(self.known, set().union(*[pieces[1:] for pieces in block]), " ", TOGETHER)
        known = self.known.__getitem__
        for pieces in block:
            yield self.first[pieces[0]] + b"".join(map(known, pieces[1:])) if pieces else b""

    def _learn(self, known: dict[str, bytes], needed: set[str], before: str, together: int) -> dict[str, bytes]:
        if len(known) > REMEMBERED:
            known = {p: known[p] for p in needed if p in known}
        new = list(needed.difference(known))
        for at in range(0, len(new), 50_000):
            part = [before + p for p in new[at : at + 50_000]]
            texts = ["".join(part[i : i + together]) for i in range(0, len(part), together)]
            made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype=self.width) for e in made])
            # a piece ends where the bytes of its text end
            reached = np.cumsum(self.spans[ids])
            ends = np.cumsum([len(p.encode()) for p in part])
            stops = np.searchsorted(reached, ends, side="right")
            if (np.r_[0, reached][stops] != ends).any():
                raise ValueError("a token reaches over a space: not a byte-level vocabulary")
            packed, edges = ids.tobytes(), [0, *(stops * ids.itemsize).tolist()]
            known.update((p, packed[a:b]) for p, a, b in zip(new[at : at + 50_000], edges, edges[1:]))
        return known


def ending(starts: list[int], ids: list[int | None], n_ids: int, width: int) -> bytes:
    """What follows the token ids in a file: nulls among the documents, both sequences, the footer."""
    named = [i for i in ids if i is not None]
    body = struct.pack("<Q", len(ids) - len(named)) + EliasFano.of(starts).pack() + EliasFano.of(named).pack()
    return body + struct.pack(FOOTER, n_ids, len(body), width, 1, MAGIC)


class IdFile:
    """A file opened for reading; ``source`` needs ``seek`` and ``read``."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        footer = struct.calcsize(FOOTER)
        source.seek(size - footer)
        self.n_ids, tail_bytes, self.width, version, magic = struct.unpack(FOOTER, source.read(footer))
        if magic != MAGIC or version != 1:
            raise ValueError("not a token-id file")
        source.seek(size - footer - tail_bytes)
        data = source.read(tail_bytes)
        self.nulls = struct.unpack_from("<Q", data)[0]
        self.starts, at = EliasFano.unpack(data, 8)
        self.names, _ = EliasFano.unpack(data, at)

    @property
    def n_docs(self) -> int:
        return self.starts.n

    def doc_ids(self, at: int, stop: int) -> list[int | None]:
        """The ids of documents ``at`` to ``stop``; ascending, nulls first."""
        nulls = min(stop, self.nulls) - min(at, self.nulls)
        return [None] * nulls + self.names.slice(max(0, at - self.nulls), stop - at - nulls)

    def edges(self, at: int, stop: int) -> np.ndarray:
        """Where documents ``at`` to ``stop`` start, and where the last of them ends."""
        if stop < self.n_docs:
            return np.array(self.starts.slice(at, stop + 1 - at), dtype=np.int64)
        return np.array([*self.starts.slice(at, stop - at), self.n_ids], dtype=np.int64)

    def span(self, i: int) -> tuple[int, int]:
        """Where document ``i`` starts and ends, counted in ids, by two selects."""
        return self.starts.select(i), self.starts.select(i + 1) if i + 1 < self.starts.n else self.n_ids

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``."""
        self.source.seek(start * self.width)
        return np.frombuffer(self.source.read((stop - start) * self.width), f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        return self.read(*self.span(i))


def write_files(
    docs: DataFrame, vocabulary_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    folder: str | None = None, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode and write all documents in ascending order of their ids; the table of files.

    ``file`` (path), ``part``, ``turn`` (its place among the files), ``n_docs``, ``n_ids``.
    Ids are range-partitioned, so every task writes a stretch of the order; documents with
    one id are ordered by a hash of their text, and copies by their place in ``docs``, so that no
    number of equal rows is one task. Null ids come first, null texts count as empty.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = folder or scratch_dir(spark, "token-ids")
    raw = pathlib.Path(vocabulary_path).read_text()
    spec = json.loads(raw)
    last = max(*spec["model"]["vocab"].values(), *[t["id"] for t in spec["added_tokens"]], end_id)
    width = "<u2" if last < 1 << 16 else "<u4"
    shipped = spark.sparkContext.broadcast(raw)
    end = np.array([end_id], dtype=width).tobytes()
    ordered = (
        pick(docs, doc_id=id_col, text=text_col)
        .select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
        .repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place").select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encoder = TaskContext.get(), _encoder(shipped.value, width)
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        turn, out = 0, None
        names: list = []
        starts: list[int] = []
        n_ids = 0

        def close() -> pa.RecordBatch:
            out.write(ending(starts, names, n_ids, int(width[-1])))
            out.close()
            row = [name, task.partitionId(), turn, len(names), n_ids]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["file", "part", "turn", "n_docs", "n_ids"])

        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                size = len(ids) // int(width[-1]) + 1
                if out is not None and n_ids + size > file_ids:
                    yield close()
                    turn, out = turn + 1, None
                if out is None:
                    name = f"{root}/part-{task.partitionId():06d}-{turn:04d}-{uuid.uuid4().hex}.ids"
                    out, names, starts, n_ids = system.open_output_stream(name), [], [], 0
                names.append(doc_id)
                starts.append(n_ids)
                out.write(ids + end)
                n_ids += size
        if out is not None:
            yield close()

    files = ordered.mapInArrow(write, "file string, part long, turn long, n_docs long, n_ids long")
    return stage(files.select("*", F.lit(folder).alias("folder")), "token-files")


def _encoder(raw: str, width: str) -> PieceEncoder:
    return kept(("pieces", hash(raw), width), lambda: PieceEncoder(raw, width))


def with_starts(files: DataFrame, per_bin: int = 4096) -> DataFrame:
    """The table of files with ``base``: the ids in all files before. Running sums within bins of parts, and over bins."""
    binned = files.withColumn("bin", F.floor(F.col("part") / per_bin))
    inside = Window.partitionBy("bin").orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("bin").agg(F.sum("n_ids").alias("n")).select("bin", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    return (
        binned.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(bins, "bin")
        .select(*files.columns, (F.col("inside") + F.col("before")).alias("base"))
    )


def read_files(files: DataFrame, per_document: Callable[[np.ndarray], dict], schema: str, read_ids: int = READ_IDS) -> DataFrame:
    """Read listed files back: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, and what a function of the ids says.

    The starts come from the boundaries in the files; ids are read a stretch of whole
    documents at a time.
    """
    spark = files.sparkSession
    n = files.count()
    tasks = max(1, min(n, max(200, 4 * spark.sparkContext.defaultParallelism)))
    arrow = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, _ = open_folder(row["folder"])
                with system.open_input_file(row["file"]) as source:
                    opened = IdFile(source, source.size())
                    at = 0
                    while at < opened.n_docs:
                        # boundaries between two noted places, then as many documents as are read at a time
                        edges = opened.edges(at, min(at + SAMPLE, opened.n_docs))
                        n = max(1, int(np.searchsorted(edges, edges[0] + read_ids, side="right")) - 1)
                        edges = edges[: n + 1]
                        ids = opened.read(int(edges[0]), int(edges[-1]))
                        said = [per_document(ids[a:b]) for a, b in zip(edges - edges[0], edges[1:] - edges[0])]
                        columns = {
                            "doc_id": opened.doc_ids(at, at + n), "start": (edges[:-1] + row["base"]).tolist(), "n_tokens": np.diff(edges).tolist(),
                        } | {k: [s[k] for s in said] for k in said[0]}
                        yield pa.RecordBatch.from_arrays([pa.array(v, arrow.get(k)) for k, v in columns.items()], names=list(columns))
                        at += n

    return files.repartition(tasks, "file").mapInArrow(read, f"doc_id long, start long, n_tokens long, {schema}")


def crc_of_ids(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def token_files(docs: DataFrame, vocabulary_path: str, end_id: int = 2, **settings) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` per row of ``docs``, read back from the written files.

    Every document has its end id, so a null or empty text has one token. Null ids come first
    in the order; repeated ids follow each other, ordered by a hash of their texts; texts of any
    length are encoded whole; an empty table writes no file and gives an empty result.
    """
    return read_files(with_starts(write_files(docs, vocabulary_path, end_id, **settings)), crc_of_ids, "ids_crc32 long")


def to_bytes(documents: Iterable[tuple[int | None, np.ndarray]], width: str = "<u2") -> bytes:
    """One file in memory, for documents in order."""
    out, names, starts, n_ids = io.BytesIO(), [], [], 0
    for doc_id, ids in documents:
        names.append(doc_id)
        starts.append(n_ids)
        out.write(ids.astype(width).tobytes())
        n_ids += len(ids)
    out.write(ending(starts, names, n_ids, int(width[-1])))
    return out.getvalue()
