"""Benchmark decontamination over a distributed positional inverted index.

Training text is tokenised once into index segments: for each term of a segment the sorted
list of its positions. A phrase is looked up by taking the list of its rarest term, shifting
it by that term's offset in the phrase, and intersecting it with the shifted lists of the
next rarer terms until nothing or only exact occurrences are left. Segments hold whole
documents, so the index is spread by documents: no term, however frequent, is one list.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pads
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegauge.functions.columns import quoted
from tidegauge.llm.common import bound_batches, kept, let_go, open_folder, pick, stage, unused
from tidegauge.session import scratch_dir

#: Bytes of text per index segment; a longer document is a segment by itself.
SEGMENT_BYTES = 4 << 20
#: Bytes of benchmark text looked up in one pass over the index.
QUERY_BYTES = 4 << 20
#: Words of a contamination window.
WINDOW = 10

# word bytes are digits, letters (A-Z lower-cased) and everything beyond ASCII
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


def index_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("segment", T.LongType()),
        T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("terms", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("positions", T.BinaryType()),
    ])


@dataclass
class Segment:
    """Documents on their way into one index row."""

    ids: list = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    spelled: list[np.ndarray] = field(default_factory=list)
    n_bytes: int = 0

    def __post_init__(self) -> None:
        self.terms: defaultdict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__  # a new word gets the next number

    def add(self, doc_id, text: str | None) -> None:
        words = words_of(text)
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.spelled.append(np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words)))
        self.n_bytes += len(text) if text else 0

    def row(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1).compress
        spelled = np.concatenate(self.spelled)
        positions = np.argsort(spelled, kind="stable").astype("<i4")  # by term, then by place
        counts = np.bincount(spelled, minlength=len(self.terms)).astype("<i4")
        values = [
            number, self.ids, self.sizes, pack(b" ".join(self.terms)), pack(counts.tobytes()),
            pack(np.diff(positions, prepend=np.int32(0)).tobytes()),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """The positional index, a row per segment, written to the shared folder.

    ``ids`` and ``sizes`` (words) list its documents; ``terms``, ``counts`` and ``positions``
    are the posting lists, compressed: the terms in order of appearance, the length of
    each list, and the differences of all positions, list after list.
    """
    bound_batches(docs.sparkSession)
    chosen = pick(docs, doc_id=id_col, text=text_col)
    schema = index_schema(chosen.schema["doc_id"].dataType)
    arrow_schema = to_arrow_schema(schema)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        first = TaskContext.get().partitionId() << 32
        n, segment = 0, Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if segment.ids and segment.n_bytes >= segment_bytes:
                    yield segment.row(first + n, arrow_schema)
                    n, segment = n + 1, Segment()
                segment.add(doc_id, text.as_py())
        if segment.ids:
            yield segment.row(first + n, arrow_schema)

    return stage(chosen.mapInArrow(segments, schema), "positional-index")


class Postings:
    """One index row, opened."""

    def __init__(self, sizes: list[int], terms: bytes, counts: bytes, positions: bytes) -> None:
        unpack = zstandard.ZstdDecompressor().decompress
        self.ends = np.cumsum(np.array(sizes, dtype=np.int64))
        self.starts = self.ends - np.array(sizes, dtype=np.int64)
        self.numbers = {term: i for i, term in enumerate(unpack(terms).split(b" "))} if len(sizes) else {}
        self.counts = np.frombuffer(unpack(counts), "<i4")
        self.positions = np.cumsum(np.frombuffer(unpack(positions), "<i4"), dtype=np.int32)
        self.offsets = np.r_[0, np.cumsum(self.counts, dtype=np.int64)]

    def list_of(self, number: int) -> np.ndarray:
        return self.positions[self.offsets[number] : self.offsets[number + 1]]

    def document_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")

    def phrase(self, numbers: np.ndarray) -> np.ndarray:
        """Places where the terms stand one after the other inside one document."""
        rarest = np.argsort(self.counts[numbers], kind="stable")
        found = self.list_of(numbers[rarest[0]]) - rarest[0]
        for offset in rarest[1:]:
            if not len(found):
                return found
            there, wanted = self.list_of(numbers[offset]), found + offset
            at = np.searchsorted(there, wanted)
            at[at == len(there)] = 0
            found = found[there[at] == wanted]
        found = found[found >= 0]
        return found[found + len(numbers) <= self.ends[self.document_of(found)]] if len(found) else found

    def near(self, numbers: np.ndarray, span: int) -> list[tuple[int, int]]:
        """Stretches of at most ``span`` words of one document that hold all the terms and start and end with one.

        Of the stretches with one start only the shortest is told.
        """
        wanted, times = np.unique(numbers, return_counts=True)
        rarest = wanted[np.argmin(self.counts[wanted])]
        anchors = self.list_of(rarest).astype(np.int64)
        places, owners = [], []
        for number in wanted:
            there = self.list_of(number)
            at = np.searchsorted(anchors, there - span + 1)
            close = (at < len(anchors)) & (anchors[np.minimum(at, len(anchors) - 1)] < there.astype(np.int64) + span)
            places.append(there[close])
            owners.append(np.full(int(close.sum()), number))
        order = np.argsort(np.concatenate(places), kind="stable")
        place, owner = np.concatenate(places)[order], np.concatenate(owners)[order]
        document = self.document_of(place)
        need = dict(zip(wanted.tolist(), times.tolist()))
        have: dict[int, int] = dict.fromkeys(need, 0)
        missing, end, out = len(numbers), 0, []
        for start in range(len(place)):
            while missing and end < len(place):
                term = int(owner[end])
                missing -= have[term] < need[term]
                have[term] += 1
                end += 1
            if missing:
                break
            if place[end - 1] - place[start] < span and document[start] == document[end - 1]:
                out.append((int(place[start]), int(place[end - 1]) + 1))
            term = int(owner[start])
            have[term] -= 1
            missing += have[term] < need[term]
        return out


@dataclass
class Queries:
    """Distinct phrases of a block, and the benchmark items each stands for."""

    terms: dict[bytes, int] = field(default_factory=dict)
    phrases: list[tuple[list[int], list[str]]] = field(default_factory=list)

    def add(self, phrase: bytes, items: list[str]) -> None:
        self.phrases.append(([self.terms.setdefault(w, len(self.terms)) for w in phrase.split(b" ")], items))

    def present(self, postings: Postings) -> Iterator[tuple[np.ndarray, list[str]]]:
        """Phrases of which every term occurs in the segment, with the segment's term numbers."""
        own = np.array([postings.numbers.get(t, -1) for t in self.terms], dtype=np.int64)
        for phrase, items in self.phrases:
            numbers = own[phrase]
            if numbers.min() >= 0:
                yield numbers, items


@dataclass(frozen=True)
class PhraseBlocks:
    """Where the phrases of a benchmark lie in the shared folder, and the numbers of their blocks."""

    folder: str
    numbers: list[int]

    def open(self, number: int) -> Queries:
        """A block as a task reads it; a worker keeps the last one."""

        def read() -> Queries:
            system, root = open_folder(f"{self.folder}/block={number}")
            block = Queries()
            for batch in pads.dataset(root, filesystem=system, format="parquet").to_batches(columns=["phrase", "items"]):
                for phrase, items in zip(batch.column("phrase").to_pylist(), batch.column("items").to_pylist()):
                    block.add(phrase, items)
            return block

        return kept(("phrases", self.folder, number), read)


def phrase_blocks(benchmark: DataFrame, window: int | None, block_bytes: int) -> PhraseBlocks:
    """The distinct phrases of a benchmark (``item_id``, ``text``) with their items, dealt out to blocks by a hash.

    Tasks cut the items into windows (whole items where ``window`` is null, or the item is
    shorter); a block holds the windows of about ``block_bytes`` of text. The driver learns
    the blocks' numbers only.
    """
    spark = benchmark.sparkSession

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple[bytes, str | None]] = []
        for batch in batches:
            for item, text in zip(batch["item_id"], batch["text"]):
                words = words_of(text)
                size = min(window or len(words), len(words))
                for at in range(len(words) - size + 1 if size else 0):
                    found.append((b" ".join(words[at : at + size]), item))
                    if len(found) >= 10_000:
                        yield pd.DataFrame(found, columns=["phrase", "item"])
                        found = []
        if found:
            yield pd.DataFrame(found, columns=["phrase", "item"])

    n = max(1, -(-(benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    phrases = benchmark.mapInPandas(cut, "phrase binary, item string").groupBy("phrase").agg(F.collect_set("item").alias("items"))
    folder = scratch_dir(spark, "phrases")
    dealt = phrases.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(n))).repartition("block")
    dealt.write.partitionBy("block").parquet(folder)
    stored = spark.read.schema("phrase binary, items array<string>, block long").parquet(folder)
    return PhraseBlocks(folder, sorted(r["block"] for r in stored.select("block").distinct().collect()))


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Sorted disjoint spans that cover the same places."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    return list(zip(starts[cut].tolist(), ends[np.r_[cut[1:] - 1, len(ends) - 1]].tolist()))


HITS = "segment long, place int, spans array<struct<low:long,high:long>>, items array<string>"


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Postings]]:
    for batch in batches:
        for row in range(batch.num_rows):
            part = batch.slice(row, 1).to_pydict()
            sizes = part["sizes"][0]
            yield part["segment"][0], Postings(sizes, part["terms"][0], part["counts"][0], part["positions"][0])


def _postings(index: DataFrame) -> DataFrame:
    return index.select("segment", "sizes", "terms", "counts", "positions")


def phrase_hits(index: DataFrame, blocks: PhraseBlocks, block: int) -> DataFrame:
    """Per document with occurrences of a block's phrases: the word spans they cover and the items they come from."""
    schema = T._parse_datatype_string(HITS)
    arrow_schema = to_arrow_schema(schema)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, postings in _open(batches):
            spans, items = defaultdict(list), defaultdict(set)
            for numbers, of in blocks.open(block).present(postings):
                found = postings.phrase(numbers).astype(np.int64)
                for document in np.unique(postings.document_of(found)).tolist():
                    low, high = postings.starts[document], postings.ends[document]
                    here = found[(found >= low) & (found < high)] - low
                    spans[document].append((here, here + len(numbers)))
                    items[document].update(of)
            for document, parts in spans.items():
                covered = merged(np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]))
                row = [[number], [document], [[{"low": a, "high": b} for a, b in covered]], [list(items[document])]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, arrow_schema)], schema=arrow_schema)

    return _postings(index).mapInArrow(look_up, schema)


def _texts(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return pick(benchmark, item_id=item_col, text=text_col).select(F.col("item_id").cast("string"), "text")


def contamination(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = QUERY_BYTES,
                  item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per indexed document (``segment``, ``place``): its id, words, hits and items.

    A null item id counts as a match of the words but is in no list of items; repeated items
    count once. An empty benchmark hits nothing. The phrases of a benchmark are looked up in
    all segments block by block; tasks read a block from the shared folder.
    """
    blocks = phrase_blocks(_texts(benchmark, item_col, text_col), window, block_bytes)
    passes = [phrase_hits(index, blocks, block) for block in blocks.numbers]
    hits = reduce(DataFrame.union, passes, index.sparkSession.createDataFrame([], HITS))
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda done, span: F.struct(
            (done["n"] + F.greatest(F.lit(0), span["high"] - F.greatest(span["low"], done["upto"]))).alias("n"),
            F.greatest(done["upto"], span["high"]).alias("upto"),
        ),
        lambda done: done["n"],
    )
    per_document = (
        hits.groupBy("segment", "place")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        .select("segment", "place", covered.alias("n_hit"), F.array_sort("items").alias("items"))
    )
    documents = index.select("segment", F.posexplode(F.arrays_zip("ids", "sizes"))).select(
        "segment", F.col("pos").alias("place"), F.col("col.ids").alias("doc_id"), F.col("col.sizes").alias("n_words")
    )
    none = F.array().cast("array<string>")
    return documents.join(per_document, ["segment", "place"], "left").select(
        "segment", "place", "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )


def contaminated_documents(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    segment_bytes: int = SEGMENT_BYTES, block_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Per document: words, hit words, matched items, their digest, and whether any word is hit.

    A null or empty text has no words and is clean. Repeated rows and null ids are reported
    as often as they occur; texts of any length are read whole; an empty table gives an empty
    result; other columns of either table are not looked at.
    """
    found = contamination(build_index(docs, id_col, text_col, segment_bytes), benchmark, window, block_bytes)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, all columns as they are.

    Null, empty and wordless texts are clean; repeated rows stay or go together; an empty
    table stays empty, and an empty benchmark leaves all rows.

    Whether a row goes depends on its text alone, so rows are told apart by the digest of
    their text, and only the digests of contaminated texts are joined.
    """
    digest, text = unused(docs, "digest"), F.col(quoted(text_col))
    marked = docs.withColumn(digest, F.sha2(text.cast("binary"), 256))
    found = contamination(build_index(marked, digest, text_col), benchmark, window)
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("_hit")).distinct()
    return marked.join(hit, marked[digest] == hit["_hit"], "left_anti").drop(digest)


def proximity_matches(
    index: DataFrame, benchmark: DataFrame, slop: int, block_bytes: int = QUERY_BYTES,
    item_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """Where all words of an item stand together, in any order, with at most ``slop`` other words between them.

    ``doc_id``, ``item_id``, ``low``, ``high``: word places in the document, the end exclusive;
    per start the shortest stretch. Items without words match nothing.
    """
    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("item_id", T.StringType()),
        T.StructField("low", T.LongType()), T.StructField("high", T.LongType()),
    ])
    arrow_schema = to_arrow_schema(schema)

    blocks = phrase_blocks(_texts(benchmark, item_col, text_col), None, block_bytes)

    def pass_over(block: int) -> DataFrame:
        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("ids").to_pylist()
                for row, (_, postings) in enumerate(_open(iter([batch]))):
                    out = []
                    for numbers, items in blocks.open(block).present(postings):
                        for low, high in postings.near(numbers, len(numbers) + slop):
                            document = int(postings.document_of(np.array([low]))[0])
                            base = int(postings.starts[document])
                            out += [(ids[row][document], item, low - base, high - base) for item in items]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v, f.type) for v, f in zip(zip(*out), arrow_schema)], schema=arrow_schema
                        )

        return index.mapInArrow(look_up, schema)

    return reduce(DataFrame.union, map(pass_over, blocks.numbers), index.sparkSession.createDataFrame([], schema))
