"""Token files against the tokenizers library, and the Elias-Fano coding by itself."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import by_key, clashing, documents, frame, odd_documents
from tidegauge.llm import token_binary as tb

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_whole_table(spark, library):
    start, want = 0, []
    for r in sorted(documents(spark).collect(), key=lambda r: r.doc_id):
        ids = encoded(library, r.text)
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert by_key(tb.token_files(documents(spark), PATH).collect()) == by_key(want)


def test_odd_rows_in_small_files(spark, library):
    rows = odd_documents()
    got = tb.token_files(clashing(frame(spark, rows)), PATH, file_ids=50).collect()
    ids = {(r[0], crc(encoded(library, r[1]))) for r in rows}
    assert len(got) == len(rows) and {(g.doc_id, g.ids_crc32) for g in got} == ids
    in_order = sorted(got, key=lambda g: g.start)
    assert [g.doc_id for g in in_order] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(in_order, in_order[1:])) and in_order[0].start == 0
    assert tb.token_files(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 511, 512, 513, 4000])
def test_elias_fano(n):
    random.seed(n)
    values = sorted(random.randint(-(10**6), 10 ** random.randint(1, 18)) for _ in range(n))
    coded, _ = tb.EliasFano.unpack(b"xx" + tb.EliasFano.of(values).pack(), 2)
    assert coded.all() == values and [coded.select(i) for i in range(n)] == values
    for at in {0, 1, 255, 511, 512, 513, n - 1, n} & set(range(n + 1)):
        for size in {0, 1, 2, 512, 513, 1500, n - at} & set(range(n - at + 1)):
            assert coded.slice(at, size) == values[at : at + size]
    with pytest.raises(IndexError):
        coded.select(n)


def test_boundaries_take_near_minimal_space():
    starts = np.cumsum(np.random.default_rng(1).integers(1, 2000, 50_000)).tolist()
    bits = 8 * tb.EliasFano.of(starts).nbytes() / len(starts)
    assert bits < np.log2(starts[-1] / len(starts)) + 2.6


def test_one_file_read_by_select():
    docs = [(None, np.array([5, 2])), (-3, np.array([2])), (7, np.arange(1000)), (7, np.array([], dtype=int))]
    data = tb.to_bytes(docs)
    opened = tb.IdFile(io.BytesIO(data), len(data))
    assert opened.doc_ids(0, 4) == [None, -3, 7, 7] and opened.doc_ids(1, 3) == [-3, 7] and opened.doc_ids(0, 1) == [None]
    assert opened.edges(0, 4).tolist() == [0, 2, 3, 1003, 1003] and opened.edges(1, 3).tolist() == [2, 3, 1003]
    assert [opened.document(i).tolist() for i in range(4)] == [d.tolist() for _, d in docs]
    with pytest.raises(ValueError):
        tb.IdFile(io.BytesIO(b"x" * 100), 100)


def test_pieces_join_to_the_same_ids(library):
    random.seed(1)
    letters = "abcdeABC019 .,'!<|>\n\té́ßΣ日本     \x1c\x85\xa0"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) + random.choice(["", "<|endoftext|>", " <|endoftext|> x"]) for _ in range(4000)]
    with open(PATH) as file:
        encoder = tb.PieceEncoder(file.read(), "<u2")
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == want


def test_reading_never_expands_all_boundaries(spark, library, monkeypatch):
    """Stretches of documents are found by select; files of many documents give what the library says."""
    monkeypatch.setattr(tb.EliasFano, "all", lambda self: pytest.fail("all boundaries at once"))
    rng = np.random.default_rng(2)
    docs = [(i, rng.integers(0, 50_000, rng.integers(1, 9))) for i in range(2000)]
    data = tb.to_bytes(docs)
    opened = tb.IdFile(io.BytesIO(data), len(data))
    at = 0
    for a in range(0, 2000, 700):
        edges = opened.edges(a, min(2000, a + 700))
        assert edges[0] == at and opened.doc_ids(a, a + 3) == [a, a + 1, a + 2]
        at = int(edges[-1])
    assert at == opened.n_ids


def test_equal_rows_spread_over_tasks(spark, library):
    """A third of all rows alike in id and text are not one task."""
    rows = [(7, "the same text again", None, None, 0)] * 1000 + [(i, f"text {i}", None, None, 0) for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = tb.write_files(frame(spark, rows).repartition(8), PATH, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r.n_docs for r in files.groupBy("part").sum("n_docs").toDF("part", "n_docs").collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000
