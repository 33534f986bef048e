"""Small tables with everything that is odd, and plain-Python versions of shared rules."""

from __future__ import annotations

import zlib

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977} the" for i in range(60_000))
    same = "The quick brown fox jumps over the lazy dog and runs far away from all of them"
    texts = [None, "", " \t\n", same, same, same.upper(), same + " ", long, long + " x", "Ünïcode ẞ 日本 ok", "a", "a b c"]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}" if i % 4 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows += [(3, same, "en", "src1", len(same)), (None, same, "de", None, None), (None, None, None, None, None)]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """Extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["fp", "row_number", "score", "predicted", "label", "kept", "shard", "segment", "n_words", "Text_Hash", "hash", "runs", "beginning", "frequent", "_copies", "_best", "norm", "place"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def documents(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_fold(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def by_key(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, str(v)) for v in r])
