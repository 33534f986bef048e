"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import by_key, clashing, documents, frame, odd_documents
from tidegauge.llm import spelling as sp


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zA-ZÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def edits(word):
    """Everything one edit leads to, with a mark for any letter."""
    for i in range(len(word) + 1):
        yield word[:i] + "?" + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield word[:i] + "?" + word[i + 1 :]


def plain_variants(counts):
    marked = {}
    for w in counts:
        for e in set(edits(w)):
            marked.setdefault(e, set()).add(w)
    near = {}
    for w in counts:
        # one letter replaced: equal marks of equal length; one inserted: a mark of the longer equals a mark of the shorter
        found = set()
        for i in range(len(w)):
            found |= {v for v in marked[w[:i] + "?" + w[i + 1 :]] if len(v) == len(w)}
            found |= {w[:i] + w[i + 1 :]} & counts.keys()
        found |= {v for e in set(edits(w)) if len(e) == len(w) + 1 for v in marked[e] if len(v) == len(w) + 1}
        near[w] = found - {w}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 10 * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(near[w]), counts.get(forms[w])))
    return rows


def collected(df):
    return by_key([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()])


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    want = plain_variants(plain_words(rows))
    assert any(r[1] for r in want) and any(r[4] for r in want)
    assert collected(sp.spelling_variants(documents(spark))) == by_key(want)


@pytest.mark.parametrize("per_class,chunk", [(1, 8192), (50, 16), (10**9, 8192), (10**9, 16)])
def test_classes_and_chunks_do_not_change_the_result(spark, monkeypatch, per_class, chunk):
    monkeypatch.setattr(sp, "WORDS_PER_CLASS", per_class)
    monkeypatch.setattr(sp, "CHUNK", chunk)
    rng = np.random.default_rng(4)
    seeds = ["".join(rng.choice(list("abcéÿ"), 8)) for _ in range(12)]
    base = sorted({e.replace("?", rng.choice(list("abc"))) for w in seeds for e in edits(w)})
    base += ["aaaaaaa" + "a" * i for i in range(6)] + ["abcabca", "bcaabca"]
    text = " ".join(w for i, w in enumerate(base) for _ in range(2 + 30 * (i % 7 == 0) + 400 * (i % 41 == 0)))
    docs = frame(spark, [(5, text, None, None, 0)])
    want = plain_variants(plain_words([(5, text)]))
    assert sum(r[4] for r in want) > 100 and any(r[1] for r in want)
    assert collected(sp.spelling_variants(docs)) == by_key(want)


def test_chains_lead_to_the_root(spark):
    counts = {"abcdefg": 30000, "abcdefgh": 2000, "abcdefghi": 150, "abcdefghij": 12, "zzzzzzz": 3}
    forms = [(r[0], r[1]) for r in plain_variants(counts) if r[1]]
    got = {r.word: r.root for r in sp.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "abcdefg" for w, _ in forms} and len(got) == 3


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_documents() + [(None, "Schreiben schreiben SCHREIBÉN Schreibén " * 40, None, None, None), (7, "x" * 3_000 + " " + "x" * 3_001 + " ", None, None, 1)] * 2
    docs = clashing(frame(spark, rows))
    assert collected(sp.spelling_variants(docs)) == by_key(plain_variants(plain_words([r[:2] for r in rows])))
    assert sp.spelling_variants(frame(spark, [])).count() == 0
    assert sp.spelling_variants(frame(spark, [(1, None, None, None, None), (2, "", None, None, 0)])).count() == 0


def test_edits_are_verified_not_only_counted():
    words = np.array(["abcdefg", "abcdegf", "abcdxfg", "gfedcba"], dtype=object)
    found, near, _, best = sp.near_in_block("6/0/0", np.zeros(4, int), words, np.array([5, 4, 3, 2]), np.zeros(4, int))
    assert dict(zip(found, best)) == {"abcdefg": "abcdxfg", "abcdxfg": "abcdefg"} and list(near) == [1, 1]
