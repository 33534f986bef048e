"""BPE against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import by_key, clashing, documents, frame, odd_documents
from tidegauge.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def ours():
    with open(PATH) as file:
        return bpe.WordBpe(json.load(file))


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return out


def test_whole_table(spark, library):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert by_key(bpe.round_trips(documents(spark), PATH).collect()) == by_key(expected(library, rows))


def test_odd_rows(spark, library):
    rows = odd_documents() + [(90, "<|endoftext|>x<|startoftext|> we'll it's <|", None, None, None)]
    got = bpe.round_trips(clashing(frame(spark, rows)), PATH)
    assert by_key(got.collect()) == by_key(expected(library, [r[:2] for r in rows]))
    assert bpe.round_trips(frame(spark, []), PATH).count() == 0


def test_encode_then_decode(spark, library):
    docs = frame(spark, odd_documents())
    encoded = bpe.encode_texts(docs, PATH)
    want = [(r.doc_id, library.decode(r.ids, skip_special_tokens=False)) for r in encoded.collect()]
    assert by_key(bpe.decode_ids(encoded, PATH).collect()) == by_key(want)


def test_random_texts_and_single_characters(library, ours):
    random.seed(1)
    letters = "abcdeABC019 .,'!<|>\n\té́ßΣσİ日本  \x1c\x1f\x85\xa0"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(5000)]
    texts += ["".join(random.choice("abcdefghij") for _ in range(n)) for n in (63, 64, 65, 5000)]
    texts += [f"ab{chr(c)}Cd {chr(c)}" for c in range(0x500)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [e.tolist() for e in ours.encode(texts)] == want


def test_proposals_fail_and_are_merged(ours):
    """Greedy and exact merging differ for some words, and the check finds just these."""
    random.seed(2)
    words = list({"".join(random.choice("aeinrst") for _ in range(random.randint(2, 12))) for _ in range(3000)})
    flat, owner = ours.propose(words)
    greedy = [flat[owner == i].tolist() for i in range(len(words))]
    spelled = [[ours.vocab[c] for c in (*w[:-1], w[-1] + ours.end)] for w in words]
    exact = ours.merge_all(spelled)
    assert [ours._merge_long(s) for s in spelled] == exact
    wrong = [i for i in range(len(words)) if greedy[i] != exact[i]]
    assert 0 < len(wrong) < len(words)
    for i in range(len(words)):
        pairs = list(zip(greedy[i], greedy[i][1:]))
        fine = ours.compatible(*map(lambda x: np.array(x), zip(*pairs))).all() if pairs else True
        assert fine == (greedy[i] == exact[i])


def test_fewer_characters_at_once_change_no_token():
    with open(PATH) as file:
        words = bpe.WordBpe(json.load(file))
    texts = ["one Two  three", None, "", "four, five." * 50, "six"]
    assert [e.tolist() for e in words.encode(texts, at_once=1)] == [e.tolist() for e in words.encode(texts)]
