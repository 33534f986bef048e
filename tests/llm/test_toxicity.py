"""Toxicity: planted words are caught, clean documents left alone, held-out accuracy."""

import random

import pytest

from tests.llm.helpers import by_key, clashing, crc_fold, documents, frame, odd_documents
from tidegauge.llm import toxicity as tx

BAD = ["scoundrel", "dolt", "vermin", "nitwit", "wretch"]


def corpus(n, seed):
    random.seed(seed)
    parts = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar".split()
    rows = []
    for i in range(n):
        words = ["".join(random.choices(parts, k=random.randint(1, 5))) for _ in range(random.randint(20, 300))]
        toxic = int(random.random() < 0.2)
        for _ in range(random.randint(3, 6) * toxic):
            words.insert(random.randrange(len(words)), random.choice(BAD) + random.choice(["", ".", ","]))
        rows.append((i, " ".join(words).capitalize(), toxic))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus(1500, 4)


def test_held_out_rows(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in tx.toxicity_scores(docs, labels).collect()}
    assert len(got) == len(rows)
    held = [(got[i], t) for i, _, t in rows if crc_fold(i, 3) == 1]
    assert all(r.held_out == (crc_fold(i, 3) == 1) and 0 <= r.score <= 1 for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.7) for r, _ in held)
    caught = sum(r.predicted for r, t in held if t) / sum(t for _, t in held)
    wrong = sum(r.predicted for r, t in held if not t) / sum(1 - t for _, t in held)
    assert caught > 0.95 and wrong < 0.01


def test_labels_of_the_held_out_fold_do_not_matter(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows[:400]], "doc_id long, text string")
    scores = []
    for flip in (0, 1):
        labels = [(i, t ^ (flip and crc_fold(i, 3) == 1)) for i, _, t in rows[:400]]
        scores.append(by_key(tx.toxicity_scores(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()))
    assert scores[0] == scores[1]


def test_odd_rows(spark, rows):
    odd = odd_documents()
    learned = [(i + 1000, t, None, None, None) for i, t, _ in rows[:300]]
    labels = spark.createDataFrame(
        [(i + 1000, t) for i, _, t in rows[:300]] + [(None, 1), (1, None), (2, 7), (1000, rows[0][2])], "doc_id long, toxic int"
    )
    docs = clashing(frame(spark, odd + learned))
    got = tx.toxicity_scores(docs, labels).collect()
    assert len(got) == len(odd) + 300 and not any(r.predicted for r in got if r.doc_id is None or r.doc_id < 20)
    nothing = tx.toxicity_scores(docs, labels.limit(0))
    assert {(r.score, r.predicted) for r in nothing.collect()} == {(0.0, 0)}
    assert tx.toxicity_scores(frame(spark, []), labels).count() == 0
    kept = tx.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    clean = {r.doc_id for r in got if not r.predicted}
    assert {r.doc_id for r in kept.collect()} == clean


def test_windows_cover_long_words_whole():
    word = "x" * 100 + "scoundrel" + "y" * 100
    windows = tx.windows_of(f"a {word} B")
    assert windows[0] == b"a" and windows[-1] == b"b" and any(b"scoundrel" in w for w in windows)
    assert {len(w) <= tx.WINDOW for w in windows} == {True}


def test_given_labels(spark):
    """The given tables, on the rows that are not learned from; some 290 toxic ones are left to learn from."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = tx.toxicity_scores(docs, labels).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic, clean = [[r.predicted for r in scored if r.toxic == y] for y in (1, 0)]
    assert sum(toxic) / len(toxic) > 0.65 and sum(clean) / len(clean) < 0.005


@pytest.mark.parametrize("n", [2, 4, 5, 8, 12, 20])
@pytest.mark.parametrize("long", [False, True])
def test_few_labels_do_not_fail(spark, rows, n, long):
    """Too little text to train a dictionary on is no error."""
    few = [(i, (t if long else t[:20]), i // 2 % 2) for i, t, _ in rows[:n]]
    model = tx.fit([(t, y) for _, t, y in few])
    docs = spark.createDataFrame([r[:2] for r in few], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in few], "doc_id long, toxic int")
    assert model is not None and all(0 <= r.score <= 1 for r in tx.toxicity_scores(docs, labels).collect())


def test_a_labelled_id_on_a_third_of_all_rows(spark, rows, monkeypatch):
    """One text of it is learned from; the bound on bytes holds for what is fetched."""
    fitted = []
    monkeypatch.setattr(tx, "fit", lambda sample: fitted.append(sample) or tx.ToxicityModel(b"", b"", (0, 0), tx.np.zeros((tx.GAINS, tx.LENGTHS)), tx.np.zeros(5)))
    learned = [r for r in rows[:60] if crc_fold(r[0], 3) != 1]
    hot = learned[0][0]
    docs = spark.createDataFrame([r[:2] for r in rows[:60]] + [(hot, f"copy {i % 7}") for i in range(30)] + [(hot, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows[:60]] * 2, "doc_id long, toxic int")
    tx.train(docs, labels)
    assert len(fitted[-1]) == len(learned)
    tx.train(docs, labels, max_bytes=3000)
    assert 0 < sum(len((t or "").encode()) for t, _ in fitted[-1]) <= 3000


def test_scores_of_the_shipped_model_by_hand(rows):
    """Each window compressed by itself, each document's features added up in plain Python."""
    model = tx.fit([(t, y) for _, t, y in rows[:600]])
    assert model.fitted
    lengths = tx.lengths_under(model.ordinary, model.peculiar, model.frame)

    def evidence(window):
        framed = lengths.lead + window + lengths.trail
        ordinary, toxic = (len(c.compress(framed)) for c in lengths.both)
        return model.evidence[min(max(ordinary - toxic, 0), tx.GAINS - 1), min(ordinary, tx.LENGTHS - 1)]

    texts = [t for _, t, _ in rows[600:640]] + [None, "", "x" * 300]
    got = list(tx.Scorer(model).scores(texts))
    for text, score in zip(texts, got):
        windows = tx.windows_of(text)
        row = tx.np.array(tx.features([evidence(w) for w in windows], len(windows)))
        assert score == pytest.approx(1 / (1 + tx.np.exp(-tx.np.clip(row @ model.weights, -30, 30))))
