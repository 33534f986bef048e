"""Languages and site quality: held-out accuracy, mixtures, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import by_key, clashing, crc_fold, documents, frame, odd_documents
from tidegauge.llm import language, quality

SF = "/root/testdata/sf0.01"


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in language.identify_languages(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [(got[r.doc_id].lang_pred, r.lang) for r in rows if crc_fold(r.doc_id, 5) == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.98
    assert all(r.held_out == (crc_fold(i, 5) == 0) and 0 <= r.score <= 1 for i, r in got.items())


def test_mixtures_and_proportions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs, "lang", "text")
    long = {r.lang: r.text for r in docs.where("n_chars > 2000").collect()}
    lang, score, found = language.identify(model, long["de"][:1500] + " " + long["fr"][:500])
    assert lang == "de" and {f[0] for f in found} == {"de", "fr"} and 0.6 < score < 0.9
    assert [f[0] for f in language.identify(model, long["es"])[2]] == ["es"]


def test_expectation_maximisation_climbs():
    rng = np.random.default_rng(2)
    shares, counts = rng.random((3, 50)), rng.integers(1, 9, 50).astype(float)
    weights, reached = language.mix(shares, counts)
    assert abs(weights.sum() - 1) < 1e-9
    for other in rng.dirichlet([1, 1, 1], 2000):
        assert counts @ np.log(other @ shares) <= reached + 1e-2


def test_odd_languages(spark):
    rows = odd_documents() + [(50, "123 456 !?", "en", None, None), (51, "ⅷ ²", "en", None, None)]
    got = language.identify_languages(clashing(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    lettered = {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    assert all((r.lang_pred == "und") == (r.doc_id not in lettered) for r in got if r.doc_id is not None and r.doc_id != 3)
    assert {r.lang_pred for r in got} <= {"und", "en", "de"}
    assert language.identify_languages(frame(spark, [])).count() == 0
    untaught = frame(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify_languages(untaught).collect()} == {"und"}


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels)
    assert got.count() == docs.count()
    held = got.where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9


def test_posteriors_shrink_sparse_sites(spark):
    judged = [("big", "a", 0.9)] * 400 + [("big", "b", 0.1)] * 4 + [("mid", "a", 0.2)] * 100 + [("tiny", "a", 1.0)] + [(None, None, 0.3)] * 50
    sites, centre = quality.site_posteriors(spark.createDataFrame(judged, "host string, path string, p double"))
    rows = {(r.host, r.path): r for r in sites.collect()}
    whole = sum(p for _, _, p in judged) / len(judged)
    assert abs(centre - whole) < 1e-9
    assert abs(rows["big", "a"].host_rate - 0.892) < 0.02 and whole < rows["tiny", "a"].host_rate < 1.0
    assert 0.1 < rows["big", "b"].path_rate < rows["big", "b"].host_rate
    assert (None, None) in rows and len(rows) == 5


def test_odd_quality_and_addresses(spark):
    rows = odd_documents()
    docs = clashing(frame(spark, rows))
    for marks in ([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], [(1, 1)], []):
        got = quality.quality_scores(docs, spark.createDataFrame(marks, "doc_id long, quality int")).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    urls = spark.createDataFrame([("https://U@Ex.example:80/Path/x?q",), ("http://a.b",), (None,), ("x",)], "url string")
    assert by_key(urls.select(quality.url_host(F.col("url")), quality.url_path(F.col("url"))).collect()) == by_key(
        [("ex.example", "Path"), ("a.b", ""), (None, None), ("", "")]
    )


def plain_weight(groups):
    """Weight of a beta prior from (n, good, centre) by its moments."""
    n = sum(g[0] for g in groups)
    spread = sum(c * (good / c - centre) ** 2 for c, good, centre in groups)
    chance = sum(centre * (1 - centre) for _, _, centre in groups)
    scale = sum(c * centre * (1 - centre) for c, _, centre in groups)
    real = (spread - chance) / n
    return quality.STRONGEST if real <= 0 else min(quality.STRONGEST, max(quality.WEAKEST, scale / n / real - 1))


def plain_sites(rows):
    """Host and path rates from (host, path, p), in plain Python."""
    hosts, paths = {}, {}
    for host, path, p in rows:
        for table, key in ((hosts, host), (paths, (host, path))):
            n, good = table.get(key, (0, 0.0))
            table[key] = n + 1, good + p
    centre = sum(g for _, g in hosts.values()) / sum(n for n, _ in hosts.values())
    weight = plain_weight([(n, g, centre) for n, g in hosts.values()])
    host_rates = {h: (weight * centre + g) / (weight + n) for h, (n, g) in hosts.items()}
    weight = plain_weight([(n, g, host_rates[h]) for (h, _), (n, g) in paths.items()])
    return centre, host_rates, {(h, p): (weight * host_rates[h] + g) / (weight + n) for (h, p), (n, g) in paths.items()}


def test_site_quality_recomputed_over_a_whole_table(spark):
    """Rates and scores of the given documents follow from their evidence."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sites = {r.doc_id: (r.source, r.lang) for r in docs.collect()}
    got = quality.quality_scores(docs, labels).collect()
    centre, host_rates, path_rates = plain_sites([(*sites[r.doc_id], r.evidence) for r in got])

    def logit(p):
        p = min(max(p, 1e-9), 1 - 1e-9)
        return np.log(p / (1 - p))

    for r in got:
        site = sites[r.doc_id]
        assert abs(r.host_rate - host_rates[site[0]]) < 1e-9 and abs(r.path_rate - path_rates[site]) < 1e-9
        want = 1 / (1 + np.exp(-(logit(r.evidence) + logit(path_rates[site]) - logit(centre))))
        assert abs(r.score - want) < 1e-9


def test_sites_of_crawled_pages(spark):
    """Hosts and paths of real addresses: sparse sites are drawn to the global rate, more so than large ones."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select(
        quality.url_host(F.col("url")).alias("host"), quality.url_path(F.col("url")).alias("path"),
        (F.pmod(F.xxhash64(quality.url_host(F.col("url"))), F.lit(7)) / 6 * 0.6 + F.pmod(F.xxhash64("url"), F.lit(100)) / 100 * 0.4).alias("p"),
    )
    rows = [tuple(r) for r in pages.collect()]
    assert all(h and "/" not in h for h, _, _ in rows)
    sites, centre = quality.site_posteriors(pages)
    want, host_rates, path_rates = plain_sites(rows)
    got = sites.collect()
    assert abs(centre - want) < 1e-9 and len(got) == len(path_rates)
    assert all(abs(r.host_rate - host_rates[r.host]) < 1e-9 and abs(r.path_rate - path_rates[r.host, r.path]) < 1e-9 for r in got)
    raw = {}
    for host, _, p in rows:
        raw.setdefault(host, []).append(p)
    kept = {h: (host_rates[h] - centre) / (np.mean(ps) - centre) for h, ps in raw.items() if abs(np.mean(ps) - centre) > 1e-3}
    assert all(0 < k <= 1 for k in kept.values())
    few, many = ([k for h, k in kept.items() if (len(raw[h]) > 2) == large] for large in (False, True))
    assert not few or not many or max(few) <= min(many) + 1e-9


def test_languages_recomputed_over_a_whole_table(spark):
    """Every document's set of languages by plain expectation-maximisation over dictionaries of trigrams."""
    docs = documents(spark)
    model = language.train(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0), "lang", "text")
    got = {r.doc_id: r for r in language.identify_languages(docs).collect()}
    table = np.exp(model.log_shares)

    def plain_mix(chosen, counts):
        weights = [1 / len(chosen)] * len(chosen)
        for _ in range(language.ROUNDS if len(chosen) > 1 else 0):
            fresh = [0.0] * len(chosen)
            for bucket, n in counts.items():
                parts = [w * table[i, bucket] for w, i in zip(weights, chosen)]
                fresh = [f + n * p / sum(parts) for f, p in zip(fresh, parts)]
            fresh = [f / sum(counts.values()) for f in fresh]
            moved, weights = max(abs(a - b) for a, b in zip(fresh, weights)), fresh
            if moved < language.STILL:
                break
        return weights, sum(n * np.log(sum(w * table[i, b] for w, i in zip(weights, chosen))) for b, n in counts.items())

    for r in docs.orderBy(F.length("text")).limit(60).collect():  # brute force is slow; the shortest are the closest calls
        if not r.text or not any(c.isalpha() for c in r.text):
            assert got[r.doc_id].lang_pred == "und"
            continue
        counts = {b: int(n) for b, n in enumerate(language.trigram_counts(r.text)) if n}
        order = sorted(range(len(model.languages)), key=lambda i, w=plain_mix(range(len(model.languages)), counts)[0]: -w[i])
        best = None
        for size in range(1, len(order) + 1):
            weights, reached = plain_mix(order[:size], counts)
            value = reached / language.OVERLAP - 0.5 * np.log(sum(counts.values()) + 1) * size
            if best is not None and value <= best[0]:
                break
            best = value, dict(zip(order[:size], weights))
        main = max(best[1], key=best[1].get)
        assert got[r.doc_id].lang_pred == model.languages[main] and abs(got[r.doc_id].score - best[1][main]) < 1e-6
