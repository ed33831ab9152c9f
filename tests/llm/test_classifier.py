import math
import random

import numpy as np
import pytest

from kindred.llm import classifier
from kindred.llm.tables import Scratch
from tests.conftest import rows
from tests.llm.texts import documents, frame, prose

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy_on_the_given_tables(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    train, test = labels.filter("hash(doc_id) % 4 <> 0"), labels.filter("hash(doc_id) % 4 = 0")
    got = classifier.classify(docs, train).join(test, "doc_id").selectExpr("kept", "quality = 1 AND toxic = 0 AS good").collect()
    kept = np.array([r.kept for r in got])
    good = np.array([r.good for r in got])
    assert kept[good].mean() > 0.98
    assert kept[~good].mean() < 0.15


def test_sparse_sites_stay_near_their_parents(spark):
    rows_ = [("h1", "p", 1)] * 900 + [("h1", "p", 0)] * 100 + [("h2", "p", 1)] * 200 + [("h2", "p", 0)] * 800
    rows_ += [("h3", "p", 0), ("h1", "q", 0), ("h4", "p", 1)] + [("h5", "p", 1)] * 60 + [("h5", "p", 0)] * 40
    train = spark.createDataFrame(rows_, "host string, path string, good int")
    hosts, sites = classifier.site_posteriors(train, 0.5)
    shares = dict(rows(hosts))
    assert 0.85 < shares["h1"] < 0.95 and 0.15 < shares["h2"] < 0.25
    assert 0.25 < shares["h3"] < 0.5 < shares["h4"] < 0.75
    assert {(h, p) for h, p, _ in rows(sites)} == {("h1", "p"), ("h1", "q"), ("h2", "p"), ("h3", "p"), ("h4", "p"), ("h5", "p")}


def test_awkward_rows_and_repeats(spark):
    docs = documents()
    labels = spark.createDataFrame(
        [(6, 1, 0), (6, 1, 0), (7, 0, 0), (8, 1, None), (9, None, 1), (None, 0, 0), (12345, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = classifier.classify(frame(spark, docs), labels).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((i for i, _ in docs), key=str)
    assert all(0 <= r.p_good <= 1 and r.kept is not None for r in got)


def test_no_labels_and_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = classifier.classify(frame(spark, documents()), labels).collect()
    assert all(r.p_good == 0.5 and r.kept for r in got)
    assert rows(classifier.classify(frame(spark, []), labels)) == []


def test_separates_words(spark):
    rng = random.Random(4)
    docs = [(i, prose(rng, 40) + (" moron idiot" if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    got = classifier.classify(frame(spark, docs), labels).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in got)


def brute_posteriors(sites, share):
    """Host shares and path shares by the definition; ``sites`` holds (host, path, good) rows."""

    def strength(groups, means):
        s = sum(n * (g / n - m) ** 2 for (g, n), m in zip(groups, means))
        v = sum(m * (1 - m) for m in means)
        w = sum(n * m * (1 - m) for (_, n), m in zip(groups, means))
        if not v or s <= v or w <= v:
            return 1e6
        return min(max((w - v) / (s - v) - 1, 1.0), 1e6)

    count = {}
    for host, path, good in sites:
        for key in ((host,), (host, path)):
            g, n = count.get(key, (0, 0))
            count[key] = g + good, n + 1
    hosts = {k[0]: c for k, c in count.items() if len(k) == 1}
    paths = {k: c for k, c in count.items() if len(k) == 2}
    k = strength(list(hosts.values()), [share] * len(hosts))
    of_host = {h: (g + k * share) / (n + k) for h, (g, n) in hosts.items()}
    j = strength(list(paths.values()), [of_host[h] for h, _ in paths])
    return of_host, {(h, p): (g + j * of_host[h]) / (n + j) for (h, p), (g, n) in paths.items()}


def test_evidence_posteriors_and_verdicts_equal_brute_force(spark):
    rng = random.Random(9)
    docs, labels, where = [], [], {}
    for i in range(300):
        host, bad = f"h{rng.randrange(6)}", rng.random() < 0.3
        where[i] = host, rng.choice(["a", "b"])
        docs.append((i, prose(rng, rng.randrange(5, 60)) + (" spam buy now" if bad and rng.random() < 0.8 else ""), f"{host}/{where[i][1]}/x", "en"))
        if i < 220:
            labels.append((i, int(not bad), 0))
    table = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in classifier.classify(table, known).collect()}

    features = {r.doc_id: np.frombuffer(r.features, np.uint16) for r in classifier.featurise(table, Scratch(spark)).collect()}
    good = {i: q for i, q, _ in labels}
    n, n_good = len(good), sum(good.values())
    seen, bad = np.zeros(classifier.BUCKETS), np.zeros(classifier.BUCKETS)
    for i, g in good.items():
        seen[features[i]] += 1
        bad[features[i]] += 1 - g
    share = (n - n_good) / n
    apart = np.abs(bad - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
    apart[seen == 0] = 0
    chosen = sorted(b for b in sorted(range(len(apart)), key=lambda b: (-apart[b], b))[: classifier.CHOSEN] if apart[b] > 0)
    x = {i: np.isin(chosen, f).astype(float) for i, f in features.items()}
    weights, offset = classifier._logistic(np.array([x[i] for i in good]), np.array(list(good.values()), bool), classifier.HOLD)
    # the regression is at its optimum: the penalised loss has no slope there
    p = {i: 1 / (1 + np.exp(-(x[i] @ weights + offset))) for i in good}
    slope = sum((p[i] - good[i]) * x[i] for i in good) + classifier.HOLD * weights
    assert np.abs(slope).max() < 1e-3

    mean = (n_good + 1) / (n + 2)
    hosts, paths = brute_posteriors([(*where[i], g) for i, g in good.items()], mean)
    for i, r in got.items():
        evidence = x[i] @ weights + offset
        site = paths.get(where[i], hosts.get(where[i][0], mean))
        odds = evidence + math.log(site / (1 - site)) - math.log(mean / (1 - mean))
        assert r.evidence == pytest.approx(evidence, abs=1e-4) and r.site_share == pytest.approx(site, abs=2e-6)
        assert r.p_good == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-4)
        assert r.kept == (r.p_good >= 0.5)


@pytest.mark.parametrize("copies", [1, 30])
def test_the_sample_is_that_of_the_smallest_turns(spark, copies):
    n, sample = 3000, 200
    made = [(b"x", i % 2, random.Random(i // copies).getrandbits(64) - (1 << 63)) for i in range(n)]
    bits = spark.createDataFrame(made, "bits binary, good int, turn long").repartition(5)
    got = classifier._first(bits, n, sample).collect()
    assert sorted(r.turn for r in got) == sorted(t for _, _, t in made)[:sample]
    assert classifier._first(bits, n, 10_000).count() == n
