"""Fitted operators: gradients, held-out accuracy, shrinkage; and the edge cases of their inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, quality, toxicity

SYLLABLES = {"aa": ["ba", "na", "to", "ri", "mo"], "bb": ["sch", "ung", "ver", "heit", "ö"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)) + "."


def test_gradients_are_exact():
    net = langid.Network(["a", "b", "c"], hidden=3)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (4, 5)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grads = net.gradients(x, y)
    for k, v in net.params.items():
        for _ in range(8):
            at = (int(x[rng.integers(0, 4), rng.integers(0, 5)]), int(rng.integers(0, v.shape[1]))) if k[0] == "x" else tuple(int(rng.integers(0, s)) for s in v.shape)
            old = v[at]
            v[at] = old + 1e-5
            up, _ = net.gradients(x, y)
            v[at] = old - 1e-5
            down, _ = net.gradients(x, y)
            v[at] = old
            assert abs((up - down) / 2e-5 - grads[k][at]) < 1e-7


def test_language_of_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang := ("aa", "bb")[i % 2], rng.randint(2, 40)), lang, "x") for i in range(200)]
    rows += [(500, None, "aa", None), (501, "", "bb", None), (502, "12 34 !!", None, None), (None, "schung", "bb", None), (503, "schungver " * 5000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    net = langid.fit_labelled(docs.where(~langid.held_out(F.col("doc_id"))), rows=60, words=6000)
    got = {r["doc_id"]: r for r in langid.predict(docs, net).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (500, 501, 502))
    assert got[503]["lang_pred"] == "bb" and all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _ in rows[:200]]) > 0.97
    assert langid.fit_labelled(docs.where("false")) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.spans("schung nato".encode(), net)[0][2] == "bb"


def test_severity_grows_with_toxic_words(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        bad = [rng.choice(["vile", "rotten", "scoundrel"]) for _ in range(i % 8)] if i % 2 else []
        words = text(rng, "aa", 60).split() + bad
        rng.shuffle(words)
        rows.append((i, " ".join(words), "keep"))
        labels.append((i, int(bool(bad))))
    rows += [(900, None, None), (901, "", None), (None, "vile vile rotten scoundrel", None), (902, "Vile, rotten! scoundrel?", None), (902, "vile, rotten scoundrel", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity string")
    labels = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit_labelled(docs, labels)
    assert np.all(np.diff(model.cuts) > 0)
    got = toxicity.score(docs, model).collect()
    by = {r["doc_id"]: r for r in got}
    assert np.mean([by[i]["toxic"] == bool(y) for i, y in [(i, i % 2 and i % 8) for i in range(400)]]) > 0.97
    assert not by[900]["toxic"] and not by[901]["toxic"] and by[902]["toxic"] and by[None]["toxic"]
    assert by[0]["row"]["severity"] == "keep" and len(got) == len(rows)
    assert toxicity.fit_labelled(docs, labels.where("false")) is None
    assert toxicity.score(docs, None).where("toxic").count() == 0


def test_ordinal_gradients_and_probabilities():
    rng = np.random.default_rng(4)
    n, m = 12, 5
    rows, cols = np.repeat(np.arange(n), 2), rng.integers(0, m, 2 * n)
    values, grades, weight = rng.random(2 * n) + 0.5, rng.integers(0, 4, n), rng.random(n)
    w, first, gaps = rng.standard_normal(m), 0.3, np.array([0.2, -0.4])
    total, g_w, g_first, g_gaps = toxicity.gradients(w, first, gaps, rows, cols, values, grades, weight)
    cuts = [first, first + np.exp(0.2), first + np.exp(0.2) + np.exp(-0.4)]
    by_hand = 0.0
    for i in range(n):
        score = sum(w[c] * v for r, c, v in zip(rows, cols, values) if r == i)
        above = [1.0, *(1 / (1 + np.exp(c - score)) for c in cuts), 0.0]
        by_hand += weight[i] * np.log(above[grades[i]] - above[grades[i] + 1])
    assert abs(total - by_hand) < 1e-9
    value = lambda w_, f_, g_: toxicity.gradients(w_, f_, g_, rows, cols, values, grades, weight)[0]
    for j in range(m):
        e = np.eye(m)[j] * 1e-6
        assert abs((value(w + e, first, gaps) - value(w - e, first, gaps)) / 2e-6 - g_w[j]) < 1e-6
    assert abs((value(w, first + 1e-6, gaps) - value(w, first - 1e-6, gaps)) / 2e-6 - g_first) < 1e-6
    for k in range(2):
        e = np.eye(2)[k] * 1e-6
        assert abs((value(w, first, gaps + e) - value(w, first, gaps - e)) / 2e-6 - g_gaps[k]) < 1e-6


def test_toxicity_edges(spark):
    rng = random.Random(9)
    rows = [(i, text(rng, "aa", 30) + (" awful" * 3 if i % 2 else ""), {"a": 1}) for i in range(80)]
    rows += [(7, "fine words " * 40_000 + "awful", None), (3, None, None), (None, "awful awful", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity map<string,int>")
    labels = spark.createDataFrame([(i, i % 2 * (1 + i % 3)) for i in range(80)] * 2, "doc_id long, toxic int")
    model = toxicity.fit_labelled(docs, labels)
    assert len(model.cuts) == 3  # labels of several grades are taken as they are
    got = {(r["doc_id"], bool(r["row"]["severity"])): r["toxic"] for r in toxicity.score(docs, model).collect()}
    assert got[(5, True)] and got[(None, False)] and not got[(4, True)] and not got[(3, False)] and (7, False) in got
    empty = docs.where("false")
    assert toxicity.fit_labelled(empty, labels) is None and toxicity.score(empty, model).count() == 0


def test_quality_shrinks_sparse_sites(spark):
    rows = [("big", "big/a", 0.9)] * 50 + [("big", "big/b", 0.1)] * 50 + [("small", "small/a", 0.2)] + [("bad", "bad/a", 0.05)] * 60
    got = quality.posterior(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    site = {r["path"]: r["site"] for r in got}
    mean = sum(p for *_, p in rows) / len(rows)
    assert site["big/a"] > mean > site["bad/a"]
    assert abs(site["small/a"] - mean) < 1e-6  # its own evidence is left out: only the prior remains


def test_quality_edges(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, "aa", 50) if i % 3 else "%%% ### !!! " * 30, f"s{i % 4}", "p") for i in range(120)]
    rows += [(500, None, None, None), (501, "", "s1", None), (None, "bana nato", "s1", "q"), (3, "%%% ###", "s3", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, p string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id long, quality int")
    got = quality.score(docs, labels, F.col("source"), F.col("p")).collect()
    assert len(got) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert np.mean([kept[i] == (i % 3 > 0) for i in range(120) if i != 3]) > 0.98
    assert all(r["kept"] for r in quality.score(docs, labels.where("false"), F.col("source"), F.col("p")).collect())
    assert quality.score(docs.where("false"), labels, F.col("source"), F.col("p")).count() == 0


def test_long_words_are_cut_between_characters():
    word = ("語" * 40 + "a" * 7 + "é" * 60).encode()
    parts = list(langid.cut(word))
    assert b"".join(parts) == word and all(len(p) <= langid.MOST_BYTES and p.decode() for p in parts)
    assert list(langid.cut(b"")) == []


def by_hand(rows):
    """Site and combined chance of each (host, path, p), from sums in plain loops."""
    mean = sum(p for *_, p in rows) / len(rows)

    def groups(key):
        found = {}
        for row in rows:
            found.setdefault(key(row), []).append(row[2])
        return found

    hosts, paths = groups(lambda r: r[0]), groups(lambda r: r[:2])

    def strength(of, prior):
        """Documents that the prior is worth; ``prior``: (mean, documents) that a group shrinks toward."""
        n = sum(map(len, of.values()))
        within = sum(p * (1 - p) for ps in of.values() for p in ps) / n
        between = sum(len(ps) * (sum(ps) / len(ps) - prior(g)[0]) ** 2 for g, ps in of.items())
        free = n - sum(len(ps) ** 2 / prior(g)[1] for g, ps in of.items())
        if free <= 0:
            return quality.MOST_STRENGTH
        extra = (between - within * (len(of) - sum(len(ps) / prior(g)[1] for g, ps in of.items()))) / free
        return min(quality.MOST_STRENGTH, max(quality.LEAST_STRENGTH, mean * (1 - mean) / extra - 1)) if extra > 0 else quality.MOST_STRENGTH

    at_host = strength(hosts, lambda g: (mean, len(rows)))
    at_path = strength(paths, lambda g: (sum(hosts[g[0]]) / len(hosts[g[0]]), len(hosts[g[0]])))
    out = []
    for host, path, p in rows:
        h = (sum(hosts[host]) - p + at_host * mean) / (len(hosts[host]) - 1 + at_host)
        site = (sum(paths[host, path]) - p + at_path * h) / (len(paths[host, path]) - 1 + at_path)
        odds = p / (1 - p) * site / (1 - site) / (mean / (1 - mean))
        out.append((host, path, p, site, odds / (1 + odds)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quality_posterior_equals_plain_loops(spark, seed):
    rng = random.Random(seed)
    rows = []
    for h in range(rng.randint(1, 6)):
        base = rng.uniform(0.2, 0.8)
        for k in range(rng.randint(1, 4)):
            rows += [(f"h{h}", f"h{h}/{k}", round(min(0.95, max(0.05, base + 0.1 * k + rng.gauss(0, 0.1))), 3)) for _ in range(rng.choice([1, 2, 30]))]
    rows.append(rows[0])  # a repeated row counts twice
    got = sorted((r["host"], r["path"], r["p"], r["site"], r["q"]) for r in quality.posterior(spark.createDataFrame(rows, "host string, path string, p double")).collect())
    want = by_hand(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3:] for g in got], [w[3:] for w in want], rtol=1e-6)


def test_network_equals_a_loop_over_bytes():
    net = langid.Network(["a", "b", "c"], hidden=4, seed=9)
    p, k = {n: v.astype(float) for n, v in net.params.items()}, 4
    sigmoid = lambda v: 1 / (1 + np.exp(-v))

    def states(word, way):
        h, out = np.zeros(k), {}
        for t in range(len(word)) if way == "f" else reversed(range(len(word))):
            x, u = p["x" + way][word[t]], p["u" + way]
            new = np.zeros(k)
            for j in range(k):
                z = sigmoid(x[j] + h @ u[:, j])
                r = sigmoid(x[k + j] + h @ u[:, k + j])
                c = np.tanh(x[2 * k + j] + r * (h @ u[:, 2 * k + j]))
                new[j] = z * h[j] + (1 - z) * c
            out[t] = h = new
        return out

    words = [b"straat", "größe".encode()[:6], b"zzzzzz"]
    got = net.probabilities(np.stack([np.frombuffer(w, np.uint8) for w in words]))
    for m, w in enumerate(words):
        forward, backward = states(w, "f"), states(w, "b")
        for t in range(len(w)):
            e = np.exp(np.concatenate((forward[t], backward[t])) @ p["v"] + p["c"])
            assert np.allclose(got[t, m], e / e.sum(), atol=1e-5)
