"""Toxicity by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import small_side, table, with_row, written
from millrace.llm.words import WordHashes, pieces_of, shingles

#: The fit takes at most about this many labelled rows of each class, chosen by hash of doc_id.
FIT_ROWS = 3000
FEATURES, GRAM, GRADES = 4000, 5, 3
#: A feature stands in this many toxic texts of the sample, and its log-likelihood ratio is at least this.
LEAST_TEXTS, LEAST_RATIO = 4, 12.0
OFTEN = 3
#: What a share of clean texts flagged costs against the same share of toxic texts missed.
CLEAN_COST = 1.0
RIDGE = 2e-6
#: Texts of the sample that agree in a band of min-hashes count once when features are chosen.
BANDS, BAND_ROWS = 8, 3
EDGES = ".,;:!?\"'()[]{}<>%$&*#|-"


def features_of(word: str) -> list[str]:
    """The bare lower-case word, and its character n-grams with marked ends."""
    bare = word.strip(EDGES)
    if not bare:
        return []
    marked = f"^{bare}$"
    return ["=" + bare, *dict.fromkeys(marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1))]


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(cut_k - w.x); one weight vector for all ordered cuts."""

    index: dict[str, int]
    weights: np.ndarray
    cuts: np.ndarray
    threshold: float = 0.5

    def hits(self, word: str) -> tuple[int, ...]:
        return tuple(self.index[f] for f in features_of(word) if f in self.index)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: one column each."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -50, 50)))


def _odd_numbers(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text: its features with the number of distinct words that have them, and bands of min-hashes of its word 5-shingles."""
    hashes, odd = WordHashes(), _odd_numbers(BANDS * BAND_ROWS)
    known: dict[str, list[str]] = {}
    for batch in pieces_of(batches, 64):
        bands, features = [], []
        for text in batch.column("text").to_pylist():
            words = text.lower().split()
            own = shingles([w.encode() for w in words], hashes, 5)
            low = [int((own * m).min()) for m in odd] if len(own) else []
            bands.append([xxhash.xxh3_64_intdigest(repr((b, low[b : b + BAND_ROWS])).encode()) >> 1 for b in range(0, len(low), BAND_ROWS)])
            found: Counter[str] = Counter()
            for w in dict.fromkeys(words):
                if w not in known:
                    if len(known) > 200_000:
                        known.clear()
                    known[w] = features_of(w)
                found.update(known[w])
            features.append(list(found.items()))
        kept = [batch.column(c) for c in ("key", "grade")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(bands, pa.list_(pa.int64())), pa.array(features, pa.map_(pa.string(), pa.int32()))], names=["key", "grade", "bands", "features"])


def _first_of_copies(bands: list[list[int]]) -> list[int]:
    """One row of each group of near copies: rows that share no band with a row before them.

    Else words that only happen to stand in a much-copied toxic text would look toxic.
    """
    seen: set[int] = set()
    out = []
    for i, own in enumerate(bands):
        if own and not seen.intersection(own):
            out.append(i)
        seen.update(own)
    return out


def chance_ratio(candidates: int) -> float:
    """The log-likelihood ratio that none of ``candidates`` features is likely (1 in 100) to reach by chance."""
    x = LEAST_RATIO
    for _ in range(20):
        x = max(LEAST_RATIO, 2 * np.log(100 * max(1, candidates) * np.sqrt(1 / (2 * np.pi * x))))
    return float(x)


def _ratio(a: Column, b: Column, share: float) -> Column:
    """Log-likelihood ratio of ``a`` toxic and ``b`` clean texts against the sample's share of toxic ones."""
    part = lambda x, of: F.when(x > 0, x * F.log(x / ((a + b) * of))).otherwise(0.0)
    return 2 * (part(a, share) + part(b, 1 - share))


def select_features(sampled: DataFrame, alone: DataFrame) -> list[list[str]]:
    """Features that toxic texts hold far more often: from all of ``alone``, and from each of its halves.

    ``alone``: key, toxic, half. A feature may tell by standing in a text at all, or by standing in OFTEN distinct words
    of it. Texts are counted by grouped sums; only features that pass are collected.
    """
    n = {(r["half"], r["toxic"]): r["n"] for r in alone.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    held = sampled.join(F.broadcast(alone), "key").select("toxic", "half", F.explode("features").alias("feature", "words"))
    one = lambda t, h, words: F.sum(F.when((F.col("toxic") == t) & (F.col("half") == h) & (F.col("words") >= words), 1).otherwise(0))
    kinds = [(f"{'ba'[t]}{h}_{w}", t, h, w) for t in (True, False) for h in (0, 1) for w in (1, OFTEN)]
    counts = written(held.groupBy("feature").agg(*(one(t, h, w).alias(k) for k, t, h, w in kinds)).where(F.col("a0_1") + F.col("a1_1") >= LEAST_TEXTS))
    m = counts.agg(F.count("*").alias("any"), F.count_if(F.col(f"a0_{OFTEN}") + F.col(f"a1_{OFTEN}") >= LEAST_TEXTS).alias("often")).first()
    least = {1: chance_ratio(m["any"]), OFTEN: chance_ratio(m["often"])}
    out = []
    for halves in ((0, 1), (0,), (1,)):
        of = {t: sum(n.get((h, t), 0) for h in halves) for t in (True, False)}
        if not of[True] or not of[False]:
            out.append([])
            continue
        share = of[True] / (of[True] + of[False])
        over = []
        for w in (1, OFTEN):
            a, b = (reduce(Column.__add__, [F.col(f"{x}{h}_{w}") for h in halves]) for x in "ab")
            over.append(F.when((a >= len(halves) * LEAST_TEXTS // 2) & (a * (1 - share) > 4 * b * share), _ratio(a, b, share) / (least[w] * len(halves) / 2)).otherwise(0.0))
        good = counts.withColumn("r", F.greatest(*over)).where("r >= 1")
        out.append([r["feature"] for r in good.orderBy(F.desc("r"), "feature").limit(FEATURES).collect()])
    return out


def _find(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = index.value
        for batch in batches:
            features = batch.column("features").to_pylist()
            found = [sorted((known[f], n) for f, n in own if f in known) for own in features]
            hits, words = ([[x[k] for x in own] for own in found] for k in (0, 1))
            arrays = [pa.array(v, pa.list_(pa.int32())) for v in (hits, words)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("grade"), *arrays, pa.array([len(own) for own in features], pa.int32())], names=["key", "grade", "hits", "words", "size"])

    return run


def value_of(words: np.ndarray) -> np.ndarray:
    """A feature's value in a text: grows with the number of distinct words that have it, from 1 for one."""
    return np.log2(1 + words)


def gradients(w: np.ndarray, first: float, gaps: np.ndarray, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, float, np.ndarray]:
    """Weighted log-likelihood of the grades, and its slopes in the weights, the first cut and the log gaps.

    P(grade >= k) = sigmoid(score - cut_k), so P(grade = k) is the difference of two neighbours.
    """
    top = len(gaps) + 1
    cuts = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
    score = np.bincount(rows, w[cols] * values, len(grades))
    s = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -50, 50)))
    full = np.concatenate((np.ones((len(s), 1)), s, np.zeros((len(s), 1))), axis=1)
    at = np.arange(len(s))
    like = np.maximum(full[at, grades] - full[at, grades + 1], 1e-9)
    slope = full * (1 - full)
    d_score = weight * (slope[at, grades] - slope[at, grades + 1]) / like
    d_cut = np.zeros_like(s)
    here, below = grades >= 1, grades < top
    d_cut[at[here], grades[here] - 1] -= (weight * slope[at, grades] / like)[here]
    d_cut[at[below], grades[below]] += (weight * slope[at, grades + 1] / like)[below]
    g_gaps = np.array([d_cut[:, k + 1 :].sum() * np.exp(gaps[k]) for k in range(top - 1)])
    return float((weight * np.log(like)).sum()), np.bincount(cols, d_score[rows] * values, len(w)), float(d_cut.sum()), g_gaps


def fit(index: dict[str, int], rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, steps: int = 400) -> OrdinalModel:
    """Fit weights and cuts to texts given as (row, feature number, value) triples and their grades from 0."""
    toxic = grades > 0
    # each class weighs the same
    weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    w, first, gaps = np.zeros(len(index)), np.ones(1), np.zeros(max(1, int(grades.max())) - 1)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, first, gaps)]
    for step in range(1, steps + 1):
        _, g_w, g_first, g_gaps = gradients(w, float(first[0]), gaps, rows, cols, values, grades, weight)
        moved = []
        for g, (m, v) in zip((g_w - RIDGE * w, np.array([g_first]), g_gaps), moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            moved.append(0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8))
        w, first, gaps = w + moved[0], first + moved[1], gaps + moved[2]
    model = OrdinalModel(index, w, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))
    model.threshold = _operating_point(np.bincount(rows, w[cols] * values, len(grades)), toxic, model)
    return model


def derived_grades(toxic: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    """Grades where labels only say toxic or not: 0, or 1 to GRADES by thirds of ``evidence`` among toxic texts."""
    parts = np.quantile(evidence[toxic], np.arange(1, GRADES) / GRADES)
    return np.where(toxic, 1 + np.searchsorted(parts, evidence, "right"), 0)


def _operating_point(score: np.ndarray, toxic: np.ndarray, model: OrdinalModel) -> float:
    """The chance of grade 1 that best parts the classes of the sample, midway between scores; a flagged clean text costs CLEAN_COST."""
    values = np.unique(score)
    right = [((score[toxic] >= v).mean() - CLEAN_COST * (score[~toxic] >= v).mean(), v) for v in values[1:]]
    if not right:
        return 0.5
    _, cut = max(right)
    middle = (cut + values[values < cut][-1]) / 2
    return float(model.at_least(np.array([middle]))[0, 0])


def fit_labelled(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> OrdinalModel | None:
    """Fit on up to about ``rows`` labelled documents of each class (chosen by hash, any null left out).

    Texts stay on the executors: features are counted by grouped sums, and the driver gets the chosen
    features and the numbers of those that each sampled text holds. Grades are the labels themselves if there
    are more than two of them. Else a toxic text is graded by how many features it holds of those that the half
    of the sample it isn't in gives. None if there is one class only or nothing tells the two apart.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.greatest(F.col("toxic").cast("int"), F.lit(0)).alias("grade")).where("doc_id is not null and toxic is not null")
    toxic = F.col("grade") > 0
    counts = {r["toxic"]: r["n"] for r in marked.groupBy(toxic.alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2 or rows < 1:
        return None
    part = lambda key, n: F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.when(toxic, rows / n[True]).otherwise(rows / n[False]) * 1_000_000
    some = marked.where(part("doc_id", counts)).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    chosen = texts.join(small_side(some, 4 * rows), "doc_id").select(F.xxhash64("doc_id", "text").alias("key"), "grade", "text")
    sampled = written(chosen.mapInArrow(_sketch, "key long, grade int, bands array<long>, features map<string,int>"))
    counts = {True: rows, False: rows} | {r["toxic"]: r["n"] for r in sampled.groupBy(toxic.alias("toxic")).agg(F.count("*").alias("n")).collect()}
    sampled = sampled.where(part("key", counts))  # many texts of one doc_id don't enlarge the sample
    rows_of = sampled.select("key", "grade", "bands").dropDuplicates(["key", "grade"]).toPandas().sort_values(["key", "grade"])
    first = rows_of.iloc[_first_of_copies([list(b) for b in rows_of["bands"]])]
    if not (first["grade"] > 0).any() or (first["grade"] > 0).all():
        return None
    own = docs.sparkSession.createDataFrame([(int(k), bool(g > 0), i % 2) for i, (k, g) in enumerate(zip(first["key"], first["grade"]))], "key long, toxic boolean, half int")
    whole, *halves = select_features(sampled, own)
    if not whole:
        return None
    names = list(dict.fromkeys([*whole, *halves[0], *halves[1]]))
    number = {f: i for i, f in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(number)
    got = sampled.mapInArrow(_find(shared), "key long, grade int, hits array<int>, words array<int>, size int").dropDuplicates(["key", "grade"]).toPandas().sort_values(["key", "grade"])
    grades = got["grade"].to_numpy(int)
    if grades.max() == 1:
        half = {int(k): i % 2 for i, k in enumerate(first["key"])}
        from_half = [np.isin(np.arange(len(names)), [number[f] for f in h]) for h in halves]
        # near copies and others outside both halves are judged by the half of the other parity of their key
        evidence = np.array([from_half[1 - half.get(k, k % 2)][np.asarray(h, int)].sum() / np.sqrt(n + 1) for k, h, n in zip(got["key"], got["hits"], got["size"])])
        grades = derived_grades(grades > 0, evidence)
    at = np.repeat(np.arange(len(got)), [len(h) for h in got["hits"]])
    cols, words = (np.concatenate([np.asarray(v, int) for v in got[c]]) for c in ("hits", "words"))
    own = cols < len(whole)
    return fit({f: i for i, f in enumerate(whole)}, at[own], cols[own], value_of(words[own]), grades)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: OrdinalModel | None = pickle.loads(model.value)
        known: dict[bytes, float | tuple] = {}
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if m is not None:
                for i, text in enumerate(batch.column("text").to_pylist()):
                    if not text:
                        continue
                    if len(known) > 400_000:
                        known.clear()
                    found: list[int] = []
                    for w in set(text.lower().split()):
                        hit = known.get(w)
                        if hit is None:
                            hit = known[w] = m.hits(w)
                        if hit:
                            found += hit
                    if found:
                        cols, words = np.unique(found, return_counts=True)
                        scores[i] = m.weights[cols] @ value_of(words)
                at_least = m.at_least(scores)
            else:
                at_least = np.zeros((batch.num_rows, 1))
            names = [c for c in batch.schema.names if c != "text"]
            extra = {"severity": at_least.sum(1), "p_toxic": at_least[:, 0]}
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(v, pa.float64()) for v in extra.values())], names=[*names, *extra])

    return run


def score(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """Severity of every row: doc_id, row (the whole input row), severity, p_toxic, toxic.

    severity is the expected grade, p_toxic the probability of grade 1 or more, and toxic says
    that it reaches the model's operating point (where it best parts the fitted sample). Whole texts are read. Null and empty texts have no features
    and score as the model's clean baseline; without a model (no labels of both classes) all
    rows score 0 and none is toxic.
    """
    base = with_row(docs)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    schema = T.StructType([base.schema["doc_id"], base.schema["row"], T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())])
    return base.mapInArrow(_score(shared), schema).withColumn("toxic", F.col("p_toxic") >= (0.5 if model is None else model.threshold))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_labelled(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", "severity", "p_toxic", "toxic", (~F.col("toxic")).alias("kept"))
