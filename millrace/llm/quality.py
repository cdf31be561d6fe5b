"""Quality: document evidence combined with host and path posteriors by empirical Bayes."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import small_side, table, written
from millrace.llm.words import raw_texts, words_of

#: Labelled rows of each class that the classifier is fitted on, about, chosen by hash of doc_id.
FIT_ROWS = 10_000
#: Prior strengths are kept within these numbers of documents.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
FEATURES = ("log_words", "letters", "upper", "digits", "marks", "word_length", "distinct", "top_word", "long_words", "repeated_lines", "line_words")


def features_of(text: bytes | None) -> list[float]:
    """Shares of kinds of bytes, words and lines of a whole text; zeros for a null or empty one."""
    words = words_of(text)
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text) - counts[[9, 10, 11, 12, 13, 32]].sum()
    upper, lower = counts[65:91].sum(), counts[97:123].sum() + counts[128:].sum()
    seen: dict[bytes, int] = {}
    get = seen.get
    for w in words:
        seen[w] = get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x]
    return [
        np.log1p(len(words)), (upper + lower) / n, upper / max(1, upper + lower), counts[48:58].sum() / n, (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / n,
        min(20.0, n / len(words)), len(seen) / len(words) ** 0.9, max(seen.values()) / len(words), sum(1 for w in seen if len(w) > 30) / len(seen), 1 - len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)),
    ]


@dataclass
class Classifier:
    """Logistic regression over standardised features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def _wide(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        z = np.clip((x - mean) / scale, -6, 6)
        return np.concatenate((np.ones((len(z), 1)), z, z * z), axis=1)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> Classifier:
        mean, scale = x.mean(0), x.std(0) + 1e-6
        wide = cls._wide(x, mean, scale)
        # both classes weigh the same
        v = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum())) * len(y)
        w = np.zeros(wide.shape[1])
        for _ in range(rounds):  # Newton's method
            p = 1 / (1 + np.exp(-np.clip(wide @ w, -30, 30)))
            h = (wide * (v * p * (1 - p))[:, None]).T @ wide + ridge * np.eye(len(w))
            step = np.linalg.solve(h, wide.T @ (v * (y - p)) - ridge * w)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        return cls(mean, scale, w)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._wide(x, self.mean, self.scale) @ self.weights, -30, 30)))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features_of(t) for t in raw_texts(batch.column("text"))]
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(x, pa.list_(pa.float64()))], names=[*names, "x"])


def _classify(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Classifier | None = pickle.loads(model.value)
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, -1)
            p = c(x) if c is not None and len(x) else np.full(batch.num_rows, 0.5)
            names = [k for k in batch.schema.names if k != "x"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), pa.array(p, pa.float64())], names=[*names, "p"])

    return run


def fit_labelled(measured: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Classifier | None:
    """Fit on up to about ``rows`` labelled documents of each class; None without both classes."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).alias("good")).where("doc_id is not null and good is not null")
    counts = {r["good"]: r["n"] for r in marked.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("good"), rows / counts[True]).otherwise(rows / counts[False])
    some = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).distinct()
    got = measured.select("doc_id", "x").join(small_side(some, 4 * rows), "doc_id").toPandas()
    if not len(got) or got["good"].nunique() < 2:
        return None
    got = got.sort_values("doc_id", kind="stable")
    return Classifier.fit(np.stack(got["x"].to_list()), got["good"].to_numpy(bool))


def _strength(groups: DataFrame, mean: float) -> float:
    """Prior strength (in documents) from the spread of group means around their own prior's mean beyond chance, by moments.

    ``groups``: n, s, spread, and m, the mean of what each group shrinks toward (host or global) and over, the documents of that.
    """
    r = groups.agg(
        F.count("*").alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n") / F.col("over").cast("double")).alias("n2"),
        F.sum("spread").alias("within"), F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col("m")) ** 2).alias("between"), F.sum(F.col("n") / F.col("over").cast("double")).alias("k"),
    ).first()
    free = r["n"] - r["n2"] if r["n"] else 0
    if free <= 0:
        return MOST_STRENGTH
    extra = (r["between"] - (r["g"] - r["k"]) * r["within"] / r["n"]) / free
    return float(min(MOST_STRENGTH, max(LEAST_STRENGTH, mean * (1 - mean) / extra - 1))) if extra > 0 else MOST_STRENGTH


def posterior(scored: DataFrame) -> DataFrame:
    """Combine document chances with site posteriors.

    ``scored``: host, path, p and any other columns. Grouped sums give each path and host its evidence; a
    path shrinks toward its host and a host toward the global mean, the more the less it holds. A
    document's own evidence is taken out of its site first. Adds site (the path's posterior mean
    without the document) and q: logit q = logit p + logit site - logit global mean.
    """
    spread = F.sum(F.col("p") * (1 - F.col("p")))
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), spread.alias("spread")))
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("spread").alias("spread")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = min(1 - 1e-6, max(1e-6, (total["s"] or 0.0) / total["n"])) if total["n"] else 0.5
    at_host = _strength(hosts.withColumns({"m": F.lit(mean), "over": F.lit(total["n"] or 1)}), mean)
    own = hosts.select("host", (F.col("s") / F.col("n")).alias("m"), F.col("n").alias("over"))
    at_path = _strength(paths.join(own, "host"), mean)  # paths against their host's mean
    known = paths.select("host", "path", F.col("n").alias("path_n"), F.col("s").alias("path_s")).join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host")
    out = scored.join(small_side(written(known)), ["host", "path"])
    host_mean = (F.col("host_s") - F.col("p") + at_host * mean) / (F.col("host_n") - 1 + at_host)
    site = (F.col("path_s") - F.col("p") + at_path * host_mean) / (F.col("path_n") - 1 + at_path)
    logit = lambda x: F.log(F.greatest(F.lit(1e-9), x) / F.greatest(F.lit(1e-9), 1 - x))
    out = out.withColumn("site", site)
    score = logit(F.col("p")) + logit(F.col("site")) - float(np.log(mean / (1 - mean)))
    return out.withColumn("q", 1 / (1 + F.exp(-score))).drop("path_n", "path_s", "host_n", "host_s")


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """Quality of every row: doc_id, host, path, p (document alone), site, q (combined), kept (q >= 0.5).

    ``host`` and ``path`` are columns of ``docs``; nulls count as the empty name. Null and empty texts are
    measured as zeros. Without labels of both classes p is 0.5 everywhere and all rows are kept.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    measured = written(base.mapInArrow(_measure, "doc_id long, host string, path string, x array<double>"))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(fit_labelled(measured, labels)))
    scored = written(measured.mapInArrow(_classify(shared), "doc_id long, host string, path string, p double"))
    return posterior(scored).withColumn("kept", F.col("q") >= 0.5)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source (the host) and, below it, source and language (the path)."""
    docs = table(spark, sf_dir, "documents")
    made = score(docs, table(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))
    return made.select("doc_id", "host", "path", F.col("p").alias("p_document"), F.col("site").alias("p_site"), F.col("q").alias("quality"), "kept")
