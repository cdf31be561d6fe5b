"""Language ID: a bidirectional gated recurrent network over the bytes of words, in numpy."""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table, written
from millrace.llm.words import pieces_of, raw_texts, words_of

#: The fit takes about this many texts of each language, chosen by hash.
FIT_ROWS = 250
#: Words of each language that the network sees, and how often; and words of all languages.
FIT_WORDS, EPOCHS, BATCH, RATE = 12_000, 3, 512, 0.01
ALL_WORDS = 600_000
HIDDEN = 16
#: A longer word is read in pieces of this many bytes.
MOST_BYTES = 48
#: Marks around words, which carry no language.
MARKS = b".,;:!?\"'()[]{}<>%*&$#|-_=+/\\"
LETTER = re.compile(rb"[A-Za-z]")
MOST_LANGUAGES = 1000


def has_letter(word: bytes) -> bool:
    return bool(LETTER.search(word)) or (not word.isascii() and any(c.isalpha() for c in word.decode(errors="replace")))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Forward and backward gated units over bytes; a softmax over languages at every byte."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        scale = 1 / np.sqrt(hidden)
        draw = lambda *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.params = {"xf": draw(256, 3 * hidden), "xb": draw(256, 3 * hidden), "uf": draw(hidden, 3 * hidden), "ub": draw(hidden, 3 * hidden), "v": draw(2 * hidden, len(languages)), "c": np.zeros(len(languages), np.float32)}

    def _run(self, x: np.ndarray, which: str, tape: list | None = None) -> np.ndarray:
        """States (n, batch, hidden) of one direction; ``tape`` collects what the way back needs."""
        table, u, k = self.params["x" + which], self.params["u" + which], self.hidden
        m, n = x.shape
        h = np.zeros((m, k), table.dtype)
        out = np.empty((n, m, k), table.dtype)
        for t in range(n) if which == "f" else range(n - 1, -1, -1):
            gx = table[x[:, t]]
            gh = h @ u
            zr = _sigmoid(gx[:, : 2 * k] + gh[:, : 2 * k])
            z, r = zr[:, :k], zr[:, k:]
            c = np.tanh(gx[:, 2 * k :] + r * gh[:, 2 * k :])
            new = c + z * (h - c)
            if tape is not None:
                tape.append((t, h, z, r, c, gh[:, 2 * k :]))
            out[t] = h = new
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(n, batch, languages): the label probabilities at every byte of equally long words."""
        both = np.concatenate((self._run(x, "f"), self._run(x, "b")), axis=2)
        logits = both @ self.params["v"] + self.params["c"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        return logits / logits.sum(axis=2, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all bytes and its gradients, by backpropagation through time."""
        p, k = self.params, self.hidden
        m, n = x.shape
        tapes = {"f": [], "b": []}
        both = np.concatenate([self._run(x, d, tapes[d]) for d in "fb"], axis=2)
        logits = both @ p["v"] + p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        e = np.exp(logits)
        prob = e / e.sum(axis=2, keepdims=True)
        loss = -float(np.log(prob[:, np.arange(m), y] + 1e-12).mean())
        d = prob
        d[:, np.arange(m), y] -= 1
        d /= m * n
        grads = {key: np.zeros_like(value) for key, value in p.items()}
        grads["v"] = np.einsum("nmh,nml->hl", both, d, optimize=True)
        grads["c"] = d.sum((0, 1))
        d_states = d @ p["v"].T
        one_hot = np.eye(256, dtype=p["v"].dtype)
        for at, which in enumerate("fb"):
            u = p["u" + which]
            dh = np.zeros((m, k), u.dtype)
            for t, before, z, r, c, ghc in reversed(tapes[which]):
                dh = dh + d_states[t, :, at * k : (at + 1) * k]
                dac = dh * (1 - z) * (1 - c * c)
                daz = dh * (before - c) * z * (1 - z)
                dar = dac * ghc * r * (1 - r)
                dgx = np.concatenate((daz, dar, dac), axis=1)
                dgh = np.concatenate((daz, dar, dac * r), axis=1)
                grads["x" + which] += one_hot[x[:, t]].T @ dgx
                grads["u" + which] += before.T @ dgh
                dh = dh * z + dgh @ u.T
        return loss, grads

    def train(self, words: dict[int, tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 6) -> None:
        """Adam over batches of equally long words. words: length -> (bytes, language numbers)."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for epoch in range(epochs):
            parts = []
            for n, (x, _) in sorted(words.items()):
                order = rng.permutation(len(x))
                parts += [(n, order[lo : lo + batch]) for lo in range(0, len(x), batch)]
            for j in rng.permutation(len(parts)):
                n, rows = parts[j]
                x, y = words[n]
                _, grads = self.gradients(x[rows], y[rows])
                step += 1
                weight = len(rows) / batch
                now = rate * weight * (0.3 if epoch == epochs - 1 else 1)
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.params[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def bare(word: bytes) -> bytes:
    return word.strip(MARKS).lower()


def cut(core: bytes) -> Iterator[bytes]:
    """A bare word in pieces of at most MOST_BYTES, cut between characters."""
    while len(core) > MOST_BYTES:
        at = MOST_BYTES
        while at and core[at] & 0xC0 == 0x80:
            at -= 1
        at = at or MOST_BYTES
        yield core[:at]
        core = core[at:]
    if core:
        yield core


def fit(pieces: list[tuple[str, bytes, int]]) -> Network | None:
    """Train on pieces of words, given as (language, piece, how often it is seen); None without any."""
    languages = sorted({lang for lang, _, _ in pieces})
    if not languages:
        return None
    numbers = {lang: i for i, lang in enumerate(languages)}
    by_length: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    for lang, piece, n in pieces:
        x, y = by_length[len(piece)]
        x += [np.frombuffer(piece, np.uint8)] * n
        y += [numbers[lang]] * n
    net = Network(languages)
    if len(languages) > 1:
        net.train({n: (np.stack(x), np.array(y)) for n, (x, y) in by_length.items()})
    return net


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches):
        found: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), raw_texts(batch.column("text"))):
            for core, n in Counter(map(bare, words_of(text))).items():
                if has_letter(core):
                    for piece in cut(core):
                        found[lang, piece] += n
        names, parts = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(parts, pa.binary()), pa.array(found.values(), pa.int64())], names=["lang", "piece", "n"])


class Reader:
    """Summed label probabilities of words, remembered within a task."""

    def __init__(self, net: Network, limit: int = 300_000):
        self.net, self.limit = net, limit
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.sums = np.zeros((1024, len(self.net.languages) + 1), np.float32)  # the last: bytes
        self.cores: dict[bytes, int] = {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.at) > self.limit:
            self.clear()
        new: dict[bytes, list[bytes]] = defaultdict(list)
        for w in words.difference(self.at):
            core = bare(w)
            if core in self.cores:
                self.at[w] = self.cores[core]
            else:
                new[core].append(w)
        if not new:
            return
        start = len(self.cores)
        if start + len(new) > len(self.sums):
            self.sums = np.concatenate((self.sums, np.zeros((max(len(self.sums), len(new)), self.sums.shape[1]), np.float32)))
        pieces: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
        for i, (core, raw) in enumerate(new.items(), start):
            self.cores[core] = i
            for w in raw:
                self.at[w] = i
            if has_letter(core):
                for part in cut(core):
                    pieces[len(part)][0].append(part)
                    pieces[len(part)][1].append(i)
        for n, (parts, rows) in pieces.items():
            x = np.frombuffer(b"".join(parts), np.uint8).reshape(len(parts), n)
            for lo in range(0, len(parts), 2048):
                p = self.net.probabilities(x[lo : lo + 2048]).sum(0)
                np.add.at(self.sums[:, :-1], rows[lo : lo + 2048], p)
                np.add.at(self.sums[:, -1], rows[lo : lo + 2048], np.float32(n))

    def pool(self, words: list[bytes]) -> np.ndarray | None:
        """Mean label probabilities over all bytes of words that hold a letter."""
        if not words:
            return None
        total = self.sums[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(0, dtype=np.float64)
        return total[:-1] / total[-1] if total[-1] else None


def spans(text: bytes, net: Network) -> list[tuple[int, int, str]]:
    """Labels of all positions of a text, as runs (first byte, bytes, language); bytes outside words have none."""
    out: list[list] = []
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", text or b""):
        left = len(m[0]) - len(m[0].lstrip(MARKS))
        core = bare(m[0])
        if not has_letter(core):
            continue
        begin = m.start() + left
        for part in cut(core):
            best = net.probabilities(np.frombuffer(part, np.uint8)[None])[:, 0].argmax(1)
            for k, b in enumerate(best, begin):
                if out and out[-1][2] == net.languages[b] and out[-1][0] + out[-1][1] == k:
                    out[-1][1] += 1
                else:
                    out.append([k, 1, net.languages[b]])
            begin += len(part)
    return [tuple(x) for x in out]


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network | None = pickle.loads(model.value)
        reader = Reader(net) if net else None
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            for lo in range(0, len(texts) if reader else 0, 512):
                words = [words_of(t) for t in texts[lo : lo + 512]]
                reader.learn(set().union(*words))
                for i, own in enumerate(words, lo):
                    p = reader.pool(own)
                    if p is not None:
                        best = int(p.argmax())
                        langs[i], scores[i] = net.languages[best], float(min(1.0, max(0.0, p[best])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def fit_labelled(docs: DataFrame, rows: int = FIT_ROWS, words: int = FIT_WORDS) -> Network | None:
    """Train on about ``rows`` whole texts of each non-null lang, chosen by hash; None without any.

    Words are counted on the executors. The driver gets about ``words`` of them for each language (fewer
    where there are more than ALL_WORDS / ``words`` languages), drawn by the square root of their counts. Of more
    than MOST_LANGUAGES languages those with most texts are learned.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    if not counts:
        return None
    share = docs.sparkSession.createDataFrame([(k, min(1.0, rows / n)) for k, n in counts.items()], "lang string, share double")
    some = known.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    found = written(some.select("lang", "text").mapInArrow(_count_pieces, "lang string, piece binary, n long").groupBy("lang", "piece").agg(F.sqrt(F.sum("n")).alias("w")))
    total = found.groupBy("lang").agg(F.sum("w").alias("all"))
    chance = F.pmod(F.xxhash64("lang", "piece"), F.lit(1_000_003)) / 1_000_003.0
    drawn = found.join(F.broadcast(total), "lang").withColumn("n", F.floor(F.col("w") / F.col("all") * min(words, ALL_WORDS // len(counts)) + chance).cast("int")).where("n > 0")
    return fit(sorted((r["lang"], bytes(r["piece"]), r["n"]) for r in drawn.select("lang", "piece", "n").collect()))


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every whole text.

    Words are read one by one (white space resets the state), so each distinct word of a task is read
    once; every byte of a word gets label probabilities and a document's are their mean over all its words. A null
    text, or one without letters, is ``und`` with score 0, as is every text without a network.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(net))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit_labelled(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return predict(docs, net).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
