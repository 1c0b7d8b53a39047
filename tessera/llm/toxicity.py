"""Toxicity by a classifier chain: linear models in turn, later ones fed with earlier categories' probabilities."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .langid import LETTERS
from .runtime import prepare, table
from .words import chunks, word_hashes

#: Labelled documents used for training, in expectation; words that become features; folds; strength of the penalty.
SAMPLE, FEATURES, FOLDS, PENALTY = 6000, 256, 4, 1.0
#: Most deviations from the mean that count, so that a text unlike all labelled ones is judged by its words.
FAR = 4.0
#: Newton steps of a fit; chi square that a word must reach to become a feature; weight of recall against precision in choosing thresholds.
STEPS, CHI, BETA = 8, 15.0, 0.5
#: The categories in the order of the chain. Labels know one kind of toxicity; whether a document is of low quality is told first.
CHAIN = ("low_quality", "toxic")
_UPPER = bytes(1 if 65 <= c <= 90 else 0 for c in range(256))
_MARKS = bytes(1 if 33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 else 0 for c in range(256))


def documents(texts: list[str | None]):
    """For each text its distinct words as sorted hashes, and four figures of its whole: shares of capitals, of punctuation and of distinct
    words, and the logarithm of its number of words. Words are runs of letters and of bytes outside ASCII, in lower case."""
    for part in chunks(texts):
        h, bounds, _, _ = word_hashes(part, LETTERS)
        for t, a, b in zip(part, bounds[:-1], bounds[1:], strict=True):
            own = np.unique(h[a:b])
            n = max(len(t), 1)
            yield own, np.array([t.translate(_UPPER).count(1) / n, t.translate(_MARKS).count(1) / n, len(own) / max(b - a, 1), np.log1p(b - a)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights of an L2-penalised logistic regression, by Newton steps; the last column of x is the constant and isn't penalised."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(STEPS):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def informative(sets: list[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """Hashes of the words, in three documents or more, whose presence differs most, and by CHI at least, between y = 1 and y = 0; sorted."""
    if not sets:
        return np.zeros(0, np.uint64)
    words, at = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    n = np.bincount(at, minlength=len(words))
    hit = np.bincount(at, weights=y[doc], minlength=len(words))
    total, pos = len(sets), y.sum()
    expected = n * pos / total
    chi = (hit - expected) ** 2 * total**2 / np.maximum(n * (total - n) * 1.0 * max(pos, 1) * max(total - pos, 1) / total, 1e-9)
    chi[n < 3] = 0
    best = np.lexsort((words, -chi))[:most]
    return np.sort(words[best[chi[best] >= CHI]])


class Chain:
    """words: features; weights: for each category its linear model over figures, words, earlier probabilities and 1; cut: its threshold."""

    def __init__(self, words: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.words, self.mean, self.scale = words, mean, scale
        self.weights: list[np.ndarray] = []
        self.cut: list[float] = []

    def matrix(self, sets: list[np.ndarray], figures: np.ndarray) -> np.ndarray:
        x = np.zeros((len(sets), 4 + len(self.words)))
        x[:, :4] = np.clip((figures - self.mean) / self.scale, -FAR, FAR)
        if len(self.words):
            for i, s in enumerate(sets):
                at = np.searchsorted(self.words, s)
                hit = at < len(self.words)
                hit[hit] = self.words[at[hit]] == s[hit]
                x[i, 4 + at[hit]] = 1
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 0))
        for w in self.weights:
            out = np.hstack([out, sigmoid(np.hstack([x, out, np.ones((len(x), 1))]) @ w)[:, None]])
        return out


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold on p with the best F measure (BETA) against y, halfway to the next smaller value; 0.5 if y has no positive."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f = (1 + BETA**2) * hits / (np.arange(1, len(y) + 1) + BETA**2 * y.sum())
    last = np.append(p[order][:-1] != p[order][1:], True)
    at = int(np.argmax(np.where(last, f, 0)))
    return float((p[order][at] + (p[order][at + 1] if at + 1 < len(p) else 0)) / 2)


def fit(sets: list[np.ndarray], figures: np.ndarray, labels: np.ndarray, features: int = FEATURES, folds: int = FOLDS) -> Chain | None:
    """A chain from documents' words, figures and 0/1 labels (a column for each category).

    Each later model is trained with out-of-fold probabilities of the earlier ones, as it will meet them: for each fold, models,
    words and scales of the figures included, come from the other folds. Thresholds come from out-of-fold probabilities too.
    """
    n, k = labels.shape
    if n < 2 * folds:
        return None
    fold = np.arange(n) % folds
    own = max(1, features // k)

    def chosen(rows):
        return np.unique(np.concatenate([informative([sets[i] for i in rows], labels[rows, c], own) for c in range(k)]))

    def begun(rows):
        return Chain(chosen(rows), figures[rows].mean(axis=0), figures[rows].std(axis=0) + 1e-6)

    parts = [begun(np.flatnonzero(fold != f)).matrix(sets, figures) for f in range(folds)]
    full = begun(np.arange(n))
    x, seen = full.matrix(sets, figures), np.zeros((n, 0))
    for c in range(k):
        p = np.zeros(n)
        for f, xf in enumerate(parts):
            with_seen = np.hstack([xf, seen, np.ones((n, 1))])
            w = logistic(with_seen[fold != f], labels[fold != f, c])
            p[fold == f] = sigmoid(with_seen[fold == f] @ w)
        full.weights.append(logistic(np.hstack([x, seen, np.ones((n, 1))]), labels[:, c]))
        full.cut.append(best_cut(p, labels[:, c]))
        seen = np.hstack([seen, p[:, None]])
    return full


def _features(batches):
    for batch in batches:
        sets, figures = [], []
        for own, four in documents(batch.column("text").to_pylist()):
            sets.append(own.tobytes())
            figures.append(four.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), batch.column("toxic"), pa.array(sets, pa.binary()), pa.array(figures, pa.binary())], names=["doc_id", "quality", "toxic", "words", "figures"])


def _fitted(batches):
    """One row: the chain of all rows, which are a bounded sample."""
    rows = sorted(r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    chain = None
    if rows:
        _, quality, toxic, words, figures = zip(*rows, strict=True)
        labels = np.stack([np.array(quality) <= 0, np.array(toxic) > 0], axis=1).astype(float)
        chain = fit([np.frombuffer(b, np.uint64) for b in words], np.array([np.frombuffer(b, float) for b in figures]), labels)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chain)], pa.binary())], names=["chain"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """A chain from about `sample` labelled documents, picked by a hash of doc_id among all with both labels. A document labelled
    more than once takes its lowest quality and highest toxicity. The picked ones' words meet in one task, which fits the models. None if there is
    too little to learn from."""
    labels = labels.where("quality is not null and toxic is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    n = labels.count()
    if not n:
        return None
    picked = labels.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) < min(1.0, sample / n) * (1 << 30))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # about `sample` rows of 16 bytes
    fields = "doc_id long, quality int, toxic int, words binary, figures binary"
    got = rows.select("doc_id", "quality", "toxic", "text").mapInArrow(_features, fields)
    return pickle.loads(got.repartition(1).mapInArrow(_fitted, "chain binary").first()[0])


def _predictor(sent):
    def run(batches):
        chain = sent.value
        for batch in batches:
            p = np.zeros((batch.num_rows, len(CHAIN)))
            if chain is not None and batch.num_rows:
                sets, figures = zip(*documents(batch.column(1).to_pylist()), strict=True)
                p = chain.predict(chain.matrix(list(sets), np.array(figures)))
            cut = chain.cut if chain is not None else [1.0] * len(CHAIN)
            flags = p >= np.array(cut) if chain is not None else p > 1
            names = [",".join(c for c, on in zip(CHAIN, row, strict=True) if on) for row in flags]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, i]) for i in range(len(CHAIN))), pa.array(flags[:, 1]), pa.array(names, pa.string())], names=["doc_id", *(f"p_{c}" for c in CHAIN), "toxic", "categories"])

    return run


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """doc_id, a probability for each category, toxic and categories (comma-joined) for each row of docs (doc_id, text).

    Null and empty texts are scored as texts without words. Without a chain all probabilities are 0 and nothing is toxic.
    Repeated rows are scored each; an empty table gives an empty one; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    fields = ", ".join(["doc_id long", *(f"p_{c} double" for c in CHAIN), "toxic boolean", "categories string"])
    return docs.select("doc_id", "text").mapInArrow(_predictor(sent), fields)


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
