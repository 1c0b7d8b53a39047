"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy, with calibrated rejection."""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .runtime import prepare, table
from .words import PIECE, chunks

#: Documents of each language used for training, in expectation; buckets of the subword hash; size of an embedding.
SAMPLE, BUCKETS, DIM, EPOCHS = 400, 1 << 15, 16, 8
#: Lengths in bytes of the subwords.
GRAMS = (2, 3, 4)
#: Rejection: a text goes whose lead of the best language over the second is under MARGIN of what all but REJECT of the rightly labelled whole
#: calibration texts have.
REJECT, MARGIN = 0.01, 0.25
#: What a row of the sample is: a whole text, a piece of one, a piece whose characters are shuffled.
WHOLE, PART, JUNK = 0, 1, 2
#: ASCII other than letters becomes a space, A-Z becomes a-z.
LETTERS = bytes(c if c > 127 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the texts, and where each text's begin (one more entry than texts).
    Runs of non-letters count as one space; subwords don't cross texts; a text of one byte or more has at least one."""
    folded = [b" " + t.translate(LETTERS) + b"    " for t in texts]
    data = np.frombuffer(b"".join(folded), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, folded), np.int64, len(folded)))
    space = data == 32
    keep = ~(space & np.concatenate([[False], space[:-1]]))
    keep[np.concatenate([[0], ends[:-1]]).astype(np.int64)] = True
    data = data[keep].astype(np.uint32)
    place = np.concatenate([[0], np.cumsum(keep)])
    bounds = place[np.concatenate([[0], ends])]
    n = len(data)
    out = np.empty((n, len(GRAMS)), np.uint16)
    for g, size in enumerate(GRAMS):
        h = np.full(n, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for j in range(size):
            part = np.zeros(n, np.uint32)
            part[: max(0, n - j)] = data[j:]
            h = (h ^ part) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        out[:, g] = h >> np.uint32(32 - BUCKETS.bit_length() + 1)
    # the last positions of a text would reach into the next one: they take the last bucket that fits instead
    for size, g in zip(GRAMS, range(len(GRAMS)), strict=True):
        for j in range(1, size):
            at = bounds[1:] - j
            at = at[at >= bounds[:-1]]
            out[at, g] = 0
    return out.reshape(-1), bounds * len(GRAMS)


def _sampled(batches):
    """Counted buckets of each text, of a short piece of it, so that short texts are learned too, and of such a piece with its characters shuffled, which is
    in no language: calibration meets those."""
    for batch in batches:
        langs, out = batch.column(1).to_pylist(), ([], [], [], [])
        texts = batch.column(2).to_pylist()
        for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), texts, strict=True)):
            text = text or ""
            rng = np.random.default_rng(abs(doc_id or 0))
            size = int(rng.integers(10, 200))
            at = int(rng.integers(0, max(1, len(text) - size)))
            shuffled = "".join(text[at + i] for i in rng.permutation(min(size, len(text) - at)))
            for kind, piece in ((WHOLE, text), (PART, text[at : at + size]), (JUNK, shuffled)):
                b, _ = buckets([piece.encode("utf-8", "surrogatepass")])
                idx, n = np.unique(b, return_counts=True)
                out[0].append(langs[i])
                out[1].append(idx.astype(np.uint16).tobytes())
                out[2].append((n / n.sum()).astype(np.float32).tobytes())
                out[3].append(kind)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.int32())], names=["lang", "idx", "share", "kind"])


def _in_pieces(texts: list[bytes]):
    """(numbers of texts, pieces): short texts whole and together, each longer one piece by piece, cut behind spaces, so that memory is bounded."""
    short = [i for i, t in enumerate(texts) if len(t) <= PIECE]
    if short:
        yield short, [texts[i] for i in short]
    for i, t in enumerate(texts):
        at = 0
        while len(t) > PIECE and at < len(t):
            end = t.find(b" ", at + PIECE) + 1 or len(t)
            yield [i], [t[at:end]]
            at = end


class Model:
    """table: each bucket's contribution to the languages' logits; a text's logits are their mean plus bias, times scale. reject: the least
    lead of the best language's logit over the second's."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, scale: float = 1.0, reject: float = 0.0):
        self.langs, self.table, self.bias, self.scale, self.reject = langs, table, bias, scale, reject

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best language of each text, its probability, and whether the text is rejected."""
        sums, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for at, pieces in _in_pieces(texts):
            b, bounds = buckets(pieces)
            np.add.at(n, at, np.diff(bounds))
            for c in range(len(self.langs)):
                upto = np.concatenate([[0], np.cumsum(self.table[b, c], dtype=np.float64)])
                np.add.at(sums[:, c], at, upto[bounds[1:]] - upto[bounds[:-1]])
        logits = sums / np.maximum(n, 1)[:, None] + self.bias
        p = softmax(logits * self.scale)
        return p.argmax(axis=1), p.max(axis=1), lead(logits * self.scale) < self.reject


def lead(z: np.ndarray) -> np.ndarray:
    """How far the largest of each row is before the second; infinitely far where it is the only one."""
    top = np.sort(z, axis=-1)
    return top[..., -1] - top[..., -2] if z.shape[-1] > 1 else np.full(z.shape[:-1], np.inf)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 7) -> Model | None:
    """A model from (language, distinct buckets, their shares, kind). Every third row, and shuffled ones among them, calibrate the scale, so that texts get
    their language's probability and shuffled ones that of a guess, and rejection."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    held, used = rows[::3], [r for i, r in enumerate(rows) if i % 3 and r[3] != JUNK] or [r for r in rows if r[3] != JUNK]
    at = {x: i for i, x in enumerate(langs)}
    e = (rng.random((BUCKETS, DIM)) - 0.5) / DIM
    w, bias = np.zeros((len(langs), DIM)), np.zeros(len(langs))
    steps, step = epochs * len(used), 0
    for _ in range(epochs):
        for i in rng.permutation(len(used)):
            lang, idx, share, _ = used[i]
            rate = 0.5 * (1 - step / steps)
            step += 1
            h = share @ e[idx]
            g = softmax(w @ h + bias)
            g[at[lang]] -= 1
            back = w.T @ g
            w -= rate * np.outer(g, h)
            bias -= 0.1 * rate * g
            e[idx] -= rate * 200 * share[:, None] * back  # an average hides each subword behind hundreds of others
    table = e @ w.T
    size = max(float(np.abs(table).max(initial=0)), 1e-12)  # only ratios count: the scale is calibrated next
    model = Model(langs, (table / size).astype(np.float32), bias / size)
    logits = np.array([share @ model.table[idx] + model.bias for _, idx, share, _ in held])
    y, kind = np.array([at[lang] for lang, _, _, _ in held]), np.array([r[3] for r in held])

    def loss(scale: float) -> float:
        logs = np.log(np.maximum(softmax(logits * scale), 1e-12))
        own = -logs[kind != JUNK, y[kind != JUNK]]
        return float((own.mean() if len(own) else 0) - (logs[kind == JUNK].mean() if (kind == JUNK).any() else 0))

    model.scale = min((2.0 ** (k / 2) for k in range(-10, 50)), key=loss)
    far = np.sort(lead(logits * model.scale)[(kind == WHOLE) & (logits.argmax(axis=1) == y)])
    model.reject = float(MARGIN * far[math.floor(REJECT * len(far))]) if len(far) and np.isfinite(far[0]) else 0.0
    return model


def _fitted(batches):
    """One row: the model of all rows, which are a bounded sample."""
    rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    model = fit([(a, np.frombuffer(b, np.uint16), np.frombuffer(c, np.float32), kind) for a, b, c, kind in sorted(rows)])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from about `sample` documents (doc_id, text, lang) of each non-null language, picked by a hash of doc_id.
    A language is a value of lang; their number is taken to be small. The counts that set each language's rate cover all documents; the picked ones' counted subwords meet in one task, which fits the model."""
    docs = docs.where("lang is not null and text is not null")
    rates = {r[0]: min(1.0, sample / r[1]) for r in docs.groupBy("lang").count().collect()}
    if not rates:
        return None
    rate = F.element_at(F.create_map(*[F.lit(x) for pair in rates.items() for x in pair]), F.col("lang"))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) < rate * (1 << 30))
    counted = picked.select("doc_id", "lang", "text").mapInArrow(_sampled, "lang string, idx binary, share binary, kind int")
    return pickle.loads(counted.repartition(1).mapInArrow(_fitted, "model binary").first()[0])


def _predictor(sent):
    def run(batches):
        model = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            known = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
            best, score, rejected = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.ones(len(texts), bool)
            if model is not None:
                done = 0
                for part in chunks(texts):
                    best[done : done + len(part)], score[done : done + len(part)], rejected[done : done + len(part)] = model.predict(part)
                    done += len(part)
            lang = [model.langs[b] if ok and model is not None else "und" for b, ok in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(rejected | ~known)], names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of docs (doc_id, text; other columns are ignored). Texts that are null or without a letter are `und` with
    score 0 and rejected, as are all texts if there was nothing to learn from; rejected too are those in none of the languages, as far as the lead of
    the best one tells. Whole texts count, however long; repeated rows and rows without a doc_id are predicted each; an empty table gives an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_predictor(sent), "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of all documents; learns from those that aren't held out."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    out = predict(docs, train(docs.where(~held_out())))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def _keeper(sent, at: int):
    def run(batches):
        model = sent.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            keep = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
            if model is not None:
                done = 0
                for part in chunks(texts):
                    keep[done : done + len(part)] &= ~model.predict(part)[2]
                    done += len(part)
            yield batch.filter(pa.array(keep))

    return run


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without text or a letter and those that the model rejects; without a language to learn from, only the former. Each row is judged by
    its text alone, so rows without a doc_id and repeated ones are kept or dropped as others are; an empty table gives an empty one."""
    prepare(spark)
    sent = spark.sparkContext.broadcast(train(docs.where(~held_out())))
    return docs.mapInArrow(_keeper(sent, docs.columns.index("text")), docs.schema)
