"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded by a bounded vector: shares of character classes
in its bytes and in its word ends, word shape figures and repetition, and hashed character pairs. Gated
attention ``softmax(w . (tanh(V h) * sigmoid(U h)))``, learned from document labels alone, weighs the
passages; the weighted passage representation is scored by a logistic unit.

Fitting uses a bounded sample of labelled documents (``TRAIN_DOCS`` of each class, and fewer where their passages would
exceed ``TRAIN_PASSAGES``; documented bounds on rows). A sampled document gives all its passages, as in scoring; one of more than
``LONGEST`` of the bound is not sampled. Only the passage vectors of the sample reach the driver. Rows are drawn by a hash
of id and text and repeated rows count once, so copies of a text are drawn one by one. No scoring step has a cap.

Defined results: null and empty texts are one empty passage and get the score the model gives it; with
labels of one class only, the score is that class's share (0 or 1); with no labels it is 0.5; repeated
label rows of a document count by their least quality; repeated documents each get their row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import blocks, bounded_sample, draw_hash, id_remainder, materialize, release_memory, texts

PASSAGE_BYTES = 512
TRAIN_DOCS, TRAIN_PASSAGES = 4_000, 30_000  # of each class
LONGEST = 1 / 8
HASHED = 64
HIDDEN, ATTENTION = 24, 12
THRESHOLD = 0.3
EPOCHS, BATCH, RATE, DECAY, SEED = 30, 128, 5e-3, 1e-4, 7

# Byte classes: lower, upper, digit, space, line end, comma and full stop, other marks one by one, rest.
_MARKS = "!?#$%&*|<>=/\\@+_-'\"():;[]{}~^`"
CLASSES = 8 + len(_MARKS)


def _class_table() -> np.ndarray:
    out = np.full(256, 6, dtype=np.int64)
    for b in range(256):
        ch = chr(b)
        if "a" <= ch <= "z":
            out[b] = 0
        elif "A" <= ch <= "Z":
            out[b] = 1
        elif "0" <= ch <= "9":
            out[b] = 2
        elif ch == " ":
            out[b] = 3
        elif ch in "\n\r":
            out[b] = 4
        elif ch in ".,":
            out[b] = 5
        elif b >= 0x80:
            out[b] = 7
        elif ch in _MARKS:
            out[b] = 8 + _MARKS.index(ch)
    return out


_CLASS = _class_table()
DIM = 2 * CLASSES + 5 + HASHED


def passages(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of all documents (whole texts) and the number of passages of each document."""
    size = np.array([len(d) for d in documents], dtype=np.int64)
    count = np.maximum(1, -(-size // PASSAGE_BYTES))
    data = np.frombuffer(b"".join(documents), dtype=np.uint8)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    offset = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    # equal parts, so that the last passage of a document isn't a scrap
    bag = np.repeat(first, size) + offset * np.repeat(count, size) // np.maximum(np.repeat(size, size), 1)
    n = int(count.sum())
    kind = _CLASS[data]
    shares = np.bincount(bag * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float32)
    length = np.maximum(shares.sum(axis=1, keepdims=True), 1)
    blank = (kind == 3) | (kind == 4)
    last = np.flatnonzero(~blank & np.append(blank[1:], True)) if len(data) else np.zeros(0, dtype=np.int64)
    ends = np.bincount(bag[last] * CLASSES + kind[last], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float32)
    n_words = np.maximum(ends.sum(axis=1, keepdims=True), 1)
    lines = shares[:, 4:5]
    word_at = np.concatenate([[0], last[:-1]]) if len(last) else last
    word_len = last - word_at
    long_words = np.bincount(bag[last], weights=word_len > 14, minlength=n)[:, None]
    short_words = np.bincount(bag[last], weights=word_len <= 3, minlength=n)[:, None]
    pair = (data[:-1].astype(np.int64) * 31 + data[1:]) * 0x9E3779B1 >> 12 & (HASHED - 1) if len(data) > 1 else np.zeros(0, dtype=np.int64)
    hashed = np.bincount(bag[:-1] * HASHED + pair, minlength=n * HASHED).reshape(n, HASHED) if len(pair) else np.zeros((n, HASHED))
    distinct = _distinct_pairs(data, bag, n)
    return np.hstack(
        [shares / length, ends / n_words, length / n_words / 16, lines / n_words * 8, long_words / n_words, short_words / n_words,
         distinct[:, None] / length, hashed / length * 4]
    ).astype(np.float32), count


def _distinct_pairs(data: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
    """Different 4-byte strings in each passage: low where a passage repeats itself."""
    if len(data) < 4:
        return np.zeros(n)
    gram = np.zeros(len(data) - 3, dtype=np.int64)
    for k in range(4):
        gram = gram * 257 + data[k : len(data) - 3 + k]
    slots = 1024
    slot = (gram * 0x9E3779B1 >> 15) & (slots - 1)
    seen = np.zeros(n * slots, dtype=bool)
    seen[bag[: len(gram)] * slots + slot] = True
    return seen.reshape(n, slots).sum(axis=1)


@dataclass
class MilModel:
    """Parameters of the gated attention network; ``constant`` is set where nothing could be learned."""

    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None
    constant: float | None = None

    def score(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(count), self.constant)
        return _forward(self.weights, (x - self.mean) / self.scale, count)["p"]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(w: dict, x: np.ndarray, count: np.ndarray) -> dict:
    start = np.concatenate([[0], np.cumsum(count)])[:-1]
    h = np.tanh(x @ w["E"] + w["e"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    a = (t * g) @ w["a"]
    a = np.exp(a - np.repeat(np.maximum.reduceat(a, start), count))
    a /= np.repeat(np.add.reduceat(a, start), count)
    z = np.add.reduceat(h * a[:, None], start, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["o"] + w["b"]), "start": start}


def _gradients(w: dict, x: np.ndarray, count: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    f = _forward(w, x, count)
    d_out = (f["p"] - y) * weight / weight.sum()
    d_z = np.repeat(d_out[:, None] * w["o"], count, axis=0)
    d_h = d_z * f["a"][:, None]
    d_a = (d_z * f["h"]).sum(axis=1)
    inner = np.repeat(np.add.reduceat(d_a * f["a"], f["start"]), count)
    d_logit = f["a"] * (d_a - inner)
    d_tg = d_logit[:, None] * w["a"]
    d_t, d_g = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
    d_h += d_t @ w["V"].T + d_g @ w["U"].T
    d_x = d_h * (1 - f["h"] ** 2)
    return {
        "E": x.T @ d_x, "e": d_x.sum(axis=0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_g,
        "a": (f["t"] * f["g"]).T @ d_logit, "o": f["z"].T @ d_out, "b": d_out.sum(keepdims=True),
    }


def train(bags: list[np.ndarray], y: np.ndarray) -> MilModel:
    """Adam on the logistic loss; the rarer class is weighted up to half the loss. Fixed seed and row order."""
    if not len(y):
        return MilModel(constant=0.5)
    if len(set(y.tolist())) == 1:
        return MilModel(constant=float(y[0]))
    rng = np.random.default_rng(SEED)
    every, cut = np.vstack(bags), np.cumsum([len(b) for b in bags])[:-1]
    mean, scale = every.mean(axis=0), every.std(axis=0) + 0.02
    every -= mean
    every /= scale
    bags = np.split(every, cut)
    init = lambda *s: rng.normal(0, s[0] ** -0.5, s)
    w = {"E": init(DIM, HIDDEN), "e": np.zeros(HIDDEN), "V": init(HIDDEN, ATTENTION), "U": init(HIDDEN, ATTENTION),
         "a": init(ATTENTION), "o": init(HIDDEN), "b": np.zeros(1)}
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            at = order[i : i + BATCH]
            g = _gradients(w, np.vstack([bags[j] for j in at]), np.array([len(bags[j]) for j in at]), y[at], weight[at])
            step += 1
            for k in w:
                g[k] += DECAY * w[k]
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return MilModel(mean, scale, w)


def _passage_count() -> Column:
    return F.greatest(F.lit(1), F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / PASSAGE_BYTES))


def _drawn(rows: DataFrame, bound: int, passage_bound: int, key: list[str], draw: Column | None = None) -> DataFrame:
    """The sampled rows of ``rows(quality, size, *key)``; with ``draw`` in place of the key's columns."""
    rows = rows.where(F.col("quality").isin(0, 1) & (F.col("size") <= passage_bound * LONGEST))
    total = {r["quality"]: r for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("passages")).collect()}
    share = {q: min(1.0, bound / r["n"], passage_bound / r["passages"]) for q, r in total.items()}
    return bounded_sample(rows, {q: share[q] * r["n"] for q, r in total.items()}, "quality", key=key, draw=draw)


def training_sample(labelled: DataFrame, bound: int = TRAIN_DOCS, passage_bound: int = TRAIN_PASSAGES) -> DataFrame:
    """About ``bound`` rows of ``labelled([doc_id,] text, quality)`` of each quality at most, with about ``passage_bound`` passages at most."""
    key = [c for c in ("doc_id", "text") if c in labelled.columns]
    drawn = _drawn(labelled.select(*key, "quality", _passage_count().alias("size")), bound, passage_bound, key).drop("size")
    return drawn.dropDuplicates([*key, "quality"]) if "doc_id" in key else drawn


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS, passage_bound: int = TRAIN_PASSAGES) -> DataFrame:
    """``training_sample`` of the labelled documents, drawn before their texts are fetched: labels are joined to ids, sizes and
    hashes alone, and the texts of the drawn rows (bounded, broadcast) are read without a shuffle."""
    key = ["doc_id", "text"]
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    sized = docs.select("doc_id", "text", _passage_count().alias("size"), draw_hash(key).alias("draw"))
    rows = materialize(sized.drop("text").join(one, "doc_id"))
    drawn = _drawn(rows, bound, passage_bound, key, F.col("draw")).distinct()
    return sized.join(F.broadcast(drawn), ["doc_id", "size", "draw"]).select(*key, "quality").dropDuplicates([*key, "quality"])


def fit(labelled: DataFrame, bound: int = TRAIN_DOCS, passage_bound: int = TRAIN_PASSAGES) -> MilModel:
    """Fit on ``training_sample`` of ``labelled([doc_id,] text, quality)``."""
    return fit_sample(training_sample(labelled, bound, passage_bound))


def fit_sample(sample: DataFrame) -> MilModel:
    """Fit on all rows of ``sample(text, quality)``."""
    rows = sample.select("text", "quality")

    def run(batches):
        for batch in blocks(batches):
            x, count = passages([t.encode("utf-8", "surrogatepass") for t in texts(batch)])
            at = np.concatenate([[0], np.cumsum(count)])
            out = [x[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(out, pa.binary())], names=["quality", "x"])

    got = rows.mapInArrow(run, "quality int, x binary").toPandas()
    got = got.sort_values(["quality", "x"], ignore_index=True)  # the same fit under any partitioning
    model = train([np.frombuffer(x, dtype=np.float32).reshape(-1, DIM) for x in got["x"]], got["quality"].to_numpy(dtype=float))
    del got
    release_memory()  # the driver goes on for long
    return model


def _scores(batch: pa.RecordBatch, model: MilModel) -> np.ndarray:
    return model.score(*passages([t.encode("utf-8", "surrogatepass") for t in texts(batch)]))


def score(docs: DataFrame, model: MilModel) -> DataFrame:
    """``doc_id, score`` of every row of ``docs(doc_id, text)``; no shuffle."""

    def run(batches):
        for batch in blocks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch, model), pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: MilModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores at least ``threshold``; no shuffle."""

    def run(batches):
        for batch in blocks(batches):
            yield batch.filter(pa.array(_scores(batch, model) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def fit_outside_fold(spark, docs: DataFrame, sf_dir: str) -> MilModel:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return fit_sample(labelled_sample(docs.where(id_remainder("doc_id", 5) != 0), labels))


def query(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out fifth."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_outside_fold(spark, docs, sf_dir)
    return score(docs, model).select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
