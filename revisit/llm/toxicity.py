"""Toxicity by logistic regression, trained with FTRL-proximal on hashed word n-grams and skip-grams.

Features of a text are its distinct words, pairs of neighbouring words and pairs with one word between,
hashed to 30 bits. FTRL-proximal keeps a sum of adjusted gradients z and of squared gradients n for every
coordinate: its learning rate falls with its own n, and its weight is zero while |z| is at most the L1
strength. What remains is a short list of weights, which every scoring task gets.

A feature of too few training texts can't reach the L1 strength at all, as a gradient is 1 at most, and is
left out before training without changing the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisit.llm import words
from revisit.llm.common import remainder, stored

BITS = 30
TRAIN_ROWS = 10_000
ALPHA, BETA, L2, EPOCHS = 2.0, 1.0, 0.0, 4
L1_LEAST, L1_PER_ROW = 1.5, 0.002  # the L1 strength grows with the training rows, as the gradients' sums do

#: ASCII marks separate words here, so that a word is the same before a stop or a comma.
MARKS_AS_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def features(texts: Sequence[bytes | None]) -> Iterator[np.ndarray]:
    """Each text's distinct features, ascending; none for an empty or null text."""
    salts = words.stream(3, 61) | np.uint64(1)
    for _, hashes, offsets in words.hashed(t and t.translate(MARKS_AS_SPACE) for t in texts):
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            h = hashes[a:b]
            kinds = [h * salts[0]]
            for k in (1, 2):
                kinds.append((h[:-k] * salts[k] + h[k:]) * salts[0] + np.uint64(k)) if len(h) > k else None
            out = words.mix(np.concatenate(kinds)) >> np.uint64(64 - BITS)
            out.sort()
            yield out[np.concatenate(([True], out[1:] != out[:-1]))] if len(out) else out


def strength(rows: int) -> float:
    """The L1 strength for so many training rows."""
    return max(L1_LEAST, L1_PER_ROW * rows)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, alpha: float = ALPHA, beta: float = BETA, l1: float | None = None, l2: float = L2, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight other than zero, ascending, their weights, and the bias."""
    l1 = strength(len(rows)) if l1 is None else l1
    names, seen = np.unique(np.concatenate([*rows, np.zeros(0, dtype=np.uint64)]), return_counts=True)
    names = names[seen * epochs > l1]
    kept = []
    for x in rows:
        place = np.searchsorted(names, x)
        place[place == len(names)] = 0
        kept.append(place[names[place] == x].astype(np.int32) if len(names) else np.zeros(0, dtype=np.int32))
    z, n = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    bias = len(names)  # the bias has no L1 part

    def weights(i: np.ndarray) -> np.ndarray:
        free = np.where(i == bias, 0.0, l1)
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - free, 0)
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for x, y in zip(kept, labels):
            i = np.append(x, bias)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(n[i])
            z[i] += g - (np.sqrt(n[i] + g * g) - root) / alpha * w
            n[i] += g * g
    final = weights(np.arange(len(names) + 1))
    use = np.flatnonzero(final[:-1])
    return names[use], final[use], float(final[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """The model from at most `rows` labelled documents, those with the smallest hash of their id.

    Labels other than 0 and 1 and null ids are left out; an id labelled twice counts once, as 1 if any
    label says so; of documents that repeat an id, the smallest text counts. Without any usable row the
    model has no weights and the bias 0. Features are counted first, so that the one task that learns row by
    row gets only those that enough texts have; only these and the weights come to the driver. A feature
    that does is in more than a share of L1_PER_ROW / EPOCHS of the training rows, so there are fewer of them
    than the mean text has features, times 2,000.
    """
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(rows)
    )
    # `rows` bounds the broadcast
    sample = docs.join(F.broadcast(chosen), docs[id_col] == chosen["id"]).select("place", "id", "label", F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.astype("<u4").tobytes() for x in features(words.as_bytes(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], names=["place", "id", "label", "x"])

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(x.as_py(), dtype="<u4") for x in batch.column(0))])
            names, seen = np.unique(every, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(seen)], names=["feature", "seen"])

    kinds = "place long, id long, label int, x binary"
    one = sample.mapInArrow(featured, kinds).groupBy("place", "id").agg(F.min(F.struct("x", "label")).alias("r"))
    one = stored(one.select("place", "id", "r.label", "r.x"))
    many = one.count()
    if not many:
        return np.zeros(0, dtype=np.uint64), np.zeros(0), 0.0
    counts = one.select("x").mapInArrow(occurrences, "feature long, seen long").groupBy("feature").agg(F.sum("seen").alias("seen"))
    able = counts.where(F.col("seen") * EPOCHS > strength(many)).select("feature").toArrow()
    able = np.sort(able.column("feature").to_numpy()).astype("<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in batch.column(3):
                x = np.frombuffer(raw.as_py(), dtype="<u4")
                place = np.minimum(np.searchsorted(able, x), max(0, len(able) - 1))
                found.append(x[able[place] == x].tobytes() if len(able) else b"")
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], names=["place", "id", "label", "x"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("id", "ascending")])
        x = [np.frombuffer(b.as_py(), dtype="<u4") for b in table.column("x")]
        names, w, bias = ftrl(x, table.column("label").to_numpy().astype(float))
        return pa.table({"feature": np.append(names.astype(np.int64), -1), "weight": np.append(w, bias)})

    learned = one.mapInArrow(cut, kinds).withColumn("model", F.lit(0)).groupBy("model").applyInArrow(learn, "feature long, weight double").toArrow()
    names, w = learned.column("feature").to_numpy(), learned.column("weight").to_numpy()
    order = np.argsort(names)
    return names[order][1:].astype(np.uint64), w[order][1:], float(w[order][0])


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Adds the probability that a whole text is toxic; null counts as empty, whose score is the bias's.

    A scan without a shuffle. A column named like the score is replaced; all others are kept.
    """
    names, w, bias = model
    docs = docs.drop(score_col)
    schema = docs.withColumn(score_col, F.lit(0.0)).schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.full(batch.num_rows, bias)
            for r, x in enumerate(features(words.as_bytes(batch.column(at)))):
                if len(names) and len(x):
                    place = np.searchsorted(x, names)
                    place[place == len(x)] = 0
                    sums[r] += w[x[place] == names].sum()
            found = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=schema.names)

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's id, whether it was held out of training, its score and the prediction.

    Rows whose crc32(id) modulo 5 is 0 are held out. Null ids are scored too.
    """
    model = train(docs, labels.where(remainder(F.col(id_col), 5) != 0), id_col, text_col)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), (remainder(F.col(id_col), 5) == 0).alias("held_out"))
    out = scored(rows, model, "text")
    return out.select(id_col, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
