"""Quality classifier: gated-attention multiple-instance learning (Ilse et al. 2018).

A document is a bag of passages.  Every passage is encoded from its bytes,
gated attention weighs the passages, and the weighted sum of their encodings is
scored.  Only documents carry labels; the attention is learned from them.  The
model is small and is fitted on a bounded sample of labelled documents; scoring
reads every whole text in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import table
from telemetry_lake.llm.text import LOWER, SPACE, chunks, span_hashes, word_spans

PASSAGE = 512  # bytes
SAMPLE = 6000  # labelled documents that the model is fitted on, at most
SAMPLE_BYTES = 64 << 20  # text of these documents in all, at most; each is read whole
FOLDS, HELD = 4, 2
THRESHOLD = 0.7

#: Byte classes: lower, upper, digit, space, line end, stops, marks in words, shouts, symbols, rules, lead, inner byte.
_CLASS = np.full(256, 9, dtype=np.int64)
for _bytes, _class in (
    (range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), ((32, 9), 3), ((10, 13), 4), (b".,;:", 5),
    (b"'\"-()", 6), (b"!?", 7), (b"#$%&*@", 8), (range(128, 192), 11), (range(192, 256), 10),
):
    _CLASS[list(_bytes)] = _class
_CLASSES = 12
_BINS = 256
FEATURES = _CLASSES * _CLASSES + 5


def passage_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, number of passages before each row); an empty text is one empty passage."""
    size = np.diff(off)
    per_row = np.maximum(1, -(-size // PASSAGE))
    first = np.append(0, np.cumsum(per_row))
    total = int(first[-1])
    row = np.repeat(np.arange(len(size)), size)
    passage = first[row] + (np.arange(len(data)) - off[row]) // PASSAGE if len(data) else np.zeros(0, np.int64)
    length = np.bincount(passage, minlength=total).astype(float)
    some = np.maximum(length, 1)
    kind = _CLASS[data]
    follow = np.full(len(data), 4)  # a row ends like a line
    follow[:-1] = kind[1:]
    last = off[1:][size > 0] - 1
    follow[last] = 4
    pairs = np.bincount(passage * _CLASSES**2 + kind * _CLASSES + follow, minlength=total * _CLASSES**2)
    pairs = pairs.reshape(total, -1) / some[:, None]
    low = LOWER[data]
    starts, ends, _ = word_spans(low, off, SPACE)
    at = passage[starts]
    words = np.bincount(at, minlength=total).astype(float)
    chars = np.bincount(at, weights=ends - starts, minlength=total)
    seen = np.zeros(total * _BINS, dtype=bool)
    seen[at * _BINS + (span_hashes(low, starts, ends) & np.uint64(_BINS - 1)).astype(np.int64)] = True
    different = seen.reshape(total, _BINS).sum(axis=1)
    # distinct words against what as many different words would hit of the bins
    expected = _BINS * (1 - (1 - 1 / _BINS) ** words)
    mean = chars / np.maximum(words, 1)
    extra = np.stack(
        [different / np.maximum(expected, 1), np.minimum(mean, 40) / 10, words / some * 5, length / PASSAGE, length == 0], axis=1
    )
    return np.hstack([np.sqrt(pairs), extra]).astype(np.float32), first


@dataclass
class Model:
    """Weights of the encoder (one hidden layer), the gated attention and the classifier."""

    center: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        w = self.weights
        x = (x - self.center) / self.scale
        h = np.tanh(x @ w["We"] + w["be"])
        v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        a = (v * u) @ w["a"]
        starts, counts = first[:-1], np.diff(first)
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), counts))
        a /= np.repeat(np.add.reduceat(a, starts), counts)
        z = np.add.reduceat(h * a[:, None], starts, axis=0)
        return {"x": x, "h": h, "v": v, "u": u, "att": a, "z": z, "logit": z @ w["w"] + w["b"][0]}

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(first) < 2:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.forward(x, first)["logit"], -30, 30)))


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, hidden: int = 24, gate: int = 8,
        epochs: int = 60, batch: int = 256, seed: int = 7) -> Model:
    """Adam on the documents' log loss; all passages' attention is learned from document labels."""
    rng = np.random.default_rng(seed)
    center = x.mean(axis=0) if len(x) else np.zeros(FEATURES, np.float32)
    scale = x.std(axis=0) + 0.02 if len(x) else np.ones(FEATURES, np.float32)
    init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    rate = np.clip(label.mean(), 0.02, 0.98) if len(label) else 0.5
    w = {"We": init(FEATURES, hidden), "be": np.zeros(hidden), "V": init(hidden, gate), "U": init(hidden, gate),
         "a": init(gate), "w": init(hidden), "b": np.array([np.log(rate / (1 - rate))])}
    model = Model(center, scale, w)
    if not len(label):
        return model
    m = {k: np.zeros_like(p) for k, p in w.items()}
    s = {k: np.zeros_like(p) for k, p in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        for k in range(0, len(order), batch):
            bags = order[k : k + batch]
            counts = first[bags + 1] - first[bags]
            inside = np.append(0, np.cumsum(counts))
            rows = np.arange(inside[-1]) + np.repeat(first[bags] - inside[:-1], counts)
            f = model.forward(x[rows], inside)
            d = (1 / (1 + np.exp(-f["logit"])) - label[bags]) / len(bags)
            each = np.repeat(d, counts)
            dz = each[:, None] * w["w"]
            # through the attention's softmax to the passages
            gain = (f["h"] * dz).sum(axis=1)
            mean = np.repeat(np.add.reduceat(gain * f["att"], inside[:-1]), counts)
            da = f["att"] * (gain - mean)
            dv = da[:, None] * w["a"] * f["u"] * (1 - f["v"] ** 2)
            du = da[:, None] * w["a"] * f["v"] * f["u"] * (1 - f["u"])
            dh = (f["att"][:, None] * dz + dv @ w["V"].T + du @ w["U"].T) * (1 - f["h"] ** 2)
            grad = {"We": f["x"].T @ dh + 1e-4 * w["We"], "be": dh.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                    "a": (f["v"] * f["u"]).T @ da, "w": f["z"].T @ d + 1e-4 * w["w"], "b": np.array([d.sum()])}
            step += 1
            rate = 0.01 * min(1.0, 2 * (1 - epoch / epochs))
            for name, g in grad.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                s[name] = 0.999 * s[name] + 0.001 * g * g
                w[name] -= rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(folds: int, held: int):
    """Whether crc32 of the id's text leaves the held-out remainder; false without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled documents, never held-out ones.

    The ids with the smallest hashes are taken, so the sample doesn't depend on
    partitions or on order; the bound makes their broadcast small.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .where(~held_out(folds, held))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fitting(sizes: list[tuple], bound: int) -> list[tuple]:
    """The (id, text hash) of ``sizes`` (id, text hash, size), in order, whose sizes fit into ``bound`` together."""
    kept, total = [], 0
    for doc, text, size in sizes:
        if total + size <= bound:
            kept.append((doc, text))
            total += size
    return kept


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS, held: int = HELD,
          sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a bounded sample of labelled, not held-out documents; features are made on the executors.

    The sample is at most ``sample`` documents, in order of a hash, with at
    most ``sample_bytes`` of text in all; one that no longer fits is left out
    and the next is tried.  Every passage of a sampled document is learned
    from.  Equal texts of one id count once.
    """

    def run(batches):
        for batch in batches:
            for row, end, data, off in chunks(batch):
                x, first = passage_features(data, off)
                bags = [x[first[k] : first[k + 1]].astype("<f4").tobytes() for k in range(end - row)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(bags, pa.binary()), batch.column(2).slice(row, end - row)],
                    names=["doc_id", "bag", "label"],
                )

    labelled = sample_of(docs, labels, "quality", folds, held, sample).withColumn("own_text", F.xxhash64("text"))
    sizes = (
        labelled.groupBy("doc_id", "own_text")
        .agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
        .orderBy(F.xxhash64("doc_id", "own_text"), "doc_id", "own_text").limit(sample)
        .collect()
    )
    chosen = docs.sparkSession.createDataFrame(fitting(sizes, sample_bytes), "doc_id bigint, own_text bigint")
    rows = (
        labelled.join(F.broadcast(chosen), ["doc_id", "own_text"])
        .groupBy("doc_id", "own_text").agg(F.max("text").alias("text"), F.max("label").alias("label"))
        .select("doc_id", "text", "label")
        .mapInArrow(run, "doc_id bigint, bag binary, label int")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES) for r in rows]
    first = np.append(0, np.cumsum([len(b) for b in bags])).astype(np.int64)
    x = np.concatenate(bags) if bags else np.zeros((0, FEATURES), np.float32)
    return fit(x, first, np.array([r["label"] for r in rows], dtype=float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""

    def run(batches):
        for batch in batches:
            for row, end, data, off in chunks(batch):
                value = model.scores(*passage_features(data, off))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(value, pa.float64())], names=["doc_id", "score"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score at least ``threshold``; nothing is shuffled."""
    model, at = train(docs, labels), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
            for row, end, data, off in chunks(texts):
                good = model.scores(*passage_features(data, off)) >= threshold
                yield batch.slice(row, end - row).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every document for quality: doc_id, held_out, score, predicted.

    NULL and empty texts are one empty passage and get its score; texts are
    read whole however long; repeated rows are scored each; a document labelled
    twice counts with its larger label; without any label the score is about
    one half everywhere; an empty table gives no rows; other columns are
    ignored (lang, source and labels are never inputs of a score).
    """
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(FOLDS, HELD).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op4_quality(spark, sf_dir):
    """Every document of the table, by a model of its labelled ones."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
