"""Toxicity by a learned word list, looked up by compression with two zstandard dictionaries.

No dictionary is trained on toxic text: windows of ordinary and of toxic text
share almost all their bytes, and dictionaries trained on either tell them
apart no better than the larger class does (figures in the README).  What marks
toxic text is a word list instead, picked by a test over word beginnings
(``word_lists``), whole however long it gets.

Words are written as eight bytes each (their 64-bit hashes), so that only whole
words match.  One dictionary holds ordinary text; the other holds the same
content and the word list before it.  A short window that carries listed words
compresses to fewer bytes with the second one; other windows come out alike.
The byte difference from which a window counts and a small logistic model over
the differences of a document are calibrated on labelled documents.

Labelled documents are read whole: words are counted, and windows compressed, on
the executors; the driver gets the word lists and, of every sampled document,
how many of its windows save how many bytes.

Four details make single bytes count.  Each window is preceded by a fixed
ballast that both dictionaries hold, so a window is never stored raw; a fixed
tail follows it, since zstandard looks for no match in the last 16 bytes;
windows stay below 64 literals, where zstandard spends no bytes on entropy
tables; and the match tables have room for every position of a dictionary.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import saved, table
from telemetry_lake.llm.quality import held_out, sample_of
from telemetry_lake.llm.text import NOT_ALNUM, chunks, flat, mix, span_hashes, word_hashes, word_spans

SAMPLE = 8000  # labelled documents that the model is fitted on, at most
FOLDS, HELD = 3, 1
THRESHOLD = 0.7
WINDOW = 48  # bytes: six words; with the tail less than 64 literals
ORDINARY_WORDS = 1024
PARTS = 3  # of the sample, for calibration
PREFIX = range(4, 13)  # bytes of the word beginnings that may mark toxic text
Z_LEAST, PURITY = 5.0, 0.75
GAINS = 64  # bytes that a window can save, exclusive
LEAST_GAINS = range(1, 9)  # thresholds on them that calibration chooses from

_TAIL = b"~^`|@!?%;"
_BALLAST = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ<>{}"
_ALL = PARTS  # number of the model of all parts; the others leave out the part of their number


def parts_of(doc_ids: pa.Array) -> np.ndarray:
    return (mix(doc_ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) % np.uint64(PARTS)).astype(np.int64)


def low_text(column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pc.utf8_lower(column)], names=["text"])


def contexts(rows: DataFrame) -> DataFrame:
    """(word, context, bits) of whole texts: the words before and after as a hash, part and label as one bit."""

    def run(batches):
        for batch in batches:
            bit = np.int64(1) << (2 * parts_of(batch.column(0)) + batch.column(2).to_numpy())
            for row, end, data, off in chunks(low_text(batch.column(1))):
                starts, ends, first = word_spans(data, off, NOT_ALNUM)
                hashes = span_hashes(data, starts, ends)
                before, after = np.zeros_like(hashes), np.zeros_like(hashes)
                before[1:], after[:-1] = hashes[:-1], hashes[1:]
                some = np.diff(first) > 0
                before[first[:-1][some]] = 0
                after[first[1:][some] - 1] = 0
                context = mix(before + mix(after + np.uint64(1)))
                bits = np.repeat(bit[row:end], np.diff(first))
                _, at = np.unique(mix(hashes + mix(context + bits.astype(np.uint64))), return_index=True)
                raw = data.tobytes()
                for k in range(0, len(at), 1 << 16):
                    part = at[k : k + (1 << 16)]
                    found = [raw[a:b] for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.binary()), pa.array(context[part].view(np.int64)), pa.array(bits[part])],
                        names=["word", "context", "bits"],
                    )

    return rows.select("doc_id", "text", "label").mapInArrow(run, "word binary, context bigint, bits bigint")


def word_lists(rows: DataFrame) -> list[tuple[list[bytes], list[bytes]]]:
    """(toxic words, frequent other words) for each model: without part 0, 1, .., and of all parts.

    Words and word beginnings are counted by distinct contexts (the words before
    and after), so copies of a document count once.  A beginning is toxic if it
    stands out by ``Z_LEAST`` standard deviations over its share if labels did
    not matter, and if most of its contexts are toxic.  Toxic words are those of
    toxic text that begin so.
    """

    def seen(model: int, label: int):
        mask = sum(1 << (2 * part + label) for part in range(PARTS) if part != model)
        return F.sum((F.col("bits").bitwiseAND(mask) != 0).cast("bigint")).alias(f"n{label}_{model}")

    models = range(PARTS + 1)
    numbers = [f"n{label}_{m}" for m in models for label in (0, 1)]
    by_context = contexts(rows).groupBy("word", "context").agg(F.bit_or("bits").alias("bits"))
    counted = saved(by_context.groupBy("word").agg(*(seen(m, y) for m in models for y in (0, 1))), "toxic_words")
    whole = counted.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in numbers)).first()
    blank = F.lit(bytearray(b" "))
    spaced = F.concat(blank, "word", blank)
    begins = [F.when(F.length("word") > size, F.substring(spaced, 1, size + 1)) for size in PREFIX]
    forms = counted.select("*", F.explode(F.array_compact(F.array(spaced, *begins))).alias("form"))

    def stands_out(m: int):
        toxic, both = F.col(f"n1_{m}"), F.col(f"n0_{m}") + F.col(f"n1_{m}")
        expected = both * F.lit(whole[f"n1_{m}"] / max(1, whole[f"n0_{m}"] + whole[f"n1_{m}"]))
        return (toxic - expected >= Z_LEAST * F.sqrt(expected + 1)) & (toxic >= PURITY * both)

    stems = forms.groupBy("form").agg(*(F.sum(n).alias(n) for n in numbers)).select(
        "form", sum(F.when(stands_out(m), 1 << m).otherwise(0) for m in models).alias("models")
    )
    marks = (
        forms.join(stems.where("models <> 0"), "form").groupBy("word")
        .agg(F.bit_or("models").alias("models"), *(F.first(f"n1_{m}").alias(f"n1_{m}") for m in models)).collect()
    )
    lists = []
    for m in models:
        own = [r for r in marks if r["models"] >> m & 1 and r[f"n1_{m}"]]
        own = [bytes(r["word"]) for r in sorted(own, key=lambda r: (-r[f"n1_{m}"], bytes(r["word"])))]
        frequent = (
            counted.where(F.col(f"n0_{m}") > 0).orderBy(F.desc(f"n0_{m}"), "word").select("word")
            .limit(ORDINARY_WORDS + len(own)).collect()
        )
        listed = set(own)
        lists.append((own, [w for r in frequent if (w := bytes(r["word"])) not in listed][:ORDINARY_WORDS]))
    return lists


def codes(words: list[bytes]) -> bytes:
    """The hashes of words, eight bytes each."""
    data, off = flat(pa.array([b" ".join(words)], pa.binary()))
    return word_hashes(data, off, NOT_ALNUM)[0].astype("<u8").tobytes()


@dataclass
class Dictionaries:
    """Contents of the two dictionaries."""

    ordinary: bytes
    toxic: bytes

    def compressors(self):
        return _compressors(self.ordinary, self.toxic)


@lru_cache(maxsize=4)
def _compressors(ordinary: bytes, toxic: bytes):
    import zstandard as zs

    made = []
    whole = len(toxic) + len(ordinary) + len(_BALLAST)
    log = max(15, whole.bit_length() + 1)  # both alike; rows of the match tables stay a quarter full
    for content in (ordinary + _BALLAST, toxic + ordinary + _BALLAST):
        params = zs.ZstdCompressionParameters(
            min_match=6, strategy=zs.STRATEGY_GREEDY, window_log=log, hash_log=log, chain_log=log, search_log=4,
            write_checksum=0, write_content_size=0, write_dict_id=0,
        )
        data = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=params)
        made.append(zs.ZstdCompressor(dict_data=data, compression_params=params))
    return made


def gains(coded: bytes, dictionaries: Dictionaries) -> np.ndarray:
    """How many windows of a coded document save 0, 1, .. bytes with the toxic dictionary."""
    plain, toxic = (c.compress for c in dictionaries.compressors())
    windows = [_BALLAST + coded[i : i + WINDOW] + _TAIL for i in range(0, max(1, len(coded)), WINDOW)]
    saved_ = np.array([len(plain(w)) - len(toxic(w)) for w in windows])
    return np.bincount(np.clip(saved_, 0, GAINS - 1), minlength=GAINS)


FEATURES = 5


def summary(gain: np.ndarray, least: int) -> np.ndarray:
    """What the windows of each document (a row of ``gain``) say together, those over ``least`` counting."""
    size = np.arange(GAINS)
    total, windows = (gain * size)[:, least:].sum(axis=1), gain.sum(axis=1)
    return np.stack([
        np.log1p(total), ((gain > 0) * size).max(axis=1), np.minimum(1.0, total / (windows + 2)),
        np.log1p(gain[:, 2 * least :].sum(axis=1)), np.log(windows),
    ], axis=1)


@dataclass
class Model:
    dictionaries: Dictionaries
    least: int  # bytes from which a window counts
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, gain: np.ndarray) -> np.ndarray:
        """Of documents by the windows that save each number of bytes."""
        return 1 / (1 + np.exp(-self.logits(summary(gain, self.least))))

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.hstack([(x - self.center) / self.scale, np.ones((len(x), 1))])
        return np.clip(x @ self.weights, -30, 30)


def calibrate(gain: np.ndarray, label: np.ndarray, dictionaries: Dictionaries) -> Model:
    """The threshold on a window's gain, and the logistic model with it, that have the least log loss."""
    best = None
    for least in LEAST_GAINS:
        model = _logistic(summary(gain, least), label, dictionaries, least)
        margin = model.logits(summary(gain, least)) * np.where(label > 0, 1, -1)
        loss = np.log1p(np.exp(-margin)).sum()
        if best is None or loss < best[0] - 1e-9:
            best = (loss, model)
    return best[1]


def _logistic(x: np.ndarray, label: np.ndarray, dictionaries: Dictionaries, least: int) -> Model:
    center = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(FEATURES)
    design = np.hstack([(x - center) / scale, np.ones((len(x), 1))])
    w = np.zeros(FEATURES + 1)
    for _ in range(50):  # Newton's method on the ridged log loss
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 0.3 * np.eye(len(w))
        step = np.linalg.solve(hessian, design.T @ (p - label) + 0.3 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(dictionaries, least, center, scale, w)


def text_gains(texts: pa.Array, dictionaries: list[Dictionaries]) -> list[np.ndarray]:
    """``gains`` of every whole text, each by its own dictionaries."""
    out = []
    for _, _, data, off in chunks(low_text(texts)):
        hashes, first = word_hashes(data, off, NOT_ALNUM)
        coded = hashes.astype("<u8").tobytes()
        for a, b in zip(first[:-1], first[1:], strict=True):
            out.append(gains(coded[8 * a : 8 * b], dictionaries[len(out)]))
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Word lists from all sampled rows, read whole; thresholds from rows that their lists haven't seen."""
    rows = saved(sample_of(docs, labels, "toxic", FOLDS, HELD, sample), "toxic_sample")
    made = [Dictionaries(codes(frequent[::-1]), codes(toxic)) for toxic, frequent in word_lists(rows)]

    def run(batches):
        for batch in batches:
            own = [made[part] for part in parts_of(batch.column(0))]
            gain = [g.astype("<i8").tobytes() for g in text_gains(batch.column(1), own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(gain, pa.binary())], names=["doc_id", "label", "gain"]
            )

    found = rows.select("doc_id", "text", "label").mapInArrow(run, "doc_id bigint, label int, gain binary").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["gain"])))
    gain = np.frombuffer(b"".join(bytes(r["gain"]) for r in found), "<i8").reshape(-1, GAINS)
    return calibrate(gain, np.array([r["label"] for r in found], dtype=float), made[_ALL])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every document for toxicity: doc_id, held_out, score, predicted.

    NULL and empty texts get the score of one empty window; texts are read whole
    however long; repeated rows are scored each; a document labelled twice
    counts with its larger label; without labels every score is one half; an
    empty table gives no rows; other columns are ignored.
    """
    model = train(docs, labels)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                gain = text_gains(batch.column(1), [model.dictionaries] * batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.scores(np.array(gain)), pa.float64())], names=["doc_id", "score"]
                )

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", held_out(FOLDS, HELD).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op10_toxicity(spark, sf_dir):
    """Every document of the table, by a model of its labelled ones."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
