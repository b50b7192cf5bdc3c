"""Language-model scoring: prediction by partial matching over bytes, and a unigram base.

The byte model is a trie of all contexts of up to ``CONTEXT`` bytes that occur in
the training texts, with counts of what follows: a byte or, as symbol 256, the
end of the text.  A symbol is coded in the longest known context; if it has not
followed there, an escape is coded (method C: as many escape counts as different
symbols seen) and the search goes on in the shorter context without the symbols
that the longer one has ruled out; below the shortest, all symbols are alike.
Whatever followed a context also followed its shorter ones, so the symbols ruled
out in a context are those seen in the one before it, and their counts there are
one sum per longer context.

The trie grows with the corpus and is nowhere whole.  Tasks emit the distinct
grams (context and symbol, one 64-bit number) of a block of texts, dealt by a
hash of the context; each share is summed in one group, the sums of what longer
contexts rule out come from a join of the grams with those a byte shorter, and
the counts go back to the blocks that asked for them.  The unigram counts take
the same way, by ranges of the words' 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import saved, table
from telemetry_lake.llm.text import chunks, crc_remainder, mix, word_hashes

FOLDS, HELD = 7, 2
BLOCK_BYTES = 16 << 20  # text whose words and grams are looked up together
CONTEXT = 5  # bytes; at most 6 fit into a gram's number
END = 256  # the symbol after the last byte
SYMBOLS = 257
_ORDER, _SYMBOL = 57, 9  # a gram: order, up to 48 bits of context (last byte lowest), 9 bits of symbol
_CONTEXT_BITS = (1 << 48) - 1
_SLICE = 1 << 18  # positions, grams and words worked on at a time
_LOOSE = 1 << 20  # counts of slices that are held before they are added up
_ROW_BYTES = 32  # what a row without text counts towards a block


# --- the byte model -------------------------------------------------------------------


def symbols(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with an END after each, and where each text starts."""
    rows = np.arange(len(off) - 1)
    out = np.full(len(data) + len(rows), END, dtype=np.int16)
    byte = np.ones(len(out), dtype=bool)
    byte[off[1:] + rows] = False
    out[byte] = data
    return out, off[:-1] + rows


def gram_slices(stream: np.ndarray, starts: np.ndarray, context: int):
    """(first position, grams) of slices of ``stream``: each symbol after its longest context within its text."""
    for a in range(0, len(stream), _SLICE):
        b = min(a + _SLICE, len(stream))
        begin = np.zeros(b - a, dtype=np.int64)
        begin[0] = starts[np.searchsorted(starts, a, "right") - 1]
        inside = starts[np.searchsorted(starts, a, "right") : np.searchsorted(starts, b)]
        begin[inside - a] = inside
        within = np.arange(a, b) - np.maximum.accumulate(begin)
        codes = stream[a:b].astype(np.int64) | np.minimum(within, context) << _ORDER
        for j in range(1, context + 1):
            back = np.zeros(b - a, dtype=np.int64)
            first = max(a, j)
            if first < b:
                back[first - a :] = stream[first - j : b - j]
            codes |= np.where(within >= j, back, 0) << (_SYMBOL + 8 * (j - 1))
        yield a, codes


def shorter(codes: np.ndarray) -> np.ndarray:
    """The same symbols after contexts without their oldest byte (no gram of order 0 among them)."""
    order = (codes >> _ORDER) - 1
    kept = (codes >> _SYMBOL) & ((np.int64(1) << 8 * order) - 1)
    return order << _ORDER | kept << _SYMBOL | codes & 511


def add_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``codes``, sorted, with the sums of their ``counts``."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.add.reduceat(counts[order], first)


class Tally:
    """Counts by number, collected slice by slice; holds the distinct numbers and at most ``_LOOSE`` more."""

    def __init__(self, kind):
        self.sums, self.loose, self.n = (np.zeros(0, kind), np.zeros(0, np.int64)), [], 0

    def add(self, numbers: np.ndarray, counts: np.ndarray) -> None:
        self.loose.append((numbers, counts))
        self.n += len(numbers)
        if self.n >= _LOOSE:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct numbers, sorted, and their counts."""
        if self.loose:
            self.sums = add_up(*(np.concatenate(x) for x in zip(self.sums, *self.loose, strict=True)))
            self.loose, self.n = [], 0
        return self.sums


def all_orders(codes: np.ndarray, counts: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of grams of every order, sorted, from those after the longest contexts."""
    levels, longer = [], (codes[:0], counts[:0])
    for k in range(context, -1, -1):
        own = codes >> _ORDER == k
        longer = add_up(np.append(codes[own], shorter(longer[0])), np.append(counts[own], longer[1]))
        levels.append(longer)
    return tuple(np.concatenate(x) for x in zip(*levels[::-1], strict=True))


def context_sums(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of sorted, distinct grams, with the sum of counts and the number of symbols seen."""
    contexts = codes >> _SYMBOL
    if not len(contexts):
        return contexts, counts, counts
    first = np.flatnonzero(np.append(True, contexts[1:] != contexts[:-1]))
    return contexts[first], np.add.reduceat(counts, first), np.diff(np.append(first, len(codes)))


def log_probabilities(codes, counts, contexts, total, kinds, ruled_out) -> np.ndarray:
    """log10 probability of each gram's symbol after its context.

    ``codes`` are sorted and hold the shorter grams of each too; ``contexts``
    (sorted) are theirs, with the sum of counts, the symbols seen and the sum of
    what these symbols count in the context a byte shorter; all 0 if unknown.
    """
    out = np.zeros(len(codes))
    for a in range(0, len(codes), _SLICE):
        at = codes[a : a + _SLICE]
        todo = np.arange(a, a + len(at))
        seen, gone = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)  # ruled out: symbols, their counts
        while len(todo):
            place = np.searchsorted(contexts, at >> _SYMBOL)
            count = counts[np.searchsorted(codes, at)]
            known = total[place] > 0
            left = total[place] - gone
            escape = np.where(kinds[place] == SYMBOLS, 0, kinds[place] - seen)
            hit = count > 0
            out[todo[hit]] += np.log10(count[hit]) - np.log10((left + escape)[hit])
            missed = ~hit & known & (escape > 0)  # nothing new was seen here: the escape is certain
            out[todo[missed]] += np.log10(escape[missed]) - np.log10((left + escape)[missed])
            lowest = ~hit & (at >> _ORDER == 0)
            out[todo[lowest]] -= np.log10(SYMBOLS - kinds[place[lowest]])
            on = ~hit & ~lowest
            seen, gone = np.where(known, kinds[place], 0)[on], np.where(known, ruled_out[place], 0)[on]
            todo, at = todo[on], shorter(at[on])
    return out


# --- counting -------------------------------------------------------------------------

_PASS = "kind int, block bigint, part int, doc_id bigint, text string, keys binary, counts binary"
WORDS, DOCS, GRAMS = 0, 1, 2


def share_of(numbers: np.ndarray, parts: int) -> np.ndarray:
    """The highest bits of 64-bit numbers: one of ``parts`` (a power of two)."""
    if parts == 1:
        return np.zeros(len(numbers), np.int64)
    return (numbers >> np.uint64(64 - (parts.bit_length() - 1))).astype(np.int64)


def pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, compressed: grams are sorted and counts small, so most planes are nearly constant."""
    planes = numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    return [unpack(x.as_buffer()) for x in column]


def _shares(place: np.ndarray):
    """(part, slice) of each part in sorted ``place``."""
    found, first = np.unique(place, return_index=True)
    last = np.append(first, len(place))[1:]
    for part, a, b in zip(found.tolist(), first, last, strict=True):
        yield part, slice(a, b)


def count_blocks(docs: DataFrame, parts: int, folds: int, held: int, context: int = CONTEXT) -> DataFrame:
    """One pass over the texts; rows of three kinds.

    WORDS: the distinct words of a block whose hash lies in range ``part``
    (sorted) with their training counts.  GRAMS: its distinct grams of all
    orders whose context's hash lies in ``part`` (sorted), likewise, packed.
    DOCS: the block's texts.
    """

    def emit(block, state):
        words, learn = state["words"].total()
        rows = [(WORDS, block, p, None, None, words[s].astype("<u8").tobytes(), learn[s].astype("<i8").tobytes())
                for p, s in _shares(share_of(words, parts))]
        grams, often = all_orders(*state["grams"].total(), context)
        place = share_of(mix((grams >> _SYMBOL).astype(np.uint64)), parts)
        order = np.argsort(place, kind="stable")
        grams, often = grams[order], often[order]
        rows += [(GRAMS, block, p, None, None, pack(grams[s]), pack(often[s]))
                 for p, s in _shares(place[order])]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        names = ["kind", "block", "part", "doc_id", "text", "keys", "counts"]
        for k in range(0, len(rows), 1024):
            columns = zip(*rows[k : k + 1024], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        for ids, texts in state["rows"]:
            n = len(ids)
            none = [pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, DOCS, np.int32)), pa.array(np.full(n, block)), none[0], ids, texts, *none[1:]], names=names
            )

    def run(batches):
        from pyspark import TaskContext

        fresh = lambda: {"words": Tally(np.uint64), "rows": [], "grams": Tally(np.int64), "bytes": 0}
        task, number, state = TaskContext.get().partitionId(), 0, fresh()
        for batch in batches:
            for row, end, data, off in chunks(batch):
                ids, texts = (batch.column(k).slice(row, end - row) for k in (0, 1))
                train = crc_remainder(ids.to_pylist(), folds) != held
                hashes, first = word_hashes(data, off)
                learn = np.repeat(train, np.diff(first))
                state["words"].add(*np.unique(hashes[learn], return_counts=True))
                other = np.unique(hashes[~learn])
                state["words"].add(other, np.zeros(len(other), np.int64))
                state["rows"].append((ids, texts))
                stream, starts = symbols(data, off)
                learn = np.repeat(train, np.diff(off) + 1)
                for a, codes in gram_slices(stream, starts, context):
                    learned = learn[a : a + len(codes)]
                    state["grams"].add(*np.unique(codes[learned], return_counts=True))
                    other = np.unique(codes[~learned])
                    state["grams"].add(other, np.zeros(len(other), np.int64))
                state["bytes"] += len(data) + _ROW_BYTES * (end - row)
                if state["bytes"] >= BLOCK_BYTES:
                    yield from emit(task << 32 | number, state)
                    number, state = number + 1, fresh()
        if state["rows"]:
            yield from emit(task << 32 | number, state)

    return docs.select("doc_id", "text").mapInArrow(run, _PASS)


def _numbers(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def sum_words(words: DataFrame) -> DataFrame:
    """Training counts over the corpus, returned to each block in the order of its words.

    Also one row per range (block NULL) with the range's distinct and total
    training words in ``n_distinct`` and ``n_total``.
    """

    def total(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        keys, counts = _numbers(t.column("keys"), "<u8"), _numbers(t.column("counts"), "<i8")
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(place, weights=np.concatenate(counts))
        back = sums[place].astype("<i8")
        cut = np.cumsum([len(k) for k in keys])[:-1]
        return pa.table(
            {
                "block": pa.array([*t.column("block").to_pylist(), None], pa.int64()),
                "part": pa.array([part] * (t.num_rows + 1), pa.int32()),
                "counts": pa.array([*(x.tobytes() for x in np.split(back, cut)), None], pa.binary()),
                "n_distinct": pa.array([None] * t.num_rows + [int((sums > 0).sum())], pa.int64()),
                "n_total": pa.array([None] * t.num_rows + [int(sums.sum())], pa.int64()),
            }
        )

    return words.groupBy("part").applyInArrow(
        total, "block bigint, part int, counts binary, n_distinct bigint, n_total bigint"
    )


def sum_grams(grams: DataFrame) -> DataFrame:
    """(part, code, n) of the grams that occur in training texts."""

    def total(t: pa.Table) -> pa.Table:
        codes, sums = add_up(*(np.concatenate(_unpacked(t.column(c))) for c in ("keys", "counts")))
        codes, sums = codes[sums > 0], sums[sums > 0]
        part = np.full(len(codes), t.column("part")[0].as_py(), np.int32)
        return pa.table({"part": part, "code": codes, "n": sums})

    return grams.groupBy("part").applyInArrow(total, "part int, code bigint, n bigint")


def ruled_out(model: DataFrame) -> DataFrame:
    """(part, context, n): what the symbols seen in a context count in the context a byte shorter.

    A gram has at most 256 grams that are a byte longer, so no key of the join is hot.
    """
    order = F.expr(f"cast(shiftright(code, {_ORDER}) - 1 as int)")
    kept = F.expr(f"shiftright(code, {_SYMBOL}) & (shiftleft(1L, 8 * up) - 1L)")
    longer = model.where(F.col("code") >= F.lit(1 << _ORDER)).select("part", "code", order.alias("up"))
    longer = longer.withColumn("kept", kept).selectExpr(
        "part", f"shiftright(code, {_SYMBOL}) as context",
        f"shiftleft(cast(up as bigint), {_ORDER}) | shiftleft(kept, {_SYMBOL}) | (code & 511L) as short",
    )
    return longer.join(model.select(F.col("code").alias("short"), "n"), "short").groupBy("part", "context").agg(
        F.sum("n").alias("n")
    )


def look_up(requests: DataFrame, model: DataFrame, gone: DataFrame) -> DataFrame:
    """(block, keys, counts, sums) for each request: counts of its grams; three sums for each of its contexts."""
    known = model.selectExpr("part", "true as gram", "code as key", "n").unionByName(
        gone.selectExpr("part", "false as gram", "context as key", "n")
    )

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        gram = right.column("gram").to_numpy(zero_copy_only=False).astype(bool)
        key, n = right.column("key").to_numpy().astype(np.int64), right.column("n").to_numpy().astype(np.int64)
        codes, counts = add_up(key[gram], n[gram])
        contexts, total, kinds = context_sums(codes, counts)
        longer, gone = add_up(key[~gram], n[~gram])
        out_counts, out_sums = [], []
        for asked in _unpacked(left.column("keys")):
            out_counts.append(pack(_at(codes, asked, counts)))
            own = np.unique(asked >> _SYMBOL)
            out_sums.append(pack(np.concatenate([_at(contexts, own, total), _at(contexts, own, kinds), _at(longer, own, gone)])))
        return pa.table({"block": left.column("block"), "keys": left.column("keys"),
                         "counts": pa.array(out_counts, pa.binary()), "sums": pa.array(out_sums, pa.binary())})

    return requests.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(
        answer, "block bigint, keys binary, counts binary, sums binary"
    )


def _at(keys: np.ndarray, asked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of ``asked`` among sorted ``keys``, 0 where missing."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[place] == asked, values[place], 0).astype(np.int64)


def score_blocks(docs: DataFrame, words: DataFrame, grams: DataFrame, context: int = CONTEXT) -> DataFrame:
    """(doc_id, n_tokens, n_known, logs, score) of each text of each block.

    ``n_known`` and ``logs`` are the known occurrences and the sum of log10(c + 1) of its words.
    """
    answers = words.selectExpr("block", "part", "cast(null as binary) as keys", "counts", "cast(null as binary) as sums")
    answers = answers.unionByName(grams.selectExpr("block", "cast(null as int) as part", "keys", "counts", "sums"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        of_words = right.filter(right.column("part").is_valid()).sort_by("part")
        counts = np.concatenate([none, *_numbers(of_words.column("counts"), "<i8")])
        logs, known = np.log10(counts + 1.0), counts > 0
        codes, logp = _block_model(right.filter(right.column("part").is_null()))
        batch = left.select(["doc_id", "text"]).combine_chunks().to_batches(max_chunksize=left.num_rows)[0]
        found = [(row, *word_hashes(data, off)) for row, _, data, off in chunks(batch)]
        words = np.unique(np.concatenate([np.unique(h) for _, h, _ in found]))
        n_tokens, n_known, sums, score = [], [], [], []
        for (_, hashes, first), (_, _, data, off) in zip(found, chunks(batch), strict=True):
            place = np.searchsorted(words, hashes)
            n_tokens.append(np.diff(first) + 1)
            n_known.append(np.diff(np.append(0, np.cumsum(known[place]))[first]))
            sums.append([float(logs[place[a:b]].sum()) for a, b in zip(first, first[1:])])
            stream, starts = symbols(data, off)
            each = np.empty(len(stream))
            for a, here in gram_slices(stream, starts, context):
                kinds, inverse = np.unique(here, return_inverse=True)
                each[a : a + len(here)] = logp[np.searchsorted(codes, kinds)][inverse]
            score.append(np.add.reduceat(each, starts))
        return pa.table({
            "doc_id": left.column("doc_id"), "n_tokens": np.concatenate(n_tokens).astype(np.int64),
            "n_known": np.concatenate(n_known).astype(np.int64), "logs": np.concatenate(sums).astype(np.float64),
            "score": np.concatenate(score),
        })

    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, logs double, score double"
    )


def _block_model(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Grams of a block, sorted, and the log10 probabilities of their symbols."""
    keys, counts, sums = (_unpacked(answers.column(c)) for c in ("keys", "counts", "sums"))
    own = np.concatenate([np.unique(k >> _SYMBOL) for k in keys])
    sums = np.concatenate([s.reshape(3, -1) for s in sums], axis=1)
    by, order = np.argsort(own), np.argsort(np.concatenate(keys))
    codes, counts = np.concatenate(keys)[order], np.concatenate(counts)[order]
    return codes, log_probabilities(codes, counts, own[by], *sums[:, by])


def ranges(size: int, shuffles: int) -> int:
    """Shares of the words and grams, a power of two: no fewer than the blocks of ``size`` bytes or the shuffle partitions.

    A share so holds about as many words and grams as one block, however large the corpus.
    """
    return 1 << (max(1, shuffles, -(-size // BLOCK_BYTES)) - 1).bit_length()


def lm_scores(docs: DataFrame, folds: int = FOLDS, held: int = HELD, context: int = CONTEXT) -> DataFrame:
    """Score every text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32 remainder is ``held`` are scored but never learned from; a
    row without doc_id is scored and learned from like any other.  NULL and
    empty texts have the end as their only token; texts are read whole; of rows
    repeated with the same doc_id each is learned from and scored by itself;
    without training texts all counts are 0 and all symbols alike.
    An empty table gives no rows; other columns are ignored.

    ``score`` adds up the symbols of a text as it stands (letters in their own
    case) and its end, so the probabilities of all byte strings add up to 1.
    ``context`` (0 to 6) is the longest context in bytes.  Words are told apart
    by 64-bit hashes, grams by their bytes.
    """
    if not 0 <= context <= 6:
        raise ValueError("context must be 0 to 6 bytes")
    spark: SparkSession = docs.sparkSession
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = int(size or 0) + _ROW_BYTES * rows
    parts = ranges(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = saved(count_blocks(docs, parts, folds, held, context), "lm_counts")
    sums = saved(sum_words(counted.where(F.col("kind") == WORDS).select("block", "part", "keys", "counts")), "lm_sums")
    v, n = sums.where("block is null").agg(F.sum("n_distinct"), F.sum("n_total")).first()
    ends = docs.select(_held(folds, held).alias("held")).where("not held").count()  # a token of every training text
    n, v = (n or 0) + ends, (v or 0) + (1 if ends else 0)
    grams = counted.where(F.col("kind") == GRAMS)
    model = saved(sum_grams(grams.select("part", "keys", "counts")), "lm_model")
    scored = score_blocks(
        counted.where(F.col("kind") == DOCS).select("block", "doc_id", "text"),
        sums.where("block is not null").select("block", "part", "counts"),
        look_up(grams.select("block", "part", "keys"), model, ruled_out(model)),
        context,
    )
    return scored.select(
        "doc_id", _held(folds, held).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.lit(float(np.log10(ends + 1.0))) - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1.0))))
        .alias("base_score"),
        "score",
    )


def _held(folds: int, held: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))


def op5_lm_scoring(spark, sf_dir):
    """Every whole text of ``documents``."""
    return lm_scores(table(spark, sf_dir, "documents"))
