"""Language-model scoring from a log-frequency Bloom filter.

Counts of all unigrams and bigrams of the training texts are taken exactly, by 64-bit hash, in Spark. The filter
holds, for an n-gram of count c, the items (n-gram, 1) .. (n-gram, q) with q = 1 + floor(log2 c); a lookup probes levels
upward until one is missing and returns the middle of that level's range. It holds every counted n-gram from level 1 on:
its size follows from the exact histogram of levels (``BITS_PER_ITEM`` for each item), at the same rate of false positives.

The filter is built in segments. An n-gram's hash names its segment, all its bits lie there, and each segment is
made by the task that counted its n-grams. Up to ``FILTER_BITS`` (corpora of a few MB) the driver lays finished segments end to end
and broadcasts them. A larger filter stays a table: the distinct n-grams of each chunk of texts are shuffled to their segments, probed
there, and their levels go back to the chunk. The bits are the same, so the scores are the same in both forms.

    P(w | v) = MIX * c(v w) / max(c(v), c(v w)) + (1 - MIX) * (c(w) + 1) / (N + V + 1)

``base_score`` is exact: the ``HEAD_WORDS`` most frequent words' counts are broadcast (a fixed bound), all other words join the
count table, and both parts are added. Words are told apart by a 64-bit hash.

Defined results: a null text counts as '' and has the end token alone; with no training text all counts are 0 and base_score is 0;
words of any length are counted whole; rows that repeat a doc_id each get their own result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import blocks, id_remainder, materialize, mix64, release_shuffles, utf8, word_hashes
from loanlens.session import release_table

END = np.uint64(0x5851F42D4C957F2D)  # the end token, in the place of a word's hash
FILTER_BITS = 1 << 22  # of a broadcast filter; a larger one is probed by a shuffle
BITS_PER_ITEM = 9  # with 3 probes: about 2.5 % false positives
PROBES = 3
HEAD_WORDS = 1 << 16
MIX = 0.6
BLOCK = 1 << 20  # bytes of text at a time
CHUNK = 1 << 23  # bytes of text whose n-grams are probed together by a shuffle
FLUSH_NGRAMS = 1_000_000
FLUSH_WORDS = 500_000
TOKENS_PER_SEGMENT = 500_000
PROBED_AT_A_TIME = 200_000
MAX_LEVEL = 62


def bigram_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(first * np.uint64(0x9E3779B97F4A7C15) + second)


def unigram_hash(word: np.ndarray) -> np.ndarray:
    return mix64(word + np.uint64(0x632BE59BD9B4E019))


def levels(count: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count)."""
    return np.frexp(count.astype(np.float64))[1].astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; 0 for level 0."""
    return np.where(level > 0, 1.5 * 2.0 ** (level - 1) - 0.5, 0.0)


def _reduce(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of their times."""
    k = np.concatenate(keys)
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, dtype=np.int64)
    return k[first], np.add.reduceat(np.concatenate(times)[order], first) if len(k) else np.zeros(0, dtype=np.int64)


def tokens(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text followed by the end token, and the number of tokens of each text."""
    h, count = word_hashes(documents, BLOCK)
    size = count + 1
    out = np.empty(int(size.sum()), dtype=np.uint64)
    ends = np.cumsum(size) - 1
    word = np.ones(len(out), dtype=bool)
    word[ends] = False
    out[word], out[ends] = h, END
    return out, size


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` (the word as its hash) over all tokens of ``docs(text)``; counted in each task before the shuffle."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def out(k, n):
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["word", "n"])

        for batch in blocks(batches, limit=BLOCK):
            k, n = np.unique(tokens(utf8(batch))[0], return_counts=True)
            keys.append(k)
            times.append(n)
            if sum(map(len, keys)) >= FLUSH_WORDS:
                k, n = _reduce(keys, times)
                keys, times = [k], [n]
                if len(k) >= FLUSH_WORDS // 2:
                    yield out(k, n)
                    keys, times = [], []
        if keys:
            yield out(*_reduce(keys, times))

    return docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def segment_count(tokens: int) -> int:
    """Segments so that one holds about ``TOKENS_PER_SEGMENT`` tokens: a power of two from 64 to 2^16."""
    return 1 << min(16, max(6, (max(tokens, 1) // TOKENS_PER_SEGMENT).bit_length()))


def _packed(keys: np.ndarray, n: np.ndarray, segments: int) -> pa.RecordBatch:
    """One row for each segment met in ``keys``, which are sorted and distinct; hashes as ``_steps``."""
    segment = _segment_of(keys, segments).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1, [len(keys)]]).tolist()
    n = n.astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(segment[cut[:-1]].astype(np.int32)),
         pa.array([_steps(keys[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
         pa.array([n[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())],
        names=["segment", "hashes", "counts"],
    )


def ngram_levels(docs: DataFrame, counts: DataFrame, segments: int) -> DataFrame:
    """``segment, hashes, levels, histogram``: the unigrams of ``counts(word, n)`` and exactly counted bigrams of
    ``docs(text)``, one row a segment.

    Tasks count as they read and send one packed row for each segment; a frequent n-gram is one entry of it.
    """

    def bigrams(batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in blocks(batches, limit=BLOCK):
            h, length = tokens(utf8(batch))
            inner = np.ones(len(h), dtype=bool)
            inner[np.cumsum(length) - length] = False  # a text's first token has none before it
            second = np.flatnonzero(inner)
            held.append(bigram_hash(h[second - 1], h[second]))
            size += len(second)
            if size >= FLUSH_NGRAMS:
                yield _packed(*np.unique(np.concatenate(held), return_counts=True), segments)
                held, size = [], 0
        if size:
            yield _packed(*np.unique(np.concatenate(held), return_counts=True), segments)

    def unigrams(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h = unigram_hash(batch.column("word").to_numpy().view(np.uint64))
                order = np.argsort(h)
                yield _packed(h[order], batch.column("n").to_numpy()[order], segments)

    def merge(group: pa.Table) -> pa.Table:
        h = np.concatenate([_from_steps(x) for x in group.column("hashes").to_pylist()])
        n = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in group.column("counts").to_pylist()])
        every, n = _reduce([h], [n])
        q = levels(n)
        return pa.table(
            {
                "segment": pa.array([group.column("segment")[0].as_py()], pa.int32()),
                "hashes": pa.array([every.tobytes()], pa.binary()),
                "levels": pa.array([q.astype(np.uint8).tobytes()], pa.binary()),
                "histogram": pa.array([np.bincount(q, minlength=MAX_LEVEL + 1).tolist()], pa.list_(pa.int64())),
            }
        )

    schema = "segment int, hashes binary, counts binary"
    packed = docs.select("text").mapInArrow(bigrams, schema).unionAll(counts.select("word", "n").mapInArrow(unigrams, schema))
    return packed.groupBy("segment").applyInArrow(merge, "segment int, hashes binary, levels binary, histogram array<bigint>")


def lowest_level(histogram: np.ndarray, capacity: int) -> int:
    """The lowest level from which on all items fit (1: all of them): an n-gram of level q has q - lowest + 1 of them."""
    for low in range(1, len(histogram)):
        q = np.arange(low, len(histogram))
        if int((histogram[low:] * (q - low + 1)).sum()) <= capacity:
            return low
    return len(histogram)


def _level_key(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix64(hashes + np.uint64(level * 0xD1B54A32D192ED03 & (1 << 64) - 1))


def _bit_place(key: np.ndarray, probe: int, segment_bits: int) -> np.ndarray:
    return ((key >> np.uint64(16 * probe)) & np.uint64(0xFFFFFFFF)) * np.uint64(segment_bits) >> np.uint64(32)


def _segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return hashes >> np.uint64(64 - segments.bit_length() + 1)


class LogFrequencyFilter:
    """Finished segments end to end: probes of many n-grams at once. ``first`` is the number of the first segment."""

    lowest = 1  # no counted n-gram is left out

    def __init__(self, bits: np.ndarray, segments: int, segment_bits: int, first: int = 0):
        self.bits, self.segments, self.segment_bits, self.first = bits, segments, segment_bits, first

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """Highest level found for each hash, 0 where the lowest is missing."""
        out = np.zeros(len(hashes), dtype=np.int64)
        base = (_segment_of(hashes, self.segments) - np.uint64(self.first)) * np.uint64(self.segment_bits)
        left = np.arange(len(hashes))
        for level in range(self.lowest, MAX_LEVEL + 1):
            key = _level_key(hashes[left], level)
            for probe in range(PROBES):
                p = base[left] + _bit_place(key, probe, self.segment_bits)
                there = (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
                left, key = left[there], key[there]
            if not len(left):
                break
            out[left] = level
        return out


def filter_size(ngrams: DataFrame) -> tuple[np.ndarray, int]:
    """The histogram of levels, and the bits of a segment: ``BITS_PER_ITEM`` for each item of the fullest one."""
    total = ngrams.select(F.posexplode("histogram").alias("q", "n")).groupBy("q").agg(F.sum("n").alias("n")).collect()
    histogram = np.zeros(MAX_LEVEL + 1, dtype=np.int64)
    for r in total:
        histogram[r["q"]] = r["n"]
    items = F.aggregate(F.transform("histogram", lambda n, q: n * q), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    most = ngrams.agg(F.max(items)).first()[0] or 1
    return histogram, -(-most * BITS_PER_ITEM // 64) * 64


def filter_segments(ngrams: DataFrame, segment_bits: int) -> DataFrame:
    """``segment, bits``: the finished segments of ``ngram_levels``."""

    def make(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, h, q in zip(*(batch.column(c).to_pylist() for c in ("segment", "hashes", "levels")), strict=True):
                h, q = np.frombuffer(h, dtype=np.uint64), np.frombuffer(q, dtype=np.uint8)
                out = np.zeros(segment_bits, dtype=np.uint8)
                for level in range(1, int(q.max(initial=0)) + 1):
                    key = _level_key(h[q >= level], level)
                    for probe in range(PROBES):
                        out[_bit_place(key, probe, segment_bits)] = 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment], pa.int32()), pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())],
                    names=["segment", "bits"],
                )

    return ngrams.select("segment", "hashes", "levels").mapInArrow(make, "segment int, bits binary")


def build_filter(ngrams: DataFrame, segments: int, bits: int = FILTER_BITS) -> LogFrequencyFilter | None:
    """The whole filter of ``ngram_levels``; None where it takes more than ``bits``, which bounds what reaches the driver and the workers."""
    histogram, segment_bits = filter_size(ngrams)
    if lowest_level(histogram, bits // BITS_PER_ITEM) > 1 or segments * segment_bits > bits:
        return None
    whole = np.zeros(segments * segment_bits // 8, dtype=np.uint8)
    for row in filter_segments(ngrams, segment_bits).toLocalIterator():  # one partition of finished segments at a time
        at = row["segment"] * (segment_bits // 8)
        whole[at : at + segment_bits // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return LogFrequencyFilter(whole, segments, segment_bits)


def _chunks(docs: DataFrame) -> DataFrame:
    """``row, chunk, doc_id, text``: rows numbered, and in chunks of about ``CHUNK`` bytes of text named by their first row."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        row = chunk = TaskContext.get().partitionId() << 33
        size = 0
        for batch in blocks(batches, limit=BLOCK):
            if size >= CHUNK:
                chunk, size = row, 0
            n = batch.num_rows
            size += batch.nbytes
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(n), pa.int64()), pa.array(np.full(n, chunk), pa.int64()), batch.column("doc_id"), batch.column("text")],
                names=["row", "chunk", "doc_id", "text"],
            )
            row += n

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"row bigint, chunk bigint, doc_id {id_type}, text string")


def _bigrams(h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of all bigrams of texts as ``tokens`` gives them, in their order."""
    inner = np.ones(len(h), dtype=bool)
    inner[np.cumsum(size) - size] = False
    second = np.flatnonzero(inner)
    return bigram_hash(h[second - 1], h[second])


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _steps(keys: np.ndarray) -> bytes:
    """Sorted hashes as steps from each to the next, byte place by byte place: the high places are zeros, which compress."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_steps(data: bytes) -> np.ndarray:
    places = np.frombuffer(data, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(places.T).view("<u8").ravel(), dtype=np.uint64)


def chunk_levels(chunks: DataFrame, made: DataFrame, segments: int, segment_bits: int) -> DataFrame:
    """``chunk, piece, segment, levels``: for each chunk the levels of its distinct n-grams in the order of their hashes, by
    probing the segments ``made`` where they lie. A frequent n-gram is asked for once a chunk. A chunk that two tasks read is
    asked for in pieces, which are named by their first row."""

    def ask(batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        chunk = piece = after = -1

        def out():
            asked = _distinct(np.concatenate(held))
            segment = _segment_of(asked, segments).astype(np.int32)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1, [len(asked)]]).tolist()
            same = lambda x: pa.array(np.full(len(cut) - 1, x), pa.int64())
            steps = pa.array([_steps(asked[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(segment[cut[:-1]]), same(chunk), same(piece), steps], names=["segment", "chunk", "piece", "asked"])

        for batch in blocks(batches, limit=BLOCK):
            row, of = batch.column("row").to_numpy(), batch.column("chunk").to_numpy()
            cut = [0, *(np.flatnonzero((np.diff(of) != 0) | (np.diff(row) != 1)) + 1).tolist(), len(row)]
            for a, b in zip(cut, cut[1:], strict=False):
                if of[a] != chunk or row[a] != after:
                    if held:
                        yield out()
                    held, chunk, piece = [], of[a], row[a]
                h, size = tokens(utf8(batch.slice(a, b - a)))
                held += [unigram_hash(_distinct(h)), _bigrams(h, size)]
                after = row[b - 1] + 1
        if held:
            yield out()

    def probe(asked: pa.Table, made: pa.Table) -> pa.Table:
        hashes = [_from_steps(x) for x in asked.column("asked").to_pylist()]
        cut = np.cumsum([0, *map(len, hashes)]).tolist()
        found = np.zeros(cut[-1], dtype=np.uint8)
        if made.num_rows and hashes:
            bits, first = np.frombuffer(made.column("bits")[0].as_py(), dtype=np.uint8), made.column("segment")[0].as_py()
            part = LogFrequencyFilter(bits, segments, segment_bits, first)
            every = np.concatenate(hashes)
            for i in range(0, len(every), PROBED_AT_A_TIME):
                found[i : i + PROBED_AT_A_TIME] = part.level(every[i : i + PROBED_AT_A_TIME])
        levels_of = [found[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
        return pa.table({"chunk": asked.column("chunk"), "piece": asked.column("piece"), "segment": asked.column("segment"), "levels": pa.array(levels_of, pa.binary())})

    probes = chunks.select("row", "chunk", "text").mapInArrow(ask, "segment int, chunk bigint, piece bigint, asked binary")
    return probes.groupBy("segment").cogroup(made.groupBy("segment")).applyInArrow(probe, "chunk bigint, piece bigint, segment int, levels binary")


def _answered(found: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Levels of the unigrams ``one`` and bigrams ``two``; ``found`` has those of the distinct ones in the order of their hashes."""
    keys = np.concatenate([one, two])
    order = np.argsort(keys)
    keys = keys[order]
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = found[np.cumsum(np.concatenate([[False], keys[1:] != keys[:-1]]))]
    return out[: len(one)], out[len(one) :]


def score(docs: DataFrame, train: DataFrame, bits: int = FILTER_BITS, head_words: int = HEAD_WORDS) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs(doc_id, text)``,
    by the counts of ``train(text)``."""
    spark = docs.sparkSession
    counts = materialize(word_counts(train))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = counts.orderBy(F.desc("n"), "word").limit(head_words).toPandas().sort_values("word")
    segments = segment_count(n)
    ngrams = materialize(ngram_levels(train, counts, segments))
    model = build_filter(ngrams, segments, bits)
    parts = (model.bits, model.segments, model.segment_bits) if model else None
    shared = spark.sparkContext.broadcast((head["word"].to_numpy(), head["n"].to_numpy(), parts))

    def columns(row: pa.Array, doc_id, h: np.ndarray, size: np.ndarray, levels_of) -> list:
        head_word, head_n, _ = shared.value
        word, at = np.unique(h, return_inverse=True)
        key = word.view(np.int64)
        place = np.minimum(np.searchsorted(head_word, key), max(len(head_word) - 1, 0))
        in_head = head_word[place] == key if len(head_word) else np.zeros(len(key), dtype=bool)
        log_count = np.where(in_head, np.log10((head_n[place] if len(head_n) else 0) + 1.0), 0.0)
        q1, q2 = levels_of(unigram_hash(word), _bigrams(h, size))
        c1, c2 = level_count(q1), level_count(q2)
        doc = np.repeat(np.arange(len(size)), size)
        inner = np.ones(len(h), dtype=bool)
        inner[np.cumsum(size) - size] = False
        second = np.flatnonzero(inner)
        p = (c1[at] + 1) / (n + v + 1)
        p[second] = MIX * c2 / np.maximum(np.maximum(c1[at[second - 1]], c2), 1) + (1 - MIX) * p[second]
        rare = ~in_head[at]
        pair, times = np.unique(doc[rare] * len(word) + at[rare], return_counts=True)
        tail = pa.StructArray.from_arrays([pa.array(key[pair % len(word)]), pa.array(times)], names=["word", "times"])
        per_doc = np.bincount(pair // len(word), minlength=len(size))
        sums = lambda x: np.bincount(doc, weights=x, minlength=len(size))
        return [
            row,
            doc_id,
            pa.array(size),
            pa.array(sums(~rare).astype(np.int64)),
            pa.array(sums(log_count[at])),
            pa.array(sums(np.log10(np.minimum(p, 1)))),
            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32)), tail),
        ]

    names = ["row", "doc_id", "n_tokens", "n_head", "head_sum", "score", "tail"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        filter_, row = LogFrequencyFilter(*shared.value[2]), TaskContext.get().partitionId() << 33
        for batch in blocks(batches, limit=BLOCK):
            h, size = tokens(utf8(batch))
            at = pa.array(row + np.arange(len(size)), pa.int64())
            yield pa.RecordBatch.from_arrays(columns(at, batch.column("doc_id"), h, size, lambda *x: map(filter_.level, x)), names=names)
            row += len(size)

    def run_chunk(group: pa.Table, answers: pa.Table) -> pa.Table:
        group, answers = group.sort_by("row"), answers.sort_by([("piece", "ascending"), ("segment", "ascending")])
        of, levels_of = answers.column("piece").to_numpy(), answers.column("levels").to_pylist()
        pieces, first = np.unique(of, return_index=True)
        at = [*np.searchsorted(group.column("row").to_numpy(), pieces).tolist(), group.num_rows]
        first = [*first.tolist(), len(of)]
        out = []
        for k in range(len(pieces)):
            rows = group.slice(at[k], at[k + 1] - at[k]).combine_chunks()
            h, size = tokens(utf8(rows))
            found = np.frombuffer(b"".join(levels_of[first[k] : first[k + 1]]), dtype=np.uint8)
            answered = lambda one, two, found=found: _answered(found, one, two)
            out.append(pa.Table.from_arrays(columns(rows.column("row"), rows.column("doc_id"), h, size, answered), names=names))
        return pa.concat_tables(out)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {id_type}, n_tokens bigint, n_head bigint, head_sum double, score double, tail array<struct<word:bigint,times:bigint>>"
    if model:
        scored = docs.select("doc_id", "text").mapInArrow(run, schema)
    else:
        segment_bits = filter_size(ngrams)[1]
        made = materialize(filter_segments(ngrams, segment_bits))
        release_table(ngrams)
        release_shuffles(spark)  # those of the counts, which are tables by now
        chunks = materialize(_chunks(docs))
        answers = materialize(chunk_levels(chunks, made, segments, segment_bits))
        release_shuffles(spark)  # those of the probes
        scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run_chunk, schema)
    scored = materialize(scored)
    if not model:
        for used in (made, chunks, answers):
            release_table(used)
        release_shuffles(spark)
    rare = (
        scored.select("row", F.explode("tail").alias("t"))
        .select("row", "t.word", "t.times")
        .join(counts, "word")
        .groupBy("row")
        .agg(F.sum("times").alias("n_tail"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail_sum"))
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("tail").join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_head") + zero("n_tail")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_sum") + zero("tail_sum") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"), "score",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Model and base score of every document, learned outside the held-out seventh."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = id_remainder("doc_id", 7) == 2
    return score(docs, docs.where(~held_out)).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
