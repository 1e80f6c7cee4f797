"""Document fingerprints by SimHash, and search within a Hamming radius by permuted block tables.

Terms are pairs of neighbouring words (the first word also pairs with the start), weighted by ``1 + ln(count)``. Each bit of
a term's hash votes for or against the same bit of the fingerprint. Likeness is the share of equal bits.

Search: a fingerprint is cut into ``b`` blocks, one table each. Of two fingerprints within ``radius`` some block differs in at most
``radius // b`` bits, so a query probes each table by every key that near its own block; an equi-join on (table, key) finds all
pairs, the exact distance decides, and a pair counts in the first of its tables alone. Fewer blocks have longer keys and more probes;
``tables_for`` takes the number of blocks with the least work for the two sizes, and any number gives the same pairs. Equal
fingerprints are one entry with their number of copies.

``RADIUS`` is what texts of 0.8 similarity of five-word shingles need: one changed word in 45 (0.8 = k / (2 - k), k = 0.89 of the shingles
kept, five lost a word) changes 2 word pairs in 45, which turns the vector of weights by an angle of about sqrt(2 * 2 / 45) = 0.3 and so
0.3 / pi * 256 = 24 bits on average, with a standard deviation of some 4.5.

The document after each one is found with one shuffle of the texts: explicit id ranges, sorted inside, and the head of
the following range sent along as an extra row, so no task sees more than its range.

Defined results: null counts as ''; a text without words has the fingerprint of zeros; equal texts have equal fingerprints; a single
document follows itself; rows that repeat an id follow each other by text; a null id comes after all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import blocks as text_blocks
from loanlens.llm.common import materialize, texts, words

BITS = 256
RADIUS = 31
LANES = BITS // 64
PROBE_COST = 8  # of a probe or an index row, in compared candidates
_LANE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
MAX_CACHED_WORDS = 300_000


class WordHashes(dict):
    """word -> 64-bit hash, remembered within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _finish(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def fingerprint(text: str, hashes: WordHashes) -> np.ndarray:
    """``BITS`` bits as bytes."""
    found = words(text)
    if not found:
        return np.zeros(BITS // 8, dtype=np.uint8)
    h = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    before = np.concatenate([[np.uint64(0)], h[:-1]])
    term, count = np.unique(_finish(before * np.uint64(0x9FB21C651E98DF25) + h), return_counts=True)
    weight = (1 + np.log(count)).astype(np.float32)
    votes = np.zeros(BITS, dtype=np.float32)
    for a in range(0, len(term), 1 << 14):  # bounded arrays for any text
        lanes = _finish(term[a : a + (1 << 14), None] + _LANE[: BITS // 64])
        bits = np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8).reshape(len(lanes), -1), axis=1)
        w = weight[a : a + (1 << 14)]
        votes += 2 * (w @ bits.astype(np.float32)) - w.sum()
    return np.packbits(votes > 0)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1 - int(np.unpackbits(a ^ b).sum()) / BITS


def lanes_of(fingerprint: np.ndarray) -> list[int]:
    """The fingerprint as 64-bit integers, first bytes first."""
    return fingerprint.view(">i8").tolist()


def edited(text: str, following: str) -> str:
    """``text`` with its last third (rounded down) replaced by as much of the beginning of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _range_of(doc_id: Column, bounds: list) -> Column:
    """Number of bounds below the id (binary search); 0 for null."""
    array = F.array(*(F.lit(b) for b in bounds)) if bounds else None
    if array is None:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*(F.lit(s) for s in steps)), F.lit(0), lambda acc, s: F.when(F.get(array, acc + s - 1) < doc_id, acc + s).otherwise(acc)
    )


def in_order(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs(doc_id, text)`` in ranges of descending id, each range followed by the row after it (``ghost``)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0]
    bounds = sorted(set(cuts or []))
    rows = rows.withColumn("range", _range_of(F.col("doc_id"), bounds))
    heads = rows.groupBy("range").agg(F.max("doc_id").alias("head")).orderBy(F.desc("range")).collect()  # one row a range
    following = [(r["range"], heads[(i + 1) % len(heads)]["head"]) for i, r in enumerate(heads)]
    ghosts = spark.createDataFrame(following, f"to_range int, head {id_type}")
    ghosts = (
        rows.drop("range").join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", F.col("to_range").alias("range"))
    )
    both = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts.withColumn("ghost", F.lit(1)))
    return both.repartition(n, "range").sortWithinPartitions("range", "ghost", F.desc_nulls_last("doc_id"), "text"), id_type


def fingerprints_with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, lanes`` of every row.

    ``lanes`` is the fingerprint as 64-bit integers, for the search.
    """
    rows, id_type = in_order(docs)

    def run(batches):
        hashes = WordHashes()
        last = None  # (range, ghost, id, text, fingerprint) of the row before
        for batch in text_blocks(batches):
            out = []
            for where, ghost, doc_id, text in zip(
                batch.column("range").to_pylist(), batch.column("ghost").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch), strict=True
            ):
                own = fingerprint(text, hashes) if not (ghost and last and last[1]) else None
                if last and not last[1] and last[0] == where:
                    out.append(row(last, text, own, hashes))
                last = (where, ghost, doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    def row(doc, text, next_print, hashes):
        _, _, doc_id, own_text, own = doc
        other = edited(own_text, text)
        changed = fingerprint(other, hashes)
        return {
            "doc_id": doc_id, "n_chars": len(own_text), "edited_sha256": hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": own.tobytes().hex(), "edited_fingerprint": changed.tobytes().hex(),
            "near_edited": likeness(own, changed), "near_next": likeness(own, next_print), "lanes": lanes_of(own),
        }

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema(
        [("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
         ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
         ("lanes", pa.list_(pa.int64()))]
    )
    schema = f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, lanes array<bigint>"
    return rows.mapInArrow(run, schema)


def _widths(per_lane: int) -> list[int]:
    """Bits of the blocks of a lane."""
    return [64 // per_lane + (k < 64 % per_lane) for k in range(per_lane)]


def tables_for(queries: int, entries: int, radius: int = RADIUS) -> int:
    """Blocks a lane (2 to 8) with the least work: rows of both sides, and expected candidates of evenly spread fingerprints."""

    def work(per_lane: int) -> float:
        near = radius // (LANES * per_lane)
        ball = [sum(comb(w, k) for k in range(near + 1)) for w in _widths(per_lane)]
        rows = LANES * per_lane * entries + queries * LANES * sum(ball)
        return PROBE_COST * rows + queries * entries * LANES * sum(n / 2**w for n, w in zip(ball, _widths(per_lane), strict=True))

    return min(range(2, 9), key=work)


def _block(lane: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(lane, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _blocks(lanes: list[Column], per_lane: int) -> list[tuple[Column, int]]:
    """Value and bits of every block."""
    out = []
    for lane in lanes:
        at = 0
        for width in _widths(per_lane):
            out.append((_block(lane, at, width), width))
            at += width
    return out


def _masks(width: int, near: int) -> list[int]:
    """Every choice of at most ``near`` of ``width`` bits."""
    return [sum(1 << b for b in chosen) for k in range(near + 1) for chosen in combinations(range(width), k)]


def _text_of(lanes: list[Column]) -> Column:
    return F.concat(*(F.lower(F.lpad(F.hex(x), 16, "0")) for x in lanes))


def near_pairs(queries: DataFrame, index: DataFrame, radius: int = RADIUS, per_lane: int | None = None) -> DataFrame:
    """``q0 .. q3, i0 .. i3, copies, distance``: each different fingerprint of ``queries(lanes)`` with every other one of ``index(lanes)`` within
    ``radius``, once, and how many rows of the index have it. ``per_lane`` sets the blocks of a lane (``tables_for`` when None)."""
    names = lambda x: [f"{x}{k}" for k in range(LANES)]
    split = lambda df, x: df.select(*(F.col("lanes")[k].alias(c) for k, c in enumerate(names(x))))
    q = materialize(split(queries, "q").distinct())
    i = materialize(split(index, "i").groupBy(*names("i")).agg(F.count(F.lit(1)).alias("copies")))
    per_lane = per_lane or tables_for(q.count(), i.count(), radius)
    near = radius // (LANES * per_lane)
    longest = max(_widths(per_lane))
    key = lambda t, block: block.bitwiseOR(F.lit(t << longest).cast("long"))
    probes = lambda t, block, width: F.transform(F.lit(_masks(width, near)).cast("array<long>"), lambda m: key(t, block.bitwiseXOR(m)))

    asked, held = (_blocks([F.col(c) for c in names(x)], per_lane) for x in ("q", "i"))
    q = q.select(*names("q"), F.explode(F.concat(*(probes(t, b, w) for t, (b, w) in enumerate(asked)))).alias("key"))
    i = i.select(*names("i"), "copies", F.explode(F.array(*(key(t, b) for t, (b, _) in enumerate(held)))).alias("key"))

    apart = [F.col(a).bitwiseXOR(F.col(b)) for a, b in zip(names("q"), names("i"), strict=True)]
    distance = sum((F.bit_count(x) for x in apart), F.lit(0))
    first = F.coalesce(*(F.when(F.bit_count(b) <= near, F.lit(t)) for t, (b, _) in enumerate(_blocks(apart, per_lane))))
    # always a shuffle: the keys of a small table are many times its size, so its size is no ground to broadcast them
    return q.hint("merge").join(i, (q["key"] == i["key"]) & (distance > 0) & (distance <= radius) & (F.shiftrightunsigned(q["key"], longest) == first)).select(
        *names("q"), *names("i"), "copies", distance.alias("distance")
    )


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, per_lane: int | None = None) -> DataFrame:
    """``fingerprint, near, distance``: ``near_pairs`` by the fingerprints as text."""
    own, near = ([F.col(f"{x}{k}") for k in range(LANES)] for x in ("q", "i"))
    return near_pairs(queries, index, radius, per_lane).select(_text_of(own).alias("fingerprint"), _text_of(near).alias("near"), "distance")


def query(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents; ``n_within`` counts the other documents within the radius, copies among them, for every
    document whose id is divisible by 20 (null for the rest)."""
    found = materialize(fingerprints_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    asked = found.where("doc_id % 20 = 0")
    own = [F.col(f"q{k}") for k in range(LANES)]
    near = near_pairs(asked, found).groupBy(*own).agg(F.sum("copies").alias("n")).select(_text_of(own).alias("fingerprint"), "n")
    copies = found.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"))
    counted = asked.select("fingerprint").distinct().join(copies, "fingerprint").join(near, "fingerprint", "left").select(
        "fingerprint", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_within")
    )
    return found.drop("lanes").join(counted, "fingerprint", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.when(F.col("doc_id") % 20 == 0, F.col("n_within")).alias("n_within"),
    )
