"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.session import checkpointed

# Bytes of text that a Python task works on at a time, whatever the size of the Arrow batch.
BLOCK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(col: str, n: int) -> Column:
    """``crc32(id as text) mod n``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def materialize(df: DataFrame) -> DataFrame:
    """Write under ``spark.checkpoint.dir`` and read back: cuts the lineage, survives lost executors."""
    return checkpointed(df)


def release_memory() -> None:
    """Give freed memory back to the system, so that a Python worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer used: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``limit`` bytes of text (a longer row is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
        del batch, size, part
        release_memory()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as ''."""
    return [t or "" for t in batch.column(column).to_pylist()]


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, as UTF-8 (``bytes`` lower-cases and splits by ASCII alone)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def draw_hash(key: list[str]) -> Column:
    """The hash by which ``bounded_sample`` draws."""
    return F.xxhash64(*key, F.lit(17))


def bounded_sample(df: DataFrame, bound: float | dict, by: str | None = None, *, key: list[str], draw: Column | None = None) -> DataFrame:
    """About ``bound`` rows (of each value of ``by``; a dictionary gives each its own), chosen by a hash of ``key``; everything when there are fewer.

    The same rows come back under any partitioning or retry. ``by`` must have few values (labels). ``draw`` is the hash
    where ``df`` has it in place of the columns.
    """
    draw = draw_hash(key) if draw is None else draw
    group = F.col(by) if by else F.lit(0)
    scale = 1 << 30
    keep = F.lit(False)
    for value, n in df.groupBy(group.alias("g")).count().collect():
        own = bound.get(value, 0) if isinstance(bound, dict) else bound
        share = min(scale, int(scale * own / max(n, 1)))
        keep = keep | (group.eqNullSafe(F.lit(value)) & (F.pmod(draw, F.lit(scale)) < F.lit(share)))
    return df.where(keep)


# Word hashes: sum of a random value of each byte times a power of an odd number, mod 2^64, freed of the
# word's place by the inverse power, then finished. A-Z share the values of a-z.
_ODD = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE[_SPACE] = 0
_CUT = re.compile(rb"[\x20\x09-\x0D]")


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of ``_ODD`` and of its inverse, as many as were needed so far."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
                p = np.full(n, base, dtype=np.uint64)
                p[0] = 1
                setattr(cls, name, np.multiply.accumulate(p))
        return cls.up, cls.down


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data``, which ends in white space, and where they start."""
    raw = np.frombuffer(data, dtype=np.uint8)
    up, down = _Powers.to(len(raw))
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_VALUE[raw] * up[: len(raw)], out=total[1:])
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    start, end = edge[::2], edge[1::2]
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def word_hashes(documents: list[bytes], limit: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all documents (``words``, A-Z as a-z), one after the other, and the number of each.

    Memory is in proportion to ``limit`` and the number of words, whatever the length of a document.
    """
    hashes, counts = [np.zeros(0, dtype=np.uint64)], np.zeros(len(documents), dtype=np.int64)
    held: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush():
        h, start = _hash_piece(b"\n".join(held) + b"\n")
        first = np.cumsum([0] + [len(p) + 1 for p in held])
        counts_here = np.diff(np.searchsorted(start, first))
        np.add.at(counts, owner, counts_here)
        hashes.append(h)

    for d, whole in enumerate(documents):
        at = 0
        while at < len(whole):
            cut = len(whole)
            if cut - at > limit:
                found = _CUT.search(whole, at + limit)  # the next white space: no word is cut
                cut = found.start() if found else cut
            piece = whole[at:cut]
            at = cut
            if held and size + len(piece) > limit:
                flush()
                held, owner, size = [], [], 0
            held.append(piece)
            owner.append(d)
            size += len(piece)
    if held:
        flush()
    return np.concatenate(hashes), counts


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8, null as b''."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
