"""Byte-level BPE encoding and decoding by reuse of content-defined chunks.

A rolling hash over the bytes cuts each text into chunks, so that a passage shared by documents yields the
same chunks wherever it stands. A Python worker encodes a chunk once and keeps the ids in a bounded cache;
a repeated chunk costs a lookup. Encoding chunks one by one is wrong around their joins, so each join is
repaired: the text from the last word end before it to the first one after it is encoded anew, and the
window grows until its two ends are token boundaries of the chunks beside it. A word end (a printable ASCII
byte followed by ASCII white space) is a boundary of the pre-tokenizer whatever stands around, which makes the
spliced ids equal to those of the whole text.

Chunks are shared within a worker, not through a shuffle: sending every chunk to its hash and the ids back
would move more bytes than encoding costs. So there is no shuffle, and a lost executor only repeats its tasks.

Defined results: null counts as ''; '' has no ids; a special token's string in a text becomes its id, as the
tokenizers library has it; ids that stand for broken UTF-8 decode to U+FFFD; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from loanlens.llm.common import blocks, texts

WINDOW = 32  # bytes under the rolling hash
MIN_CHUNK, MEAN_CHUNK_BITS, MAX_CHUNK = 128, 10, 8192
CACHE_BYTES = 24 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15  # any odd number
# Fixed value: the pre-tokenizer pattern of byte-level BPE with use_regex.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary: printable ones themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE file of the tokenizers library: ranks, bytes of each id, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normalizer and prefix space")
        alphabet = byte_alphabet()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or ask for whole words are not supported")
        self.special = added
        self.ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        self.bytes_of = [b""] * (max([*self.ranks.values(), *added.values()]) + 1)
        for token, i in [*self.ranks.items(), *((t.encode(), i) for t, i in added.items())]:
            self.bytes_of[i] = token
        self.length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None


def cut_points(data: np.ndarray) -> list[int]:
    """Where the rolling hash of ``data`` (bytes) starts a new chunk; always at the start of a character."""
    n = len(data)
    if n <= MIN_CHUNK:
        return []
    spread = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    spread ^= spread >> np.uint64(29)
    cuts: list[int] = []
    step = 1 << 20
    for a in range(WINDOW, n, step):  # blocks overlap by a window: bounded arrays for any text
        b = min(n, a + step)
        part = spread[data[a - WINDOW : b]]
        power = np.full(len(part), _MULTIPLIER, dtype=np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        total = np.cumsum(part * power)
        # window before byte p, scaled so that it doesn't depend on the place
        window = total[WINDOW - 1 : -1] - np.concatenate([[np.uint64(0)], total[: -WINDOW - 1]])
        back = np.full(len(window), pow(_MULTIPLIER, -1, 1 << 64), dtype=np.uint64)
        back[0] = 1
        window = window * np.multiply.accumulate(back)
        hit = np.flatnonzero((window >> np.uint64(64 - MEAN_CHUNK_BITS)) == 0)
        cuts.extend((hit + a).tolist())
    out, last = [], 0
    for p in [*cuts, n]:
        while p - last > MAX_CHUNK:
            at = last + MAX_CHUNK
            while data[at] & 0xC0 == 0x80:
                at -= 1
            out.append(at)
            last = at
        while p < n and data[p] & 0xC0 == 0x80:
            p += 1
        if p < n and p - last >= MIN_CHUNK:
            out.append(p)
            last = p
    return out


class Cache:
    """bytes -> value in two generations: when the young one is full it becomes the old one."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.young: dict = {}
        self.old: dict = {}
        self.size, self.limit = 0, limit // 2

    def get(self, key: bytes, make: Callable):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = make(key)
            self.young[key] = value
            self.size += 3 * len(key) + 300
            if self.size > self.limit:
                self.old, self.young, self.size = self.young, {}, 0
        return value


class ChunkCodec:
    """Encoder and decoder of one worker."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.engine = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=self.vocabulary.ranks, special_tokens={})
        self.vocabulary.ranks = {}  # the engine has its own
        self.cache = Cache()
        self.encoded = 0  # bytes that the engine saw

    def _fresh(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        self.encoded += len(piece)
        ids = np.array(self.engine.encode_ordinary(piece.decode("utf-8", "surrogatepass")), dtype=np.uint32)
        return ids, np.concatenate([[0], np.cumsum(self.vocabulary.length[ids])])

    def _segment(self, data: bytes) -> list[np.ndarray]:
        """Ids of a text without special tokens, in pieces."""
        raw = np.frombuffer(data, dtype=np.uint8)
        n = len(data)
        bounds = [0, *cut_points(raw), n]
        if len(bounds) == 2:
            return [self.cache.get(data, self._fresh)[0]] if data else []
        chunks = [self.cache.get(data[a:b], self._fresh) for a, b in zip(bounds, bounds[1:], strict=False)]
        space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
        safe = np.flatnonzero(space[1:] & (raw[:-1] > 0x20) & (raw[:-1] < 0x7F)) + 1
        windows: list[list[int]] = []
        for k in range(1, len(bounds) - 1):
            c = bounds[k]
            left = int(np.searchsorted(safe, c, side="right")) - 1
            right = int(np.searchsorted(safe, c, side="left"))
            while True:
                s = int(safe[left]) if left >= 0 else 0
                e = int(safe[right]) if right < len(safe) else n
                agree_left = s <= bounds[k - 1] or self._boundary(chunks[k - 1][1], s - bounds[k - 1])
                agree_right = e >= bounds[k + 1] or self._boundary(chunks[k][1], e - c)
                if agree_left and agree_right:
                    break
                left -= not agree_left
                right += not agree_right
            if windows and s < windows[-1][1]:
                windows[-1][1] = max(e, windows[-1][1])
            else:
                windows.append([s, e])
        out, at = [], 0
        for s, e in [*windows, [n, n]]:
            if at < s:  # between two windows: within one chunk
                k = int(np.searchsorted(bounds, at, side="right")) - 1
                ids, ends = chunks[k]
                out.append(ids[np.searchsorted(ends, at - bounds[k]) : np.searchsorted(ends, s - bounds[k])])
            if s < e:
                out.append(self.cache.get(data[s:e], self._fresh)[0])
            at = max(at, e)
        return out

    @staticmethod
    def _boundary(ends: np.ndarray, at: int) -> bool:
        i = int(np.searchsorted(ends, at))
        return i < len(ends) and int(ends[i]) == at

    def encode(self, text: str) -> np.ndarray:
        split = self.vocabulary.split
        parts = split.split(text) if split else [text]
        out: list[np.ndarray] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([self.vocabulary.special[part]], dtype=np.uint32))
            else:
                out.extend(self._segment(part.encode("utf-8", "surrogatepass")))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        table = self.vocabulary.bytes_of
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs(doc_id, text)``; ``vocabulary`` is a path that every executor can read."""

    def run(batches):
        codec = ChunkCodec(vocabulary)
        for batch in blocks(batches):
            ids = [codec.encode(t) for t in texts(batch)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, dtype=np.uint32)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {_id_type(docs)}, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` of every row of ``encoded(doc_id, ids)``; a null list counts as empty."""

    def run(batches):
        codec = ChunkCodec(vocabulary)
        for batch in batches:
            out = [codec.decode(np.array(x or [], dtype=np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_id_type(encoded)}, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes, decodes the ids, and digests both in one pass.

    Ids are digested as little-endian unsigned 32-bit integers, the decoded text as UTF-8.
    """

    def run(batches):
        codec = ChunkCodec(vocabulary)
        for batch in blocks(batches):
            rows = []
            for t in texts(batch):
                ids = codec.encode(t)
                decoded = codec.decode(ids).encode("utf-8", "surrogatepass")
                rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            n, a, b = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"doc_id {_id_type(docs)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir: str) -> DataFrame:
    """Encode and decode the whole text of every document."""
    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
