"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts, with corpus-wide counts of linked ids.

Both tokenizers see the same bytes (a space and the text), so both lists of tokens are lists of byte ends. An offset where
a token of each ends is a shared cut. An interval between two shared cuts is divided at a common end near its middle: the A
token in the middle is looked up in the ends of B by bisection, then its neighbours outward, and the first common
end splits the interval into two that are divided in turn. An interval without a common end inside is a leaf group. All
intervals of a level, over all documents of a block, take a step at once.

A link is a pair of tokens that end together, so each group has one, of its last tokens. What a pair of ids counts is known only
over the whole corpus, so it takes two passes over what the first one leaves:

1. ``aligned`` writes one row for each ``CHUNK_BYTES`` of text: the documents with their digests, the distinct id
   pairs with their number, and which document has which pair how often (packed 32-bit integers).
2. The pairs alone are summed up over the corpus and joined back to the chunks that hold them: a frequent pair is a row
   a chunk, not a row a document. Each chunk meets its answers in a co-group and adds them up for each document.

Texts are read once and never shuffled; a chunk and its answers are bounded by ``CHUNK_BYTES`` whatever the corpus. A pair of ids
that ties for the most links of its B id counts as best, as do the others it ties with.

Long texts are encoded in parts of about ``PART`` code points, cut at a space between two printable ASCII characters: neither tokenizer
joins tokens across one (B's pieces are checked for it), and both end a token there. A text without such a place is one part.

Defined results: a null or empty text, or one that either tokenizer doesn't give back byte for byte, has no
tokens: zeros and ''. Strings of special tokens in a text are plain text. Repeated rows are documents of their own; a null
doc_id is passed on; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.bpe import PATTERN
from loanlens.llm.common import blocks, materialize, table, texts

PART = 1 << 16
CHUNK_BYTES = 8 << 20
_SAFE = re.compile(r"(?<=[!-~]) (?=[!-~])")


class RankTokenizer:
    """Byte-level BPE from a file of ranks (A)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.engine = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.cuts_at_spaces = True

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [self.engine.encode_ordinary(" " + p) for p in parts]


class PieceTokenizer:
    """SentencePiece BPE with byte fallback (B)."""

    def __init__(self, path: str):
        self.engine = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.engine.id_to_piece(i) for i in range(self.engine.get_piece_size())]
        self.bytes_of = [
            bytes([int(p[1:-1], 16)]) if self.engine.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.cuts_at_spaces = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self.engine.encode(parts, num_threads=1)


def parts_of(text: str, limit: int = PART) -> list[str]:
    """``text`` in parts that end before a space (which is left out, as every part is encoded with one before it)."""
    out, at = [], 0
    while len(text) - at > limit:
        cut = _SAFE.search(text, at + limit)
        if not cut:
            break
        out.append(text[at : cut.start()])
        at = cut.end()
    return [*out, text[at:]]


def encoded(tokenizer, some: list[str], whole: list[bytes]) -> list[list[int] | None]:
    """Ids of each text; None where the text is empty or its tokens' bytes, joined, differ from ``whole``."""
    cut = [parts_of(t) if tokenizer.cuts_at_spaces else [t] for t in some]
    flat = iter(tokenizer.encode([p for parts in cut for p in parts]))
    out: list[list[int] | None] = []
    for text, parts, expected in zip(some, cut, whole, strict=True):
        ids = next(flat)
        for _ in parts[1:]:
            ids = ids + next(flat)
        out.append(ids if text and b"".join(map(tokenizer.bytes_of.__getitem__, ids)) == expected else None)
    return out


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and of the B tokens that end together, in order.

    ``ends_*`` are the byte ends of the tokens of all documents, one after the other; ``last_*`` the documents' last
    tokens, which end together.
    """
    partner = np.full(len(ends_a), -1, dtype=np.int64)
    if not len(last_a):
        return partner, partner
    partner[last_a] = last_b
    # an interval is the A tokens low..high and the B tokens from low_b to high_b; both of the last ones end at its end
    low, high = np.concatenate([[0], last_a[:-1] + 1]).astype(np.int64), last_a.astype(np.int64)
    low_b, high_b = np.concatenate([[0], last_b[:-1] + 1]).astype(np.int64), last_b.astype(np.int64)
    while True:
        inner = (low < high) & (low_b < high_b)
        low, high, low_b, high_b = low[inner], high[inner], low_b[inner], high_b[inner]
        if not len(low):
            break
        middle = (low + high - 1) // 2
        found = np.full(len(low), -1, dtype=np.int64)
        active, away = np.arange(len(low)), 0
        while len(active):
            for probe in (middle[active] + away, middle[active] - away)[: 2 if away else 1]:
                inside = (probe >= low[active]) & (probe < high[active]) & (found[active] < 0)
                at, probed = active[inside], probe[inside]
                place = np.searchsorted(ends_b, ends_a[probed])
                common = ends_b[place] == ends_a[probed]
                found[at[common]] = probed[common]
                partner[probed[common]] = place[common]
            away += 1
            open_ = (found[active] < 0) & ((middle[active] + away < high[active]) | (middle[active] - away >= low[active]))
            active = active[open_]
        split = found >= 0  # the others are leaf groups
        low, high, low_b, high_b, found = low[split], high[split], low_b[split], high_b[split], found[split]
        cut_b = partner[found]
        low, high = np.concatenate([low, found + 1]), np.concatenate([found, high])
        low_b, high_b = np.concatenate([low_b, cut_b + 1]), np.concatenate([cut_b, high_b])
    a = np.flatnonzero(partner >= 0)
    return a, partner[a]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1 as bytes, left-aligned with room for one more, and their number."""
    width = len(str(max(n - 1, 0)))
    text = np.array([str(i).encode() for i in range(n)], dtype=f"S{width + 1}")
    return text.view(np.uint8).reshape(n, width + 1).copy(), np.char.str_len(text).astype(np.int64)


class GroupText:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_a: int, n_b: int):
        self.digits, self.size = _digits(max(n_a, n_b))

    def write(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups one after the other, each followed by ``;``, and where each one ends."""
        total = len(ids_a) + len(ids_b)
        of_a = np.searchsorted(cut_a, np.arange(len(ids_a)))  # the group of each token
        of_b = np.searchsorted(cut_b, np.arange(len(ids_b)))
        before_b = np.concatenate([[0], cut_b[:-1] + 1]) if len(cut_b) else cut_b
        place_a = np.arange(len(ids_a)) + before_b[of_a]
        place_b = np.arange(len(ids_b)) + (cut_a + 1)[of_b]
        ids, mark = np.empty(total, dtype=np.int64), np.full(total, ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        mark[place_a[cut_a]], mark[place_b[cut_b]] = ord("|"), ord(";")
        size = self.size[ids]
        out = self.digits[ids]
        out[np.arange(total), size] = mark
        keep = np.arange(out.shape[1]) <= size[:, None]
        return out[keep].tobytes(), np.cumsum(size + 1)[place_b[cut_b]]


class Aligner:
    """Aligns blocks of texts; one for each task."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = RankTokenizer(path_a), PieceTokenizer(path_b)
        self.length_a = np.array([len(t) for t in self.a.bytes_of], dtype=np.int64)
        self.length_b = np.array([len(t) for t in self.b.bytes_of], dtype=np.int64)
        self.text = GroupText(len(self.length_a), len(self.length_b))

    def groups(self, some: list[str]) -> tuple[np.ndarray, ...]:
        """``n_a, n_b`` of each text, ids of all texts in order, and the numbers of the last tokens of all groups."""
        whole = [(" " + t).encode() for t in some]
        ids = [(x, y) if x is not None and y is not None else ([], []) for x, y in zip(encoded(self.a, some, whole), encoded(self.b, some, whole), strict=True)]
        n_a, n_b = (np.array([len(p[k]) for p in ids], dtype=np.int64) for k in (0, 1))
        ids_a, ids_b = (np.concatenate([np.zeros(0, dtype=np.int64), *(np.array(p[k], dtype=np.int64) for p in ids)]) for k in (0, 1))
        full = n_a > 0
        last_a, last_b = np.cumsum(n_a)[full] - 1, np.cumsum(n_b)[full] - 1
        cut_a, cut_b = shared_cuts(np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b]), last_a, last_b)
        return n_a, n_b, ids_a, ids_b, cut_a, cut_b

    def align(self, some: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """``(n_a, n_b, n_groups, groups_sha256)`` of each text, and the links: number of the text, pair of ids."""
        n_a, n_b, ids_a, ids_b, cut_a, cut_b = self.groups(some)
        doc = np.searchsorted(np.cumsum(n_a), cut_a, side="right")
        n_groups = np.bincount(doc, minlength=len(some))
        written, ends = self.text.write(ids_a, ids_b, cut_a, cut_b)
        rows, group, at = [], 0, 0
        for i in range(len(some)):
            digest = ""
            if n_groups[i]:
                group += int(n_groups[i])
                end = int(ends[group - 1])
                digest = hashlib.sha256(written[at : end - 1]).hexdigest()
                at = end
            rows.append((int(n_a[i]), int(n_b[i]), int(n_groups[i]), digest))
        return rows, doc, ids_a[cut_a] * len(self.length_b) + ids_b[cut_b]


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def aligned(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each ``chunk_bytes`` of the texts of ``docs(doc_id, text)``.

    ``docs`` are its documents; ``pairs`` its distinct id pairs ``a * size of B + b`` in rising order, with their number of links;
    ``pair_count`` (for each document), ``pair`` (its place in ``pairs``) and ``times`` are packed int32 lists.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 32
        ids, rows, links, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            doc = np.concatenate([d for d, _ in links])
            pairs, place = np.unique(np.concatenate([p for _, p in links]), return_inverse=True)
            key, times = np.unique(doc * max(len(pairs), 1) + place, return_counts=True)
            per_doc = np.bincount(key // max(len(pairs), 1), minlength=len(rows))
            packed = [pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (per_doc, key % max(len(pairs), 1), times)]
            n = np.bincount(place, minlength=len(pairs))
            n_a, n_b, n_groups, digest = zip(*rows, strict=True)
            documents = pa.StructArray.from_arrays(
                [pa.concat_arrays(ids), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(digest, pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"],
            )
            counted = pa.StructArray.from_arrays([pa.array(pairs), pa.array(n, pa.int64())], names=["pair", "n"])
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), one(documents), one(counted), *packed], names=["chunk", "docs", "pairs", "pair_count", "pair", "times"]
            )

        for batch in blocks(batches):
            some = texts(batch)
            of_text, doc, pair = aligner.align(some)
            links.append((doc + len(rows), pair))
            ids.append(batch.column("doc_id"))
            rows += of_text
            held += sum(map(len, some))
            if held >= chunk_bytes:
                yield out()
                chunk += 1
                ids, rows, links, held = [], [], [], 0
        if rows:
            yield out()

    doc = f"struct<doc_id:{_id_type(docs)},n_a:bigint,n_b:bigint,n_groups:bigint,groups_sha256:string>"
    schema = f"chunk bigint, docs array<{doc}>, pairs array<struct<pair:bigint,n:bigint>>, pair_count binary, pair binary, times binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(chunks: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: links of each pair of ids over all chunks, and whether no pair of its B id has more."""
    counts = chunks.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("n"))
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs(doc_id, text)``."""
    chunks = materialize(aligned(docs, path_a, path_b, chunk_bytes))
    counts = materialize(pair_counts(chunks, len(PieceTokenizer(path_b).bytes_of)))
    # a pair is one row a chunk that holds it
    answers = chunks.select(F.col("chunk").alias("of_chunk"), F.inline("pairs")).select("of_chunk", "pair").join(counts, "pair")

    def add_up(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        order = np.argsort(answer.column("pair").to_numpy())
        n, best = answer.column("n").to_numpy()[order], answer.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        out = []
        for row in range(chunk.num_rows):
            per_doc, pair, times = (np.frombuffer(chunk.column(c)[row].as_py(), dtype="<i4").astype(np.int64) for c in ("pair_count", "pair", "times"))
            end = np.cumsum(per_doc)
            sums = lambda x, end=end, per_doc=per_doc: np.concatenate([[0], np.cumsum(x)])[end] - np.concatenate([[0], np.cumsum(x)])[end - per_doc]
            documents = chunk.column("docs")[row].values
            doc_id, n_a, n_b, n_groups, digest = documents.flatten()
            columns = [doc_id, n_a, n_b, n_groups, n_groups, pa.array(sums(times * best[pair])), pa.array(sums(times * n[pair])), digest]
            out.append(pa.Table.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(out)

    fields = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = f"doc_id {_id_type(docs)}, " + ", ".join(f"{c} bigint" for c in fields) + ", groups_sha256 string"
    packed = chunks.select("chunk", "docs", "pair_count", "pair", "times")
    return packed.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(add_up, schema)


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir: str) -> DataFrame:
    """Align the whole text of every document under the two vocabularies."""
    return align_documents(table(spark, sf_dir, "documents"), *default_vocabularies())
