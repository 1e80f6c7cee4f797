"""Fill-in-middle transformation with a Fenwick tree over fixed text blocks.

A text's units are its runs of letters A-Z (either case) and every other code point. Its UTF-8 bytes are cut into blocks of
``BLOCK`` bytes; a Fenwick tree over the blocks holds how many units and code points start in each. To cut
after ``k`` units, a binary-lifting descent of the tree finds the block in which unit ``k`` starts, with the units and code
points before it, and the place inside that block is then found among its own units. No list of units is ever
made: beside the text, memory is a mask of a byte each and one tree node a block.

Hashes of the document id choose the two cuts and the form, so a retry or another partitioning gives the same output:

    psm    <P> prefix <S> suffix <M> middle
    spm    <S> suffix <P> prefix <M> middle
    plain  the text itself

A text that holds one of the marks stays plain, so the marks of an output are its own and ``rebuild`` is exact. There is no
shuffle; tasks work on blocks of rows of bounded size, a longer text is a block of its own.

Defined results: a null text counts as '' and is plain with 0 units; a null id is hashed as ''; repeated rows give repeated
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanlens.llm.common import blocks, table, utf8

BLOCK = 1024  # bytes of text a tree leaf
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
SEED = 1

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True


class BlockCounts:
    """Fenwick tree over the blocks of one text: node ``i`` sums the units and code points of the ``i & -i`` blocks up to block ``i``."""

    def __init__(self, units: list[int], points: list[int]):
        n = len(units)
        self.units, self.points = [0, *units], [0, *points]
        for i in range(1, n + 1):
            parent = i + (i & -i)
            if parent <= n:
                self.units[parent] += self.units[i]
                self.points[parent] += self.points[i]
        self.top = 1 << n.bit_length() >> 1

    def descend(self, k: int) -> tuple[int, int, int]:
        """The block in which unit ``k`` (from 0) starts, how many of its units come before, and the code points before the block."""
        block, points, step, units, all_points = 0, 0, self.top, self.units, self.points
        last = len(units) - 1
        while step:
            after = block + step
            if after <= last and units[after] <= k:
                block, k, points = after, k - units[after], points + all_points[after]
            step >>= 1
        return block, k, points


class Units:
    """Where units and code points start in the texts of a batch, and a tree for each text."""

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) for t in texts], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(size)])
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.point = (raw & 0xC0) != 0x80
        letter = _LETTER[raw]
        follows = np.zeros(len(raw), dtype=bool)
        follows[1:] = letter[:-1]
        follows[self.first[:-1][size > 0]] = False
        self.unit = self.point & ~(letter & follows)
        self.of_text = (size + BLOCK - 1) // BLOCK
        leaf = np.concatenate([[0], np.cumsum(self.of_text)])
        at = np.repeat(self.first[:-1] - leaf[:-1] * BLOCK, self.of_text) + np.arange(leaf[-1]) * BLOCK
        sums = lambda mask: np.add.reduceat(mask, at, dtype=np.int64).tolist() if len(at) else []
        self.leaf, self.units, self.points = leaf.tolist(), sums(self.unit), sums(self.point)

    def tree(self, i: int) -> tuple[BlockCounts, int]:
        """The tree of text ``i`` and its number of units."""
        a, b = self.leaf[i], self.leaf[i + 1]
        return BlockCounts(self.units[a:b], self.points[a:b]), sum(self.units[a:b])

    def cut(self, i: int, tree: BlockCounts, k: int) -> tuple[int, int]:
        """Byte and code point of text ``i`` after its first ``k`` units; ``k`` is below its number of units."""
        block, left, points = tree.descend(k)
        a = int(self.first[i]) + block * BLOCK
        b = min(a + BLOCK, int(self.first[i + 1]))
        inside = int(np.flatnonzero(self.unit[a:b])[left])
        return block * BLOCK + inside, points + int(np.count_nonzero(self.point[a : a + inside]))


@dataclass
class Transformed:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def transform_texts(ids: list, texts: list[bytes], seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> Iterator[Transformed]:
    """The transformed form of each text, by its id."""
    units = Units(texts)
    for i, (key, text) in enumerate(zip(ids, texts, strict=True)):
        digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
        h1, h2, h3, h4 = (int.from_bytes(digest[j : j + 4], "big") for j in (0, 4, 8, 12))
        tree, n = units.tree(i)
        if not text or h3 % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            yield Transformed(n, "plain", None, None, text)
            continue
        cuts = []
        for k in sorted((h1 % (n + 1), h2 % (n + 1))):
            cuts.append(units.cut(i, tree, k) if k < n else (len(text), int(sum(units.points[units.leaf[i] : units.leaf[i + 1]]))))
        (a, prefix_chars), (b, end_chars) = cuts
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_below:
            form, out = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
        else:
            form, out = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
        yield Transformed(n, form, prefix_chars, end_chars - prefix_chars, b"".join(out))


def rebuild(output: bytes, form: str) -> bytes:
    """The text from its transformed form."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, _, rest = output[len(first) :].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    return one + middle + two if form == "psm" else two + middle + one


def _id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def transform_documents(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs(doc_id, text)``."""

    def run(batches):
        for batch in blocks(batches):
            ids = batch.column("doc_id")
            out = list(transform_texts(ids.to_pylist(), utf8(batch), seed, plain_from, spm_below))
            column = lambda name, kind: pa.array([getattr(t, name) for t in out], kind)
            yield pa.RecordBatch.from_arrays(
                [ids, column("n", pa.int64()), column("form", pa.string()), column("prefix_chars", pa.int64()), column("middle_chars", pa.int64()),
                 column("output", pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    schema = f"doc_id {_id_type(docs)}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restore_documents(transformed: DataFrame) -> DataFrame:
    """``doc_id, text`` of every row of ``transformed(doc_id, form, output)``; a null output counts as ''."""

    def run(batches):
        for batch in blocks(batches, "output"):
            out = [rebuild(t, f) for t, f in zip(utf8(batch, "output"), batch.column("form").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return transformed.select("doc_id", "form", "output").mapInArrow(run, f"doc_id {_id_type(transformed)}, text string")


def round_trip_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``: transforms, rebuilds, digests both in one pass."""

    def run(batches):
        for batch in blocks(batches):
            ids = batch.column("doc_id")
            rows = []
            for t in transform_texts(ids.to_pylist(), utf8(batch)):
                restored = hashlib.sha256(rebuild(t.output, t.form)).hexdigest()
                rows.append((t.n, t.form, t.prefix_chars, t.middle_chars, hashlib.sha256(t.output).hexdigest(), restored))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            values = [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *values], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    schema = f"doc_id {_id_type(docs)}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """Transform and rebuild the whole text of every document."""
    return round_trip_digests(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The same in DuckDB by lists of units."""
    marks = " OR ".join(f"contains(t, '{m.decode()}')" for m in (PREFIX, SUFFIX, MIDDLE))
    h = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w FROM d),
k AS (
  SELECT *, len(w) AS n, least({h(0)} % (len(w) + 1), {h(1)} % (len(w) + 1)) AS a, greatest({h(0)} % (len(w) + 1), {h(1)} % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR {marks} OR {h(2)} % 100 >= {PLAIN_FROM} THEN 'plain' WHEN {h(3)} % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM u
),
p AS (
  SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
