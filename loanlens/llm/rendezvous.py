"""Sharding by rendezvous hashing over weighted shards, with built-in SQL functions only.

Every shard has a number and a weight. A record's key is hashed together with each shard's number; the hash, a uniform
``u`` in (0, 1), gives the score ``-weight / ln(u)``, and the record goes to the shard with the highest one. A shard wins
records in proportion to its weight. Scores of the other shards don't depend on a shard that is added or
taken away, so a new shard only takes records into itself, and the records of one that goes spread over the
rest. Nothing is stored: key and shards alone decide, under any partitioning and after any retry.

``assign`` is a projection. ``slots`` numbers the records of each shard from 0 without a gap and without a task that sees a whole
shard: records are first counted (``docs`` rows with equal key, size and checksum are one counted record, so a key that
holds a third of all rows is one row a task), dealt into ``BUCKETS`` buckets a shard by a hash of all three, summed up
within the buckets and shifted by the total of the buckets before. The totals are at most ``BUCKETS`` rows a shard and are
broadcast. A record's copies are spread over the tasks again before they are written out one by one.

The law of the query is ``key``: the document id and the number of shards decide, not the text. Documents of equal text
are a group only in that they share a checksum; they go where their ids send them.

Defined results: a null key is the key '', all rows of one key go to one shard; a null text has no bytes (size 8,
checksum 0); an empty table gives no rows; repeated rows get slots of their own; in ``assign`` an existing column of
the output's name is replaced, other columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanlens.llm.common import materialize, table

SHARDS = 24
OVERHEAD_BYTES = 8
BUCKETS = 4096  # three hexadecimal digits
HASH_DIGITS = 13  # hexadecimal: 52 bits, exact in a double
COPIES = 1 << 12  # copies of one record that are written out from one row


def equal_weights(n: int) -> dict[int, float]:
    return dict.fromkeys(range(n), 1.0)


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(""))


def _hash(key: Column, shard: int) -> Column:
    digest = F.md5(F.concat(key, F.lit(f":{shard}")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")


def _bids(rows: DataFrame, key: Column, shards: Mapping[int, float]) -> tuple[DataFrame, dict[int, Column]]:
    """``rows`` with a hash column for each shard, and each shard's bid: score, hash, and the lower number on a tie."""
    if not shards or any(s < 0 or w <= 0 for s, w in shards.items()):
        raise ValueError("shards are non-negative numbers with positive weights")
    rows = rows.withColumns({f"_hash_{s}": _hash(key_text(key), s) for s in shards})
    bids = {}
    for s, weight in shards.items():
        u = (F.col(f"_hash_{s}") + 0.5) / F.lit(float(16**HASH_DIGITS))
        bids[s] = F.struct((-F.lit(float(weight)) / F.log(u)).alias("score"), F.col(f"_hash_{s}").alias("hash"), F.lit(-s).alias("order"))
    return rows, bids


def _winner(bids: list[Column]) -> Column:
    return F.negative((F.greatest(*bids) if len(bids) > 1 else bids[0])["order"])


def assign(rows: DataFrame, key: str, shards: Mapping[int, float], out: str = "shard", grown: Mapping[int, float] | None = None) -> DataFrame:
    """``rows`` with the shard of each record's ``key`` in ``out``, and with ``grown`` (more shards beside the same ones) the
    shard it then has in ``grown_<out>``. No shuffle."""
    names = [c for c in rows.columns if c.lower() not in (out.lower(), f"grown_{out}".lower())]
    extra = {s: w for s, w in (grown or {}).items() if s not in shards}
    if grown and {s: grown.get(s) for s in shards} != dict(shards):
        raise ValueError("grown keeps the given shards and their weights")
    hashed, bids = _bids(rows, F.col(f"`{key}`"), {**shards, **extra})
    before = _winner([bids[s] for s in shards]).alias(out)
    after = [_winner(list(bids.values())).alias(f"grown_{out}")] if grown else []
    return hashed.select(*(f"`{c}`" for c in names), before, *after)


def slots(records: DataFrame, shard: str, identity: list[str]) -> DataFrame:
    """A row for each row of ``records``: its ``shard``, ``identity`` columns and ``slot``, gapless from 0 in each shard.

    Equal records may take each other's slots. The order within a shard is by a hash, then by ``identity``.
    """
    columns = [*identity, shard]
    bucket = F.conv(F.substring(F.md5(F.concat_ws(":", *(key_text(F.col(c)) for c in identity))), 1, 3), 16, 10).cast("int")
    counted = materialize(records.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", bucket))
    totals = counted.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_in_bucket"))
    earlier = W.unboundedPreceding, -1
    by_bucket = W.partitionBy(shard).orderBy("_bucket").rowsBetween(*earlier)
    offsets = totals.select(F.col(shard).alias("_shard"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_in_bucket").over(by_bucket), F.lit(0)).alias("_offset"))
    within = W.partitionBy(shard, "_bucket").orderBy(*identity).rowsBetween(*earlier)
    first = counted.withColumn("_first", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    # at most BUCKETS rows a shard
    placed = first.join(F.broadcast(offsets), F.col(shard).eqNullSafe(F.col("_shard")) & (F.col("_bucket") == F.col("_b")))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES)))
    start = placed.select(*columns, (F.col("_first") + F.col("_offset")).alias("_at"), "_n", parts.alias("_part")).hint("rebalance")
    copy = F.explode(F.sequence(F.col("_part") * COPIES, F.least((F.col("_part") + 1) * COPIES, F.col("_n")) - 1))
    return start.select(*columns, "_at", copy.alias("_copy")).select(*columns, (F.col("_at") + F.col("_copy")).alias("slot"))


def shard_documents(docs: DataFrame, shards: Mapping[int, float], grown: Mapping[int, float]) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs(doc_id, text)``; texts are not shuffled."""
    content = F.coalesce(F.col("text"), F.lit(""))
    records = docs.select(
        "doc_id", (F.octet_length(content) + OVERHEAD_BYTES).cast("long").alias("size"), F.crc32(content.cast("binary")).alias("text_crc32")
    )
    identity = ["doc_id", "size", "text_crc32"]
    numbered = slots(assign(records, "doc_id", shards, grown=grown).withColumnRenamed("grown_shard", "grown"), "shard", [*identity, "grown"])
    return numbered.select(*identity, F.lit("key").alias("law"), "shard", "slot", F.col("grown").alias("grown_shard"))


def write_shards(docs: DataFrame, folder: str, key: str, shards: Mapping[int, float], rows_per_file: int = 1_000_000) -> None:
    """All columns of ``docs`` as Parquet under ``folder/shard=N``. Spark splits what is large and joins what is small
    (rebalance), so a shard is neither one task nor a file a task."""
    dealt = assign(docs, key, shards).hint("rebalance", "shard")
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(folder)


def query(spark, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 23 by their id, and where shard 24 would take them."""
    return shard_documents(table(spark, sf_dir, "documents"), equal_weights(SHARDS), equal_weights(SHARDS + 1))


def oracle_sql() -> str:
    """The same in DuckDB: the highest hash wins as weights are equal, slots by one window, CRC-32 byte by byte from its polynomial."""
    return f"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8
),
rest AS (SELECT list(v ORDER BY i) AS of FROM step WHERE k = 8),
bytes AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b
  FROM documents
),
records AS (
  SELECT row, doc_id, key, len(b) + {OVERHEAD_BYTES} AS size,
    xor(list_reduce(list_prepend(4294967295, b), lambda acc, x: xor(acc >> 8, of[(xor(acc, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, rest
),
bids AS (
  SELECT row, s, CAST('0x' || substr(md5(key || ':' || s), 1, {HASH_DIGITS}) AS BIGINT) AS hash FROM records, range({SHARDS + 1}) t(s)
),
won AS (
  SELECT row, arg_max(s, hash * 100 - s) FILTER (s < {SHARDS}) AS shard, arg_max(s, hash * 100 - s) AS grown FROM bids GROUP BY row
),
dealt AS (
  SELECT records.*, CAST(shard AS INTEGER) AS shard, CAST(grown AS INTEGER) AS grown,
    substr(md5(key || ':' || size || ':' || text_crc32 || ':' || grown), 1, 3) AS bucket
  FROM records JOIN won USING (row)
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32, grown) - 1 AS slot, grown AS grown_shard
FROM dealt
"""
