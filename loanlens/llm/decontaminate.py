"""Benchmark decontamination by spaced seeds, with built-in SQL functions only.

Texts and benchmark items become tokens (runs of letters and digits, lower case), tokens become 64-bit hashes. Each
fixed mask takes the tokens at its ones and ignores those at its zeros, at every position: a substituted token under
a zero doesn't hide a hit. Seeds of texts and items meet in an equi-join; around each hit the two token
sequences are laid side by side on the hit's diagonal and the equal tokens are counted over the whole item, so
substitutions elsewhere only lower the count.

An item with fewer tokens than the shortest mask spans has one seed instead, over all its tokens, and texts are hashed in windows of
that length, too (only of lengths that the benchmark has).

A document is contaminated by an item from ``MIN_EQUAL`` equal tokens on (``MIN_SHARE`` of the item where that is less).
A hit whose predecessor on its diagonal is a hit under the same mask is not counted again, so a verbatim copy costs
one count a mask, not one a token.

Seeds are lean: hash, item and place. They and the items' tokens, each once, are broadcast while both together are at most
``MAX_BROADCAST_BYTES``, which is computed from the items' lengths beforehand; texts are then never shuffled. Beyond that, seeds of
texts (document, place, hash) meet those of items by a shuffle, are reduced to distinct diagonals, and only
documents with a diagonal fetch their tokens. Both forms give the same rows.

Defined results: null and empty texts and items have no tokens and match nothing; repeated items count once for each
``item_id``, which matches by any of its texts; repeated rows of a ``doc_id`` are one document with all its matches;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import materialize

MASKS = ["111010011", "1100101011"]
MIN_EQUAL, MIN_SHARE = 12, 0.8
MAX_BROADCAST_BYTES = 64 << 20
SEED_BYTES = 48  # a row of the hash table
TOKEN = r"[\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _windows(lengths: list[int]) -> dict[int, list[int]]:
    """Offsets of the tokens under each seed's number: the masks, then windows of the given lengths."""
    return {m: _offsets(mask) for m, mask in enumerate(MASKS)} | {len(MASKS) + n: list(range(n)) for n in lengths}


def _with_seeds(rows: DataFrame, tokens: str, windows: dict[int, list[int]]) -> DataFrame:
    """One row for each window at every position where it fits: the columns of ``rows`` with ``number``, ``pos`` and ``seed``."""

    def seeds(number: int, offsets: list[int]) -> Column:
        last = F.size(tokens) - (offsets[-1] + 1)
        hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(number), *(F.get(tokens, i + o) for o in offsets)))
        return F.struct(F.lit(number).alias("number"), F.when(last >= 0, hashes).alias("of"))

    each = rows.select("*", F.inline(F.array(*(seeds(k, o) for k, o in windows.items()))))
    return each.select("*", F.posexplode("of").alias("pos", "seed")).drop("of")


def _count_equal(shift: Column) -> Column:
    n = F.size("item_tokens")
    return F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.lit(0),
        lambda acc, j: acc + F.when((j + shift >= 0) & (F.get("tokens", j + shift) == F.get("item_tokens", j)), 1).otherwise(0),
    )


def _continues(windows: dict[int, list[int]]) -> Column:
    """True where the window one place earlier on the diagonal is a hit, too."""
    out = F.lit(False)
    for number, offsets in windows.items():
        same = F.lit(True)
        for o in offsets:
            same = same & (F.get("tokens", F.col("pos") - 1 + o) == F.get("item_tokens", F.col("item_pos") - 1 + o))
        out = F.when(F.col("number") == number, same).otherwise(out)
    return (F.col("pos") > 0) & (F.col("item_pos") > 0) & out


def matches(docs: DataFrame, benchmark: DataFrame, max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``doc_id, item_id, n_equal, n_tokens``: each contaminated document and item, with the most equal
    tokens on one diagonal and the item's length."""
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("item_tokens")).where("size(item_tokens) > 0").distinct()
    items = materialize(items.withColumn("item", F.xxhash64("item_id", "item_tokens")))
    span = min(map(len, MASKS))
    sizes = items.groupBy(F.least(F.size("item_tokens"), F.lit(span)).alias("n")).agg(F.sum(F.size("item_tokens")).alias("total")).collect()  # at most ``span`` rows
    windows = _windows(sorted(r["n"] for r in sizes if r["n"] < span))
    size = sum(r["total"] for r in sizes) * (len(MASKS) * SEED_BYTES + 8)
    fits = (F.col("number") < len(MASKS)) | (F.size("item_tokens") + len(MASKS) == F.col("number"))  # a short window is a whole item
    seeds = _with_seeds(items, "item_tokens", windows).where(fits).select("seed", "number", "item", F.col("pos").alias("item_pos"))
    seeds = materialize(seeds)
    of_doc = docs.select("doc_id", token_hashes(F.col("text")).alias("tokens"))
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    if size <= max_broadcast:
        hits = _with_seeds(of_doc, "tokens", windows).join(F.broadcast(seeds), ["seed", "number"])
        found = hits.join(F.broadcast(items), "item").where(~_continues(windows)).select("doc_id", "item_id", "item", "tokens", "item_tokens", shift)
    else:
        # a text is known by its id and its tokens' hash: rows may repeat an id
        keyed = of_doc.withColumn("text_key", F.xxhash64("tokens"))
        hits = _with_seeds(keyed, "tokens", windows).select("doc_id", "text_key", "number", "pos", "seed").join(seeds, ["seed", "number"])
        diagonals = materialize(hits.select("doc_id", "text_key", "item", shift).distinct())
        texts = keyed.dropDuplicates(["doc_id", "text_key"])
        same = diagonals["doc_id"].eqNullSafe(texts["doc_id"]) & (diagonals["text_key"] == texts["text_key"])
        found = diagonals.join(texts, same).select(diagonals["doc_id"], "item", "tokens", "shift").join(items, "item")
    n = F.size("item_tokens")
    least = F.least(F.lit(MIN_EQUAL), F.ceil(n * MIN_SHARE))
    # the threshold follows the aggregate: as a condition of the join it would take explode and probe out of generated code
    return (
        found.select("doc_id", "item_id", "item", _count_equal(F.col("shift")).alias("n_equal"), n.alias("n_tokens"), least.alias("least"))
        .groupBy("doc_id", "item_id", "item")
        .agg(F.max("n_equal").alias("n_equal"), F.max("n_tokens").alias("n_tokens"), F.max("least").alias("least"))
        .where("n_equal >= least")
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_equal").alias("n_equal"), F.max("n_tokens").alias("n_tokens"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, item_ids, n_equal``: one row for each contaminated document."""
    return (
        matches(docs, benchmark)
        .groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.array_join(F.transform(F.array_sort(F.collect_list("item_id")), lambda i: i.cast("string")), ",").alias("item_ids"),
            F.max("n_equal").cast("long").alias("n_equal"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) whose document matches no item; null ids are compared as equal."""
    found = materialize(matches(docs, benchmark).select("doc_id").distinct())
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item or a long part of one."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def oracle_sql() -> str:
    """The same documents in DuckDB: token lists instead of hashes, the same masks and counts."""
    windows = _windows(list(range(1, min(map(len, MASKS)))))

    def seeds(source: str, key: str, short: str) -> str:
        parts = []
        for k, offsets in windows.items():
            at = ", ".join(f"w[i + {o}]" for o in offsets)
            where = "" if k < len(MASKS) else f" WHERE {short.format(n=len(offsets))}"
            parts.append(
                f"SELECT {key}, w, i, {{'m': {k}, 't': [{at}]}} AS seed "
                f"FROM (SELECT {key}, w, unnest(range(1, len(w) - {offsets[-1] + 1} + 2)) AS i FROM {source}{where})"
            )
        return " UNION ALL ".join(parts)

    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '{TOKEN}') AS w FROM benchmark),
ds AS ({seeds("d", "doc_id", "{n} IN (SELECT len(w) FROM b)")}),
bs AS ({seeds("b", "item_id", "len(w) = {n}")}),
hits AS (
  SELECT DISTINCT doc_id, item_id, ds.w AS dw, bs.w AS bw, ds.i - bs.i AS shift FROM ds JOIN bs ON ds.seed = bs.seed
),
counted AS (
  SELECT doc_id, item_id, len(bw) AS n,
    len(list_filter(range(1, len(bw) + 1), lambda j : j + shift >= 1 AND j + shift <= len(dw) AND dw[j + shift] = bw[j])) AS n_equal
  FROM hits
),
m AS (
  SELECT doc_id, item_id, max(n_equal) AS n_equal FROM counted WHERE n_equal >= least({MIN_EQUAL}, ceil(n * {MIN_SHARE})) GROUP BY ALL
)
SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids, max(n_equal) AS n_equal
FROM m GROUP BY doc_id
"""
