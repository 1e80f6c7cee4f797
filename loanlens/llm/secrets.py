"""Secret spans by character Markov models, with built-in SQL functions only.

Base spans come from three fixed patterns and are always kept. Further candidates are long runs of key
characters; two first-order Markov models, of random strings and of ordinary identifiers, are compared
by the log-likelihood ratio of the run's character transitions. The models are trained from labels: the different
values inside base matches of all documents against the other words in a bounded sample of documents (``TRAIN_DOCS``, a
documented bound; candidates, scores and spans cover all rows and whole texts). Only transition counts, at
most (number of key characters + 1) squared a class, reach the driver.

Defined results: null and empty texts have no spans; with no value of a class its model is uniform; candidates
that overlap a base span are left out; repeated rows give repeated rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.linalg import let
from loanlens.llm.common import bounded_sample
from loanlens.llm.spans import characters, joined, match_spans, no_spans, outside, running, text_between, text_blocks

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ASSIGN_MIN = 12
# Shorter runs fail, and no part of a run can be longer than the run, so the least length is part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
TRAIN_DOCS = 4_000
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
# A candidate is reported from these posterior odds on, given that one run in PRIOR is a secret.
PRIOR = 10_000.0
MASK = "[SECRET]"


def base_spans(text: Column) -> Column:
    """``array<struct<start, k, end, kind, value>>`` of the fixed patterns, sorted by start, then kind."""
    none = no_spans()
    value = lambda s: F.regexp_extract(s["value"], ASSIGN_VALUE, 1)
    assign = F.when(F.regexp_like(text, F.lit("[:=]")), match_spans(text, ASSIGN)).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")), match_spans(text, ACCESS)).otherwise(none)
    found = [F.filter(assign, lambda s: F.char_length(value(s)) >= ASSIGN_MIN), access, match_spans(text, HEX)]
    tagged = lambda k: lambda s: F.struct(
        s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), F.lit(KINDS[k]).alias("kind"),
        (value(s) if k == 0 else s["value"]).alias("value"),
    )
    return F.array_sort(F.concat(*(F.transform(a, tagged(k)) for k, a in enumerate(found))))


def _transitions(values: DataFrame) -> np.ndarray:
    """Transition counts of the strings in ``values(value)``, over ALPHABET."""
    two = let(characters(F.col("value")), lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c)), lambda a, b: F.concat(a, b)))
    pairs = (
        values.where("char_length(value) > 1")
        .groupBy("value")
        .count()
        .select("count", F.explode(two).alias("pair"))
        .groupBy("pair")
        .agg(F.sum("count").alias("n"))
        .where(F.regexp_like("pair", F.lit(r"^[A-Za-z0-9+/_=-]{2}$")))
        .collect()
    )
    out = np.zeros((len(ALPHABET), len(ALPHABET)))
    for r in pairs:
        out[ALPHABET.index(r["pair"][0]), ALPHABET.index(r["pair"][1])] = r["n"]
    return out


def log_ratio(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """log P(next | char) under the model of random strings less that of identifiers. Sparse rows lean on
    the class's character frequencies, and those on the uniform distribution."""

    def model(n: np.ndarray) -> np.ndarray:
        frequency = (n.sum(axis=0) + 1) / (n.sum() + n.shape[0])
        return (n + 20 * frequency) / (n.sum(axis=1, keepdims=True) + 20)

    return np.log(model(random)) - np.log(model(ordinary))


def fit(docs: DataFrame, bound: int = TRAIN_DOCS) -> np.ndarray:
    """Log ratios of all transitions: secrets, which may be rare, from all documents, other words from about ``bound`` at most."""
    known = docs.select("text").where("text is not null")
    sample = bounded_sample(known, bound, key=["text"])
    random = known.select(F.explode(base_spans(F.col("text"))).alias("s")).select("s.value").distinct()
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = sample.select(F.explode(F.split(rest, r"[^A-Za-z0-9+/_=-]+")).alias("value"))
    return log_ratio(_transitions(random), _transitions(ordinary))


def ratio_of(value: Column, ratios: np.ndarray) -> Column:
    """Log-likelihood ratio of a string of key characters: the sum over its transitions."""
    table = F.array(*(F.lit(float(x)) for x in ratios.ravel()))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        here = F.instr(F.lit(ALPHABET), c) - 1
        return F.struct(here.alias("last"), (acc["sum"] + F.when(acc["last"] >= 0, F.get(table, acc["last"] * len(ALPHABET) + here)).otherwise(0.0)).alias("sum"))

    return F.aggregate(characters(value), start, step, lambda acc: acc["sum"])


def find(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``row, base, spans`` of every row of ``docs``: all its columns in ``row``, and ``array<struct<start, k, end, kind>>``; no shuffle."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("found", base_spans(F.col("text"))).withColumn("runs", match_spans(F.col("text"), CANDIDATE))
    added = F.filter(outside(F.col("runs"), F.col("found")), lambda s: ratio_of(s["value"], ratios) >= float(np.log(PRIOR)))
    plain = lambda a, k=None: F.transform(
        a,
        lambda s: F.struct(
            s["start"].alias("start"), (s["k"] if k is None else F.lit(k)).alias("k"), s["end"].alias("end"),
            (s["kind"] if k is None else F.lit(KINDS[k])).alias("kind"),
        ),
    )
    base = plain(F.col("found"))
    every = F.when(F.size("runs") > 0, F.array_sort(F.concat(base, plain(added, 3)))).otherwise(base)
    return rows.select("row", base.alias("base"), every.alias("spans"))


def redact(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """The rows of ``docs`` with each run of secret spans replaced by ``MASK``; ``n_chars``, where there is one, follows.

    Spans that overlap or touch are one run. Null texts and texts without secrets stay as they are.
    """
    text = F.col("row.text")

    # a span begins a run where it starts beyond the ends of all before it
    ends = running(F.transform("spans", lambda s: s["end"]), lambda a, b: F.greatest(a, b), -1)
    before = F.concat(F.array(F.lit(-1)), F.slice(ends, 1, F.size("spans") - 1))
    gap = lambda s, end: F.struct(F.greatest(end, F.lit(0)).alias("from"), s["start"].alias("to"), (s["start"] > end).alias("new"))
    gaps = F.filter(F.zip_with("spans", before, gap), lambda g: g["new"])
    after = F.array_max(F.transform("spans", lambda s: s["end"]))
    masked = let(
        text_blocks(text),
        lambda blocks: F.concat(
            F.array_join(F.transform(gaps, lambda g: F.concat(text_between(blocks, g["from"], g["to"]), F.lit(MASK))), ""),
            text_between(blocks, after, F.char_length(text)),
        ),
    )
    hit = F.size("spans") > 0
    new = find(docs, ratios).select("row", hit.alias("hit"), F.when(hit, masked).otherwise(text).alias("new"))
    kept = {c: F.col(f"row.`{c}`").alias(c) for c in docs.columns} | {"text": F.col("new").alias("text")}
    if "n_chars" in docs.columns:
        length = F.when(F.col("hit"), F.char_length("new")).otherwise(F.col("row.n_chars"))
        kept["n_chars"] = length.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return new.select(*kept.values())


def query(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans, and all spans with those the Markov models add."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find(docs.select("doc_id", "text"), fit(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "row.doc_id", *(count(k) for k in KINDS[:3]), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
