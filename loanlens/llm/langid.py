"""Language identification of mixed-language text.

Every word gets a log score for each language: character trigrams and the whole word, hashed into a
bounded table of smoothed log probabilities. The script of the word (code point ranges) narrows the
languages that may claim it. A Viterbi pass over the words of a text, with a penalty for each change of
language, labels spans; the language with the most letters is the text's.

Fitting: two Spark aggregations over a bounded labelled sample. The tables that reach the driver hold
``BUCKETS`` rows a language and one row for each script and language.

Defined results: a null text or one without letters is ``und`` with score 0 and no spans; without
labelled rows every text is ``und``; letters of a script that no learned language uses leave all
languages possible; equal totals go to the first language in alphabetical order; repeated rows and null ids
each give their own row.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import blocks, bounded_sample, id_remainder, texts

UNKNOWN = "und"
BUCKETS = 1 << 15
# Labelled documents a language that the tables are fitted on (a documented bound; prediction covers all rows).
TRAIN_DOCS_PER_LANGUAGE = 2_000
SWITCH_PENALTY = 6.0
FLOOR, NOT_A_CANDIDATE = -6.0, -12.0
# A language is a candidate for a script that at least this share of its letters uses.
SCRIPT_SHARE = 0.01

# First code point and name of Unicode script ranges, in order.
SCRIPT_RANGES = [
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "southeast_asian"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2C00, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD800, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_STARTS = [start for start, _ in SCRIPT_RANGES]
_WORD = re.compile(r"[^\W\d_]+")  # letters, and signs such as superscripts that ``letter_runs`` takes out again
_SCRIPT_OF_RANGE = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])
MAX_CACHED_WORDS = 300_000
WORDS_AT_A_TIME = 20_000


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # BUCKETS x languages
    allowed: np.ndarray  # scripts x languages


def script_of(code_point: int) -> int:
    return SCRIPTS.index(SCRIPT_RANGES[bisect_right(_STARTS, code_point) - 1][1])


def _script_column(word: Column) -> Column:
    code = F.ascii(word)
    out = F.lit(SCRIPT_RANGES[0][1])
    for start, name in SCRIPT_RANGES[1:]:
        out = F.when(code >= start, F.lit(name)).otherwise(out)
    return out


def fit(labelled: DataFrame, per_language: int = TRAIN_DOCS_PER_LANGUAGE) -> LanguageModel:
    """Fit on ``labelled(text, lang)``, at most about ``per_language`` texts of each language."""
    rows = bounded_sample(
        labelled.where("text is not null and lang is not null"), per_language, "lang", key=[c for c in ("doc_id", "text") if c in labelled.columns]
    )
    counted = (
        rows.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w"))
        .where("w != ''")
        .groupBy("lang", "w")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    padded = F.concat(F.lit("^"), F.col("w"), F.lit("$"))
    grams = F.concat(
        F.transform(F.sequence(F.lit(1), F.char_length("w")), lambda i: F.substring(padded, i, F.lit(3))),
        F.array(F.concat(F.lit("="), F.col("w"))),
    )
    table = (
        counted.select("lang", "n", F.explode(grams).alias("g"))
        .groupBy("lang", (F.crc32(F.col("g").cast("binary")) % BUCKETS).cast("int").alias("b"))
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    scripts = (
        counted.groupBy("lang", _script_column(F.col("w")).alias("s"))
        .agg(F.sum(F.col("n") * F.char_length("w")).alias("n"))
        .toPandas()
    )
    languages = sorted(set(table["lang"]))
    at = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((BUCKETS, len(languages)))
    counts[table["b"].to_numpy(dtype=int), table["lang"].map(at).to_numpy(dtype=int)] = table["n"].to_numpy(dtype=float)
    share = np.zeros((len(SCRIPTS), len(languages)))
    for row in scripts.itertuples():
        share[SCRIPTS.index(row.s), at[row.lang]] = row.n
    share /= np.maximum(share.sum(axis=0), 1)
    smooth = 0.5
    return LanguageModel(languages, np.log((counts + smooth) / (counts.sum(axis=0) + smooth * BUCKETS)), share >= SCRIPT_SHARE)


def place(gram: str) -> int:
    """The gram's row of the tables."""
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS


class Places(dict):
    """gram -> its row of the tables, kept."""

    def __missing__(self, gram: str) -> int:
        self[gram] = at = place(gram)
        return at


class WordScores(dict):
    """word -> row of ``rows``; cleared when it grows past its bound. New words are scored many at a time."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model, self.rows, self.places = model, np.zeros((0, len(model.languages))), Places()

    def learn(self, words: list[str]) -> None:
        """Score the words of ``words`` that are not known yet."""
        new = [w for w in dict.fromkeys(words) if w not in self]
        scores = [self.rows]
        for i in range(0, len(new), WORDS_AT_A_TIME):
            some = new[i : i + WORDS_AT_A_TIME]
            at: list[int] = []
            first = []
            for w in some:
                padded = f"^{w}$"
                first.append(len(at))
                at += [self.places[padded[j : j + 3]] for j in range(len(w))]
                at.append(place("=" + w))
            scores.append(self._scored(some, np.add.reduceat(self.model.log_prob[at], first, axis=0)))
        if new:
            self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
            self.rows = np.concatenate(scores)

    def _scored(self, words: list[str], score: np.ndarray) -> np.ndarray:
        """Log shares of the summed ``score`` of ``words``, within the languages that their scripts allow."""
        score = np.maximum(score - np.logaddexp.reduce(score, axis=1, keepdims=True), FLOOR)
        code = np.fromiter((ord(w[0]) for w in words), dtype=np.int64, count=len(words))
        allowed = self.model.allowed[_SCRIPT_OF_RANGE[np.searchsorted(_STARTS, code, side="right") - 1]]
        return np.where(allowed.any(axis=1, keepdims=True), np.where(allowed, score, NOT_A_CANDIDATE), 0.0)

    def trim(self) -> None:
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
            self.rows = self.rows[:0]
        if len(self.places) > MAX_CACHED_WORDS:
            self.places.clear()


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each row of ``scores``; sequence d is ``starts[d]:starts[d + 1]``.

    All sequences advance together, the longest first, so a step works on arrays of the sequences that
    have a word there. Work and memory are in proportion to words times languages.
    """
    n, k = scores.shape
    length = np.diff(starts)
    order = np.argsort(-length, kind="stable")
    first, length = starts[:-1][order], length[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # sequences longer than t
    back = np.empty((n, k), dtype=np.int16)
    label = np.zeros(n, dtype=np.int16)
    own = np.arange(k, dtype=np.int16)
    best = np.empty((len(length), k))
    for t in range(longest):
        a = active[t]
        rows = first[:a] + t
        if t == 0:
            best[:a] = scores[rows]
            continue
        v = best[:a]
        top = v.argmax(axis=1)
        change = v[np.arange(a), top] - penalty
        stay = v >= change[:, None]
        back[rows] = np.where(stay, own, top[:, None])
        best[:a] = np.where(stay, v, change[:, None]) + scores[rows]
    now = best.argmax(axis=1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        later = active[t + 1] if t + 1 < longest else 0
        rows = first[:a] + t
        if later:
            now[:later] = back[rows[:later] + 1, now[:later]]
        label[rows] = now[:a]
    return label


def letter_runs(text: str) -> list[str]:
    """Runs of letters, as ``fit`` splits them (``[^\\p{L}]+``)."""
    found = _WORD.findall(text)
    if "".join(found).isalpha():
        return found
    return [w for x in found for w in ([x] if x.isalpha() else "".join(c if c.isalpha() else " " for c in x).split())]


def label_batch(batch: pa.RecordBatch, cache: WordScores) -> list[tuple[str, float, list]]:
    """(language, score, [(first word, last word, language)]) of each text."""
    found = [letter_runs(t.lower()) for t in texts(batch)]
    if not cache.model.languages:
        return [(UNKNOWN, 0.0, []) for _ in found]
    cache.trim()
    flat = [w for ws in found for w in ws]
    cache.learn(flat)
    ids = np.fromiter(map(cache.__getitem__, flat), dtype=np.int64, count=len(flat))
    letters = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
    starts = np.concatenate([[0], np.cumsum([len(ws) for ws in found])]).astype(np.int64)
    k = len(cache.model.languages)
    labels = viterbi(cache.rows[ids], starts)
    doc = np.repeat(np.arange(len(found)), np.diff(starts))
    weight = np.bincount(doc * k + labels, weights=letters, minlength=len(found) * k).reshape(len(found), k)
    total = weight.sum(axis=1)
    change = np.flatnonzero(np.diff(labels) | np.diff(doc)) + 1
    begin = np.concatenate([[0], change]) if len(flat) else np.zeros(0, dtype=int)
    end = np.append(change, len(flat))
    spans: list[list] = [[] for _ in found]
    for a, b in zip(begin.tolist(), end.tolist(), strict=False):
        d = int(doc[a])
        spans[d].append((a - int(starts[d]), b - 1 - int(starts[d]), cache.model.languages[labels[a]]))
    out = []
    for d in range(len(found)):
        if total[d] == 0:
            out.append((UNKNOWN, 0.0, []))
        else:
            top = int(weight[d].argmax())
            out.append((cache.model.languages[top], float(weight[d, top] / total[d]), spans[d]))
    return out


SPAN = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("lang", pa.string())]))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every row of ``docs(doc_id, text)``; no shuffle.

    ``spans`` counts words (runs of letters) from 0; ``score`` is the share of letters in the predicted language.
    """
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prob, model.allowed))  # BUCKETS x languages floats

    def run(batches):
        cache = WordScores(LanguageModel(*shared.value))
        for batch in blocks(batches, limit=6 << 20):  # more texts advance together
            lang, score, spans = zip(*label_batch(batch, cache), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array([[dict(zip(("first_word", "last_word", "lang"), s, strict=True)) for s in x] for x in spans], SPAN)],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    schema = f"doc_id {id_type.simpleString()}, lang_pred string, score double, spans array<struct<first_word:bigint,last_word:bigint,lang:string>>"
    return rows.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out third."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = id_remainder("doc_id", 3) == 1
    model = fit(docs.where(~held_out))
    return identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans")
    )
