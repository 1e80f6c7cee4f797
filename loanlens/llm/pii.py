"""Personal data spans by weak supervision, with built-in SQL functions only.

Candidates of four kinds come from strict patterns (the base, always kept) and from wider ones. Four labelers vote
yes, no or nothing on each candidate: its pattern and checksum, a gazetteer (top-level domains, calling codes,
issuer prefixes, address blocks), the words before it, and its shape. Expectation-maximisation over the counts of vote patterns
estimates each labeler's reliability without labels; the posteriors train a logistic span classifier on votes
and shape, which decides on the wider candidates.

One pass over the texts writes the candidates. What reaches the driver is a table of vote and
feature patterns, at most ``4 kinds x 3^4 votes x 4 lengths x 3 separators`` rows, counted over all documents.

Defined results: null and empty texts have no spans; a wide candidate that overlaps a base span of any kind, or an
earlier wide one, is left out; where there are no candidates nothing is added; repeated rows give repeated rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import materialize
from loanlens.llm.spans import joined, match_spans, no_spans, outside, text_between, text_blocks

KINDS = ["email", "ip", "card", "phone"]
# Base patterns. They match what the plain forms match, but start only where a match can begin and don't
# walk back over what can't help (possessive), so that long runs cost linear time and no stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Wider candidates.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{2,63}\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{2,24}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{15,16})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])",
}
# Gazetteers and cue words of the labelers.
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "ch", "at", "it", "nl", "us", "ca"]
CALLING = r"^(?:\+|00)?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])[^0-9]?"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)"
CUES = {
    "email": r"(?i)(?:mail|contact|write|reply|courriel|correo)",
    "ip": r"(?i)(?:\bip\b|host|server|addr|login|client)",
    "card": r"(?i)(?:card|visa|master|credit|debit|karte|carte|tarjeta|pay)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell|handy|whatsapp)",
}
AGAINST = r"(?i)(?:version|release|isbn|issn|order|invoice|ticket|page|serial|build|doi)"
CONTEXT_CHARS = 40
VOTES = ["v_pattern", "v_gazetteer", "v_context", "v_shape"]
MIN_PROBABILITY = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    n = F.char_length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc
        + F.when(
            (n - i) % 2 == 1,
            F.substring(digits, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, i, F.lit(1)) > "4", F.lit(9)).otherwise(F.lit(0)),
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return (n > 0) & (total % 10 == 0)


def _ip_ok(value: Column) -> Column:
    return F.forall(
        F.split(value, r"\."),
        lambda p: F.regexp_like(p, F.lit(r"^0*[0-9]{1,3}$")) & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255),
    )


def base_spans(text: Column) -> dict[str, Column]:
    """The strict spans of each kind: ``array<struct<start, end, value>>``."""
    none = no_spans()
    digits_in = F.regexp_like(text, F.lit("[0-9]"))
    found = {
        "email": F.when(F.contains(text, F.lit("@")), match_spans(text, EMAIL)).otherwise(none),
        "ip": F.when(digits_in, match_spans(text, IP)).otherwise(none),
        "card": F.when(digits_in, match_spans(text, CARD)).otherwise(none),
        "phone": F.when(F.contains(text, F.lit("+")), match_spans(text, PHONE)).otherwise(none),
    }
    n = lambda s: F.char_length(_digits(s["value"]))
    return {
        "email": found["email"],
        "ip": F.filter(found["ip"], lambda s: _ip_ok(s["value"])),
        "card": F.filter(found["card"], lambda s: (n(s) <= 19) & luhn_ok(_digits(s["value"]))),
        "phone": F.filter(found["phone"], lambda s: n(s).between(9, 15)),
    }


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _votes(kind: str, span: Column, blocks: Column, strict: bool) -> list[Column]:
    value, digits = span["value"], _digits(span["value"])
    if strict:
        pattern = F.lit(1)
    else:
        pattern = F.lit(int(kind == "card"))  # a wide card candidate has passed the Luhn check
    if kind == "email":
        known = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1)).isin(TOP_DOMAINS)
        gazetteer = _vote(known, ~known)
        shape = _vote(F.regexp_like(value, F.lit(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*[A-Za-z0-9]?[@\x20(\[]")), F.lit(True))
    elif kind == "ip":
        head = F.regexp_extract(value, r"^0*([0-9]{1,3})\.", 1)
        gazetteer = _vote(head.try_cast("int").between(1, 223), head.try_cast("int").isNotNull())
        shape = _vote(F.regexp_like(value, F.lit(r"^(?:(?:0|[1-9][0-9]*)(?:\.|$))+|:")), F.lit(True))
    elif kind == "card":
        gazetteer = _vote(F.regexp_like(digits, F.lit(ISSUERS)), F.lit(True))
        shape = _vote(F.char_length(digits).isin(15, 16) & ~F.regexp_like(digits, F.lit(r"^(.)\1+$")), F.regexp_like(digits, F.lit(r"(.)\1{7}")))
    else:
        gazetteer = _vote(F.regexp_like(value, F.lit(CALLING)) & F.startswith(value, F.lit("+")), F.startswith(value, F.lit("+")))
        shape = _vote(
            F.regexp_like(value, F.lit(r"[\x20().-]")) & F.char_length(digits).between(10, 13), F.regexp_like(digits, F.lit(r"(.)\1{6}"))
        )
    before = text_between(blocks, F.greatest(F.lit(0), span["start"] - CONTEXT_CHARS), span["start"])
    context = _vote(F.regexp_like(before, F.lit(CUES[kind])), F.regexp_like(before, F.lit(AGAINST)))
    return [c.cast("int").alias(v) for c, v in zip((pattern, gazetteer, context, shape), VOTES, strict=True)]


def _features(span: Column) -> list[Column]:
    n = span["end"] - span["start"]
    value = span["value"]
    separators = F.size(F.array_distinct(F.regexp_extract_all(value, F.lit(r"[\x20().:-]"), F.lit(0))))
    return [
        F.when(n < 12, 0).when(n < 16, 1).when(n < 20, 2).otherwise(3).alias("f_length"),
        F.least(separators, F.lit(2)).alias("f_separators"),
    ]


def _struct(kind: str, span: Column, blocks: Column, strict: bool) -> Column:
    return F.struct(
        F.lit(KINDS.index(kind)).alias("k"), F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
        F.lit(strict).alias("base"), *_votes(kind, span, blocks, strict), *_features(span),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, base, wide``: voted spans of every row of ``docs(doc_id, text)``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base_spans(F.col("text"))
    rows = rows.withColumns({f"b_{k}": base[k] for k in KINDS})
    every = F.concat(*(F.col(f"b_{k}") for k in KINDS))
    none = no_spans()
    wide = {}
    for k in KINDS:
        if k == "email":
            there = F.contains("text", F.lit("(at)")) | F.contains("text", F.lit("[at]"))
        elif k == "ip":
            there = F.contains("text", F.lit(":"))
        else:
            there = F.regexp_like("text", F.lit(r"[0-9]{4}[\x20-][0-9]{4}|[0-9]{15}|[0-9]{3}[-.)]"))
        wide[f"w_{k}"] = F.when(there, match_spans(F.col("text"), WIDE[k])).otherwise(none)
    rows = rows.withColumns(wide)
    spans = [F.size(F.col(f"{x}_{k}")) for x in "bw" for k in KINDS]
    rows = rows.withColumn("blocks", F.when(F.greatest(*spans) > 0, text_blocks(F.col("text"))))
    voted = lambda k, strict: lambda s: _struct(k, s, F.col("blocks"), strict)
    strict = [F.transform(f"b_{k}", voted(k, True)) for k in KINDS]
    may_be = lambda k: lambda s: luhn_ok(_digits(s["value"])) if k == "card" else F.lit(True)
    loose = [F.transform(F.filter(outside(F.col(f"w_{k}"), every), may_be(k)), voted(k, False)) for k in KINDS]
    return rows.select("doc_id", F.concat(*strict).alias("base"), F.concat(*loose).alias("wide"))


def estimate_reliabilities(kinds: np.ndarray, votes: np.ndarray, count: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior that each vote pattern is a true span: expectation-maximisation with a table of vote
    probabilities for each kind, labeler and class (0 abstains), started from the majority vote."""
    total = votes.sum(axis=1)
    p = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
    for _ in range(rounds):
        log_odds = np.zeros(len(count))
        for k in np.unique(kinds):
            at = kinds == k
            yes, no = count[at] * p[at], count[at] * (1 - p[at])
            log_odds[at] += np.log((yes.sum() + 1) / (no.sum() + 1))
            for j in range(votes.shape[1]):
                for v in (-1, 0, 1):
                    here = votes[at, j] == v
                    # a prior of one vote in the labeler's favour keeps the classes from changing places
                    a = (yes[here].sum() + 1 + (v == 1)) / (yes.sum() + 4)
                    b = (no[here].sum() + 1 + (v == -1)) / (no.sum() + 4)
                    rows = np.flatnonzero(at)[here]
                    log_odds[rows] += np.log(a / b)
        p = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return p


def design(kinds: np.ndarray, votes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """One column for each kind, vote (by value) and feature value."""
    cols = [kinds == k for k in range(len(KINDS))]
    cols += [votes[:, j] == v for j in range(len(VOTES)) for v in (-1, 1)]
    cols += [features[:, 0] == v for v in range(4)] + [features[:, 1] == v for v in range(3)]
    return np.stack(cols, axis=1).astype(float)


def train_classifier(x: np.ndarray, p: np.ndarray, count: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression on soft labels by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (count * (q - p)) + ridge * w
        hessian = (x * (count * q * (1 - q))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w - np.linalg.solve(hessian, gradient)
    return w


def fit(found: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier from all candidates; None where there are none."""
    names = ["k", *VOTES, "f_length", "f_separators"]
    patterns = (
        found.select(F.explode(F.concat("base", "wide")).alias("s"))
        .groupBy(*(F.col(f"s.{c}").alias(c) for c in names))
        .count()
        .orderBy(*names)
        .collect()
    )
    if not patterns:
        return None
    table = np.array([[r[c] for c in names] for r in patterns])
    count = np.array([r["count"] for r in patterns], dtype=float)
    kinds, votes, features = table[:, 0], table[:, 1:5], table[:, 5:]
    p = estimate_reliabilities(kinds, votes, count)
    return train_classifier(design(kinds, votes, features), p, count)


def _score(span: Column, w: np.ndarray) -> Column:
    """The classifier's log odds as a column expression; the order of weights is that of ``design``."""
    tests = [span["k"] == k for k in range(len(KINDS))]
    tests += [span[v] == x for v in VOTES for x in (-1, 1)]
    tests += [span["f_length"] == v for v in range(4)] + [span["f_separators"] == v for v in range(3)]
    total = F.lit(0.0)
    for test, weight in zip(tests, w.tolist(), strict=True):
        total = total + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
    return total


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: arrays of ``struct<k, kind, start, end>`` sorted by kind and start."""
    found = materialize(candidates(docs))
    weights = fit(found)
    plain = lambda a: F.array_sort(
        F.transform(a, lambda s: F.struct(s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    kept = F.col("wide")
    if weights is not None:
        odds = float(np.log(MIN_PROBABILITY / (1 - MIN_PROBABILITY)))
        kept = F.filter("wide", lambda s: _score(s, weights) >= odds)
    # of two wide spans that overlap, the one of the earlier kind stays
    of = lambda a, test: F.filter(a, lambda s: test(s["k"]))
    first = F.concat(*(outside(of(F.col("_kept"), lambda k, i=i: k == i), of(F.col("_kept"), lambda k, i=i: k < i)) for i in range(len(KINDS))))
    rows = found.select("doc_id", "base", kept.alias("_kept"))
    return rows.select("doc_id", plain(F.col("base")).alias("base"), plain(F.concat("base", first)).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans, and all spans with those that the classifier adds."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *(count(k) for k in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
