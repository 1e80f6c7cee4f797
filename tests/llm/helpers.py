"""Rows and brute-force forms shared by the tests of this folder."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, schema=DOC, **columns):
    """Documents with ids 0.. and the given texts; a pair in ``texts`` gives its own id."""
    rows = []
    for i, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (i, t)
        rows.append((i, t, columns.get("lang"), "s", None if t is None else len(t)))
    return spark.createDataFrame(rows, schema)


def clashing(df, *names):
    """With extra columns of names that the operators use themselves."""
    for n in names:
        df = df.selectExpr("*", f"'x' AS `{n}`")
    return df


def vocabulary(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n)]


def sentence(rng, vocab, n):
    return " ".join(rng.choices(vocab, k=n))


ODD_TEXTS = [None, "", "   \n", "x", "é" * 50, "word " * 30_000, "日本語 テキスト", "<|endoftext|> </s>", "a\x00b\\n"]
