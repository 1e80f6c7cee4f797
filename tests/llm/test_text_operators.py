"""Language identification, BPE codec, quality classifier and language model."""

import collections
import functools
import hashlib
import math
import random
import unicodedata
import zlib

import numpy as np
import pytest
from helpers import DOC, ODD_TEXTS, clashing, docs_frame, sentence, vocabulary
from pyspark.sql import functions as F

from loanlens import session
from loanlens.llm import bloom_lm, bpe, common, langid, mil_quality


# ---- word hashes -----------------------------------------------------------


def test_word_hashes_tell_words_apart_and_fold_ascii_case():
    rng = random.Random(3)
    docs = ["".join(rng.choices("abAB \t\n\x0bé日x.", k=rng.randint(0, 90))).encode() for _ in range(400)] + [b"", b" ", b"one", b"x" * 900 + b" y"]
    expected = [common.words(d.decode()) for d in docs]
    for limit in (1 << 20, 200, 30):  # pieces of a document or many documents at once
        h, n = common.word_hashes(docs, limit)
        assert n.tolist() == [len(e) for e in expected]
        names = {}
        for w, x in zip([w for e in expected for w in e], h.tolist(), strict=True):
            assert names.setdefault(w, x) == x
        assert len(set(names.values())) == len(names)


# ---- language identification -----------------------------------------------


@pytest.fixture(scope="module")
def language_model(spark):
    rng = random.Random(5)
    en, de = vocabulary(300, 1), ["".join(rng.choices("klmnopqrst", k=5)) for _ in range(300)]
    ru = ["".join(rng.choices("абвгдежз", k=5)) for _ in range(300)]
    rows = [(sentence(rng, v, 60), lang) for lang, v in (("en", en), ("de", de), ("ru", ru)) for _ in range(30)]
    return langid.fit(spark.createDataFrame(rows, "text string, lang string")), en, de, ru


def test_words_scored_many_at_a_time_equal_single_ones(language_model, monkeypatch):
    model, en, de, ru = language_model
    monkeypatch.setattr(langid, "WORDS_AT_A_TIME", 7)
    cache = langid.WordScores(model)
    for words in (en[:40] + ru[:40], en[20:60] + de[:3] + ["λόγος", "日本"]):
        cache.learn(words + words[:5])
        for w in words:
            grams = [f"^{w}$"[i : i + 3] for i in range(len(w))] + ["=" + w]
            score = model.log_prob[[zlib.crc32(g.encode()) % langid.BUCKETS for g in grams]].sum(axis=0)
            score = np.maximum(score - np.logaddexp.reduce(score), langid.FLOOR)
            allowed = model.allowed[langid.script_of(ord(w[0]))]
            expected = np.where(allowed, score, langid.NOT_A_CANDIDATE) if allowed.any() else np.zeros(3)
            assert cache.rows[cache[w]] == pytest.approx(expected, abs=1e-12)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(40):
        sizes = rng.integers(0, 6, size=4)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(0, 3, (int(starts[-1]), 3))
        got = langid.viterbi(scores, starts, 2.0)
        for a, b in zip(starts, starts[1:], strict=False):
            def value(path, a=a):
                return sum(scores[a + i, s] for i, s in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:], strict=False))

            paths = [[]]
            for _ in range(b - a):
                paths = [[*p, s] for p in paths for s in range(3)]
            assert value(got[a:b].tolist()) == pytest.approx(max(map(value, paths)))


def test_languages_and_spans_of_mixed_text(spark, language_model):
    model, en, de, ru = language_model
    rng = random.Random(6)
    mixed = sentence(rng, en, 20) + ". " + sentence(rng, de, 40)
    out = langid.identify(docs_frame(spark, [sentence(rng, en, 30), sentence(rng, ru, 30), mixed, "12 34 !!", None, ""]), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in out] == ["en", "ru", "de", "und", "und", "und"]
    assert [(s.first_word, s.last_word, s.lang) for s in out[2].spans] == [(0, 19, "en"), (20, 59, "de")]
    assert out[3].score == 0 and out[3].spans == []
    assert 0.5 < out[2].score < 1


def test_language_id_odd_inputs(spark, language_model):
    model = language_model[0]
    docs = clashing(docs_frame(spark, [*ODD_TEXTS, (0, "again"), (None, "no id")]), "score", "spans", "lang_pred")
    out = langid.identify(docs, model)
    assert out.count() == len(ODD_TEXTS) + 2
    assert out.where("score < 0 or score > 1 or lang_pred is null").count() == 0
    assert langid.identify(spark.createDataFrame([], DOC), model).count() == 0
    nothing = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in langid.identify(docs_frame(spark, ["abc", None]), nothing).collect()} == {"und"}


def plain_words(text):
    """Runs of letters, by the Unicode categories."""
    return "".join(c if unicodedata.category(c).startswith("L") else " " for c in (text or "").lower()).split()


def test_letters_beside_other_signs_are_words(spark, language_model):
    model, en, _, _ = language_model
    rng = random.Random(9)
    marked = " ".join(w + "²₃½"[i % 3] for i, w in enumerate(sentence(rng, en, 30).split()))
    out = langid.identify(docs_frame(spark, [marked, "² ₃ ½ Ⅷ"]), model).orderBy("doc_id").collect()
    assert out[0].lang_pred == "en" and out[0].score > 0.9 and out[1].lang_pred == "und"
    for t in (marked, "m² x₂ ½kg a_b c1d e\u0301f Ⅷa", "plain words", "漢字かな カナ"):
        assert langid.letter_runs(t.lower()) == plain_words(t)


def test_language_query_equals_brute_force(spark, sf_small):
    """The query against a plain statement: counts by words, scripts by name, one dynamic programme a text."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    words = collections.defaultdict(collections.Counter)
    for d in docs:
        if d.lang is not None and d.text is not None and not held(d.doc_id):
            words[d.lang].update(plain_words(d.text))
    langs = sorted(words)
    grams = lambda w: [("^" + w + "$")[i : i + 3] for i in range(len(w))] + ["=" + w]
    place = lambda g: zlib.crc32(g.encode()) % langid.BUCKETS
    script = lambda w: langid.SCRIPTS[langid.script_of(ord(w[0]))]
    gram_n = {k: collections.Counter() for k in langs}
    script_n = {k: collections.Counter() for k in langs}
    for k in langs:
        for w, n in words[k].items():
            script_n[k][script(w)] += n * len(w)
            for g in grams(w):
                gram_n[k][place(g)] += n
    total = {k: sum(gram_n[k].values()) for k in langs}
    letters = {k: sum(script_n[k].values()) for k in langs}

    @functools.cache
    def scores(w):
        raw = [sum(math.log((gram_n[k][place(g)] + 0.5) / (total[k] + 0.5 * langid.BUCKETS)) for g in grams(w)) for k in langs]
        norm = max(raw) + math.log(sum(math.exp(x - max(raw)) for x in raw))
        able = [script_n[k][script(w)] / letters[k] >= langid.SCRIPT_SHARE for k in langs]
        if not any(able):
            return [0.0] * len(langs)
        return [max(x - norm, langid.FLOOR) if ok else langid.NOT_A_CANDIDATE for x, ok in zip(raw, able, strict=True)]

    out = {r.doc_id: r for r in langid.query(spark, sf_small).collect()}
    assert len(out) == len(docs)
    for d in docs:
        ws = plain_words(d.text)
        r = out[d.doc_id]
        assert r.held_out == held(d.doc_id)
        if not ws:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        best, back = scores(ws[0]), []
        for w in ws[1:]:
            top = max(range(len(langs)), key=best.__getitem__)
            step = [k if best[k] >= best[top] - langid.SWITCH_PENALTY else top for k in range(len(langs))]
            best = [max(best[k], best[top] - langid.SWITCH_PENALTY) + s for k, s in enumerate(scores(w))]
            back.append(step)
        k = max(range(len(langs)), key=best.__getitem__)
        path = [k]
        for step in reversed(back):
            path.append(k := step[k])
        weight = collections.Counter()
        for w, k in zip(ws, reversed(path), strict=True):
            weight[langs[k]] += len(w)
        share = weight[r.lang_pred] / sum(weight.values())
        assert weight[r.lang_pred] == max(weight.values()) and r.score == pytest.approx(share), d.doc_id


def test_held_out_languages(spark, sf_small):
    out = langid.query(spark, sf_small).alias("o").join(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, every = out.where("lang_pred = lang").count(), out.where("lang is not null").count()
    assert every > 30 and right / every > 0.95


# ---- BPE codec --------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def test_codec_equals_the_library(reference_tokenizer):
    rng = random.Random(1)
    pieces = ["a", "b", " ", "  ", "\n", "é", "日", "'s", "1", "<|endoftext|>", "!", " ", "\U0001f600", "word", "\t", "'LL"]
    texts = ["".join(rng.choices(pieces, weights=[5, 5, 8, 2, 1, 2, 1, 1, 2, 0.05, 1, 1, 1, 5, 1, 1], k=rng.randint(0, 4000))) for _ in range(120)]
    texts += [t for t in ODD_TEXTS if t is not None] + ["日本語" * 3000, "a" * 9000, " " * 20_000 + "x", "it's we'll I'd " * 900]
    codec = bpe.ChunkCodec(bpe.default_vocabulary())
    for t in texts:
        ids = codec.encode(t)
        expected = reference_tokenizer.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == expected
        assert codec.decode(ids) == reference_tokenizer.decode(expected, skip_special_tokens=False) == t


def test_shared_passages_are_encoded_once():
    rng = random.Random(2)
    vocab = vocabulary(500)
    passage = sentence(rng, vocab, 6000)
    codec = bpe.ChunkCodec(bpe.default_vocabulary())
    codec.encode("First. " + passage)
    before = codec.encoded
    codec.encode("Quite another beginning here. " + passage + " And an end.")
    assert codec.encoded - before < 0.15 * len(passage)


def test_chunk_starts_depend_on_content_alone():
    rng = random.Random(3)
    data = sentence(rng, vocabulary(400), 5000).encode()
    cut = lambda b: set(bpe.cut_points(np.frombuffer(b, dtype=np.uint8)))
    whole, moved = cut(data), {c - 13 for c in cut(b"Thirteen byte" + data)}
    assert len(whole) > 10 and len(whole & moved) > 0.8 * len(whole)


def test_encode_and_decode_frames(spark, reference_tokenizer):
    docs = clashing(docs_frame(spark, [*ODD_TEXTS, (0, "twice"), (None, "no id")]), "ids", "n_tokens")
    ids = bpe.encode_documents(docs, bpe.default_vocabulary())
    back = bpe.decode_documents(ids, bpe.default_vocabulary())
    assert sorted(r.text for r in back.collect()) == sorted([t or "" for t in ODD_TEXTS] + ["twice", "no id"])
    out = bpe.round_trip_digests(docs, bpe.default_vocabulary()).where("doc_id = 3").first()
    assert out.ids_sha256 == hashlib.sha256(np.array(reference_tokenizer.encode("x").ids, "<u4").tobytes()).hexdigest()
    assert out.decoded_sha256 == hashlib.sha256(b"x").hexdigest() and out.n_tokens == 1
    assert bpe.round_trip_digests(spark.createDataFrame([], DOC), bpe.default_vocabulary()).count() == 0


def test_codec_on_documents(spark, sf_small, reference_tokenizer):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    out = bpe.query(spark, sf_small).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = reference_tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


# ---- quality classifier -----------------------------------------------------


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(4)
    d, h, a = 6, 4, 3
    w = {"E": rng.normal(size=(d, h)), "e": rng.normal(size=h), "V": rng.normal(size=(h, a)), "U": rng.normal(size=(h, a)), "a": rng.normal(size=a),
         "o": rng.normal(size=h), "b": rng.normal(size=1)}
    count = np.array([3, 1, 4])
    x, y, weight = rng.normal(size=(8, d)), np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss(w):
        p = mil_quality._forward(w, x, count)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    got = mil_quality._gradients(w, x, count, y, weight)
    for k in w:
        for at in np.ndindex(w[k].shape):
            up, down = ({n: v.copy() for n, v in w.items()} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            assert got[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)


def test_attention_weights_sum_to_one_and_find_the_bad_passage():
    rng = np.random.default_rng(5)
    good = lambda: rng.normal(0, 1, (6, mil_quality.DIM)).astype(np.float32)
    bags, y = [], []
    for i in range(200):
        b = good()
        if i % 2:
            b[rng.integers(6), :5] += 6
        bags.append(b)
        y.append(i % 2)
    model = mil_quality.train(bags, np.array(y, dtype=float))
    probe = good()
    probe[2, :5] += 6
    f = mil_quality._forward(model.weights, (probe - model.mean) / model.scale, np.array([6]))
    assert f["a"].sum() == pytest.approx(1) and f["a"].argmax() == 2 and f["p"][0] > 0.9
    fresh = np.concatenate([good() for _ in range(50)])
    spoiled = np.concatenate([good() for _ in range(50)])
    spoiled[3::6, :5] += 6
    size = np.full(50, 6)
    assert (model.score(fresh, size) < 0.5).mean() >= 0.9 and (model.score(spoiled, size) >= 0.5).mean() >= 0.9


def test_quality_odd_inputs(spark):
    docs = clashing(docs_frame(spark, [*ODD_TEXTS, (0, "twice"), (None, "no id")]), "score", "quality")
    none = mil_quality.fit(spark.createDataFrame([], "text string, quality int"))
    one = mil_quality.fit(spark.createDataFrame([("a b", 1)], "text string, quality int"))
    assert {r.score for r in mil_quality.score(docs, none).collect()} == {0.5}
    assert {r.score for r in mil_quality.score(docs, one).collect()} == {1.0}
    rows = [("plain words in a line. " * 20, 1), ("### $$$ !!! ||| " * 30, 0), ("", 1), (None, 0)] * 20
    model = mil_quality.fit(spark.createDataFrame(rows, "text string, quality int"))
    out = mil_quality.score(docs, model)
    assert out.count() == len(ODD_TEXTS) + 2 and out.where("score is null or isnan(score) or score < 0 or score > 1").count() == 0
    kept = mil_quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert mil_quality.keep_good(spark.createDataFrame([], DOC), model).count() == 0


def test_fit_sees_every_passage_of_a_long_document(spark):
    """Long documents that differ from good ones by one passage, at any place: seen in fitting, found in scoring."""
    rng = random.Random(31)
    vocab = vocabulary(300)

    def text(bad):
        parts = [sentence(rng, vocab, 400) for _ in range(12)]  # some 60 passages
        if bad:
            at = rng.randrange(12)
            parts[at] = parts[at][: len(parts[at]) // 2] + " " + "### $$$ !!! ||| " * 48 + parts[at][len(parts[at]) // 2 :]
        return "\n".join(parts)

    rows = [(i, text(i % 2), 1 - i % 2) for i in range(160)]
    train = spark.createDataFrame(rows[:120], "doc_id long, text string, quality int")
    sample = mil_quality.training_sample(train)
    assert sample.count() == 120
    model = mil_quality.fit(train)
    assert len(mil_quality.passages([rows[1][1].encode()])[0]) > 40
    out = mil_quality.score(spark.createDataFrame([r[:2] for r in rows[120:]], "doc_id long, text string"), model).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in out) >= 36


def test_labelled_sample_is_drawn_before_texts_move(spark):
    """The same rows as from the joined texts, and no shuffle carries the text of a row that is not drawn."""
    rows = [(i % 300, f"text {i % 290} " * 60) for i in range(400)] + [(None, "x"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(280)] + [(3, 0), (5, None), (None, 1)], "doc_id long, quality int")
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    for bound in (20, 4000):
        got = mil_quality.labelled_sample(docs, labels, bound)
        expected = mil_quality.training_sample(docs.join(one, "doc_id"), bound)
        rows_of = lambda df: sorted(map(tuple, df.select("doc_id", "text", "quality").collect()), key=repr)
        assert rows_of(got) == rows_of(expected) and got.count() > 10
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) >= 1 and all("BroadcastHashJoin" in x for x in joins)


def test_training_sample_keeps_its_bounds(spark):
    rows = [(i, "one hot text" if i % 3 == 0 else f"text {i} " + "x " * 300, i % 2) for i in range(6000)]
    frame = spark.createDataFrame([*rows, *rows[:2000]], "doc_id long, text string, quality int")
    got = mil_quality.training_sample(frame, 300).collect()
    hot = sum(r.text == "one hot text" for r in got)
    assert 400 < len(got) < 660 and 0.2 * len(got) < hot < 0.5 * len(got) and len(set(got)) == len(got)
    few = mil_quality.training_sample(frame, 3000, 500).collect()  # by passages: 2 each, 1 for the hot text
    assert sum(1 if r.text == "one hot text" else 2 for r in few) < 1150
    long = spark.createDataFrame([(1, "y" * 600_000, 0), (2, "z", 0)], "doc_id long, text string, quality int")
    assert [r.doc_id for r in mil_quality.training_sample(long, 10, 5000).collect()] == [2]


def test_passages_cover_whole_texts():
    x, count = mil_quality.passages([b"", b"a" * 5, b"b" * 5000])
    assert count.tolist() == [1, 1, 10] and x.shape == (12, mil_quality.DIM) and np.isfinite(x).all()
    both, _ = mil_quality.passages([b"x y z " * 400])
    alone, _ = mil_quality.passages([b"other", b"x y z " * 400])
    assert np.allclose(both[1:-1], alone[2:-1], atol=0.05)


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    out = mil_quality.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right, every = out.where("predicted = quality").count(), out.count()
    assert every > 50 and right / every > 0.9


# ---- language model ---------------------------------------------------------


def brute_scores(texts, train):
    split = [common.words(t or "") + [b""] for t in texts]
    counts = collections.Counter(w for x, use in zip(split, train, strict=True) if use for w in x)
    n, v = sum(counts.values()), len(counts)
    return n, [(len(x), sum(counts[w] > 0 for w in x), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x)) for x in split]


@pytest.mark.parametrize("head_words", [0, 7, 10_000])
def test_base_score_is_exact(spark, head_words):
    rng = random.Random(7)
    vocab = vocabulary(200)
    texts = [sentence(rng, vocab, rng.randint(0, 80)) for _ in range(60)] + [None, "", "UPPER upper Upper", "unseenword", "  "]
    train = [i % 3 != 0 for i in range(len(texts))]
    docs = docs_frame(spark, texts)
    out = bloom_lm.score(docs, docs.where("doc_id % 3 <> 0"), bits=1 << 16, head_words=head_words).orderBy("doc_id").collect()
    n, expected = brute_scores(texts, train)
    for r, (tokens, known, base) in zip(out, expected, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert r.base_score == pytest.approx(base, abs=1e-9)
        assert r.score < 0


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    rng = random.Random(8)
    vocab = vocabulary(3000)
    docs = docs_frame(spark, [sentence(rng, vocab, 100) for _ in range(100)])
    counts = bloom_lm.word_counts(docs)
    segments = bloom_lm.segment_count(10_000)
    f = bloom_lm.build_filter(bloom_lm.ngram_levels(docs, counts, segments), segments, 1 << 18)
    h, _ = bloom_lm.tokens([t.text.encode() for t in docs.collect()])
    word, n = np.unique(h, return_counts=True)
    found = f.level(bloom_lm.unigram_hash(word))
    true = bloom_lm.levels(n)
    assert f.lowest == 1 and (found >= true).all() and (found == true).mean() > 0.9
    absent = np.random.default_rng(9).integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2)
    assert (f.level(absent) > 0).mean() < 0.05


def test_filter_keeps_the_frequent_when_it_is_small():
    histogram = np.zeros(bloom_lm.MAX_LEVEL + 1, dtype=np.int64)
    histogram[1:4] = [1000, 100, 10]
    assert [bloom_lm.lowest_level(histogram, c) for c in (1230, 1229, 120, 119, 9)] == [1, 2, 2, 3, 4]


def test_filter_holds_every_ngram_at_any_size(spark):
    rng = random.Random(11)
    vocab = vocabulary(3000)
    texts = [sentence(rng, vocab, rng.randint(0, 200)) for _ in range(80)] + [None, "", "unseenword", "again", "again"]
    docs = docs_frame(spark, [*texts, (0, "twice"), (None, "no id")]).repartition(3)
    train = docs.where("doc_id % 3 <> 0")
    segments = bloom_lm.segment_count(10_000)
    ngrams = bloom_lm.ngram_levels(train, bloom_lm.word_counts(train), segments)
    assert bloom_lm.build_filter(ngrams, segments, 1 << 12) is None  # too small for the broadcast: no lower levels are cut off
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.score)
    large, small = (sorted(bloom_lm.score(docs, train, bits=b).collect(), key=key) for b in (1 << 28, 1 << 12))
    assert len(small) == len(texts) + 2
    for a, b in zip(large, small, strict=True):
        assert (a.doc_id, a.n_tokens, a.n_known) == (b.doc_id, b.n_tokens, b.n_known)
        assert b.score == pytest.approx(a.score, abs=1e-9) and b.base_score == pytest.approx(a.base_score, abs=1e-9)


def test_tables_that_are_used_up_are_deleted(spark):
    docs = docs_frame(spark, ["one two three", "two three four", None])
    before = set(session._CREATED)
    out = bloom_lm.score(docs, docs, bits=1)
    assert len(set(session._CREATED) - before) == 2  # the counts and the scored rows
    assert out.count() == 3


def test_model_beats_the_unigram_on_seen_order(spark):
    docs = docs_frame(spark, ["one two three four five six seven"] * 5 + ["seven two five four one six three"])
    out = bloom_lm.score(docs, docs.where("doc_id < 5"), bits=1 << 16).orderBy("doc_id").collect()
    assert out[0].score > out[5].score and abs(out[0].base_score - out[5].base_score) < 1e-9


def test_language_model_odd_inputs(spark):
    docs = clashing(docs_frame(spark, [*ODD_TEXTS, (0, "twice"), (None, "no id")]), "score", "row", "word")
    out = bloom_lm.score(docs, docs, bits=1 << 16)
    assert out.count() == len(ODD_TEXTS) + 2 and out.where("score is null or base_score is null").count() == 0
    empty = spark.createDataFrame([], DOC)
    assert bloom_lm.score(empty, empty, bits=1 << 16).count() == 0
    assert {r.base_score for r in bloom_lm.score(docs, empty, bits=1 << 16).collect()} == {0.0}


def test_language_model_query(spark, sf_small):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    ids = sorted(rows)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in ids]
    n, expected = brute_scores([rows[i] for i in ids], [not h for h in held])
    out = {r.doc_id: r for r in bloom_lm.query(spark, sf_small).collect()}
    for i, h, (tokens, known, base) in zip(ids, held, expected, strict=True):
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, tokens, known, n) and r.base_score == pytest.approx(base, abs=1e-6)
