"""Rendezvous sharding, cross-tokenizer alignment and fill-in-middle."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD_TEXTS, clashing, docs_frame, sentence, vocabulary
from tokenizers import Tokenizer

from loanlens.llm import fim, registry, rendezvous, token_align

ODD = [*ODD_TEXTS, "<P> a <S>", "x<M>", "<", "▁ marked", "  two  spaces  ", "tab\there", "ab" * 3000, "é日" * 700, "\U0001f600 a", " "]


def mixed_texts(rng, n):
    """Words, digits, letters of several scripts, white space and copies."""
    vocab = vocabulary(120, 3)
    out = []
    for _ in range(n):
        parts = [sentence(rng, vocab, rng.randint(0, 60)), "".join(rng.choices("abZ 1.é日<P>S\n", k=rng.randint(0, 40))), str(rng.random())]
        rng.shuffle(parts)
        out.append(" ".join(parts))
    return [*out, *out[: n // 4]]


# ---- rendezvous sharding -----------------------------------------------------------


def brute_hash(key, shard):
    return int(hashlib.md5(f"{key}:{shard}".encode()).hexdigest()[:13], 16)


def brute_shard(key, shards):
    return max(shards, key=lambda s: (-shards[s] / np.log((brute_hash(key, s) + 0.5) / 16**13), brute_hash(key, s), -s))


def check_slots(rows):
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_sharding_query_equals_its_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    expected = con.execute(registry.ORACLE_SQL["op11_rendezvous"])
    names = [d[0] for d in expected.description]
    out = registry.QUERIES["op11_rendezvous"](spark, sf_small)
    assert sorted(map(tuple, out.select(*names).collect())) == sorted(expected.fetchall())


def test_sharding_equals_brute_force_on_odd_rows(spark):
    texts = [*ODD, (3, "repeated"), (3, "repeated"), (3, "other text"), (None, "no id"), (None, None)]
    docs = clashing(docs_frame(spark, texts), "shard", "slot", "size", "law", "_n", "grown_shard")
    rows = rendezvous.shard_documents(docs, rendezvous.equal_weights(24), rendezvous.equal_weights(25)).collect()
    expected = []
    for i, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (i, t)
        data, key = (t or "").encode(), "" if i is None else i
        expected.append((i, len(data) + 8, zlib.crc32(data), brute_shard(key, rendezvous.equal_weights(24)), brute_shard(key, rendezvous.equal_weights(25))))
    order = lambda x: (x[0] is not None, *map(lambda v: v or 0, x))
    assert sorted([(r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows], key=order) == sorted(expected, key=order)
    assert {r.law for r in rows} == {"key"}
    check_slots(rows)
    assert rendezvous.shard_documents(docs.limit(0), {0: 1.0}, {0: 1.0, 1: 1.0}).count() == 0


def test_copies_of_one_record_keep_slots_gapless(spark, monkeypatch):
    monkeypatch.setattr(rendezvous, "COPIES", 7)
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 5L, id) AS doc_id", "'same' AS text")
    rows = rendezvous.shard_documents(docs, rendezvous.equal_weights(4), rendezvous.equal_weights(5)).collect()
    assert len(rows) == 3000 and sum(r.doc_id == 5 for r in rows) == 1001
    check_slots(rows)


def test_a_new_shard_only_takes_and_weights_hold(spark):
    keys = spark.range(40_000).withColumnRenamed("id", "doc_id")
    light = {0: 1.0, 1: 2.0, 2: 1.0}
    rows = rendezvous.assign(keys, "doc_id", light, grown={**light, 7: 4.0}).collect()
    assert all(r.grown_shard in (r.shard, 7) for r in rows)
    share = collections.Counter(r.shard for r in rows)
    grown = collections.Counter(r.grown_shard for r in rows)
    assert abs(share[1] / 40_000 - 0.5) < 0.01 and abs(share[0] / 40_000 - 0.25) < 0.01
    assert abs(grown[7] / 40_000 - 0.5) < 0.01
    fewer = {r.doc_id: r.shard for r in rendezvous.assign(keys, "doc_id", {0: 1.0, 1: 2.0}).collect()}
    assert all(fewer[r.doc_id] == r.shard for r in rows if r.shard != 2)
    assert [brute_shard(k, light) for k in range(200)] == [r.shard for r in sorted(rows, key=lambda r: r.doc_id)[:200]]
    with pytest.raises(ValueError):
        rendezvous.assign(keys, "doc_id", {0: 0.0})
    with pytest.raises(ValueError):
        rendezvous.assign(keys, "doc_id", {0: 1.0}, grown={1: 1.0})


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = docs_frame(spark, [f"text {i}" for i in range(200)])
    rendezvous.write_shards(docs, str(tmp_path / "out"), "doc_id", rendezvous.equal_weights(5))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r.doc_id: r.shard for r in back.collect()} == {i: brute_shard(i, rendezvous.equal_weights(5)) for i in range(200)}
    assert {r.text for r in back.collect()} == {f"text {i}" for i in range(200)}


def test_sharding_has_no_python_and_no_wide_shuffle(spark, sf_small):
    plan = registry.QUERIES["op11_rendezvous"](spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- alignment -----------------------------------------------------------------


def brute_tokens(tokenizer, pieces, text):
    """``(id, end)`` lists of both tokenizers, or None."""
    if not text:
        return None
    data = (" " + text).encode()
    alphabet = {}
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    for b in shown:
        alphabet[chr(b)] = b
    for i, b in enumerate(b for b in range(256) if b not in shown):
        alphabet[chr(256 + i)] = b
    a = [(i, bytes(alphabet[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text):
        p = pieces.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()))
    if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
        return None
    out = []
    for tokens in (a, b):
        end, ends = 0, []
        for i, x in tokens:
            end += len(x)
            ends.append((i, end))
        out.append(ends)
    return out


def brute_align(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = [(i, brute_tokens(tokenizer, pieces, t)) for i, t in rows]
    links, counts = [], collections.Counter()
    for _, tokens in found:
        ends = [{e: i for i, e in side} for side in tokens] if tokens else [{}, {}]
        links.append([(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())])
        counts.update(links[-1])
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (i, tokens), of_doc in zip(found, links, strict=True):
        digest = ""
        if tokens:
            groups, cuts = [], sorted({e for _, e in tokens[0]} & {e for _, e in tokens[1]})
            at = 0
            for c in cuts:
                groups.append("|".join(",".join(str(t) for t, e in side if at < e <= c) for side in tokens))
                at = c
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        n_best = sum(counts[x] == most[x[1]] for x in of_doc)
        out.append((i, *(len(s) for s in tokens or ([], [])), len(of_doc), len(of_doc), n_best, sum(counts[x] for x in of_doc), digest))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned_rows(docs, **options):
    out = token_align.align_documents(docs, *token_align.default_vocabularies(), **options)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=lambda r: (r[0] is not None, *map(str, r)))


@pytest.mark.parametrize("chunk_bytes", [token_align.CHUNK_BYTES, 3000])
def test_alignment_equals_brute_force(spark, chunk_bytes):
    texts = [*mixed_texts(random.Random(4), 60), *ODD, "<s> </s> <unk> <0x41>", (2, "again"), (2, "again"), (None, "no id")]
    docs = clashing(docs_frame(spark, texts), "chunk", "docs", "pairs", "pair", "n_a", "best")
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    expected = sorted(brute_align(rows), key=lambda r: (r[0] is not None, *map(str, r)))
    assert aligned_rows(docs, chunk_bytes=chunk_bytes) == expected
    by_id = {r[0]: r for r in expected}
    assert by_id[texts.index("▁ marked")][1:] == (0, 0, 0, 0, 0, 0, "")
    assert aligned_rows(docs.limit(0)) == [] and aligned_rows(docs_frame(spark, [None, ""])) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_query_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = registry.QUERIES["op12_token_align"](spark, sf_small)
    assert sorted(map(tuple, out.select(*COLUMNS).collect())) == sorted(brute_align([(r.doc_id, r.text) for r in docs.collect()]))


def test_shared_cuts_are_the_common_ends():
    rng = np.random.default_rng(2)
    for common in (0.0, 0.05, 0.6, 1.0):
        ends = []
        last_a, last_b, a, b, at = [], [], [], [], 0
        for _ in range(30):
            n = int(rng.integers(1, 300))
            inside = np.arange(1, n)
            both = rng.random(n - 1) < common
            side = rng.random(n - 1) < 0.5
            a.append(at + np.append(inside[both | side], n))
            b.append(at + np.append(inside[both | ~side], n))
            at += n
            last_a.append(sum(map(len, a)) - 1)
            last_b.append(sum(map(len, b)) - 1)
        ends_a, ends_b = np.concatenate(a), np.concatenate(b)
        cut_a, cut_b = token_align.shared_cuts(ends_a, ends_b, np.array(last_a), np.array(last_b))
        ends = np.intersect1d(ends_a, ends_b)
        assert ends_a[cut_a].tolist() == ends.tolist() == ends_b[cut_b].tolist()


def test_long_texts_are_encoded_in_parts(monkeypatch):
    rng = random.Random(8)
    texts = [t for t in [*mixed_texts(rng, 40), *ODD] if t]
    whole = [(" " + t).encode() for t in texts]
    tokenizers = [token_align.RankTokenizer(token_align.default_vocabularies()[0]), token_align.PieceTokenizer(token_align.default_vocabularies()[1])]
    expected = [token_align.encoded(t, texts, whole) for t in tokenizers]
    assert all(t.cuts_at_spaces for t in tokenizers)
    monkeypatch.setattr(token_align, "parts_of", lambda t, f=token_align.parts_of: f(t, 5))
    assert max(len(token_align.parts_of(t)) for t in texts) > 20
    assert [token_align.encoded(t, texts, whole) for t in tokenizers] == expected


# ---- fill in the middle --------------------------------------------------------------


UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute_fim(key, text):
    text = text or ""
    w = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(w), "plain", None, None, text
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    pre, mid, suf = ("".join(x) for x in (w[:a], w[a:b], w[b:]))
    if h[3] % 100 < 20:
        return len(w), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(w), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fim_equals_brute_force_and_restores(spark):
    texts = [*mixed_texts(random.Random(6), 300), *ODD, "<S<P", "a" * 5000, "A1" * 3000, (7, "again"), (7, "again"), (None, "no id"), (-3, "negative id")]
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    docs = clashing(docs_frame(spark, texts), "form", "output", "n")
    out = fim.transform_documents(docs)
    key = lambda r: (r[0] is not None, r[0] or 0, str(r))
    got = sorted(map(tuple, out.collect()), key=key)
    assert got == sorted([(i, *brute_fim(i, t)) for i, t in rows], key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert sorted(map(tuple, fim.restore_documents(out).collect()), key=key) == sorted([(i, t or "") for i, t in rows], key=key)
    digests = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.round_trip_digests(docs).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert digests == {(i, sha(brute_fim(i, t)[4]), sha(t or "")) for i, t in rows}
    assert fim.transform_documents(docs.limit(0)).count() == 0


def test_tree_descends_to_every_unit():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 7, 8, 9, 40):
        units, points = [rng.choice([0, 0, 1, 5]) for _ in range(n)], [rng.randint(0, 9) for _ in range(n)]
        tree = fim.BlockCounts(units, points)
        starts = [(b, j) for b in range(n) for j in range(units[b])]
        for k, (b, j) in enumerate(starts):
            assert tree.descend(k) == (b, j, sum(points[:b]))
        assert tree.descend(len(starts)) == (n, 0, sum(points)) or not n


def test_fim_query_equals_its_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    expected = con.execute(registry.ORACLE_SQL["op13_fill_in_middle"])
    names = [d[0] for d in expected.description]
    out = registry.QUERIES["op13_fill_in_middle"](spark, sf_small)
    assert set(map(tuple, out.select(*names).collect())) == set(expected.fetchall())


