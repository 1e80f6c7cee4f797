"""Jaccard join, fingerprints and decontamination."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from helpers import DOC, ODD_TEXTS, clashing, docs_frame, sentence, vocabulary

from loanlens.llm import components, decontaminate, jaccard_join, simhash


# ---- components -------------------------------------------------------------


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, j) for j in range(1, 30)]  # a path and a star
    edges += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(7, 7), (3, 0), (3, 0)]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    out = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(out) == len(nodes)
    assert {r.node: r.component for r in out} == brute_components(nodes, [e for e in edges if e[0] != e[1]])
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_star_needs_no_step(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "materialize", lambda df, plain=components.materialize: written.append(df) or plain(df))
    out = components.connected_components(spark.createDataFrame([(0, j) for j in range(1, 9)] + [(20, 21), (21, 20)], "a long, b long")).collect()
    assert {r.node: r.component for r in out} == {**dict.fromkeys(range(9), 0), 20: 20, 21: 20}
    assert len(written) == 1


# ---- Jaccard join -----------------------------------------------------------


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_join(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    owners = collections.defaultdict(list)
    for i, s in sets:
        if s:
            owners[s].append(i)
    edges = [(o[0], x) for o in owners.values() for x in o[1:]]
    every = sorted(owners, key=len)
    for x in range(len(every)):
        for y in range(x + 1, len(every)):
            a, b = every[x], every[y]
            if 100 * len(a) < 80 * len(b):
                break
            both = len(a & b)
            if 100 * both >= 80 * (len(a) + len(b) - both):
                edges.append((owners[a][0], owners[b][0]))
    return brute_components([i for i, _ in rows], edges), dict(sets)


def near_copies(rng, vocab, lengths, copies):
    """Texts with copies whose words are substituted, dropped or added, around the limit of similarity."""
    out = []
    for n in lengths:
        base = rng.choices(vocab, k=n)
        out.append(" ".join(base))
        for _ in range(rng.randint(0, copies)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, n // 25))):
                at = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.5:
                    w[at] = rng.choice(vocab)
                elif kind < 0.75 and len(w) > 1:
                    del w[at]
                else:
                    w.insert(at, rng.choice(vocab))
            out.append(" ".join(w))
    return out


def check_join(spark, rows):
    expected, sets = brute_join(rows)
    out = jaccard_join.components(docs_frame(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == expected[r.doc_id]
    return expected


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = vocabulary(400, seed)
    texts = near_copies(rng, vocab, [rng.choice([1, 3, 5, 6, 7, 9, 12, 20, 40, 80, 150, 300]) for _ in range(120)], 5)
    texts += texts[:7] + ["UP down up DOWN up down", "up down up down up down"]
    rng.shuffle(texts)
    expected = check_join(spark, list(enumerate(texts)))
    assert len(set(expected.values())) < len(texts)


def test_join_with_a_hot_group_and_a_common_passage(spark):
    rng = random.Random(3)
    vocab = vocabulary(2000)
    base, line = rng.choices(vocab, k=120), sentence(rng, vocab, 30)
    texts = []
    for _ in range(150):  # a third: near copies of one text
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(120)] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [line + " " + sentence(rng, vocab, rng.randint(2, 60)) for _ in range(150)]
    texts += [sentence(rng, vocab, 60) for _ in range(100)] + [texts[0]] * 50
    expected = check_join(spark, list(enumerate(texts)))
    assert max(collections.Counter(expected.values()).values()) > 100


@pytest.mark.parametrize("deletion", [frozenset(), frozenset(range(12))])
@pytest.mark.parametrize("heavy_share", [0.0, 0.4, 0.97])
def test_similar_sets_share_a_key(deletion, heavy_share):
    """The pigeonhole argument itself: any modes, any heavy shingles."""
    rng = np.random.default_rng(int(heavy_share * 100) + len(deletion))
    for _ in range(600):
        n = int(rng.choice([1, 2, 3, 4, 5, 8, 10, 12, 19, 30, 64, 120, 250]))
        a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        heavy = np.sort(a[rng.random(len(a)) < heavy_share])
        index = jaccard_join.Index(heavy, deletion)
        fewer = a[rng.permutation(len(a))[: len(a) - rng.integers(0, len(a) // 6 + 1)]]
        b = np.unique(np.concatenate([fewer, rng.integers(0, 1 << 64, rng.integers(0, len(a) // 6 + 1), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            (ka, _, la), (kb, _, lb) = index.keys(a), index.keys(b)
            _, i, j = np.intersect1d(ka, kb, return_indices=True)
            assert not (la[i] & lb[j]).all()  # and not only where both look for smaller ones


def test_modes_are_allocated_by_cost():
    rng = np.random.default_rng(6)
    draw = lambda n: rng.integers(0, 1 << 64, n, dtype=np.uint64)
    spread = [np.sort(draw(20)) for _ in range(200)]
    assert jaccard_join.allocate(spread, np.zeros(0, dtype=np.uint64), 1.0) == frozenset()
    shared = draw(14)
    alike = [np.unique(np.concatenate([shared, draw(6)])) for _ in range(200)]
    assert jaccard_join.allocate(alike, np.zeros(0, dtype=np.uint64), 100.0) in (frozenset(), frozenset({6}))


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 64, 300, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(1, len(a))], rng.integers(0, 1 << 64, 40, dtype=np.uint64)]))
        apart = sum(int(x).bit_count() for x in (jaccard_join.sketch(a) ^ jaccard_join.sketch(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))


def test_join_odd_inputs(spark):
    docs = clashing(docs_frame(spark, [*ODD_TEXTS, (None, "x"), (None, None), (3, "x")]), "key", "set", "n", "component_id")
    out = jaccard_join.components(docs)
    assert out.count() == len(ODD_TEXTS) + 3
    by_id = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by_id[0].n_shingles == 0 and by_id[0].component_id == 0 and by_id[2].component_id == 2
    assert by_id[3].n_shingles == 1 and by_id[5].n_shingles == 1  # one word; one word repeated
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    empty = spark.createDataFrame([], DOC)
    assert jaccard_join.components(empty).count() == 0 and jaccard_join.keep_one(empty).count() == 0


def test_keep_one_of_each_group(spark):
    docs = docs_frame(spark, ["a b c d e f"] * 3 + ["other words stand in this text"] + [None, None, ""])
    assert sorted(r.doc_id for r in jaccard_join.keep_one(docs).collect()) == [0, 3, 4, 5, 6]


def test_join_on_documents(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    expected, sets = brute_join(rows)
    out = jaccard_join.query(spark, sf_small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == {i: (len(sets[i]), expected[i]) for i, _ in rows}


# ---- fingerprints -----------------------------------------------------------


def test_likeness_follows_the_share_of_common_terms():
    rng = random.Random(1)
    vocab, h = vocabulary(3000), simhash.WordHashes()
    text = rng.choices(vocab, k=400)
    likes = []
    for changed in (0, 40, 150, 400):
        other = rng.choices(vocab, k=changed) + text[changed:]
        likes.append(simhash.likeness(simhash.fingerprint(" ".join(text), h), simhash.fingerprint(" ".join(other), h)))
    assert likes[0] == 1 and likes == sorted(likes, reverse=True) and likes[1] > 0.8 and abs(likes[3] - 0.5) < 0.12


def test_fingerprint_is_the_sign_of_the_weighted_votes():
    text = "a b a b a c"
    h = simhash.WordHashes()
    pairs = collections.Counter(zip([None, *text.split()[:-1]], text.split(), strict=True))
    votes = np.zeros(simhash.BITS)
    for (x, y), n in pairs.items():
        before = np.uint64(h[x.encode()] if x else 0)
        term = simhash._finish(np.array([before], dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(h[y.encode()]))
        lanes = simhash._finish(term[:, None] + simhash._LANE)
        votes += (1 + np.log(n)) * (2 * np.unpackbits(lanes.view(np.uint8)).astype(float) - 1)
    assert (np.unpackbits(simhash.fingerprint(text, h)) == (votes > 0)).all()


def test_next_document_and_edited_text(spark):
    rng = random.Random(2)
    texts = [(i * 7 % 50, sentence(rng, ["é", "日本", "word", "x"], rng.randint(0, 40))) for i in range(50)] + [(None, "no id at all"), (60, None)]
    out = {r.doc_id: r for r in simhash.fingerprints_with_next(clashing(docs_frame(spark, texts), "range", "ghost", "fingerprint")).collect()}
    order = [(60, "")] + sorted(((i, t) for i, t in texts if i is not None and i < 60), reverse=True) + [(None, "no id at all")]
    assert len(out) == len(order)
    h = simhash.WordHashes()
    for (i, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        n = len(t) // 3
        other = t[: len(t) - n] + following[:n]
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(other.encode()).hexdigest())
        assert r.fingerprint == simhash.fingerprint(t, h).tobytes().hex() and r.edited_fingerprint == simhash.fingerprint(other, h).tobytes().hex()
        assert r.near_next == simhash.likeness(simhash.fingerprint(t, h), simhash.fingerprint(following, h))


def test_fingerprints_odd_inputs(spark):
    assert simhash.fingerprints_with_next(spark.createDataFrame([], DOC)).count() == 0
    one = simhash.fingerprints_with_next(docs_frame(spark, ["only one text"])).first()
    assert one.near_next == 1.0
    out = simhash.fingerprints_with_next(docs_frame(spark, [*ODD_TEXTS, (0, "b"), (0, "a"), (0, "a"), (None, None)]))
    assert out.count() == len(ODD_TEXTS) + 4
    assert out.where("n_chars = 0").select("fingerprint").distinct().count() == 1
    only_null = simhash.fingerprints_with_next(docs_frame(spark, [(None, "a"), (None, "b")]))
    assert only_null.count() == 2


def test_simhash_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(12)
    vocab = vocabulary(2000)
    texts = {}
    for g in range(8):
        base = rng.choices(vocab, k=600)
        for k in range(10):  # near copies, and an exact one
            w = list(base)
            for _ in range(k // 2):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts[10 * g + k] = " ".join(w)
    docs_frame(spark, list(texts.items())).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in simhash.query(spark, str(tmp_path)).collect()}
    h = simhash.WordHashes()
    own = {i: simhash.fingerprint(t, h) for i, t in texts.items()}
    order = sorted(texts, reverse=True)
    assert set(out) == set(texts)
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        other = simhash.edited(texts[i], texts[following])
        changed = simhash.fingerprint(other, h)
        near = sum(np.unpackbits(own[i] ^ p).sum() <= simhash.RADIUS for p in own.values()) - 1
        r = out[i]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(texts[i]), own[i].tobytes().hex(), changed.tobytes().hex())
        assert r.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        assert (r.near_edited, r.near_next) == (simhash.likeness(own[i], changed), simhash.likeness(own[i], own[following]))
        assert r.n_within == (near if i % 20 == 0 else None)
    assert max(r.n_within or 0 for r in out.values()) > 0


def test_search_finds_near_copies(spark, sf_small):
    """Recall against brute-force similarity of five-word shingles, which knows nothing of fingerprints."""
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    _, sets = brute_join([(r.doc_id, r.text) for r in rows])
    rng = random.Random(21)
    vocab = vocabulary(1500)
    texts = {}
    for g in range(40):  # near copies by scattered changes of words, as far as the similarity allows and beyond
        base = rng.choices(vocab, k=rng.choice([60, 120, 300, 800]))
        texts[1000 * g] = " ".join(base)
        for k in range(1, 6):
            w = list(base)
            for at in rng.sample(range(len(w)), max(1, len(w) * k // 225)):
                w[at] = rng.choice(vocab)
            texts[1000 * g + k] = " ".join(w)
    _, made = brute_join(list(texts.items()))
    alike = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    for pairs_of, text_of in ((sets, {r.doc_id: r.text for r in rows}), (made, texts)):
        h = simhash.WordHashes()
        prints = {i: simhash.fingerprint(t or "", h) for i, t in text_of.items()}
        df = spark.createDataFrame([(simhash.lanes_of(p),) for p in prints.values()], "lanes array<long>")
        found = {(r.fingerprint, r.near) for r in simhash.within_radius(df, df).collect()}
        similar = [(a, b) for a in pairs_of for b in pairs_of if a != b and alike(pairs_of[a], pairs_of[b])]
        text = {i: p.tobytes().hex() for i, p in prints.items()}
        caught = sum(text[a] == text[b] or (text[a], text[b]) in found for a, b in similar)
        assert caught >= 0.9 * len(similar)
    assert len(similar) > 300


def test_tables_follow_the_sizes():
    assert simhash.tables_for(10_000, 200_000) == 4  # 16 blocks of 16 bits, one bit apart
    few, many = simhash.tables_for(10**3, 10**4), simhash.tables_for(5 * 10**8, 10**10)
    assert few >= 4 > many == 2


@pytest.mark.parametrize("per_lane,radius", [(None, 31), (3, 31), (4, 11), (2, 9), (8, 31), (2, 3)])
def test_search_equals_brute_force(spark, per_lane, radius):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2, (20, simhash.BITS))
    prints = []
    for b in base:
        for flips in range(0, 36, 3):
            x = b.copy()
            x[rng.choice(simhash.BITS, flips, replace=False)] ^= 1
            prints.append(np.packbits(x))
    prints.append(np.zeros(simhash.BITS // 8, dtype=np.uint8))
    prints.append(np.full(simhash.BITS // 8, 255, dtype=np.uint8))
    rows = [(p.tobytes().hex(), simhash.lanes_of(p)) for p in prints] * 2
    df = spark.createDataFrame(rows, "fingerprint string, lanes array<long>")
    out = [(r.fingerprint, r.near, r.distance) for r in simhash.within_radius(df, df, radius, per_lane).collect()]
    got = set(out)
    assert len(out) == len(got)  # each pair once
    expected = set()
    for a in prints:
        for b in prints:
            d = int(np.unpackbits(a ^ b).sum())
            if 0 < d <= radius:
                expected.add((a.tobytes().hex(), b.tobytes().hex(), d))
    assert got == expected and len(expected) >= 20


# ---- decontamination --------------------------------------------------------


def brute_matches(docs, items):
    """Masks by hand: a hit needs equal tokens at the ones of a mask, then equal tokens on that diagonal count."""
    import regex

    split = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    out = {}
    for i, text in docs:
        d = split(text)
        for j, item in items:
            b = split(item)
            best = 0
            for shift in range(-len(b), len(d)):
                eq = [0 <= k + shift < len(d) and d[k + shift] == b[k] for k in range(len(b))]
                hit = any(
                    k + shift >= 0 and k + shift + len(m) <= len(d) and all(eq[k + o] for o, c in enumerate(m) if c == "1")
                    for m in decontaminate.MASKS
                    for k in range(len(b) - len(m) + 1)
                )
                if hit or (0 < len(b) < min(map(len, decontaminate.MASKS)) and all(eq)):
                    best = max(best, sum(eq))
            if best and best >= min(decontaminate.MIN_EQUAL, -(-len(b) * 8 // 10)):
                out[(i, j)] = best
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    vocab = vocabulary(300)
    items = [(j, sentence(rng, vocab, n)) for j, n in enumerate([9, 10, 12, 15, 30, 59, 3, 0])] + [(50, None), (4, None)]
    docs = []
    for i in range(60):
        text = rng.choices(vocab, k=rng.randint(0, 60))
        if i % 2:
            part = (items[i % 8][1] or "").split()
            for k in range(len(part)):
                if rng.random() < 0.12:
                    part[k] = rng.choice(vocab)
            text[5:5] = [w + rng.choice(["", "###", ",", "!!"]) for w in part[: rng.randint(5, 60)]]
        docs.append((i, " ".join(text).title()))
    docs += [(100, None), (101, ""), (1, "again")]
    expected = brute_matches(docs, items)
    frame = clashing(docs_frame(spark, docs), "tokens", "seed", "pos", "item_id", "n_equal")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.matches(frame, bench).collect()}
    assert got == expected and len(expected) > 10
    kept = decontaminate.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in expected}


def test_substitutions_are_tolerated(spark):
    rng = random.Random(5)
    vocab = vocabulary(500)
    item = sentence(rng, vocab, 40).split()
    broken = [w if k % 8 else "changed" for k, w in enumerate(item)]  # no nine tokens in a row are left
    out = decontaminate.contaminated(docs_frame(spark, [" ".join(broken), sentence(rng, vocab, 200)]), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert [(r.doc_id, r.item_ids, r.n_equal) for r in out.collect()] == [(0, "1", 35)]


def test_decontamination_empty_tables(spark):
    docs, bench = docs_frame(spark, ODD_TEXTS), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench).count() == len(ODD_TEXTS)
    assert decontaminate.drop_contaminated(spark.createDataFrame([], DOC), bench).count() == 0
    with_null = docs_frame(spark, [(None, "a b c d e f g h i j k l m n o p"), (None, "free")])
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string")
    assert decontaminate.drop_contaminated(with_null, bench).count() == 0  # rows without id are one document


def test_decontamination_stays_in_generated_code(spark, sf_small):
    plan = decontaminate.matches(spark.read.parquet(f"{sf_small}/documents.parquet"), spark.read.parquet(f"{sf_small}/benchmark.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Python" not in text and "Arrow" not in text
    join = next(line for line in text.splitlines() if "BroadcastHashJoin" in line)
    assert "aggregate(" not in join


def test_short_items_are_found_whole(spark):
    items = [(1, "one two three four five six seven"), (2, "Solo"), (3, "two three"), (4, ""), (5, "nine words are in this item and no more")]
    texts = ["One two, three four five six seven!", "x solo y", "two words three", "zero two three one", "one two three four five six eight", None, "",
             "so nine words are in this item and no more of it"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (decontaminate.MAX_BROADCAST_BYTES, -1):
        got = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.matches(docs_frame(spark, texts), bench, limit).collect()}
        assert got == brute_matches(enumerate(texts), items) == {(0, 1): 7, (0, 3): 2, (1, 2): 1, (3, 3): 2, (4, 3): 2, (7, 5): 9}


def test_shuffled_seeds_give_the_same_rows(spark):
    rng = random.Random(12)
    vocab = vocabulary(40)
    items = [(i // 2, sentence(rng, vocab, rng.randint(1, 30))) for i in range(20)]  # an id has two texts
    docs = []
    for i in range(60):
        part = items[rng.randrange(len(items))][1].split()
        for _ in range(rng.randint(0, 3)):
            part[rng.randrange(len(part))] = rng.choice(vocab)
        docs.append((i // 2 if i < 10 else i, " ".join([sentence(rng, vocab, rng.randint(0, 20)), *part, sentence(rng, vocab, 10)])))
    docs += [docs[20], docs[20], (None, docs[21][1])]
    frame = clashing(docs_frame(spark, docs), "tokens", "seed", "pos", "number", "shift", "item", "item_id", "text_key")
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"), "item", "seed", "tokens", "doc_id")
    assert not re.search("Python|Arrow", decontaminate.matches(frame, bench, -1)._jdf.queryExecution().executedPlan().toString())
    one, other = (sorted(map(str, decontaminate.matches(frame, bench, limit).collect())) for limit in (decontaminate.MAX_BROADCAST_BYTES, -1))
    assert one == other
    expected = {}
    for key, value in [(k, v) for pair in items for k, v in brute_matches(docs, [pair]).items()]:
        expected[key] = max(expected.get(key, 0), value)
    assert {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.matches(frame, bench).collect()} == expected
