"""Exact Jaccard join on word shingles by universe partition and the pigeonhole principle.

Two sets with sizes a and b and a similarity of at least 0.8 differ in at most ``(a + b) / 9`` shingles. The hashes of
all possible shingles are cut into segments, finer for larger sets: there is one partition for each size
band, and a set takes part in that of its own band and, where a smaller partner can be there, of the band below. The
differences fall into the segments, so two similar sets agree on many segments. A segment's units say what it proves:

- exact mode: the hash of a segment's subset is indexed; 1 unit (equal subsets meet);
- deletion mode: the subset and its one-deletion neighbourhood are indexed; 2 units (subsets that differ in one shingle meet).

A set walks through its segments in order until its units exceed the differences that are allowed. Of two similar
sets the one that stops first has units in more places than there are differences, so some segment of both meets. The mode of a
band is allocated by cost: index entries plus expected candidates, measured on a bounded sample of sets.

Shingles that very many sets hold prove little: a segment counts units only by its other shingles
(``heavy`` is found in the same sample and is the same for all sets, so exactness doesn't depend on it). A set that runs out of
segments goes on in a second index of run-out sets, in which all shingles count, and a set with too few segments even
there in a third one by single shingles.

Equal sets are one from the start. Within an index key each set is compared to a few leaders of the key, one such pair for each
set first; whoever is then in one component needs no further comparison. Pairs of different components that share a
key are compared last, all of them that parity sketches allow (two sketches never differ in more bits than the sets do in
shingles). Candidates are verified on the whole sets of 64-bit shingle hashes. Sets themselves are told apart by a 64-bit
hash. No step gathers a group.

Defined results: null, empty and blank texts have no shingles and are linked with nothing; with fewer than five words the
whole sequence is the one shingle; rows that repeat a ``doc_id`` share its component; the least non-null id names a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loanlens.llm.common import blocks, bounded_sample, materialize, mix64, release_memory, release_shuffles, utf8, word_hashes
from loanlens.llm.components import connected_components

SHINGLE = 5
BAND_RATIO = 1.5
PER_SEGMENT = {"exact": 3.0, "deletion": 6.0}  # shingles of the band's largest sets in a segment
# Sets from which heavy shingles and the bands' costs are estimated (a documented bound; all sets are indexed).
SAMPLE_SETS = 8_000
HEAVY_IN_SAMPLE = 4
MAX_HEAVY = 1 << 17
DELETION_UP_TO = 64  # largest set of a band for which deletion mode is weighed
CANDIDATE_COST = 20.0
ALLOCATE_SETS = 300
SALTS = 32
LEADER_CHOICES = 4
SKETCH_BITS = 1024
MAX_BROADCAST_ROWS = 1_000_000
SEEN = 500_000
FLUSH_KEYS = 1_000_000

_C = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_sets(documents: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    h, count = word_hashes(documents)
    ends = np.cumsum(count)
    if len(h) >= SHINGLE:
        n = len(h) - SHINGLE + 1
        rolled = h[:n] * _C[0]
        for j in range(1, SHINGLE):
            rolled = rolled + h[j : j + n] * _C[j]
        rolled = mix64(rolled)
    out = []
    for b, k in zip(ends.tolist(), count.tolist(), strict=True):
        if k >= SHINGLE:
            out.append(np.unique(rolled[b - k : b - SHINGLE + 1]))
        elif k:
            out.append(mix64((h[b - k : b] * _C[:k]).sum(keepdims=True) + np.uint64(k)))
        else:
            out.append(h[:0])
    return out


def set_id(s: np.ndarray) -> int:
    """Hash of a set, as a signed 64-bit integer."""
    return int(mix64(mix64(s ^ _C[1]).sum(keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


def bands(largest: int) -> list[int]:
    """First size of each band up to the one after ``largest``'s: 1, 2, 3, 5, 8, 12, ..."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * BAND_RATIO))))
    return out


@dataclass
class Index:
    """What all sets are indexed by: heavy shingles (sorted) and the bands in deletion mode."""

    heavy: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    deletion: frozenset = frozenset()
    known: dict = field(default_factory=dict)

    def schemes(self, n: int) -> list[tuple[int, int, int]]:
        """(band, largest size in it, differences allowed) for a set of ``n``: its own band, and the one below if a partner can be there."""
        if n in self.known:
            return self.known[n]
        first = bands(n)
        k = len(first) - 2
        out = [(k, first[k + 1] - 1, (n + n * 5 // 4) // 9)]
        if k and -(-n * 4 // 5) < first[k]:
            out.append((k - 1, first[k] - 1, (n + first[k] - 1) // 9))
        self.known[n] = out
        return out

    def keys(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index keys of a sorted set, the index (1, 2 or 3) of each, and whether it is in the band below the set's own.

        Two sets of one band meet in that band; below it each only looks for smaller ones.
        """
        mixed = mix64(s)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, s), len(self.heavy) - 1)
            light = (self.heavy[at] != s).astype(np.int64)
        else:
            light = np.ones(len(s), dtype=np.int64)
        keys, spaces, low = [], [], []
        own = self.schemes(len(s))[0][0]
        for band, largest, allowed in self.schemes(len(s)):
            mode = "deletion" if band in self.deletion else "exact"
            m = max(1, int(np.ceil(largest / PER_SEGMENT[mode])))
            segment = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            start = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1])
            size = np.diff(np.append(start, len(s)))
            total = np.add.reduceat(mixed, start)
            salt = mix64(segment[start] + np.uint64(band << 40))
            ran_out = True
            for space, weight in ((1, np.add.reduceat(light, start)), (2, size)):
                units = np.minimum(weight, 2 if mode == "deletion" else 1)
                reached = np.cumsum(units)
                stop = int(np.searchsorted(reached, allowed + 1)) + 1  # segments walked
                use = np.flatnonzero(units[:stop])
                keys.append(mix64(total[use] + salt[use] + np.uint64(space)))
                if mode == "deletion":
                    double = use[units[use] == 2]
                    spread = np.repeat(double, size[double])
                    inside = np.arange(len(spread)) - np.repeat(np.cumsum(size[double]) - size[double], size[double])
                    keys.append(mix64(total[spread] - mixed[start[spread] + inside] + salt[spread] + np.uint64(space)))
                spaces += [space] * (len(keys[-1]) + (len(keys[-2]) if mode == "deletion" else 0))
                if reached[-1] > allowed:
                    ran_out = False
                    break
            if ran_out:
                keys.append(mix64(mixed + np.uint64((band << 40) + 3)))
                spaces += [3] * len(s)
            low += [band < own] * (len(spaces) - len(low))
        return np.concatenate(keys), np.array(spaces, dtype=np.int8), np.array(low, dtype=bool)


def set_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n, set`` of every row of ``docs(doc_id, text)``; ``set`` is null where there are no shingles."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            sets = shingle_sets(utf8(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", "n", "set"],
            )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n bigint, set bigint")


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of ``SKETCH_BITS`` cells. Two sketches differ in at most as many
    bits as the sets differ in shingles."""
    return np.packbits((np.bincount((s % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def sketch_distance(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))


def _with_shingles(docs: DataFrame) -> DataFrame:
    """``set, shingles, sketch`` of every row of ``docs(text)`` with shingles, once for each set and task."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in blocks(batches):
            out = {}
            for s in shingle_sets(utf8(batch)):
                if len(s) and (i := set_id(s)) not in seen:
                    seen.add(i)
                    out[i] = s
            if len(seen) > SEEN:
                seen.clear()
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in out.values()])]).astype(np.int32)
            flat = np.concatenate([*out.values(), np.zeros(0, dtype=np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(out), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array([sketch(s).tolist() for s in out.values()], pa.list_(pa.int64())),
                ],
                names=["set", "shingles", "sketch"],
            )

    return docs.select("text").mapInArrow(run, "set bigint, shingles array<bigint>, sketch array<bigint>")


def fit(docs: DataFrame, n_docs: int, bound: int = SAMPLE_SETS) -> Index:
    """Heavy shingles and the bands' modes from about ``bound`` sets."""
    sample = materialize(_with_shingles(bounded_sample(docs.select("doc_id", "text"), bound, key=["doc_id", "text"])).dropDuplicates(["set"]))
    common = (
        sample.select(F.explode("shingles").alias("s")).groupBy("s").count().where(F.col("count") >= HEAVY_IN_SAMPLE).orderBy(F.desc("count"), "s").limit(MAX_HEAVY)
    )
    heavy = np.sort(common.select("s").toPandas()["s"].to_numpy(dtype=np.int64).view(np.uint64))
    small = sample.where(F.size("shingles") <= DELETION_UP_TO).select("shingles").toPandas()["shingles"]
    index = Index(heavy, allocate([np.asarray(s, dtype=np.int64).view(np.uint64) for s in small], heavy, max(1.0, n_docs / bound)))
    del common, small
    release_memory()
    return index


def allocate(sample: list[np.ndarray], heavy: np.ndarray, scale: float) -> frozenset:
    """Bands in which deletion mode costs less: entries of a set, plus the other sets that share a key with it.

    ``scale`` is how many sets there are for one of the sample. Candidates are counted as different pairs
    among ``ALLOCATE_SETS`` sets of the band and carried on to all of them.
    """
    top = bands(DELETION_UP_TO)
    chosen = set()
    for k in range(len(top) - 1):
        band = [s for s in sample if top[k] <= len(s) < top[k + 1]]
        own = band[:ALLOCATE_SETS]
        if not own:
            continue
        cost = {}
        for mode in ("exact", "deletion"):
            index = Index(heavy, frozenset({k} if mode == "deletion" else ()))
            every = [index.keys(s)[0] for s in own]
            flat = np.concatenate(every)
            owner = np.repeat(np.arange(len(own)), [len(e) for e in every])[np.argsort(flat, kind="stable")]
            flat = np.sort(flat)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(flat)) + 1, [len(flat)]])
            pairs = np.zeros((len(own), len(own)), dtype=bool)
            for a, b in zip(cut, cut[1:], strict=False):
                if b - a > 1:
                    pairs[np.ix_(owner[a:b], owner[a:b])] = True
            np.fill_diagonal(pairs, False)
            cost[mode] = len(flat) / len(own) + CANDIDATE_COST * pairs.sum() / len(own) * scale * len(band) / len(own)
        if cost["deletion"] < cost["exact"]:
            chosen.add(k)
    return frozenset(chosen)


def index_entries(docs: DataFrame, index: Index) -> DataFrame:
    """``key, salt, low, set, n``: the index of all sets. ``salt`` is -1 in the first index and splits the keys of the others."""
    shared = docs.sparkSession.sparkContext.broadcast((index.heavy, index.deletion))  # at most MAX_HEAVY hashes

    def run(batches) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        seen: set[int] = set()
        for batch in blocks(batches):
            keys, salts, lows, sets, sizes = [], [], [], [], []
            for s in shingle_sets(utf8(batch)):
                if not len(s) or (i := set_id(s)) in seen:
                    continue
                seen.add(i)
                k, space, low = index.keys(s)
                keys.append(k)
                lows.append(low)
                salts.append(np.where(space == 1, -1, i % SALTS).astype(np.int32))
                sets.append(np.full(len(k), i, dtype=np.int64))
                sizes.append(np.full(len(k), len(s), dtype=np.int32))
            if len(seen) > SEEN:
                seen.clear()
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (salts, lows, sets, sizes))],
                    names=["key", "salt", "low", "set", "n"],
                )

    return docs.select("text").mapInArrow(run, "key bigint, salt int, low boolean, set bigint, n int")


def _stars(entries: DataFrame, by: list[str]) -> DataFrame:
    """Entries with the least set of their key as ``pivot`` and its size ``pivot_n``, each set once.

    Keys of a single set go, but for salted ones, which may meet other parts of their key. The window only
    looks at the first, the last and the next row: it streams through a key of any size.
    """
    order = W.partitionBy(*by).orderBy("set")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        entries.withColumns({"pivot": F.first("set").over(so_far), "pivot_n": F.first("n").over(so_far), "next": F.lead("set").over(order)})
        .where("(next is null or next <> set) and (set <> pivot or next is not null or salt >= 0)")
        .drop("next")
    )


def could_be_similar(a: str, b: str) -> Column:
    """By their sizes."""
    return F.least(a, b) * 5 >= F.greatest(a, b) * 4


def similar(intersection, a, b):
    """The link's condition in integers: 100 * intersection >= 80 * union."""
    return 100 * intersection >= 80 * (a + b - intersection)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, marked for broadcast if its rows (at most ``rows`` if given), which must be a few numbers each, are counted to be few."""
    rows = df.limit(MAX_BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose ``sets(set, shingles)`` are similar. Only the shingles of sets in a pair move."""
    pairs = materialize(pairs.select("a", "b"))
    n = pairs.count()
    if not n:
        return pairs
    a = sets.select(F.col("set").alias("a"), F.col("shingles").alias("sa")).join(small(pairs, n), "a")
    wanted = pairs.select("b").distinct()
    b = sets.select(F.col("set").alias("b"), F.col("shingles").alias("sb")).join(small(wanted, n), "b", "left_semi")
    both = F.size(F.array_intersect("sa", "sb"))
    found = materialize(a.join(b, "b").where(similar(both, F.size("sa"), F.size("sb"))).select("a", "b").distinct())
    release_shuffles(sets.sparkSession)  # and the plans and classes that the driver is done with
    return found


def links(docs: DataFrame, members: DataFrame, index: Index) -> DataFrame:
    """``node, component`` of all sets that are similar to another set."""
    # the parts of a salted key meet through their least sets
    first = materialize(_stars(index_entries(docs, index), ["key", "salt"]))
    second = _stars(first.where("salt >= 0 and set = pivot").select("key", "salt", "low", "set", "n"), ["key"])
    paired = first.unionByName(second).where("set <> pivot")
    ids = materialize(paired.select(F.explode(F.array("set", "pivot")).alias("set")).distinct())
    reps = members.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("doc_id"))
    chosen = materialize(reps.join(ids, "set", "left_semi").select("doc_id"))
    texts = docs.join(small(chosen), "doc_id", "left_semi").select("text").unionAll(docs.where("doc_id is null").select("text"))
    sets = materialize(_with_shingles(texts))
    sketches = sets.groupBy("set").agg(F.first("sketch").alias("sketch"))
    stars = leaders(first)
    # the pair of each set with the hub that has the most keys
    order = W.partitionBy("b").orderBy(F.desc("degree"), "a")
    one = stars.where("degree is not null").withColumn("r", F.row_number().over(order)).where("r = 1").select("a", "b")
    named = materialize(connected_components(verify(one, sets)))
    # the other leaders, of all choices at once: a pair that several choices or keys name is compared once
    drawn = lambda side: sketches.toDF(side, f"s{side}")
    rest = _apart(stars, named).join(drawn("a"), "a").join(drawn("b"), "b")
    named = _merged(named, verify(rest.where(sketch_distance("sa", "sb") * 9 <= F.col("na") + F.col("nb")), sets))
    # any two sets of different components under one key
    placed = first.select("key", "low", "set", "n").join(named.toDF("set", "component"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    open_ = materialize(_of_several_components(placed))
    open_ = open_.join(_common(sets, open_), "set").where(_enough(F.col("common"), F.col("n"), F.ceil(F.col("n") * 4 / 5)))
    lanes = lambda side: [F.col("sketch")[k].alias(f"{side}{k}") for k in range(SKETCH_BITS // 64)]
    left = _of_several_components(open_).join(sketches, "set").select("key", "low", "set", "n", "component", "common", *lanes("x"))
    left = materialize(left)
    right = left.toDF("key", "lowb", "b", "nb", "cb", "mb", *(f"y{k}" for k in range(SKETCH_BITS // 64)))
    bits = [F.bit_count(F.col(f"x{k}").bitwiseXOR(F.col(f"y{k}"))) for k in range(SKETCH_BITS // 64)]
    half, every = sum(bits[: len(bits) // 2], F.lit(0)), sum(bits, F.lit(0))
    # one side is in its own band; two such sets meet once
    across = (
        left.where("not low").toDF("key", "lowa", "a", "na", "ca", "ma", *(f"x{k}" for k in range(SKETCH_BITS // 64)))
        .join(right, "key")
        .where("ca <> cb and (lowb or a < b)")
        .where(could_be_similar("na", "nb"))
        .where(_enough(F.least("ma", "mb"), F.col("na"), F.col("nb")))
        .where((half * 9 <= F.col("na") + F.col("nb")) & (every * 9 <= F.col("na") + F.col("nb")))
        .select("a", "b", "ca", "cb", every.alias("distance"))
        .distinct()
    )
    across = materialize(across)
    # the closest pair of each two components first; what is in one component then needs no more
    nearest = across.groupBy("ca", "cb").agg(F.min_by(F.struct("a", "b"), F.struct("distance", "a", "b")).alias("p")).select("p.a", "p.b")
    named = _merged(named, verify(nearest, sets))
    return _merged(named, verify(_apart(across.join(nearest, ["a", "b"], "left_anti").drop("ca", "cb"), named), sets))


def _of_several_components(rows: DataFrame) -> DataFrame:
    """The rows whose key holds sets of more than one component."""
    mixed = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return rows.join(mixed, "key", "left_semi")


def _common(sets: DataFrame, open_: DataFrame) -> DataFrame:
    """``set, common``: how many shingles of each set in ``open_(set, n)`` stand in another one of them, too."""
    wanted = materialize(open_.select("set", "n").distinct())
    rows = sets.join(small(wanted.select("set")), "set", "left_semi").select("set", F.explode("shingles").alias("s"))
    alone = rows.groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.min("set").alias("set")).where("k = 1")
    alone = alone.groupBy("set").agg(F.count(F.lit(1)).alias("alone"))
    return wanted.join(alone, "set", "left").select("set", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))


def _enough(common: Column, na: Column, nb: Column) -> Column:
    """Whether sets of these sizes can be similar with no more than ``common`` shingles in common."""
    return common * 9 >= (na + nb) * 4


def _apart(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``pairs(a, b, ...)`` whose sets are in different components, with these as ``ca, cb``."""
    tagged = pairs.join(named.toDF("a", "ca"), "a", "left").join(named.toDF("b", "cb"), "b", "left")
    return tagged.withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")}).where("ca <> cb")


def _merged(named: DataFrame, pairs: DataFrame) -> DataFrame:
    """``named`` after the links ``pairs``: components of the components, so many links between two of them are one edge."""
    top = materialize(connected_components(_apart(pairs, named).select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
    if top.isEmpty():
        return named
    old = named.join(top.toDF("component", "new"), "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return materialize(old.unionByName(top.join(named, "node", "left_anti")))


def leaders(first: DataFrame) -> DataFrame:
    """``a, b, na, nb, degree``: each set ``b`` with the leaders ``a`` of each of its keys, if their sizes allow a link.
    ``degree``, the leader's number of shared keys, is null where only a random choice names the pair.

    The first choice is a key's set with the most shared keys: in a group of edited copies one of the least edited.
    The others are random (least hash of the set with a seed), so that a large group soon is one component. Leaders of
    the parts of a salted key meet in a second step.
    """
    degree = first.groupBy("set").agg(F.count(F.lit(1)).alias("degree"))
    ranked = first.select("key", "salt", "set", "n").join(degree, "set")
    choices = [F.desc("degree"), *(F.xxhash64("set", F.lit(r)) for r in range(1, LEADER_CHOICES))]

    def led(rows: DataFrame, by: list[str], orders: dict) -> DataFrame:
        window = lambda o: W.partitionBy(*by).orderBy(o, "set").rowsBetween(W.unboundedPreceding, W.currentRow)
        return rows.withColumns({name: F.first(F.struct("set", "n", "degree")).over(window(o)) for name, o in orders.items()})

    names = [f"lead{r}" for r in range(len(choices))]
    parts = materialize(led(ranked, ["key", "salt"], dict(zip(names, choices, strict=True))))
    both = parts.select("set", "n", F.array(*names).alias("leads"))
    for name, choice in zip(names, choices, strict=True):
        whole = parts.where(f"salt >= 0 and set = {name}.set").select("key", "salt", "set", "n", "degree")
        both = both.unionByName(led(whole, ["key"], {name: choice}).select("set", "n", F.array(*(F.col(name) if x == name else F.lit(None) for x in names)).alias("leads")))
    pairs = both.select("set", "n", F.posexplode("leads").alias("choice", "lead")).where("lead is not null").select(
        F.col("lead.set").alias("a"), F.col("set").alias("b"), F.col("lead.n").alias("na"), F.col("n").alias("nb"),
        F.when(F.col("choice") == 0, F.col("lead.degree")).alias("degree"),
    )
    pairs = pairs.where("a <> b").where(could_be_similar("na", "nb"))
    return materialize(pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.max("degree").alias("degree")))


def components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``."""
    members = materialize(set_table(docs))
    index = fit(docs, members.count())
    named = links(docs, members, index)
    release_shuffles(docs.sparkSession)
    reps = members.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("least"))
    placed = reps.join(named.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = placed.join(least, "component").select("set", "component_id")
    return members.join(of_set, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without those of a component whose ``doc_id`` isn't its least one.

    Rows without shingles or id stay; rows that repeat a ``doc_id`` are one document.
    """
    extra = materialize(components(docs).where("doc_id <> component_id").select("doc_id").distinct())
    return docs.join(extra, docs["doc_id"] == extra["doc_id"], "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    """Components of all documents under a five-word shingle similarity of at least 0.8."""
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
