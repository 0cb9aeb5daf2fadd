"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds its distinct word shingles (64-bit hashes).  Equal
sets form a class, of which the smallest id goes on.  Banded signatures give
candidate buckets; a bucket never lists all its pairs:

1. Hubs.  Every class meets, out of the smallest ids of its buckets, the one
   that it shares most bands with.  One pair per class, whatever the size of
   a bucket.
2. Crossings.  Members of a bucket that are still in different components
   after the hubs' links meet in blocks: those outside the bucket's main
   component against all others, in the first band that a pair shares.
   Members of one component need no check, and of a pair of blocks only the
   links that join components are kept.

Both steps compare signatures batch by batch and drop a pair as soon as the
posterior probability that its similarity reaches the threshold falls below
the miss probability (uniform prior).  Of a crossing the parity of the number
of shingles in each of at least four slots per shingle then bounds the sets'
difference from below, which drops a pair below the threshold for certain
(a few that lie just under it stay).  Survivors are confirmed on full sets,
100 * |A and B| >= percent * |A or B|.

With 32 bands of 4 hashes a pair at similarity 0.8 has no bucket in common
with probability 5e-8.

Edge cases: a null or blank text has an empty set and is linked with
nothing; a text with fewer words than a shingle has its whole sequence as
one; rows with equal ids are one document, for which the set with the
smallest fingerprint stands; rows without an id have no links and a null
component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settings
from ._common import giving_back, likely, matched, quoted, stored
from .components import components

N_HASHES, BAND = 128, 4
BATCH = 16
BLOCK = 256
#: Slots of a set's parities are a power of two in this range; sets of more than a quarter of the upper end are pruned less.
LEAST_SLOTS, MOST_SLOTS = 64, 1 << 16
#: Words whose hashes a worker keeps at a time.
CACHED = 1 << 17
#: What a worker gets at a time: a pair of full blocks alone has some 400 kB, which Python's objects multiply.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, size: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles (A-Z lower-cased)."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(TO_LOWER).split()
    if len(cache) > CACHED:
        cache.clear()
    hashes = np.empty(len(found), dtype=np.uint64)
    for i, w in enumerate(found):
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh3_64_intdigest(w)
        hashes[i] = h
    n = min(size, len(found))
    if not n:
        return hashes
    out = np.full(len(found) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = (out ^ hashes[k : k + len(out)]) * MIX1
        out ^= out >> np.uint64(29)
        out *= MIX2
        out ^= out >> np.uint64(32)
    return np.unique(out)


def multipliers(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, N_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The high 32 bits of the smallest product with each multiplier."""
    low = np.full(N_HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        for k in range(0, N_HASHES, BATCH):
            np.minimum(low[k : k + BATCH], np.multiply.outer(by[k : k + BATCH], part).min(axis=1), out=low[k : k + BATCH])
    return (low >> np.uint64(32)).astype(np.uint32)


def parities(hashes: np.ndarray) -> np.ndarray:
    """One bit per slot: whether an odd number of the hashes falls into it."""
    slots = min(max(LEAST_SLOTS, 1 << (4 * len(hashes) - 1).bit_length()), MOST_SLOTS)
    odd = np.bincount((hashes & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def folded(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Parities of ``width`` words: halves are added until they fit, as slots
    are the low bits of a hash.  Rows with fewer words are left zero."""
    out = np.zeros((len(rows), width), dtype=np.uint64)
    for at, r in enumerate(rows):
        if len(r) >= width:
            out[at] = np.bitwise_xor.reduce(r.reshape(-1, width), axis=0)
    return out


def near_enough(
    a: list[np.ndarray], b: list[np.ndarray], sizes: tuple[np.ndarray, np.ndarray], percent: int, pairs: tuple[np.ndarray, np.ndarray]
) -> np.ndarray:
    """Which pairs (rows of a, rows of b) can reach the threshold: slots of
    different parity are at most the shingles that only one set holds."""
    i, j = pairs
    ok = np.ones(len(i), dtype=bool)
    if not len(i):
        return ok
    width = np.minimum(np.array([len(r) for r in a])[i], np.array([len(r) for r in b])[j])
    most = (sizes[0][i] + sizes[1][j]) * (100 - percent)
    for w in np.unique(width).tolist():
        x, y, of = folded(a, w), folded(b, w), np.nonzero(width == w)[0]
        step = max(1, (1 << 20) // w)
        for at in range(0, len(of), step):
            some = of[at : at + step]
            differ = np.bitwise_count(x[i[some]] ^ y[j[some]]).sum(axis=1, dtype=np.int64)
            ok[some] = differ * (100 + percent) <= most[some]
    return ok


def least_matches(percent: int, miss: float) -> list[int]:
    """Per batch: the fewest equal hashes so far with which a pair goes on,
    P(similarity >= threshold | matches) >= miss under a uniform prior."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    above, out = grid >= percent / 100, []
    for n in range(BATCH, N_HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(log - log.max())
            if p[above].sum() / p.sum() >= miss:
                break
        out.append(m)
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: list[int], pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (rows of a, rows of b) whose signatures pass every batch."""
    i, j = pairs
    equal = np.zeros(len(i), dtype=np.int64)
    for k, enough in enumerate(least):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        equal += (a[i, cut] == b[j, cut]).sum(axis=1)
        go = equal >= enough
        i, j, equal = i[go], j[go], equal[go]
    return i, j


def _signatures(percent: int, size: int):
    by = multipliers()

    @giving_back
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[bytes, int] = {}
        for b in batches:
            n, fp, sig, odd = [], [], [], []
            for t in b["text"]:
                s = shingle_set(t, size, cache)
                n.append(len(s))
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s, by).tobytes() if len(s) else None)
                odd.append(parities(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"id": b["id"], "n": n, "fp": fp, "sig": sig, "odd": odd})

    return of


def _sets(size: int):
    @giving_back
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[bytes, int] = {}
        for b in batches:
            sets = [shingle_set(t, size, cache).tobytes() for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "fp": [xxhash.xxh3_128_digest(s) for s in sets], "set": sets})

    return of


def _confirmed(percent: int):
    @giving_back
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = []
            for x, y in zip(b["set_a"], b["set_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.loc[ok, ["a", "b"]]

    return of


def _pruned_pairs(least: list[int]):
    @giving_back
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array([np.frombuffer(s, np.uint32) for s in b["sig_a"]]).reshape(-1, N_HASHES)
            y = np.array([np.frombuffer(s, np.uint32) for s in b["sig_b"]]).reshape(-1, N_HASHES)
            every = np.arange(len(b))
            i, _ = survivors(x, y, least, (every, every))
            yield b.iloc[i][["a", "b"]]

    return of


def _pruned_blocks(least: list[int], percent: int):
    """Per pair of blocks the pairs in different components, near enough in
    size, that pass the batches, meet in no earlier band and can reach the
    threshold by their parities."""

    @giving_back
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for left, right, same, k, key in zip(b["left"], b["right"], b["same"], b["k"], b["key"]):
                cols = []
                for side in (left, right):
                    cols.append(
                        (
                            np.array([r["id"] for r in side]),
                            np.array([r["n"] for r in side], dtype=np.int64),
                            np.array([r["comp"] for r in side]),
                            np.array([np.frombuffer(r["sig"], np.uint32) for r in side]),
                            [np.frombuffer(r["odd"], np.uint64) for r in side],
                        )
                    )
                (ia, na, ca, sa, oa), (ib, nb, cb, sb, ob) = cols
                got = []
                for at in range(0, len(ia), 64):
                    cut = slice(at, at + 64)
                    small, big = np.minimum.outer(na[cut], nb), np.maximum.outer(na[cut], nb)
                    ok = (ca[cut, None] != cb[None, :]) & (100 * small >= percent * big)
                    if same:
                        ok &= ia[cut, None] < ib[None, :]
                    i, j = survivors(sa[cut], sb, least, np.nonzero(ok))
                    if len(i):
                        shared = (sa[cut][i] == sb[j]).reshape(len(i), -1, BAND).all(axis=2)
                        first = shared.argmax(axis=1) == k
                        i, j = i[first], j[first]
                        near = near_enough(oa[cut], ob, (na[cut], nb), percent, (i, j))
                        i, j = i[near], j[near]
                        got.append((ia[cut][i], ib[j], ca[cut][i], cb[j]))
                if got and sum(len(g[0]) for g in got):
                    yield pd.DataFrame({"key": [key], **{c: [np.concatenate([g[x] for g in got])] for x, c in enumerate(("a", "b", "ca", "cb"))}})

    return of


def _confirmed_blocks(percent: int):
    """Links of a block pair that join components: a pair whose components
    an earlier one has joined needs no look at its sets."""

    @giving_back
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            links = []
            for left, right, ca, cb, sets in zip(rows["a"], rows["b"], rows["ca"], rows["cb"], rows["sets"]):
                own = {r["id"]: np.frombuffer(r["set"], np.uint64) for r in sets}
                up: dict[int, int] = {}

                def root(c: int, up: dict[int, int] = up) -> int:
                    while up.get(c, c) != c:
                        c = up[c]
                    return c

                for a, b, p, q in zip(left.tolist(), right.tolist(), ca.tolist(), cb.tolist()):
                    x, y = root(p), root(q)
                    if x != y:
                        both = len(np.intersect1d(own[a], own[b], assume_unique=True))
                        if 100 * both >= percent * (len(own[a]) + len(own[b]) - both):
                            up[max(x, y)] = min(x, y)
                            links.append((min(a, b), max(a, b), min(p, q), max(p, q)))
            yield pd.DataFrame(links, columns=["a", "b", "low", "high"])

    return of


def _bands(classes: DataFrame) -> DataFrame:
    """(k, band, id, n): every class in one bucket of each band k."""
    width = 4 * BAND
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width)) for k in range(N_HASHES // BAND)])
    return classes.select(F.posexplode(keys).alias("k", "band"), "id", "n")


def _likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows whose id is not in ``ids``."""
    return likely(docs, ids, "id", "__held").where("__held").drop("__held")


def _sets_of(ids: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(id, set) of the texts with these ids; of the others hardly any is shuffled."""
    # An inner join: a semi join would be pushed below the filter, with every text in its shuffle.
    some = _likely(docs.select("id", "text"), ids).join(ids.distinct(), "id")
    sets = some.mapInPandas(_sets(size), "id long, fp binary, set binary")
    return stored(sets.groupBy("id").agg(F.min(F.struct("fp", "set")).alias("own")).select("id", "own.set"), "near-sets")


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs that hold on full sets."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs, size)
    got = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    got = got.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    return stored(got.mapInPandas(_confirmed(percent), "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """(id, n_shingles, class_id, n_links, component_id) per row of ``docs``.

    ``class_id``: smallest id with the same set; ``n_links``: confirmed links
    of the class that the search needed; ``component_id``: smallest id that
    links can reach.
    """
    with settings(docs.sparkSession, BATCHES):  # every step that runs Python is stored in here
        return _near_duplicates(docs, id, text, size, percent, miss)


def _near_duplicates(docs: DataFrame, id: str, text: str, size: int, percent: int, miss: float) -> DataFrame:
    least = least_matches(percent, miss)
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    known = rows.where("id is not null")
    prints = stored(rows.mapInPandas(_signatures(percent, size), "id long, n long, fp binary, sig binary, odd binary"), "near-signatures")
    full = prints.where("fp is not null and id is not null")
    # Ids and fingerprints alone are shuffled to find which come more than once; of all other rows
    # no signature leaves its place.
    twins = full.groupBy("id").agg(F.min("fp").alias("own"), F.count("*").alias("k")).where("k > 1").select("id", "own")
    full = matched(full, stored(twins, "near-twins"), "id").where("own is null or own = fp").drop("own")
    repeated = stored(full.groupBy("fp").agg(F.count("*").alias("k")).where("k > 1").select("fp"), "near-repeated")
    seen = likely(full, repeated, "fp", "__may")
    several = seen.where("__may").groupBy("fp").agg(*[f(c).alias(c) for f, c in ((F.min, "id"), (F.first, "n"), (F.first, "sig"), (F.first, "odd"))])
    classes = stored(seen.where("not __may").select(several.columns).union(several), "near-classes")

    bands = _bands(classes)
    buckets = bands.groupBy("band").agg(F.min(F.struct("id", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    buckets = stored(buckets, "near-buckets")
    met = bands.join(buckets, "band").where("id <> hub.id and 100 * least(n, hub.n) >= %d * greatest(n, hub.n)" % percent)
    met = met.groupBy("id", F.col("hub.id").alias("hub")).agg(F.count("*").alias("bands"))
    best = met.groupBy(F.col("id").alias("b")).agg(F.max_by("hub", F.struct("bands", -F.col("hub"))).alias("a"))
    best = stored(best, "near-best")
    sigs = _likely(classes.select("id", "sig"), best.select(F.explode(F.array("a", "b")).alias("id")))
    pairs = best.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    pairs = pairs.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
    pairs = stored(pairs.mapInPandas(_pruned_pairs(least), "a long, b long"), "near-hubs")
    links = _confirm(pairs, known, percent, size)
    stars = stored(components(links).withColumnRenamed("node", "id"), "near-stars")

    labelled = matched(classes, stars, "id").withColumn("comp", F.coalesce("component", "id"))
    labelled = stored(labelled.select("id", "n", "sig", "odd", "comp"), "near-labelled")
    where = _bands(labelled.select("id", "n", "sig")).join(buckets.select("band", "size", F.col("hub.id").alias("hub")), "band")
    where = where.join(labelled.select("id", "comp"), "id").select("band", "k", "id", "comp", "hub", "size")
    mixed = where.groupBy("band").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.first("hub").alias("hub"), F.first("size").alias("size")
    )
    mixed = mixed.where("low <> high").join(labelled.select(F.col("id").alias("hub"), F.col("comp").alias("main")), "hub")
    members = where.drop("hub", "size").join(mixed.select("band", "main", "size"), "band")
    members = members.withColumn("minor", F.col("comp") != F.col("main"))
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK)))
    members = stored(members, "near-members")
    members = members.join(_likely(labelled.select("id", "n", "sig", "odd"), members.select("id")), "id")
    blocks = members.groupBy("band", "minor", "block").agg(F.first("k").alias("k"), F.collect_list(F.struct("id", "n", "comp", "sig", "odd")).alias("rows"))
    blocks = stored(blocks, "near-blocks")
    left = blocks.where("minor").select("band", F.col("block").alias("at"), F.col("rows").alias("left"))
    cross = left.join(blocks, "band").where("not minor or at <= block").withColumn("key", F.struct("band", "at", "minor", "block"))
    cross = cross.select("key", "k", "left", F.col("rows").alias("right"), (F.col("minor") & (F.col("at") == F.col("block"))).alias("same"))
    key = "key struct<band: long, at: long, minor: boolean, block: long>"
    arrays = "a array<long>, b array<long>, ca array<long>, cb array<long>"
    found = stored(cross.mapInPandas(_pruned_blocks(least, percent), f"{key}, {arrays}"), "near-crossings")
    ids = found.select("key", F.explode(F.array_distinct(F.concat("a", "b"))).alias("id"))
    sets = ids.join(_sets_of(ids.select("id"), known, size), "id").groupBy("key").agg(F.collect_list(F.struct("id", "set")).alias("sets"))
    more = found.join(sets, "key").select("a", "b", "ca", "cb", "sets").mapInPandas(_confirmed_blocks(percent), "a long, b long, low long, high long")
    # One link between two components is as good as many.
    more = more.groupBy("low", "high").agg(F.min(F.struct("a", "b")).alias("link")).select("link.a", "link.b")
    more = stored(more, "near-links")

    links = links.union(more).distinct()
    stars = components(links)
    n_links = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    classed = full.select("id", "fp").distinct().join(classes.select("fp", F.col("id").alias("class_id")), "fp").drop("fp")
    out = prints.select("id", F.col("n").alias("n_shingles")).join(classed, "id", "left")
    out = out.withColumn("class_id", F.coalesce("class_id", "id")).join(n_links, "class_id", "left")
    out = out.join(stars.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    unknown = rows.where("id is null").select("id", F.lit(None).cast("long").alias("n_shingles"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.select(
        "id", "n_shingles", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "class_id").alias("component_id")
    ).union(unknown)


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the smallest id of each
    component; of rows with one id, one; rows without an id stay."""
    found = near_duplicates(docs, id, text, size, percent).where("id is not null")
    kept = found.groupBy("id").agg(F.min("component_id").alias("low"), F.count("*").alias("copies"))
    others = kept.where("id <> low or copies > 1").select(F.col("id").alias("__id"), (F.col("id") == F.col("low")).alias("__kept"))
    others = stored(others, "near-others")
    # Texts are shuffled only where their id may be among those that go or come more than once.
    seen = likely(docs.withColumn("__id", F.col(f"`{id}`").cast("long")), others.select("__id"), "__id", "__may")
    seen = seen.withColumn("__may", F.col("__may") & F.col("__id").isNotNull())
    some = seen.where("__may").join(others, "__id", "left").where("coalesce(__kept, true)").dropDuplicates(["__id"])
    columns = [F.col(quoted(c)) for c in docs.columns]
    return seen.where("not __may").select(columns).union(some.select(columns))
