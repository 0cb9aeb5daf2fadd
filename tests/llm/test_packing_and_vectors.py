"""Packing, whitening and clustering against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from odd_rows import empty, odd  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flightmart.llm import drift_clusters, packing, queries, whitening
from flightmart.llm._common import table

BYTES = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<float>, whitened string"
NAN = float("nan")


# --- packing -------------------------------------------------------------------


def plain_best_two_fit(items, window):
    """One piece and one sequence at a time."""
    left, bins = sorted(items, reverse=True), []
    while left:
        own, gap = [], window
        for x in list(left):
            if x <= gap:
                own.append(x)
                left.remove(x)
                gap -= x
        least = min(own)
        pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if least < a + b <= least + gap] if gap else []
        if pairs:
            _, a, b = max(pairs)
            own.remove(least)
            left.remove(a)
            left.remove(b)
            own += [a, b]
            left = sorted([*left, least], reverse=True)
        bins.append(sorted(own))
    return bins


@pytest.mark.parametrize("seed", range(60))
def test_planned_sequences_are_those_of_a_plain_loop(seed):
    r = random.Random(seed)
    window = r.choice([10, 30, 64])
    items = [r.randint(1, r.choice([window, window // 2])) for _ in range(r.randint(0, 120))]
    plan = packing.best_two_fit(Counter(items), window)
    made = [sorted(x for n, k in content.items() for x in [n] * k) for content, again in plan for _ in range(again)]
    assert made == plain_best_two_fit(items, window)


def test_two_pieces_replace_the_smallest():
    # 10 and 7 leave 3; 5 and 4 fill the place of the 7 and the gap better
    assert packing.best_two_fit({10: 1, 7: 1, 5: 1, 4: 1}, 20) == [({10: 1, 5: 1, 4: 1}, 1), ({7: 1}, 1)]
    assert packing.best_two_fit({11: 9, 7: 9, 5: 9, 4: 9}, 20)[0] == ({11: 1, 5: 1, 4: 1}, 9)
    assert packing.best_two_fit({9: 1, 5: 1, 4: 1, 2: 1}, 11) == [({9: 1, 2: 1}, 1), ({5: 1, 4: 1}, 1)]


@pytest.mark.parametrize("n, want", [(1, [0, 1]), (4, [0, 4]), (5, [0, 1, 5]), (8, [0, 4, 8]), (11, [0, 3, 7, 11])])
def test_only_the_first_piece_may_be_shorter(n, want):
    assert packing.cuts(n, 4) == want


def test_encoder_equals_the_library():
    library = Tokenizer.from_file(BYTES)
    texts = ["", " ", "a  b", "a \n b", "\n\na b\tc 's don't I'll x's 'S", "é ü ß 12ab 3.4 --- ...", "<|endoftext|> a", "漢字 x", " lead",
             "trail ", "a\n\n b", "a b c", "x" * 5000, "a\n\n\nb c\n", "\x01a b", "a\n \nb", "one\x0btwo three \x0cfour"]
    r = random.Random(5)
    texts += ["".join(r.choice(" \n\tab'é1.s") for _ in range(40)) for _ in range(300)]
    texts += ["".join(r.choice("ab'é1.s \n") + r.choice("xy") for _ in range(40)) for _ in range(300)]
    encoder = packing.Encoder(BYTES, memory=50)
    got = list(encoder.ids(texts))
    for text, ids in zip(texts, got):
        assert library.encode(text, add_special_tokens=False).ids == np.frombuffer(ids, "<u4").tolist(), repr(text)


def check_packing(rows, docs, window):
    """Pieces cover their documents, sequences have no gap and no overflow."""
    library = Tokenizer.from_file(BYTES)
    want = Counter()
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        at = packing.cuts(len(ids), window)
        for p, (a, b) in enumerate(zip(at, at[1:])):
            want[i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for held in inside.values():
        held.sort()
        ends = [o + n for o, n in held]
        assert [o for o, _ in held] == [0, *ends[:-1]] and ends[-1] <= window
    return len(inside)


@pytest.mark.parametrize("window", [7, 64, 2048])
def test_pack(spark, odd, window):
    docs = odd.select("doc_id", "text").union(spark.range(300).select("id", F.lit("one two three")))
    rows = packing.pack(docs, BYTES, window).collect()
    used = check_packing(rows, [tuple(r) for r in docs.collect()], window)
    assert used == len(plain_best_two_fit([r.length for r in rows], window))


def test_pack_ranks_in_chunks(spark):
    rows = spark.range(5000).select(F.col("id").alias("row"), (F.col("id") % 3).alias("length"))
    counts = {r.length: r["count"] for r in rows.groupBy("length").count().collect()}
    got = packing.ranked(rows, counts, chunk=100).collect()
    for length, n in counts.items():
        assert sorted(r.rank for r in got if r.length == length) == list(range(n))


def test_pack_query_and_empty(spark, empty):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    rows = [r for r in queries.op11_packing(spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()]
    used = check_packing(rows, [tuple(r) for r in docs], 2048)
    assert used <= sum(r.length for r in rows) // 2048 + 2
    assert packing.pack(empty, BYTES).columns == ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packing.pack(empty, BYTES).count() == 0


# --- whitening -----------------------------------------------------------------


def triangles():
    r = np.random.default_rng(1)
    turn = np.linalg.qr(r.normal(size=(32, 32)))[0]
    yield "normal", r.normal(size=(500, 32))
    yield "graded", r.normal(size=(500, 32)) * np.logspace(0, -5, 32)
    yield "fewer rows", r.normal(size=(9, 32))
    yield "equal", np.tile(turn, (3, 1))
    yield "clusters", np.linalg.qr(r.normal(size=(99, 32)))[0] @ np.diag([3.0] * 10 + [1.0] * 12 + [0.001] * 10) @ turn
    yield "dependent", r.normal(size=(99, 4)) @ r.normal(size=(4, 32))
    yield "constant entries", np.pad(r.normal(size=(99, 3)), ((0, 0), (2, 4)))
    yield "one", np.ones((5, 1))


@pytest.mark.parametrize("name, rows", list(triangles()), ids=[n for n, _ in triangles()])
def test_solver_equals_dense_singular_values(name, rows):
    d = rows.shape[1]
    square = np.zeros((d, d))
    r = np.linalg.qr(rows, mode="r")
    square[: len(r)] = r
    values, vectors = whitening.solve(square)
    want = np.linalg.svd(rows, compute_uv=False) ** 2
    want = want[want > 1e-20 * want[0]]
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-9, atol=0)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-10
    gram = rows.T @ rows
    assert np.abs(gram @ vectors.T - vectors.T * values).max() < 1e-12 * d * values[0]


def test_triangles_merge_like_one():
    r = np.random.default_rng(3)
    parts = [r.normal(size=(n, 6)) for n in (1, 2, 50, 7)]
    got = whitening.triangle([whitening.triangle([p]) for p in parts])
    whole = np.concatenate(parts)
    assert np.allclose(got.T @ got, whole.T @ whole)
    y = whitening.merged_scatter([whitening.scatter_of(p) for p in parts])
    assert np.allclose(y[2:], (whole - whole.mean(0)).T @ (whole - whole.mean(0))) and y[0, 0] == 60


def plain_whitening(vectors, components=32):
    x = np.floor(np.array(vectors, dtype=float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    y = (n * x - sums) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    whitened = y @ vectors[:, :components] / np.sqrt(values[:components])
    return ((n * x - sums) ** 2).sum(1), whitened, values[:components] / np.trace(cov)


def test_whitening_query_equals_dense_version(spark):
    rows = table(spark, SF_SMALL, "embeddings").orderBy("vec_id").collect()
    deviation, whitened, explained = plain_whitening([r.embedding for r in rows])
    got = defaultdict(dict)
    for r in queries.op12_whitening(spark, SF_SMALL).collect():
        got[r.vec_id][r.component] = r
    assert len(got) == len(rows)
    mine = np.array([[got[r.vec_id][c].whitened for c in range(1, 33)] for r in rows])
    sign = np.sign((mine * whitened).sum(0))
    assert np.abs(mine * sign - whitened).max() < 1e-9
    assert [got[r.vec_id][1].deviation for r in rows] == deviation.tolist()
    one = got[rows[0].vec_id]
    assert np.allclose([one[c].explained for c in range(1, 33)], explained, rtol=1e-10)
    assert one[1].identity_error < 1e-9 and one[1].n == len(rows)


ODD_VECTORS = [
    (1, [1.0, 2.0, 3.0], "x"), (2, [0.5, -1.0, 2.0], "x"), (2, [0.5, -1.0, 2.0], "x"), (None, [4.0, 0.0, -7.5], None), (3, None, "x"),
    (4, [], "x"), (5, [1.0, None, 2.0], "x"), (6, [1.0, NAN, 2.0], "x"), (7, [1.0, float("inf"), 2.0], "x"), (8, [1.0, 2.0], "x"),
    (9, [0.0, 0.0, 0.0], "x"),
]


def test_whitening_of_odd_rows(spark):
    rows = spark.createDataFrame(ODD_VECTORS, VECTORS)
    got = whitening.whiten(rows).collect()
    assert Counter(r.id for r in got) == {1: 3, 2: 6, None: 3, 9: 3} and {r.n for r in got} == {5}
    kept = [v for _, v, _ in ODD_VECTORS if v is not None and len(v) == 3 and None not in v and np.isfinite(v).all()]
    assert sorted({r.deviation for r in got}) == sorted(set(plain_whitening(kept)[0].tolist()))
    assert all(r.identity_error < 1e-9 for r in got)
    assert whitening.whiten(rows.where("vec_id = 2")).count() == 0 and whitening.whiten(rows.where("vec_id = 3")).count() == 0
    flat = spark.createDataFrame([(1, [1.0, 5.0, 1.0], ""), (2, [2.0, 5.0, 2.0], ""), (3, [9.0, 5.0, 9.0], "")], VECTORS)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
    large = spark.createDataFrame([(1, [3e12], ""), (2, [-3e12], "")], VECTORS)
    with pytest.raises(Exception, match="or more after scaling"):
        whitening.whiten(large).collect()
    wide = spark.createDataFrame([(1, [4e11, 1.0], ""), (2, [-4e11, 0.0], "")], VECTORS)
    assert {r.deviation for r in whitening.whiten(wide).collect()} == {None}


def test_partial_results_merge_in_levels(spark):
    rows = spark.range(0, 400, 1, 150).select("id", F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.xxhash64("id", i) % 1000).alias("x"))
    x = np.array([r.x for r in rows.collect()], dtype=float)
    got = whitening.folded(rows, lambda x: whitening.triangle([x.astype(float)]), whitening.triangle, "test_levels")
    assert np.allclose(got.T @ got, x.T @ x)


# --- clusters ------------------------------------------------------------------


def test_loosening_covers_every_vector_of_the_sphere():
    r = np.random.default_rng(0)
    share = []
    for _ in range(400):
        d = r.integers(1, 6)
        centre, old, new = r.normal(size=(3, d)) * r.choice([0.3, 1, 3])
        radius = 2 * r.random()
        x = r.normal(size=(2000, d))
        x = centre + x / np.sqrt((x**2).sum(1))[:, None] * radius * r.random((2000, 1)) ** 0.1
        falls = np.sqrt(((x - old) ** 2).sum(1)) - np.sqrt(((x - new) ** 2).sum(1))
        bound, drift = drift_clusters.loosening(centre, radius, old, new), np.sqrt(((new - old) ** 2).sum())
        assert falls.max() <= bound <= drift * (1 + 1e-8) + 1e-8
        share.append(bound / drift)
    assert np.mean(share) < 0.8  # full drift would be 1


def plain_clusters(rows, k, rounds, seed=2, scale=256):
    rows = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(rows, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in rows:
            groups[near(v)[1]].append(v)
        for j, held in groups.items():
            centroids[j] = [sum(x) // len(held) for x in zip(*held)]
    out = [(i, *near(v)) for i, v in rows]
    total = Counter()
    for _, d, c in out:
        total[c] += d
    sha = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return Counter((i, c, d, total[c], sum(total.values()), sha(c)) for i, d, c in out)


@pytest.mark.parametrize("k, rounds", [(1, 2), (4, 6), (12, 3)])
def test_clusters_equal_plain_rounds(spark, k, rounds):
    r = np.random.default_rng(k)
    centres = r.normal(size=(5, 3)) * 4
    points = [(i, [float(np.float32(x)) for x in centres[i % 5] + r.normal(size=3) * 0.3], "") for i in range(200)]
    rows = points + [ODD_VECTORS[3], *[(900 + i, [1.0, 1.0, 1.0], "") for i in range(60)], *ODD_VECTORS]
    df = spark.createDataFrame(rows, VECTORS)
    found = drift_clusters.fit(df, k, rounds, dimension=3)
    got = Counter(map(tuple, drift_clusters.with_inertia(found).collect()))
    usable = [(i, v) for i, v, _ in rows if v is not None and len(v) == 3 and None not in v and np.isfinite(v).all()]
    assert got == plain_clusters(usable, k, rounds)
    assert found.scanned[0] == len(usable) and (k == 1 or found.scanned[-1] < len(usable) / 2)


def test_clusters_edges(spark):
    rows = spark.createDataFrame(ODD_VECTORS, VECTORS)
    none = drift_clusters.with_inertia(drift_clusters.fit(rows.where("vec_id = 3"), dimension=3))
    assert none.count() == 0 and none.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    few = drift_clusters.with_inertia(drift_clusters.fit(rows, dimension=3)).collect()
    assert {r.distance for r in few} == {0} and len({r.cluster for r in few}) == 4
    with pytest.raises(Exception, match="or more after scaling"):
        drift_clusters.fit(spark.createDataFrame([(1, [1e6, 1.0, 1.0], "")], VECTORS), dimension=3)


def test_large_components_stay_exact():
    r = np.random.default_rng(7)
    x = r.integers(-(2**27) + 1, 2**27, size=(50, 64))
    c = r.integers(-(2**27) + 1, 2**27, size=(4, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c] for u in x]
    assert drift_clusters.squared(x, c).tolist() == want
