"""Near duplicates, fingerprints, site lines, mixing, LM scores, pipeline."""

import math
import warnings
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from odd_rows import empty, odd  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from flightmart.llm import _common, bpe, components, lm_scoring, mixing, near_dups, order_minhash, queries, site_lines, toxicity
from flightmart.llm._common import giving_back, table


def brute_components(rows, size):
    sets, up = {}, {}
    for i, t in rows:
        w = (t or "").encode().translate(near_dups.TO_LOWER).split()
        n = min(size, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            a, b = sets[x], sets[y]
            if x < y and a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = sorted((root(x), root(y)))
                up[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    base = [f"a{i}" for i in range(60)]
    cluster = [(10_000 + k, " ".join(base[:k] + ["z"] * (k % 4) + base[k:])) for k in range(60)]
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").union(spark.createDataFrame(cluster, "doc_id long, text string"))
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()], size)
    got = near_dups.near_duplicates(docs, size=size).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == want


def test_parities_never_drop_a_link():
    """Sets of all widths, among them more shingles than the most slots hold."""
    rng = np.random.default_rng(3)
    left, right = [], []
    for n in [1, 2, 15, 16, 17, 60, 400, 5_000, 40_000]:
        for share in (0.0, 0.5, 0.7, 0.79, 0.8, 0.81, 0.9, 1.0):
            both = round(n * share)
            own = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
            left.append(np.unique(own[:n]))
            right.append(np.unique(np.concatenate([own[:both], own[n:]]))[: max(1, n - n // 9)])
    a, b = [near_dups.parities(x) for x in left], [near_dups.parities(x) for x in right]
    assert {len(x) for x in a} > {1, 4, 32, 1024}
    i, j = (x.ravel() for x in np.indices((len(a), len(b))))
    sizes = (np.array([len(x) for x in left]), np.array([len(x) for x in right]))
    got = near_dups.near_enough(a, b, sizes, 80, (i, j))
    meet = np.array([len(np.intersect1d(left[x], right[y], assume_unique=True)) for x, y in zip(i, j)])
    linked = 100 * meet >= 80 * (sizes[0][i] + sizes[1][j] - meet)
    assert linked.any() and not (linked & ~got).any()
    # Of the pairs under 0.7 whose sizes and slots allow a verdict none stays.
    like = np.minimum(sizes[0][i], sizes[1][j]) >= 0.8 * np.maximum(sizes[0][i], sizes[1][j])
    low = like & (meet < 0.7 * (sizes[0][i] + sizes[1][j] - meet)) & (sizes[0][i] > 50) & (sizes[0][i] < 10_000)
    assert low.any() and not got[low].any()


def test_near_duplicates_of_a_large_group(spark):
    """A group whose pairs lie about the threshold: thousands of pairs pass the signatures, few are links."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    docs = []
    for k in range(900):
        words = list(base)
        for at in rng.choice(80, rng.integers(3, 8), replace=False):
            words[at] = f"x{rng.integers(0, 10_000)}"
        docs.append((k, " ".join(words)))
    want = brute_components(docs, 2)
    got = near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=2).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == want
    assert 1 < len({c for _, c in want.values()}) < 900


@pytest.mark.parametrize("budget", [None, 30_000.0])
def test_rake_equals_plain_loop(spark, budget):
    rng = np.random.default_rng(11)
    tokens = {(f"s{a}", f"l{b}"): int(rng.integers(1, 5_000)) for a in range(6) for b in range(4) if (a, b) != (5, 3)}
    goals = [{f"s{a}": 1 / 6 for a in range(6)}, {"l0": 0.4, "l1": 0.3, "l2": 0.2, "l3": 0.1}]
    weight, before = {c: float(n) for c, n in tokens.items()}, math.inf
    for _ in range(15):
        for _ in range(4):
            for d, goal in enumerate(goals):
                held = Counter()
                for c, w in weight.items():
                    held[c[d]] += w
                weight = {c: w * goal[c[d]] / held[c[d]] for c, w in weight.items()}
                if budget:
                    weight = {c: min(w, tokens[c] / budget) for c, w in weight.items()}
        off = max(abs(sum(w for c, w in weight.items() if c[d] == k) - share) for d, goal in enumerate(goals) for k, share in goal.items())
        if off <= 1e-6 or (budget and off >= 0.9 * before):
            break
        before = off
    cells = spark.createDataFrame([(*c, n) for c, n in tokens.items()], "__mix_source string, __mix_lang string, tokens long")
    targets = {d: spark.createDataFrame(list(g.items()), "category string, share double") for d, g in zip(("source", "lang"), goals)}
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        got = {(r[0], r[1]): r.weight for r in mixing.rake(cells, ["source", "lang"], targets, budget=budget).select("__mix_source", "__mix_lang", "weight").collect()}
    assert got.keys() == weight.keys() and all(math.isclose(got[c], weight[c], rel_tol=1e-9) for c in got)
    assert any(f"raking ends {off:.2g}" in str(w.message) for w in told) == (off > 1e-6)
    assert (off > 1e-6) == bool(budget)


def test_near_duplicates_edges(spark, odd, empty):
    got = {r.id: r for r in near_dups.near_duplicates(odd, size=2).collect()}
    assert got[4].component_id == got[5].component_id == 4 and got[6].component_id == got[7].component_id == 6
    assert (got[1].n_shingles, got[2].component_id, got[None].component_id) == (0, 2, None)
    kept = sorted(str(r.doc_id) for r in near_dups.keep_one(odd, size=2).collect())
    assert kept == ["1", "2", "3", "4", "6", "8", "None"]
    assert near_dups.near_duplicates(empty).count() == 0 and near_dups.keep_one(empty).count() == 0


def test_keep_one_shuffles_no_text_that_stays(spark):
    body = "concat_ws(' ', transform(sequence(1, 30), x -> concat('w', g * 100 + x)))"
    docs = spark.range(400).selectExpr("id as doc_id", "if(id % 10 = 9, id - 1, id) as g").selectExpr("doc_id", f"{body} as text")
    again = spark.createDataFrame([(7, "other text of the same id"), (8, None), (8, None), (None, "no id"), (None, "no id")], "doc_id long, text string")
    out = near_dups.keep_one(docs.union(again), size=2)
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter([*[i for i in range(400) if i % 10 != 9], None, None])
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [i for i, line in enumerate(plan) if "Join LeftOuter, (__id#" in line]
    assert joins
    for i in joins:
        deep = len(plan[i]) - len(plan[i].lstrip(" :+-"))
        side = [j for j in range(i + 1, len(plan)) if len(plan[j]) - len(plan[j].lstrip(" :+-")) <= deep + 3]
        assert any("getbit" in line for line in plan[side[0] : side[1]])


def test_matched_is_a_left_join(spark):
    rows = spark.createDataFrame([(i if i % 9 else None, str(i)) for i in range(300)], "id long, s string")
    few = spark.createDataFrame([(3, 6.0), (3, 7.0), (7, None), (500, 1.0)], "id long, x double")
    got = _common.matched(rows, few, "id")
    assert got.columns == ["id", "s", "x"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, rows.join(few, "id", "left").collect()))


def test_components_of_a_long_path(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(edges.union(spark.createDataFrame([(900, 901)], "a long, b long"))).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_order_minhash_pairs_and_edges(spark, odd, empty):
    docs = table(spark, SF_SMALL, "documents")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in order_minhash.edited_likeness(docs).collect()}
    import hashlib

    for k, (i, text) in enumerate(rows):
        q, nxt = len(text) // 4, rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - q] + nxt[:q]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    prints = {}
    for i, text in rows:
        assert prints.setdefault(text, got[i].fingerprint) == got[i].fingerprint
    long = [r for r in got.values() if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) > 0.25 > np.mean([r.near_next for r in long])
    odd_got = order_minhash.edited_likeness(odd).collect()
    assert len(odd_got) == odd.count() and all(0 <= r.near_edited <= 1 for r in odd_got)
    assert order_minhash.edited_likeness(empty).count() == 0
    one = order_minhash.edited_likeness(odd.where("doc_id = 6")).collect()[0]
    assert one.near_next == 1


def test_order_minhash_equals_plain_version(spark):
    """Without hashes' values: equal components are equal tuples, by a plain model of the choice."""
    frame = spark.createDataFrame([("a b c a b c a b d",), ("a b c a b c a b d",), ("d b a c b a c b a",), ("a",), ("",)], "text string")
    parts = [r.p for r in frame.select(order_minhash.components(F.col("text")).alias("p")).collect()]
    assert parts[0] == parts[1] and not set(parts[0]) & set(parts[2])
    assert len(parts[3]) == 1 and parts[4] == []


def test_site_lines_edges(spark, odd, empty):
    rows = [(i, f"menu\nbody {i}\nmenu\n\n", "en", "host", 1) for i in range(12)] + [(20, "menu", "en", "host", 1), (21, "menu", "en", None, 1)]
    docs = spark.createDataFrame(rows, odd.drop("score").schema)
    got = {r.doc_id: r for r in site_lines.drop_boilerplate(docs.withColumn("n_dropped_lines", F.lit("x"))).collect()}
    assert (got[3].text, got[3].n_dropped_lines) == ("body 3\n\n", 2)
    assert (got[20].text, got[21].text) == ("", "menu")
    assert site_lines.drop_boilerplate(odd).count() == odd.count() and site_lines.drop_boilerplate(empty).count() == 0


def test_raking_meets_targets(spark):
    cells = [("a", "x", 900), ("a", "y", 50), ("b", "x", 30), ("b", "y", 20), (None, "y", 5)]
    counted = spark.createDataFrame(cells, "__mix_s string, __mix_l string, tokens long")
    goal = lambda rows: spark.createDataFrame(rows, "category string, share double")
    targets = {"s": goal([("a", 0.5), ("b", 0.4), (None, 0.1), ("absent", 9.0)]), "l": goal([("x", 0.6), ("y", 0.4)])}
    got = mixing.rake(counted, ["s", "l"], targets).collect()
    for at, want in (("__mix_s", {"a": 0.5, "b": 0.4, None: 0.1}), ("__mix_l", {"x": 0.6, "y": 0.4})):
        sums = Counter()
        for r in got:
            sums[r[at]] += r["weight"]
        assert all(math.isclose(sums[k], v, abs_tol=1e-5) for k, v in want.items())


def test_mix_samples_at_its_rates(spark, odd, empty):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    dims = {"lang": "lang", "topic": mixing.topic()}
    got = mixing.mix(docs, dims, power=0.5).collect()
    assert got == mixing.mix(docs, dims, power=0.5).collect() or len(got) == mixing.mix(docs, dims, power=0.5).count()
    assert len({r.doc_id for r in got}) == len(got) < docs.count()
    assert abs(sum(1 / r.keep_rate for r in got) / docs.count() - 1) < 0.35
    assert set(mixing.mix(odd, {"source": "source"}).columns) == {*odd.columns, "keep_rate"}
    assert mixing.mix(empty, {"source": "source"}).count() == 0


def test_lm_scores_equal_plain_version(spark, odd, empty):
    rows = [(1, "abab abab", True), (2, "xyxy xyxy", False), (3, "abxy", None), (4, "", True), (5, None, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, is_target boolean")
    weights = (0.2, 0.5)
    model = lm_scoring.fit(docs, "is_target", min_count=1, weights=weights)
    got = {r.doc_id: r for r in lm_scoring.score(docs, model).collect()}

    def loss(text, corpus):
        one, two, before = Counter(), Counter(), Counter()
        for t in corpus:
            s = "^" + t
            one.update(t)
            two.update(zip(s, s[1:]))
            before["^"] += 1
            before.update(t)
        size, total = len(set("abxy ")) + 2, sum(one.values())
        p = []
        for a, b in zip("^" + text, text):
            share = min(1, two[a, b] / before[a]) if before[a] else 1 / size
            p.append(0.3 / size + 0.2 * (one[b] / total if total else 1 / size) + 0.5 * share)
        return -sum(map(math.log, p)) / len(p)

    texts = [t for _, t, _ in rows if t]
    for i in (1, 2, 3):
        t = rows[i - 1][1]
        assert got[i].target_loss == pytest.approx(loss(t, texts[:1]), rel=1e-5)
        assert got[i].background_loss == pytest.approx(loss(t, texts), rel=1e-5)
    assert (got[4].n_tokens, got[5].score) == (0, None) and got[1].score < 0 < got[2].score
    alone = {r.doc_id: r for r in lm_scoring.score(docs, model, counted="is_target").collect()}
    for i in (1, 2, 3):
        t = rows[i - 1][1]
        rest = [x for x in texts if x != t]
        assert alone[i].background_loss == pytest.approx(loss(t, rest), rel=1e-5)
        assert alone[i].target_loss == pytest.approx(loss(t, texts[:1] if i > 1 else []), rel=1e-5)
    odd_got = lm_scoring.score(odd, model).collect()
    assert len(odd_got) == odd.count()
    nothing = lm_scoring.fit(empty.withColumn("is_target", F.lit(True)), "is_target")
    assert lm_scoring.score(empty, nothing).count() == 0


def test_target_ids_are_all_of_them(spark):
    n = 450_000
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    odd = spark.createDataFrame([(0, 1, 0), (None, 1, 0), (n, 0, 0), (n + 1, 1, 1), (n + 2, None, 0)], "doc_id long, quality int, toxic int")
    got = queries.target_ids(labels.union(odd))
    assert got.agg(F.count("*"), F.countDistinct("doc_id"), F.max("doc_id")).first() == (n, n, n - 1)
    assert got.columns == ["doc_id", "is_target"]


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert 0 < docs.count() <= before.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    nothing = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF_SMALL).count() == 0


def test_queries_are_registered(spark):
    import __spark_entry__

    assert {*queries.QUERIES, "pipeline"} <= __spark_entry__.queries().keys()
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_bitmap_filter_keeps_every_wanted_id(spark):
    docs = spark.range(-3000, 3000).selectExpr("id", "cast(id as string) as text")
    ids = docs.where("id % 7 = 0").select("id")
    got = {r.id for r in near_dups._likely(docs, ids.union(ids)).collect()}
    wanted = {r.id for r in ids.collect()}
    assert wanted <= got and len(got) < len(wanted) + 10
    assert near_dups._likely(docs, ids.limit(0)).count() == 0


def test_mix_is_not_set_by_one_stray_row(spark):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents").select("doc_id", "text", "lang", "source")
    dims = {"source": "source", "lang": "lang"}
    stray = docs.union(spark.createDataFrame([(-1, "x", "odd", "odd")], docs.schema))
    plain, other = mixing.mix(docs, dims).collect(), mixing.mix(stray, dims).collect()
    assert len(other) > 0.97 * len(plain)
    assert all(r.keep_rate == pytest.approx(1) for r in other if r.lang == "odd")


def test_raking_under_a_budget(spark):
    cells = [("a", "x", 900), ("a", "y", 500), ("b", "x", 300), ("b", "y", 400), ("stray", "y", 1)]
    counted = spark.createDataFrame(cells, "__mix_s string, __mix_l string, tokens long")
    goal = lambda rows: spark.createDataFrame(rows, "category string, share double")
    targets = {"s": goal([("a", 0.49), ("b", 0.49), ("stray", 0.02)]), "l": goal([("x", 0.5), ("y", 0.5)])}
    got = {(r["__mix_s"], r["__mix_l"]): r.weight for r in mixing.rake(counted, ["s", "l"], targets, budget=1000.0).collect()}
    assert all(got[s, l] <= n / 1000 + 1e-9 for s, l, n in cells) and got["stray", "y"] == pytest.approx(0.001)
    assert got["a", "x"] + got["b", "x"] == pytest.approx(0.5, abs=1e-4)
    assert sum(got.values()) == pytest.approx(1, abs=1e-4)


def test_target_marks_shuffle_no_other_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(k, str(k)) for k in (1, 2, 2, 3, None, -4)] + [(5, None)], "doc_id long, text string")
    targets = queries.target_ids(spark.createDataFrame([(2, 1, 0), (5, 1, 0), (9, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int"))
    out = queries.marked(docs, targets)
    got = sorted(((r.doc_id, r.text, r.is_target) for r in out.collect()), key=str)
    wanted = [(1, "1", None), (2, "2", True), (2, "2", True), (3, "3", None), (None, "None", None), (-4, "-4", None), (5, None, True)]
    assert got == sorted(wanted, key=str)
    assert queries.marked(docs, targets.limit(0)).where("is_target is null").count() == 7
    # With hardly any bits most ids are in doubt; the join then tells them apart.
    monkeypatch.setattr(_common, "FILTER_BITS", 2)
    assert sorted(((r.doc_id, r.text, r.is_target) for r in queries.marked(docs, targets).collect()), key=str) == got
    monkeypatch.undo()
    # A join that shuffles texts gets the few rows whose ids both bitmaps let through.
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 500).alias("text")).localCheckpoint()
    few = targets.union(spark.range(100, 200).select("id", F.lit(True)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries.marked(many, few)
        assert plan.where("is_target").count() == 103
        text = plan._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = text.split("Join LeftOuter, (doc_id")[1]
    assert "getbit" in join.split("\n")[1] + join.split("\n")[2], text
    assert plan.where("is_target").agg(F.min("doc_id"), F.max("doc_id")).first() == (2, 199)


def test_losses_leave_the_scratch_counts_at_zero(spark):
    docs = spark.createDataFrame([(1, "abab abab", True), (2, "xyxy", False)], "doc_id long, text string, is_target boolean")
    model = lm_scoring.fit(docs, "is_target", min_count=1, slots=64)
    own = np.zeros(len(model.target), dtype=np.float32)
    for text, counted in (("abab abab", True), ("xyxy", False), ("abab abab", True)):
        assert lm_scoring.losses(text, model, counted, own) == lm_scoring.losses(text, model, counted)
        assert not own.any()


def test_near_copy_workers_get_small_batches(spark, monkeypatch):
    docs = spark.range(3_000).selectExpr("id", "concat('the same words ', id div 2, ' make a copy') as text").coalesce(1)
    of = near_dups._signatures(80, 2)

    def checked(batches):
        def small():
            for b in batches:
                assert len(b) <= 1000
                yield b

        return of(small())

    monkeypatch.setattr(near_dups, "_signatures", lambda percent, size: checked)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = near_dups.near_duplicates(docs, "id", size=2)
    assert found.count() == 3_000 and found.where("component_id <> id").count() >= 1_500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_workers_give_freed_memory_back():
    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * 4096 / 1e6

    kept = []

    @giving_back
    def of(batches):
        rows = [np.zeros(120) for _ in range(100_000)]
        kept.append(np.zeros(120))  # lies above the rows, so that the heap can't shrink by itself
        yield resident() + 0 * len(rows)

    _common.give_back()  # what earlier tests freed
    (most,) = of([])
    assert resident() < most - 60
    path = queries.tokenizer_path()
    for step in (
        near_dups._signatures(80, 5), near_dups._sets(5), near_dups._pruned_pairs([]), near_dups._confirmed(80), near_dups._pruned_blocks([], 80),
        near_dups._confirmed_blocks(80), bpe._whole(path), bpe._leaves(path), toxicity.count_words,
    ):
        assert step.__wrapped__ is not step
