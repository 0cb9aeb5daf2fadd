"""Tokens, chat, HTML, line labels and toxicity against plain versions."""

import hashlib
import json
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from odd_rows import empty, odd  # noqa: F401
from pyspark.sql import functions as F

from flightmart.llm import bpe, chat, html_text, line_crf, queries, toxicity
from flightmart.llm._common import table


def test_bpe_equals_library(spark, odd, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    docs = odd.select("doc_id", "text").union(table(spark, SF_SMALL, "documents").select("doc_id", "text"))
    got = bpe.encode(docs, queries.tokenizer_path(), leaf=1000).collect()
    want = []
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), np.array(ids, dtype="<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r.id), bytes(r.ids), r.decoded) for r in got) == sorted(want)
    assert bpe.encode(empty, queries.tokenizer_path()).count() == 0


def test_tree_concatenation_on_hard_strings(monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 64)
    e, rnd = bpe.Encoder(queries.tokenizer_path()), random.Random(5)
    parts = ["a", "the", "'s", "'", "--", "é", "é", "́", "İ", "Σ", "中", "12", "🙂", "<|endoftext|>", "<|", "|>", "\xa0", "\x1c", " ", "\n", "!!!"]
    for _ in range(300):
        some = rnd.sample(parts, rnd.randint(1, 6))
        text = "".join(rnd.choice(some) for _ in range(rnd.randint(0, 500)))
        n = rnd.randint(1, 7)
        edges = [len(text) * i // n for i in range(n)] + [len(text)]
        leaves = [bpe.unpacked(bpe.packed(e.pieces(text[a:b], a), a), a) for a, b in zip(edges, edges[1:])]
        want = e.plain(text).ids
        assert [i for p in bpe.join_leaves(text, edges, leaves, e) for i in p[2]] == want
        assert np.frombuffer(e.ids([text])[0], "<u4").tolist() == want


def test_bpe_leaf_equals_its_pieces():
    e, rnd = bpe.Encoder(queries.tokenizer_path()), random.Random(6)
    parts = ["a", "The", "'S", "it's", "--", "É", "Ärger", "12", "×", " ", "  ", "\n", "\t\x0b", "<|EndOfText|>", "x" * 600, "İ", "中", "<|endoftext|>", ""]
    for k in range(300):
        some = rnd.sample(parts[:14] if k % 2 else parts, rnd.randint(1, 6))
        text = "".join(rnd.choice(some) for _ in range(rnd.randint(0, 60)))
        assert e.leaf(text, 7) == bpe.packed(e.pieces(text, 7), 7)


def test_bpe_tasks_hold_one_small_batch(spark):
    path = queries.tokenizer_path()
    n, text = 300, "the cat sat on the mat " * 40
    rows = pa.RecordBatch.from_pydict({"id": list(range(n)), "key": ["k"] * n, "leaf": [0] * n, "start": [0] * n, "part": [text] * n})
    got = list(bpe._leaves(path)([rows]))
    assert sum(b.num_rows for b in got) == n and max(b.num_rows for b in got) <= 64
    assert list(bpe._leaves(path)([])) == list(bpe._whole(path)([])) == []
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    try:
        docs = spark.createDataFrame([(None, "b " * 20_000)] * 3 + [(k, "a " * 20_000) for k in range(9)], "doc_id long, text string")
        for own, then in (("64m", 4 << 20), ("1000", 1000)):
            spark.conf.set(limit, own)
            out = bpe.encode(docs, path)
            assert int(spark.conf.get(limit)) == then
        # Copies of a text under many ids do not meet in one task.
        assert "hashpartitioning(id" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.id is None, r.id or 0, r.n_tokens) for r in out.collect()) == [(False, k, 20_000) for k in range(9)] + [(True, 0, 20_000)] * 3
    finally:
        spark.conf.set(limit, before)


def test_bpe_keeps_short_runs_up_to_a_number():
    e = bpe.Encoder(queries.tokenizer_path(), memory=200)
    texts = [" ".join(f"{stem}{k}{stem * 40 if k % 50 == 0 else ''}" for k in range(at, at + 100)) for at in range(0, 1000, 100) for stem in ("ab", "é中")]
    assert [np.frombuffer(i, "<u4").tolist() for i in e.ids(texts)] == [e.plain(t).ids for t in texts]
    for t in texts:
        assert [i for p in e.pieces(t, 0) for i in p[2]] == e.plain(t).ids
        assert bpe.unpacked(e.leaf(t, 3), 3) == e.pieces(t, 3)
    kept = [*e.known, *e.parts, *e.runs]
    assert 0 < len(kept) <= 700 and max(len(k if isinstance(k, str) else k.decode()) for k in kept) <= bpe.KEPT


def test_chat_round_trip():
    rnd = random.Random(1)
    parts = ["<", "\\", "|", chat.END, chat.START, "\n", "a", "n"]
    for _ in range(3000):
        turns = [(rnd.choice(["user", "assistant", "a\\b\n<|"]), "".join(rnd.choices(parts, k=rnd.randint(0, 8)))) for _ in range(3)]
        text, spans = chat.render(turns)
        assert chat.read_back(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [x for r, x in turns if r == "assistant"]


def test_chat_layouts_and_edges(spark):
    known = {
        '{"prompt": "p", "completion": "c"}': [("user", "p"), ("assistant", "c")],
        '{"instruction": "i", "output": "o"}': [("user", "i"), ("assistant", "o")],
        '{"system": "s", "instruction": "i", "output": "o"}': [("system", "s"), ("user", "i"), ("assistant", "o")],
        '{"messages": [{"role": "user", "content": null}]}': [("user", "")],
        '{"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}]}': [("user", "x"), ("assistant", "y")],
        '{"other": 1}': None,
        "no json": None,
        None: None,
    }
    rows = spark.createDataFrame([(k, "mine") for k in known], "record string, mapping string")
    got = chat.formatted(chat.canonical(rows)).collect()
    assert {r.record: r.turns and [tuple(t) for t in r.turns] for r in got} == known
    assert chat.canonical(rows.limit(0)).count() == 0


def test_chat_roles_that_look_like_several(spark):
    rows = [(1, 0, "user,assistant", "a"), (2, 0, "system,user,assistant", None), (3, 0, "user", "b"), (3, 1, "assistant", "c"), (4, 0, None, ""), (None, 0, "user", "d")]
    turns = spark.createDataFrame([(*r, "mine") for r in rows], "conv_id long, turn long, role string, text string, id string")
    got = {r.id: r for r in chat.digests(chat.formatted(chat.canonical(chat.as_records(turns)))).collect()}
    want = {}
    for i, _, role, text in rows:
        want[i] = want.get(i, "") + f"{role or ''}\n{text or ''}\n"
    assert {i: r.turns_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_chat_query_against_rows(spark):
    turns = {}
    for r in table(spark, SF_SMALL, "conversations").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    turns[-1] = [(0, "user", queries.CONTROL), (1, "assistant", queries.CONTROL)]
    got = {r.conv_id: r for r in queries.op2_chat(spark, SF_SMALL).collect()}
    assert got.keys() == turns.keys()
    for c, rows in turns.items():
        rows.sort()
        loss = "".join(x for _, r, x in rows if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(rows), chat._sha("".join(f"{r}\n{x}\n" for _, r, x in rows)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), chat._sha(loss))


def test_html_keeps_article_only(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>home</a></nav>"
        "<div class=cookie-notice>We use cookies</div><div id=main><article><h1>Head &amp; line</h1><p>First,  with\n commas, and <b>bold</b> text.<br>more"
        "<p>Second unclosed &#233;<ul><li>item one<li>item two</ul><script>var x = '<p>no</p>';</script><form>ask</form></article>"
        "<div class='comments'><p>reader, says, things, at, length</p></div></div><aside>side</aside><footer>foot</footer></body>"
    )
    want = "Head & line\nFirst, with commas, and bold text. more\nSecond unclosed é\nitem one\nitem two"
    rows = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<<p a='>broken"), (5, "<div>" * 5000 + "deep")], "page_id long, html string")
    got = {r.page_id: r.text for r in html_text.extract(rows.withColumn("text", F.lit(0))).collect()}
    assert (got[1], got[2], got[3], got[5]) == (want, "", "", "deep")
    assert html_text.extract(rows.limit(0)).count() == 0


def brute_base(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    symbols = sum(c in "#*$%&|<>" for c in text)
    n = len(words)
    return n, sum(len(w.decode()) for w in words), symbols, len(lines) - len(set(lines)), len(inside), n < 20 or 100 * len(inside) > 30 * n


def test_line_base_counts_and_edges(spark, odd, empty):
    rnd = random.Random(2)
    for _ in range(200):
        text = "".join(rnd.choice(["a ", "b ", "c\n", "d\x0b", "# ", "é|", "\n\n"]) for _ in range(rnd.randint(0, 80)))
        assert line_crf.base_counts(text) == brute_base(text)
    crf = line_crf.train([], [], line_crf.Params())
    got = line_crf.judge(odd, crf).collect()
    assert len(got) == odd.count() and "score" in got[0].asDict()
    assert line_crf.judge(empty, crf).count() == 0


def test_crf_gradient_and_viterbi():
    rng = np.random.default_rng(0)
    crf = line_crf.Crf(rng.normal(size=(line_crf.N_FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    rows = [rng.normal(size=(n, line_crf.N_FEATURES)) for n in (1, 3, 4)]

    def score(r, y):
        e = r @ crf.emit
        return crf.first[y[0]] + sum(e[t, y[t]] for t in range(len(y))) + sum(crf.move[a, b] for a, b in zip(y, y[1:]))

    paths = [[tuple(np.unravel_index(k, (2,) * len(r))) for k in range(2 ** len(r))] for r in rows]
    for r, p, got in zip(rows, paths, line_crf.viterbi(crf, rows)):
        assert tuple(got) == max(p, key=lambda y: score(r, y))
    x, sizes = line_crf.padded(rows)
    y = np.ones((3, 4), dtype=int)

    def likelihood():
        return sum(score(r, (1,) * len(r)) - np.log(sum(np.exp(score(r, q)) for q in p)) for r, p in zip(rows, paths))

    emit, move, first = line_crf.gradient(crf, x, sizes, y)
    for w, g in ((crf.emit, emit), (crf.move, move), (crf.first, first)):
        at = (0,) * w.ndim
        before = likelihood()
        w[at] += 1e-5
        assert (likelihood() - before) / 1e-5 == pytest.approx(g[at], abs=1e-3)
        w[at] -= 1e-5


def test_lines_of_one_text_get_labels_of_their_own(spark):
    """Rows carry one label each; a text half boilerplate, half content comes out near one half."""
    r = np.random.default_rng(4)
    content = lambda: " ".join(r.choice(["walking", "river", "the", "evening", "of", "quiet", "letters"], 18)).capitalize() + "."
    menu = lambda: " | ".join(r.choice(["HOME", "LOGIN", "SHARE", "MENU"], 3))
    texts, labels = [], []
    for k in range(300):
        good = k % 2
        own = [content() if good else menu() for _ in range(8)]
        for at in range(2):  # every row has some lines of the other kind
            own[3 * at + k % 3] = menu() if good else content()
        texts.append("\n".join(own))
        labels.append(good)
    crf = line_crf.train([line_crf.features(t)[0] for t in texts], labels, line_crf.Params())
    half = "\n".join([menu() for _ in range(20)] + [content() for _ in range(20)])
    (found,) = line_crf.viterbi(crf, [line_crf.features(half)[0]])
    assert found.tolist() == [0] * 20 + [1] * 20
    docs = spark.createDataFrame([(1, half), (2, content()), (3, menu())], "doc_id long, text string")
    share = {x.doc_id: x.content_share for x in line_crf.judge(docs, crf).collect()}
    assert share[2] == 1 and share[3] == 0 and 0.5 < share[1] < 0.95
    # the row's side keeps more than half of its lines, whatever the emissions say
    rows = line_crf.features(half)[0]
    for y in (0, 1):
        for n in range(1, 8):
            own = line_crf.line_labels(crf, rows[:n], y)
            assert (own == y).sum() > n / 2


def test_line_verdict_held_out(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    labels = table(spark, sf, "labels").where(queries.held_out()).select("doc_id", "quality")
    got = queries.op3_line_crf(spark, sf).join(labels, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in got]) > 0.9


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(700):
        terms = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        w = rng.random(len(terms))
        rows.append((terms, w / np.linalg.norm(w)))
    index = toxicity.BlockMaxIndex(30, 32, [str(i) for i in range(700)], np.ones((700, 2)), rows)
    dense = np.zeros((700, 30))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    queries_ = [*rows[:60], (np.zeros(0, dtype=int), np.zeros(0))]
    cosines, examples = index.search(queries_, 10)
    for (t, w), got, who in zip(queries_, cosines, examples):
        q = np.zeros(30)
        q[t] = w
        want = np.round(dense @ q, 12)
        best = np.argsort(-want, kind="stable")[:10]
        assert np.allclose(got, want[best], atol=1e-11)
        assert who[got > 0].tolist() == best[want[best] > 0].tolist()
    none = toxicity.BlockMaxIndex(1, 32, [], np.zeros((0, 2)), [])
    assert none.search(queries_[:0], 3)[0].shape == (0, 3) and not none.search([rows[0]], 3)[0].any()


def test_search_expands_one_query_at_a_time(monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(400):
        w = rng.random(6)
        rows.append((np.sort(rng.choice(90, 6, replace=False)), w / np.linalg.norm(w)))
    index = toxicity.BlockMaxIndex(90, 16, [str(i) for i in range(400)], np.ones((400, 2)), rows)
    want, sizes = index.search(rows[:64], 8, 1), []
    ranges = toxicity.ranges
    monkeypatch.setattr(toxicity, "ranges", lambda starts, n: sizes.append((len(n), int(n.sum()))) or ranges(starts, n))
    got = index.search(rows[:64], 8, 64)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))
    runs, postings = (np.array(x) for x in zip(*sizes[1:]))  # the first expands terms to pairs
    held = np.bincount(np.concatenate([t for t, _ in rows]), minlength=90)
    assert postings.max() <= max(int(held[t].sum()) for t, _ in rows[:64])
    assert runs.sum() < sizes[0][1] / 2  # a term's blocks go together


def test_words_without_a_pattern():
    every = [chr(c) for c in range(0x3000)] + ["\ud800", "\U0001f600", "\U00010400"]
    for c in every:
        text = f"A{c}b {c}{c} \xc9t\xe9_1"
        assert toxicity.words(text) == toxicity.WORD.findall(text.lower())
    assert toxicity.words(None) == toxicity.words("") == []


def test_words_are_hashed_once_for_many_texts(monkeypatch):
    texts = [f"one two two three w{i % 3}" for i in range(1000)] + ["", None]
    seen, hashed = [], toxicity.hashed
    monkeypatch.setattr(toxicity, "hashed", lambda found: seen.extend(found) or hashed(found))
    batches = [pd.DataFrame({"text": texts[:600]}), pd.DataFrame({"text": texts[600:]})]
    out = pd.concat(toxicity.count_words(iter(batches)))
    assert sorted(seen) == ["one", "three", "two", "w0", "w1", "w2"]
    assert out.loc[~out["word_row"], "n"].tolist() == [1002]
    want = {"one": 1000, "two": 1000, "three": 1000, "w0": 334, "w1": 333, "w2": 333}
    assert dict(zip(out["word"], out["n"])) | {0: 0} == {int(hashed([w])[0]): n for w, n in want.items()} | {0: 0}
    monkeypatch.setattr(toxicity, "COUNTED", 2)
    again = pd.concat(toxicity.count_words(iter(batches)))
    assert again.sort_values("word").values.tolist() == out.sort_values("word").values.tolist()
    assert pd.concat(toxicity.count_words(iter([])))["n"].tolist() == [0]


def test_examples_are_searched_in_tasks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(np.sort(rng.choice(40, 5, replace=False)), np.full(5, 0.2**0.5)) for _ in range(600)]
    index = toxicity.BlockMaxIndex(40, 32, [str(i) for i in range(600)], np.ones((600, 2)), rows)
    want = toxicity.search_own(index, 7)
    got = toxicity.search_in_tasks(spark, index, 7)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))

    def on_the_driver(self):
        raise AssertionError("postings on the driver")

    monkeypatch.setattr(toxicity.BlockMaxIndex, "_build", on_the_driver)
    docs = spark.createDataFrame([(i, f"word{i % 7} other{i % 5}") for i in range(40)], "doc_id long, text string")
    model = toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 7 = 0 as int) as toxic"))
    assert len(model.index.rows) == 35 and len(model.steps[0])


def test_leave_one_out_calibration_by_loop():
    rng, p = np.random.default_rng(6), toxicity.Params(neighbours=3, block=8)
    sample = []
    for i in range(90):
        terms = np.sort(rng.choice(6, rng.integers(0, 4), replace=False)).tolist()
        sample.append({"id": str(i), "y": int(rng.random() < 0.2 + 0.6 * (0 in terms)), "terms": terms, "tf": [1] * len(terms)})
    model = toxicity.assemble(sample, {str(i): i for i in range(5)}, np.ones(6), [1.0, 1.0], 0.4, p)
    groups = {}
    for r in sample:
        groups.setdefault(tuple(r["terms"]), []).append(r["y"])
    at = {tuple(t.tolist()): i for i, (t, _) in enumerate(model.index.rows)}
    votes, truth = [], []
    for key, ys in groups.items():
        q = np.zeros(6)
        q[list(key)] = 1 / max(1, len(key)) ** 0.5
        found = []
        for other, i in at.items():
            cosine = round(sum(q[x] / len(other) ** 0.5 for x in other), 12) if other else 0
            if cosine > 0 and (other != key or len(ys) > 1):
                found.append((-cosine, i, other))
        for y in ys:
            toxic = total = 0.0
            for c, _, other in sorted(found)[:3]:
                n, k = len(groups[other]), sum(groups[other])
                if other == key:
                    n, k = n - 1, k - y
                toxic, total = toxic + k / (1.05 + c), total + n / (1.05 + c)
            votes.append((toxic + 0.4) / (total + 1))
            truth.append(y)
    want = toxicity.isotonic(np.round(votes, 9), np.array(truth, dtype=float), np.ones(len(votes)))
    grid = np.unique(np.round(votes, 9))
    assert np.allclose(model.probabilities(grid), np.interp(grid, *want), atol=0.02)


def test_toxicity_held_out_and_edges(spark, odd, empty):
    sf = SF_SMALL.replace("0.001", "0.1")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels")
    model = queries.toxicity_model(docs, labels)
    held = docs.join(labels.where(queries.held_out()).select("doc_id", "toxic"), "doc_id")
    got = toxicity.score(held, model).collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit / sum(r.predicted for r in got) > 0.9 and hit / sum(r.toxic for r in got) > 0.8
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, model).collect())
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(empty, empty.withColumn("toxic", F.lit(1)))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.5}


def test_toxicity_vectors_hold_all_words(spark):
    """Cosines and evidence against dense TF-IDF over every word of the texts."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices("abcdefgh", k=6) + [f"w{i % 9}", f"only{i}"] + (["vile"] if i % 3 == 0 else []))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(45)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    bags = [{w: t.split().count(w) for w in t.split()} for _, t in rows]
    df = {w: sum(w in b for b in bags) for b in bags for w in b}

    def weight(w):
        n, pos = sum(w in b for b in bags[:45]), sum(w in bags[i] for i in range(0, 45, 3))
        cells = [(pos, n * 15 / 45), (n - pos, n * 30 / 45), (15 - pos, (45 - n) * 15 / 45), (30 - n + pos, (45 - n) * 30 / 45)]
        ratio = 2 * sum(k * np.log(k / m) for k, m in cells if k)
        return (np.log(61 / (1 + df[w])) + 1) * (1 + (max(ratio, 0) ** 0.5 if pos * 45 > n * 15 else 0))

    vectors = [{w: (1 + np.log(c)) * weight(w) for w, c in b.items()} for b in bags]
    cos = lambda a, b: sum(v * b.get(w, 0) for w, v in a.items()) / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5
    for i, r in got.items():
        want = sorted((-cos(vectors[i], vectors[j]), j) for j in range(45))[:5]
        assert np.allclose(r.evidence_cosines, [-c for c, _ in want], atol=1e-6)
        assert [int(x) for x in r.evidence_ids] == [j for _, j in want]
    assert len({tuple(r.evidence_ids) for r in got.values() if r.doc_id % 3}) > 30


def test_html_unclosed_furniture_and_state_words():
    text = "A paragraph, of the article, with commas, that is long enough to be scored as such by the method."
    body = f"<p>{text}</p><p>{text}</p>"
    want = f"{text}\n{text}"
    assert html_text.main_text(f"<body><p class=ad>Buy<p>{text}</p><p>{text}</p></body>") == want
    assert html_text.main_text(f"<body><div><p class=ad>Buy</div><div>{body}</div></body>") == want
    assert html_text.main_text(f"<body><p><span class=ad>Buy<div>{body}</div></body>") == want
    assert html_text.main_text(f"<body><ul><li class=share>Share<li>Other</ul><div>{body}</div></body>") == want
    assert html_text.main_text(f"<head><title>t</title><body>{body}</body>") == want
    for name in ("content has-sidebar", "layout with-sidebar", "no-comments", "page-widget"):
        assert html_text.main_text(f"<body><div class='{name}'>{body}<div class='sidebar'><p>{text[2:]}</p></div></div></body>").startswith(want)
    assert html_text.main_text("<body><div class=menu><p>Home</p></div></body>") == ""
    assert html_text.main_text(f"<body><aside><div><p>Side</aside><div>{body}</div></body>") == want


def test_html_keeps_the_article_whole():
    text = "A paragraph, of the article, with commas, that is long enough to be scored as such by the method."
    body = f"<p>{text}</p>"
    lines = lambda page: html_text.main_text(page).split("\n")
    # a container of a furniture-like name that also holds an article's word, and one of a furniture name alone
    assert lines(f"<body><div class='promo-story'>{body * 2}</div></body>") == [text] * 2
    assert lines(f"<body><div class='menu'>{body * 2}</div></body>") == [text] * 2
    assert lines("<body><div class=menu><p>Home</p></div></body>") == [""]
    # short siblings of any element beside the best container, and what stands between
    page = f"<body><div>{body * 3}</div><blockquote>Short quote.</blockquote><ul><li>item</ul><p>The end.</p><div><a href=/>more</a></div></body>"
    assert lines(page) == [text] * 3 + ["Short quote.", "item", "The end."]
    page = f"<body><ul><li><a href=/>link</a></ul><p>Lead.</p><div>{body * 4}</div>between<span> two</span><div><a href=/a>all links</a></div><div>{body * 3}</div></body>"
    assert lines(page) == ["Lead."] + [text] * 4 + ["between two"] + [text] * 3
    # an article in two rows of a layout table, without the cell of links
    page = f"<body><table><tr><td><a href=/>home</a></td><td>{body * 3}</td></tr><tr><td>{body * 3}</td></tr></table></body>"
    assert lines(page) == [text] * 6
