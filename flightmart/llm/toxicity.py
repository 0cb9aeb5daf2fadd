"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Vectors hold every word of a text, weighed by (1 + ln tf) x idf x
association.  IDF is counted over all documents, exactly, and is highest for
words in a share of ``rare`` of them or less, which all weigh alike; so does a
word seen in one document or none.  The association of a word is 1 plus
the root of the log-likelihood ratio that ties its document counts among the
labelled training rows to the toxic label, and 1 for all other words.  Words
go by 64-bit hashes.  The table of weights holds the words above ``rare``, of
which there can be no more than a text's distinct words (on average) over
``rare``, whatever the corpus: 12 bytes each.  The examples are a bounded,
stratified sample of training rows; equal vectors are merged and keep their
class weights.

Search: postings are cut into blocks of examples and every term knows its
largest weight in each block that holds it.  A query sums these into upper
bounds, scores the blocks of the best bounds and then all others whose bound
reaches the k-th best cosine so far, so the neighbours are the exact ones.
Terms that many examples share are no postings but a dense matrix.

Scores: neighbours vote with the inverse of their cosine distance, and an
isotonic fit of leave-one-out votes turns votes into calibrated
probabilities.  The neighbours come along as evidence.

Edge cases: a null text counts as empty; an empty text has no neighbour and
gets the calibrated training share of toxic rows; labels other than 0 and 1 and null
labels are ignored; ties in cosine go to the lower example id; with no
labelled row every score is 0.5; an empty table gives an empty result.
Added columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ._common import give_back, giving_back, quoted, stored, text_or_empty

WORD = re.compile(r"\w+")
#: Latin-1 characters, with spaces for those that are in no word.
LATIN = "".join(c if WORD.match(c) else " " for c in map(chr, range(256))).encode("latin-1")
PLACES, ID_BITS = 10**12, 22
CHUNK = 128  # texts weighed together
COUNTED = 1 << 16  # words that are counted before they are hashed
TOGETHER = 32  # queries searched together
FEW = 8  # examples searched together for their calibration
OWN = 256  # examples that a task gets at a time
SHARED = 1 / 8  # share of the examples from which a term's weights are a row of a matrix
FIRST = 2  # blocks that are scored before bounds are compared
COLUMNS = ["score", "predicted", "evidence_ids", "evidence_cosines", "evidence_labels"]
RESULT = "score double, predicted int, evidence_ids array<string>, evidence_cosines array<double>, evidence_labels array<int>"


@dataclass
class Params:
    """Bounds and thresholds of the classifier."""

    max_train: int = 400_000  # labels that are learned from, about
    max_examples: int = 4096  # indexed examples of each class, about
    neighbours: int = 15
    evidence: int = 5
    block: int = 256
    threshold: float = 0.3
    rare: float = 1e-4  # share of all documents up to which words weigh alike


def words(text: str | None) -> list[str]:
    low = (text or "").lower()
    try:
        return low.encode("latin-1").translate(LATIN).decode("latin-1").split()  # the same words, sooner
    except UnicodeEncodeError:
        return WORD.findall(low)


def hashed(found: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(found, dtype=object), categorize=False).view(np.int64)


def term_counts(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, then text after text the places of its
    words among these and their counts, and how many each text has."""
    found = [Counter(words(t)) for t in texts]
    place: defaultdict[str, int] = defaultdict(count().__next__)
    sizes = np.array([len(own) for own in found], dtype=np.int64)
    n = int(sizes.sum())
    at = np.fromiter(map(place.__getitem__, chain.from_iterable(found)), np.int64, n)
    tf = np.fromiter(chain.from_iterable(own.values() for own in found), np.int64, n)
    return hashed(list(place)), at, tf, sizes


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start .. start + size - 1`` of each, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def found_at(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``; -1 where missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class Postings:
    """A BlockMaxIndex in arrays.  A pair is a term and a block that holds it."""

    shared: np.ndarray  # by term: its row of ``dense``, or -1
    dense: np.ndarray
    pairs_of: np.ndarray  # by term: its first pair; a last entry more
    block_of: np.ndarray  # by pair
    best: np.ndarray  # by pair: largest weight
    first: np.ndarray  # by pair: its first posting; a last entry more
    examples: np.ndarray  # by posting
    weights: np.ndarray


@dataclass
class BlockMaxIndex:
    """Sparse example vectors of unit length, searched exactly.

    ``rows``: per example the term ids and weights.  Every process builds
    the postings for itself, so they don't travel with the model.
    """

    n_terms: int
    block: int
    ids: list[str]
    mass: np.ndarray  # example x class: summed weights of the rows merged into it
    rows: list[tuple[np.ndarray, np.ndarray]]
    postings: Postings | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"postings": None}

    def _build(self) -> Postings:
        n = len(self.rows)
        blocks = -(-n // self.block)
        terms = np.concatenate([t for t, _ in self.rows]).astype(np.int32, copy=False)
        weights = np.concatenate([w for _, w in self.rows])
        examples = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t, _ in self.rows])
        common = np.bincount(terms, minlength=self.n_terms) >= max(2, n * SHARED)
        many = np.flatnonzero(common)
        shared = np.full(self.n_terms, -1)
        shared[many] = np.arange(len(many))
        dense = np.zeros((len(many), n))
        own = common[terms]
        dense[shared[terms[own]], examples[own]] = weights[own]
        # Arrays as long as the postings are let go of as soon as they can.
        terms, weights, examples = terms[~own], weights[~own], examples[~own]
        order = np.argsort(terms, kind="stable")
        terms, weights, examples = terms[order], weights[order], examples[order]
        del own, order
        pair = terms * np.int64(blocks)
        pair += examples // self.block
        del terms
        new = np.ones(len(pair), dtype=bool)
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        first = np.flatnonzero(new)
        pair = pair[first]
        best = np.maximum.reduceat(weights, first) if len(first) else np.zeros(0)
        pairs_of = np.searchsorted(pair, np.arange(self.n_terms + 1) * blocks)
        return Postings(shared, dense, pairs_of, (pair % blocks).astype(np.int32), best, np.append(first, len(weights)), examples, weights)

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, together: int = TOGETHER) -> tuple[np.ndarray, np.ndarray]:
        """Query x k best cosines and their examples, best first; cosine 0 is no
        neighbour.  Cosines count to twelve places, ties go to the lower example."""
        # One integer per neighbour: the cosine, then the example counted down.
        top = np.zeros((len(queries), k), dtype=np.int64)
        if self.rows:
            if self.postings is None:
                self.postings = self._build()
                give_back()  # building takes more than what it leaves
            for at in range(0, len(queries), together):
                self._search(queries[at : at + together], top[at : at + together])
        top = -np.sort(-top, axis=1)
        examples = np.where(top > 0, (1 << ID_BITS) - 1 - (top & ((1 << ID_BITS) - 1)), 0)
        return (top >> ID_BITS) / PLACES, examples

    def _search(self, queries: list[tuple[np.ndarray, np.ndarray]], top: np.ndarray) -> None:
        """Bounds of all queries at once, where a pair goes by query and block; then
        postings query by query, as their arrays stay in the processor's cache."""
        p, n, m, k = self.postings, len(self.rows), len(queries), top.shape[1]
        edges = np.arange(0, n, self.block)
        terms = np.concatenate([np.asarray(t, dtype=np.int64) for t, _ in queries])
        weights = np.concatenate([w for _, w in queries])
        who = np.repeat(np.arange(m), [len(t) for t, _ in queries])
        at = p.shared[terms]
        q = np.zeros((m, len(p.dense)))
        q[who[at >= 0], at[at >= 0]] = weights[at >= 0]
        cosines = q @ p.dense
        terms, weights, who = terms[at < 0], weights[at < 0], who[at < 0]
        sizes = p.pairs_of[terms + 1] - p.pairs_of[terms]
        pairs, own = ranges(p.pairs_of[terms], sizes), np.repeat(np.arange(len(terms)), sizes)
        cell = np.repeat(who * len(edges), sizes) + p.block_of[pairs]
        bound = np.maximum.reduceat(cosines, edges, axis=1) + np.bincount(cell, weights[own] * p.best[pairs], m * len(edges)).reshape(m, -1)
        turn = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(turn, np.argsort(-bound, axis=1, kind="stable")[:, :FIRST], True, axis=1)
        seen = turn
        while turn.any():
            go = np.flatnonzero(turn.ravel()[cell])
            # A term's pairs one after the other are one run of postings.
            starts = np.flatnonzero((np.diff(pairs[go], prepend=-2) != 1) | (np.diff(own[go], prepend=-1) != 0))
            first = p.first[pairs[go[starts]]]
            held = p.first[pairs[go[np.append(starts, len(go))[1:] - 1]] + 1] - first
            term = own[go[starts]]
            ends = np.searchsorted(who[term], np.arange(m + 1)).tolist()
            for i in range(m):
                cut = slice(ends[i], ends[i + 1])
                at = ranges(first[cut], held[cut])
                cosines[i] += np.bincount(p.examples[at], np.repeat(weights[term[cut]], held[cut]) * p.weights[at], n)
            # What is not summed yet is missing from a cosine, so this is no more than the k-th best.
            last = np.partition(cosines, max(0, n - k), axis=1)[:, max(0, n - k)] if n >= k else np.zeros(m)
            turn = ~seen & (bound > 0) & (bound >= last[:, None] - 1e-9)
            seen = seen | turn
        row, example = np.nonzero((cosines > 0) & (cosines >= last[:, None] - 2 / PLACES))
        exact = np.rint(cosines[row, example] * PLACES).astype(np.int64)
        keys = np.where(exact > 0, (exact << ID_BITS) + (1 << ID_BITS) - 1 - example, 0)
        order = np.lexsort((-keys, row))
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < k
        top[row[best], place[best]] = keys[order][best]


@dataclass
class Vocabulary:
    hashes: np.ndarray  # sorted
    weights: np.ndarray  # IDF x association
    other: float  # weight of all other words
    terms: np.ndarray  # sorted hashes of the examples' words; a term id is a place in it

    def weight(self, hashes: np.ndarray) -> np.ndarray:
        at = found_at(self.hashes, hashes)
        return np.where(at >= 0, self.weights[at] if len(self.hashes) else 0.0, self.other)


@dataclass
class Model:
    vocabulary: Vocabulary
    index: BlockMaxIndex
    prior: float
    steps: tuple[np.ndarray, np.ndarray]  # votes and the probabilities they stand for
    params: Params

    def vectors(self, texts: Iterable[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of each text.  Words that no example has count in
        the length and are left out, as no posting meets them."""
        hashes, places, tf, sizes = term_counts(texts)
        weights = (1 + np.log(tf)) * self.vocabulary.weight(hashes)[places]
        terms = found_at(self.vocabulary.terms, hashes)[places]
        out, at = [], 0
        for n in sizes.tolist():
            t, w = terms[at : at + n], weights[at : at + n]
            out.append((t[t >= 0], w[t >= 0] / np.linalg.norm(w) if n else w))
            at += n
        return out

    def votes(self, cosines: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """Toxic share by neighbours' ``mass`` (query x k x class)."""
        weight = np.where(cosines > 0, 1 / (1.05 - np.minimum(cosines, 1)), 0)
        toxic, clean = (weight * mass[..., 1]).sum(axis=1), (weight * mass[..., 0]).sum(axis=1)
        return (toxic + self.prior) / (toxic + clean + 1)

    def probabilities(self, votes: np.ndarray) -> np.ndarray:
        return np.interp(votes, *self.steps) if len(self.steps[0]) else votes

    def score(self, texts: Iterable[str | None]) -> list[tuple[float, int, list[str], list[float], list[int]]]:
        """Per text one row of RESULT."""
        cosines, examples = self.index.search(self.vectors(texts), self.params.neighbours)
        mass = self.index.mass[examples] if len(self.index.ids) else np.zeros((*examples.shape, 2))
        scores = self.probabilities(self.votes(cosines, mass))
        toxic, out = mass[..., 1] > mass[..., 0], []
        for i, s in enumerate(scores.tolist()):
            n = min(int((cosines[i] > 0).sum()), self.params.evidence)
            ids = [self.index.ids[x] for x in examples[i, :n]]
            out.append((s, int(s >= self.params.threshold), ids, cosines[i, :n].tolist(), toxic[i, :n].astype(int).tolist()))
        return out


def weigh(terms: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length, by ascending term."""
    terms, tf = np.asarray(terms, dtype=np.int32), np.asarray(tf, dtype=float)
    order = np.argsort(terms)
    weights = (1 + np.log(tf[order])) * idf[terms[order]]
    return terms[order], weights / np.linalg.norm(weights) if len(terms) else weights


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted least-squares non-decreasing fit (pooled neighbours)."""
    pools: list[list[float]] = []
    for i in np.argsort(x, kind="stable").tolist():
        pools.append([y[i] * w[i], w[i], x[i], x[i]])
        while len(pools) > 1 and (
            pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]
        ):
            a = pools.pop()
            pools[-1] = [pools[-1][0] + a[0], pools[-1][1] + a[1], pools[-1][2], a[3]]
    at = [v for p in pools for v in (p[2], p[3])]
    return np.array(at), np.array([p[0] / p[1] for p in pools for _ in (0, 1)])


@giving_back
def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents by word; the row without the mark counts all documents."""
    held, parts, size, every = Counter(), [], 0, 0

    def hashes() -> tuple[np.ndarray, np.ndarray]:
        return hashed(list(held)), np.fromiter(held.values(), np.int64, len(held))

    def taken() -> pd.DataFrame:
        words, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return pd.DataFrame({"word": words, "n": np.bincount(at, np.concatenate([c for _, c in parts]), len(words)).astype(np.int64), "word_row": True})

    for b in batches:
        every += len(b)
        for t in b["text"]:
            held.update(set(words(t)))
            if len(held) > COUNTED:
                parts.append(hashes())
                size += len(held)
                held.clear()
        if size > 4_000_000:
            yield taken()
            parts, size = [], 0
    if held:
        parts.append(hashes())
    if parts:
        yield taken()
    yield pd.DataFrame({"word": [0], "n": [every], "word_row": [False]})


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", id: str = "doc_id", params: Params | None = None) -> Model:
    """Learn from the ``docs`` that ``labels`` (id, label; a row per id) names;
    IDF comes from all ``docs``.

    Beyond ``max_train`` labels a sample of about so many is taken, by hash
    of the id; their ids and labels are broadcast, so texts stay where they
    are.  Brought to the driver: the table of words' weights (bounded by
    ``rare``) and at most about twice ``max_examples`` sparse vectors.
    """
    p = params or Params()
    known = labels.select(F.col(id).cast("string").alias("id"), F.col(label).cast("int").alias("y"))
    known = stored(known.where("id is not null and y in (0, 1)"), "toxicity-labels")
    n = known.count()
    if n > p.max_train:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30) < p.max_train / n)
    rows = docs.select(F.col(id).cast("string").alias("id"), text_or_empty(text).alias("text"))
    rows = stored(rows.join(F.broadcast(known), "id"), "toxicity-labelled")
    share = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()

    def counted(texts: DataFrame) -> DataFrame:
        found = texts.select("text").mapInPandas(count_words, "word long, n long, word_row boolean")
        return found.groupBy("word", "word_row").agg(F.sum("n").alias("n"))

    counts = stored(counted(docs.select(text_or_empty(text).alias("text"))), "toxicity-words")
    every = counts.where("not word_row").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(1.0, p.rare * every)
    counts = counts.where("word_row").select("word", F.col("n").alias("df")).where(F.col("df") >= least)
    if 0 < pos < n:
        toxic = counted(rows.where("y = 1")).where("word_row").select("word", F.col("n").alias("pos"))
        clean = counted(rows.where("y = 0")).where("word_row").select("word", F.col("n").alias("neg"))
        tied = toxic.join(clean, "word", "left").select("word", "pos", (F.col("pos") + F.coalesce("neg", F.lit(0))).alias("n"))
        log_part = lambda k, m: f"CASE WHEN {k} > 0 THEN {k} * ln({k} / ({m})) ELSE 0 END"
        ratio = (
            f"2 * ({log_part('pos', f'n * {pos}D / {n}')} + {log_part('(n - pos)', f'n * {n - pos}D / {n}')}"
            f" + {log_part(f'({pos} - pos)', f'({n} - n) * {pos}D / {n}')}"
            f" + {log_part(f'({n - pos} - n + pos)', f'({n} - n) * {n - pos}D / {n}')})"
        )
        tied = tied.where(f"pos * {n}D > n * {pos}D").select("word", F.sqrt(F.greatest(F.lit(0.0), F.expr(ratio))).alias("tie"))
        counts = counts.join(tied, "word", "left")
    else:
        counts = counts.withColumn("tie", F.lit(None).cast("double"))
    held = counts.where("df > 1 or tie is not null").select("word", F.col("df").cast("int"), F.coalesce("tie", F.lit(0.0)).cast("float").alias("tie")).toArrow()
    order = np.argsort(held["word"].to_numpy())
    df, tie = held["df"].to_numpy()[order], held["tie"].to_numpy()[order]
    weights = ((np.log((1 + every) / (1 + df)) + 1) * (1 + tie)).astype(np.float32)
    other = float(np.float32(math.log((1 + every) / (1 + least)) + 1))
    vocabulary = Vocabulary(held["word"].to_numpy()[order], weights, other, np.zeros(0, dtype=np.int64))
    del held, order, df, tie

    @giving_back
    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            own = [term_counts([t]) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "terms": [x[0].astype("<i8").tobytes() for x in own], "tf": [x[2].astype("<i4").tobytes() for x in own]})

    neg, rates = n - pos, []
    for size_of in (neg, pos):
        rates.append(min(1.0, p.max_examples / size_of) if size_of else 1.0)
    chosen = rows.where(share < F.when(F.col("y") == 1, F.lit(rates[1])).otherwise(F.lit(rates[0])))
    drawn = chosen.mapInPandas(bags, "id string, y int, terms binary, tf binary").toArrow()
    sample = [(i.as_py(), y.as_py(), np.frombuffer(t.as_buffer(), "<i8"), np.frombuffer(c.as_buffer(), "<i4")) for i, y, t, c in zip(*drawn.columns)]
    vocabulary.terms = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *[r[2] for r in sample]]))
    sample = [{"id": r[0], "y": r[1], "terms": np.searchsorted(vocabulary.terms, r[2]).astype(np.int32), "tf": r[3].astype(np.int32)} for r in sample]
    del drawn  # the sample holds copies now
    pa.default_memory_pool().release_unused()
    idf = vocabulary.weight(vocabulary.terms)
    return assemble(sample, vocabulary, idf, rates, pos / n if n else 0.5, p, lambda index, k: search_in_tasks(docs.sparkSession, index, k))


def search_own(index: BlockMaxIndex, k: int) -> tuple[np.ndarray, np.ndarray]:
    return index.search(index.rows, k, FEW)


def search_in_tasks(spark: SparkSession, index: BlockMaxIndex, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``search_own`` with the examples dealt over tasks, so that the driver builds no postings."""
    held = spark.sparkContext.broadcast(index)

    @giving_back
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in b["id"].tolist():
                cosines, examples = held.value.search(held.value.rows[at : at + OWN], k, FEW)
                yield pd.DataFrame({"at": [at], "cosines": [cosines.tobytes()], "examples": [examples.astype("<i8").tobytes()]})

    found = spark.range(0, len(index.rows), OWN).mapInPandas(search, "at long, cosines binary, examples binary").toArrow()
    parts = sorted(zip(*(found[c].to_pylist() for c in ("at", "cosines", "examples"))))
    held.destroy()
    return tuple(np.frombuffer(b"".join(x[at] for x in parts), kind).reshape(-1, k) for at, kind in ((1, "<f8"), (2, "<i8")))


def assemble(
    sample: list, vocabulary: Vocabulary, idf: np.ndarray, rates: list[float], prior: float, p: Params,
    search: Callable[[BlockMaxIndex, int], tuple[np.ndarray, np.ndarray]] = search_own,
) -> Model:
    """Index the sampled examples and calibrate on their leave-one-out votes, which ``search`` finds."""
    merged: dict[bytes, list] = {}
    for r in sorted(sample, key=lambda r: (r["id"] is None, str(r["id"]))):
        terms, weights = weigh(r["terms"], r["tf"], idf)
        own = np.eye(2)[r["y"]] / rates[r["y"]]
        entry = merged.setdefault(hashlib.sha256(terms.tobytes() + np.round(weights, 9).tobytes()).digest(), [terms, weights, np.zeros(2), str(r["id"]), []])
        entry[2] = entry[2] + own
        entry[4].append(own)
    entries = sorted(merged.values(), key=lambda e: (int(e[0][np.argmax(e[1])]) if len(e[0]) else -1, e[3]))
    mass = np.array([e[2] for e in entries]).reshape(-1, 2)
    index = BlockMaxIndex(len(idf), p.block, [e[3] for e in entries], mass, [(e[0], e[1]) for e in entries])
    model = Model(vocabulary, index, prior, (np.zeros(0), np.zeros(0)), p)
    votes, labels, weights = [], [], []
    if entries:
        cosines, examples = search(index, p.neighbours + 1)
        self_at = (examples == np.arange(len(entries))[:, None]) & (cosines > 0)
        # An example of one row leaves its list; of several rows, one row's weight leaves.
        drop = self_at & np.array([len(e[4]) == 1 for e in entries])[:, None]
        drop[~drop.any(axis=1), -1] = True
        near, who, own_at = (x[~drop].reshape(len(entries), -1) for x in (cosines, examples, self_at))
        for y in (0, 1):
            own = np.eye(2)[y] / rates[y]
            has = np.array([any(o[y] > 0 for o in e[4]) for e in entries])
            without = np.where(own_at[..., None], np.maximum(mass[who] - own, 0), mass[who])
            votes += model.votes(near, without)[has].tolist()
            labels += [y] * int(has.sum())
            weights += [sum(o[y] for o in e[4]) for e, h in zip(entries, has) if h]
    index.postings = None  # the driver has no further use for them
    if votes:
        model.steps = isotonic(np.array(votes), np.array(labels, dtype=float), np.array(weights))
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the columns of RESULT added.

    The model is broadcast, so a worker process reads it and builds its
    postings once.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @giving_back
    def rows_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [r for at in range(0, len(texts), CHUNK) for r in held.value.score(texts.iloc[at : at + CHUNK])]
            yield pd.DataFrame(rows, columns=COLUMNS)

    @pandas_udf(RESULT)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from rows_of(batches)

    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in COLUMNS]
    return docs.select(*kept, scored.asNondeterministic()(text_or_empty(text)).alias("__toxicity")).select(*kept, "__toxicity.*")
