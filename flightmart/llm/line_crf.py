"""Line labelling by a linear-chain conditional random field.

Each text is a sequence of lines; the field has two labels, boilerplate and
content, emission weights over a line's surface features, and transition
weights.  It is trained by the gradient of the log-likelihood (forward and
backward sums) on a bounded sample of rows with a quality label.  A row's
label says what most of its lines are, not what each one is: a first pass
fits emissions alone, and a line that these place on the other side takes
that label, as long as its row keeps the larger part on the row's side.  So
the field sees labels change inside texts.  Viterbi decoding then labels the lines of
every whole text, and the share of characters in content lines decides
whether a text is kept.

The base rules come with it: counts of words, symbols, repeated lines and
repeated 8-word windows, and the verdict over them.

Edge cases: a null text counts as empty and has no words, so it fails the
base rules; lines without a word are not labelled; a text without content
lines has content share 0; without any training row of both labels the field
is neutral and calls every line content; equal texts get equal results; an
empty table gives an empty result.  Result columns replace columns of the
same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import quoted, stored, text_or_empty

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
N_FEATURES = 16
BOILERPLATE, CONTENT = 0, 1
OF_SYMBOLS = {ord(c): None for c in SYMBOLS}
UPPER, LOWER, DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[a-zß-öø-ÿ]"), re.compile(r"[0-9]")


@dataclass
class Crf:
    emit: np.ndarray  # feature x label
    move: np.ndarray  # label x label
    first: np.ndarray  # label


@dataclass
class Params:
    max_train: int = 3000  # labelled rows in training, about
    rounds: int = 120
    step: float = 0.1
    decay: float = 1e-3
    min_share: float = 0.5


def line_features(line: str, again: bool) -> list[float]:
    found = line.split()
    n, size = len(found), len(line)
    if n == 0:
        return [1.0] + [0.0] * (N_FEATURES - 1)
    symbols = size - len(line.translate(OF_SYMBOLS))
    upper, digits = len(UPPER.findall(line)), len(DIGIT.findall(line))
    letters = upper + len(LOWER.findall(line))
    distinct = len(set(found)) / n
    return [
        1.0,
        float(n <= 2),
        float(n <= 5),
        float(n >= 15),
        min(1.0, 8 * symbols / size),
        float(symbols > 0.04 * size),
        upper / letters if letters else 0.0,
        float(upper > 0.5 * max(letters, 1)),
        min(1.0, 5 * digits / size),
        1 - distinct,
        float(n >= 6 and distinct < 0.5),
        float(line.rstrip()[-1:] in ".?!"),
        min(1.0, 5 * line.count("!") / n),
        float(" | " in line),
        float(again),
        min(1.0, size / n / 12),
    ]


def features(text: str) -> tuple[np.ndarray, list[int]]:
    """Feature rows and lengths of the lines that hold a word."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        if line.strip(SPACES):
            rows.append(line_features(line, line in seen))
            sizes.append(len(line))
            seen.add(line)
    return np.array(rows, dtype=float).reshape(-1, N_FEATURES), sizes


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences side by side: (sequence x line x feature) and lengths."""
    sizes = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), int(sizes.max(initial=0)), N_FEATURES))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, sizes


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradient(crf: Crf, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the log-likelihood of labels ``y`` (sequence x line)."""
    s, n, _ = x.shape
    score = x @ crf.emit
    live = np.arange(n)[None, :] < sizes[:, None]
    ahead, back = np.empty((s, n, 2)), np.zeros((s, n, 2))
    ahead[:, 0] = crf.first + score[:, 0]
    for t in range(1, n):
        ahead[:, t] = _lse(ahead[:, t - 1, :, None] + crf.move, 1) + score[:, t]
    for t in range(n - 2, -1, -1):
        step = _lse(crf.move[None] + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(live[:, t + 1, None], step, 0.0)
    total = _lse(ahead[np.arange(s), sizes - 1], 1)
    node = np.exp(ahead + back - total[:, None, None]) * live[..., None]
    truth = np.eye(2)[y] * live[..., None]
    emit = np.einsum("snf,snl->fl", x, truth - node)
    move = np.zeros((2, 2))
    for t in range(1, n):
        pair = ahead[:, t - 1, :, None] + crf.move[None] + (score[:, t] + back[:, t])[:, None, :] - total[:, None, None]
        move += (np.exp(pair) * live[:, t, None, None]).sum(0) * -1 + np.einsum("sa,sb->ab", truth[:, t - 1] * live[:, t, None], truth[:, t])
    return emit, move, (truth[:, 0] - node[:, 0]).sum(0)


def line_labels(crf: Crf, rows: np.ndarray, y: int) -> np.ndarray:
    """Labels of the lines of a row of label ``y``: those that the emissions
    give, but with more than half of the lines on the row's side (the
    likeliest ones stay there)."""
    odds = rows @ (crf.emit[:, y] - crf.emit[:, 1 - y])
    most = (len(rows) - 1) // 2  # lines that may be on the other side
    other = [i for i in np.argsort(odds, kind="stable")[:most] if odds[i] < 0]
    out = np.full(len(rows), y)
    out[other] = 1 - y
    return out


def train(sequences: list[np.ndarray], labels: list[int], p: Params, longest: int = 64) -> Crf:
    """From rows with one label each; see ``line_labels``."""
    own = [np.full(len(rows), y) for rows, y in zip(sequences, labels)]
    lines = ascend([rows[k : k + 1] for rows in sequences for k in range(len(rows))], [y[k : k + 1] for y in own for k in range(len(y))], p)
    lines.emit[0] += (lines.first - lines.first.mean())  # alone, a line's start weight is a bias
    return ascend(sequences, [line_labels(lines, rows, y) if len(rows) else rows[:, 0].astype(int) for rows, y in zip(sequences, labels)], p, longest)


def ascend(sequences: list[np.ndarray], labels: list[np.ndarray], p: Params, longest: int = 64) -> Crf:
    """Adaptive gradient ascent over labelled lines; sequences are cut to ``longest`` lines each."""
    parts, ys = [], []
    for rows, y in zip(sequences, labels):
        for k in range(0, len(rows), longest):
            parts.append(rows[k : k + longest])
            ys.append(y[k : k + longest])
    crf = Crf(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    if not parts or len(np.unique(np.concatenate(ys))) < 2:
        crf.emit[0] = (-1.0, 1.0)
        return crf
    order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
    batches = []
    for k in range(0, len(order), 4096 if longest == 1 else 512):
        pick = order[k : k + (4096 if longest == 1 else 512)]
        x, sizes = padded([parts[i] for i in pick])
        y = np.zeros(x.shape[:2], dtype=int)
        for row, i in enumerate(pick):
            y[row, : sizes[row]] = ys[i]
        batches.append((x, sizes, y))
    sums = [np.zeros_like(w) for w in (crf.emit, crf.move, crf.first)]
    count = sum(int(b[1].sum()) for b in batches)
    for _ in range(p.rounds):
        got = [np.zeros_like(w) for w in sums]
        for b in batches:
            for g, d in zip(got, gradient(crf, *b)):
                g += d
        for w, g, s in zip((crf.emit, crf.move, crf.first), got, sums):
            g = g / count - p.decay * w
            s += g * g
            w += p.step * g / np.sqrt(s + 1e-12) * 3
    return crf


def viterbi(crf: Crf, rows: list[np.ndarray]) -> list[np.ndarray]:
    """The best label sequence of each; ties go to content."""
    out: list[np.ndarray] = [np.zeros(0, dtype=int)] * len(rows)
    order = sorted((i for i in range(len(rows)) if len(rows[i])), key=lambda i: len(rows[i]))
    for k in range(0, len(order), 128):
        pick = order[k : k + 128]
        x, sizes = padded([rows[i] for i in pick])
        s, n, _ = x.shape
        score = x @ crf.emit
        best, from_ = crf.first + score[:, 0], np.zeros((s, n, 2), dtype=np.int8)
        ends = best.copy()
        for t in range(1, n):
            ways = best[:, :, None] + crf.move[None]
            from_[:, t] = ways[:, 1] >= ways[:, 0]
            best = ways.max(axis=1) + score[:, t]
            ends = np.where((sizes > t)[:, None], best, ends)
        label = (ends[:, 1] >= ends[:, 0]).astype(int)
        path = np.zeros((s, n), dtype=int)
        for t in range(n - 1, -1, -1):
            path[:, t] = label
            label = np.where(sizes > t, from_[np.arange(s), t, label], label)
        for r, i in enumerate(pick):
            out[i] = path[r, : sizes[r]]
    return out


MIX = np.random.default_rng(11).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


def n_repeat_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.uint64)
    if len(ids) == len(words):
        return 0
    hashes = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        hashes += (code[k : k + n] + np.uint64(1)) * MIX[k]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    maybe = np.zeros(n, dtype=bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    met: dict[tuple, int] = {}
    where = np.flatnonzero(maybe).tolist()
    plain = code.tolist()
    windows = [tuple(plain[i : i + WINDOW]) for i in where]
    for w in windows:
        met[w] = met.get(w, 0) + 1
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    for i, w in zip(where, windows):
        if met[w] > 1:
            marks[i] += 1
            marks[i + WINDOW] -= 1
    return int((np.cumsum(marks[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    words = text.encode("utf-8", "surrogatepass").split()
    spaces = sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeated = n_repeat_words(words)
    failed = len(words) < 20 or 100 * repeated > 30 * len(words)
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated, failed


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", id: str = "doc_id", params: Params | None = None) -> Crf:
    """Train on the ``docs`` of about ``max_train`` of the ``labels`` (id, label; a
    row per id) that are 0 or 1, drawn by a hash of the id.

    The draw reads the labels alone and is broadcast (``max_train`` ids, about),
    so texts stay where they are.
    """
    p = params or Params()
    known = labels.select(F.col(quoted(id)).cast("string").alias("id"), F.col(quoted(label)).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    rate = {r[0]: min(1.0, p.max_train / 2 / r[1]) for r in known.groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where(draw < F.when(F.col("y") == 1, F.lit(rate.get(1, 0.0))).otherwise(F.lit(rate.get(0, 0.0))))
    drawn = stored(drawn, "line-crf-labels")
    rows = docs.select(F.col(quoted(id)).cast("string").alias("id"), text_or_empty(F.col(quoted(text))).alias("text"))
    chosen = rows.join(F.broadcast(drawn), "id")

    def shaped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "x": [features(t)[0].astype("<f8").tobytes() for t in b["text"]]})

    sample = sorted(chosen.mapInPandas(shaped, "id string, y int, x binary").collect(), key=lambda r: (r["id"] or "", bytes(r["x"])))
    return train([np.frombuffer(r["x"], "<f8").reshape(-1, N_FEATURES) for r in sample], [r["y"] for r in sample], p)


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, n_lines long, n_content_lines long, content_share double, kept boolean"


def judge(docs: DataFrame, crf: Crf, text: str = "text", min_share: float = 0.5) -> DataFrame:
    """``docs`` with the base counts, line counts, content share and verdict."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    @F.pandas_udf(COLUMNS)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            for k in range(0, max(len(texts), 1), 512):
                part = texts.iloc[k : k + 512].tolist()
                base = [base_counts(t) for t in part]
                shaped = [features(t) for t in part]
                labels = viterbi(crf, [x for x, _ in shaped])
                rows = []
                for b, (_, sizes), y in zip(base, shaped, labels):
                    total = sum(sizes)
                    share = float(np.dot(sizes, y)) / total if total else 0.0
                    rows.append((*b, len(sizes), int(y.sum()), share, not b[-1] and share >= min_share))
                held = pd.DataFrame(rows, columns=names)
                out = held if k == 0 else pd.concat([out, held], ignore_index=True)
            yield out

    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in names]
    return docs.select(*kept, judged.asNondeterministic()(text_or_empty(F.col(quoted(text)))).alias("__judged")).select(*kept, "__judged.*")
