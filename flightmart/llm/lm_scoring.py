"""Cross-entropy difference of a target and a background language model.

Both are character n-gram models of one order, one vocabulary and one
smoothing: the vocabulary holds the lower-cased characters that the corpus
has ``min_count`` times or more, all others share one symbol; each order's
relative frequencies are interpolated, down to a uniform share.  The target
model counts the rows marked as target, the background all rows.  A
document's score is its mean loss per token under the target model less that
under the background; low scores read like the target.  A document that the
models were counted on is scored without its own counts (they are taken out of
both tables), so that a score tells likeness and not membership.

Every task counts the n-grams of its whole texts and sends each with its two
counts, so what is gathered grows with the corpus; sums are partial before
and complete after the shuffle.  Each n-gram has a slot by a hash of its
symbols; the table of slots is what scoring tasks get, so its size is
bounded by ``slots`` (two 4-byte numbers each), whatever the corpus.  N-grams
that meet in a slot share a count, in both models alike.

Edge cases: a null text counts as empty; a text without characters has no
tokens, null losses and a null score; a corpus without target rows gives
the target model the uniform share alone; equal texts get equal scores; an
empty table gives an empty result.  Result columns replace columns of the
same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import quoted, text_or_empty

#: Interpolation weights of orders 1, 2, ...; what is missing to one is uniform.
WEIGHTS = (0.04, 0.1, 0.2, 0.3, 0.35)
SLOTS = 1 << 22
UNKNOWN, EDGE = 1, 2
MUL = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    symbols: np.ndarray  # symbol of each code point, in a table up to the largest known one
    size: int
    target: np.ndarray  # count by slot, then texts and tokens
    background: np.ndarray
    weights: tuple[float, ...] = WEIGHTS


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    c = codes(text)
    return np.where(c < len(table), table[np.minimum(c, len(table) - 1)], UNKNOWN).astype(np.uint64)


def slots_of(symbols: np.ndarray, orders: int, slots: int) -> list[np.ndarray]:
    """For each order the slot of the n-gram that ends at each symbol; the
    text begins after an edge symbol, and longer n-grams reach no further."""
    padded = np.concatenate([np.full(orders - 1, EDGE, dtype=np.uint64), symbols])
    out, mixed = [], np.zeros(len(symbols), dtype=np.uint64)
    for k in range(orders):
        mixed = (mixed ^ (padded[orders - 1 - k : len(padded) - k] + np.uint64(k * 1_000_003 + 7))) * MUL
        mixed ^= mixed >> np.uint64(31)
        out.append((mixed * MUL >> np.uint64(64 - (slots - 1).bit_length())).astype(np.int64))
    return out


def _probability(counts: list[np.ndarray], before: list[np.ndarray], total: float, model: Model) -> np.ndarray:
    p = np.full(len(counts[0]), (1 - sum(model.weights)) / model.size)
    for k, w in enumerate(model.weights):
        held = before[k - 1] if k else None
        below = np.full(len(p), total) if held is None else held
        share = np.divide(counts[k], below, out=np.full(len(p), 1 / model.size), where=below > 0)
        p += w * np.minimum(share, 1.0)
    return p


def losses(text: str, model: Model, counted: bool | None = None, own: np.ndarray | None = None) -> tuple[int, float, float] | None:
    """Tokens, mean target loss and mean background loss (natural logarithm).

    ``counted`` tells of a text that the models were counted on whether it
    was a target; its own counts are then left out.  None: it was not counted.
    ``own``: zeros for every slot, and zeros again afterwards.
    """
    s = symbols_of(text, model.symbols)
    if not len(s):
        return None
    slots = slots_of(s, len(model.weights), len(model.target) - 2)
    if counted is not None:
        own = np.zeros(len(model.target), dtype=np.float32) if own is None else own
        every = np.concatenate(slots)
        np.add.at(own, every, np.float32(1))
        mine = own[every].reshape(len(slots), -1)
        own[every] = 0
    out = []
    for table, without in ((model.target, counted is True), (model.background, counted is not None)):
        counts = [table[x] - mine[k] if without else table[x] for k, x in enumerate(slots)]
        # Before a text's first symbol stands the edge, once per text.
        before = [np.concatenate([table[-2:-1] - without, c[:-1]]) for c in counts]
        out.append(float(-np.log(_probability(counts, before, float(table[-1]) - without * len(s), model)).mean()))
    return len(s), out[0], out[1]


def fit(docs: DataFrame, is_target: str, text: str = "text", min_count: int = 5, slots: int = SLOTS, weights: tuple[float, ...] = WEIGHTS) -> Model:
    """Both models from all ``docs``; column ``is_target`` marks target rows."""
    rows = docs.select(text_or_empty(F.col(quoted(text))).alias("text"), F.coalesce(F.col(quoted(is_target)), F.lit(False)).alias("t"))

    def characters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Counter()
        for b in batches:
            for k in range(0, len(b), 64):
                u, n = np.unique(codes("".join(b["text"].iloc[k : k + 64])), return_counts=True)
                found.update(dict(zip(u.tolist(), n.tolist())))
        yield pd.DataFrame(list(found.items()), columns=["code", "n"])

    # At most one row per code point of Unicode.
    known = rows.select("text").mapInPandas(characters, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    vocabulary = sorted(r[0] for r in known.select("code").collect())
    symbols = np.full((vocabulary[-1] if vocabulary else 0) + 2, UNKNOWN, dtype=np.uint32)
    symbols[vocabulary] = np.arange(len(vocabulary)) + 3
    orders = len(weights)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, slots + 2), dtype=np.int64)
        for b in batches:
            for text, t in zip(b["text"], b["t"]):
                s = symbols_of(text, symbols)
                if len(s):
                    found = np.concatenate(slots_of(s, orders, slots))
                    for row in (0, 1) if t else (1,):
                        np.add.at(sums[row], found, 1)
                        sums[row, slots] += 1
                        sums[row, slots + 1] += len(s)
        held = np.flatnonzero(sums[1])
        yield pd.DataFrame({"slot": held, "t": sums[0, held], "n": sums[1, held]})

    sums = rows.mapInPandas(counted, "slot long, t long, n long").groupBy("slot").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    got = sums.toArrow()
    tables = np.zeros((2, slots + 2), dtype=np.float32)
    at = got["slot"].to_numpy()
    tables[0, at], tables[1, at] = got["t"].to_numpy(), got["n"].to_numpy()
    return Model(symbols, len(vocabulary) + 2, tables[0], tables[1], weights)


def score(docs: DataFrame, model: Model, text: str = "text", counted: str | None = None) -> DataFrame:
    """``docs`` with n_tokens, target_loss, background_loss and score.

    ``counted`` names the column that marked target rows if ``docs`` are the
    rows that the models were fitted on: each is scored without itself.
    """
    names = ["n_tokens", "target_loss", "background_loss", "score"]

    @F.pandas_udf("n_tokens long, target_loss double, background_loss double, score double")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = np.zeros(len(model.target), dtype=np.float32)
        for texts, marks in batches:
            got = [losses(t, model, None if counted is None else bool(m), own) for t, m in zip(texts, marks)]
            yield pd.DataFrame([(0, None, None, None) if g is None else (*g, g[1] - g[2]) for g in got], columns=names)

    mark = F.lit(False) if counted is None else F.coalesce(F.col(quoted(counted)), F.lit(False))
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in names]
    return docs.select(*kept, scored.asNondeterministic()(text_or_empty(F.col(quoted(text))), mark).alias("__lm")).select(*kept, "__lm.*")
