"""Mixing to target weights by iterative proportional fitting, in DataFrame
operations.

Documents are counted into cells, one per combination of the dimensions'
categories; only cells go through the fitting.  Every step scales the cells'
token weights so that one dimension's sums meet its targets, in turn, until
all dimensions agree.  A document of cell c is then kept with probability
budget * weight(c) / tokens(c), at most ``top_rate``, by a hash of its id and
text: equal runs choose equal documents, and expected tokens meet the
targets.  The budget of tokens is given, or is the largest at which cells
with a share of at most ``saturated`` of all tokens come above the top rate,
so that a few tiny cells can't set the rate of all others.  Such cells are
held at the top rate, and the raking is repeated under these bounds, which
lets the other cells make up for them.

Token counts are partial before their shuffle, so a source with a third of
all rows is spread; from there on the tables have a row per cell, as many as
combinations of categories that occur, whatever the rows of a category.

Edge cases: a null category is a category of its own; a null or blank text
counts as one token, so that it has a chance like any other; categories
without a positive target get probability 0; targets of categories that do not occur are left
out and the rest scaled to one; if targets can't all be met (empty cells),
the last step's dimension is exact, but for categories whose cells are all
at the top rate, and the rest as near as the rounds brought them; an empty table gives an empty result.  Columns whose names
start with ``__mix`` are reserved; ``keep_rate`` replaces a column of that
name.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import NOT_SPACE, quoted, stored, text_or_empty

#: Topics by the first rule that a text meets, else "prose".
TOPIC_RULES = {
    "license": r"(?i)\b(licensed under|all rights reserved|general public license)\b",
    "table": r" \| \S+ \| ",
    "symbols": r"([#*$%&]{3}.*){5}",
    "shouting": r"(!!.*){5}",
}


def topic(text: str | Column = "text", rules: Mapping[str, str] = TOPIC_RULES) -> Column:
    """A topic by declared patterns, tried in order on the whole text."""
    text, out = text_or_empty(text), F.lit("prose")
    for name, pattern in reversed(list(rules.items())):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def tempered(shares: DataFrame, power: float) -> DataFrame:
    """Targets (category, share) in proportion to tokens to a power below 1,
    from (category, tokens): large categories shrink, small ones grow."""
    return shares.select("category", F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("share"))


def cells(docs: DataFrame, dims: list[str]) -> DataFrame:
    return docs.groupBy(*[F.col(f"__mix_{d}") for d in dims]).agg(F.sum("__mix_tokens").alias("tokens"))


def rake(counted: DataFrame, dims: list[str], targets: Mapping[str, DataFrame], tolerance: float = 1e-6, max_rounds: int = 60, block: int = 4, budget: float | None = None) -> DataFrame:
    """``counted`` (a row per cell) with ``weight``, raked to the targets' shares;
    with a ``budget`` no weight of it passes the cell's tokens.

    Rounds run in blocks; each block is one job whose result is written to
    the shared folder, and whose largest deviation decides on the next: it
    ends when that is small or, under a budget, no longer falls.  A warning
    says by how much a category then misses its share, if not within ``tolerance``.
    """
    now = counted.withColumn("weight", F.col("tokens").cast("double"))
    goals = {}
    for d in dims:
        present = counted.select(F.col(f"__mix_{d}").alias("category")).distinct()
        own = present.join(targets[d].select("category", "share"), present["category"].eqNullSafe(targets[d]["category"]), "left").select(present["category"], F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(0.0)).alias("share"))
        total = own.agg(F.sum("share").alias("total"))
        goals[d] = stored(own.crossJoin(F.broadcast(total)).select(F.col("category").alias(f"__goal_{d}"), F.when(F.col("total") > 0, F.col("share") / F.col("total")).otherwise(0.0).alias(f"__share_{d}")), "mix-goal")
    for d in dims:
        now = now.join(goals[d], F.col(f"__mix_{d}").eqNullSafe(F.col(f"__goal_{d}"))).drop(f"__goal_{d}")
    now, before, off = stored(now, "mix-cells"), float("inf"), 0.0
    bound = F.lit(float("inf")) if budget is None else F.col("tokens") / F.lit(float(budget))
    for _ in range(0, max_rounds, block):
        for _ in range(block):
            for d in dims:
                held = F.sum("weight").over(W.partitionBy(f"__mix_{d}"))
                now = now.withColumn("weight", F.when(held > 0, F.least(F.col("weight") * F.col(f"__share_{d}") / held, bound)).otherwise(0.0))
        now = stored(now, "mix-round")
        off = 0.0
        for d in dims:
            gap = now.groupBy(f"__mix_{d}").agg(F.abs(F.sum("weight") - F.first(f"__share_{d}")).alias("gap"))
            off = max(off, gap.agg(F.max("gap")).first()[0] or 0.0)
        if off <= tolerance or (budget is not None and off >= 0.9 * before):
            break
        before = off
    if off > tolerance:
        warnings.warn(f"raking ends {off:.2g} of all weight off a target share", stacklevel=2)
    return now.drop(*[f"__share_{d}" for d in dims])


def mix(docs: DataFrame, dims: Mapping[str, str | Column], targets: Mapping[str, DataFrame] | None = None, power: float = 0.9, top_rate: float = 1.0, id: str = "doc_id", text: str = "text", seed: int = 0, budget: float | None = None, saturated: float = 0.05) -> DataFrame:
    """The sampled documents, with ``keep_rate``.

    ``dims``: name and column of each dimension; ``targets``: per dimension
    (category, share), by default the tokens' own shares to ``power``;
    ``budget``: expected tokens to keep, by default chosen by ``saturated``.
    """
    names = list(dims)
    frame = docs.drop("keep_rate")
    for d in names:
        frame = frame.withColumn(f"__mix_{d}", (F.col(quoted(dims[d])) if isinstance(dims[d], str) else dims[d]).cast("string"))
    body = text_or_empty(F.col(quoted(text)))
    frame = frame.withColumn("__mix_tokens", F.greatest(F.regexp_count(body, F.lit(NOT_SPACE)), F.lit(1)))
    counted = stored(cells(frame, names), "mix-tokens")
    goals = dict(targets or {})
    for d in names:
        if d not in goals:
            sums = counted.groupBy(F.col(f"__mix_{d}").alias("category")).agg(F.sum("tokens").alias("tokens"))
            goals[d] = tempered(sums, power)
    raked = rake(counted, names, goals)
    raw = F.col("weight") / F.col("tokens")
    # The rate below which cells with all but ``saturated`` of the tokens lie, and the largest.
    own, most = raked.where("weight > 0").select(raw.alias("raw"), "tokens").agg(F.percentile("raw", F.lit(1 - saturated), F.col("tokens")), F.max("raw")).first()
    if own:
        budget = top_rate / own if budget is None else budget
        if budget * most > top_rate * (1 + 1e-9):
            raked = rake(counted, names, goals, budget=budget / top_rate)
    rates = raked.select(
        *[F.col(f"__mix_{d}").alias(f"__cell_{d}") for d in names],
        F.least(F.lit(float(top_rate)), F.lit(float(budget or 0.0)) * raw).alias("keep_rate"),
    )
    rates = stored(rates, "mix-rates")
    same = F.lit(True)
    for d in names:
        same = same & F.col(f"__mix_{d}").eqNullSafe(F.col(f"__cell_{d}"))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(quoted(id)).cast("string"), F.md5(body)), F.lit(1 << 53)) / float(1 << 53)
    chosen = frame.join(rates, same).where(draw < F.col("keep_rate"))
    return chosen.drop(*[f"__mix_{d}" for d in names], *[f"__cell_{d}" for d in names], "__mix_tokens")
