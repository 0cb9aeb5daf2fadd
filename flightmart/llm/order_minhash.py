"""Order MinHash fingerprints, in DataFrame operations.

A text's k-mers are its runs of ``k`` words, each numbered by how often it
stood in the text before.  A hash of k-mer and number deals them into bins,
one per component of the signature; each bin selects its ``l`` smallest,
puts them back into text order and hashes this tuple.  Equal components ask
for the same k-mers in the same order, so likeness falls with edits and with
moved passages, not only with the set of words.

All of it is one expression over arrays: two sorts per text, no shuffle.

Pairing with the next document (ascending id) has no global sort either:
ids are cut at approximate quantiles into buckets, the window runs per
bucket, and the first document of each bucket also stands at the end of the
bucket before.  Only bucket edges (as many as buckets) reach the driver.

Edge cases: a null text counts as empty; a text without words has an empty
fingerprint, which is like another empty one (1) and unlike all others (0);
fewer than ``k`` words are one k-mer; null ids sort first; equal ids follow
the order of their texts; with one document the next is itself; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import let, quoted, text_or_empty

#: Low bits of a packed long that hold a word's place in the text.
PLACE = 24
LOW = (1 << PLACE) - 1


def _packed(value: Column, place: Column) -> Column:
    return value.bitwiseAND(F.lit(~LOW)).bitwiseOR(F.least(place, F.lit(LOW)).cast("long"))


def components(text: Column, k: int = 2, l: int = 2, bins: int = 32) -> Column:
    """The signature: one tuple hash per bin that has k-mers, bin included."""
    shift = 64 - (bins - 1).bit_length()
    bin_of = lambda x: F.shiftrightunsigned(x, shift)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")

    def kmers(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0)))
        return F.transform(places, lambda i: _packed(F.xxhash64(*[F.get(w, i + d) for d in range(k)]), i))

    def numbered(s: Column) -> Column:
        """(k-mer, number) hashes with their places, from sorted k-mers."""
        head = lambda j: F.shiftright(F.get(s, j), PLACE)
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (head(j) != head(j - 1)))

        def runs(t: Column) -> Column:
            return F.transform(
                t,
                lambda a, q: F.transform(
                    F.sequence(a, F.coalesce(F.get(t, q + 1), F.size(s)) - 1),
                    lambda j: _packed(F.xxhash64(head(j), j - a), F.get(s, j).bitwiseAND(F.lit(LOW))),
                ),
            )

        return F.flatten(let(starts, runs))

    def smallest(s: Column) -> Column:
        return F.filter(s, lambda x, j: (j < l) | (bin_of(F.get(s, j - l)) != bin_of(x)))

    def tuples(p: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda j: (j == 0) | (bin_of(F.get(p, j)) != bin_of(F.get(p, j - 1))))

        def of(j: Column) -> Column:
            own = F.filter(F.slice(p, j + 1, l), lambda x: bin_of(x) == bin_of(F.get(p, j)))
            in_order = F.array_sort(F.transform(own, lambda x: F.struct(x.bitwiseAND(F.lit(LOW)).alias("place"), F.shiftright(x, PLACE).alias("kmer"))))
            return F.xxhash64(bin_of(F.get(p, j)), F.transform(in_order, lambda x: x["kmer"])).bitwiseAND(F.lit(0xFFFFFFFF))

        return F.transform(first, of)

    def signature(w: Column) -> Column:
        chosen = let(F.sort_array(kmers(w)), lambda s: let(F.sort_array(numbered(s)), lambda g: let(smallest(g), tuples)))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(chosen)

    return let(words, signature)


def as_text(parts: Column) -> Column:
    """A fingerprint string: eight hexadecimal digits per component."""
    return F.array_join(F.transform(parts, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Equal components over the larger number of components, 0 to 1."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / most)


def with_next(rows: DataFrame, id: str, text: str, carried: list[str], buckets: int = 256) -> DataFrame:
    """``rows`` with ``next_<c>`` of the next row, ascending id, for the
    ``carried`` columns; the last row's next is the first."""
    at, body = F.col(quoted(id)), F.col(quoted(text))
    cuts = rows.agg(F.percentile_approx(at, [i / buckets for i in range(1, buckets)], 10_000)).first()[0]
    edges = sorted(set(cuts or []))
    bounds = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<bigint>")
    place = lambda c: F.when(c.isNull(), F.lit(0)).otherwise(1 + F.size(F.filter(bounds, lambda e: e <= c)))
    placed = rows.withColumn("__bucket", place(at)).withColumn("__guest", F.lit(0))
    heads = sorted((r[0], r[1]) for r in placed.groupBy("__bucket").agg(F.min(at)).collect())
    if not heads:
        return placed.select("*", *[F.col(quoted(c)).alias(f"next_{c}") for c in carried]).drop("__bucket", "__guest")
    least = at.isNull() if heads[0][0] == 0 else at == heads[0][1]
    every = placed.union(rows.where(least).withColumn("__bucket", F.lit(heads[-1][0])).withColumn("__guest", F.lit(2)))
    if len(heads) > 1:
        before = F.create_map(*[F.lit(x) for (b, _), (_, low) in zip(heads, heads[1:]) for x in (low, b)])
        guests = rows.where(at.isin([low for _, low in heads[1:]]))
        every = every.union(guests.withColumn("__bucket", F.element_at(before, at)).withColumn("__guest", F.lit(1)))
    window = W.partitionBy("__bucket").orderBy("__guest", at.asc_nulls_first(), body)
    led = every.select("*", *[F.lead(F.col(quoted(c))).over(window).alias(f"next_{c}") for c in carried])
    return led.where("__guest = 0").drop("__bucket", "__guest")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 2, l: int = 2, bins: int = 32) -> DataFrame:
    """(id, text, parts): every text's signature."""
    body = text_or_empty(F.col(quoted(text)))
    return docs.select(F.col(quoted(id)).alias(id), body.alias("text")).withColumn("parts", components(F.col("text"), k, l, bins))


def edited_likeness(docs: DataFrame, id: str = "doc_id", text: str = "text", **shape: int) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the last
    quarter replaced from the next document), and both likenesses."""
    rows = with_next(fingerprints(docs, id, text, **shape), id, "text", ["text", "parts"])
    n = F.length("text")
    q = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - q), F.substring("next_text", F.lit(1), q))
    made = rows.select(F.col(quoted(id)), n.cast("long").alias("n_chars"), edited.alias("edited"), "parts", "next_parts")
    made = made.withColumn("edited_parts", components(F.col("edited"), **shape))
    return made.select(
        F.col(quoted(id)),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("parts")).alias("fingerprint"),
        as_text(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"),
    )
