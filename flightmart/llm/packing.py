"""Best-two-fit packing of tokenised documents into fixed-length sequences.

A document is its token ids and an end id.  One longer than a sequence is cut
from its end into pieces of full length, so that only its first piece may be
shorter; nothing else is cut, dropped or padded.

Best-two-fit fills one sequence at a time: the largest piece that fits, again
and again; once none fits, the sequence's smallest piece is exchanged for the
two unpacked pieces that fill its place and the gap most tightly, if any two
fill more than it did.  Pieces of one length are interchangeable, so the
packing is planned over the histogram of lengths (``window`` numbers at most,
whatever the corpus): one step plans all the sequences of one content, as
many as the counts allow before a choice would change.  The plan is what a
loop over single pieces would do, and holds about ``window`` x ln(``window``)
runs at most; only it and the histogram meet the driver.

Pieces then take their places by rank within their length.  A length can hold
most of the pieces, so ranks are made in chunks of it: a row number within
each chunk, plus the pieces of the chunks before.  Texts are read once and
never shuffled; pieces (ids, lengths and a checksum) are written first, which
fixes their numbers should an executor be lost.

Edge cases: a null text counts as empty, and an empty one is its end id
alone; repeated rows are packed each; null ids stay null; an empty table
gives an empty result; other columns are not looked at; a text's length
matters only to the memory of the task that encodes it.
"""

from __future__ import annotations

import codecs
import json
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ._common import quoted, stored
from .bpe import BYTE_CHARS, LETTERS, SIMPLE

#: The byte-level pre-tokeniser's pattern, for texts that ``SIMPLE`` matches.
PARTS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
#: What byte-level BPE writes each byte as.
WRITTEN = "".join(chr(BYTE_CHARS.get(b, b)) for b in range(256))
#: Least pieces of one length that are ranked together.
CHUNK = 2048


class Encoder:
    """Whole texts to ids, many texts at a time.

    A space before a printed character always starts a new part of the
    byte-level pre-tokeniser, so texts are cut there, each distinct unit is
    encoded once, and a text's ids are gathered from those of its units.
    Texts that this does not hold for go to the library whole.
    """

    #: Texts are cut in groups of about so many characters.
    GROUP = 1 << 22
    #: New units that are encoded together.
    TOGETHER = 1 << 13
    #: Marks a text's first unit, which has no space before it (no simple text holds it).
    FIRST = "\x01"

    def __init__(self, path: str, memory: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_units = (
            spec.get("normalizer") is None
            and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) == ("ByteLevel", False, True)
        )
        self.marks = [str(t) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.memory = memory

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """One encoder per Python worker, which remembers its units from task
        to task: a class that travels by value is made once per process."""
        if getattr(cls, "made", (None, None))[0] != path:
            cls.made = path, cls(path)
        return cls.made[1]

    def has_units(self, text: str) -> bool:
        """Whether every space of a text stands before a printed character."""
        loose = text.endswith(" ") or "  " in text or any(f" {c}" in text for c in "\t\n\v\f\r")
        return self.by_units and not loose and SIMPLE.fullmatch(text) is not None and not any(m in text for m in self.marks)

    def learn(self, units: list[str]) -> list[bytes]:
        """The ids of units that are not known yet."""
        texts = [u[1:] if u[:1] == self.FIRST else " " + u for u in units]
        found = [PARTS.findall(t) for t in texts]
        wanted = {p for ps in found for p in ps}
        new = list(wanted.difference(self.parts))
        if len(self.parts) + len(new) > self.memory:
            self.parts = {p: self.parts[p] for p in wanted.difference(new)}
        tokenize, parts = self.tokenizer.model.tokenize, self.parts
        # As the tokeniser writes bytes; no part holds the mark, which keeps the parts apart.
        written = codecs.charmap_decode(self.FIRST.join(new).encode(), "strict", WRITTEN)[0].split(chr(BYTE_CHARS[1]))
        for p, w in zip(new, written):
            parts[p] = array("I", [t.id for t in tokenize(w)]).tobytes()
        return [parts[ps[0]] if len(ps) == 1 else b"".join([parts[p] for p in ps]) for ps in found]

    def from_units(self, texts: list[str]) -> list[bytes]:
        cut = pc.split_pattern(pa.array([self.FIRST + t for t in texts], pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.units.get, names))
        new = [k for k, ids in enumerate(known) if ids is None]
        for at in range(0, len(new), self.TOGETHER):
            some = new[at : at + self.TOGETHER]
            for k, ids in zip(some, self.learn([names[k] for k in some])):
                known[k] = ids
        if len(self.units) + len(new) > self.memory:
            self.units = dict(zip(names, known))  # the units of this group alone
        else:
            self.units.update((names[k], known[k]) for k in new)
        size = np.fromiter(map(len, known), np.int32, len(known)) // 4
        pool = np.frombuffer(b"".join(known), dtype="<u4")
        begin = np.cumsum(size) - size
        unit = coded.indices.to_numpy(zero_copy_only=False)
        width = size[unit]
        end = np.cumsum(width)
        whole = len(end) and int(end[-1])
        small = np.int32 if max(whole, len(pool)) < 1 << 31 else np.int64
        at = np.repeat((begin[unit] - (end - width)).astype(small), width)
        at += np.arange(whole, dtype=small)
        ids = pool[at]
        edge = np.concatenate([[0], end])[cut.offsets.to_numpy()]
        del cut, coded, at
        pa.default_memory_pool().release_unused()
        return [ids[a:b].tobytes() for a, b in zip(edge, edge[1:])]

    def ids(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Per text its little-endian unsigned 32-bit ids, without a template's special tokens."""
        texts, group = iter(texts), [""]
        while group:
            group, chars = [], 0
            for t in texts:
                group.append(t)
                chars += len(t)
                if chars >= self.GROUP:
                    break
            whole = [self.has_units(t) for t in group]
            quick = iter(self.from_units([t for t, w in zip(group, whole) if w]) if any(whole) else [])
            for t, w in zip(group, whole):
                yield next(quick) if w else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()


def cuts(n: int, window: int) -> list[int]:
    """Where the pieces of ``n`` tokens start, and ``n``."""
    head = n % window
    return [0, *range(head or window, n, window), n] if n > window else [0, n]


def pieces(docs: DataFrame, path: str, window: int = 2048, end_id: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): every document's pieces."""
    rows = docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).cast("string").alias("text"))
    counted = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([rows.schema["id"], *[T.StructField(n, t) for n, t in counted]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of_worker(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            found = []
            for k, own in enumerate(encoder.ids(t.as_py() or "" for t in batch.column(1))):
                ids = own + end
                at = cuts(len(ids) // 4, window)
                found += [(k, p, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for p, (a, b) in enumerate(zip(at, at[1:]))]
            if found:
                row, *rest = (np.array(c, dtype=np.int64) for c in zip(*found))
                columns = [batch.column(0).take(pa.array(row)), pa.array(rest[0].astype(np.int32)), *map(pa.array, rest[1:])]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(cut, schema)


def best_two_fit(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Sequences as (pieces per length, how many such sequences), in packing order."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    places = np.arange(window + 1)
    largest = lambda c: np.maximum.accumulate(np.where(c > 0, places, 0))
    out = []
    while left.any():
        best, gap, at, greedy = largest(left), window, window, {}
        while length := int(best[min(gap, at)]):
            greedy[length] = times = min(int(left[length]), gap // length)
            gap, at = gap - times * length, length - 1
        final, needed = dict(greedy), dict(greedy)
        least = min(greedy)
        if gap:
            room, rest = least + gap, left.copy()
            for length, times in greedy.items():
                rest[length] -= times
            best, first = largest(rest), np.flatnonzero(rest[:room])
            second = best[np.minimum(first, room - first)]
            alone = (second == first) & (rest[first] < 2)
            second = np.where(alone, best[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            if len(total) and total.max() > least:
                k = len(total) - 1 - int(total[::-1].argmax())
                final[least] -= 1
                for length in (int(first[k]), int(second[k])):
                    final[length] = final.get(length, 0) + 1
                    needed[length] = needed.get(length, 0) + 1
        final = {length: times for length, times in final.items() if times}
        again = min((int(left[length]) - needed[length]) // times for length, times in final.items()) + 1
        for length, times in final.items():
            left[length] -= again * times
        out.append((final, again))
    return out


def runs(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """One row per sequence content and length in it, by (length, first rank):
    length, first rank, pieces per sequence, first sequence, offset."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for content, again in plan:
        offset = 0
        for length, times in sorted(content.items(), reverse=True):
            out.append((length, taken.get(length, 0), times, sequence, offset))
            taken[length] = taken.get(length, 0) + again * times
            offset += length * times
        sequence += again
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def ranked(rows: DataFrame, counts: dict[int, int], chunk: int = CHUNK) -> DataFrame:
    """``rows`` (with unique ``row``) numbered from 0 within their length, as
    ``rank``, in chunks of about ``chunk`` rows or the root of the count."""
    parts = [(n, max(1, int(c / max(chunk, c**0.5)))) for n, c in counts.items()]
    spark = rows.sparkSession
    dealt = rows.join(F.broadcast(spark.createDataFrame(parts, "length long, __parts long")), "length")
    dealt = dealt.withColumn("__chunk", F.pmod(F.xxhash64("row"), F.col("__parts"))).drop("__parts")
    sizes = dealt.groupBy("length", "__chunk").count()
    before = F.sum("count").over(W.partitionBy("length").orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("length", "__chunk", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.row_number().over(W.partitionBy("length", "__chunk").orderBy("row"))
    numbered = dealt.withColumn("__within", within).join(sizes, ["length", "__chunk"])
    return numbered.withColumn("rank", F.col("__before") + F.col("__within") - 1).drop("__chunk", "__within", "__before")


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece."""
    rows = stored(pieces(docs, path, window, end_id, id, text).withColumn("row", F.monotonically_increasing_id()), "packing_pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    table = runs(best_two_fit(counts, window))
    starts = table[:, 0] << 44 | table[:, 1]
    schema = T.StructType([f for f in rows.schema if f.name != "row"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = schema.names[:-2]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            _, first, times, sequence, offset = table[np.searchsorted(starts, length << 44 | rank, "right") - 1].T
            own = rank - first
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence + own // times), pa.array(offset + own % times * length)], names=schema.names)

    return ranked(rows, counts).mapInArrow(place, schema)
