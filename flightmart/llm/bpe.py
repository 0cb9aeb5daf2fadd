"""BPE encoding and decoding of whole texts, by tree concatenation.

The vocabulary file's normaliser and pre-tokeniser never join characters
across ASCII white space, so a run without any is encoded on its own, and
each task keeps the short runs it has met (frequent ones are encoded once),
up to a number of them.  A task holds one small batch of rows and the
pieces of one row at a time, whatever the size of its partition.

Long unsplit text goes by halves: a run above ``LONG`` characters is cut in
the middle again and again, the pieces are encoded, and two neighbours are
concatenated by encoding a window around their join, which grows until a
piece of it equals one of the left half, and a later one equals one of the
right half (same place, same tokens), with a guard of characters between
these and any cut.  Texts above ``leaf`` characters are cut the same way
into rows, so that the halves of one long text are encoded by different
tasks; they are joined level by level as rows of one text.

Edge cases: a null text counts as empty; an empty text has no tokens; rows
with one id and one text give one result each; an empty table gives an
empty result.  Ids can be of any type that casts to a string.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import hold_arrow_batches
from ._common import giving_back, quoted, text_or_empty

LONG = 512
#: Runs and parts above so many characters are not kept from text to text.
KEPT = 32
#: Bytes of an Arrow batch that a worker gets, about; rows that it returns at once, of whole texts and of leaves.
BATCH_BYTES, TOGETHER, LEAVES_TOGETHER = 4 << 20, 256, 64
FIRST_WINDOW, GUARD = 64, 16
RUN = re.compile(r"[^\x20\x09-\x0d]+")
#: Letters that normal form C leaves alone and that lower-case one by one.
LETTERS = r"a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
#: Texts of these, printable ASCII and ASCII white space alone.
SIMPLE = re.compile(rf"[\x20\x09-\x0d!-~{LETTERS}\u00d7\u00f7]*")
#: (start, end, token ids): a run, or a part of a long run that tokens share no character across.
Piece = tuple[int, int, tuple[int, ...]]

#: The characters that byte-level BPE writes bytes as: printable ones as they are, others from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class Encoder:
    """A tokeniser file with whole texts, pieces of texts and decoding."""

    def __init__(self, path: str, memory: int = 200_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.runs: dict[str, tuple[int, ...]] = {}
        self.memory = memory
        self.split = self._splitter(path)
        self.marks = tuple(str(t) for t in self.tokenizer.get_added_tokens_decoder().values())

    @staticmethod
    def _splitter(path: str) -> Callable[[str], list[str]] | None:
        """The file's own pattern for simple texts, if it and lower case are
        all that such texts meet before the merges."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm = [(n["type"], n.get("pattern")) for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if norm != [("NFC", None), ("Replace", {"Regex": "\\s+"}), ("Lowercase", None)] or [p["type"] for p in pre] != ["Split", "ByteLevel"]:
            return None
        cut, as_bytes = pre
        if (cut["behavior"], cut["invert"], as_bytes["add_prefix_space"], as_bytes["use_regex"]) != ("Removed", True, False, False):
            return None
        pattern = cut["pattern"]["Regex"].replace(r"\p{L}", LETTERS).replace(r"\p{N}", "0-9")
        return None if r"\p" in pattern else re.compile(pattern).findall

    def make_room(self) -> None:
        """Between texts, all that is kept goes once it is too much."""
        every = (self.known, self.parts, self.runs)
        if sum(map(len, every)) > self.memory:
            for kept in every:
                kept.clear()

    def of_parts(self, found: list[str]) -> list[bytes]:
        """Ids of each part of a simple text."""
        parts = self.parts
        try:
            return [parts[p] for p in found]
        except KeyError:
            tokenize, large = self.tokenizer.model.tokenize, {}
            for p in {*found}.difference(parts):
                mapped = p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_CHARS)
                (parts if len(p) <= KEPT else large)[p] = array("I", [t.id for t in tokenize(mapped)]).tobytes()
        return [large[p] if p in large else parts[p] for p in found] if large else [parts[p] for p in found]

    def simple(self, text: str) -> bytes:
        """Ids of a simple text, from those of the parts that the pattern finds."""
        return b"".join(self.of_parts(self.split(text.lower())))

    def is_simple(self, text: str) -> bool:
        return self.split is not None and SIMPLE.fullmatch(text) is not None and not any(m in text for m in self.marks)

    def plain(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def learn(self, runs: set[bytes]) -> dict[bytes, bytes]:
        """Encode runs that are not known yet; those too long to be kept are returned."""
        new = {r: r.decode() for r in runs if r not in self.known}
        short = [r for r, t in new.items() if len(t) <= LONG]
        done = self.tokenizer.encode_batch_fast([new[r] for r in short], add_special_tokens=False)
        large: dict[bytes, bytes] = {}
        for r, e in zip(short, done):
            (self.known if len(new[r]) <= KEPT else large)[r] = np.array(e.ids, dtype="<u4").tobytes()
        for r, t in new.items():
            if len(t) > LONG:
                large[r] = np.array([i for p in self.tree(t, 0) for i in p[2]], dtype="<u4").tobytes()
        return large

    def ids(self, texts: list[str]) -> list[bytes]:
        """Token ids of each whole text as little-endian 32-bit integers."""
        out: list[bytes] = []
        for text in texts:
            self.make_room()
            if self.is_simple(text) and max(map(len, text.split()), default=0) <= LONG:
                out.append(self.simple(text))
                continue
            runs = text.encode().split()
            large, known = self.learn({*runs}), self.known
            out.append(b"".join([large[r] if r in large else known[r] for r in runs]))
        return out

    def leaf(self, text: str, start: int) -> bytes:
        """``packed`` pieces of a part of a text; those of a simple one are not made one by one."""
        self.make_room()
        low = text.lower() if self.is_simple(text) else ""
        runs = low.split()
        found = self.split(low) if runs and max(map(len, runs)) <= LONG else []
        if not runs or "".join(found) != "".join(runs):  # else each part lies in one run
            return packed(self.pieces(text, start), start)
        ids = self.of_parts(found)
        chars = np.frombuffer(low.encode("utf-32-le"), "<u4")
        inside = np.zeros(len(chars) + 2, np.int8)
        inside[1:-1] = (chars != 0x20) & ((chars < 0x09) | (chars > 0x0D))
        steps = np.diff(inside)
        begin, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        first = np.searchsorted(np.cumsum([len(p) for p in found]), np.cumsum(end - begin) - (end - begin), "right")
        counts = np.add.reduceat(np.fromiter(map(len, ids), np.int64, len(ids)) // 4, first)
        begin, end, counts = (x[counts > 0] for x in (begin, end, counts))
        head = np.stack([begin - np.concatenate([[0], end[:-1]]), end - begin, counts], axis=1)
        return _squeezed(len(head), head.astype(np.uint32).tobytes() + b"".join(ids))

    def strings(self) -> np.ndarray:
        """Every token's text, by id, as the tokeniser joins them when decoding."""
        size = max(self.tokenizer.get_vocab().values()) + 1
        return np.array([self.tokenizer.id_to_token(i) or "" for i in range(size)], dtype=object)

    def exact(self, text: str, base: int) -> list[Piece]:
        """Pieces of a text encoded at once: tokens that share a character stay together."""
        e = self.plain(text)
        out: list[Piece] = []
        for i, (a, b) in zip(e.ids, e.offsets):
            a, b = a + base, b + base
            if out and a < out[-1][1]:
                out[-1] = (min(out[-1][0], a), max(out[-1][1], b), (*out[-1][2], i))
            else:
                out.append((a, b, (i,)))
        return out

    def pieces(self, text: str, base: int) -> list[Piece]:
        out: list[Piece] = []
        known = self.runs
        self.make_room()
        for m in RUN.finditer(text):
            run = m.group()
            ids = known.get(run)
            if ids is None:
                if len(run) > LONG:
                    out += self.tree(run, base + m.start())
                    continue
                ids = self._run(run)
                if len(run) <= KEPT:
                    known[run] = ids
            if ids:
                out.append((base + m.start(), base + m.end(), ids))
        return out

    def _run(self, run: str) -> tuple[int, ...]:
        if self.is_simple(run):
            return tuple(np.frombuffer(self.simple(run), "<u4").tolist())
        return tuple(self.plain(run).ids)

    def window(self, text: str, low: int, high: int, start: int, end: int) -> list[Piece]:
        """A window's pieces; one run that fills [start, end) is encoded at once."""
        if low == start and high == end and RUN.fullmatch(text, low, high):
            return self.exact(text[low:high], low)
        return self.pieces(text[low:high], low)

    def tree(self, run: str, base: int) -> list[Piece]:
        """An unsplit run by halves."""
        if len(run) <= LONG:
            return self.exact(run, base)
        half = len(run) // 2
        left, right = self.tree(run[:half], base), self.tree(run[half:], base + half)
        return join(left, right, base + half, base, base + len(run), lambda a, b: self.exact(run[a - base : b - base], a))


def join(left: list[Piece], right: list[Piece], at: int, start: int, end: int, encode: Callable[[int, int], list[Piece]]) -> list[Piece]:
    """One encoding of [start, end) from those of [start, at) and [at, end).

    ``encode(a, b)``: pieces of the text between two places.  At worst the
    window grows to the whole.
    """
    reach = FIRST_WINDOW
    while True:
        low, high = max(start, at - reach), min(end, at + reach)
        window = encode(low, high)
        if low == start and high == end:
            return window
        head = _agree(left, window, low + GUARD, at - GUARD) if low > start else (0, 0)
        tail = _agree(right, window, at + GUARD, high - GUARD) if high < end else (len(right), len(window))
        if head is not None and tail is not None and head[1] <= tail[1]:
            return left[: head[0]] + window[head[1] : tail[1]] + right[tail[0] :]
        reach *= 2


def _agree(side: list[Piece], window: list[Piece], low: int, high: int) -> tuple[int, int] | None:
    """Indexes of two equal neighbouring pieces of both within [low, high)."""
    i = bisect_left(side, (low,))
    j = bisect_left(window, (low,))
    while i + 1 < len(side) and j + 1 < len(window) and max(side[i + 1][1], window[j + 1][1]) <= high:
        if side[i] == window[j] and side[i + 1] == window[j + 1]:
            return i + 1, j + 1
        if side[i][0] <= window[j][0]:
            i += 1
        else:
            j += 1
    return None


def join_leaves(text: str, edges: list[int], leaves: list[list[Piece]], encoder: Encoder) -> list[Piece]:
    """Join the encodings of a text's consecutive parts, two by two."""
    while len(leaves) > 1:
        nxt, cuts = [], [edges[0]]
        for k in range(0, len(leaves), 2):
            if k + 1 == len(leaves):
                nxt.append(leaves[k])
                cuts.append(edges[k + 1])
                continue
            a, m, b = edges[k], edges[k + 1], edges[k + 2]
            nxt.append(join(leaves[k], leaves[k + 1], m, a, b, lambda lo, hi: encoder.window(text, lo, hi, a, b)))
            cuts.append(b)
        leaves, edges = nxt, cuts
    return leaves[0] if leaves else []


def _digests(ids: bytes, strings: np.ndarray) -> tuple[int, bytes, str]:
    found = np.frombuffer(ids, "<u4")
    return len(found), ids, " ".join(strings[found].tolist())


def _opened(path: str) -> tuple[Encoder, np.ndarray]:
    encoder = Encoder(path)
    return encoder, encoder.strings()


def _tokens(ids: pa.Array, found: list[tuple[int, bytes, str]]) -> pa.RecordBatch:
    n, tokens, decoded = zip(*found)
    columns = [ids, pa.array(n, pa.int64()), pa.array(tokens, pa.binary()), pa.array(decoded, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids", "decoded"])


def _whole(path: str):
    @giving_back
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, strings = _opened(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                yield _tokens(part.column(0), [_digests(i, strings) for i in encoder.ids(part.column(1).to_pylist())])

    return of


def _leaves(path: str):
    @giving_back
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, LEAVES_TOGETHER):
                rows = batch.slice(at, LEAVES_TOGETHER)
                start, part = (rows.column(c).to_pylist() for c in (3, 4))
                pieces = pa.array([encoder.leaf(t, s) for t, s in zip(part, start)], pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns, pieces], names=["id", "key", "leaf", "start", "part", "pieces"])

    return of


def packed(pieces: list[Piece], start: int) -> bytes:
    """Pieces as gaps, lengths, token counts and ids, compressed."""
    head, at = [], start
    for a, b, ids in pieces:
        head += (a - at, b - a, len(ids))
        at = b
    return _squeezed(len(pieces), array("I", [*head, *(i for p in pieces for i in p[2])]).tobytes())


def _squeezed(n: int, rest: bytes) -> bytes:
    return zlib.compress(array("I", [n]).tobytes() + rest, 1)


def unpacked(data: bytes, start: int) -> list[Piece]:
    every = array("I", zlib.decompress(data))
    n, out, at = every[0], [], start
    tokens = every[1 + 3 * n :].tolist()
    k = 0
    for gap, size, count in zip(every[1 : 1 + 3 * n : 3], every[2 : 1 + 3 * n : 3], every[3 : 1 + 3 * n : 3]):
        out.append((at + gap, at + gap + size, tuple(tokens[k : k + count])))
        at, k = at + gap + size, k + count
    return out


def _joined(path: str):
    held: list = []

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.extend(_opened(path))
        leaves: dict[int, tuple[int, str, bytes]] = {}
        copies, own = 0, None
        for rows in batches:
            own = rows.column(0).slice(0, 1) if own is None and rows.num_rows else own
            for k, leaf in enumerate(rows.column(2).to_pylist()):
                copies += leaf == 0
                if leaf not in leaves:
                    leaves[leaf] = tuple(rows.column(c)[k].as_py() for c in (3, 4, 5))
        starts, parts, pieces = zip(*(leaves[k] for k in sorted(leaves)))
        text = "".join(parts)
        got = join_leaves(text, [*starts, len(text)], [unpacked(p, s) for p, s in zip(pieces, starts)], held[0])
        found = _digests(np.array([i for p in got for i in p[2]], dtype="<u4").tobytes(), held[1])
        for _ in range(copies):
            yield _tokens(own, [found])

    return of


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", leaf: int = 16384) -> DataFrame:
    """(id, n_tokens, ids, decoded) per row: ``ids`` as little-endian 32-bit
    integers in one binary, ``decoded`` as the file's own decoder gives it.
    ``path``: the tokeniser file, at the same place on every machine.
    Holds the session's Arrow batches to ``BATCH_BYTES``."""
    hold_arrow_batches(docs.sparkSession, BATCH_BYTES)
    kind = docs.select(F.col(quoted(id))).dtypes[0][1]
    rows = docs.select(F.col(quoted(id)).alias("id"), text_or_empty(F.col(quoted(text))).alias("text"))
    schema = f"id {kind}, n_tokens long, ids binary, decoded string"
    short = rows.where(F.length("text") <= leaf).mapInArrow(_whole(path), schema)
    # Halves, quarters, ...: as many equal parts as the least power of two that fits.
    parts = F.expr(f"shiftleft(1, cast(ceil(log2(length(text) / {leaf}D)) as int))")
    long = rows.where(F.length("text") > leaf).withColumn("key", F.sha2("text", 256)).withColumn("parts", parts)
    long = long.withColumn("leaf", F.explode(F.expr("sequence(0, parts - 1)")))
    begin = "cast(length(text) * cast({} as bigint) div parts as int)"
    long = long.withColumn("start", F.expr(begin.format("leaf"))).withColumn("stop", F.expr(begin.format("(leaf + 1)")))
    long = long.select("id", "key", "leaf", "start", F.expr("substring(text, start + 1, stop - start)").alias("part"))
    spread = long.repartition("id", "key", "leaf")  # copies of a text go to different tasks
    leaves = spread.mapInArrow(_leaves(path), f"id {kind}, key string, leaf int, start int, part string, pieces binary")
    joined = leaves.groupBy("id", "key").applyInArrow(_joined(path), schema)
    return short.union(joined)
