"""Chat formatting by schema fingerprints.

A record is a JSON document.  Its fingerprint is a hash of its sorted nested
field paths with their kinds (``messages[].role:string``); values never
count.  A registry of mappings names the fingerprints it knows: each mapping
is data, a list of rules that say which paths give roles and texts.  So
prompt/completion, instruction/output and message layouts all become
canonical turns, and a layout that nobody declared is reported as unmatched
rather than guessed.

Formatting writes each turn between control strings.  Control strings inside
roles and texts are escaped reversibly: every ``<``, back-slashes, ``|``
gets one more back-slash, so ``<|`` never stands in an escaped text, and
taking one away again restores any text.  Roles also escape back-slashes and
line breaks.  Loss spans are code point ranges of the formatted string that
hold the assistant texts.

Edge cases: null and missing texts and roles count as empty; nulls leave a
field's path out, so the mapping with optional fields still matches; a
record that is null or no JSON object, or whose paths match no mapping, has
null turns and ``mapping`` null; a record without turns formats to an empty
string; equal turns are kept, as often as they come.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import quoted

START, END, ROLE_END = "<|im_start|>", "<|im_end|>\n", "\n"
TURNS = "array<struct<role: string, text: string>>"


def paths(value: object, at: str = "") -> set[str]:
    """Nested field paths with their kinds; nulls and empty lists have none."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value))
    if value is None:
        return set()
    kind = "bool" if isinstance(value, bool) else "number" if isinstance(value, (int, float)) else "string"
    return {f"{at}:{kind}"}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode("utf-8", "surrogatepass")).hexdigest()[:32]


@dataclass(frozen=True)
class Mapping:
    """Which paths become turns.

    ``fields``: (path, role) pairs in turn order; or ``each``: the path of a
    list with the paths of role and text inside an item, and role names to
    rewrite.  ``optional`` paths may be absent.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    rename: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()

    def needed(self) -> list[str]:
        if self.each:
            items, role, text = self.each
            return [f"{items}[].{role}:string", f"{items}[].{text}:string"]
        return [f"{p}:string" for p, _ in self.fields]

    def fingerprints(self) -> set[str]:
        """Of the layout with and without each of the optional paths."""
        out, optional = set(), [f"{p}:string" for p in self.optional]
        for bits in range(1 << len(optional)):
            left = {p for k, p in enumerate(optional) if bits >> k & 1}
            out.add(fingerprint(set(self.needed()) - left))
        return out

    def turns(self, record: dict) -> list[tuple[str, str]]:
        names = dict(self.rename)
        if self.each:
            items, role, text = self.each
            found = [(at(i, role), at(i, text)) for i in at(record, items) or []]
        else:
            found = [(r, at(record, p)) for p, r in self.fields if p not in self.optional or at(record, p) is not None]
        return [(names.get(r or "", r or ""), t or "") for r, t in found]


def at(record: object, path: str) -> object:
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record


#: Layouts known by default; more can be given.
MAPPINGS = (
    Mapping("messages", each=("messages", "role", "content"), optional=("messages[].role", "messages[].content")),
    Mapping("share", each=("conversations", "from", "value"), rename=(("human", "user"), ("gpt", "assistant")), optional=("conversations[].from", "conversations[].value")),
    Mapping("nested", each=("dialog.turns", "speaker.role", "utterance"), optional=("dialog.turns[].speaker.role", "dialog.turns[].utterance")),
    Mapping("prompt", fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("instruction", fields=(("system", "system"), ("instruction", "user"), ("output", "assistant")), optional=("system",)),
)


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    """Mappings by fingerprint; the first one declared wins."""
    out: dict[str, Mapping] = {}
    for m in mappings:
        for f in m.fingerprints():
            if f != fingerprint(set()):
                out.setdefault(f, m)
    return out


def canonical(records: DataFrame, record: str = "record", mappings=MAPPINGS) -> DataFrame:
    """``records`` with ``fingerprint``, ``mapping`` and ``turns`` (columns
    of these names are replaced)."""
    known = registry(mappings)

    @F.pandas_udf(f"fingerprint string, mapping string, turns {TURNS}")
    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                try:
                    value = json.loads(t) if t is not None else None
                except ValueError:
                    value = None
                if not isinstance(value, dict):
                    rows.append((None, None, None))
                    continue
                f = fingerprint(paths(value))
                m = known.get(f)
                rows.append((f, m.name if m else None, [{"role": r, "text": x} for r, x in m.turns(value)] if m else None))
            yield pd.DataFrame(rows, columns=["fingerprint", "mapping", "turns"])

    kept = [F.col(quoted(c)) for c in records.columns if c.lower() not in ("fingerprint", "mapping", "turns")]
    return records.select(*kept, mapped.asNondeterministic()(F.col(quoted(record))).alias("__chat")).select(*kept, "__chat.*")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string and the spans under the loss mask."""
    out, spans, size = [], [], 0
    for role, text in turns:
        head, body = START + escape_role(role) + ROLE_END, escape(text)
        if role == "assistant":
            spans.append((size + len(head), size + len(head) + len(body)))
        out += [head, body, END]
        size += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    out, i = [], 0
    while i < len(formatted):
        head = formatted.index(ROLE_END, i)
        stop = formatted.index(END, head)
        out.append((unescape_role(formatted[i + len(START) : head]), unescape(formatted[head + 1 : stop])))
        i = stop + len(END)
    return out


def formatted(canonical_turns: DataFrame, turns: str = "turns") -> DataFrame:
    """The rows with ``formatted`` and ``loss_spans`` (replaced if present)."""

    @F.pandas_udf("formatted string, loss_spans array<struct<begin: int, stop: int>>")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            got = [None if t is None else render([(x["role"] or "", x["text"] or "") for x in t]) for t in rows]
            yield pd.DataFrame(
                {
                    "formatted": [None if g is None else g[0] for g in got],
                    "loss_spans": [None if g is None else [{"begin": a, "stop": b} for a, b in g[1]] for g in got],
                }
            )

    kept = [F.col(quoted(c)) for c in canonical_turns.columns if c.lower() not in ("formatted", "loss_spans")]
    return canonical_turns.select(*kept, made.asNondeterministic()(F.col(quoted(turns))).alias("__made")).select(*kept, "__made.*")


def digests(rows: DataFrame) -> DataFrame:
    """What can be read back from ``formatted`` and ``loss_spans`` alone:
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    @F.pandas_udf(schema)
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in batches:
            out = []
            for t, s in zip(texts, spans):
                if t is None:
                    out.append((None,) * 5)
                    continue
                turns = read_back(t)
                every = "".join(f"{r}\n{x}\n" for r, x in turns)
                loss = "".join(unescape(t[x["begin"] : x["stop"]]) for x in s)
                out.append((len(turns), _sha(every), len(loss), _sha(loss), len(t)))
            yield pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kept = [F.col(quoted(c)) for c in rows.columns]
    return rows.select(*kept, read.asNondeterministic()("formatted", "loss_spans").alias("__read")).select(*kept, "__read.*")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def as_records(turns: DataFrame, id: str = "conv_id") -> DataFrame:
    """(id, record): rows by turn gathered into JSON records of several
    layouts, the way such corpora come.  Two-turn user/assistant exchanges
    become prompt or instruction records, with a leading system turn
    instruction records, others one of the three message layouts by id."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    every = turns.groupBy(F.col(quoted(id)).alias("id")).agg(F.array_sort(F.collect_list(row)).alias("t"))
    roles = F.transform("t", lambda x: x.role)
    are = lambda *names: roles == F.array(*map(F.lit, names))
    text = lambda i: F.get("t", F.lit(i))["text"]
    pick = F.pmod(F.xxhash64("id"), F.lit(3))
    pair = F.when(pick == 0, F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion")))).otherwise(
        F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("output")))
    )
    triple = F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output")))
    share_role = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    messages = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x.role.alias("role"), x.text.alias("content"))).alias("messages")))
    share = F.to_json(F.struct(F.transform("t", lambda x: F.struct(share_role(x.role).alias("from"), x.text.alias("value"))).alias("conversations")))
    nested = F.to_json(
        F.struct(F.struct(F.transform("t", lambda x: F.struct(F.struct(x.role.alias("role")).alias("speaker"), x.text.alias("utterance"))).alias("turns")).alias("dialog"))
    )
    plain = ~F.exists("t", lambda x: x.role.isin("human", "gpt"))
    record = (
        F.when(are("user", "assistant"), pair)
        .when(are("system", "user", "assistant"), triple)
        .when(pick == 0, messages)
        .when((pick == 1) & plain, share)
        .otherwise(nested)
    )
    return every.select("id", record.alias("record"))
