"""Secret scans by grammar inference.

Three fixed patterns find labelled credentials in every text. From a bounded
sample of their distinct values one probabilistic automaton is inferred for
each kind, and one more from strings of the same alphabet that no pattern claims.
Every candidate string of ``MIN_ASSIGN`` characters or more outside the patterns' spans is then scored, whole and,
where that finds nothing, in its parts between ``=``, ``/`` and ``:``. Where the likeliest format
beats the background by enough bits a character, and by ``MIN_BITS`` in all, its span is added
as kind ``format``. The second bound is a prior: one ordinary string in 2^24 may look that much like a credential, so
a short one needs a format unlike ordinary words. Spans of the patterns always stay.

Defined results: a null or empty text has no spans; rows are handled one by one;
an empty table, or one with fewer than ``MIN_EXAMPLES`` examples of either side,
gives the patterns' spans alone; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.automata import Automaton
from tidewater.llm.common import keep_table, map_batches, texts_of

# The patterns of the contract, in the order in which equal starts are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "format")
MIN_ASSIGN, MIN_ACCESS = 6, 20

MIN_LENGTH = MIN_ASSIGN  # the shortest labelled credential
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{MIN_LENGTH},}}")
PART = re.compile(r"[^=/]+")
EDGES = ".-_/"
#: At most so many distinct examples of each kind are learnt from: those with the smallest hashes.
TRAINING_EXAMPLES = 1000
MIN_EXAMPLES = 20
#: Bits a character by which a format has to beat the background, and the share of examples that may fall below.
MIN_MARGIN = 1.0
#: Bits by which it has to beat it in all.
MIN_BITS = 24.0
#: Strings that a task remembers, for words come again.
REMEMBERED = 200_000
LOST_SHARE = 0.05
MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of every match of the patterns, by start and kind; code points."""
    found = [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span):
    return span[0], KINDS.index(span[2]), span[1]


def candidates(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of strings in the credentials' alphabet that touch no span of ``taken``."""
    out, i = [], 0
    reach = 0  # the furthest end of spans that begin before the candidate ends
    for m in CANDIDATE.finditer(text):
        raw = m[0]
        value = raw.strip(EDGES)
        if len(value) < MIN_LENGTH:
            continue
        start = m.start() + len(raw) - len(raw.lstrip(EDGES))
        end = start + len(value)
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            out.append((start, end, value))
    return out


@dataclass
class Formats:
    """The automata of the kinds and of the background, and the margin of each kind."""
    kinds: dict[str, Automaton]
    background: Automaton | None
    margins: dict[str, float]

    def bits(self, value: str) -> dict[str, float]:
        """Bits a character by which each format beats the background."""
        if self.background is None:
            return {}
        base = self.background.log2(value)
        return {k: (a.log2(value) - base) / (len(value) + 1) for k, a in self.kinds.items()}

    def is_credential(self, value: str) -> bool:
        return any(x >= self.margins[k] and x * (len(value) + 1) >= MIN_BITS for k, x in self.bits(value).items())

    def found_in(self, value: str) -> list[tuple[int, int]]:
        """(start, end) in a candidate of what reads as a credential: all of it, or parts of it."""
        if self.is_credential(value):
            return [(0, len(value))]
        out = []
        for m in PART.finditer(value):
            part = m[0].strip(EDGES)
            if MIN_LENGTH <= len(part) < len(value) and self.is_credential(part):
                start = m.start() + len(m[0]) - len(m[0].lstrip(EDGES))
                out.append((start, start + len(part)))
        return out

    def added(self, text: str, taken, clean: set[str] | None = None):
        """Spans beside those ``taken``; ``clean`` remembers strings without any, so that most texts end there."""
        if self.background is None or not self.kinds:
            return []
        clean = set() if clean is None else clean
        new = set(CANDIDATE.findall(text)) - clean
        suspects = {raw for raw in new if len(value := raw.strip(EDGES)) >= MIN_LENGTH and self.found_in(value)}
        remember(clean, new - suspects)
        if not suspects:
            return []
        suspects = {raw.strip(EDGES) for raw in suspects}
        return [(start + a, start + z, "format", value[a:z]) for start, _, value in candidates(text, taken)
                if value in suspects for a, z in self.found_in(value)]

    def spans(self, text: str, clean: set[str] | None = None) -> list[tuple[int, int, str, str]]:
        base = base_spans(text)
        return sorted(base + self.added(text, base, clean), key=_order)


def remember(known: set[str], new: set[str]) -> None:
    """``new`` joins ``known``, which starts anew when full; very long strings are not kept."""
    if len(known) >= REMEMBERED:
        known.clear()
    known.update(x for x in new if len(x) <= 64)


def examples(docs: DataFrame, text: str = "text", most: int = TRAINING_EXAMPLES) -> DataFrame:
    """(kind, value, h): labelled credentials, and ``other`` for unclaimed strings, with a hash that orders them.

    A task hands on the ``most`` distinct values of each kind with the smallest hashes, which the smallest of all are among.
    """
    def run(batches):
        best: dict[str, dict[str, int]] = {k: {} for k in (*KINDS[:-1], "other")}
        met: set[str] = set()

        def least(kind):
            ranked = sorted(best[kind].items(), key=lambda x: (x[1], x[0]))[:most]
            best[kind] = dict(ranked)
            return ranked

        for batch in batches:
            for t in texts_of(batch.column(0)):
                base = base_spans(t)
                if base:
                    other = {v for *_, v in candidates(t, base)}
                else:
                    new = set(CANDIDATE.findall(t)) - met
                    remember(met, new)
                    other = {v for raw in new if len(v := raw.strip(EDGES)) >= MIN_LENGTH}
                for kind, values in (*((k, (v,)) for _, _, k, v in base), ("other", other)):
                    own = best[kind]
                    own.update((v, xxhash.xxh3_64_intdigest(v.encode()) >> 1) for v in values if v not in own)
                    if len(own) > 20 * most:
                        least(kind)
        rows = [(kind, value, h) for kind in best for value, h in least(kind)]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(
            (pa.string(), pa.string(), pa.int64()))], ["kind", "value", "h"])

    return map_batches(docs.select(text), run, "kind string, value string, h bigint").distinct()


def learn_formats(docs: DataFrame, text: str = "text", most: int = TRAINING_EXAMPLES) -> Formats:
    """Automata from at most ``most`` examples a kind, chosen by hash from all documents."""
    first = Window.partitionBy("kind").orderBy("h", "value")
    sample = (examples(docs, text, most).withColumn("n", F.row_number().over(first))
              .where(F.col("n") <= most).select("kind", "value"))
    by_kind: dict[str, list[str]] = {}
    for kind, value in keep_table(sample, "secret-examples").collect():  # bounded by ``most``
        by_kind.setdefault(kind, []).append(value)
    other = by_kind.pop("other", [])
    background = Automaton.learn(other) if len(other) >= MIN_EXAMPLES else None
    out = Formats({}, background, {})
    for kind in KINDS[:-1]:
        values = sorted(by_kind.get(kind, []))
        if background is None or len(values) < MIN_EXAMPLES:
            continue
        held, learnt = values[::5], [v for i, v in enumerate(values) if i % 5]
        out.kinds[kind] = Automaton.learn(learnt)
        scores = sorted(out.bits(v)[kind] for v in held)
        out.margins[kind] = max(MIN_MARGIN, scores[int(LOST_SHARE * len(scores))])
    return out


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


def scan(docs: DataFrame, formats: Formats, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of base spans, their digest, and all spans."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        clean: set[str] = set()
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for t in texts_of(batch.column(1)):
                base = base_spans(t)
                added = formats.added(t, base, clean)
                counts = [sum(s[2] == k for s in base) for k in KINDS[:3]]
                row = [*counts, hashlib.sha256(_joined(base).encode()).hexdigest(),
                       _joined(sorted(base + added, key=_order)), len(added)]
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    return map_batches(docs.select(key, text), run,
                       f"`{key}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
                       "base_sha256 string, spans string, n_format bigint")


def mask_text(text: str, spans) -> str:
    """The text with every secret replaced by MASK; of an assignment the name stays."""
    out, at = [], 0
    for start, end, kind, value in spans:
        start = end - len(value) if kind == "assign" else start
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start] + MASK)
        at = end
    return "".join(out) + text[at:]


def mask(docs: DataFrame, formats: Formats, text: str = "text") -> DataFrame:
    """``docs`` with its own columns, secrets replaced in the text; texts without any stay as they are."""
    at = docs.columns.index(text)

    def run(batches):
        clean: set[str] = set()
        for batch in batches:
            raw = batch.column(at).to_pylist()
            masked = [t and mask_text(t, formats.spans(t, clean)) for t in raw]
            arrays = list(batch.columns)
            arrays[at] = pa.array(masked, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return map_batches(docs, run, docs.schema)
