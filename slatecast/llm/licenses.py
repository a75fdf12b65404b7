"""License scans with template markup compiled into token automata.

A template is a line of words with two kinds of markup: ``[[words]]`` may be
left out (and may nest), ``{{n}}`` stands for one to n words of any wording.
Everything else is mandatory and must match word by word. A template becomes a
token automaton whose sets of states are joined on demand, so a scan takes one
dictionary step a word, and starts only at words that open some template.

The templates are whole wordings (a text that shares an opening and goes on
otherwise isn't accepted) and short notices that name a licence.

Words: A-Z are lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.
Defined cases: a null text counts as empty (no words, no labels); a null doc_id
is kept; repeated rows are scanned each; whole texts are read, however long; an
empty table gives an empty result. Other columns are not read, whatever their
names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.llm.license_texts import TEMPLATES

#: Phrases and labels of the base rule.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_BREAKS = bytes(i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else i + 32 if 0x41 <= i <= 0x5A else 32
                for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BREAKS).split()


class Automaton:
    """States are positions in the template; ``step`` maps a set of them over one word."""

    def __init__(self, template: str):
        self.exact: list[dict[bytes, int]] = []
        self.any: list[int | None] = []
        self.skip: list[list[int]] = []
        start = self._state()
        tokens = re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", template)
        end, rest = self._sequence(tokens, start)
        if rest:
            raise ValueError(f"unbalanced markup in {template!r}")
        self.final = end
        self.start = self._closed({start})
        if self.final in self.start:
            raise ValueError("a template needs mandatory words")
        self.opening = {w for s in self.start for w in self.exact[s]}
        if any(self.any[s] is not None for s in self.start):
            raise ValueError("a template starts with a fixed or an optional word")
        self._steps: dict[tuple[frozenset, bytes], frozenset] = {}

    def _state(self) -> int:
        self.exact.append({})
        self.any.append(None)
        self.skip.append([])
        return len(self.exact) - 1

    def _sequence(self, tokens: list[str], at: int) -> tuple[int, list[str]]:
        while tokens:
            token, tokens = tokens[0], tokens[1:]
            if token == "]]":
                return at, ["]]", *tokens]
            if token == "[[":
                opened = at
                at, tokens = self._sequence(tokens, at)
                if not tokens:
                    raise ValueError("[[ without ]]")
                tokens, closed = tokens[1:], self._state()
                self.skip[at].append(closed)
                self.skip[opened].append(closed)
                at = closed
            elif token.startswith("{{"):
                after = self._state()
                for _ in range(int(token[2:-2])):
                    following = self._state()
                    self.any[at] = following
                    self.skip[following].append(after)
                    at = following
                at = after
            else:
                following = self._state()
                self.exact[at][token.encode()] = following
                at = following
        return at, []

    def _closed(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        known = any(word in self.exact[s] for s in states)
        key = (states, word if known else b"")
        if key not in self._steps:
            after = {self.exact[s][word] for s in states if known and word in self.exact[s]}
            after |= {self.any[s] for s in states if self.any[s] is not None}
            self._steps[key] = self._closed(after)
        return self._steps[key]

    def end_from(self, words: Sequence[bytes], at: int) -> int | None:
        """Where the longest accepted stretch that starts at ``at`` ends, or None."""
        states, found = self.start, None
        for i in range(at, len(words)):
            states = self.step(states, words[i])
            if not states:
                break
            if self.final in states:
                found = i + 1
        return found


class Scanner:
    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, str]):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.automata = [(label, Automaton(t)) for label, t in templates.items()]
        self.by_word: dict[bytes, list] = {}
        for label, a in self.automata:
            for w in a.opening:
                self.by_word.setdefault(w, []).append((label, a))
        self.opening = {p[0] for p, _ in self.phrases} | set(self.by_word)
        # a word every match must hold: texts without any of them need no word positions
        self.needed = {p[-1] for p, _ in self.phrases} | {self._mandatory(t) for t in templates.values()}

    @staticmethod
    def _mandatory(template: str) -> bytes:
        bare = template
        while "[[" in bare:
            bare = re.sub(r"\[\[(?:(?!\[\[|\]\]).)*\]\]", " ", bare)
        return max(re.sub(r"\{\{\d+\}\}", " ", bare).split(), key=len).encode()

    def scan(self, text: bytes | None) -> tuple:
        words = words_of(text or b"")
        base, starts, labels, spans = set(), [], set(), []
        after: dict[str, int] = {}   # stretches of one label don't overlap
        if any(w in text.translate(_BREAKS) for w in self.needed) if text else False:
            for i, word in enumerate(words):
                if word not in self.opening:
                    continue
                for phrase, label in self.phrases:
                    if words[i:i + len(phrase)] == phrase:
                        base.add(label)
                        starts.append(i)
                for label, automaton in self.by_word.get(word, ()):
                    end = automaton.end_from(words, i) if i >= after.get(label, 0) else None
                    if end is not None:
                        after[label] = end
                        labels.add(label)
                        spans.append((label, i, end))
        return len(words), starts, base, labels, spans


def scan_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """Every document with its labels and matched stretches.

    Returns doc_id, n_words, starts (of base phrases), base_labels, labels (base
    and template labels together), spans (label, first word, word after the last).
    """
    span = "array<struct<label:string,first:long,after:long>>"
    schema = (f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words long, starts array<long>, "
              f"base_labels array<string>, labels array<string>, spans {span}")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for part in parts:
            found = [scanner.scan(t) for t in part.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                part.column(0),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.list_(pa.int64())),
                pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
                pa.array([sorted(f[2] | f[3]) for f in found], pa.list_(pa.string())),
                pa.array([[{"label": a, "first": b, "after": c} for a, b, c in f[4]] for f in found],
                         pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64())]))),
            ], names=["doc_id", "n_words", "starts", "base_labels", "labels", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def license_report(scanned: DataFrame) -> DataFrame:
    """One flat row per document; score 1 if a template accepted, 0.5 for a base phrase alone, else 0."""
    return scanned.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        F.when(F.size("spans") > 0, 1.0).when(F.size("starts") > 0, 0.5).otherwise(0.0).alias("score"),
        F.size("spans").cast("long").alias("n_templates"))
