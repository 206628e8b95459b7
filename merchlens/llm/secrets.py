"""Secret scan: patterns, and formats learned from what they find.

Base spans are those of three patterns. Their values are the labelled credentials: for each
kind a prefix tree of character classes is built from a bounded sample and its states are
merged while their outcomes are statistically compatible (the ALERGIA test, Hoeffding bounds),
which leaves a probabilistic automaton of the format. One more automaton is learned from
ordinary long words. All other candidates of the corpus, runs of credential characters with a
letter and a digit, are scored by log likelihood under each format against the ordinary one;
those that gain at least ``LEAST_GAIN`` per character become spans of kind ``format``.

One pass over the texts finds spans and candidates; what is learned and scored afterwards are
those short strings alone.

Defined cases: a null text is empty; an empty text has no spans; repeated rows are reported each;
null ids are carried; without labelled credentials only base spans are given; an empty table gives
an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import as_array, store, table

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "format")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_WORDS = ("password", "passwd", "secret", "token", "api")

#: Credentials and ordinary words of each kind that automata are learned from, those with the least hashes.
SAMPLE = 1500
SAMPLE_LENGTH = 200
ALPHA = 0.05
#: Nodes seen less often are compatible with anything.
LEAST_SEEN = 12
LEAST_GAIN = 0.5


def symbols(value: str) -> str:
    """Character classes: hex letter, other small letter, capital, digit, and other characters as they are."""
    return "".join(
        "h" if "a" <= c <= "f" else "l" if "g" <= c <= "z" else "U" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c
        for c in value
    )


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def other_candidates(text: str, base: list[tuple]) -> list[tuple[str, int, int, str]]:
    """Runs of credential characters outside base spans; ``word`` those without both letters and digits."""
    out = []
    for m in CANDIDATE.finditer(text):
        if not any(s < m.end() and m.start() < e for _, s, e, _ in base):
            digits = sum(c.isdigit() for c in m[0])
            kind = "format" if digits and any(c.isalpha() for c in m[0]) else "word"
            out.append((kind, m.start(), m.end(), m[0]))
    return out


_SPAN = "array<struct<kind:string,start:long,end:long,value:string>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and other candidates of every row, each with its text."""
    def as_rows(found):
        return pa.array([[dict(zip(("kind", "start", "end", "value"), x, strict=True)) for x in y] for y in found], _ARROW)

    def of(batches):
        for batch in batches:
            base, other = [], []
            for text in as_array(batch.column(1)).to_pylist():
                base.append(base_spans(text))
                other.append(other_candidates(text, base[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), as_rows(base), as_rows(other)], ["doc_id", "base", "other"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(of, f"doc_id {kind}, base {_SPAN}, other {_SPAN}")


class Automaton:
    """A probabilistic automaton: per state how often it was entered, ended, and left by each symbol."""

    def __init__(self, values: list[str], alpha: float = ALPHA) -> None:
        self.seen, self.ended, self.next, self.left = [0], [0], [{}], [{}]
        for value in values:
            state = 0
            self.seen[0] += 1
            for c in symbols(value):
                if c not in self.next[state]:
                    self.next[state][c] = len(self.seen)
                    self.seen.append(0)
                    self.ended.append(0)
                    self.next.append({})
                    self.left.append({})
                self.left[state][c] = self.left[state].get(c, 0) + 1
                state = self.next[state][c]
                self.seen[state] += 1
            self.ended[state] += 1
        self.slack = sqrt(0.5 * log(2 / alpha))
        self._merge_states()
        self.alphabet = {c for x in self.left for c in x}

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.slack * (1 / sqrt(n1) + 1 / sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.seen[a], self.seen[b]
            if n1 < LEAST_SEEN or n2 < LEAST_SEEN:
                continue
            if self._differ(self.ended[a], n1, self.ended[b], n2):
                return False
            for c in self.left[a].keys() | self.left[b].keys():
                if self._differ(self.left[a].get(c, 0), n1, self.left[b].get(c, 0), n2):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.seen[a] += self.seen[b]
            self.ended[a] += self.ended[b]
            for c, n in self.left[b].items():
                self.left[a][c] = self.left[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_states(self) -> None:
        red = [0]
        while True:
            members = set(red)
            blue = [(self.seen[t], r, c, t) for r in red for c, t in self.next[r].items() if t not in members]
            if not blue:
                return
            _, source, symbol, state = max(blue, key=lambda x: (x[0], -x[1], x[2]))
            home = next((r for r in red if self._compatible(r, state)), None)
            if home is None:
                red.append(state)
            else:
                self.next[source][symbol] = home
                self._fold(home, state)

    def gain(self, value: str) -> float:
        """Log likelihood; symbols a state never left by cost as much as half an occurrence in all it saw."""
        state, total = 0, 0.0
        size = len(self.alphabet) + 2
        for c in symbols(value):
            n = self.seen[state]
            total += log((self.left[state].get(c, 0) + 0.5 / size) / (n + 0.5))
            state = self.next[state].get(c, 0)
        return total + log((self.ended[state] + 0.5 / size) / (self.seen[state] + 0.5))


def learn(found: DataFrame, sample: int = SAMPLE) -> dict[str, Automaton]:
    """One automaton per base kind, and ``word`` for ordinary words, from at most ``sample`` different values of each."""
    values = found.select(F.explode(F.concat("base", F.filter("other", lambda x: x.kind == "word"))).alias("s")).select(
        F.col("s.kind").alias("kind"), F.col("s.value").alias("value")
    ).filter(F.length("value") <= SAMPLE_LENGTH)
    out = {}
    for kind in (*KINDS[:3], "word"):
        rows = values.filter(F.col("kind") == kind).distinct().orderBy(F.xxhash64("value"), "value").limit(sample).collect()
        if rows:
            out[kind] = Automaton([r.value for r in rows])
    return out


def formats(found: DataFrame, automata: dict[str, Automaton], least: float = LEAST_GAIN) -> DataFrame:
    """``found`` (doc_id, base, other) with ``added``: candidates that gain at least ``least`` per character."""
    plain = automata.get("word")
    learned = [automata[k] for k in KINDS[:3] if k in automata]

    def ordinary(value: str) -> float:
        # Without ordinary words to learn from, any of 38 characters is as likely as another.
        return plain.gain(value) if plain else -(len(value) + 1) * log(38)

    def likely(value: str) -> bool:
        return bool(learned) and (max(a.gain(value) for a in learned) - ordinary(value)) / (len(value) + 1) >= least

    def of(batches):
        for batch in batches:
            added = [
                [{"kind": "format", "start": s["start"], "end": s["end"], "value": s["value"]} for s in x if s["kind"] == "format" and likely(s["value"])]
                for x in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(added, _ARROW)], ["doc_id", "base", "other", "added"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(of, f"doc_id {kind}, base {_SPAN}, other {_SPAN}, added {_SPAN}")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = store(find(table(spark, sf_dir, "documents")), "secrets")
    scored = formats(found, learn(found))
    every = F.array_sort(
        F.concat("base", "added"),
        lambda a, b: F.when(a.start < b.start, -1).when(a.start > b.start, 1).otherwise(
            F.array_position(F.array(*map(F.lit, KINDS)), a.kind).cast("int") - F.array_position(F.array(*map(F.lit, KINDS)), b.kind).cast("int")
        ),
    )
    def count(kind):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return scored.select(
        "doc_id", *map(count, KINDS[:3]), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined(every).alias("spans")
    )
