"""Secrets in texts: known patterns, and formats learned from what they match (grammar inference)."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import fresh
from tidepool.shared import cut_lineage

#: The known patterns, fixed values: name, pattern, group that is the credential, its least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex")
#: What ASSIGN needs somewhere in the lower-case text.
WORDS = ("passw", "secret", "token", "api")

#: The name of spans found by a learned format, and the tokens that are scored: as long as the
#: shortest credential that the known patterns label.
LEARNED = "format"
CANDIDATE = re.compile("[A-Za-z0-9+/_.=-]{%d,}" % ASSIGN_LEAST)
#: Different credentials of a kind, and other tokens, that an automaton is fitted on, and the
#: length of the longest one. Longer ones are scored, but not learned from.
PER_KIND, LONGEST = 2000, 256


def known(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential) of the known patterns, sorted; offsets are code points."""
    found = []
    low = text.lower()
    if any(word in low for word in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]  # a run of 16 or more is one match
    found.sort()
    return found


def others(text: str, spans: list[tuple], apart: bool = False) -> list[tuple[int, int, str]]:
    """(start, end, token) of the candidates that no span covers; if ``apart``, that none touches."""
    out, at, reach = [], 0, 0  # spans before ``at`` begin before the token, and end by ``reach``
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] <= start:
            reach = max(reach, spans[at][2])
            at += 1
        covered, k = max(reach, start), at
        touched = reach > start
        while k < len(spans) and spans[k][0] < end:
            touched = True
            if spans[k][0] <= covered:
                covered = max(covered, spans[k][2])
            k += 1
        if not touched or not apart and covered < end:
            out.append((start, end, m[0]))
    return out


# -- automata ---------------------------------------------------------------------------------


class Node:
    """A state: how many strings come through it, end in it, and go on by each sign, and where to."""

    __slots__ = ("count", "ends", "next", "taken")

    def __init__(self) -> None:
        self.count, self.ends = 0, 0
        self.next: dict[str, Node] = {}
        self.taken: dict[str, int] = {}


def prefix_tree(strings: list[str]) -> Node:
    root = Node()
    for string in strings:
        node = root
        node.count += 1
        for sign in string:
            node.taken[sign] = node.taken.get(sign, 0) + 1
            node = node.next.setdefault(sign, Node())
            node.count += 1
        node.ends += 1
    return root


def _alike(state: Node, tree: Node, factor: float) -> bool:
    """Whether two states may be one: all their frequencies agree within the Hoeffding bound."""
    todo = [(state, tree)]
    while todo:
        a, b = todo.pop()
        bound = factor * (1 / math.sqrt(a.count) + 1 / math.sqrt(b.count))
        if abs(a.ends / a.count - b.ends / b.count) > bound:
            return False
        for sign in a.taken.keys() | b.taken.keys():
            if abs(a.taken.get(sign, 0) / a.count - b.taken.get(sign, 0) / b.count) > bound:
                return False
            if sign in a.next and sign in b.next:
                todo.append((a.next[sign], b.next[sign]))
    return True


def _fold(into: Node, tree: Node) -> None:
    """Adds a subtree to a state, sign by sign."""
    todo = [(into, tree)]
    while todo:
        into, tree = todo.pop()
        into.count += tree.count
        into.ends += tree.ends
        for sign, child in tree.next.items():
            into.taken[sign] = into.taken.get(sign, 0) + tree.taken[sign]
            if sign in into.next:
                todo.append((into.next[sign], child))
            else:
                into.next[sign] = child


@dataclass(frozen=True)
class Automaton:
    """For each state the log probabilities of its signs with the next state, and of the end."""

    moves: tuple[dict[str, tuple[float, int]], ...]
    ends: tuple[float, ...]
    unseen: float

    def likelihood(self, string: str) -> float:
        """Mean log probability of a string's signs and its end."""
        total, state = 0.0, 0
        for sign in string:
            move = self.moves[state].get(sign)
            if move is None:
                total += self.unseen
            else:
                total += move[0]
                state = move[1]
        return (total + self.ends[state]) / (len(string) + 1)


def infer(strings: list[str], doubt: float = 0.05, unseen: float = 1e-4) -> Automaton:
    """A probabilistic automaton from examples, by merging alike states of their prefix tree.

    States next to accepted ones are taken by falling count; each is merged into the first
    accepted state that is alike (its own predecessor first), or else accepted.
    """
    root = prefix_tree(strings)
    factor = math.sqrt(0.5 * math.log(2 / doubt))
    accepted = [root]
    while True:
        held = {id(node) for node in accepted}
        border = [(child.count, sign, at, node) for at, node in enumerate(accepted)
                  for sign, child in node.next.items() if id(child) not in held]
        if not border:
            break
        _, sign, _, node = max(border, key=lambda x: (x[0], x[1], -x[2]))
        child = node.next[sign]
        for target in [node, *(n for n in accepted if n is not node)]:
            if _alike(target, child, factor):
                node.next[sign] = target
                _fold(target, child)
                break
        else:
            accepted.append(child)
    number = {id(node): k for k, node in enumerate(accepted)}
    moves = tuple({sign: (math.log(node.taken[sign] / node.count), number[id(child)])
                   for sign, child in node.next.items()} for node in accepted)
    ends = tuple(math.log(max(node.ends / node.count, unseen)) for node in accepted)
    return Automaton(moves, ends, math.log(unseen))


@dataclass(frozen=True)
class Formats:
    """Automata of credentials with the least likelihood of each, and the one of other tokens."""

    credentials: tuple[tuple[Automaton, float], ...]
    plain: Automaton | None

    def matches(self, token: str) -> bool:
        """Likely enough under some format of credentials, and likelier than as another token."""
        base = self.plain.likelihood(token) if self.plain else -math.inf
        return any((own := automaton.likelihood(token)) >= least and own > base
                   for automaton, least in self.credentials)

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, kind, end) of all spans in a whole text, sorted; learned ones are of kind 3."""
        base = known(text or "")
        more = [(start, len(KINDS), end) for start, end, token in others(text or "", base) if self.matches(token)]
        return sorted([span[:3] for span in base] + more)


def learn(docs: DataFrame, per_kind: int = PER_KIND, longest: int = LONGEST, quantile: float = 0.05,
          slack: float = 0.1, text_col: str = "text") -> Formats:
    """Formats of the credentials that the known patterns find, and of other tokens.

    Other tokens are those apart from all matches; tokens that reach beyond a match are scored only, and those
    with other signs than letters that a credential's automaton finds likely don't count as plain.

    Labelled credentials are the different matches of each kind in all documents, read once. An automaton
    is fitted on at most ``per_kind`` of a kind, of ``longest`` signs or fewer, with the
    smallest hashes; these few come to the driver. The least likelihood of a kind is that of a
    ``quantile`` of them, less ``slack`` as they fit their own automaton best. A kind without a match has no automaton; without any, no span is
    added to the known ones.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                base = known(text or "")
                found.update((kind, token) for _, kind, _, token in base if len(token) <= longest)
                found.update((len(KINDS), token) for *_, token in others(text or "", base, True) if len(token) <= longest)
            if found:
                kinds, tokens = zip(*sorted(found))
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(tokens)], ["kind", "token"])

    tokens = cut_lineage(docs.select(F.col(text_col).alias("text")).mapInArrow(of, "kind int, token string").distinct())
    chosen = tokens.where("false")
    for kind in range(len(KINDS) + 1):
        chosen = chosen.unionAll(tokens.where(F.col("kind") == kind)
                                 .orderBy(F.xxhash64("token"), "token").limit(per_kind))
    by_kind: dict[int, list[str]] = {}
    for row in chosen.collect():  # (number of kinds) x per_kind rows at most
        by_kind.setdefault(row["kind"], []).append(row["token"])
    credentials = []
    for kind in range(len(KINDS)):
        if strings := sorted(by_kind.get(kind, [])):
            automaton = infer(strings)
            least = float(np.quantile([automaton.likelihood(s) for s in strings], quantile)) - slack
            credentials.append((automaton, least))
    # a bare credential of a known format must not be learned as plain; words always are
    plain = sorted(token for token in by_kind.get(len(KINDS), [])
                   if token.isalpha() or not any(automaton.likelihood(token) >= least for automaton, least in credentials))
    return Formats(tuple(credentials), infer(plain) if plain else None)


def written(spans: list[tuple[int, int, int]]) -> str:
    names = (*KINDS, LEARNED)
    return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)


FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def found_column(spark: SparkSession, formats: Formats, text: Column) -> Column:
    """Counts of the known kinds, the digest of their spans, and all spans as text.

    NULL counts as empty: no spans, and the digest of the empty string.
    """
    sent = spark.sparkContext.broadcast(formats)  # a few states for each kind

    @F.pandas_udf(FOUND)
    def of(texts_: pd.Series) -> pd.DataFrame:
        rows = []
        for text_ in texts_:
            spans = sent.value.spans(text_)
            base = [s for s in spans if s[1] < len(KINDS)]
            counts = [sum(s[1] == k for s in base) for k in range(len(KINDS))]
            rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return of(text)


MASK = "[SECRET]"


def masked_column(spark: SparkSession, formats: Formats, text: Column) -> Column:
    """The text with each stretch of spans replaced by ``MASK``; NULL stays NULL."""
    sent = spark.sparkContext.broadcast(formats)

    @F.pandas_udf("string")
    def of(texts_: pd.Series) -> pd.Series:
        def mask(text_: str | None) -> str | None:
            out, at = [], 0
            for start, _, end in sent.value.spans(text_):
                if start >= at:
                    out += [text_[at:start], MASK]
                at = max(at, end)
            return "".join([*out, text_[at:]]) if out else text_

        return texts_.map(mask, na_action="ignore")

    return of(text)


def masked_documents(docs: DataFrame, formats: Formats, text_col: str = "text",
                     chars_col: str = "n_chars") -> DataFrame:
    """All rows of ``docs`` with secrets masked in the text, and the length of the new text."""
    name = fresh(docs, "masked")
    out = docs.withColumn(name, masked_column(docs.sparkSession, formats, F.col(text_col)))
    changes = {text_col: F.col(name)}
    if chars_col in docs.columns:
        changed = ~F.col(name).eqNullSafe(F.col(text_col))
        changes[chars_col] = (F.when(changed, F.char_length(name)).otherwise(F.col(chars_col))
                              .cast(docs.schema[chars_col].dataType))
    return out.withColumns(changes).drop(name)
