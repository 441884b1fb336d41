"""Chat records of many layouts as canonical turns, and turns as one marked text with a loss mask."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# -- layouts ----------------------------------------------------------------------------------


def paths(value, at: str = "") -> set[str]:
    """Paths of all leaves of a JSON value; members of a list share one path, and an empty list has none."""
    if isinstance(value, dict) and value:
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(found: Iterable[str]) -> str:
    """The hash of a schema: of its sorted leaf paths."""
    return hashlib.sha256("\n".join(sorted(found)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """How records of one schema become turns.

    ``fields`` are (role, paths): one turn with the values of the paths, blank lines between,
    left out if all are empty. A path that ends in ``[]`` is a list with a turn for each
    member; ``role`` and ``text`` are then the paths within it (none: members are texts and
    take the roles of ``roles`` in turns). ``roles`` gives other names of a role. ``order`` is
    the path of the number by which records of one conversation are sorted.
    """

    schema: tuple[str, ...]
    fields: tuple[tuple[str, tuple[str, ...]], ...]
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)
    order: str = ""


    def schemas(self) -> list[set[str]]:
        """The leaf paths with all lists, and without those of any lists that are empty."""
        lists = sorted({path.split("[]")[0] for path in self.schema if "[]" in path})
        empty = [set(some) for n in range(len(lists) + 1) for some in combinations(lists, n)]
        return [{p for p in self.schema if "[]" not in p or p.split("[]")[0] not in some} for some in empty]


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: Known layouts by their leaf paths.
MAPPINGS = (
    Mapping(("conv_id", "turn", "role", "text"), (("", ("",)),), "role", "text", order="turn"),
    Mapping(("messages[].role", "messages[].content"), (("", ("messages[]",)),), "role", "content"),
    Mapping(("conversations[].from", "conversations[].value"), (("", ("conversations[]",)),), "from", "value", SPEAKERS),
    Mapping(("instruction", "input", "output"), (("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("instruction", "output"), (("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping(("system", "instruction", "input", "output"),
            (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("prompt", "response"), (("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("prompt", "completion"), (("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping(("system", "prompt", "response"),
            (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("question", "answer"), (("user", ("question",)), ("assistant", ("answer",)))),
    Mapping(("prompt[].role", "prompt[].content", "completion[].role", "completion[].content"),
            (("", ("prompt[]",)), ("", ("completion[]",))), "role", "content"),
    Mapping(("history[][]", "query", "response"),
            (("", ("history[]",)), ("user", ("query",)), ("assistant", ("response",)))),
)


def _at(value, path: str):
    for name in path.split(".") if path else ():
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def turns(record, mapping: Mapping) -> list[tuple[str, str]]:
    """(role, text) in order; NULL roles and texts are empty."""
    out = []

    def member(value) -> None:
        role = _text(_at(value, mapping.role))
        out.append((mapping.roles.get(role, role), _text(_at(value, mapping.text))))

    for role, sources in mapping.fields:
        if sources[0].endswith("[]"):
            for value in _at(record, sources[0][:-2]) or []:
                if isinstance(value, list):  # pairs of a question and its answer
                    out += [(("user", "assistant")[k % 2], _text(v)) for k, v in enumerate(value)]
                else:
                    member(value)
        elif not role:
            member(_at(record, sources[0]))
        elif found := [text for path in sources if (text := _text(_at(record, path)))]:
            out.append((role, "\n\n".join(found)))
    return out


TURNS = "id long, turn long, place int, role string, text string, layout string"
UNREADABLE, UNKNOWN = "unreadable", "unknown"


def canonical_turns(records: DataFrame, id_col: str, json_col: str, mappings: Iterable[Mapping] = MAPPINGS,
                    ignored: Iterable[str] = ()) -> DataFrame:
    """(id, turn, place, role, text, layout): the turns of JSON records.

    The schema of each record, without the ``ignored`` paths, is hashed, and the mapping with
    that hash makes the turns; ``layout`` is the hash. Lists may be empty, as the history of a first turn. A record that is NULL or no JSON object
    (layout 'unreadable'), or of a schema without a mapping ('unknown:' and its hash), or without any turn, has one
    row with NULL role and text, so that nothing gets lost unseen.
    """
    by_hash: dict[str, Mapping] = {}
    for mapping in mappings:
        for schema in mapping.schemas():  # a layout of its own goes before one with empty lists
            if schema == set(mapping.schema) or fingerprint(schema) not in by_hash:
                by_hash[fingerprint(schema)] = mapping
    left_out = frozenset(ignored)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    record = json.loads(packed or "")
                except ValueError:
                    record = None
                if not isinstance(record, dict):
                    rows.append((name, None, 0, None, None, UNREADABLE))
                    continue
                layout = fingerprint(paths(record) - left_out)
                mapping = by_hash.get(layout)
                if mapping is None:
                    rows.append((name, None, 0, None, None, f"{UNKNOWN}:{layout}"))
                    continue
                number = _at(record, mapping.order) if mapping.order else 0
                made = turns(record, mapping) or [(None, None)]
                rows += [(name, number, k, role, text, layout) for k, (role, text) in enumerate(made)]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 [part.split(" ")[0] for part in TURNS.split(", ")])

    return (records.select(F.col(id_col).cast("long").alias("id"), F.col(json_col).alias("json"))
            .mapInArrow(of, TURNS))


# -- template ---------------------------------------------------------------------------------

#: Every control string begins with ``<|``, which escaped text never holds.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """Puts one more backslash into ``<|``, ``<\\|`` and so on."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """As ``escape``, and on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """(marked text, start, end): the loss mask covers start to end, nothing if they are equal."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    loss = len(body) if role == LEARNED_ROLE else 0
    return f"{head}{body}{END}\n", len(head), len(head) + loss


def read_back(marked: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn in a marked text."""
    return [(unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(marked)]


FORMATTED = "id long, turn long, place int, role string, text string, marked string, loss_start long, loss_end long"


def formatted(rows: DataFrame) -> DataFrame:
    """Canonical turns with their marked text and the part of it under the loss mask.

    A conversation's text is its turns' texts by turn, place, role and text, one after the
    other; a row for each turn keeps conversations of any length apart from task memory.
    Rows without a role and a text (unreadable records) have none.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [formatted_turn(role or "", text or "") if role is not None or text is not None else (None, None, None)
                    for role, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            if made:
                marked, start, end = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(marked, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    [part.split(" ")[0] for part in FORMATTED.split(", ")])

    kinds = {"id": "long", "turn": "long", "place": "int", "role": "string", "text": "string"}
    return rows.select(*(F.col(name).cast(kind) for name, kind in kinds.items())).mapInArrow(of, FORMATTED)


DIGESTS = ("id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digests(rows: DataFrame) -> DataFrame:
    """What each formatted conversation holds, read back from its marked text.

    Turns stream by in order, so a conversation of any length takes the memory of one turn.
    """
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def closed() -> tuple:
            return name, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                              [part.split(" ")[0] for part in DIGESTS.split(", ")])

        for batch in batches:
            done = []
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in ("id", "marked", "loss_start", "loss_end"))
            for own, marked, start, end in zip(*columns):
                if state is None or own != name:
                    if state is not None:
                        done.append(closed())
                    name, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(marked)
                for role, text, *_ in read_back(marked):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                learned = unescape(marked[start:end])
                state[2] += len(learned)
                state[3].update(learned.encode("utf-8", "surrogatepass"))
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([closed()])

    return (rows.where("marked is not null").repartition("id")
            .sortWithinPartitions("id", "turn", "place", "role", "text")
            .select("id", "marked", "loss_start", "loss_end").mapInArrow(of, DIGESTS))
