"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that any match must contain. A task cuts its
rows into segments of a bounded size, builds the postings of the trigrams that the rules name (trigram -> rows of the
segment), evaluates each rule's query by intersecting and uniting postings, and runs the regular expression on the candidate
rows only. A rule whose expression has no mandatory trigram is run on every row. No row leaves its partition.

A null text counts as empty. Matches of a rule are its leftmost non-overlapping ones over the whole text; offsets are code
points, the end exclusive. Repeated rows are scanned each on their own; other columns are not read.
"""

import re
from re import _constants as op, _parser as parser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from speechframe.llm.common import map_batches, per_text, sha256_hex

#: Bytes of text that one segment of the index covers at most (a longer text is a segment of its own).
SEGMENT_BYTES = 4_000_000
#: An expression's set of exact strings is cut into trigrams before it grows beyond this.
EXACT_STRINGS = 64


class Rule(NamedTuple):
    kind: str
    pattern: str
    flags: int = 0
    group: int = 0  # the group whose length counts
    shortest: int = 1  # matches whose group is shorter are dropped


# fixed values: the base rules, then further token formats with an unmistakable prefix
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    # a run of 24 or more is what a run of any length is when the shorter ones are dropped
    Rule("hex", r"[0-9a-f]{24,}", 0, 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("host_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + MORE

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_spans", T.LongType()),
    ]
)

# A query is True (no demand), a trigram, or a tuple ("and" | "or", parts).


def _both(a, b):
    return b if a is True else a if b is True or a == b else ("and", (a, b))


def _either(parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_string(s: bytes):
    query = True
    for i in range(len(s) - 2):
        query = _both(query, s[i : i + 3])
    return query


def _of_strings(strings):
    return _either(_of_string(s) for s in strings)


def _characters(items):
    """The bytes a character class can be in lower case, or None when it is large or not a plain list."""
    out = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower().encode())
        elif kind is op.RANGE and value[1] - value[0] < 4:
            out |= {chr(c).lower().encode() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(items):
    """(exact strings or None, query) of a sequence: the strings it is if these are few, and what it demands in any case."""
    exact, query, whole = {b""}, True, True
    for kind, value in items:
        if kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
            continue
        own, demand = None, True
        if kind is op.LITERAL:
            own = {chr(value).lower().encode()}
        elif kind is op.IN:
            own = _characters(value)
        elif kind is op.SUBPATTERN:
            own, demand = _walk(value[3])
        elif kind is op.BRANCH:
            branches = [_walk(b) for b in value[1]]
            own = set().union(*(b[0] for b in branches)) if all(b[0] is not None for b in branches) else None
            demand = _either(_of_strings(b[0]) if b[0] is not None else b[1] for b in branches)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, body = value
            strings, inner = _walk(body)
            if strings is not None and (least, most) == (0, 1):
                own = strings | {b""}
            elif strings is not None and least == most == 1:
                own = strings
            elif least:
                demand = _both(inner, _of_strings(strings) if strings is not None else True)
        if own is not None and len(exact) * len(own) <= EXACT_STRINGS:
            exact = {a + b for a in exact for b in own}
        else:
            query = _both(query, _of_strings(exact))
            query = _both(query, _of_strings(own) if own is not None else demand)
            exact, whole = {b""}, False
    return (exact, query) if whole else (None, _both(query, _of_strings(exact)))


def trigram_query(rule: Rule):
    """The Boolean query over lower-case trigrams that every text with a match satisfies; True when there is none."""
    exact, query = _walk(parser.parse(rule.pattern, rule.flags))
    return _of_strings(exact) if exact is not None else query


def trigrams_of(query) -> set[bytes]:
    return set() if query is True else {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


class TrigramIndex:
    """Postings of one segment: for each named trigram the rows that contain it, in ascending order."""

    def __init__(self, texts: list[bytes], slots: np.ndarray, names: list[bytes]):
        data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
        self.postings = {}
        if len(data) < 3:
            return
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        code = data[:-2].astype(np.uint32) << 16
        code |= data[1:-1].astype(np.uint32) << 8
        code |= data[2:]
        slot = slots[code]
        at = np.flatnonzero(slot)
        rows = np.searchsorted(starts, at, side="right") - 1
        pairs = np.unique(slot[at].astype(np.int64) * len(texts) + rows)
        of, rows = pairs // len(texts), pairs % len(texts)
        cuts = np.searchsorted(of, np.arange(1, len(names) + 2))
        self.postings = {name: rows[cuts[i] : cuts[i + 1]] for i, name in enumerate(names)}

    def rows(self, query) -> np.ndarray:
        if isinstance(query, bytes):
            return self.postings.get(query, np.empty(0, dtype=np.int64))
        kind, parts = query
        if kind == "or":
            return np.unique(np.concatenate([self.rows(p) for p in parts]))
        found = None
        for part in parts:
            own = self.rows(part)
            found = own if found is None else np.intersect1d(found, own, assume_unique=True)
            if not len(found):
                break
        return found


class Scanner:
    def __init__(self, rules):
        self.rules = [(r, re.compile(r.pattern, r.flags), trigram_query(r)) for r in rules]
        self.names = sorted(set().union(*(trigrams_of(q) for _, _, q in self.rules)))
        self.slots = np.zeros(1 << 24, dtype=np.uint16)
        for i, name in enumerate(self.names, 1):
            self.slots[int.from_bytes(name, "big")] = i

    def segment(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, end, rule number) in order of start and rule."""
        index = TrigramIndex([t.encode("utf-8", "surrogatepass") for t in texts], self.slots, self.names)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, expression, query) in enumerate(self.rules):
            for row in range(len(texts)) if query is True else index.rows(query).tolist():
                for m in expression.finditer(texts[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.shortest:
                        found[row].append((m.start(), m.end(), number))
        for spans in found:
            spans.sort(key=lambda s: (s[0], s[2]))
        return found

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        out, own, size = [], [], 0
        for t in texts:
            if own and size + len(t) > SEGMENT_BYTES:
                out += self.segment(own)
                own, size = [], 0
            own.append(t)
            size += len(t)
        return out + (self.segment(own) if own else [])


_scanners: dict[tuple, Scanner] = {}


def _scanner(rules) -> Scanner:
    if rules not in _scanners:
        _scanners[rules] = Scanner(rules)
    return _scanners[rules]


def secret_spans(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, spans) with one struct of kind, start, end and text for each match, for texts that have any or not."""
    rules = tuple(map(tuple, rules))
    kind = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("secret", T.StringType())])
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(kind))])

    def run(ids, texts):
        own = tuple(Rule(*r) for r in rules)
        found = _scanner(own).scan(texts)
        return {"doc_id": ids, "spans": [[{"kind": own[n].kind, "start": a, "end": b, "secret": t[a:b]} for a, b, n in spans] for t, spans in zip(texts, found)]}

    return map_batches(docs.select("doc_id", "text"), per_text(run, schema), schema)


def secret_scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans of every text."""
    rules = tuple(map(tuple, rules))

    def joined(own, spans):
        return ",".join(f"{own[n].kind}:{a}:{b}" for a, b, n in spans)

    def run(ids, texts):
        own = tuple(Rule(*r) for r in rules)
        found = _scanner(own).scan(texts)
        counts = [[sum(n == k for _, _, n in spans) for spans in found] for k in range(3)]
        return {
            "doc_id": ids,
            "n_assign": counts[0],
            "n_access": counts[1],
            "n_hex": counts[2],
            "base_sha256": [sha256_hex(joined(own, [s for s in spans if s[2] < 3]).encode()) for spans in found],
            "spans": [joined(own, spans) for spans in found],
            "n_spans": list(map(len, found)),
        }

    return map_batches(docs.select("doc_id", "text"), per_text(run, SCHEMA), SCHEMA)
