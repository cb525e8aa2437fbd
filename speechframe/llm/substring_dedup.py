"""Removal of repeated byte strings with per-shard suffix arrays that are merged across shards.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. The corpus is written
once as shards, bucketed by shard, and every later step meets a shard's texts without moving them.

Suffix arrays of all text, kept for merging, would take several times the input on disk, and merging every shard with every other
would grow with the square of the corpus. So the places where shards can agree at all are narrowed down first, without loss. Each
window of ``LENGTH`` bytes has an anchor, the ``GRAM`` bytes in it of the lowest hash, which only its own bytes decide; the
windows of one anchor are a stretch. Shards exchange (anchor, stretch, smallest document), once per anchor. Where all shards
have one and the same stretch for an anchor, its windows repeat all or not at all. Only anchors with different stretches are
ambiguous: their stretches make up the text of the shard's suffix array (Larsson-Sadakane refinement of the order by the first
8 bytes), neighbours with a common prefix (Kasai) of ``LENGTH`` bytes are one window, and the sorted windows of all shards are
merged by binary search. A shard learns of each window only whether a smaller document elsewhere has it.

Anchors and stretches are told apart by hashes of 46 bits and more, which a part of the exchange adds to (two anchors taken for one
are merely ambiguous), windows by 96 bits.

A null text counts as empty. A null doc_id counts as greater than any other, and is returned as null. Rows that share a doc_id, or have none, do not count as repeats of each other; each is judged and returned on its
own. Matches never cross documents. Other columns are not read.
"""

import hashlib
import pickle
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from speechframe.session import materialize, ship_package, workspace

LENGTH = 50
GRAM = 24
#: Bytes of text for which a shard and a part of the exchange are laid out.
SHARD_BYTES = 9_000_000
#: A null doc_id counts as the greatest one.
NULL_ID = 2**63 - 1
#: Bytes whose anchors are worked out at a time (a longer text is taken whole).
PIECE = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mixed(h):
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


_powers = {"n": 0}


def _power_tables(n: int):
    """Powers of the base and of its inverse modulo 2**64."""
    if _powers["n"] < n:
        size = max(n, PIECE + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


class Hashes:
    """Polynomial hashes of any stretch of a byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start, length):
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def _lowest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` successive values."""
    reach = 1
    while 2 * reach <= width:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    return np.minimum(h[: len(h) - (width - reach)], h[width - reach :]) if reach < width else h


def anchors(texts: list[bytes]):
    """(text, start, end, key, stretch hash) of every run of windows with one anchor; ``end`` is the last window's start + 1."""
    found = []
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= PIECE):
            size += len(texts[stop])
            stop += 1
        if size >= LENGTH:
            found.append(_anchors_of(texts, at, stop))
        at = stop
    if not found:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors_of(texts, first, stop):
    data = np.frombuffer(b"".join(texts[first:stop]), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts[first:stop]])
    ends = np.cumsum(sizes)
    hashes, n = Hashes(data), len(data)
    grams = _mixed(hashes.of(np.arange(n - GRAM + 1), GRAM))
    # the hash's upper half, then the place: of equal grams the first one counts
    placed = ((grams >> _U(32)) << _U(32)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_lowest(placed, LENGTH - GRAM + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    whole = np.ones(len(anchor) + LENGTH, dtype=bool)  # windows that end within their text
    for back in range(1, LENGTH):
        whole[ends[ends >= back] - back] = False
    whole = whole[: len(anchor)]
    turn = np.flatnonzero(whole & np.concatenate([[True], (anchor[1:] != anchor[:-1]) | ~whole[:-1]]))
    last = np.flatnonzero(whole & np.concatenate([(anchor[1:] != anchor[:-1]) | ~whole[1:], [True]])) + 1
    q = anchor[turn]
    key = _mixed(grams[q])  # mixed again: the lowest of many hashes is a low one, and parts are ranges of keys
    length = last - turn + LENGTH - 1
    stretch = _mixed(hashes.of(turn, length) ^ _mixed((length * 64 + (q - turn)).astype(np.uint64)))
    stretch[stretch == 0] = 1
    of = np.searchsorted(ends, turn, side="right")
    begin = ends[of] - sizes[of]
    return of + first, turn - begin, last - begin, key, stretch


def _order(values: np.ndarray, width: int) -> np.ndarray:
    """Places of ``values`` (whole numbers below 2**width) in ascending order, the first of equals first."""
    bits = max(1, (len(values) - 1).bit_length())
    if width + bits > 64:
        return np.argsort(values, kind="stable")
    # value and place in one number: sorting numbers is several times faster than sorting places
    packed = (values.astype(np.uint64) << _U(bits)) | np.arange(len(values), dtype=np.uint64)
    packed.sort()
    return (packed & ((_U(1) << _U(bits)) - _U(1))).astype(np.int64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes of ``data`` in their order.

    Larsson-Sadakane: groups of equal prefixes are refined by the ranks ``h`` bytes on, ``h`` doubles, and groups of one are left alone.
    """
    n, h = len(data), 5
    padded = np.concatenate([data, np.zeros(h, dtype=np.uint8)])
    first = np.zeros(n, dtype=np.uint64)
    for k in range(h):
        first = (first << _U(8)) | padded[k : k + n]
    order = _order(first, 8 * h)
    fresh = np.concatenate([[True], first[order][1:] != first[order][:-1]]) if n else np.empty(0, dtype=bool)
    rank = np.zeros(2 * n + 8, dtype=np.int64)  # beyond the end lies what is smaller than anything
    bits = max(1, n.bit_length())
    while True:
        starts = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        rank[order] = starts[group] + 1
        sizes = np.diff(np.concatenate([starts, [n]]))
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            return order
        suffixes = order[open_]
        beyond = rank[suffixes + h]
        by = _order((group[open_].astype(np.uint64) << _U(bits)) | beyond.astype(np.uint64), 2 * bits)
        order[open_] = suffixes[by]
        beyond = beyond[by]
        fresh[open_[1:]] |= beyond[1:] != beyond[:-1]
        h *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, begins: np.ndarray, ends: np.ndarray, cap: int = LENGTH) -> np.ndarray:
    """For each suffix, the bytes it shares with its predecessor in ``order``, up to ``cap``; stretches are [begins, ends).

    Kasai: one suffix on, the common prefix is at most one byte shorter. All stretches move on together.
    """
    n = len(data)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    end = np.repeat(ends, ends - begins)
    shared = np.zeros(n, dtype=np.int64)
    i, have, stop = begins.copy(), np.zeros(len(begins), dtype=np.int64), ends
    while len(i):
        j = before[i]
        have = np.where(j < 0, 0, np.maximum(have - 1, 0))
        limit = np.minimum(np.minimum(stop - i, np.where(j < 0, 0, end[j] - j)), cap)
        have = np.minimum(have, limit)
        grow = np.flatnonzero(have < limit)
        while len(grow):
            grow = grow[data[i[grow] + have[grow]] == data[j[grow] + have[grow]]]
            have[grow] += 1
            grow = grow[have[grow] < limit[grow]]
        shared[i] = have
        on = i + 1 < stop
        i, have, stop = i[on] + 1, have[on], stop[on]
    return shared


def _between(shared: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """For each chosen place the common prefix with the chosen one before it: the minimum over what lies between."""
    places = np.flatnonzero(chosen)
    begins = np.concatenate([[0], places[:-1] + 1])
    return np.minimum.reduceat(np.concatenate([shared, [0]]), np.stack([begins, places + 1], axis=1).ravel())[::2]


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of the exchange that a hash belongs to: ranges of the upper half."""
    return (((hashes >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64)


class Shard:
    """One shard's texts with their anchors, and what other shards know about them."""

    def __init__(self, table: pa.Table, parts: int):
        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        self.ids = table.column("doc_id").to_numpy()
        self.texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in table.column("text").to_pylist()]
        self.parts = parts
        self.text, self.start, self.end, self.key, self.stretch = anchors(self.texts)
        # in the order of keys; within a key of stretches, within a stretch of documents
        self.order = _order(self.key >> _U(20), 44)
        top = self.key[self.order] >> _U(20)
        same = top[1:] == top[:-1]
        again = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if len(top) else top
        among = self.order[again]
        self.order[again] = among[np.lexsort((self.stretch[among], self.key[among]))]
        key, stretch, doc = self.key[self.order], self.stretch[self.order], self.ids[self.text[self.order]]
        self.new_key = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=bool)
        self.new_class = self.new_key | np.concatenate([[True], stretch[1:] != stretch[:-1]]) if len(key) else self.new_key
        self.at = np.flatnonzero(self.new_key)
        self.keys = key[self.at]
        several = np.add.reduceat(self.new_class, self.at) > 1 if len(key) else np.empty(0, dtype=bool)
        self.stretches = np.where(several, _U(0), stretch[self.at]) if len(key) else np.empty(0, dtype=np.uint64)
        self.smallest = np.minimum.reduceat(doc, self.at) if len(key) else np.empty(0, dtype=np.int64)
        self.largest = np.maximum.reduceat(doc, self.at) if len(key) else np.empty(0, dtype=np.int64)
        self.part = _part(self.keys, parts)

    def sent(self, number: int) -> pa.Table:
        """What other shards have to know of the keys: 48 bits of each within its part, 46 of its stretch, 0 for several ones, and whether several documents have it."""
        stretch = np.where(self.stretches == 0, _U(0), (self.stretches & _U(2**47 - 1)) | _U(1 << 46))
        several = (self.smallest != self.largest).astype(np.uint64)
        return _sent(number, self.part, [(self.keys & _U(2**48 - 1), 6), ((stretch << _U(1)) | several, 6)], self.smallest)

    def ambiguous_classes(self, codes: np.ndarray):
        """The classes of ambiguous anchors, by their first occurrence, and where the stretch of each begins and ends in their text."""
        code = np.repeat(codes, np.diff(np.concatenate([self.at, [len(self.order)]])))
        heads = np.flatnonzero(self.new_class & (code == 2))  # a class's first occurrence is in its smallest document
        run = self.order[heads]
        lengths = self.end[run] - self.start[run] + LENGTH - 1
        ends = np.cumsum(lengths)
        return heads, ends - lengths, ends

    def windows(self, heads: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        """The windows of these classes in suffix order, the group of equal ones, and each group's smallest document and identity."""
        run = self.order[heads]
        pieces = [self.texts[t][a : b + LENGTH - 1] for t, a, b in zip(self.text[run].tolist(), self.start[run].tolist(), self.end[run].tolist())]
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        order = suffix_array(data)
        shared = common_prefixes(data, order, begins, ends)
        windows = np.repeat(ends, ends - begins) - np.arange(len(data)) >= LENGTH
        doc = np.repeat(self.ids[self.text[run]], ends - begins)
        at = order[windows[order]]
        # between two windows with a common prefix of LENGTH bytes no other suffix can stand that lacks it
        fresh = np.ones(len(at), dtype=bool)
        if len(at) > 1:
            low = _between(shared[order], windows[order])
            fresh[1:] = low[1:] < LENGTH
        group = np.cumsum(fresh) - 1
        first = at[fresh]
        smallest = np.minimum.reduceat(doc[at], np.flatnonzero(fresh)) if len(first) else doc[:0]
        identity = check = np.empty(0, dtype=np.uint64)
        if len(first):
            hashes = Hashes(data)
            identity = _mixed(hashes.of(first, LENGTH))
            halves = [_mixed(hashes.of(first + k, LENGTH // 2)) for k in (0, LENGTH // 2)]
            check = (halves[0] * _BASE + halves[1]) >> _U(32)
        return at, group, smallest, identity, check, doc


class Open:
    """What a shard keeps of its windows until the answers come: which repeat by the shard's own documents, and where the others stand."""

    def __init__(self, hit: np.ndarray, places: np.ndarray, answer: np.ndarray):
        self.hit, self.places, self.answer = hit, places, answer

    @classmethod
    def of(cls, at, group, smallest, doc, order) -> "Open":
        hit, own = np.zeros(len(doc), dtype=bool), smallest[group] < doc[at]
        hit[at[own]] = True
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        places, answer = at[~own], rank[group[~own]]
        by = np.argsort(answer, kind="stable")
        return cls(hit, places[by], answer[by])

    def packed(self) -> bytes:
        # every group has a window in its smallest document, so the answers' numbers have no gap
        fresh = np.diff(self.answer, prepend=-1) > 0
        width = max(1, -(-len(self.hit).bit_length() // 8))
        # answers are numbered by hashes, so their places do not shrink
        return pickle.dumps((len(self.hit), zlib.compress(np.packbits(self.hit).tobytes(), 1), width, _narrow(self.places, width), zlib.compress(np.packbits(fresh).tobytes(), 1)))

    @classmethod
    def unpacked(cls, content: bytes) -> "Open":
        n, hit, width, places, fresh = pickle.loads(content)
        places = _wide(places, width).astype(np.int64)
        bits = lambda packed, count: np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), count=count)
        return cls(bits(hit, n).astype(bool), places, np.cumsum(bits(fresh, len(places)).astype(np.int64)) - 1)

    def answered(self, answers: np.ndarray) -> np.ndarray:
        """For each byte of the stretches whether the window that begins there is repeated."""
        hit = self.hit.copy()
        hit[self.places[answers[self.answer] == 1]] = True
        return hit


EXCHANGED = "part int, shard int, content binary"
REPLIED = "shard int, part int, step int, codes binary"
#: Steps of the replies: to the anchors, to the windows, and what a shard has sent itself.
TO_ANCHORS, TO_WINDOWS, TO_ITSELF = 1, 2, 3
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _narrow(values: np.ndarray, width: int) -> bytes:
    """The lower ``width`` bytes of whole numbers."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _wide(content: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(content) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(content, dtype=np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes: those that are all zero shrink to nothing."""
    return zlib.compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _from_planes(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(content), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _sent(shard: int, part: np.ndarray, columns: list[tuple[np.ndarray, int]], smallest: np.ndarray) -> pa.Table:
    """One row for each part, of the rows that belong to it (``part`` is ascending); columns come with their width in bytes."""
    names, starts = np.unique(part, return_index=True)
    rows = []
    for a, b in zip(starts, [*starts[1:], len(part)]):
        rows.append(pickle.dumps(([_narrow(c[a:b], w) for c, w in columns], _planes(smallest[a:b]))))
    return pa.table({"part": pa.array(names, pa.int32()), "shard": pa.array([shard] * len(names), pa.int32()), "content": pa.array(rows, pa.binary())})


def _received(table: pa.Table, widths: list[int]):
    """The rows that shards have sent to a part, and (shard, from, to) of each shard's."""
    columns, smallest, whose, at = [[] for _ in widths], [], [], 0
    for shard, content in zip(table.column("shard").to_pylist(), table.column("content").to_pylist()):
        own, planes = pickle.loads(content)
        for column, data, width in zip(columns, own, widths):
            column.append(_wide(data, width))
        smallest.append(_from_planes(planes))
        whose.append((shard, at, at + len(smallest[-1])))
        at += len(smallest[-1])
    return [np.concatenate(c) for c in columns], np.concatenate(smallest), whose


def _replies(part: int, step: int, codes: np.ndarray, whose) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array([s for s, _, _ in whose], pa.int32()),
            "part": pa.array([part] * len(whose), pa.int32()),
            "step": pa.array([step] * len(whose), pa.int32()),
            "codes": pa.array([zlib.compress(codes[a:b].tobytes(), 1) for _, a, b in whose], pa.binary()),
        }
    )


def _codes(replies: pa.Table, step: int) -> np.ndarray:
    """A shard's codes of one step, in the order in which it has sent what they answer."""
    rows = sorted((p, c) for p, s, c in zip(*(replies.column(x).to_pylist() for x in ("part", "step", "codes"))) if s == step)
    return np.frombuffer(b"".join(zlib.decompress(c) for _, c in rows), dtype=np.uint8)


def _compare_anchors(table: pa.Table) -> pa.Table:
    """0: what the shard knows itself is all there is; 1: a smaller document elsewhere has the same stretch; 2: ambiguous."""
    (key, stretch), smallest, whose = _received(table, [6, 6])
    several, stretch = stretch & _U(1), stretch >> _U(1)
    order = _order(key, 48)
    starts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    group = np.repeat(np.arange(len(starts)), sizes)
    s = stretch[order]
    same = (np.minimum.reduceat(s, starts) == np.maximum.reduceat(s, starts))[group] & (s != 0)
    low = np.minimum.reduceat(smallest[order], starts)[group]
    alone = (sizes == 1)[group]
    code = np.where(same, (smallest[order] > low).astype(np.uint8), np.where(alone & (several[order] == 0), 0, 2)).astype(np.uint8)
    codes = np.empty(len(key), dtype=np.uint8)
    codes[order] = code
    return _replies(table.column("part")[0].as_py(), TO_ANCHORS, codes, whose)


def _merge_windows(table: pa.Table) -> pa.Table:
    """1 for each window of a shard that a document elsewhere, smaller than all of the shard's, has too."""
    part = table.column("part")[0].as_py()
    if part < 0:
        return pa.table({"shard": table.column("shard"), "part": table.column("part"), "step": pa.array([TO_ITSELF] * len(table), pa.int32()), "codes": table.column("content")})
    (identity, check), smallest, whose = _received(table, [8, 4])
    order = np.lexsort((check, identity))
    m, x, doc = identity[order], check[order], smallest[order]
    starts = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (x[1:] != x[:-1])]))
    low, m, x = np.minimum.reduceat(doc, starts), m[starts], x[starts]
    # each shard's run finds its windows among the merged ones by binary search
    codes = np.empty(len(identity), dtype=np.uint8)
    for _, a, b in whose:
        at = np.searchsorted(m, identity[a:b])
        while len(step := np.flatnonzero(x[at] != check[a:b])):
            at[step] += 1
        codes[a:b] = low[at] < smallest[a:b]
    return _replies(part, TO_WINDOWS, codes, whose)


def sending_order(identity: np.ndarray) -> np.ndarray:
    """Windows are sent in the order of their hashes, so that parts are ranges of it."""
    return np.argsort(identity, kind="stable")


def _removed(shard: Shard, codes: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Runs of repeated windows as rows (text, from, to); ``hit`` says it of the windows of ambiguous anchors."""
    sizes = np.diff(np.concatenate([shard.at, [len(shard.order)]]))
    code = np.repeat(codes, sizes)
    doc = shard.ids[shard.text[shard.order]]
    number = np.cumsum(shard.new_class) - 1
    smallest = doc[np.flatnonzero(shard.new_class)][number] if len(doc) else doc
    gone = (code == 1) | (doc > smallest)
    whole = shard.order[gone]
    found = [np.stack([shard.text[whole], shard.start[whole], shard.end[whole]], axis=1)]
    heads, begins, ends = shard.ambiguous_classes(codes)
    if len(heads):
        # a class that stands several times in its smallest document shares the answer
        place = np.full(int(number[-1]) + 1, -1)
        place[number[heads]] = np.arange(len(heads))
        rest = np.flatnonzero((code == 2) & ~gone)
        which = place[number[rest]]
        for row, w in zip(shard.order[rest].tolist(), which.tolist()):
            a, n = int(begins[w]), int(ends[w] - begins[w]) - LENGTH + 1
            flags = np.flatnonzero(np.diff(np.concatenate([[0], hit[a : a + n].view(np.int8), [0]])))
            if len(flags):
                spans = flags.reshape(-1, 2) + shard.start[row]
                found.append(np.concatenate([np.full((len(spans), 1), shard.text[row]), spans], axis=1))
    return np.concatenate(found)


def _cut(shard: Shard, spans: np.ndarray) -> pa.Table:
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    cuts = np.searchsorted(spans[:, 0], np.arange(len(shard.texts) + 1))
    out = {c: [] for c in ("n_removed", "n_spans", "kept_sha256")}
    for i, text in enumerate(shard.texts):
        kept, done, removed, runs = hashlib.sha256(), 0, 0, 0
        low = None
        for _, a, b in spans[cuts[i] : cuts[i + 1]].tolist():
            b += LENGTH - 1
            if low is not None and a <= high:
                high = max(high, b)
                continue
            if low is not None:
                kept.update(text[done:low])
                done, removed, runs = high, removed + high - low, runs + 1
            low, high = a, b
        if low is not None:
            kept.update(text[done:low])
            done, removed, runs = high, removed + high - low, runs + 1
        kept.update(text[done:])
        for c, v in zip(out, (removed, runs, kept.hexdigest())):
            out[c].append(v)
    return pa.table(
        {"doc_id": pa.array(shard.ids, pa.int64()), "n_bytes": pa.array([len(t) for t in shard.texts], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()), "n_spans": pa.array(out["n_spans"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
    )


def write_shards(docs: DataFrame) -> tuple[str, int]:
    """The name of a table of the texts, bucketed by the number of their shard, and their bytes in all.

    A shard is a part of one task's rows, so that writing needs no shuffle. Into how many a task's rows are cut follows from
    the bytes of text in the fullest task.
    """
    spark = docs.sparkSession
    size = F.sum(F.octet_length("text").cast("long"))
    tasks = docs.groupBy(F.spark_partition_id().alias("task")).agg(size.alias("bytes")).agg(F.max("bytes").alias("most"), F.sum("bytes").alias("all")).first()
    pieces = max(1, -(-(tasks["most"] or 0) // SHARD_BYTES))
    shard = F.spark_partition_id() * pieces + F.pmod(F.xxhash64("doc_id"), F.lit(pieces)).cast("int")
    rows = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    name = f"shards_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.withColumn("shard", shard).write.bucketBy(buckets, "shard").option("path", workspace(spark, "shards")).option("compression", "zstd").format("parquet").saveAsTable(name)
    return name, tasks["all"] or 0


def substring_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    name, size = write_shards(docs)
    shards, parts = spark.table(name), max(4, size // SHARD_BYTES)

    def number(table: pa.Table) -> int:
        return table.column("shard")[0].as_py()

    def send_anchors(table: pa.Table) -> pa.Table:
        own = Shard(table, parts)
        return own.sent(number(table))

    def send_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Shard(table, parts)
        at, group, smallest, identity, check, doc = own.windows(*own.ambiguous_classes(_codes(replies, TO_ANCHORS)))
        order = sending_order(identity)
        sent = _sent(number(table), _part(identity[order], parts), [(identity[order], 8), (check[order], 4)], smallest[order])
        kept = Open.of(at, group, smallest, doc, order).packed()
        # to a part of its own, so that it comes back with the answers
        itself = pa.table({"part": pa.array([-1 - number(table)], pa.int32()), "shard": pa.array([number(table)], pa.int32()), "content": pa.array([kept], pa.binary())})
        return pa.concat_tables([sent, itself])

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Shard(table, parts)
        windows = Open.unpacked(replies.filter(pc.equal(replies.column("step"), TO_ITSELF)).column("codes")[0].as_py())
        return _cut(own, _removed(own, _codes(replies, TO_ANCHORS), windows.answered(_codes(replies, TO_WINDOWS))))

    first = materialize(shards.groupBy("shard").applyInArrow(send_anchors, EXCHANGED).groupBy("part").applyInArrow(_compare_anchors, REPLIED), "anchor_replies")
    sent = shards.groupBy("shard").cogroup(first.groupBy("shard")).applyInArrow(send_windows, EXCHANGED)
    second = materialize(sent.groupBy("part").applyInArrow(_merge_windows, REPLIED), "window_replies")
    rows = materialize(shards.groupBy("shard").cogroup(first.unionByName(second).groupBy("shard")).applyInArrow(finish, RESULT), "cut")
    spark.sql(f"DROP TABLE {name}")
    return rows.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))
