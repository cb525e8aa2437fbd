"""Byte-level BPE encoding and decoding.

Each match of the split pattern ("word") is encoded on its own by folding ranked merges over its bytes. The words that a batch
of texts brings are folded together, one merge of each at a time, and kept in a bounded table as ids and as the bytes that the
ids decode to, so the work follows the distinct words and not the text. Decoding looks the ids up in the inverse of the rank
table and concatenates the pieces.

``merge_words`` is the same fold as Spark higher-order functions over byte arrays with a literal rank map. It is right but
cannot meet the check tool's limits on whole texts (figures in the README), so ``encode`` runs the fold in Python workers.

Nulls and empty texts have no tokens and the digest of the empty string; a row that occurs twice is encoded twice; columns
other than the id and the text are not read.
"""

import base64
import heapq
from copy import copy
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from speechframe.llm.common import Recent, map_batches, per_text, sha256_hex

#: Distinct parts of texts that a task keeps.
KEPT_PARTS = 300_000
#: Texts whose new parts are folded together, words that are, and the bytes beyond which a word is folded alone.
TEXTS, FOLDED, LONG = 256, 20_000, 200
#: A mark that follows letters is a word of its own.
MARKS = ".,;:!?)"
#: More than any rank.
NEVER = 1 << 62

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)
IDS_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def read_ranks(path: str) -> bytes:
    """The rank file as it is; it is a few hundred kB and travels with the function that uses it."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=4)
def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Fold the merges over one word: always the adjacent pair of the lowest rank, the leftmost of equals."""
    if word in ranks:
        return [word]
    if len(word) > 60:
        return merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    get = ranks.get
    pairs = [get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        best = at = None
        for i, r in enumerate(pairs):
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = get(parts[at] + parts[at + 1])
        if at:
            pairs[at - 1] = get(parts[at - 1] + parts[at])


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same fold with a heap over a linked list, for words whose length makes the plain one quadratic."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        j = after[i]
        # a pair that has changed since it was put on the heap is stale
        if not alive[i] or j >= n or end[i] != middle or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[after[i]]))
        if before[i] >= 0:
            p = before[i]
            if (r := ranks.get(word[p:stop])) is not None:
                heapq.heappush(heap, (r, p, i, stop))
    out, i = [], 0
    while i < n:
        out.append(word[i : end[i]])
        i = after[i]
    return out


def cut_at_blanks(text: str) -> tuple[str, list[str]] | None:
    """The text up to its first blank, and the parts after each blank; None when some blank follows white space.

    The split pattern always begins a word at a blank that follows other than white space, so such parts are encoded each on
    their own, with the blank in front.
    """
    first, *parts = text.split(" ")
    if parts and (not first or first[-1].isspace() or "" in parts or any(map(str.isspace, [p[-1] for p in parts]))):
        return None
    return first, parts


class Encoder:
    """Encodes and decodes the texts of one task, a batch at a time.

    Its table has what stands between blanks as a string, which is encoded with the blank in front, and any other piece of
    text as its bytes.
    """

    def __init__(self, content: bytes, pattern: str):
        self.ranks = parse_ranks(content)
        self.pieces = {rank: token for token, rank in self.ranks.items()}
        self.names = {rank: str(rank) for rank in self.pieces}
        self.split = regex.compile(pattern).findall
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # the rank at which two neighbouring ids merge, for every way to cut a piece in two
        cuts = ((self.ranks.get(t[:i]), self.ranks.get(t[i:]), rank) for t, rank in self.ranks.items() for i in range(1, len(t)))
        merged = np.array(sorted((a << 32 | b, rank) for a, b, rank in cuts if a is not None and b is not None), dtype=np.int64).reshape(-1, 2)
        self.pairs, self.merged = np.append(merged[:, 0], NEVER), np.append(merged[:, 1], NEVER)
        self.known = Recent(KEPT_PARTS)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.merged[at], NEVER)

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each has: in every round each word merges its pair of the lowest rank, the leftmost of equals."""
        sizes = np.array(list(map(len, words)), dtype=np.int64)
        ids, word = self.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)], np.repeat(np.arange(len(words)), sizes)
        rank = np.full(len(ids), NEVER)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self._ranks(ids[inside], ids[inside + 1])
        done = [(word[:0], ids[:0])]
        while len(ids):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            ended = lowest == NEVER
            done.append((word[ended], ids[ended]))
            going = ~ended
            ids, word, rank, lowest = ids[going], word[going], rank[going], lowest[going]
            at = np.flatnonzero(rank == lowest)
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])] if len(at) else at
            ids[at] = rank[at]
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            ids, word, rank = ids[stay], word[stay], rank[stay]
            at -= np.arange(len(at))  # one piece went before each later place
            rank[at] = NEVER
            for left in (at[at + 1 < len(ids)], at[at > 0] - 1):
                left = left[word[left] == word[left + 1]]
                rank[left] = self._ranks(ids[left], ids[left + 1])
        word, ids = map(np.concatenate, zip(*done))
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(words))

    def _learn(self, new: set) -> None:
        """Put the ids (as text) and the decoded bytes of new parts into the table."""
        split, parts, counts, words = self.split, [], [], []
        for p in new:
            if type(p) is str and p.isalpha():  # the pattern takes letters with the blank before them as one word
                own = [(" " + p).encode("utf-8", "surrogatepass")]
            elif type(p) is str and p[-1] in MARKS and p[:-1].isalpha():
                own = [(" " + p[:-1]).encode("utf-8", "surrogatepass"), p[-1].encode()]
            else:
                text = " " + p if type(p) is str else p.decode("utf-8", "surrogatepass")
                own = [w.encode("utf-8", "surrogatepass") for w in split(text)]
            parts.append(p)
            counts.append(len(own))
            words += own
            if len(words) >= FOLDED:
                self._put(parts, counts, words)
                parts, counts, words = [], [], []
        self._put(parts, counts, words)

    def _put(self, parts, counts, words) -> None:
        now = self.known.now
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        if long:  # a round is as long as the text that is left, so long words are folded on a heap
            found = {i: np.array([self.ranks[t] for t in merge_long(words[i], self.ranks)], dtype=np.int64) for i in long}
            ids, sizes = self.fold([b"" if i in found else w for i, w in enumerate(words)])
            ends = np.cumsum(sizes)
            ids = np.insert(ids, np.repeat([ends[i] for i in long], [len(found[i]) for i in long]), np.concatenate(list(found.values())))
            sizes[long] = [len(found[i]) for i in long]
        else:
            ids, sizes = self.fold(words)
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(np.array(counts, dtype=np.int64)))].tolist()
        ids = ids.tolist()
        names, data = list(map(self.names.__getitem__, ids)), list(map(self.pieces.__getitem__, ids))
        for p, a, b in zip(parts, ends, ends[1:]):
            now[p] = (",".join(names[a:b]), b"".join(data[a:b]))

    def _cut(self, text: str) -> list:
        """The keys of a text's parts in the table; a text with blanks after white space is cut into words."""
        cut = cut_at_blanks(text)
        if cut:
            return [cut[0].encode("utf-8", "surrogatepass"), *cut[1]]
        return [w[1:] if w[0] == " " and w[1:] and not w[1].isspace() else w.encode("utf-8", "surrogatepass") for w in self.split(text)]

    def encoded(self, texts: list[str]):
        """For each text its ids as text and the bytes that they decode to."""
        for at in range(0, len(texts), TEXTS):
            cuts = list(map(self._cut, texts[at : at + TEXTS]))
            self._learn(self.known.missing(set().union(*cuts)))
            find = self.known.now.__getitem__
            for cut in cuts:
                found = list(map(find, cut))
                yield ",".join([f[0] for f in found if f[0]]), b"".join([f[1] for f in found])

    def encode(self, text: str) -> list[int]:
        ids = next(self.encoded([text]))[0]
        return list(map(int, ids.split(","))) if ids else []

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def _encoder(content: bytes, pattern: str) -> Encoder:
    return Encoder(content, pattern)


def encoder(content: bytes, pattern: str, kept: int = KEPT_PARTS) -> Encoder:
    """An encoder for a task: the worker keeps its tables of ranks for the next one, but not the parts of texts."""
    own = copy(_encoder(content, pattern))
    own.known = Recent(kept)
    return own


def encode_ids(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every text."""
    content = read_ranks(ranks_path)

    def run(ids, texts, own):
        found = own.encoded(texts)
        return {"doc_id": ids, "ids": [list(map(int, i.split(","))) if i else [] for i, _ in found]}

    return map_batches(docs.select("doc_id", "text"), per_text(run, IDS_SCHEMA, lambda: encoder(content, pattern)), IDS_SCHEMA)


def decode_ids(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, text) again from (doc_id, ids), in the JVM: each id becomes its binary piece and the pieces are concatenated."""
    pieces = [None] * (max(parse_ranks(read_ranks(ranks_path)).values()) + 1)
    for token, rank in parse_ranks(read_ranks(ranks_path)).items():
        pieces[rank] = token.hex()
    # one literal list of hexadecimal pieces, addressed by id
    listed = F.split(F.lit(",".join(p or "" for p in pieces)), ",")
    joined = F.transform("ids", lambda i: F.element_at(listed, i + 1))
    return encoded.select("doc_id", F.decode(F.unhex(F.array_join(joined, "")), "UTF-8").alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, kept: int = KEPT_PARTS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, the last from decoding the ids again.

    A task keeps ``kept`` distinct parts of texts; results do not depend on it.
    """
    content = read_ranks(ranks_path)

    def run(ids, texts, own):
        found = [(i.count(",") + bool(i), sha256_hex(i.encode()), sha256_hex(d)) for i, d in own.encoded(texts)]
        return {"doc_id": ids} | {c: [f[k] for f in found] for k, c in enumerate(("n_tokens", "ids_sha256", "decoded_sha256"))}

    return map_batches(docs.select("doc_id", "text"), per_text(run, SCHEMA, lambda: encoder(content, pattern, kept)), SCHEMA)


def merge_words(word: Column, ranks_path: str, buckets: int = 4096) -> Column:
    """Ids of one word (binary) by higher-order functions: bytes as hexadecimal pieces, folded by a literal rank map.

    Map lookups in Spark are linear, so the literal is an array of small maps, addressed by the pair's hash.
    """
    import json
    import zlib

    maps = [{} for _ in range(buckets)]
    for token, rank in parse_ranks(read_ranks(ranks_path)).items():
        maps[zlib.crc32(token.hex().encode()) % buckets][token.hex()] = rank
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")

    def rank(piece):
        return F.element_at(F.element_at(literal, (F.crc32(piece) % buckets + 1).cast("int")), piece)

    def step(parts, _):
        pairs = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p, i: F.coalesce(rank(F.concat(F.element_at(parts, i + 1), p)), F.lit(2**31 - 1)))
        best = F.array_min(pairs)
        at = F.array_position(pairs, best).cast("int")
        merged = F.concat(
            F.slice(parts, 1, at - 1),
            F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))),
            F.slice(parts, at + 2, F.size(parts)),
        )
        return F.when(F.coalesce(best, F.lit(2**31 - 1)) < 2**31 - 1, merged).otherwise(parts)

    hexed = F.lower(F.hex(word))
    start = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(hexed, 2 * i - 1, F.lit(2)))
    folded = F.aggregate(F.sequence(F.lit(1), F.length(word)), start, step)
    return F.transform(folded, rank)
