"""Token counts at every prefix of a text by dynamic programming.

For a word of bytes the encoding of a prefix ends in exactly one token: the one whose pair with the last token of the
shorter prefix does not merge. So the count of each prefix is one more than that of a shorter prefix, and one pass over a
word counts all its prefixes. A text is cut at the starts of its runs of white space, where no word begins earlier; such a
unit's counts do not depend on the rest of the text. They are kept as differences, so that the counts at every prefix of a
text are one running sum, from which the total, any truncation point and any budget are read without encoding again.

A null text counts as empty. Special strings inside a text are single tokens, as the tokenizer's library has them by default;
a prefix that ends inside such a string is plain text. Columns other than the id and the text are not read; repeated rows
are counted each on their own.
"""

import json
from array import array
from functools import lru_cache
from itertools import accumulate

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from speechframe.llm.bpe import FOLDED, LONG, MARKS, NEVER, TEXTS, cut_at_blanks
from speechframe.llm.common import Recent, map_batches, per_text

#: Distinct words, units and pairs of tokens that a task keeps of each.
KEPT_UNITS = 400_000
#: Words whose prefixes the split pattern takes apart.
APART = ("'re", "'ve", "'ll")
#: A difference of one token.
ONE = array("h", [1]).tobytes()

COUNTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
        T.StructField("fitting_chars", T.LongType()),
    ]
)
PREFIXES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))])


def _printable_bytes() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the rest follow from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _running(differences: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(differences, dtype=np.int16), dtype=np.int32)


class PrefixCounter:
    def __init__(self, content: bytes, pattern: str):
        spec = json.loads(content)
        to_byte = _printable_bytes()
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocabulary = spec["model"]["vocab"]
        self.ranks = {bytes(to_byte[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        self.longest = max(map(len, self.ranks))
        # lengths of the tokens that end in two given bytes, the longest first
        ends: dict[bytes, set] = {}
        for token in self.ranks:
            ends.setdefault(token[-2:], set()).add(len(token))
        self.lengths = {end: (*sorted(sizes | {1}, reverse=True),) for end, sizes in ends.items() if len(end) == 2}
        # the two tokens that each one is merged of, and the rank at which they merge; single bytes are made of nothing
        self.head, self.tail, self.merged = {}, {}, {}
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            whole, left, right = vocabulary[left + right], vocabulary[left], vocabulary[right]
            self.head[whole], self.tail[whole], self.merged[left << 32 | right] = left, right, whole
        self._index(max(self.ranks.values()) + 1)
        self.split = regex.compile(pattern).findall
        self.units = regex.compile(r"\s*\S+|\s+").findall
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.words, self.known, self.apart = Recent(KEPT_UNITS), Recent(KEPT_UNITS), {}

    def _index(self, size: int) -> None:
        """The same tables as arrays, and the tokens as a trie that is walked from their last byte."""
        self.heads, self.tails = np.full(size, -1), np.full(size, -1)
        self.heads[list(self.head)], self.tails[list(self.tail)] = list(self.head.values()), list(self.tail.values())
        pairs = np.array([*sorted(self.merged.items()), (NEVER, NEVER)], dtype=np.int64)
        self.pair_keys, self.pair_ranks = pairs[:, 0].copy(), pairs[:, 1].copy()
        children: dict[int, int] = {}
        tokens = [-1]
        for token, rank in self.ranks.items():
            node = 0
            for b in reversed(token):
                step = node << 8 | b
                if step not in children:
                    children[step] = len(tokens)
                    tokens.append(-1)
                node = children[step]
            tokens[node] = rank
        steps = np.array([*sorted(children.items()), (NEVER, 0)], dtype=np.int64)
        self.steps, self.nodes, self.node_tokens = steps[:, 0].copy(), steps[:, 1].copy(), np.array(tokens)

    def _all_stay_apart(self, pairs: np.ndarray) -> np.ndarray:
        """``_stay_apart`` of many pairs at once."""
        pairs, back = np.unique(pairs, return_inverse=True)
        out = np.zeros(len(pairs), dtype=bool)
        row, left, right, until = np.arange(len(pairs)), pairs >> 32, pairs & 0xFFFFFFFF, np.full(len(pairs), NEVER)
        while len(row):
            pair = left << 32 | right
            at = np.searchsorted(self.pair_keys, pair)
            rank = np.where(self.pair_keys[at] == pair, self.pair_ranks[at], NEVER)
            made_left, made_right = self.tails[left], self.heads[right]
            single = (made_left < 0) & (made_right < 0)
            out[row[single & (rank >= until)]] = True
            go = ~single & (rank >= until)
            row, left, right, until, made_left, made_right = row[go], left[go], right[go], until[go], made_left[go], made_right[go]
            undo = (made_left >= 0) & ((made_right < 0) | (left > right))
            until = np.where(undo, left, right + 1)
            left, right = np.where(undo, made_left, left), np.where(undo, right, made_right)
        return out[back]

    def _batch(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each prefix of many words, at the ends of their characters, and how many these are of each word.

        Position by position, for all words that are so long: the tokens that end there are found in the trie, and the
        longest of them that stays apart from the last token before it is taken.
        """
        words_of = sorted(range(len(words)), key=lambda i: -len(words[i]))
        sizes = np.array([len(words[i]) for i in words_of], dtype=np.int64)
        data = np.frombuffer(b"".join([words[i] for i in words_of]), dtype=np.uint8).astype(np.int64)
        starts = np.append(0, np.cumsum(sizes))[:-1]
        last, count = np.empty(len(data), dtype=np.int64), np.empty(len(data), dtype=np.int32)
        for i in range(1, int(sizes[0]) + 1):
            end = starts[: np.searchsorted(-sizes, -i, side="right")] + i - 1
            row, node, found = np.arange(len(end)), np.zeros(len(end), dtype=np.int64), []
            for size in range(1, min(i, self.longest) + 1):
                step = node << 8 | data[end[row] - size + 1]
                at = np.searchsorted(self.steps, step)
                there = self.steps[at] == step
                row, node = row[there], self.nodes[at[there]]
                if not len(row):
                    break
                token = self.node_tokens[node]
                known = token >= 0
                found.append((size, row[known], token[known]))
            open_ = np.ones(len(end), dtype=bool)
            for size, row, token in reversed(found):
                free = open_[row]
                row, token = row[free], token[free]
                if size < i:
                    alone = self._all_stay_apart(last[end[row] - size] << 32 | token)
                    row, token = row[alone], token[alone]
                    count[end[row]] = count[end[row] - size] + 1
                else:
                    count[end[row]] = 1
                last[end[row]] = token
                open_[row] = False
        # back to the order of the words, at the ends of characters only
        ends = np.append(data[1:] & 0xC0 != 0x80, True)
        chars = np.add.reduceat(ends, starts) if len(starts) else np.empty(0, dtype=np.int64)
        order = np.argsort(np.array(words_of), kind="stable")
        first, chars = (np.cumsum(chars) - chars)[order], chars[order]
        return count[ends][np.arange(chars.sum()) + np.repeat(first - (np.cumsum(chars) - chars), chars)], chars

    def _stay_apart(self, pair: int) -> bool:
        """Whether two neighbouring tokens are also the encoding of their bytes.

        Their merges are undone, the last one first. The two tokens that meet at the border in between must not merge at a
        lower rank than that of the merge that took one of them away; of equal ranks the left one goes first.
        """
        left, right, until = pair >> 32, pair & 0xFFFFFFFF, NEVER
        merged, head, tail = self.merged, self.head, self.tail
        while True:
            if merged.get(left << 32 | right, NEVER) < until:
                return False
            made_left, made_right = tail.get(left), head.get(right)
            if made_left is not None and (made_right is None or left > right):
                until, left = left, made_left
            elif made_right is not None:
                until, right = right + 1, made_right
            else:
                return True

    def word_counts(self, word: str) -> tuple:
        """Tokens of each prefix of one word, at the ends of its characters."""
        return self.words.get(word, self._word_counts)

    def _word_counts(self, word: str) -> tuple:
        if word in APART:
            first = self.word_counts(word[0])[-1]
            return (first, first + self.word_counts(word[1])[-1], self._dynamic(word)[-1])
        return self._dynamic(word)

    def _dynamic(self, word: str) -> tuple:
        data, ranks, lengths, apart = word.encode("utf-8", "surrogatepass"), self.ranks, self.lengths, self.apart
        if len(apart) > KEPT_UNITS:
            apart.clear()
        n = len(data)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            whole = ranks.get(data[:i]) if i <= self.longest else None
            if whole is not None:
                last[i], count[i] = whole, 1
                continue
            for size in lengths.get(data[i - 2 : i], (1,)):
                if size < i:
                    token = ranks.get(data[i - size : i])
                    if token is not None:
                        pair = last[i - size] << 32 | token
                        alone = apart.get(pair)
                        if alone is None:
                            alone = apart[pair] = self._stay_apart(pair)
                        if alone:
                            last[i], count[i] = token, count[i - size] + 1
                            break
        if n == len(word):
            return tuple(count[1:])
        return tuple([count[e] for e in accumulate(len(c.encode("utf-8", "surrogatepass")) for c in word)])

    def unit_counts(self, unit: str) -> list[int]:
        """Tokens of each prefix of a unit: a run of white space and what follows up to the next one."""
        body = unit.lstrip() if unit[0].isspace() else unit
        # str.lstrip also takes the separators x1c to x1f, which the split pattern has among other characters
        space = len(unit) - len(body)
        for i, c in enumerate(unit[:space]):
            if "\x1c" <= c <= "\x1f":
                space, body = i, unit[i:]
                break
        counts: list[int] = list(self.word_counts(unit[:space])) if space else []
        if not body:
            return counts
        total, head = 0, ""
        if space:
            total = counts[-2] if space > 1 else 0
            if unit[space - 1] == " ":
                head = " "
            else:
                total += self.word_counts(unit[space - 1])[-1]
        for word in self.split(head + body):
            own = self.word_counts(word)
            counts.extend(total + c for c in (own[1:] if head else own))
            total, head = total + own[-1], ""
        return counts

    def _steps(self, text: str) -> bytes:
        """Differences between the counts of successive prefixes."""
        counts = self.unit_counts(text)
        return array("h", [b - a for a, b in zip([0, *counts], counts)]).tobytes()

    def _learn(self, new: set) -> None:
        """Put the differences between the counts of successive prefixes of new parts, with the blank before them, into the table."""
        known = self.known.now
        # the pattern takes letters with the blank before them as one word
        plain = [p for p in new if p.isalpha() and len(p) <= LONG]
        # and a mark after them as a word of one token
        marked = {p: p[:-1] for p in new if p[-1] in MARKS and p[:-1].isalpha() and len(p) <= LONG}
        plain += {p for p in marked.values()}.difference(known).difference(plain)
        for at in range(0, len(plain), FOLDED):
            parts = plain[at : at + FOLDED]
            counts, chars = self._batch([(" " + p).encode("utf-8", "surrogatepass") for p in parts])
            steps, ends = np.diff(counts, prepend=0), np.append(0, np.cumsum(chars))
            steps[ends[:-1]] = counts[ends[:-1]]
            steps = steps.astype(np.int16).tobytes()
            known.update((p, steps[2 * a : 2 * b]) for p, a, b in zip(parts, ends.tolist(), ends[1:].tolist()))
        known.update((p, known[letters] + ONE) for p, letters in marked.items())
        others = new.difference(plain).difference(marked)
        words = [w for w in self.words.missing({w for p in others for w in self.split(" " + p)}) if len(w) <= LONG and w not in APART]
        for at in range(0, len(words), FOLDED):
            counts, chars = self._batch([w.encode("utf-8", "surrogatepass") for w in words[at : at + FOLDED]])
            counts, ends = counts.tolist(), np.append(0, np.cumsum(chars)).tolist()
            self.words.now.update((w, tuple(counts[a:b])) for w, a, b in zip(words[at : at + FOLDED], ends, ends[1:]))
        for p in others:
            known[p] = b"".join(map(self._steps, self.units(" " + p)))

    def _differences(self, texts: list[str]):
        """Differences between the counts of successive prefixes of each text."""
        for at in range(0, len(texts), TEXTS):
            cuts = list(map(cut_at_blanks, texts[at : at + TEXTS]))
            self._learn(self.known.missing(set().union(*(c[1] for c in cuts if c))))
            find = self.known.now.__getitem__
            for cut, text in zip(cuts, texts[at : at + TEXTS]):
                first, parts = cut or (text, [])
                yield b"".join([*map(self._steps, self.units(first)), *map(find, parts)])

    def _plain(self, text: str) -> bytes:
        return next(self._differences([text]))

    def all_prefix_counts(self, texts: list[str]):
        """``prefix_counts`` of each text; what is new in them is counted together."""
        has_special = [bool(self.special) and any(s in t for s in self.special) for t in texts]
        plain = self._differences([t for t, s in zip(texts, has_special) if not s])
        for text, special in zip(texts, has_special):
            yield self.prefix_counts(text) if special else _running(next(plain))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of each non-empty prefix of ``text``, in characters; the last one is the text's own count."""
        if not self.at_special or not any(s in text for s in self.special):
            return _running(self._plain(text))
        parts, done, total = [], 0, 0
        for m in self.at_special.finditer(text):
            plain = _running(self._plain(text[done : m.start()])) + total
            before, tail = total, text[done : m.start()]
            if tail:
                last = self.units(tail)[-1]
                before = int(plain[-len(last) - 1]) if len(last) < len(tail) else total
                total = int(plain[-1])
            else:
                last = ""
            open_counts = self.unit_counts(last + m.group()[:-1])[len(last) :]
            total += 1
            parts += [plain, np.array(open_counts, dtype=np.int32) + before, np.array([total], dtype=np.int32)]
            done = m.end()
        parts.append(_running(self._plain(text[done:])) + total)
        return np.concatenate(parts).astype(np.int32)


def fitting(prefix: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    within = np.flatnonzero(prefix <= budget)
    return int(within[-1]) + 1 if len(within) else 0


@lru_cache(maxsize=2)
def counter(content: bytes, pattern: str) -> PrefixCounter:
    """The counter of this worker; its table serves all the tasks that the worker runs."""
    return PrefixCounter(content, pattern)


def _content(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def prefix_counts(docs: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """(doc_id, prefix_tokens): the token count of every prefix, one per character."""
    content = _content(tokenizer_path)

    def run(ids, texts):
        return {"doc_id": ids, "prefix_tokens": list(counter(content, pattern).all_prefix_counts(texts))}

    return map_batches(docs.select("doc_id", "text"), per_text(run, PREFIXES), PREFIXES)


def count_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fitting_chars): the last is the longest prefix within ``limit`` tokens."""
    content = _content(tokenizer_path)

    def run(ids, texts):
        bytes_, tokens, fits = [], [], []
        for t, counts in zip(texts, counter(content, pattern).all_prefix_counts(texts)):
            n = int(counts[-1]) if len(counts) else 0
            bytes_.append(len(t.encode("utf-8", "surrogatepass")))
            tokens.append(n)
            fits.append(len(t) if n <= limit else fitting(counts, limit))
        return {"doc_id": ids, "n_bytes": bytes_, "n_tokens": tokens, "over_limit": [n > limit for n in tokens], "fitting_chars": fits}

    return map_batches(docs.select("doc_id", "text"), per_text(run, COUNTS), COUNTS)
