"""Near-duplicate documents by a signature-coordinate inverted join.

Every text becomes the set of its word shingles, and the set a MinHash signature of ``COORDINATES`` values. Texts with the same
set are one class from then on. A class is posted under its coordinate-value pairs, rarest first: two signatures that agree in
``MATCHES`` coordinates must meet in the first ``COORDINATES - MATCHES + 1`` of any common order, so the rest is skipped.
Pairs that meet count their collisions over sketches (two bits of each of ``SKETCHED`` coordinates, which can only overstate
them), and those above the threshold are confirmed on the full shingle sets.

A list never emits all its pairs. Its members are first compared with its smallest member. Then a list gives the components that
may be linked by members of it as a star; components that hang together so form a group, and the members of a group are compared
with each other inside tasks that give only the links they need. So rows follow the members, whether near copies of a text are
linked or just miss the threshold. Components are found by alternating large-star and small-star steps over written tables.

Two sets of similarity 0.8 agree in fewer than ``MATCHES`` of 64 coordinates with a probability of 8e-8, and their sketches in
fewer than ``ALIKE`` of 128 with one of 4e-7.

A text without words is linked with nothing and stays; a null text is an empty one. Rows that share a doc_id are one node:
they are linked whatever their texts. A row without a doc_id is a node of its own, greater than all ids: its doc_id is null, and so is
the component_id of a component of such rows alone, the first of which is kept. Other columns are not read.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from speechframe.llm.common import map_batches, per_text, small, with_ids, without_number
from speechframe.llm.exact_dedup import join_groups
from speechframe.session import materialize, ship_package

COORDINATES = 64
MATCHES = 33
#: A sketch holds two bits of each of so many coordinates; sketches of a link agree in ``ALIKE`` of them.
SKETCHED = 128
ALIKE = 87
POSTED = COORDINATES - MATCHES + 1
#: The order of coordinate-value pairs is taken from so many classes; any order gives the same links.
ORDER_ROWS = 4_096
#: Word hashes that a task remembers.
KEPT_WORDS = 200_000

SIGNED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("set_hash", T.BinaryType()), T.StructField("signature", T.BinaryType()), T.StructField("sketch", T.BinaryType())])
SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("shingles", T.BinaryType())])


@lru_cache(maxsize=1)
def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the coordinates' hash functions, from a fixed seed."""
    rng = np.random.default_rng(20_240_229)
    draw = lambda: rng.integers(0, 2**63, SKETCHED, dtype=np.uint64)
    return (draw() * np.uint64(2) + np.uint64(1))[:, None], draw()[:, None]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Turns texts into sorted arrays of distinct 64-bit shingle hashes; remembers the hashes of words."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def shingles(self, text: str) -> np.ndarray:
        # bytes.lower and bytes.split are those of ASCII alone
        tokens = text.encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
        if not len(h):
            return h
        size = min(self.words, len(h))
        total = np.full(len(h) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            total = _mixed(total) + h[k : k + len(total)]
        return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    a, b = _coefficients()
    low = np.full(SKETCHED, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(shingles), 8192):
        values = (shingles[None, at : at + 8192] * a + b) >> np.uint64(32)
        np.minimum(low, values.min(axis=1).astype(np.uint32), out=low)
    return low


def sign(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, signature, sketch) of every row; the last three are null without words."""

    def run(ids, texts, own):
        sets = list(map(own.shingles, texts))
        signatures = [signature(s) if len(s) else None for s in sets]
        return {
            "doc_id": ids,
            "n_shingles": list(map(len, sets)),
            "set_hash": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "signature": [None if s is None else s[:COORDINATES].tobytes() for s in signatures],
            "sketch": [None if s is None else sketch(s) for s in signatures],
        }

    return map_batches(docs.select("doc_id", "text"), per_text(run, SIGNED, lambda: Shingler(words)), SIGNED)


def sketch(values: np.ndarray) -> bytes:
    """Two bits of each coordinate."""
    bits = (_mixed(values.astype(np.uint64)) >> np.uint64(40)).astype(np.uint8) & 3
    return (bits[::4] | (bits[1::4] << 2) | (bits[2::4] << 4) | (bits[3::4] << 6)).tobytes()


def collisions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Coordinates whose bits agree, for rows of sketches as 64-bit words; never fewer than those that are equal."""
    differ = a ^ b
    differ |= differ >> np.uint64(1)
    return SKETCHED - np.bitwise_count(differ & np.uint64(0x5555555555555555)).sum(axis=1)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)


def _pairs_of_coordinates(signatures: np.ndarray) -> np.ndarray:
    return (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32))[None, :] | signatures


#: Members of a list that one task compares with each other; longer lists are cut into blocks that meet pairwise.
BLOCK = 20_000
#: Up to so many sets are compared one by one, more through the inverted list.
FEW = 8
POSTING = "key long, rep long, n long, block int, same boolean, sketch binary"


def _order(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate-value pairs that occur again in a bounded sample of classes, and how often."""
    rows = classes.select("signature", F.xxhash64("rep").alias("h")).orderBy("h").limit(ORDER_ROWS).select("signature").collect()
    if not rows:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    seen, counts = np.unique(_pairs_of_coordinates(_signatures(pa.array([bytes(r[0]) for r in rows]))), return_counts=True)
    return seen[counts > 1], counts[counts > 1]


def post(classes: DataFrame) -> DataFrame:
    """The postings of each class under its ``POSTED`` rarest coordinate-value pairs."""
    total = classes.count()
    common, counts = _order(classes)
    shared = classes.sparkSession.sparkContext.broadcast((common, counts))
    sampled = max(1, min(ORDER_ROWS, total))

    def run(batches):
        common, counts = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            reps, n = batch.column("rep").to_numpy(), batch.column("n_shingles").to_numpy()
            signatures = _signatures(batch.column("signature"))
            pairs = _pairs_of_coordinates(signatures)
            at = np.minimum(np.searchsorted(common, pairs), max(0, len(common) - 1))
            often = np.where(common[at] == pairs, counts[at], 1) if len(common) else np.ones(pairs.shape, dtype=np.int64)
            rank = often + (_mixed(pairs) >> np.uint64(11)) / 2.0**53
            chosen = np.argsort(rank, axis=1)[:, :POSTED]
            key = _mixed(np.take_along_axis(pairs, chosen, 1)).ravel()
            blocks = np.ceil(np.take_along_axis(often, chosen, 1).ravel() * (total / sampled) / BLOCK).astype(np.int64)
            row = np.repeat(np.arange(len(reps)), chosen.shape[1])
            block = (_mixed(reps.astype(np.uint64))[row] % np.maximum(1, blocks).astype(np.uint64)).astype(np.int64)
            again = np.maximum(1, blocks)  # one posting for each block that this one meets
            row, key, block, blocks = (np.repeat(x, again) for x in (row, key, block, again))
            other = np.arange(len(row)) - np.repeat(np.cumsum(again) - again, again)
            low, high = np.minimum(block, other), np.maximum(block, other)
            key = key ^ (_mixed((low * 1_000_003 + high).astype(np.uint64)) * (blocks > 1).astype(np.uint64))
            sketches = batch.column("sketch")
            for i in range(0, len(row), 50_000):
                part = slice(i, i + 50_000)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": key[part].astype(np.int64),
                        "rep": reps[row[part]],
                        "n": n[row[part]],
                        "block": block[part].astype(np.int32),
                        "same": low[part] == high[part],
                        "sketch": sketches.take(pa.array(row[part])),
                    }
                )

    return map_batches(classes.select("rep", "n_shingles", "signature", "sketch"), run, POSTING)


def _whole_lists(batches, columns):
    """Rows of whole lists as arrays; the input is in the order of keys, so a list may run on into the next batch."""
    kept = None
    for batch in batches:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns if c != "sketch"}
        rows["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(-1, 4)
        if kept is not None:
            rows = {c: np.concatenate([kept[c], rows[c]]) for c in rows}
        if not len(rows["key"]):
            continue
        cut = np.searchsorted(rows["key"], rows["key"][-1])
        kept = {c: v[cut:] for c, v in rows.items()}
        if cut:
            yield {c: v[:cut] for c, v in rows.items()}
    if kept is not None:
        yield kept


def _alike(rows, a, b, share):
    """Of the pairs of rows a, b those whose sizes and collisions allow a link."""
    n = rows["n"]
    small_, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    fits = 100 * small_ >= share * large
    a, b = a[fits], b[fits]
    enough = collisions(rows["sketch"][a], rows["sketch"][b]) >= ALIKE
    return a[enough], b[enough]


LISTS = "key long, rep long, n long, block int, same boolean, sketch binary, center long"


def merge_lists(postings: DataFrame, share: int) -> DataFrame:
    """Rows of the lists that have several members; ``center`` is the list's smallest member where it may be linked with the row."""

    def run(batches):
        for rows in _whole_lists(batches, ("key", "rep", "n", "block", "same", "sketch")):
            key = rows["key"]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            first, several = np.repeat(starts, sizes), np.repeat(sizes, sizes) > 1
            i = np.flatnonzero(several & (rows["rep"] != rows["rep"][first]))
            center = np.full(len(key), -1, dtype=np.int64)
            linked = np.zeros(len(key), dtype=bool)
            a, b = _alike(rows, i, first[i], share)
            center[a], linked[a] = rows["rep"][b], True
            keep = np.flatnonzero(several)
            for at in range(0, len(keep), 50_000):
                k = keep[at : at + 50_000]
                yield pa.RecordBatch.from_pydict(
                    {
                        **{c: rows[c][k] for c in ("key", "rep", "n", "block", "same")},
                        "sketch": pa.array([s.tobytes() for s in rows["sketch"][k]], pa.binary()),
                        "center": pa.array(center[k], mask=~linked[k]),
                    }
                )

    dealt = postings.repartition("key").sortWithinPartitions("key", "rep")
    return map_batches(dealt, run, LISTS)


#: Members and shingles of a group's part, all of which one task compares with those of another part.
MEMBERS, SHINGLES = 1_000, 2_000_000
#: Pairs of rows that are held at a time before they are joined to sets.
HELD = 1_000_000


def _join_up(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels of rows after the pairs x, y are joined: rows that are connected get the smallest label among them."""
    while True:
        low = np.minimum(labels[x], labels[y])
        before = labels.copy()
        np.minimum.at(labels, labels[x], low)
        np.minimum.at(labels, labels[y], low)
        labels = labels[labels]
        if np.array_equal(labels, before):
            return labels


def merge_components(lists: DataFrame, share: int) -> DataFrame:
    """Pairs of components (a, b) that lists show members of which may be linked.

    A list gives its components that hang together by such members as a star, so its rows are at most its members.
    """

    def run(batches):
        for rows in _whole_lists(batches, ("key", "rep", "n", "block", "same", "comp", "sketch")):
            key, comp = rows["key"], rows["comp"]
            labels, held, size = np.arange(len(key)), [], 0
            for lag in range(1, len(key)):
                i = np.flatnonzero(key[lag:] == key[:-lag])
                if not len(i):
                    break
                j = i + lag
                apart = (comp[i] != comp[j]) & (rows["same"][i] | (rows["block"][i] != rows["block"][j]))
                i, j = i[apart], j[apart]
                apart = labels[i] != labels[j]
                x, y = _alike(rows, j[apart], i[apart], share)
                held.append((x, y))
                size += len(x)
                if size > HELD:
                    labels, held, size = _join_up(labels, *map(np.concatenate, zip(*held))), [], 0
            if size:
                labels = _join_up(labels, *map(np.concatenate, zip(*held)))
            moved = np.flatnonzero(comp != comp[labels])
            if len(moved):
                found = np.unique(np.stack([comp[moved], comp[labels[moved]]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    dealt = lists.select("key", "rep", "n", "block", "same", "comp", "sketch").repartition("key").sortWithinPartitions("key", "rep")
    return map_batches(dealt, run, "a long, b long").distinct()


def shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Written (doc_id, shingles) of the documents listed in ``ids``."""

    def sets(ids, texts, own):
        return {"doc_id": ids, "shingles": [own.shingles(t).tobytes() for t in texts]}

    chosen = docs.select("doc_id", "text").join(small(materialize(ids.distinct(), "ids")), "doc_id", "left_semi")
    return materialize(map_batches(chosen, per_text(sets, SETS, lambda: Shingler(words)), SETS), "sets")


def compare_groups(docs: DataFrame, classes: DataFrame, groups: DataFrame, words: int, share: int) -> DataFrame:
    """Links (a, b) that join the components within each group; ``groups`` is (comp, grp), ``classes`` (rep, comp, n_shingles, sketch).

    A group is cut into parts, every two of which meet in one task with their shingle sets, as an inverted list. A task gives only
    links between what is not yet joined in it, so rows follow the members and not their pairs.
    """
    members = materialize(classes.join(small(groups), "comp"), "members")
    parts = F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("n_shingles") / SHINGLES)).cast("int")
    sizes = materialize(members.groupBy("grp").agg(parts.alias("parts")), "parts")
    sets = shingle_sets(docs, members.select(F.col("rep").alias("doc_id")), words)
    own = members.join(small(sizes), "grp").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("grp", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "rep", "comp", "sketch")
    rows = met.join(sets.toDF("rep", "x"), "rep")

    def compare(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        table = table.take(pc.sort_indices(table, [("part", "ascending"), ("rep", "ascending")]))
        own = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table.column("x")]
        rep, part, sizes = table.column("rep").to_numpy(), table.column("part").to_numpy(), np.array(list(map(len, own)))
        root = table.column("comp").to_numpy().copy()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint64).reshape(-1, 4)
        # the inverted list of those that are looked up in
        listed = np.flatnonzero(part == high)
        shingles = np.concatenate([own[k] for k in listed])
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], np.repeat(np.arange(len(listed), dtype=np.int32), sizes[listed])[order]
        links = []
        for a in np.flatnonzero(part == low):
            fits = (root[listed] != root[a]) & (100 * np.minimum(sizes[listed], sizes[a]) >= share * np.maximum(sizes[listed], sizes[a]))
            if low == high:
                fits &= listed > a
            fits[fits] = collisions(sketches[listed[fits]], sketches[a]) >= ALIKE
            if not fits.any():
                continue
            x = own[a]
            if fits.sum() <= FEW:
                both = np.zeros(len(listed), dtype=np.int64)
                for b in np.flatnonzero(fits):
                    both[b] = len(np.intersect1d(x, own[listed[b]], assume_unique=True))
            else:
                first, last = np.searchsorted(shingles, x), np.searchsorted(shingles, x, side="right")
                n = last - first
                at = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
                both = np.bincount(owner[at], minlength=len(listed))
            for b in listed[fits & (100 * both >= share * (sizes[a] + sizes[listed] - both))]:
                if root[a] != root[b]:
                    links.append((rep[a], rep[b]))
                    root[root == root[b]] = root[a]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    ship_package(docs.sparkSession)
    return materialize(rows.groupBy("grp", "low", "high").applyInArrow(compare, "a long, b long"), "links")


def confirm(docs: DataFrame, pairs: DataFrame, words: int, share: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have a similarity of ``share`` percent or more. ``pairs`` is a written table."""
    full = shingle_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), words)

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= share * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(mask) for c in ("a", "b")})

    sides = pairs.join(full.toDF("a", "x"), "a").join(full.toDF("b", "y"), "b")
    return materialize(map_batches(sides, compare, "a long, b long").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(rep, comp): the smallest node reachable, for every node of the links (a, b) that is not itself the smallest."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    state = None
    while True:
        # large star: the larger neighbours of each node are tied to its smallest one
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: the smaller neighbours of each node, and itself, to its smallest one
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        tied = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v")
        edges = materialize(tied.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("rep"), F.col("v").alias("comp"))
        state = now


def near_dedup(docs: DataFrame, words: int = 5, share: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: texts whose sets of ``words``-word shingles are similar by ``share`` percent are linked."""
    return numbered_components(with_ids(docs), words, share).withColumns({c: without_number(c) for c in ("doc_id", "component_id")})


def numbered_components(docs: DataFrame, words: int = 5, share: int = 80) -> DataFrame:
    """The rows of ``near_dedup`` for documents that all have an id."""
    signed = materialize(sign(docs, words), "signed")
    classes = materialize(
        signed.filter("n_shingles > 0").groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch")),
        "classes",
    )
    lists = materialize(merge_lists(post(classes), share), "lists")

    def labelled(df: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
        labels = small(found.select(F.col("rep").alias(node), F.col("comp").alias(name)))
        return df.join(labels, node, "left").withColumn(name, F.coalesce(name, node))

    # first each class with the smallest center it has; most links are found so
    stars = lists.filter("center IS NOT NULL").groupBy(F.col("rep").alias("a")).agg(F.min("center").alias("b"))
    links = confirm(docs, materialize(stars, "pairs"), words, share)
    found = components(links)
    # then what lists show between components: these hang together as groups, in which all are compared
    mixed = labelled(lists, found, "rep", "comp")
    several = mixed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
    edges = materialize(merge_components(mixed.join(several, "key", "left_semi"), share), "rest")
    joined = components(edges).toDF("comp", "grp")
    groups = materialize(joined.unionByName(joined.select(F.col("grp").alias("comp"), "grp").distinct()), "groups")
    links = links.unionByName(compare_groups(docs, labelled(classes.select("rep", "n_shingles", "sketch"), found, "rep", "comp"), groups, words, share))
    found = components(links)
    groups = materialize(labelled(classes.select("set_hash", "size", "rep"), found, "rep", "component_id").drop("rep"), "components")
    rows = signed.select("doc_id", "n_shingles", "set_hash")
    linked = join_groups(rows.filter("n_shingles > 0"), groups, "set_hash", "size").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))
