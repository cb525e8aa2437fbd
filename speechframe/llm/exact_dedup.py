"""Exact deduplication with two passes over a Bloom filter, in DataFrame operations only.

Texts are reduced to the digest of their normal form once. The first pass counts, for each digest, the filter positions it
sets; positions set twice or more make up the filter of possibly repeated digests. The second pass tests every row against
that filter: rows that fail are certainly unique and pass straight through, the others are shuffled by their digest. A false
positive is a group of one, so the result is exact at any filter size.

The filter is a table of blocks of 32,768 bits; a digest sets two bits of one block. It has 16 bits a row up to
``MAX_BITS``, which bounds what is broadcast to ``MAX_BITS`` / 8 bytes; a fuller filter only lets more rows shuffle.

A null text counts as empty, and empty texts are equal to each other. Rows that share a doc_id are rows of their own: they
count in ``group_size`` and are all marked as kept when the id is the smallest of its group. Other columns are not read.
"""

from pyspark.sql import Column, DataFrame, functions as F

from speechframe.session import materialize

BLOCK_BITS = 32_768  # what one bitmap of bitmap_construct_agg holds
BITS_PER_ROW = 16
MAX_BITS = 2**29
#: A group with more than this share of the shuffled rows is joined by broadcast; there can be at most so many of them.
HOT_GROUPS = 500


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _bit_is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), bit.bitwiseAND(F.lit(7))).cast("int")) != 0


def possibly_repeated(digests: DataFrame, key: str = "digest") -> tuple[DataFrame, DataFrame]:
    """(rows whose digest may occur again, rows whose digest certainly does not) of a written table."""
    blocks = max(1, min(MAX_BITS, BITS_PER_ROW * digests.count()) // BLOCK_BITS)
    h = F.xxhash64(key)
    placed = digests.withColumns(
        {
            "_block": F.pmod(h, F.lit(blocks)),
            "_bit1": F.pmod(F.xxhash64(F.lit(1), key), F.lit(BLOCK_BITS)).cast("int"),
            "_bit2": F.pmod(F.xxhash64(F.lit(2), key), F.lit(BLOCK_BITS)).cast("int"),
        }
    )
    twice = (
        placed.select("_block", F.explode(F.array_distinct(F.array("_bit1", "_bit2"))).alias("_bit"))
        .groupBy("_block", "_bit")
        .count()
        .filter("count > 1")
        .groupBy("_block")
        .agg(F.bitmap_construct_agg(F.col("_bit").cast("long")).alias("_bitmap"))
    )
    # at most MAX_BITS / BLOCK_BITS rows of 4 kB each
    tested = placed.join(F.broadcast(twice), "_block", "left")
    hit = F.coalesce(_bit_is_set(F.col("_bitmap"), F.col("_bit1")) & _bit_is_set(F.col("_bitmap"), F.col("_bit2")), F.lit(False))
    return tested.filter(hit).select(digests.columns), tested.filter(~hit).select(digests.columns)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of their group. Groups that hold many rows are broadcast, so that no task gets all of a large group."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(groups.filter(F.col(size) > max(1, total // HOT_GROUPS)))
    rest = groups.filter(F.col(size) <= max(1, total // HOT_GROUPS))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    digests = materialize(docs.select("doc_id", F.unhex(F.sha2(normalized(F.col("text")), 256)).alias("digest")), "digests")
    maybe, unique = possibly_repeated(digests)
    maybe = materialize(maybe, "maybe")
    groups = materialize(maybe.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    found = join_groups(maybe, groups, "digest", "group_size").select("doc_id", "keep_id", "group_size", "digest")
    alone = unique.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    return found.unionByName(alone).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
