"""Exact deduplication through an extendible-hash index on shared files.

Keys are 64-bit hashes of white-space-normalised texts. The directory maps the
leading ``depth`` bits of a key to a bucket; it starts with one bucket and is
doubled, splitting the overfull buckets, until every bucket holds at most
``capacity`` entries (only entries with one and the same key cannot be split;
they form a chain). Owner tasks take ranges of buckets and write them, one row per key
with its chain of entries, to files in the shared folder. A row looks its text up
by the directory's bucket and the key, and finds its entry in the chain by the digest.

Bytes are compared where entries are formed: an entry carries the smallest and the largest
of its texts in byte order until all tasks' parts have met, and only if these are the same are
all of its texts. Else the entry is marked, and its rows are told apart by their texts.

Equal texts are reduced to one entry inside each task before anything is
shuffled, so a group of copies of any size reaches its owner as a few rows.

Cases: null counts as the empty text, and all empty texts are equal; of rows with
equal ids and texts one entry stays the keeper and every row of that id is kept;
a null id is larger than any id; very long texts are compared whole; an empty table gives an
empty result; columns named like those added are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from flowlog.llm.common import SPACE, materialise, text_of

CAPACITY = 200_000       # entries of a bucket before it is split
STEP_BITS = 10           # directory bits counted by one pass over the keys
MAX_DEPTH = 20           # 2^20 slots at most; beyond it overfull buckets stay chains


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def _slot(depth: int) -> Column:
    return F.shiftrightunsigned(F.col("key"), 64 - depth).cast("int") if depth else F.lit(0)


def build_directory(keys: DataFrame, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Buckets (depth, leading bits) after doubling until none is overfull.

    Only counts per slot travel to the driver: at most 2^STEP_BITS for each overfull
    bucket of the level before, at most 2^MAX_DEPTH in all.
    """
    buckets, full = [], [(0, 0)]
    depth = 0
    while full and depth < MAX_DEPTH:
        step = min(STEP_BITS, MAX_DEPTH - depth)
        counted = keys.groupBy(_slot(depth + step).alias("slot")).count()
        if depth:
            counted = counted.where(F.shiftrightunsigned(F.col("slot"), step).isin([bits for _, bits in full]))
        leaf = {row["slot"]: row["count"] for row in counted.collect()}
        level = [(depth, bits) for _, bits in full]
        for more in range(step):                       # double, and split what is overfull
            split = []
            for at, bits in level:
                span = step - (at - depth)
                held = sum(leaf.get(s, 0) for s in range(bits << span, (bits + 1) << span))
                if held <= capacity:
                    buckets.append((at, bits))
                else:
                    split += [(at + 1, 2 * bits), (at + 1, 2 * bits + 1)]
            level = split
        depth += step
        full = [x for x in level if leaf.get(x[1], 0) > capacity]
        buckets += [x for x in level if leaf.get(x[1], 0) <= capacity]
    return sorted(buckets + full, key=lambda x: x[1] << (MAX_DEPTH - x[0]))


def bucket_of(buckets: list[tuple[int, int]], key: str = "key") -> Column:
    """Directory lookup as an expression: the bucket's number for a key, by its first slot at full depth."""
    firsts = [bits << (MAX_DEPTH - depth) for depth, bits in buckets]
    slot = F.shiftrightunsigned(F.col(key), 64 - MAX_DEPTH).cast("int")
    levels = F.array(*[F.lit(x) for x in firsts]) if len(firsts) <= 4096 else F.from_json(F.lit(str(firsts)), "array<int>")
    return F.size(F.filter(levels, lambda x: x <= slot)) - 1


def text_key(body: Column) -> Column:
    return F.xxhash64(body)


def text_digest(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def entries_of(keyed: DataFrame, id_col: str) -> DataFrame:
    """One entry per key and digest: least id, rows, and whether texts of other bytes have met in it."""
    return (keyed.groupBy("text_key", "text_digest")
            .agg(F.min(id_col).alias("keep_id"), F.count("*").alias("group_size"), F.min("text_body").alias("first"), F.max("text_body").alias("last"))
            .select(F.col("text_key").alias("key"), F.col("text_digest").alias("digest"), "keep_id", "group_size",
                    (F.col("first") != F.col("last")).alias("mixed")))


def place(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The index and its directory: rows (bucket, key, chain), each owner task writes one range of buckets, sorted by key."""
    buckets = build_directory(entries.select("key"), capacity)
    placed = entries.withColumn("bucket", bucket_of(buckets))
    owned = (placed.repartitionByRange(F.col("bucket"), F.col("key"))
             .groupBy("bucket", "key").agg(F.sort_array(F.collect_list(F.struct("digest", "keep_id", "group_size", "mixed"))).alias("chain"))
             .sortWithinPartitions("bucket", "key"))
    return materialise(owned, "exact-index"), buckets


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 key: Callable[[Column], Column] = text_key, digest: Callable[[Column], Column] = text_digest) -> DataFrame:
    """``docs`` with ``text_digest``, ``keep_id``, ``group_size`` and ``kept`` (columns of these names are replaced)."""
    docs = docs.drop("text_digest", "keep_id", "group_size", "kept", "text_key", "text_body", "text_bucket", "text_entry", "chain")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    body = normalised(text_of(text_col))
    keyed = docs.withColumns({"text_body": body, "text_key": key(body), "text_digest": digest(body)})
    index, buckets = place(materialise(entries_of(keyed, id_col), "exact-entries"), capacity)
    lookup = index.select(F.col("bucket").alias("text_bucket"), F.col("key").alias("text_key"), "chain")
    found = (keyed.withColumn("text_bucket", bucket_of(buckets, "text_key")).join(lookup, ["text_bucket", "text_key"])
             .withColumn("text_entry", F.element_at(F.filter("chain", lambda e: e["digest"] == F.col("text_digest")), 1)))
    single = found.select(*columns, "text_digest", "text_entry.keep_id", "text_entry.group_size")
    if not index.where(F.exists("chain", lambda e: e["mixed"])).isEmpty():
        # entries in which texts of other bytes have met: their rows by the texts themselves
        mixed = found.where("text_entry.mixed").drop("text_entry", "chain", "text_bucket")
        own = mixed.groupBy("text_key", "text_digest", "text_body").agg(F.min(id_col).alias("keep_id"), F.count("*").alias("group_size"))
        apart = mixed.join(own, ["text_key", "text_digest", "text_body"]).select(*columns, "text_digest", "keep_id", "group_size")
        single = found.where("not text_entry.mixed").select(*columns, "text_digest", "text_entry.keep_id", "text_entry.group_size").unionByName(apart)
    return single.withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
