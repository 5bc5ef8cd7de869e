"""Removal of repeated byte strings by bucket-pointer refinement of suffix buckets.

Every byte position starts a suffix. A suffix's bucket at depth 1 is its byte; a
bucket at depth 2d is named by the pair of bucket identifiers at depth d of the
position and of the position d later, the identifiers of the round before being
used again in the next, up to the wanted length. Identifiers are 64-bit
fingerprints, so all blocks of documents name equal strings alike and sorting
identifiers brings the members of a bucket together.

Two refinements keep what is sorted across blocks small, and lose nothing:
first a string of ``length`` bytes is put in the bucket of its smallest q-gram
identifier. Equal strings are in equal buckets; a string that holds the first
occurrence of its q-gram in the corpus cannot have occurred before, and a bucket
whose q-gram occurs once is done. Only strings in the other buckets are refined
to the full depth and sorted by it. Documents that repeat an earlier one byte by
byte are found by their whole content and need no refinement.

Blocks are ranges of ids, in order. A block sends each distinct identifier once to
the owner of its range of identifiers; the owner sorts them and answers, in two
bits, whether an earlier block or any other block holds it. Order inside a block
is settled there. A string in every document costs one identifier per block.

Cases: null and empty texts have nothing to remove; a null id comes first; rows of
equal id are ordered by their text; of repeated rows the second is a copy of the
first; a text shorter than ``length`` keeps all bytes; matches never cross
documents; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType

from flowlog.llm.common import (U64, as_bytes, count_blocks, mix, owner_bits, owner_slices, pack_keys, ship_package,
                                text_of, unpack_keys)

LENGTH = 100
GRAM = 32               # depth of the initial buckets
BLOCK_BYTES = 2 << 20
EARLIER, ELSEWHERE = 1, 2


def byte_identifiers() -> np.ndarray:
    """Depth-1 bucket identifiers: fingerprints of the byte values."""
    return mix(np.arange(1, 257, dtype=np.uint64), np.full(256, 0x51ED270B, np.uint64))


def refine(level: np.ndarray, step: int) -> np.ndarray:
    """Identifiers at depth d + step from those at depth d: each paired with the one ``step`` later."""
    return mix(level[:-step], level[step:]) if len(level) > step else level[:0]


def _spread(values: np.ndarray) -> np.ndarray:
    return mix(values, np.full(len(values), 0x2545F491, np.uint64))


def smallest_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each position on, by doubling."""
    low, have = values, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:]) if len(low) > have else low[:0]
        have *= 2
    rest = width - have
    if rest:
        low = np.minimum(low[:-rest], low[rest:]) if len(low) > rest else low[:0]
    return low


class BlockStrings:
    """The strings of ``length`` bytes of a block's documents, in (id, position) order."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, length: int, gram: int):
        texts = as_bytes(table.column(text_col))
        ids = table.column(id_col).to_pylist()
        self.order = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, texts[i]))
        self.texts = [texts[i] for i in self.order]
        self.length, self.gram = length, gram
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        digests = [hashlib.blake2b(t, digest_size=8).digest() for t in self.texts]
        self.whole = np.frombuffer(b"".join(digests), np.uint64) if digests else np.zeros(0, np.uint64)
        first_at: dict[int, int] = {}
        self.copy_here = np.array([first_at.setdefault(int(h), i) != i for i, h in enumerate(self.whole)], dtype=bool)

    def strings(self, copies: np.ndarray) -> None:
        """Number the strings of all documents but the copies, with the bucket (smallest q-gram) of each."""
        self.used = np.flatnonzero(~copies & (self.sizes >= self.length))
        joined = np.frombuffer(b"".join([self.texts[i] for i in self.used]), np.uint8)
        sizes = self.sizes[self.used]
        self.at = np.cumsum(sizes) - sizes                      # where each used document starts in the joined bytes
        level = byte_identifiers()[joined]
        depth = 1
        while depth * 2 <= self.gram:
            level = refine(level, depth)
            depth *= 2
        self.level, self.depth = level, depth
        self.bucket = smallest_ahead(level, self.length - depth + 1)
        ends = np.repeat(self.at + sizes, sizes)[:len(self.bucket)]
        self.inside = np.flatnonzero(np.arange(len(self.bucket)) + self.length <= ends)    # starts of whole strings

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets and the order in which they are asked: minima crowd at small values, so by a
        fingerprint of theirs, which spreads them evenly over the owners."""
        own = np.unique(self._runs()[0])
        return own, np.argsort(_spread(own), kind="stable")

    def _runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Neighbouring strings mostly share their bucket: the bucket of each run of strings, and the run's length."""
        mine = self.bucket[self.inside]
        starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]) if len(mine) else np.zeros(0, np.int64)
        return mine[starts], np.diff(np.r_[starts, len(mine)])

    def open_strings(self, buckets: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """Starts of the strings whose bucket has another member: elsewhere, or later in this block."""
        runs, lengths = self._runs()
        place = np.searchsorted(buckets, runs)
        # places of q-grams that are the smallest of some string: no smaller one in all of the strings that hold them
        of_string = np.zeros(len(self.level), np.uint64)
        of_string[self.inside] = self.bucket[self.inside]
        width = self.length - self.depth + 1
        highest = ~smallest_ahead(np.concatenate([np.full(width - 1, ~U64(0)), ~of_string]), width)
        hit = np.flatnonzero((highest == self.level) & (highest > 0))
        times = np.bincount(np.searchsorted(buckets, self.level[hit]), minlength=len(buckets))
        return self.inside[np.repeat(((flags[place] & ELSEWHERE) > 0) | (times[place] > 1), lengths)]

    def full_depth(self, starts: np.ndarray) -> np.ndarray:
        """Identifiers at the full depth for strings starting at ``starts``."""
        level, depth, chain = self.level, self.depth, None
        while depth * 2 <= self.length:
            level = refine(level, depth)
            depth *= 2
        rest = self.length - depth
        return mix(level[starts], level[starts + rest]) if rest else level[starts]

    def repeated(self, starts: np.ndarray, names: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """Of these strings the starts of those that occurred before, in an earlier block or here; ``flags`` by sorted name."""
        _, first, place = np.unique(names, return_index=True, return_inverse=True)
        return starts[(first[place] != np.arange(len(starts))) | ((flags[place] & EARLIER) > 0)]


def _rows(block: int, kind: int, keys: np.ndarray, bits: int) -> list[tuple]:
    return [(owner, block, kind, pack_keys(keys[a:b])) for owner, a, b in owner_slices(keys, bits)]


def _asked(rows: list[tuple]) -> pa.Table:
    owner, block, kind, keys = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"owner": pa.array(owner, pa.int32()), "block": pa.array(block, pa.int32()),
                     "kind": pa.array(kind, pa.int32()), "keys": pa.array(keys, pa.binary())})


def _owner(table: pa.Table) -> pa.Table:
    """Sort an owner's identifiers over blocks; answer each block's list with two bits an identifier."""
    blocks, kinds = np.array(table.column("block").to_pylist()), np.array(table.column("kind").to_pylist())
    owner = table.column("owner")[0].as_py()
    blobs = table.column("keys").to_pylist()
    out = []
    for kind in np.unique(kinds).tolist():
        mine = sorted(np.flatnonzero(kinds == kind).tolist(), key=lambda i: blocks[i])
        lists = [unpack_keys(blobs[i]) for i in mine]
        merged = np.concatenate(lists)
        order = np.argsort(merged, kind="stable")             # blocks ascend inside equal identifiers
        ranked = merged[order]
        first = np.r_[True, ranked[1:] != ranked[:-1]]
        alone = first & np.r_[first[1:], True]
        flags = np.zeros(len(merged), np.uint8)
        flags[order] = np.where(alone, 0, ELSEWHERE) | np.where(first, 0, EARLIER)
        at = 0
        for i, keys in zip(mine, lists):
            out.append((int(blocks[i]), kind, owner, flags[at:at + len(keys)].tobytes()))
            at += len(keys)
    block, kind, own, answer = zip(*out)
    return pa.table({"block": pa.array(block, pa.int32()), "kind": pa.array(kind, pa.int32()),
                     "owner": pa.array(own, pa.int32()), "answer": pa.array(answer, pa.binary())})


_ASKED = "owner int, block int, kind int, keys binary"
_ANSWERED = "block int, kind int, owner int, answer binary"
COPY, BUCKET, FULL = 0, 1, 2


def _answers(table: pa.Table) -> dict[int, np.ndarray]:
    """Flags by kind, in the order of the sorted identifiers that were asked."""
    parts: dict[int, list] = {COPY: [], BUCKET: [], FULL: []}
    for kind, owner, answer in zip(*[table.column(c).to_pylist() for c in ("kind", "owner", "answer")]):
        parts[kind].append((owner, answer))
    return {k: np.frombuffer(b"".join([a for _, a in sorted(v)]), np.uint8) for k, v in parts.items()}


class _Plan:
    """The three steps over a block; small enough to travel with the tasks."""

    def __init__(self, id_col, text_col, length, gram, bits):
        self.id_col, self.text_col, self.length, self.gram, self.bits = id_col, text_col, length, gram, bits

    def _open(self, table):
        return BlockStrings(table, self.id_col, self.text_col, self.length, self.gram)

    def ask_buckets(self, table: pa.Table) -> pa.Table:
        s = self._open(table)
        block = table.column("block")[0].as_py()
        s.strings(s.copy_here)
        own, order = s.buckets()
        return _asked(_rows(block, COPY, np.unique(s.whole), self.bits) + _rows(block, BUCKET, _spread(own)[order], self.bits))

    def _refined(self, table, flags):
        """Strings still open after the first answers. Documents copied from an earlier block stay in the
        bucket lists (they were asked with them) but are not refined."""
        s = self._open(table)
        whole = np.unique(s.whole)
        copies = s.copy_here | ((flags[COPY][np.searchsorted(whole, s.whole)] & EARLIER) > 0)
        s.strings(s.copy_here)
        buckets, order = s.buckets()
        known = np.zeros(len(buckets), np.uint8)
        known[order] = flags[BUCKET]
        starts = s.open_strings(buckets, known) if len(buckets) else np.zeros(0, np.int64)
        copied = copies[s.used]
        if copied.any() and len(starts):
            doc = np.searchsorted(s.at, starts, side="right") - 1
            starts = starts[~copied[doc]]
        return s, copies, starts, s.full_depth(starts) if len(starts) else np.zeros(0, np.uint64)

    def ask_full(self, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _asked([])
        _, _, _, names = self._refined(docs, _answers(answers))
        return _asked(_rows(docs.column("block")[0].as_py(), FULL, np.unique(names), self.bits))

    def remove(self, docs: pa.Table, answers: pa.Table) -> pa.Table:
        flags = _answers(answers)
        s, copies, starts, names = self._refined(docs, flags)
        gone = s.repeated(starts, names, flags[FULL]) if len(starts) else starts
        cover = np.zeros(int(s.sizes[s.used].sum()) + 1, np.int32)
        cover[gone] += 1                    # starts are distinct
        cover[gone + self.length] -= 1
        covered = np.cumsum(cover[:-1]) > 0
        at = dict(zip(s.used.tolist(), s.at.tolist()))
        removed, kept, spans = [], [], []
        for i, text in enumerate(s.texts):
            if copies[i] and len(text) >= self.length:
                runs, rest = [(0, len(text))], b""
            elif i in at and covered[at[i]:at[i] + len(text)].any():
                own = covered[at[i]:at[i] + len(text)]
                edges = np.flatnonzero(np.diff(np.r_[0, own.astype(np.int8), 0]))
                runs = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
                rest = np.frombuffer(text, np.uint8)[~own].tobytes()
            else:
                runs, rest = [], text
            removed.append(sum(b - a for a, b in runs))
            kept.append(rest)
            spans.append([{"start": a, "end": b} for a, b in runs])
        ids = docs.column(self.id_col).take(pa.array(s.order, pa.int64()))
        return pa.table({self.id_col: ids, "n_bytes": pa.array(s.sizes), "n_removed": pa.array(removed, pa.int64()),
                         "removed_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         "kept_bytes": pa.array(kept, pa.binary())})


def _block_of(docs: DataFrame, id_col: str, blocks: int):
    """Block number by id: ``blocks`` ranges of about equally many rows, equal ids together."""
    if blocks == 1:
        return F.lit(0)
    cuts = docs.select(F.percentile_approx(F.col(id_col), [i / blocks for i in range(1, blocks)], max(10_000, 20 * blocks))).first()[0]
    cuts = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf(IntegerType())
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        return pd.Series(np.where(known, np.searchsorted(cuts, ids.where(known, 0).astype("int64"), side="right") + 1, 0), dtype="int32")

    return place(F.col(id_col))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: ``n_bytes``, ``n_removed``, ``removed_spans`` (start, end) and ``kept_bytes``. Ids are integers."""
    ship_package(docs.sparkSession)
    blocks, size = count_blocks(docs, text_col, block_bytes)
    dealt = (docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias(text_col))
             .withColumn("block", _block_of(docs, id_col, blocks)))
    plan = _Plan(id_col, text_col, length, gram, owner_bits(size // 6))
    first = dealt.groupBy("block").applyInArrow(lambda t: plan.ask_buckets(t), _ASKED).groupBy("owner").applyInArrow(_owner, _ANSWERED)
    second = (dealt.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(lambda d, a: plan.ask_full(d, a), _ASKED)
              .groupBy("owner").applyInArrow(_owner, _ANSWERED))
    answers = first.unionByName(second)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda d, a: plan.remove(d, a), f"`{id_col}` long, n_bytes long, n_removed long, removed_spans array<struct<start: long, end: long>>, kept_bytes binary")
