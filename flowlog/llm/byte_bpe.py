"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (base64 token, rank) becomes a BPE model: bytes are mapped to
printable characters, and every way to cut a token into two known tokens is a
merge, in rank order, which makes the library merge the pair of lowest rank
first. Texts are cut before single spaces between other characters; such a place
is always a boundary of the split pattern, so the stretches can be encoded apart,
and one seen before in the worker is taken from a bounded memo. New ones are
encoded many in a text, and the tokens' byte offsets say where each ends. Decoding maps ids back to bytes by the reversed byte
table; the bytes of a character that is split over tokens meet again when the
tokens' bytes are joined, so only the joined bytes are decoded as UTF-8.

Cases: null counts as empty; empty texts have no ids; unknown ids in decoding
raise an error; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from flowlog.llm.common import release_memory, ship_package, text_runs

MEMO = 1 << 15          # stretches in one of the two generations that a worker remembers
TOGETHER = 128          # new stretches encoded in one call

# one space between two characters that are not white space: always a boundary of the split pattern
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class ByteBpe:
    """Encoder and decoder of one vocabulary; one per worker process."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        table = byte_characters()

        def as_characters(token: bytes) -> str:
            return "".join([table[b] for b in token])

        merges = []
        for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
            for cut in range(1, len(token)):
                if token[:cut] in ranks and token[cut:] in ranks:
                    merges.append((as_characters(token[:cut]), as_characters(token[cut:])))
        self.model = Tokenizer(models.BPE(vocab={as_characters(t): r for t, r in ranks.items()}, merges=merges))
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # decoding goes the other way: the model's own characters back to bytes
        back = {c: b for b, c in enumerate(table)}
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for piece, i in self.model.get_vocab().items():
            self.bytes_of[i] = bytes([back[c] for c in piece])
        self.sizes = np.array([len(x or b"") for x in self.bytes_of], dtype=np.int64)
        self.memo: dict[str, bytes] = {}        # ids of " " + stretch
        self.older: dict[str, bytes] = {}       # the generation before

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, stretches: list[str]) -> None:
        """Encode new stretches, many in one text, and cut the ids where the stretches' bytes end."""
        groups = [stretches[i:i + TOGETHER] for i in range(0, len(stretches), TOGETHER)]
        for group, ids in zip(groups, self._ids([" " + " ".join(g) for g in groups])):
            flat = np.frombuffer(ids, "<u4")
            ends = np.cumsum(self.sizes[flat])
            last = np.cumsum([1 + len(x.encode("utf-8", "surrogatepass")) for x in group])
            cuts = np.searchsorted(ends, last) + 1
            at = 0
            for x, cut in zip(group, cuts.tolist()):
                self.memo[x] = flat[at:cut].tobytes()
                at = cut

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        memo = self.memo
        cut = [_CUT.split(t) for t in texts]
        new = []
        for x in {x for parts in cut for x in parts[1:]}:
            if x not in memo:
                ids = self.older.get(x)
                if ids is None:
                    new.append(x)
                else:
                    memo[x] = ids
        self._learn(new)
        firsts = self._ids([parts[0] for parts in cut])
        return [first + b"".join([memo[x] for x in parts[1:]]) for first, parts in zip(firsts, cut)]

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def offsets(self, text: str, ids: bytes) -> list[tuple[int, int]]:
        """Character span of each token; a token that holds part of a character spans that character."""
        char_of = []
        for n, c in enumerate(text):
            char_of += [n] * len(c.encode("utf-8", "surrogatepass"))
        spans, at = [], 0
        for i in np.frombuffer(ids, "<u4").tolist():
            end = at + len(self.bytes_of[i])
            spans.append((char_of[at], char_of[end - 1] + 1))
            at = end
        return spans


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> ByteBpe:
    made = ByteBpe(path, pattern)
    release_memory()        # building takes twice what the model keeps
    return made


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           count_col: str = "n_tokens", decoded_col: str | None = None) -> DataFrame:
    """``docs`` without its text, with ids (packed unsigned 32-bit), their number and, if named, the bytes decoded from them."""
    ship_package(docs.sparkSession)
    names = {ids_col, count_col, decoded_col}
    rest = [f for f in docs.schema.fields if f.name != text_col and f.name not in names]
    added = [StructField(ids_col, BinaryType()), StructField(count_col, LongType())]
    added += [StructField(decoded_col, BinaryType())] if decoded_col else []
    schema = StructType(rest + added)
    keep = [f.name for f in rest]

    def run(batches):
        bpe = codec(path, pattern)
        for part, values in text_runs(batches, text_col):
            ids = bpe.encode_batch([v.decode("utf-8", "replace") for v in values])
            columns = [part.column(n) for n in keep]
            columns += [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if decoded_col:
                columns.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Ids back to text: bytes first, then UTF-8 over the joined bytes."""
    ship_package(encoded.sparkSession)
    rest = [f for f in encoded.schema.fields if f.name != text_col]
    schema = StructType(rest + [StructField(text_col, BinaryType())])

    def run(batches):
        bpe = codec(path, pattern)
        for batch in batches:
            raw = [bpe.decode(x or b"") for x in batch.column(ids_col).to_pylist()]
            columns = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(raw, pa.binary())], names=[f.name for f in schema.fields])

    return encoded.select(*[f.name for f in rest]).mapInArrow(run, schema).withColumn(text_col, F.decode(text_col, "UTF-8"))
