"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words (A-Z lowered, outer punctuation cut) and their
prefixes of 4 to 7 bytes, each present or absent, hashed to 2^18 places.
The machine's score is w0 + sum w_i + sum over pairs <v_i, v_j>: the factors let
two terms together (an insult and whom it is aimed at) weigh more than either.
It is fitted on at most ``max_rows`` labelled rows, those of smallest hash of
the id, with AdaGrad on logistic loss; all terms in ``MIN_ROWS`` of these rows or
more take part, whatever their own share of positives, as two neutral terms may be
toxic together. Noise is held down by decay, and a row's
terms that are neutral by themselves share one step. The model has a fixed size (2^18 rows
of 1 + factors floats), so it goes to the tasks as a broadcast.

Cases: null and empty texts have no term and score sigmoid(w0); without labelled
rows of both kinds the score is the share of positives, 0 without labels; repeated words
count once; extra columns are kept.
"""

from __future__ import annotations

import zlib
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flowlog.llm.common import lower_words, materialise, ship_package, spark_of, text_runs

PLACES = 1 << 18
FACTORS = 4
MAX_ROWS = 12_000       # labelled rows that the fit sees at most
MIN_ROWS = 5
MIN_Z = 3.5             # a term nearer to the share of positives, in standard deviations, is neutral by itself
MEMO = 1 << 16          # words that a worker remembers (some 30 MB)
PREFIXES = (4, 5, 6, 7)   # bytes
CUT = b".,;:!?\"'()[]{}<>|*#%&$-_/\\"


def term_places(text: bytes) -> np.ndarray:
    """Sorted distinct places of a text's terms."""
    words = {w.strip(CUT) for w in set(lower_words(text))}
    words.discard(b"")
    found = {crc32(w, 1) for w in words}
    for n in PREFIXES:
        found |= {crc32(p, n) for p in {w[:n] for w in words if len(w) >= n}}
    return np.unique(np.fromiter(found, dtype=np.int64, count=len(found)) % PLACES).astype(np.int32)


def word_places(word: bytes) -> list[int]:
    """Places of one word's terms, as in :func:`term_places`."""
    word = word.strip(CUT)
    if not word:
        return []
    return [crc32(word, 1) % PLACES, *[crc32(word[:n], n) % PLACES for n in PREFIXES if len(word) >= n]]


def pack_places(places: np.ndarray) -> bytes:
    """Sorted places as steps from one to the next, compressed byte plane by byte plane."""
    steps = np.diff(places, prepend=0).astype(np.uint32)
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T[:3].tobytes(), 1)


def unpack_places(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(3, -1)
    steps = np.zeros((planes.shape[1], 4), np.uint8)
    steps[:, :3] = planes.T
    return np.cumsum(steps.view(np.uint32).ravel(), dtype=np.int32)


class FactorizationMachine:
    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def logit(self, places: np.ndarray) -> float:
        v = self.factors[places]
        return self.bias + float(self.linear[places].sum()) + 0.5 * float((v.sum(0) ** 2 - (v * v).sum(0)).sum())

    def score(self, places: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(places), -40, 40))))


def fit(rows: list[np.ndarray], labels: np.ndarray, passes: int = 12, rate: float = 0.08, decay: float = 2e-3,
        min_rows: int = MIN_ROWS, seed: int = 7) -> FactorizationMachine:
    """AdaGrad over single rows; positives and negatives weigh the same in all."""
    linear = np.zeros(PLACES, np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return FactorizationMachine(40.0 if share else -40.0, linear, np.zeros((PLACES, FACTORS), np.float32))
    seen, positive = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64)
    for r, y in zip(rows, labels):          # places are distinct within a row
        seen[r] += 1
        if y == 1:
            positive[r] += 1
    z = (positive - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    neutral = np.abs(z) < MIN_Z
    usable = seen >= min_rows
    if not usable[seen > 0].all():
        rows = [r[usable[r]] for r in rows]
    rng = np.random.default_rng(seed)
    factors = np.where(usable[:, None], rng.normal(0, 0.01, (PLACES, FACTORS)), 0).astype(np.float32)
    gl, gf, gb = np.full(PLACES, 1e-2, np.float32), np.full((PLACES, FACTORS), 1e-2, np.float32), 1e-2
    bias = float(np.log(share / (1 - share)))
    weight = np.where(labels == 1, (1 - share) / share, 1.0) * min(1.0, 2 * share)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            x = rows[i]
            v = factors[x]
            total = v.sum(0)
            z = bias + linear[x].sum() + 0.5 * (total ** 2 - (v * v).sum(0)).sum()
            g = float(weight[i]) * (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - labels[i])
            if abs(g) < 1e-3:
                continue
            dull = neutral[x]
            pace = np.where(dull, 1 / max(1, dull.sum()), 1).astype(np.float32)        # a row's neutral terms share one step
            gb += g * g
            bias -= rate * g / np.sqrt(gb)
            step = g + decay * linear[x]
            gl[x] += step * step
            linear[x] -= rate * pace * step / np.sqrt(gl[x])
            fstep = g * (total - v) + decay * v
            gf[x] += fstep * fstep
            factors[x] -= 0.25 * rate * pace[:, None] * fstep / np.sqrt(gf[x])
    return FactorizationMachine(bias, linear, factors)


class TermFinder:
    """The places that a model uses in a text; words without any are remembered (boundedly) and skipped."""

    def __init__(self, used: np.ndarray):
        self.used = bytearray(PLACES)
        np.frombuffer(self.used, np.uint8)[used] = 1
        self.dull: set[bytes] = set()
        self.known: dict[bytes, tuple[int, ...]] = {}

    def places(self, text: bytes) -> np.ndarray:
        found: set[int] = set()
        for word in set(lower_words(text)) - self.dull:
            places = self.known.get(word)
            if places is None:
                places = tuple(p for p in word_places(word) if self.used[p])
                if places:
                    self.known[word] = places
                else:
                    self.dull.add(word)
            found.update(places)
        if len(self.dull) + len(self.known) > MEMO:
            self.dull.clear()
            self.known.clear()
        return np.array(sorted(found), dtype=np.int32)


def pick_labels(labels: DataFrame, label_col: str, id_col: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids (column ``lid``, ``y``), those of smallest hash; the larger of contradicting labels."""
    per_id = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("lid")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
              .withColumn("h", F.xxhash64("lid")))
    return per_id.orderBy("h", "lid").limit(max_rows)


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id",
          max_rows: int = MAX_ROWS) -> FactorizationMachine:
    """Fit on the texts of at most ``max_rows`` labelled ids."""
    ship_package(docs.sparkSession)
    picked = pick_labels(labels, label_col, id_col, max_rows)      # bounded by max_rows, hence the broadcast
    rows = (docs.select(F.col(id_col).alias("lid"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(F.broadcast(picked), "lid")
            .groupBy("h").agg(F.max("y").alias("y"), F.max("t").alias("t")))      # one row an id

    def run(batches):
        for part, found in text_runs(batches, "t"):
            places = [term_places(t) for t in found]
            yield pa.RecordBatch.from_arrays([part.column("h"), part.column("y"), pa.array(places, pa.list_(pa.int32()))], names=["h", "y", "p"])

    placed = materialise(rows.mapInArrow(run, "h long, y int, p array<int>"), "toxicity-terms")
    total, positive = placed.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < positive < total:
        return fit([], np.full(total, float(positive > 0)))
    # only terms that can take part travel to the driver: 2^18 rows at most, and these terms of max_rows rows
    terms = placed.select(F.explode("p").alias("place")).groupBy("place").agg(F.count("*").alias("seen")).where(F.col("seen") >= MIN_ROWS)
    used = np.zeros(PLACES, bool)
    used[[r["place"] for r in terms.select("place").collect()]] = True

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("p")
            flat, ends = rows.flatten().to_numpy(zero_copy_only=False), np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))
            kept = [pack_places(p[used[p]]) for p in np.split(flat, ends[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("y"), pa.array(kept, pa.binary())], names=["h", "y", "p"])

    # partition by partition, so that the driver never holds rows twice
    found = [(r["h"], r["y"], unpack_places(r["p"])) for r in placed.mapInArrow(keep, "h long, y int, p binary").toLocalIterator()]
    found.sort(key=lambda r: r[0])
    return fit([p for _, _, p in found], np.array([y for _, y, _ in found], dtype=np.float64))


def score_texts(docs: DataFrame, model: FactorizationMachine, text_col: str = "text", score_col: str = "toxicity",
                keep_text: bool = True) -> DataFrame:
    """``docs`` with the score in [0, 1] of every whole text."""
    ship_package(docs.sparkSession)
    used = np.flatnonzero((model.linear != 0) | model.factors.any(axis=1)).astype(np.int32)
    shared = spark_of(docs).sparkContext.broadcast((model.bias, used, model.linear[used], model.factors[used]))
    rest = [f for f in docs.schema.fields if f.name != score_col and (keep_text or f.name != text_col)]
    schema = StructType([*rest, StructField(score_col, DoubleType())])

    def run(batches):
        bias, at, w, v = shared.value
        linear, factors = np.zeros(PLACES, np.float32), np.zeros((PLACES, v.shape[1]), np.float32)
        linear[at], factors[at] = w, v
        machine, finder = FactorizationMachine(bias, linear, factors), TermFinder(at)
        for part, found in text_runs(batches, text_col):
            scores = [machine.score(finder.places(t)) for t in found]
            yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in rest], pa.array(scores, pa.float64())],
                                             names=[f.name for f in schema.fields])

    return docs.select(*dict.fromkeys([*[f.name for f in rest], text_col])).mapInArrow(run, schema)


def predicted(score: Column) -> Column:
    return F.when(score >= 0.5, 1).otherwise(0)
