"""Language-model scoring with a weighted backoff automaton.

The n-gram model is estimated on all training texts and smoothed by giving each
context c an escape weight e(c), the number of distinct words expected among as
many draws as the context was seen (computed from the word counts, summed over
their owners), times ``escape``:

    p(w | c) = (count(c w) + e(c) p(w | shorter c)) / (count(c) + e(c))
    p(w)     = count(w) / (N + V),   p(unknown) = V / (N + V)

over the V known tokens and one unknown one. Seen n-grams become arcs, contexts
become states, and every state has a failure arc to its shorter context whose
weight e(c) / (count(c) + e(c)) is exactly what an unseen word costs, so one
left-to-right pass carries the state and adds up log10 weights.

The model is never in one place. Documents are dealt into blocks; a block sends
each of its distinct n-grams once, with its count in the block's training texts,
to the owner of the n-gram's 64-bit key. The owner adds the counts of all blocks
and answers each block with the totals, in the order asked. A block then holds
the counts of all n-grams that its texts touch, builds that part of the automaton
and traverses its documents. Frequent words cost one key per block.

Cases: null and empty texts are one end token; without training texts N = V = 0,
every token is unknown and the scores are 0 (log10 of 1); repeated rows count
each time they occur; the result has one row per input row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlog.llm.common import (BLOCK_BYTES, U64, as_bytes, count_blocks, hash_words, lower_words, mix, owner_bits,
                                owner_slices, pack_counts, pack_keys, ship_package, text_of, unpack_counts, unpack_keys)

END_KEY, START_KEY = U64(0xA5A5F00D5EED0001), U64(0xA5A5F00D5EED0002)
GRID = 48               # the escape weight is tabulated for N, N/2, N/4, ... draws
ESCAPE = 2.0


class BlockGrams:
    """The n-grams of a block: per order the key of each position and its place among the distinct keys."""

    def __init__(self, texts: list[bytes], order: int):
        places: dict[bytes, int] = {}
        tokens: list[int] = []
        lengths = []
        pads = order - 1
        for t in texts:
            words = lower_words(t)
            tokens += [-1] * pads
            tokens += [places.setdefault(w, len(places)) for w in words]
            tokens.append(-2)
            lengths.append(len(words) + 1)
        at = np.array(tokens, dtype=np.int64)
        names = np.concatenate([hash_words(list(places)), np.array([END_KEY, START_KEY], np.uint64)])   # -2 is the end, -1 the start
        self.lengths = np.array(lengths, dtype=np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.lengths + pads)
        self.real = at != -1
        self.counted = self.real | np.r_[self.real[1:], False]      # of the start marks only the last
        level = names[at]
        self.keys, self.place = [], []
        for m in range(1, order + 1):
            if m > 1:
                level = np.concatenate([level[:1], mix(level[:-1], names[at[1:]])])
                same = np.zeros(len(at), bool)
                same[m - 1:] = self.doc[m - 1:] == self.doc[:len(at) - m + 1]
                level = np.where(same, level, U64(m))       # positions without a whole n-gram share one dead key
            keys, place = np.unique(level, return_inverse=True)
            self.keys.append(keys)
            self.place.append(place)

    def counts(self, m: int, training: np.ndarray) -> np.ndarray:
        return np.bincount(self.place[m - 1], weights=training[self.doc] & self.counted, minlength=len(self.keys[m - 1])).astype(np.int64)


def _ask(table: pa.Table, order: int, bits: int, text_col: str, train_col: str) -> pa.Table:
    block = table.column("block")[0].as_py()
    grams = BlockGrams(as_bytes(table.column(text_col)), order)
    training = np.array(table.column(train_col).to_pylist(), dtype=bool)
    rows = {"owner": [], "block": [], "n": [], "keys": [], "counts": []}
    for m in range(1, order + 1):
        counts = grams.counts(m, training)
        for owner, a, b in owner_slices(grams.keys[m - 1], bits):
            rows["owner"].append(owner)
            rows["block"].append(block)
            rows["n"].append(m)
            rows["keys"].append(pack_keys(grams.keys[m - 1][a:b]))
            rows["counts"].append(pack_counts(counts[a:b]))
    return pa.table({"owner": pa.array(rows["owner"], pa.int32()), "block": pa.array(rows["block"], pa.int32()),
                     "n": pa.array(rows["n"], pa.int32()), "keys": pa.array(rows["keys"], pa.binary()),
                     "counts": pa.array(rows["counts"], pa.binary())})


def _answer(table: pa.Table) -> pa.Table:
    """Totals of an owner's keys, back to each block that asked; block -1 carries the owner's word statistics."""
    owner = table.column("owner")[0].as_py()
    blocks, orders = table.column("block").to_pylist(), table.column("n").to_pylist()
    keys = [unpack_keys(x) for x in table.column("keys").to_pylist()]
    counts = [unpack_counts(x) for x in table.column("counts").to_pylist()]
    out = {"block": [], "n": [], "owner": [], "totals": []}
    stats = [0.0] * (GRID + 2)
    for m in sorted(set(orders)):
        mine = [i for i, n in enumerate(orders) if n == m]
        distinct, place = np.unique(np.concatenate([keys[i] for i in mine]), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, np.concatenate([counts[i] for i in mine]))
        at = 0
        for i in mine:
            out["block"].append(blocks[i])
            out["n"].append(m)
            out["owner"].append(owner)
            out["totals"].append(pack_counts(total[place[at:at + len(keys[i])]]))
            at += len(keys[i])
        if m == 1:
            words = total[(total > 0) & (distinct != START_KEY)]
            out["block"].append(-1)
            out["n"].append(1)
            out["owner"].append(owner)
            out["totals"].append(b"")
            stats = [float(words.sum()), float(len(words)), *[float(-np.expm1(-words * 2.0 ** -j).sum()) for j in range(GRID)]]
    return pa.table({"block": pa.array(out["block"], pa.int32()), "n": pa.array(out["n"], pa.int32()),
                     "owner": pa.array(out["owner"], pa.int32()), "totals": pa.array(out["totals"], pa.binary()),
                     "stats": pa.array([stats if b < 0 else None for b in out["block"]], pa.list_(pa.float64()))})


def escape_weight(context_counts: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """Expected distinct words among as many draws, read between the tabulated N, N/2, N/4, ..."""
    halvings = np.clip(np.log2(max(1, n) / np.maximum(context_counts, 1e-9)), 0, GRID - 1)
    return np.exp(np.interp(halvings, np.arange(GRID), np.log(np.maximum(table, 1e-300))))


class BlockAutomaton:
    """States, arcs and failure arcs of the n-grams that a block touches, by order and distinct n-gram.

    The state of a context fails to the state of the same context without its first word, which ends at
    the same position; the arc of a word from a context's state is the n-gram of both.
    """

    def __init__(self, grams: BlockGrams, totals: list[np.ndarray], n: int, v: int, table: np.ndarray, escape: float):
        self.grams, self.order = grams, len(totals)
        self.unknown = math.log10(v / (n + v)) if v else 0.0
        self.state, self.back, self.arc, self.weight = [], [], [], []
        probability, extra, seen_as = None, None, None
        for m in range(self.order):
            position = np.zeros(len(grams.keys[m]), np.int64)
            position[grams.place[m]] = np.arange(len(grams.doc))
            seen = self._whole(m, position) & (totals[m] > 0)
            arc = seen & grams.real[position]
            if m == 0:
                probability = np.where(arc, totals[0] / max(1.0, float(n + v)), 0.0)
            else:
                at = position[arc]
                context = grams.place[m - 1][at - 1]
                fresh = np.zeros(len(arc))
                fresh[arc] = (totals[m][arc] + extra[context] * probability[grams.place[m - 1][at]]) / (seen_as[context] + extra[context])
                probability = fresh
            weight = np.zeros(len(arc))
            weight[arc] = np.log10(probability[arc])
            self.arc.append(arc)
            self.weight.append(weight)
            if m < self.order - 1:
                state = seen & (grams.keys[m] != END_KEY)
                seen_as = totals[m].astype(float)
                extra, back = np.zeros(len(state)), np.zeros(len(state))
                extra[state] = escape * escape_weight(seen_as[state], n, table)
                back[state] = np.log10(extra[state] / (seen_as[state] + extra[state]))
                self.state.append(state)
                self.back.append(back)

    def _whole(self, m: int, at: np.ndarray) -> np.ndarray:
        """The n-gram ends where its document has as many positions behind it."""
        ok = at >= m
        ok[ok] = self.grams.doc[at[ok]] == self.grams.doc[at[ok] - m]
        return ok

    def _longest(self, marks: list[np.ndarray]) -> np.ndarray:
        """Per position the longest n-gram ending there all of whose ends are marked."""
        out = np.zeros(len(self.grams.doc), np.int64)
        for m, marked in enumerate(marks):
            out[marked[self.grams.place[m]] & (out == m)] = m + 1
        return out

    def score_all(self) -> np.ndarray:
        """The traversals of all documents, each from left to right, at once.

        An n-gram is only seen where its context was, so the state carried behind a position is the longest
        seen context that ends there, and the arc taken at a position is the longest seen n-gram. What lies
        between, from the state carried to the one that has the arc, are the failure arcs that are paid for.
        """
        place = self.grams.place
        carried, taken = self._longest(self.state), self._longest(self.arc)
        total = np.full(len(taken), self.unknown)
        for m in range(self.order):
            here = taken == m + 1
            total[here] = self.weight[m][place[m][here]]
        for m in range(self.order - 1):
            fails = np.flatnonzero((carried[:-1] > m) & (taken[1:] <= m + 1))
            total[fails + 1] += self.back[m][place[m][fails]]
        lengths = self.grams.lengths
        return np.add.reduceat(total[self.grams.real], np.cumsum(lengths) - lengths)


def _score(docs: pa.Table, answers: pa.Table, order: int, escape: float, text_col: str, carry: list[str]) -> pa.Table:
    grams = BlockGrams(as_bytes(docs.column(text_col)), order)
    parts: dict[int, list] = {m: [] for m in range(1, order + 1)}
    for m, owner, blob in zip(answers.column("n").to_pylist(), answers.column("owner").to_pylist(), answers.column("totals").to_pylist()):
        parts[m].append((owner, blob))
    totals = [np.concatenate([unpack_counts(x) for _, x in sorted(parts[m])]) for m in range(1, order + 1)]
    facts = answers.column("facts")[0].as_py()
    n, v, table = facts["train_tokens"], facts["train_words"], np.array(facts["escape_table"])
    automaton = BlockAutomaton(grams, totals, n, v, table, escape)
    counts = totals[0][grams.place[0]][grams.real].astype(np.float64)
    starts = np.cumsum(grams.lengths) - grams.lengths
    base = np.add.reduceat(np.log10((counts + 1) / (n + v + 1)), starts)
    known = np.add.reduceat((counts > 0).astype(np.int64), starts)
    return pa.table({**{c: docs.column(c) for c in carry}, "n_tokens": pa.array(grams.lengths), "n_known": pa.array(known),
                     "train_tokens": pa.array(np.full(len(known), n, np.int64)), "base_score": pa.array(base),
                     "score": pa.array(automaton.score_all())})


def score_texts(docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
                escape: float = ESCAPE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, the boolean ``train_col``, token counts, add-one score and the model's log10 probability.

    ``train_col`` marks the rows the model is estimated on; all rows are scored.
    """
    ship_package(docs.sparkSession)
    blocks, size = count_blocks(docs, text_col, block_bytes)
    bits = owner_bits(size // 8)
    carry = [id_col, train_col]
    dealt = (docs.select(id_col, train_col, text_of(text_col).alias(text_col))
             .withColumn("block", F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int")))
    ask = (dealt.groupBy("block").applyInArrow(lambda t: _ask(t, order, bits, text_col, train_col),
                                               "owner int, block int, n int, keys binary, counts binary"))
    answers = ask.groupBy("owner").applyInArrow(_answer, "block int, n int, owner int, totals binary, stats array<double>")
    def added(i):
        return F.coalesce(F.sum(F.element_at("stats", i + 1)), F.lit(0.0))

    facts = answers.where("block < 0").agg(F.struct(added(0).cast("long").alias("train_tokens"), added(1).cast("long").alias("train_words"),
                                                    F.array(*[added(2 + j) for j in range(GRID)]).alias("escape_table")).alias("facts"))
    asked = answers.where("block >= 0").drop("stats").withColumn("facts", facts.scalar())
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carry) + ", n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (dealt.groupBy("block").cogroup(asked.groupBy("block"))
            .applyInArrow(lambda d, a: _score(d, a, order, escape, text_col, carry), schema))
