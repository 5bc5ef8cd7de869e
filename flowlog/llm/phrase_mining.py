"""Collocations from weighted acyclic automata of phrase counts.

A phrase is up to ``max_words`` words in a row inside a piece (text between
sentence marks). Documents are dealt into blocks.

1. Sieve. A block sends each distinct word and pair of words once, as a sorted
   64-bit key with its count, to the key's owner; the owner adds the counts of
   all blocks and answers with one bit, "reaches ``min_count``". A phrase cannot
   reach it unless all its pairs do, so this drops no phrase that counts (keys
   that collide only let more through).
2. Count automata. A block sorts the phrases that passed and builds, phrase after
   phrase, an acyclic automaton: a phrase shares the states of the prefix that it
   has in common with the one before, and states that accept with the same weight
   and lead on alike are one state. Its states' weights are the counts, its labels
   the words themselves. The phrases go by the range of their prefix's key (the
   first three words) to owners, one automaton for each.
3. Union. An owner unites the automata of all blocks state by state: states
   reached by the same words fall together and their weights add up. What stays
   below ``min_count`` is cut off. These are exact counts, by words and not by keys.
4. Composition. The parts into which candidates can be cut are sorted into an
   acyclic automaton per owner and composed with its count automaton; a path that
   both have carries the part's count.
5. Scores in decimals of 38 digits. A candidate inside one that is a word longer and
   as frequent is dropped; more distant ones need no look, since all between are
   as frequent too.

Cases: null and empty texts have no piece; a null language is ``und``; repeated rows
count each time; very long texts are one piece of work of their block; an empty table
gives an empty result; other columns of the table are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowlog.llm.common import (BLOCK_BYTES, U64, as_bytes, count_blocks, hash_words, materialise, mix, owner_bits,
                                owner_slices, pack_keys, ship_package, text_of, unpack_keys)

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
PREFIX = 3                          # words of the prefix whose key names a phrase's owner
MARKS = b".,;:!?\n\x0b\x0c\r"       # what ends a piece
_TO_MARK = bytes.maketrans(MARKS, b"." * len(MARKS))


def piece_words(text: bytes) -> list[bytes]:
    """A-Z lowered words of a text in order, with ``.`` wherever a piece ends."""
    return text.lower().translate(_TO_MARK).replace(b".", b" . ").split()


class BlockPhrases:
    """The words and pairs of one language in a block: ids by position, distinct ones with counts."""

    def __init__(self, texts: list[bytes], lang: str):
        places: dict[bytes, int] = {b".": 0}
        ids: list[int] = []
        for t in texts:
            ids += [places.setdefault(w, len(places)) for w in piece_words(t)]
            ids.append(0)
        self.words = list(places)
        self.at = np.array(ids, dtype=np.int64)
        self.total = int(np.count_nonzero(self.at))
        self.names = mix(hash_words(self.words), hash_words([lang.encode()] * 1, 5).repeat(len(self.words)))
        self.counts = np.bincount(self.at, minlength=len(self.words))
        x, y = self.at[:-1], self.at[1:]
        self.pair_at = np.flatnonzero((x > 0) & (y > 0))
        both = x[self.pair_at] * len(self.words) + y[self.pair_at]
        self.pairs, self.pair_of, self.pair_counts = np.unique(both, return_inverse=True, return_counts=True)

    def asked(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per kind (words, pairs): sorted keys, their counts, and the order that sorted them."""
        n = len(self.words)
        pair_keys = mix(self.names[self.pairs // n], self.names[self.pairs % n]) if len(self.pairs) else np.zeros(0, np.uint64)
        out = []
        for keys, counts in ((self.names[1:], self.counts[1:]), (pair_keys, self.pair_counts)):
            order = np.argsort(keys, kind="stable")
            out.append((keys[order], counts[order], order))
        return out

    def phrases(self, often: list[np.ndarray], max_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases that pass the sieve (rows of word ids, 0 beyond their end) and their counts."""
        good_word = np.zeros(len(self.words), bool)
        good_word[1:] = often[0]
        used = np.flatnonzero(good_word)
        rows, counts = [np.zeros((len(used), max_words), np.int64)], [self.counts[used]]
        rows[0][:, 0] = used
        good = np.zeros(len(self.at), bool)
        good[self.pair_at] = often[1][self.pair_of]
        n = len(self.words)
        level = np.full(len(self.at), -1, np.int64)
        last = None
        for m in range(2, max_words + 1):
            # positions where m words in a row have only frequent pairs
            at = np.flatnonzero(good[:len(good) - m + 2]) if m == 2 else last[good[np.minimum(last + m - 2, len(good) - 1)] & (last + m - 2 < len(good))]
            if not len(at):
                break
            key = (self.at[at] if m == 2 else level[at]) * n + self.at[at + m - 1]
            _, first, inverse, c = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            level = np.full(len(self.at), -1, np.int64)
            level[at] = inverse
            last = at
            table = np.zeros((len(first), max_words), np.int64)
            for j in range(m):
                table[:, j] = self.at[at[first] + j]
            rows.append(table)
            counts.append(c)
        return np.concatenate(rows), np.concatenate(counts)


def prefix_keys(rows: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Keys of the first words (at most PREFIX) of phrases given by word ids."""
    key = names[rows[:, 0]]
    for j in range(1, min(PREFIX, rows.shape[1])):
        key = np.where(rows[:, j] > 0, mix(key, names[rows[:, j]]), key)
    return key


class CountAutomaton:
    """A weighted acyclic automaton: per depth the first arc of each state and its weight; arcs by label.

    State 0 of depth 0 is the start. Weight 0 is a state that does not accept. Arcs of a state are
    sorted by label; labels are places in the sorted list ``words``.
    """

    def __init__(self, words: list[bytes], weights: list[np.ndarray], degree: list[np.ndarray], label: list[np.ndarray], target: list[np.ndarray]):
        self.words, self.weights, self.degree, self.label, self.target = words, weights, degree, label, target

    @staticmethod
    def build(words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> "CountAutomaton":
        """From sorted distinct phrases (1-based labels, 0 beyond the end): each shares the states of the
        prefix that it has in common with the one before; equal ends are merged, deepest first."""
        depth = rows.shape[1]
        fresh = np.zeros(rows.shape, bool)
        changed = np.zeros(len(rows), bool)
        changed[:1] = True
        label, parent, weight = [], [], []
        above = np.zeros(len(rows), np.int64)
        for j in range(depth):
            changed[1:] |= rows[1:, j] != rows[:-1, j]
            fresh[:, j] = changed & (rows[:, j] > 0)
            state = np.cumsum(fresh[:, j]) - 1
            ends = (rows[:, j + 1] == 0) if j + 1 < depth else np.ones(len(rows), bool)
            here = fresh[:, j]
            label.append(rows[here, j] - 1)
            parent.append(above[here])
            weight.append(np.where(ends[here], counts[here], 0))
            above = state
        # merge from the deepest states on: a state is told by its weight and, with one arc, by that arc
        merged_weight, degree, arcs, targets = [], [], [], []
        klass = np.zeros(0, np.int64)
        for j in range(depth - 1, -1, -1):
            n = len(label[j])
            children = np.bincount(parent[j + 1], minlength=n) if j + 1 < depth else np.zeros(n, np.int64)
            first = np.cumsum(children) - children
            one = children == 1
            arc = np.zeros(n, np.int64)
            if one.any():
                arc[one] = label[j + 1][first[one]] * (int(klass.max()) + 1) + klass[first[one]] + 1
            arc[children > 1] = -1 - np.flatnonzero(children > 1)
            _, arc = np.unique(arc, return_inverse=True)
            _, at, own = np.unique(weight[j] * (int(arc.max()) + 1 if n else 1) + arc, return_index=True, return_inverse=True)
            merged_weight.append(weight[j][at])
            degree.append(children[at])
            if j + 1 < depth:
                take = _ranges(first[at], children[at])
                arcs.append(label[j + 1][take])
                targets.append(klass[take])
            klass = own
        start = np.array([len(label[0]) if depth else 0])
        return CountAutomaton(words, [np.zeros(1, np.int64), *merged_weight[::-1]], [start, *degree[::-1]],
                              [label[0], *arcs[::-1]], [klass, *targets[::-1]])

    def pack(self) -> bytes:
        """The words and, byte plane by byte plane, the states and arcs."""
        most = max([int(np.max(x, initial=0)) for part in (self.weights, self.degree, self.label, self.target) for x in part], default=0)
        kind = np.uint32 if most < 1 << 32 else np.uint64
        head = pa.array([len(self.words), kind().itemsize, *[len(w) for w in self.weights], *[len(x) for x in self.label]], pa.int64())
        body = b"".join(np.ascontiguousarray(np.asarray(x, kind).view(np.uint8).reshape(-1, kind().itemsize).T).tobytes()
                        for part in (self.weights, self.degree, self.label, self.target) for x in part)
        text = b"\n".join(self.words)
        sizes = np.array([len(head), len(text)], np.int64).tobytes()
        return sizes + np.array(head, np.int64).tobytes() + text + body

    @staticmethod
    def unpack(blob: bytes) -> "CountAutomaton":
        n_head, n_text = np.frombuffer(blob, np.int64, 2).tolist()
        head = np.frombuffer(blob, np.int64, n_head, 16).tolist()
        at = 16 + 8 * n_head
        words = blob[at:at + n_text].split(b"\n") if head[0] else []
        at += n_text
        size = head[1]
        levels = (n_head - 2 + 1) // 2
        states, arcs = head[2:2 + levels], head[2 + levels:]

        def take(lengths):
            nonlocal at
            out = []
            for n in lengths:
                planes = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, -1)
                out.append(np.ascontiguousarray(planes.T).view(np.uint32 if size == 4 else np.uint64).ravel().astype(np.int64))
                at += n * size
            return out

        # the deepest states have no arcs, so there is one list of arcs less than of states
        return CountAutomaton(words, take(states), take(states), take(arcs), take(arcs))


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each range, one range after another."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)


def unite(automata: list[CountAutomaton], min_count: int) -> tuple[list[list[bytes]], np.ndarray]:
    """Phrases of the union whose weights add up to ``min_count`` or more, with these sums: the automata are
    walked together, and the states that the same words reach are one state of the union."""
    words = sorted(set().union(*[a.words for a in automata]))
    place = {w: i for i, w in enumerate(words)}
    renamed = [np.array([place[w] for w in a.words], np.int64) for a in automata]
    front = [(np.zeros(1, np.int64), np.zeros(1, np.int64)) for _ in automata]      # each one's states and their union states
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for j in range(max(len(a.label) for a in automata)):
        keys, weights, reached = [], [], []
        for a, names, (state, union) in zip(automata, renamed, front):
            if j >= len(a.label):
                reached.append(np.zeros(0, np.int64))
                continue
            degree = a.degree[j][state]
            arc = _ranges((np.cumsum(a.degree[j]) - a.degree[j])[state], degree)
            to = a.target[j][arc]
            keys.append(np.repeat(union, degree) * len(words) + names[a.label[j][arc]])
            weights.append(a.weights[j + 1][to])
            reached.append(to)
        both, union = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(union, weights=np.concatenate(weights), minlength=len(both)).astype(np.int64)
        levels.append((both // len(words), both % len(words), total))
        # beyond a state that accepts too rarely nothing is frequent; weight 0 is a prefix counted by another owner
        going = (total == 0) | (total >= min_count)
        at, front = 0, []
        for to in reached:
            mine = union[at:at + len(to)]
            front.append((to[going[mine]], mine[going[mine]]))
            at += len(to)
    phrases, counts = [], []
    for j, (_, _, total) in enumerate(levels):
        state = np.flatnonzero(total >= min_count)
        counts.append(total[state])
        columns = []
        for parent, label, _ in levels[j::-1]:
            columns.append(label[state])
            state = parent[state]
        phrases += [[words[i] for i in row] for row in np.stack(columns[::-1], axis=1).tolist()]
    return phrases, np.concatenate(counts) if counts else np.zeros(0, np.int64)


def sorted_automaton(phrases: list[tuple[bytes, ...]], counts: list[int]) -> CountAutomaton:
    """The automaton of distinct phrases given as words."""
    words = sorted({w for p in phrases for w in p})
    place = {w: i + 1 for i, w in enumerate(words)}
    depth = max((len(p) for p in phrases), default=1)
    rows = np.zeros((len(phrases), depth), np.int64)
    for i, p in enumerate(phrases):
        rows[i, :len(p)] = [place[w] for w in p]
    order = np.lexsort(rows.T[::-1])
    return CountAutomaton.build(words, rows[order], np.array(counts, np.int64)[order])


def compose(asked: CountAutomaton, counted: CountAutomaton) -> list[tuple[tuple[bytes, ...], int]]:
    """Paths that both automata accept, with the weight of ``counted``: pairs of states are walked by equal labels."""
    place = {w: i for i, w in enumerate(counted.words)}
    renamed = [place.get(w, -1) for w in asked.words]
    arcs = {}
    for j, (degree, label, target) in enumerate(zip(counted.degree, counted.label, counted.target)):
        ends = np.cumsum(degree).tolist()
        arcs[j] = (ends, degree.tolist(), label.tolist(), target.tolist())
    out, front = [], [((), 0, 0)]
    for j in range(min(len(asked.label), len(counted.label))):
        ends = np.cumsum(asked.degree[j]).tolist()
        degree, label, target = asked.degree[j].tolist(), asked.label[j].tolist(), asked.target[j].tolist()
        c_ends, c_degree, c_label, c_target = arcs[j]
        weights, wanted = counted.weights[j + 1].tolist(), asked.weights[j + 1].tolist()
        known: dict[int, dict[int, int]] = {}
        after = []
        for path, s, c in front:
            table = known.get(c)
            if table is None:
                table = known[c] = {c_label[k]: c_target[k] for k in range(c_ends[c] - c_degree[c], c_ends[c])}
            for k in range(ends[s] - degree[s], ends[s]):
                to = table.get(renamed[label[k]])
                if to is not None:
                    step = path + (asked.words[label[k]],)
                    if wanted[target[k]]:
                        out.append((step, weights[to]))
                    after.append((step, target[k], to))
        front = after
    return out


def _owner_of(phrases: list[tuple[bytes, ...]], lang: str, bits: int) -> np.ndarray:
    if not phrases:
        return np.zeros(0, np.int64)
    own = sorted({w for p in phrases for w in p[:PREFIX]})
    place = {w: i + 1 for i, w in enumerate(own)}
    names = np.concatenate([np.zeros(1, np.uint64), mix(hash_words(own), hash_words([lang.encode()], 5).repeat(len(own)))])
    rows = np.zeros((len(phrases), PREFIX), np.int64)
    for i, p in enumerate(phrases):
        rows[i, :len(p[:PREFIX])] = [place[w] for w in p[:PREFIX]]
    return (prefix_keys(rows, names) >> U64(64 - bits)).astype(np.int64)


def _blocks_langs(table: pa.Table):
    langs = table.column("lang").to_pylist()
    texts = as_bytes(table.column("text"))
    groups: dict[str, list[bytes]] = {}
    for lang, t in zip(langs, texts):
        groups.setdefault(lang, []).append(t)
    for lang in sorted(groups):
        yield lang, BlockPhrases(groups[lang], lang)


def _ask(table: pa.Table, bits: int) -> pa.Table:
    """Each distinct word and pair of the block once, to the owner of its key."""
    block = table.column("block")[0].as_py()
    rows = []
    for lang, phrases in _blocks_langs(table):
        for kind, (keys, counts, _) in enumerate(phrases.asked()):
            for owner, a, b in owner_slices(keys, bits):
                rows.append((owner, block, lang, kind, pack_keys(keys[a:b]), counts[a:b].astype(np.uint32).tobytes()))
    owner, blocks, lang, kind, keys, counts = zip(*rows) if rows else ([],) * 6
    return pa.table({"owner": pa.array(owner, pa.int32()), "block": pa.array(blocks, pa.int32()), "lang": pa.array(lang, pa.string()),
                     "kind": pa.array(kind, pa.int32()), "keys": pa.array(keys, pa.binary()), "counts": pa.array(counts, pa.binary())})


def _answer(table: pa.Table, min_count: int) -> pa.Table:
    """One bit for each key asked: its counts of all blocks reach ``min_count``."""
    owner = table.column("owner")[0].as_py()
    kinds = table.column("kind").to_pylist()
    blocks, langs = table.column("block").to_pylist(), table.column("lang").to_pylist()
    keys = [unpack_keys(x) for x in table.column("keys").to_pylist()]
    counts = [np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]
    out = []
    for kind in sorted(set(kinds)):
        mine = [i for i, k in enumerate(kinds) if k == kind]
        distinct, place = np.unique(np.concatenate([keys[i] for i in mine]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([counts[i] for i in mine]), minlength=len(distinct))
        bits = (total >= min_count)[place]
        at = 0
        for i in mine:
            out.append((blocks[i], langs[i], kind, owner, len(keys[i]), np.packbits(bits[at:at + len(keys[i])]).tobytes()))
            at += len(keys[i])
    block, lang, kind, own, n, often = zip(*out)
    return pa.table({"block": pa.array(block, pa.int32()), "lang": pa.array(lang, pa.string()), "kind": pa.array(kind, pa.int32()),
                     "owner": pa.array(own, pa.int32()), "n": pa.array(n, pa.int32()), "often": pa.array(often, pa.binary())})


_COUNTED = pa.schema([("lang", pa.string()), ("owner", pa.int32()), ("words", pa.int64()), ("automaton", pa.binary())])


def _count(docs: pa.Table, answers: pa.Table, bits: int, max_words: int) -> pa.Table:
    """The block's count automata, one per language and owner; a row without owner holds the language's words."""
    if not docs.num_rows:
        return pa.Table.from_pylist([], _COUNTED)
    told: dict[tuple[str, int], list] = {}
    for lang, kind, owner, n, often in zip(*[answers.column(c).to_pylist() for c in ("lang", "kind", "owner", "n", "often")]):
        told.setdefault((lang, kind), []).append((owner, np.unpackbits(np.frombuffer(often, np.uint8), count=n)))
    rows = []
    for lang, block in _blocks_langs(docs):
        often = []
        for kind, (keys, _, order) in enumerate(block.asked()):
            flags = np.zeros(len(keys), bool)
            parts = [x for _, x in sorted(told.get((lang, kind), []), key=lambda p: p[0])]
            if parts:
                flags[order] = np.concatenate(parts) > 0
            often.append(flags)
        rows.append({"lang": lang, "owner": None, "words": block.total, "automaton": None})
        table, counts = block.phrases(often, max_words)
        if not len(table):
            continue
        # labels in the order of the words' bytes
        used = np.unique(table[table > 0])
        by_bytes = sorted(used.tolist(), key=block.words.__getitem__)
        rank = np.zeros(len(block.words), np.int64)
        rank[by_bytes] = np.arange(1, len(by_bytes) + 1)
        owner = (prefix_keys(table, block.names) >> U64(64 - bits)).astype(np.int64)
        ranked = rank[table]
        order = np.lexsort((*ranked.T[::-1], owner))
        ranked, counts, owner = ranked[order], counts[order], owner[order]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(owner)]):
            mine = np.unique(ranked[a:b][ranked[a:b] > 0])
            local = np.zeros(len(by_bytes) + 1, np.int64)
            local[mine] = np.arange(1, len(mine) + 1)
            automaton = CountAutomaton.build([block.words[by_bytes[i - 1]] for i in mine.tolist()], local[ranked[a:b]], counts[a:b])
            rows.append({"lang": lang, "owner": int(owner[a]), "words": 0, "automaton": automaton.pack()})
    return pa.Table.from_pylist(rows, _COUNTED)


def _union(table: pa.Table, min_count: int) -> pa.Table:
    phrases, counts = unite([CountAutomaton.unpack(x) for x in table.column("automaton").to_pylist()], min_count)
    n = len(phrases)
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()),
                     "owner": pa.array([table.column("owner")[0].as_py()] * n, pa.int32()),
                     "words": pa.array([[w.decode() for w in p] for p in phrases], pa.list_(pa.string())), "a": pa.array(counts, pa.int64())})


def _compose(asked: pa.Table, counted: pa.Table) -> pa.Table:
    """Counts of the parts that this owner's phrases hold."""
    out = []
    if asked.num_rows and counted.num_rows:
        want = [tuple(w.encode() for w in p) for p in asked.column("part").to_pylist()]
        have = [tuple(w.encode() for w in p) for p in counted.column("words").to_pylist()]
        out = compose(sorted_automaton(want, [1] * len(want)), sorted_automaton(have, counted.column("a").to_pylist()))
    lang = (asked if asked.num_rows else counted).column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "part": pa.array([[w.decode() for w in p] for p, _ in out], pa.list_(pa.string())),
                     "f": pa.array([n for _, n in out], pa.int64())})


def phrase_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                  max_words: int = MAX_WORDS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """Phrases of at least ``min_count`` occurrences (lang, owner, words, a), words per language (lang, n), owner bits."""
    ship_package(docs.sparkSession)
    blocks, size = count_blocks(docs, text_col, block_bytes)
    bits = owner_bits(size // 8)
    dealt = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_of(text_col).alias("text"),
                        F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int").alias("block"))
    answers = (dealt.groupBy("block").applyInArrow(lambda t: _ask(t, bits), "owner int, block int, lang string, kind int, keys binary, counts binary")
               .groupBy("owner").applyInArrow(lambda t: _answer(t, min_count), "block int, lang string, kind int, owner int, n int, often binary"))
    automata = materialise(dealt.groupBy("block").cogroup(answers.groupBy("block"))
                           .applyInArrow(lambda d, a: _count(d, a, bits, max_words), "lang string, owner int, words long, automaton binary"), "phrase-automata")
    totals = automata.where("owner is null").groupBy("lang").agg(F.sum("words").alias("n"))
    phrases = materialise(automata.where("owner is not null").groupBy("lang", "owner")
                          .applyInArrow(lambda t: _union(t, min_count), "lang string, owner int, words array<string>, a long"), "phrases")
    return phrases, totals, bits


def _owners(parts: DataFrame, bits: int) -> DataFrame:
    """``parts`` (lang, part) with the owner of each."""
    def run(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            parts = [tuple(w.encode() for w in p) for p in batch.column("part").to_pylist()]
            owner = np.zeros(len(parts), np.int64)
            for lang in set(langs):
                mine = [i for i, x in enumerate(langs) if x == lang]
                owner[mine] = _owner_of([parts[i] for i in mine], lang, bits)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("part"), pa.array(owner.astype(np.int32))], names=["lang", "part", "owner"])

    return parts.mapInArrow(run, "lang string, part array<string>, owner int")


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    phrases, totals, bits = phrase_counts(docs, id_col, text_col, lang_col, min_count, max_words, block_bytes)
    cuts = (phrases.where(F.size("words") > 1)
            .select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
            .withColumn("first", F.slice("words", F.lit(1), F.col("k")))
            .withColumn("rest", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))))
    asked = _owners(cuts.select("lang", F.explode(F.array("first", "rest")).alias("part")).distinct(), bits)
    found = materialise(asked.groupBy("lang", "owner").cogroup(phrases.groupBy("lang", "owner"))
                        .applyInArrow(_compose, "lang string, part array<string>, f long"), "phrase-parts")
    both = materialise(cuts.join(found.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
                       .join(found.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]), "phrase-cuts")
    # inside a phrase a word longer and as frequent: its first words (last cut) or its last words (first cut)
    inside = (both.where((F.col("k") == F.size("words") - 1) & (F.col("l") <= F.col("a"))).select("lang", F.col("first").alias("words"))
              .unionByName(both.where((F.col("k") == 1) & (F.col("r") <= F.col("a"))).select("lang", F.col("rest").alias("words"))).distinct())
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = (both.join(inside, ["lang", "words"], "left_anti").join(totals, "lang")
            .withColumn("score", score)
            .groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
