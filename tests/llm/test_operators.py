"""Each operator against a brute-force version, and on awkward rows."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from flowlog.llm import (ann_forest, byte_bpe, common, exact_dedup, html_extract, lm_scoring, mixing, near_dedup, queries,
                         suffix_dedup, toxicity, url_filter)

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, block string, size long"
LONG = "alpha beta gamma delta " * 30_000
AWKWARD = [(1, None, None, None, None, "x", 1), (2, "", "en", "a", 0, None, None), (3, "one two three four five six", "en", "a", 3, "y", 2),
           (4, "one two three\tfour five  six", "en", None, 3, "y", 2), (5, "one two three four five six", None, "b", 3, "y", 2),
           (5, "one two three four five six", None, "b", 3, "y", 2), (None, "word", "en", "b", 1, "z", 0), (None, None, None, None, None, None, None),
           (8, " \n ", "en", "a", 0, "w", 9), (9, LONG, "en", "c", 9, "w", 9), (10, LONG + "end", "en", "c", 9, "w", 9)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts(spark):
    return {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def lm_brute(rows, training, escape=lm_scoring.ESCAPE):
    tokens = [t.lower().split() + [None] for t in rows]
    words, pairs, contexts = collections.Counter(), collections.Counter(), collections.Counter()
    for t, used in zip(tokens, training):
        if used:
            words.update(t)
            pairs.update(zip(["start", *t[:-1]], t))
            contexts.update(["start", *t[:-1]])
    n, v = sum(words.values()), len(words)
    table = np.array([sum(-math.expm1(-c * 2.0 ** -j) for c in words.values()) for j in range(lm_scoring.GRID)])
    out = []
    for t in tokens:
        total = 0.0
        for a, b in zip(["start", *t[:-1]], t):
            p = words[b] / (n + v) if words[b] else (v / (n + v) if v else 1.0)
            c = contexts[a]
            if c:
                e = escape * float(lm_scoring.escape_weight(np.array([c]), n, table)[0])
                p = (pairs[(a, b)] + e * p) / (c + e)
            total += math.log10(p)
        out.append((len(t), sum(words[b] > 0 for b in t), n, sum(math.log10((words[b] + 1) / (n + v + 1)) for b in t), total))
    return out


def test_lm_score_equals_brute_force(spark):
    rows = {r.doc_id: r for r in queries.op1_lm_score(spark, SF).collect()}
    all_texts = texts(spark)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in all_texts}
    want = lm_brute(list(all_texts.values()), [not held[i] for i in all_texts])
    for i, (n, known, total, base, score) in zip(all_texts, want):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    assert sum(r.score for r in rows.values() if r.held_out) > sum(r.base_score for r in rows.values() if r.held_out)


class LmBrute:
    """The smoothed model by its definition, with counts of word tuples."""

    def __init__(self, texts, order, escape=lm_scoring.ESCAPE):
        self.order, self.escape = order, escape
        self.counts = [collections.Counter() for _ in range(order + 1)]
        for t in texts:
            tokens = ["<s>"] * (order - 1) + t.lower().split() + ["</s>"]
            for i in range(max(0, order - 2), len(tokens)):         # of the start marks the last counts
                for m in range(1, order + 1):
                    if i + 1 >= m:
                        self.counts[m][tuple(tokens[i + 1 - m:i + 1])] += 1
        self.words = {w: c for (w,), c in self.counts[1].items() if w != "<s>"}
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.table = np.array([sum(-math.expm1(-c * 2.0 ** -j) for c in self.words.values()) for j in range(lm_scoring.GRID)])

    def p(self, word, context):
        if not context:
            return (self.words[word] if word in self.words else self.v) / (self.n + self.v)
        c = self.counts[len(context)][context]
        shorter = self.p(word, context[1:])
        if not c:
            return shorter
        e = self.escape * float(lm_scoring.escape_weight(np.array([c]), self.n, self.table)[0])
        return (self.counts[len(context) + 1][(*context, word)] + e * shorter) / (c + e)

    def score(self, text):
        tokens = ["<s>"] * (self.order - 1) + text.lower().split() + ["</s>"]
        k = self.order - 1
        return sum(math.log10(self.p(tokens[i], tuple(tokens[i - k:i]))) for i in range(k, len(tokens)))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_orders_equal_the_definition(spark, order):
    """Scores of every order; and from any history the known words, the end and one unknown word share probability 1."""
    rng = np.random.default_rng(order)
    train = [" ".join(rng.choice(list("abcde"), size=rng.integers(0, 12), p=[.4, .3, .15, .1, .05])) for _ in range(40)]
    probes = [" ".join(rng.choice(list("abcdefx"), size=rng.integers(0, 9))) for _ in range(40)]
    model = LmBrute(train, order)
    for history in [("<s>",) * (order - 1), *[tuple(rng.choice(list("abcx"), size=order - 1).tolist()) for _ in range(20)]]:
        assert sum(model.p(w, history) for w in [*model.words, "unknown"]) == pytest.approx(1)
    rows = [(i, t, True) for i, t in enumerate(train)] + [(100 + i, t, False) for i, t in enumerate(probes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, training boolean")
    got = {r.doc_id: r.score for r in lm_scoring.score_texts(docs, "training", order=order, block_bytes=64).collect()}
    assert got == {i: pytest.approx(model.score(t)) for i, t, _ in rows}


def test_lm_totals_beyond_32_bits():
    counts = np.array([0, 1, 2**32 - 1, 2**32, 2**45 + 3], np.int64)
    assert (common.unpack_counts(common.pack_counts(counts)) == counts).all() and (common.unpack_counts(common.pack_counts(counts[:0])) == counts[:0]).all()


def test_lm_awkward(awkward, empty):
    got = lm_scoring.score_texts(awkward.withColumn("t", F.lit(True)), "t", block_bytes=1 << 16).collect()
    assert len(got) == len(AWKWARD) and sorted(r.n_tokens for r in got)[:4] == [1, 1, 1, 1]
    none = lm_scoring.score_texts(awkward.withColumn("t", F.lit(False)), "t").collect()
    assert all(r.score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in none)
    assert lm_scoring.score_texts(empty.withColumn("t", F.lit(True)), "t").count() == 0


def test_url_filter_cases(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.b", "", "block"), ("a.b", "", "allow")],
                                  "host string, path string, verdict string")
    urls = {"http://X.Example.NET/en/a?q": ("x.example.net", "/en/a", "example.net/en/", "allow"), "http://y.net/": ("y.net", "/", "net/", "block"),
            "http://y.net": ("y.net", "", None, "allow"), "http://xnet/": ("xnet", "/", None, "allow"), "no scheme": ("", "", None, "allow"),
            None: ("", "", None, "allow"), "": ("", "", None, "allow"), "s://c.a.b#f": ("c.a.b", "", "a.b", "block"),
            "http://y.net/" + "p" * 100_000: ("y.net", "/" + "p" * 100_000, "net/", "block")}
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*urls, *urls])], "page_id long, url string, host string")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == urls
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def cut_brute(rows, length):
    seen, out = set(), []
    for b in rows:
        covered = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                covered[p:p + length] = b"\1" * length
            seen.add(w)
        out.append((sum(covered), bytes(x for x, c in zip(b, covered) if not c),
                    sum(1 for j in range(len(b)) if covered[j] and (j == 0 or not covered[j - 1]))))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 15, 1 << 20])
def test_suffix_dedup_equals_brute_force(spark, block_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: (r.text or "").encode() for r in docs.orderBy("doc_id").collect()}
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, block_bytes=block_bytes).collect()}
    for i, (removed, kept, spans) in zip(rows, cut_brute(list(rows.values()), 100)):
        assert (got[i].n_removed, bytes(got[i].kept_bytes), len(got[i].removed_spans)) == (removed, kept, spans)


@pytest.mark.parametrize("length,gram", [(10, 4), (7, 2), (64, 32)])
def test_suffix_dedup_small_alphabet(spark, length, gram):
    rng = np.random.default_rng(length)
    rows = ["".join(rng.choice(list("abé"), size=rng.integers(0, 200))) for _ in range(40)] + ["ab" * 80, "ab" * 80, "a" * 300]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, length=length, gram=gram, block_bytes=500).collect()}
    for i, (removed, kept, spans) in enumerate(cut_brute([r.encode() for r in rows], length)):
        assert (got[i].n_removed, bytes(got[i].kept_bytes), len(got[i].removed_spans)) == (removed, kept, spans)


def test_suffix_dedup_awkward(awkward, empty):
    got = suffix_dedup.remove_repeats(awkward, block_bytes=1 << 16).collect()
    assert len(got) == len(AWKWARD)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert by_id[1].n_bytes == 0 and by_id[3].n_removed == 0
    assert by_id[9].n_bytes == len(LONG) and len(bytes(by_id[9].kept_bytes)) < 200       # its own repetitions go
    assert bytes(by_id[10].kept_bytes) == b"end"[-3:] or by_id[10].n_removed >= len(LONG)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_exact_dedup_awkward(awkward, empty):
    got = exact_dedup.exact_groups(awkward).collect()
    assert len(got) == len(AWKWARD)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert {i: by_id[i].keep_id for i in (1, 2, 3, 4, 5, 8, 9)} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 8: 8, 9: 9}
    assert by_id[1].group_size == 3 and by_id[3].group_size == 4
    assert exact_dedup.exact_groups(empty).count() == 0


@pytest.mark.parametrize("key,digest", [(lambda b: F.lit(1).cast("long"), exact_dedup.text_digest),
                                        (lambda b: F.length(b).cast("long"), lambda b: F.lit("same")),
                                        (exact_dedup.text_key, lambda b: F.substring(F.md5(b), 1, 1))])
def test_exact_dedup_with_colliding_keys_and_digests(awkward, key, digest):
    """Chains of one key are told apart by digests, and texts that share both by their bytes."""
    want = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(awkward).collect()}
    got = exact_dedup.exact_groups(awkward, key=key, digest=digest).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == want and len(got) == len(AWKWARD)


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key")).unionByName(spark.range(300).select(F.lit(7).cast("long").alias("key")))
    buckets = exact_dedup.build_directory(keys, 100)
    counts = {r["b"]: r["count"] for r in keys.withColumn("b", exact_dedup.bucket_of(buckets)).groupBy("b").count().collect()}
    assert sum(counts.values()) == 5300 and sorted(counts.values())[-2] <= 100 and max(counts.values()) >= 300


def test_mix_targets_and_copies(spark, awkward, empty):
    rows = queries.op5_source_mix(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    by_source = collections.defaultdict(list)
    for r in rows:
        assert r.taken <= 3 * r["size"]
        by_source[r.source].append(r)
    assert sum(v[0].target for v in by_source.values()) == pytest.approx(sum(r["size"] for r in rows))
    for v in by_source.values():
        assert abs(sum(r.taken for r in v) - v[0].target) <= 3 * max(r["size"] for r in v)
    odd = mixing.systematic_mix(awkward)
    assert odd.count() == len(AWKWARD) and mixing.systematic_mix(empty).count() == 0
    assert all(r.mix_copies == 0 for r in odd.where("mix_size = 0").collect())


def test_toxicity_worker_memory_is_bounded():
    """A worker remembers a bounded number of words, and texts of a batch are taken part by part, each row once."""
    finder = toxicity.TermFinder(np.arange(0, toxicity.PLACES, 2))
    for i in range(0, 150_000, 100):
        found = finder.places(b" ".join(b"word%d" % k for k in range(i, i + 100)))
        assert len(found) == len(set(found.tolist())) and (found % 2 == 0).all()
        assert len(finder.dull) + len(finder.known) <= 100_000
    rows = ["x" * 400_000, None, "y" * 3_000_000, "", "z"] * 3
    batch = pa.RecordBatch.from_pydict({"i": list(range(15)), "t": pa.array(rows, pa.string())})
    parts = list(common.text_runs([batch, batch.slice(0, 0)], "t"))
    assert [i for p, _ in parts for i in p.column("i").to_pylist()] == list(range(15))
    assert [t for _, v in parts for t in v] == [(r or "").encode() for r in rows]
    assert all(len(v) == 1 or sum(map(len, v)) <= common.SLICE_BYTES for _, v in parts)


def near_brute(rows, width, percent):
    sets = {}
    for i, t in rows.items():
        w = t.lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(rows)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}, sets


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_dedup_equals_brute_force(spark, width, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want, sets = near_brute(texts(spark), width, percent)
    got = near_dedup.near_groups(docs, width=width, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.component_id == r.doc_id) for r in got)


def test_near_dedup_long_lists(spark):
    """Variants of one text, each with other edits, go through lists far longer than list_max; so do a passage's many texts."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = {0: " ".join(base)}
    for i in range(1, 90):
        own = list(base)
        for p in rng.choice(120, size=int(rng.integers(1, 5)), replace=False):
            own[p] = f"edit{i}_{p}"
        rows[i] = " ".join(own)
    for i in range(200, 290):
        rows[i] = " ".join([f"own{i}_{k}" for k in range(60)] + [f"passage{k}" for k in range(60)])
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want, _ = near_brute({i: t.encode() for i, t in rows.items()}, 3, 85)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, width=3, percent=85, list_max=8).collect()}
    assert got == want


def test_near_dedup_one_large_group_of_variants(spark, monkeypatch):
    """Each class of one large group of variants takes part in a few candidate pairs, not in one for every list it is in."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    rows = {}
    for i in range(200):
        own = list(base)
        for p in rng.choice(120, size=2, replace=False):
            own[p] = f"edit{i}_{p}"
        rows[i] = " ".join(own)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    made, write = {}, near_dedup.materialise
    monkeypatch.setattr(near_dedup, "materialise", lambda df, name: made.setdefault(name, write(df, name)) if name == "near-pairs" else write(df, name))
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, width=3, percent=85, list_max=8).collect()}
    want, _ = near_brute({i: t.encode() for i, t in rows.items()}, 3, 85)
    assert got == want
    assert made["near-pairs"].count() <= 5 * len(rows)


def form_letters(options, fields=30, letters=300, planted=60):
    """Letters of fields filled from short lists; of each planted pair the second differs from the first in one field."""
    rng = np.random.default_rng(11)
    picks = [rng.integers(0, options, fields) for _ in range(letters)]
    for p in list(picks[:planted]):
        other = p.copy()
        other[rng.integers(0, fields)] += 1
        picks.append(other % options)
    return {i: " ".join(f"f{f}o{o}w{k}" for f, o in enumerate(p) for k in range(6)) for i, p in enumerate(picks)}


@pytest.mark.parametrize("options", [2, 3])
def test_near_dedup_form_letters(spark, options):
    """All values of all letters lie in long lists, and pairs have no leader in common."""
    rows = form_letters(options)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want, _ = near_brute({i: t.encode() for i, t in rows.items()}, 3, 85)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, width=3, percent=85, list_max=8).collect()}
    assert sum(i != c for i, c in want.items()) >= 60 and got == want


def test_near_dedup_short_texts_of_common_words(spark):
    """Sets of few values, all in long lists: pairs that share fewer values than a part is split by."""
    rng = np.random.default_rng(3)
    rows = {i: " ".join(rng.choice([f"w{k}" for k in range(10)], size=rng.integers(1, 9), replace=False)) for i in range(80)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want, _ = near_brute({i: t.encode() for i, t in rows.items()}, 1, 85)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, width=1, percent=85, list_max=1).collect()}
    assert got == want


def test_near_dedup_awkward(awkward, empty):
    got = near_dedup.near_groups(awkward).collect()
    assert len(got) == len(AWKWARD)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert {i: by_id[i].component_id for i in (1, 2, 3, 4, 5, 8, 9)} == {1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 8: 8, 9: 9}
    assert near_dedup.near_groups(empty).count() == 0


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in queries.op7_toxicity(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in labels]
    hit = sum(r.predicted == 1 and labels[r.doc_id] == 1 for r in rows)
    assert hit / sum(labels[r.doc_id] for r in rows) > 0.8 and hit / sum(r.predicted for r in rows) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_factorization_learns_a_pair():
    """Two terms that are harmless apart and toxic together."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(4000):
        x = [int(v) for v in (1, 2) if rng.random() < 0.5] + [3]
        rows.append(np.array(x, np.int32))
        labels.append(float(1 in x and 2 in x))
    model = toxicity.fit(rows, np.array(labels))
    assert model.score(np.array([1, 2, 3])) > 0.5 > max(model.score(np.array([1, 3])), model.score(np.array([2, 3])))


def test_factorization_learns_a_pair_of_neutral_terms():
    """Two terms without any effect of their own: toxic are the rows with both or neither."""
    rows = [np.array([x for x, there in ((1, a), (2, b), (3, True)) if there], np.int32) for a in (0, 1) for b in (0, 1)] * 1000
    model = toxicity.fit(rows, np.array([1.0, 0.0, 0.0, 1.0] * 1000))
    assert min(model.score(np.array(x)) for x in ([1, 2, 3], [3])) > 0.5 > max(model.score(np.array(x)) for x in ([1, 3], [2, 3]))


def test_toxicity_awkward(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(awkward, none)
    assert {r.toxicity for r in toxicity.score_texts(awkward, model).collect()} == {model.score(np.zeros(0, np.int32))}
    assert toxicity.score_texts(empty, model).count() == 0
    some = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (99, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.score_texts(awkward, toxicity.train(awkward, some)).columns[:7] == awkward.columns


def test_ann_recall_and_exact_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows])
    ids = np.array([r.vec_id for r in rows])
    norm = np.sqrt((x * x).sum(1))
    got = collections.defaultdict(list)
    for r in ann_forest.nearest_neighbours(spark.read.parquet(f"{SF}/embeddings.parquet"), F.col("vec_id") % 50 == 0, index_block=200,
                                           query_block=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    hit = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q] / (norm * norm[q])
        s[q] = -9
        best = set(ids[np.lexsort((ids, -s))[:5]].tolist())
        own = got[int(ids[q])]
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert all(abs(s[np.searchsorted(ids, r.vec_id)] - r.score) < 1e-12 for r in own)
        hit, total = hit + len(best & {r.vec_id for r in own}), total + 5
    assert hit / total >= 0.9


def test_ann_awkward(spark):
    kind = "vec_id long, embedding array<float>, rank int"
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [float("nan"), 1.0], 1),
            (7, [None, 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [0.0, 1.0], 1), (None, [1.0, 1.0], 1), (10, [], 1), (3, [1.0, 0.0], 2), (50, [1.0, 0.0], 0)]
    got = [tuple(r) for r in ann_forest.nearest_neighbours(spark.createDataFrame(rows, kind), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 50), (0, 5, 9), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 3), (50, 5, 9)]
    assert ann_forest.nearest_neighbours(spark.createDataFrame([], kind), F.col("vec_id") % 50 == 0).count() == 0


def test_bpe_equals_tiktoken_and_round_trips(spark, awkward, empty):
    path = public_tokenizers.path(queries.VOCABULARY)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    bpe = byte_bpe.ByteBpe(path, public_tokenizers.PATTERN)
    rng = np.random.default_rng(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "漢", "\U0001F600", "'s", "12", "!", "\x1c", "\x85", "\xa0", "the", "ing", "\r\n", "aaaa"]
    rows = ["".join(rng.choice(parts, size=rng.integers(0, 40))) for _ in range(3000)] + ["a" * 3000, " " * 3000, ""]
    for text, ids in zip(rows, bpe.encode_batch(rows)):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text) and bpe.decode(ids) == text.encode()
    text = "né漢\U0001F600x"
    spans = bpe.offsets(text, bpe.encode_batch([text])[0])
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(a < b for a, b in spans)
    coded = byte_bpe.encode(awkward, path, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded, path, public_tokenizers.PATTERN)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=key) == sorted([(r[0], r[1] or "") for r in AWKWARD], key=key)
    assert byte_bpe.encode(empty, path, public_tokenizers.PATTERN).count() == 0


PAGE = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href='/x'>Menu {i}</a></li></ul></nav>"
        "<div class='cookie-notice'>We use cookies</div>{body}<aside>Side {i}</aside><div id=comments><p>First!</p></div>"
        "<form><p>Search</p></form><footer>&copy; host</footer></body></html>")


def page_rows():
    rows = []
    for i in range(6):
        rows.append((i, "http://a.org/%d" % i, PAGE.format(i=i, body=f"<article><h1>Head &amp; {i}</h1><p>One <b>bo</b>ld<br>two<p>x &lt; y {i}</article>")))
        rows.append((10 + i, "http://b.org/%d" % i, PAGE.format(i=i, body=f"<div class=post><p>Long text number {i} of this page goes on</p><div class=ads>Buy</div>"
                                                                      f"<p>and on and on, {i}</p></div>")))
    return rows


def test_html_main_text(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in page_rows()] + [(20, None, None, "c"), (21, "", "", "c"), (22, "http://a.org/", "<script>never closed", "c"),
                                                                          (23, "u", "plain &amp; text", "c")], "page_id long, url string, html string, host string")
    got = {r.page_id: r.main_text for r in html_extract.extract_main_text(pages).collect()}
    for i in range(6):
        assert got[i] == f"Head & {i} One bold two x < y {i}"
        assert got[10 + i] == f"Long text number {i} of this page goes on and on and on, {i}"
    assert (got[20], got[21], got[22]) == ("", "", "") and got[23] == "plain & text"
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


def main_texts(spark, pages):
    """Main text of pages of one host; the pages differ in ``{i}``."""
    rows = [(k, "http://c.org/%d" % k, h) for k, h in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.main_text for r in html_extract.extract_main_text(frame).orderBy("page_id").collect()]


def test_html_text_of_several_containers(spark):
    """Without an article: heading, lead, list, table and sections beside the largest are main text."""
    body = ("<div class=post><h1>Head {i}</h1><div class=lead><p>Lead {i}</p></div><div class=body><p>Body of many more words than "
            "the lead has, page {i}</p><ul><li>Item {i}<li>Other {i}</ul><table><tr><td>Cell {i}<td>Next {i}</table></div>"
            "<div class=more><p>More {i}</p></div>{own}</div>")
    got = main_texts(spark, [PAGE.format(i=i, body=body.format(i=i, own="<section class=once><p>Only here</p></section>" * (i == 2)))
                             for i in range(5)])
    for i, text in enumerate(got):
        want = (f"Head {i} Lead {i} Body of many more words than the lead has, page {i} Item {i} Other {i} Cell {i} Next {i} More {i}")
        assert text == want + " Only here" * (i == 2)


def test_html_names_of_headings_and_sections(spark):
    """Names mark side parts on containers only, as whole words, and if many pages of the host have them."""
    body = ("<article><div class='article-header'><h1 id='search'>Search {i}</h1></div><h2 id='related-work'>Related {i}</h2>{own}"
            "<section class='social-policy'><p id='notice-period'>Notice {i}</p></section><div class='share'>Tell {i}</div></article>")
    once = "<section id='comment'><h2>Comment</h2><p>On this</p></section><section class='share'><p>A share</p></section>"
    got = main_texts(spark, [PAGE.format(i=i, body=body.format(i=i, own=once * (i == 2))) for i in range(5)])
    for i, text in enumerate(got):
        assert text == f"Search {i} Related {i} " + "Comment On this A share " * (i == 2) + f"Notice {i}"
    alone = "<article><h2 id=share>Share {i}</h2><section id='reply'><h2>Reply</h2><p>Text</p></section><div id=comments>No</div></article>"
    assert main_texts(spark, [PAGE.format(i=0, body=alone)]) == ["Share {i} Reply Text"]


@pytest.mark.parametrize("tag", ["article", "div"])
def test_html_constant_text(spark, tag):
    """Text under neutral names that all pages of a host repeat is template; a page that is copied is not."""
    body = ("<{tag}><h1>Head {i}</h1><div class=x7><p>Read our offer</p></div><p>Text of page {i}</p><section><h3>Terms</h3><p>apply</p></section>"
            "<p>Common words</p>{own}</{tag}><div class=x9>Top stories of the host</div>")
    pages = [PAGE.format(i=i, body=body.format(i=i, tag=tag, own="<p>Common words</p>" * (i % 2))) for i in range(6)]
    assert main_texts(spark, pages) == [f"Head {i} Text of page {i}" + " Common words" * (1 + i % 2) for i in range(6)]
    copy = PAGE.format(i=0, body=f"<{tag}><h1>Head</h1><p>Text</p></{tag}>")
    assert all(t.startswith("Head Text") or " Head Text" in t for t in main_texts(spark, [copy] * 4))


def test_html_self_closed_and_unclosed_controls(spark):
    body = ("<article><h1>Head {i}</h1><svg class='i'/><p>One <svg viewBox='0 0 1 1'><text>icon</text></svg>two {i}</p><button>Press<p>Three {i}</p>"
            "<select><option>a<option>b</select><p>Four</p><div><button>No</div><p>Five {i}</p></article>")
    assert main_texts(spark, [PAGE.format(i=i, body=body.format(i=i)) for i in range(4)]) == [f"Head {i} One two {i} Three {i} Four Five {i}" for i in range(4)]


@pytest.mark.parametrize("pages", [1, 5])
def test_html_compound_names_of_side_parts(spark, pages):
    body = ("<article><h1>Head {i}</h1><p>Text {i}</p><div class='notice'>Please note {i}</div><div class='reader-comments'><p>Nice {i}</p></div>"
            "<ul class='comment-list'><li>First {i}</ul><div class=ad-slot>Buy {i}</div><div class='relatedPosts'>See {i}</div>"
            "<div class='header-image'><p>Caption {i}</p></div><p>End {i}</p></article><div class=post-comments>Second {i}</div>")
    got = main_texts(spark, [PAGE.format(i=i, body=body.format(i=i)) for i in range(pages)])
    assert got == [f"Head {i} Text {i} Caption {i} End {i}" for i in range(pages)]


def test_html_clashing_columns_and_long_pages(spark):
    long = "<article>" + "<p>word and more</p>" * 50_000 + "</article>"
    rows = [(1, "http://a.org/", long, *"abcdef"), (1, "http://a.org/", None, *"abcdef")]
    names = "raw_html string, host_of_page string, host_of_template string, sides string, roots string, Main_Text string"
    got = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, " + names), text_col="out").collect()
    assert sorted(len(r.out) for r in got) == [0, 14 * 50_000 - 1] and {r.raw_html + r.sides for r in got} == {"ad"}


def test_html_articles_of_the_tables(spark):
    import html as h
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op10_html_text(spark, SF).collect():
        article = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1))
        want = " ".join(h.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert r.text == want and r.n_chars == len(want)


def test_packed_keys_round_trip():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (common.unpack_keys(common.pack_keys(keys)) == keys).all()
    assert sum(b - a for _, a, b in common.owner_slices(keys, 6)) == len(keys)


def test_bpe_holds_one_part_of_a_batch(monkeypatch, spark):
    # the texts of a whole Arrow batch are never copied at once into the worker
    import tracemalloc

    class Codec:
        def encode_batch(self, texts):
            return [b"\x01\x00\x00\x00" for _ in texts]

    class Docs:
        sparkSession = spark
        schema = spark.createDataFrame([], "doc_id long, text string").schema

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(byte_bpe, "codec", lambda *_: Codec())
    run = byte_bpe.encode(Docs(), "", "")
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(160)), "text": ["x" * 100_000] * 159 + [None]})
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 160 and peak < 6 * common.SLICE_BYTES
