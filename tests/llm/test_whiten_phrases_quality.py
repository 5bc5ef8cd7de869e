"""Whitening, phrase mining and quality rules against plain versions, and on awkward rows."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlog.llm import phrase_mining as pm, quality_rules as qr, queries, whitening as wh
from tests.llm.test_operators import AWKWARD, SF, awkward, empty  # noqa: F401


# ---------------------------------------------------------------- whitening
@pytest.mark.parametrize("values", [np.linspace(1, 2, 20), np.r_[1 + 1e-9 * np.arange(5), np.arange(2, 12)], np.r_[np.ones(6), 3, 4, 4 + 1e-12],
                                    np.r_[1, 1e-4 + 1e-10 * np.arange(8), 1e-9 * np.arange(1, 4)], np.ones(4), np.r_[0, 0, 1, 2]])
def test_refinement_reaches_the_last_digit(values):
    """From single precision to the precision of the matrix, also inside clusters of eigenvalues."""
    rng = np.random.default_rng(3)
    n = len(values)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ ((np.eye(n) - q.T @ q) / 2)
    a = (q * values.astype(np.longdouble)) @ q.T
    a = (a + a.T) / 2
    e, x = wh.refine(a, np.linalg.eigh(a.astype(np.float32))[1])
    assert float(abs(e - np.sort(values)[::-1]).max()) < 1e-16 * n * max(values)
    assert float(abs(a @ x - x * e).max()) < 1e-16 * n * max(values) and float(abs(x.T @ x - np.eye(n)).max()) < 1e-17 * n


def test_whitening_equals_numpy(spark):
    rows = queries.op11_whiten(spark, SF).toPandas()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x = np.floor(64 * np.stack(table.embedding).astype(float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    cov = np.cov(x.T, bias=True)
    values, vectors = (v[..., ::-1] for v in np.linalg.eigh(cov))
    deviation = dict(zip(table.vec_id, ((n * x - total) ** 2).sum(axis=1)))
    assert len(rows) == 32 * n and set(rows.n) == {n} and (rows.deviation == rows.vec_id.map(deviation)).all()
    assert rows.groupby("component").explained.first().to_numpy() == pytest.approx(values[:32] / np.trace(cov), rel=1e-9)
    assert rows.identity_error.nunique() == 1 and rows.identity_error.iloc[0] < 1e-9
    white = rows.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    want = ((x - total / n) @ vectors[:, :32]) / np.sqrt(values[:32])
    assert white * np.sign((white * want).sum(axis=0)) == pytest.approx(want, abs=1e-8)


def test_whitening_awkward(spark):
    kind = "vec_id long, embedding array<float>, n int, whitened string"
    rows = [(1, [1.0, 2.0, 5.0]), (2, [2.0, 1.0, 5.0]), (2, [2.0, 1.0, 5.0]), (None, [3.0, 3.5, 5.0]), (4, None), (5, []), (6, [1.0, None, 2.0]),
            (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0])]
    got = wh.whiten(spark.createDataFrame([(*r, 1, "x") for r in rows], kind)).collect()
    assert sorted([r.vec_id for r in got], key=str) == sorted([1, 2, 2, None], key=str)
    assert all(len(r.whitened) == 3 and r.whitened[2] is None and r.whitened[0] is not None and r.n == 4 for r in got)     # the third dimension is constant
    x = np.array([[64, 128, 320], [128, 64, 320], [128, 64, 320], [192, 224, 320]])
    assert {int(r.deviation) for r in got if r.vec_id == 1} == {int(((4 * x[0] - x.sum(axis=0)) ** 2).sum())}
    assert got[0].identity_error < 1e-12
    single = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1, "x")], kind)).collect()
    assert [(int(r.deviation), r.whitened) for r in single] == [(0, [None, None])]
    big = wh.whiten(spark.createDataFrame([(i, [float(i) * 2 ** 30, 1.0 + i % 2], 1, "x") for i in range(8)], kind)).collect()
    y = [[64 * i * 2 ** 30, 64 * (1 + i % 2)] for i in range(8)]
    sums = [sum(c) for c in zip(*y)]
    assert {r.vec_id: int(r.deviation) for r in big} == {i: sum((8 * v - s) ** 2 for v, s in zip(y[i], sums)) for i in range(8)}
    assert wh.whiten(spark.createDataFrame([], kind)).count() == 0


# ---------------------------------------------------------------- phrases
def phrases_brute(rows, min_count, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[(lang, *w[i:i + m])] += 1
    candidates = {k: c for k, c in f.items() if c >= min_count and len(k) > 2}
    inside = {(k[0], *k[i:i + m]) for k, c in candidates.items() for m in range(2, len(k) - 1) for i in range(1, len(k) - m + 1) if c >= f[(k[0], *k[i:i + m])]}
    out = collections.defaultdict(list)
    for k, a in candidates.items():
        if k not in inside:
            cuts = [(1000 * a * n[k[0]] // (f[k[:1 + j]] * f[(k[0], *k[1 + j:])]), j, f[k[:1 + j]], f[(k[0], *k[1 + j:])]) for j in range(1, len(k) - 1)]
            score, _, left, right = min(cuts)
            out[k[0]].append((-score, -a, " ".join(k[1:]).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1)}


def test_phrases_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    words = ["a", "b", "B", "c", "der", "é", "x.y", "a,b", "q!", "\x1c", "z\nz", "t\tu", "v\x0bw", "."]
    rows = [(i, str(rng.choice(["en", "de"])) if i % 9 else None, " ".join(rng.choice(words, size=rng.integers(0, 60)))) for i in range(300)]
    rows += [(1000 + i, "en", "one two three four five six seven") for i in range(40)] + [(None, "fr", None), (2000, "fr", ""), (2001, "fr", "un deux " * 3000)]
    rows.append(rows[5])
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, lang string, text string, words string, owner int")
    for block_bytes in (1 << 11, 1 << 20):
        got = {tuple(r) for r in pm.collocations(docs, min_count=5, top=40, block_bytes=block_bytes).collect()}
        assert got == phrases_brute([r[1:] for r in rows], 5, 40)


def test_phrase_scores_beyond_64_bits(spark):
    """The score's products need more than 64 bits long before counts do."""
    expression = "(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    a, l, r, n = 99_999_999_999_999, 100_000_000_000_001, 123_456_789_012_345, 999_999_999_999_989
    row = spark.createDataFrame([(a, l, r, n)], "a long, l long, r long, n long").select(F.expr(expression).alias("score")).first()
    assert row.score == 1000 * a * n // (l * r)


def test_automata_share_states_and_unite(spark):
    one = [((b"a", b"b"), 2), ((b"a", b"c"), 2), ((b"b", b"b"), 2), ((b"a",), 7), ((b"x", b"y", b"z"), 1)]
    two = [((b"a", b"b"), 3), ((b"q",), 1), ((b"x", b"y", b"z"), 4)]
    first, second = (pm.sorted_automaton([p for p, _ in x], [c for _, c in x]) for x in (one, two))
    assert len(first.weights[2]) == 2        # "ab", "ac" and "bb" end in one state, "xy" does not accept
    again = pm.CountAutomaton.unpack(first.pack())
    assert again.words == first.words and all((u == v).all() for a, b in ((again.weights, first.weights), (again.target, first.target)) for u, v in zip(a, b))
    phrases, counts = pm.unite([again, second], 2)
    assert {tuple(p): int(c) for p, c in zip(phrases, counts)} == {(b"a", b"b"): 5, (b"a", b"c"): 2, (b"b", b"b"): 2, (b"a",): 7, (b"x", b"y", b"z"): 5}
    asked = pm.sorted_automaton([(b"a", b"b"), (b"x", b"y", b"z"), (b"a", b"nowhere")], [1, 1, 1])
    assert sorted(pm.compose(asked, first)) == [((b"a", b"b"), 2), ((b"x", b"y", b"z"), 1)]


def test_phrases_awkward(awkward, empty):  # noqa: F811
    got = {tuple(r) for r in pm.collocations(awkward, min_count=3, top=5).collect()}
    assert got == phrases_brute([(r[2], r[1]) for r in AWKWARD], 3, 5)
    assert pm.collocations(empty).count() == 0


# ---------------------------------------------------------------- quality rules
def counts_brute(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_awkward_rows(spark, awkward, empty):  # noqa: F811
    extra = [(100, "a b c a b c", "en", "s", 1, "n_words", 0), (101, "x\n x\nx\r\nx\n\n \nx", None, "s", 1, "k", 0), (102, "## é$ 漢<>|\x0b&", "de", None, 1, "k", 0),
             (103, "A B\n" * 200, "en", "s", 1, "k", 0), (104, "é " * 60 + "\U0001F600", "en", "s", 1, "k", 0)]
    docs = awkward.unionByName(spark.createDataFrame(extra, awkward.schema))
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in qr.judge(docs).collect())
    want = collections.Counter()
    for r in [*AWKWARD, *extra]:
        c = counts_brute(r[1])
        want[(r[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert got == want
    assert qr.judge(empty).count() == 0


def test_sketch_buckets_are_fine_and_merge(spark):
    values = [0, 1, 63, 64, 127, 128, 129, 1000, 12_345, 10**6, 2**40 + 17]
    df = spark.createDataFrame([(v,) for v in values], "v long").withColumn("b", qr.bucket_of(F.col("v")).cast("long")).withColumn("low", qr.value_of(F.col("b")))
    rows = df.orderBy("v").collect()
    assert all(r.low <= r.v and r.v - r.low <= r.v / 64 for r in rows) and [r.b for r in rows] == sorted(r.b for r in rows)
    counted = spark.createDataFrame([("a", i % 2, 10 * i, 100) for i in range(200)], "lang_key string, source_key int, word_chars long, n_words long")
    for c in ("n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"):
        counted = counted.withColumn(c, F.lit(0).cast("long"))
    parts = qr.sketches(counted, ["lang_key", "source_key"])
    whole = qr.sketches(counted, ["lang_key"])
    assert qr.merge(parts, ["lang_key"]).exceptAll(whole).count() == 0
    q = qr.quartiles(whole, ["lang_key"]).where("rule = 'word_length'").first()
    true = sorted(1000 * 10 * i // 100 for i in range(200))
    assert q.docs == 200 and abs(q.low - true[49]) <= true[49] / 64 and abs(q.high - true[149]) <= true[149] / 64


def test_fences_follow_the_group(spark):
    """The same ratio is usual in one source and beyond the fence of another; a small source borrows its language's."""
    def text(words, marks):
        return " ".join(f"w{k}{'#' if k < marks else ''}" for k in range(words))

    rng = np.random.default_rng(2)
    rows = [(i, text(100, int(rng.integers(0, 3))), "en", "plain") for i in range(80)]
    rows += [(100 + i, text(100, int(rng.integers(50, 70))), "xx", "code") for i in range(80)]
    rows += [(1000, text(100, 60), "en", "plain"), (1001, text(100, 60), "xx", "code"), (1002, text(100, 60), "en", "new"), (1003, text(100, 1), "en", "new")]
    got = {r.doc_id: (r.kept, list(r.failed_rules)) for r in qr.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[1000] == (False, ["symbols"]) and got[1002] == (False, ["symbols"])
    assert got[1001] == (True, []) and got[1003] == (True, []) and all(got[i][0] for i in range(80)) and all(got[100 + i][0] for i in range(80))


def test_quality_tells_labelled_junk_from_good_texts(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = queries.op13_quality_rules(spark, sf).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in rows.collect()}
    assert kept[0] < 0.02 and kept[1] > 0.98
