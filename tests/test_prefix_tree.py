"""The prefix tree against plain Python, with pieces shorter than what cases share."""

import collections
import random

import pytest

from flowlog.config import MiningConfig, SkewConfig
from flowlog.operators import conformance as cf, prefix_tree as pt
from tests.conftest import make_log

OFF = MiningConfig(skew=SkewConfig(mode="off"))
ALL = MiningConfig(skew=SkewConfig(mode="all", bucket_rows=2))


def _log(spark):
    rnd = random.Random(8)
    cases = {f"c{i}": [rnd.choice("AB") for _ in range(rnd.randint(1, 6))] for i in range(25)}
    cases |= {"long1": list("ABAB" * 6), "long2": list("ABAB" * 6), "long3": list("ABAB" * 5) + list("BBB"), "alone": list("CCCCCCCCCCC")}
    rows = [(c, a, f"2026-0{1 + (c == 'alone')}-01 00:00:{k:02d}", "s1" if k % 2 else "s2", None) for c, acts in cases.items() for k, a in enumerate(acts)]
    return make_log(spark, rows), cases


@pytest.mark.parametrize("piece,cfg", [(1, OFF), (3, ALL), (32, OFF)])
def test_nodes_are_the_distinct_prefixes(spark, piece, cfg):
    log, cases = _log(spark)
    rows = pt.prefix_tree(log, cfg, piece=piece).collect()
    want = collections.Counter()
    for c, acts in cases.items():
        for segment in {"s2"} | ({"s1"} if len(acts) > 1 else set()):
            whole = [*acts, pt.END]
            for k in range(1, len(whole) + 1):
                want[(segment, "2026-02" if c == "alone" else "2026-01", tuple(whole[:k]))] += 1
    by_id = {(r.segment, r.month, r.node): r for r in rows}
    assert len(by_id) == len(rows)

    def path(r):
        return () if r is None else path(by_id.get((r.segment, r.month, r.parent))) + (r.activity,)

    got = {(r.segment, r.month, path(r)): r.n for r in rows}
    assert got == dict(want) and len(got) == len(rows)
    for r in rows:
        p = path(r)
        assert r.depth == len(p) and r.prev_activity == (p[-2] if len(p) > 1 else pt.START)


@pytest.mark.parametrize("noise", [0.0, 0.5])
def test_conformance_read_off_the_tree(spark, noise):
    log, _ = _log(spark)
    want = {(r.source, r.month): r for r in cf.conformance(log, OFF, noise_threshold=noise).collect()}
    got = {(r.source, r.month): r for r in pt.tree_conformance(pt.prefix_tree(log, OFF, piece=3), noise).collect()}
    assert got == want


def test_tree_of_an_empty_log(spark):
    log, _ = _log(spark)
    assert pt.prefix_tree(log.limit(0), OFF).count() == 0
