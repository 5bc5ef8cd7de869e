"""What a Python worker keeps between tasks."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from flowlog.llm import byte_bpe, common
from flowlog.llm.queries import VOCABULARY


def test_memory_is_released_after_every_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pydict({"t": pa.array(x, pa.string())}) for x in (["a", None], [], ["b" * 3_000_000, "c"])]
    assert [len(x) for _, values in common.text_runs(batches, "t") for x in values] == [1, 0, 3_000_000, 1]
    assert len(calls) == 3


def test_release_memory_gives_back_what_was_freed():
    def held():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith("Pss_Anon")) / 1024

    kept, blocks = [], []
    for _ in range(3000):                   # blocks below the size that malloc maps one by one, with pins between them
        blocks.append(np.ones(60_000, np.uint8))
        kept.append(np.ones(100, np.uint8))
    del blocks
    before = held()
    common.release_memory()
    assert held() <= before


def test_encoder_remembers_a_bounded_number_of_stretches():
    bpe = byte_bpe.ByteBpe(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    for i in range(100):
        text = " ".join(f"w{i}x{j}" for j in range(1000))
        (ids,) = bpe.encode_batch([text])
        assert bpe.decode(ids) == text.encode()
    assert len(bpe.memo) + len(bpe.older) < 80_000
