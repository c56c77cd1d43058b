"""What a task's own code holds at a time does not grow with the batch it is given."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa

from quarrydesk.llm import byte_bpe, decontaminate


def _texts(megabytes, seed=3):
    rng = np.random.default_rng(seed)
    return [" ".join(map(str, rng.integers(10**6, 10**9, 400))) for _ in range(megabytes * 260)]


def _peak(run, batch):
    """Largest MB held at a time, without what the batch itself holds."""
    tracemalloc.start()
    rows = sum(out.num_rows for out in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return rows, peak / 2**20


def test_decontamination_holds_little_beside_its_batch():
    texts = _texts(6)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    shared = SimpleNamespace(value=decontaminate.build_index([1], [" ".join(texts[7].split()[:30])]))
    rows, peak = _peak(decontaminate._search(shared), batch)
    assert rows == 1 and peak < 25


def test_byte_bpe_remembers_a_bounded_number_of_pieces():
    texts = _texts(1)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as ranks:
        shared = SimpleNamespace(value=ranks.read())
    rows, peak = _peak(byte_bpe._coder(shared, public_tokenizers.PATTERN, False), batch)
    assert rows == len(texts) and peak < 70
