"""Memory that tokenizing takes in a worker, whatever it reads."""

import random

import pyarrow as pa

from broadsheet.llm import packing
from broadsheet.llm.queries import TOKENIZER


def test_arrow_memory_of_tokenizing_is_bounded():
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]
    texts = [" ".join(r.choices(words, k=1000)) for _ in range(4000)]  # 28 MB
    batches = [pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(texts[i : i + 100])], names=["_id", "_text"]) for i in range(0, len(texts), 100)]
    encoder, before, most, n = packing.WordBPE(TOKENIZER), pa.total_allocated_bytes(), 0, 0
    for table in packing._gathered(iter(batches)):
        for ids in encoder.encode(table.column(1)):
            n += 1
            most = max(most, pa.total_allocated_bytes() - before)
    assert n == len(texts)
    assert most < 32 << 20
