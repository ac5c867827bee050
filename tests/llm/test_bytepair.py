import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from broadsheet.llm import bytepair, queries
from broadsheet.llm.bytepair import BytePairs, RankQueue, read_ranks

SF = "/root/testdata/sf0.001"
RANKS = read_ranks(queries.BYTE_RANKS)
ODD = ["", None, " ", "  \n\t x", "É é ÑandÚ!! it's we'll don'T", "İstanbul\x1cy\x85z  w", "日本語 ½ ⅷ ٣", "<|endoftext|> a", "a" * 30000, "🙂🙂 ퟿", "x\x00y \x01z", "the same", "the same"]


def library(ranks=RANKS, pattern=P.PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def brute(ranks, piece):
    parts = [piece[i : i + 1] for i in range(len(piece))] if piece not in ranks else [piece]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return [ranks[x] for x in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_ids_equal_the_library():
    r, own, lib = random.Random(1), BytePairs(RANKS, P.PATTERN), library()
    texts = [t or "" for t in ODD] + ["".join(r.choice("abcdefghiéüß 日本.-'12\n\t") for _ in range(r.randint(0, 300))) for _ in range(3000)]
    texts += ["a" * k for k in range(1, 200)] + ["ab" * k for k in range(1, 100)] + [f"a{chr(c)}b {chr(c)} 1{chr(c)}" for c in range(0x2200) if not 0xD800 <= c < 0xE000]
    for _ in range(2):  # the second time, pieces are known
        for t, ids in zip(texts, own.encode(texts), strict=True):
            assert ids.tolist() == lib.encode_ordinary(t)
            assert own.decode(ids) == t.encode()
    with pytest.raises(ValueError):
        own.decode(np.array([10**6]))


def test_ranks_in_any_order_equal_brute_force():
    """Joins may make pairs of lower ranks, which then come first."""
    r = random.Random(3)
    for _ in range(60):
        more = {"".join(r.choice("abc") for _ in range(r.randint(2, 6))).encode() for _ in range(60)}
        ids = list(range(256 + len(more)))
        r.shuffle(ids)
        ranks = dict(zip([*[bytes([b]) for b in range(256)], *sorted(more)], ids, strict=True))
        own = BytePairs(ranks, "[abc]+")
        texts = ["".join(r.choice("abc") for _ in range(r.randint(1, 60))) for _ in range(40)]
        assert [x.tolist() for x in own.encode(texts)] == [brute(ranks, t.encode()) for t in texts]


def test_queue_gives_least_rank_first():
    queue = RankQueue()
    queue.push(np.array([300, 5, -1, 70_000, 5]), np.array([1, 9, 2, 3, 4]))
    got = []
    for rank, at in queue.drain():
        got.append((rank, at.tolist()))
        if len(got) == 2:
            queue.push(np.array([7, 300]), np.array([8, 8]))
    assert got == [(5, [9, 4]), (300, [1]), (7, [8]), (300, [8]), (70_000, [3])]


def test_very_long_piece_takes_linear_time():
    own, r = BytePairs(RANKS, P.PATTERN), random.Random(2)
    text = "aé" * 200_000 + "x" * 50_000 + "".join(r.choice("abcdefé日") for _ in range(200_000))
    began = time.perf_counter()
    (ids,) = own.encode([text])
    assert time.perf_counter() - began < 20
    assert ids.tolist() == library().encode_ordinary(text)


def test_rows_and_edges(spark, monkeypatch):
    monkeypatch.setattr(bytepair, "NEW_PIECES", 5)
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(ODD)] + [(None, "lone", None, 2), (3, ODD[3], "s", 1)], "doc_id long, text string, ids string, bytes int")
    encoded = bytepair.encode(docs, queries.BYTE_RANKS, P.PATTERN)
    rows = bytepair.decode(encoded, queries.BYTE_RANKS, P.PATTERN).collect()
    lib = library()
    want = sorted([(str(i), t or "") for i, t in enumerate(ODD)] + [("None", "lone"), ("3", ODD[3])])
    assert sorted((str(x.doc_id), bytes(x.bytes).decode()) for x in rows) == want
    assert all(x.ids == lib.encode_ordinary(bytes(x.bytes).decode()) for x in rows)
    assert bytepair.decode(bytepair.encode(docs.limit(0), queries.BYTE_RANKS, P.PATTERN), queries.BYTE_RANKS, P.PATTERN).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted((x.doc_id, x.bytes) for x in bytepair.decode(nothing, queries.BYTE_RANKS, P.PATTERN).collect()) == [(1, None), (2, b"")]


def test_query_against_the_library(spark):
    lib = library()
    texts = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for x in rows:
        ids = lib.encode_ordinary(texts[x.doc_id])
        assert x.n_tokens == len(ids) and x.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(texts[x.doc_id].encode()).hexdigest()
