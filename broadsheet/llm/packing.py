"""Packing documents into windows of tokens by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import bisect
import heapq
import json
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from broadsheet.llm.common import small_batches

WINDOW, END_ID = 2048, 1
#: Windows that one differencing fills; its tokens are short of full by SLACK a window, room for uneven sums.
BLOCK_WINDOWS, SLACK = 128, 2
#: Longest piece that goes into differencing; a document's tail is cut to such pieces.
PIECE = 256
#: Bytes of text that are tokenized together (a worker holds some ten times that for them), and distinct words that it remembers.
TEXT_BYTES, KNOWN_WORDS = 2 << 20, 250_000


# ---------------------------------------------------------------- tokens


_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def ascii_lower(text: str) -> str:
    return text.translate(_LOWER)


class WordBPE:
    """Ids of a lower-casing word-end BPE vocabulary file, for many texts at once.

    A text's white-space chunks don't touch one another's ids, so each distinct chunk of a batch is encoded once and the
    ids are gathered. Chunks in Latin letters go through a byte-level encoder with the vocabulary's ids as merge ranks;
    all others, and chunks that hold the string of a special token, go through the tokenizers library itself.
    """

    #: The vocabulary's own pattern of pieces.
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    #: Characters that normalisation may change in other ways than to lower case.
    ODD = regex.compile("[^\\x20-\\u02ff\\n]|[\\x7f-\\xa0\\xad\\u0130]")

    #: What ascii_split_whitespace leaves whole.
    CHUNK = re.compile("[^ \\t\\n\\x0b\\x0c\\r]+")

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        added = self.slow.get_added_tokens_decoder()
        special = set(added)
        self.specials = re.compile("|".join(re.escape(t.content) for t in added.values()), re.IGNORECASE) if added else None
        ranks = {}
        for token, i in vocab.items():
            if i not in special:
                ends = token.endswith("</w>") and len(token) > 4
                ranks[bytes(byte_of[c] for c in (token[:-4] if ends else token)) + b"\x01" * ends] = i
        self.fast = tiktoken.Encoding("word-ends", pat_str=r"[^\x01\n]+\x01|\n", mergeable_ranks=ranks, special_tokens={})
        self.newline = ranks[b"\n"]
        self.known = pa.array([], pa.string())
        self.known_ids, self.known_at = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's begin (one more entry than words)."""
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        line = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py()
        odd = {}
        if self.ODD.search(line) or (self.specials and self.specials.search(line)):
            parts = line.split("\n")
            odd = {i: w for i, w in enumerate(parts) if self.ODD.search(w) or (self.specials and self.specials.search(w))}
            line = "\n".join("" if i in odd else w for i, w in enumerate(parts))
        ids = self.fast.encode_to_numpy(self.PIECES.sub("\\g<0>\x01", line.lower()) + "\n")
        ends = np.flatnonzero(ids == self.newline)
        sizes = np.diff(ends, prepend=-1) - 1
        ids = ids[ids != self.newline]
        if odd:
            pieces = np.split(ids, np.cumsum(sizes)[:-1])
            for i, w in odd.items():
                pieces[i] = np.array(self.slow.encode(w, add_special_tokens=False).ids, np.uint32)
            ids, sizes = np.concatenate(pieces), np.array([len(p) for p in pieces])
        return ids.astype(np.uint32, copy=False), np.append(0, np.cumsum(sizes))

    def _lower(self, column: pa.Array) -> pa.Array:
        """A-Z lower-cased, but not in white-space chunks with the string of a special token in any case, which counts as written."""
        low = pc.ascii_lower(column)
        if self.specials is None:
            return low
        held = pc.match_substring_regex(column, self.specials.pattern, ignore_case=True)
        if not pc.any(held).as_py():
            return low
        kept = [self.CHUNK.sub(lambda m: m[0] if self.specials.search(m[0]) else ascii_lower(m[0]), t) if h else None for t, h in zip(column.to_pylist(), held.to_pylist(), strict=True)]
        return pc.if_else(held, pa.array(kept, pa.string()), low)

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column in order; null is empty."""
        chunks = pc.ascii_split_whitespace(self._lower(pc.fill_null(column, "")))
        coded = chunks.flatten().dictionary_encode()
        words = pc.if_else(pc.equal(coded.dictionary, ""), None, coded.dictionary)
        met = pc.index_in(words, value_set=self.known)
        new = pc.and_(pc.is_null(met), pc.is_valid(words))
        fresh = words.filter(new)
        ids, at = self._encode(fresh)
        base = len(self.known_ids)
        flat = np.concatenate([self.known_ids, ids])
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        hit = met.is_valid().to_numpy(zero_copy_only=False)
        where = met.drop_null().to_numpy()
        begin[hit], size[hit] = self.known_at[where], np.diff(self.known_at)[where]
        miss = new.to_numpy(zero_copy_only=False)
        begin[miss], size[miss] = at[:-1] + base, np.diff(at)
        if len(self.known) < KNOWN_WORDS:
            self.known = pa.concat_arrays([self.known, fresh])
            self.known_at = np.concatenate([self.known_at, at[1:] + base])
            self.known_ids = flat
        index, edge = coded.indices.to_numpy(), np.asarray(chunks.offsets) - chunks.offsets[0].as_py()
        for lo in range(0, len(column), 128):
            hi = min(lo + 128, len(column))
            i = index[edge[lo] : edge[hi]]
            n = size[i]
            total = np.append(0, np.cumsum(n))
            out = flat[np.repeat((begin[i] - total[:-1]), n) + np.arange(total[-1])] if len(i) else np.empty(0, np.uint32)
            cuts = total[edge[lo : hi + 1] - edge[lo]]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield out[a:b]


# ---------------------------------------------------------------- differencing


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: split items into `ways` sets of nearly equal sums; gives the items of each set.

    Partial partitions are merged, the two most uneven first, the largest sets of one with the smallest of the other. A
    partial partition keeps its non-empty sets only, in ascending order of sums.
    """
    heap = []  # (-unevenness, number, sums ascending, items)
    for i, s in enumerate(sizes):
        heap.append((-s if ways > 1 else 0, i, [s], [[i]]))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        if len(a) < len(b):
            a, x, b, y = b, y, a, x
        over = max(0, len(a) + len(b) - ways)  # sets that are merged: largest of one with smallest of the other
        if over == 0:
            for s, items in zip(b, y, strict=True):
                k = bisect.bisect(a, s)
                a.insert(k, s)
                x.insert(k, items)
        else:
            # the free places of a's partition take b's largest sets; its other sets meet a's smallest in reverse order
            merged = [(a[j] + b[over - 1 - j], x[j] + y[over - 1 - j]) for j in range(over)]
            merged += list(zip(b[over:], y[over:], strict=True))
            merged += list(zip(a[over:], x[over:], strict=True))
            merged.sort(key=lambda p: p[0])
            a, x = [p[0] for p in merged], [p[1] for p in merged]
        count += 1
        heapq.heappush(heap, (-(a[-1] - (a[0] if len(a) == ways else 0)), count, a, x))
    out = heap[0][3] if heap else []
    return out + [[] for _ in range(ways - len(out))]


def windows_of(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Sets of items with sums of at most `window`; the number of sets rises whenever one is exceeded."""
    ways = max(1, -(-sum(sizes) // window))
    while True:
        sets = differencing(sizes, ways)
        if all(sum(sizes[i] for i in s) <= window for s in sets):
            return [s for s in sets if s]
        ways += 1


# ---------------------------------------------------------------- operator

OUT = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, piece: int = PIECE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row a piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every row of docs is tokenized whole and ends with `end_id`; null and empty texts are that id alone. Whole windows are
    cut from long documents; what remains is cut to pieces, and each block of pieces is split by differencing into windows
    of nearly equal sums. Nothing is shuffled: a task packs the rows it reads in bounded memory, and a task that runs
    again gives pieces of the same documents. sequence_id holds the partition in its upper half. An empty table gives no
    rows. `tokenizer` is a path that every executor has. Other columns of docs are not read.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))
    names = [id_col, *[x.split()[0] for x in OUT.split(", ")]]
    target = block_windows * (window - SLACK)

    def run(batches):
        encoder, sequence = WordBPE(tokenizer), TaskContext.get().partitionId() << 32
        id_type = None
        pending, pending_tokens, ready = [], 0, []

        def place(pieces):
            nonlocal sequence
            for members in windows_of([len(p[2]) // 4 for p in pieces], window):
                offset = 0
                for m in sorted(members):
                    doc, start, raw, total = pieces[m]
                    ready.append((doc, start, len(raw) // 4, raw, total, sequence, offset))
                    offset += len(raw) // 4
                sequence += 1

        def rows():
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready, strict=True), types, strict=True)], names=names)
            ready.clear()
            return out

        for table in _gathered(batches):
            id_type = table.column(0).type
            for doc, ids in zip(table.column(0).to_pylist(), encoder.encode(table.column(1)), strict=True):
                raw = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                total, at = len(raw) // 4, 0
                while total - at >= window:
                    ready.append((doc, at, window, raw[4 * at : 4 * (at + window)], total, sequence, 0))
                    sequence += 1
                    at += window
                while at < total:
                    n = min(piece, total - at, target - pending_tokens)
                    pending.append((doc, at, raw[4 * at : 4 * (at + n)], total))
                    pending_tokens += n
                    at += n
                    if pending_tokens == target:
                        place(pending)
                        pending, pending_tokens = [], 0
                if len(ready) >= 2000:
                    yield rows()
        if pending:
            place(pending)
        if ready:
            yield rows()

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, {OUT}")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about TEXT_BYTES of text, so that words repeat within them."""
    held, size = [], 0
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy()
        at, sums = 0, np.cumsum(lengths)
        for i in range(b.num_rows):
            if size + sums[i] - (sums[at - 1] if at else 0) >= TEXT_BYTES:
                held.append(b.slice(at, i + 1 - at))
                yield _one(held)
                held, size, at = [], 0, i + 1
        if at < b.num_rows:
            held.append(b.slice(at))
            size += int(sums[-1] - (sums[at - 1] if at else 0))
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
