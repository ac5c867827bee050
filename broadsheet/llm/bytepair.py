"""Byte-level BPE encoding and decoding with a queue of merge ranks under a hierarchical bitmap."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from broadsheet.llm.common import slices, small_batches

#: Distinct pieces whose ids a worker remembers.
KNOWN_PIECES = 600_000
#: Texts of more characters are cut into pieces one by one, so that the list of their pieces is never held.
LISTED_CHARS = 1 << 20
#: Texts that are cut together; and pieces of texts, and distinct new pieces, that are held until the new ones are merged
#: together.
ROWS, HELD_PIECES, NEW_PIECES = 2000, 6 << 20, 150_000
#: Code points up to which the classes of a pattern are spelled out for the plain regular expressions, which are faster.
LATIN = 0x250


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of base64 tokens and decimal ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def latin_pattern(pattern: str) -> re.Pattern | None:
    """The pattern with \\p{L}, \\p{N} and \\s spelled out, for texts of code points below LATIN; nothing if it holds other classes."""
    spelled = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        one = regex.compile(name)
        spelled[name] = "".join(f"\\u{c:04x}" for c in range(LATIN) if one.match(chr(c)))
    inside = regex.compile(r"(?<=\[\^?[^\]]*)(?:\\p\{[LN]\}|\\s)")
    out = inside.sub(lambda m: spelled[m[0]], pattern)
    for name, chars in spelled.items():
        out = out.replace(name, f"[{chars}]")
    out = out.replace(r"\S", f"[^{spelled[chr(92) + 's']}]")
    return None if re.search(r"\\[^u]", out) else re.compile(out)


class RankQueue:
    """Positions by rank, the least rank first.

    A bucket for each rank holds arrays of positions. A bitmap in words of 256 bits marks the ranks whose buckets are not
    empty, and `top` marks the words that are not zero, so find-first-set in top and then in a word gives the next rank.
    Words and buckets are made when they are first needed, so an empty queue costs nothing.
    """

    def __init__(self):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.words: dict[int, int] = {}
        self.top = 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Enter positions under their ranks; negative ranks are none."""
        order = np.argsort(ranks, kind="stable")
        ranks = ranks[order]
        edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        edges = [0, *edges.tolist(), len(ranks)]
        first, positions = ranks[edges[:-1]].tolist(), positions[order]
        for rank, a, b in zip(first, edges[:-1], edges[1:], strict=True):
            if rank < 0:
                continue
            bucket = self.buckets.get(rank)
            if bucket is not None:
                bucket.append(positions[a:b])
                continue
            self.buckets[rank] = [positions[a:b]]
            at = rank >> 8
            self.words[at] = self.words.get(at, 0) | 1 << (rank & 255)
            self.top |= 1 << at

    def drain(self) -> Iterator[tuple[int, np.ndarray]]:
        """(rank, its positions in order) until the queue is empty; what is pushed meanwhile comes in its turn."""
        while top := self.top:
            first = top & -top
            at = first.bit_length() - 1
            word = self.words[at]
            bit = word & -word
            rank = at << 8 | bit.bit_length() - 1
            self.words[at] = word = word ^ bit
            if not word:
                self.top = top ^ first
            bucket = self.buckets.pop(rank)
            yield rank, bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))


class BytePairs:
    """Encoder and decoder of a vocabulary of ranks; a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.latin, self.beyond = latin_pattern(pattern), re.compile(f"[^\\u0000-\\u{LATIN - 1:04x}]")
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_size = np.array([len(t) for t in tokens], np.int64)
        self.token_at = np.append(0, np.cumsum(self.token_size))
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # the rank of every two tokens whose joined bytes are a token
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pair_keys = np.array([*[k for k, _ in pairs], 1 << 62], np.int64)
        self.pair_ranks = np.array([*[r for _, r in pairs], -1], np.int32)
        self.forget()

    # ------------------------------------------------------------ merging

    def _joined(self, left, right) -> np.ndarray:
        """Ranks of neighbouring parts' joined bytes, -1 where these are no token."""
        key = np.asarray(left, np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has), for non-empty pieces that are encoded each by itself.

        In a piece, again and again the leftmost of the neighbours whose joined bytes have the least rank are joined. Parts
        of all pieces are one linked list over byte positions: after[i] is where the part that begins at i ends, before[i]
        where the part left of it begins. The queue gives the positions of one rank at once; those whose pair has another
        rank by now are stale and skipped. They are joined together if no join makes a pair of a lower rank, which would
        have its turn first; else the first of each piece is, and the others go back. Every join enters at most two pairs,
        so a piece of n bytes takes O(n) entries.
        """
        if not pieces:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        size = np.array([len(p) for p in pieces], np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        edge = np.zeros(n + 1, bool)
        edge[np.append(0, np.cumsum(size))] = True
        part, alive = self.byte_ids[raw], np.ones(n, bool)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        pair = np.append(self._joined(part[:-1], part[1:]), -1).astype(np.int32)
        pair[edge[1:]] = -1
        queue = RankQueue()
        queue.push(pair, np.arange(n, dtype=np.int32))
        for rank, at in queue.drain():
            live = at = at[pair[at] == rank]
            if len(at) > 1:
                linked = at[1:] == after[at[:-1]]
                if linked.any():  # of pairs that share a part the first counts, then the third, ...
                    place = np.arange(len(at))
                    place -= np.maximum.accumulate(np.where(np.append(False, linked), 0, place))
                    at = at[place % 2 == 0]
            while len(at):
                middle = after[at]
                end = after[middle]
                right, left = ~edge[end], ~edge[at]
                # a left neighbour may be joined in the same step
                met = np.append(False, end[:-1] == at[1:]) & left
                start = np.where(met, np.append(0, at[:-1]), before[at])
                after_join, before_join = np.full(len(at), -1, np.int32), np.full(len(at), -1, np.int32)
                after_join[right] = self._joined(rank, part[end[right]])
                before_join[left] = self._joined(np.where(met[left], rank, part[start[left]]), rank)
                if len(at) == 1 or not (((after_join >= 0) & (after_join < rank)) | ((before_join >= 0) & (before_join < rank))).any():
                    break
                owner = np.cumsum(edge[:n])[at]
                first = np.append(True, owner[1:] != owner[:-1])
                if first.all():
                    break
                queue.push(np.full(len(live), rank), live)
                at = at[first]
            if not len(at):
                continue
            part[at], after[at], pair[middle], alive[middle] = rank, end, -1, False
            before[end[right]] = at[right]
            pair[at] = after_join
            pair[start[left]] = before_join[left]
            queue.push(np.concatenate([after_join, before_join]), np.concatenate([at, start.astype(np.int32)]))
        return part[alive], np.add.reduceat(alive, np.cumsum(size) - size, dtype=np.int64)

    # ------------------------------------------------------------ texts

    def forget(self) -> None:
        self.number: dict[str, int] = _Numbers()
        self.ids, self.size, self.at = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self) -> None:
        """Ids of the pieces that have been numbered since the last time; pieces that are tokens have that id."""
        new = [p.encode("utf-8") for p in self.number.fresh]
        if not new:
            return
        self.number.fresh = []
        whole = np.array([self.ranks.get(p, -1) for p in new], np.int32)
        ids, size = self.merge([p for p, r in zip(new, whole.tolist(), strict=True) if r < 0])
        sizes = np.ones(len(new), np.int64)
        sizes[whole < 0] = size
        flat = np.repeat(whole, sizes)
        flat[flat < 0] = ids
        self.at = np.concatenate([self.at, np.cumsum(sizes) - sizes + len(self.ids)])
        self.ids, self.size = np.concatenate([self.ids, flat]), np.concatenate([self.size, sizes])

    def _pieces(self, text: str) -> Iterator[str]:
        pattern = self.pattern if self.latin is None or self.beyond.search(text) else self.latin
        if len(text) <= LISTED_CHARS:
            return iter(pattern.findall(text))
        return (m[0] for m in pattern.finditer(text))

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the pieces of each text."""
        return [np.fromiter(map(self.number.__getitem__, self._pieces(t)), np.int32) for t in texts]

    def ids_of(self, pieces: np.ndarray) -> np.ndarray:
        """Ids of numbered pieces; new ones are merged first, all together, each once."""
        self._learn()
        size = self.size[pieces]
        shift = self.at[pieces] - (np.cumsum(size) - size)
        return self.ids[np.repeat(shift, size) + np.arange(size.sum())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, each match of the pattern encoded by itself."""
        if len(self.number) > KNOWN_PIECES:
            self.forget()
        return [self.ids_of(x) for x in self.numbers(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids; an id that the vocabulary lacks is an error."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.token_size) and self.token_size[ids].all()):
            raise ValueError("ids beyond the vocabulary")
        size = self.token_size[ids]
        shift = self.token_at[ids] - (np.cumsum(size) - size)
        return self.token_bytes[np.repeat(shift, size) + np.arange(size.sum())].tobytes()


class _Numbers(dict):
    """Numbers of pieces in the order in which they are met; `fresh` are those whose ids are not known yet."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = out = len(self)
        self.fresh.append(piece)
        return out


@lru_cache(2)
def byte_pairs(ranks: str, pattern: str) -> BytePairs:
    """One encoder a worker, with what it remembers, for all the tasks that the worker runs."""
    return BytePairs(read_ranks(ranks), pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ids (array of int).

    ranks is the path of a vocabulary that every executor has, pattern what cuts a text into pieces. Whole texts are
    encoded without special tokens; null and empty texts have no ids. Rows that repeat are encoded each. An empty table gives
    no rows; other columns of docs are not read. Nothing is shuffled; a worker holds a slice of texts or one text, the
    numbers of HELD_PIECES pieces besides it, and the ids of some KNOWN_PIECES distinct ones.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))

    def run(batches):
        pairs = byte_pairs(ranks, pattern)
        held: list[tuple[pa.Array, list[np.ndarray]]] = []

        def rows():
            for column, numbers in held:
                found = [pairs.ids_of(x) for x in numbers]
                edges = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([column, ids], names=[id_col, "ids"])
            held.clear()
            if len(pairs.number) > KNOWN_PIECES:
                pairs.forget()

        pieces = 0
        for b in slices(batches, ROWS):
            held.append((b.column(0), pairs.numbers([t or "" for t in b.column(1).to_pylist()])))
            pieces += sum(map(len, held[-1][1]))
            if pieces >= HELD_PIECES or len(pairs.number.fresh) >= NEW_PIECES:
                yield from rows()
                pieces = 0
        yield from rows()

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of encoded: id, ids, bytes (binary). Null ids give null; an id that the vocabulary lacks is an error."""
    small_batches(encoded.sparkSession)
    kind = encoded.schema[id_col].dataType.simpleString()
    narrow = encoded.select(encoded[id_col].alias("_id"), encoded[ids_col].cast("array<int>").alias("_ids"))

    def run(batches):
        pairs = byte_pairs(ranks, pattern)
        for b in slices(batches, ROWS):
            flat, edge = b.column(1).flatten().to_numpy(), np.append(0, np.cumsum(np.asarray(b.column(1).value_lengths().fill_null(0))))
            valid = b.column(1).is_valid().to_pylist()
            out = [pairs.decode(flat[lo:hi]) if ok else None for lo, hi, ok in zip(edge[:-1], edge[1:], valid, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=[id_col, "ids", "bytes"])

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, bytes binary")
