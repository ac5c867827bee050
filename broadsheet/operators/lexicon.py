"""Terms of a lexicon in texts: an Aho-Corasick automaton over words, built once and run over Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most terms of a lexicon: it goes through the driver and to every worker.
MOST = 1_000_000
#: Words are letters, digits, underscores and combining marks; the words of a term may have this between them.
WORD, GAP = r"(?:[^\W]|[̀-ͯ])+", r"[\s'’\-]+"
#: Matches that are handed on at once, and word forms that a worker remembers.
ROWS, FORMS = 8192, 200_000


def folded(word: str, accents: bool = False) -> str:
    """Lower case; without `accents` also the compatibility form without combining marks."""
    if accents:
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.casefold()) if not unicodedata.combining(c)).casefold()


class Automaton:
    """Finds sequences of words in one pass, whatever the number of terms.

    A state is a sequence of words with which some term begins; its fallback is its longest proper ending that is a state,
    and its hit the longest term that it ends with. Terms that fold to the same words are one, the smallest; a term
    without words is left out.
    """

    def __init__(self, terms: Sequence[str], accents: bool = False):
        self.accents, self.terms, self.symbols = accents, [], {}
        self.next: list[dict[int, int]] = [{}]
        self.depth, own = [0], [-1]
        for term in sorted(set(terms)):
            words = [folded(w, accents) for w in re.findall(WORD, term)]
            state = 0
            for word in words:
                sym = self.symbols.setdefault(word, len(self.symbols))
                if sym not in self.next[state]:
                    self.next[state][sym] = len(self.next)
                    self.next.append({})
                    self.depth.append(self.depth[state] + 1)
                    own.append(-1)
                state = self.next[state][sym]
            if words and own[state] < 0:
                own[state] = len(self.terms)
                self.terms.append(term)
        self.own, self.fall, self.hit = own, [0] * len(own), [0] * len(own)  # hit: the state of the longest term, 0 for none
        todo = deque(self.next[0].values())
        for state in todo:
            self.hit[state] = state if own[state] >= 0 else 0
        while todo:
            state = todo.popleft()
            for sym, child in self.next[state].items():
                self.fall[child] = self.step(self.fall[state], sym)
                self.hit[child] = child if own[child] >= 0 else self.hit[self.fall[child]]
                todo.append(child)

    def step(self, state: int, sym: int) -> int:
        while state and sym not in self.next[state]:
            state = self.fall[state]
        return self.next[state].get(sym, 0)

    def longest(self, syms: Sequence[int], breaks: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """(first word, word after the last, term) of leftmost-longest matches that don't overlap."""
        at, state, best, n = 0, 0, None, len(syms)
        while at < n or best:
            if best and (at == n or breaks[at] or at + 1 - self.depth[now := self.step(state, syms[at])] > best[0]):
                yield best
                at, state, best = best[1], 0, None
                continue
            if not best:
                now = self.step(0 if breaks[at] else state, syms[at])
            at, state = at + 1, now
            if self.hit[state]:
                first = at - self.depth[self.hit[state]]
                if best is None or first <= best[0]:
                    best = (first, at, self.own[self.hit[state]])

    def every(self, syms: Sequence[int], breaks: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """The same of all matches, those that overlap too, by end and then from the longest."""
        state = 0
        for at, sym in enumerate(syms):
            state = self.step(0 if breaks[at] else state, sym)
            found = self.hit[state]
            while found:
                yield at + 1 - self.depth[found], at + 1, self.own[found]
                found = self.hit[self.fall[found]]


def find_terms(texts: DataFrame, lexicon: DataFrame, id_cols: Sequence[str], text_col: str = "text", term_col: str = "term", overlapping: bool = False, gap: str | None = GAP, accents: bool = False, most: int = MOST) -> DataFrame:
    """(ids, start, end, surface, term): where terms occur, in code points, the end exclusive; ids repeat with their rows.

    Texts and terms are compared word by word after folding; between two words of a term only what `gap` matches may stand
    (None: anything). Leftmost-longest matches, unless `overlapping` asks for all of them. Null and empty texts and terms
    have none; terms may repeat; other columns aren't read, but an id column must not be named like a result. A lexicon of more than `most`
    terms is an error. Nothing is shuffled: a worker gets the automaton once and holds one batch and the places of one text's words.
    """
    clash = {"start", "end", "surface", "term"} & set(id_cols)
    if clash:
        raise ValueError(f"id columns named like results: {sorted(clash)}")
    listed = [r[0] for r in lexicon.select(F.col(term_col).cast("string")).filter(F.col(term_col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(listed) > most:
        raise ValueError(f"the lexicon has more than {most} terms")
    held = texts.sparkSession.sparkContext.broadcast(Automaton(listed, accents))
    narrow = texts.select(*id_cols, F.col(text_col).cast("string").alias("_text"))
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in id_cols] + ["start int", "end int", "surface string", "term string"])

    def run(batches):
        auto, word, between = held.value, re.compile(WORD), re.compile(gap, re.DOTALL) if gap is not None else None
        search = auto.every if overlapping else auto.longest
        forms: dict[str, int] = {}
        for b in batches:
            rows, found = array("q"), []

            def flush(b=b):
                ids = b.select(list(id_cols)).take(pa.array(rows, pa.int64())).columns if id_cols else []
                start, end, surface, term = zip(*found, strict=True)
                out = pa.RecordBatch.from_arrays([*ids, pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(surface, pa.string()), pa.array(term, pa.string())], names=[*id_cols, "start", "end", "surface", "term"])
                del rows[:], found[:]
                return out

            for i, value in enumerate(b.column(len(id_cols))):
                text = value.as_py()
                if not text:
                    continue
                starts, ends, syms, breaks, last = array("q"), array("q"), array("q"), array("b"), 0
                for m in word.finditer(text):
                    form, first = m.group(), m.start()
                    sym = forms.get(form)
                    if sym is None:
                        sym = auto.symbols.get(folded(form, auto.accents), -1)
                        if len(forms) < FORMS:
                            forms[form] = sym
                    apart = sym < 0 or (between is not None and bool(starts) and not between.fullmatch(text, last, first))
                    starts.append(first)
                    last = m.end()
                    ends.append(last)
                    syms.append(sym)
                    breaks.append(apart)
                for first, after, term in search(syms, breaks):
                    rows.append(i)
                    found.append((starts[first], ends[after - 1], text[starts[first] : ends[after - 1]], auto.terms[term]))
                    if len(found) >= ROWS:
                        yield flush()
            if found:
                yield flush()

    return narrow.mapInArrow(run, schema)
