"""Lemmas by the longest rewritable ending, and parts of speech by a Viterbi tagger fitted from counts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.operators.collocations import DAY, LEAST_COUNT, LEAST_LETTERS, MENTION, WINDOW, sentences

#: Languages of countries.
LANGUAGE = {"DE": "de", "UK": "en", "US": "en", "FR": "fr", "ES": "es", "IT": "it", "TR": "tr"}
#: Letters that an ending must leave.
STEM = 3
#: Endings that inflection adds, and what stands there instead, by language.
ENDINGS = {
    "en": {"s": "", "es": "e", "ies": "y", "sses": "ss", "ches": "ch", "shes": "sh", "xes": "x", "ed": "", "ied": "y", "ing": "", "ings": "ing", "tions": "tion", "ness": "", "ss": "ss", "us": "us"},
    "de": {"e": "", "en": "", "er": "", "es": "", "em": "", "ern": "er", "ungen": "ung", "heiten": "heit", "keiten": "keit", "innen": "in", "ten": "t", "st": ""},
    "fr": {"s": "", "x": "", "es": "e", "ées": "é", "aux": "al", "eaux": "eau", "tions": "tion", "ements": "ement", "euses": "eux", "ives": "if", "ait": "er", "aient": "er"},
    "es": {"s": "", "es": "e", "ciones": "ción", "ces": "z", "as": "a", "os": "o", "ando": "ar", "iendo": "er", "aron": "ar"},
    "it": {"i": "o", "zioni": "zione", "ità": "ità", "he": "a", "hi": "o", "ando": "are", "endo": "ere"},
    "tr": {"lar": "", "ler": "", "ları": "", "leri": "", "larda": "", "lerde": "", "lardan": "", "lerden": "", "da": "", "de": "", "dan": "", "den": ""},
}

#: Parts of speech; the first is what an unknown word most likely is.
TAGS = ("NOUN", "VERB", "ADJ", "ADV", "DET", "ADP", "PRON", "CCONJ", "NUM", "PROPN", "X")
#: Words of closed classes by language.
CLOSED = {
    "en": {"DET": "the a an this that these those", "ADP": "of in on at by for with from to as into", "PRON": "he she it they we you i who which", "CCONJ": "and or but", "VERB": "is are was were be has have had will"},
    "de": {"DET": "der die das den dem des ein eine einen einem einer", "ADP": "in auf an mit von zu für über nach bei aus", "PRON": "er sie es wir ihr ich wer", "CCONJ": "und oder aber", "VERB": "ist sind war hat haben wird werden", "ADV": "nicht auch"},
    "fr": {"DET": "le la les un une des ce cette ces", "ADP": "de du à dans par pour sur avec en", "PRON": "il elle ils elles nous vous je qui que", "CCONJ": "et ou mais", "VERB": "est sont était a ont sera"},
    "es": {"DET": "el la los las un una unos unas este esta", "ADP": "de en a por para con sobre del al", "PRON": "él ella ellos nosotros yo que quien", "CCONJ": "y o pero", "VERB": "es son era ha han será"},
}
#: Endings that tell an open class where no count does, the longest first.
TELLING = {
    "en": (("ing", "VERB"), ("ed", "VERB"), ("ly", "ADV"), ("ous", "ADJ"), ("ful", "ADJ"), ("ble", "ADJ"), ("ive", "ADJ")),
    "de": (("lich", "ADJ"), ("isch", "ADJ"), ("ig", "ADJ"), ("ieren", "VERB"), ("te", "VERB")),
    "fr": (("ment", "ADV"), ("eux", "ADJ"), ("ique", "ADJ"), ("er", "VERB"), ("ait", "VERB")),
    "es": (("mente", "ADV"), ("oso", "ADJ"), ("ando", "VERB"), ("iendo", "VERB"), ("ar", "VERB")),
}
#: Letters of a word's end that the tagger counts, features that are kept a language, and what each count starts from.
FEATURE_LETTERS, FEATURES, SMOOTH = 3, 20_000, 0.1
#: Words that a task remembers a language, words that it tags at once, and from how many sentences on a step takes a tag at a time.
KNOWN, WORDS, MANY = 100_000, 1 << 18, 64
#: Parts of speech that collocates may have.
KEPT = ("NOUN", "VERB", "ADJ", "PROPN")


# ---------------------------------------------------------------- lemmas


class SuffixTrie:
    """Endings read from a word's last letter on; a node that ends one holds what it is rewritten to."""

    def __init__(self, endings: dict[str, str], stem: int = STEM):
        self.root, self.stem = {}, stem
        for ending, instead in endings.items():
            node = self.root
            for c in reversed(ending):
                node = node.setdefault(c, {})
            node[""] = instead

    def lemma(self, word: str) -> str:
        """The word with its longest ending that leaves `stem` letters rewritten, or as it is."""
        node, best = self.root, word
        for i in range(len(word) - 1, self.stem - 1, -1):
            node = node.get(word[i])
            if node is None:
                break
            if "" in node:
                best = word[:i] + node[""]
        return best


def language_of(country: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in LANGUAGE.items() for x in pair]), country), F.lit(""))


def lemma_table(articles: DataFrame, endings: dict[str, dict[str, str]] | None = None, stem: int = STEM) -> DataFrame:
    """(language, word, lemma, n): every lower-case word of the texts. Words are counted first, so each is looked up once."""
    words = sentences(articles).select(language_of(F.col("country_code")).alias("language"), F.explode("words").alias("w"))
    counted = words.groupBy("language", F.lower("w").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    tables = ENDINGS if endings is None else endings

    def run(batches):
        tries = {k: SuffixTrie(v, stem) for k, v in tables.items()}
        none = SuffixTrie({}, stem)
        for b in batches:
            lemmas = [tries.get(k, none).lemma(w) for k, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lemmas, pa.string()), b.column(2)], names=["language", "word", "lemma", "n"])

    return counted.mapInArrow(run, "language string, word string, lemma string, n bigint")


# ---------------------------------------------------------------- tags


@dataclass
class TagModel:
    """Log probabilities: first[language] of tags, moves[language] of tag after tag, and of features by tag."""

    first: dict[str, np.ndarray]
    moves: dict[str, np.ndarray]
    features: dict[str, dict[str, np.ndarray]]
    unknown: np.ndarray


def feature(word: str, place: int) -> str:
    """What the tagger sees of an open-class word: its shape and its last letters."""
    if word[:1].isdigit():
        return "0"
    shape = "A" if word[:1].isupper() and place else "a"
    return shape + word[-FEATURE_LETTERS:].lower()


_CLOSED = {k: {w: TAGS.index(t) for t, ws in v.items() for w in ws.split()} for k, v in CLOSED.items()}


def seed(word: str, place: int, language: str) -> int:
    """A word's tag by rules: closed class, number, capital inside a sentence (not in German), telling ending, else NOUN."""
    low = word.lower()
    known = _CLOSED.get(language, {}).get(low)
    if known is not None:
        return known
    if word[:1].isdigit():
        return TAGS.index("NUM")
    if place and word[:1].isupper() and language != "de":
        return TAGS.index("PROPN")
    for ending, tag in TELLING.get(language, ()):
        if low.endswith(ending) and len(low) - len(ending) >= STEM:
            return TAGS.index(tag)
    return 0


def viterbi(emissions: np.ndarray, lengths: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The likeliest tags of many sentences at once; ties go to the tag that comes first in TAGS.

    emissions: a row of log probabilities by tag for each word, sentence after sentence. Sentences are taken from the longest
    on, so those that have ended drop out at the end of the arrays, and a step is one operation for all of them.
    """
    out = np.zeros(len(emissions), np.int8)
    lengths = np.asarray(lengths)
    if not len(emissions):
        return out
    order = np.argsort(-lengths, kind="stable")
    start, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
    live = int((size > 0).sum())
    start, size = start[:live], size[:live]
    kinds = len(moves)
    back = np.zeros((kinds, len(emissions)), np.int8)
    score = np.ascontiguousarray((first + emissions[start]).T)  # a row a tag, so that operations run along the sentences
    last = np.empty(live, np.int8)
    for t in range(1, int(size[0]) + 1):
        now = int(np.searchsorted(-size, -t, side="left"))  # sentences of more than t words
        last[now : score.shape[1]] = score[:, now:].argmax(axis=0)
        if now == 0:
            break
        if now < MANY:
            ways = score[:, None, :now] + moves[:, :, None]
            best, top = ways.argmax(axis=0), ways.max(axis=0)
        else:  # the same sums, a tag at a time
            top, best = score[0, :now] + moves[0][:, None], np.zeros((kinds, now), np.int8)
            for i in range(1, kinds):
                way = score[i, :now] + moves[i][:, None]
                np.copyto(best, i, where=way > top)
                np.maximum(top, way, out=top)
        back[:, start[:now] + t] = best
        score = top + emissions[start[:now] + t].T
    tag = last
    out[start + size - 1] = tag
    for t in range(int(size[0]) - 1, 0, -1):
        now = int(np.searchsorted(-size, -t, side="left"))
        tag = tag.copy()
        tag[:now] = back[tag[:now], start[:now] + t]
        out[start[:now] + t - 1] = tag[:now]
    return out


class Lexicon:
    """What a task knows of the different words that it has met: tags by rules (or rows of emissions, with a model) and features
    of a word that begins its sentence and of one that does not, and lemmas. It forgets a language's words beyond KNOWN."""

    def __init__(self, model: TagModel | None = None, endings: dict[str, dict[str, str]] | None = None):
        self.model, self.none = model, SuffixTrie({})
        self.tries = {k: SuffixTrie(v) for k, v in (ENDINGS if endings is None else endings).items()}
        self.known: dict[str, dict[str, tuple]] = {}
        self.tables: dict[str, tuple[dict[str, int], np.ndarray]] = {}

    def _table(self, language: str) -> tuple[dict[str, int], np.ndarray]:
        """Rows by feature, and log probabilities: of fixed tags, of features, of unknown ones in the last row."""
        if language not in self.tables:
            fixed = np.full((len(TAGS), len(TAGS)), -1e3)
            np.fill_diagonal(fixed, 0.0)
            features = self.model.features.get(language, {})
            self.tables[language] = {f: len(TAGS) + i for i, f in enumerate(features)}, np.array([*fixed, *features.values(), self.model.unknown])
        return self.tables[language]

    def entries(self, language: str, words: list[str]) -> list[tuple]:
        """(code, code, feature, feature, lemma) of words: the first of two at a sentence's beginning, the second elsewhere."""
        known = self.known.setdefault(language, {})
        if len(known) > KNOWN:
            known.clear()
        closed, lemma = _CLOSED.get(language, {}), self.tries.get(language, self.none).lemma
        rows, table = self._table(language) if self.model else ({}, ())
        unknown, out = len(table) - 1, []
        for w in words:
            e = known.get(w)
            if e is None:
                low, f = w.lower(), feature(w, 0)
                g = feature(w, 1) if w[0].isupper() else f  # else neither feature nor tag depends on the place
                x = y = closed.get(low)
                if x is None:
                    x = rows.get(f, unknown) if self.model else seed(w, 0, language)
                    y = x if g is f else rows.get(g, unknown) if self.model else seed(w, 1, language)
                e = known[w] = x, y, f, g, lemma(low)
            out.append(e)
        return out

    def tags(self, language: str, piece: Piece, entries: list[tuple]) -> np.ndarray:
        """Tags of a piece's words: by the rules where there is no model."""
        codes = np.fromiter((c for e in entries for c in e[:2]), np.int32, 2 * len(entries))[piece.which]
        if self.model is None:
            return codes
        plain = np.full(len(TAGS), -np.log(len(TAGS)))
        first, moves = self.model.first.get(language, plain), self.model.moves.get(language, np.tile(plain, (len(TAGS), 1)))
        return viterbi(self._table(language)[1][codes], piece.lengths, first, moves)


@dataclass
class Piece:
    """Sentences of one language: their rows in the batch, how many words they have, the different words in them, and for each
    word twice its place among those, plus one where it does not begin its sentence."""

    rows: np.ndarray
    lengths: np.ndarray
    words: list[str]
    which: np.ndarray


def pieces(b: pa.RecordBatch) -> Iterable[tuple[str, Piece]]:
    """(language, piece) of a batch with columns language and words, about WORDS words at a time, or one sentence."""
    names = b.schema.names
    spoken, listed = b.column(names.index("language")).dictionary_encode(), b.column(names.index("words"))
    lengths = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = pc.fill_null(spoken.indices, -1).to_numpy(zero_copy_only=False)
    for code in np.unique(codes):
        mine = np.flatnonzero(codes == code)
        part = (np.cumsum(lengths[mine]) - 1) // WORDS
        for rows in np.split(mine, np.flatnonzero(np.diff(part)) + 1):
            words = listed.take(pa.array(rows)).flatten().dictionary_encode()
            which = 2 * words.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
            n = lengths[rows]
            which[(np.cumsum(n) - n)[n > 0]] -= 1
            yield (spoken.dictionary[int(code)].as_py() if code >= 0 else ""), Piece(rows, n, words.dictionary.to_pylist(), which)


def _summed(counts: dict[tuple[str, str, int], int], names: list[str]) -> pa.RecordBatch:
    """Counts by (language, text, tag) as rows."""
    keys = list(counts)
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in keys], pa.string()), pa.array([x[1] for x in keys], pa.string()), pa.array([x[2] for x in keys], pa.int32()), pa.array(list(counts.values()), pa.int64())], names=names)


def fit_tags(tokens: DataFrame, rounds: int = 1, features: int = FEATURES) -> TagModel:
    """A tagger from counts over all sentences (language, words): of the tags that the rules give, then, `rounds` - 1 times,
    of those that the tagger so far gives.

    A task sends its counts, one row a pair of tags or a feature and tag. Of features the `features` most frequent of a language
    are kept, which bounds the model; others count as unknown. Closed-class words keep their tags.
    """
    none = np.full(len(TAGS), -np.log(len(TAGS)))
    model = None
    for _ in range(max(1, rounds)):
        before = model

        def run(batches, before=before):
            counts: dict[tuple[str, str, int], int] = {}
            lexicon, kinds = Lexicon(before, {}), len(TAGS)
            for b in batches:
                for k, piece in pieces(b):
                    entries = lexicon.entries(k, piece.words)
                    tags = lexicon.tags(k, piece, entries).astype(np.int64)
                    n = np.bincount(piece.which * kinds + tags)
                    for at in np.flatnonzero(n).tolist():
                        word, inside = divmod(at // kinds, 2)
                        key = k, entries[word][2 + inside], at % kinds
                        counts[key] = counts.get(key, 0) + int(n[at])
                    last = np.append(-1, tags[:-1]) if len(tags) else tags
                    last[piece.which % 2 == 0] = -1
                    n = np.bincount((last + 1) * kinds + tags)
                    for at in np.flatnonzero(n).tolist():
                        key = k, f"\t{at // kinds - 1}", at % kinds
                        counts[key] = counts.get(key, 0) + int(n[at])
            yield _summed(counts, ["language", "what", "tag", "n"])

        summed = tokens.select("language", "words").mapInArrow(run, "language string, what string, tag int, n bigint").groupBy("language", "what", "tag").agg(F.sum("n").alias("n"))
        grouped = summed.groupBy("language", "what").agg(F.sum("n").alias("total"), F.collect_list(F.struct("tag", "n")).alias("by"))  # at most one entry a tag
        move = F.col("what").startswith("\t")
        order = Window.partitionBy("language", move).orderBy(F.col("total").desc(), "what")
        first, moves, known = {}, {}, {}
        totals: dict[str, np.ndarray] = {}
        for r in grouped.withColumn("rank", F.row_number().over(order)).filter(move | (F.col("rank") <= features)).collect():
            n = np.full(len(TAGS), SMOOTH)
            for x in r["by"]:
                n[x["tag"]] += x["n"]
            if not r.what.startswith("\t"):
                known.setdefault(r.language, {})[r.what] = n
                totals[r.language] = totals.get(r.language, 0) + n
            elif r.what == "\t-1":
                first[r.language] = np.log(n / n.sum())
            else:
                moves.setdefault(r.language, np.tile(none, (len(TAGS), 1)))[int(r.what[1:])] = np.log(n / n.sum())
        features_of = {k: {f: np.log(n / totals[k]) for f, n in v.items()} for k, v in known.items()}
        model = TagModel(first, moves, features_of, none)
    return model


def tagged(tokens: DataFrame, model: TagModel, endings: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """tokens (id, day, sentence, language, words) with lemmas and tags, arrays beside words. One pass, nothing shuffled."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields)
    kind = pa.list_(pa.string())

    def run(batches):
        lexicon, names = Lexicon(model, endings), pa.array(TAGS, pa.string())
        for b in batches:
            rows, parts = [], []
            for k, piece in pieces(b):
                entries = lexicon.entries(k, piece.words)
                offsets = pa.array(np.append(0, np.cumsum(piece.lengths)), pa.int32())
                lemmas = pa.array([e[-1] for e in entries], pa.string()).take(pa.array(piece.which // 2))
                rows.append(piece.rows)
                parts.append([pa.ListArray.from_arrays(offsets, x) for x in (lemmas, names.take(pa.array(lexicon.tags(k, piece, entries))))])
            back = pa.array(np.argsort(np.concatenate(rows), kind="stable")) if rows else None
            both = [pa.concat_arrays(x).take(back) for x in zip(*parts, strict=True)] if rows else [pa.array([], kind)] * 2
            yield pa.RecordBatch.from_arrays([*b.columns, *both], names=[*b.schema.names, "lemmas", "tags"])

    return tokens.mapInArrow(run, f"{schema}, lemmas array<string>, tags array<string>")


def tag_counts(tokens: DataFrame, model: TagModel, endings: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """(language, lemma, pos, n): how often tagged() gives a lemma and tag. A task adds up the pairs that it meets, up to KNOWN at
    a time, so neither words nor tags leave it one by one."""

    def run(batches):
        lexicon, counts, kinds = Lexicon(model, endings), {}, len(TAGS)
        for b in batches:
            for k, piece in pieces(b):
                entries = lexicon.entries(k, piece.words)
                n = np.bincount(piece.which // 2 * kinds + lexicon.tags(k, piece, entries))
                for at in np.flatnonzero(n).tolist():
                    key = k, entries[at // kinds][-1], at % kinds
                    counts[key] = counts.get(key, 0) + int(n[at])
            if len(counts) > KNOWN:
                yield _summed(counts, ["language", "lemma", "tag", "n"])
                counts = {}
        yield _summed(counts, ["language", "lemma", "tag", "n"])

    rows = tokens.select("language", "words").mapInArrow(run, "language string, lemma string, tag int, n bigint")
    named = F.element_at(F.array(*map(F.lit, TAGS)), F.col("tag") + 1)
    return rows.groupBy("language", "lemma", named.alias("pos")).agg(F.sum("n").alias("n"))


def lemma_windows(tokens: DataFrame, stopwords: list[str] = (), keep: tuple[str, ...] | None = KEPT, window: int = WINDOW, least: int = LEAST_LETTERS, mention: str = MENTION) -> DataFrame:
    """One row for each kept word within `window` words of a mention in its sentence: country, day, canonical, lemma, pos.

    tokens come from tagged(). A word is kept if its part of speech is in `keep` (None keeps all), its lemma has `least`
    letters and is no stopword; the others use up places.
    """
    t = F.arrays_zip("lemmas", "tags")
    fits = lambda x: (F.length(x["lemmas"]) >= least) & ~x["lemmas"].isin(*(stopwords or [""])) & (F.lit(True) if keep is None else x["tags"].isin(*keep))

    def near(word, at):
        left = F.slice("t", F.greatest(at + 1 - window, F.lit(1)), F.least(at, F.lit(window)))
        return F.when(word.rlike(mention), F.struct(word.alias("canonical"), F.filter(F.concat(left, F.slice("t", at + 2, F.lit(window))), fits).alias("near")))

    found = F.filter(F.transform("words", near), lambda x: x.isNotNull())
    rows = tokens.withColumn("t", t).select("id", *DAY, F.explode(found).alias("m"))
    return rows.select("id", *DAY, "m.canonical", F.explode("m.near").alias("x")).select("id", *DAY, "canonical", F.col("x.lemmas").alias("lemma"), F.col("x.tags").alias("pos"))


def lemma_counts(windows: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """Pairs of each day by lemma and part of speech that occur at least `least` times."""
    return windows.groupBy(*DAY, "canonical", "lemma", "pos").agg(F.count(F.lit(1)).alias("c11")).filter(F.col("c11") >= least)


def tokens_of(articles: DataFrame) -> DataFrame:
    """Sentences with the language of their country."""
    return sentences(articles).withColumn("language", language_of(F.col("country_code")))
