"""Keywords of clusters by mean TF-IDF weight."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.sources.shared import stored
from broadsheet.sources.store import SliceStore

TOKEN = r"[\p{L}\p{N}_]{2,}"
FEATURES, LEAST_DOCS = 5000, 2
#: Terms that a task adds up before it sends them, characters of a slice a task, and second words that a task holds.
HELD, CHARS_A_TASK, SECOND = 200_000, 4_000_000, 50_000
#: German articles that a noun may be shown with.
GERMAN_ARTICLES = ("der", "die", "das", "den", "dem", "des")


def whole(docs: DataFrame) -> DataFrame:
    """(doc_id, parts): one row a document, with cluster and words of each of its rows; a part's words are one text, joined by spaces.

    Texts are shuffled once, and all that is counted of a document is counted within its row.
    """
    words = F.array_join(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(TOKEN), F.lit(0)), " ")
    return docs.select("doc_id", F.struct("cluster", words.alias("words")).alias("part")).groupBy("doc_id").agg(F.collect_list("part").alias("parts"))


def _documents(b: pa.RecordBatch):
    """(doc_id, [(cluster, lists of words)]) of rows of whole()."""
    for doc_id, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
        of: dict = {}
        for x in parts:
            of.setdefault(x["cluster"], []).append(x["words"].split(" ") if x["words"] else [])
        yield doc_id, list(of.items())


def _pairs(words: list[str], first: frozenset | None = None, second: frozenset | None = None) -> list[str]:
    """Pairs of neighbouring words; first and second: the words that may stand there, None for any."""
    both = zip(words, words[1:], strict=False)
    if first is None:
        return [f"{a} {b}" for a, b in both]
    return [f"{a} {b}" for a, b in both if a in first and (second is None or b in second)]


def counted(docs: DataFrame, of: Callable[[list[str]], list[str]], partitions: int | None = None) -> DataFrame:
    """(term, df, total) of the terms that `of` makes of a list of words; docs come from whole().

    A task adds up as many as HELD terms before it sends them. partitions: how many the sums are made in; they are made
    behind the shuffle alone then, so that no task holds more than its share of the terms.
    """

    def run(batches):
        dfs, totals = Counter(), Counter()

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([dfs[t] for t in totals], pa.int64()), pa.array(list(totals.values()), pa.int64())], names=["term", "df", "total"])

        for _, clusters in chain.from_iterable(map(_documents, batches)):
            for _, lists in clusters:
                got = Counter(chain.from_iterable(map(of, lists)))
                dfs.update(got.keys())
                totals.update(got)
            if len(totals) > HELD:
                yield sent()
                dfs, totals = Counter(), Counter()
        if totals:
            yield sent()

    rows = docs.mapInArrow(run, "term string, df bigint, total bigint")
    if partitions:
        rows = rows.repartition(partitions, "term")
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


class TermCounts:
    """Document frequencies of a corpus that grows: a table of (slice, term, df, total), a slice a day, say.

    A slice is counted once, when it comes; one that comes again takes the place of what was counted, and an empty one
    clears it. Weights read sums over slices and never the texts of earlier ones. The term '' counts a slice's documents.
    A document is in one slice: rows of one id in one slice are one document for its terms.
    """

    SCHEMA = "term string, df bigint, total bigint, slice string"

    def __init__(self, spark: SparkSession, path: str):
        self.store = SliceStore(spark, path, ("slice",))

    def put(self, docs: DataFrame, slices: list[str], slice_col: str = "slice") -> None:
        """Count the documents (doc_id, text, slice) of the slices named; documents of others are not read, null texts have no terms."""
        of = F.col(slice_col).cast("string")
        for s in slices:
            rows = docs.filter(of == s).select("doc_id", F.lit(s).alias("cluster"), "text")
            n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
            # the number of a slice's terms grows with its text, and so does the number of tasks that sum them
            counts = counted(whole(rows), lambda w: w + _pairs(w), max(1, -(-chars // CHARS_A_TASK)))
            every = rows.sparkSession.createDataFrame([("", n, 0)] if n else [], "term string, df bigint, total bigint")
            self.store.replace(counts.unionByName(every).withColumn("slice", F.lit(s)), [{"slice": s}])

    def rows(self) -> DataFrame:
        return self.store.rows(self.SCHEMA)


def _top(df: DataFrame, features: int, least: int) -> DataFrame:
    return df.filter(F.col("df") >= least).orderBy(F.col("total").desc(), "term").limit(features)


def vocabulary(words: DataFrame, pairs: Callable[[frozenset, frozenset | None], DataFrame], features: int, least: int) -> dict[str, int]:
    """{term: df} of the `features` terms of the highest total, then the first by text, that are in at least `least` documents.

    A word occurs wherever a pair that it begins does and comes before it by text, so it ranks before the pair: only pairs that
    begin with one of the first `features` words can be among the first `features` terms. Their second word has at least the
    total of the last of these words, a restriction that is left out where more than SECOND words have it. So pairs are
    counted of frequent words alone, and no other pair is shuffled; the terms are the same.
    """
    top = _top(words, features, least).collect()
    enough = words.filter((F.col("df") >= least) & (F.col("total") >= (top[-1]["total"] if len(top) == features else 0)))
    second = [r["term"] for r in enough.select("term").limit(SECOND + 1).collect()]
    more = _top(pairs(frozenset(r["term"] for r in top), frozenset(second) if len(second) <= SECOND else None), features, least).collect()
    # by bytes, as Spark orders texts
    return {r["term"]: r["df"] for r in sorted(top + more, key=lambda r: (-r["total"], r["term"].encode()))[:features]}


def weights(docs: DataFrame, features: int = FEATURES, least: int = LEAST_DOCS, counts: DataFrame | None = None) -> DataFrame:
    """(doc_id, cluster, term, weight): (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), each document's weights of norm 1.

    The vocabulary is the `features` terms of the highest total count that are in at least `least` documents. Frequencies are
    those of docs, or with `counts`, the rows of a TermCounts, those of its corpus, in which docs may be a day alone.
    """
    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "cluster")}
    texts = stored(whole(docs), "keyword-texts")  # read for the words, for the pairs and for the weights
    if counts is None:
        known = stored(counted(texts, lambda w: w), "keyword-counts")
        pairs = lambda a, b: counted(texts, lambda w: _pairs(w, a, b))
        n = docs.count()
    else:
        summed = lambda rows: rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        known = stored(summed(counts.filter("term <> '' and not contains(term, ' ')")), "keyword-counts")
        part = lambda i: F.split_part("term", F.lit(" "), F.lit(i))

        def pairs(a, b):
            rows = counts.filter("contains(term, ' ')")
            for i, side in ((1, a), (2, b)):
                if side is not None:
                    one = counts.sparkSession.createDataFrame([(w,) for w in sorted(side)], f"_w{i} string")
                    rows = rows.join(F.broadcast(one), part(i) == F.col(f"_w{i}"), "left_semi")  # bounded by `features` rows and SECOND
            return summed(rows)

        n = counts.filter("term = ''").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    idf = {t: math.log((1 + n) / (1 + df)) + 1 for t, df in vocabulary(known, pairs, features, least).items()}
    names = ["doc_id", "cluster", "term", "weight"]
    first = frozenset(t.partition(" ")[0] for t in idf if " " in t)

    def run(batches):
        for b in batches:
            types = [b.schema.field(0).type, b.schema.field(1).type.value_type.field("cluster").type, pa.string(), pa.float64()]
            rows = []
            for doc_id, clusters in _documents(b):
                of = []
                for cluster, lists in clusters:
                    tf = Counter(t for words in lists for t in chain(words, _pairs(words, first)) if t in idf)
                    of += [(doc_id, cluster, t, (1 + math.log(k)) * idf[t]) for t, k in tf.items()]
                norm = math.sqrt(math.fsum(w * w for *_, w in of))
                rows += [(i, c, t, w / norm) for i, c, t, w in of]
                if len(rows) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return texts.mapInArrow(run, f"doc_id {kinds['doc_id']}, cluster {kinds['cluster']}, term string, weight double")


def top_keywords(docs: DataFrame, stopwords: list[str], k: int = 8, counts: DataFrame | None = None) -> DataFrame:
    """The k informative terms of each cluster with the highest mean weight; ties by term. counts: see weights.

    A word must be no stopword; a pair must have one that is none.
    """
    w = weights(docs, counts=counts)
    sizes = docs.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"))
    mean = w.groupBy("cluster", "term").agg(F.sum("weight").alias("s")).join(sizes, "cluster").select("cluster", "term", (F.col("s") / F.col("docs")).alias("weight"))
    stop = F.array(*map(F.lit, stopwords)) if stopwords else F.array().cast("array<string>")
    informative = F.exists(F.split("term", " "), lambda t: ~F.array_contains(stop, t))
    # rounded, so that sums in another order rank alike
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.round("weight", 9).desc(), "term"))
    return mean.filter(informative).withColumn("rank", rank).filter(F.col("rank") <= k)


def german_phrases(ranked: DataFrame, pairs: DataFrame, stopwords: list[str]) -> DataFrame:
    """ranked (cluster, term, rank) with bare nouns replaced by the pair of an article and the noun that the cluster has.

    Of several pairs of a noun the first by text counts; a phrase is kept at its first rank.
    """
    split = F.split("term", " ")
    phrases = pairs.filter((F.size(split) == 2) & split[0].isin(*GERMAN_ARTICLES) & ~split[1].isin(*(stopwords or [""])))
    phrases = phrases.groupBy("cluster", split[1].alias("noun")).agg(F.min("term").alias("phrase"))
    out = ranked.join(phrases.withColumnRenamed("noun", "term"), ["cluster", "term"], "left").select("cluster", F.coalesce("phrase", "term").alias("term"), "rank")
    return out.groupBy("cluster", "term").agg(F.min("rank").alias("rank"))


SQL = r"""
WITH words AS (SELECT doc_id, lang AS cluster, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
all_terms AS (SELECT doc_id, cluster, unnest(w) AS term FROM words UNION ALL
  SELECT doc_id, cluster, unnest(list_transform(list_zip(w[:-2], w[2:]), lambda x: x[1] || ' ' || x[2])) FROM words WHERE len(w) > 1),
tf AS (SELECT doc_id, cluster, term, count(*) AS tf FROM all_terms GROUP BY ALL),
voc AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 5000),
raw AS (SELECT doc_id, cluster, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN voc USING (term)),
wt AS (SELECT doc_id, cluster, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw),
sz AS (SELECT lang AS cluster, count(*) AS docs FROM documents GROUP BY 1),
mean AS (SELECT cluster, term, sum(weight) / any_value(docs) AS weight FROM wt JOIN sz USING (cluster) GROUP BY ALL),
r AS (SELECT cluster, term, weight, row_number() OVER (PARTITION BY cluster ORDER BY round(weight, 9) DESC, term) AS rank FROM mean
  WHERE len(list_filter(string_split(term, ' '), lambda x: x NOT IN ('the', 'and', 'les', 'der', 'de', 'la'))) > 0)
SELECT cluster, term, round(weight, 6) AS weight, rank FROM r WHERE rank <= 8
"""
