"""Entity mentions: counts, rankings, resolution, snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.entities import candidate_score, display_name, normal_names


def filled_name() -> Column:
    """The canonical name, or the text where it is null or empty."""
    return F.coalesce(F.nullif(F.col("canonical"), F.lit("")), F.col("entity_text"))


def mention_counts(mentions: DataFrame) -> DataFrame:
    """Mentions by canonical name (null: the text; an empty name stays) and type."""
    return mentions.groupBy(F.coalesce("canonical", "entity_text").alias("name"), "entity_type").agg(F.count(F.lit(1)).alias("mentions"))


def top_entities(mentions: DataFrame, k: int) -> DataFrame:
    """The k names of each type with most mentions; ties by name."""
    counts = mentions.groupBy("entity_type", filled_name().alias("name")).agg(F.count(F.lit(1)).alias("mentions"))
    w = Window.partitionBy("entity_type").orderBy(F.col("mentions").desc(), "name")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def unresolved(mentions: DataFrame, with_normalized: bool) -> DataFrame:
    open_ = F.col("canonical").isNull() | F.col("resolver_method").isNull()
    return mentions.filter(open_ | (F.col("resolver_method") == "normalized") if with_normalized else open_)


def top_unresolved(mentions: DataFrame, k: int) -> DataFrame:
    """Texts without an id that no resolver but the normalizer has met, most frequent first."""
    open_ = mentions.filter(F.col("wikidata_qid").isNull() & (F.col("resolver_method").isNull() | (F.col("resolver_method") == "normalized")))
    return open_.groupBy("entity_text", "entity_type").agg(F.count(F.lit(1)).alias("mentions")).orderBy(F.col("mentions").desc(), "entity_text", "entity_type").limit(k)


def audit_groups(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity_type", filled_name().alias("name"), "entity_text", "wikidata_qid", "resolver_method").agg(F.count(F.lit(1)).alias("mentions"))


def resolution_audit(mentions: DataFrame) -> DataFrame:
    """Per type and name: surface forms, ids, mentions, and whether the merge is suspicious."""
    g = audit_groups(mentions)
    out = g.groupBy("entity_type", "name").agg(
        F.count_distinct("entity_text").alias("aliases"),
        F.count_distinct("wikidata_qid").alias("qids"),
        F.sum("mentions").alias("mentions"),
        F.coalesce(F.max(F.col("resolver_method") == "local_alias"), F.lit(False)).alias("local"),
    )
    suspicious = (F.col("aliases") > 1) & ((F.col("qids") > 1) | ((F.col("aliases") >= 5) & ~F.col("local")))
    return out.withColumn("merged", F.col("aliases") > 1).withColumn("suspicious", suspicious)


def first_per_article(mentions: DataFrame, news: DataFrame, limit: int) -> DataFrame:
    """The first mention of each article, newest articles first."""
    w = Window.partitionBy("article_id").orderBy(F.col("position_in_article").asc_nulls_last(), "mention_id")
    first = mentions.withColumn("rank", F.row_number().over(w)).filter("rank = 1")
    joined = first.join(news.select(F.col("id").alias("article_id"), "source_name", F.col("collected_date").alias("day")), "article_id")
    return joined.orderBy(F.col("day").desc(), "article_id").limit(limit)


def snippets(candidates: DataFrame, lemmas: list[str], most: int = 8) -> DataFrame:
    """Texts ranked by how many of the lemmas they contain; among equals the later-ranked candidate comes first.

    candidates: id, rank (0 for the most recent), text.
    """
    low = F.lower("text")
    matched = F.filter(F.array(*[F.lit(x) for x in lemmas[:15]]), lambda x: low.contains(x)) if lemmas else F.array().cast("array<string>")
    return candidates.withColumn("matched", matched).withColumn("coverage", F.size("matched")).orderBy(F.col("coverage").desc(), F.col("rank").desc(), "id").limit(most)


def typed(mentions: DataFrame, aliases: DataFrame, default: str = "PER") -> DataFrame:
    """mentions with the entity_type that the country's aliases give their name, the first by order, or else the default."""
    known = aliases.groupBy("country_code", normal_names("alias").alias("_key")).agg(F.min_by("entity_type", "ordinal").alias("_type"))
    out = mentions.withColumn("_key", normal_names("entity_text")).join(known, ["country_code", "_key"], "left")
    return out.withColumn("entity_type", F.coalesce("_type", F.lit(default))).drop("_key", "_type")


def canonicalize(mentions: DataFrame, aliases: DataFrame, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Canonical name, id, confidence and method of each mention.

    aliases: country_code, entity_type, alias, canonical, wikidata_qid, ordinal; a later alias of a key takes its place.
    Looked up by type, then as PER, then as ORG, in one table with a map by type for each country and name. Without an alias
    the display form counts, with confidence 0. The table is broadcast if its bytes, which are summed first, are few.
    """
    keyed = aliases.withColumn("key", normal_names("alias")).filter("key <> ''")
    keyed = keyed.groupBy("country_code", "key", "entity_type").agg(F.max_by(F.struct("canonical", "wikidata_qid"), "ordinal").alias("a"))
    lookup = keyed.groupBy("country_code", "key").agg(F.map_from_entries(F.collect_list(F.struct("entity_type", "a"))).alias("by_type"))
    size = keyed.agg(F.sum(100 + F.octet_length("key") + F.octet_length(F.to_json("a")))).first()[0] or 0
    side = F.broadcast(lookup) if size <= broadcast_bytes else lookup
    out = mentions.withColumn("key", normal_names("entity_text")).join(side, ["country_code", "key"], "left")
    hit = F.coalesce(*[F.try_element_at("by_type", k) for k in (F.upper("entity_type"), F.lit("PER"), F.lit("ORG"))])
    return out.select(
        *[c for c in mentions.columns if c not in ("canonical", "wikidata_qid", "resolver_method")],
        F.coalesce(hit["canonical"], display_name(F.col("entity_text"))).alias("canonical"),
        hit["wikidata_qid"].alias("wikidata_qid"),
        F.when(hit.isNotNull(), 1.0).otherwise(0.0).alias("confidence"),
        F.when(hit.isNotNull(), "local_alias").otherwise("normalized").alias("resolver_method"),
    )


def with_cache(mentions: DataFrame, cache: DataFrame) -> DataFrame:
    """Mentions that no alias met take what the cache has for their name, type and country; a cached miss counts too."""
    c = cache.select("country_code", "entity_type", F.col("normalized_text").alias("key"), F.struct("canonical", "wikidata_qid", "confidence").alias("hit"))
    rows = mentions.withColumn("key", normal_names("entity_text")).join(c, ["country_code", "entity_type", "key"], "left")
    use = (F.col("resolver_method") != "local_alias") & F.col("hit").isNotNull()
    return rows.select(
        *[x for x in mentions.columns if x not in ("canonical", "wikidata_qid", "confidence", "resolver_method")],
        *[F.when(use, F.col(f"hit.{x}")).otherwise(F.col(x)).alias(x) for x in ("canonical", "wikidata_qid", "confidence")],
        F.when(use, "cache").otherwise(F.col("resolver_method")).alias("resolver_method"),
    )


def best_candidate(candidates: DataFrame, threshold: float) -> DataFrame:
    """Per key the candidate with the highest score of at least `threshold`; ties go to the first one.

    candidates: key, ordinal, label_raw, and normal forms text, label, aliases, description, type_words, country_terms, qid.
    """
    score = candidate_score(*[F.col(c) for c in ("text", "label", "aliases", "description", "type_words", "country_terms", "qid")])
    w = Window.partitionBy("key").orderBy(F.col("score").desc(), "ordinal")
    best = candidates.withColumn("score", score).withColumn("rank", F.row_number().over(w)).filter(f"rank = 1 and score >= {threshold}")
    return best.select("key", F.coalesce("label_raw", "text").alias("canonical"), F.col("qid").alias("wikidata_qid"), F.round("score", 4).alias("confidence"), F.lit("wikidata").alias("resolver_method"))


def ref_filter(ref: str) -> Column:
    """Q and digits is an id, all else a name."""
    return F.col("wikidata_qid") == ref if ref[:1] == "Q" and ref[1:].isdigit() else filled_name() == ref


def gated(mentions: DataFrame, label: str, name: str, score: str, labels: tuple[str, ...] = ("PER", "ORG", "LOC"), least: float = 0.5, letters: int = 3) -> DataFrame:
    """Mentions of the labels (a tag before a dash is cut), without word pieces, long enough, and sure enough or unscored."""
    kind = F.upper(F.regexp_replace(F.col(label), "^[^-]*-", ""))
    return mentions.filter(kind.isin(*labels) & ~F.col(name).rlike("(^|\\s)##") & (F.length(name) >= letters) & (F.col(score).isNull() | (F.col(score) >= least)))


def default_mentions(articles: DataFrame, rule: str = r"^\p{Lu}\p{Ll}{3,}$") -> DataFrame:
    """Default tagger: capitalized words; (id, entity_text, position), positions in characters. Built-in functions."""
    from broadsheet.functions.text import pieces

    rows = articles.select("id", pieces(F.col("text")).alias("p"))
    # only pieces that fit leave the array; where positions are not asked for, the array goes no further either
    fits = F.filter(F.transform("p", lambda x, i: F.when(x.rlike(rule), F.struct(x.alias("x"), i.alias("i")))), lambda z: z.isNotNull())
    short = rows.filter(F.size("p") <= 2000).select("id", "p", F.explode(fits).alias("z")).select("id", F.col("z.x").alias("entity_text"), F.length(F.array_join(F.slice("p", F.lit(1), F.col("z.i")), "")).alias("position"))
    # long texts: the sum runs over rows, because growing an array is quadratic in its length
    from pyspark.sql import Window

    exploded = rows.filter(F.size("p") > 2000).select("id", F.posexplode("p").alias("i", "entity_text"))
    w = Window.partitionBy("id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    long = exploded.select("id", "entity_text", F.coalesce(F.sum(F.length("entity_text")).over(w), F.lit(0)).cast("int").alias("position"))
    return short.unionByName(long).filter(F.col("entity_text").rlike(rule))


def default_names(articles: DataFrame) -> DataFrame:
    """(id, entity_text): what default_mentions finds by its rule, each name once a text; one scan, and nothing is shuffled."""
    found = F.regexp_extract_all("text", F.lit(r"(?<![\p{L}\p{N}_])\p{Lu}\p{Ll}{3,}(?![\p{L}\p{N}_])"), F.lit(0))
    return articles.select("id", F.explode(F.array_distinct(found)).alias("entity_text"))
