"""Record linkage of names to identifiers: a cascade of dictionary look-ups, first hit wins, doubtful rows quarantined.

Every exact step only says which names to look up, in which order: all candidates of all steps go through one join with
the dictionary of identifiers, and the first found by rank wins. Approximate look-ups run for the names still open. The
dictionaries (answers of outer services) are data frames; Spark broadcasts the ones whose size allows. No step drops rows,
so main and quarantine together are the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions import lexicons as X
from vigilake.functions.names import any_pattern, similar, without_noise, words
from vigilake.runtime import cut


def unique_names(table: DataFrame, name: str = "name", identifier: str = "rxcui") -> DataFrame:
    """(_name, _hit, _as): one row per case-folded name, its smallest identifier and a spelling, so that joins add no rows."""
    kept = table.filter(F.col(name).isNotNull() & F.col(identifier).isNotNull())
    return kept.groupBy(F.lower(F.trim(F.col(name))).alias("_name")).agg(F.min(identifier).alias("_hit"), F.min(name).alias("_as"))


def by_name(df: DataFrame, key: Column, table: DataFrame) -> DataFrame:
    """Adds ``_hit``: the identifier whose name equals ``key``, case ignored."""
    return df.withColumn("_name", F.lower(F.trim(key))).join(unique_names(table), "_name", "left").drop("_name", "_as")


def by_list(df: DataFrame, names: str, table: DataFrame, key: str) -> DataFrame:
    """Adds ``_hit``: the identifier of the first name in a list that has one."""
    each = df.select(key, F.posexplode(names).alias("_at", "_name")).withColumn("_name", F.lower(F.trim("_name")))
    hits = each.join(unique_names(table), "_name").groupBy(key).agg(F.min_by("_hit", "_at").alias("_hit"))
    return df.join(hits, key, "left")


def _letters(c: Column) -> Column:
    """Two words of bits: one bit, by hash, for each letter of a text and its how-manieth."""
    chars = F.split(c, "")
    numbered = F.transform(chars, lambda x, i: F.pmod(F.xxhash64(x, F.size(F.filter(F.slice(chars, 1, i + 1), lambda y: y == x))), F.lit(128)))
    bits = lambda k: F.aggregate(F.filter(numbered, lambda n: F.floor(n / 64) == k), F.lit(0).cast("bigint"), lambda m, n: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), (n % 64).cast("int"))))
    return F.array(bits(0), bits(1))


def _trigrams(c: Column) -> Column:
    """The distinct trigrams of a text with two blanks before and one after it."""
    padded = F.concat(F.lit("  "), c, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) + 1), lambda i: F.substr(padded, i, F.lit(3))))


def nearest(df: DataFrame, key: str, name: str, table: DataFrame, least: float = 0.7, share: float = 0.2, letters: int = 1) -> DataFrame:
    """Adds ``_hit`` and ``_as``: identifier and spelling of the most similar name, of a ratio of ``least`` or more.

    Candidates share at least ``share`` of the name's trigrams; so at least one of all but the most common of them that the
    share leaves, which makes the join's keys rare ones. A name of one word also shares its first ``letters`` letters. Before
    the ratio runs, pairs are left out that can't reach it: it implies that the lengths differ by no more than 30 % of their
    mean, how many letters are common to both, counted by bits, which never count a common letter as missing, and how many
    edits lie between them at most, as each letter that isn't matched is one."""
    low = F.lower(F.trim(F.col(name)))
    left = cut(df.filter(low != "").select(key, low.alias("_a"))).withColumns({"_ma": _letters(F.col("_a")), "_la": F.length("_a"), "_ga": _trigrams(F.col("_a"))})
    right = unique_names(table).filter(F.col("_name") != "").withColumns({"_mb": _letters(F.col("_name")), "_lb": F.length("_name"), "_gb": _trigrams(F.col("_name"))})
    listed = right.select("_name", F.explode("_gb").alias("_g"))
    common = listed.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    asked = left.select("_a", F.explode("_ga").alias("_g")).distinct().join(common, "_g")  # a trigram of no name leads to none
    ranked = asked.groupBy("_a").agg(F.array_sort(F.collect_list(F.struct("_n", "_g"))).alias("_r"))
    least_shared = F.ceil(F.size("_ga") * share)
    ranked = left.select("_a", "_ga").distinct().join(ranked, "_a").filter(F.size("_r") >= least_shared)
    rare = F.slice(F.transform("_r", lambda x: x["_g"]), F.lit(1), (F.size("_r") - least_shared + 1).cast("int"))
    pairs = ranked.select("_a", F.explode(rare).alias("_g")).join(listed, "_g").select("_a", "_name").distinct()
    near = left.join(pairs, "_a").join(right, "_name").filter(F.size(F.array_intersect("_ga", "_gb")) >= F.ceil(F.size("_ga") * share))
    one_word = F.size(words(F.col("_a"))) == 1
    needed = least * (F.col("_la") + F.col("_lb")) / 2 - 1e-6  # letters that the ratio asks for
    lacking = lambda m, n: sum((F.bit_count(F.col(m)[k].bitwiseAND(F.bitwise_not(F.col(n)[k]))) for k in (0, 1)), F.lit(0))
    near = near.filter((F.least("_la", "_lb") >= needed) & (F.col("_la") - lacking("_ma", "_mb") >= needed) & (F.col("_lb") - lacking("_mb", "_ma") >= needed))
    near = near.filter(F.levenshtein("_a", "_name") <= (1 - least) * (F.col("_la") + F.col("_lb")) + 1e-6)
    near = near.filter(~one_word | (F.left("_a", F.lit(letters)) == F.left("_name", F.lit(letters))))
    scored = near.select(key, "_hit", "_as", "_name", similar(F.col("_a"), F.col("_name"), least).alias("_r")).filter(F.col("_r") >= least)
    hits = scored.groupBy(key).agg(F.min_by(F.struct("_hit", "_as"), F.struct(-F.col("_r"), "_name")).alias("_h")).select(key, "_h._hit", "_h._as")
    return df.join(hits, key, "left")


def _titles(table: DataFrame, *also: str) -> DataFrame:
    """(_name, title, also...): one row per case-folded name, the smallest."""
    row = F.min(F.struct("title", *also)).alias("_t")
    return table.filter(F.col("name").isNotNull() & F.col("title").isNotNull()).groupBy(F.lower(F.trim("name")).alias("_name")).agg(row).select("_name", "_t.*")


def cascade(
    names: DataFrame, exact: DataFrame, synonyms: DataFrame | None = None, brands: DataFrame | None = None, approximate: DataFrame | None = None, kegg: DataFrame | None = None, skip: Iterable[str] = X.NO_DRUGS, noise: Iterable[str] = X.NOISE
) -> DataFrame:
    """names: (basename unique, ingredients) -> with rxcui, lookup_hit, source.

    exact, approximate: (name, rxcui); synonyms, brands: (name, title), a title is looked up again; kegg: (name, kegg_id,
    title), the title being the international name. The steps, in order: base name; each ingredient; titles of the
    synonyms of base name and ingredients; base name without noise words; titles of brands that the base name or, if it
    has several, one of its words of four letters or more is, or the title's first word; nearest name; international
    name of base names of five letters or more, exact, then nearest. Names of the skip list aren't looked up.
    """
    skipped = F.coalesce(_any_word(F.col("basename"), skip), F.lit(False))
    own = names.select("basename", F.coalesce("ingredients", F.array().cast("array<string>")).alias("ingredients")).filter(F.col("basename").isNotNull() & ~skipped)

    def candidates(df: DataFrame, rank: Column, name: Column, hit: Column, source: str) -> DataFrame:
        return df.select("basename", rank.cast("int").alias("_rank"), F.lower(F.trim(name)).alias("_name"), hit.alias("lookup_hit"), F.lit(source).alias("source"))

    each = own.select("basename", F.posexplode("ingredients").alias("_at", "_n"))
    bare = without_noise(F.col("basename"), noise)
    parts = [
        candidates(own, F.lit(0), F.col("basename"), F.lit("basename"), "rxnav_basename"),
        candidates(each, 10_000 + F.col("_at"), F.col("_n"), F.lit("ingredients"), "rxnav_ingredients"),
        candidates(own.filter((bare != "") & (bare != F.upper("basename"))), F.lit(30_000), bare, F.concat(F.lit("suffix_strip:"), bare), "suffix_strip"),
    ]

    def titled(df: DataFrame, table: DataFrame) -> DataFrame:
        return df.select("basename", "_at", F.lower(F.trim("_n")).alias("_name")).join(_titles(table), "_name")

    title = F.col("title")
    if synonyms is not None:
        found = titled(own.select("basename", F.posexplode(F.concat(F.array("basename"), "ingredients")).alias("_at", "_n")), synonyms)
        parts.append(candidates(found, 20_000 + F.col("_at"), title, title, "local_cid_fallback"))
    if brands is not None:
        several = words(F.col("basename"))
        tried = F.concat(F.array("basename"), F.when(F.size(several) > 1, F.filter(several, lambda w: F.length(w) >= 4)).otherwise(F.array().cast("array<string>")))
        found = titled(own.select("basename", F.posexplode(tried).alias("_at", "_n")), brands)
        parts.append(candidates(found, 40_000 + 2 * F.col("_at"), title, title, "chembl_brand"))
        parts.append(candidates(found, 40_001 + 2 * F.col("_at"), F.get(words(title), F.lit(0)), title, "chembl_brand"))
    known = unique_names(exact).select("_name", F.col("_hit").cast("string").alias("rxcui"))
    first = lambda df: df.groupBy("basename").agg(F.min_by(F.struct("rxcui", "lookup_hit", "source"), "_rank").alias("_h")).select("basename", "_h.*")
    hits = first(reduce(DataFrame.unionByName, parts).filter(F.col("_name") != "").join(known, "_name"))
    if approximate is not None or kegg is not None:
        hits = cut(hits)  # read again by every step for the names still open
    if approximate is not None:
        still = own.join(hits, "basename", "left_anti").select("basename")
        near = nearest(still, "basename", "basename", approximate).filter(F.col("_hit").isNotNull())
        hits = hits.unionByName(near.select("basename", F.col("_hit").cast("string").alias("rxcui"), F.concat(F.lit("approx:"), "_as").alias("lookup_hit"), F.lit("approx_match").alias("source")))
    if kegg is not None:
        hits = cut(hits)
        still = own.join(hits, "basename", "left_anti").filter(F.length(F.trim("basename")) >= 5)
        found = still.select("basename", F.lower(F.trim("basename")).alias("_name")).join(_titles(kegg, "kegg_id"), "_name").drop("_name")
        hit = F.concat_ws(":", F.lit("kegg"), "kegg_id", "title")
        found = cut(found)
        inns = candidates(found, F.lit(0), title, hit, "kegg_inn").join(known, "_name").drop("_name")
        if approximate is not None:
            near = nearest(found.join(inns, "basename", "left_anti"), "basename", "title", approximate).filter(F.col("_hit").isNotNull())
            inns = inns.unionByName(near.select("basename", F.lit(1).alias("_rank"), hit.alias("lookup_hit"), F.lit("kegg_inn").alias("source"), F.col("_hit").cast("string").alias("rxcui")))
        hits = hits.unionByName(first(inns))
    out = names.join(hits, "basename", "left")
    return out.select(*names.columns, "rxcui", F.coalesce("lookup_hit", F.lit("not_found")).alias("lookup_hit"), F.when(skipped, "skipped_non_drug").otherwise(F.coalesce("source", F.lit("not_found"))).alias("source"))


def ingredient_source(source: Column, rxcui: Column, lookup_hit: Column) -> Column:
    """Where a product's ingredients come from: as said, else by how its identifier was found; null without one."""
    found = F.when(rxcui.isNull(), None).when(lookup_hit == "basename", "rxnav_basename").when(lookup_hit == "ingredients", "rxnav_ingredients").otherwise("rxnorm_enriched")
    return F.coalesce(source, found)


def _any_word(c: Column, words: Iterable[str]) -> Column:
    up, out = F.upper(c), F.lit(False)
    for w in words:
        out = out | up.contains(w)
    return out


def related_ingredients(df: DataFrame, related: DataFrame, key: str = "rxcui") -> DataFrame:
    """Adds ``rxnorm_ingredients``: distinct lower-case names related as single or multiple ingredient, sorted.
    related: (rxcui, tty, name)."""
    kept = related.filter(F.col("tty").isin("IN", "MIN")).groupBy(key).agg(F.array_sort(F.collect_set(F.lower("name"))).alias("rxnorm_ingredients"))
    return df.join(kept, key, "left")


def best_by_type(candidates: DataFrame, key: str, order: Sequence[str] = ("IN", "MIN")) -> DataFrame:
    """One candidate (rxcui, tty) per key: single ingredient before multiple before any; ties: the smaller id."""
    rank = F.coalesce(*(F.when(F.col("tty") == t, i) for i, t in enumerate(order)), F.lit(len(order)))
    return candidates.groupBy(key).agg(F.min_by(F.struct("rxcui", "tty"), F.struct(rank, "rxcui")).alias("_b")).select(key, "_b.rxcui", "_b.tty")


def ingredient_status(df: DataFrame, names: str, table: DataFrame, key: str) -> DataFrame:
    """Adds ``statuses``: for each name of a list, in order, ``exact`` if the table has it, ``approx`` if one of its names
    is similar, else ``not_found``."""
    each = df.select(key, F.posexplode(names).alias("_at", "_n"))
    distinct = by_name(each.select("_n").distinct(), F.col("_n"), table).withColumn("_exact", F.col("_hit").isNotNull()).drop("_hit")
    open_names = distinct.filter(~F.col("_exact")).select("_n")
    near = nearest(open_names, "_n", "_n", table).select("_n", F.col("_hit").isNotNull().alias("_near"))
    status = F.when(F.col("_exact"), "exact").when(F.coalesce("_near", F.lit(False)), "approx").otherwise("not_found")
    found = distinct.join(near, "_n", "left").select("_n", status.alias("_s"))
    lists = each.join(found, "_n").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_s"))), lambda x: x["_s"]).alias("statuses"))
    return df.join(lists, key, "left")


def quarantine_reason(name: Column, rxcui: Column) -> Column:
    odd = any_pattern(name)
    return F.when(rxcui.isNull() & odd, "no_rxcui_and_suspicious").when(rxcui.isNull(), "no_rxcui").when(odd, "suspicious_name")


def split_quarantine(df: DataFrame, name: str = "medicinal_product", rxcui: str = "rxcui") -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("quarantine_reason", quarantine_reason(F.col(name), F.col(rxcui)))
    return marked.filter(F.col("quarantine_reason").isNull()).drop("quarantine_reason"), marked.filter(F.col("quarantine_reason").isNotNull())
