"""Queries of the problems tagged llm, over the whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilake.functions import lexicons as X
from vigilake.functions.text import NULL_TOKENS, strip
from vigilake.llm import canonical as C
from vigilake.llm import encode as E
from vigilake.llm import leak as L
from vigilake.llm import pairs as P
from vigilake.llm import split as S
from vigilake.runtime import read

LIMIT, OVERLAP = 512, 64

def _baskets(spark: SparkSession, d: str) -> DataFrame:
    fact = read(spark, d, "adult_fact")
    drug, reaction = F.concat(F.lit("D:"), strip(F.col("rxcui"))), F.concat(F.lit("R:"), F.col("meddra_concept_id").cast("string"))
    return P.baskets(fact, F.col("safetyreportid"), drug, reaction)


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every pair, with its counts and scores."""
    return P.pairs(_baskets(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return P.pairs(_baskets(spark, d), min_count=5, min_share=(3, 1000), min_lift=3).select("item_a", "item_b")


# What may stand beside a product's name without changing which drug is meant: salts, forms, routes and qualifiers of the
# project's word lists, beside those of the product list's own columns.
ADDITIONS = (*X.SALTS, *X.DOSAGE_FORMS, *X.FORMULATIONS, *X.ROUTES, *X.BRACKET_QUALIFIERS, *X.NAME_NOISE)


def _additions(products: DataFrame) -> DataFrame:
    """(phrase): the additions of the word lists and of the list's columns."""
    own = products.select(F.explode(F.concat(F.array("dosage_form", "qualifier"), F.coalesce("salt", F.array().cast("array<string>")))).alias("phrase"))
    return own.unionByName(products.sparkSession.createDataFrame([(w,) for w in ADDITIONS], "phrase string")).filter(F.col("phrase").isNotNull()).distinct()


def _products(d: DataFrame) -> DataFrame:
    """Entries of the product list. A brand's components are its own name; cleaned names are aliases."""
    several = (F.size("ingredients") > 1) & (F.coalesce("rxcui_tty", F.lit("")) != "BN")
    components = F.when(several, F.col("ingredients")).otherwise(F.array(F.coalesce("basename", "medicinal_product")))
    aliases = F.array_distinct(F.array_compact(F.array("medicinal_product_norm", "medicinal_product_llm_clean", "basename")))
    return d.select(F.col("rxcui").alias("target"), F.col("medicinal_product").alias("name"), aliases.alias("aliases"), components.alias("components"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    listed = read(spark, d, "adult_drugs_enriched")
    terms = read(spark, d, "pt_soc_dictionary").select(F.col("meddra_concept_id").alias("target"), F.col("meddra_concept_name").alias("name"))
    terms = terms.withColumns({"aliases": F.array().cast("array<string>"), "components": F.filter(F.split("name", r"[^\p{L}\p{N}]+"), lambda w: w != "")})
    drugs = C.match_values(read(spark, d, "drugcharacteristics_extended"), "drug", "medicinal_product", "safetyreportid", _products(listed), NULL_TOKENS, _additions(listed))
    reactions = C.match_values(read(spark, d, "reactions"), "reaction", "reaction_meddrapt", "safetyreportid", terms, NULL_TOKENS, strict=False)
    return drugs.unionByName(reactions)


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values no entry is meant by, most frequent first in reports."""
    found = p5_found(spark, d).filter(F.col("target_id") == "UNMATCHED")
    return found.groupBy("field", "raw_value").agg(F.count(F.lit(1)).alias("n_reports"))


def p5_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Precision and recall against rows that name the substance themselves: of typed products whose row names substances
    that are exactly one entry's ingredients, how many are matched, and how many to an entry of these ingredients."""
    listed = read(spark, d, "adult_drugs_enriched").select("rxcui", F.array_sort(F.transform("ingredients", F.upper)).alias("i")).filter(F.size("i") > 0).distinct()
    named = F.array_sort(F.transform(F.split("active_substance_name", r"\\|;"), lambda x: F.upper(F.trim(x))))
    rows = read(spark, d, "drugcharacteristics_extended").select("safetyreportid", F.col("medicinal_product").alias("raw_value"), named.alias("i")).distinct()
    labelled = rows.join(listed.select("i").distinct(), "i")
    found = p5_found(spark, d).filter(F.col("field") == "drug")
    cases = labelled.join(found, "raw_value").select("raw_value", "i", "target_id").distinct()
    right = listed.withColumnRenamed("rxcui", "target_id").withColumn("right", F.lit(1))
    out = cases.join(right, ["i", "target_id"], "left")
    return out.agg(F.count(F.lit(1)).alias("n_labelled"), F.count_if(F.col("target_id") != "UNMATCHED").alias("n_matched"), F.count("right").alias("n_agree"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return E.encode(read(spark, d, "documents"))


def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """By language: texts, tokens, and texts that decoding doesn't give back (none is expected)."""
    docs = read(spark, d, "documents").select("doc_id", "lang", "text")
    ids = E.encode(docs.withColumn("key", F.struct("lang", "text")), key="key")
    back = ids.select("key.lang", (E.decode(F.col("ids")) == F.coalesce("key.text", F.lit(""))).alias("same"), F.size("ids").alias("n"))
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_tokens"), F.count_if(~F.col("same")).alias("n_changed"))


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return L.leaks(read(spark, d, "documents"), read(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """The items that leaked: into how many documents, and the longest passage."""
    return p8_leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("n_words").alias("most_words"))


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return S.split(read(spark, d, "documents"), limit=LIMIT, overlap=OVERLAP)


def p9_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Of each text that isn't null: characters covered by its pieces in order, and how many pieces leave a gap, are over
    the limit, or share more than the overlap."""
    pieces = S.split(read(spark, d, "documents"), limit=LIMIT, overlap=OVERLAP, all_texts=True, with_text=False)
    before = F.coalesce(F.lag("end_char").over(Window.partitionBy("doc_id").orderBy("piece")), F.lit(0))
    pieces = pieces.withColumn("gap", F.col("first_char") > before)
    bad = lambda c, name: F.count_if(c).alias(name)
    return pieces.groupBy("doc_id").agg(F.max("end_char").cast("bigint").alias("n_chars"), bad(F.col("gap"), "n_gaps"), bad(F.col("n_tokens") > LIMIT, "n_over_limit"), bad(F.col("n_overlap") > OVERLAP, "n_over_overlap"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = S.split(read(spark, d, "documents"), limit=LIMIT, overlap=OVERLAP, with_text=False)
    return pieces.filter(F.col("piece") == 0).select("doc_id").distinct()


QUERIES = {
    "p4_found": p4_found,
    "p4_pairs": p4_pairs,
    "p5_found": p5_found,
    "p5_unmatched": p5_unmatched,
    "p5_agreement": p5_agreement,
    "p7_ids": p7_ids,
    "p7_roundtrip": p7_roundtrip,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p8_items": p8_items,
    "p9_found": p9_found,
    "p9_pieces": p9_pieces,
    "p9_coverage": p9_coverage,
}
_PAIRS = """
with r as (select distinct safetyreportid s, 'D:' || trim(rxcui) i from adult_fact where safetyreportid is not null and rxcui is not null
           union select distinct safetyreportid, 'R:' || cast(meddra_concept_id as varchar) from adult_fact where safetyreportid is not null and meddra_concept_id is not null),
     c as (select i, count(*) n from r group by i),
     t as (select count(distinct safetyreportid) n from adult_fact),
     p as (select a.i item_a, b.i item_b, count(*) n_ab from r a join r b on a.s = b.s and a.i < b.i group by 1, 2)
"""
SQL: dict[str, str] = {
    "p4_found": _PAIRS + "select item_a, item_b from p join c a on a.i = item_a join c b on b.i = item_b, t where n_ab >= 5 and 1000 * n_ab >= 3 * t.n and n_ab * t.n >= 3 * a.n * b.n",
    "p4_pairs": _PAIRS
    + """select item_a, item_b, n_ab, a.n n_a, b.n n_b, t.n n, (n_ab / a.n) * (t.n / b.n) lift,
         case when n_ab < a.n then (1 - b.n / t.n) / (1 - n_ab / a.n) end conviction
         from p join c a on a.i = item_a join c b on b.i = item_b, t""",
    "p9_coverage": "select doc_id, length(text) n_chars, cast(0 as bigint) n_gaps, cast(0 as bigint) n_over_limit, cast(0 as bigint) n_over_overlap from documents where text is not null",
}
