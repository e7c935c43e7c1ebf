"""The pipeline's stages as pure functions from data frames to data frames. Reading and writing live in the runner."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions import lexicons as X
from vigilake.functions.names import base_name, clean_name, ingredients_and_salts, substances, title_case
from vigilake.functions.text import NULL_TOKENS, strip
from vigilake.functions.values import age_band, any_date, cohort, distinct_list, serious
from vigilake.operators import linkage as L
from vigilake.operators import relational as R

WINDOW = (date(2004, 1, 1), date(2025, 12, 31))
LEVELS = ("PT", "HLT", "HLGT", "SOC")
DATES = ("mostrecent_receive_date", "receive_date", "lastupdate_date")
PROFILE_TEXTS = ("medicinal_product", "drug_administration", "drug_dosage_form", "active_substance_name", "drug_authorization_number")
PROFILE_LISTS = ("generic_name", "brand_name", "substance_name", "application_number")
ABOUT = ("serious", "congenital_anomali", "death", "disabling", "hospitalization", "life_threatening", "other", "reporter_country", "reporter_company", "reporter_qualification")
FACT_KEYS = ("safetyreportid", "medicinal_product", "reaction_meddrapt")


def reports(report: DataFrame) -> DataFrame:
    """One row per report: each date's largest text, on its own."""
    return report.filter(F.col("safetyreportid").isNotNull()).groupBy("safetyreportid").agg(*(F.max(c).alias(c) for c in DATES))


def patients(patient: DataFrame) -> DataFrame:
    """One row per report: each column's first value that isn't null, by load time."""
    cols = [c for c in patient.columns if c not in ("safetyreportid", "load_ts")]
    return R.first_values(patient.filter(F.col("safetyreportid").isNotNull()), ["safetyreportid"], cols, ["load_ts"])


def drug_lines(drug: DataFrame) -> DataFrame:
    """The distinct drug lines of a report."""
    kept = drug.filter(F.col("safetyreportid").isNotNull() & F.col("medicinal_product").isNotNull())
    return kept.select("safetyreportid", "medicinal_product", "drug_characterization", "drug_administration", "drug_indication").distinct()


def drug_entries(drug: DataFrame) -> DataFrame:
    """One row per (report, entry), the first loaded."""
    return R.first_rows(drug.filter(F.col("safetyreportid").isNotNull()), ["safetyreportid", "entry"], [F.col("load_ts")])


def mapping_input(entries: DataFrame, wide: DataFrame) -> DataFrame:
    return entries.join(wide, ["safetyreportid", "entry"], "left")


def mapping_profiles(mapping: DataFrame) -> DataFrame:
    """One row per drug profile (null texts equal empty ones, a list counts by its first), with the rows behind it."""
    keys = [F.coalesce(F.col(c), F.lit("")) for c in PROFILE_TEXTS] + [F.get(F.col(c), F.lit(0)) for c in PROFILE_LISTS]
    return R.count_back(mapping, keys, ["safetyreportid", "entry"])


def reaction_lines(reactions: DataFrame) -> DataFrame:
    kept = reactions.filter(F.col("safetyreportid").isNotNull() & F.col("reaction_meddrapt").isNotNull())
    return kept.select("safetyreportid", "reaction_meddrapt", "reaction_outcome").distinct()


def events(report: DataFrame, patient: DataFrame, drug: DataFrame, reaction: DataFrame, window: tuple[date, date] = WINDOW, cut: int = 21, seriousness: DataFrame | None = None, reporter: DataFrame | None = None) -> DataFrame:
    """Report x drug x reaction, of reports with a numeric id, a date in the window and an age, suspected drugs only; where
    seriousness and reporter are given, joined with them, without the reporters that don't count.

    Filters stand before the joins; the joins share one partitioning, by report.
    """
    dated = report.select("safetyreportid", *(any_date(F.col(c)).alias(c) for c in DATES))
    at = F.coalesce(*(F.col(c) for c in DATES))
    dated = dated.filter(F.col("safetyreportid").rlike(r"^\d+$") & at.between(F.lit(window[0]), F.lit(window[1])))
    age = F.col("patient_custom_master_age")
    aged = patient.filter((age >= 0) & (age <= 120)).select("safetyreportid", "patient_sex", age.try_cast("int").alias("age_years"), cohort(age, cut).alias("cohort"), age_band(age).alias("band"))
    suspected = drug.filter(F.col("drug_characterization").startswith("Suspect"))
    about = [dated, aged]
    if seriousness is not None:
        about.append(seriousness)
    if reporter is not None:
        about.append(reporter.filter(~F.col("reporter_qualification").isin(*X.EXCLUDED_REPORTERS)))
    return reduce(lambda a, b: a.join(b, "safetyreportid"), [*about, suspected, reaction])


def adverse_reactions(events_: DataFrame) -> DataFrame:
    out = events_.filter(F.col("reaction_meddrapt").isNotNull()).select("safetyreportid", "reaction_meddrapt", "reaction_outcome").distinct()
    return out.withColumn("reaction_meddrapt", strip(F.col("reaction_meddrapt")))


def mapped_terms(reactions: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Terms in title case joined to the dictionary's names in title case; unmatched terms stay."""
    terms = reactions.select(title_case(strip(F.col("reaction_meddrapt"))).alias("reaction_term")).filter(F.col("reaction_term") != "").distinct()
    names = dictionary.select(title_case(F.col("meddra_concept_name")).alias("reaction_term"), "meddra_concept_id", "meddra_concept_code")
    return terms.join(names, "reaction_term", "left")


def products(drug: DataFrame) -> DataFrame:
    """One row per product with the lists of its context, and its cleaned and base name."""
    lists = ("active_substance_name", "drug_dosage_form", "drug_authorization_number", "action_drug")
    kept = drug.filter(F.col("medicinal_product").isNotNull() & ~F.col("medicinal_product").isin(*NULL_TOKENS))
    out = kept.groupBy("medicinal_product").agg(*(F.array_sort(F.collect_set(c)).alias(c) for c in lists))
    for c in lists:
        out = out.withColumn(c, distinct_list(F.col(c)))
    return out.withColumn("medicinal_product_norm", clean_name(F.col("medicinal_product"))).withColumn("basename", base_name(F.col("medicinal_product")))


def decomposed(names: DataFrame) -> DataFrame:
    """Ingredients and salts out of substance texts."""
    ingredient, salt = ingredients_and_salts(substances(F.col("active_substance_name")))
    return names.withColumn("ingredients", ingredient).withColumn("salts", salt)


def linked(products_: DataFrame, listed: DataFrame) -> DataFrame:
    """Products with the ingredients of their substances and, by base name, the identifier the cascade over the listed
    names (basename, rxcui, rxnorm_ingredients) finds; ``ingredient`` holds the listed ingredients of that identifier."""
    parts = decomposed(products_.withColumn("active_substance_name", F.array_join("active_substance_name", ";")))
    parts = products_.join(parts.select("medicinal_product", "ingredients"), "medicinal_product")
    # An empty base name is no name to look up.
    names = parts.filter(F.col("basename") != "").groupBy("basename").agg(F.min_by("ingredients", F.when(F.col("ingredients").isNotNull(), F.col("medicinal_product"))).alias("ingredients"))
    table = listed.select(F.col("basename").alias("name"), "rxcui")
    hits = L.cascade(names, table, approximate=table).drop("ingredients")
    related = listed.select("rxcui", F.lit("IN").alias("tty"), F.explode("rxnorm_ingredients").alias("name"))
    out = L.related_ingredients(parts.join(hits, "basename", "left"), related)
    none = F.array().cast("array<string>")
    out = out.withColumn("ingredient", F.coalesce("rxnorm_ingredients", none)).withColumn("faers_ingredients", F.coalesce("ingredients", none)).drop("rxnorm_ingredients", "ingredients")
    return with_counts(out).withColumnRenamed("lookup_hit", "mapping_method")


LOOKUP = ("rxcui", "mapping_method", "ingredient", "faers_ingredients", "ingredient_count", "faers_ingredient_count", "is_combination_product")


def with_counts(df: DataFrame) -> DataFrame:
    """How many ingredients either list has, and whether one has several."""
    n, m = F.size("ingredient"), F.size("faers_ingredients")
    return df.withColumns({"ingredient_count": n, "faers_ingredient_count": m, "is_combination_product": (n > 1) | (m > 1)})


def product_lookup(listed: DataFrame) -> DataFrame:
    """One row per product of the enriched list that is selected, has an identifier and an ingredient: the smallest
    identifier. Where no selection was made, an identifier selects."""
    own = F.coalesce(F.col("is_selected_case"), F.col("rxcui").isNotNull()) if "is_selected_case" in listed.columns else F.col("rxcui").isNotNull()
    none = F.array().cast("array<string>")
    rows = listed.filter((own == True) & F.col("medicinal_product").isNotNull() & F.col("rxcui").isNotNull())  # noqa: E712
    rows = rows.select("medicinal_product", "rxcui", F.col("lookup_hit").alias("mapping_method"), F.coalesce("rxnorm_ingredients", none).alias("ingredient"), F.coalesce("ingredients", none).alias("faers_ingredients"))
    rows = rows.filter((F.size("ingredient") > 0) | (F.size("faers_ingredients") > 0))
    return with_counts(R.first_rows(rows, ["medicinal_product"], [F.col("rxcui")]))


def merged(events_: DataFrame, lookup: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Events x products x dictionary, the term in title case."""
    names = dictionary.filter(F.col("meddra_concept_id").isNotNull()).withColumn("reaction_meddrapt", title_case(F.col("meddra_concept_name"))).select("reaction_meddrapt", "meddra_concept_id", "meddra_concept_code", "meddra_soc_codes", "meddra_soc_names")
    names = R.first_rows(names, ["reaction_meddrapt"], [F.col("meddra_concept_id")])
    rows = events_.withColumn("reaction_meddrapt", title_case(strip(F.col("reaction_meddrapt"))))
    return rows.join(lookup.select("medicinal_product", *LOOKUP), "medicinal_product").join(names, "reaction_meddrapt")


def joined_facts(events_: DataFrame, products_: DataFrame, dictionary: DataFrame, about: DataFrame) -> DataFrame:
    """Events of all cohorts x linked products x dictionary, the term in title case. ``about``: rows with what the report
    table lacks, reporter and seriousness. A report without any keeps nulls there and a reporter of its own word: that
    none was landed is no reason to leave it out, as an unknown reporter is."""
    report = R.first_rows(about.select("safetyreportid", *ABOUT, "load_ts"), ["safetyreportid"], [F.col("load_ts")]).withColumn("_known", F.lit(True))
    rows = merged(events_, products_, dictionary).join(report, "safetyreportid", "left")
    return rows.withColumn("reporter_qualification", F.when(F.col("_known"), F.col("reporter_qualification")).otherwise("Not landed")).drop("_known")


FLAGS = ("congenital_anomali", "disabling", "life_threatening", "death", "other", "hospitalization")


def fact_filter(fact: DataFrame, window: tuple[date, date] = WINDOW) -> DataFrame:
    """Without reporters that don't count, rows without product, id or ingredient, and dates out of the window."""
    return fact.filter(
        F.col("receive_date").between(F.lit(window[0]), F.lit(window[1]))
        & F.col("rxcui").isNotNull()
        & F.col("medicinal_product").isNotNull()
        & ((F.size("ingredient") > 0) | (F.size("faers_ingredients") > 0))
        & ~F.col("reporter_qualification").isin(*X.EXCLUDED_REPORTERS)
    )


def priority(kind: Column) -> Column:
    """Suspected before interacting before concomitant."""
    return F.when(kind.startswith("Suspect"), 0).when(kind.startswith("Interacting"), 1).when(kind.startswith("Concomitant"), 2).otherwise(3)


def facts(fact: DataFrame, window: tuple[date, date] = WINDOW) -> DataFrame:
    """One row per report, product and reaction, by priority; flags and seriousness recoded, unknowns named."""
    kept = fact_filter(fact, window).withColumn("serious", serious(F.col("serious"), *(F.col(c) for c in FLAGS)))
    first = R.first_rows(kept, FACT_KEYS, [priority(F.col("drug_characterization")), F.col("load_ts")])
    return first.fillna("Unknown", subset=["patient_sex", "reporter_country", "reporter_company", "reaction_outcome"])


def with_landed(joined: DataFrame, landed: DataFrame) -> DataFrame:
    """The facts that were landed ready-made, all adult, and the joined ones that aren't among them, letter case of terms aside."""
    known = landed.select("safetyreportid", "medicinal_product", title_case(strip(F.col("reaction_meddrapt"))).alias("reaction_meddrapt")).distinct()
    return R.union_all([landed.withColumn("cohort", F.lit("adult")), joined.join(known, list(FACT_KEYS), "left_anti")])


def drug_dimension(fact: DataFrame) -> DataFrame:
    kept = fact.filter(F.col("rxcui").isNotNull()).select("rxcui", "ingredient", "medicinal_product", "mapping_method")
    return R.first_rows(kept, ["rxcui"], [F.col("medicinal_product"), F.col("mapping_method")])


def reaction_dimension(fact: DataFrame, by: str = "reaction_meddrapt") -> DataFrame:
    """One row per report and reaction, by term or by concept."""
    kept = fact.filter(F.col("meddra_concept_id").isNotNull()).select("safetyreportid", "reaction_meddrapt", "reaction_outcome", "meddra_concept_id", "meddra_concept_code", "meddra_soc_names", "meddra_soc_codes")
    return R.first_rows(kept, ["safetyreportid", by], [F.col("reaction_meddrapt"), F.col("reaction_outcome").asc_nulls_last()])
