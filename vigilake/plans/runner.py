"""Runs stages by name: reads their inputs, writes their outputs, manifests and quality notes; skips what is done.

    python -m vigilake.plans.runner --input DIR --output DIR [--stage NAME] [--skip NAME,...] [--resume]
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.operators import relational as R
from vigilake.operators.linkage import split_quarantine
from vigilake.operators.wide import widen
from vigilake.plans import stages as P
from vigilake.runtime import read
from vigilake.sources import writers


@dataclass(frozen=True)
class Context:
    spark: SparkSession
    source: str
    target: str
    resume: bool = False
    run: str = field(default_factory=lambda: datetime.now(UTC).strftime("%Y%m%dT%H%M%S"))

    def table(self, name: str) -> DataFrame:
        """A stage's output if it was written, else the landed table."""
        path = f"{self.target}/{name}"
        return self.spark.read.parquet(path) if writers.exists(self.spark, path) else read(self.spark, self.source, name)


Stage = Callable[[Context], dict[str, DataFrame]]


def entities(c: Context) -> dict[str, DataFrame]:
    drug = read(c.spark, c.source, "drugcharacteristics_extended")
    return {
        "er_report": P.reports(read(c.spark, c.source, "report")),
        "er_patient": P.patients(read(c.spark, c.source, "patient")),
        "er_drug": P.drug_lines(drug),
        "er_drug_entry": P.drug_entries(drug),
        "er_reaction": P.reaction_lines(read(c.spark, c.source, "reactions")),
        "er_openfda_wide": widen(read(c.spark, c.source, "patient_drug_openfda")),
    }


def mapping(c: Context) -> dict[str, DataFrame]:
    joined = P.mapping_input(c.table("er_drug_entry"), c.table("er_openfda_wide"))
    return {"drug_mapping_input": joined, "drug_mapping_unique": P.mapping_profiles(joined)}


def cohorts(c: Context) -> dict[str, DataFrame]:
    return {"events": P.events(c.table("er_report"), c.table("er_patient"), c.table("er_drug"), c.table("er_reaction"))}


def reactions(c: Context) -> dict[str, DataFrame]:
    rows = P.adverse_reactions(c.table("events"))
    return {"adr": rows, "mapped_terms": P.mapped_terms(rows, read(c.spark, c.source, "pt_soc_dictionary"))}


def products(c: Context) -> dict[str, DataFrame]:
    return {"products": P.products(read(c.spark, c.source, "drugcharacteristics_extended"))}


def decompose(c: Context) -> dict[str, DataFrame]:
    """Ingredients and salts of the products' substance texts."""
    names = c.table("products").select("medicinal_product", F.array_join("active_substance_name", ";").alias("active_substance_name"))
    return {"decomposed_products": P.decomposed(names)}


def vocabulary(c: Context) -> dict[str, DataFrame]:
    """The hierarchy's paths and lists out of landed vocabulary tables, if there are any."""
    names = ("vocabulary_concepts", "vocabulary_relations")
    if not all(writers.landed(c.spark, f"{c.source}/{n}.parquet") for n in names):
        return {}
    paths = R.hierarchy(*(read(c.spark, c.source, n) for n in names), P.LEVELS)
    return {"hierarchy_paths": paths, "hierarchy_lists": R.hierarchy_lists(paths, P.LEVELS)}


def linkage(c: Context) -> dict[str, DataFrame]:
    main, out = split_quarantine(P.linked(c.table("products"), read(c.spark, c.source, "adult_drugs_enriched")))
    return {"linked_products": main, "quarantined_products": out}


def finalise(c: Context) -> dict[str, DataFrame]:
    return {"joined_fact": P.joined_facts(c.table("events"), c.table("linked_products"), read(c.spark, c.source, "pt_soc_dictionary"), read(c.spark, c.source, "adult_fact"))}


def package(c: Context) -> dict[str, DataFrame]:
    fact = P.with_landed(P.facts(c.table("joined_fact")), P.facts(read(c.spark, c.source, "adult_fact")))
    return {"fact": fact, "dim_drug": P.drug_dimension(fact), "dim_reaction": P.reaction_dimension(fact), "dim_standard_reaction": P.reaction_dimension(fact, "meddra_concept_id")}


STAGES: dict[str, Stage] = {f.__name__: f for f in (entities, mapping, cohorts, reactions, vocabulary, products, decompose, linkage, finalise, package)}


def mapping_notes(c: Context) -> dict[str, str]:
    report = writers.quality_report(c.table("drug_mapping_input"), "drug_mapping_input", ("safetyreportid", "entry"), ("medicinal_product", *P.PROFILE_LISTS))
    return {"drug_mapping_input_quality_report.json": json.dumps(report, indent=2, ensure_ascii=False)}


COLUMNS = {
    "safetyreportid": "report identifier", "age_years": "age of the patient in years", "medicinal_product": "drug as reported", "reaction_meddrapt": "reaction term", "meddra_concept_id": "concept of the term",
    "rxcui": "identifier of the drug, to count distinct drugs by", "ingredient": "ingredients of the identifier", "faers_ingredients": "ingredients of the report", "is_combination_product": "whether either list has several",
}


def package_notes(c: Context) -> dict[str, str]:
    rows = {r.cohort: r["count"] for r in c.table("fact").groupBy("cohort").count().collect() if r.cohort}  # two cohorts
    return {"README.md": writers.dataset_readme("Adverse drug reactions of two cohorts", COLUMNS, rows, c.run)}


NOTES: dict[str, Callable[[Context], dict[str, str]]] = {"mapping": mapping_notes, "package": package_notes}


def run_stage(c: Context, name: str) -> dict[str, int | None]:
    counts = {}
    for table, df in STAGES[name](c).items():
        by = ("cohort",) if "cohort" in df.columns else ()
        counts[table] = writers.write(df, f"{c.target}/{table}", partition_by=by, resume=c.resume)
    writers.manifest(c.spark, f"{c.target}/_manifest_{c.run}_{name}.json", name, counts, run=c.run)
    written = {t: n for t, n in counts.items() if n is not None}
    if written:
        before, after = list(written.values())[0], list(written.values())[-1]
        notes = {f"_summary/{name}.md": writers.quality_summary(name.capitalize(), before, after, written), **NOTES.get(name, lambda _: {})(c)}
        for path, text in notes.items():
            writers.write_text(c.spark, f"{c.target}/{path}", text)
    return counts


def run(c: Context, only: str | None = None, skip: tuple[str, ...] = ()) -> dict[str, dict[str, int | None]]:
    names = [only] if only else [n for n in STAGES if n not in skip]
    unknown = {*names, *skip} - set(STAGES)
    if unknown:
        raise ValueError(f"no such stage: {', '.join(sorted(unknown))}")
    return {n: run_stage(c, n) for n in names}


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--stage")
    p.add_argument("--skip", default="")
    p.add_argument("--resume", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(run(Context(spark, a.input, a.output, a.resume), a.stage, tuple(x for x in a.skip.split(",") if x)))


if __name__ == "__main__":
    main()
