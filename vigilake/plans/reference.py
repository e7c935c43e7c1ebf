"""Queries over the reference operators, each with equivalent SQL for an independent engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.functions import lexicons as X
from vigilake.functions import names as N
from vigilake.functions import values as V
from vigilake.functions.text import NULL_TOKENS, null_tokens, strip
from vigilake.operators import inference as I
from vigilake.operators import linkage as L
from vigilake.operators import relational as R
from vigilake.operators import shred as S
from vigilake.operators import wide as W
from vigilake.plans import stages as P
from vigilake.plans import training as T
from vigilake.runtime import read, shared_folder
from vigilake.sources import readers, writers
from vigilake.streaming import landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *tables: str):
    """Registers a query over tables; the function takes them in order."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        name = f.__name__
        QUERIES[name] = lambda spark, d: f(*(read(spark, d, t) for t in tables))
        if sql:
            SQL[name] = sql
        return f

    return register


def _list(words: tuple[str, ...]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


_NULLED = lambda c: f"case when {c} not in {_list(NULL_TOKENS)} then {c} end"
DRUG, FACT, LIST = "drugcharacteristics_extended", "adult_fact", "adult_drugs_enriched"
_DATE = "coalesce(cast(try_strptime({0}, '%Y%m%d') as date), try_cast({0} as date))"
_DAY = lambda c: f"case when regexp_full_match({c}, '[0-9]{{8}}') then cast(try_strptime({c}, '%Y%m%d') as date) when regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then try_cast(left({c}, 10) as date) end"
_TITLE = lambda c: f"array_to_string(list_transform(regexp_extract_all(lower({c}), '[a-z0-9]+|[^a-z0-9]+'), lambda w: upper(w[1]) || w[2:]), '')"
_STRIP = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_SORTED = lambda c, cond="": f"list_sort(list(distinct {c}) filter (where {c} is not null{cond}))"

_WHITE = "[\\s\\x{0B}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200B}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]"
_TRIM = lambda c: f"regexp_replace({c}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"

# --- entity tables -------------------------------------------------------------------------------------------------
_EVENTS = f"""
select r.*, cast(trunc(p.patient_custom_master_age) as integer) age_years, p.patient_sex,
       case when p.patient_custom_master_age <= 21 then 'pediatric' else 'adult' end cohort,
       case when p.patient_custom_master_age < 1 then 'infancy' when p.patient_custom_master_age < 2 then 'toddler'
            when p.patient_custom_master_age < 6 then 'early_childhood' when p.patient_custom_master_age < 12 then 'middle_childhood'
            when p.patient_custom_master_age < 18 then 'early_adolescence' when p.patient_custom_master_age <= 21 then 'late_adolescence' end band,
       d.medicinal_product, d.drug_characterization, d.drug_administration, d.drug_indication, x.reaction_meddrapt, x.reaction_outcome
from (select safetyreportid, {_DAY('mostrecent_receive_date')} mostrecent_receive_date, {_DAY('receive_date')} receive_date, {_DAY('lastupdate_date')} lastupdate_date
      from (select safetyreportid, max(mostrecent_receive_date) mostrecent_receive_date, max(receive_date) receive_date, max(lastupdate_date) lastupdate_date
            from report where safetyreportid is not null group by 1)) r
join (select safetyreportid, arg_min(patient_sex, (load_ts, patient_sex)) filter (where patient_sex is not null) patient_sex,
             arg_min(patient_custom_master_age, (load_ts, patient_custom_master_age)) filter (where patient_custom_master_age is not null) patient_custom_master_age
      from patient where safetyreportid is not null group by 1) p on r.safetyreportid = p.safetyreportid
join (select distinct safetyreportid, medicinal_product, drug_characterization, drug_administration, drug_indication
      from drugcharacteristics_extended where medicinal_product is not null) d on r.safetyreportid = d.safetyreportid
join (select distinct safetyreportid, reaction_meddrapt, reaction_outcome from reactions where reaction_meddrapt is not null) x on r.safetyreportid = x.safetyreportid
where regexp_full_match(r.safetyreportid, '[0-9]+') and p.patient_custom_master_age between 0 and 120
  and coalesce(r.mostrecent_receive_date, r.receive_date, r.lastupdate_date) between date '2004-01-01' and date '2025-12-31'
  and starts_with(d.drug_characterization, 'Suspect')
"""


@query(_EVENTS, "report", "patient", DRUG, "reactions")
def r01_cohort_events(report, patient, drug, reaction):
    return P.events(P.reports(report), P.patients(patient), P.drug_lines(drug), P.reaction_lines(reaction))


@query("select safetyreportid, max(mostrecent_receive_date) mostrecent_receive_date, max(receive_date) receive_date, max(lastupdate_date) lastupdate_date from report where safetyreportid is not null group by 1", "report")
def r02_largest_dates(report):
    return P.reports(report)


_FIRSTS = ("patient_onsetage", "patient_onsetageunit", "patient_custom_master_age", "patient_sex", "patient_weight")


@query(f"select safetyreportid, {', '.join(f'arg_min({c}, (load_ts, {c})) filter (where {c} is not null) {c}' for c in _FIRSTS)} from patient where safetyreportid is not null group by 1", "patient")
def r03_first_values(patient):
    return P.patients(patient)


@query("select distinct safetyreportid, medicinal_product, drug_characterization, drug_administration, drug_indication from drugcharacteristics_extended where safetyreportid is not null and medicinal_product is not null", DRUG)
def r04_distinct_lines(drug):
    return P.drug_lines(drug)


_ENTRY_COLUMNS = "medicinal_product, drug_characterization, drug_administration, drug_indication, drug_dosage_form, drug_authorization_number, drug_batch_number, drug_structured_dosage_num, drug_structured_dosage_unit, drug_interval_dosage_unit_num, drug_interval_dosage_definition, drug_treatment_duration, drug_treatment_duration_unit, drug_separate_dosage_num, action_drug, activesubstance_raw, active_substance_name"
_ENTRY_ORDER = "load_ts, " + ", ".join(f"{c.strip()} nulls first" for c in _ENTRY_COLUMNS.split(","))
_ENTRIES = f"select * exclude (o) from (select *, row_number() over (partition by safetyreportid, entry order by {_ENTRY_ORDER}) o from drugcharacteristics_extended where safetyreportid is not null) where o = 1"


@query(_ENTRIES, DRUG)
def r05_first_by_key(drug):
    return P.drug_entries(drug)


@query("select distinct safetyreportid, medicinal_product, i - 1 as position, ingredient[i] as ingredient from (select safetyreportid, medicinal_product, ingredient, unnest(range(1, len(ingredient) + 1)) i from adult_fact where ingredient is not null)", FACT)
def r06_explode_with_position(fact):
    return fact.select("safetyreportid", "medicinal_product", F.posexplode("ingredient").alias("p", "ingredient")).select("safetyreportid", "medicinal_product", F.col("p").cast("bigint").alias("position"), "ingredient").distinct()


_KEYS = tuple(a.name for a in W.OPENFDA[:17])
_WIDE = f"select safetyreportid, coalesce(entry, 0) entry, {', '.join(_SORTED('value', f' and key = {chr(39)}{k}{chr(39)}') + ' ' + k for k in _KEYS)} from patient_drug_openfda where key in {_list(_KEYS)} and value not in {_list(NULL_TOKENS)} group by 1, 2"


def _wide(openfda: DataFrame) -> DataFrame:
    kept = openfda.filter(~F.col("value").isin(*NULL_TOKENS)).withColumn("entry", F.coalesce("entry", F.lit(0)))
    return R.pivot_lists(kept, ["safetyreportid", "entry"], "key", "value", _KEYS)


@query(_WIDE, "patient_drug_openfda")
def r07_pivot_lists(openfda):
    return _wide(openfda)


_MAPPING = f"select d.safetyreportid, d.entry, d.medicinal_product, d.drug_administration, d.drug_dosage_form, d.active_substance_name, d.drug_authorization_number, w.generic_name, w.brand_name, w.substance_name, w.application_number from ({_ENTRIES}) d left join ({_WIDE}) w on d.safetyreportid = w.safetyreportid and d.entry = w.entry"


def _mapping(drug: DataFrame, openfda: DataFrame) -> DataFrame:
    entries = P.drug_entries(drug).select("safetyreportid", "entry", *P.PROFILE_TEXTS)
    return P.mapping_input(entries, _wide(openfda).select("safetyreportid", "entry", *P.PROFILE_LISTS))


@query(_MAPPING, DRUG, "patient_drug_openfda")
def r08_left_join_two_keys(drug, openfda):
    return _mapping(drug, openfda)


_PROFILE = f"""
with m as ({_MAPPING}),
k as (select *, {', '.join(f"coalesce({c}, '') k{i}" for i, c in enumerate(P.PROFILE_TEXTS))}, {', '.join(f'{c}[1] l{i}' for i, c in enumerate(P.PROFILE_LISTS))} from m),
r as (select *, row_number() over (partition by k0, k1, k2, k3, k4, l0, l1, l2, l3 order by safetyreportid, entry) o,
             count(*) over (partition by k0, k1, k2, k3, k4, l0, l1, l2, l3) source_record_count from k)
select safetyreportid, entry, {', '.join(P.PROFILE_TEXTS)}, {', '.join(P.PROFILE_LISTS)}, source_record_count from r where o = 1
"""


@query(_PROFILE, DRUG, "patient_drug_openfda")
def r09_content_profiles(drug, openfda):
    return P.mapping_profiles(_mapping(drug, openfda))


@query(f"select safetyreportid, entry, row_number() over (order by safetyreportid, entry) as mapping_record_id from ({_PROFILE})", DRUG, "patient_drug_openfda")
def r10_running_number(drug, openfda):
    profiles = P.mapping_profiles(_mapping(drug, openfda)).select("safetyreportid", "entry")
    return R.numbered(profiles, ["safetyreportid", "entry"], "mapping_record_id").withColumn("mapping_record_id", F.col("mapping_record_id").cast("bigint"))


@query("select count(*) n_groups, cast(count(*) filter (where n > 1) as bigint) n_repeated, cast(sum(n - 1) as bigint) n_extra_rows from (select count(*) n from drugcharacteristics_extended group by safetyreportid, entry)", DRUG)
def r11_key_audit(drug):
    return R.key_audit(drug, ["safetyreportid", "entry"])


_COVERED = ("medicinal_product", "drug_administration", "drug_batch_number", "active_substance_name")


@query(" union all ".join(f"select '{c}' column_name, count({c}) n_present, count(*) n_rows, round(100.0 * count({c}) / count(*), 2) percent_present from drugcharacteristics_extended" for c in _COVERED), DRUG)
def r12_coverage(drug):
    return R.coverage(drug, _COVERED)


# --- reactions and hierarchy ---------------------------------------------------------------------------------------
@query("select distinct safetyreportid, trim(reaction_meddrapt) reaction_meddrapt, reaction_outcome from adult_fact where reaction_meddrapt is not null", FACT)
def r13_reaction_rows(fact):
    return P.adverse_reactions(fact).distinct()


@query(f"""with t as (select distinct {_TITLE('trim(reaction_meddrapt)')} reaction_term from adult_fact where trim(reaction_meddrapt) <> '')
select reaction_term, meddra_concept_id, meddra_concept_code from t left join (select {_TITLE('meddra_concept_name')} n, meddra_concept_id, meddra_concept_code from pt_soc_dictionary) d on reaction_term = n""", FACT, "pt_soc_dictionary")
def r14_title_match(fact, dictionary):
    return P.mapped_terms(fact, dictionary)


# A vocabulary of four classes with several parents: orders, their suppliers, nations, regions.
LEVELS = P.LEVELS
_LEVEL_TABLES = {"PT": ("orders", "o_orderkey", "o_orderpriority", 100_000_000), "HLT": ("supplier", "s_suppkey", "s_name", 1_000_000), "HLGT": ("nation", "n_nationkey", "n_name", 1000), "SOC": ("region", "r_regionkey", "r_name", 0)}


def _concepts(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    code = lambda k, level: (F.col(k).cast("bigint") + _LEVEL_TABLES[level][3])
    concepts = [tables[t].select(code(k, v).alias("concept_id"), F.concat(F.lit(v[0]), F.col(k).cast("string")).alias("concept_code"), F.col(n).alias("concept_name"), F.lit(v).alias("concept_class")) for v, (t, k, n, _) in _LEVEL_TABLES.items()]
    edge = lambda t, a, x, b, y: tables[t].select(code(a, x).alias("from_id"), code(b, y).alias("to_id"))
    edges = [edge("lineitem", "l_orderkey", "PT", "l_suppkey", "HLT"), edge("supplier", "s_suppkey", "HLT", "s_nationkey", "HLGT"), edge("nation", "n_nationkey", "HLGT", "n_regionkey", "SOC")]
    return R.union_all(concepts), R.union_all(edges)


def _of(level: str) -> str:
    _, k, n, base = _LEVEL_TABLES[level]
    return f"cast({k} as bigint) + {base} {level.lower()}_id, '{level[0]}' || {k} {level.lower()}_code, {n} {level.lower()}_name"


_PATHS = f"select {', '.join(map(_of, LEVELS))} from orders left join (select distinct l_orderkey, l_suppkey from lineitem) on o_orderkey = l_orderkey left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"
_FOUR = ("region", "nation", "supplier", "orders", "lineitem")


@query(f"select * from ({_PATHS}) where soc_name is null or soc_name not in ('AFRICA')", *_FOUR)
def r15_hierarchy_paths(*tables):
    return R.hierarchy(*_concepts(dict(zip(_FOUR, tables))), LEVELS, excluded=("AFRICA",))


@query(f"select pt_id, pt_code, pt_name, {', '.join(_SORTED(f'{v.lower()}_{x}') + f' {v.lower()}_{x}s' for v in LEVELS[1:] for x in ('id', 'code', 'name'))} from ({_PATHS}) where soc_name is null or soc_name not in ('AFRICA') group by 1, 2, 3", *_FOUR)
def r16_hierarchy_lists(*tables):
    return R.hierarchy_lists(R.hierarchy(*_concepts(dict(zip(_FOUR, tables))), LEVELS, excluded=("AFRICA",)), LEVELS)


# --- products and names --------------------------------------------------------------------------------------------
@query(f"select medicinal_product, {', '.join(_SORTED(c) + ' ' + c for c in ('active_substance_name', 'drug_dosage_form', 'drug_authorization_number', 'action_drug'))} from drugcharacteristics_extended where medicinal_product not in {_list(NULL_TOKENS)} group by 1", DRUG)
def r17_product_lists(drug):
    return P.products(drug).drop("medicinal_product_norm", "basename")


_KEEP = f"len(w) > 2 and w not in {_list(X.SALTS + X.DOSAGE_FORMS + X.ROUTES + X.NAME_NOISE + X.COMPANIES)}"
_TOKENS = lambda c: f"list_filter(string_split(trim(regexp_replace(regexp_replace({c}, '[^A-Z ]', ' ', 'g'), ' +', ' ', 'g')), ' '), lambda w: {_KEEP})"


_LETTERS = lambda c: f"regexp_replace({c}, '[^A-Z ]', ' ', 'g')"
_KEPT_WORDS = lambda c: f"array_to_string(list_filter(string_split({_LETTERS(c)}, ' '), lambda w: {_KEEP}), ' ')"


@query(f"""with p as (select medicinal_product, upper(medicinal_product) u from (select distinct medicinal_product from drugcharacteristics_extended where medicinal_product is not null)),
b as (select *, list_filter(list_transform(regexp_extract_all(u, '[(]([^)]+)[)]', 1), lambda b: {_KEPT_WORDS('b')}), lambda b: b <> '')[1] inside from p)
select medicinal_product, coalesce(nullif({_KEPT_WORDS("regexp_replace(u, '[(].*?[)]', ' ', 'g')")}, ''), inside, nullif({_KEPT_WORDS('u')}, ''), trim(regexp_replace({_LETTERS('u')}, ' +', ' ', 'g'))) basename from b""", DRUG)
def r18_base_name(drug):
    return drug.select("medicinal_product").filter(F.col("medicinal_product").isNotNull()).distinct().withColumn("basename", N.base_name(F.col("medicinal_product")))


@query(f"""with p as (select distinct p_type from part), a as (select p_type, list_filter(string_split(upper(p_type), ' '), lambda w: w not in ('STANDARD', 'SMALL', 'PLATED') and w <> '') w from p)
select p_type, array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: list_position(w, w[i]) = i), lambda i: w[i]), ' ') bare from a""", "part")
def r19_noise_words(part):
    return part.select("p_type").distinct().withColumn("bare", N.without_noise(F.col("p_type"), ("STANDARD", "SMALL", "PLATED")))


def _texts(table: str, column: str, out: str, sql: str, expression: Callable[[Column], Column], name: str, where: str = "true") -> None:
    """A scalar function over a table's distinct texts."""
    SQL[name] = f"select {column}, {sql} {out} from (select distinct {column} from {table} where {where})"
    QUERIES[name] = lambda spark, d: read(spark, d, table).filter(where).select(column).distinct().withColumn(out, expression(F.col(column)))


_texts(FACT, "medicinal_product", "stripped", _STRIP("medicinal_product"), strip, "r20_strip")
_texts(FACT, "reaction_meddrapt", "title", _TITLE("reaction_meddrapt"), N.title_case, "r21_title_case")
_texts(FACT, "reaction_meddrapt", "cased", "lower(reaction_meddrapt) || '/' || upper(reaction_meddrapt)", lambda c: F.concat(F.lower(c), F.lit("/"), F.upper(c)), "r22_lower_upper")
_texts(DRUG, "activesubstance_raw", "name", """nullif(trim(regexp_extract(activesubstance_raw, '["'']activesubstancename["'']\\s*:\\s*["'']([^"'']+)["'']', 1)), '')""", V.substance_in_text, "r23_extract")
_texts("part", "p_name", "replaced", "regexp_replace(p_name, '[aeiou]+', '_', 'g')", lambda c: F.regexp_replace(c, "[aeiou]+", "_"), "r24_replace")
_texts("part", "p_type", "parts", "string_split(p_type, ' ')", lambda c: F.split(c, " "), "r25_split")
_texts("part", "p_brand", "code", "case when len(regexp_extract(p_brand, '[0-9]+')) < 5 then lpad(regexp_extract(p_brand, '[0-9]+'), 5, '0') else regexp_extract(p_brand, '[0-9]+') end", lambda c: F.lpad(F.regexp_extract(c, "[0-9]+", 0), 5, "0"), "r26_zero_pad")
_texts("report", "receive_date", "receive_day", _DAY("receive_date"), V.any_date, "r27_any_date")
_texts("drugcharacteristics_extended", "drug_batch_number", "kept", f"case when {_STRIP('drug_batch_number')} not in {_list(NULL_TOKENS)} then {_STRIP('drug_batch_number')} end", null_tokens, "r32_null_tokens")
_texts("events", "props", "k", "json_extract_string(props, '$.k')", lambda c: F.get_json_object(c, "$.k"), "r33_json_path")


@query("select safetyreportid, patient_onsetage, patient_onsetageunit, case patient_onsetageunit when 'Decade' then trunc(patient_onsetage) * 10 when 'Year' then floor(trunc(patient_onsetage)) when 'Month' then floor(trunc(patient_onsetage) / 12) when 'Week' then floor(trunc(patient_onsetage) / 52) when 'Day' then floor(trunc(patient_onsetage) / 365) when 'Hour' then floor(trunc(patient_onsetage) / 8760) end as years from patient", "patient")
def r28_age_in_years(patient):
    return patient.select("safetyreportid", "patient_onsetage", "patient_onsetageunit", V.age_in_years(F.col("patient_onsetage"), F.col("patient_onsetageunit")).alias("years"))


@query("select l_linenumber, case l_linenumber when 1 then 'first' when 2 then 'second' when 3 then 'third' end as meaning, lpad(cast(l_linenumber as varchar), 3, '0') as padded from (select distinct l_linenumber from lineitem)", "lineitem")
def r29_decode(lineitem):
    c = F.col("l_linenumber")
    three = {f"{i:03d}": f"{i:03d}" for i in range(1000)}
    return lineitem.select("l_linenumber").distinct().select(c, V.decode(c, {"1": "first", "2": "second", "3": "third"}).alias("meaning"), V.decode(c, three, 3).alias("padded"))


@query("select drug_separate_dosage_num as v, case when try_cast(drug_separate_dosage_num as double) = 1 then 1 else 0 end as flag, case when lower(trim(drug_separate_dosage_num)) in ('1', 'y', 'yes', 'true', 't') then 1 else 0 end as yes from (select distinct drug_separate_dosage_num from drugcharacteristics_extended)", DRUG)
def r30_flags(drug):
    c = F.col("drug_separate_dosage_num")
    return drug.select(c).distinct().select(c.alias("v"), V.flag(c).alias("flag"), V.yes(c).alias("yes"))


@query("select serious, death, hospitalization, greatest(case when serious = 1 then 1 else 0 end, case when death = 1 then 1 else 0 end, case when hospitalization = 1 then 1 else 0 end) recoded, count(*) n from adult_fact group by 1, 2, 3", FACT)
def r31_serious(fact):
    out = fact.groupBy("serious", "death", "hospitalization").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("recoded", V.serious(F.col("serious"), F.col("death"), F.col("hospitalization")))


@query("""with c as (select reporter_country k, count(*) n from adult_fact group by 1), t as (select k, n, format('{:,} ({:.1f}%)', n, round(100.0 * n / (select count(*) from adult_fact), 1)) as text from c)
select k, text, cast(replace(regexp_extract(text, '^([0-9,]+)', 1), ',', '') as bigint) n_back, cast(regexp_extract(text, '[(]([0-9.]+)%', 1) as double) p_back from t""", FACT)
def r34_count_percent(fact):
    counts = fact.groupBy(F.col("reporter_country").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = counts.withColumn("text", V.count_percent(F.col("n"), fact.agg(F.count(F.lit(1))).scalar()))
    n, p = V.parse_count_percent(F.col("text"))
    return out.select("k", "text", n.alias("n_back"), p.alias("p_back"))


# --- facts and dimensions ------------------------------------------------------------------------------------------
_FLAGS = ("congenital_anomali", "disabling", "life_threatening", "death", "other", "hospitalization")
_FACT_COLUMNS = "safetyreportid, medicinal_product, reaction_meddrapt, rxcui, drug_characterization, load_ts"
_KEPT = f"""receive_date between date '2004-01-01' and date '2025-12-31' and rxcui is not null and medicinal_product is not null
  and (len(ingredient) > 0 or len(faers_ingredients) > 0) and reporter_qualification not in {_list(X.EXCLUDED_REPORTERS)}"""


@query(f"""select safetyreportid, medicinal_product, reaction_meddrapt, n_rows, load_ts, priority from (
  select safetyreportid, medicinal_product, reaction_meddrapt, load_ts, priority,
    row_number() over (partition by safetyreportid, medicinal_product, reaction_meddrapt order by priority, load_ts) o,
    count(*) over (partition by safetyreportid, medicinal_product, reaction_meddrapt) n_rows
  from (select *, case when drug_characterization like 'Suspect%' then 0 when drug_characterization like 'Interacting%' then 1 when drug_characterization like 'Concomitant%' then 2 else 3 end priority from adult_fact where {_KEPT})) where o = 1""", FACT)
def r35_fact_rows(fact):
    kept = P.fact_filter(fact).withColumn("priority", P.priority(F.col("drug_characterization")))
    rows = kept.groupBy(*P.FACT_KEYS).agg(F.min(F.struct("priority", "load_ts")).alias("_r"), F.count(F.lit(1)).alias("n_rows"))
    return rows.select(*P.FACT_KEYS, "n_rows", "_r.load_ts", "_r.priority")


@query("select rxcui, list_extract(list(ingredient order by medicinal_product, mapping_method, array_to_string(ingredient, '|')), 1) ingredient, min(medicinal_product) medicinal_product, list_extract(list(mapping_method order by medicinal_product, mapping_method), 1) mapping_method from adult_fact where rxcui is not null group by 1", FACT)
def r36_drug_dimension(fact):
    return P.drug_dimension(fact)


_FIRST_REACTION = lambda key: f"""select safetyreportid, reaction_meddrapt, reaction_outcome, meddra_concept_id, meddra_concept_code, meddra_soc_names, meddra_soc_codes from (
  select *, row_number() over (partition by safetyreportid, {key} order by reaction_meddrapt, reaction_outcome nulls last) o from adult_fact where meddra_concept_id is not null) where o = 1"""  # noqa: E731


@query(_FIRST_REACTION("reaction_meddrapt"), FACT)
def r37_reaction_dimension(fact):
    return P.reaction_dimension(fact)


@query(_FIRST_REACTION("meddra_concept_id"), FACT)
def r38_standard_reactions(fact):
    return P.reaction_dimension(fact, "meddra_concept_id")


_LOOKUP = """select medicinal_product, rxcui, coalesce(rxnorm_ingredients, []) ingredient, lookup_hit mapping_method, coalesce(ingredients, []) faers_ingredients, len(coalesce(rxnorm_ingredients, [])) ingredient_count,
  len(coalesce(ingredients, [])) faers_ingredient_count, len(coalesce(rxnorm_ingredients, [])) > 1 or len(coalesce(ingredients, [])) > 1 is_combination_product
  from (select *, row_number() over (partition by medicinal_product order by rxcui) o from adult_drugs_enriched where medicinal_product is not null and rxcui is not null and (len(rxnorm_ingredients) > 0 or len(ingredients) > 0)) where o = 1"""
_MERGED = f"""select e.safetyreportid, cohort, e.medicinal_product, {_TITLE('trim(e.reaction_meddrapt)')} reaction_meddrapt, rxcui, ingredient, mapping_method, faers_ingredients, ingredient_count, faers_ingredient_count, is_combination_product, meddra_concept_id, meddra_concept_code, meddra_soc_names, meddra_soc_codes
from ({_EVENTS}) e join ({_LOOKUP}) l on e.medicinal_product = l.medicinal_product join pt_soc_dictionary d on {_TITLE('trim(e.reaction_meddrapt)')} = {_TITLE('meddra_concept_name')}"""


@query(_MERGED, "report", "patient", DRUG, "reactions", LIST, "pt_soc_dictionary")
def r73_fact_merge(report, patient, drug, reaction, listed, dictionary):
    """Events of both cohorts, the product look-up and the term dictionary, from the landed tables."""
    events = P.events(P.reports(report), P.patients(patient), P.drug_lines(drug), P.reaction_lines(reaction))
    rows = P.merged(events, P.product_lookup(listed), dictionary)
    return rows.select("safetyreportid", "cohort", "medicinal_product", "reaction_meddrapt", *P.LOOKUP, "meddra_concept_id", "meddra_concept_code", "meddra_soc_names", "meddra_soc_codes")


_ABOUT = f"select safetyreportid, max(serious) serious, max(death) death, min(reporter_country) reporter_country, min(reporter_qualification) reporter_qualification from adult_fact group by 1 having min(reporter_qualification) not in {_list(X.EXCLUDED_REPORTERS)}"


@query(f"select e.*, serious, death, reporter_country, reporter_qualification from ({_EVENTS}) e join ({_ABOUT}) a on e.safetyreportid = a.safetyreportid", "report", "patient", DRUG, "reactions", FACT)
def r74_six_way_join(report, patient, drug, reaction, fact):
    """Seriousness and reporter as tables of their own, as the landed report has neither."""
    by = fact.groupBy("safetyreportid")
    seriousness = by.agg(F.max("serious").alias("serious"), F.max("death").alias("death"))
    reporter = by.agg(F.min("reporter_country").alias("reporter_country"), F.min("reporter_qualification").alias("reporter_qualification"))
    return P.events(P.reports(report), P.patients(patient), P.drug_lines(drug), P.reaction_lines(reaction), seriousness=seriousness, reporter=reporter)


# --- tables and top lists ------------------------------------------------------------------------------------------
@query("""with c as (select unnest(['Male', 'Female', 'Other']) patient_sex), n as (select patient_sex, count(distinct safetyreportid) n from adult_fact group by 1)
select c.patient_sex, coalesce(n, 0) n, format('{:,} ({:.1f}%)', coalesce(n, 0), round(100.0 * coalesce(n, 0) / (select count(distinct safetyreportid) from adult_fact), 1)) as text from c left join n on c.patient_sex = n.patient_sex""", FACT)
def r39_category_counts(fact):
    categories = fact.sparkSession.createDataFrame([("Male",), ("Female",), ("Other",)], "patient_sex string")
    return R.category_counts(fact, "patient_sex", categories, "safetyreportid", fact.agg(F.count_distinct("safetyreportid")).scalar())


@query(" union all ".join(f"select '{c}' item, count(*) filter (where {c} = 1) n, count(*) total, round(100.0 * count(*) filter (where {c} = 1) / count(*), 1) percent from adult_fact" for c in ("serious", *_FLAGS)), FACT)
def r40_flag_rows(fact):
    return R.flag_rows(fact, ("serious", *_FLAGS))


@query("select case when k = 1 then 'One' else 'Multiple' end item, count(*) n from (select count(distinct rxcui) k from adult_fact group by safetyreportid) where k > 0 group by 1", FACT)
def r41_one_or_several(fact):
    return R.one_or_several(fact, "safetyreportid", "rxcui")


@query("select 0 ord, 'reports' section, count(distinct safetyreportid) n from adult_fact union all select 1, 'products', count(distinct medicinal_product) from adult_fact union all select 2, 'serious', count(distinct safetyreportid) from adult_fact where serious = 1 union all select 3, 'not serious', count(distinct safetyreportid) from adult_fact where serious = 0", FACT)
def r42_totals(fact):
    """One scan: an explode gives each row's sections, a distinct per section and key lets repeats go before the shuffle."""
    who = F.col("safetyreportid")
    sections = [(0, "reports", who), (1, "products", F.col("medicinal_product")), (2, "serious", F.when(F.col("serious") == 1, who)), (3, "not serious", F.when(F.col("serious") == 0, who))]
    rows = F.explode(F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(name).alias("section"), c.alias("k")) for i, name, c in sections))).alias("x")
    return fact.select(rows).select("x.*").groupBy("ord", "section").agg(F.count_distinct("k").alias("n"))


@query("select patient_sex, medicinal_product, n, rank from (select patient_sex, medicinal_product, n, cast(row_number() over (partition by patient_sex order by n desc, medicinal_product) as integer) rank from (select patient_sex, medicinal_product, count(*) n from adult_fact where medicinal_product is not null group by 1, 2)) where rank <= 10", FACT)
def r43_top_by_group(fact):
    return R.top(fact, ["patient_sex"], "medicinal_product", 10)


def _counts_by_sex(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reaction_meddrapt, n) for either sex, of the reactions it has, from one aggregation."""
    both = fact.filter(F.col("patient_sex").isin("Male", "Female")).groupBy("reaction_meddrapt", "patient_sex").agg(F.count_distinct("safetyreportid").alias("n"))
    return tuple(both.filter(F.col("patient_sex") == s).drop("patient_sex") for s in ("Male", "Female"))


_BY = lambda s: f"select reaction_meddrapt, count(distinct safetyreportid) n from adult_fact where patient_sex = '{s}' group by 1"


@query(f"select a.reaction_meddrapt, a.n n_a, b.n n_b, least(a.n, b.n) n_min from ({_BY('Male')}) a join ({_BY('Female')}) b on a.reaction_meddrapt = b.reaction_meddrapt order by n_min desc, 1 limit 10", FACT)
def r44_top_common(fact):
    return R.top_common(*_counts_by_sex(fact), "reaction_meddrapt", 10)


@query("""select medicinal_product, 'listed' kind from (select distinct medicinal_product from drugcharacteristics_extended where medicinal_product in (select medicinal_product from adult_drugs_enriched))
union all select medicinal_product, 'not listed' from (select distinct medicinal_product from drugcharacteristics_extended d where medicinal_product is not null and not exists (select 1 from adult_drugs_enriched e where e.medicinal_product = d.medicinal_product))""", DRUG, LIST)
def r45_semi_and_anti(drug, listed):
    names = drug.select("medicinal_product").filter(F.col("medicinal_product").isNotNull()).distinct()
    known = listed.select("medicinal_product")
    return names.join(known, "medicinal_product", "left_semi").withColumn("kind", F.lit("listed")).unionByName(names.join(known, "medicinal_product", "left_anti").withColumn("kind", F.lit("not listed")))


@query("""select 'record' as lvl, count(*) n, count(rxcui) n_mapped, round(100.0 * count(rxcui) / count(*), 2) percent from adult_fact
union all select 'unique', count(*), count(r), round(100.0 * count(r) / count(*), 2) from (select medicinal_product, max(rxcui) r from adult_fact where medicinal_product is not null group by 1)""", FACT)
def r46_coverage_levels(fact):
    each = fact.select("medicinal_product", "rxcui")
    once = each.filter(F.col("medicinal_product").isNotNull()).groupBy("medicinal_product").agg(F.max("rxcui").alias("rxcui"))
    of = lambda df, level: df.agg(F.count(F.lit(1)).alias("n"), F.count("rxcui").alias("n_mapped")).select(F.lit(level).alias("lvl"), "n", "n_mapped", V.percent(F.col("n_mapped"), F.col("n")).alias("percent"))
    return of(each, "record").unionByName(of(once, "unique"))


# --- record linkage ------------------------------------------------------------------------------------------------
_LINK_NAMES = "select distinct upper(trim(medicinal_product)) basename from adult_fact where medicinal_product is not null"
_WORDS = lambda c: f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> '')"
_BARE = f"(select basename, list_filter({_WORDS('basename')}, lambda w: w not in {_list(X.NOISE)}) w from n)"
_SKIPPED = " or ".join(f"contains(n.basename, '{w}')" for w in X.NO_DRUGS)
_CASCADE = f"""
with n as (select basename, list_filter([split_part(basename, ' ', 1), split_part(basename, ' ', 3)], lambda x: x <> '') ing from ({_LINK_NAMES})),
d as (select lower(trim(basename)) k, min(rxcui) r from adult_drugs_enriched where basename is not null and rxcui is not null and rxcui_tty in ('IN', 'MIN') group by 1),
sy as (select lower(trim(medicinal_product_norm)) k, min(basename) t from adult_drugs_enriched where medicinal_product_norm is not null and basename is not null group by 1),
br as (select lower(trim(basename)) k, min(upper(array_to_string(ingredients, ' '))) t from adult_drugs_enriched where basename is not null and len(ingredients) > 0 and rxcui_tty = 'BN' group by 1),
s3 as (select basename, i, t from (select basename, unnest(range(len(ing) + 1)) i, unnest([basename] || ing) x from n) join sy on k = lower(trim(x))),
s4 as (select basename, array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: list_position(w, w[i]) = i), lambda i: w[i]), ' ') bare from {_BARE}),
s5 as (select basename, i, t from (select basename, unnest(range(len(x))) i, unnest(x) x from (select basename, [basename] || case when len({_WORDS('basename')}) > 1 then list_filter({_WORDS('basename')}, lambda w: len(w) >= 4) else [] end x from n)) join br on k = lower(trim(x))),
c as (
  select basename, 0 rk, basename nm, 'basename' hit, 'rxnav_basename' src from n
  union all select basename, 10000 + i, x, 'ingredients', 'rxnav_ingredients' from (select basename, unnest(range(len(ing))) i, unnest(ing) x from n)
  union all select basename, 20000 + i, t, t, 'local_cid_fallback' from s3
  union all select basename, 30000, bare, 'suffix_strip:' || bare, 'suffix_strip' from s4 where bare <> '' and bare <> upper(basename)
  union all select basename, 40000 + 2 * i, t, t, 'chembl_brand' from s5
  union all select basename, 40001 + 2 * i, {_WORDS('t')}[1], t, 'chembl_brand' from s5),
f as (select basename, arg_min(d.r, rk) rxcui, arg_min(hit, rk) lookup_hit, arg_min(src, rk) source from c join d on d.k = lower(trim(nm)) where nm <> '' group by 1)
select n.basename, case when not ({_SKIPPED}) then rxcui end rxcui, case when {_SKIPPED} then 'not_found' else coalesce(lookup_hit, 'not_found') end lookup_hit,
  case when {_SKIPPED} then 'skipped_non_drug' else coalesce(source, 'not_found') end source
from n left join f on f.basename = n.basename"""


def _dictionaries(listed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Exact names of ingredients, synonyms, brands and a brand's international name, out of the product list."""
    exact = listed.filter(F.col("rxcui_tty").isin("IN", "MIN")).select(F.col("basename").alias("name"), "rxcui")
    brands = listed.filter((F.col("rxcui_tty") == "BN") & (F.size("ingredients") > 0)).select(F.col("basename").alias("name"), F.upper(F.array_join("ingredients", " ")).alias("title"), "rxcui")
    return exact, listed.select(F.col("medicinal_product_norm").alias("name"), F.col("basename").alias("title")), brands.select("name", "title"), brands.select("name", F.concat(F.lit("D"), "rxcui").alias("kegg_id"), "title")


def _link_names(fact: DataFrame) -> DataFrame:
    names = fact.filter(F.col("medicinal_product").isNotNull()).select(F.upper(F.trim("medicinal_product")).alias("basename")).distinct()
    parts = F.split("basename", " ")
    return names.withColumn("ingredients", F.filter(F.array_compact(F.array(F.get(parts, F.lit(0)), F.get(parts, F.lit(2)))), lambda w: w != ""))


@query(_CASCADE, FACT, LIST)
def r47_linkage_cascade(fact, listed):
    exact, synonyms, brands, _ = _dictionaries(listed)
    return L.cascade(_link_names(fact), exact, synonyms, brands).select("basename", "rxcui", "lookup_hit", "source")


@query(None, DRUG, LIST)
def r71_approximate_steps(drug, listed):
    """The steps that SQL has no function for: nearest names, and international names of brands."""
    exact, _, _, kegg = _dictionaries(listed)
    names = drug.select(N.strip_to_name(F.col("medicinal_product")).alias("basename")).filter(F.col("basename") != "").distinct().withColumn("ingredients", F.array().cast("array<string>"))
    return L.cascade(names, exact, approximate=exact, kegg=kegg).select("basename", "rxcui", "lookup_hit", "source")


@query("select medicinal_product, rxcui, coalesce(case when length(medicinal_product) % 2 = 0 then ing_source end, case when rxcui is null then null when lookup_hit = 'basename' then 'rxnav_basename' when lookup_hit = 'ingredients' then 'rxnav_ingredients' else 'rxnorm_enriched' end) src from adult_drugs_enriched", LIST)
def r72_ingredient_source(listed):
    known = F.when(F.length("medicinal_product") % 2 == 0, F.col("ing_source"))
    return listed.select("medicinal_product", "rxcui", L.ingredient_source(known, F.col("rxcui"), F.col("lookup_hit")).alias("src"))


@query(None, DRUG, LIST)
def r48_nearest_name(drug, listed):
    plain = drug.select(N.strip_to_name(F.col("medicinal_product")).alias("basename")).filter(F.col("basename") != "").distinct()
    return L.nearest(plain, "basename", "basename", listed.select(F.col("basename").alias("name"), "rxcui")).withColumnsRenamed({"_hit": "rxcui", "_as": "name"})


@query(None, DRUG)
def r49_clean_name(drug):
    return drug.select("medicinal_product").distinct().withColumn("clean", N.clean_name(F.col("medicinal_product")))


_ODD = " or ".join(f"regexp_matches(upper(medicinal_product), '{p}')" for p in X.SUSPICIOUS)


@query(f"""with u as (select medicinal_product, rxcui from adult_drugs_enriched union all select medicinal_product, rxcui from quarantine)
select medicinal_product, rxcui, case when rxcui is null and ({_ODD}) then 'no_rxcui_and_suspicious' when rxcui is null then 'no_rxcui' when {_ODD} then 'suspicious_name' end quarantine_reason
from u where rxcui is null or {_ODD}""", LIST, "quarantine")
def r50_quarantine(listed, out):
    both = R.union_all([listed.select("medicinal_product", "rxcui"), out.select("medicinal_product", "rxcui")])
    return L.split_quarantine(both)[1]


@query("select medicinal_product, rxcui, null as s08_quarantine_reason from adult_drugs_enriched union all select medicinal_product, rxcui, s08_quarantine_reason from quarantine", LIST, "quarantine")
def r51_union_missing_columns(listed, out):
    return R.union_all([listed.select("medicinal_product", "rxcui"), out.select("medicinal_product", "rxcui", "s08_quarantine_reason")])


@query("""select user_id, event_id, last_value(case when event_id % 3 = 0 then event_type end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and current row) filled,
case when row_number() over (partition by user_id, event_type order by event_id) = 1 then event_type else '' end shown from events""", "events")
def r52_fill_and_blank(events):
    sparse = events.withColumn("label", F.when(F.col("event_id") % 3 == 0, F.col("event_type")))
    return sparse.select("user_id", "event_id", R.forward_fill(sparse, "label", ["user_id"], ["event_id"]).alias("filled"), R.blank_repeats("event_type", ["user_id"], ["event_id"]).alias("shown"))


# --- lists, JSON and codes -----------------------------------------------------------------------------------------
@query("select distinct safetyreportid, meddra_concept_id, len(meddra_soc_names) n, meddra_soc_names[1] first_name, list_sort(list_distinct(meddra_soc_names)) names, list_sort(list_transform(meddra_soc_codes, lambda x: 'S' || x)) codes, len(meddra_soc_names) > 1 several from adult_fact where meddra_soc_names is not null", FACT)
def r53_list_functions(fact):
    c = F.col("meddra_soc_names")
    out = fact.filter(c.isNotNull()).select("safetyreportid", "meddra_concept_id", F.size(c).cast("bigint").alias("n"), F.get(c, F.lit(0)).alias("first_name"), V.distinct_list(c).alias("names"), F.array_sort(F.transform("meddra_soc_codes", lambda x: F.concat(F.lit("S"), x))).alias("codes"), (F.size(c) > 1).alias("several"))
    return out.distinct()


_texts(DRUG, "activesubstance_raw", "joined", """case when activesubstance_raw like '{%' then json_extract_string(activesubstance_raw, '$.activesubstancename') when activesubstance_raw like '[%' then array_to_string(json_extract_string(activesubstance_raw, '$[*].activesubstancename'), '|') else nullif(trim(activesubstance_raw), '') end""", V.joined_substances, "r54_joined_substances")


@query(f"select rxcui, {_SORTED('x')} ingredient from (select rxcui, unnest(ingredient) x from adult_fact where rxcui is not null) group by 1", FACT)
def r55_merged_lists(fact):
    return R.merged_lists(fact.filter(F.col("rxcui").isNotNull()), ["rxcui"], ["ingredient"]).filter(F.size("ingredient") > 0)


@query("select count(*) n_rows, count(distinct rxcui) + cast(bool_or(rxcui is null) as integer) n_unique_rxcui, count(distinct reporter_company) + cast(bool_or(reporter_company is null) as integer) n_unique_company from adult_fact", FACT)
def r56_output_summary(fact):
    return fact.agg(F.count(F.lit(1)).alias("n_rows"), V.n_unique(F.col("rxcui")).alias("n_unique_rxcui"), V.n_unique(F.col("reporter_company")).alias("n_unique_company"))


_texts(DRUG, "medicinal_product", "quoted", "url_encode(medicinal_product)", V.url_quoted, "r57_url_quote")


@query("select safetyreportid, case when list_contains(s, 'Fatal') and len(s) > 1 then 'partial' when list_contains(s, 'Fatal') then 'Fatal' when list_contains(s, 'Unknown') then 'Unknown' when list_contains(s, 'Recovered/resolved') then 'Recovered/resolved' end worst from (select safetyreportid, list(distinct reaction_outcome) s from adult_fact where reaction_outcome in ('Fatal', 'Unknown', 'Recovered/resolved') group by 1)", FACT)
def r58_worst_status(fact):
    of = ("Fatal", "Unknown", "Recovered/resolved")
    return fact.filter(F.col("reaction_outcome").isin(*of)).groupBy("safetyreportid").agg(F.collect_set("reaction_outcome").alias("s")).select("safetyreportid", V.worst_status(F.col("s"), of).alias("worst"))


@query("select basename, arg_min(rxcui, (case rxcui_tty when 'IN' then 0 when 'MIN' then 1 else 2 end, rxcui)) rxcui, arg_min(rxcui_tty, (case rxcui_tty when 'IN' then 0 when 'MIN' then 1 else 2 end, rxcui)) tty from adult_drugs_enriched where basename is not null group by 1", LIST)
def r59_best_by_type(listed):
    return L.best_by_type(listed.filter(F.col("basename").isNotNull()).select("basename", "rxcui", F.col("rxcui_tty").alias("tty")), "basename")


@query(f"select r.rxcui, {_SORTED('lower(x)')} rxnorm_ingredients from (select rxcui, unnest(rxnorm_ingredients) x from adult_drugs_enriched where rxcui_tty in ('IN', 'MIN')) r group by 1", LIST)
def r60_related_ingredients(listed):
    related = listed.select("rxcui", F.col("rxcui_tty").alias("tty"), F.explode("rxnorm_ingredients").alias("name"))
    ids = listed.filter(F.col("rxcui_tty").isin("IN", "MIN")).select("rxcui").distinct()
    return L.related_ingredients(ids, related)


@query(f"select medicinal_product, active_substance_name, case when active_substance_name is not null then list_filter(list_transform(regexp_split_to_array(active_substance_name, '\\\\|;| [|] '), lambda x: {_TRIM('x')}), lambda x: x <> '' and lower(x) not in ('none', 'null')) end parts from (select distinct medicinal_product, active_substance_name from drugcharacteristics_extended)", DRUG)
def r61_substance_parts(drug):
    out = drug.select("medicinal_product", "active_substance_name").distinct()
    return out.withColumn("parts", N.substances(F.col("active_substance_name")))


@query(f"select medicinal_product, n_products, case when upper(reporter_country) in ('US', 'USA') then 'US' when coalesce(reporter_country, '') = '' then 'Unknown' else 'Other' end place, case upper(patient_sex) when 'MALE' then 'Male' when 'FEMALE' then 'Female' else 'Unknown' end sex, case upper(trim(reporter_qualification)) when 'PHYSICIAN' then 'Physician' when 'PHARMACIST' then 'Pharmacist' when 'OTHER HEALTH-PROFESSIONAL' then 'Other health professional' when 'OTHER HEALTH PROFESSIONAL' then 'Other health professional' when 'LAWYER' then 'Lawyer' when 'CONSUMER' then 'Consumer or non-health professional' when 'NON-HEALTH PROFESSIONAL' then 'Consumer or non-health professional' else coalesce(trim(reporter_qualification), 'Null/unknown') end qualification from (select reporter_country, reporter_qualification, patient_sex, min(medicinal_product) medicinal_product, count(distinct medicinal_product) n_products from adult_fact group by 1, 2, 3)", FACT)
def r62_normalized_codes(fact):
    out = fact.groupBy("reporter_country", "reporter_qualification", "patient_sex").agg(F.min("medicinal_product").alias("medicinal_product"), F.count_distinct("medicinal_product").alias("n_products"))
    return out.select("medicinal_product", "n_products", V.country(F.col("reporter_country")).alias("place"), V.sex(F.col("patient_sex")).alias("sex"), V.qualification(F.col("reporter_qualification")).alias("qualification"))


@query("select o_orderpriority, o_orderstatus, sum(l_quantity) quantity, count(*) n, count(distinct o_custkey) customers from orders join lineitem on o_orderkey = l_orderkey where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01' group by 1, 2", "orders", "lineitem")
def r63_join_aggregate(orders, lineitem):
    lines = lineitem.filter((F.col("l_shipdate") >= "1996-01-01") & (F.col("l_shipdate") < "1997-01-01")).select("l_orderkey", "l_quantity")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).groupBy("o_orderpriority", "o_orderstatus").agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query(f"select coalesce(a.reaction_meddrapt, b.reaction_meddrapt) reaction_meddrapt, a.n n_a, b.n n_b from ({_BY('Male')}) a full join ({_BY('Female')}) b on a.reaction_meddrapt = b.reaction_meddrapt", FACT)
def r64_outer_merge(fact):
    """A full outer merge of two counts of one table is one aggregation; a null term has a row for either sex, as nulls don't join."""
    kept = fact.filter(F.col("patient_sex").isin("Male", "Female")).withColumn("_s", F.when(F.col("reaction_meddrapt").isNull(), F.col("patient_sex")))
    of = lambda s: F.nullif(F.count_distinct(F.when(F.col("patient_sex") == s, F.col("safetyreportid"))), F.lit(0))
    rows = kept.groupBy("reaction_meddrapt", "_s").agg(of("Male").alias("n_a"), of("Female").alias("n_b"), F.collect_set("patient_sex").alias("_has"))
    has = lambda s, c: F.when(F.array_contains("_has", s), F.coalesce(c, F.lit(0))).alias(c)
    return rows.select("reaction_meddrapt", has("Male", "n_a"), has("Female", "n_b"))


@query("""select medicinal_product, n from (select medicinal_product, count(*) n from adult_fact where rxcui is null and medicinal_product is not null group by 1
  having medicinal_product not in (select medicinal_product from adult_fact where rxcui is not null and medicinal_product is not null)) order by n desc, 1 limit 20""", FACT)
def r65_unmapped_by_frequency(fact):
    mapped = fact.filter(F.col("rxcui").isNotNull()).select("medicinal_product").distinct()
    left = fact.filter(F.col("medicinal_product").isNotNull()).join(mapped, "medicinal_product", "left_anti")
    return R.top(left, [], "medicinal_product", 20).select("medicinal_product", "n")


@query("select basename, arg_min(ingredients[1], (medicinal_product)) filter (where ingredients[1] is not null) ingredient, count(*) n from adult_drugs_enriched where basename is not null group by 1", LIST)
def r66_first_ingredient(listed):
    one = F.get("ingredients", F.lit(0))
    kept = listed.filter(F.col("basename").isNotNull())
    return kept.groupBy("basename").agg(F.min_by(one, F.when(one.isNotNull(), F.col("medicinal_product"))).alias("ingredient"), F.count(F.lit(1)).alias("n"))


@query(None, DRUG, LIST)
def r67_ingredient_status(drug, listed):
    """Of each substance text, whether its substances are names of the list's single ingredients."""
    named = drug.select("active_substance_name").filter(F.col("active_substance_name").isNotNull()).distinct()
    names = named.withColumn("names", N.substances(F.col("active_substance_name")))
    exact = listed.filter(F.col("rxcui_tty") == "IN").select(F.col("basename").alias("name"), "rxcui")
    out = L.ingredient_status(names, "names", exact, "active_substance_name")
    return out.withColumn("worst", V.worst_status(F.col("statuses")))


def strength_and_form():
    """A model by patterns, as batched inference takes it: strength, dosage form, and what stands before them."""
    import json
    import re

    strength, form = re.compile(r"\b\d+(?:\.\d+)?\s?(?:MG|MCG|ML|G|IU)\b", re.ASCII), re.compile(r"\b(?:" + "|".join(sorted(X.DOSAGE_FORMS, key=len, reverse=True)) + r")\b", re.ASCII)

    def answer(text: str) -> str:
        s, f = strength.search(text), form.search(text)
        name = text[: min((x.start() for x in (s, f) if x), default=len(text))]
        return json.dumps({"ingredients": [name] if name else None, "strength": s and s.group(), "dosage_form": f and f.group()})

    return lambda texts: [answer(t) for t in texts]


_FORMS = "|".join(sorted(X.DOSAGE_FORMS, key=len, reverse=True))
_CLEAN = lambda c: f"array_to_string(list_filter(string_split(regexp_replace(regexp_replace(upper({_TRIM(c)}), '\\.([A-Z]+)\\.', '\\1', 'g'), '[^A-Z0-9 ]', ' ', 'g'), ' '), lambda w: len(w) > 1 and not regexp_full_match(w, '[0-9]+|[0-9]+[A-Z]{{1,2}}|[A-Z]{{1,2}}[0-9]+')), ' ')"


@query(f"""with t as (select distinct upper(medicinal_product) t from drugcharacteristics_extended where medicinal_product is not null),
m as (select t, nullif(regexp_extract(t, '\\b[0-9]+(?:\\.[0-9]+)?\\s?(?:MG|MCG|ML|G|IU)\\b'), '') s, nullif(regexp_extract(t, '\\b(?:{_FORMS})\\b'), '') f,
  regexp_extract(t, '^(?s:(.*?))(?:\\b[0-9]+(?:\\.[0-9]+)?\\s?(?:MG|MCG|ML|G|IU)\\b|\\b(?:{_FORMS})\\b|$)', 1) n from t),
c as (select t, s, f, n, {_CLEAN('n')} i from m)
select t as text, case when n <> '' then [n] end ingredients, s strength, f dosage_form, case when i <> '' and i not in {_list(X.NON_INGREDIENTS)} and i not in {_list(X.SALTS)} then [i] end ingredient, case when i in {_list(X.SALTS)} then [i] end salt from c""", DRUG)
def r68_decompose_names(drug):
    texts = drug.select(F.upper("medicinal_product").alias("text"))
    answers = I.infer(texts, "text", strength_and_form)
    ingredient, salt = N.ingredients_and_salts(F.col("ingredients"))
    return answers.select("text", "ingredients", "strength", "dosage_form", ingredient.alias("ingredient"), salt.alias("salt"))


_Q = lambda s: f"regexp_replace({s}, '([A-Za-z0-9])[?]([A-Za-z0-9])', '\\1-\\2', 'g')"
_GREEKED = "s1"
for _g in X.GREEK:
    _GREEKED = f"regexp_replace({_GREEKED}, '(?i)[.]{_g}[.]', '{_g.lower()}-', 'g')"


@query(f"""with p as (select distinct medicinal_product from drugcharacteristics_extended), a as (select medicinal_product, {_TRIM('medicinal_product')} o from p),
b as (select *, translate(regexp_replace(regexp_replace(o, '[‘’]', chr(39), 'g'), '[“”]', '"', 'g'), '^', ' ') s1 from a),
c as (select *, {_Q(_Q(_GREEKED))} s2 from b),
d as (select *, {_TRIM("regexp_replace(regexp_replace(s2, '-{2,}', '-', 'g'), '[ \\t\\n\\x{0B}\\f\\r]+', ' ', 'g')")} s3 from c),
e as (select *, {_TRIM("regexp_replace(s3, '([^ \\t\\n\\x{0B}\\f\\r])[.]+$', '\\1')")} s4 from d)
select medicinal_product, coalesce(nullif(s4, ''), o, '') clean from e""", DRUG)
def r75_clean_name_as_typed(drug):
    """All steps of the normaliser but the compatibility forms, which SQL lacks."""
    return drug.select("medicinal_product").distinct().withColumn("clean", N.clean_name(F.col("medicinal_product"), compat=False))


@query(f"""with p as (select distinct medicinal_product from drugcharacteristics_extended where medicinal_product is not null),
b as (select medicinal_product, list_filter(regexp_extract_all(upper(medicinal_product), '[(](.*?)[)]', 1), lambda x: regexp_matches(x, '[+;]'))[1] b from p)
select medicinal_product, list_filter(list_transform(regexp_split_to_array(b, '[+;]'), lambda x: {_TRIM('x')}), lambda x: x <> '' and x not in {_list(X.BRACKET_QUALIFIERS)} and not regexp_matches(x, '^[0-9]')) parts,
case when lower({_TRIM('medicinal_product')}) not in ('', 'none', 'null') then {_TRIM('medicinal_product')} end kept from b""", DRUG)
def r76_brackets_and_nulls(drug):
    c = F.col("medicinal_product")
    return drug.select(c).filter(c.isNotNull()).distinct().select(c, N.bracket_ingredients(c).alias("parts"), N.text_or_null(c).alias("kept"))


@query("select distinct basename, nullif(trim(regexp_replace(regexp_replace(basename || ' (JAN/INN) second', '\\s*[(][^)]*[)]', '', 'g'), ';\\s*$', '')), '') inn from adult_drugs_enriched where basename is not null", LIST)
def r77_name_block(listed):
    block = F.concat(F.lit("ENTRY       D00001  Drug\nNAME        "), F.col("basename"), F.lit(" (JAN/INN) second;\n            Other (TN)\nFORMULA     C"))
    return listed.filter(F.col("basename").isNotNull()).select("basename", N.first_name(block).alias("inn")).distinct()


_REST = "age_years, patient_sex, receive_date, mostrecent_receive_date, lastupdate_date, serious, congenital_anomali, death, disabling, hospitalization, life_threatening, other, reporter_country, reporter_company, reporter_qualification, rxcui, mapping_method, ingredient, faers_ingredients, ingredient_count, faers_ingredient_count, is_combination_product, drug_characterization, drug_administration, drug_indication, reaction_outcome, meddra_concept_id, meddra_concept_code, meddra_soc_codes, meddra_soc_names"
_RECODED = f"greatest(case when serious = 1 then 1 else 0 end, {', '.join(f'case when {c} = 1 then 1 else 0 end' for c in _FLAGS)})"


@query(f"""select safetyreportid, medicinal_product, reaction_meddrapt, serious, coalesce(patient_sex, 'Unknown') patient_sex, coalesce(reporter_country, 'Unknown') reporter_country, coalesce(reporter_company, 'Unknown') reporter_company, coalesce(reaction_outcome, 'Unknown') reaction_outcome from (
  select *, row_number() over (partition by safetyreportid, medicinal_product, reaction_meddrapt order by priority, load_ts, {', '.join(f'{c.strip()} nulls first' for c in _REST.split(','))}) o
  from (select * replace ({_RECODED} as serious), case when drug_characterization like 'Suspect%' then 0 when drug_characterization like 'Interacting%' then 1 when drug_characterization like 'Concomitant%' then 2 else 3 end priority from adult_fact where {_KEPT})) where o = 1""", FACT)
def r78_fact_columns(fact):
    return P.facts(fact).select("safetyreportid", "medicinal_product", "reaction_meddrapt", "serious", "patient_sex", "reporter_country", "reporter_company", "reaction_outcome")


@query("""select safetyreportid, serious, text, case when serious = 1 then 1 else 0 end recoded, rxcui is not null selected from (select distinct safetyreportid, serious, rxcui,
  case when serious = 1 then 'The reaction resulted in ' || coalesce(reaction_outcome, 'harm') when serious = 0 then 'It did not result in any of the above' else 'other' end as text from adult_fact)""", FACT)
def r79_serious_texts(fact):
    text = F.when(F.col("serious") == 1, F.concat(F.lit("The reaction resulted in "), F.coalesce("reaction_outcome", F.lit("harm")))).when(F.col("serious") == 0, "It did not result in any of the above").otherwise("other")
    out = R.with_column_if_absent(fact.select("safetyreportid", "serious", "rxcui", text.alias("text")).distinct(), "is_selected_case", F.col("rxcui").isNotNull())
    out = out.withColumns({"recoded": V.serious(F.col("text")), "selected": F.coalesce("is_selected_case", F.lit(False)) == True})  # noqa: E712
    return R.select_existing(out, ("safetyreportid", "serious", "text", "absent", "recoded", "selected"))


# --- sources and sinks: written to the shared folder, read back -----------------------------------------------------
def _written(name: str, sql: str | None, *tables: str):
    """Registers a query that writes its tables below a folder of its own and reads them back."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, d: f(spark, shared_folder(spark), *(read(spark, d, t) for t in tables))
        if sql:
            SQL[name] = sql
        return f

    return register


@_written("r81_delimited_files", f"select key, {_NULLED('value')} as value, {_NULLED('safetyreportid')} safetyreportid, case when len(key) % 2 = 0 then entry end entry from patient_drug_openfda where key not in {_list(NULL_TOKENS)}", "patient_drug_openfda")
def _delimited_files(spark, folder, openfda):
    """Files of two layouts in one folder, packed, read by the names of their columns."""
    even = F.length("key") % 2 == 0
    writers.write(openfda.filter(even).select("key", "value", "safetyreportid", "entry"), f"{folder}/a", kind="csv")
    writers.write(openfda.filter(~even).select("safetyreportid", "value", F.lit("x").alias("other"), "key"), f"{folder}/b", kind="csv")
    return readers.read_delimited(spark, f"{folder}/*", ("key", "value", "safetyreportid", "entry"), {"entry": "bigint"}).filter(F.col("key").isNotNull())


@_written("r82_diagnosed_files", "select 'a' part, cast(null as varchar) reason union all select 'b', 'missing_cols' union all select 'c', 'empty_after_filter'", "pt_soc_dictionary")
def _diagnosed_files(spark, folder, terms):
    names = terms.select(F.col("meddra_concept_name").alias("key")).coalesce(1)
    writers.write(names, f"{folder}/a", kind="csv")
    writers.write(names.withColumnRenamed("key", "other"), f"{folder}/b", kind="csv")
    writers.write(names.select(F.lit("none").alias("key")), f"{folder}/c", kind="csv")
    first = [r[0] for r in terms.select("meddra_concept_name").limit(1).collect()]
    found = readers.diagnose(spark, f"{folder}/*", ("key",), ("key", first))
    return found.select(F.regexp_extract("file", "/([abc])/[^/]*$", 1).alias("part"), "reason")


@_written("r83_vocabulary_file", "select meddra_concept_id, meddra_concept_name, meddra_concept_code from pt_soc_dictionary", "pt_soc_dictionary")
def _vocabulary_file(spark, folder, terms):
    terms.select("meddra_concept_id", "meddra_concept_name", "meddra_concept_code").write.option("sep", "\t").option("quote", "").option("header", True).csv(f"{folder}/v")
    return readers.read_vocabulary(spark, f"{folder}/v", "meddra_concept_id bigint, meddra_concept_name string, meddra_concept_code string")


_SYNONYMS = """with n as (select distinct lower(trim(basename)) k from adult_drugs_enriched where basename is not null),
s as (select distinct cast(rxcui as bigint) id, medicinal_product_norm t from adult_drugs_enriched where medicinal_product_norm is not null and try_cast(rxcui as bigint) is not null),
i as (select k, min(id) id from s join n on k = lower(trim(t)) group by 1)"""


@_written("r84_synonym_files", _SYNONYMS + ", t as (select cast(rxcui as bigint) id, min(basename) title from adult_drugs_enriched where basename is not null and try_cast(rxcui as bigint) is not null group by 1) select k as name, title, (select count(*) from s where s.id in (select id from s join n on k = lower(trim(t)))) n_all from i join t on i.id = t.id", LIST)
def _synonym_files(spark, folder, listed):
    ids = listed.filter(F.col("rxcui").try_cast("bigint").isNotNull())
    tsv = lambda df, name: df.distinct().write.option("sep", "\t").option("quote", "").csv(f"{folder}/{name}")
    tsv(ids.filter(F.col("medicinal_product_norm").isNotNull()).select("rxcui", "medicinal_product_norm"), "synonyms")
    tsv(ids.filter(F.col("basename").isNotNull()).groupBy("rxcui").agg(F.min("basename")), "titles")
    names = listed.filter(F.col("basename").isNotNull()).select("basename")
    table = spark.read.csv(f"{folder}/synonyms", sep="\t", quote="", schema="id bigint, text string")
    n_all = readers.all_synonyms(table, names).agg(F.count(F.lit(1))).scalar()
    return readers.synonyms(spark, f"{folder}/synonyms", f"{folder}/titles", names).withColumn("n_all", n_all)


@_written("r85_written_batches", "select reaction_meddrapt, n, (select count(*) from reactions) n_written, row_number() over (order by n desc, reaction_meddrapt) as place from (select reaction_meddrapt, count(*) n from reactions where reaction_meddrapt is not null group by 1)", "reactions")
def _written_batches(spark, folder, reactions):
    """Two batches, written apart and read in the order of a column; a finished output isn't written again."""
    n_written = writers.write(reactions, f"{folder}/all")
    counts = reactions.filter(F.col("reaction_meddrapt").isNotNull()).groupBy("reaction_meddrapt").agg(F.count(F.lit(1)).alias("n"))
    places = R.numbered(counts.withColumn("m", -F.col("n")), ["m", "reaction_meddrapt"], "place").select("reaction_meddrapt", "n", F.lit(n_written).cast("bigint").alias("n_written"), F.col("place").cast("bigint").alias("place"))
    for i in (0, 1):
        writers.write(places.filter(F.col("place") % 2 == i), f"{folder}/batch{i}")
        if writers.write(places.limit(0), f"{folder}/batch{i}", resume=True) is not None:
            raise AssertionError("a finished batch was written again")
    return writers.merge_batches(spark, [f"{folder}/batch{i}" for i in (0, 1)], "place")


@_written("r86_first_of_sources", "select nullif(safetyreportid, '') safetyreportid, patient_custom_master_age age from patient", "patient")
def _first_of_sources(spark, folder, patient):
    """The packed text is taken, as there is no parquet of the table; an empty text comes back as null."""
    writers.write(patient.select("safetyreportid", F.col("patient_custom_master_age").alias("age")), f"{folder}/p.csv", kind="csv")
    out = readers.read_first_of(spark, [f"{folder}/p.parquet", f"{folder}/p.csv"], ["safetyreportid", "age"])
    return out.select("safetyreportid", F.col("age").try_cast("double").alias("age"))


@_written("r87_landed_stream", T.SQL["p2_found"], "raw_reports")
def _landed_stream(spark, folder, raw):
    """Files that arrive in two lots, each taken once."""
    for i in (0, 1):
        raw.filter(F.col("record_id") % 2 == i).select("record_id", "payload").write.mode("append").parquet(f"{folder}/in")
        landing.land(spark, f"{folder}/in", f"{folder}/out", f"{folder}/mark").awaitTermination()
    return S.children(landing.landed(spark, f"{folder}/out"))


@query("select event_type, strftime(ts, '%Y-%m') as month, count(*) n, sum(value) total, max(value) - min(value) spread from events where event_type <> 'click' group by 1, 2", "events")
def r69_monthly(events):
    kept = events.filter(F.col("event_type") != "click")
    return kept.groupBy("event_type", F.date_format("ts", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), (F.max("value") - F.min("value")).alias("spread"))
