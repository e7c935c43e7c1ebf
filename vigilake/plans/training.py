"""Queries of the general data problems (p1, p2, p3, p6) over the whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.functions.text import plain_number_id, squeeze_upper, strip
from vigilake.operators import orphans as O
from vigilake.operators import shred as S
from vigilake.operators import skew as K
from vigilake.operators import wide as W
from vigilake.runtime import read

HEAVY_SHARE = 0.02


def p1_wide(spark: SparkSession, d: str) -> DataFrame:
    return W.widen(read(spark, d, "patient_drug_openfda"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return W.filled(p1_wide(spark, d))


def _table(node: S.Node):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return S.table(S.shred(read(spark, d, "raw_reports"), only=node), node)

    return run


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return S.children(S.shred(read(spark, d, "raw_reports")))


def p2_openfda(spark: SparkSession, d: str) -> DataFrame:
    """Problem 1's input out of the raw reports: the drugs' openFDA blocks as attribute rows."""
    return S.openfda_rows(_table(S.DRUG)(spark, d))


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    fact = read(spark, d, "adult_fact").select("rxcui", "reaction_meddrapt", "safetyreportid")
    return K.key_counts(fact, {"rxcui": strip(F.col("rxcui")), "reaction_meddrapt": F.upper(strip(F.col("reaction_meddrapt")))}, F.col("safetyreportid"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return K.heavy(p3_counts(spark, d), HEAVY_SHARE)


def p3_ages(spark: SparkSession, d: str) -> DataFrame:
    """Mode and exact percentiles of the age per rxcui, from weighted ages."""
    fact = read(spark, d, "adult_fact")
    return K.profile(K.compress(fact, {"rxcui": strip(F.col("rxcui"))}, F.col("age_years")), (0.5, 0.9)).filter(F.col("key_value").isNotNull())


def p3_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Distinct outcomes and the most frequent one (a text) per reaction."""
    fact = read(spark, d, "adult_fact")
    return K.profile(K.compress(fact, {"reaction_meddrapt": F.upper(strip(F.col("reaction_meddrapt")))}, F.col("reaction_outcome"))).filter(F.col("key_value").isNotNull())


def _orphans(spark: SparkSession, d: str, ends: bool = False) -> DataFrame:
    """``ends``: whether a withdrawal ends a loaded report's validity. In the problem's statement it doesn't."""
    at, key = F.col("load_ts"), plain_number_id(F.col("safetyreportid"))
    parents = O.intervals(read(spark, d, "report"), key, at, read(spark, d, "report_nullified"), key, F.col("nullified_ts"))
    own = None
    for name in ("patient", "reactions", "drugcharacteristics_extended"):
        refs = O.references(read(spark, d, name), name, key, at, F.lit(None).cast("string").alias("holder"))
        own = refs if own is None else own.unionByName(refs)
    product = squeeze_upper(F.col("medicinal_product"))
    listed = O.intervals(read(spark, d, "adult_drugs_enriched"), product, None, read(spark, d, "quarantine"), product)
    facts = O.references(read(spark, d, "adult_fact"), "adult_fact", product, at, key.alias("holder"))
    columns = ("child_table", "period", "key", "holder", "kind")
    return O.orphans(own, parents, ends).select(*columns).unionByName(O.orphans(facts, listed).select(*columns))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = _orphans(spark, d)
    own = F.when(F.col("child_table") == "adult_fact", F.col("holder")).otherwise(F.col("key"))
    return found.select("child_table", "period", own.alias("safetyreportid"), F.col("key").alias("ref_value"), "kind")


def p6_by_period(spark: SparkSession, d: str) -> DataFrame:
    return O.by_period(_orphans(spark, d))


def p6_ended(spark: SparkSession, d: str) -> DataFrame:
    """As ``p6_found`` for the reports' children, with a withdrawal after the last load ending the report's validity."""
    found = _orphans(spark, d, ends=True).filter(F.col("child_table") != "adult_fact")
    return found.select("child_table", "period", F.col("key").alias("safetyreportid"), "kind")


QUERIES = {
    "p1_found": p1_found,
    "p1_wide": p1_wide,
    "p2_found": p2_found,
    "p2_openfda": p2_openfda,
    "p2_reports": _table(S.REPORT),
    "p2_drugs": _table(S.DRUG),
    "p2_substances": _table(S.SUBSTANCE),
    "p2_recurrences": _table(S.RECURRENCE),
    "p2_reactions": _table(S.REACTION),
    "p3_found": p3_found,
    "p3_counts": p3_counts,
    "p3_ages": p3_ages,
    "p3_outcomes": p3_outcomes,
    "p6_found": p6_found,
    "p6_by_period": p6_by_period,
    "p6_ended": p6_ended,
}

# SQL for the same results, written independently of the operators.
_CELLS = r"""
with raw as (
  select safetyreportid, coalesce(entry, 0) entry,
         regexp_replace(regexp_replace(lower(key), '[\s._-]+', '', 'g'), '^openfda', '') k,
         regexp_replace(value, '^\s+|\s+$', '', 'g') v
  from patient_drug_openfda),
kept as (select * from raw where v is not null and v not in ('', 'NA', 'NaN', 'null', 'NULL')),
cells as (
  select safetyreportid, entry, k,
    v as text,
    case when k = 'rxcui' and regexp_full_match(v, '[+-]?\d+(\.0+)?') then try_cast(regexp_replace(v, '\..*$', '') as bigint) end whole,
    case when k = 'strengthmg' and regexp_full_match(v, '[+-]?(\d+([.,]\d*)?|[.,]\d+)([eE][+-]?\d+)?') then try_cast(replace(v, ',', '.') as double) end number,
    case when k <> 'isoriginalpackager' then null when lower(v) in ('true', 'yes', 'y', '1') then true when lower(v) in ('false', 'no', 'n', '0') then false end flag,
    case when k <> 'effectivetime' then null
         when regexp_full_match(v, '\d{8}') then cast(try_strptime(v, '%Y%m%d') as date)
         when regexp_full_match(v, '\d{4}-\d{1,2}-\d{1,2}') then cast(try_strptime(v, '%Y-%m-%d') as date)
         when regexp_full_match(v, '\d{4}/\d{1,2}/\d{1,2}') then cast(try_strptime(v, '%Y/%m/%d') as date)
         when regexp_full_match(v, '\d{1,2} [A-Za-z]{3} \d{4}') then cast(try_strptime(v, '%d %b %Y') as date) end dt
  from kept),
wide as (
  select safetyreportid, entry,
    list_sort(list(distinct whole) filter (where whole is not null)) rxcui,
    %s,
    list_sort(list(distinct dt) filter (where dt is not null)) effective_time,
    bool_or(flag) is_original_packager,
    list_sort(list(distinct number) filter (where number is not null)) strength_mg
  from cells
  where k in (%s)
  group by safetyreportid, entry),
good as (select * from wide where %s)
"""
_TEXTS = [a.name for a in W.OPENFDA if a.kind == "string"]
_CELLS = _CELLS.replace("%Y%m%d", "#1").replace("%Y-%m-%d", "#2").replace("%Y/%m/%d", "#3").replace("%d %b %Y", "#4") % (
    ", ".join(f"list_sort(list(distinct text) filter (where k = '{n.replace('_', '')}')) {n}" for n in _TEXTS),
    ", ".join(f"'{a.name.replace('_', '')}'" for a in W.OPENFDA),
    " or ".join(f"{a.name} is not null" for a in W.OPENFDA),
)
_CELLS = _CELLS.replace("#1", "%Y%m%d").replace("#2", "%Y-%m-%d").replace("#3", "%Y/%m/%d").replace("#4", "%d %b %Y")

# An array as it stands, an object as an array of one; elements with their positions, nulls left out.
_EACH = lambda table, value, alias: f"(select *, unnest(range(len(a))) {alias}_at, unnest(a) {alias} from (select *, case json_type({value}) when 'ARRAY' then cast({value} as json[]) when 'OBJECT' then [{value}] else [] end a from {table}))"
_SHREDDED = f"""
with recursive good as (select record_id, cast(payload as json) j from raw_reports where json_valid(payload) and json_type(cast(payload as json)) = 'OBJECT'),
roots as (select record_id, unnest(range(len(a))) report_pos, unnest(a) r from (
  select record_id, case json_type(j->'results') when 'ARRAY' then cast(j->'results' as json[]) when 'OBJECT' then [j->'results'] else [j] end a from good)),
reports as (select record_id, report_pos, r, r->>'safetyreportid' safetyreportid from roots where json_type(r) = 'OBJECT'),
react as (select record_id, report_pos, safetyreportid, case when json_type(x) = 'VARCHAR' then case when json_valid(x->>'$') then cast(x->>'$' as json) end else x end x from (select *, r->'patient'->'reaction' x from reports)),
reactions as (select record_id, report_pos, safetyreportid, e_at entry, e from {_EACH('react', 'x', 'e')} where json_type(e) <> 'NULL'),
drugs as (select record_id, report_pos, safetyreportid, e_at entry, e from {_EACH("(select *, r->'patient'->'drug' x from reports)", 'x', 'e')} where json_type(e) <> 'NULL'),
subs as (select record_id, report_pos, safetyreportid, entry, case when json_type(x) = 'VARCHAR' then json_object('activesubstancename', x) else x end x from (select *, e->'activesubstance' x from drugs)),
substances as (select record_id, report_pos, safetyreportid, entry, s_at sub_entry, case when json_type(s) = 'VARCHAR' then json_object('activesubstancename', s) else s end s from {_EACH('subs', 'x', 's')} where json_type(s) <> 'NULL'),
recurrences as (select record_id, report_pos, safetyreportid, entry, s_at sub_entry, s from {_EACH("(select *, e->'drugrecurrence' x from drugs)", 'x', 's')} where json_type(s) <> 'NULL')
"""


def _leaves(node: S.Node, value: str) -> str:
    steps = lambda p: "".join(f"->'{x}'" for x in p[:-1]) + f"->>'{p[-1]}'"
    return ", ".join(f"{value}{steps(p)} {p[-1]}" for p in node.leaves if p != ("safetyreportid",))


_KEYS = """
with k as (select 'rxcui' key_field, trim(rxcui) key_value, safetyreportid from adult_fact
           union all select 'reaction_meddrapt', upper(trim(reaction_meddrapt)), safetyreportid from adult_fact),
c as (select key_field, key_value, count(*) n_rows, count(distinct safetyreportid) n_reports,
             count(*) / (select count(*) from adult_fact) share
      from k where key_value is not null group by 1, 2)
"""


def _plain(c: str) -> str:
    t = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    return f"case when {t} = '' then null when regexp_full_match({t}, '[0-9]+([.]0*)?') then cast(try_cast(regexp_replace({t}, '[.].*$', '') as bigint) as varchar) else {t} end"


def _product(c: str) -> str:
    return f"nullif(upper(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), '')"


_CHILDREN = " union all ".join(f"select '{t}' child_table, strftime(load_ts, '%Y-%m') period, {_plain('safetyreportid')} id, load_ts from {t}" for t in ("patient", "reactions", "drugcharacteristics_extended"))
_ORPHANS = f"""
with parent as (select {_plain("safetyreportid")} id, min(load_ts) first_load from report group by 1),
gone as (select distinct {_plain("safetyreportid")} id from report_nullified),
listed as (select distinct {_product("medicinal_product")} p from adult_drugs_enriched),
out as (select distinct {_product("medicinal_product")} p from quarantine),
own as (
  select distinct child_table, period, c.id safetyreportid, c.id ref_value,
         case when p.id is not null then 'late' when g.id is not null then 'deleted' else 'missing' end kind
  from ({_CHILDREN}) c left join parent p on c.id = p.id left join gone g on c.id = g.id
  where c.id is not null and (p.id is null or p.first_load > c.load_ts)),
fact as (
  select distinct 'adult_fact' child_table, strftime(load_ts, '%Y-%m') period, {_plain("safetyreportid")} safetyreportid,
         {_product("medicinal_product")} ref_value,
         case when {_product("medicinal_product")} in (select p from out where p is not null) then 'deleted' else 'missing' end kind
  from adult_fact
  where {_product("medicinal_product")} is not null and {_product("medicinal_product")} not in (select p from listed where p is not null)),
found as (select * from own union all select * from fact)
"""
SQL: dict[str, str] = {
    "p1_wide": _CELLS + "select * from good",
    "p1_found": _CELLS + " union all ".join(f"select safetyreportid, entry, '{a.name}' attribute from good where {a.name} is not null" for a in W.OPENFDA),
    "p2_found": _SHREDDED
    + """select record_id, safetyreportid, 'reaction' child, entry, cast(-1 as bigint) sub_entry from reactions union all select record_id, safetyreportid, 'drug', entry, -1 from drugs
union all select record_id, safetyreportid, 'activesubstance', entry, sub_entry from substances union all select record_id, safetyreportid, 'drugrecurrence', entry, sub_entry from recurrences""",
    "p2_reports": _SHREDDED + f"select record_id, report_pos, safetyreportid, {_leaves(S.REPORT, 'r')} from reports",
    "p2_drugs": _SHREDDED + f"select record_id, report_pos, safetyreportid, entry, {_leaves(S.DRUG, 'e')} from drugs",
    "p2_substances": _SHREDDED + f"select record_id, report_pos, safetyreportid, entry, sub_entry, {_leaves(S.SUBSTANCE, 's')} from substances",
    "p2_recurrences": _SHREDDED + f"select record_id, report_pos, safetyreportid, entry, sub_entry, {_leaves(S.RECURRENCE, 's')} from recurrences",
    "p2_reactions": _SHREDDED + f"select record_id, report_pos, safetyreportid, entry, {_leaves(S.REACTION, 'e')} from reactions",
    "p2_openfda": _SHREDDED
    + """, block as (select safetyreportid, entry, e->'openfda' o, unnest(json_keys(e->'openfda')) as "key" from drugs where json_type(e->'openfda') = 'OBJECT')
select "key", value, safetyreportid, entry from (select *, unnest(case when json_type(o->"key") = 'ARRAY' then cast(o->"key" as varchar[]) else [o->>"key"] end) as value from block) where value is not null""",
    "p3_counts": _KEYS + "select * from c",
    "p3_found": _KEYS + "select key_field, key_value from c where share >= 0.02",
    "p3_ages": """
with r as (select trim(rxcui) k, age_years v from adult_fact where rxcui is not null),
w as (select k, v, count(*) n from r group by 1, 2),
m as (select k, v, n, row_number() over (partition by k order by n desc, v) o from w where v is not null),
t as (select k, count(*) n_rows, count(distinct v) n_values, quantile_cont(cast(v as double), 0.5) p50, quantile_cont(cast(v as double), 0.9) p90 from r group by 1)
select 'rxcui' key_field, t.k key_value, n_rows, n_values, m.n mode_weight, m.v mode_value, p50, p90 from t left join m on t.k = m.k and m.o = 1""",
    "p3_outcomes": """
with w as (select upper(trim(reaction_meddrapt)) k, reaction_outcome v, count(*) n from adult_fact where reaction_meddrapt is not null group by 1, 2),
m as (select k, v, n, row_number() over (partition by k order by n desc, v) o from w where v is not null)
select 'reaction_meddrapt' key_field, w.k key_value, cast(sum(w.n) as bigint) n_rows, count(w.v) n_values, any_value(m.n) mode_weight, any_value(m.v) mode_value from w left join m on w.k = m.k and m.o = 1 group by 2""",
    "p6_found": _ORPHANS + "select * from found",
    "p6_ended": f"""
with parent as (select {_plain("safetyreportid")} id, min(load_ts) first_load, max(load_ts) last_load from report group by 1),
gone as (select {_plain("safetyreportid")} id, max(nullified_ts) t from report_nullified group by 1),
refs as (select child_table, period, id, min(load_ts) a, max(load_ts) b from ({_CHILDREN}) where id is not null group by 1, 2, 3),
k as (select child_table, period, r.id safetyreportid, case when p.first_load > a then 'late' when p.id is not null then case when g.t >= p.last_load and b >= g.t then 'deleted' end when g.id is not null then 'deleted' else 'missing' end kind
      from refs r left join parent p on r.id = p.id left join gone g on r.id = g.id)
select * from k where kind is not null""",
    "p6_by_period": _ORPHANS + "select child_table, period, kind, count(*) n_references, count(distinct ref_value) n_keys from found group by 1, 2, 3",
}
