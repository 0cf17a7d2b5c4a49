"""Shared definitions for the SQL statements that check the queries.

Each entry states one derived table independently of the DataFrame code, in
terms of the given tables and of earlier entries.
"""

from __future__ import annotations

import re


def rounded(expression: str, digits: int) -> str:
    """Half-up rounding of the decimal reading of a double."""
    return f"round(cast({expression} as decimal(28, 12)), {digits})::double"


def seconds(moment: str) -> str:
    return f"(epoch_us({moment}) // 1000000)"


def hours(start: str, end: str, digits: int) -> str:
    return rounded(f"({seconds(end)} - {seconds(start)}) / 3600.0", digits)


def ordinal(salt: str, key: str) -> str:
    return f"('0x' || substr(md5('{salt}::' || {key}), 1, 8))::bigint"


def split_of(bucket: str) -> str:
    return (f"case when {bucket} < 70 then 'train' when {bucket} < 85 then 'validation' "
            "else 'test' end")


def first_row(source: str, keys: str, order: str, columns: str = "*") -> str:
    return (f"select {columns} from {source} qualify row_number() over "
            f"(partition by {keys} order by {order}) = 1")


NAMES_OF_LABEL = r"""rtrim(substr(case when core = '' then 'unnamed'
  when regexp_matches(core, '^[0-9]') then 'lab_' || core else core end, 1, 55), '_')"""


def label_core(label: str) -> str:
    text = f"lower(trim({label}))"
    for symbol, word in (("%", "pct"), ("/", "per"), ("+", "plus"), ("#", "num")):
        text = f"replace({text}, '{symbol}', ' {word} ')"
    return f"trim(regexp_replace({text}, '[^0-9a-z]+', '_', 'g'), '_')"


DEFINITIONS: dict[str, str] = {}

# -- orders view ------------------------------------------------------------

DEFINITIONS["raw_patients"] = """
select * from (
  select c_custkey as subject_id,
    case c_mktsegment when 'BUILDING' then 'm' when 'MACHINERY' then 'MALE'
      when 'AUTOMOBILE' then ' f ' when 'HOUSEHOLD' then 'Female'
      when 'FURNITURE' then 'X' end as gender,
    floor(c_acctbal / 100)::int as anchor_age, (2100 + c_nationkey)::int as anchor_year,
    'group ' || (c_nationkey % 5) as anchor_year_group,
    case when c_acctbal < 0 then timestamp '2110-01-01' + to_days(c_nationkey::int) end as dod
  from customer)
union all
select c_custkey, 'MALE', floor(c_acctbal / 100)::int, (2101 + c_nationkey)::int,
  'group ' || (c_nationkey % 5),
  case when c_acctbal < 0 then timestamp '2110-01-01' + to_days(c_nationkey::int) end
from customer"""

DEFINITIONS["first_admissions"] = """
select o_custkey as subject_id, o_orderkey as hadm_id, o_orderdate as admittime,
  case when o_orderstatus = 'O' then null
    when o_orderkey % 50 = 0 then o_orderdate - interval 5 hour
    else o_orderdate + to_days((1 + o_orderkey % 180)::int) end as dischtime,
  o_orderpriority as admission_type, 'WARD ' || (o_orderkey % 7) as admission_location,
  o_orderstatus as discharge_location, o_orderstatus as insurance,
  substr(o_orderpriority, 1, 1) as marital_status, substr(o_orderpriority, 3) as race,
  case when o_orderkey % 25 = 0 then 1 end as hospital_expire_flag
from orders"""

DEFINITIONS["raw_admissions"] = """
select * from first_admissions
union all
select * replace (admittime + interval 1 day as admittime, dischtime + interval 1 day as dischtime)
from first_admissions"""

DEFINITIONS["raw_diagnoses"] = """
select o_custkey as subject_id, l_orderkey as hadm_id, l_linenumber as seq_num,
  ' ' || p_brand || '.' || p_type || ' ' as icd_code,
  case when l_linenumber = 7 then 9 when l_linenumber <> 3 then 10 end as icd_version
from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey"""

DEFINITIONS["raw_dictionary"] = """
select p_partkey as itemid, '  ' || p_name || ' ' as label, p_brand as fluid, p_type as category
from part
union all select p_partkey, 'zz ' || p_name, p_brand, p_type from part"""

DEFINITIONS["raw_labs"] = """
select l_orderkey as hadm_id, l_partkey as itemid, l_shipdate as charttime,
  case when l_quantity % 10 <> 0 then l_extendedprice end as valuenum,
  l_returnflag as valueuom, l_linestatus as flag
from lineitem"""

DEFINITIONS["patients"] = f"""
select subject_id, gender, anchor_age, anchor_age >= 18 as is_adult, anchor_year,
  anchor_year_group, dod
from ({first_row('''(
  select subject_id,
    case when upper(trim(gender)) in ('M', 'MALE') then 'M'
      when upper(trim(gender)) in ('F', 'FEMALE') then 'F' end as gender,
    case when anchor_age between 0 and 120 then anchor_age end as anchor_age,
    anchor_year, anchor_year_group, dod
  from raw_patients where subject_id is not null)''', 'subject_id',
  'anchor_year nulls last, gender nulls last, anchor_age nulls last')})"""

DEFINITIONS["admissions"] = f"""
select subject_id, hadm_id, admittime, dischtime, {hours('admittime', 'dischtime', 2)} as los_hours,
  year(admittime)::int as admit_year, admission_type, admission_location, discharge_location,
  insurance, marital_status, race, died_in_hospital
from ({first_row('''(
  select * exclude (hospital_expire_flag),
    coalesce(hospital_expire_flag, 0) = 1 as died_in_hospital
  from raw_admissions
  where hadm_id is not null and subject_id is not null and admittime is not null
    and (dischtime is null or dischtime >= admittime))''', 'hadm_id', 'admittime')})"""

DEFINITIONS["diagnoses"] = f"""
select *,
  icd_version = 10 and icd_code like 'BRAND#25ECONOMY%' as is_angina,
  icd_version = 10 and icd_code like 'BRAND#25%' as is_circulatory,
  coalesce(seq_num, 99) = 1 as is_primary
from ({first_row('''(
  select subject_id, hadm_id, seq_num, upper(replace(trim(icd_code), '.', '')) as icd_code,
    coalesce(icd_version, 10) as icd_version
  from raw_diagnoses where hadm_id is not null and icd_code is not null)''',
  'subject_id, hadm_id, icd_code, icd_version', 'seq_num nulls last')})"""

DEFINITIONS["dictionary"] = f"""
select *, regexp_matches(lower(label), 'ring|bolt|gear|anvil') as is_target_lab,
  regexp_matches(lower(label), 'ring') as is_acute_marker
from ({first_row('''(select itemid, trim(label) as label, fluid, category
  from raw_dictionary where label is not null)''', 'itemid', 'label, fluid, category')})"""

DEFINITIONS["labs"] = f"""
select hadm_id, itemid, label, category, is_acute_marker,
  case when is_acute_marker then 'acute' else 'routine' end as marker_type, charttime,
  {hours('admittime', 'charttime', 3)} as hours_from_admit, valuenum, valueuom, flag
from ({first_row('''(
  select e.hadm_id, e.itemid, d.label, d.category, d.is_acute_marker, e.charttime, a.admittime,
    e.valuenum, e.valueuom, e.flag
  from raw_labs e join dictionary d on d.itemid = e.itemid and d.is_target_lab
  join admissions a on a.hadm_id = e.hadm_id
  where e.valuenum is not null and e.charttime >= a.admittime
    and e.charttime <= coalesce(a.dischtime, e.charttime))''',
  'hadm_id, itemid, charttime, valuenum', 'valueuom nulls last, flag nulls last')})"""


def cohort_definition(patients: str, admissions: str, diagnoses: str) -> str:
    """Cases, then as many controls by hash, one stay per subject, with a split."""
    return f"""
select *, {split_of('split_bucket')} as split from (
  select c.subject_id, c.hadm_id, c.label, p.gender, p.anchor_age, c.admittime, c.dischtime,
    c.los_hours, c.admit_year, c.admission_type, c.insurance, c.race, c.died_in_hospital,
    ({ordinal('angina-v1', 'c.subject_id')} % 100)::int as split_bucket
  from (
    with adult as (select a.* from {admissions} a join {patients} p
        on p.subject_id = a.subject_id and p.is_adult),
      cases as (select *, 1 as label from adult
        where hadm_id in (select hadm_id from {diagnoses} where is_angina)
        qualify row_number() over (partition by subject_id order by admittime, hadm_id) = 1),
      controls as (select *, 0 as label from adult
        where subject_id not in (select subject_id from {diagnoses} where is_circulatory)
        qualify row_number() over (partition by subject_id order by admittime, hadm_id) = 1),
      kept as (select * from controls
        qualify row_number() over (order by {ordinal('ctl', 'subject_id')}, subject_id)
          <= greatest((select count(*) from cases), 1))
    select * from cases union all by name select * from kept) c
  join {patients} p on p.subject_id = c.subject_id)"""


DEFINITIONS["cohort"] = cohort_definition("patients", "admissions", "diagnoses")

# -- activity view ------------------------------------------------------------

DEFINITIONS["user_stays"] = """
select user_id as subject_id, event_id as hadm_id, ts as admittime,
  lead(ts) over (partition by user_id order by ts, event_id) as dischtime
from events where event_type = 'signup'"""

DEFINITIONS["user_draws"] = """
select event_id, user_id as subject_id,
  case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
    when 'view' then 4 end as itemid,
  event_type as label, event_type in ('error', 'purchase') as is_acute_marker,
  ts as charttime, value as valuenum
from events where event_type <> 'signup'"""

DEFINITIONS["user_labs"] = f"""
select d.subject_id, s.hadm_id, d.event_id, d.itemid, d.label, d.is_acute_marker,
  case when d.is_acute_marker then 'acute' else 'routine' end as marker_type, d.charttime,
  {hours('s.admittime', 'd.charttime', 3)} as hours_from_admit, d.valuenum
from user_draws d join user_stays s on s.subject_id = d.subject_id
  and d.charttime >= s.admittime and d.charttime <= coalesce(s.dischtime, d.charttime)"""

DEFINITIONS["user_points"] = """
select user_id as subject_id, event_id as study_id, 'rec' || event_id as file_name,
  ts as ecg_time,
  'files/u' || user_id || '/' || (event_id % 10)
    || case when event_id % 2 = 0 then '.hea' else '.dat' end as path
from events where event_type = 'click'"""

DEFINITIONS["user_patients"] = """
select subject_id, gender, anchor_age, anchor_age >= 18 as is_adult, anchor_year,
  'all' as anchor_year_group
from (select distinct user_id as subject_id,
    case user_id % 3 when 0 then 'M' when 1 then 'F' end as gender,
    (10 + user_id % 85)::int as anchor_age, (2100 + user_id % 10)::int as anchor_year
  from events)"""

DEFINITIONS["user_admissions"] = f"""
select *, {hours('admittime', 'dischtime', 2)} as los_hours, year(admittime)::int as admit_year,
  'type ' || (hadm_id % 3) as admission_type, 'plan ' || (hadm_id % 4) as insurance,
  'group ' || (subject_id % 5) as race, hadm_id % 11 = 0 as died_in_hospital
from user_stays"""

DEFINITIONS["user_diagnoses"] = """
select distinct subject_id, hadm_id, code as icd_code,
  code like 'PURCHASE1%' as is_angina,
  (code like 'PURCHASE1%' or code like 'PURCHASE2%') as is_circulatory
from (select *, upper(label) || floor(valuenum / 150)::bigint as code from user_labs)"""

DEFINITIONS["user_cohort"] = cohort_definition(
    "user_patients", "user_admissions", "user_diagnoses"
)

DEFINITIONS["user_features"] = """
select *, case when is_acute_marker then first_value else mean_value end as feature_value,
  case when is_acute_marker then 'first' else 'mean' end as aggregation
from (select hadm_id, itemid, label, is_acute_marker,
    arg_min(valuenum, (charttime, valuenum)) as first_value, avg(valuenum) as mean_value,
    max(valuenum) as max_value, min(valuenum) as min_value,
    count(*)::int as measurement_count, min(hours_from_admit) as first_measurement_hours
  from user_labs group by all)"""

DEFINITIONS["user_wide"] = """
select hadm_id,
  max(feature_value) filter (where label = 'click') as click,
  max(feature_value) filter (where label = 'error') as error,
  max(feature_value) filter (where label = 'purchase') as purchase,
  max(feature_value) filter (where label = 'view') as view
from user_features group by hadm_id"""

DEFINITIONS["user_matches"] = f"""
select * from (
  select p.subject_id, s.hadm_id, p.study_id, p.file_name, p.path, p.ecg_time,
    {hours('s.admittime', 'p.ecg_time', 3)} as hours_from_admit
  from user_points p join user_stays s on s.subject_id = p.subject_id
    and p.ecg_time >= s.admittime - interval 12 hour
    and p.ecg_time <= coalesce(s.dischtime, p.ecg_time))
where hours_from_admit <= 72
qualify row_number() over (partition by hadm_id order by abs(hours_from_admit), study_id) = 1"""

DEFINITIONS["user_mart"] = """
select c.*, w.* exclude (hadm_id),
  case when c.gender = 'M' then 1 else 0 end as gender_male, c.anchor_age as age,
  m.study_id as ecg_study_id, m.path as ecg_path, m.hours_from_admit as ecg_hours_from_admit,
  m.study_id is not null as has_ecg, 15 as feature_count
from user_cohort c left join user_wide w on w.hadm_id = c.hadm_id
left join user_matches m on m.hadm_id = c.hadm_id"""

MART_COLUMNS = (
    "gender", "anchor_age", "admittime", "dischtime", "los_hours", "admit_year",
    "admission_type", "insurance", "race", "died_in_hospital", "split_bucket", "click", "error",
    "purchase", "view", "gender_male", "age", "ecg_study_id", "ecg_path", "ecg_hours_from_admit",
    "has_ecg", "feature_count",
)

DEFINITIONS["user_coverage"] = f"""
select column_name,
  case when column_name in ('click', 'error', 'purchase', 'view') then 'lab_feature'
    else 'attribute' end as column_kind,
  non_null_rows, total_rows,
  coalesce({rounded('1 - non_null_rows / nullif(total_rows, 0)', 6)}, 1.0) as null_rate
from (
  {' union all '.join(
      f"select '{c}' as column_name, count({c}) as non_null_rows, count(*) as total_rows "
      "from user_mart" for c in MART_COLUMNS)})"""

DEFINITIONS["staged_cohort"] = """
select subject_id, hadm_id, label,
  case when label = 1 then 'angina' else 'control' end as cohort_group, gender,
  case when gender = 'M' then 1 else 0 end as is_male, anchor_age as age_years,
  case when anchor_age < 18 then 0 when anchor_age >= 98 then 9
    else floor((anchor_age - 18) * 8 / 80)::int + 1 end as age_bucket,
  admittime as admitted_at, dischtime as discharged_at, los_hours as length_of_stay_hours,
  admit_year, admission_type, insurance, race, died_in_hospital, split, 'run-1' as etl_run_id
from user_cohort"""

DEFINITIONS["staged_features"] = """
select hadm_id, itemid as lab_itemid, label as lab_name, is_acute_marker,
  aggregation as aggregation_rule, feature_value, first_value, mean_value, min_value, max_value,
  measurement_count, first_measurement_hours, 'run-1' as etl_run_id
from user_features"""

DEFINITIONS["panel"] = """
select c.subject_id, c.hadm_id, c.label, c.cohort_group, c.split, c.age_years, c.is_male,
  f.lab_itemid, f.lab_name, f.is_acute_marker, f.aggregation_rule, f.feature_value,
  f.measurement_count, f.first_measurement_hours
from staged_cohort c join staged_features f on f.hadm_id = c.hadm_id"""

DEFINITIONS["staged_coverage"] = f"""
select column_name, column_kind, non_null_rows, total_rows, null_rate,
  {rounded('1 - null_rate', 4)} as coverage_rate, 'run-1' as etl_run_id,
  timestamp '2024-02-01' as loaded_at
from user_coverage"""

DEFINITIONS["coverage_tiers"] = """
select column_name, column_kind, total_rows, non_null_rows, null_rate, coverage_rate,
  case when null_rate <= 0.10 then 'complete' when null_rate <= 0.50 then 'partial'
    when null_rate <= 0.90 then 'sparse' else 'mostly_missing' end as completeness_tier,
  etl_run_id, loaded_at
from staged_coverage"""

DEFINITIONS["training_features"] = """
select hadm_id, subject_id, label, split, age, gender_male, los_hours, has_ecg,
  null::boolean as troponin_elevated, click, error, purchase, view, 'run-1' as etl_run_id
from user_mart"""

# -- histories ----------------------------------------------------------------

DEFINITIONS["dq_results"] = """
select 'run-' || run as run_id, timestamp '2024-01-01' + to_days(run::int) as checked_at,
  layer, table_name, check_name, severity,
  case when sevens % modulus <> 1 then 'true' else 'false' end as passed,
  (sevens % modulus)::double as observed, 0.0::double as threshold, row_count,
  'observed ' || (sevens % modulus) as details
from (select o_orderkey % 5 as run, o_orderstatus as layer, o_orderpriority as table_name,
    count(*) as row_count, count(*) filter (where o_orderkey % 7 = 0) as sevens
  from orders group by all),
  (values ('row_count_between_1_inf', 'error', 13), ('not_null__o_custkey', 'error', 7),
    ('null_rate__o_clerk', 'warn', 3)) as c(check_name, severity, modulus)"""

DEFINITIONS["staged_dq"] = """
select * replace (passed = 'true' as passed), split_part(check_name, '__', 1) as check_type
from dq_results"""

#: Checks are counted by what came of them; the columns are read from those counts.
DEFINITIONS["dq_history"] = f"""
with outcomes as (
  select run_id, layer, table_name, if(passed, 'passed', severity) as outcome, count(*) as n,
    max(checked_at) as newest, max(row_count) as largest
  from staged_dq group by all),
tallies as (
  select run_id, layer, table_name, max(newest) as checked_at, sum(n)::bigint as checks_run,
    histogram_values.v as v, max(largest) as row_count
  from outcomes join (select run_id as r, layer as l, table_name as t, map_from_entries(list((outcome, n))) as v
    from outcomes group by all) histogram_values on (r, l, t) = (run_id, layer, table_name)
  group by all)
select run_id, layer, table_name, checked_at, checks_run, coalesce(v['passed'], 0) as checks_passed,
  coalesce(v['error'], 0) as blocking_failures, coalesce(v['warn'], 0) as warnings, row_count,
  {rounded("coalesce(v['passed'], 0) / checks_run", 4)} as pass_rate,
  not map_contains(v, 'error') as run_healthy
from tallies"""

DEFINITIONS["coverage_history"] = f"""
select 'run-' || run as _run_id, column_name, non_null_rows, total_rows,
  {rounded('1 - non_null_rows / total_rows', 6)} as null_rate
from (
  select l_linenumber as run, 'tax' as column_name, count(*) as total_rows,
    count(*) filter (where l_tax > 0.02::double * (l_linenumber - 3)) as non_null_rows
    from lineitem group by 1
  union all by name select l_linenumber as run, 'discount' as column_name,
    count(*) as total_rows,
    count(*) filter (where l_discount > 0.01::double * l_linenumber) as non_null_rows
    from lineitem group by 1
  union all by name select l_linenumber as run, 'quantity' as column_name,
    count(*) as total_rows, count(*) filter (where l_quantity > 10) as non_null_rows
    from lineitem group by 1)"""

# -- scored rows --------------------------------------------------------------

DEFINITIONS["scored"] = f"""
select *, 6 * score - 3 as logit from (
  select row_id, run, label, model_name, {split_of('bucket')} as split,
    floor(((1 - weight) * uniform + weight * label) * 1000) / 1000.0::double as score
  from (
    select o_orderkey as row_id, o_orderkey % 5 as run, (o_orderstatus = 'F')::int as label,
      model_name, {ordinal('split', 'o_orderkey')} % 100 as bucket,
      case when model_name = 'tabular' then 0.2::double else 0.3::double end as weight,
      {ordinal('score', "model_name || '-' || o_orderkey")} / 4294967296.0::double as uniform
    from orders, (values ('tabular'), ('combined')) as m(model_name)))"""


def metric_rows(groups: str) -> str:
    """Six metrics per group, by pairwise-free textbook formulas."""
    return f"""
select {groups}, n_rows,
  (tp + tn) / n_rows as accuracy,
  coalesce(tp / nullif(tp + fp, 0), 0) as precision,
  coalesce(tp / nullif(tp + fn, 0), 0) as recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1,
  case when pos > 0 and neg > 0 then (rank_sum - pos * (pos + 1) / 2.0) / (pos * neg) end
    as roc_auc,
  case when pos > 0 and neg > 0 then ap_sum / pos end as pr_auc
from (
  select {groups}, count(*) as n_rows,
    count(*) filter (where label = 1 and score >= 0.5) as tp,
    count(*) filter (where label = 0 and score >= 0.5) as fp,
    count(*) filter (where label = 1 and score < 0.5) as fn,
    count(*) filter (where label = 0 and score < 0.5) as tn,
    sum(label)::double as pos, (count(*) - sum(label))::double as neg,
    sum(case when label = 1 then mid_rank end)::double as rank_sum,
    sum(case when label = 1 then hits_above / rows_above end)::double as ap_sum
  from (
    select *,
      rank() over (partition by {groups} order by score)
        + (count(*) over (partition by {groups}, score) - 1) / 2.0 as mid_rank,
      sum(label) over (partition by {groups} order by score desc
        range between unbounded preceding and current row)::double as hits_above,
      count(*) over (partition by {groups} order by score desc
        range between unbounded preceding and current row)::double as rows_above
    from scored)
  group by {groups})"""


def long_metrics(source: str, keep: str) -> str:
    return " union all ".join(
        f"select {keep}, '{m}' as metric_name, {m}::double as metric_value from {source}"
        for m in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
    )


DEFINITIONS["metrics_by_run"] = metric_rows("run, model_name, split")
DEFINITIONS["metrics_by_model"] = metric_rows("model_name, split")

DEFINITIONS["model_metrics"] = f"""
select 'run-' || run as run_id, timestamp '2024-01-01' + to_days(run::int) as trained_at,
  model_name, split, metric_name, {rounded('metric_value', 6)} as metric_value, n_rows,
  12 as n_features
from ({long_metrics('metrics_by_run', 'run, model_name, split, n_rows')})"""

#: Runs are numbered per model and split, and each is joined to the number before.
DEFINITIONS["model_performance"] = """
with wide as (
  from (select run_id, trained_at, model_name, split, metric_name, metric_value from model_metrics)
  pivot (max(metric_value) for metric_name in ('roc_auc', 'pr_auc', 'f1', 'recall', 'precision', 'accuracy'))),
sizes as (
  select run_id, model_name, split, max(n_rows) as n_rows, max(n_features) as n_features
  from model_metrics group by all),
numbered as (
  select *, row_number() over (partition by model_name, split order by trained_at, run_id) as nth
  from wide join sizes using (run_id, model_name, split))
select new.* exclude (nth), new.roc_auc - old.roc_auc as roc_auc_change_vs_previous_run
from numbered new left join numbered old
  on (old.model_name, old.split, old.nth + 1) = (new.model_name, new.split, new.nth)"""


def with_definitions(statement: str) -> str:
    """Prefix the statement with the definitions it uses, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in DEFINITIONS.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                needed.add(name)
                visit(body)

    visit(statement)
    parts = [f"{name} as materialized ({body})" for name, body in DEFINITIONS.items()
             if name in needed]
    if not parts:
        return statement.strip()
    own = statement.strip()
    rest = f", {own.removeprefix('with ')}" if own.startswith("with ") else f" {own}"
    return f"with {', '.join(parts)}{rest}"
