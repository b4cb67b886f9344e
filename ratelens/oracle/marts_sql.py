"""The marts as ANSI SQL over the test tables, written apart from the Spark code."""

import re

from ratelens.plans.testdata import SOURCES, source_sql

# The seed maps.
SEED_PAYER = """select * from (values ('BCBS', 'BCBS'), ('BLUE CROSS BLUE SHIELD', 'BCBS'),
 ('BLUE CROSS AND BLUE SHIELD', 'BCBS'), ('UNITEDHEALTHCARE', 'United'),
 ('UNITED HEALTHCARE', 'United'), ('AETNA', 'Aetna'), ('CIGNA', 'Cigna'),
 ('CIGNA HEALTHCARE', 'Cigna'), ('MEDICARE', 'Medicare'), ('MEDICAID', 'Medicaid'))
 t(payer_name_norm, payer_family)"""
SEED_PLAN = """select * from (values ('BCBS', 'PPO', 'PPO'), ('BCBS', 'HMO', 'HMO'),
 ('United', 'CHOICE', 'Choice'), ('United', 'SELECT', 'Select'), ('Aetna', 'PPO', 'PPO'),
 ('Medicare', 'MEDICARE FEE FOR SERVICE', 'Medicare FFS'),
 ('Medicare', 'TRADITIONAL', 'Medicare FFS')) t(payer_family, plan_name_norm, plan_family)"""


def key(*parts):
    token = "'_ratelens_no_value_'"
    return "md5(" + " || '-' || ".join(
        f"coalesce(cast({p} as varchar), {token})" for p in parts
    ) + ")"


def kind(t):
    return f"upper(replace(trim(coalesce({t}, '')), '-', '_'))"


def classify(c):
    x = f"replace(replace(trim(coalesce({c}, '')), '-', ''), ' ', '')"
    return f"""case when {x} = '' or regexp_full_match({x}, '[0-9]{{5}}') then 'CPT'
 when regexp_full_match({x}, '[A-Za-z][0-9]{{4}}') then 'HCPCS'
 when regexp_full_match({x}, '[0-9]{{10,11}}') then 'NDC'
 when regexp_full_match({x}, '[0-9]{{3,4}}') then 'REVENUE'
 when regexp_full_match({x}, '[A-Za-z][0-9A-Za-z]{{6}}') then 'ICD-10-PCS' else 'UNKNOWN' end"""


def infer(c, t):
    return f"""case when lower(trim(coalesce({t}, ''))) in ('unknown', '') then {classify(c)}
 else trim(coalesce({t}, '')) end"""


def stored(c, t):
    return f"""case {kind(t)} when 'CPT' then right(trim({c}), 5) when 'HCPCS' then upper(trim({c}))
 when 'ICD_10_PCS' then upper(trim({c})) when 'ICD_10_CM' then replace(upper(trim({c})), '.', '')
 when 'NDC' then replace(replace(replace(trim({c}), '-', ''), ' ', ''), '.', '')
 else trim({c}) end"""


def issue(c, t):
    s, k = f"({stored(c, t)})", kind(t)

    def no(pattern):
        return f"not regexp_full_match({s}, '{pattern}')"

    return f"""case
 when {k} = 'CPT' and {no('[0-9]{5}')} then 'cpt_expected_5_digits'
 when {k} = 'HCPCS' and {no('[A-Z0-9]{5}')} then 'hcpcs_expected_5_alphanum'
 when {k} = 'NDC' and length({s}) not in (10, 11) then 'ndc_not_10_or_11_digits'
 when {k} = 'REVENUE' and {no('[0-9]{3,4}')} then 'revenue_expected_3_or_4_digits'
 when {k} = 'RC' and {no('[0-9]{3,4}')} then 'rc_expected_3_or_4_digits'
 when {k} = 'CDM' and {no('[0-9]{3,4}')} then 'cdm_expected_3_or_4_digits'
 when {k} = 'ICD_10_PCS' and {no('[A-Z0-9]{7}')} then 'icd_10_pcs_expected_7_alphanum'
 when {k} = 'ICD_10_CM' and {no('[A-Z0-9]{3,7}')} then 'icd_10_cm_expected_3_to_7_alphanum'
 when {k} in ('DRG', 'MS_DRG', 'APR_DRG', 'TRIS_DRG') and {no('[0-9]{3}')}
   then 'drg_expected_3_digits'
 when {k} = 'HIPPS' and {no('[A-Za-z0-9]{5}')} then 'hipps_expected_5_alphanum'
 when {k} in ('APC', 'EAPG') and {no('[0-9]{4}')} then 'apc_eapg_expected_4_digits'
 when {k} not in ('CPT', 'HCPCS', 'NDC', 'REVENUE', 'ICD_10_PCS', 'UNKNOWN', 'DRG', 'MS_DRG', 'APC',
  'EAPG', 'ICD_10_CM', 'RC', 'CDM', '8', 'APR_DRG', 'ICD', 'TRIS_DRG', 'HIPPS')
   then 'unknown_code_type' end"""


def match(x):
    x = rf"regexp_replace(trim(coalesce({x}, '')), '\[\d+\]', '', 'g')"
    x = rf"regexp_replace({x}, '[^a-zA-Z0-9\s]', ' ', 'g')"
    return f"upper(trim(regexp_replace({x}, ' +', ' ', 'g')))"


def stem(f):
    x = rf"regexp_replace(lower(coalesce({f}, '')), '\.(csv|json)$', '')"
    x = f"regexp_replace({x}, '_standardcharges$', '')"
    x = rf"regexp_replace({x}, '^\d+_', '')"
    return rf"trim(regexp_replace({x}, '[_\-\s]+', ' ', 'g'))"


def initcap(x):
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


def json_name(keys):
    parts = [f"nullif(trim(json_extract_string(preamble_kv, '$.\"{k}\"')), '')" for k in keys]
    return "coalesce(" + ", ".join(parts) + ")"


SHORT_NAMES = ("hospital_name", "hospital", "facility_name")
ALL_NAMES = SHORT_NAMES + ("Hospital Name", "Facility Name")


def norm_type(r="rate_type"):
    return f"lower(trim(coalesce({r}, '')))"


CATEGORY = f"""case
 when {norm_type()} in ('negotiated_rate', 'negotiated_dollar', 'negotiated', 'estimated_amount',
  'estimated', 'self_pay', 'self_pay_rate', 'self-pay') then 'negotiated'
 when {norm_type()} in ('negotiated_percentage', 'percentage') then 'percentage'
 when {norm_type()} in ('gross_charge', 'gross', 'standard_charge_gross', 'standard_charge',
  'charge') then 'gross'
 when {norm_type()} in ('discounted_cash', 'discounted_cash_price', 'cash_price', 'cash') then 'cash'
 when {norm_type()} in ('min', 'minimum') then 'min'
 when {norm_type()} in ('max', 'maximum') then 'max'
 when {norm_type()} = '' and rate_amount = gross_charge then 'gross'
 when {norm_type()} = '' and rate_amount = discounted_cash then 'cash'
 when {norm_type()} = '' and rate_amount = minimum then 'min'
 when {norm_type()} = '' and rate_amount = maximum then 'max'
 when {norm_type()} = '' then 'negotiated' else 'other' end"""

STAGED = """hospital_name, hospital_id, billing_code, billing_code_type, description, payer_name,
 plan_name, rate_type, rate_amount, billing_class, gross_charge, discounted_cash, minimum, maximum,
 source_system, source_file_name, run_id, ingested_at, raw_rate_json"""

CHARGE_KEY = key(
    "source_system", "source_file_name", "ingested_at", "hospital_id", "billing_code",
    "billing_code_type", "payer_name", "plan_name", "rate_type",
    "cast(rate_amount as decimal(38,9))", "''", "coalesce(raw_rate_json, '{}')",
)


def dedupe(source):
    return f"""select standard_charge_sk, {STAGED} from (
 select *, row_number() over (partition by standard_charge_sk order by ingested_at desc nulls last,
  run_id desc nulls last, description desc nulls last, gross_charge desc nulls last,
  discounted_cash desc nulls last, minimum desc nulls last, maximum desc nulls last,
  billing_class desc nulls last, hospital_name desc nulls last) as rn
 from (select *, {CHARGE_KEY} as standard_charge_sk from {source}) keyed) where rn = 1"""


def typed(category, amount, own):
    return f"""select *, '{category}' as rate_category_, {amount} as amount_, 'dollars' as unit_, 2 as pri
 from resolved where {amount} is not null and {amount} <> 0
 and lower(coalesce(rate_type, '')) not in ({own})"""


CLEAN = r"""trim(regexp_replace(trim(regexp_replace({x}, '[_\-\s]+', ' ', 'g')), '^\d{{1,3}}\s+\d{{5,}}\s*', ''))"""

CTES = {
    "seed_payer": SEED_PAYER,
    "seed_plan": SEED_PLAN,
    "base": dedupe("charges"),
    "csv_latest": """select * from csv_registry qualify row_number() over (
 partition by source_file_name order by ingested_at desc, run_id desc) = 1""",
    "file_names": f"""select source_file_name, coalesce({json_name(ALL_NAMES)},
 nullif({initcap(stem('source_file_name'))}, ''), source_file_name) as hospital_name_clean
 from csv_latest union all
 select distinct source_file_name, coalesce(nullif({initcap(stem('source_file_name'))}, ''),
 source_file_name) from json_registry""",
    "dim_hospital": f"""select {key('hospital_name_norm')} as hospital_id, * from (
 select hospital_name, hospital_name_clean,
  coalesce(nullif(trim(regexp_replace(regexp_replace(lower(hospital_name_clean), '[^a-z0-9\\s]', '',
   'g'), ' +', ' ', 'g')), ''), lower(trim(hospital_name_clean)), lower(trim(source_file_name)))
   as hospital_name_norm, source_system, source_file_name
 from (select raw_name as hospital_name, source_system, source_file_name,
   coalesce(nullif({CLEAN.format(x='raw_name')}, ''), source_file_name) as hospital_name_clean
  from (select b.source_file_name, b.source_system, coalesce(nullif(trim(n.hospital_name_clean), ''),
     nullif({initcap(stem('b.source_file_name'))}, ''), b.source_file_name) as raw_name
   from (select source_file_name, min(source_system) as source_system from base group by 1) b
   left join file_names n on b.source_file_name = n.source_file_name)))""",
    "display": """select hospital_id, min(hospital_name_clean) as hospital_name_clean
 from dim_hospital group by 1""",
    "dim_payer": """select distinct coalesce(payer_name, '') as payer_name,
 coalesce(plan_name, '') as plan_name from base
 where payer_name is not null or plan_name is not null""",
    "dim_payer_harmonized": f"""select payer_name_raw, plan_name_raw, payer_name_norm, plan_name_norm,
 payer_family, coalesce(l.plan_family, plan_name_norm) as plan_family from (
  select n.*, coalesce(p.payer_family, n.payer_name_norm) as payer_family from (
   select payer_name as payer_name_raw, plan_name as plan_name_raw,
    {match('payer_name')} as payer_name_norm, {match('plan_name')} as plan_name_norm
   from dim_payer) n left join seed_payer p using (payer_name_norm)) f
 left join seed_plan l using (payer_family, plan_name_norm)""",
    "family_lookup": """select distinct payer_name_norm, plan_name_norm, payer_family, plan_family
 from dim_payer_harmonized""",
    "dim_procedure": f"""select {stored('billing_code', 'billing_code_type')} as billing_code,
 billing_code_type, description from (
 select coalesce(billing_code, '') as billing_code,
  upper(replace(trim({infer('billing_code', 'billing_code_type')}), '-', '_')) as billing_code_type,
  description from (select distinct billing_code, billing_code_type, description from base
   where billing_code is not null or description is not null))""",
    "resolved": """select b.* exclude (hospital_id), d.hospital_id,
 coalesce(upper(replace(trim(billing_code_type), '-', '_')), 'UNKNOWN') as type_
 from base b left join dim_hospital d on b.source_file_name = d.source_file_name
 where billing_code is not null""",
    "rate_rows": f"""select *, {CATEGORY} as rate_category_, rate_amount as amount_,
 case when {norm_type()} like '%percent%' then 'percent' else 'dollars' end as unit_, 1 as pri
 from resolved where rate_amount is not null and rate_amount <> 0
 union all {typed('gross', 'gross_charge', "'gross_charge', 'gross', 'standard_charge_gross'")}
 union all {typed('cash', 'discounted_cash', "'discounted_cash', 'cash_price', 'cash'")}
 union all {typed('min', 'minimum', "'min', 'minimum'")}
 union all {typed('max', 'maximum', "'max', 'maximum'")}""",
    "semantic": f"""select {key('standard_charge_sk', 'rate_category_')} as semantic_charge_sk,
 standard_charge_sk, hospital_id, hospital_name, billing_code, billing_code as billing_code_raw,
 type_ as billing_code_type, description, payer_name, plan_name, rate_category_ as rate_category,
 amount_ as rate_amount, unit_ as rate_unit, source_system, source_file_name, ingested_at,
 cast(null as varchar) as contracting_method from (
 select *, row_number() over (partition by standard_charge_sk, rate_category_
  order by ingested_at desc, pri) as rn from rate_rows) where rn = 1""",
    "comparable": f"""select semantic_charge_sk, standard_charge_sk, hospital_id, hospital_name,
 billing_code_raw, {stored('billing_code_raw', 'billing_code_type')} as billing_code,
 billing_code_type, ({issue('billing_code_raw', 'billing_code_type')}) is null
  as billing_code_is_valid,
 {issue('billing_code_raw', 'billing_code_type')} as billing_code_issue_reason, description,
 payer_name, plan_name, lower(trim(rate_category)) as rate_category, rate_amount, rate_unit,
 billing_code_type || '|' || lower(trim(rate_category)) || '|' || trim(rate_unit)
  as comparability_key,
 lower(trim(rate_category)) in ('negotiated', 'gross', 'cash', 'min', 'max', 'percentage')
  as is_comparable,
 case when lower(trim(rate_category)) = 'other' then 'excluded_other'
  when lower(trim(rate_category)) not in ('negotiated', 'gross', 'cash', 'min', 'max', 'percentage')
  then 'excluded_unexpected_category' else 'comparable' end as comparability_reason,
 source_system, source_file_name, ingested_at, contracting_method from semantic
 where rate_category is not null and rate_amount is not null and rate_amount <> 0""",
    "harmonized": f"""select f.* exclude (pn, ln),
 coalesce(h.payer_family, trim(coalesce(f.payer_name, ''))) as payer_family,
 coalesce(h.plan_family, trim(coalesce(f.plan_name, ''))) as plan_family
 from (select *, {match('payer_name')} as pn, {match('plan_name')} as ln from comparable) f
 left join family_lookup h on f.pn = h.payer_name_norm and f.ln = h.plan_name_norm""",
    "compare": """select billing_code, billing_code_type, payer_family, plan_family, rate_category,
 rate_unit, comparability_key, hospital_id, min(rate_amount) as min_rate,
 max(rate_amount) as max_rate, quantile_disc(rate_amount, 0.5) as approx_median_rate,
 count(*) as row_count, max(ingested_at) as last_ingested_at from harmonized
 where is_comparable and rate_category <> 'other' and billing_code_is_valid group by all""",
    "procedures": """select k.billing_code, k.billing_code_type,
 coalesce(c.described, nullif(k.listed, ''), '(no description)') as canonical_description,
 coalesce(v.n, 0) as description_variants_count from (
  select coalesce(billing_code, '') as billing_code,
   coalesce(billing_code_type, 'UNKNOWN') as billing_code_type,
   max(trim(coalesce(description, ''))) as listed from dim_procedure group by 1, 2) k
 left join (select * from uses qualify row_number() over (
   partition by billing_code, billing_code_type order by cnt desc, described) = 1) c
  using (billing_code, billing_code_type)
 left join (select billing_code, billing_code_type, count(distinct described) as n from uses
   group by 1, 2) v using (billing_code, billing_code_type)""",
    "uses": """select billing_code, billing_code_type, trim(description) as described, count(*) as cnt
 from semantic where trim(coalesce(description, '')) <> '' group by 1, 2, 3""",
    "rejects": """select semantic_charge_sk, standard_charge_sk, hospital_id, hospital_name,
 billing_code, billing_code_type, description, payer_name, plan_name, rate_category, rate_amount,
 rate_unit, comparability_reason, source_system, source_file_name, ingested_at, contracting_method
 from comparable where not is_comparable
 order by ingested_at desc nulls last, semantic_charge_sk limit 1000000""",
    "denormalized": """select f.*, d.hospital_name_clean as hospital_name_display,
 coalesce(p.described, f.description) as procedure_description,
 trim(coalesce(payer_name, '') || ' | ' || coalesce(plan_name, ''), ' |') as payer_display
 from semantic f left join display d using (hospital_id)
 left join (select billing_code, billing_code_type, min(description) as described
  from dim_procedure where description is not null group by 1, 2) p
  using (billing_code, billing_code_type)""",
}


def with_ctes(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` with exactly the derived tables it needs in front."""
    known = {**{n: source_sql(n) for n in SOURCES}, **CTES, **(extra or {})}
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:from|join)\s+(\w+)", sql)):
            if name in known and name not in order:
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(select)
    if not order:
        return select.strip()
    return "with " + ",\n".join(f"{n} as ({known[n].strip()})" for n in order) + "\n" + select.strip()
