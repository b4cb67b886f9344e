"""Oracle SQL per registered query."""

from ratelens.oracle.lake_sql import CTES as LAKE
from ratelens.oracle.lake_sql import parse, strict
from ratelens.oracle.marts_sql import (
    CATEGORY,
    CHARGE_KEY,
    CLEAN,
    classify,
    dedupe,
    infer,
    initcap,
    issue,
    key,
    kind,
    match,
    norm_type,
    stem,
    stored,
    with_ctes,
)

CODES = "billing_code, billing_code_type"
NULLS = ("hospital_id", "billing_code", "rate_amount", "description")
HERE = "hospital_id = md5('supplier 000000003')"
FILTERS = """a.billing_code = '00010' and a.rate_category = 'negotiated'
 and a.rate_unit = 'dollars'"""
MAX_FILTERS = "billing_code = '00010' and rate_category = 'max' and rate_unit = 'dollars'"
KNOWN = """'CPT', 'HCPCS', 'NDC', 'REVENUE', 'ICD_10_PCS', 'UNKNOWN', 'DRG', 'MS_DRG', 'APC', 'EAPG',
 'ICD_10_CM', 'RC', 'CDM', '8', 'APR_DRG', 'ICD', 'TRIS_DRG', 'HIPPS'"""
LAKE_CATEGORY = """case when upper(rate_type) in ('NEGOTIATED', 'NEGOTIATED_RATE') then 'negotiated'
 when upper(rate_type) in ('GROSS', 'GROSS_CHARGE') then 'gross'
 when upper(rate_type) in ('CASH', 'DISCOUNTED_CASH_PRICE') then 'cash'
 when upper(rate_type) = 'MINIMUM' then 'min' when upper(rate_type) = 'MAXIMUM' then 'max'
 else 'other' end"""
METRICS = """select count(*) as total_rows, count(*) filter (reason_code is null) as good_rows,
 count(*) filter (reason_code is not null) as quarantine_rows,
 round(count(*) filter (reason_code is not null)::double / count(*), 4) as quarantine_rate,
 round(count(*) filter (reason_code is null and billing_code is null)::double
  / count(*) filter (reason_code is null), 4) as null_rate_billing_code,
 round(count(*) filter (reason_code is null and rate_amount is null)::double
  / count(*) filter (reason_code is null), 4) as null_rate_rate_amount from candidates"""
ISSUES = f"""select trim(billing_code) as billing_code, billing_code_type,
 {issue('trim(billing_code)', 'billing_code_type')} as {{name}}, count(*) as row_count from semantic
 where ({issue('trim(billing_code)', 'billing_code_type')}) is not null group by all"""
ISSUES = ISSUES.replace("{5}", "{{5}}").replace("{3}", "{{3}}").replace("{4}", "{{4}}")
ISSUES = ISSUES.replace("{7}", "{{7}}").replace("{3,4}", "{{3,4}}").replace("{3,7}", "{{3,7}}")
SEARCH = """rate_category in ('negotiated', 'gross', 'cash')
 and payer_display in ('Aetna [123] | PPO', 'CIGNA | PPO', 'medicare  | PPO', 'AUTOMOBILE')
 and (lower(billing_code) like '%gear%' or lower(billing_code_type) like '%gear%'
  or lower(procedure_description) like '%gear%')"""


def detail(where):
    return f"""select a.hospital_id, coalesce(d.hospital_name_clean, a.hospital_id)
 as hospital_name_clean, coalesce(d.hospital_name_clean, a.hospital_id) as hospital_display_name,
 a.billing_code, a.billing_code_type, coalesce(p.canonical_description, '') as description,
 a.payer_family, a.plan_family, a.rate_category, a.rate_unit, a.min_rate, a.max_rate,
 a.approx_median_rate, a.row_count, coalesce(p.canonical_description, '') as canonical_description
 from compare a left join display d using (hospital_id)
 left join procedures p on a.billing_code = p.billing_code
  and a.billing_code_type = p.billing_code_type where {where}"""


def top_codes(where, limit):
    return f"""select t.billing_code, t.billing_code_type,
 coalesce(p.canonical_description, '') as canonical_description, row_count, hospitals_covered from (
 select billing_code, billing_code_type, cast(sum(row_count) as bigint) as row_count,
 count(distinct hospital_id) as hospitals_covered from compare where {where} group by 1, 2
 order by 3 desc, 1, 2 limit {limit}) t left join procedures p using (billing_code, billing_code_type)"""


def money(where):
    return f"""cast(sum(cast(rate_amount as decimal(28,4))) filter ({where}) as double)"""


def by(columns, expression):
    return f"""select {columns}, {expression} as result, count(*) as row_count from charges
 group by all"""


def null_rows(table, columns):
    parts = [
        f"select '{c}' as column_name, count(*) as null_rows from {table} where {c} is null"
        for c in columns
    ]
    return "select * from (" + " union all ".join(parts) + ") where null_rows > 0"


def repeated(table, column):
    return f"""select {column} as value, count(*) as n_records from {table} group by 1
 having count(*) > 1"""


def unaccepted(table, column, values):
    return f"""select {column} as value, count(*) as n_records from {table}
 where {column} not in ({values}) group by 1"""


DELIVERED = "'negotiated_dollar', 'gross_charge', 'discounted_cash_price'"
REGISTERED = """select source_file_name from csv_registry where status = 'success'
 union all select source_file_name from json_registry where status = 'success'"""


def tally(table, name, checks, unique=()):
    """Violations per check, every check a count of its own."""
    parts = [f"select '{name}' as table_name, 'not_empty' as check_name, (count(*) = 0)::bigint as violations from {table}"]
    parts += [f"select '{name}', '{check}', count(*) from {table} where {bad}" for check, bad in checks.items()]
    parts += [
        f"select '{name}', 'unique {c}', count(*) from (select {c} from {table} where {c} is not null group by 1"
        " having count(*) > 1)" for c in unique
    ]
    return " union all ".join(parts)


SELECTS = {
    "m01_dim_hospital": "select * from dim_hospital",
    "m03_dim_payer": "select * from dim_payer",
    "m04_dim_payer_harmonized": "select * from dim_payer_harmonized",
    "m05_dim_procedure": "select * from dim_procedure",
    "m06_dim_procedure_harmonized": "select * from procedures",
    "m07_dim_source_file": """select source_file_name, source_system,
 min(hospital_name) as hospital_name, min(ingested_at) as ingested_at_min,
 max(ingested_at) as ingested_at_max, min(format_hint) as format_hint,
 min(header_count) as header_count, min(delimiter) as delimiter, min(encoding) as encoding,
 min(rows_loaded) as rows_loaded, min(status) as status from (
  select source_file_name, case when lower(trim(format_hint)) = 'wide' then 'csv_wide'
    else 'csv_tall' end as source_system,
   coalesce(nullif(trim(json_extract_string(preamble_kv, '$.hospital_name')), ''),
    nullif(trim(json_extract_string(preamble_kv, '$.hospital')), ''),
    nullif(trim(json_extract_string(preamble_kv, '$.facility_name')), ''), source_file_name)
    as hospital_name, ingested_at, format_hint, header_count, delimiter, encoding, rows_loaded,
   status from csv_registry
  union all
  select source_file_name, 'json', source_file_name, ingested_at, null, null, null, null,
   rows_loaded, status from json_registry) group by 1, 2""",
    "m08_standard_charges": """select b.* exclude (hospital_id), d.hospital_id
 from base b left join dim_hospital d using (source_file_name)""",
    "m13_semantic": "select * from semantic",
    "m15_comparable": "select * from comparable",
    "m16_harmonized": "select * from harmonized",
    "m16_harmonized_by_dimension": "select * from harmonized",
    "m17_rejects": "select * from rejects",
    "m18_code_rejects": """select 'fct_rates_comparable' as source_layer, billing_code_raw,
 billing_code_type, billing_code_issue_reason, count(*) as row_count from comparable
 where not billing_code_is_valid and billing_code_issue_reason is not null group by 1, 2, 3, 4""",
    "m19_agg_compare": "select * from compare",
    "m19_agg_compare_exact": """select billing_code, billing_code_type, payer_family, plan_family,
 rate_category, rate_unit, comparability_key, hospital_id, min(rate_amount) as min_rate,
 max(rate_amount) as max_rate, median(rate_amount) as approx_median_rate, count(*) as row_count,
 max(ingested_at) as last_ingested_at from harmonized
 where is_comparable and rate_category <> 'other' and billing_code_is_valid group by all""",
    "m20_payer_plan_compare": "select * from compare",
    # Incremental and lake marts.
    "m02_lake_dim_hospital": "select * from lake_hospitals",
    "m09_incremental_merge": """select b.* exclude (hospital_id), d.hospital_id
 from base b left join dim_hospital d using (source_file_name)""",
    "m10_lake_standard_charges": "select * from lake_charges",
    "m14_lake_semantic": f"""select {key('standard_charge_sk', 'rate_category')}
  as semantic_charge_sk, * from (select standard_charge_sk, hospital_id, hospital_name, billing_code,
 billing_code as billing_code_raw,
 coalesce(upper(replace(trim(billing_code_type), '-', '_')), 'UNKNOWN') as billing_code_type,
 description, payer_name, plan_name, {LAKE_CATEGORY} as rate_category, rate_amount,
 'dollars' as rate_unit, source_system, source_file_name, ingested_at,
 cast(null as varchar) as contracting_method from lake_charges
 where rate_amount is not null and rate_amount <> 0)""",
    # Staging.
    "t01_stage_json": "select * from staged_json",
    "t02_stage_csv_tall": "select * from staged_tall",
    "t03_stage_csv_wide": "select * from staged_wide",
    "t04_registry_names": "select * from registry_names",
    "t05_file_display_name": f"""select distinct source_file_name,
 {initcap(stem('source_file_name'))} as display_name from csv_registry""",
    "t06_file_names": "select * from file_names",
    "t07_hospital_id": "select s_name, md5(lower(trim(s_name))) as hospital_id from supplier",
    "t08_lake_base": "select * from lake_base",
    "t09_union_base": "select * from staged_base",
    "t10_charge_key": f"""select {CHARGE_KEY} as standard_charge_sk, source_file_name, run_id,
 raw_rate_json from charges""",
    "t11_payload_fingerprint": """select sha256(raw) as fingerprint, count(*) as row_count
 from landing_tall group by 1""",
    "t12_dedupe": f"select * from ({dedupe('twice')})",
    # Lake rates.
    "v01_parse_rate": f"""select negotiated_rate as cell, {parse('negotiated_rate')} as amount,
 count(*) as row_count from lake_tabular group by all""",
    "v02_strict_amount": f"""select negotiated_rate as cell, {strict('negotiated_rate')} as amount,
 count(*) as row_count from lake_tabular group by all""",
    "v05_payload_rates": "select * from payload_candidates",
    "v08_tabular_rates": "select * from tabular_candidates",
    "v10_reason_counts": """select branch, rate_type, reason_code, count(*) as row_count
 from candidates group by all""",
    "v12_quarantine": "select * exclude (branch) from candidates where reason_code is not null",
    "v12_good": "select * from good",
    "v13_quality_metrics": METRICS,
    "v14_rows_by_source": """select 'csv_tall' as _source_system, count(*) as row_count
 from lake_tabular union all select 'json', count(*) from lake_payload""",
    "v14_good_rows_by_branch": """select branch, count(*) as row_count from candidates
 where reason_code is null group by 1""",
    "v14_quarantine_reasons": """select reason_code, count(*) as row_count from candidates
 where reason_code is not null and lower(source_format) in ('csv', 'csv_tall') group by 1""",
    "v14_candidate_nulls": """select count(*) as candidate_rows,
 round(100.0::double * count(*) filter (trim(coalesce(billing_code, '')) = '') / count(*), 2)
  as pct_null_billing_code,
 round(100.0::double * count(*) filter (rate_amount is null) / count(*), 2) as pct_null_rate_amount
 from candidates where rate_type is not null""",
    "v14_rate_types": """select rate_type, count(*) as row_count from candidates
 where rate_type is not null group by 1 order by 2 desc, 1 limit 10""",
    "v15_gate": f"select * from ({METRICS}) where quarantine_rate > 0.3",
    # Diagnostics.
    "g01_display_sanity": """select * from (select 'hospital_name_clean' as check_type,
 hospital_id as key_value, hospital_name_clean as detail,
 not regexp_full_match(lower(trim(hospital_name_clean)), '[0-9a-f]{32}') as ok from dim_hospital
 order by hospital_id, source_file_name limit 10)
 union all select * from (select 'billing_code_99213', billing_code, count(*) || ' rows',
 billing_code = '99213' from compare where billing_code like '%99213%' group by billing_code
 order by billing_code limit 10)""",
    "g02_code_issues": f"select * from ({ISSUES.format(name='issue_reason')})",
    "g18_rule_violations": f"select * from ({ISSUES.format(name='issue_type')})",
    "g03_funnel": """select 'funnel' as section, 'total_semantic_rows' as metric_name,
 cast(null as varchar) as breakdown_key, count(*) as n from semantic
 union all select 'funnel', 'accepted_category_rows', null, count(*) from comparable
  where rate_category in ('negotiated', 'gross', 'cash', 'min', 'max', 'percentage', 'other')
 union all select 'funnel', 'comparable_true_rows', null, count(*) from harmonized
  where is_comparable
 union all select 'funnel', 'comparable_true_non_other_rows', null, count(*) from harmonized
  where is_comparable and rate_category <> 'other'
 union all select 'funnel', 'comparable_false_rows', null, count(*) from comparable
  where not is_comparable
 union all select 'breakdown', 'rate_category', rate_category, count(*) from comparable group by 3
 union all select 'breakdown', 'is_comparable', cast(is_comparable as varchar), count(*)
  from comparable group by 3
 union all select 'breakdown', 'comparability_reason', comparability_reason, count(*)
  from comparable group by 3
 union all select 'breakdown', 'rate_unit_blank', case when trim(coalesce(rate_unit, '')) = ''
  then 'blank' else 'nonblank' end, count(*) from comparable group by 3""",
    "g04_procedure_types": """select billing_code_type, count(*) as row_count from dim_procedure
 group by 1""",
    "g05_unexpected_types": f"""select billing_code_type, count(*) as n from dim_procedure
 where billing_code_type not in ({KNOWN}) group by 1""",
    "g06_unexpected_categories": """select rate_category as rate_category_norm,
 count(*) as row_count from comparable
 where rate_category not in ('negotiated', 'gross', 'cash', 'min', 'max', 'percentage')
 group by 1""",
    "g07_hospital_name_issues": r"""select hospital_id, hospital_name, hospital_name_clean,
 source_file_name from dim_hospital where regexp_matches(trim(hospital_name_clean), '^\d')""",
    "g08_other_rates": """select rate_category as rate_category_norm, is_comparable,
 comparability_reason, count(*) as n from harmonized where rate_category = 'other' group by all""",
    "g09_other_leak": """select 'fct_rates_comparable' as source, rate_category, is_comparable,
 comparability_reason, count(*) as n from comparable where rate_category = 'other' group by all
 union all select 'fct_rates_comparable_harmonized', rate_category, is_comparable,
 comparability_reason, count(*) from harmonized where rate_category = 'other' group by all""",
    "g10_other_variants": """select 'harmonized' as source, rate_category as raw_or_category,
 lower(trim(rate_category)) as rate_category_norm, is_comparable, count(*) as n from harmonized
 where lower(trim(rate_category)) = 'other' group by all
 union all select 'agg', rate_category, lower(trim(rate_category)), null, count(*) from compare
 where lower(trim(rate_category)) = 'other' group by all""",
    "g11_category_counts": """select rate_category, source_system, count(*) as rows_,
 count(distinct hospital_id) as hospitals from semantic group by 1, 2""",
    "g12_unit_profile": """select rate_category as rate_category_norm, rate_unit as rate_unit_norm,
 lower(billing_code_type) as billing_code_type_norm, count(*) as row_count,
 count(rate_amount) as rows_with_numeric_rate, count(*) filter (trim(rate_unit) <> '')
 as rows_with_unit from semantic group by 1, 2, 3 order by row_count desc, 1, 2, 3 limit 500""",
    "g13_rate_type_mapping": f"""select source_system, rate_type as raw_rate_type,
 {norm_type()} as rate_type_norm, {CATEGORY} as derived_rate_category, count(*) as row_count
 from base where billing_code is not null and rate_amount <> 0 group by all""",
    "g14_source_fields": f"""select b.source_system, b.source_file_name, b.hospital_id, b.billing_code,
 b.standard_charge_sk, b.rate_type as raw_rate_type, {norm_type('b.rate_type')} as rate_type_norm,
 b.rate_amount as raw_rate_amount, b.gross_charge, b.discounted_cash, b.minimum, b.maximum,
 s.rate_category as current_rate_category, s.rate_amount as semantic_rate_amount, s.rate_unit
 from base b join semantic s on b.standard_charge_sk = s.standard_charge_sk
 order by 1, 5, 13 limit 5000""",
    "g15_type_examples": """select billing_code_type, billing_code, description, row_count from (
 select billing_code_type, trim(billing_code) as billing_code,
  trim(coalesce(description, '')) as description, count(*) as row_count from semantic
 group by 1, 2, 3) qualify row_number() over (partition by billing_code_type
  order by row_count desc, billing_code, description) <= 50""",
    "g16_type_filter_path": " union all ".join(
        f"""select '{name}' as layer_name, billing_code_type, count(*) as row_count,
 count(distinct trim(billing_code)) as distinct_code_count from {cte} group by 1, 2"""
        for name, cte in (
            ("fct_standard_charges_semantic", "semantic"), ("fct_rates_comparable", "comparable"),
            ("fct_rates_comparable_harmonized", "harmonized"),
            ("agg_hospital_procedure_compare", "compare"),
        )
    ),
    "g17_type_inventory": """select billing_code_type, count(*) as row_count,
 count(distinct trim(billing_code)) as distinct_code_count,
 count(distinct trim(coalesce(description, ''))) as distinct_description_count
 from semantic group by 1""",
    # Analyst queries.
    "a01_hospitals": "select *, hospital_name_clean as hospital_display_name from dim_hospital",
    "a01_payers": "select * from dim_payer",
    "a01_payer_families": "select payer_family, plan_family from dim_payer_harmonized",
    "a02_hospital_comparison": detail(f"{FILTERS} and a.payer_family = 'Aetna'"),
    "a02_hospital_comparison_gross": detail("""a.billing_code = '0014' and a.rate_category = 'gross'
 and a.rate_unit = 'dollars' and a.payer_family = 'Aetna' and a.plan_family = 'PPO'
 and a.billing_code_type = 'RC'"""),
    "a03_top_codes": top_codes("true", 100),
    "a03_top_codes_by_type": top_codes(f"billing_code_type = 'HCPCS' and {HERE}", 20),
    "a04_payer_plan_detail": detail(FILTERS),
    "a05_payer_rollup": f"""select payer_family, min(min_rate) as min_rate,
 cast(sum(cast(approx_median_rate as decimal(28,4))) as double) / count(*) as median_rate,
 max(max_rate) as max_rate, cast(sum(row_count) as bigint) as row_count,
 count(distinct hospital_id) as hospitals_covered, 'max' as rate_category, 'dollars' as rate_unit
 from compare where {MAX_FILTERS} group by 1""",
    "a06_plan_rollup": f"""select plan_family, min(min_rate) as min_rate,
 cast(sum(cast(approx_median_rate as decimal(28,4))) as double) / count(*) as median_rate,
 max(max_rate) as max_rate, cast(sum(row_count) as bigint) as row_count, 'max' as rate_category,
 'dollars' as rate_unit from compare where {MAX_FILTERS} and payer_family = 'Aetna' group by 1""",
    "a07_rejects_summary": """select comparability_reason, count(*) as row_count,
 min(payer_name) as sample_payer_name, min(hospital_id) as sample_hospital_id from (
 select * from rejects where billing_code = '00010' and rate_category = 'other'
 and rate_unit = 'dollars')
 group by 1""",
    "a08_search_procedures": """select billing_code, billing_code_type,
 canonical_description as description from procedures where lower(billing_code) like '%gear%'
 or lower(canonical_description) like '%gear%' order by 1, 2 limit 50""",
    "a09_comparable_rates": f"""select semantic_charge_sk, f.hospital_id,
 coalesce(d.hospital_name_clean, f.hospital_name) as hospital_name_clean, f.billing_code,
 f.billing_code_type, coalesce(p.canonical_description, f.description) as description,
 f.payer_family, f.plan_family, f.rate_category, f.rate_amount, f.rate_unit, f.ingested_at
 from harmonized f left join display d using (hospital_id)
 left join procedures p on f.billing_code = p.billing_code
  and f.billing_code_type = p.billing_code_type
 where f.billing_code = '00010' and f.rate_category = 'negotiated' and f.rate_unit = 'dollars'
 order by rate_amount desc, semantic_charge_sk limit 500""",
    "a10_hospital_rates": f"""select semantic_charge_sk, f.hospital_id,
 coalesce(d.hospital_name_clean, f.hospital_name) as hospital_name_clean, f.billing_code,
 f.billing_code_type, coalesce(p.canonical_description, f.description) as description,
 coalesce(h.payer_family, f.payer_name) as payer_family,
 coalesce(h.plan_family, f.plan_name) as plan_family, f.rate_category, f.rate_amount, f.rate_unit,
 f.ingested_at from semantic f left join display d using (hospital_id)
 left join procedures p on f.billing_code = p.billing_code
  and f.billing_code_type = p.billing_code_type
 left join dim_payer_harmonized h on coalesce(trim(f.payer_name), '') = h.payer_name_raw
  and coalesce(trim(f.plan_name), '') = h.plan_name_raw
 where f.{HERE} order by rate_amount desc, semantic_charge_sk limit 300""",
    "a11_overview": """select count(*) as charges_rows, min(ingested_at) as min_ingested_at,
 max(ingested_at) as max_ingested_at, (select count(*) from dim_hospital) as hospitals_rows,
 (select count(*) from dim_payer) as payers_rows,
 (select count(*) from dim_procedure) as procedures_rows from semantic""",
    "a12_code_type_breakdown": """select *, distinct_codes as distinct_billing_code_count,
 cast(sum(distinct_codes) over (partition by hospital_name_clean) as bigint)
  as total_distinct_codes
 from (select coalesce(d.hospital_name_clean, f.hospital_id) as hospital_name_clean,
  trim(billing_code_type) as billing_code_type, count(distinct billing_code) as distinct_codes
  from semantic f left join display d using (hospital_id) where billing_code_type <> 'APC'
  group by 1, 2)""",
    "a13_category_distribution": "select rate_category, count(*) as cnt from semantic group by 1",
    "a14_hospital_kpis": f"""select count(*) as total_rows,
 count(distinct billing_code) as distinct_procedures,
 count(distinct coalesce(payer_name, '') || '|' || coalesce(plan_name, '')) as distinct_payer_plan,
 quantile_disc(rate_amount, 0.5) as median_rate, min(rate_amount) as min_rate,
 max(rate_amount) as max_rate from semantic where {HERE}""",
    "a15_payer_coverage": f"""select payer_name, plan_name, count(*) as row_count from semantic
 where {HERE} group by 1, 2 order by 3 desc, 1 nulls first, 2 nulls first limit 100""",
    "a16_top_procedures": f"""select t.billing_code, t.billing_code_type,
 coalesce(p.canonical_description, t.own) as description, row_count from (
 select billing_code, billing_code_type, max(description) as own, count(*) as row_count
 from semantic where {HERE} group by 1, 2 order by 4 desc, 1, 2 limit 50) t
 left join procedures p using (billing_code, billing_code_type)""",
    "a17_coverage_matrix": """select a.hospital_id,
 coalesce(min(d.hospital_name_clean), a.hospital_id) as hospital_name_clean,
 count(distinct billing_code) as distinct_billing_codes,
 count(distinct payer_family) as distinct_payer_family,
 count(distinct plan_family) as distinct_plan_family,
 cast(sum(row_count) as bigint) as total_comparable_rows
 from compare a left join display d using (hospital_id) group by a.hospital_id""",
    "a18_procedure_variants": """select * from procedures where description_variants_count > 0
 order by description_variants_count desc, billing_code, billing_code_type limit 50""",
    "a19_payer_family_variants": """select payer_family,
 count(distinct payer_name_norm) as payer_name_norm_count from dim_payer_harmonized group by 1
 having count(distinct payer_name_norm) > 1 order by 2 desc, 1 limit 50""",
    "a20_data_quality": "select " + ", ".join(
        f"round(100.0::double * count(*) filter ({c} is null) / count(*), 2) as pct_null_{c}"
        for c in NULLS
    ) + """, count(*) filter (lower(billing_code_type) = 'unknown')
 as unknown_billing_code_type_count, count(*) as total_rows from semantic""",
    "a21_outliers": """select f.hospital_id, coalesce(d.hospital_name_clean, f.hospital_name)
 as hospital_name, f.billing_code, coalesce(p.canonical_description, f.description) as description,
 rate_category, rate_amount, payer_name, plan_name from semantic f
 left join display d using (hospital_id)
 left join procedures p on f.billing_code = p.billing_code
  and f.billing_code_type = p.billing_code_type
 order by rate_amount desc, semantic_charge_sk limit 100""",
    "a22_display_diagnostic": """select * from (select 'dim_hospital_hospital_name_clean'
 as check_name, case when regexp_full_match(lower(hospital_name_clean), '[0-9a-f]{32}')
  then 'hash-like' else 'human-readable' end as result_summary,
 case when length(hospital_name_clean) > 50 then hospital_name_clean[1:50] || '...'
  else hospital_name_clean end as sample_value,
 not regexp_full_match(lower(hospital_name_clean), '[0-9a-f]{32}') as ok
 from dim_hospital order by hospital_id, source_file_name limit 1)
 union all select case when count(*) = 0 then 'billing_code_99213'
  else 'billing_code_99213_normalized' end,
 case when count(*) = 0 then 'no 99213 rows' when bool_or(billing_code = '99213')
  then '99213 exact' else '99213 has variant (e.g. leading digit)' end, min(billing_code),
 coalesce(bool_or(billing_code = '99213'), false)
 from compare where billing_code like '%99213%'""",
    "a23_data_health": "select count(*) as charges_rows, min(ingested_at) as min_ingested_at,"
    " max(ingested_at) as max_ingested_at, " + ", ".join(
        f"100.0::double * count(*) filter ({c} is null) / count(*) as pct_null_{c}" for c in NULLS
    ) + """, (select count(*) from dim_hospital) as hospitals_rows,
 (select count(*) from dim_procedure) as procedures_rows,
 (select count(*) from dim_payer) as payers_rows,
 count(distinct hospital_id) as distinct_hospital_id,
 count(distinct billing_code) as distinct_billing_code from semantic""",
    "a24_hospital_metrics": """select count(*) as total_rows,
 count(distinct billing_code) as distinct_billing_code,
 median(rate_amount) as median_rate_amount, min(rate_amount) as min_rate_amount,
 max(rate_amount) as max_rate_amount from semantic where hospital_name = 'Supplier#000000003'
 having count(*) > 0""",
    "a25_hospital_top_rates": """select hospital_name, billing_code, billing_code_type, description,
 rate_amount, rate_category, ingested_at from semantic where hospital_name = 'Supplier#000000003'
 order by rate_amount desc nulls last, semantic_charge_sk limit 50""",
    "a26_denormalized": "select * from denormalized",
    "a27_search_rates": f"select * from denormalized where {SEARCH}",
    "a28_search_kpis": f"""select count(*) as row_count,
 count(distinct hospital_id) as distinct_hospitals, count(distinct billing_code) as distinct_codes,
 median(rate_amount) filter (rate_category = 'negotiated') as median_negotiated
 from denormalized where {SEARCH}""",
    "a29_top_by_median": """select billing_code, procedure_description, rate_amount,
 coalesce(billing_code, '') || ' – ' || coalesce(procedure_description, '')[1:40]
  as procedure_label
 from (select billing_code, procedure_description, median(rate_amount) as rate_amount
  from denormalized where rate_category = 'negotiated' and rate_unit = 'dollars' group by 1, 2)
 order by rate_amount desc, billing_code, procedure_description nulls first limit 10""",
    "a30_histogram": """select cast(least(cast(floor((rate_amount - lo) * 50 / (hi - lo)) as bigint),
  49) + 1 as integer) as bin, count(*) as rate_count
 from semantic, (select min(rate_amount) as lo, max(rate_amount) as hi from semantic
  where rate_unit = 'dollars') where rate_unit = 'dollars' group by 1""",
    "a31_measures": f"""select total as total_charge_amount, records as distinct_charge_records,
 total / codes as average_charge_per_procedure, negotiated / total as negotiated_share,
 gross as gross_charge_total, cash as cash_price_total, codes as procedure_count,
 hospitals as hospital_count from (select {money("rate_unit = 'dollars'")} as total,
 {money("rate_unit = 'dollars' and rate_category = 'negotiated'")} as negotiated,
 {money("rate_category = 'gross'")} as gross, {money("rate_category = 'cash'")} as cash,
 count(distinct semantic_charge_sk) as records, count(distinct billing_code) as codes,
 count(distinct hospital_id) as hospitals from semantic)""",
    "a31_charge_spread": """select hospital_id, billing_code, payer_name,
 max(rate_amount) filter (rate_category = 'max') - min(rate_amount) filter (rate_category = 'min')
  as charge_spread from semantic where rate_category in ('min', 'max') group by 1, 2, 3""",
    "a31_payer_totals": f"""select payer_name, plan_name, {money('true')} as payer_charge_total
 from semantic where rate_unit = 'dollars' group by 1, 2""",
    "a32_median_negotiated": """select hospital_id, billing_code, payer_name,
 median(rate_amount) as median_negotiated_rate from semantic
 where rate_category = 'negotiated' group by 1, 2, 3""",
    "a32_average_cash": f"""select hospital_id, billing_code,
 {money('true')} / count(*) as average_cash_price from semantic where rate_category = 'cash'
 group by 1, 2""",
    "a32_negotiated_cash_delta": f"""select hospital_id, billing_code, median_negotiated_rate,
 average_cash_price, median_negotiated_rate - average_cash_price as negotiated_cash_delta from (
 select hospital_id, billing_code,
 median(rate_amount) filter (rate_category = 'negotiated') as median_negotiated_rate,
 {money("rate_category = 'cash'")} / count(*) filter (rate_category = 'cash')
  as average_cash_price from semantic group by 1, 2)
 where median_negotiated_rate is not null and average_cash_price is not null""",
    "a33_hospital_options": """select distinct hospital_name from semantic
 where lower(hospital_name) like '%0000003%'""",
    "a33_payer_family_options": "select distinct payer_family from dim_payer_harmonized",
    "a33_plan_family_options": """select distinct plan_family from dim_payer_harmonized
 where payer_family = 'Aetna'""",
    # Functions.
    "f01_classify": by(CODES, classify("billing_code")),
    "f02_infer": by(CODES, infer("billing_code", "billing_code_type")),
    "f03_type_norm": by(CODES, kind("billing_code_type")),
    "f04_storage": by(CODES, stored("billing_code", "billing_code_type")),
    "f05_issue": by(CODES, issue("billing_code", "billing_code_type")),
    "f06_is_valid": by(CODES, f"({issue('billing_code', 'billing_code_type')}) is null"),
    "f07_validation": by(CODES, f"""case {kind('billing_code_type')}
 when 'ICD_10_CM' then replace(upper(trim(coalesce(billing_code, ''))), '.', '')
 when 'NDC' then replace(replace(upper(trim(coalesce(billing_code, ''))), '-', ''), ' ', '')
 else upper(trim(coalesce(billing_code, ''))) end"""),
    "f08_match_text": by("payer_name", match("payer_name")),
    "f09_numeric": """select negotiated_rate as cell,
 cast(try_cast(trim(negotiated_rate) as decimal(38,9)) as double) as result, count(*) as row_count
 from lake_tabular group by all""",
    "f10_json_value": """select json_extract_string(props, '$.k') as k, count(*) as row_count
 from events group by 1""",
    "f11_json_keys": """select array_to_string(list_sort(json_keys(raw)), ',') as json_keys,
 count(*) as row_count from landing_tall group by 1""",
    "f12_regexp": by("source_file_name", r"""concat_ws('|',
 regexp_extract(source_file_name, '(\d+)_', 1),
 cast(regexp_matches(source_file_name, '\.csv$') as varchar),
 regexp_replace(source_file_name, '\d+', '#', 'g'))"""),
    "f13_strings": by("description", f"""concat_ws('|', trim(description), lower(description),
 upper(description), {initcap('lower(trim(description))')}, trim(description)[1:3],
 cast(length(description) as varchar), replace(description, ' ', '_'))"""),
    "f14_hashes": by("source_file_name",
                     "md5(source_file_name) || '|' || sha256(source_file_name)"),
    "f15_round": """select source_system, round(100.0::double * count(*) filter (payer_name is null)
 / count(*), 2) as pct_null_payer from charges group by 1""",
    "f16_days": """select cast(ingested_at as date) as day, count(*) as row_count from charges
 where ingested_at > timestamp '1996-06-30' group by 1""",
    "f17_rate_category": by("rate_type", CATEGORY),
    "f17_lake_rate_category": f"""select rate_type, {LAKE_CATEGORY} as result,
 count(*) as row_count from candidates group by all""",
    "f18_rate_unit": by("rate_type", f"""case when {norm_type()} like '%percent%' then 'percent'
 else 'dollars' end"""),
    "f19_comparability": """select comparability_key as key, comparability_reason as reason,
 count(*) as row_count from comparable group by 1, 2""",
    "f20_hospital_names": rf"""select source_file_name, clean,
 trim(regexp_replace(regexp_replace(lower(clean), '[^a-z0-9\s]', '', 'g'), ' +', ' ', 'g')) as norm
 from (select source_file_name, {CLEAN.format(x='hospital_name_clean')} as clean from file_names)""",
    # Quality checks.
    "q01_not_null_semantic": null_rows("semantic", (
        "semantic_charge_sk", "hospital_id", "billing_code", "rate_category", "ingested_at",
        "payer_name", "plan_name", "description")),
    "q01_not_null_compare": null_rows("compare", (
        "billing_code", "hospital_id", "rate_category", "approx_median_rate", "payer_family",
        "plan_family")),
    "q02_unique_semantic": repeated("semantic", "semantic_charge_sk"),
    "q02_unique_hospital_id": repeated("dim_hospital", "hospital_id"),
    "q03_accepted_types": unaccepted("dim_procedure", "billing_code_type", KNOWN),
    "q03_accepted_categories": unaccepted(
        "comparable", "rate_category",
        "'negotiated', 'gross', 'cash', 'min', 'max', 'percentage', 'other'"),
    "q03_accepted_systems": unaccepted("base", "source_system", "'json', 'csv_tall', 'csv_wide'"),
    "q04_hospital_relationship": """select distinct hospital_id as value from semantic
 where hospital_id not in (select hospital_id from dim_hospital)""",
    "q04_procedure_relationship": """select distinct billing_code as value from comparable
 where billing_code not in (select billing_code from dim_procedure)""",
    "q05_not_empty": """select 'agg_hospital_procedure_compare' as empty_table
 where not exists (select 1 from compare)""",
    "q06_code_formats": f"""select billing_code, billing_code_type, normalized_billing_code from (
 select billing_code, billing_code_type, {kind('billing_code_type')} as k,
 case {kind('billing_code_type')}
  when 'ICD_10_CM' then replace(upper(trim(billing_code)), '.', '')
  else upper(trim(billing_code)) end as normalized_billing_code from dim_procedure)
 where (k = 'CPT' and not regexp_full_match(normalized_billing_code, '[0-9]{{5}}'))
 or (k in ('HCPCS', 'HIPPS') and not regexp_full_match(normalized_billing_code, '[A-Z0-9]{{5}}'))
 or (k in ('DRG', 'MS_DRG', 'APR_DRG', 'TRIS_DRG')
  and not regexp_full_match(normalized_billing_code, '[0-9]{{3}}'))
 or (k in ('APC', 'EAPG', 'REVENUE', 'RC')
  and not regexp_full_match(normalized_billing_code, '[0-9]{{4}}'))
 or (k = 'ICD_10_PCS' and not regexp_full_match(normalized_billing_code, '[A-Z0-9]{{7}}'))
 or (k = 'ICD_10_CM' and not regexp_full_match(normalized_billing_code, '[A-Z0-9]{{3,7}}'))""",
    "q07_unknown_share": """select * from (select count(*) as total,
 count(*) filter (billing_code_type = 'UNKNOWN') as unknown_count from dim_procedure)
 where total > 0 and cast(unknown_count as double) / total >= 0.01""",
    "q08_numeric_prefixes": r"""select hospital_id, hospital_name, hospital_name_clean,
 source_file_name from dim_hospital
 where regexp_matches(trim(hospital_name_clean), '^\d{1,3}\s+\d{5,}')""",
    "q09_invalid_codes": f"""select billing_code, billing_code_type, agg_name from (
 select *, 'agg_hospital_procedure_compare' as agg_name from compare
 union all select *, 'agg_payer_plan_compare' from compare)
 where ({issue('billing_code', 'billing_code_type')}) is not null""",
    "q10_other_category": "select * from compare where lower(trim(rate_category)) = 'other'",
    "q11_landing_counts": """select 'pt_csv_raw_tall' as table_name, source_file_name,
 count(*) as row_count, min(ingested_at) as first_ingested, max(ingested_at) as last_ingested
 from landing_tall group by 1, 2""",
    "q11_extracted_counts": """select 'pt_json_extracted_rates' as table_name, source_file_name,
 record_path, count(*) as row_count, min(ingested_at) as first_ingested,
 max(ingested_at) as last_ingested from landing_json group by 1, 2, 3""",
    "q12_sample_keys": """select source_file_name, ingested_at,
 array_to_string(list_sort(json_keys(raw)), ',') as sample_json_keys from landing_tall
 order by source_file_name, ingested_at, raw limit 1""",
    "q13_first_rows": """select * from (select source_file_name, ingested_at, raw,
 row_number() over (partition by source_file_name order by ingested_at, raw) as rn
 from landing_wide) where rn <= 5""",
    "q13_sample_rows": """select * from landing_json
 order by source_file_name, ingested_at, raw_rate, billing_code limit 20""",
    "q14_format_counts": """select json_extract_string(raw, '$._meta_format_hint') as format_hint,
 count(*) as row_count from (select raw from landing_tall union all select raw from landing_wide)
 group by 1""",
    "q14_json_rows": """select count(*) filter (json_valid(raw)) as json_typed_rows
 from landing_tall""",
    "q15_published_counts": """select 'fct_standard_charges_semantic' as table_name,
 count(*) as row_count from semantic union all select 'dim_hospital', count(*) from dim_hospital
 union all select 'dim_payer', count(*) from dim_payer
 union all select 'dim_procedure', count(*) from dim_procedure""",
    "q16_comparable_groups": """select hospital_id, billing_code,
 cast(count(distinct rate_category) as integer) as rate_category_values,
 cast(count(distinct rate_unit) as integer) as rate_unit_values from comparable group by 1, 2
 having count(distinct rate_category) > 1 or count(distinct rate_unit) > 1""",
    # Ingest operators.
    "i01_file_hash": "select source_file_name, file_hash from files",
    "i02_not_loaded": """select source_file_name, file_hash from files
 where file_hash not in (select file_hash from files where doc_id % 3 = 0)""",
    "i03_forced": """select source_file_name, file_hash from files where source_format = 'csv'
 or file_hash not in (select file_hash from files where doc_id % 3 = 0)""",
    "i12_charge_rows": """select * from lake_tabular where trim(billing_code) <> ''
 and (trim(coalesce(gross_charge, '')) <> '' or trim(coalesce(discounted_cash_price, '')) <> ''
  or trim(coalesce(negotiated_rate, '')) <> '')""",
    "i18_safe_preview": r"""select doc_id, case when length(line) > 200 then line[1:200] || '...'
 else line end as preview from (select doc_id, trim(regexp_replace(regexp_replace(text[1:400],
 '[\x00-\x08\x0b\x0c\x0e-\x1f]', ' ', 'g'), '\s+', ' ', 'g')) as line from documents)""",
    "i19_extract_records": """select 'events_' || event_type || '.json' as source_file_name,
 cast(event_id as varchar) as run_id, ts as ingested_at, 'ndjson_line' as record_path,
 event_type as billing_code, cast(null as varchar) as billing_code_type,
 event_type as description, cast(null as varchar) as payer, cast(null as varchar) as plan,
 cast(user_id as double) as negotiated_rate, cast(null as varchar) as rate_type,
 cast(null as varchar) as billing_class, cast(null as varchar) as payment_methodology,
 cast(null as varchar) as payment_unit from events""",
    "i23_key_profile": """select count(*) as json_lines, (select string_agg(k, ',' order by k) from (
  select distinct unnest(json_keys(props)) as k
  from events where props like '{%' and json_valid(props))) as sample_keys
 from events where props like '{%' and json_valid(props)""",
    "i24_not_registered": """select distinct source_file_name from charges
 where source_file_name not in (select source_file_name from csv_registry where status = 'success'
  union all select source_file_name from json_registry where status = 'success')""",
    "i25_load_counts": """select source_file_name, count(raw) as rows_loaded,
 count(raw) > 0 as verified from (select distinct source_file_name from csv_registry
 union select distinct source_file_name from json_registry) f
 left join landing_tall using (source_file_name) group by 1""",
    "s07_lenient_objects": """select line, count(*) as row_count from (
 select trim(unnest(string_split(text, chr(10)))) as line from documents
 union all select trim(props) from events) where line like '{%' and json_valid(line) group by 1""",
    "s01_csv_rows": """select 'drop/' || l_suppkey || '.csv' as source_path, l_partkey::varchar as billing_code,
 'ship "' || l_linestatus || '"' || chr(10) || 'part, ' || l_suppkey as description,
 trunc(l_extendedprice)::bigint::varchar as gross_charge, null::varchar as discounted_cash_price,
 trunc(l_quantity)::bigint::varchar as negotiated_rate, l_linenumber || '" line' as payer_name,
 null::varchar as plan_name from lineitem""",
    "s02_preamble_rows": """select l_suppkey || '.csv' as source_file_name, 'TALL' as format_hint,
 '{"billing_code":"' || l_partkey || '","description":"ship \\"' || l_linestatus || '\\"\\npart, ' || l_suppkey
 || '","payer_name":"' || l_linenumber || '\\" line","gross_charge":"' || trunc(l_extendedprice)::bigint
 || '","negotiated_rate":"' || trunc(l_quantity)::bigint || '","_meta_format_hint":"TALL","_meta_row_number":'
 || 3 + row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey,
 l_linestatus, l_extendedprice, l_quantity)
 || ',"_meta_header_column_count":5}' as raw from lineitem""",
    "i09_header": """select distinct 'drop/' || l_suppkey || '.csv' as source_path, 'utf-8' as encoding,
 2 as header_row, 6 as header_score, 'billing_code|description|payer_name|gross_charge|negotiated_rate' as columns,
 true as has_code_col, true as has_rate_col, true as looks_like_charge_table from lineitem""",
    "s03_documents": """select 'drop/' || l_suppkey || '.json' as source_path,
 '{"description":"part } \\"' || l_partkey || '\\" [","code_information":[{"code":"' || l_partkey || '","type":"CPT"}],'
 || '"standard_charges":[{"setting":"' || l_linestatus || '","gross_charge":' || trunc(l_extendedprice)::bigint
 || ',"payers_information":[{"payer_name":"' || l_returnflag || '","plan_name":"' || l_linenumber
 || '","estimated_amount":' || trunc(l_quantity)::bigint || '}]}]}' as element from lineitem""",
    "i20_services": """select l_suppkey || '.json' as source_file_name, 'run' as run_id,
 'standard_charge_information.item' as record_path, l_partkey::varchar as billing_code, 'CPT' as billing_code_type,
 'part } "' || l_partkey || '" [' as description, l_returnflag as payer, l_linenumber::varchar as plan,
 trunc(l_quantity)::decimal(38,9) as negotiated_rate, 'estimated_amount' as rate_type, l_linestatus as billing_class,
 null::varchar as payment_methodology, null::varchar as payment_unit,
 '{"service":{"description":"part } \\"' || l_partkey || '\\" [","billing_code":"' || l_partkey
 || '","billing_code_type":"CPT"},"standard_charge":{"setting":"' || l_linestatus || '","gross_charge":'
 || trunc(l_extendedprice)::bigint || '.0,"discounted_cash":null,"minimum":null,"maximum":null},"payer":{"payer_name":"'
 || l_returnflag || '","plan_name":"' || l_linenumber || '","methodology":null,"estimated_amount":'
 || trunc(l_quantity)::bigint || '.0}}' as raw_rate from lineitem""",
    "i01_content_hash": """with lines as (
 select doc_id, strlen(text) + 1 as size, unnest(string_split(text, chr(10))) as line,
 unnest(range(len(string_split(text, chr(10))))) as n from documents where text is not null),
 hashed as (select doc_id, size, sha256(n || ':' || line) as d from lines),
 sums as (select doc_id, max(size) as size, count(*) as n, sum(('0x' || d[1:16])::ubigint::hugeint) as a,
 sum(('0x' || d[17:32])::ubigint::hugeint) as b from hashed group by doc_id)
 select 'doc_' || doc_id as source_path, sha256(size || ':' || n || ':' || a || ':' || b) as file_hash from sums""",
    "i13_delimiter": """select distinct 'drop/' || l_suppkey || '.csv' as source_path, 'utf-8' as encoding,
 ',' as delimiter, 'TALL' as format_hint, 5::bigint as header_count,
 '{"hospital_name":"Fixture","state":"NY","license":"17","last_updated":"2024-01-01","version":"2.0"}' as preamble
 from lineitem""",
    # Checks over delivered rows, landing tables and files.
    "q00_check_run": tally("semantic", "semantic", {
        **{f"not_null {c}": f"{c} is null" for c in (
            "semantic_charge_sk", "hospital_id", "billing_code", "payer_name", "plan_name", "description")},
        "accepted_values rate_category":
            "rate_category not in ('negotiated', 'gross', 'cash', 'min', 'max', 'percentage', 'other')",
        "no_other rate_category": "rate_category = 'other'",
        "relationships hospital_id": "hospital_id not in (select hospital_id from dim_hospital)",
    }, ("semantic_charge_sk",)) + " union all " + tally("dim_procedure", "procedures", {
        "not_null billing_code": "billing_code is null",
        "accepted_values billing_code_type": f"billing_code_type not in ({KNOWN})",
    }),
    "q00_check_run_delivered": tally("charges", "charges", {
        **{f"not_null {c}": f"{c} is null" for c in (
            "billing_code", "billing_code_type", "description", "payer_name", "plan_name", "rate_amount")},
        "accepted_values rate_type": f"rate_type not in ({DELIVERED})",
        "accepted_values billing_code_type": f"billing_code_type not in ({KNOWN})",
        "relationships source_file_name": f"source_file_name not in ({REGISTERED})",
    }, ("run_id", "raw_rate_json")),
    "q01_not_null_delivered": null_rows("charges", (
        "billing_code", "billing_code_type", "description", "payer_name", "hospital_id")),
    "q02_unique_run": repeated("charges", "run_id"),
    "q03_accepted_rate_types": unaccepted("charges", "rate_type", DELIVERED),
    "q04_file_relationship": f"""select distinct source_file_name as value from charges
 where source_file_name not in ({REGISTERED})""",
    "q05_empty_class": """select 'classified_charges' as empty_table
 where not exists (select 1 from charges where billing_class is not null)""",
    "q08_stated_prefixes": r"""select run_id as hospital_id, n as hospital_name, n as hospital_name_clean,
 source_file_name from (select *, json_extract_string(preamble_kv, '$.hospital_name') as n from csv_registry)
 where regexp_matches(trim(n), '^\d{1,3}\s+\d{5,}')""",
    "q09_invalid_delivered": f"""select billing_code, billing_code_type, 'charges' as agg_name from (
 select distinct billing_code, billing_code_type from charges)
 where ({issue('billing_code', 'billing_code_type')}) is not null""",
    "q10_other_semantic": "select * from semantic where lower(trim(rate_category)) = 'other'",
    "q11_wide_counts": """select 'pt_csv_raw_wide' as table_name, source_file_name,
 count(*) as row_count, min(ingested_at) as first_ingested, max(ingested_at) as last_ingested
 from landing_wide group by 1, 2""",
    "q11_document_counts": """select 'pt_json_raw' as table_name, source_file_name,
 count(*) as row_count, min(ingested_at) as first_ingested, max(ingested_at) as last_ingested
 from (select distinct source_file_name, ingested_at, run_id from landing_json) group by 1, 2""",
    "q14_json_rows_wide": "select count(*) filter (json_valid(raw)) as json_typed_rows from landing_wide",
    "m09_returning_keys": """select b.* exclude (hospital_id, back) replace (
 case when back then 'delivered again' else description end as description,
 case when back then ingested_at + interval 3650 days else ingested_at end as ingested_at), d.hospital_id
 from (select *, coalesce(ingested_at < '1997-01-01' and rate_type = 'gross_charge', false) as back from base) b
 left join dim_hospital d using (source_file_name)""",
    "i04_manifest": """select source_file_name as source_path, coalesce(file_hash, '') as file_hash,
 case when doc_id % 5 = 0 then 'FAILED' else 'SUCCESS' end as status, '2024-01-01' as ingest_date,
 case when doc_id % 5 = 0 then 'invalid JSON' else '' end as error_message from files""",
    "i05_run_summary": """select count(*) filter (doc_id % 5 <> 0) as ingested, 0::bigint as skipped,
 count(*) filter (doc_id % 5 = 0) as failed from files""",
    "i06_encodings": """select 'doc_' || doc_id as source_path,
 case when doc_id % 3 = 0 then 'latin-1' else 'utf-8' end as encoding,
 case when doc_id % 3 = 0 then strlen(replace(text, chr(10), '')) + 1
 else length(replace(text, chr(10), '')) end as n_chars from documents where text is not null""",
    "i07_line_shapes": """select source_path, count(*) filter (line <> '') as lines,
 count(*) filter (line like '{%' and json_valid(line)) as objects, count(*) filter (line <> '') >= 2
 and count(*) filter (line <> '') = count(*) filter (line like '{%' and json_valid(line)) as is_ndjson from (
 select 'doc_' || doc_id as source_path, trim(unnest(string_split(text, chr(10)))) as line from documents
 where text is not null
 union all select 'events_' || event_id % 50, trim(props) from events) group by 1""",
    "i21_capped": """select source_file_name, raw from landing_tall
 order by md5(source_file_name || raw) limit 1000""",
    "i26_routing": """select l_suppkey || '.csv' as source_file_name, 'run' as run_id, 'TALL' as format_hint,
 ',' as delimiter, case when l_suppkey % 5 = 0 then 0 else count(*) end as rows_loaded,
 case when l_suppkey % 5 = 0 then 'failed' else 'success' end as status,
 case when l_suppkey % 5 = 0 then 'no rows loaded' end as error_message from lineitem group by l_suppkey""",
}

EXTRA = {**LAKE, "files": """select 'doc_' || doc_id as source_file_name,
 case when doc_id % 2 = 0 then 'csv' else 'json' end as source_format, sha256(text) as file_hash,
 doc_id from documents""", "twice": """select * from charges
 union all select * replace ('retry-' || run_id as run_id) from charges"""}


def oracle() -> dict[str, str]:
    return {name: with_ctes(select, EXTRA) for name, select in SELECTS.items()}
