"""Lake rates and landing tables as ANSI SQL."""

from ratelens.oracle.marts_sql import CHARGE_KEY, STAGED, classify, json_name, key, SHORT_NAMES

NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def strict(c):
    return f"case when regexp_full_match(trim({c}), '{NUMBER}') then try_cast(trim({c}) as double) end"


def parse(c):
    digits = rf"regexp_extract(regexp_replace(trim({c}), '[$,]', '', 'g'), '-?\d+\.?\d*')"
    return f"""case when lower(trim({c})) not in ('n/a', 'na', 'null', '-')
 then try_cast(nullif({digits}, '') as double) end"""


REASON = """case when coalesce(source_file_name, '') = '' then 'missing_source_file_name'
 when trim(coalesce(billing_code, '')) = '' then 'MISSING_CODE'
 when rate_amount is null then 'MISSING_RATE' when rate_amount < 0 then 'BAD_RATE_VALUE' end"""

META = """source_path as source_file_name, source_format,
 cast(ingest_day as varchar) as ingest_date, cast(ingest_day as varchar) || 'T00:00:00'
 as ingested_at"""


def tabular(column, kind):
    return f"""select {META}, coalesce(nullif(trim(billing_code), ''), nullif(trim(code), ''), '')
 as billing_code, coalesce(description, '') as description, '{kind}' as rate_type,
 {strict(column)} as rate_amount,
 coalesce(nullif(trim(payer_name), ''), nullif(trim(payer), '')) as payer_name,
 nullif(trim(plan_name), '') as plan_name, cast(null as varchar) as reject
 from lake_tabular where {strict(column)} is not null"""


def flat(member, kind):
    amount = parse(f"json_extract_string(item, '$.{member}')")
    return f"""select source_file_name, source_format, ingest_date, ingested_at,
 trim(coalesce(nullif(json_extract_string(item, '$.code'), ''),
  json_extract_string(item, '$.billing_code'), '')) as billing_code,
 coalesce(json_extract_string(item, '$.description'), '') as description, '{kind}' as rate_type,
 {amount} as rate_amount,
 nullif(trim(coalesce(nullif(json_extract_string(item, '$.payer_name'), ''),
  json_extract_string(item, '$.payer'))), '') as payer_name, cast(null as varchar) as plan_name,
 cast(null as varchar) as reject from items where not nested and {amount} is not null"""


def nested(member):
    amount = parse(f"json_extract_string(charge, '$.{member}')")
    return f"""select source_file_name, source_format, ingest_date, ingested_at, item_code, item_text,
 '{member.upper()}', {amount}, null, null, null from nested_charges where {amount} is not null"""


PAYER_AMOUNT = parse(
    "coalesce(nullif(json_extract_string(p, '$.standard_charge_dollar'), ''),"
    " case when json_type(p, '$.negotiated_rate') <> 'VARCHAR'"
    " and json_extract_string(p, '$.negotiated_rate') = '0' then null"
    " else nullif(json_extract_string(p, '$.negotiated_rate'), '') end)"
)


def rejected(condition, reason, code):
    return f"""select source_file_name, source_format, ingest_date, ingested_at, {code}, item_text,
 null, null, null, null, '{reason}' from nested_items where {condition}"""


def field(*keys, number=False):
    parts = [f"json_extract_string(raw, '$.{k}')" for k in keys]
    value = "coalesce(" + ", ".join(parts) + ")" if len(parts) > 1 else parts[0]
    return f"cast(try_cast({value} as decimal(38,9)) as double)" if number else value


STATED = "coalesce(nullif(trim(row_name), ''), stated_name, l.source_file_name)"


def staged(source, system):
    return f"""select {STATED} as hospital_name, md5(lower(trim({STATED}))) as hospital_id,
 billing_code, billing_code_type, description, payer_name, plan_name, rate_type, rate_amount,
 billing_class, gross_charge, discounted_cash, minimum, maximum, '{system}' as source_system,
 l.source_file_name, cast(null as varchar) as run_id, ingested_at, raw as raw_rate_json
 from {source} l left join registry_names r on l.source_file_name = r.source_file_name"""


def wide(rate):
    return f"""select *, '{rate}' as rate_type, {rate} as rate_amount, cast(null as varchar)
 as payer_name, cast(null as varchar) as plan_name from wide_fields where {rate} is not null"""


CTES = {
    "tabular_rates": f"""{tabular('negotiated_rate', 'NEGOTIATED')}
 union all {tabular('gross_charge', 'GROSS')} union all {tabular('discounted_cash_price', 'CASH')}
 union all select {META}, coalesce(nullif(billing_code, ''), nullif(code, '')), description, null,
 null, null, null, 'MISSING_RATE' from lake_tabular where {strict('negotiated_rate')} is null
 and {strict('gross_charge')} is null and {strict('discounted_cash_price')} is null""",
    "documents_in": f"""select {META}, coalesce(json_extract(payload_json, '$.standardCharges'),
 json_extract(payload_json, '$.STANDARDCHARGES'),
 json_extract(payload_json, '$.standard_charge_information')) as charges from lake_payload""",
    "items": """select source_file_name, source_format, ingest_date, ingested_at, item,
 json_extract(item, '$.code_information') is not null
  and json_extract(item, '$.standard_charges') is not null as nested
 from (select *, unnest(cast(charges as json[])) as item from documents_in
  where charges is not null)""",
    "nested_items": """select *,
 nullif(trim(json_extract_string(item, '$.code_information[0].code')), '') as item_code,
 coalesce(json_extract_string(item, '$.description'), '') as item_text,
 json_array_length(item, '$.standard_charges') as n_charges from items where nested""",
    "nested_charges": """select *, unnest(cast(json_extract(item, '$.standard_charges') as json[]))
 as charge from nested_items where item_code is not null""",
    "payload_rates": f"""{flat('negotiated_rate', 'NEGOTIATED')}
 union all {flat('gross_charge', 'GROSS')} union all {flat('cash_discount', 'CASH')}
 union all {nested('negotiated_rate')} union all {nested('gross_charge')}
 union all {nested('discounted_cash_price')} union all {nested('minimum')}
 union all {nested('maximum')}
 union all select source_file_name, source_format, ingest_date, ingested_at, item_code, item_text,
  'NEGOTIATED', {PAYER_AMOUNT}, nullif(trim(json_extract_string(p, '$.payer_name')), ''),
  nullif(trim(json_extract_string(p, '$.plan_name')), ''), null
  from (select *, unnest(cast(json_extract(charge, '$.payers_information') as json[])) as p
   from nested_charges where json_extract(charge, '$.payers_information') is not null)
  where {PAYER_AMOUNT} is not null
 union all {rejected('item_code is null', 'MISSING_CODE', 'null')}
 union all {rejected('item_code is not null and n_charges = 0', 'MISSING_RATE', 'item_code')}
 union all select source_file_name, source_format, ingest_date, ingested_at, null, null, null, null,
  null, null, 'JSON_UNSUPPORTED_SHAPE' from documents_in where charges is null""",
    "tabular_candidates": f"""select * exclude (reject), coalesce(reject, {REASON}) as reason_code
 from tabular_rates""",
    "payload_candidates": f"""select * exclude (reject), coalesce(reject, {REASON}) as reason_code
 from payload_rates""",
    "candidates": """select *, 'CSV/tabular' as branch from tabular_candidates
 union all select *, 'JSON' from payload_candidates""",
    "good": "select * exclude (reason_code, branch) from candidates where reason_code is null",
    "lake_base": rf"""select {key('source_system', 'source_file_name', 'ingested_at', 'hospital_id',
  'billing_code', 'rate_type', 'cast(rate_amount as decimal(38,9))')} as standard_charge_sk, *
 from (select *, md5(hospital_name_clean) as hospital_id,
   regexp_replace(hospital_name_clean, '[^a-z0-9]+', ' ', 'g') as hospital_name_norm,
   case when lower(source_format) like '%json%' then 'json' else 'csv_wide' end as source_system,
   {classify('billing_code')} as billing_code_type, cast(null as varchar) as raw_rate_json
  from (select *, lower(coalesce(nullif(trim(hospital_name), ''), 'unknown')) as hospital_name_clean
   from (select *, trim(regexp_replace(hospital_token, '_+', ' ', 'g')) as hospital_name
    from (select *, regexp_replace(regexp_replace(regexp_replace(source_file_name,
      '\.(csv|json|parquet)$', ''), '^\d+_', ''), '_standardcharges.*$', '') as hospital_token
     from good))))""",
    "lake_hospitals": """select hospital_id, min(hospital_name) as hospital_name,
 min(hospital_name_clean) as hospital_name_clean, min(hospital_name_norm) as hospital_name_norm,
 min(source_system) as source_system, min(source_file_name) as source_file_name
 from lake_base group by 1""",
    "lake_wide": """select b.* exclude (hospital_id), coalesce(d.hospital_id, md5(b.source_file_name))
  as hospital_id, cast(null as varchar) as billing_class, cast(null as varchar) as run_id,
 case when upper(rate_type) = 'GROSS_CHARGE' then rate_amount end as gross_charge,
 case when upper(rate_type) in ('CASH', 'DISCOUNTED_CASH_PRICE') then rate_amount end
  as discounted_cash,
 case when upper(rate_type) = 'MINIMUM' then rate_amount end as minimum,
 case when upper(rate_type) = 'MAXIMUM' then rate_amount end as maximum
 from lake_base b left join (select source_file_name, min(hospital_id) as hospital_id
  from lake_hospitals group by 1) d on b.source_file_name = d.source_file_name""",
    "lake_charges": f"""select standard_charge_sk, {STAGED} from (
 select *, row_number() over (partition by standard_charge_sk order by ingested_at desc,
  description desc nulls last, gross_charge desc nulls last, discounted_cash desc nulls last,
  minimum desc nulls last, maximum desc nulls last, hospital_name desc nulls last,
  billing_code_type, payer_name, plan_name) as rn from lake_wide) where rn = 1""",
    "registry_names": f"""select source_file_name, {json_name(SHORT_NAMES)} as stated_name
 from csv_latest""",
    "tall_fields": f"""select source_file_name, ingested_at, raw, {field('hospital_name')} as row_name,
 {field('billing_code', 'code', 'service_code')} as billing_code,
 {field('billing_code_type', 'code_type')} as billing_code_type,
 {field('description', 'procedure_description')} as description,
 {field('payer_name', 'payer')} as payer_name, {field('plan_name', 'plan')} as plan_name,
 coalesce({field('rate_type', 'standard_charge_type')}, 'estimated_amount') as rate_type,
 {field('estimated_amount', 'negotiated_rate', 'rate', 'amount', number=True)} as rate_amount,
 {field('billing_class', 'setting')} as billing_class,
 {field('gross_charge', number=True)} as gross_charge,
 {field('discounted_cash', number=True)} as discounted_cash,
 {field('minimum', 'min', number=True)} as minimum, {field('maximum', 'max', number=True)} as maximum
 from landing_tall""",
    "wide_fields": f"""select source_file_name, ingested_at, raw, {field('hospital_name')} as row_name,
 {field('code', 'billing_code', 'service_code', 'CPT', 'HCPCS')} as billing_code,
 {field('billing_code_type', 'code_type')} as billing_code_type,
 {field('description', 'procedure_description', 'Description')} as description,
 {field('billing_class', 'setting')} as billing_class,
 {field('gross_charge', number=True)} as gross_charge,
 {field('discounted_cash', number=True)} as discounted_cash,
 {field('min', number=True)} as minimum, {field('max', number=True)} as maximum,
 {field('negotiated_dollar', number=True)} as negotiated_dollar,
 {field('negotiated_percentage', number=True)} as negotiated_percentage,
 {field('estimated_amount', number=True)} as estimated_amount from landing_wide""",
    "wide_rates": f"""{wide('negotiated_dollar')} union all {wide('negotiated_percentage')}
 union all {wide('estimated_amount')}""",
    "staged_json": """select source_file_name as hospital_name,
 md5(lower(trim(source_file_name))) as hospital_id, billing_code, billing_code_type, description,
 payer as payer_name, plan as plan_name, coalesce(rate_type, 'negotiated_rate') as rate_type,
 negotiated_rate as rate_amount, billing_class, cast(null as double) as gross_charge,
 cast(null as double) as discounted_cash, cast(null as double) as minimum,
 cast(null as double) as maximum, 'json' as source_system, source_file_name, run_id, ingested_at,
 raw_rate as raw_rate_json from landing_json""",
    "staged_tall": staged("tall_fields", "csv_tall"),
    "staged_wide": staged("wide_rates", "csv_wide"),
    "staged": "select * from staged_json union all select * from staged_tall union all select * from staged_wide",
    "staged_base": f"""select standard_charge_sk, {STAGED} from (
 select *, row_number() over (partition by standard_charge_sk order by ingested_at desc,
  run_id desc nulls last, description desc nulls last, gross_charge desc nulls last) as rn
 from (select *, {CHARGE_KEY} as standard_charge_sk from staged)) where rn = 1""",
}
