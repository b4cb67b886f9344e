"""Charge rows, registries, landing tables and lake rows derived from the star-schema test tables.

Each function is a plain projection, so the work of every query grows with the tables.
"""

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelens.sources.tables import read_table, written

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LINES = """
@lineitem join @orders on l_orderkey = o_orderkey join @customer on o_custkey = c_custkey
join @part on l_partkey = p_partkey join @supplier on l_suppkey = s_suppkey
"""

# The same join as Spark runs it: customers meet orders first, so that lines are not shuffled for them.
LINES_ORDERED = """
@lineitem join (select * from @orders join @customer on o_custkey = c_custkey) placed on l_orderkey = o_orderkey
join @part on l_partkey = p_partkey join @supplier on l_suppkey = s_suppkey
"""

# Joined lines spread over {tasks} tasks, for inputs whose rows cost far more to read than to shuffle. How many tasks a join
# ends in follows from its bytes, its files and which side is broadcast: as few as one.
LINES_SPREAD = f"(select /*+ repartition({{tasks}}, l_orderkey, l_linenumber) */ * from {LINES_ORDERED}) spread_lines"
COSTLY = ("lake_tabular", "lake_payload")

FILE_NAME = """concat(cast(100 + s_suppkey as string), '_', lower(replace(s_name, '#', '-')),
  '_standardcharges.', case when s_suppkey % 3 = 0 then 'json' else 'csv' end)"""

CODE = """case l_partkey % 10
  when 0 then lpad(cast(l_partkey as string), 5, '0')
  when 1 then concat('1', lpad(cast(l_partkey as string), 5, '0'))
  when 2 then concat('j', lpad(cast(l_partkey as string), 4, '0'))
  when 3 then concat(lpad(cast(l_partkey as string), 5, '0'), '-0123-01')
  when 4 then lpad(cast(l_partkey as string), 4, '0')
  when 5 then lpad(cast(l_partkey % 1000 as string), 3, '0')
  when 6 then concat('0dtj', lpad(cast(l_partkey % 1000 as string), 3, '0'))
  when 7 then concat('e', lpad(cast(l_partkey % 100 as string), 2, '0'), '.65')
  when 8 then concat('X', cast(l_partkey as string), '?') else null end"""

CODE_TYPE = """case l_partkey % 10 when 0 then 'CPT' when 1 then 'cpt' when 2 then 'HCPCS'
  when 3 then 'NDC' when 4 then 'RC' when 5 then 'MS-DRG' when 6 then 'ICD-10-PCS'
  when 7 then 'ICD_10_CM'
  when 8 then (case l_partkey % 3 when 0 then 'CDM' when 1 then 'LOCAL' else null end)
  else 'UNKNOWN' end"""

PAYER = """case c_custkey % 7 when 0 then 'Aetna [123]' when 1 then 'Blue Cross & Blue Shield'
  when 2 then 'United-Healthcare'
  when 3 then (case when c_nationkey % 2 = 0 then 'CIGNA' else 'Cigna.' end)
  when 4 then ' medicare ' when 5 then c_mktsegment else null end"""

PLAN = """case c_nationkey % 4 when 0 then 'PPO' when 1 then 'choice.'
  when 2 then 'Medicare Fee-for-Service' else null end"""

CHARGES = f"""
select s_name as hospital_name, md5(lower(trim(s_name))) as hospital_id,
 {CODE} as billing_code, {CODE_TYPE} as billing_code_type,
 case when l_linenumber = 1 then concat(' ', p_name, ' ') when l_linenumber = 2 then upper(p_name)
      when l_linenumber = 3 then null else p_name end as description,
 {PAYER} as payer_name, {PLAN} as plan_name,
 case l_linenumber when 1 then 'negotiated_dollar' when 2 then ' Negotiated_Percentage '
  when 3 then 'gross_charge' when 4 then 'discounted_cash_price' when 5 then ''
  when 6 then 'bundled_rate' else null end as rate_type,
 case when l_linenumber = 2 then (case when l_quantity = 50 then 0.0e0 else l_quantity end)
  else l_extendedprice end as rate_amount,
 cast(null as string) as billing_class,
 case when l_returnflag = 'A' then l_extendedprice else null end as gross_charge,
 case when l_returnflag <> 'N' then p_retailprice else null end as discounted_cash,
 case when l_linestatus = 'O' then l_quantity else null end as minimum,
 case when l_linestatus = 'O' then o_totalprice else null end as maximum,
 case s_suppkey % 3 when 0 then 'json' when 1 then 'csv_tall' else 'csv_wide' end as source_system,
 {FILE_NAME} as source_file_name, cast(l_orderkey as string) as run_id, o_orderdate as ingested_at,
 concat('{{"order":', cast(l_orderkey as string), ',"line":', cast(l_linenumber as string), '}}')
   as raw_rate_json
from {LINES}
"""

CSV_REGISTRY = """
select concat(cast(100 + s_suppkey as string), '_', lower(replace(s_name, '#', '-')),
   '_standardcharges.csv') as source_file_name,
 cast(run_no as string) as run_id, registered_at as ingested_at,
 case when s_suppkey % 3 = 2 then 'WIDE' else 'TALL' end as format_hint,
 cast(10 + s_suppkey % 40 as bigint) as header_count,
 case when s_suppkey % 2 = 0 then ',' else '|' end as delimiter, 'utf-8' as encoding,
 case s_suppkey % 4
  when 0 then concat('{"hospital_name":"', cast(10 + s_suppkey % 90 as string), ' ',
                     cast(500000 + s_suppkey as string), '  St. ', s_name, '"}')
  when 1 then concat('{"Facility Name":"', s_name, ' - Main_Campus"}')
  when 2 then '{"hospital_name":" ","hospital":"General Hospital"}' else null end as preamble_kv,
 cast(s_suppkey * 10 + run_no as bigint) as rows_loaded,
 case when s_suppkey % 7 = 0 then 'failed' else 'success' end as status
from (
  select 1 as run_no, timestamp '2024-01-01 00:00:00' as registered_at, s_suppkey, s_name
  from @supplier
  union all
  select 2, timestamp '2024-02-01 00:00:00', s_suppkey, s_name from @supplier
  where s_suppkey % 5 = 0) runs
where s_suppkey % 3 <> 0
"""

JSON_REGISTRY = """
select concat(cast(100 + s_suppkey as string), '_', lower(replace(s_name, '#', '-')),
   '_standardcharges.json') as source_file_name,
 cast(run_no as string) as run_id, registered_at as ingested_at,
 cast(s_suppkey * 10 + run_no as bigint) as rows_extracted,
 cast(s_suppkey * 10 + run_no as bigint) as rows_loaded,
 case when s_suppkey % 7 = 0 then 'failed' else 'success' end as status
from (
  select 1 as run_no, timestamp '2024-01-01 00:00:00' as registered_at, s_suppkey, s_name
  from @supplier
  union all
  select 2, timestamp '2024-02-01 00:00:00', s_suppkey, s_name from @supplier
  where s_suppkey % 5 = 0) runs
where s_suppkey % 3 = 0
"""

# Landing rows of the three staging models: one JSON object per row, keyed by header names.
LANDING_JSON = f"""
select {FILE_NAME} as source_file_name, cast(l_orderkey as string) as run_id,
 o_orderdate as ingested_at, 'standard_charge_information.item' as record_path,
 {CODE} as billing_code, {CODE_TYPE} as billing_code_type, p_name as description,
 {PAYER} as payer, {PLAN} as plan, l_extendedprice as negotiated_rate,
 case when l_linenumber % 2 = 0 then 'estimated_amount' else null end as rate_type,
 l_returnflag as billing_class, cast(null as string) as payment_methodology,
 cast(null as string) as payment_unit,
 concat('{{"order":', cast(l_orderkey as string), ',"line":', cast(l_linenumber as string), '}}')
   as raw_rate
from {LINES} where s_suppkey % 3 = 0
"""

CENTS = "cast(cast(round(l_extendedprice * 100) as bigint) as string)"

LANDING_TALL = f"""
select {FILE_NAME} as source_file_name, o_orderdate as ingested_at,
 concat('{{"code":"', coalesce({CODE}, ''), '","code_type":"', coalesce({CODE_TYPE}, ''),
  '","description":"', p_name, '","payer_name":"', coalesce({PAYER}, ''),
  case when l_linenumber % 3 = 0 then '","hospital_name":" ' else '' end,
  '","plan":"', coalesce({PLAN}, ''), '","',
  case l_linenumber % 4 when 0 then 'estimated_amount' when 1 then 'negotiated_rate'
   when 2 then 'rate' else 'amount' end, '":"',
  case when l_linenumber = 7 then 'n/a' else {CENTS} end,
  '","setting":"', l_returnflag, '","gross_charge":', cast(l_partkey as string),
  ',"min":"', cast(l_suppkey as string),
  '","_meta_format_hint":"TALL","_meta_row_number":', cast(l_linenumber + 3 as string), '}}') as raw
from {LINES} where s_suppkey % 3 = 1
"""

LANDING_WIDE = f"""
select {FILE_NAME} as source_file_name, o_orderdate as ingested_at,
 concat('{{"description":"', p_name, '","',
  case when l_linenumber % 2 = 0 then 'code' else 'CPT' end, '":"', coalesce({CODE}, ''),
  '","billing_code_type":"', coalesce({CODE_TYPE}, ''),
  case when l_linenumber % 2 = 0 then concat('","negotiated_dollar":"', {CENTS}) else '' end,
  case when l_linenumber % 3 = 0 then concat('","negotiated_percentage":"',
    cast(cast(floor(l_quantity) as bigint) as string)) else '' end,
  case when l_linenumber % 5 <> 0 then concat('","estimated_amount":"', {CENTS}) else '","x":"' end,
  '","setting":"', l_returnflag, '","gross_charge":', cast(l_partkey as string),
  ',"max":"', cast(l_suppkey as string),
  '","_meta_format_hint":"WIDE","_meta_row_number":', cast(l_linenumber + 3 as string), '}}') as raw
from {LINES} where s_suppkey % 3 = 2
"""

# Lake rows as they come out of a tabular file: everything is text, amounts are dirty.
DIRTY_AMOUNT = """case l_linenumber % 7
  when 0 then 'n/a' when 1 then concat('$', cast(cast(floor(l_extendedprice) as bigint) as string))
  when 2 then cast(cast(floor(l_extendedprice) as bigint) as string) when 3 then ''
  when 4 then concat(' ', cast(cast(floor(l_quantity) as bigint) as string), ' ') when 5 then '-3'
  else concat('$1,', lpad(cast(cast(floor(l_quantity) as bigint) as string), 3, '0'), '.00 per day') end"""

LAKE_TABULAR = f"""
select case when l_partkey % 97 = 0 then '' else {FILE_NAME} end as source_path,
 'csv' as source_format, cast(o_orderdate as date) as ingest_day,
 case when l_partkey % 5 = 0 then {CODE} else '' end as billing_code,
 case when l_partkey % 5 <> 0 then {CODE} else null end as code, p_name as description,
 {DIRTY_AMOUNT} as negotiated_rate,
 case when l_returnflag = 'A' then cast(cast(floor(l_extendedprice) as bigint) as string) else '' end
   as gross_charge,
 case when l_returnflag = 'R' then cast(cast(floor(l_quantity) as bigint) as string) else null end
   as discounted_cash_price,
 case when c_custkey % 2 = 0 then {PAYER} else null end as payer_name,
 case when c_custkey % 2 = 1 then {PAYER} else '' end as payer, {PLAN} as plan_name
from {LINES}
"""

# Lake rows that hold one JSON document each: nested, flat or of an unsupported shape.
LAKE_PAYLOAD = f"""
select {FILE_NAME} as source_path, 'json' as source_format, cast(o_orderdate as date) as ingest_day,
 case l_linenumber % 7
 when 0 then concat('{{"rates":[', cast(l_orderkey as string), ']}}')
 when 1 then concat('{{"STANDARDCHARGES":[{{"code":"', coalesce({CODE}, ''), '","description":"',
   p_name, '","payer":"', coalesce({PAYER}, ''), '","negotiated_rate":"$',
   cast(cast(floor(l_extendedprice) as bigint) as string), '","gross_charge":',
   cast(l_partkey as string), ',"cash_discount":"n/a"}}]}}')
 when 2 then concat('{{"standard_charge_information":[{{"code_information":[],"description":"',
   p_name, '","standard_charges":[{{"minimum":5}}]}}]}}')
 when 3 then concat('{{"standard_charge_information":[{{"code_information":[{{"code":"',
   coalesce({CODE}, ''), '"}}],"description":"', p_name, '","standard_charges":[]}}]}}')
 else concat('{{"standardCharges":[{{"code_information":[{{"code":"', coalesce({CODE}, ''),
   '","type":"', coalesce({CODE_TYPE}, ''), '"}}],"description":"', p_name,
   '","standard_charges":[{{"setting":"', l_returnflag, '","payers_information":[{{"payer_name":"',
   coalesce({PAYER}, ''), '","plan_name":"', coalesce({PLAN}, ''), '","standard_charge_dollar":"',
   case when l_linenumber = 4 then '' else cast(cast(floor(l_extendedprice) as bigint) as string) end,
   '","negotiated_rate":', cast(l_suppkey as string), ',"estimated_amount":',
   cast(l_partkey as string), '}},{{"payer_name":"Self","negotiated_rate":"-',
   cast(l_linenumber as string), '"}}],"gross_charge":"', cast(l_partkey as string),
   '","minimum":"-"}},{{"maximum":', cast(cast(floor(l_quantity) as bigint) as string),
   '}}]}},{{"code":"', coalesce({CODE}, ''), '","negotiated_rate":1}}]}}') end as payload_json
from {LINES}
"""

SOURCES = {
    "charges": CHARGES,
    "csv_registry": CSV_REGISTRY,
    "json_registry": JSON_REGISTRY,
    "landing_json": LANDING_JSON,
    "landing_tall": LANDING_TALL,
    "landing_wide": LANDING_WIDE,
    "lake_tabular": LAKE_TABULAR,
    "lake_payload": LAKE_PAYLOAD,
}


# Tables large enough to be worth spreading over the cores, by their key.
SPREAD_BY = {
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
    "documents": ("doc_id",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", *SPREAD_BY.get(name, ()))


def _on(name: str, locate, tasks: int | None = None) -> str:
    """The SQL of a source; with ``tasks`` as Spark runs it, braces escaped."""
    sql = SOURCES[name]
    if tasks:
        lines = LINES_SPREAD.format(tasks=tasks) if name in COSTLY else LINES_ORDERED
        sql = sql.replace(LINES, lines).replace("{", "{{").replace("}", "}}")
    return re.sub(r"@(\w+)", lambda match: locate(match[1]), sql)


def source_sql(name: str) -> str:
    """The projection over plain table names, valid in Spark and in ANSI engines."""
    return _on(name, lambda table_name: table_name)


def shared_lines(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The joined lines that several costly sources are made from, joined, spread and written once."""
    tables = dict.fromkeys(re.findall(r"@(\w+)", LINES))
    frames = {f"ratelens_{t}": table(spark, sf_dir, t) for t in tables}
    columns = sorted(set(re.findall(r"\b[clops]_[a-z]+\b", "".join(SOURCES[name].replace(LINES, "") for name in names))))
    lines = re.sub(r"@(\w+)", r"{ratelens_\1}", LINES_SPREAD.format(tasks=_tasks(spark)))
    lines = lines.replace("*/ * from", f"*/ {', '.join(columns)} from")
    return written(spark.sql(f"select * from {lines}", **frames))


def _tasks(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def source(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """One derived input over the Parquet tables of a folder, or over their joined ``lines``."""
    if lines is not None:
        text = SOURCES[name].replace(LINES, "@lines").replace("{", "{{").replace("}", "}}").replace("@lines", "{lines}")
        return spark.sql(text, lines=lines)
    used = dict.fromkeys(re.findall(r"@(\w+)", SOURCES[name]))
    frames = {f"ratelens_{t}": table(spark, sf_dir, t) for t in used}
    text = _on(name, lambda t: "{ratelens_" + t + "}", _tasks(spark))
    return spark.sql(text, **frames)


def bronze(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """Lake rows with the load date as the partition column."""
    system = {"lake_tabular": "csv_tall", "lake_payload": "json"}[name]
    return source(spark, sf_dir, name, lines).select(
        "*",
        F.col("ingest_day").cast("string").alias("ingest_date"),
        F.lit(system).alias("_source_system"),
    )


def bronze_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tabular and JSON lake rows together, by column name."""
    lines = shared_lines(spark, sf_dir, *COSTLY)
    return bronze(spark, sf_dir, "lake_tabular", lines).unionByName(
        bronze(spark, sf_dir, "lake_payload", lines), allowMissingColumns=True
    )


CSV_HEAD = (
    "hospital_name,state,license,last_updated,version",
    "Fixture,NY,17,2024-01-01,2.0",
    'billing_code,"description",payer_name,gross_charge,negotiated_rate',
)


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical lines of one CSV file per supplier, as the line scan gives them, blocks included.

    Every line item is a record of two lines, with doubled quotes and a line break in its description and a
    stray quote in its payer; blocks also end within records. Written like the files they stand for, which are
    read several times.
    """
    # Keys repeat in this table: all that a record shows tells records apart.
    in_file = Window.partitionBy("l_suppkey").orderBy(
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_extendedprice", "l_quantity"
    )
    items = table(spark, sf_dir, "lineitem").withColumn("place", F.row_number().over(in_file).cast("long") * 2)
    first = """concat(l_partkey, ',"ship ""', l_linestatus, '""')"""
    second = """concat('part, ', l_suppkey, '",', l_linenumber, '" line,', cast(l_extendedprice as bigint), ',', cast(l_quantity as bigint))"""
    parts = F.expr(f"array(struct(place as place, {first} as bytes), struct(place + 1 as place, {second} as bytes))")
    path = F.concat(F.lit("drop/"), "l_suppkey", F.lit(".csv")).alias("source_path")
    data = items.select(path, F.explode(parts).alias("line")).select(
        "source_path", F.expr("(line.place + 1) div 512 + 1").alias("block"), "line.place", "line.bytes"
    )
    head = table(spark, sf_dir, "lineitem").select(path).distinct().select(
        "source_path", F.lit(0).cast("long").alias("block"), F.posexplode(F.array(*map(F.lit, CSV_HEAD))).alias("place", "bytes")
    )
    both = data.unionByName(head.withColumn("place", F.col("place").cast("long")))
    order = Window.partitionBy("source_path", "block").orderBy("place")
    position = (F.col("block") * 100_000 + F.row_number().over(order)).alias("position")
    return written(both.select("source_path", "block", position, "bytes"))


JSON_HEAD = '{"hospital_name":"H } x","locations":[{"no":[1]}],"standard_charge_information":['
JSON_TAIL = '],"notes":[{"q":1}]}'
SERVICE = (
    """concat('{"description":"part } \\\\"', l_partkey, '\\\\" [","code_information":[{"code":"', l_partkey, '","type":"CPT"}],'"""
    """, '"standard_charges":[{"setting":"', l_linestatus, '","gross_charge":', cast(l_extendedprice as bigint), ',"payers_information":'"""
    """, '[{"payer_name":"', l_returnflag, '","plan_name":"', l_linenumber, '","estimated_amount":', cast(l_quantity as bigint), '}]}]}')"""
)


def json_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per supplier as the scan at closing braces gives it; every line item is a service.

    Braces and brackets stand in its texts as well, and blocks end within services.
    """
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_extendedprice", "l_quantity", "l_returnflag"]
    in_file = Window.partitionBy("l_suppkey")
    items = table(spark, sf_dir, "lineitem").withColumns(
        {"place": F.row_number().over(in_file.orderBy(*order)).cast("long"), "n": F.count("*").over(in_file)}
    )
    text = F.concat(
        F.when(F.col("place") == 1, F.lit(JSON_HEAD)).otherwise(F.lit(",")), F.expr(SERVICE),
        F.when(F.col("place") == F.col("n"), F.lit(JSON_TAIL)).otherwise(F.lit("")),
    )
    # The brace that ends a text is what parts it from the next one.
    pieces = F.split(text, "\\}")
    parts = items.select("l_suppkey", "place", F.posexplode(F.slice(pieces, F.lit(1), F.size(pieces) - 1)).alias("at", "bytes"))
    kept = parts.withColumn("file_size_bytes", F.sum(F.octet_length("bytes") + 1).over(in_file))
    path = F.concat(F.lit("drop/"), "l_suppkey", F.lit(".json")).alias("source_path")
    cut = kept.select(path, F.expr("(place * 100 + at) div 4003").alias("block"), "place", "at", "bytes", "file_size_bytes")
    order = Window.partitionBy("source_path", "block").orderBy("place", "at")
    position = F.col("block") * 100_000 + F.row_number().over(order)
    return cut.select("source_path", "block", position.alias("position"), "bytes", "file_size_bytes")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of numbered lines."""
    texts = table(spark, sf_dir, "documents").filter("text is not null")
    return texts.select(
        F.concat(F.lit("doc_"), "doc_id").alias("source_path"), (F.octet_length("text") + 1).alias("file_size_bytes"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "bytes"),
    )
