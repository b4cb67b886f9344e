"""JSON and NDJSON charge files: records, extraction of rates and structure profiles."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions import blank_to_null
from ratelens.functions.jsonx import as_text, first_text, items, members
from ratelens.operators.rows import one_row
from ratelens.schemas import EXTRACTED_RATE
from ratelens.sources.files import BOM, decoded

# Keys under which a generic record carries each field, best first.
RECORD_KEYS = {
    "billing_code": ("billing_code", "code", "billingCode", "service_code"),
    "billing_code_type": ("billing_code_type", "code_type", "type", "billingCodeType"),
    "description": ("description", "desc", "name", "billing_code_description"),
    "payer": ("payer", "payer_name", "payerName"),
    "plan": ("plan", "plan_name", "planName"),
    "negotiated_rate": ("negotiated_rate", "rate", "negotiatedRate", "price", "billed_charge"),
    "rate_type": ("rate_type", "rateType", "type"),
    "billing_class": ("billing_class", "billingClass", "billing_classification"),
    "payment_methodology": ("payment_methodology", "paymentMethodology"),
    "payment_unit": ("payment_unit", "paymentUnit", "unit"),
}
SERVICE_PATH = "standard_charge_information.item"
LINE_PATH = "ndjson_line"


def json_start(text) -> Column:
    """1-based place of the first bracket after any byte-order mark or junk; 0 when there is none."""
    return F.regexp_instr(text, F.lit(r"[\{\[]"))


def from_start(text: str) -> Column:
    return F.substring(F.col(text), json_start(text), F.length(text))


def lenient_objects(lines: DataFrame, column: str = "line") -> DataFrame:
    """Lines that hold one JSON object each; blank, broken and other lines are passed over."""
    trimmed = F.trim(column)
    parsed = lines.withColumn(column, trimmed).filter(trimmed.startswith("{"))
    return parsed.withColumn("record", F.try_parse_json(column)).filter("record is not null")


def line_shapes(raw: DataFrame) -> DataFrame:
    """Per file whether it is NDJSON: two or more lines, and every line that is not blank an object."""
    line = F.trim(F.ltrim(F.col("bytes"), F.lit(BOM)))
    is_object = line.startswith("{") & F.try_parse_json(line).isNotNull()
    counted = raw.groupBy("source_path").agg(
        F.count_if(line != "").alias("lines"), F.count_if(is_object).alias("objects")
    )
    return counted.withColumn(
        "is_ndjson", (F.col("lines") >= 2) & (F.col("lines") == F.col("objects"))
    )


def ndjson_records(raw: DataFrame, shapes: DataFrame) -> DataFrame:
    """Records of the NDJSON files, read line by line so that large files split."""
    chosen = shapes.filter("is_ndjson").select("source_path")
    texts = raw.join(chosen, "source_path", "left_semi").select(
        "source_path", F.trim(F.ltrim(F.col("bytes"), F.lit(BOM))).alias("record_json")
    )
    return texts.filter("record_json <> ''")


def documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Whole JSON documents, one row per file, as text."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.select(F.lit("").alias("source_path"), F.col("value").alias("document"))
    whole = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("bytes")
    )
    with_encoding = whole.withColumn(
        "encoding", F.when(F.is_valid_utf8("bytes"), "utf-8").otherwise("latin-1")
    )
    return with_encoding.select("source_path", F.trim(decoded()).alias("document"))


def document_records(docs: DataFrame) -> DataFrame:
    """Records of whole documents.

    An array of objects gives one record per object; an object, a scalar, an empty or
    mixed array stays one payload.  A document that does not parse gives an error instead.
    """
    parsed = docs.withColumn("v", F.try_parse_json("document"))
    elements = items("v")
    all_objects = F.forall(
        elements, lambda e: F.schema_of_variant(e).startswith("OBJECT")
    )
    tabular = (F.size(elements) > 0) & all_objects
    split = parsed.withColumn("_split", F.coalesce(tabular, F.lit(False)))
    records = split.filter("_split").select(
        "source_path", F.explode(items("v")).alias("_record")
    )
    missing = F.lit(None).cast("string")
    rows = records.select(
        "source_path", F.to_json("_record").alias("record_json"),
        missing.alias("payload_json"), missing.alias("error_message"),
    )
    broken = F.col("v").isNull()
    problem = F.when(F.col("document") == "", "empty JSON file").when(broken, "invalid JSON")
    whole = split.filter(~F.col("_split")).select(
        "source_path", missing.alias("record_json"),
        F.to_json("v").alias("payload_json"), problem.alias("error_message"),
    )
    return rows.unionByName(whole)


def _ddl(found: str) -> str:
    """A variant schema as a type; key names, quoted or before a colon, stay as they are."""
    words = {"OBJECT": "STRUCT", "VOID": "STRING"}
    return re.sub(r"`(?:[^`]|``)*`|\b(?:OBJECT|VOID)\b(?!:)", lambda m: words.get(m[0], m[0]), found)


def _numbered(kind: T.DataType) -> T.DataType:
    """The type with the fields of its structs named by place, so that no two names are alike."""
    if not isinstance(kind, T.StructType):
        return kind
    return T.StructType(
        [T.StructField(f"f{i}", _numbered(f.dataType)) for i, f in enumerate(kind.fields)]
    )


def _leaves(kind: T.StructType, row: Column, prefix: str = "") -> list[tuple[str, Column]]:
    """Dotted name and text of every leaf of a struct whose fields are named by place."""
    leaves: list[tuple[str, Column]] = []
    for i, field in enumerate(kind.fields):
        child = row.getField(f"f{i}")
        if isinstance(field.dataType, T.StructType):
            leaves += _leaves(field.dataType, child, f"{prefix}{field.name}.")
        else:
            leaves.append((f"{prefix}{field.name}", child.cast("string")))
    return leaves


def flattened(records: DataFrame, column: str = "record_json") -> DataFrame:
    """Records as text columns, nested objects under dotted names; the schema is their union.

    Keys that differ in case only give one column, the first spelling in the schema winning.
    """
    parsed = records.withColumn("_v", F.try_parse_json(column))
    found = parsed.agg(F.schema_of_variant_agg("_v").alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return records.drop(column)
    kept = [c for c in records.columns if c != column]
    shaped = parsed.select(*kept, F.try_variant_get("_v", "$", _ddl(found)).alias("_row"))
    kind = shaped.schema["_row"].dataType
    columns: dict[str, tuple[str, list[Column]]] = {}
    for name, leaf in _leaves(kind, F.col("_row").cast(_numbered(kind))):
        columns.setdefault(name.lower(), (name, []))[1].append(leaf)
    return shaped.select(*kept, *[F.coalesce(*c).alias(name) for name, c in columns.values()])


def extract_records(records: DataFrame, record_path: str, record: str = "record") -> DataFrame:
    """Generic objects as extracted rates: each field from the first of its keys that is present."""
    keys = sorted({k for names in RECORD_KEYS.values() for k in names})
    shaped = records.withColumn("_r", members(record, *keys))

    def field(name: str) -> Column:
        text = first_text([F.col("_r")[k] for k in RECORD_KEYS[name]])
        return (text.try_cast("decimal(38,9)") if name == "negotiated_rate" else text).alias(name)

    return shaped.select(
        "source_file_name", "run_id", "ingested_at", F.lit(record_path).alias("record_path"),
        *[field(name) for name in RECORD_KEYS], F.to_json(record).alias("raw_rate"),
    ).select(*EXTRACTED_RATE.fieldNames())


def _plain(value: Column) -> Column:
    return blank_to_null(as_text(value))


def _number(value: Column) -> Column:
    return as_text(value).try_cast("double")


def extract_services(services: DataFrame, service: str = "service") -> DataFrame:
    """One extracted rate per service, standard charge and payer, with a compact raw form."""
    item = services.withColumn(
        "_s", members(service, "description", "code_information", "standard_charges")
    ).select(
        "source_file_name", "run_id", "ingested_at",
        _plain(F.col("_s.description")).alias("description"),
        members(
            F.try_variant_get("_s.code_information", "$[0]", "variant"), "code", "type"
        ).alias("_code"),
        F.explode(items("_s.standard_charges")).alias("_c"),
    )
    charge = item.withColumn(
        "_c",
        members(
            "_c", "setting", "gross_charge", "discounted_cash", "minimum", "maximum",
            "payers_information",
        ),
    ).select(
        "source_file_name", "run_id", "ingested_at", "description",
        _plain(F.col("_code.code")).alias("billing_code"),
        _plain(F.col("_code.type")).alias("billing_code_type"),
        _plain(F.col("_c.setting")).alias("billing_class"),
        *[
            _number(F.col(f"_c.{c}")).alias(c)
            for c in ("gross_charge", "discounted_cash", "minimum", "maximum")
        ],
        F.explode(items("_c.payers_information")).alias("_p"),
    )
    payer = charge.withColumn(
        "_p", members("_p", "payer_name", "plan_name", "methodology", "estimated_amount")
    ).filter("_p is not null")
    rows = payer.withColumns(
        {
            "payer": _plain(F.col("_p.payer_name")),
            "plan": _plain(F.col("_p.plan_name")),
            "payment_methodology": _plain(F.col("_p.methodology")),
            "estimated_amount": _number(F.col("_p.estimated_amount")),
        }
    )
    raw = F.struct(
        F.struct("description", "billing_code", "billing_code_type").alias("service"),
        F.struct(
            F.col("billing_class").alias("setting"),
            "gross_charge", "discounted_cash", "minimum", "maximum",
        ).alias("standard_charge"),
        F.struct(
            F.col("payer").alias("payer_name"), F.col("plan").alias("plan_name"),
            F.col("payment_methodology").alias("methodology"), "estimated_amount",
        ).alias("payer"),
    )
    return rows.withColumns(
        {
            "record_path": F.lit(SERVICE_PATH),
            "negotiated_rate": F.col("estimated_amount").cast("decimal(38,9)"),
            "rate_type": F.lit("estimated_amount"),
            "payment_unit": F.lit(None).cast("string"),
            "raw_rate": F.to_json(raw, {"ignoreNullFields": "false"}),
        }
    ).select(*EXTRACTED_RATE.fieldNames())


# Rows of one key that a task makes from one array.
COPIES = 1 << 16


def capped(rows: DataFrame, max_records: int = 0, key: Column | None = None) -> DataFrame:
    """At most ``max_records`` rows; 0 means all. The same rows each time, however they are partitioned.

    The first rows by ``key`` stay: a hexadecimal hash that only equal rows share, by default of the whole row. Rows
    are counted by the first five digits (2^20 counts at most meet in one task); whole classes stay without a
    shuffle, and only the class the cap falls into is ordered, one row per key, so repeated rows are no burden.
    """
    if max_records <= 0:
        return rows
    columns = rows.columns
    whole = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    keyed = rows.withColumn("_key", whole if key is None else key).withColumn("_class", F.substring("_key", 1, 5))
    counts = keyed.groupBy("_class").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_class")) - F.col("_n")
    room = counts.withColumn("_room", max_records - before).filter("_room > 0")
    inside = keyed.join(room.filter("_n <= _room").select("_class"), "_class", "left_semi")
    edge = keyed.join(room.filter("_n > _room").select("_class", "_room"), "_class")
    by_key = edge.groupBy("_key", "_room").agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*columns)).alias("_row")
    )
    copies = F.least("_n", F.col("_room") - F.sum("_n").over(Window.orderBy("_key")) + F.col("_n"))
    blocks = by_key.withColumn("_copies", copies).filter("_copies > 0").select(
        "_row", "_copies", F.explode(F.expr(f"sequence(0, (_copies - 1) div {COPIES})")).alias("_block")
    )
    size = F.least(F.lit(COPIES), F.col("_copies") - F.col("_block") * COPIES).cast("int")
    kept = blocks.select("_row", F.explode(F.sequence(F.lit(1), size))).select("_row.*")
    return inside.select(*columns).unionByName(kept)


def structure_profile(docs: DataFrame, top: int | None = None) -> DataFrame:
    """Paths that hold arrays of objects, how many objects each holds and their keys.

    Each level of nesting is one explode over the level above, until one is empty; ``top`` keeps
    the largest paths only.
    """
    spark = docs.sparkSession
    level = docs.select(F.lit("").alias("path"), F.try_parse_json("document").alias("v"))
    levels = []
    while not levels or not level.isEmpty():
        level = spark.sql(
            "select p.path as parent, c.key, c.value as v from {p} p,"
            " lateral variant_explode(p.v) c",
            p=level,
        ).select(
            F.concat_ws(
                ".",
                F.when(F.col("parent") != "", F.col("parent")),
                F.coalesce("key", F.lit("item")),
            ).alias("path"),
            "v",
        )
        levels.append(level)
    everything = reduce(DataFrame.unionByName, levels)
    keys = F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))
    objects = everything.filter(F.col("path").rlike(r"(^|\.)item$")).select(
        "path", keys.alias("keys")
    ).filter("keys is not null")
    counts = objects.groupBy("path").agg(F.count("*").alias("object_count"))
    named = (
        objects.select("path", F.explode("keys").alias("key"))
        .distinct()
        .groupBy("path")
        .agg(F.array_sort(F.collect_set("key")).alias("sample_keys"))
    )
    found = counts.join(named, "path", "left").orderBy(F.desc("object_count"), "path")
    return found if top is None else found.limit(top)


def key_profile(lines: DataFrame, column: str = "line") -> DataFrame:
    """Objects among the lines and their distinct keys, sorted."""
    keyed = lenient_objects(lines, column).select(F.json_object_keys(column).alias("keys"))
    names = keyed.select(F.explode("keys").alias("key")).distinct()
    return one_row(
        keyed.agg(F.count("*").alias("json_lines")),
        names.agg(F.array_join(F.array_sort(F.collect_set("key")), ",").alias("sample_keys")),
    )


def landing_documents(docs: DataFrame, ingested_at: Column) -> DataFrame:
    """One landing row per JSON file."""
    return docs.select(
        F.regexp_replace("source_path", r"^.*[\\/]", "").alias("source_file_name"),
        ingested_at.alias("ingested_at"),
        F.col("document").alias("raw"),
    )
