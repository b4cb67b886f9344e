"""Runs over a drop of raw files: landing tables, Bronze and Silver.

Each run is a few jobs over all files at once.  What differs per file lives in a profile table that
is written and read back first, so Spark knows how small it is before it meets the rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.operators import silver
from ratelens.schemas import CSV_REGISTRY, EXTRACTED_RATE, JSON_REGISTRY, MANIFEST, RAW_ROW
from ratelens.session import configure
from ratelens.sources import commits, csv_files, files, json_elements, json_files, sinks
from ratelens.functions.jsonx import items, top_level


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _stamp(hashed: DataFrame, rows: DataFrame, ingest_date: str, kind: str) -> DataFrame:
    """Bronze metadata columns; ``file_key`` names the partition of one file's content."""
    known = hashed.select("source_path", "file_hash")
    return rows.join(known, "source_path").withColumns(
        {
            "ingest_ts": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "ingest_date": F.lit(ingest_date),
            "source_format": F.lit(kind),
            "file_key": F.substring("file_hash", 1, 16),
        }
    )


def _only(raw: DataFrame, wanted: DataFrame) -> DataFrame:
    return raw.join(wanted.select("source_path"), "source_path", "left_semi")


def _paths(df: DataFrame) -> list[str]:
    """Names of the files of a frame: one text per file, never file contents."""
    return [row[0] for row in df.select("source_path").distinct().toLocalIterator()]


def run_bronze(
    spark: SparkSession, drop: str, lake: str, ingest_date: str, force: bool = False, forced=()
) -> DataFrame:
    """Load new files of a drop into Bronze; returns ingested, skipped and failed counts."""
    configure(spark)
    work = f"{lake}/_work/bronze"
    manifest = sinks.read_or_empty(spark, f"{lake}/manifest", MANIFEST)
    hashed = _written(files.hashed_files(spark, drop), f"{work}/files")
    todo = _written(files.not_loaded(hashed, manifest, force, forced), f"{work}/todo")

    raw = _only(files.lines(spark, drop, "*.csv"), todo)
    profile = _written(csv_files.bronze_profile(raw), f"{work}/csv_profile")
    rows = _stamp(todo, csv_files.bronze_rows(raw, profile), ingest_date, "csv")
    sinks.overwrite_partitions(rows, f"{lake}/bronze/pt_csv", "ingest_date", "file_key")

    raw_json = _only(files.lines(spark, drop, "*.json"), todo)
    shapes = _written(json_files.line_shapes(raw_json), f"{work}/json_shapes")
    wanted = _only(todo.filter("source_format = 'json'"), shapes.filter("not is_ndjson"))
    texts = _only(json_elements.chunks(spark, drop), wanted)
    cut = _written(json_elements.elements(texts), f"{work}/elements")
    cuts = _written(json_elements.outcomes(cut), f"{work}/element_outcomes")
    unsplit = wanted.join(cuts.filter("not whole and not broken"), "source_path", "left_anti")
    docs = json_files.documents(spark, _paths(unsplit.filter(F.col("file_size_bytes") <= files.WHOLE_FILE)))
    too_large = unsplit.filter(F.col("file_size_bytes") > files.WHOLE_FILE).select(
        "source_path", *[F.lit(None).cast("string").alias(c) for c in ("record_json", "payload_json")],
        F.lit("no array of objects in a file too large for one value").alias("error_message"),
    )
    split = cut.join(cuts.filter("not whole and not broken"), "source_path", "left_semi").select(
        "source_path", F.to_json(F.try_parse_json("element")).alias("record_json"),
        *[F.lit(None).cast("string").alias(c) for c in ("payload_json", "error_message")],
    )
    parsed = _written(
        json_files.document_records(docs).unionByName(split).unionByName(too_large), f"{work}/documents"
    )
    lines = json_files.ndjson_records(raw_json, shapes).withColumn(
        "payload_json", F.lit(None).cast("string")
    )
    records = lines.unionByName(
        parsed.filter("error_message is null").drop("error_message")
    )
    tabular = json_files.flattened(
        records.filter("record_json is not null").drop("payload_json")
    )
    payloads = records.filter("record_json is null").drop("record_json")
    both = tabular.unionByName(payloads, allowMissingColumns=True)
    stamped = _stamp(todo, both, ingest_date, "json")
    sinks.overwrite_partitions(stamped, f"{lake}/bronze/pt_json", "ingest_date", "file_key")

    errors = parsed.filter("error_message is not null").select("source_path", "error_message")
    outcome = todo.join(errors, "source_path", "left")
    sinks.append(files.manifest_rows(outcome, ingest_date), f"{lake}/manifest")
    loaded = outcome.select(
        F.when(F.col("error_message").isNull(), "ingested").otherwise("failed").alias("outcome")
    )
    skipped = hashed.join(todo.select("source_path"), "source_path", "left_anti")
    return files.run_summary(
        loaded.unionByName(skipped.select(F.lit("skipped").alias("outcome")))
    )


def run_silver(
    spark: SparkSession, lake: str, ingest_date: str, threshold: float = 0.5
) -> DataFrame:
    """Rates of one day into Silver and quarantine; stops when too much was quarantined.

    Candidates are written once, so the two tables and the metrics read them instead of parsing
    the files again.
    """
    configure(spark)
    bronze = sinks.read_bronze(spark, lake, ingest_date)
    if bronze is None:
        raise ValueError(f"no bronze data for {ingest_date}")
    candidates = _written(silver.candidate_rates(bronze), f"{lake}/_work/silver/{ingest_date}")
    good, bad = silver.good_rates(candidates), silver.quarantined(candidates)
    sinks.overwrite_day(good, f"{lake}/silver/standard_charges", "ingest_date", ingest_date)
    sinks.overwrite_day(bad, f"{lake}/silver/quarantine", "ingest_date", ingest_date)
    metrics = silver.quality_metrics(candidates)
    silver.require_quality(metrics, threshold)
    return metrics


def _now() -> Column:
    return F.current_timestamp()


LANDING = {
    "pt_csv_raw_tall": RAW_ROW, "pt_csv_raw_wide": RAW_ROW, "pt_json_raw": RAW_ROW,
    "pt_json_extracted_rates": EXTRACTED_RATE, "pt_csv_registry": CSV_REGISTRY, "pt_json_registry": JSON_REGISTRY,
}
REGISTRIES = ("pt_csv_registry", "pt_json_registry")


def landed(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """A landing table or registry as committed runs left it, every file once."""
    return commits.read(spark, lake, table, LANDING[table], REGISTRIES)


def run_landing(
    spark: SparkSession, drop: str, lake: str, run_id: str, max_records: int = 0
) -> DataFrame:
    """Load a drop into the landing tables and registries; returns one outcome row per file.

    All tables of a run become visible together, by its commit. A run that broke off is repeated under any id and
    loads the same files again; nothing of the broken one is ever read (``landed``).
    """
    configure(spark)
    attempt = commits.new_attempt()
    work = f"{lake}/_work/landing/{attempt}"
    csv_registry = landed(spark, lake, "pt_csv_registry")
    json_registry = landed(spark, lake, "pt_json_registry")
    listed = _written(files.list_files(spark, drop), f"{work}/listed")
    done = csv_registry.select("source_file_name", "status").unionByName(
        json_registry.select("source_file_name", "status")
    )
    todo = _written(files.not_registered(listed, done), f"{work}/todo")

    raw = _only(files.lines(spark, drop, "*.csv"), todo)
    profile = _written(csv_files.landing_profile(raw), f"{work}/csv_profile")
    csv_loaded = _written(
        csv_files.landing_rows(raw, profile).withColumn("ingested_at", _now()),
        f"{work}/csv_rows",
    )
    for hint, table in (("TALL", "pt_csv_raw_tall"), ("WIDE", "pt_csv_raw_wide")):
        rows = csv_loaded.filter(F.col("format_hint") == hint)
        commits.write(rows.select(*RAW_ROW.fieldNames()), lake, table, attempt)
    csv_rows = csv_files.registry_rows(profile, csv_loaded, run_id, _now())
    commits.write(csv_rows.select(*CSV_REGISTRY.fieldNames()), lake, "pt_csv_registry", attempt)

    raw_json = _only(files.lines(spark, drop, "*.json"), todo)
    shapes = _written(json_files.line_shapes(raw_json), f"{work}/json_shapes")
    single = _only(todo, shapes.filter("not is_ndjson"))
    docs = json_files.documents(spark, _paths(single.filter(F.col("file_size_bytes") <= files.WHOLE_FILE)))
    commits.write(json_files.landing_documents(docs, _now()), lake, "pt_json_raw", attempt)
    meta = {
        "source_file_name": files.base_name("source_path"),
        "run_id": F.lit(run_id),
        "ingested_at": _now(),
    }
    texts = _only(json_elements.chunks(spark, drop), single)
    cut = _written(json_elements.elements(texts, "standard_charge_information"), f"{work}/elements")
    cuts = _written(json_elements.outcomes(cut), f"{work}/element_outcomes")
    named = cut.join(cuts.filter("not whole and not broken"), "source_path", "left_semi")
    services = named.withColumns(meta).select(*meta, F.try_parse_json("element").alias("service"))
    whole = docs.join(cuts.filter("whole"), "source_path", "left_semi").withColumns(meta).select(
        *meta,
        F.explode(
            items(top_level(json_files.from_start("document"), "standard_charge_information"))
        ).alias("service"),
    )
    services = services.unionByName(whole)
    lines = json_files.ndjson_records(raw_json, shapes).withColumns(meta)
    records = json_files.lenient_objects(lines, "record_json")
    extracted = json_files.extract_services(services).unionByName(
        json_files.extract_records(records, json_files.LINE_PATH)
    )
    extracted = _written(json_files.capped(extracted, max_records), f"{work}/extracted")
    commits.write(
        extracted.select(*EXTRACTED_RATE.fieldNames()), lake, "pt_json_extracted_rates", attempt
    )
    json_files_done = todo.filter("source_format = 'json'")
    hashes = files.hashed_files(spark, drop, "*.json").select("source_path", "file_hash")
    counts = files.load_counts(json_files_done, extracted)
    good = F.col("verified")
    json_rows = (
        json_files_done.join(counts, "source_file_name")
        .join(hashes, "source_path", "left")
        .select(
            "source_file_name",
            F.col("source_path").alias("local_path"),
            F.lit(None).cast("string").alias("gcs_uri"),
            _now().alias("ingested_at"),
            F.lit(run_id).alias("run_id"),
            F.when(good, "success").otherwise("failed").alias("status"),
            F.col("rows_loaded").alias("rows_extracted"),
            "rows_loaded", "file_size_bytes",
            F.col("file_hash").alias("file_sha256"),
            F.when(~good, "no rows extracted").alias("error_message"),
        )
    )
    commits.write(json_rows.select(*JSON_REGISTRY.fieldNames()), lake, "pt_json_registry", attempt)
    commits.commit(spark, lake, attempt, run_id)

    outcome = ["source_file_name", "status", "rows_loaded", "error_message"]
    registered = [
        spark.read.parquet(f"{lake}/{name}/attempt={attempt}").select(*outcome) for name in REGISTRIES
    ]
    unknown = todo.filter("source_format is null").select(
        "source_file_name", F.lit("failed").alias("status"),
        F.lit(0).cast("long").alias("rows_loaded"),
        F.lit("unknown file extension").alias("error_message"),
    )
    return registered[0].unionByName(registered[1]).unionByName(unknown)
