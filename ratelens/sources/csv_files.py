"""CSV charge files: header detection, tall and wide landing rows, canonical Bronze rows.

Everything that differs from file to file (encoding, delimiter, header, column positions) is one
row of a profile table; rows are parsed by a join with it, so there is no loop over files.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions import blank_to_null
from ratelens.sources.csv_records import records
from ratelens.sources.files import base_name, decoded, encodings, first_lines

# Header detection.
SNIFF_LINES = 15
HEADER_CANDIDATES = 5
CODE_WORDS = ("billing_code", "code", "cpt", "hcpcs", "revenue", "ndc", "msdrg", "drg")
RATE_WORDS = (
    "negotiated", "gross", "cash", "min", "max", "standard_charge", "rate", "charge", "price",
)
DELIMITERS = (",", "|", "\t", ";")
MIN_PREAMBLE_COLUMNS = 5
MAX_HEADER_COLUMNS = 200
WIDE_COLUMNS = 38
# Headers of each canonical column, best first.
CANONICAL_HEADERS = {
    "billing_code": ("billing_code", "code|1", "code"),
    "description": ("description",),
    "gross_charge": ("gross_charge", "standard_charge|gross"),
    "discounted_cash_price": ("discounted_cash_price", "standard_charge|discounted_cash"),
    "negotiated_rate": ("negotiated_rate", "standard_charge|negotiated_dollar"),
    "payer_name": ("payer_name",),
    "plan_name": ("plan_name",),
}
CANONICAL = tuple(CANONICAL_HEADERS)
RATE_COLUMNS = ("gross_charge", "discounted_cash_price", "negotiated_rate")


def _unquoted(field: Column) -> Column:
    bare = F.trim(field)
    inner = F.regexp_extract(bare, r'^"(.*)"$', 1)
    quoted = bare.startswith('"') & bare.endswith('"') & (F.length(bare) > 1)
    return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)


def header_fields(line, delimiter: str) -> Column:
    """Fields of one header or preamble line; delimiters inside quotes do not count."""
    mark = f"\\{delimiter}" if delimiter in "|;," else delimiter
    outside = mark + r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    return F.transform(F.split(line, outside), _unquoted)


def _by_delimiter(line, delimiter: Column, parse) -> Column:
    choice = F.when(delimiter == DELIMITERS[0], parse(line, DELIMITERS[0]))
    for mark in DELIMITERS[1:]:
        choice = choice.when(delimiter == mark, parse(line, mark))
    return choice


def _widest(line: Column) -> Column:
    """The delimiter that gives a line most fields; the earlier one wins a tie."""
    counts = F.array(
        *[
            F.struct(
                F.size(header_fields(line, mark)).alias("n"), F.lit(-i).alias("i"),
                F.lit(mark).alias("mark"),
            )
            for i, mark in enumerate(DELIMITERS)
        ]
    )
    return F.array_max(counts)["mark"]


def header_score(fields: Column) -> Column:
    """Two points per field naming a code and two per field naming a rate."""

    def points(field: Column) -> Column:
        low = F.lower(field)

        def names(words):
            return reduce(Column.__or__, [low.contains(w) for w in words])

        return F.when(names(CODE_WORDS), 2).otherwise(0) + F.when(names(RATE_WORDS), 2).otherwise(0)

    return F.aggregate(fields, F.lit(0), lambda total, field: total + points(field))


def sniffed(raw: DataFrame) -> DataFrame:
    """Per file: encoding, and its first lines as an array of text."""
    head = first_lines(raw, SNIFF_LINES).select("source_path", "line_no", "bytes")
    in_order = F.transform(
        F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]
    )
    return (
        head.join(encodings(raw), "source_path")
        .withColumn("text", decoded())
        .groupBy("source_path", "encoding")
        .agg(in_order.alias("head"))
    )


def header_report(raw: DataFrame) -> DataFrame:
    """Detected header row of every comma-separated file and whether it looks like a charge table."""
    scored = (
        sniffed(raw)
        .select("source_path", "encoding", F.posexplode("head"))
        .filter(F.col("pos") < HEADER_CANDIDATES)
        .withColumn("fields", F.transform(header_fields("col", ","), F.trim))
        .withColumn("score", header_score(F.col("fields")))
    )
    first = F.min_by(F.struct("pos", "score", "fields"), "pos")
    best = F.max_by(F.struct("pos", "score", "fields"), F.struct("score", -F.col("pos")))
    chosen = (
        scored.groupBy("source_path", "encoding")
        .agg(first.alias("first"), best.alias("best"))
        .withColumn(
            "pick", F.when(F.col("best.score") >= 2, F.col("best")).otherwise(F.col("first"))
        )
    )
    norm = F.transform("pick.fields", lambda c: F.replace(F.lower(c), F.lit(" "), F.lit("_")))

    def named(words) -> Column:
        return F.exists(norm, lambda c: reduce(Column.__or__, [c.contains(w) for w in words]))

    has_code = named(CODE_WORDS + ("billing",))
    has_rate = named(RATE_WORDS)
    return chosen.select(
        "source_path", "encoding",
        F.col("pick.pos").alias("header_row"),
        F.col("pick.score").alias("header_score"),
        F.col("pick.fields").alias("columns"),
        has_code.alias("has_code_col"),
        has_rate.alias("has_rate_col"),
        (has_code & has_rate).alias("looks_like_charge_table"),
    )


def canonical_positions(columns: Column) -> Column:
    """Position of each canonical column among the headers, 0 where there is none."""
    norm = F.transform(
        columns, lambda c: F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))
    )

    def position(name: str) -> Column:
        found = [
            F.when(F.array_position(norm, header) > 0, F.array_position(norm, header))
            for header in CANONICAL_HEADERS[name]
        ]
        if name == "negotiated_rate":
            like = F.filter(norm, lambda c: c.contains("negotiated") & c.contains("dollar"))
            found.append(
                F.when(F.size(like) > 0, F.array_position(norm, F.get(like, F.lit(0))))
            )
        return F.coalesce(*found, F.lit(0)).cast("int").alias(name)

    return F.struct(*[position(name) for name in CANONICAL])


def bronze_profile(raw: DataFrame) -> DataFrame:
    """What is needed to read each file's charge rows."""
    report = header_report(raw)
    return report.select(
        "source_path", "encoding", "header_row",
        F.size("columns").alias("header_count"),
        canonical_positions(F.col("columns")).alias("at"),
    )


def _row_fields(text: Column, delimiter: str, width: int) -> Column:
    """Fields of a data line as an array of ``width`` texts."""
    names = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{n} string" for n in names)
    options = {"sep": delimiter, "mode": "PERMISSIVE", "quote": '"', "escape": '"'}
    row = F.from_csv(text, F.lit(schema), options)
    return F.array(*[row[n] for n in names])


def widest_header(profile: DataFrame) -> int:
    """Most header columns of any file; one number."""
    return profile.agg(F.max("header_count")).first()[0] or 1


def canonical_rows(raw: DataFrame, profile: DataFrame) -> DataFrame:
    """Data rows of every file under canonical names; records with too many fields are skipped."""
    width = widest_header(profile) + 1
    marks = profile.withColumn("delimiter", F.lit(","))
    numbered = records(raw, marks, ",").join(profile, "source_path")
    data = numbered.filter(F.col("line_no") > F.col("header_row")).withColumn("text", decoded())
    data = data.filter(F.trim("text") != "").withColumn(
        "fields", _row_fields(F.col("text"), ",", width)
    )
    extra = F.exists(
        F.slice("fields", F.col("header_count") + 1, F.lit(width)), lambda c: c.isNotNull()
    )

    def field(name: str) -> Column:
        at = F.col(f"at.{name}")
        return F.when(at > 0, F.get("fields", at - 1)).alias(name)

    return data.filter(~extra).select("source_path", *[field(name) for name in CANONICAL])


def charge_rows(rows: DataFrame) -> DataFrame:
    """Rows with a code and at least one of the gross, cash and negotiated amounts."""
    has_rate = reduce(Column.__or__, [blank_to_null(c).isNotNull() for c in RATE_COLUMNS])
    return rows.filter(blank_to_null("billing_code").isNotNull() & has_rate)


def bronze_rows(raw: DataFrame, profile: DataFrame) -> DataFrame:
    """Charge rows; a file without any gives one blank row, so that it shows up downstream."""
    kept = charge_rows(canonical_rows(raw, profile))
    empty = profile.select("source_path").join(
        kept.select("source_path").distinct(), "source_path", "left_anti"
    )
    blank = empty.select("source_path", *[F.lit("").alias(c) for c in CANONICAL])
    return kept.unionByName(blank)


def landing_profile(raw: DataFrame) -> DataFrame:
    """Per file with a two-row preamble: delimiter, preamble, headers and tall or wide.

    A delimiter is guessed from the header line and replaced by the preamble's when the preamble
    comes out too narrow or the header implausible.
    """
    def line(i: int) -> Column:
        return F.coalesce(F.get("head", F.lit(i)), F.lit(""))

    guess = _widest(F.when(F.size("head") > 2, line(2)).otherwise(line(0)))
    by_preamble = _widest(line(0))

    def width(i: int, mark: Column) -> Column:
        return F.size(_by_delimiter(line(i), mark, header_fields))

    first = F.when(
        (width(0, F.col("_guess")) < MIN_PREAMBLE_COLUMNS)
        | (width(1, F.col("_guess")) < MIN_PREAMBLE_COLUMNS),
        F.col("_preamble"),
    ).otherwise(F.col("_guess"))
    implausible = ~width(2, F.col("_first")).between(2, MAX_HEADER_COLUMNS)
    read = (
        sniffed(raw)
        .withColumns({"_guess": guess, "_preamble": by_preamble})
        .withColumn("_first", first)
        .withColumn(
            "delimiter", F.when(implausible, F.col("_preamble")).otherwise(F.col("_first"))
        )
        .withColumns(
            {
                name: _by_delimiter(line(i), F.col("delimiter"), header_fields)
                for i, name in enumerate(("row1", "row2", "headers"))
            }
        )
    )
    count = F.size("headers")
    return read.select(
        "source_path", "encoding", "delimiter", "row1", "row2", "headers",
        count.alias("header_count"),
        F.when(count >= WIDE_COLUMNS, "WIDE").otherwise("TALL").alias("format_hint"),
        preamble_map(F.col("row1"), F.col("row2")).alias("preamble_kv"),
    )


def preamble_map(row1: Column, row2: Column) -> Column:
    """Labels of row 1 with the values of row 2, else alternating labels and values in row 1."""
    below = F.zip_with(row1, row2, lambda k, v: F.struct(F.trim(k).alias("key"), v.alias("value")))
    below = F.slice(below, F.lit(1), F.size(row1))
    pairs = F.floor(F.size(row1) / 2).cast("int")
    beside = F.when(
        pairs > 0,
        F.transform(
            F.sequence(F.lit(0), pairs - 1),
            lambda i: F.struct(
                F.trim(F.get(row1, i * 2)).alias("key"), F.get(row1, i * 2 + 1).alias("value")
            ),
        ),
    ).otherwise(F.slice(below, F.lit(1), F.lit(0)))
    entries = F.when(F.size(row2) >= F.size(row1), below).otherwise(beside)
    return F.map_from_entries(
        F.filter(entries, lambda e: e["key"].isNotNull() & (e["key"] != ""))
    )


def landing_rows(raw: DataFrame, profile: DataFrame) -> DataFrame:
    """One JSON object per data row, keyed by the headers, with the row's place in the file."""
    width = widest_header(profile)
    numbered = records(raw, profile, DELIMITERS).join(profile, "source_path")
    data = numbered.filter("line_no > 2").withColumn("text", decoded())
    fields = _by_delimiter(
        F.col("text"), F.col("delimiter"), lambda text, mark: _row_fields(text, mark, width)
    )
    pairs = F.map_from_entries(
        F.filter(
            F.arrays_zip(F.col("headers").alias("key"), F.col("fields").alias("value")),
            lambda e: e["key"].isNotNull() & e["value"].isNotNull(),
        )
    )
    cells = F.regexp_replace(F.to_json(pairs), r"\}$", "")
    meta = F.format_string(
        '%s"_meta_format_hint":"%s","_meta_row_number":%d,"_meta_header_column_count":%d}',
        F.when(cells == "{", cells).otherwise(F.concat(cells, F.lit(","))),
        F.col("format_hint"), F.col("line_no") + 1, F.col("header_count"),
    )
    return data.withColumn("fields", fields).select(
        base_name("source_path").alias("source_file_name"), "format_hint", meta.alias("raw")
    )


def registry_rows(
    profile: DataFrame, loaded: DataFrame, run_id: str, ingested_at: Column
) -> DataFrame:
    """Registry row per CSV file with the rows it brought."""
    counts = loaded.groupBy("source_file_name").agg(F.count("*").alias("rows_loaded"))
    named = profile.withColumn("source_file_name", base_name("source_path"))
    rows = F.coalesce("rows_loaded", F.lit(0))
    problem = F.when(rows == 0, "no rows loaded")
    return named.join(counts, "source_file_name", "left").select(
        "source_file_name",
        F.lit(run_id).alias("run_id"),
        ingested_at.alias("ingested_at"),
        "format_hint",
        F.col("header_count").cast("long").alias("header_count"),
        "delimiter", "encoding",
        F.to_json("row1").alias("row1_raw"),
        F.to_json("row2").alias("row2_raw"),
        F.to_json("preamble_kv").alias("preamble_kv"),
        rows.alias("rows_loaded"),
        F.when(problem.isNull(), "success").otherwise("failed").alias("status"),
        problem.alias("error_message"),
    )
