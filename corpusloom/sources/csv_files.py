"""A4: CSV files of any layouts and encodings, in one folder.

Fields are split on bytes read as latin-1, which loses none. Those of files that are UTF-8 in
every line are then decoded. So neither encodings nor layouts need lists of files on the driver:
both are columns of a table with a row per file, which meets the rows by file.

A line is a record; ``multiline=True`` lets quoted fields hold line ends, at the price of a
task per file. The head line must be the first that is not blank, in the first of the parts
(``spark.sql.files.maxPartitionBytes``) a file is cut into. Files without any line that is not blank have no layout and give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import stored
from corpusloom.sources.files import document

# Fields that stand for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")
WHOLE = r"^\s*[+-]?\d+\s*$"
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"

# Kinds of field are bits; what a column holds is the bits of its fields or-ed, in any order.
ABSENT, INTEGER, REAL, BOOLEAN, TEXT = 1, 2, 4, 8, 16

DIALECT = {"escape": '"', "quote": '"'}


def csv_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(source_path, utf8, names) of each file.

    Names are those of the first line that is not blank: nameless columns are called by their place, repeated names
    are numbered. ``utf8`` tells whether all lines are UTF-8; otherwise the file is latin-1.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    # Within a part of a file lines are numbered in their order.
    place = F.struct(F.monotonically_increasing_id().alias("n"), "value")
    opening = (F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")
    files = (
        lines.select(F.col("_metadata.file_path").alias("source_path"), "value", F.when(opening, place).alias("head"))
        .groupBy("source_path")
        .agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.min("head")["value"].alias("head"))
        .filter("head is not null")
    )
    head = F.when(F.col("utf8"), F.col("head")).otherwise(F.decode(F.col("head").cast("binary"), "ISO-8859-1"))
    unquoted = F.regexp_replace("head", '"[^"]*"', "")
    files = files.withColumn("head", head).withColumn("width", F.regexp_count(unquoted, F.lit(",")) + 1)
    files = stored(files, "layouts")
    widest = files.agg(F.max("width")).first()[0] or 1
    fields = [f"c{i}" for i in range(widest)]
    split = F.from_csv("head", ", ".join(f"{f} string" for f in fields), DIALECT)
    names = F.slice(F.array(*[split[f] for f in fields]), F.lit(1), F.col("width"))
    named = F.transform(names, lambda x, i: F.coalesce(F.nullif(x, F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))))
    files = files.select("source_path", "utf8", named.alias("names"))
    earlier = lambda x, i: F.size(F.filter(F.slice("names", F.lit(1), i), lambda y: y == x))
    numbered = lambda x, i: F.when(earlier(x, i) == 0, x).otherwise(F.concat_ws(".", x, earlier(x, i).cast("string")))
    return stored(files.withColumn("names", F.transform("names", numbered)), "layouts")


def csv_records(spark: SparkSession, path: str, layouts: DataFrame | None = None, multiline: bool = False) -> DataFrame:
    """The columns of ``layouts`` with ``values``, one per name, and ``malformed``: whether a line has fields beyond them.

    Values are as written, missing and empty ones null. Spark broadcasts the layouts if they are small.
    """
    layouts = csv_layouts(spark, path) if layouts is None else layouts
    widest = layouts.agg(F.max(F.size("names"))).first()[0] or 1
    # One column more shows lines that are too long.
    fields = [f"c{i}" for i in range(widest + 1)]
    reader = spark.read.options(header=True, encoding="ISO-8859-1", recursiveFileLookup=True, multiLine=multiline, **DIALECT)
    raw = reader.schema(", ".join(f"{f} string" for f in fields)).csv(path)
    rows = raw.select(F.col("_metadata.file_path").alias("source_path"), F.array(*fields).alias("raw"))
    rows = rows.join(layouts, "source_path")
    known = F.slice("raw", F.lit(1), F.size("names"))
    decoded = F.transform(known, lambda v: F.decode(F.encode(v, "ISO-8859-1"), "UTF-8"))
    beyond = F.slice("raw", F.size("names") + 1, F.lit(widest + 1))
    return rows.select(
        *layouts.columns,
        F.when(F.col("utf8"), decoded).otherwise(known).alias("values"),
        F.exists(beyond, lambda v: v.isNotNull()).alias("malformed"),
    )


def missing(value: Column) -> Column:
    return value.isNull() | value.isin(*MISSING)


def kind_of(value: Column) -> Column:
    """The bit of a field's kind; whole numbers beyond 64 bits count as real."""
    return (
        F.when(missing(value), ABSENT)
        .when(value.isin(*TRUTH), BOOLEAN)
        .when(value.rlike(WHOLE) & value.try_cast("bigint").isNotNull(), INTEGER)
        .when(value.rlike(NUMBER), REAL)
        .otherwise(TEXT)
    )


def dtype_of(kinds: Column) -> Column:
    """A column's type in its file by the names the report uses.

    Whole numbers among missing ones are real; truth values among anything else are objects.
    """
    numeric = kinds.bitwiseAND(F.lit(BOOLEAN | TEXT)) == 0
    return (
        F.when(kinds == INTEGER, "int64")
        .when(kinds == BOOLEAN, "bool")
        .when(numeric & (kinds > 0), "float64")
        .otherwise("object")
    )


def csv_profile(spark: SparkSession, path: str, layouts: DataFrame | None = None, multiline: bool = False) -> DataFrame:
    """(source_path, utf8, rows, columns, column_names, kinds, dtypes, malformed) of each file, from one scan.

    Fields become bits before they are grouped, and bits of a column are combined before they move.
    """
    layouts = csv_layouts(spark, path) if layouts is None else layouts
    kinds = csv_records(spark, path, layouts, multiline).select(
        "source_path", "malformed", F.posexplode(F.transform("values", kind_of)).alias("place", "kind")
    )
    columns = kinds.groupBy("source_path", "place").agg(
        F.bit_or("kind").alias("kind"), F.count(F.lit(1)).alias("rows"), F.count_if("malformed").alias("malformed")
    )
    files = columns.groupBy("source_path").agg(
        F.max("rows").alias("rows"),
        F.max("malformed").alias("malformed"),
        F.sort_array(F.collect_list(F.struct("place", "kind"))).alias("kinds"),
    )
    # A file of a head line only has no kinds.
    none = F.transform("names", lambda _: F.lit(0))
    found = F.coalesce(F.transform("kinds", lambda c: c["kind"]), none)
    count = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return layouts.join(files, "source_path", "left").select(
        "source_path",
        "utf8",
        count("rows"),
        F.size("names").alias("columns"),
        F.col("names").alias("column_names"),
        found.alias("kinds"),
        F.transform(found, dtype_of).alias("dtypes"),
        count("malformed"),
    )


def table_type(kinds: int) -> T.DataType:
    """The type that holds all fields of the given kinds and nulls."""
    present = kinds & ~ABSENT
    if present == INTEGER:
        return T.LongType()
    if present == BOOLEAN:
        return T.BooleanType()
    return T.DoubleType() if present and not present & (BOOLEAN | TEXT) else T.StringType()


def inferred_schema(profile: DataFrame) -> T.StructType:
    """All columns of all files by name, those of first places first; types hold what any file has."""
    pairs = profile.select(F.posexplode(F.arrays_zip("column_names", "kinds")).alias("place", "c"))
    names = pairs.groupBy(F.col("c.column_names").alias("name")).agg(F.bit_or("c.kinds").alias("kinds"), F.min("place").alias("place"))
    rows = names.orderBy("place", "name").collect()
    return T.StructType([T.StructField(r["name"], table_type(r["kinds"])) for r in rows])


def csv_rows(spark: SparkSession, path: str, schema: str | None = None, multiline: bool = False) -> DataFrame:
    """The files as one table; columns are matched by name, and those a file lacks are null.

    Give ``schema`` on large inputs; inference is one more scan. A value that its column's type cannot hold is null.
    """
    layouts = csv_layouts(spark, path)
    if schema is None:
        wanted = inferred_schema(csv_profile(spark, path, layouts, multiline))
    else:
        wanted = T.StructType.fromDDL(schema)
    # Places are looked up once per file; 0 is none.
    places = F.array(*[F.array_position("names", n).cast("int") for n in wanted.names])
    records = csv_records(spark, path, layouts.withColumn("places", places), multiline)

    def field(i: int, of: T.StructField) -> Column:
        value = F.get("values", F.get("places", F.lit(i)) - 1)
        return F.when(~missing(value), value.try_cast(of.dataType)).alias(of.name)

    return records.select(*[field(i, f) for i, f in enumerate(wanted.fields)])


def csv_documents(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One document per CSV record, so that no file has to fit one row."""
    doubled = lambda v: F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
    written = lambda v: F.when(v.rlike('[",\r\n]'), doubled(v)).otherwise(F.coalesce(v, F.lit("")))
    rows = csv_records(spark, path, multiline=multiline)
    line = F.array_join(F.transform("values", written), ",")
    return rows.select("source_path", line.alias("line")).select(*document(F.col("source_path"), F.col("line"), "csv"))
