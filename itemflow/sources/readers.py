"""Readers for exports, stage files and the billing database."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from itemflow import schema
from itemflow.functions.columns import cast_or_refuse

# Fixed value: how exports write a missing value.
NULL_TOKEN = "NA"


# Columns that an export may lack: another table has them, or a later step makes them.
OPTIONAL = frozenset(
    ["activity_id_hist", "activity_status", "source_system", "rawest_response", "correct_answer", "is_scored", "tutor_mode"]
)


def read_tsv(
    spark: SparkSession, path: str, columns: StructType, names: Mapping[str, str] | None = None, optional: Iterable[str] = ()
) -> DataFrame:
    """An export with a header, tabs between fields and ``NA`` or nothing for null."""
    return _delimited(spark, path, columns, "\t", names or {}, optional)


def read_csv(
    spark: SparkSession, path: str, columns: StructType, names: Mapping[str, str] | None = None, optional: Iterable[str] = ()
) -> DataFrame:
    return _delimited(spark, path, columns, ",", names or {}, optional)


def _delimited(
    spark: SparkSession, path: str, columns: StructType, separator: str, names: Mapping[str, str], optional: Iterable[str]
) -> DataFrame:
    """Columns are found by name, whatever their place; unknown ones are ignored.

    All fields are read as text. Headers are brought to the names used here, then each
    column is cast; a field that is no value of its type stops the run.
    """
    text, present = _as_text(spark, path, columns, separator, names, optional)
    return text.select(
        *[
            F.col(f.name) if f.dataType == StringType() else cast_or_refuse(F.col(f.name), f.dataType, f.name).alias(f.name)
            for f in present
        ]
    )


def _as_text(
    spark: SparkSession, path: str, columns: StructType, separator: str, names: Mapping[str, str], optional: Iterable[str]
) -> tuple[DataFrame, list[StructField]]:
    """The file's columns as text under the names used here, and which of the wanted ones it has."""
    text = spark.read.option("header", True).option("sep", separator).option("nullValue", NULL_TOKEN).csv(path)
    text = schema.canonical(schema.lower_first_letters(text), names)
    missing = [f.name for f in columns if f.name not in text.columns and f.name not in set(optional)]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(text.columns)}")
    return text, [f for f in columns if f.name in text.columns]


def read_sorted_out(
    spark: SparkSession, path: str, columns: StructType, names: Mapping[str, str] | None = None, optional: Iterable[str] = (), separator: str = "\t"
) -> tuple[DataFrame, DataFrame]:
    """(rows, bad cells): rows whose fields are all of their types, and the fields that are not.

    A bad cell is (file, row, column, text); ``row`` has all fields of its row as they are,
    by which it is found in the file. Rows with a bad cell are in the second frame only, once
    for each of its bad cells.
    """
    text, present = _as_text(spark, path, columns, separator, names or {}, optional)
    typed = [f for f in present if f.dataType != StringType()]
    no_value = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in typed]
    cell = [F.when(bad, F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text"))) for f, bad in zip(typed, no_value)]
    found = F.filter(F.array(*cell), lambda c: c.isNotNull())
    marked = text.withColumns({"__file": F.col("_metadata.file_path"), "__bad": found})
    kinds = {f.name: f.dataType for f in present}
    rows = marked.where(F.size("__bad") == 0).select(*[F.col(c).try_cast(k).alias(c) for c, k in kinds.items()])
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns]))
    bad = marked.where(F.size("__bad") > 0).select(F.col("__file").alias("file"), whole.alias("row"), F.inline("__bad"))
    return rows, bad


def stop_beyond(bad: DataFrame, limit: int) -> dict[str, int]:
    """How many cells of each column are bad; raises if some column has more than the limit."""
    counts = {r["column"]: r["n"] for r in bad.groupBy("column").agg(F.count("*").alias("n")).collect()}
    beyond = {c: n for c, n in sorted(counts.items()) if n > limit}
    if beyond:
        raise ValueError(f"more than {limit} cells are no values of their types: " + ", ".join(f"{c}: {n}" for c, n in beyond.items()))
    return counts


def read_responses(spark: SparkSession, path: str, columns: StructType = schema.RESPONSE_EXPORT) -> DataFrame:
    """Responses as TSV export; ids and responses stay text."""
    return read_tsv(spark, path, columns, schema.RESPONSE_NAMES, OPTIONAL)


def read_activities(spark: SparkSession, path: str, columns: StructType = schema.ACTIVITIES) -> DataFrame:
    return read_tsv(spark, path, columns, schema.ACTIVITY_NAMES, ["source_system"])


def read_content_items(spark: SparkSession, path: str, columns: StructType = schema.CONTENT_ITEMS) -> DataFrame:
    return read_tsv(spark, path, columns, schema.CONTENT_NAMES, ["content_item_name", "section_name"])


def read_test_map(spark: SparkSession, path: str) -> DataFrame:
    """A test map kept as CSV by hand."""
    return read_csv(spark, path, schema.TEST_MAP, schema.TEST_MAP_NAMES)


def read_section_map(spark: SparkSession, path: str) -> DataFrame:
    """A section map kept as CSV by hand; only names and numbers of questions must be there."""
    return read_csv(spark, path, schema.SECTION_MAP, schema.SECTION_MAP_NAMES, schema.SECTION_MAP.names[2:])


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """What an earlier step left behind as Parquet: cleaned responses, maps, matrices."""
    return spark.read.parquet(path)


def read_matrix_csv(spark: SparkSession, path: str) -> DataFrame:
    """A wide matrix; all columns are text, since codes and numbers are mixed."""
    return spark.read.option("header", True).csv(path)


def read_block_lines(spark: SparkSession, path: str, id_column: str = "student_id") -> DataFrame:
    """(value, block, ...): the lines of a matrix written in blocks, without the header lines."""
    return spark.read.text(path).where(~F.col("value").startswith(f"{id_column},"))


def read_matrix_lines(spark: SparkSession, path: str, id_column: str = "student_id") -> tuple[DataFrame, DataFrame]:
    """(lines, headers) of a matrix as CSV text, in one file or in blocks, with the columns of its folders.

    A header begins with the name of the id column, quoted or not.
    """
    text = spark.read.text(path)
    first = F.replace(F.substring_index("value", ",", 1), F.lit('"'), F.lit(""))
    return text.where(first != id_column), text.where(first == id_column)


def repeat_enrollment_query(purchases: str, products: str, code_column: str = "transaction_code") -> str:
    """The question the database answers itself: enrollments bought again."""
    codes = ", ".join(f"'{c}'" for c in schema.REPEAT_PURCHASE_CODES)
    return (
        f"select p.id as enrollment_id from {purchases} p join {products} d on p.product_id = d.id "
        f"where p.{code_column} in ({codes}) and p.created_on >= '{schema.REPEAT_PURCHASES_SINCE}'"
    )


def read_repeat_enrollments(spark: SparkSession, query: str, options: Mapping[str, str]) -> DataFrame:
    """Repeat enrollments over JDBC; url, driver and credentials come from the caller."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()
