"""Typed CSV in and out.

Files have a header line, commas, optional double quotes (doubled inside a
quoted field) and, as a rule, one record per line; dates and times have fixed
formats. A field without content is NULL, and so is an unquoted `\\N`; a quoted
one without content is an empty text. Any compression Spark knows by its suffix,
gzip included, is read as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.sources.catalog import append, create_table, full_refresh, with_audit

_FORMAT = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# A null marker other than "" keeps empty quoted text apart from a missing one.
_READ = {"mode": "FAILFAST", "nullValue": "\\N"}


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    audit_column: str | None = None,
    spread: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read files into the schema, in column order; the load fails as a whole.

    A value that does not parse, a wrong number of fields, a NULL in a required
    column or a text over its declared length raises, whatever the query on the
    frame reads: the row filter needs every column. `audit_column` is filled
    with the load time. A gzip file is one task; `spread` evens the rows
    out afterwards, for a load of few large files. `multiline` allows line ends
    inside quotes, at the price that plain files are one task each as well.
    """
    rows = (
        spark.read.schema(schema)
        .options(**_FORMAT, **_READ, multiLine=multiline)
        .csv(path)
        .select(*[_enforced(field) for field in schema.fields])
    )
    # Always true, but known only once all columns have been parsed and checked.
    rows = rows.where(F.xxhash64(*[F.col(f.name) for f in schema.fields]) >= -(2**63))
    if spread:
        rows = rows.hint("rebalance")
    if audit_column:
        rows = with_audit(rows, audit_column)
    return rows


def load_table(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    schema: T.StructType,
    audit_column: str | None = None,
    replace: bool = False,
    spread: bool = False,
    multiline: bool = False,
) -> None:
    """Load files into a typed catalog table, created where missing, all or nothing.

    Rows are added, or with `replace` take the place of all others. A bad record
    leaves the table as it was; `audit_column` gets the load time.
    """
    rows = load_csv(spark, path, schema, spread=spread, multiline=multiline)
    if not spark.catalog.tableExists(table):
        create_table(spark, table, schema, audit_column)
    if replace:
        full_refresh(rows, table)
    else:
        append(rows, table)


def save_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write a directory of CSV files; times are cut to whole seconds."""
    df.write.mode("overwrite").options(**_FORMAT, compression=compression).csv(path)


def _enforced(field: T.StructField) -> Column:
    value = F.col(field.name)
    longest = (field.metadata or {}).get("max_length")
    checked = value
    if longest is not None:
        refusal = F.raise_error(F.lit(f"{field.name}: text longer than {longest}"))
        checked = F.when(F.length(value) > longest, refusal).otherwise(checked)
    if not field.nullable:
        refusal = F.raise_error(F.lit(f"{field.name}: no value in a required column"))
        checked = F.when(value.isNull(), refusal).otherwise(checked)
    return checked.alias(field.name)
