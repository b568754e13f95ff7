"""Catalog tables and views: create, append, refresh, layer.

New contents of a table are written to a folder of their own; then the catalog entry is
pointed at it and the old folder removed. Until that switch the old rows stay readable,
so a failure while computing loses nothing, and a table may be built from itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name as SQL text, whatever its characters."""
    return "`" + name.replace("`", "``") + "`"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    return name


def layer(spark: SparkSession, base: str, name: str, location: str | None = None) -> str:
    """The database of one layer, `<base>_<name>`, created where missing."""
    return create_database(spark, f"{base}_{name}", location and f"{location}/{base}_{name}")


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, audit_column: str | None = None
) -> None:
    """An empty typed Parquet table in place of any of that name.

    The audit column comes last and defaults to the time of the insert.
    """
    columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
    if audit_column:
        columns.append(f"{quoted(audit_column)} TIMESTAMP DEFAULT current_timestamp()")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet")


def append(df: DataFrame, table: str) -> None:
    """Add rows by column name; columns that `df` lacks take their default."""
    names = ", ".join(map(quoted, df.columns))
    df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {{rows}}", rows=df)


def full_refresh(df: DataFrame, table: str) -> None:
    """Replace all rows of an unpartitioned table, by column name.

    Columns that `df` lacks take their default. The rows are written once.
    """
    switch_to(df.sparkSession, {table: staged(df, table)})


def staged(df: DataFrame, table: str, keep: DataFrame | None = None) -> str:
    """Write the rows that a table is to hold to a new folder, and return it.

    Columns that `df` lacks take their default. `keep` holds rows of the table itself that
    stay, load times included. The table does not change before `switch_to`.
    """
    spark = df.sparkSession
    fields = spark.table(table).schema.fields
    unknown = {c.lower() for c in df.columns} - {f.name.lower() for f in fields}
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    folder = new_folder(spark, table)
    rows = df.select(*[_filled(df, f) for f in fields])
    if keep is not None:
        rows = rows.unionByName(keep)
    rows.write.parquet(folder)
    return folder


def switch_to(spark: SparkSession, folders: dict[str, str]) -> None:
    """Point tables at their staged rows, one catalog entry after the other, in order."""
    for table, folder in folders.items():
        _switch(spark, table, folder)


def _filled(df: DataFrame, field: T.StructField):
    if field.name.lower() in {c.lower() for c in df.columns}:
        value = F.col(quoted(field.name))
    else:
        value = F.expr(field.metadata.get("CURRENT_DEFAULT", "NULL"))
    return value.cast(field.dataType).alias(field.name)


def new_folder(spark: SparkSession, table: str) -> str:
    """A new folder for a table's rows, in the place of its database."""
    database, _, name = table.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place}/{name.strip('`')}-{uuid.uuid4().hex}"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def _switch(spark: SparkSession, table: str, folder: str) -> None:
    """Point the table at its new rows, then remove the old ones."""
    old = _location(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    remove_folder(spark, old)


def replace_entry(spark: SparkSession, table: str, new: str) -> None:
    """Give the name of a table to another one that is complete, then drop what had the name.

    At every moment both tables' rows lie under some name: should the second renaming fail, the
    first is taken back.
    """
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        return
    old = beside(table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    place = _location(spark, old)
    spark.sql(f"DROP TABLE {old}")
    remove_folder(spark, place)
    spark.catalog.refreshTable(table)


def beside(table: str) -> str:
    """A new table name in the same database."""
    return f"{table.rstrip('`')}_{uuid.uuid4().hex}{'`' if table.endswith('`') else ''}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    files, path = _files(spark, folder)
    files.delete(path, True)


def swap_folder(spark: SparkSession, folder: str, new: str) -> None:
    """Put a complete folder in the place of another one, which goes when it has moved."""
    files, path = _files(spark, folder)
    _, source = _files(spark, new)
    _, old = _files(spark, f"{folder}-{uuid.uuid4().hex}")
    if not files.exists(source):
        raise OSError(f"{new} does not exist")
    earlier = files.exists(path)
    if earlier and not files.rename(path, old):
        raise OSError(f"{folder} could not be moved")
    moved = False
    try:
        moved = files.rename(source, path)
    finally:
        if earlier and not moved:
            files.rename(old, path)
    if not moved:
        raise OSError(f"{new} could not be moved to {folder}")
    files.delete(old, True)


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def with_audit(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def register_view(df: DataFrame, name: str) -> None:
    """Name a frame for SQL in this session."""
    df.createOrReplaceTempView(name)


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """A lasting view; its query may only read catalog tables and views."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def materialize(df: DataFrame, name: str, kind: str) -> None:
    """Keep a model as a session view, or as a table built anew.

    The table's rows are computed before anything of the old table is touched.
    """
    spark = df.sparkSession
    if kind == "view":
        register_view(df, name)
    elif kind == "table":
        folder = new_folder(spark, name)
        df.write.parquet(folder)
        if spark.catalog.tableExists(name) and spark.table(name).dtypes == df.dtypes:
            _switch(spark, name, folder)
        else:
            new = beside(name)
            create_table(spark, new, df.schema)
            _switch(spark, new, folder)
            replace_entry(spark, name, new)
    else:
        raise ValueError(f"unknown kind of model: {kind}")


def store_failures(df: DataFrame, table: str) -> None:
    """Keep the rows a check objected to, in place of those of the last run."""
    materialize(df, table, "table")
