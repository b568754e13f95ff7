"""A CSV load that sets bad and repeated records aside instead of aborting.

Every line of the files, headers left out, ends in one of two frames: as a typed record, or as a
rejected line with its file, its number there, and the reason. Records are one line each; the
format is that of `csv_files`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.sources.scratch import scratch_path

# The written forms of dates and times, as in `csv_files`.
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_FORMS = {T.DateType(): _DATE, T.TimestampType(): _TIME, T.TimestampNTZType(): _TIME}
# Records, and bytes of their lines, that one task looks for repeated keys in.
TASK_ROWS = 250_000
TASK_BYTES = 64_000_000


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columns file, line_no (from 1), line and place, written down once.

    A file may be read by many tasks. Each notes where its piece of the file starts and counts its
    lines; the pieces' counts, a row for each, are added up along the file, and the files' counts
    along their names: `place` numbers the lines of all files.
    """
    own = scratch_path(spark, "lines")
    read = spark.read.option("lineSep", "\n").text(path)
    read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    ).write.parquet(own)
    lines = spark.read.parquet(own)
    pieces = lines.groupBy("file", "piece").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    pieces = pieces.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("piece", "first", "n"))).alias("all"))
    before = F.aggregate(
        F.filter("all", lambda p: p["piece"] < F.col("one.piece")), F.lit(0).cast("long"), lambda a, p: a + p["n"]
    )
    # One row per file.
    whole = F.aggregate("all", F.lit(0).cast("long"), lambda a, p: a + p["n"])
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("others", F.coalesce(F.sum(whole).over(earlier), F.lit(0)))
    starts = pieces.select("file", "all", "others", F.explode("all").alias("one")).select(
        "file", "others", "one.piece", (before - F.col("one.first") + 1).alias("shift")
    )
    line_no = F.col("place") + F.col("shift")
    return lines.join(starts, ["file", "piece"]).select(
        "file", line_no.alias("line_no"), "line", (F.col("others") + line_no).alias("place")
    )


def _reason(field: T.StructField, value: Column, typed: Column) -> Column:
    """Why a field is refused, or NULL."""
    wrong = typed.isNull()
    form = _FORMS.get(field.dataType)
    if form is not None:
        wrong = wrong | ~value.rlike(form)
    reason = F.when(value.isNotNull() & wrong, F.lit(f"{field.name}: not a {field.dataType.simpleString()}"))
    if not field.nullable:
        reason = reason.when(value.isNull(), F.lit(f"{field.name}: no value in a required column"))
    longest = (field.metadata or {}).get("max_length")
    if longest is not None:
        reason = reason.when(F.length(value) > longest, F.lit(f"{field.name}: text longer than {longest}"))
    return reason


def load_clean(
    spark: SparkSession, path: str | list[str], schema: T.StructType, key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): typed records, and file, line_no, line and reason of the others.

    A line is rejected for a wrong number of fields, or for the first field, in the order of the
    schema, that does not parse, lacks a required value, or is too long. Of good records that share
    a `key`, the last stays, by file name and line; the others are rejected as repeated. Records
    without a key are not repeated. Blank lines are rejected for their number of fields.
    """
    lines = numbered_lines(spark, path).where("line_no > 1")
    names = [f.name for f in schema.fields]
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_bad", T.StringType())])
    options = {"sep": ",", "quote": '"', "escape": '"', "nullValue": "\\N", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.withColumn("r", F.from_csv("line", texts.simpleString()[7:-1].replace(":", " "), options))
    # A field without content is NULL; an empty text in quotes is not told apart from it here.
    values = {f.name: F.when(F.col("r")[f.name] != "", F.col("r")[f.name]) for f in schema.fields}
    typed = {f.name: values[f.name].try_cast(f.dataType) for f in schema.fields}
    fields = F.coalesce(*[_reason(f, values[f.name], typed[f.name]) for f in schema.fields])
    shape = F.when(F.col("r").isNull() | F.col("r._bad").isNotNull() | (F.trim("line") == ""), "wrong number of fields")
    judged_at = scratch_path(spark, "judged")
    parsed.select(
        "file", "line_no", "line", "place", F.coalesce(shape, fields).alias("reason"),
        F.struct(*[typed[n].alias(n) for n in names]).alias("record"),
    ).write.parquet(judged_at)
    judged = spark.read.parquet(judged_at)
    good, bad = judged.where("reason is null"), judged.where("reason is not null")
    rejected = bad.select("file", "line_no", "line", "reason")
    if key is not None:
        of = F.col("record")[key]
        keyed = good.where(of.isNotNull())
        # A number of partitions given with `repartition` stays: rows that compress well would
        # else be merged to very many per task. Semi and anti joins would slip below it.
        n, size = keyed.agg(F.count("*"), F.sum(F.octet_length("line"))).first()
        tasks = 1 + max(n // TASK_ROWS, (size or 0) // TASK_BYTES)
        last = keyed.groupBy(of.alias("k")).agg(F.max("place").alias("place"))
        # Places are unique, so a key that very many records share makes no hot group here.
        stay = last.select("place", F.lit(True).alias("stays")).repartition(tasks, "place")
        unique = keyed.select("place", "record").repartition(tasks, "place").join(stay, "place")
        others = keyed.select("place", "file", "line_no", "line").repartition(tasks, "place")
        repeated = others.join(stay, "place", "left").where("stays is null")
        again = repeated.select("file", "line_no", "line", F.lit(f"{key}: repeated").alias("reason"))
        good = good.where(of.isNull()).select("record").unionByName(unique.select("record"))
        rejected = rejected.unionByName(again)
    return good.select("record.*"), rejected
