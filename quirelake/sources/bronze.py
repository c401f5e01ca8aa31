"""Bronze: JSON lines below a prefix, read tolerantly and landed by key and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quirelake.functions.text import path_key, trim_ws
from quirelake.schemas import BOOK_COLUMNS

CORRUPT = "_corrupt_record"
EXTRAS = "_extras"


def read_lines(spark: SparkSession, prefix: str, path: str | None = None) -> DataFrame:
    """Every line of every .json file below the prefix; unreadable files are
    skipped, and an absent prefix has no lines. `path` names a column for the
    file that a line comes from."""
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
    )
    try:
        lines = reader.text(prefix)
        return lines.withColumn(path, F.col("_metadata.file_path")) if path else lines
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"value string, `{path}` string" if path else "value string")


def parse_lines(lines: DataFrame, required=tuple(BOOK_COLUMNS), value: str = "value", keep=()) -> DataFrame:
    """Lines to rows in a single pass and a single parse, without a scan to infer the schema.

    Required fields become text columns, fields nobody asked for stay in the
    `_extras` map, and a line that is no JSON object goes to `_corrupt_record`.
    Blank lines vanish. Of a field that occurs twice in a line the last wins.
    Works on a stream as well.
    """
    raw, line, fields = F.col(value), F.col("_line"), F.col("_fields")
    usual = raw.startswith("{") & raw.endswith("}")
    trimmed = lines.select(*keep, raw, F.when(usual, raw).otherwise(trim_ws(raw)).alias("_line")).filter(line != "")
    is_object = line.startswith("{") & line.endswith("}")
    parsed = trimmed.select(
        *keep, raw, F.when(is_object, F.from_json(line, "map<string,string>")).alias("_parsed")
    ).select(*keep, raw, _last_of_each("_parsed").alias("_fields"))
    return parsed.select(
        *keep,
        *[F.try_element_at(fields, F.lit(n)).alias(n) for n in required],
        F.map_filter(fields, lambda k, _: ~k.isin(*required)).alias(EXTRAS),
        F.when(fields.isNull(), raw).alias(CORRUPT),
        F.map_keys(fields).alias("_names"),
    )


def _last_of_each(name: str) -> Column:
    """The map with the last value of a key that occurs more than once."""
    entries = F.col(name)
    keys, values = F.map_keys(entries), F.map_values(entries)
    unique = F.array_distinct(keys)
    places = F.size(keys) - F.lit(1)

    def last(key: Column) -> Column:
        return F.get(values, places - (F.array_position(F.reverse(keys), key) - 1).cast("int"))

    return F.when(F.size(unique) < F.size(keys), F.map_from_arrays(unique, F.transform(unique, last))).otherwise(entries)


def listed_files(spark: SparkSession, prefix: str) -> DataFrame:
    """Paths and lengths of the .json files below the prefix that are not empty; their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    try:
        return listed.load(prefix).filter("length > 0").select("path", "length", F.col("modificationTime").alias("modified"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")


def skipped_files(spark: SparkSession, prefix: str) -> DataFrame:
    """Paths of the files that `read_lines` could not read: listed but without a line.

    The lines are read for it, but not parsed; a run observes the paths while it reads instead (`ReadFiles`).
    """
    read = read_lines(spark, prefix, "path").select("path").distinct()
    return missing_paths(listed_files(spark, prefix).select("path"), read)


class ReadFiles:
    """Notes the files that lines come from while some other job reads them; no pass of its own.

    What is noted is a set of paths, of which the driver holds the whole list for the scan anyway. A task that runs
    twice adds the same paths.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.observation = spark, Observation()

    def watch(self, lines: DataFrame, path: str) -> DataFrame:
        """The lines without the column `path`, which is observed."""
        return lines.observe(self.observation, F.collect_set(path).alias("paths")).drop(path)

    def paths(self) -> DataFrame:
        """The paths, once the job that reads the lines is done."""
        return self.spark.createDataFrame([(p,) for p in self.observation.get["paths"]], "path string")

    def skipped(self, prefix: str) -> DataFrame:
        return missing_paths(listed_files(self.spark, prefix).select("path"), self.paths())


def missing_paths(listed: DataFrame, read: DataFrame) -> DataFrame:
    # the two readers write the slashes after the scheme differently
    uri = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("path")
    return listed.select(uri).join(read.select(uri), "path", "left_anti")


def extras_to_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the named keys of the `_extras` map a column of their own.

    Keys that differ from another column only in case cannot be columns in
    Spark and stay in the map.
    """
    taken = {c.lower() for c in df.columns}
    columns = {}
    for name in names:
        if name.lower() not in taken:
            taken.add(name.lower())
            columns[name] = F.try_element_at(EXTRAS, F.lit(name))
    return df.withColumns(columns) if columns else df


def read_bronze(
    spark: SparkSession, prefix: str, required: Sequence[str] = tuple(BOOK_COLUMNS), extras: Sequence[str] = ()
) -> DataFrame:
    """All records below a prefix as text columns, with `_corrupt_record`, in one scan.

    Fields outside `required` stay in the `_extras` map, however many they are;
    those named in `extras` become columns as well. A field that a record or the
    whole batch lacks is null: the run gives wholly absent fields their defaults
    from what it has seen while reading.
    """
    parsed = parse_lines(read_lines(spark, prefix), required).drop("_names")
    return extras_to_columns(parsed, extras)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, corrupt lines)."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def corrupt_report(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("lignes_lues"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("lignes_ignorees"),
    )


def landing_columns(df: DataFrame, at: Column, source="source", category="categorie") -> DataFrame:
    """Folder keys of a record: source, UTC hour and category; absent ones 'unknown'."""

    def label(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("unknown")) if name in df.columns else F.lit("unknown")

    return df.withColumns({
        "source_key": path_key(label(source), ". "),
        "ingest_hour": F.date_format(at, "yyyy-MM-dd-HH"),
        "categorie_key": path_key(label(category)),
    })


LANDING_KEYS = ["source_key", "ingest_hour", "categorie_key"]


def land(df: DataFrame, root: str, at: Column) -> None:
    """Append records as JSON lines below source / hour / category folders.

    The rebalance hint gathers the rows of a folder in few files and splits a
    folder that is too large for one task.
    """
    keyed = landing_columns(df, at)
    (
        keyed.hint("rebalance", *LANDING_KEYS)
        .write.mode("append").partitionBy(*LANDING_KEYS).option("ignoreNullFields", False).json(root)
    )
