"""File sources: S3 player-season CSV, S4 style-match CSV, S5 optional
source, S6 schema conform (see :func:`pitchside.operators.players.conform_measures`),
S7 pandas-style missing-value tokens.

CSV cells are read as text (no schema inference pass over the data) and
coerced by column expressions downstream, so one bad cell nulls one value
instead of failing or re-typing a whole column.  ``escape='"'`` is required:
with Spark's default backslash escape a doubled quote inside a quoted cell
splits the cell and shifts every later column.

A row with fewer or more cells than the header keeps what it has, as the modelled job keeps short rows; with ``keep_bad``
its text is in the column ``BAD``, so a job can count such rows and put them out.  :func:`columnar` turns a
file into a columnar copy, so that it is parsed once however many steps read it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pitchside.params import PANDAS_NA_TOKENS

# Renames applied at ingest: these names are unsafe in SQL text ("90s" parses
# as the literal 90; "Tkl+Int" is an expression).
PLAYER_RENAMES = {"90s": "nineties", "Tkl+Int": "tkl_int"}


#: The text of a row whose cells do not match the header; null for others.
BAD = "_bad_row"


def csv_reader(spark: SparkSession, multi_line: bool = False):
    """Large files are read in splits.  Cells with line breaks need ``multi_line``, which reads each
    file in one task; convert such a file once."""
    return (spark.read.option("header", True).option("escape", '"')
            .option("multiLine", multi_line).option("mode", "PERMISSIVE"))


def null_na_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The text tokens pandas reads as missing become null."""
    cols = columns if columns is not None else [f.name for f in df.schema.fields
                                                if f.dataType.simpleString() == "string"]
    return df.withColumns({
        c: F.when(F.col(f"`{c}`").isin(PANDAS_NA_TOKENS), F.lit(None)).otherwise(F.col(f"`{c}`"))
        for c in cols
    })


def _with_ordinal(df: DataFrame) -> DataFrame:
    # File order whatever the order of the splits: file, block, place in the block.
    return df.withColumn("ordinal", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def _read(spark: SparkSession, path: str, multi_line: bool, keep_bad: bool) -> DataFrame:
    """The file as text columns named by its header."""
    names = csv_reader(spark, multi_line).csv(path).columns
    if not keep_bad:
        return _with_ordinal(csv_reader(spark, multi_line).csv(path))
    schema = StructType([StructField(n, StringType()) for n in (*names, BAD)])
    return _with_ordinal(csv_reader(spark, multi_line).schema(schema).option("columnNameOfCorruptRecord", BAD).csv(path))


def read_players(spark: SparkSession, path: str, multi_line: bool = False, keep_bad: bool = False) -> DataFrame:
    """S3: player-season file -> text columns, renamed, NA tokens nulled,
    plus ``ordinal`` (file order) for top-k tie breaks."""
    df = _read(spark, path, multi_line, keep_bad)
    df = df.withColumnsRenamed({k: v for k, v in PLAYER_RENAMES.items() if k in df.columns})
    return null_na_tokens(df, [f.name for f in df.schema if f.dataType == StringType() and f.name != BAD])


def read_style_matches(spark: SparkSession, path: str, multi_line: bool = False, keep_bad: bool = False) -> DataFrame:
    """Style-match file (``home_team, away_team, home_score, away_score``)."""
    df = _read(spark, path, multi_line, keep_bad)
    return null_na_tokens(df, [f.name for f in df.schema if f.dataType == StringType() and f.name != BAD])


def columnar(df: DataFrame, folder: str, flag: Column | None = None) -> DataFrame:
    """``df`` written once to ``folder`` (shared) as Parquet and read back, partitioned by ``flag``, a condition that
    later steps filter by, as the column ``flagged``: they then read only its files."""
    out = df.withColumn("flagged", F.lit(True) if flag is None else flag)
    out.write.partitionBy("flagged").parquet(folder)
    return df.sparkSession.read.schema(out.schema).parquet(folder)


def bad_rows(df: DataFrame) -> DataFrame:
    """``file, row`` of the rows whose cells do not match the header."""
    return df.filter(F.col(BAD).isNotNull()).select(F.col("ordinal.file").alias("file"), F.col(BAD).alias("row"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in whatever store Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def optional_source(spark: SparkSession, path: str | None, read, schema: StructType) -> DataFrame:
    """A missing input yields a typed empty DataFrame instead of an error,
    so downstream plans stay valid and produce empty results (G2).  Any other
    read failure still raises."""
    if path:
        try:
            return read(spark, path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)
