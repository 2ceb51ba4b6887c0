"""CSV exports, one file or a whole folder, into typed Parquet."""

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feira import schemas
from feira.sources import quoted_lines
from feira.sources.sinks import write_parquet

# A file belongs to the first of these keywords found in its name, in
# this order; the second item is the entity (and folder) it goes to.
ROUTES = [
    ("orders", "orders"),
    ("customers", "customers"),
    ("products", "products"),
    ("order_items", "order_items"),
    ("payments", "order_payments"),
    ("reviews", "order_reviews"),
    ("sellers", "sellers"),
    ("geolocation", "geolocation"),
    ("translation", schemas.TRANSLATION),
]
UNROUTED = "misc"

# Free text holds line breaks inside quotes. Reading across lines takes a pass of its own to
# tell where records begin, so the other entities are read line by line unless the caller
# asks for more; a record that goes on in the next line is then malformed.
WITH_FREE_TEXT = {"order_reviews"}
REJECTS = "_rejects"
_MALFORMED = "_malformed_record"
# What fields without anything are read as first; no text is like it.
_NO_TEXT = "\0null\0"


def entity_of(file_name: str) -> str:
    for keyword, entity in ROUTES:
        if keyword in file_name:
            return entity
    return UNROUTED


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    multi_line: bool,
    keep_empty: bool = False,
) -> DataFrame:
    """CSV files of one header as text columns, and the record where it is malformed.

    An empty field is null, and so is a pair of quotes unless ``keep_empty`` tells the
    empty text from null, as ``sinks.export_csv`` writes them. Files are split into parts
    that are read in parallel, also where records cross lines (``quoted_lines``).
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    options = {
        "header": True,
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "enforceSchema": False,
        # a record whose fields are not all parsed is not seen to be malformed
        "columnPruning": False,
    }
    if keep_empty:
        options["nullValue"] = _NO_TEXT
    names = spark.read.options(**options).csv(files).columns
    options["columnNameOfCorruptRecord"] = _MALFORMED
    if multi_line:
        return _parsed(quoted_lines.records(spark, files), names, options)
    schema = StructType([StructField(name, StringType()) for name in [*names, _MALFORMED]])
    return spark.read.options(**options).schema(schema).csv(files)


def _parsed(text: DataFrame, names: Sequence[str], options: Mapping[str, object]) -> DataFrame:
    """The fields of records (column ``record``), each of which may hold line breaks."""
    quoted = ["`" + name.replace("`", "``") + "`" for name in [*names, _MALFORMED]]
    ddl = ", ".join(f"{name} string" for name in quoted)
    kept = {key: str(value) for key, value in options.items() if key not in ("header", "multiLine")}
    return text.select(F.from_csv("record", ddl, kept).alias("row")).select("row.*")


def _well_formed(text: DataFrame) -> Column:
    """Also looks at a field: Spark refuses to read the malformed records' column alone."""
    return F.col(_MALFORMED).isNull() & (F.coalesce(F.col(text.columns[0]), F.lit("")) != _NO_TEXT)


def _crosses_lines(entity: str, multi_line: bool | None) -> bool:
    return entity in WITH_FREE_TEXT if multi_line is None else multi_line


def read_export(
    spark: SparkSession,
    paths: str | Sequence[str],
    entity: str,
    multi_line: bool | None = None,
) -> DataFrame:
    """One entity's CSV files as a typed DataFrame, without malformed records.

    Columns are found by header name, and the files of one call must share a header
    (Spark raises otherwise). Nothing is inferred, so the data is read once. A value
    its type cannot hold becomes null; columns the schema does not know stay text.
    ``multi_line`` says whether records may cross lines; free text does by default.
    """
    ddl = schemas.BRONZE.get(entity) or schemas.LOOKUPS[entity]
    text = read_csv(spark, paths, _crosses_lines(entity, multi_line))
    types = {field.name: field.dataType for field in schemas.struct(ddl)}
    missing = [name for name in types if name not in text.columns]
    if missing:
        raise ValueError(f"{entity}: the export has no column {', '.join(missing)}")
    extra = [name for name in text.columns if name not in types and name != _MALFORMED]
    return text.where(_well_formed(text)).select(
        *[F.col(name).try_cast(dtype).alias(name) for name, dtype in types.items()], *extra
    )


def rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    entity: str,
    multi_line: bool | None = None,
) -> DataFrame:
    """Records (text) that ``read_export`` cannot read as they were meant.

    Those with too few or too many fields; and, reading line by line, those with a quote
    that is not closed in its line, even if their number of fields is right.
    """
    crosses = _crosses_lines(entity, multi_line)
    parsed = read_csv(spark, paths, crosses)
    found = parsed.where(~_well_formed(parsed)).select(F.col(_MALFORMED).alias("record"))
    if crosses:
        return found
    files = [paths] if isinstance(paths, str) else list(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    open_ended = spark.read.text(files).where(quotes % 2 == 1).select(F.col("value").alias("record"))
    # a line that the parser reports it reports each time, so repeats are counted as they are
    return found.union(open_ended.join(found, "record", "left_anti"))


def read_unknown_export(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with no known schema: names from its header, types inferred."""
    return spark.read.csv(
        path, header=True, inferSchema=True, quote='"', escape='"', multiLine=True
    )


def list_exports(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the ``*.csv`` files of a folder on any file system Spark can reach.

    Only names come back: a binaryFile scan that selects the path opens no file.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return sorted(row.path for row in listing.select("path").toLocalIterator())


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _ingest(
    spark: SparkSession,
    paths: list[str],
    entity: str,
    bronze_root: str,
    multi_line: bool | None,
    allow_rejects: bool,
) -> str:
    target, rejected = f"{bronze_root}/{entity}", f"{bronze_root}/{REJECTS}/{entity}"
    bad = rejects(spark, paths, entity, multi_line)
    if not bad.isEmpty():
        write_parquet(bad, rejected)
        count = spark.read.parquet(rejected).count()
        message = f"{entity}: {count} malformed records, see {rejected}"
        if not allow_rejects:
            raise ValueError(message)
        warnings.warn(message, stacklevel=3)
    write_parquet(read_export(spark, paths, entity, multi_line), target)
    return target


def ingest_export(
    spark: SparkSession,
    path: str,
    entity: str,
    bronze_root: str,
    multi_line: bool | None = None,
    allow_rejects: bool = False,
) -> str:
    """One CSV file to its entity's Parquet folder; returns the folder.

    Malformed records go to a folder of rejects, and the call raises with their number,
    or, if they are allowed, warns and writes the others.
    """
    return _ingest(spark, [path], entity, bronze_root, multi_line, allow_rejects)


def ingest_folder(
    spark: SparkSession,
    folder: str,
    bronze_root: str,
    multi_line: Mapping[str, bool] | None = None,
    allow_rejects: bool = False,
) -> dict[str, str]:
    """Every CSV file of a folder to Parquet; returns ``{entity or file: folder}``.

    All files of an entity are written together, so that none replaces another.
    Files that match no entity have no common schema and get a folder each.
    ``multi_line`` says by entity whether records may cross lines.
    """
    by_entity: dict[str, list[str]] = {}
    for path in list_exports(spark, folder):
        by_entity.setdefault(entity_of(_name(path)), []).append(path)
    written = {}
    for path in by_entity.pop(UNROUTED, []):
        name = _name(path)
        target = f"{bronze_root}/{UNROUTED}/{name.removesuffix('.csv')}"
        write_parquet(read_unknown_export(spark, path), target)
        written[name] = target
    for entity, paths in by_entity.items():
        crosses = (multi_line or {}).get(entity)
        written[entity] = _ingest(spark, paths, entity, bronze_root, crosses, allow_rejects)
    return written
