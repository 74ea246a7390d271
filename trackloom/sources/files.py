"""CSV, tar and parquet readers, and listings of what lies below a folder."""

import csv
import gzip
import io
import itertools
import sys
import tarfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas

# functions for tasks are shipped by value, so executors do not need this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_states(
    spark: SparkSession, paths: str | list[str], schema: str = schemas.STATES, **options: str
) -> DataFrame:
    """Position reports from CSV or gzipped CSV; a header of other columns is an error."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.options(**options).csv(paths)


def _by_header(spark: SparkSession, paths: str | list[str], schema: str, **options) -> DataFrame:
    """CSV files whose columns may be in any order and have spaces around their names.

    The order is that of the first header; a file with another one is an error. Columns of
    ``schema`` that the files lack are null; columns that it lacks are text.
    """
    named = spark.read.option("header", True).options(**options)
    trim = {"ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    header = [c.strip() for c in named.csv(paths).columns]
    types = dict(schemas.fields(schema))
    layout = ", ".join(f"`{name}` {types.get(name, 'string')}" for name in header)
    read = named.options(**trim).option("enforceSchema", False).schema(layout).csv(paths)
    missing = {n: F.lit(None).cast(t) for n, t in types.items() if n not in header}
    return read.withColumns(missing) if missing else read


def read_history_csv(
    spark: SparkSession, paths: str | list[str], schema: str | None = schemas.HISTORY
) -> DataFrame:
    """Flight history; pass ``schema=None`` to have the types inferred.

    Inference reads the data twice, so a known layout should be given.
    """
    if schema:
        return _by_header(spark, paths, schema)
    return strip_column_names(spark.read.option("header", True).option("inferSchema", True).csv(paths))


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def list_files(
    spark: SparkSession, root: str, pattern: str = "*", **options: str
) -> DataFrame:
    """``path, length, modification_time`` of every file below ``root``.

    The content column of the binary source is pruned, so no file is opened.
    ``options`` such as ``modifiedAfter`` narrow the listing at the source.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .options(**options)
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modification_time"))
    )


def require_files(spark: SparkSession, root: str, pattern: str = "*.{csv,csv.gz}") -> int:
    """Number of matching files below ``root``; an error when there are none."""
    found = list_files(spark, root, pattern).count()
    if not found:
        raise FileNotFoundError(f"no file matching {pattern} below {root}")
    return found


def read_csv_tree(spark: SparkSession, root: str, schema: str | None = schemas.HISTORY) -> DataFrame:
    """Every ``.csv`` and ``.csv.gz`` below ``root``, at any depth."""
    require_files(spark, root)
    options = {"recursiveFileLookup": True, "pathGlobFilter": "*.{csv,csv.gz}"}
    if schema:
        return _by_header(spark, root, schema, **options)
    reader = spark.read.option("header", True).option("inferSchema", True).options(**options)
    return strip_column_names(reader.csv(root))


def _csv_line(values: list[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(values)
    return out.getvalue()


def _in_order(text: Iterable[str], names: list[str]) -> Iterator[str]:
    """Lines behind the header with their columns in the order of ``names``, found by name."""
    header = next(csv.reader([next(iter(text), "")]), [])
    header = [c.strip() for c in header]
    if header == names or not header:
        yield from (line.rstrip("\r\n") for line in text)
        return
    if missing := [n for n in names if n not in header]:
        raise tarfile.ReadError(f"columns are missing: {', '.join(missing)}")
    places = [header.index(n) for n in names]
    for row in csv.reader(text):
        if row:
            yield _csv_line([row[k] if k < len(row) else "" for k in places])


def _tar_lines(batches, names):
    """Lines of the first gzipped CSV of each archive; a broken archive gives its error."""
    schema = pa.schema([("tar_path", pa.string()), ("line", pa.string()), ("error", pa.string())])

    def rows(path, lines=(), error=None):
        lines = list(lines) if error is None else [None]
        columns = [[path] * len(lines), lines, [error] * len(lines)]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)

    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            path = path.as_py()
            try:
                content = content.as_py()
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:") as tar:
                    member = next((m for m in tar if m.name.endswith(".csv.gz")), None)
                    if member is None:
                        continue
                    if member.offset_data + member.size > len(content):
                        raise tarfile.ReadError("archive is cut short")
                    # read to the end once: damage must show before the first line is given
                    with gzip.open(tar.extractfile(member), "rt", encoding="utf-8", newline="") as text:
                        while text.read(4 << 20):
                            pass
                    with gzip.open(tar.extractfile(member), "rt", encoding="utf-8", newline="") as text:
                        lines = _in_order(text, names)
                        while chunk := list(itertools.islice(lines, 50_000)):
                            yield rows(path, chunk)
            except (tarfile.TarError, OSError, EOFError, UnicodeDecodeError, zlib.error) as problem:
                yield rows(path, error=f"{type(problem).__name__}: {problem}")


def read_tar_lines(
    spark: SparkSession, root: str | list[str], schema: str = schemas.STATES, **options: str
) -> DataFrame:
    """``tar_path, line, error`` of every ``*.tar`` below ``root``.

    A line has the columns of ``schema`` in its order, whatever the order in the member's header;
    a header without one of them is an error of its archive. Archives are opened in memory on the executors and handed on in chunks of a few
    MB; nothing is extracted to disk. One archive must fit into a task. A damaged archive
    gives its error and no line. ``options`` such as ``modifiedAfter`` bound the files.
    """
    tars = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.tar")
        .options(**options)
        .load(root)
    )
    names = schemas.names(schema)
    return tars.select("path", "content").mapInArrow(
        lambda batches: _tar_lines(batches, names), "tar_path string, line string, error string"
    )


def tar_states(lines: DataFrame, schema: str = schemas.STATES) -> DataFrame:
    """Typed rows of ``read_tar_lines``, parsed by Spark's own CSV parser."""
    parsed = F.from_csv("line", schema, {"mode": "PERMISSIVE"})
    good = lines.filter(F.col("error").isNull() & (F.length(F.trim("line")) > 0))
    return good.select(parsed.alias("state")).select("state.*")


def tar_errors(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("error").isNotNull()).select("tar_path", "error")


def read_tar_csv(
    spark: SparkSession, root: str, schema: str = schemas.STATES, **options: str
) -> DataFrame:
    """Position reports from tar archives that hold one gzipped CSV each."""
    return tar_states(read_tar_lines(spark, root, schema, **options), schema)


def read_layer(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """A parquet layer. ``since``/``until`` are (year, month) pairs, both inclusive.

    The bounds become predicates on the partition columns, so whole folders are
    skipped.
    """
    df = spark.read.parquet(path)
    for bound, newer in ((since, True), (until, False)):
        if bound is not None:
            year, month = bound
            beyond = F.col("year") > year if newer else F.col("year") < year
            edge = F.col("month") >= month if newer else F.col("month") <= month
            df = df.filter(beyond | ((F.col("year") == year) & edge))
    return df


def read_optional(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame | None:
    """A parquet layer, or None when the folder does not exist. Other errors are raised.

    With a ``schema`` a folder without files is an empty layer.
    """
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def file_path() -> Column:
    """Path of the row's file as listings show it; the metadata column holds it encoded."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn("_source_file", file_path())


def new_files(listing: DataFrame, ledger: DataFrame, key: str = "path", ledger_key: str = "file_path") -> DataFrame:
    """Files of ``listing`` that ``ledger`` does not hold yet."""
    return listing.join(ledger, listing[key] == ledger[ledger_key], "left_anti")


def read_new_files(
    spark: SparkSession, root: str, ledger: DataFrame | None = None, **options: str
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of the parquet files below ``root`` that are not in ``ledger``, and those files.

    Without a ledger everything is read. ``basePath`` keeps the partition columns.
    The paths go through the driver, as they do in every Spark file scan; with very
    many files use ``streaming.serve``, where the file source keeps track itself.
    """
    files = list_files(spark, root, "*.parquet", **options)
    if ledger is None:
        return with_source_file(spark.read.parquet(root)), files
    files = new_files(files, ledger)
    paths = [r.path for r in files.select("path").toLocalIterator()]
    if not paths:
        return None, files
    return with_source_file(spark.read.option("basePath", root).parquet(*paths)), files


def with_line_order(df: DataFrame) -> DataFrame:
    """Adds ``_file``, ``_block`` and ``_line``; sorting by them gives the file's line order.

    The running id alone would not do: splits of one file are not handed out in order.
    """
    return df.withColumns(
        {
            "_file": file_path(),
            "_block": F.col("_metadata.file_block_start"),
            "_line": F.monotonically_increasing_id(),
        }
    )
