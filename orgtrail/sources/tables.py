"""Registry tables at rest: Parquet with a known schema."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, StructType

from orgtrail.schemas import REGISTRY, SHAPES

#: Files that an error names.
SHOWN = 3


def _missing(wanted: DataType, found: DataType, path: str) -> list[str]:
    """What ``found`` lacks of ``wanted``, whatever its nullability and extra fields."""
    if isinstance(wanted, StructType) and isinstance(found, StructType):
        there = {field.name: field.dataType for field in found}
        gaps = []
        for field in wanted:
            name = f"{path}.{field.name}".lstrip(".")
            if field.name not in there:
                gaps.append(f"{name} is missing")
            else:
                gaps += _missing(field.dataType, there[field.name], name)
        return gaps
    if isinstance(wanted, ArrayType) and isinstance(found, ArrayType):
        return _missing(wanted.elementType, found.elementType, f"{path}[]")
    if wanted != found:
        return [f"{path} is {found.simpleString()}, not {wanted.simpleString()}"]
    return []


def file_schema(spark: SparkSession, path: str, wanted: StructType) -> StructType:
    """The schema that all files of a table share; Spark reads their footers in tasks and merges them.

    Files of other types than the rest are named with what is wrong in them.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except (PySparkException, Py4JJavaError) as error:
        odd = _odd_files(spark, path, wanted)
        if not odd:
            raise
        raise ValueError(f"{path}: {'; '.join(odd)}") from error


def _odd_files(spark: SparkSession, path: str, wanted: StructType) -> list[str]:
    """The first files that lack something of ``wanted``; only once merging has failed."""
    odd = []
    # Of binary files only the names are asked for: no contents are read.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").orderBy("path")
    for row in files.toLocalIterator():
        gaps = _missing(wanted, spark.read.parquet(row["path"]).schema, "")
        if gaps:
            odd.append(f"{row['path'].rsplit('/', 1)[-1]}: {', '.join(gaps)}")
        if len(odd) == SHOWN:
            break
    return odd


def scan(
    spark: SparkSession, path: str, schema: StructType | tuple[StructType, ...], strict: bool = True
) -> DataFrame:
    """A Parquet table with a fixed schema, or the first of several shapes that its files have.

    ``strict`` compares it with the schema of all files first, so that a renamed or retyped column
    is an error instead of a column of nulls, also in a single file. A column that some files have
    and others lack reads as null in these.
    """
    shapes = schema if isinstance(schema, tuple) else (schema,)
    if not strict:
        return spark.read.schema(shapes[0]).parquet(path)
    found = file_schema(spark, path, shapes[0])
    gaps = [_missing(shape, found, "") for shape in shapes]
    fitting = [shape for shape, lacks in zip(shapes, gaps) if not lacks]
    if not fitting:
        raise ValueError(f"{path}: {'; '.join(min(gaps, key=len))}")
    return spark.read.schema(fitting[0]).parquet(path)


def scan_registry(spark: SparkSession, base: str | dict[str, str], name: str, strict: bool = True) -> DataFrame:
    """A registry table by name: under a base folder, or at its own path of a dictionary.

    A dictionary may have a folder for all other tables under ``""``.
    """
    if isinstance(base, dict):
        path = base.get(name) or f"{base[''].rstrip('/')}/{name}"
    else:
        path = f"{base.rstrip('/')}/{name}"
    return scan(spark, path, SHAPES.get(name, REGISTRY[name]), strict)
