"""Delimited table dumps: tab-separated, backslash escapes, ``\\N`` for NULL, no header.

Spark's CSV reader folds an empty field into NULL as soon as ``nullValue`` is set
and leaves the escapes in place, so dumps are read as text lines and decoded with
built-in string functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.layers import conform

PATTERN = "*.tsv.zst"
NULL_FIELD = r"\N"
NUL = "\0"

# The escape letters of the dump dialect and what they stand for.
ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}


# Only values of these types can hold characters a dump escapes.
_FREE_TEXT = (T.StringType, T.BinaryType, T.VariantType)


def _decode(field: Column, kind: T.DataType) -> Column:
    """Undo the escapes of one field.

    A dump escapes NUL characters, so in a field without any, NUL can stand for an
    escaped backslash while the other escapes are replaced: plain string
    replacement, compiled.  The few fields that do hold a NUL are split on the
    escaped backslash instead, which leaves pieces no replacement can confuse.
    """
    if not isinstance(kind, _FREE_TEXT):
        return F.when(field != NULL_FIELD, field)
    quick = _unescape(F.replace(field, F.lit("\\\\"), F.lit(NUL)), [c for c in ESCAPES if c != "0"])
    quick = F.replace(quick, F.lit(NUL), F.lit("\\"))
    split = F.array_join(F.transform(F.split(field, r"\\\\"), lambda piece: _unescape(piece, list(ESCAPES))), "\\")
    has_nul = F.contains(field, F.lit("\\0")) | F.contains(field, F.lit(NUL))
    return (
        F.when(~F.contains(field, F.lit("\\")), field)
        .when(field == NULL_FIELD, F.lit(None).cast("string"))
        .when(has_nul, split)
        .otherwise(quick)
    )


def _unescape(text: Column, letters: list[str]) -> Column:
    """Replace the given escapes; a backslash before any other character just goes."""
    for letter in letters:
        text = F.replace(text, F.lit("\\" + letter), F.lit(ESCAPES[letter]))
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _encode(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.VariantType):
        text = F.to_json(col)  # a cast would drop the quotes of a JSON string
    elif isinstance(kind, T.BinaryType):
        text = F.base64(col)
    else:
        text = col.cast("string")
    if isinstance(kind, _FREE_TEXT):
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for letter, char in ESCAPES.items():
            text = F.replace(text, F.lit(char), F.lit("\\" + letter))
    return F.coalesce(text, F.lit(NULL_FIELD))


def read_dump(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str = PATTERN,
    with_file: bool = False,
    base64: Sequence[str] = (),
) -> DataFrame:
    """Read the data files under ``path`` that match ``pattern``, by column position.

    A directory without a matching file and a line with the wrong number of
    fields are errors.  One compressed file is one task, so dumps should come in
    chunks (64 MB is usual).  Binary columns named in ``base64`` are decoded from
    that form, as ``write_dump`` writes them; others are the bytes of the field.
    """
    lines = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
    if not _any_file(spark, path, pattern):
        raise FileNotFoundError(f"no {pattern} data files in {path}")
    width = len(schema.fields)
    fields = F.split(F.col("value"), "\t", -1)
    checked = F.when(F.size(fields) == width, fields).otherwise(
        F.raise_error(
            F.concat(F.lit(f"expected {width} fields, found "), F.size(fields).cast("string"))
        ).cast("array<string>")
    )
    parts = lines.select(checked.alias("f"), F.col("_metadata.file_path").alias("_SRC_FILE"))
    coded = {c.upper() for c in base64}

    def field(i: int, f: T.StructField) -> Column:
        col = _decode(F.col("f")[i], f.dataType)
        return (F.unbase64(col) if f.name.upper() in coded else col).alias(f.name)

    text = parts.select(*[field(i, f) for i, f in enumerate(schema.fields)], "_SRC_FILE")
    if with_file:
        schema = T.StructType([*schema.fields, T.StructField("_SRC_FILE", T.StringType())])
    return conform(text, schema)


def _any_file(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether the folder has a matching file; stops at the first."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    names = hadoop.GlobFilter(pattern)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration()).listStatusIterator(folder)
    while files.hasNext():
        status = files.next()
        if status.isFile() and names.accept(status.getPath()):
            return True
    return False


def write_dump(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write ``df`` in the dump dialect, one line per row.

    Spark reads zstd text but has no built-in codec to write it.  Uncompressed
    files can be split by the reader, compressed ones cannot.  Text cannot hold
    every byte, so binary columns are written as base64; name them to ``read_dump``.
    """
    cells = [_encode(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    line = F.concat_ws("\t", *cells).alias("value")
    df.select(line).write.mode("errorifexists").option("lineSep", "\n").option(
        "compression", compression
    ).text(path)
