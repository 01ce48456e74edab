"""Batch reads with declared schemas (CSV, JSON array, parquet).

One call reads one delivery: the path is an argument and never a folder glob, so a rerun
never re-reads older files. ``batch_id`` stamps the delivery on every row (``_batch``), the
lineage column the downstream batch metrics group by.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import BATCH_COL, TRANSACTION_SCHEMA


#: Holds the text of a record that did not parse as declared; NULL for all others.
CORRUPT_COL = "_corrupt_record"


def read_batch(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
               batch_id: int | None = None, header: bool = True, keep_text: bool = False) -> DataFrame:
    """One delivery with the declared schema. A value that does not parse becomes NULL (rules catch
    it); ``keep_text`` adds ``CORRUPT_COL`` with the text of every record that has such a value, too
    few or too many fields, or no structure at all (see ``split_unparsed``)."""
    if keep_text:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])
    if fmt == "csv":
        # All columns are parsed with the text kept, so a record's fields are counted whatever is selected.
        reader = spark.read.schema(schema).option("header", header)
        df = reader.option("columnNameOfCorruptRecord", CORRUPT_COL).csv(path) if keep_text else reader.csv(path)
    elif fmt == "json":
        # the landing JSON is one array of records, not newline-delimited
        df = read_json_array(spark, path, schema, keep_text)
    elif fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    if batch_id is not None:
        df = df.withColumn(BATCH_COL, F.lit(batch_id).cast("int"))
    return df


def split_unparsed(df: DataFrame, corrupt: str = CORRUPT_COL) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, without the text column; rows that did not, with it)."""
    return df.filter(F.col(corrupt).isNull()).drop(corrupt), df.filter(F.col(corrupt).isNotNull())


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of every record of a file that is one JSON array of objects.

    The file is cut at the separator between its first two records, as a line separator, so it is
    read in splits by many tasks; each piece gets back the brackets that the cut took. A separator
    with a line end cannot occur inside a record's strings (JSON escapes line ends), a separator
    without one is taken up to the first field's name, whose quote could not stand in a string
    either. Only the head of the file is looked at to find it. Records must be separated alike, as
    one writer does; what does not parse on its own is reported as such, with its text. The last
    field of a record may not be a list of objects.
    """
    separator = _separator(spark, path)
    if separator is None:
        pieces = spark.read.text(path, wholetext=True)
    else:
        pieces = spark.read.option("lineSep", separator).text(path)
    opening = "" if separator is None else separator[separator.index("{"):]
    piece, blank = F.col("value"), F.lit(" \t\n\r")
    first = F.ltrim(piece, blank).startswith("[")
    last = F.rtrim(piece, blank).rlike(r"(\}|^\s*\[)\s*\]$")
    start = F.when(first, F.regexp_replace(piece, r"^\s*\[", "")).otherwise(F.concat(F.lit(opening), piece))
    whole = F.when(last, F.regexp_replace(start, r"\]\s*$", "")).otherwise(F.concat(start, F.lit("}")))
    return pieces.select(F.btrim(whole, blank).alias("record")).filter(F.col("record") != "")


_NEXT = re.compile(r'\s*,\s*\{(\s*"(?:[^"\\]|\\.)*")')


def _separator(spark: SparkSession, path: str) -> str | None:
    """What stands between the first two records; None if there are not two."""
    pieces, found = 16, None
    while True:
        rows = spark.read.option("lineSep", "}").text(path).limit(pieces).collect()
        head = "}".join(r.value for r in rows) + ("}" if len(rows) == pieces else "")
        start = head.find("{")
        try:
            end = json.JSONDecoder(strict=False).raw_decode(head, start)[1] if start >= 0 else None
            found = _NEXT.match(head, end) if end is not None else None
        except json.JSONDecodeError:
            # (a first record that does not parse: its fields' end is taken from the layout)
            found = re.search(r'\}\s*\n\s*,?\s*,\s*\{|\}\s*,\s*\n\s*\{', head)
            if found:
                return found.group()
        if found:
            text = head[end - 1:found.end()]
            cut = text[:text.index("{") + 1]
            return cut if "\n" in cut else text
        if len(rows) < pieces:
            return None
        pieces *= 8


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, keep_text: bool = False) -> DataFrame:
    """The records of a JSON array file with the declared schema; with ``keep_text``, its last field
    is ``CORRUPT_COL``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    parsed = json_records(spark, path).select("record", F.from_json("record", schema, options).alias("r"))
    fields = [F.col(f"r.`{f.name}`").alias(f.name) for f in schema if f.name != CORRUPT_COL]
    if keep_text:
        # (a record that is no object parses to nothing)
        fields.append(F.when(F.col("r").isNull(), F.col("record")).otherwise(F.col(f"r.{CORRUPT_COL}")).alias(CORRUPT_COL))
    return parsed.select(*fields)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_strings(spark: SparkSession, path: str, fmt: str = "csv",
                 names: Sequence[str] = tuple(f.name for f in TRANSACTION_SCHEMA)) -> DataFrame:
    """All columns as strings (for checks of a raw file: nothing is coerced to NULL, and a timestamp
    keeps its zone). JSON needs the ``names`` of the declared fields."""
    if fmt == "csv":
        return spark.read.option("header", True).csv(path)
    if fmt == "json":
        return read_json_array(spark, path, _text_schema(names))
    raise ValueError(f"unsupported format {fmt!r}")


def read_keys(spark: SparkSession, path: str, key: str = "transaction_id", fmt: str = "csv") -> DataFrame:
    """Key-only read of one delivery; the scan prunes every other column."""
    if fmt == "csv":
        return spark.read.option("header", True).csv(path).select(key)
    if fmt == "json":
        return read_json_array(spark, path, _text_schema([key]))
    if fmt == "parquet":
        return spark.read.parquet(path).select(key)
    raise ValueError(f"unsupported format {fmt!r}")
