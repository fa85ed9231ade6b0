"""CSV without a schema (O1): types from all rows, malformed rows set aside.

Two scans.  The first reads every field as text and asks, in one aggregate,
which types every value of a column has; the second reads the file again with
these types.  The lattice, narrowest first: boolean (true/false, t/f), int, bigint,
double, date (yyyy-MM-dd), timestamp, string.  A column gets the first type
that all its values have; an empty field is missing and fits every type; a
column without values is text.

A row with too few or too many fields is malformed.  It takes no part in the
types; its whole line is in the quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelab.functions.columns import qcol

CORRUPT = "_corrupt_record"

_WHOLE = r"^[+-]?[0-9]{1,19}$"
_REAL = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"


def _flag(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.isin("t", "true"), True).when(low.isin("f", "false"), False)


def _readers(c: Column) -> dict[str, Column]:
    """What a text value is under each type, null where it is none."""
    whole = F.when(c.rlike(_WHOLE), c)
    return {"boolean": _flag(c), "int": whole.try_cast("int"), "bigint": whole.try_cast("bigint"),
            "double": F.when(c.rlike(_REAL), c).try_cast("double"),
            "date": F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c).try_cast("date"),
            "timestamp": F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}"), c).try_cast("timestamp")}


@dataclass
class CsvScan:
    rows: DataFrame              # typed
    quarantine: DataFrame        # (line) of each malformed row
    types: dict[str, str]


def scan_csv(spark: SparkSession, path: str | list[str], names: list[str] | None = None) -> CsvScan:
    """Read CSV files with a header row, or without one under ``names``."""
    header = names is None
    if header:
        names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    # every field of a row is parsed whatever a query selects: a parser that
    # skips fields cannot tell a row of too many or too few of them
    text = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True)
            .option("escape", '"').csv(path))        # a quote inside quotes is doubled
    # Spark refuses queries of the corrupt column alone; this condition, always true, names the others
    parsed = F.length(F.concat_ws("", *[qcol(n) for n in names])) >= 0
    good = text.where(F.col(CORRUPT).isNull() & parsed)
    checks = []
    for i, n in enumerate(names):
        for kind, read in _readers(qcol(n)).items():
            # bool_and ignores nulls, so missing values fit every type
            checks.append(F.bool_and(F.when(qcol(n).isNotNull(), read.isNotNull())).alias(f"{i}:{kind}"))
    fits = good.agg(*checks).first()
    types = {n: next((k for k in _readers(F.lit("")) if fits[f"{i}:{k}"]), "string") for i, n in enumerate(names)}
    typed = [(_readers(qcol(n))[t] if t != "string" else qcol(n)).alias(n) for n, t in types.items()]
    quarantine = text.where(F.col(CORRUPT).isNotNull() & parsed).select(F.col(CORRUPT).alias("line"))
    return CsvScan(good.select(*typed), quarantine, types)
