"""The nine input tables: their columns, and loading them in a normal form."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType

# Input columns and types per table; nothing is inferred.
# A number of the source's own type: nothing is rounded.
HOURS = "number"
SCHEMAS: dict[str, dict[str, str]] = {
    "year_terms": {"yr_cde": "string", "trm_cde": "string", "trm_begin_dte": "date", "trm_end_dte": "date"},
    "courses": {
        "id_num": "bigint",
        "yr_cde": "string",
        "trm_cde": "string",
        "grade_cde": "string",
        "transaction_sts": "string",
        "credit_hrs": HOURS,
        "hrs_attempted": HOURS,
        "credit_type_cde": "string",
    },
    "candidacy": {
        "id_num": "bigint",
        "yr_cde": "string",
        "trm_cde": "string",
        "load_p_f": "string",
        "candidacy_type": "string",
    },
    "degrees": {
        "id_num": "bigint",
        "entry_dte": "date",
        "exit_dte": "date",
        "dte_degr_conferred": "date",
        "withdrawal_dte": "date",
        "exit_reason": "string",
        "major_1": "string",
        "major_2": "string",
        "concentration_1": "string",
        "degr_cde": "string",
        "div_cde": "string",
    },
    "majors": {"major_cde": "string", "degr_cde": "string"},
    "cohort": {"id_num": "bigint"},
    "code_map": {
        "map_code": "string",
        "college": "string",
        "degree": "string",
        "major": "string",
        "concentration": "string",
        "program": "string",
    },
    "degree_map": {"degree_code": "string", "college": "string", "degree": "string", "program": "string"},
    "external_ids": {"external_id": "string", "pidm": "bigint"},
}


@dataclass(frozen=True)
class Sources:
    """The input tables as DataFrames.

    ``year_terms``   academic terms with begin and end
    ``courses``      course registrations of every student
    ``candidacy``    declared load per student and term
    ``degrees``      degree records with their milestone dates
    ``majors``       degree of each major
    ``cohort``       the students to convert
    ``code_map``     target codes by degree + major + concentration (active students)
    ``degree_map``   target codes by degree (other students)
    ``external_ids`` student id as text -> target id
    """

    year_terms: DataFrame
    courses: DataFrame
    candidacy: DataFrame
    degrees: DataFrame
    majors: DataFrame
    cohort: DataFrame
    code_map: DataFrame
    degree_map: DataFrame
    external_ids: DataFrame

    @classmethod
    def read(
        cls,
        table: Callable[[str], DataFrame],
        names: Mapping[str, str] | None = None,
        columns: Mapping[str, Mapping[str, str]] | None = None,
        upper: bool = False,
    ) -> Sources:
        """Load every table with ``table(name)`` and bring it into normal form.

        ``names`` gives the stored name of a table and ``columns`` the stored name of its columns
        where they differ, so any Spark source works: ``spark.table``, ``spark.read.parquet`` on a
        path, or a JDBC reader.
        """
        names, columns = names or {}, columns or {}
        return cls(
            **{
                f.name: conform(table(names.get(f.name, f.name)), f.name, columns.get(f.name), upper)
                for f in fields(cls)
            }
        )

    @classmethod
    def parquet(cls, spark: SparkSession, directory: str, **options) -> Sources:
        """Load ``<directory>/<table>.parquet``."""
        return cls.read(lambda name: spark.read.parquet(f"{directory}/{name}.parquet"), **options)


def conform(
    df: DataFrame, table: str, columns: Mapping[str, str] | None = None, upper: bool = False
) -> DataFrame:
    """Select a table's columns with their declared types and normalised codes."""
    columns = columns or {}

    def typed_column(name: str, kind: str) -> Column:
        stored = columns.get(name, name)
        if kind == HOURS:
            kind = number_type(df.select(stored).schema[0].dataType)
        return F.col(stored).cast(kind).alias(name)

    typed = [typed_column(name, kind) for name, kind in SCHEMAS[table].items()]
    return normalize_codes(df.select(*typed), upper)


def number_type(stored: DataType) -> str:
    """The type in which a number is exact: decimals and doubles as they are, whole numbers as longs."""
    if isinstance(stored, (DecimalType, DoubleType)):
        return stored.simpleString()
    return {"float": "double", "string": "decimal(38,10)"}.get(stored.typeName(), "bigint")


def normalize_codes(df: DataFrame, upper: bool = False) -> DataFrame:
    """Cut trailing blanks (and upper-case on request), so that codes compare as plain text."""

    def clean(name: str):
        trimmed = F.rtrim(F.col(name))
        return F.upper(trimmed) if upper else trimmed

    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(*[clean(c).alias(c) if c in text else F.col(c) for c in df.columns])

