"""The public surface: tables from files, definitions of their columns, and functions of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom import __version__
from arrayloom.functions import settings
from arrayloom.functions.definitions import alias, attr, index, ree, rse
from arrayloom.functions.rowwise import attributes_value, ls_swmr_value, ls_value, read_value
from arrayloom.model import ArrayFileError
from arrayloom.plans.bind import bind
from arrayloom.sources.datasource import register_source
from arrayloom.sources.listing import attributes, ls, tree
from arrayloom.sources.paths import first_file
from arrayloom.sources.scan import scan


def read(spark: SparkSession, files, *definitions, filename=False, mode: str = "auto", swmr: bool | None = None, range_rows: int | None = None, rows_read=None) -> DataFrame:
    """Datasets side by side as columns, file after file.

    Rows are as many as the shortest dataset has; scalars are repeated; run-encoded columns are expanded; the
    index counts from 0 in each file. ``mode`` is "late", "full" or "auto". ``swmr`` (else the session's default) is
    accepted, as a file that another process appends to is read as it is when the read is bound. ``rows_read``
    is an accumulator that is told how many values of datasets are read.
    """
    settings.swmr(spark, swmr)
    return scan(spark, bind(files, definitions, filename, spark), mode, range_rows, rows_read)


def version():
    """A column of the versions in use."""
    import pyspark

    return F.struct(F.lit(__version__).alias("engine"), F.lit("1.0").alias("format"), F.lit(pyspark.__version__).alias("spark"))


def register(spark: SparkSession) -> None:
    """SQL functions read_value, ls_value, ls_swmr_value, attributes_value over (file, path), and the format ``arrayloom``."""
    register_source(spark)
    for name, f in (("read_value", read_value()), ("ls_value", ls_value()), ("ls_swmr_value", ls_swmr_value()), ("attributes_value", attributes_value())):
        spark.udf.register(name, f)


__all__ = ["ArrayFileError", "alias", "attr", "attributes", "attributes_value", "first_file", "index", "ls", "ls_swmr_value", "ls_value", "read", "read_value", "ree", "register", "rse", "tree", "version"]
