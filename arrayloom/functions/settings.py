"""Settings: of the session, or given as text.

``spark.arrayloom.swmrDefault`` (false): what ``swmr`` is where a read does not say. ``spark.arrayloom.batchSize``
(10MB): bytes of a batch of the full scan. ``spark.arrayloom.valueMemoryLimit`` (64MB, or none): memory of one
value of ``read_value``. A call's own argument goes before the session's setting.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from arrayloom.model import ArrayFileError

#: Powers of memory units, decimal and binary.
UNITS = {"": 1, "B": 1, "KB": 10**3, "MB": 10**6, "GB": 10**9, "TB": 10**12, "KIB": 2**10, "MIB": 2**20, "GIB": 2**30, "TIB": 2**40}


def memory(text: int | str, name: str) -> int:
    """Bytes of "64MB", "1 GiB" or a number."""
    m = re.fullmatch(r"\s*([0-9]*\.?[0-9]+)\s*([A-Za-z]*)\s*", str(text))
    unit = UNITS.get(m[2].upper()) if m else None
    if unit is None or float(m[1]) * unit < 1:
        raise ArrayFileError(f"Invalid value for {name}: {text}")
    return int(float(m[1]) * unit)


def memory_limit(text: int | str | None) -> int | None:
    """A limit in bytes, or None for no limit."""
    return None if text is None or str(text).strip().lower() == "none" else memory(text, "value read memory limit")


def batch_size(text: int | str) -> int:
    """Bytes of a batch, a gigabyte at most."""
    return min(memory(text, "batch size"), 10**9)


SWMR, BATCH, LIMIT = "spark.arrayloom.swmrDefault", "spark.arrayloom.batchSize", "spark.arrayloom.valueMemoryLimit"


def setting(spark: SparkSession | None, name: str, default: str) -> str:
    spark = spark or SparkSession.getActiveSession()
    return spark.conf.get(name, default) if spark else default


def swmr(spark: SparkSession | None, option: bool | None) -> bool:
    """The option, or the session's default."""
    if option is not None:
        if not isinstance(option, bool):
            raise ArrayFileError(f"swmr must be true or false: {option}")
        return option
    text = setting(spark, SWMR, "false").strip().lower()
    if text not in ("true", "false"):
        raise ArrayFileError(f"Invalid value for {SWMR}: {text}")
    return text == "true"
