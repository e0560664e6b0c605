"""The landing area: which files there are, whose day and role they are, how they are written."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Candidate delimiters in order of preference on ties, and how much is read.
DELIMITERS = (",", ";", "|", "\t")
PEEK_BYTES = 8192
ROLE_MARKS = {"productos": "producto", "sucursales": "sucursal", "comercio": "comercio"}


def day_of(path: Column, root: str) -> Column:
    """The day folder, `YYYY-MM-DD` or `fecha=YYYY-MM-DD`, right below the root."""
    base = re.sub(r"^[a-z0-9]+:/+", "/", root).rstrip("/")
    below = F.substring(path, F.instr(path, base) + F.lit(len(base)), F.lit(1 << 20))
    day = F.regexp_extract(below, r"^/(?:fecha=)?(\d{4}-\d{2}-\d{2})/", 1)
    return F.try_to_date(F.nullif(day, F.lit("")))


def role_of(name: Column) -> Column:
    role = F.lit(None).cast("string")
    for role_name, text in reversed(ROLE_MARKS.items()):
        role = F.when(F.lower(name).contains(text), role_name).otherwise(role)
    return role


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, rol, fecha of every CSV below `root`, null where a file has no known role or no day
    folder. The role is told by the file name, or by the `rol=` folder of files unpacked by
    `archives`. No content is read."""
    path = F.col("path")
    packed_role = F.regexp_extract(path, "/rol=([^/]+)/", 1)
    known = packed_role.isin(list(ROLE_MARKS))
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "{*.csv,*.txt}")
        .load(root)
        .select(
            "path",
            F.when(known, packed_role)
            .when((packed_role == "") & path.endswith(".csv"), role_of(F.substring_index(path, "/", -1)))
            .alias("rol"),
            day_of(path, root).alias("fecha"),
        )
        .where((packed_role != "") | path.endswith(".csv"))
    )


def discover(spark: SparkSession, root: str) -> DataFrame:
    """path, rol, fecha of every CSV of a known role below `root/YYYY-MM-DD/`."""
    return listing(spark, root).where(F.col("rol").isNotNull() & F.col("fecha").isNotNull())


def unplaced(spark: SparkSession, root: str) -> DataFrame:
    """path, motivo of the files that `discover` leaves out."""
    reason = F.when(F.col("fecha").isNull(), "no day folder").when(F.col("rol").isNull(), "unknown role")
    return listing(spark, root).select("path", reason.alias("motivo")).where(F.col("motivo").isNotNull())


def slug(name: str) -> str:
    """Header name to column name: no accents, lower case, other characters to one `_`."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", "_", plain.strip().lower()).strip("_")


def delimiter_of(header: str) -> str:
    """The candidate that occurs most in the header line; a comma if none does."""
    return max(DELIMITERS, key=header.count)


def _first_lines(path: str) -> tuple[str, str]:
    filesystem, name = pafs.FileSystem.from_uri(path)
    with filesystem.open_input_stream(name) as stream:
        data = b""
        # Most headers fit the first read; longer ones are read to their end.
        while data.count(b"\n") < 2:
            chunk = stream.read(PEEK_BYTES)
            if not chunk:
                break
            data += chunk
    lines = data.decode("utf-8", errors="replace").removeprefix("\ufeff").splitlines()
    return (lines + ["", ""])[0], (lines + ["", ""])[1]


def _peek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path in batch["path"]:
            try:
                header, first = _first_lines(path)
            except OSError as error:
                rows.append((None, None, f"unreadable: {error}"))
                continue
            sep = delimiter_of(header)
            # A delimiter at the end of the data lines only is one more, nameless field.
            extra = first.endswith(sep) and first.count(sep) == header.count(sep) + 1
            rows.append((sep, header + (sep if extra else ""), None))
        yield batch.assign(**{name: [r[k] for r in rows] for k, name in enumerate(("sep", "header", "motivo"))})


def detect_dialect(files: DataFrame) -> DataFrame:
    """Adds `sep`, `header` and `motivo` to a frame of paths; `motivo` says why a file could not be
    read, and is null for all others. Tasks read the first lines of each file."""
    columns = ", ".join(f"{name} {kind}" for name, kind in files.dtypes)
    spread = files.repartition(F.col("path"))
    return spread.mapInPandas(_peek, f"{columns}, sep string, header string, motivo string")


# The functions that run in tasks travel with the plan; workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
