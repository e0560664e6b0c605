"""Tolerant reading of the raw delimited files of one role."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola.config import RAW_COLUMNS
from gondola.sources.landing import day_of, detect_dialect, discover, slug

# Texts that mean a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
           "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

BAD_LINE = "_corrupt_record"
REJECT_SCHEMA = "path string, motivo string"


def _names(header: str, sep: str) -> list[str]:
    """Slugs of the header fields, made unique; nameless fields get a name of their own."""
    names: list[str] = []
    for position, field in enumerate(header.split(sep)):
        name = slug(field.strip('"')) or f"_campo{position}"
        names.append(name if name not in names else f"{name}_{position}")
    return names


def _too_long(sep: str, first: str, fields: int) -> Column:
    """A line with more fields than the header; shorter ones are padded and kept."""
    unquoted = F.regexp_replace(BAD_LINE, '"[^"]*"', "")
    separators = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit("")))
    # The reader refuses queries that need the bad line alone, as a plain count would; the
    # first field is read along with it.
    read_too = F.coalesce(F.length(first), F.lit(0)) >= 0
    return F.coalesce((separators >= fields) & read_too, F.lit(False))


def _read_group(
    spark: SparkSession, paths: list[str], sep: str, names: list[str], wanted: list[str], root: str
) -> DataFrame:
    """Files that share delimiter and header, read with one all-text schema. All columns are
    parsed, since a pruned parser does not notice lines of the wrong length."""
    schema = ", ".join(f"`{n}` string" for n in [*names, BAD_LINE])
    rows = (
        spark.read.schema(schema)
        .options(sep=sep, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE,
                 quote='"', escape='"', encoding="UTF-8", columnPruning=False)
        .csv(paths)
    )
    present = [n for n in wanted if n in names]
    return (
        rows.select(
            day_of(F.col("_metadata.file_path"), root).alias("fecha"),
            # The position in the source, taken at the scan, before any shuffle.
            F.struct(
                F.col("_metadata.file_path").alias("archivo"),
                F.col("_metadata.file_block_start").alias("bloque"),
                F.monotonically_increasing_id().alias("linea"),
            ).alias("orden"),
            BAD_LINE,
            *present,
        )
        .where(~_too_long(sep, names[0], len(names)))
        .select(
            "fecha", "orden",
            *[F.when(~F.col(n).isin(list(MISSING)), F.col(n)).alias(n) for n in present],
        )
    )


def read_role(
    spark: SparkSession, role: str, root: str, files: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of one role. Rows have fecha, orden, the core columns and all optional
    ones, null where a file lacks them. A file without a core column, and one whose header
    cannot be read, is rejected, and the others are read.

    The dialects, one small record per file, are gathered on the driver, which needs the
    paths anyway to plan the scans; the scan of each dialect stays lazy.
    """
    core, optional = RAW_COLUMNS[role]
    wanted = [*core, *optional]
    if files is None:
        files = discover(spark, root)
    dialects, rejects = defaultdict(list), []
    for file in detect_dialect(files.where(F.col("rol") == role)).collect():
        if file["motivo"] is None:
            dialects[(file["sep"], file["header"])].append(file["path"])
        else:
            rejects.append((file["path"], file["motivo"]))

    rows = []
    for (sep, header), paths in sorted(dialects.items()):
        names = _names(header, sep)
        missing = [c for c in core if c not in names]
        if missing:
            rejects += [(path, f"missing columns: {', '.join(missing)}") for path in paths]
        else:
            rows.append(_read_group(spark, sorted(paths), sep, names, wanted, root))

    empty = spark.createDataFrame(
        [],
        "fecha date, orden struct<archivo: string, bloque: bigint, linea: bigint>, "
        + ", ".join(f"{c} string" for c in wanted),
    )
    result = empty
    for frame in rows:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result, spark.createDataFrame(rejects, REJECT_SCHEMA)
