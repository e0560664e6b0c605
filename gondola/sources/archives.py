"""Nested ZIP landing: a daily archive holds one archive per chain, which holds CSV files.

Packed files are read by the data source of `zips`, each by a task of its own. Text travels in
chunks of whole lines and is written by Spark as `fecha=…/paquete=…/rol=…/pieza=…/` folders, which `landing.discover` understands.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.sources import zips
from gondola.sources.landing import role_of
from gondola.sources.shared import intermediate, materialize, spare_disk

CHUNK_BYTES = 1 << 20
PIECE_CHUNKS = 64
# Fixed pattern: a date in the name of a packed file or folder.
DATE = r"(20\d{2})[-_/](\d{2})[-_/](\d{2})"


def expand_archives(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(files, rejects) of the daily archives below `root`: files has archivo, paquete, nombre,
    parte, texto; rejects has archivo, paquete, nombre, motivo (an action).

    Every packed file is a task of its own, which streams it from its range of the archive into
    one stored table. A checksum is known only at the end of a member, when parts of it have
    gone out already; so whatever belongs to an archive or package that failed anywhere is
    taken out afterwards."""
    spark.dataSource.register(zips.ZipSource)
    unpacked = materialize(
        spark.read.format("packed_csv").options(chunkbytes=CHUNK_BYTES, piecechunks=PIECE_CHUNKS).load(root),
        "unpacked",
    )
    bad = F.col("motivo").isNotNull()
    # Written, so that their real size decides how the texts meet them.
    rejects = materialize(unpacked.where(bad).select("archivo", "paquete", "nombre", "motivo"), "unreadable")
    archives = rejects.where(F.col("paquete").isNull()).select("archivo").distinct()
    packages = rejects.where(F.col("paquete").isNotNull()).select("archivo", "paquete").distinct()
    files = (
        unpacked.where(~bad).drop("motivo")
        .join(archives, "archivo", "left_anti").join(packages, ["archivo", "paquete"], "left_anti")
    )
    return files, rejects


def content_date(names: DataFrame) -> DataFrame:
    """archivo, fecha: the date found most often in the packed names of an archive (the latest
    on ties), each package and each file counting once, else the one in the archive's own name;
    null where neither has one."""
    def date_in(column: str):
        parts = [F.regexp_extract(column, DATE, group) for group in (1, 2, 3)]
        return F.try_to_date(F.nullif(F.concat_ws("-", *parts), F.lit("--")))

    last = F.substring_index("n", "/", -1)
    packages = names.select("archivo", "paquete", F.col("paquete").alias("n")).distinct().select("archivo", last.alias("n"))
    files = names.select("archivo", "paquete", "nombre").distinct().select("archivo", F.substring_index("nombre", "/", -1).alias("n"))
    dated = packages.union(files).select("archivo", date_in("n").alias("fecha"))
    votes = dated.groupBy("archivo", "fecha").agg(F.count("fecha").alias("votos"))
    return votes.groupBy("archivo").agg(
        F.coalesce(
            F.max_by("fecha", F.struct("votos", "fecha")),
            F.first(date_in("archivo")),
        ).alias("fecha")
    )


def _replace_days(spark: SparkSession, staged: str, out: str) -> None:
    """Put each staged day in the place of the day stored before, if any."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(out)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for status in system.listStatus(hadoop.Path(staged)):
        if status.isDirectory():
            day = hadoop.Path(target, status.getPath().getName())
            system.delete(day, True)
            system.rename(status.getPath(), day)
    system.delete(hadoop.Path(staged), True)


def unpack(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Write the packed CSV files as a landing area and return what was left out, each with its
    reason: archivo, paquete, nombre, motivo (an action).

    Of several archives with one content date the one whose path comes last is taken, and its
    day replaces the day stored before as a whole. Files keep the archive and their full name
    apart by a hash, so that names which differ in odd characters only do not meet. The unpacked
    texts are removed at the end."""
    with intermediate(spark), spare_disk(spark):
        return _unpack(spark, root, out)


def _unpack(spark: SparkSession, root: str, out: str) -> DataFrame:
    files, failed = expand_archives(spark, root)
    names = materialize(files.select("archivo", "paquete", "nombre").distinct(), "packed-names")
    dates = materialize(content_date(names), "archive-dates")
    chosen = materialize(
        dates.where(F.col("fecha").isNotNull()).groupBy("fecha").agg(F.max("archivo").alias("archivo")), "chosen-archives"
    )
    role = role_of(F.substring_index("nombre", "/", -1))
    judged = names.join(dates, "archivo").join(
        chosen.select("archivo", F.lit(True).alias("_chosen")), "archivo", "left"
    )
    reason = (
        F.when(F.col("fecha").isNull(), "no content date")
        .when(F.col("_chosen").isNull(), "another archive has the same content date")
        .when(role.isNull(), "unknown role")
    )
    rejects = materialize(
        failed.union(judged.where(reason.isNotNull()).select("archivo", "paquete", "nombre", reason)),
        "rejected-archives",
        kept=True,
    )
    label = F.concat_ws("/", "paquete", "nombre")
    laid = (
        files.join(chosen, "archivo")
        .select(
            "fecha",
            F.concat_ws(
                "_", F.regexp_replace(label, r"[^A-Za-z0-9-]+", "_"), F.hex(F.xxhash64("archivo", "paquete", "nombre"))
            ).alias("paquete"),
            role.alias("rol"),
            F.format_string("%06d", F.floor(F.col("parte") / PIECE_CHUNKS)).alias("pieza"),
            "parte", "texto",
        )
        .where(F.col("rol").isNotNull())
        .repartition("fecha", "paquete", "rol", "pieza")
        .sortWithinPartitions("fecha", "paquete", "rol", "pieza", "parte")
        .drop("parte")
    )
    staged = f"{out.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    laid.write.partitionBy("fecha", "paquete", "rol", "pieza").format("text").save(staged)
    _replace_days(spark, staged, out)
    return rejects
