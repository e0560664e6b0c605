"""The registered queries: every operator run over the driver's tables.

Tables that several queries start from (comparable rows, star tables, audited raw rows, the
quality log) are built once per session and data folder and kept as written tables, as the
pipeline itself does between its stages.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola import fixtures
from gondola.config import CLEAN_COLUMNS
from gondola.functions import size, text, units
from gondola.operators import checks, compare, diagnostics, enrich, facts, findings, quality, sampling, texts
from gondola.plans import clean as clean_plan, star as star_plan
from gondola.sources import archives, landing, raw, tables as stored, zips
from gondola.sources.shared import intermediate, materialize, new_path, spare_disk


class Tables:
    """The tables of one data folder in one session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def clean(self) -> DataFrame:
        return fixtures.clean_prices(self.spark, self.sf_dir)

    @cached_property
    def dim(self) -> DataFrame:
        return materialize(fixtures.dim_items(self.spark, self.sf_dir), "dim_item")

    @cached_property
    def annotated(self) -> DataFrame:
        return compare.annotate_comparable(self.clean, self.dim)

    @cached_property
    def rows(self) -> DataFrame:
        """Comparable rows, without the text columns that the facts do not read."""
        needed = [*facts.PRICE_GRAIN, "ean", "precio_unitario"]
        return materialize(compare.comparable(self.annotated).select(*needed), "comparable")

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return star_plan.build_star(self.rows, self.dim)

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.raw_productos(self.spark, self.sf_dir)

    @cached_property
    def audited(self) -> DataFrame:
        with intermediate(self.spark):
            staged = materialize(clean_plan.typed(self.raw), "staged")
            rows = clean_plan.audit_staged(
                staged,
                fixtures.raw_sucursales(self.spark, self.sf_dir, staged),
                fixtures.raw_comercio(self.spark, self.sf_dir),
                order=F.struct("orden.l_orderkey", "orden.l_linenumber"),
            )
            return materialize(rows, "audited", kept=True)

    @cached_property
    def quality(self) -> DataFrame:
        return materialize(quality.quality_metrics(self.audited), "quality")

    @cached_property
    def coverage(self) -> DataFrame:
        return diagnostics.coverage(self.clean)

    @cached_property
    def landing(self) -> str:
        """The raw tables written as a landing area of delimited text."""
        return write_landing(self.spark, self.sf_dir)

    @cached_property
    def archives(self) -> str:
        """The landing area as archives, one per day, ten years on: only dates from 2000 on
        are read from packed names. A landing area written for them only is removed."""
        root = new_path(self.spark, "archives")
        with intermediate(self.spark):
            landed = self.__dict__.get("landing") or write_landing(self.spark, self.sf_dir)
            lines = self.spark.read.text(landed).select("fecha", "paquete", "rol", "value", "_metadata")
            name = F.concat_ws("_", "rol", F.substring_index("_metadata.file_path", "/", -1))
            # Lines of a block come from the scan in their order, so neighbours travel as one text.
            block = F.col("_metadata.file_block_start")
            zips.write_days(
                zips.joined_lines(lines.select(
                    F.add_months("fecha", 120).alias("dia"), "paquete", name.alias("nombre"), F.col("value").alias("linea"),
                    F.struct(block, F.monotonically_increasing_id().alias("fila")).alias("orden"), block.alias("bloque"),
                )),
                root,
            )
        return root

    @property
    def chains(self) -> list[str]:
        names = fixtures.read(self.spark, self.sf_dir, "customer").select("c_mktsegment").distinct()
        return sorted(r[0] for r in names.collect())

    @property
    def categories(self) -> list[str]:
        return sorted(r[0] for r in self.dim.select("categoria").distinct().collect())


_tables: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        _tables[key] = Tables(spark, sf_dir)
    return _tables[key]


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name, digits in places.items()})


def write_landing(spark: SparkSession, sf_dir: str) -> str:
    """`fecha=…/paquete=…/rol=…/` folders, `|` for productos and `;` for the other roles."""
    root = new_path(spark, "landing")
    with intermediate(spark):
        return _write_roles(spark, sf_dir, root)


def _write_roles(spark: SparkSession, sf_dir: str, root: str) -> str:
    roles = {
        # Line items are stored and put in order before their text is made, which is twice as
        # wide: neither the joins behind them nor these are left when it is written.
        "productos": (materialize(fixtures.raw_listing(spark, sf_dir), "listing"), fixtures.ORDER, fixtures.productos, "|"),
        "sucursales": (None, ("orden",), None, ";"),
        "comercio": (fixtures.raw_comercio(spark, sf_dir), ("orden",), None, ";"),
    }
    keep = ["fecha", "paquete", "rol"]
    for role, (df, order, text_of, sep) in roles.items():
        if df is None:  # The branches of the listings just written, whose joins are not made again.
            text = ", ".join(f"{c} string" for c in fixtures.productos(roles["productos"][0]).columns if c not in ("orden", *keep))
            listed = (
                spark.read.schema(f"{text}, fecha date, paquete string, rol string")
                .options(header=True, sep="|").csv(root).where("rol = 'productos'")
            )
            df = fixtures.raw_sucursales(spark, sf_dir, listed)
        if text_of is None:
            df = df.withColumn("paquete", F.col("id_comercio"))
        # By range, so that a large merchant fills several files, in order of their names.
        ordered = (
            df.repartitionByRange("fecha", "paquete", *order)
            .sortWithinPartitions("fecha", "paquete", *order)
        )
        (
            (text_of(ordered) if text_of else ordered)
            .drop("orden")
            .withColumn("rol", F.lit(role))
            .write.mode("append").partitionBy(*keep)
            .option("header", True).option("sep", sep)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(root)
        )
    return root


Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with spare_disk(spark):
            return function(tables(spark, sf_dir))

    _queries[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_queries)


# ---- star tables ------------------------------------------------------------------------


@query
def precio_item(t: Tables) -> DataFrame:
    return rounded(t.star["fact_precio_item"], precio_mediano=6)


@query
def dispersion(t: Tables) -> DataFrame:
    return rounded(
        t.star["fact_dispersion"], precio_min=6, precio_med=6, precio_max=6, gap_pesos=6, gap_pct=6
    )


@query
def canasta(t: Tables) -> DataFrame:
    return rounded(
        t.star["fact_canasta"], canasta_optima=4, canasta_tipica=4, canasta_peor=4,
        cobertura_ponderada=6,
    )


@query
def ranking_cadenas(t: Tables) -> DataFrame:
    return rounded(t.star["fact_ranking_cadenas"], indice_vs_mercado=6)


# ---- comparability ----------------------------------------------------------------------


@query
def comparables(t: Tables) -> DataFrame:
    return rounded(
        t.annotated.select(
            "fecha", "cadena", "provincia", "id_sucursal", "ean", "item", "precio_unitario",
            "referencia", "motivo",
        ),
        referencia=6,
    )


@query
def referencias(t: Tables) -> DataFrame:
    return rounded(compare.reference_prices(t.clean), referencia=6)


@query
def descartes_comparabilidad(t: Tables) -> DataFrame:
    return rounded(compare.range_discards(t.annotated), pu_min=6, pu_max=6, referencia=6)


@query
def unidades_perdidas(t: Tables) -> DataFrame:
    return compare.lost_units(t.annotated)


@query
def embudo(t: Tables) -> DataFrame:
    # The raw listings labelled with the real basket, so that most rows fall outside it.
    clean = clean_plan.clean_rows(t.audited)
    labelled = texts.with_items(clean, texts.text_dictionary(clean), basket_only=True)
    dim = texts_dim(t)
    return rounded(
        compare.funnel(clean, compare.annotate_comparable(labelled, dim)),
        pct_canasta=6, pct_comparables=6,
    )


def texts_dim(t: Tables) -> DataFrame:
    from gondola.dims import dim_item

    return dim_item(t.spark)


# ---- text and size ----------------------------------------------------------------------


def _keyed(df: DataFrame) -> list[Column]:
    return [F.col("orden.l_orderkey").alias("l_orderkey"), F.col("orden.l_linenumber").alias("l_linenumber")]


@query
def to_number(t: Tables) -> DataFrame:
    return t.raw.select(*_keyed(t.raw), text.to_number(F.col("productos_precio_lista")).alias("precio"))


@query
def ean_normalizado(t: Tables) -> DataFrame:
    return t.raw.select(*_keyed(t.raw), text.ean_norm(F.col("id_producto")).alias("ean"))


@query
def descripcion_normalizada(t: Tables) -> DataFrame:
    return t.raw.select(*_keyed(t.raw), text.desc_norm(F.col("productos_descripcion")).alias("descripcion"))


@query
def tamano_envase(t: Tables) -> DataFrame:
    typed = clean_plan.typed(t.raw)
    # Few texts of the many rows, found once for both dictionaries.
    found = materialize(typed.select("descripcion", texts.UNIT_COLUMN).distinct(), "size-texts")
    sized = texts.with_size(typed, texts.text_dictionary(found), texts.unit_dictionary(found))
    return rounded(
        sized.select(
            *_keyed(sized), "cantidad_desc", "unidad_desc", "cantidad_pres", "unidad_pres",
            "cantidad_base", "unidad_base", "fuente_tamano", "precio_unitario",
        ),
        cantidad_desc=6, cantidad_pres=6, cantidad_base=6,
    )


@query
def unidad_base(t: Tables) -> DataFrame:
    unit = F.col("productos_unidad_medida_presentacion")
    clean = text.unit_clean(unit)
    return (
        t.raw.groupBy(unit.alias("texto")).agg(F.count(F.lit(1)).alias("filas"))
        .select(
            "texto", "filas",
            units.unit_base(F.col("texto")).alias("unidad"),
            units.unit_factor(F.col("texto")).alias("factor"),
            units.unit_ignored(text.unit_clean(F.col("texto"))).alias("ignorada"),
        )
    )


@query
def provincia(t: Tables) -> DataFrame:
    branches = fixtures.raw_sucursales(t.spark, t.sf_dir)
    code = F.col("sucursales_provincia")
    return branches.groupBy(code.alias("codigo"), text.province_name(code).alias("provincia")).agg(
        F.count(F.lit(1)).alias("filas")
    )


@query
def etiquetas(t: Tables) -> DataFrame:
    typed = clean_plan.typed(t.raw)
    labelled = texts.with_items(typed, texts.text_dictionary(typed))
    return labelled.groupBy("item", "categoria", "unidad_esperada").agg(
        F.count(F.lit(1)).alias("filas"), F.countDistinct("descripcion").alias("textos")
    )


@query
def etiquetas_por_fila(t: Tables) -> DataFrame:
    typed = clean_plan.typed(t.raw)
    labelled = texts.with_items(typed, texts.text_dictionary(typed), basket_only=True)
    return labelled.select(*_keyed(labelled), "item")


@query
def fecha_texto(t: Tables) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return fixtures.read(t.spark, t.sf_dir, "lineitem").groupBy(
        text.date_text(day).alias("fecha"), text.date_text(day, with_year=False).alias("dia")
    ).agg(F.count(F.lit(1)).alias("filas"))


# ---- quality ----------------------------------------------------------------------------


@query
def reglas_calidad(t: Tables) -> DataFrame:
    return t.audited.select(*_keyed(t.audited), "fecha", "ean", "precio", "descarte")


@query
def conteo_reglas(t: Tables) -> DataFrame:
    return quality.rule_counts(t.audited)


@query
def dedupe(t: Tables) -> DataFrame:
    """The row kept of every listing of the clean adapter."""
    shown = ["fecha", "id_comercio", "id_sucursal", "ean", "precio"]
    listed = materialize(t.clean.select(*shown, "orden"), "listings")
    return quality.keep_last(listed).select(*shown)


@query
def outliers_ean(t: Tables) -> DataFrame:
    return quality.outlier_prices(t.clean).select("fecha", "ean", "precio")


@query
def guardrail(t: Tables) -> DataFrame:
    """A key that repeats too often: (order, line) as listing key trips the guardrail."""
    line = fixtures.read(t.spark, t.sf_dir, "lineitem")
    rows = line.select(
        F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1)).alias("fecha"),
        F.col("l_orderkey").cast("string").alias("id_comercio"),
        F.col("l_linenumber").cast("string").alias("id_sucursal"),
        F.lit("7790000000000").alias("ean"),
        F.col("l_extendedprice").alias("precio"),
        F.struct("l_shipdate", "l_extendedprice", "l_quantity", "l_partkey").alias("orden"),
    )
    counts = quality.rule_counts(quality.annotate_rules(rows))
    return counts.where(F.col("regla") == "duplicados").select(
        "fecha", "llegan", "descarta",
        (F.col("descarta") > quality.DEFAULTS.max_discard_share * F.col("llegan")).alias("excedido"),
    )


@query
def metricas_diarias(t: Tables) -> DataFrame:
    return t.quality


@query
def enriquecido(t: Tables) -> DataFrame:
    return t.audited.groupBy("fecha", "cadena", "provincia").agg(
        F.count(F.lit(1)).alias("filas"),
        F.count("sucursales_localidad").alias("con_sucursal"),
    )


@query
def tabla_limpia(t: Tables) -> DataFrame:
    return rounded(
        clean_plan.clean_rows(t.audited).select(
            *[c for c in CLEAN_COLUMNS if c not in ("cantidad_base", "precio_unitario")],
            "cantidad_base", "precio_unitario", "productos_marca",
        ),
        cantidad_base=6,
    )


@query
def pct_descartes(t: Tables) -> DataFrame:
    return rounded(findings.discards_share(t.quality), pct=6)


@query
def resumen_calidad(t: Tables) -> DataFrame:
    return rounded(
        findings.quality_rollup(t.quality), pct_descartado=6, discrepan_media=6,
        tamano_desc_media=6, sin_tamano_media=6,
    )


# ---- ingest -----------------------------------------------------------------------------


@query
def archivos_descubiertos(t: Tables) -> DataFrame:
    """Merchants with files, per day and role."""
    merchant = F.regexp_extract("path", "/paquete=([^/]+)/", 1)
    return landing.discover(t.spark, t.landing).groupBy("fecha", "rol").agg(
        F.countDistinct(merchant).alias("comercios")
    )


@query
def archivos_rechazados(t: Tables) -> DataFrame:
    """Each merchant's file of each day written without its prices, below a folder that is no day,
    and as a role that is none: how many are rejected, and why."""
    rows, _ = raw.read_role(t.spark, "productos", t.landing)
    day = F.col("fecha").cast("string")
    cases = F.array(*(
        F.struct(d.alias("fecha"), F.lit(role).alias("rol"))
        for d, role in ((day, "productos"), (F.lit("sin"), "productos"), (day, "otros"))
    ))
    out, parts = new_path(t.spark, "odd-landing"), ["fecha", "rol", "paquete"]
    # A branch's day once, before it is multiplied by the cases.
    branches = rows.select("fecha", "id_comercio", "id_sucursal").distinct()
    files = branches.select("id_comercio", "id_sucursal", F.explode(cases).alias("caso")).select(
        "id_comercio", "id_sucursal", "caso.*", F.col("id_comercio").alias("paquete")
    )
    files.distinct().repartition(*parts).write.partitionBy(*parts).option("header", True).csv(out)
    _, rejects = raw.read_role(t.spark, "productos", out)
    return rejects.union(landing.unplaced(t.spark, out)).groupBy(
        F.substring_index("motivo", ":", 1).alias("motivo")
    ).agg(F.count(F.lit(1)).alias("archivos"))


@query
def archivos_desempacados(t: Tables) -> DataFrame:
    """The landing area packed by day and merchant, unpacked again and read."""
    out = new_path(t.spark, "unpacked-landing")
    archives.unpack(t.spark, t.archives, out)
    rows, _ = raw.read_role(t.spark, "productos", out)
    return rows.groupBy(F.add_months("fecha", -120).alias("fecha"), "id_comercio").agg(
        F.count(F.lit(1)).alias("filas"),
        F.round(F.sum(text.to_number(F.col("productos_precio_lista"))), 2).alias("precio_total"),
    )


@query
def fecha_contenido(t: Tables) -> DataFrame:
    files, _ = archives.expand_archives(t.spark, t.archives)
    names = files.select("archivo", "paquete", "nombre").distinct()
    return names.join(archives.content_date(names), "archivo").groupBy(F.add_months("fecha", -120).alias("fecha")).agg(
        F.countDistinct("archivo").alias("archivos"), F.countDistinct("paquete").alias("paquetes")
    )


@query
def lectura_cruda(t: Tables) -> DataFrame:
    rows, _ = raw.read_role(t.spark, "productos", t.landing)
    return rows.groupBy("fecha", "id_comercio", "id_sucursal").agg(
        F.count(F.lit(1)).alias("filas"),
        F.count("productos_cantidad_presentacion").alias("con_cantidad"),
        F.count("productos_ean").alias("con_ean"),
        F.round(F.sum(text.to_number(F.col("productos_precio_lista"))), 2).alias("precio_total"),
    )


@query
def limpieza_completa(t: Tables) -> DataFrame:
    """Landing folders to clean table and back, through every stage of the pipeline."""
    out = new_path(t.spark, "lake")
    clean_plan.clean_days(t.spark, t.landing, out)
    return stored.read_clean(t.spark, f"{out}/precios").groupBy("fecha", "cadena", "provincia").agg(
        F.count(F.lit(1)).alias("filas")
    )


@query
def dias_pendientes(t: Tables) -> DataFrame:
    """With the first two days stored, only the others are pending."""
    out = new_path(t.spark, "partial")
    days = t.clean.select("fecha", "cadena", "precio")
    stored.write_clean(days.where(F.col("fecha") < "1997-01-01"), out)
    return stored.pending(days, out).groupBy("fecha").agg(F.count(F.lit(1)).alias("filas"))


@query
def bitacora_calidad(t: Tables) -> DataFrame:
    """The quality log after a repeated write of some days: replaced, not appended."""
    path = new_path(t.spark, "log")
    counts = quality.rule_counts(t.audited).groupBy("fecha").agg(
        F.max("llegan").alias("filas_crudas"), F.sum("descarta").alias("descartadas")
    )
    stored.upsert_quality(counts.withColumn("filas_crudas", F.lit(0).cast("long")), path)
    stored.upsert_quality(counts, path)
    return stored.read_quality(t.spark, path)


@query
def particion_diaria(t: Tables) -> DataFrame:
    """One day of a date-partitioned table: only its folder is read."""
    path = new_path(t.spark, "days")
    stored.write_clean(t.clean.select("fecha", "cadena", "precio"), path)
    day = stored.read_clean(t.spark, path, "1998-01-01", "1998-01-01")
    return day.groupBy("fecha", "cadena").agg(F.count(F.lit(1)).alias("filas"), F.max("precio").alias("precio_max"))


@query
def exportacion(t: Tables) -> DataFrame:
    """The price fact after a round trip through the CSV export."""
    path = new_path(t.spark, "export")
    stored.export_star({"fact_precio_item": t.star["fact_precio_item"]}, path)
    back = t.spark.read.option("header", True).schema(t.star["fact_precio_item"].schema)
    return back.csv(f"{path}/fact_precio_item").groupBy("fecha", "cadena").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("n_observaciones").alias("observaciones"),
        F.round(F.max("precio_mediano"), 6).alias("precio_max"),
    )


# ---- findings ---------------------------------------------------------------------------


@query
def top_dispersion(t: Tables) -> DataFrame:
    return findings.top_dispersion(t.star["fact_dispersion"])


@query
def hallazgos(t: Tables) -> DataFrame:
    found = findings.findings(t.star["fact_dispersion"], t.star["fact_canasta"])
    return found.select(
        F.size("top_dispersion").cast("long").alias("casos"),
        F.get("top_dispersion", F.lit(0))["item"].alias("primer_item"),
        F.get("top_dispersion", F.lit(0))["gap_pct"].alias("primer_gap"),
        F.round("gap_mediano_pct", 6).alias("gap_mediano_pct"),
        "canasta.*", "ahorro_mensual_pesos", "ahorro_mensual_pct",
        "variacion_canasta.f0", "variacion_canasta.f1", "variacion_canasta.dias",
        F.round("variacion_canasta.var_pct", 6).alias("var_pct"),
    )


@query
def variacion_canasta(t: Tables) -> DataFrame:
    return rounded(findings.basket_change(t.star["fact_canasta"]), var_pct=6)


@query
def canasta_actual(t: Tables) -> DataFrame:
    return findings.basket_now(t.star["fact_canasta"])


@query
def dispersion_item(t: Tables) -> DataFrame:
    return rounded(findings.dispersion_by_item(t.star["fact_dispersion"], t.dim), gap=6, pmin=6, pmax=6)


@query
def dispersion_categoria(t: Tables) -> DataFrame:
    return rounded(findings.dispersion_by_category(t.star["fact_dispersion"]), brecha_mediana=6)


@query
def canasta_por_fecha(t: Tables) -> DataFrame:
    return rounded(
        findings.basket_by_date(t.star["fact_canasta"]), canasta_optima=4, canasta_tipica=4,
        canasta_peor=4, ahorro=4, rango=4, ahorro_pct=6,
    )


@query
def geografia(t: Tables) -> DataFrame:
    return rounded(
        findings.basket_by_province(t.star["fact_canasta"]), canasta_tipica=4, media=4, brecha_pct=6
    )


@query
def indice_cadenas(t: Tables) -> DataFrame:
    return rounded(findings.chain_index(t.star["fact_ranking_cadenas"]), indice=6, rango=6)


@query
def pareto_ahorro(t: Tables) -> DataFrame:
    return rounded(
        findings.savings_pareto(t.star["fact_dispersion"], t.dim), ahorro_mensual=4, acumulado_pct=4
    )


@query
def pivot_cadena_categoria(t: Tables) -> DataFrame:
    return findings.chain_category_pivot(t.star["fact_precio_item"], t.categories)


@query
def lider_categoria(t: Tables) -> DataFrame:
    return findings.category_leaders(t.star["fact_precio_item"])


@query
def variacion_diaria(t: Tables) -> DataFrame:
    return rounded(findings.daily_change(t.star["fact_precio_item"]), var_pct=6)


@query
def variacion_diaria_pivot(t: Tables) -> DataFrame:
    changes = rounded(findings.daily_change(t.star["fact_precio_item"]), var_pct=6)
    return findings.daily_change_pivot(changes, t.chains)


@query
def kpis(t: Tables) -> DataFrame:
    return rounded(
        findings.kpis(t.star["fact_dispersion"], t.star["fact_canasta"], t.quality),
        canasta_tipica=4, ahorro=4,
    )


@query
def detalle(t: Tables) -> DataFrame:
    return findings.detail(t.star["fact_dispersion"], t.dim)


@query
def explorador(t: Tables) -> DataFrame:
    rows = findings.detail(t.star["fact_dispersion"], t.dim)
    return findings.explore(rows, provincia="ASIA", texto=" RING ", order_by="precio_med", ascending=True)


@query
def banda_brecha(t: Tables) -> DataFrame:
    return t.star["fact_dispersion"].groupBy(text.gap_band(F.col("gap_pct")).alias("banda")).agg(
        F.count(F.lit(1)).alias("filas")
    )


@query
def listas_filtro(t: Tables) -> DataFrame:
    lists = findings.filter_lists(t.star["fact_dispersion"])
    return lists.select(
        F.array_join("categorias", ",").alias("categorias"), F.array_join("prov_lista", ",").alias("prov_lista")
    )


@query
def json_estricto(t: Tables) -> DataFrame:
    """Ratios that would be infinite or not a number come out as null."""
    rows = fixtures.read(t.spark, t.sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 3).alias("caso"),
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(float("nan")))
        .when(F.col("l_orderkey") % 3 == 1, F.lit(float("inf")))
        .otherwise(F.col("l_quantity")).alias("valor"),
    )
    return findings.json_ready(rows).groupBy("caso").agg(
        F.count(F.lit(1)).alias("filas"), F.count("valor").alias("validos"), F.max("valor").alias("maximo")
    )


@query
def tablero(t: Tables) -> DataFrame:
    payload = star_plan.dashboard_payload(t.star, t.quality)
    return payload.select(
        F.col("kpis.gap_mediano").alias("gap_mediano"),
        *[F.size(c).cast("long").alias(f"n_{c}") for c in ("canasta", "dispersion", "ranking", "provincias", "detalle", "categorias", "prov_lista")],
        F.get("detalle", F.lit(0))["item"].alias("primer_detalle"),
        F.get("canasta", F.lit(0))["dia"].alias("primer_dia"),
    )


@query
def invariantes(t: Tables) -> DataFrame:
    return checks.run_checks(clean_plan.clean_rows(t.audited), t.rows, t.star)


# ---- diagnostics ------------------------------------------------------------------------


@query
def volumen_diario(t: Tables) -> DataFrame:
    return diagnostics.volume_by_day(t.clean)


@query
def concentracion(t: Tables) -> DataFrame:
    return rounded(diagnostics.concentration(t.clean), pct_acumulado=1)


@query
def cobertura_geo(t: Tables) -> DataFrame:
    return diagnostics.geo_coverage(t.clean)


@query
def resumen_geo(t: Tables) -> DataFrame:
    return rounded(diagnostics.geo_summary(diagnostics.geo_coverage(t.clean)), pct_filas=6)


@query
def descripciones_por_ean(t: Tables) -> DataFrame:
    return diagnostics.texts_per_ean(findings.at_latest(t.clean))


@query
def catalogo(t: Tables) -> DataFrame:
    return diagnostics.catalog_stats(t.clean)


@query
def ejemplos_ean(t: Tables) -> DataFrame:
    return diagnostics.ean_examples(findings.at_latest(t.clean))


@query
def cardinalidad_cruda(t: Tables) -> DataFrame:
    found = diagnostics.raw_cardinality(t.raw)
    return found.select("campo", "distintos", F.array_join("ejemplos", ",").alias("ejemplos"))


@query
def unidades_frecuentes(t: Tables) -> DataFrame:
    return diagnostics.unit_frequency(t.clean)


@query
def unidades_no_reconocidas(t: Tables) -> DataFrame:
    return diagnostics.unknown_units(t.clean)


@query
def cobertura(t: Tables) -> DataFrame:
    return rounded(t.coverage, precio_unitario_mediano=6)


@query
def cobertura_revisar(t: Tables) -> DataFrame:
    return rounded(diagnostics.coverage_review(t.coverage), precio_unitario_mediano=6)


@query
def items_sin_datos(t: Tables) -> DataFrame:
    """Items of the basket with no listing at a bulk price, found by an anti join."""
    bulk = t.clean.where(F.col("precio_unitario") > 104_000).select("item").distinct()
    return diagnostics.items_without_data(bulk, t.dim)


@query
def saltos_precio(t: Tables) -> DataFrame:
    return diagnostics.price_jumps(t.clean)


@query
def conteo_saltos(t: Tables) -> DataFrame:
    return diagnostics.jump_counts(t.clean)


@query
def estabilidad_sucursales(t: Tables) -> DataFrame:
    return rounded(diagnostics.branch_stability(t.clean), pct=6)


@query
def dias_por_cadena(t: Tables) -> DataFrame:
    return diagnostics.chain_days(t.clean)


@query
def distribucion_precios(t: Tables) -> DataFrame:
    names = ("media", "desvio", "min", "max", *diagnostics.PERCENTILES)
    return rounded(diagnostics.describe_prices(t.clean), **{n: 4 for n in names})


@query
def histograma_precios(t: Tables) -> DataFrame:
    return diagnostics.price_histogram(t.clean)


@query
def casos_discrepantes(t: Tables) -> DataFrame:
    return sampling.discrepant(t.clean)


@query
def muestra_filas(t: Tables) -> DataFrame:
    """The rows of an exact sample of 1,000, drawn by hash."""
    return sampling.sample_rows(t.clean.select("fecha", "id_comercio", "id_sucursal", "ean"), 1000)


@query
def muestra_discrepantes(t: Tables) -> DataFrame:
    return sampling.discrepant_cases(t.clean)
