"""Time the headline queries on local[$BENCH_CPUS] and print one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from gondola import catalog, fixtures  # noqa: E402
from gondola.operators import compare, facts, quality, texts  # noqa: E402
from gondola.plans import clean as clean_plan, star as star_plan  # noqa: E402
from gondola.sources.shared import materialize  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Single registered queries, after the stages below have built their inputs.
QUERIES = (
    "dispersion", "canasta", "ranking_cadenas", "comparables", "tamano_envase", "etiquetas",
    "dedupe", "outliers_ean", "metricas_diarias", "volumen_diario", "concentracion", "catalogo",
    "cobertura", "saltos_precio", "estabilidad_sucursales", "distribucion_precios",
    "dispersion_item", "pareto_ahorro",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("gondola-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Inputs of the stages, outside the clock: the raw tables as files.
    raw = {
        name: materialize(make(spark, SF_DIR), name)
        for name, make in (
            ("productos", fixtures.raw_productos),
            ("sucursales", fixtures.raw_sucursales),
            ("comercio", fixtures.raw_comercio),
        )
    }
    prices = materialize(fixtures.clean_prices(spark, SF_DIR), "prices")
    dim = materialize(fixtures.dim_items(spark, SF_DIR), "dim")
    seconds: dict[str, float] = {}

    def timed(name: str, action):
        start = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
        return result

    def clean():
        audited = materialize(
            clean_plan.audit(raw["productos"], raw["sucursales"], raw["comercio"]), "audited"
        )
        quality.enforce_guardrail(audited)
        run(clean_plan.clean_rows(audited))

    def transform():
        rows = materialize(
            compare.comparable(compare.annotate_comparable(prices, dim)).select(
                *facts.PRICE_GRAIN, "ean", "precio_unitario"
            ),
            "comparable",
        )
        star_plan.build_star(rows, dim)

    def labels():
        run(texts.with_items(prices, texts.text_dictionary(prices)))

    for name, stage in (("stage_clean", clean), ("stage_transform", transform), ("stage_labels", labels)):
        timed(name, stage)
    built = catalog.tables(spark, SF_DIR)
    built.star, built.quality  # noqa: B018 - inputs shared by the queries
    registered = catalog.queries()
    for name in QUERIES:
        timed(name, lambda: run(registered[name](spark, SF_DIR)))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": int(CPUS),
        "rows": prices.count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
