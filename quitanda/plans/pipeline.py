"""Layered build with test gating: staging → intermediate → core → analytics.

Per layer, in dependency waves: materialise the wave's models (views lazy,
tables written under ``base_path`` and read back so later models start from
files, not from a long lineage), then run their declared tests.  A model whose
tests fail blocks its descendants; other branches of the layer are finished,
then the build stops before the next layer.

A build of some layers reads the other layers' models from the tables already
written, and replaces only its own models' test results.  The result is one row
per declaration (bounded by their number), so collecting it to decide the gate
is cheap.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.operators.quality import Declarations, check_model
from quitanda.plans.materialize import database_for, existing, materialize
from quitanda.plans.models import LAYERS, MODELS, Warehouse, models_in
from quitanda.plans.suite import SUITE
from quitanda.session import shuffles_removed
from quitanda.sources.files import list_files


class QualityGateError(RuntimeError):
    def __init__(self, layer: str, failures: list[dict]):
        self.layer, self.failures = layer, failures
        detail = "; ".join(f"{f['model']}.{f['column_name']} {f['test_name']}={f['violations']}"
                           for f in failures[:10])
        super().__init__(f"data-quality gate failed after layer {layer}: {detail}")


@dataclass
class BuildResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    test_results: DataFrame | None = None
    layers_done: list[str] = field(default_factory=list)
    seconds: dict[str, dict[str, float]] = field(default_factory=dict)   # layer → build / test


def test_models(wh: Warehouse, names: list[str], suite: Declarations = SUITE) -> DataFrame | None:
    """One row per declaration of the given models (None when none is declared)."""
    parts = []
    for name in names:
        checks = suite.by_model.get(name, [])
        if checks:
            r = check_model(name, wh.model(name), checks, wh.model)
            if r is not None:
                parts.append(r)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_layer(wh: Warehouse, layer: str, suite: Declarations = SUITE) -> DataFrame | None:
    return test_models(wh, models_in(layer), suite)


def _waves(names: list[str]) -> list[list[str]]:
    """Split a layer's models into waves; a model waits for its in-layer parents."""
    pending, done, waves = list(names), set(), []
    while pending:
        ready = [n for n in pending if all(p in done or p not in names for p in MODELS[n].parents)]
        waves.append(ready)
        done.update(ready)
        pending = [n for n in pending if n not in done]
    return waves


def materialize_wave(spark: SparkSession, wh: Warehouse, wave: list[str], base_path: str,
                     result: BuildResult, parallel_models: int = 3, database: str | None = None,
                     folders: dict[str, str] | None = None) -> None:
    """Write independent models concurrently (Spark jobs from several driver
    threads share the cluster; each job is itself parallel)."""
    # plans are built on this thread (the warehouse memo is not shared);
    # only the writes run concurrently
    streams = {name: wh.stream(name) for name in wave}
    plans = {name: stream.whole() if stream else wh.model(name) for name, stream in streams.items()}

    def build(name: str) -> tuple[str, DataFrame]:
        spec = MODELS[name]
        return name, materialize(spark, spec, plans[name], base_path, (folders or {}).get(spec.layer), database,
                                 streams[name])

    with ThreadPoolExecutor(max_workers=max(1, parallel_models)) as pool:
        for name, df in pool.map(build, wave):
            wh.overrides[name] = df
            result.tables[name] = df


def use_existing(spark: SparkSession, wh: Warehouse, base_path: str, skip: set[str] | frozenset[str] = frozenset(),
                 database: str | None = None, folders: dict[str, str] | None = None) -> list[str]:
    """Let ``wh`` read every model that is already written, but for ``skip``; return their names."""
    found = []
    for name, spec in MODELS.items():
        if name in skip or name in wh.overrides:
            continue
        df = existing(spark, spec, base_path, (folders or {}).get(spec.layer), database)
        if df is not None:
            wh.overrides[name] = df
            found.append(name)
    return found


def save_results(tests: DataFrame, results_path: str) -> None:
    """Replace the stored results of the tested models only."""
    # repartition, not coalesce: coalesce(1) would pull every check's final
    # aggregation into one task; the shuffled result is one row per check
    (tests.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("layer", "model").parquet(results_path))


def run_tests(spark: SparkSession, wh: Warehouse, names: list[str], base_path: str,
              suite: Declarations = SUITE) -> list[dict]:
    """Test models, store the results, return the failed declarations."""
    tests = test_models(wh, names, suite)
    if tests is None:
        return []
    layer_of = F.create_map(*[F.lit(x) for n in names for x in (n, MODELS[n].layer)])
    path = f"{base_path.rstrip('/')}/_test_results"
    save_results(tests.withColumn("layer", layer_of[F.col("model")]), path)
    failed = spark.read.parquet(path).where(F.col("model").isin(*names) & (F.col("violations") > 0))
    return [r.asDict() for r in failed.collect()]


def run_pipeline(spark: SparkSession, wh: Warehouse, base_path: str,
                 layers: list[str] | None = None, suite: Declarations = SUITE,
                 gate: bool = True, parallel_models: int = 3, env: str | None = None,
                 folders: dict[str, str] | None = None) -> BuildResult:
    """Build layer by layer; with ``env`` the tables are registered in that environment's database."""
    return build_into(spark, wh, base_path, database_for(env) if env else None, layers, suite, gate, parallel_models,
                      folders)


def build_into(spark: SparkSession, wh: Warehouse, base_path: str, database: str | None,
               layers: list[str] | None = None, suite: Declarations = SUITE, gate: bool = True,
               parallel_models: int = 3, folders: dict[str, str] | None = None, test: bool = True) -> BuildResult:
    """Build layer by layer; inside a layer, wave by wave (a model waits for its in-layer parents).

    Each table is one query whose shuffle files are removed when it is written, so they do not pile up.
    ``database`` registers the tables there; ``folders`` names the project folder
    of a layer, for the name prefix rule; ``test=False`` leaves the tests out.
    """
    result = BuildResult()
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    chosen = [name for layer in layers or LAYERS for name in models_in(layer)]
    if layers:
        use_existing(spark, wh, base_path, set(chosen), database, folders)
    with shuffles_removed(spark):
        for layer in layers or LAYERS:
            build_s = test_s = 0.0
            failures: list[dict] = []
            blocked: set[str] = set()
            for wave in _waves(models_in(layer)):
                blocked.update(n for n in wave if blocked.intersection(MODELS[n].parents))
                free = [n for n in wave if n not in blocked]
                t0 = time.perf_counter()
                materialize_wave(spark, wh, free, base_path, result, parallel_models, database, folders)
                t1 = time.perf_counter()
                found = run_tests(spark, wh, free, base_path, suite) if test else []
                if gate:
                    failures += found
                    blocked.update(f["model"] for f in found)
                build_s += t1 - t0
                test_s += time.perf_counter() - t1
            if failures:
                raise QualityGateError(layer, failures)
            result.seconds[layer] = {"build": round(build_s, 3), "test": round(test_s, 3)}
            result.layers_done.append(layer)
    results_path = f"{base_path.rstrip('/')}/_test_results"
    if list_files(spark, results_path):
        result.test_results = spark.read.parquet(results_path)
    return result
