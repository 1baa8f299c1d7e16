"""End-to-end plans: seeds -> staging -> models -> marts, plus the
materialised run that mirrors the reference's ``seed; run; test`` flow."""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from propensa.operators.staging import MODELS, view_sql
from propensa.session import session_key
from propensa.plans import models
from propensa.sources import catalog
from propensa.sources.seed_files import file_buckets, raw_from_files, seeds_state
from propensa.sources.seeds import AS_OF, input_state, raw_views, seed_buckets


_graphs: dict[tuple, dict[str, DataFrame]] = {}
_graph_lock = threading.Lock()
_run_lock = threading.Lock()
_runs: dict[tuple, dict[str, DataFrame]] = {}


def state_of(spark: SparkSession, sf_dir: str, files: bool) -> str:
    """State of the input files: sizes and times, so that changed files are noticed."""
    return seeds_state(spark, sf_dir) if files else input_state(spark, sf_dir)


def graph(spark: SparkSession, sf_dir: str, as_of: dt.date | None = AS_OF, files: bool = False) -> dict[str, DataFrame]:
    """Every layer as a lazy frame over the bucketed raw seed table, or, with
    ``files``, over the three CSV files in ``sf_dir``.  Raw inputs and staging models
    are catalog relations, and the models read them by name (``ref``).

    DataFrames are immutable plans, so the graph is built (and analysed)
    once per session, data set and state of its files and shared by every query on it.
    """
    key = (session_key(spark), sf_dir.rstrip("/"), as_of, files)
    state = state_of(spark, sf_dir, files)
    with _graph_lock:
        cached = _graphs.get(key)
        if cached is None or cached["state"] != state:
            _graphs[key] = cached = {"state": state, "frames": _graph(spark, sf_dir, as_of, files)}
        return dict(cached["frames"])


def _graph(spark: SparkSession, sf_dir: str, as_of: dt.date | None, files: bool) -> dict[str, DataFrame]:
    names = raw_from_files(spark, sf_dir) if files else raw_views(spark, sf_dir, AS_OF if as_of is None else as_of)
    suffix = identity(sf_dir, as_of, files)
    for model, (raw, _) in MODELS.items():
        catalog.as_view(spark, "staging", model + suffix, view_sql(model, f"raw.{names[raw]}"))
    stg = {model: catalog.ref(spark, "staging", model + suffix) for model in MODELS}
    return {**{f"raw_{k}": catalog.ref(spark, "raw", v) for k, v in names.items()}, **stg, **models.build(stg, as_of)}


def identity(sf_dir: str, as_of: dt.date | None, files: bool) -> str:
    """Suffix of the tables of one data set and date."""
    return "_" + hashlib.md5(f"{sf_dir.rstrip('/')}|{as_of}|{files}".encode()).hexdigest()[:10]


def stored_mart(spark: SparkSession, sf_dir: str, as_of: dt.date | None = AS_OF, files: bool = False) -> DataFrame:
    """The mart an earlier run wrote, by this application or another one with
    the same layer folder.  Fails when there is none."""
    name = "mart_conversion_features" + identity(sf_dir, as_of, files)
    if spark.catalog.tableExists(f"marts.{name}"):
        return catalog.ref(spark, "marts", name)
    return catalog.stored(spark, "marts", name)


def run(spark: SparkSession, sf_dir: str, as_of: dt.date | None = AS_OF, suffix: str | None = None,
        files: bool = False) -> dict[str, DataFrame]:
    """Materialised run: staging as views, intermediate and marts as
    tables bucketed by ``clinician_id`` (the mart has three consumers:
    call list, training and scoring).  ``suffix`` keeps the tables of
    different data sets and dates apart; by default it names both.  Views without a
    suffix name the models of the latest run."""
    suffix = identity(sf_dir, as_of, files) if suffix is None else suffix
    key = (session_key(spark), sf_dir.rstrip("/"), as_of, suffix, files)
    with _run_lock:
        g = graph(spark, sf_dir, as_of, files)
        state = state_of(spark, sf_dir, files)
        done = _runs.get(key)
        if done is None or done["state"] != state or not all(spark.catalog.tableExists(f"{layer}.{name}{suffix}") for layer, name in (
                ("intermediate", "int_clinician_features"), ("marts", "mart_weekly_call_list"))):
            buckets = file_buckets(spark, sf_dir) if files else seed_buckets(spark, sf_dir)
            _runs[key] = done = {"state": state, "frames": _run(spark, g, as_of, suffix, buckets)}
        for layer, name in LATEST:
            made = name + (identity(sf_dir, as_of, files) if layer == "staging" else suffix)
            catalog.as_view(spark, layer, name, f"SELECT * FROM {layer}.{made}")
        return dict(done["frames"])


#: (layer, model) of the relations that a run leaves under their plain names.
LATEST = [*[("staging", m) for m in MODELS],
          *[("intermediate", m) for m in ("int_clinician_engagement", "int_clinician_firmographic_score", "int_clinician_features")],
          ("marts", "mart_conversion_features"), ("marts", "mart_weekly_call_list")]


def _run(spark: SparkSession, g: dict[str, DataFrame], as_of: dt.date | None, suffix: str,
         buckets: int | None) -> dict[str, DataFrame]:
    """Each model reads its upstream relations by name (``ref``): tables of
    the same entities share the seed's bucket count, so the features join
    of the two intermediate tables needs no exchange either."""
    def table(df: DataFrame, layer: str, name: str, **more) -> DataFrame:
        catalog.as_table(df, layer, name + suffix, **more)
        return catalog.ref(spark, layer, name + suffix)

    out = {name: g[name] for name in MODELS}
    # the two intermediate models are independent: their writes run as two
    # concurrent Spark jobs (one submitting thread each)
    catalog.ensure_layers(spark, ["intermediate", "marts"])
    with ThreadPoolExecutor(max_workers=2) as pool:
        eng_f = pool.submit(table, models.engagement(out["stg_usage_metrics"]), "intermediate",
                            "int_clinician_engagement", buckets=buckets)
        firmo_f = pool.submit(table, models.firmographic(out["stg_clinicians"], out["stg_firmographic_enrichment"]),
                              "intermediate", "int_clinician_firmographic_score", buckets=buckets)
        eng, firmo = eng_f.result(), firmo_f.result()
    feats = table(models.features(firmo, eng), "intermediate", "int_clinician_features", buckets=buckets)
    mart_t = table(models.conversion_mart(feats, as_of), "marts", "mart_conversion_features", buckets=buckets)
    out.update({
        "int_clinician_engagement": eng,
        "int_clinician_firmographic_score": firmo,
        "int_clinician_features": feats,
        "mart_conversion_features": mart_t,
        "mart_weekly_call_list": table(models.call_list(mart_t, as_of=as_of), "marts", "mart_weekly_call_list", bucket_key=None),
    })
    return out


def register_views(spark: SparkSession, sf_dir: str, as_of: dt.date | None = AS_OF) -> list[str]:
    """Every layer of the lazy graph as a temp view named after the model,
    so the pipeline can be queried with ``spark.sql``."""
    names = []
    for name, df in graph(spark, sf_dir, as_of).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
