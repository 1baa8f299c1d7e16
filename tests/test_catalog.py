"""Layer namespaces, view and table materialisation, ref()."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from propensa.sources import catalog


def test_layer_name_rule():
    assert catalog.layer_name(" marts ") == "marts"
    assert catalog.layer_name(None) == "default"
    assert catalog.layer_name("  ") == "default"


def test_layers_view_table_ref(spark):
    assert set(catalog.ensure_layers(spark)) == {"raw", "staging", "intermediate", "marts"}
    dbs = {d.name for d in spark.catalog.listDatabases()}
    assert {"raw", "staging", "intermediate", "marts"} <= dbs
    df = spark.range(100).select(F.col("id").alias("clinician_id"), (F.col("id") * 2).alias("v"))
    name = "t_" + uuid.uuid4().hex[:8]
    table = catalog.as_table(df, "intermediate", name, buckets=4)
    view = catalog.as_view(spark, " staging ", name, f"SELECT v + 1 AS w FROM intermediate.{name}")
    assert view.count() == 100
    assert catalog.ref(spark, "staging", name).agg(F.max("w")).first()[0] == spark.sql(f"SELECT max(w) FROM staging.{name}").first()[0] == 199
    assert sorted(r.v for r in catalog.ref(spark, "intermediate", name).collect()) == list(range(0, 200, 2))
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED intermediate.{name}").collect()}
    assert desc.get("Num Buckets") == "4" and "clinician_id" in desc.get("Bucket Columns", "")
    # full replace
    catalog.as_table(df.limit(10), "intermediate", name, buckets=4)
    assert catalog.ref(spark, "intermediate", name).count() == 10
    assert table.columns == ["clinician_id", "v"]


def test_layers_queryable_with_sql(spark):
    from propensa.plans.pipeline import register_views
    from tests.conftest import SF_SMALL

    names = register_views(spark, SF_SMALL)
    assert "mart_weekly_call_list" in names and "stg_clinicians" in names
    n = spark.sql("SELECT count(*) AS n FROM mart_weekly_call_list WHERE call_rank <= 10").collect()[0].n
    assert n == 10
    tiers = {r.engagement_tier for r in spark.sql(
        "SELECT DISTINCT engagement_tier FROM int_clinician_engagement").collect()}
    assert tiers <= {"Champion", "Power User", "Active", "Casual", "Dormant"}


def test_cluster_sizing():
    from propensa.session import buckets_for_rows, cluster_conf
    conf = cluster_conf(100 << 40, executors=1000, cores_per_executor=4)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80
    assert buckets_for_rows(1500, slots=8) == 8
    assert buckets_for_rows(15_000_000_000, slots=4000) == 15_000


def test_a_reader_during_a_rewrite_sees_the_old_table(spark):
    name = "t_" + uuid.uuid4().hex[:8]
    frame = lambda n: spark.range(n).select(F.col("id").alias("clinician_id"), (F.col("id") * 2).alias("v"))
    before = catalog.as_table(frame(50), "intermediate", name, buckets=2)

    def slowly(rows):
        import time

        time.sleep(5)
        yield from rows

    slow = frame(20).coalesce(1).mapInPandas(slowly, "clinician_id long, v long")
    writer = threading.Thread(target=catalog.as_table, args=(slow, "intermediate", name), kwargs={"buckets": 2})
    writer.start()
    seen = 0
    while writer.is_alive() and seen < 2:
        assert catalog.ref(spark, "intermediate", name).count() in (50, 20)
        assert catalog.stored(spark, "intermediate", name).count() in (50, 20)
        seen += 1
    writer.join()
    assert seen and before.count() == 50  # the plan of before still reads its version
    assert catalog.ref(spark, "intermediate", name).count() == 20
    # a failing rewrite changes nothing, and no version is complete
    broken = frame(5).select("clinician_id", F.raise_error(F.lit("stop")).cast("long").alias("v"))
    with pytest.raises(Exception):
        catalog.as_table(broken, "intermediate", name, buckets=2)
    assert catalog.ref(spark, "intermediate", name).count() == catalog.stored(spark, "intermediate", name).count() == 20
    assert len(catalog.versions(spark, "intermediate", name)) == 2


def test_old_versions_go_and_layouts_may_change(spark):
    name = "t_" + uuid.uuid4().hex[:8]
    for n in range(1, 6):
        df = spark.range(n).withColumnRenamed("id", "clinician_id")
        table = catalog.as_table(df if n < 5 else df.withColumn("more", F.lit("x")), "intermediate", name, buckets=2 if n < 4 else 3)
        assert table.count() == n and catalog.stored(spark, "intermediate", name).count() == n
    assert table.columns == ["clinician_id", "more"]
    assert len(catalog.versions(spark, "intermediate", name)) == catalog.KEPT_VERSIONS
    with pytest.raises(FileNotFoundError):
        catalog.stored(spark, "intermediate", "no_such_table")


def test_changed_files_are_noticed(spark, tmp_path):
    """A, B, A in one folder; the views without a suffix follow the latest run."""
    import shutil

    from propensa.plans.pipeline import run
    from propensa.plans.queries import seed_files
    from tests.conftest import SF_SMALL

    source = seed_files(spark, SF_SMALL).replace("file:", "")
    base = tmp_path / "seeds"
    shutil.copytree(source, base, ignore=shutil.ignore_patterns("*.crc"))
    ids = lambda: sorted(r[0] for r in run(spark, str(base), files=True)["mart_weekly_call_list"].select("clinician_id").collect())
    first = ids()
    assert ids() == first and len(first) == 80
    part = sorted(p for p in (base / "clinicians.csv").iterdir() if p.suffix == ".csv")[0]
    text = part.read_text()
    part.write_text("\n".join(text.split("\n")[:2]) + "\n")
    fewer = spark.sql("SELECT count(*) FROM staging.stg_clinicians").first()[0]
    assert ids() != first
    assert spark.sql("SELECT count(*) FROM staging.stg_clinicians").first()[0] < fewer
    part.write_text(text)
    assert ids() == first
    assert spark.sql("SELECT count(*) FROM marts.mart_weekly_call_list").first()[0] == 80
    assert catalog.ref(spark, "staging", "stg_clinicians").count() == fewer
