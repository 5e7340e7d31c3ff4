from datetime import datetime
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark import StorageLevel

from strata.plans import kpi, layers, run_bronze, run_gold, run_silver
from strata.plans.layers import read_silver
from strata.sources import LayerPaths, append_table, read_table
from strata.sources.contracts import LOGISTICS_COLUMNS, SALES_COLUMNS
from tests.conftest import values
from verification import fixtures as fx

TABLES = "/root/testdata/sf0.001"
COMPARED = {"sales": SALES_COLUMNS, "logistics": LOGISTICS_COLUMNS}
MONDAY, TUESDAY = datetime(2024, 1, 1), datetime(2024, 1, 2)


@pytest.fixture(scope="module")
def built(spark):
    from strata.scratch import scratch_dir

    paths = LayerPaths(scratch_dir(spark, "layers-test"))
    fx.write_sales_csv(fx.sales_raw(spark, TABLES), paths.raw("sales"))
    fx.write_logistics_json(fx.logistics_raw(spark, TABLES), paths.raw("logistics"))
    steps = {
        "bronze": run_bronze(spark, paths, paths.raw("sales"), paths.raw("logistics"), as_of=MONDAY)
    }
    steps["silver"] = run_silver(spark, paths, money="decimal(18,2)", as_of=MONDAY)
    steps["gold"] = run_gold(spark, paths, as_of=MONDAY)
    return paths, steps


def test_bronze_counts_and_columns(spark, built):
    paths, steps = built
    audit = ["_ingestion_timestamp", "_source_file", "_layer", "_year"]
    for table, columns in (("sales", SALES_COLUMNS), ("logistics", LOGISTICS_COLUMNS)):
        df = read_table(spark, paths.bronze(table))
        assert df.count() == steps["bronze"][table] > 0
        assert [c for c in df.columns if c != "_corrupt_record"] == [*columns, *audit]
        assert df.filter("_year = 2024 and _layer = 'bronze'").count() == df.count()


def test_silver_gates_count_what_was_written(spark, built):
    paths, steps = built
    for table, gate in steps["silver"].items():
        assert read_silver(spark, paths, table).count() == gate["total"] > 0
        assert gate["read"] == gate["duplicates"] + gate["rejected"] + gate["total"]
        assert gate["read"] == read_table(spark, paths.bronze(table)).count()
        assert gate["passed"] is True
    sales = read_silver(spark, paths, "sales")
    unreadable = sales.where("sales_amount is null or order_date is null").count()
    assert steps["silver"]["sales"]["null_critical"] == unreadable > 0
    assert steps["silver"]["sales"]["duplicates"] > 0 and steps["silver"]["sales"]["rejected"] > 0


def test_a_gate_can_fail(spark, built):
    paths, _ = built
    gates = run_silver(spark, paths, max_null_pct=0.5, as_of=MONDAY)
    assert gates["sales"]["passed"] is False and gates["logistics"]["passed"] is True
    run_silver(spark, paths, as_of=MONDAY)


def test_silver_keeps_bronze_audit_columns(spark, built):
    paths, _ = built
    row = read_silver(spark, paths, "sales").first()
    assert row["_layer"] == "silver" and row["_ingestion_timestamp"] == MONDAY
    assert row["_source_file"] and row["_year"] == 2024


def test_gold_tables_equal_their_plans(spark, built):
    paths, steps = built
    sales, logistics = (read_silver(spark, paths, t) for t in ("sales", "logistics"))
    plans = {
        "sales_by_region": kpi.sales_by_region(sales, as_of=MONDAY),
        "sales_by_category": kpi.sales_by_category(sales, as_of=MONDAY),
        "logistics_kpi": kpi.logistics_kpi(logistics, as_of=MONDAY),
        "executive_summary": kpi.executive_summary(sales, logistics, as_of=MONDAY),
    }
    assert set(steps["gold"]) == set(plans)
    for table, plan in plans.items():
        stored = read_table(spark, paths.gold(table))
        assert stored.count() == steps["gold"][table]
        assert values(stored.select(*plan.columns)) == values(plan)


def test_contract_columns_need_no_schema_merge(spark, built):
    paths, steps = built
    merged = {t: values(read_silver(spark, paths, t).select(*c)) for t, c in COMPARED.items()}
    gates = run_silver(spark, paths, merge_schema=False, as_of=MONDAY)
    assert gates == steps["silver"]
    for table, columns in COMPARED.items():
        assert values(read_silver(spark, paths, table).select(*columns)) == merged[table]


def test_added_bronze_columns_reach_silver(spark, folder, rows):
    paths = LayerPaths(folder)
    schema = ", ".join(f"{c} string" for c in SALES_COLUMNS) + ", _ingestion_timestamp timestamp"
    old = ("O1", "2024-01-01", "C", "P", "K", "N", "$1.00", "1", "0%", "V", MONDAY)
    append_table(rows(schema, old), paths.bronze("sales"))
    append_table(rows(schema + ", channel string", ("O2", *old[1:], "web")), paths.bronze("sales"))
    shipments = ", ".join(f"{c} string" for c in LOGISTICS_COLUMNS)
    one = ("S1", "O1", "2024-01-01", None, "c", "a", "b", "1.0", "s")
    append_table(rows(shipments, one), paths.bronze("logistics"))
    run_silver(spark, paths)
    assert values(read_silver(spark, paths, "sales").select("order_id", "channel")) == [
        ("O1", None), ("O2", "web"),
    ]


def test_gold_runs_cached_too(spark, built):
    paths, steps = built
    assert run_gold(spark, paths, cache_level=StorageLevel.MEMORY_AND_DISK) == steps["gold"]


def test_a_rerun_scans_new_files_only(spark, folder, monkeypatch):
    paths = LayerPaths(folder)
    Path(f"{folder}/in {{a}}[1]").mkdir(parents=True)
    header = ",".join(SALES_COLUMNS) + "\n"
    one, two = (f"{folder}/in {{a}}[1]/{n}.csv" for n in ("one", "two"))
    Path(one).write_text(header + "O1,2024-01-01,C,P,K,N,$1.00,1,0%,V\n")
    Path(f"{folder}/in.json").write_text('[{"shipment_id": "S1", "order_id": "O1", "dispatch_date": "2024-01-01"}]')
    scans = []
    scan = layers.read_csv_contract
    monkeypatch.setattr(layers, "read_csv_contract", lambda *a, **k: scans.append(scan(*a, **k)) or scans[-1])
    inputs = (f"{folder}/in ?a?*", f"{folder}/in.json")
    assert run_bronze(spark, paths, *inputs, only_new_files=True) == {"sales": 1, "logistics": 1}
    Path(two).write_text(header + "O2,2024-01-01,C,P,K,N,$1.00,1,0%,V\nO3,2024-01-01,C,P,K,N,$1.00,1,0%,V\n")
    assert run_bronze(spark, paths, *inputs, only_new_files=True) == {"sales": 2, "logistics": 0}
    assert run_bronze(spark, paths, *inputs, only_new_files=True) == {"sales": 0, "logistics": 0}
    assert [[unquote(f).rsplit("/", 1)[1] for f in df.inputFiles()] for df in scans] == [["one.csv"], ["two.csv"]]
    assert read_table(spark, paths.bronze("sales")).count() == 3
    listed = spark.read.parquet(paths.manifest("sales"))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in listed.collect()) == ["one.csv", "two.csv"]
    Path(one).write_text(header + "O1,2024-01-01,C,P,K,N,$2.00,1,0%,V\nO9,2024-01-01,C,P,K,N,$2.00,1,0%,V\n")
    assert run_bronze(spark, paths, *inputs, only_new_files=True)["sales"] == 2  # a new version


def test_reruns_append_unless_only_new_files(spark, folder):
    paths = LayerPaths(folder)
    Path(folder).mkdir(parents=True)
    raw = [f"{folder}/in.csv", f"{folder}/in.json"]
    Path(raw[0]).write_text(",".join(SALES_COLUMNS) + "\nO1,2024-01-01,C,P,K,N,$1.00,1,0%,V\n")
    Path(raw[1]).write_text('[{"shipment_id": "S1", "order_id": "O1", "dispatch_date": "2024-01-01"}]')
    first = run_bronze(spark, paths, *raw, only_new_files=True, as_of=MONDAY)
    assert first == {"sales": 1, "logistics": 1}
    assert run_bronze(spark, paths, *raw, only_new_files=True) == {"sales": 0, "logistics": 0}
    assert run_bronze(spark, paths, *raw, enforce_header=True, as_of=TUESDAY) == first
    assert read_table(spark, paths.bronze("sales")).count() == 2
    gates = run_silver(spark, paths)
    assert gates["sales"]["total"] == 1
    assert read_silver(spark, paths, "sales").first()["_ingestion_timestamp"] == TUESDAY
