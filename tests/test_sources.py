from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import types as T

from strata.operators import stamp_layer, with_audit, with_ingestion_year
from strata.session import get_session, sizing
from strata.sources import (
    LOGISTICS_CONTRACT,
    SALES_CONTRACT,
    LayerPaths,
    conform,
    delta,
    read_csv_contract,
    read_json_contract,
    scratch_dir,
)

AB = T.StructType([T.StructField("a", T.StringType(), False), T.StructField("b", T.StringType())])


@pytest.fixture
def file(folder):
    def write(name, text):
        Path(folder).mkdir(parents=True, exist_ok=True)
        (Path(folder) / name).write_text(text, encoding="utf-8")
        return f"{folder}/{name}"

    return write


def test_contracts_are_all_text():
    assert len(SALES_CONTRACT) == 10 and len(LOGISTICS_CONTRACT) == 9
    assert all(f.dataType == T.StringType() for f in [*SALES_CONTRACT, *LOGISTICS_CONTRACT])
    assert [f.name for f in SALES_CONTRACT if not f.nullable] == ["order_id"]
    assert [f.name for f in LOGISTICS_CONTRACT if not f.nullable] == ["shipment_id"]


def test_csv_pads_short_lines_cuts_long_ones_and_keeps_their_text(spark, file):
    path = file("x.csv", "a,b\n1,são\n2\n3,x,extra\n,y\n")
    got = read_csv_contract(spark, path, AB).collect()
    assert [tuple(r) for r in got] == [
        ("1", "são", None), ("2", None, "2"), ("3", "x", "3,x,extra"), (None, "y", None),
    ]


def test_csv_without_corrupt_column_has_the_contract_only(spark, file):
    df = read_csv_contract(spark, file("x.csv", "a,b\n1,2\n"), AB, corrupt_column=None)
    assert df.columns == ["a", "b"] and df.count() == 1


def test_csv_positions_win_unless_the_header_is_enforced(spark, file):
    path = file("swapped.csv", "b,a\n1,2\n")
    assert read_csv_contract(spark, path, AB).first()["a"] == "1"
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_contract(spark, path, AB, enforce_header=True).collect()


def test_json_array_over_many_lines(spark, file):
    path = file("x.json", '[\n {"a": "1", "b": 12.50},\n {"a": "são", "z": 1},\n {"b": null}\n]')
    got = [tuple(r) for r in read_json_contract(spark, path, AB).collect()]
    assert [r[0] for r in got] == ["1", "são", None]
    assert float(got[0][1]) == 12.5 and got[1][1:] == (None, None)


def test_corrupt_json_keeps_its_text(spark, file):
    path = file("x.json", '{"a": "1", "b": ')
    row = read_json_contract(spark, path, AB).first()
    assert row["a"] is None and row["_corrupt_record"].startswith('{"a"')


def test_json_lines_lose_only_the_bad_line(spark, file):
    path = file("x.jsonl", '{"a": "1"}\n{"a": \n{"a": "3"}\n')
    got = read_json_contract(spark, path, AB, multi_line=False).collect()
    assert sorted(r.a for r in got if r.a) == ["1", "3"]
    assert [r._corrupt_record for r in got if r._corrupt_record] == ['{"a": ']


def test_conform_selects_casts_and_adds(rows):
    contract = T.StructType(
        [T.StructField("n", T.IntegerType()), T.StructField("x", T.StringType())]
    )
    df = conform(rows("extra int, n string", (1, "7"), (1, "seven")), contract)
    assert df.schema.names == ["n", "x"]
    assert [tuple(r) for r in df.collect()] == [(7, None), (None, None)]


def test_layer_paths():
    paths = LayerPaths("/base/")
    assert paths.bronze("sales") == "/base/bronze/sales"
    assert [paths.raw("a"), paths.silver("b"), paths.gold("c")] == [
        "/base/raw/a", "/base/silver/b", "/base/gold/c",
    ]


def test_audit_columns_and_clock(spark, file):
    when = datetime(2023, 12, 31, 23, 30)
    df = read_csv_contract(spark, file("in.csv", "a,b\n1,2\n"), AB)
    row = with_ingestion_year(with_audit(df, "bronze", when), when).first()
    assert row["_ingestion_timestamp"] == when and row["_year"] == 2023
    assert row["_layer"] == "bronze" and row["_source_file"].endswith("/in.csv")


def test_audit_without_a_file_scan_and_with_the_running_clock(spark):
    row = with_ingestion_year(with_audit(spark.range(1))).first()
    assert row["_source_file"] == "" and row["_year"] == row["_ingestion_timestamp"].year


def test_stamp_overwrites_the_layer_only_where_it_exists(rows):
    stamped = stamp_layer(rows("_layer string", "bronze"), "silver", datetime(2024, 1, 1))
    assert stamped.first().asDict() == {"_layer": "silver", "_silver_timestamp": datetime(2024, 1, 1)}
    assert stamp_layer(rows("x int", 1), "gold").columns == ["x", "_gold_timestamp"]


def test_session_factory_returns_the_running_session(spark):
    assert get_session("other", input_bytes=1) is spark


def test_sizing_grows_with_the_input():
    split = "spark.sql.files.maxPartitionBytes"
    assert sizing(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert sizing(10**9)[split] == sizing(2**40)[split] == str(128 * 1024 * 1024)
    assert int(sizing(2**40 + 2**30)[split]) < 1.01 * int(sizing(2**40)[split])  # no jump
    large = sizing(100 * 10**12)
    assert large["spark.sql.shuffle.partitions"] == "93133"
    assert large["spark.sql.files.maxPartitionBytes"] == str(512 * 1024 * 1024)


def test_scratch_folders_are_new_and_follow_the_session(spark):
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or one.startswith(base)


def test_scratch_refuses_a_cluster_without_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(Session(), "x")


def test_scratch_sees_the_checkpoint_dir_of_the_context():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return "hdfs://shared/folder"

    class Session:
        conf, sparkContext = Conf(), Context()

    assert scratch_dir(Session(), "x").startswith("hdfs://shared/folder/x-")


def test_delta_statements():
    class Session:
        def __init__(self):
            self.seen = []

        def sql(self, statement):
            self.seen.append(statement)

    session = Session()
    delta.optimize(session, "/t")
    delta.optimize(session, "/t", ["region", "order`year"])
    delta.vacuum(session, "/t")
    assert session.seen == [
        "OPTIMIZE delta.`/t`",
        "OPTIMIZE delta.`/t` ZORDER BY (`region`, `order``year`)",
        "VACUUM delta.`/t` RETAIN 168 HOURS",
    ]


def test_no_python_workers_in_the_library():
    root = Path(__file__).resolve().parent.parent / "strata"
    source = "".join(p.read_text() for p in root.rglob("*.py") if "llm" not in p.parts)
    for word in ("udf(", "applyInPandas", "mapInPandas", "mapInArrow", ".rdd", "toPandas", "localCheckpoint"):
        assert word not in source
