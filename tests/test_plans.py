"""What the plans of join-heavy queries must not contain, without any broadcast."""

import os

import pytest
from compare import compare, duck

from alvara.operators.companies import new_companies
from alvara.operators.weekly import weekly_aggregate
from alvara.registered.analog import EXTRACTION, Analog
from alvara.registered.oracle import ORACLE
from alvara.registered.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "new_companies", "weekly_aggregate", "merge_extractions", "privacy_mask", "dimension_lookup",
    "location_quotient", "per_capita_total", "sector_ratio", "duel", "lq_hero", "signature_sector",
    "distinct_labels", "next_unused", "check_complete_load", "check_report", "all_cuts",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")


@pytest.fixture(scope="module")
def unhinted(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_no_broadcast_is_needed(unhinted, name):
    df = QUERIES[name](unhinted, FOLDER)
    assert compare(df, duck(FOLDER), ORACLE[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoop", "BroadcastHashJoin", "EvalPython"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scans(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    raw = Analog(spark, FOLDER).raw()
    raw["estabelecimentos"].write.parquet(str(tmp_path / "sites"))
    raw["estabelecimentos"] = spark.read.parquet(str(tmp_path / "sites"))
    found = weekly_aggregate(new_companies(raw, EXTRACTION), EXTRACTION)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(situacao_cadastral,02)" in text
    assert "GreaterThanOrEqual(data_inicio_atividade,20000416)" in text
    assert "l_extendedprice" not in text and "logradouro" not in text and "nome_fantasia" not in text
    cells = QUERIES["top_states"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(semana,2000-06-01), LessThan(semana,2000-07-01)" in cells
    assert "ReadSchema: struct<semana:date,uf:string,contagem:bigint,semana_parcial:boolean>" in cells
    assert "TakeOrderedAndProject" in cells
