"""Queries against their SQL where record numbers and regions repeat."""

import os

import pytest

ROWS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("repeated"))
    rows = [(i // 3, i * 7 % 40, i % 10, i % 7 + 1, float(i % 50 + 1), i % 11 / 100, i % 9 / 100, "ANR"[i % 3], "OF"[i % 2]) for i in range(400)]
    rows += rows[::5] + [(*r[:2], r[2] + 1, *r[3:5], 0.05, r[6], "N", "F") for r in rows[::7]]
    spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(k, float(k)) for k in [*range(450), 3, 7]], "s_suppkey long, s_acctbal double").coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    return folder


def compare(spark, folder, name):
    import __spark_entry__
    import duckdb

    got = [tuple(r) for r in __spark_entry__.queries()[name](spark, folder).collect()]
    with duckdb.connect() as db:
        for t in os.listdir(folder):
            db.execute(f"create view {t.removesuffix('.parquet')} as select * from '{folder}/{t}/*.parquet'")
        assert sorted(got) == sorted(db.execute(__spark_entry__.oracle_sql()[name]).fetchall())


@pytest.mark.parametrize("name", ["amplicon_statistics", "overlap_bases", "template_scores", "qual_mean", "consensus_simple", "recomputed_mismatches", "md_reference_length"])
def test_repeated_records_are_as_in_sql(spark, tables, name):
    compare(spark, tables, name)
