from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from proofline.contract import Column, Contract, Table
from proofline.functions import conform as C
from proofline.operators import keys
from proofline.plans import payments as pay
from proofline.sources import changelog, delimited, export, jdbc, tables
from proofline.sources.tables import LoadError, VersionedTable, full_refresh, read_loaded, read_rejects

SMALL = Table("small", "id", (Column("id", "int"), Column("name", "text", True), Column("m", "money", True)))
ONE = Contract(tables=(SMALL,))


def write(tmp_path, text, encoding="utf-8", name="f.psv"):
    file = tmp_path / name
    file.write_bytes(text.encode(encoding))
    return str(file)


def test_pipe_file(spark, tmp_path):
    path = write(tmp_path, '1|Auto Parts, Inc.|0.10\n2||\n3|say "hi"|29.99\n4|back\\slash|1\n')
    df = C.conform(delimited.read_delimited(spark, path, SMALL), SMALL)
    assert [(r.id, r.name, r.m) for r in df.orderBy("id").collect()] == [
        (1, "Auto Parts, Inc.", Decimal("0.1000")), (2, None, None), (3, 'say "hi"', Decimal("29.9900")),
        (4, "back\\slash", Decimal("1.0000")),
    ]


def test_wrong_field_count_is_a_reject(spark, tmp_path):
    path = write(tmp_path, "1|a|1.0\n2|b\n3|c|1.0|x\n")
    df = C.conform(delimited.read_delimited(spark, path, SMALL), SMALL)
    assert C.accepted(df).count() == 1
    assert {(r.row_key, r.reason) for r in C.rejects(df, SMALL).collect()} == {("2", "wrong number of fields"), ("3", "wrong number of fields")}


@pytest.mark.parametrize("encoding", ["UTF-8", "UTF-16"])
def test_declared_encoding_keeps_every_row_and_letter(spark, tmp_path, encoding):
    path = write(tmp_path, "1|北方物流|1.0\n2|Škoda Parts|2.0\n", encoding)
    df = C.conform(delimited.read_delimited(spark, path, SMALL, encoding), SMALL)
    assert [r.name for r in C.accepted(df).orderBy("id").collect()] == ["北方物流", "Škoda Parts"]


def test_wrong_encoding_shows(spark, tmp_path):
    path = write(tmp_path, "1|Zürich|1.0\n", "latin-1")
    df = C.conform(delimited.read_delimited(spark, path, SMALL), SMALL)
    assert [r.reason for r in C.rejects(df, SMALL).collect()] == ["undecodable characters"]


def test_jdbc_options():
    o = jdbc.read_options(pay.PAYMENTS, "merchants", "jdbc:x", bounds=(1, 50), partitions=4)
    assert "CAST(merchant_guid AS VARCHAR(36)) AS merchant_guid" in o["dbtable"] and "dbo.merchants" in o["dbtable"]
    assert o["partitionColumn"] == "merchant_id" and o["upperBound"] == "51" and o["fetchsize"] == "5000"
    settlements = jdbc.read_options(pay.PAYMENTS, "settlements", "jdbc:x")
    assert "gross_amount" not in settlements["dbtable"] and "partitionColumn" not in settlements
    assert "net_amount DECIMAL(19,4)" in settlements["customSchema"]


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert not t.exists()
    with pytest.raises(LoadError):
        t.read()
    t.replace(spark.range(5))
    t.append(spark.range(5, 8))
    assert t.read().count() == 8
    t.replace(spark.range(2))
    assert t.read().count() == 2 and t.read(version=2).count() == 8
    assert [c.rows for c in t.commits()] == [5, 3, 2] and t.commits()[0].rows_per_second > 0


def test_failed_load_leaves_the_table_as_it_was(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace(spark.range(5))
    with pytest.raises(Exception):
        t.replace(spark.range(9).withColumn("id", F.raise_error(F.lit("lost")).cast("long")))
    assert t.read().count() == 5


def rows(spark, *values):
    return spark.createDataFrame([(str(i), n, m) for i, n, m in values], "id string, name string, m string")


def test_full_refresh_is_repeatable(spark, tmp_path):
    df = rows(spark, (1, "a", "1.0"), (2, "b", "bad"), (3, "c", "3.0"))
    for _ in range(2):
        report = full_refresh(spark, ONE, {"small": df}, str(tmp_path))[0]
    assert (report.rows, report.rejected, report.state) == (2, 1, "loaded")
    assert sorted(r.id for r in read_loaded(spark, ONE, str(tmp_path), "small").collect()) == [1, 3]
    assert [(r.row_key, r.column, r.value) for r in read_rejects(spark, ONE, str(tmp_path), "small").collect()] == [("2", "m", "bad")]
    full_refresh(spark, ONE, {"small": df}, str(tmp_path), append=True)
    assert read_loaded(spark, ONE, str(tmp_path), "small").count() == 4


def test_reject_policies(spark, tmp_path):
    good, bad = rows(spark, (1, "a", "1.0")), rows(spark, (1, "a", "x"), (2, "b", "2.0"))
    full_refresh(spark, ONE, {"small": good}, str(tmp_path))
    assert full_refresh(spark, ONE, {"small": bad}, str(tmp_path), policy="suspend")[0].state == "suspended"
    assert [r.id for r in read_loaded(spark, ONE, str(tmp_path), "small").collect()] == [1]
    with pytest.raises(LoadError):
        full_refresh(spark, ONE, {"small": bad}, str(tmp_path), policy="stop")
    assert full_refresh(spark, ONE, {"small": bad}, str(tmp_path), policy="suspend", reject_limit=1)[0].state == "loaded"
    assert [r.id for r in read_loaded(spark, ONE, str(tmp_path), "small").collect()] == [2]


def test_key_allocation_is_dense_and_stable(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"))
    made = keys.allocate_keys(df, "id", ["n"], above=100)
    first = {r.n: r.id for r in made.collect()}
    assert sorted(first.values()) == list(range(101, 1101))
    assert {r.n: r.id for r in keys.allocate_keys(df.repartition(7), "id", ["n"], above=100).collect()} == first


def test_clustered_layout_splits_a_hot_moment(spark, tmp_path):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).cast("timestamp").alias("at"))
    path = str(tmp_path / "c")
    tables.clustered(df, "at", "id", files=6).write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000


def test_export_layout_and_pruning(spark, sf, tmp_path):
    path = str(tmp_path / "e")
    rows = pay.transactions(spark, sf)
    export.export_by_day(rows, path)
    df = export.read_export(spark, path, "2000-01-01", "2000-01-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(capture_date" in plan
    assert "card_last4" not in df.columns and "auth_code" not in df.columns
    assert dict(df.dtypes)["amount"] == "decimal(19,4)"
    metrics = export.export_metrics(spark, path)
    assert metrics.agg(F.sum("rows")).first()[0] == rows.count()
    assert metrics.where("bytes <= 0").count() == 0


def test_export_replaces_days_and_keeps_others(spark, sf, tmp_path):
    path = str(tmp_path / "e")
    rows = pay.transactions(spark, sf)
    export.export_by_day(rows, path)
    export.export_by_day(rows, path, days=3)
    assert export.read_export(spark, path).count() == rows.count()


def test_days_without_rows_leave_the_export(spark, tmp_path):
    path = str(tmp_path / "e")

    def rows(*days):
        at = ", ".join(f"timestamp'2024-01-{d:02d} 10:00:00'" if d else "null" for d in days)
        return spark.sql(f"select 1L as txn_id, 1 as merchant_id, 1.0 as amount, 0.0 as fee_amount, 'USD' as currency, 'ok' as txn_status, explode(array({at})) as captured_at, cast(null as timestamp) as settled_at")

    held = lambda: sorted(r[0].day if r[0] else 0 for r in export.read_export(spark, path).select(export.DAY).collect())
    export.export_by_day(rows(1, 2, 3, 4, 5, 0), path)
    export.export_by_day(rows(3), path)
    assert held() == [0, 1, 2, 3, 4, 5]
    export.export_by_day(rows(1, 3, 5), path, days=2, drop_empty=True)
    assert held() == [0, 1, 2, 3, 5]
    export.export_by_day(rows(3, 5), path, drop_empty=True)
    assert held() == [0, 3, 5]
    export.export_by_day(rows(3).where("false"), path, days=2, drop_empty=True)
    assert held() == [0, 3, 5]
    export.export_by_day(rows(3).where("false"), path, drop_empty=True)
    assert held() == [0]


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256KB")
    try:
        rows = spark.range(200_000).select(
            F.col("id").alias("txn_id"), F.lit(1).alias("merchant_id"), F.rand(1).cast("decimal(19,4)").alias("amount"),
            F.lit(0).cast("decimal(19,4)").alias("fee_amount"), F.lit("USD ").alias("currency"), F.uuid().alias("txn_status"),
            F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 20)).alias("captured_at"),
            F.lit(None).cast("timestamp").alias("settled_at"),
        ).repartition(16)
        export.export_by_day(rows, str(tmp_path / "e"))
    finally:
        spark.conf.set(name, before)
    metrics = export.export_metrics(spark, str(tmp_path / "e"))
    hot = metrics.orderBy(F.col("rows").desc()).first()
    assert hot["rows"] > 60_000 and hot["files"] > 1
    assert spark.read.parquet(str(tmp_path / "e")).where("currency <> 'USD'").count() == 0


def test_change_schema():
    s = changelog.change_schema(pay.TRANSACTIONS)
    assert s.names[:4] == ["table_name", "seq", "commit_ts", "op"] and "amount" in s.names


def test_statistics_of_a_catalog_table(spark, tmp_path):
    spark.range(10).selectExpr("CAST(id AS INT) AS id", "'x' AS name", "CAST(1 AS DECIMAL(19,4)) AS m").write.parquet(str(tmp_path / "t"))
    spark.sql(f"CREATE TABLE stats_small USING parquet LOCATION '{tmp_path / 't'}'")
    try:
        tables.refresh_statistics(spark, "stats_small", SMALL)
        about = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED stats_small").collect()}
        assert "10 rows" in about["Statistics"]
    finally:
        spark.sql("DROP TABLE stats_small")


def test_new_guids_are_stable_and_spare_the_given_ones(spark):
    df = spark.createDataFrame([(1, None), (2, "keep")], "n int, g string")
    made = lambda: {r.n: r.g for r in keys.with_new_guids(df.repartition(2), "g", ["n"]).collect()}
    assert made() == made() and made()[2] == "keep" and len(made()[1]) == 36


def test_scratch_follows_the_session(spark):
    from proofline.session import scratch

    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(shared + "/x-") and scratch(spark, "x") != scratch(spark, "x")
