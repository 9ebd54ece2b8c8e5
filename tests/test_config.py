"""Configuration: targets of both kinds, loads from a work list, and the kind of mask."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulage.operators import masking
from haulage.plans.extract import extract_table
from haulage.plans.worklist import loads
from haulage.sources.config import connection_rows, read_target, recoverable
from tests import standin
from tests.test_runs import asked, job, load  # noqa: F401


def file(path, text):
    path.write_text(text)
    return str(path)


def test_targets(spark, tmp_path):
    lake = file(tmp_path / "lake.csv", "target_kind,write_format,folder_structure,access_key,account_name,container_name\nBlob,parquet,/raw,k,a,c\n")
    found = read_target(spark, lake)
    assert found.kind == "blob" and found.database is None and recoverable(found)
    columns = "db_password,target_kind,rdbms_type,database_name,db_url,db_driver,db_user,schema_name,write_format\n"
    there = read_target(spark, file(tmp_path / "db.csv", columns + "geheim,RDBMS,MSSQL,shop,jdbc:sqlserver://h/,drv,me,dbo,\n"))
    assert there.kind == "rdbms" and there.schema_name == "dbo" and "geheim" not in repr(there)
    assert there.database.vendor == "mssql" and there.database.url.startswith("jdbc:sqlserver://h;databaseName=shop;")
    assert there.database.options()["password"] == "geheim"
    with pytest.raises(ValueError, match="db_url"):
        read_target(spark, file(tmp_path / "bad.csv", columns + ",rdbms,mysql,shop,,drv,me,,\n"))


def test_a_target_gives_the_job_its_database(job, spark, tmp_path):  # noqa: F811
    assert job.database == (None, None)
    text = "target_kind,rdbms_type,database_name,db_url,db_driver,schema_name\nrdbms,mysql,shop,jdbc:mysql://h/,drv,s\n"
    given = replace(job, target=read_target(spark, file(tmp_path / "t.csv", text)))
    assert given.database[0].url == "jdbc:mysql://h/shop" and given.database[1] == "s"
    assert replace(given, target_connection=standin.SOURCE, target_schema="x").database == (standin.SOURCE, "x")


WORK = "log_id int, table_key string, sources string, db_types string, tables string, databases string, schemas string"


def test_loads(spark, tmp_path):
    work = spark.createDataFrame(
        [(2, "shop.orders", "shop", "mysql", "orders", "shop", None), (1, "crm.people", "crm", "MSSQL", "people", "crm", "dbo")], WORK
    )
    path = file(
        tmp_path / "c.json",
        '{"rdbms": "mssql", "jdbc_url": "jdbc:sqlserver://h:1/", "db_driver": "d1", "user_name": "u1", "password": "in file"}\n'
        '{"rdbms": "mysql", "jdbc_url": "jdbc:mysql://h:2/", "db_driver": "d2", "user_name": "u2", "db_name": "x"}\n',
    )
    masks = spark.createDataFrame(
        [("shop.orders", "b"), ("shop.orders", "a"), ("shop.orders", "a"), ("shop.orders2", "z")], "table_key string, column_name string"
    )
    found = loads(work, connection_rows(spark, path), masks, {"mssql": "p1", "mysql": None}.get)
    assert [x.log_id for x in found] == [1, 2] and [x.masked_columns for x in found] == [(), ("a", "b")]
    assert found[0].connection.url.startswith("jdbc:sqlserver://h:1;databaseName=crm;")
    assert found[0].connection.password == "p1" and found[0].spec.schema == "dbo" and found[0].connection.user == "u1"
    assert found[1].connection.url == "jdbc:mysql://h:2/shop" and found[1].connection.password is None
    assert [x.masked_columns for x in loads(work, connection_rows(spark, path), None, lambda v: None)] == [(), ()]
    with pytest.raises(ValueError, match="more than once: 1"):
        loads(work.withColumn("log_id", F.lit(1)), connection_rows(spark, path), None, lambda v: None)
    with pytest.raises(ValueError, match="crm.people"):
        loads(work, connection_rows(spark, path).filter("rdbms = 'mysql'"), None, lambda v: None)


def test_a_job_can_mask_reversibly(spark, asked, job, load):  # noqa: F811
    key = "0123456789abcdef"
    open_ = replace(job, mask_kind="aes", mask_key=key, salt="")
    assert key not in repr(open_)
    assert extract_table(spark, open_, load) == "Success"
    hidden = spark.table(f"{job.target.masked_zone}.s_orders_masked").drop("iteration")
    assert hidden.join(spark.table("s_orders"), ["o_orderkey", "o_orderstatus"]).count() == 0
    shown = hidden.withColumn("o_orderstatus", masking.decrypted(F.col("o_orderstatus"), F.lit(key)))
    assert shown.exceptAll(spark.table("s_orders")).count() == 0 and shown.count() == 1500


def test_masks_are_checked(job):  # noqa: F811
    with pytest.raises(ValueError, match="salt"):
        replace(job, salt="").mask.check()
    with pytest.raises(ValueError, match="16, 24 or 32"):
        replace(job, mask_kind="aes", mask_key="short").mask  # noqa: B018
    with pytest.raises(ValueError, match="no mask"):
        masking.Mask("rot13", "x")
