"""Reports over user rows keep the generating step and the customers' own columns."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.test_streaming import same
from tidemark.sources import readers


def test_datagen_users_are_generated(spark, folder):
    found = entry.queries()["datagen_users"](spark, folder)
    customers = readers.table(spark, folder, "customer")
    made = readers.generated_users(customers, "c_custkey").withColumn("subscribed", F.col("subscription").cast("int"))
    assert same(found, made, "id", "rating", "subscribed")
    own = customers.selectExpr("c_custkey AS id", "c_nationkey AS nation", "int(c_acctbal > 0) AS in_credit")
    assert same(found, own, "id", "nation", "in_credit")


def test_insert_select_inserts_them_all(spark, folder):
    found = entry.queries()["insert_select"](spark, folder)
    users = entry.queries()["datagen_users"](spark, folder)
    columns = ["rating", "subscribed", "nation", "in_credit"]
    assert found.columns == columns and same(found, users, *columns)
