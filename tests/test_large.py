"""Arrays that do not fit, in a session of its own with a small heap."""

import os
import subprocess
import sys

import pytest

from dossier.operators.nesting import HEAP_SHARE, MAX_ARRAY_BYTES, array_limit
from tests.test_nesting import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
from pyspark.sql import SparkSession, functions as F
from dossier.plans.documents import build_customer_accounts, build_customer_documents
from dossier.schemas import ACCOUNT_RAW, ADDRESS_RAW, CUSTOMER

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{folder}").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
customers = spark.createDataFrame([("big", "f", "s"), ("small", "f", "s")], CUSTOMER)
rows = spark.range(0, 1_200_000, 1, 8)
long = F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 1000))
big = rows.select(F.lit("big").alias("customerId"), long.alias("accountId"), F.lit("1").alias("balance"))
other = spark.createDataFrame([("small", "A", "4")], ACCOUNT_RAW)
try:
    build_customer_accounts(customers, big.unionByName(other)).write.format("noop").mode("overwrite").save()
except Exception as error:
    print("accounts:", "accounts of big do not fit one row" in str(error))
places = big.select(F.col("accountId").alias("addressId"), "customerId", F.lit("1, a, b, c").alias("address"))
stage = build_customer_accounts(customers, other)
try:
    build_customer_documents(stage, places).write.format("noop").mode("overwrite").save()
except Exception as error:
    print("addresses:", "address of big do not fit one row" in str(error))
print("alive:", [(r.customerId, r.numberAccounts) for r in stage.orderBy("customerId").collect()])
"""


def test_an_array_beyond_the_heap_fails_by_name_and_the_session_lives_on(tmp_path):
    """1.2 GB of one customer's records in a heap of 512 MB."""
    settings = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--driver-memory 512m pyspark-shell"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.replace("{folder}", str(tmp_path))],
        env=settings, capture_output=True, text=True, timeout=600,
    )
    assert run.stdout.split("\n")[:3] == ["accounts: True", "addresses: True", "alive: [('big', 0), ('small', 1)]"], run.stderr[-3000:]


def sized(memory):
    found = session("yarn")
    found.sparkContext.getConf = lambda: {"spark.executor.memory": memory} if memory else {}
    return found


@pytest.mark.parametrize("memory, heap", [(None, 1 << 30), ("4g", 4 << 30), ("512m", 512 << 20), ("2048", 2048 << 20), ("6GB", 6 << 30)])
def test_the_limit_follows_the_executors(memory, heap):
    assert array_limit(sized(memory)) == heap // HEAP_SHARE


def test_the_limit_has_a_limit():
    assert array_limit(sized("64g")) == MAX_ARRAY_BYTES
