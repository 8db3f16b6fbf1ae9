"""What a task of the footprint reads follows neither the tables nor a low number of shuffle partitions."""

import __spark_entry__ as contract
from pyspark.sql import functions as F
from sootledger import session
from sootledger.operators.ranking import first_per_key


def test_few_partitions_do_not_fill_tasks(spark):
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(2_000_000).select("id", F.hash("id").alias("load_order"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        contract.queries()["panel_top_trips_resent"](spark, "/root/testdata/sf0.001")
        once = first_per_key(rows, "id", ["load_order"])
        assert once.rdd.getNumPartitions() > 2 and once.count() == 2_000_000
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
        for key in session.SPREAD:
            spark.conf.unset(key)
