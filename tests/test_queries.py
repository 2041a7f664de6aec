"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, queries()[name], oracle_sql().get(name)) is None


def test_entry(spark):
    assert entry(spark).columns == ["shard", "key", "txt", "batch_id"]


#: Queries that once stopped on a cluster whose spark.checkpoint.dir names no file system.
ON_A_CLUSTER = """
    add_fields_in_place add_fields_last_wins align_captions_to_images assign_batches_drop_tail assign_batches_keep_tail
    avg_clip_score caption_images_job caption_job caption_projection caption_roundtrip clean_captions clip_score
    colourful_filter coalesce_rename completed_listing declarative_spec completed_union decoded_clean decode_rejects
    first_batch dominant_share generate_text""".split()
RUN = """
import os, sys
from pyspark.sql import SparkSession
from __spark_entry__ import queries

folder, sf_dir, *names = sys.argv[1:]
conf = {
    "spark.master": "local-cluster[1,4,1000]", "spark.executor.memory": "600m", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": folder,
}
spark = SparkSession.builder.config(map=conf).getOrCreate()
for name in names:
    queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    print("ended", name, flush=True)
os._exit(0)
"""


def test_queries_on_a_cluster_with_a_plain_checkpoint_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": root, "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1"}
    command = [sys.executable, "-c", RUN, str(tmp_path / "shared"), SF_DIR, *ON_A_CLUSTER]
    out = subprocess.run(command, env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert [line.split()[1] for line in out.stdout.splitlines() if line.startswith("ended")] == ON_A_CLUSTER, out.stderr[-2000:]
