"""Helpers that several operators share."""

from types import SimpleNamespace

import pyarrow as pa
import pytest

from tilewright.llm import common


def session(master, folder=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    assert common.shared_dir(session("spark://x", "hdfs://a")) == "hdfs://a"
    assert common.shared_dir(session("yarn", None, "hdfs://b")) == "hdfs://b"
    for master in ("yarn", "spark://x", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError):
            common.shared_dir(session(master))


def test_saved_tables_go_when_discarded(spark):
    saved = common.save(spark.range(5))
    assert saved.count() == 5
    common.discard(saved)
    files = spark._jvm.org.apache.hadoop.fs.Path(saved.saved_at)
    assert not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)


def test_keys_come_whole_and_slices_small():
    batch = lambda keys: pa.RecordBatch.from_pydict({"key": keys, "text": ["x" * 10] * len(keys)})
    tables = [t.column("key").to_pylist() for t in common.by_key(iter([batch([1, 1, 2]), batch([]), batch([2, 3]), batch([3, 3])]))]
    assert tables == [[1, 1], [2, 2], [3, 3, 3]]
    tables = [t.column("key").to_pylist() for t in common.by_key(iter([batch([1, 2, 3]), batch([3, 4])]), least=2)]
    assert tables == [[1, 2], [3, 3], [4]]
    sizes = [b.num_rows for b in common.slices(iter([batch([1] * 7)]), most=25)]
    assert sizes == [2, 2, 2, 1]
