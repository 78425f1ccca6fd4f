"""The driver contract: keys, oracles, column names."""

import __spark_entry__ as E
from chanlake.plans import catalog


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_columns_unique_and_named(spark):
    for key, fn in catalog.QUERIES.items():
        if key.startswith("stream_") or key in ("csv_roundtrip", "scan_csv", "json_roundtrip", "scan_json",
                                                 "conll_roundtrip", "channel_store", "merge_channels",
                                                 "warehouse_build"):
            continue                                  # these write files; covered by test_oracle
        cols = fn(spark, "/root/testdata/sf0.001").columns
        assert len(cols) == len(set(cols)), key
        assert all(c and "(" not in c for c in cols), (key, cols)


def test_entry_without_the_training_data_subpackage():
    """Without chanlake.llm and corpus_pipeline the entry module still imports and lists the other queries."""
    import subprocess
    import sys
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[:2] == ['chanlake', 'llm'] or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError('gone', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "from chanlake.plans import catalog\n"
        "assert set(e.queries()) == set(catalog.QUERIES) and set(e.oracle_sql()) == set(catalog.ORACLES)\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
