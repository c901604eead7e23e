import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["_id", "amount", "timestamp", "transactionFee"]
    assert df.count() > 0


def test_every_library_query_has_an_oracle():
    from txstream.plans.oracle import ORACLE
    from txstream.plans.queries import QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_workers_import_the_package_from_any_directory(tmp_path):
    """Pandas stages must work when the driver does not run from the repository."""
    import subprocess
    import sys
    from pathlib import Path
    repo = Path(__file__).resolve().parents[1]
    code = ("import sys; sys.path.insert(0, %r)\n"
            "import __spark_entry__ as e\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false')"
            ".getOrCreate()\n"
            "print('ROWS', e.queries()['keyed_order'](s, '/root/testdata/sf0.001').count())\n"
            % str(repo))
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]


def test_cleanup_scratch_only_removes_old_folders(spark, scratch):
    import os
    import time
    from txstream.session import cleanup_scratch
    root = scratch("cleanup-root")
    os.makedirs(f"{root}/old-a/x")
    os.makedirs(f"{root}/old-b")
    past = time.time() - 7200
    for d in ("old-a", "old-b"):
        os.utime(f"{root}/{d}", (past, past))
    os.makedirs(f"{root}/new-c")
    assert cleanup_scratch(spark, 3600, root=root) == 2
    assert sorted(os.listdir(root)) == ["new-c"]
