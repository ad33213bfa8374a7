import subprocess
import sys
import time
from pathlib import Path

import pytest

from wardspark.session import checkpoint_root, scratch_path, scratch_scope, stage


def test_staged_tables_go_with_their_scope(spark):
    before = stage(spark.range(3), "before")
    with scratch_scope(spark):
        inner = stage(spark.range(5), "inner")
        with scratch_scope(spark):
            nested = stage(spark.range(2), "nested")
            assert nested.count() == 2
        assert inner.count() == 5
        folders = [Path(df.inputFiles()[0].removeprefix("file:")).parent for df in (inner, nested)]
        assert folders[0].exists() and not folders[1].exists()
    assert not any(f.exists() for f in folders)
    assert before.count() == 3


def test_staged_tables_stay_after_a_failure(spark):
    with pytest.raises(ValueError), scratch_scope(spark):
        kept = stage(spark.range(4), "kept")
        raise ValueError
    assert kept.count() == 4


def test_paths_are_new_and_below_the_shared_folder(spark):
    paths = {scratch_path(spark, "name") for _ in range(5)}
    root = checkpoint_root(spark)
    assert len(paths) == 5 and all(p.startswith(f"{root}/wardspark-{spark.sparkContext.applicationId}/") for p in paths)


def test_the_application_s_folder_goes_with_the_driver(tmp_path):
    code = (
        "from wardspark.session import build_session, stage\n"
        f"s = build_session('ends', 'local[1]', **{{'spark.checkpoint.dir': 'file:{tmp_path}', 'spark.ui.enabled': 'false'}})\n"
        "assert stage(s.range(3), 'x').count() == 3\n"
        f"import os; print([d for d in os.listdir('{tmp_path}') if d.startswith('wardspark')])\n"
        "s.stop()\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parent.parent, timeout=180)
    assert done.returncode == 0 and "wardspark-local" in done.stdout, done.stderr[-2000:]
    for _ in range(60):
        if not list(tmp_path.glob("wardspark-*")):
            return
        time.sleep(0.5)
    raise AssertionError("the folder stayed")
