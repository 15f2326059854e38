"""Scratch data lives under the cluster's spark.checkpoint.dir."""

import pytest

from loomlog.session import checkpoint_root, scratch_path


def test_scratch_under_session_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(configured.rstrip("/") + "/") and a != b


def test_launcher_settings_win(tmp_path):
    # Under spark-submit, the launcher's master and settings are kept;
    # only unset ones get the library's defaults.
    import os
    import subprocess
    import sys
    import pyspark
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "probe.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {repo!r})\n"
        "from loomlog.session import build_session\n"
        "s = build_session(app='probe')\n"
        "print('PROBE', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'),"
        " s.conf.get('spark.sql.session.timeZone'))\n")
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"}
    env["PYSPARK_PYTHON"] = sys.executable
    out = subprocess.run([submit, "--master", "local[3]", "--conf", "spark.sql.shuffle.partitions=77",
                          "--conf", "spark.ui.enabled=false", str(script)],
                         capture_output=True, text=True, timeout=300, env=env).stdout
    assert "PROBE local[3] 77 UTC" in out


def test_scratch_is_released(spark, workdir):
    import os
    from loomlog.session import drop_scratch, scratch_path
    path = scratch_path(spark, "probe")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    drop_scratch(spark, path)
    assert not os.path.exists(local)
    with pytest.raises(ValueError):
        drop_scratch(spark, workdir)
