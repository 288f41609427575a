"""The package read from an archive, by a session that does not have it on its path."""

import os
import subprocess
import sys
import zipfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.addPyFile(sys.argv[1])
import asiento as A
assert A.__file__.startswith(sys.argv[1])
pages = spark.createDataFrame([(1, "https://h/", "<a href=x>y</a>")], "id int, url string, html string")
print("FOUND", A.extract_links(pages, ["id"], absolute=True).first().href)
spark.stop()
"""


def test_reader_runs_from_a_shipped_archive(tmp_path):
    archive = tmp_path / "asiento.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for path in (ROOT / "asiento").rglob("*.py"):
            files.write(path, path.relative_to(ROOT))
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(archive)], cwd=tmp_path, capture_output=True, text=True, timeout=240,
        env={name: value for name, value in os.environ.items() if name != "PYTHONPATH"},
    )
    assert "FOUND https://h/x" in run.stdout, run.stderr[-2000:]
