import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
from usagelens.llm import fill_middle, hard_negatives, naive_bayes, one_permutation
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", {folder!r}).getOrCreate())
docs = spark.createDataFrame([(1, "some words here", "en"), (2, "some words here", "en")], "doc_id long, text string, lang string")
print("rows", fill_middle.fill_in_middle(docs).count(), naive_bayes.identify(docs, naive_bayes.fit(docs)).count(),
      one_permutation.near_duplicates(docs).where("kept").count())
spark.stop()
"""


def test_operators_run_from_any_directory_without_the_package_installed(tmp_path):
    repo = str(Path(__file__).resolve().parents[2])
    found = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, folder=str(tmp_path / "warehouse"))],
                           cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 2 2 1" in found.stdout, found.stderr[-2000:]
