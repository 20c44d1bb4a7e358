import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
from corpusloom.session import local_session
spark = local_session("2", "2g")
folder = "/root/testdata/sf0.001"
for name in ("page_records", "generated_pairs", "rouge1_stemmed", "rouge_l", "embedding_match_f1", "near_dup_drop"):
    print(name, entry.queries()[name](spark, folder).count())
"""


def test_workers_need_no_installed_package(tmp_path):
    """Python workers start in a folder from which the package cannot be imported."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert "near_dup_drop" in done.stdout
