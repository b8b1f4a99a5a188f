"""The entry without the text operators or the libraries that only they need."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
PROBE = """
import sys
sys.path.insert(0, {repo!r})
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as e
print(len(e.queries()), sum(n.startswith("op") and n[2:3].isdigit() or n == "pipeline" for n in e.queries()))
"""


def count(*blocked):
    out = subprocess.run([sys.executable, "-c", PROBE.format(repo=str(REPO), blocked=blocked)],
                         capture_output=True, text=True, check=True)
    return tuple(map(int, out.stdout.split()))


def test_ledger_queries_load_without_what_the_text_operators_need():
    ledger = count("ledgerflow.llm")
    assert ledger[1] == 0 and ledger[0] > 50
    for name in ("xxhash", "regex", "numpy", "corpus_pipeline"):
        assert count(name) == ledger, name
