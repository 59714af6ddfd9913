import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "xxhash" or name in {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
assert set(entry.oracle_sql()) <= set(entry.queries())
print(sum(not q.startswith("op") and q != "pipeline" for q in entry.queries()), len(entry.queries()))
"""


def test_the_rest_works_without_the_optional_part():
    for hidden in ([], ["corpus_pipeline"], ["shelfwise.llm"]):
        out = subprocess.run([sys.executable, "-c", PROBE.format(hidden=hidden)], cwd=HERE, capture_output=True, text=True)
        assert out.returncode == 0, out.stderr
        rest, every = map(int, out.stdout.split())
        assert rest == every and rest >= 97
