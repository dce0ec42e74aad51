import os
import subprocess
import sys

from conftest import SMALL  # noqa: F401  (puts the repository on the path)

WITHOUT = """
import sys, warnings
class Absent:
    def find_spec(self, name, *args):
        if name.split(".")[0] in {names}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__
found = set(__spark_entry__.queries())
print(len(found) > 80, any(name.startswith("op") for name in found), "pipeline" in found, len(said) > 0)
"""


ROOT = __file__.rpartition("/tests/")[0]


def without(*names):
    code, root = WITHOUT.format(names=set(names)), ROOT
    return subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True, timeout=120).stdout.split()


def test_core_queries_do_without_the_needs_of_the_subpackage():
    said = str(os.path.exists(f"{ROOT}/corpus_pipeline.py"))
    assert without("public_tokenizers") == ["True", "False", "False", said]
    assert without("xxhash") == ["True", "False", "False", said]


def test_core_queries_do_without_the_subpackage():
    assert without("corpus_pipeline") == ["True", "False", "False", "False"]
