import __spark_entry__ as E


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    assert "gold_fact" in q and "gold_fact" in o


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "weather_id" in df.columns and "usgs_id" in df.columns


def test_entry_survives_a_package_that_only_the_optional_part_needs():
    import os
    import subprocess
    import sys

    code = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] in ('tiktoken', 'ahocorasick'):
            raise ImportError('blocked ' + name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
print(len(e.queries()), 'gold_fact' in e.queries())
"""
    root = os.path.dirname(os.path.abspath(E.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    count, flagship = out.stdout.split()[-2:]
    assert int(count) >= 60 and flagship == "True"
