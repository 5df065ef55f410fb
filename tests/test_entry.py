"""The driver's entry points without the optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["tiktoken", "ahocorasick", "tierwise.llm", "corpus_pipeline"])
def test_core_keys_without_an_optional_module(missing):
    code = f"""
import sys, warnings
warnings.simplefilter("ignore")
sys.path.insert(0, {ROOT!r})
sys.modules[{missing!r}] = None
import __spark_entry__ as E
keys = set(E.queries())
assert len(keys) == 50 and set(E.oracle_sql()) == keys and not any(k.startswith("op") for k in keys), keys
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
