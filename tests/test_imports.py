"""Every module imports on its own (no import cycles hidden by import order)."""

import os
import pkgutil
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

import evstar

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
MODULES = sorted(m.name for m in pkgutil.walk_packages(evstar.__path__, "evstar."))


def import_alone(module):
    return subprocess.run([sys.executable, "-c", f"import {module}"], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_modules_import_alone():
    with ThreadPoolExecutor(4) as pool:
        results = dict(zip(MODULES, pool.map(import_alone, MODULES)))
    assert {m: r.stderr[-500:] for m, r in results.items() if r.returncode} == {}
