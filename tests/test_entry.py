"""The driver's entry with and without the training-data subpackage."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OWN = ("corpus_pipeline", "cohortloom.llm")


class Fails:
    """Import hook that raises for some modules."""

    def __init__(self, modules, error):
        self.modules, self.error = modules, error

    def find_spec(self, name, path, target=None):
        if name.startswith(self.modules):
            raise self.error(name)


@pytest.fixture()
def entry(monkeypatch):
    monkeypatch.syspath_prepend(ROOT)
    import cohortloom

    for name in [m for m in sys.modules if m.startswith(OWN)]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delattr(cohortloom, "llm", raising=False)
    import __spark_entry__

    return __spark_entry__


def test_the_library_stands_without_the_subpackage(entry, monkeypatch):
    gone = Fails(OWN, lambda name: ModuleNotFoundError(f"No module named {name!r}", name=name))
    monkeypatch.setattr(sys, "meta_path", [gone, *sys.meta_path])
    assert set(entry.queries()) == set(entry.oracle_sql()) and not any(k.startswith("op") and k[2].isdigit() for k in entry.queries())


@pytest.mark.parametrize("error", [
    lambda name: ImportError("a name is missing", name=name),
    lambda name: ModuleNotFoundError("No module named 'numpy_of_tomorrow'", name="numpy_of_tomorrow"),
])
def test_a_fault_inside_the_subpackage_shows(entry, monkeypatch, error):
    monkeypatch.setattr(sys, "meta_path", [Fails(("corpus_pipeline",), error), *sys.meta_path])
    with pytest.raises(ImportError):
        entry.queries()
