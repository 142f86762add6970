from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload.oracles import ORACLES
from workload.queries import QUERIES


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_absent_modules_are_left_out_and_broken_ones_are_not(tmp_path, monkeypatch):
    (tmp_path / "broken_module_of_a_test.py").write_text("import no_such_module_at_all\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert entry._optional("no_such_module_at_all") is None
    assert entry._optional("no_such_package.inside") is None
    with pytest.raises(ModuleNotFoundError, match="no_such_module_at_all"):
        entry._optional("broken_module_of_a_test")
