"""Declared tests of large relations are counted group by group, with the counts they
have all at once."""

import pytest

from larder.plans import declared_tests as D
from larder.plans.models import Models
from larder.params import TEST_PARAMS

from conftest import SF001

DECLARED = {"child": {"k": ["unique", "not_null"], "p": ["not_null", ("relationships", ("parent", "id"))],
                      "s": [("accepted_values", ("x",)), "unique"]}, "parent": {"id": ["unique", "not_null"]}}


@pytest.fixture()
def relations(spark, scratch):
    rows = {"child": spark.createDataFrame([(1, "a", "x"), (1, "a", None), (2, None, "y"), (None, "b", "x"),
                                            (None, "zz", "q"), (3, "zz", "q")], "k long, p string, s string"),
            "parent": spark.createDataFrame([("a",), (None,)], "id string")}
    for name, df in rows.items():
        df.write.parquet(f"{scratch}/{name}")
    return {name: spark.read.schema(df.schema).parquet(f"{scratch}/{name}") for name, df in rows.items()}


def counts(relations, declared=None):
    return sorted(map(tuple, D.run_declared_tests(relations, declared).collect()))


def test_groups_count_what_one_group_counts(relations, monkeypatch):
    tests = D.declared_list(DECLARED)
    assert len(D.groups(relations, tests)) == 1
    want = counts(relations, DECLARED)
    got = {r[3]: r[4] for r in want}
    assert got == {"unique_child_k": 1, "not_null_child_k": 2, "not_null_child_p": 1, "relationships_child_p": 3,
                   "accepted_values_child_s": 2, "unique_child_s": 2, "unique_parent_id": 0, "not_null_parent_id": 1}
    monkeypatch.setattr(D, "GROUP_BYTES", 0)
    # Two unique columns, a relationship and the rest; one unique column and the rest.
    assert len(D.groups(relations, tests)) == 4 + 2
    assert counts(relations, DECLARED) == want


def test_small_relations_share_groups_of_bounded_bytes(relations, monkeypatch):
    size = {name: D.source_bytes(df) for name, df in relations.items()}
    assert all(0 < n < 10_000 for n in size.values())
    monkeypatch.setattr(D, "GROUP_BYTES", max(size.values()))
    assert len(D.groups(relations, D.declared_list(DECLARED))) == 2
    monkeypatch.setattr(D, "GROUP_BYTES", sum(size.values()))
    assert len(D.groups(relations, D.declared_list(DECLARED))) == 1


def test_every_declared_test_has_one_place(spark, monkeypatch):
    m = Models.from_testdata(spark, SF001, TEST_PARAMS)
    relations = {n: df for n, df in D.test_relations(m).items() if n.startswith(("raw_", "stg_"))}
    declared = {n: t for n, t in D.DECLARED.items() if n in relations}
    want = counts(relations, declared)
    monkeypatch.setattr(D, "GROUP_BYTES", 0)
    assert counts(relations, declared) == want and len(want) == len(D.declared_list(declared))
