"""Property: merge_upsert equals the dictionary upsert (null keys never match)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larder.operators.merge import merge_upsert

keys = st.one_of(st.none(), st.sampled_from([f"k{i}" for i in range(12)]))
rows = st.lists(st.tuples(keys, st.integers(-5, 5)), max_size=12)


def unique_keys(rs):
    seen, out = set(), []
    for k, v in rs:
        if k is None or k not in seen:
            out.append((k, v))
            if k is not None:
                seen.add(k)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, updates=rows)
def test_merge_upsert_matches_dict_model(spark, target, updates):
    target, updates = unique_keys(target), unique_keys(updates)
    schema = "surrogate_key string, v int"
    t = spark.createDataFrame(target, schema)
    u = spark.createDataFrame(updates, schema)
    got = sorted(((r.surrogate_key, r.v) for r in merge_upsert(t, u).collect()), key=repr)
    upd_keys = {k for k, _ in updates if k is not None}
    want = [(k, v) for k, v in target if k is None or k not in upd_keys] + list(updates)
    assert got == sorted(want, key=repr)
