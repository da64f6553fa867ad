"""Properties over generated data: change logs in Spark."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from test_cdc import ARGS, SCHEMA, at, model, rows
from tidemark.operators.cdc import scd2

EVENT = st.tuples(
    st.sampled_from(["A", "B", "C", None]),
    st.sampled_from(["x", "y", None]),
    st.sampled_from(["INSERT", "UPDATE", "DELETE", None]),
    st.one_of(st.none(), st.integers(0, 20).map(at)),
)


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(log=st.lists(EVENT, min_size=1, max_size=60), hot_rows=st.sampled_from([None, 1, 5]))
def test_versions_follow_the_model_and_do_not_overlap(spark, log, hot_rows):
    versions = rows(scd2(spark.createDataFrame(log, SCHEMA), hot_rows=hot_rows, **ARGS))
    assert versions == model(log)
    by_key = {}
    for key, _, start, end in versions:
        by_key.setdefault(key, []).append((start, end))
    for spans in by_key.values():
        spans.sort()
        assert all(end is not None and end <= later for (_, end), (later, _) in zip(spans, spans[1:]))
