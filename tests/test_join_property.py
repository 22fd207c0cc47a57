"""Property test: the salted left join equals the plain left join for any
row layout across tasks (salts may get no rows)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronofeat.operators import frame as ops

key = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(key, min_size=1, max_size=8),
       right=st.lists(st.tuples(key, st.integers(0, 3)), min_size=0, max_size=40),
       slices=st.integers(1, 12), budget=st.integers(1, 6))
def test_salted_equals_plain(spark, left, right, slices, budget):
    a = spark.createDataFrame([(k, f"l{i}") for i, k in enumerate(left)], "k long, a string")
    b = spark.createDataFrame(spark.sparkContext.parallelize([(k, float(v)) for k, v in right], slices)
                              if right else spark.sparkContext.emptyRDD(), "k long, b double")
    plain = sorted(map(tuple, ops.join_left(a, b, ["k"]).collect()), key=str)
    salted = sorted(map(tuple, ops.join_left(a, b, ["k"], max_rows_per_key=budget).collect()), key=str)
    assert salted == plain
