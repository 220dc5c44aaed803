from collections import Counter

from marlweave.operators.skew import dense_counts, leading

KIND = "tenant_id string, name string, n string"


def test_counts_with_a_hot_key_ties_nulls_and_clashing_columns(spark):
    rows = [("t", "hot", "x")] * 400 + [("t", f"n{i}", "x") for i in range(300)] + [("u", "b", None), ("u", "a", None), (None, "a", "x"), ("u", None, "x")]
    got = {(r.tenant_id, r.name): r.n for r in dense_counts(spark.createDataFrame(rows, KIND).repartition(5), ["tenant_id", "name"]).collect()}
    assert got == dict(Counter((a, b) for a, b, _ in rows if a and b))


def test_leading_takes_the_smallest_of_equals(spark):
    rows = [("t", "b", "")] * 2 + [("t", "a", "")] * 2 + [("t", "c", "")]
    assert [tuple(r) for r in leading(dense_counts(spark.createDataFrame(rows, KIND), ["tenant_id", "name"]), "tenant_id", "name").collect()] == [("t", "a", 2)]


def test_empty_and_one_key(spark):
    empty = spark.createDataFrame([], KIND)
    assert dense_counts(empty, ["tenant_id", "name"]).count() == 0
    assert [tuple(r) for r in dense_counts(spark.createDataFrame([("t", "", "")] * 3, KIND), ["name"]).collect()] == [("", 3)]
