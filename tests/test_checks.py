"""Table constraints on rows with repeated, null and hot keys."""

from vacantia.operators import checks


def found(df):
    return sorted((r.table, r.rule, r.key) for r in df.collect())


def test_unique_keys_are_shared_out_by_rows(spark, monkeypatch):
    """Tasks are as many as the rows need, not as few as their small bytes allow."""
    monkeypatch.setattr(checks, "ROWS", 100)
    slugs = [f"s{i}" for i in range(900)] + ["hot"] * 600 + ["s7", "s8", None, None]
    got = checks.violations({"companies": spark.createDataFrame([(s,) for s in slugs], "slug string").repartition(5)})
    assert got.rdd.getNumPartitions() >= 16
    assert found(got) == sorted(("companies", "unique(slug)", key) for key in ("", "hot", "s7", "s8"))


def test_parts_follow_the_rows():
    assert [checks._parts(n) for n in (0, 1, 300_001, 60_000_000, 216_000_000, 480_000_000)] == [1, 1, 2, 200, 200, 400]


def test_references_with_repeated_parents_and_nulls(spark):
    companies = spark.createDataFrame([("a",), ("a",), (None,)], "slug string")
    runs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "x"), (4, "x"), (5, None)], "id long, company_slug string")
    got = checks.violations({"companies": companies, "company_runs": runs})
    assert found(got) == [
        ("companies", "unique(slug)", "a"), ("company_runs", "reference(company_slug)", "3"), ("company_runs", "reference(company_slug)", "4")
    ]
