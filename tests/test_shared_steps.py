from __future__ import annotations

from lendmill.plans import clean_queries, model_table, portfolio


def test_instalments_are_joined_once_for_all_fits(dom, monkeypatch):
    written = []
    monkeypatch.setattr(portfolio, "materialize", lambda df, label: written.append(label) or df)
    clean_queries.cln_assert_no_nulls(dom)
    assert written == ["installments"]


def test_medians_only_of_columns_with_gaps(spark, dom):
    df = spark.createDataFrame([(1.0, None, 2.0), (1.0, 2.0, float("nan"))], "a double, b double, c double")
    assert model_table.with_gaps(df, ["a", "b", "c"]) == ["b", "c"] and model_table.with_gaps(df, []) == []
