import __spark_entry__ as E


def test_contract(spark):
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    df = E.entry(spark)
    assert df.columns == ["candidate", "committe", "party", "amt"]
    assert df.count() > 0


def test_flagship_plan_prunes_and_preaggregates(spark):
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
