from boreflow.operators import governance as G
from tests.conftest import rows


def _df(spark):
    return spark.createDataFrame(
        [("W-1 C", 1.5, 10.0), ("W-15 D", 2.5, 20.0), ("W-5", 3.5, 30.0)],
        "well_name string, avg_whp double, benchmark_revenue_usd double")


POLICY = G.Policy(restricted={"VIEWER": ("W-1 C", "W-15 D")})


def test_roles(spark):
    df = _df(spark)
    eng = G.governed(df, "ENGINEER", POLICY)
    assert eng.count() == 3 and eng.where("avg_whp IS NULL").count() == 0
    ana = G.governed(df, "ANALYST", POLICY)
    assert ana.count() == 3
    view = G.governed(df, "VIEWER", POLICY)
    assert sorted(r.well_name for r in view.collect()) == ["W-1 C", "W-15 D"]
    assert view.where("avg_whp IS NOT NULL OR benchmark_revenue_usd IS NOT NULL").count() == 0
    assert view.schema == df.schema                                  # mask keeps the schema
    unknown = G.governed(df, "SOMEONE", POLICY)
    assert unknown.count() == 0 and unknown.schema == df.schema


def test_policy_table_and_compare(spark):
    df = _df(spark)
    pol = spark.createDataFrame([("ENGINEER", "*"), ("ENGINEER", "W-5"), ("VIEWER", "W-5"), ("VIEWER", "W-5")],
                                "role string, entity string")
    assert G.row_filter_table(df, "ENGINEER", pol).count() == 3
    assert [r.well_name for r in G.row_filter_table(df, "VIEWER", pol).collect()] == ["W-5"]
    assert G.row_filter_table(df, "NOBODY", pol).count() == 0
    cmp = {r.role: (r.wells_visible, r.rows_visible, r.avg_whp_visible)
           for r in G.compare_roles(df, ["ENGINEER", "VIEWER"], POLICY).collect()}
    assert cmp == {"ENGINEER": (3, 3, 3), "VIEWER": (2, 2, 0)}


def test_one_text_under_several_roles(spark):
    rows_ = [("a", 1.0, 5), ("b", 2.0, 6), (None, 3.0, 7)]
    df = spark.createDataFrame(rows_, "well_name string, avg_whp double, n int")
    policy = spark.createDataFrame([("all", "*"), ("all", "a"), ("some", "a"), ("some", "a"), ("some", "zz")], "role string, entity string")
    G.governed_view(spark, "governed_test", df, policy, ["avg_whp"])
    text, made = "SELECT well_name, avg_whp, n FROM governed_test", {}
    for role in ("all", "some", "none", "it's"):
        G.use_role(spark, role)
        made[role] = spark.sql(text)
    # a frame keeps the role it was made under
    assert rows(made["all"]) == rows(df) and rows(made["some"]) == [("a", None, 5)]
    assert rows(made["none"]) == [] and rows(made["it's"]) == []
    assert made["some"].schema["avg_whp"].dataType.simpleString() == "double"
    G.use_role(spark, "some")
    plan = spark.sql(text)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
