"""The plans keep the shapes that matter on large inputs."""

from checks import inputs, queries
from kindred.operators import skew

SF_DIR = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_no_query_has_a_cross_join_or_python_worker(spark):
    for name, query in queries.QUERIES.items():
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert word not in plan, name


def test_only_needed_columns_are_read(spark):
    plan = queries.similar_pairs_exact(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_the_split_day_reaches_the_scan(spark):
    plan = inputs.train(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in plan


def test_top_words_are_cut_before_the_shuffle(spark):
    plan = final_plan(queries.business_profiles(spark, SF_DIR))
    assert "row_number(), 200, Partial" in plan


def test_self_joined_ratings_are_shuffled_once(spark):
    assert "ReusedExchange" in final_plan(queries.pair_moments(spark, SF_DIR))


def test_predictions_join_the_given_tables_once(spark):
    for query in (queries.user_cf_rmse, queries.item_cf_predict):
        assert "lineitem.parquet" not in query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_parts_of_the_input_follow_its_rows(spark, monkeypatch):
    few = inputs.ratings(spark, SF_DIR)  # 6,000 rows, whatever the runtime makes of them
    monkeypatch.setattr(skew, "PART_ROWS", 100)
    many = inputs.ratings(spark, SF_DIR)
    assert many.rdd.getNumPartitions() == 60
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, few.collect()), key=repr)


def test_an_even_join_keeps_repeated_keys_and_drops_null_ones(spark, monkeypatch):
    monkeypatch.setattr(skew, "PART_ROWS", 2)
    left = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(60)], "k long, x long")
    right = spark.createDataFrame([(k, y) for k in (0, 1, 2, None) for y in (1, 2)], "k long, y long")
    joined = skew.even_join(left, right, "k")
    assert joined.rdd.getNumPartitions() == 30
    wanted = [(i % 7, i, y) for i in range(60) if i % 5 and i % 7 < 3 for y in (1, 2)]
    assert sorted(map(tuple, joined.collect())) == sorted(wanted)
