"""First match: lowest rank of all entries, and no more rows than queries between the joins."""

from tessera.operators import relational as R


def test_a_word_of_many_entries_meets_each_query_once(spark):
    q = spark.range(2000).selectExpr("id AS k", "CASE WHEN id < 1900 THEN 'hot' ELSE 'cold' END AS word").union(spark.sql("SELECT 5L, 'cold'")).union(spark.sql("SELECT 6L, 'none'"))
    d = spark.range(5000).selectExpr("'hot' AS word", "concat('s', id) AS sense", "5000 - id AS rnk").union(spark.sql("SELECT 'cold', 'c', 0L"))
    out = R.first_match(q, d, ["k"], "word", "sense", "rnk")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.rindex("Aggregate [word")  # the dictionary is aggregated below the join
    got = {r.k: r.sense for r in out.collect()}
    assert len(got) == 2000 and got[5] == "c" and got[6] == "s4999" and got[1999] == "c"
