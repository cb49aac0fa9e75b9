from courtlake.operators.pruning import within_span


def scanned(df):
    """Rows each file scan has produced, most first."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    final = execution.executedPlan().finalPhysicalPlan()
    leaves = final.collectLeaves()
    found = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return sorted((m.get().value() for m in found if m.isDefined()), reverse=True)


def test_span_skips_pages_of_sorted_files(spark, tmp_path):
    rows = spark.range(1_000_000).selectExpr("lpad(id, 10, '0') AS k", "id AS v")
    rows.coalesce(1).write.parquet(f"{tmp_path}/t")
    rows.where("v BETWEEN 500000 AND 500100").select("k").write.parquet(f"{tmp_path}/k")
    table, keys = (spark.read.parquet(f"{tmp_path}/{n}") for n in "tk")
    found = within_span(table, "k", keys).join(keys, "k")
    assert found.count() == 101
    assert scanned(within_span(table, "k", keys))[0] <= 60_000


def test_span_of_nothing_and_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "k int")
    keys = spark.createDataFrame([(None,), (4,), (9,)], "k int")
    assert [r.k for r in within_span(df, "k", keys).collect()] == [5]
    assert within_span(df, "k", keys.where("k IS NULL")).isEmpty()
    assert within_span(df, "k", keys.where("k > 99")).isEmpty()
