from datetime import datetime, timezone

from postmill.schema import bronze_schema

DAY = datetime(2024, 1, 1, 10, 30, tzinfo=timezone.utc)


def post(post_id="a", **changes):
    row = {
        "post_id": post_id, "subreddit": "g", "title": "title", "selftext": "body", "author": "ann", "score": 1,
        "upvote_ratio": 0.5, "num_comments": 2, "created_utc": DAY, "url": "u", "permalink": "p", "is_self": "True",
        "link_flair_text": "Flair", "over_18": "False", "spoiler": "False", "awards_received": 0,
        "ingestion_timestamp": DAY,
    }
    unknown = set(changes) - set(row)
    assert not unknown, unknown
    return {**row, **changes}


def bronze_of(spark, *posts):
    return spark.createDataFrame(list(posts), bronze_schema())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def rows_scanned(df):
    """Runs ``df``, and tells how many rows its scans of files put out, by the first column of each."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    rows, open_ = {}, [execution.executedPlan()]
    while open_:
        node = open_.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            open_.append(node.plan())
        elif name == "FileSourceScanExec":
            columns = node.output().mkString(",")
            rows[columns] = rows.get(columns, 0) + node.metrics().apply("numOutputRows").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return rows


def records_shuffled(df):
    """Runs ``df``, and tells how many records its shuffles wrote."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    records, open_ = 0, [execution.executedPlan()]
    while open_:
        node = open_.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            open_.append(node.plan())
        elif name == "ShuffleExchangeExec":
            records += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return records
