from __future__ import annotations


def frame(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=lambda t: [(x is not None, str(x)) for x in t])


def one_column(df, column) -> list:
    return [row[0] for row in df.select(column).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan adaptive execution ended with; runs the query."""
    df.collect()
    return plan_of(df)
