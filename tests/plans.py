"""Helpers that read physical plans."""


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after adaptive execution."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString().split("== Initial Plan ==")[0]
