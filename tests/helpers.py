"""Reading results in tests."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def error_text(exception):
    return str(exception.value)
