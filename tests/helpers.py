"""Shared by the test modules. Not in a conftest: only one module of that name can be imported."""


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def plan(df, run=True):
    """The physical plan, after running it the one adaptive execution settled on."""
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
