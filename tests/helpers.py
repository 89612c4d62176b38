from pathlib import Path


def rows(df):
    """Rows as tuples, in a stable order; null sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan_of(df):
    """The physical plan that actually ran."""
    df.collect()
    return planned(df)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def parquet_files(path):
    return sorted(Path(path).rglob("*.parquet"))
