def explain(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
