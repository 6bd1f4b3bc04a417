import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Texts, or (doc_id, text) pairs, to a table of documents; further columns clash with names that operators use."""
    def build(values, source="s", clash=True):
        rows = [(i, v) if not isinstance(v, tuple) else v for i, v in enumerate(values)]
        df = spark.createDataFrame(
            [(d, t, "en", source(d) if callable(source) else source, None if t is None else len(t)) for d, t in rows], SCHEMA)
        if clash:
            for name in ("key", "row", "score", "fp", "component_id", "copies", "shard", "found", "size", "length", "spans"):
                df = df.selectExpr("*", f"named_struct('x', doc_id) as `{name}`")
        return df
    return build
