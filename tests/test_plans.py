"""Plan properties: pruning and pushdown reach the parquet scan."""

from conftest import SF_SMALL
from ledgerlens.sources.adapters import transactions


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_adapter_projection_is_pruned_at_the_scan(spark):
    plan = _plan(transactions(spark, SF_SMALL).select("account"))
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "user_id" in read and "event_id" in read
    assert "props" not in read and "value" not in read and "event_type" not in read


def test_filter_on_canonical_timestamp_is_pushed(spark):
    from pyspark.sql import functions as F
    df = transactions(spark, SF_SMALL).where(F.col("timestamp").isNotNull()).select("account")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(ts)" in plan


def test_queries_without_the_optional_part_or_what_it_needs(monkeypatch):
    import builtins
    import sys

    import __spark_entry__ as E
    real = builtins.__import__
    for missing in ("ahocorasick", "corpus_pipeline"):
        for m in [m for m in sys.modules if m.startswith(("ledgerlens.llm", "corpus_pipeline", "ahocorasick"))]:
            monkeypatch.delitem(sys.modules, m)

        def without(name, *a, missing=missing, **k):
            if name == missing:
                raise ImportError(name)
            return real(name, *a, **k)

        monkeypatch.setattr(builtins, "__import__", without)
        core = E.queries()
        assert len(core) > 80 and not any(n.startswith("op") or n == "pipeline" for n in core)
        assert set(E.oracle_sql()) <= set(core)
        monkeypatch.setattr(builtins, "__import__", real)
