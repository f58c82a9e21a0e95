"""Model-based test: random operation sequences on a keyed table vs a Python dict."""

import contextlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.keyed_table import KeyedTable, KeyedTableError

UNIQUE = st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=25, unique=True)
REPEATED = st.lists(st.integers(min_value=0, max_value=12), min_size=2, max_size=8)
KEYS = st.one_of(UNIQUE, UNIQUE, REPEATED)
OPS = st.one_of(
    st.tuples(st.just("append"), KEYS),
    st.tuples(st.just("replace"), KEYS),
    st.tuples(st.just("overwrite"), KEYS),
    st.tuples(st.just("update"), st.tuples(st.integers(0, 40), st.integers(0, 40))),
)


def apply_model(model: dict, op, step: int) -> dict:
    kind, arg = op
    if len(set(arg)) < len(arg) and kind in ("append", "replace", "overwrite"):
        return model  # the whole batch is rejected
    if kind == "append":
        return {**{k: f"s{step}" for k in arg}, **model}
    if kind == "replace":
        return {**model, **{k: f"s{step}" for k in arg}}
    if kind == "overwrite":
        return {k: f"s{step}" for k in arg}
    lo, hi = sorted(arg)
    return {k: (f"u{step}" if lo <= k <= hi else v) for k, v in model.items()}


@pytest.mark.parametrize(("buckets", "bound"), [(None, 1 << 28), (None, 1), (4, 1 << 28)])
@settings(max_examples=3, deadline=None)
@given(ops=st.lists(OPS, min_size=3, max_size=6))
def test_operation_sequences_match_model(spark, buckets, bound, ops):
    from ledgerloom.session import scratch_path

    t = KeyedTable(spark, scratch_path(spark, "model"), "k", buckets=buckets)
    model: dict = {}
    for step, op in enumerate(ops):
        kind, arg = op
        if kind == "update":
            if not model:
                continue
            lo, hi = sorted(arg)
            t.update({"v": F.lit(f"u{step}")}, F.col("k").between(lo, hi))
        else:
            batch = spark.createDataFrame([(k, f"s{step}") for k in arg], "k long, v string").repartition(3)
            rejected = pytest.raises(KeyedTableError) if len(set(arg)) < len(arg) else contextlib.nullcontext()
            with rejected:
                if kind == "overwrite":
                    t.overwrite(batch)
                else:
                    t.append(batch, on_conflict="replace" if kind == "replace" else "skip", max_broadcast_bytes=bound)
        model = apply_model(model, op, step)
        if not model:
            continue
        got = {r["k"]: r["v"] for r in t.scan().collect()}
        assert got == model, (step, op)
