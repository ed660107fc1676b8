"""Driver loop for iterative operators, and the states it leaves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from corvane.plans.scratch import materialize


def _saved(base: str, i: int) -> str:
    return f"{base}/iter{i:04d}"


def _manifest(base: str, i: int) -> str:
    return f"{base}/manifest{i:04d}"


def _store(state: DataFrame, base: str, i: int, manifest: dict[str, str]) -> None:
    """Write a state, then the manifest that makes it count: its rows and what it is of."""
    state.write.mode("overwrite").parquet(_saved(base, i))
    rows = state.sparkSession.read.schema(state.schema).parquet(_saved(base, i)).count()
    entries = [*manifest.items(), ("rows", str(rows))]
    state.sparkSession.createDataFrame(entries, "key string, value string").coalesce(1).write.mode(
        "overwrite").parquet(_manifest(base, i))


def read_manifest(spark: SparkSession, base: str, i: int) -> dict[str, str] | None:
    """The manifest of a stored state, None where it isn't whole."""
    try:
        # A manifest of a run that died while writing has no rows.
        return dict(spark.read.schema("key string, value string").parquet(_manifest(base, i)).collect()) or None
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def check_state(spark: SparkSession, base: str, i: int, manifest: dict[str, str]) -> None:
    """Raise ValueError unless state ``i`` is whole and of the same kind as ``manifest``."""
    held = read_manifest(spark, base, i)
    if held is None:
        raise ValueError(f"there is no whole state of iteration {i}")
    other = {k: held.get(k) for k, v in manifest.items() if held.get(k) != v}
    if other:
        raise ValueError(f"the stored state is of another run: {other}")


def last_state(spark: SparkSession, base: str, end: int) -> int:
    """The last iteration up to ``end`` whose state is whole, 0 where there is none."""
    for i in range(end, 0, -1):
        if read_manifest(spark, base, i) is not None:
            return i
    return 0


def iterate(state: DataFrame, step: Callable[[DataFrame], DataFrame], start: int, end: int, *,
            every: int = 5, base: str | None = None, manifest: dict[str, str] | None = None) -> DataFrame:
    """Apply ``step`` for iterations ``start`` .. ``end - 1``.

    With ``base`` each state is kept as ``base/iterNNNN``, followed by its manifest, and a
    run with ``start > 0`` resumes from the stored state. Without it the lineage is cut
    every ``every`` iterations and after the last one; only the newest cut is kept.
    """
    spark = state.sparkSession
    schema = state.schema
    if base is not None:
        if start == 0:
            _store(state, base, 0, manifest or {})
        state = spark.read.schema(schema).parquet(_saved(base, start))
    cut = state
    for i in range(start, end):
        state = step(state)
        if base is not None:
            _store(state, base, i + 1, manifest or {})
            state = spark.read.schema(schema).parquet(_saved(base, i + 1))
        elif (i + 1 - start) % every == 0 or i + 1 == end:
            state = cut = materialize(state, "iter", replaces=[cut])
    return state
