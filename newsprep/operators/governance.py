"""Consistency of runs: settings, data identity, states, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import LABELS, RESUME_KEYS


def config_diff(
    pairs: DataFrame,
    runs: DataFrame,
    *,
    keys: Sequence[str] = RESUME_KEYS,
    run: str = "run_id",
    arguments: str = "command_arguments",
) -> DataFrame:
    """Settings whose saved value differs from the current one, per pair of runs.

    ``pairs`` holds ``saved_run`` and ``current_run``. A key absent from the saved
    side is ignored; one that is saved but absent now is a difference. Runs are
    unique, so each join adds one map per pair; a saved run that very many others
    resume from is split by adaptive skew handling. The keys are unfolded last.
    """
    def side(name: str) -> DataFrame:
        return runs.select(F.col(run).alias(f"{name}_run"), F.col(arguments).alias(f"_{name}"))

    both = pairs.join(side("saved"), "saved_run").join(side("current"), "current_run")
    differing = F.filter(
        F.map_entries("_saved"),
        lambda e: e["key"].isin(*keys) & ~e["value"].eqNullSafe(F.col("_current")[e["key"]]),
    )
    return both.select(
        "saved_run", "current_run", "_current", F.explode(differing).alias("d")
    ).select(
        "saved_run",
        "current_run",
        "d.key",
        F.col("d.value").alias("saved"),
        F.col("_current")[F.col("d.key")].alias("current"),
    )


def fingerprint_drift(
    current: DataFrame,
    saved: DataFrame,
    *,
    key: str = "run_id",
    columns: Sequence[str] = ("train_fingerprint", "eval_fingerprint"),
) -> DataFrame:
    """Split fingerprints that differ from the saved ones.

    Only runs with a row in ``saved`` are compared: a first run has nothing to drift
    from. A fingerprint absent on one side differs from one that is there.
    """
    old = saved.select(key, *(F.col(c).alias(f"_saved_{c}") for c in columns))
    joined = current.select(key, *columns).join(old, key)
    pairs = F.array(
        *(
            F.struct(
                F.lit(c).alias("fingerprint"),
                F.col(f"_saved_{c}").alias("saved"),
                F.col(c).alias("current"),
            )
            for c in columns
        )
    )
    changed = F.filter(pairs, lambda p: ~p["saved"].eqNullSafe(p["current"]))
    return joined.select(key, F.explode(changed).alias("d")).select(
        key, "d.fingerprint", "d.saved", "d.current"
    )


def run_status_summary(
    runs: DataFrame, *, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Runs per state with their durations; only ``completed`` runs can be evaluated."""
    start = F.col("created_at") if start is None else start
    end = F.coalesce("completed_at", "failed_at") if end is None else end
    seconds = F.unix_seconds(F.to_timestamp(end)) - F.unix_seconds(F.to_timestamp(start))
    return (
        runs.select("status", seconds.alias("seconds"))
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.count("seconds").alias("ended"),
            F.min("seconds").alias("min_seconds"),
            F.avg("seconds").alias("mean_seconds"),
            F.max("seconds").alias("max_seconds"),
        )
        .withColumn("evaluable", F.col("status") == "completed")
    )


def class_drift(
    expected: DataFrame,
    observed: DataFrame,
    *,
    expected_label: str,
    observed_label: str,
    labels: Sequence[str] = LABELS,
    floor: float = 1e-4,
) -> DataFrame:
    """Total variation distance and population stability index of two label mixes.

    Each side is one row of conditional counts over the fixed label domain, so
    nothing but two rows meets. Shares below ``floor`` are raised to it inside
    the logarithm. ``unlabelled_share`` is what of the observed rows has no label of
    the domain; a side without any has no mix, and both distances are null.
    """
    def counts(df: DataFrame, label: str, side: str) -> DataFrame:
        return df.agg(
            F.array(*(F.count_if(F.col(label) == name) for name in labels)).alias("n"),
            F.count(F.lit(1)).alias("every"),
        ).select(F.lit(side).alias("side"), "n", "every")

    sides = counts(expected, expected_label, "expected").unionByName(
        counts(observed, observed_label, "observed")
    )

    def side(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("n")))

    def total(array: str) -> Column:
        return F.aggregate(F.col(array), F.lit(0).cast("bigint"), lambda acc, n: acc + n)

    def shares(array: str) -> Column:
        return F.transform(F.col(array), lambda n: F.try_divide(n, total(array)))

    every = F.max(F.when(F.col("side") == "observed", F.col("every")))
    mixed = sides.agg(
        side("expected").alias("e"), side("observed").alias("o"), every.alias("every")
    ).select(
        F.try_divide(F.col("every") - total("o"), F.col("every")).alias("unlabelled_share"),
        total("e").alias("expected_rows"),
        total("o").alias("observed_rows"),
        shares("e").alias("p"),
        shares("o").alias("q"),
    )
    zero = F.lit(0.0)
    distance = F.aggregate(
        F.zip_with("p", "q", lambda a, b: F.abs(a - b)), zero, lambda acc, d: acc + d
    ) / 2

    def term(a: Column, b: Column) -> Column:
        # greatest() passes over nulls, which here must stay.
        low, high = (F.when(x.isNotNull(), F.greatest(x, F.lit(floor))) for x in (a, b))
        return (high - low) * F.ln(high / low)

    index = F.aggregate(F.zip_with("p", "q", term), zero, lambda acc, t: acc + t)
    return mixed.select(
        "expected_rows", "observed_rows", "unlabelled_share",
        distance.alias("total_variation"), index.alias("stability_index"),
    )
