"""Declarative data-quality checks as Spark aggregates (K1-K7).

A test "fails" with the number of rows its violation query returns, as dbt
counts them: ``not_null`` -> NULL rows; ``unique`` / combination -> duplicated
keys; ``accepted_values`` -> distinct values outside the list (NULL passes);
singular tests -> violating rows.  All column-level checks of one model are
evaluated in ONE aggregate pass over it, not one job per test.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    kind: str  # not_null | accepted_values | unique | unique_combination
    columns: tuple[str, ...]
    values: tuple = ()
    severity: str = "error"


@dataclass
class ModelChecks:
    model: str
    checks: list[Check] = field(default_factory=list)

    def not_null(self, *cols: str) -> ModelChecks:
        self.checks += [Check(f"not_null_{self.model}_{c}", "not_null", (c,)) for c in cols]
        return self

    def accepted_values(self, col: str, values: Sequence) -> ModelChecks:
        self.checks.append(Check(f"accepted_values_{self.model}_{col}", "accepted_values", (col,), tuple(values)))
        return self

    def unique(self, col: str) -> ModelChecks:
        self.checks.append(Check(f"unique_{self.model}_{col}", "unique", (col,)))
        return self

    def unique_combination(self, *cols: str) -> ModelChecks:
        self.checks.append(
            Check(f"unique_combination_{self.model}_{'__'.join(cols)}", "unique_combination", tuple(cols))
        )
        return self


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K1: rows with a NULL in ``col`` (for one column)."""
    return df.where(F.col(cols[0]).isNull())


def unique_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K2 / K4: duplicated keys with their counts.

    ``unique`` ignores NULL keys; the combination test groups NULLs together.
    Partial aggregation collapses a hot key map-side before the shuffle.
    """
    cols = list(cols)
    base = df.where(F.col(cols[0]).isNotNull()) if len(cols) == 1 else df
    return base.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values_violations(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """K3: values outside the list with their counts (NULL passes)."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~c.isin(list(values))).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))


def run_checks(df: DataFrame, suite: ModelChecks) -> DataFrame:
    """(model, test, kind, severity, failures) for every check of one model.

    not_null and accepted_values share one aggregate pass; each unique check
    is one grouped aggregate whose violation count is summed in the same job
    via a union of one-row results.
    """
    row_checks = [c for c in suite.checks if c.kind in ("not_null", "accepted_values")]
    parts: list[DataFrame] = []
    if row_checks:
        # first by the checked value columns (few combinations), then over these groups: the distinct
        # values outside a list are a grouped count of their own, without a copy of every row for each list
        listed = sorted({c.columns[0] for c in row_checks if c.kind == "accepted_values"})
        nulls = [c for c in row_checks if c.kind == "not_null"]
        groups = df.groupBy(*listed).agg(F.count(F.lit(1)).alias("_rows"), *[
            F.count_if(F.col(c.columns[0]).isNull()).alias(f"_null_{i}") for i, c in enumerate(nulls)])
        if nulls:
            wide = groups.agg(*(F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(c.name) for i, c in enumerate(nulls)))
            each = [F.struct(F.lit(c.name).alias("test"), F.col(c.name).cast("bigint").alias("failures")) for c in nulls]
            parts.append(wide.select(F.inline(F.array(*each))))
        values = [c for c in row_checks if c.kind == "accepted_values"]
        if values:
            each = [F.struct(F.lit(c.name).alias("test"), F.col(c.columns[0]).cast("string").alias("value"),
                             F.coalesce(~F.col(c.columns[0]).isin(list(c.values)), F.lit(False)).alias("bad")) for c in values]
            bad = groups.select(F.inline(F.array(*each))).where("bad").groupBy("test", "value").agg(F.lit(1)).groupBy("test").count()
            tests = df.sparkSession.createDataFrame([(c.name,) for c in values], "test string")
            parts.append(tests.join(bad, "test", "left").select("test", F.coalesce("count", F.lit(0)).cast("bigint").alias("failures")))
    for c in suite.checks:
        if c.kind in ("unique", "unique_combination"):
            v = unique_violations(df, c.columns)
            parts.append(v.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
                F.lit(c.name).alias("test"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    meta = {c.name: (c.kind, c.severity) for c in suite.checks}
    kind = F.create_map(*[x for n, (k, _) in meta.items() for x in (F.lit(n), F.lit(k))])
    sev = F.create_map(*[x for n, (_, s) in meta.items() for x in (F.lit(n), F.lit(s))])
    return out.select(
        F.lit(suite.model).alias("model"), "test", kind[F.col("test")].alias("kind"),
        sev[F.col("test")].alias("severity"), "failures",
    )


def declared_suites(systems: Sequence[str], zone_marts: dict[str, str]) -> dict[str, ModelChecks]:
    """All declared tests: staging per system, the union, fact, dimension, daily mart and the zone marts.

    ``zone_marts`` maps a mart's name to its zone column.
    """
    members, bikes = ["member", "casual"], ["classic_bike", "electric_bike"]
    suites = {}
    for s in systems:
        suites[f"stg_{s}"] = (
            ModelChecks(f"stg_{s}")
            .not_null("ride_id", "started_at", "ended_at", "rideable_type", "member_casual", "system")
            .accepted_values("rideable_type", bikes).accepted_values("member_casual", members)
            .accepted_values("system", [s]))
    suites["rides_unioned"] = ModelChecks("rides_unioned").not_null("system").accepted_values("system", systems)
    suites["fct_rides"] = (
        ModelChecks("fct_rides").unique("ride_id")
        .not_null("ride_id", "started_at", "duration_seconds", "started_dow", "system")
        .accepted_values("started_dow", [1, 2, 3, 4, 5, 6, 7]).accepted_values("member_casual", members)
        .accepted_values("system", systems))
    suites["dim_stations"] = (
        ModelChecks("dim_stations").unique_combination("system", "station_id").not_null("station_id", "system"))
    suites["agg_rides_daily"] = (
        ModelChecks("agg_rides_daily").unique_combination("started_date", "system", "member_casual", "rideable_type")
        .not_null("started_date", "total_rides"))
    for name, zone_col in zone_marts.items():
        suites[name] = ModelChecks(name).unique_combination(zone_col, "started_month").not_null(zone_col, "started_month")
    return suites


def run_suites(frames: dict[str, DataFrame], suites: dict[str, ModelChecks]) -> DataFrame:
    """Results of every suite, and the long-ride warning over the fact."""
    out = singular_result("no_implausibly_long_rides", long_rides(frames["fct_rides"]))
    for name, suite in suites.items():
        out = out.unionByName(run_checks(frames[name], suite))
    return out


LONG_RIDE_SECONDS = 24 * 60 * 60


def long_rides(fct: DataFrame) -> DataFrame:
    """Rides longer than 24 h (warn-only singular test)."""
    return fct.where(F.col("duration_seconds") > LONG_RIDE_SECONDS).select(
        "ride_id", "started_at", "ended_at", "duration_seconds", "duration_minutes"
    )


def singular_result(name: str, violations: DataFrame, severity: str = "warn", model: str = "fct_rides") -> DataFrame:
    return violations.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(name).alias("test"), F.lit("singular").alias("kind"),
        F.lit(severity).alias("severity"), "failures",
    )


def freshness(raw: DataFrame, source_col: str, loaded_at: str, as_of: dt.datetime,
              warn_days: int = 35, error_days: int = 60) -> DataFrame:
    """K6: per source, MAX(loaded_at) age against warn / error thresholds."""
    g = raw.groupBy(F.col(source_col).alias("source")).agg(F.max(loaded_at).alias("max_loaded_at"))
    now = F.lit(as_of).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at").cast("timestamp_ntz"), now)  # elapsed, not calendar days
    day = 24 * 60 * 60
    return g.select(
        "source", "max_loaded_at", (age / F.lit(day)).cast("int").alias("age_days"),
        F.when(age > error_days * day, "error").when(age > warn_days * day, "warn").otherwise("pass").alias("status"),
    )


def report(results: DataFrame) -> DataFrame:
    """K7: PASS / WARN / ERROR counts over check results."""
    status = (
        F.when(F.col("failures") == 0, "PASS").when(F.col("severity") == "warn", "WARN").otherwise("ERROR")
    )
    return results.select(status.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
