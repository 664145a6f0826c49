"""Data-quality gate: every rule of one dataset is checked in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rentscope.schemas import REQUIRED_CLEAN_COLUMNS


@dataclass(frozen=True)
class Rule:
    name: str
    observed: Column                    # an aggregate expression
    passes: Callable[[Column], Column]  # predicate on the observed value


def expect(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(check, passed, observed)`` rows; all rules share one aggregate."""
    return _checked(df.agg(*[r.observed.cast("bigint").alias(f"_o{i}") for i, r in enumerate(rules)]), rules)


def _checked(observed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    rows = [F.struct(F.lit(r.name).alias("check"),
                     F.coalesce(r.passes(F.col(f"_o{i}")), F.lit(False)).alias("passed"),
                     F.col(f"_o{i}").alias("observed"))
            for i, r in enumerate(rules)]
    return observed.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


class Observed:
    """Rules checked while a frame is written, so no output is read again.

    ``watch(df, rules)`` returns the frame to write; ``report()`` has the same
    rows as ``expect`` once it is written.  The metrics stand right on top of
    the plan, in the stage that writes: a task that is run again, after a
    failure or with a lost executor, counts once, as its rows do."""

    def __init__(self):
        self._watched: list[tuple[Observation, Sequence[Rule]]] = []

    def watch(self, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        seen = Observation()
        self._watched.append((seen, rules))
        return df.observe(seen, *[r.observed.cast("bigint").alias(f"o{i}") for i, r in enumerate(rules)])

    def values(self) -> dict[str, int | None]:
        """Rule -> what was observed; waits for the writes to end."""
        return {r.name: seen.get[f"o{i}"] for seen, rules in self._watched for i, r in enumerate(rules)}

    def report(self, spark: SparkSession) -> DataFrame:
        """``(check, passed, observed)`` rows, one per rule."""
        values = self.values()
        rules = [r for _, rules in self._watched for r in rules]
        one = spark.range(1).select(*[F.lit(values[r.name]).cast("bigint").alias(f"_o{i}") for i, r in enumerate(rules)])
        return _checked(one, rules)


def non_empty(name: str = "non_empty") -> Rule:
    return Rule(name, F.count(F.lit(1)), lambda o: o > 0)


def no_nulls(col: str, name: str | None = None) -> Rule:
    return Rule(name or f"no_null_{col}", F.count_if(F.col(col).isNull()), lambda o: o == 0)


def within(col: str, lo, hi, name: str | None = None) -> Rule:
    """Fails on values below ``lo`` or above ``hi`` (null is not counted)."""
    bad = (F.col(col) < lo) | (F.col(col) > hi)
    return Rule(name or f"{col}_within_{lo}_{hi}", F.count_if(bad), lambda o: o == 0)


def has_columns(df: DataFrame, required: Sequence[str], name: str = "required_columns") -> DataFrame:
    """Schema check (no data read): observed = number of missing columns."""
    missing = len([c for c in required if c not in df.columns])
    return df.sparkSession.range(1).select(
        F.lit(name).alias("check"), F.lit(missing == 0).alias("passed"),
        F.lit(missing).cast("bigint").alias("observed"))


# The looser range of the pipeline's quality gate.
GATE_MIN_PRICE, GATE_MAX_PRICE = 100, 20000


def clean_rules() -> list[Rule]:
    return [non_empty("clean_non_empty"), no_nulls("price", "clean_no_null_price"),
            within("price", GATE_MIN_PRICE, GATE_MAX_PRICE, "clean_price_in_range")]


def fact_rules() -> list[Rule]:
    return [non_empty("fact_non_empty")]


def enriched_rules() -> list[Rule]:
    return [non_empty("enriched_non_empty")]


def quality_report(clean: DataFrame, fact: DataFrame, enriched: DataFrame) -> DataFrame:
    """The pipeline gate: clean data non-empty, no null price, prices within
    100-20,000, fact non-empty, enriched output non-empty, required columns
    present.  One aggregate pass per dataset."""
    return (expect(clean, clean_rules())
            .unionByName(expect(fact, fact_rules()))
            .unionByName(expect(enriched, enriched_rules()))
            .unionByName(has_columns(clean, REQUIRED_CLEAN_COLUMNS, "clean_required_columns")))


class QualityError(AssertionError):
    pass


def assert_quality(report: DataFrame) -> None:
    """Raise if any check failed (collects only the failing rows, which are
    at most one per rule)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']} (observed {r['observed']})" for r in failed))
