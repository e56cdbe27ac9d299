"""Partition selection, the partition manifest, and the run ledger.

A run covers a set of ``(service_type, source_year, source_month)`` partitions. The spec is a
predicate for pruning, and a manifest — one row per partition, generated with ``explode`` of
sequences (no join) — that the per-partition counts are left-joined to, so that partitions
without rows are reported with 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.sources.schemas import PARTITION_KEYS, SERVICES

ALL_MONTHS = tuple(range(1, 13))
DEFAULT_YEARS = (2015, 2025)


MONTH_BY_TEXT = {text: m for m in ALL_MONTHS for text in (str(m), f"{m:02d}")}


def _choose(values: Iterable | None, known: dict[str, object], what: str) -> set:
    """The values of ``known`` that comma-separated ``values`` name; raises on any other name."""
    names = ",".join(str(v) for v in values or () if v is not None).lower()
    chosen = {name.strip() for name in names.split(",")} - {""}
    if strangers := chosen.difference(known):
        raise ValueError(f"not a {what}: {sorted(strangers)}; known: {', '.join(known)}")
    return {known[name] for name in chosen}


def parse_months(values: Iterable | None) -> list[int]:
    """Months 1 to 12 by number, each once, ascending."""
    return sorted(_choose(values, MONTH_BY_TEXT, "month"))


def parse_services(values: Iterable | None) -> list[str]:
    """Known services by name in any case, each once, in the library's order."""
    chosen = _choose(values, {s: s for s in SERVICES}, "service")
    return [s for s in SERVICES if s in chosen]


@dataclass(frozen=True)
class PartitionSpec:
    """Years ``year_start..year_end`` × ``months`` × ``services``."""

    year_start: int = DEFAULT_YEARS[0]
    year_end: int = DEFAULT_YEARS[1]
    months: tuple[int, ...] = ALL_MONTHS
    services: tuple[str, ...] = SERVICES
    overwrite: bool = False
    mode: str = "by-partition"

    def __post_init__(self):
        if self.mode not in ("full", "by-partition"):
            raise ValueError("mode must be 'full' or 'by-partition'")
        if self.year_start > self.year_end:
            raise ValueError("year_start must be <= year_end")
        if not self.months:
            raise ValueError("at least one month is required")
        if not self.services:
            raise ValueError("at least one service is required")
        parse_months(self.months)
        parse_services(self.services)

    @classmethod
    def resolve(cls, mode: str | None = None, year_start: int | None = None,
                year_end: int | None = None, months=None, services=None,
                overwrite: bool | None = None, defaults: tuple[int, int] = DEFAULT_YEARS
                ) -> "PartitionSpec":
        """Explicit values win over defaults; ``full`` mode forces all years, months and
        services of the defaults and always overwrites."""
        if mode and mode.lower() == "full":
            return cls(*defaults, overwrite=True, mode="full")
        first, last = (given if given is not None else default for given, default in
                       zip((year_start, year_end), defaults, strict=True))
        return cls(first, last, tuple(parse_months(months)) or ALL_MONTHS,
                   tuple(parse_services(services)) or SERVICES, bool(overwrite),
                   (mode or "by-partition").lower())

    @property
    def years(self) -> list[int]:
        return list(range(self.year_start, self.year_end + 1))

    def size(self) -> int:
        return len(self.services) * len(self.years) * len(self.months)

    def contains(self, key: tuple[str, int, int]) -> bool:
        s, y, m = key
        return s in self.services and self.year_start <= y <= self.year_end and m in self.months

    def predicate(self) -> Column:
        """Partition predicate; on a table partitioned by the keys this prunes directories."""
        return (F.col("service_type").isin(list(self.services))
                & F.col("source_year").between(self.year_start, self.year_end)
                & F.col("source_month").isin(list(self.months)))

    def manifest(self, spark: SparkSession) -> DataFrame:
        """One row per partition of the spec, generated on the executors by ``explode``."""
        return (spark.range(1)
                .select(F.explode(F.array(*[F.lit(s) for s in self.services])).alias("service_type"))
                .select("service_type",
                        F.explode(F.sequence(F.lit(self.year_start), F.lit(self.year_end)))
                        .alias("source_year"))
                .select("service_type", "source_year",
                        F.explode(F.array(*[F.lit(m) for m in self.months])).alias("source_month")))


def partition_counts(table: DataFrame) -> DataFrame:
    """Rows per partition key (map-side partial counts, one small shuffle)."""
    return table.groupBy(*PARTITION_KEYS).agg(F.count(F.lit(1)).alias("rows"))


def ledger(manifest: DataFrame, counts: DataFrame, counts_bounded: bool = True) -> DataFrame:
    """Every partition of the manifest with its row count, 0 when it has none.

    ``counts`` holds one row per partition of data already filtered by the spec, so it has at
    most ``spec.size()`` rows: that bound makes it safe to broadcast."""
    if counts_bounded:
        counts = F.broadcast(counts)
    return (manifest.join(counts, list(PARTITION_KEYS), "left")
            .select(*PARTITION_KEYS, F.coalesce(F.col("rows"), F.lit(0)).cast("bigint")
                    .alias("rows")))


def run_totals(ledger_df: DataFrame) -> DataFrame:
    """Partitions processed, partitions with rows, and rows in total."""
    return ledger_df.agg(F.count(F.lit(1)).alias("partitions"),
                         F.count(F.when(F.col("rows") > 0, 1)).alias("partitions_with_rows"),
                         F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"))


def run_summary_by_year(ledger_df: DataFrame) -> DataFrame:
    """Per service and year: partitions, partitions with rows, rows."""
    return (ledger_df.groupBy("service_type", "source_year")
            .agg(F.count(F.lit(1)).alias("partitions"),
                 F.count(F.when(F.col("rows") > 0, 1)).alias("partitions_with_rows"),
                 F.sum("rows").cast("bigint").alias("rows")))


def run_report(ledger_df: DataFrame) -> DataFrame:
    """Run totals and per-year summaries in one aggregate: a row per (service, year), per service
    and for the whole run, told apart by ``level`` (``grouping_id``: 0, 1 and 3)."""
    return (ledger_df.rollup("service_type", "source_year")
            .agg(F.grouping_id().cast("int").alias("level"),
                 F.count(F.lit(1)).alias("partitions"),
                 F.count(F.when(F.col("rows") > 0, 1)).alias("partitions_with_rows"),
                 F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows")))


@dataclass(frozen=True)
class PartitionSet:
    """An explicit set of partitions, e.g. the ones a micro-batch touched."""

    keys: tuple[tuple[str, int, int], ...]

    @classmethod
    def of(cls, df: DataFrame, max_partitions: int = 100_000) -> "PartitionSet":
        """The distinct partition keys of ``df`` (bounded: raises above ``max_partitions``)."""
        rows = df.select(*PARTITION_KEYS).distinct().limit(max_partitions + 1).collect()
        if len(rows) > max_partitions:
            raise ValueError("too many partitions in one write")
        return cls(tuple(sorted((r[0], int(r[1]), int(r[2])) for r in rows)))

    def size(self) -> int:
        return len(self.keys)

    def contains(self, key: tuple[str, int, int]) -> bool:
        return tuple(key) in set(self.keys)

    def predicate(self) -> Column:
        """Per service one test of (year, month) as one number: a set of structs would be searched
        by comparing them field by field, for every row."""
        month = (F.shiftleft(F.col("source_year").cast("bigint"), 32)
                 + F.col("source_month").cast("bigint"))
        out = F.lit(False)
        for service in sorted({s for s, _, _ in self.keys}):
            months = [(y << 32) + m for s, y, m in self.keys if s == service]
            out = out | ((F.col("service_type") == service) & month.isin(months))
        return out

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.keys),
                                     "service_type string, source_year int, source_month int")
