"""Flags, levels and message texts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import flag


@dataclass(frozen=True)
class AnomalyLimits:
    """A window is anomalous when any set limit is exceeded (strictly)."""

    average: float | None = 10000.0
    count: int | None = 50
    stddev: float | None = 5000.0


# The batch preset looks at the spread too, the streaming preset does not.
BATCH_LIMITS = AnomalyLimits()
STREAM_LIMITS = AnomalyLimits(stddev=None)


def anomaly_flag(limits: AnomalyLimits = BATCH_LIMITS) -> Column:
    checks = {
        "rolling_avg_amount": limits.average,
        "transaction_count": limits.count,
        "stddev_amount": limits.stddev,
    }
    exceeded = [F.coalesce(F.col(name) > limit, F.lit(False))
                for name, limit in checks.items() if limit is not None]
    return flag(reduce(or_, exceeded, F.lit(False)))


# Level names with their lower bounds in percent, and the symbol of each.
LEVELS = (("Excellent", 95.0, "✅"), ("Moyen", 80.0, "⚠️"), ("Critique", None, "❌"))


def _by_level(rate: Column, pick) -> Column:
    out = F.lit(pick(LEVELS[-1]))
    for level in reversed(LEVELS[:-1]):
        out = F.when(rate >= level[1], pick(level)).otherwise(out)
    return out


def quality_level(rate: Column) -> Column:
    return _by_level(rate, lambda level: level[0])


def quality_symbol(rate: Column) -> Column:
    return _by_level(rate, lambda level: level[2])


# Fixed value: layout of the summary; arguments are symbol, day, rate, level, checks, failures, report.
SUMMARY_LAYOUT = (
    "%s *Rapport de Qualité - %s*\n"
    "**Taux global de succès :** %s%%\n"
    "**Statut :** %s\n"
    "**Total de contrôles :** %d\n"
    "**Échecs :** %d\n\n"
    "🗂 Rapport : %s"
)


def summary_text(rate: Column, checks: Column, failures: Column, day: Column, report: Column) -> Column:
    return F.format_string(
        SUMMARY_LAYOUT,
        quality_symbol(rate), day.cast("string"), rate.cast("string"), quality_level(rate),
        checks, failures, report,
    )


def latency_alert(latency: Column, limit: float) -> Column:
    """Unknown latency never alerts; nor does zero, whatever the limit."""
    return F.coalesce((latency != 0) & (latency > limit), F.lit(False))


def error_alert(errors: Column, limit: int = 5) -> Column:
    return F.coalesce(errors >= limit, F.lit(False))
