"""Threshold bands, code labels and status rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column, cuts: Sequence[tuple[float, object]], default: object) -> Column:
    """Label of the first cut that ``value`` reaches; cuts run from high to low, null gets the default."""
    chain = F
    for threshold, label in cuts:
        chain = chain.when(value >= F.lit(threshold), F.lit(label))
    return chain.otherwise(F.lit(default))


def label(code: Column, names: Mapping[object, object], default: Column | None = None) -> Column:
    """Constant lookup of a code; unknown codes keep ``default`` (the code itself if not given)."""
    pairs = [F.lit(item) for pair in names.items() for item in pair]
    return F.coalesce(F.create_map(*pairs)[code], default if default is not None else code)


def wind_severity(wind_kmh: Column) -> Column:
    return band(wind_kmh, [(50.0, 4), (35.0, 3), (20.0, 2)], 1)


def weather_risk_level(severity: Column) -> Column:
    return band(severity, [(4, "ALTO"), (2, "MEDIO")], "BAJO")


def weather_delay_hours(severity: Column) -> Column:
    return band(severity, [(4, 10.0), (3, 6.0), (2, 3.0)], 1.0)


def route_risk_level(score: Column) -> Column:
    return band(score, [(4.0, "ALTO"), (2.5, "MEDIO")], "BAJO")


def risk_class(avg_severity: Column, speed_std: Column) -> Column:
    """Window risk class; a one-row window has no deviation and counts as zero."""
    score = F.lit(0.7) * avg_severity + F.lit(0.3) * (F.coalesce(speed_std, F.lit(0.0)) / F.lit(10.0))
    return band(score, [(3.5, "CRITICO"), (2.0, "ALTO"), (1.0, "MEDIO")], "BAJO")


def risk_label(score: Column) -> Column:
    """Training label 3..0 from a risk score."""
    return band(score, [(3.5, 3.0), (2.0, 2.0), (1.0, 1.0)], 0.0)


def severity_class(severity: Column) -> Column:
    return band(severity, [(4, "critical"), (3, "warning")], "normal")


def node_state(criticality: Column) -> Column:
    level = F.upper(criticality)
    return (
        F.when(level.contains("CRITICO"), "Congestionado").when(level.contains("STRATEGICO"), "Tension").otherwise("Fluido")
    )


def stock_light(available: Column, safety: Column, daily: Column) -> Column:
    """Traffic light of the stock left after orders."""
    return (
        F.when(available <= safety, "ROJO").when(available <= safety + F.lit(2) * daily, "NARANJA").otherwise("VERDE")
    )


def cover_band(stock: Column, safety: Column, weekly: Column) -> Column:
    return (
        F.when(stock <= safety, "NO CUBRE").when(stock <= safety + weekly, "ALERTA").otherwise("CUBRE")
    )


def mode_label(mode: Column) -> Column:
    return F.when(mode == "AEREO_CAMION", "AEREO").otherwise("MARITIMO")


def is_uncovered(status: Column) -> Column:
    return status.rlike("NO CUBRE|ROTURA")
