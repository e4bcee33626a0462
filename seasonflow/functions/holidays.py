"""A holiday calendar generated from rules.

A rule is data, so another country's calendar needs only other rows:
``fixed`` keeps month and day, ``monday`` moves the day to the next Monday
unless it is one, ``easter`` counts days from Easter Sunday.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from seasonflow.session import literal_table

Rule = tuple[str, str, int, int, int]

# The public holidays of Colombia (name, rule, month, day, offset).
COLOMBIA: tuple[Rule, ...] = (
    ("Año Nuevo", "fixed", 1, 1, 0),
    ("Día de los Reyes Magos", "monday", 1, 6, 0),
    ("Día de San José", "monday", 3, 19, 0),
    ("Jueves Santo", "easter", 0, 0, -3),
    ("Viernes Santo", "easter", 0, 0, -2),
    ("Día del Trabajo", "fixed", 5, 1, 0),
    ("Ascensión del Señor", "easter", 0, 0, 43),
    ("Corpus Christi", "easter", 0, 0, 64),
    ("Sagrado Corazón", "easter", 0, 0, 71),
    ("San Pedro y San Pablo", "monday", 6, 29, 0),
    ("Día de la Independencia", "fixed", 7, 20, 0),
    ("Batalla de Boyacá", "fixed", 8, 7, 0),
    ("Asunción de la Virgen", "monday", 8, 15, 0),
    ("Día de la Raza", "monday", 10, 12, 0),
    ("Día de Todos los Santos", "monday", 11, 1, 0),
    ("Independencia de Cartagena", "monday", 11, 11, 0),
    ("Inmaculada Concepción", "fixed", 12, 8, 0),
    ("Navidad", "fixed", 12, 25, 0),
)


def easter_sunday(year: int) -> date:
    """Gregorian Easter by the integer method of Meeus, Jones and Butcher."""
    golden, (century, rest) = year % 19, divmod(year, 100)
    correction = (century - (century + 8) // 25 + 1) // 3
    moon = (19 * golden + century - century // 4 - correction + 15) % 30
    sunday = (32 + 2 * (century % 4) + 2 * (rest // 4) - moon - rest % 4) % 7
    late = (golden + 11 * moon + 22 * sunday) // 451
    month, day = divmod(moon + sunday - 7 * late + 114, 31)
    return date(year, month, day + 1)


def holiday_date(year: int, rule: Rule) -> date:
    _, kind, month, day, offset = rule
    if kind == "easter":
        return easter_sunday(year) + timedelta(days=offset)
    nominal = date(year, month, day)
    return nominal + timedelta(days=-nominal.weekday() % 7) if kind == "monday" else nominal


def holiday_table(spark: SparkSession, years: Sequence[int], rules: Sequence[Rule] = COLOMBIA) -> DataFrame:
    """One row per holiday date: ``ds, holiday, is_bridge``.

    Rules that meet on one date give one row with the names joined; a bridge is a
    holiday on a Monday. At most years x rules rows, so callers may broadcast it.
    """
    names = defaultdict(set)
    for year in set(years):
        for rule in rules:
            names[holiday_date(year, rule)].add(rule[0])
    rows = [(day, "; ".join(sorted(names[day])), int(day.weekday() == 0)) for day in sorted(names)]
    return literal_table(spark, rows, "ds date, holiday string, is_bridge int")
