"""What a demand table looks like, and the constants of one known network."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SeriesSpec:
    """Column roles of a long demand table: one row per (ds, key, hour).

    ``hour=None`` describes a daily table.
    """

    key: str = "key"
    ds: str = "ds"
    hour: str | None = "hour"
    y: str = "y"
    kind: str = "kind"
    total: str = "total"

    @property
    def series(self) -> list[str]:
        """Columns that name one series."""
        return [c for c in (self.key, self.hour) if c]

    @property
    def row_id(self) -> list[str]:
        """Columns that name one row, in chronological order."""
        return [self.ds, *self.series]


DAILY = SeriesSpec(hour=None)


@dataclass(frozen=True)
class Profile:
    """Everything a run needs to know about one source."""

    hours: tuple[int, ...]
    raw_date: str
    raw_key: str
    raw_total: str
    # (first year, last year, date pattern); a bound of None is open
    date_rules: tuple[tuple[int | None, int | None, str], ...]
    types: dict[str, str]
    rail_kind: str
    years: tuple[int, ...]
    trend_base: int
    test_from: str
    test_until: str
    val_from: str
    folds: tuple[tuple[str, str, str, str, str], ...]
    main_models: tuple[str, ...]
    names: dict[str, str] = field(default_factory=dict)

    def hour_columns(self) -> list[str]:
        return [f"{h}:00" for h in self.hours]

    def raw_columns(self) -> list[str]:
        return [self.raw_date, self.raw_key, *self.hour_columns(), self.raw_total]


# The layout, line map, periods and folds of the transit source
# this library replaces a pandas job for. They must equal the source's own.
TRANSIT = Profile(
    hours=tuple(range(4, 24)),
    raw_date="DIA",
    raw_key="LINEA",
    raw_total="TOTAL",
    date_rules=((None, 2024, "d/M/yyyy"), (2025, None, "M/d/yyyy")),
    types={
        "LÍNEA A": "metro_ferreo",
        "LÍNEA B": "metro_ferreo",
        "LÍNEA H": "metrocable",
        "LÍNEA J": "metrocable",
        "LÍNEA K": "metrocable",
        "LÍNEA L": "metrocable",
        "LÍNEA M": "metrocable",
        "LÍNEA P": "metrocable",
        "LÍNEA T-A": "tranvia",
        "LÍNEA 1": "brt",
        "LÍNEA 2": "brt",
        "LÍNEA O": "brt",
    },
    rail_kind="metro_ferreo",
    years=(2023, 2024, 2025),
    trend_base=2023,
    test_from="2025-01-01",
    test_until="2025-12-31",
    val_from="2024-11-01",
    folds=(
        ("Fold 1", "2023-01-01", "2023-06-30", "2023-07-01", "2023-09-30"),
        ("Fold 2", "2023-01-01", "2023-12-31", "2024-01-01", "2024-03-31"),
        ("Fold 3", "2023-01-01", "2024-06-30", "2024-07-01", "2024-09-30"),
        ("Fold 4", "2023-01-01", "2024-09-30", "2024-10-01", "2024-12-31"),
    ),
    main_models=("Baseline", "RidgeBaseline", "RandomForest", "LightGBM", "XGBoost"),
    names={
        "ds": "fecha",
        "key": "linea",
        "kind": "tipo_linea",
        "hour": "hora",
        "y": "pasajeros",
        "total": "TOTAL",
        "raw_date": "DIA_raw",
        "hour_of_day": "hora_del_dia",
        "weekday": "dia_semana",
        "month": "mes",
        "year": "año",
        "day_of_year": "dia_del_año",
        "is_weekend": "es_fin_de_semana",
        "iso_week": "semana_del_año",
        "year_trend": "año_trend",
        "is_holiday": "es_festivo",
        "is_bridge": "es_puente",
        "hour_sin": "hora_sin",
        "hour_cos": "hora_cos",
        "weekday_sin": "dia_semana_sin",
        "weekday_cos": "dia_semana_cos",
        "month_sin": "mes_sin",
        "month_cos": "mes_cos",
        "key_code": "linea_encoded",
        "kind_code": "tipo_linea_encoded",
        "is_rail": "linea_es_metro_ferreo",
        "hour_x_weekday": "hora_x_dia_semana",
        "is_morning_peak": "es_hora_pico_manana",
        "is_evening_peak": "es_hora_pico_tarde",
        "pred": "prediccion",
        "abs_err": "error_absoluto",
        "model": "modelo",
        "real": "real",
    },
)
