"""Display texts: magnitudes in Brazilian notation and metric labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from municipia.params import Selection

EM_DASH = "—"


def _brazilian(value: Column, decimals: int) -> Column:
    """Grouped number with at most ``decimals`` decimals, point for groups and comma for decimals."""
    text = F.call_function("format_number", F.round(value, decimals), F.lit("#,##0." + "#" * decimals))
    return F.translate(text, ",.", ".,")


def fmt_magnitude(value: Column, metric: Column | str) -> Column:
    """Dash for nothing, kg/ha for yields, else a number with the suffix mil, Mi or Gi."""
    metric = F.lit(metric) if isinstance(metric, str) else metric
    nothing = value.isNull() | (value == 0) | F.isnan(value)
    return (
        F.when(nothing, F.lit(EM_DASH))
        .when(metric == "r", F.concat(_brazilian(value, 1), F.lit(" kg/ha")))
        .when(value >= 1e9, F.concat(_brazilian(value / 1e9, 2), F.lit(" Gi")))
        .when(value >= 1e6, F.concat(_brazilian(value / 1e6, 2), F.lit(" Mi")))
        .when(value >= 1e3, F.concat(_brazilian(value / 1e3, 1), F.lit(" mil")))
        .otherwise(_brazilian(value, 1))
    )


# Labels of the crop metrics.
CROP_LABELS = {"p": "Produção (ton)", "a": "Área Colhida (ha)", "v": "Valor (mil R$)", "r": "Rendimento (kg/ha)"}


def metric_label(selection: Selection, category: Column | None = None, unit: Column | None = None) -> Column:
    """Label of the selected metric; for livestock it names the category and its unit."""
    if selection.domain == "crop":
        return F.lit(CROP_LABELS[selection.metric])
    category = F.lit(selection.category) if category is None else category
    unit = F.lit("") if unit is None else F.coalesce(unit, F.lit(""))
    if selection.metric == "v":
        named = F.concat(category, F.lit(" — Valor (mil R$)"))
    else:
        quantity = " — Efetivo" if selection.kind == "Rebanho" else " — Quantidade"
        named = F.concat(category, F.lit(quantity), F.when(unit == "", "").otherwise(F.concat(F.lit(" ("), unit, F.lit(")"))))
    missing = category.isNull() | (category == "")
    return F.when(missing, F.lit("Selecione uma categoria")).otherwise(named)
