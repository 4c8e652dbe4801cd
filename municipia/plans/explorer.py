"""The interactive questions over both domains.

Every answer is an aggregate of the base roll-ups (or of raw rows with the same columns): scope
predicates first, so that year and state reach the scan, then one roll-up to the level asked for.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.cleaning import round_half_even
from municipia.functions.labels import fmt_magnitude, metric_label
from municipia.functions.units import scaled, total, total_sql, whole_units
from municipia.operators import kpi, rank
from municipia.operators.choropleth import attach_values_to_features, colour_classes, features_in_scope
from municipia.operators.classify import classify_group
from municipia.operators.filters import active_categories, drop_null_keys, scope_filter
from municipia.operators.lookups import attach_names, attach_unit, category_units
from municipia.operators.rollup import with_yield_parts, yield_mean, yield_weighted
from municipia.operators.series import densify
from municipia.params import Selection
from municipia.sinks import exports
from municipia.sinks.files import write_csv


def _yield_ready(fact: DataFrame) -> DataFrame:
    return with_yield_parts(fact) if "r" in fact.columns and "r_sum" not in fact.columns else fact


@dataclass(frozen=True)
class Explorer:
    """``crop``: uf, mic, mun, category, year, a, p, v, and r or r_sum and r_n.
    ``livestock``: uf, mic, mun, kind, category, year, q, v."""

    crop: DataFrame | None = None
    groups: DataFrame | None = None
    livestock: DataFrame | None = None
    states: DataFrame | None = None
    micros: DataFrame | None = None
    municipalities: DataFrame | None = None
    years: tuple[int, ...] = ()
    # Units per amount of measures held as whole counts, see functions.units.
    crop_units: Mapping[str, int] = field(default_factory=dict)
    livestock_units: Mapping[str, int] = field(default_factory=dict)

    # -- rows in scope -------------------------------------------------------------------------

    def _rows(self, sel: Selection, use_category: bool = True, year: bool = True) -> DataFrame:
        if sel.domain == "livestock":
            scoped = scope_filter(self.livestock, sel, year)
            return scoped if sel.category is None else scoped.where(F.col("category") == sel.category)
        chosen = sel if use_category else sel.with_(category=None)
        scoped = scope_filter(_yield_ready(self.crop), sel, year)
        if chosen.category is not None:
            return scoped.where(F.col("category") == chosen.category)
        return scoped if sel.group == fixed.ALL else active_categories(classify_group(scoped, self.groups), chosen)

    def _units(self, sel: Selection) -> Mapping[str, int]:
        return self.livestock_units if sel.domain == "livestock" else self.crop_units

    def _sum(self, sel: Selection, measure: str) -> Column:
        """Sum of a measure as an amount."""
        source = self.livestock if sel.domain == "livestock" else _yield_ready(self.crop)
        summed = F.expr(total_sql(dict(source.dtypes)[measure], measure)).cast("double")
        per_one = self._units(sel).get(measure, 1)
        return summed if per_one == 1 else summed / F.lit(float(per_one))

    @staticmethod
    def _one_unit(sel: Selection) -> None:
        """Livestock categories have different units: heads, litres, dozens. Only a question about one of them has a sum."""
        if sel.domain == "livestock" and sel.category is None:
            raise ValueError("a livestock question needs a category")

    def _value(self, sel: Selection, below_state: bool = False) -> Column:
        """The metric of a group of rows."""
        if sel.metric != "r":
            return F.coalesce(self._sum(sel, sel.metric), F.lit(0.0))
        if sel.compat and below_state:
            return F.lit(0.0)
        return F.coalesce(yield_weighted(self._sum(sel, "p"), self._sum(sel, "a")), F.lit(0.0))

    @staticmethod
    def _sum_values(sel: Selection) -> Column:
        """Sum of a column ``value``; rounded values are added as whole units, which is exact."""
        if not sel.compat:
            return F.sum("value")
        per_one = 100 if sel.metric == "r" else 10
        return F.sum(whole_units(F.col("value"), per_one)).cast("double") / F.lit(float(per_one))

    def cells(self, sel: Selection, year: bool = True) -> DataFrame:
        """Value per state, category and year; with ``compat`` rounded as in the published package."""
        keys = ["uf", "category", "year"]
        rows = drop_null_keys(self._rows(sel, year=year), keys)
        if sel.metric == "r" and sel.compat:
            parts = rows.groupBy(*keys).agg(self._sum(sel, "r_sum").alias("r_sum"), F.sum("r_n").alias("r_n"))
            return parts.select(*keys, round_half_even(F.coalesce(yield_mean(), F.lit(0.0)), 2).alias("value"))
        valued = rows.groupBy(*keys).agg(self._value(sel).alias("value"))
        return valued.withColumn("value", round_half_even(F.col("value"), 1)) if sel.compat else valued

    # -- values per level ------------------------------------------------------------------------

    def values(self, sel: Selection, level: str, year: bool = True) -> DataFrame:
        """Value per key of ``uf``, ``mic`` or ``mun`` (and per year if ``year`` is off)."""
        self._one_unit(sel)
        keys = [level] if year else [level, "year"]
        if sel.compat and level == "uf":
            return self.cells(sel, year).groupBy(*keys).agg(self._sum_values(sel).alias("value"))
        # Compat below state level: only combine-harvested categories exist there, and none at all for municipalities.
        use_category = True
        if sel.compat and sel.domain == "crop" and sel.category is not None:
            use_category = level == "mic" and sel.micro_group_key([sel.category] if self._is_combine(sel.category) else []) == sel.category
        rows = drop_null_keys(self._rows(sel, use_category, year), keys)
        valued = rows.groupBy(*keys).agg(self._value(sel, below_state=level != "uf").alias("value"))
        return valued.withColumn("value", round_half_even(F.col("value"), 1)) if sel.compat else valued

    def _is_combine(self, category: str) -> bool:
        return bool(self.groups.where((F.col("category") == category) & (F.col(fixed.COL) == 1)).take(1))

    # -- rankings --------------------------------------------------------------------------------

    def top_states(self, sel: Selection, k: int = 15) -> DataFrame:
        best = rank.top_k(self.values(sel.with_(uf=None, mic=None, mun=None), "uf"), k, key="uf")
        return attach_names(best, self.states, "uf", "uf_name").orderBy(*rank.ranking_order(key="uf"))

    def top_categories(self, sel: Selection, k: int = 15) -> DataFrame:
        """Of one state if the selection has one, else of the country."""
        wide = sel.with_(mic=None, mun=None, category=None if sel.domain == "livestock" else sel.category)
        if sel.compat:
            cells = self.cells(wide)
            if sel.domain == "livestock":
                cells = cells.join(self._rows(wide).where(F.col("kind") == sel.kind).select("category").distinct(), "category", "left_semi")
            totals = cells.groupBy("category").agg(self._sum_values(wide).alias("value"))
        else:
            rows = self._rows(wide)
            rows = rows.where(F.col("kind") == sel.kind) if sel.domain == "livestock" else rows
            totals = drop_null_keys(rows, ["category"]).groupBy("category").agg(self._value(sel).alias("value"))
        return rank.top_k(totals, k, key="category")

    def top_micros(self, sel: Selection, k: int = 20, keep_zeros: bool = False) -> DataFrame:
        values = self.values(sel.with_(mic=None, mun=None), "mic")
        if keep_zeros:
            dim = self.micros if sel.uf is None else self.micros.where(F.col("uf") == sel.uf)
            values = attach_values_to_features(dim.select("mic"), values, "mic")
        best = rank.top_k(values, k, key="mic", keep_zeros=keep_zeros)
        return attach_names(best, self.micros, "mic", "mic_name").orderBy(*rank.ranking_order(key="mic"))

    def _ranked_municipalities(self, sel: Selection, values: DataFrame) -> DataFrame:
        """The published livestock ranking knows only the municipalities of the crop dimension."""
        if sel.compat and sel.domain == "livestock":
            return values.join(self.municipalities.select("mun"), "mun", "left_semi")
        return values

    def municipality_ranking(self, sel: Selection, k: int = 100) -> DataFrame:
        """Best municipalities of the state with position and the names of municipality and micro-region."""
        values = self.values(sel.with_(mic=None, mun=None), "mun")
        best = rank.ranked_top_k(self._ranked_municipalities(sel, values), k, key="mun")
        found = self.municipalities.select("mun", "mun_name", "mic")
        named = best.join(found, "mun", "left").withColumn("mun_name", F.coalesce("mun_name", F.col("mun").cast("string")))
        with_micro = attach_names(named, self.micros, "mic", "mic_name", default=F.lit(""))
        return with_micro.select("position", "mun", "mun_name", "mic_name", "value").orderBy("position")

    def top_municipalities(self, sel: Selection, k: int = 15) -> DataFrame:
        return self.municipality_ranking(sel, k)

    # -- series ----------------------------------------------------------------------------------

    def series(self, sel: Selection) -> DataFrame:
        """``year, value, is_observed`` of the narrowest chosen scope: micro-region, state, or country."""
        self._one_unit(sel)
        if sel.scope_level() == "mic":
            wanted = self.values(sel.with_(uf=None, mun=None), "mic", year=False)
        elif sel.compat:
            wanted = self.values(sel.with_(mic=None, mun=None), "uf", year=False)
        else:
            rows = self._rows(sel.with_(mic=None, mun=None), year=False)
            wanted = rows.groupBy("year").agg(self._value(sel).alias("value"))
        yearly = wanted.groupBy("year").agg(self._sum_values(sel).alias("value"))
        return densify(yearly, [], ["value"], self.years)

    def municipality_series(self, sel: Selection) -> DataFrame:
        """The chosen municipality if it has data, else its state added up from its municipalities."""
        self._one_unit(sel)
        if sel.mun is not None:
            one = self.values(sel.with_(uf=None, mic=None), "mun", year=False)
            source = self.livestock if sel.domain == "livestock" else self.crop
            present = source.where(F.col("mun") == sel.mun)
            if sel.domain == "livestock":
                present = present.where(F.col("category") == sel.category)
            if present.take(1):
                return densify(one.select("year", "value"), [], ["value"], self.years)
        wide = sel.with_(mic=None, mun=None)
        if sel.compat:
            yearly = self.values(wide, "mun", year=False).groupBy("year").agg(self._sum_values(sel).alias("value"))
        else:
            yearly = drop_null_keys(self._rows(wide, year=False), ["mun", "year"]).groupBy("year").agg(self._value(sel).alias("value"))
        return densify(yearly, [], ["value"], self.years)

    # -- maps, headline numbers, labels, exports ------------------------------------------------------

    def choropleth(self, sel: Selection, features: DataFrame, level: str = "uf") -> DataFrame:
        """Features in scope with value, scope maximum, class and colour."""
        palette = fixed.PALETTE_COUNTRY if level == "uf" else fixed.PALETTE_REGION
        if level == "uf":
            dim, values = self.states, self.values(sel.with_(uf=None, mic=None, mun=None), "uf")
        else:
            dim, values = self.micros, self.values(sel.with_(mic=None, mun=None), "mic")
        inside = features_in_scope(features, dim, level, sel.uf if level == "mic" else None)
        return colour_classes(attach_values_to_features(inside, values, level), palette=palette)

    def kpis(self, sel: Selection) -> DataFrame:
        self._one_unit(sel)
        rows = self._rows(sel.with_(mic=None, mun=None))
        if sel.domain == "livestock":
            known = self.municipalities if sel.compat else None
            return scaled(kpi.kpi_livestock(rows, known=known), self.livestock_units)
        cells = drop_null_keys(rows, ["uf"]).groupBy("uf", "category").agg(*[total(rows, c) for c in ("a", "p", "v")])
        if not sel.compat:
            return scaled(kpi.kpi_crop(cells), self.crop_units)
        amounts = scaled(cells, self.crop_units)
        tenths = amounts.withColumns({c: whole_units(round_half_even(F.col(c), 1), 10) for c in ("a", "p", "v")})
        return scaled(kpi.kpi_crop(tenths), {"a": 10, "p": 10, "v": 10})

    def labelled(self, values: DataFrame, sel: Selection) -> DataFrame:
        """Values with their display text and the label of the metric."""
        if sel.domain == "crop":
            return values.select("*", fmt_magnitude(F.col("value"), sel.metric).alias("text"), metric_label(sel).alias("label"))
        named = values if "category" in values.columns else values.withColumn("category", F.lit(sel.category))
        units = attach_unit(named, F.broadcast(category_units(values.sparkSession)))  # 16 rows
        label = metric_label(sel, F.col("category"), F.col("unit"))
        return units.select("*", fmt_magnitude(F.col("value"), sel.metric).alias("text"), label.alias("label"))

    def export_rows(self, sel: Selection) -> DataFrame:
        self._one_unit(sel)
        cells = self.cells(sel.with_(mic=None, mun=None))
        return exports.export_slice_rows(cells, self.states).orderBy("uf", "category")

    def export_document(self, sel: Selection) -> DataFrame:
        """One JSON text. Crop exports keep states that have data in any year; livestock exports do not."""
        self._one_unit(sel)
        self._one_year(sel)
        scoped = sel.with_(mic=None, mun=None)
        cells = self.cells(scoped)
        if sel.domain == "crop":
            seen = scope_filter(self.crop, scoped, year=False).select("uf").where(F.col("uf").isNotNull()).distinct()
            cells = seen.join(cells, "uf", "left")
        maps = exports.export_state_maps(cells, keep_empty=sel.domain == "crop")
        return exports.export_document(maps, F.lit(sel.year), sel.metric, sel.uf)

    def write_export_csv(self, sel: Selection, folder: str) -> str:
        """The export as CSV under its published name and headings; returns the path."""
        self._one_year(sel)
        heading = "Categoria" if sel.domain == "livestock" else "Cultura"
        rows = self.export_rows(sel).select("uf", "uf_name", "category", "value")
        spark = rows.sparkSession
        one = spark.createDataFrame([(sel.category, 0.0)], "category string, value double")
        label = self.labelled(one, sel).first()["label"]  # from the selection alone
        path = f"{folder}/{self._export_name(sel)}_{sel.uf or 'Brasil'}.csv"
        write_csv(rows.toDF("UF", "Estado", heading, label), path)
        return path

    def write_export_json(self, sel: Selection, folder: str) -> str:
        path = f"{folder}/{self._export_name(sel)}.json"
        self.export_document(sel).write.text(path)
        return path

    @staticmethod
    def _one_year(sel: Selection) -> None:
        if sel.year is None:
            raise ValueError("an export needs a year")

    @staticmethod
    def _export_name(sel: Selection) -> str:
        return f"{'PPM' if sel.domain == 'livestock' else 'PAM'}_{sel.year}"
