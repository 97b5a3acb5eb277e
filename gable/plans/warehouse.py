"""The listing warehouse: each table is built on first use and written once."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from gable.plans import adapter, gold, hotspot_model, silver, views
from gable.runtime import stage


class Missing(KeyError):
    """A table whose input was not given."""


class Warehouse(Mapping[str, DataFrame]):
    """Tables of one data set by name, built lazily in dependency order.

    Silver, dimensions and facts go through ``store`` (default: written to the
    shared folder and read back); the views stay virtual. Tables in ``given``
    exist already and are used as they are. What depends on an input that was
    not given raises :class:`Missing` and is left out of iteration.
    """

    def __init__(
        self,
        spark: SparkSession,
        listings: DataFrame | None = None,
        stations: DataFrame | None = None,
        trends: DataFrame | None = None,
        *,
        exact: bool = True,
        store: Callable[[DataFrame, str], DataFrame] = stage,
        given: Mapping[str, DataFrame] | None = None,
    ):
        self.spark, self.exact, self._store = spark, exact, store
        self._built: dict[str, DataFrame] = dict(given or {})
        inputs = {"silver_stations": stations, "silver_trends": trends}
        self._recipes: dict[str, Callable[[], DataFrame]] = {
            "silver_stations": lambda: silver.clean_stations(stations, self["area_codes"], self["ward_codes"]),
            "silver_trends": lambda: silver.clean_trends(trends),
            "dim_time": lambda: gold.dim_time(spark),
            "dim_location": lambda: gold.dim_location(self["silver_listings"], exact=exact),
            "dim_property": lambda: gold.dim_property(self["silver_listings"]),
            "dim_seller": lambda: gold.dim_seller(self["silver_listings"], exact=exact),
            "dim_metro_station": lambda: gold.dim_station(self["silver_stations"]),
            "dim_search_category": lambda: gold.dim_search_category(spark),
            "fact_properties": lambda: gold.fact_properties(
                self["silver_listings"], self["dim_location"], self["dim_property"], self["dim_seller"], exact=exact
            ),
            "fact_price_area_time": lambda: gold.fact_price_area_time(
                self["silver_listings"], self["dim_location"], self["dim_property"], exact=exact
            ),
            "fact_seller_time": lambda: gold.fact_seller_time(self["silver_listings"], self["dim_seller"], exact=exact),
            "fact_metro_analysis": lambda: gold.fact_metro_analysis(
                self["silver_listings"], self["dim_location"], self["dim_property"], self["dim_metro_station"]
            ),
            "fact_search_trends_monthly": lambda: gold.fact_search_trends_monthly(
                self["silver_trends"], self["dim_time"], self["dim_search_category"]
            ),
        }
        self._recipes = {name: made for name, made in self._recipes.items() if inputs.get(name, spark) is not None}
        self._listings = listings

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in ("silver_listings", "area_codes", "ward_codes"):
                self._build_silver()
            elif name in self._recipes:
                self._built[name] = self._store(self._recipes[name](), name)
            elif name in views.VIEWS:
                self._built[name] = views.VIEWS[name](self)
            elif name == "vw_ml_hotspot_dataset":
                self._built[name] = hotspot_model.hotspot_dataset(self)
            else:
                raise Missing(name)
        return self._built[name]

    def _build_silver(self) -> None:
        if self._listings is None:
            raise Missing("silver_listings")
        rows, areas, wards = silver.clean_listings(self._listings, exact=self.exact)
        self._built.update(silver_listings=self._store(rows, "silver_listings"), area_codes=areas, ward_codes=wards)

    def __iter__(self):
        for name in dict.fromkeys(("silver_listings", "area_codes", "ward_codes", *self._built, *self._recipes, *views.VIEWS, "vw_ml_hotspot_dataset")):
            try:
                self[name]
            except Missing:
                continue
            yield name

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def register(self) -> None:
        """Build everything that can be built and make it available to ``spark.sql`` by name."""
        for name in self:
            self[name].createOrReplaceTempView(name)


_open: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over the order tables in ``folder``, shared within the application."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _open:
        _open[key] = Warehouse(
            spark, adapter.listings(spark, folder), adapter.stations(spark, folder), adapter.trends(spark, folder)
        )
    return _open[key]
