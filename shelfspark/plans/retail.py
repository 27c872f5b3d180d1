"""The retail feature chain: fit on train, apply with saved parameters.

Order of steps: age, fat labels, NA fat by raw type list, type recode, NA fat
for the recoded non-perishable label, weight imputation, size label for listed
outlets, price bins, ordinal codes, one-hot outlet type, drop ids and texts.
The NA-by-list step must run before the type recode: the list holds raw names.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.scalar import age_from_year, recode, set_when_in
from shelfspark.session import materialize
from shelfspark.operators.features import (
    ModeImputer,
    mode_impute_apply,
    mode_impute_fit,
    one_hot_fixed,
    ordinal_encode,
    quantile_bin_expr,
    quantile_bin_fit,
)


@dataclass(frozen=True)
class RetailConfig:
    ref_year: int
    fat_recode: dict[str, str]
    no_fat_types: tuple[Any, ...]
    type_recode: dict[str, str]
    na_type_label: str
    small_outlets: tuple[Any, ...]
    small_label: str
    size_codes: dict[str, int]
    location_codes: dict[str, int]
    outlet_types: tuple[str, ...]
    n_price_bins: int = 4
    na_fat_label: str = "NA"
    drop: tuple[str, ...] = ("Item_Identifier", "Outlet_Identifier", "Item_Type", "Item_Fat_Content")
    # column roles
    key: str = "Item_Identifier"
    weight: str = "Item_Weight"
    fat: str = "Item_Fat_Content"
    item_type: str = "Item_Type"
    price: str = "Item_MRP"
    outlet: str = "Outlet_Identifier"
    year: str = "Outlet_Establishment_Year"
    size: str = "Outlet_Size"
    location: str = "Outlet_Location_Type"
    outlet_type: str = "Outlet_Type"
    extra: dict = field(default_factory=dict)


# The lists and maps the sales-record chain uses on its own data.
SALES_RECORD_PRESET = RetailConfig(
    ref_year=2020,
    fat_recode={"low fat": "Low Fat", "LF": "Low Fat", "reg": "Regular"},
    no_fat_types=("Household", "Health and Hygiene", "Hard Drinks", "Soft Drinks", "Fruits and Vegetables"),
    type_recode={
        "Others": "Non perishable",
        "Health and Hygiene": "Non perishable",
        "Household": "Non perishable",
        "Seafood": "Meats",
        "Meat": "Meats",
        "Baking Goods": "Processed Foods",
        "Frozen Foods": "Processed Foods",
        "Canned": "Processed Foods",
        "Snack Foods": "Processed Foods",
        "Breads": "Starchy Foods",
        "Breakfast": "Starchy Foods",
        "Soft Drinks": "Drinks",
        "Hard Drinks": "Drinks",
        "Dairy": "Drinks",
    },
    na_type_label="Non perishable",
    small_outlets=("OUT010", "OUT017", "OUT045"),
    small_label="Small",
    size_codes={"High": 2, "Medium": 1, "Small": 0},
    location_codes={"Tier 1": 2, "Tier 2": 1, "Tier 3": 0},
    outlet_types=("Grocery Store", "Supermarket Type1", "Supermarket Type2", "Supermarket Type3"),
)

# The same roles mapped onto the driver's TPC-H-like tables (see FIXTURES.md).
TESTDATA_PRESET = RetailConfig(
    ref_year=2020,
    fat_recode={"A": "R"},
    no_fat_types=("PROMO",),
    type_recode={"ECONOMY": "BASIC", "STANDARD": "BASIC", "SMALL": "SIZED", "MEDIUM": "SIZED", "LARGE": "SIZED"},
    na_type_label="BASIC",
    small_outlets=(1, 2, 3),
    small_label="5-LOW",
    size_codes={"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1, "5-LOW": 0},
    location_codes={"AFRICA": 0, "AMERICA": 1, "ASIA": 2, "EUROPE": 3, "MIDDLE EAST": 4},
    outlet_types=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
)


@dataclass
class FeatureParams:
    imputer: ModeImputer
    cuts: list[float]
    held: list[DataFrame] = field(default_factory=list, repr=False)

    def release(self) -> None:
        """Unpersist what the fit materialized (the features it returned become recomputed)."""
        for df in self.held:
            df.unpersist()
        self.held.clear()

    @property
    def modes(self) -> DataFrame:
        return self.imputer.table

    @property
    def global_mode(self) -> Any:
        return self.imputer.global_mode


def clean_labels(df: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Steps before imputation, all in one projection."""
    fat = recode(cfg.fat, cfg.fat_recode)
    fat = F.when(F.col(cfg.item_type).isin(list(cfg.no_fat_types)), F.lit(cfg.na_fat_label)).otherwise(fat)
    itype = recode(cfg.item_type, cfg.type_recode)
    fat = F.when(itype == F.lit(cfg.na_type_label), F.lit(cfg.na_fat_label)).otherwise(fat)
    repl = {cfg.year: age_from_year(cfg.year, cfg.ref_year), cfg.fat: fat, cfg.item_type: itype}
    return df.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in df.columns])


def encode(df: DataFrame, cfg: RetailConfig, cuts: list[float], round_cuts: int | None = None) -> DataFrame:
    """Steps after imputation: size label for listed outlets, bins, codes, one-hot, drops."""
    size = set_when_in(cfg.size, cfg.outlet, cfg.small_outlets, cfg.small_label)
    repl = {cfg.size: size, cfg.price: quantile_bin_expr(cfg.price, cuts, round_cuts)}
    out = df.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in df.columns])
    out = ordinal_encode(out, cfg.size, cfg.size_codes)
    out = ordinal_encode(out, cfg.location, cfg.location_codes)
    out = one_hot_fixed(out, cfg.outlet_type, list(cfg.outlet_types))
    return out.drop(*cfg.drop)


def feature_pipeline_fit(df: DataFrame, cfg: RetailConfig, impute_train: bool = True,
                         materialize_as: str = "persist") -> tuple[DataFrame, FeatureParams]:
    """Fit modes and price cuts on ``df`` (train rows only) and return its features.

    The fit reads the cleaned rows several times (global mode, mode table, exact
    cuts, output), so they are materialized once (``materialize_as``, see
    ``session.materialize``); the small mode table is materialized too.
    """
    cleaned = materialize(clean_labels(df, cfg), materialize_as)
    filled, imputer = mode_impute_fit(cleaned, cfg.key, cfg.weight, fill_train=impute_train)
    imputer.table = materialize(imputer.table, materialize_as)
    cuts = quantile_bin_fit(filled, cfg.price, cfg.n_price_bins)
    held = [cleaned, imputer.table] if materialize_as == "persist" else []
    return encode(filled, cfg, cuts), FeatureParams(imputer, cuts, held)


def feature_pipeline_apply(df: DataFrame, cfg: RetailConfig, params: FeatureParams, fallback: Any = "frame",
                           materialize_as: str = "persist", round_cuts: int | None = None) -> DataFrame:
    """Apply saved parameters. ``fallback="frame"``: global mode of ``df`` (batch), which
    reads the rows twice, so they are materialized first; pass ``params.global_mode``
    where the frame cannot be aggregated first (streams): then nothing is materialized.
    ``round_cuts=3`` bins with edges rounded as the saved interval labels were."""
    cleaned = clean_labels(df, cfg)
    if isinstance(fallback, str) and fallback == "frame":
        cleaned = materialize(cleaned, materialize_as)
    filled = mode_impute_apply(cleaned, params.modes, cfg.key, cfg.weight, fallback=fallback)
    return encode(filled, cfg, params.cuts, round_cuts)
