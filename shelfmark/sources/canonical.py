"""The star schema from any set of canonical tables, e.g. a folder of CSV files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.exact import MONEY, PRICE
from shelfmark.sources import files

# Types of the money columns; other columns keep the types they were read with.
_MONEY = {"base_price": PRICE, "cost": PRICE, "selling_price": PRICE, "competitor_price": PRICE,
          "revenue": MONEY, "profit": MONEY}
# Columns that a source may leave out.
_DEFAULTS = {"inventory": {"warehouse_stock": 0, "reorder_level": 50}}


def conform(name: str, table: DataFrame) -> DataFrame:
    """Money as decimals (rounded to cents), missing optional columns filled."""
    out = table.withColumns({c: F.round(F.col(c), 2).cast(t) for c, t in _MONEY.items() if c in table.columns})
    missing = {c: F.lit(v).cast("bigint") for c, v in _DEFAULTS.get(name, {}).items() if c not in table.columns}
    return out.withColumns(missing) if missing else out


@dataclass
class TableModel:
    """The same interface as the test-table adapter, over given frames."""

    spark: SparkSession
    tables: dict[str, DataFrame]
    _cache: dict = field(default_factory=dict, repr=False)

    def __getattr__(self, name: str) -> DataFrame:
        if name in ("products", "stores", "transactions", "inventory", "promotions"):
            return conform(name, self.tables[name])
        raise AttributeError(name)

    @property
    def clean_transactions(self) -> DataFrame:
        """The cleaned fact table (T1 over all columns, then T2-T5), written once."""
        from shelfmark.operators import clean

        if "clean" not in self._cache:
            self._cache["clean"] = clean.write_clean(clean.deduplicate(self.transactions).hint("rebalance", "product_id"))
        return self._cache["clean"]

    @property
    def cleaning(self) -> dict[str, int]:
        """Rows checked and removed (T3), as observed while the cleaned table was written."""
        return self.clean_transactions._cleaning


def read_folder(spark: SparkSession, raw_dir: str) -> TableModel:
    """Every CSV file of the folder as a table."""
    return TableModel(spark, files.extract(spark, raw_dir))
