"""Marts kept up to date load by load.

For every load and mart a partial state is stored: totals per key (sums, counts, first and
last day) and the sets of transactions and members as containers. States merge, so after a
load only the keys it touches, now or in the attempt it replaces, are merged anew from the
states of all loads; the other rows of the mart are taken over. Results equal a full rebuild.

One manifest names the state of each load and the version of each mart. It is written aside
and renamed, so that all marts change together and a run that breaks off changes nothing.
Readers of the manifest before keep its files; older ones are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial as partial_call
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import member_sets
from tallyspark.functions.arrays import sorted_with_null_last
from tallyspark.functions.cleaners import LENIENT
from tallyspark.functions.decimals import rounded_quotient
from tallyspark.operators import marts
from tallyspark.operators.staging import stage_transactions
from tallyspark.schemas import AMOUNT_SCALE, MONEY
from tallyspark.session import CODEC, Scratch, delete, read_text, replace_text, shuffles_deleted, side_by_side
from tallyspark.sources.tables import Warehouse

_SUM, _MIN, _MAX = F.sum, F.min, F.max


@dataclass(frozen=True)
class Mart:
    """How a mart is made of mergeable states.

    ``totals`` maps a state column to its aggregate over the rows and to the aggregate that
    merges it; ``sets`` maps a set to the column of its members; ``result`` maps the columns
    of the mart to expressions over merged totals, set sizes (``n_<set>``) and members
    (``<set>_members``, of the sets in ``shown``).
    """

    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    totals: Mapping[str, tuple[Column, Callable[[str], Column]]]
    sets: Mapping[str, str]
    result: Mapping[str, Column]
    shown: tuple[str, ...] = ()


def _money(name: str) -> Column:
    return F.round(name, 2).cast(MONEY)


def _days() -> dict:
    return {
        "first_transaction_date": (F.min("transaction_date"), _MIN),
        "last_transaction_date": (F.max("transaction_date"), _MAX),
    }


def _paid() -> dict:
    return {
        **_days(),
        "units": (F.sum("quantity"), _SUM),
        "paid": (F.sum("total_amount"), _SUM),
        "taxes": (F.sum("tax"), _SUM),
    }


def _shown(units: str) -> dict[str, Column]:
    return {
        "total_transactions": F.col("n_transactions"),
        **{day: F.col(day) for day in _days()},
        units: F.col("units"),
        "total_paid": _money("paid"),
        "total_taxes": _money("taxes"),
    }


def _with_members(keys: tuple[str, ...], member: str, array: str, count: str) -> Mart:
    members = sorted_with_null_last(F.col("member_members"), F.col("without_member") > 0)
    return Mart(
        keys,
        marts.fact_transactions,
        {**_paid(), "without_member": (F.count_if(F.col(member).isNull()), _SUM)},
        {"transactions": "transaction_id", "member": member},
        {**_shown("total_products"), array: members, count: F.col("n_member")},
        ("member",),
    )


def _agg_by_customer() -> Mart:
    return _with_members(("customer_id",), "product_id", "product_ids", "count_different_products")


def _agg_by_product() -> Mart:
    return _with_members(("product_id", "product_name"), "customer_id", "customer_ids", "count_different_customers")


def _agg_by_customer_product() -> Mart:
    keys = ("customer_id", "product_id", "product_name")
    return Mart(keys, marts.fact_transactions, _paid(), {"transactions": "transaction_id"}, _shown("total_quantity"))


def _dim_customers() -> Mart:
    prices, priced = F.col("prices").cast(f"decimal(34,{AMOUNT_SCALE})"), F.col("priced").cast("decimal(20,0)")
    return Mart(
        ("customer_id",),
        marts.priced_rows,
        {
            **_days(),
            "gross": (F.sum(marts.gross()), _SUM),
            "taxes": (F.sum("tax"), _SUM),
            "paid": (F.sum(marts.gross() + F.col("tax")), _SUM),
            "prices": (F.sum("price"), _SUM),
            "priced": (F.count("price"), _SUM),
        },
        {"transactions": "transaction_id", "products": "product_id"},
        {
            **{day: F.col(day) for day in _days()},
            "total_transactions": F.col("n_transactions"),
            "distinct_products_purchased": F.col("n_products"),
            "total_gross_amount": _money("gross"),
            "total_tax_paid": _money("taxes"),
            "total_amount_incl_tax": _money("paid"),
            "avg_unit_price": rounded_quotient(prices, priced, 2).cast(MONEY),
        },
    )


MARTS: dict[str, Callable[[], Mart]] = {
    "agg_by_customer": _agg_by_customer,
    "agg_by_product": _agg_by_product,
    "agg_by_customer_product": _agg_by_customer_product,
    "dim_customers": _dim_customers,
}


# --- states -------------------------------------------------------------------------


def partial(mart: Mart, staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The state of some rows: totals per key, and containers of its sets."""
    rows = mart.rows(staged)
    totals = rows.groupBy(*mart.keys).agg(*[made.alias(name) for name, (made, _) in mart.totals.items()])
    return totals, member_sets.containers(rows, mart.keys, mart.sets)


def merge(mart: Mart, totals: DataFrame, containers: DataFrame) -> DataFrame:
    """The mart of all rows behind the states.

    Totals and containers go to their key together, in one shuffle; the columns of the one
    are NULL in the rows of the other, which every aggregate here passes over.
    """
    merged = [
        merging(name).cast(totals.schema[name].dataType).alias(name) for name, (_, merging) in mart.totals.items()
    ]
    sets = [member_sets.size_of(name).alias(f"n_{name}") for name in mart.sets]
    sets += [member_sets.members_of(name).alias(f"{name}_members") for name in mart.shown]
    parts = totals.unionByName(member_sets.union(containers, mart.keys), allowMissingColumns=True)
    whole = parts.groupBy(*mart.keys).agg(*merged, *sets)
    return whole.select(*mart.keys, *[shown.alias(name) for name, shown in mart.result.items()])


def _of_keys(rows: DataFrame, keys: tuple[str, ...], chosen: DataFrame, how: str) -> DataFrame:
    """Rows whose key is (left_semi) or is not (left_anti) among the chosen ones; NULL equals NULL."""
    named = chosen.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return rows.join(named, same, how)


# --- the store ----------------------------------------------------------------------


@dataclass(frozen=True)
class IncrementalMarts:
    """The marts of a warehouse, by its loads. ``names`` limits them, as for one's own reports."""

    warehouse: Warehouse
    names: tuple[str, ...] = tuple(MARTS)
    mode: str = LENIENT

    @property
    def base(self) -> str:
        return f"{self.warehouse.base}/incremental"

    @property
    def _manifest_path(self) -> str:
        return f"{self.base}/_manifest"

    def manifest(self) -> dict:
        """The published versions: ``loads`` by load id, ``marts`` by name, and the ones before."""
        text = read_text(self.warehouse.spark, self._manifest_path)
        return json.loads(text) if text else {"loads": {}, "marts": {}, "former": []}

    def _state(self, name: str, part: str, version: str) -> str:
        return f"{self.base}/states/{version}/{name}/{part}"

    def _mart(self, name: str, version: str) -> str:
        return f"{self.base}/marts/{name}/{version}"

    def table(self, name: str) -> DataFrame:
        """A mart as last published."""
        return self.warehouse.spark.read.parquet(self._mart(name, self.manifest()["marts"][name]))

    def tables(self) -> dict[str, DataFrame]:
        """All marts of one publication."""
        versions = self.manifest()["marts"]
        return {name: self.warehouse.spark.read.parquet(self._mart(name, v)) for name, v in versions.items()}

    def _states(self, name: str, part: str, versions: Iterable[str]) -> DataFrame | None:
        paths = [self._state(name, part, version) for version in versions]
        return self.warehouse.spark.read.parquet(*paths) if paths else None

    def update(self, *load_ids: str) -> None:
        """Bring the marts up to date with these loads, new, repeated or emptied, and with any missing one."""
        before = self.manifest()
        stored = set(self.warehouse.load_ids())
        changed = sorted({*load_ids, *(stored - set(before["loads"])), *(set(before["loads"]) - stored)})
        if not changed and before["marts"]:
            return
        loads = {load: v for load, v in before["loads"].items() if load not in changed}
        fresh = {load: uuid.uuid4().hex for load in changed if load in stored}
        replaced = [before["loads"][load] for load in changed if load in before["loads"]]
        side_by_side(partial_call(self._write_state, load, version) for load, version in fresh.items())
        loads |= fresh
        versions = {name: self._write_mart(name, before, loads, [*fresh.values(), *replaced]) for name in self.names}
        self._publish(before, loads, before["marts"] | versions)

    def _write_state(self, load_id: str, version: str) -> None:
        with Scratch(self.warehouse.spark) as scratch:
            staged = scratch.materialize(stage_transactions(self.warehouse.raw_load(load_id), self.mode), "staged")
            side_by_side(
                partial_call(rows.write.parquet, self._state(name, part, version), compression=CODEC)
                for name in self.names
                for part, rows in zip(("totals", "containers"), partial(MARTS[name](), staged), strict=True)
            )

    def _write_mart(self, name: str, before: dict, loads: Mapping[str, str], touched: list[str]) -> str:
        mart, version = MARTS[name](), uuid.uuid4().hex
        former = before["marts"].get(name)
        if former and not touched:
            return former
        totals, containers = (self._states(name, part, loads.values()) for part in ("totals", "containers"))
        if former is None:
            rows = None if totals is None else merge(mart, totals, containers)
        else:
            kept = self.warehouse.spark.read.parquet(self._mart(name, former))
            keys = self._states(name, "totals", touched).select(*mart.keys).distinct()
            rows = _of_keys(kept, mart.keys, keys, "left_anti")
            if totals is not None:
                anew = (_of_keys(part, mart.keys, keys, "left_semi") for part in (totals, containers))
                rows = rows.unionByName(merge(mart, *anew))
        if rows is None:
            rows = merge(mart, *partial(mart, stage_transactions(self.warehouse.raw(), self.mode)))
        with shuffles_deleted(self.warehouse.spark):
            rows.write.parquet(self._mart(name, version))
        return version

    def _publish(self, before: dict, loads: dict[str, str], versions: dict[str, str]) -> None:
        kept = [f"states/{v}" for v in before["loads"].values()]
        kept += [f"marts/{name}/{v}" for name, v in before["marts"].items()]
        content = {"loads": loads, "marts": versions, "former": kept}
        replace_text(self.warehouse.spark, self._manifest_path, json.dumps(content))
        current = {f"states/{v}" for v in loads.values()} | {f"marts/{name}/{v}" for name, v in versions.items()}
        for path in set(before["former"]) - current - set(kept):
            delete(self.warehouse.spark, f"{self.base}/{path}")

