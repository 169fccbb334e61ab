"""The stored tables of a load and what follows from it: only partitions that the load touches are read and rewritten.

Charges and the ledger lie in buckets of their file, as a load adds and checks whole files. What is looked up by shipment (attributes,
costs by file, warehouse packages) lies in buckets of the tracking number. Ledger rows that wait for their package are a partition of
their own, so that a delivery of warehouse data rewrites those alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fold
from ..operators.lookup import lookup_join
from ..operators.merge import append_new
from ..session import written
from ..sources.store import BUCKETS, Layout, Store, bucket
from . import gold
from .carriers import UPS, CarrierPlan
from .unify import SHIPMENT_KEY, file_costs, shipment_attributes, shipment_charges, shipment_summary, upsert_attributes

_TRACKING = ("tracking_number",)
FEW_BUCKETS = 16  # up to as many, a task writes into all of them and rows are not exchanged for it


def layouts(n: int = BUCKETS) -> dict[str, Layout]:
    """Layouts of the stored tables; ``n`` buckets each, the same for as long as a store lives."""
    many = n > FEW_BUCKETS
    by_file = Layout(lambda: {"bucket": bucket(["file_id"], n=n)}, many)
    by_shipment = Layout(lambda: {"bucket": bucket(["tracking_number"], _TRACKING, n)}, many)
    return {
        "charges": by_file,
        "attributes": by_shipment,
        "costs": by_shipment,
        "packages": by_shipment,
        "shipments": Layout(lambda: {"bucket": bucket(["shipment_id"], n=n)}, many),
        "ledger": Layout(lambda: {"waiting": F.col("shipment_package_id").isNull(), "bucket": bucket(["file_id"], n=n)}, many),
    }


def stored_ledger(store: Store, files: DataFrame) -> DataFrame | None:
    """The ledger's rows in the buckets of some files (file_id), waiting or not; None before the first load."""
    if not store.has("ledger"):
        return None
    buckets = store.layouts["charges"].parts(files)
    return store.read_parts("ledger", [{"waiting": waiting, **p} for waiting in (True, False) for p in buckets])


def stored_charges(store: Store, files: DataFrame) -> DataFrame:
    """The charges of some files; ``files`` (file_id) is measured and broadcast where it is small."""
    near = store.read_beside("charges", files)
    return lookup_join(near, files.select("file_id").distinct(), ["file_id"], "left_semi")


def unified(
    store: Store, plan: CarrierPlan, lines: DataFrame, charge_types: DataFrame, *,
    methods: DataFrame | None = None, carriers: DataFrame | None = None,
) -> tuple[dict[str, DataFrame], dict[str, tuple[DataFrame, list[dict]]]]:
    """What the lines of new files append to the stored tables, and which partitions of attributes they replace."""
    charges = store.stage("charges", shipment_charges(plan, lines, charge_types))
    append = {"charges": charges, "costs": file_costs(charges)}
    found = shipment_attributes(plan, lines, methods=methods, carriers=carriers)
    if not store.has("attributes"):
        return append | {"attributes": found}, {}
    found = written(found, "attributes")
    parts = store.layouts["attributes"].parts(found)
    known = store.read_parts("attributes", parts)
    if plan is UPS:
        return append, {"attributes": (upsert_attributes(plan, known, found), parts)}
    return append | {"attributes": append_new(found, known, SHIPMENT_KEY, text_keys=_TRACKING)}, {}


def load_to_gold(
    store: Store, files: DataFrame, *, methods: DataFrame, charge_types: DataFrame, categories: DataFrame, orders: DataFrame,
    markups: DataFrame | None = None, default_markups: DataFrame | None = None,
) -> None:
    """Warehouse packages and shipments, ledger and markups after the files (file_id) of a load.

    The store holds charges, attributes and costs, and the warehouse's packages and shipments. All is published together; running
    the same files again changes nothing.
    """
    version = store.version()
    charges = stored_charges(store, files)
    touched = written(gold.file_shipments(charges), "touched")
    attributes = written(gold.of_files(store.read_beside("attributes", touched), touched), "touched-attributes")
    # corrections add to what earlier files have billed for the same shipments
    costs = gold.of_files(store.read_beside("costs", touched), touched)
    package_parts = store.layouts["packages"].parts(touched)
    before = store.read_parts("packages", package_parts)
    packages = store.stage("packages", gold.enrich_packages(before, shipment_summary(attributes, costs), methods))
    ours = packages.withColumn("__t", fold(F.col("tracking_number"))).join(
        touched.select(fold(F.col("tracking_number")).alias("__t")).distinct(), "__t", "left_semi").drop("__t")
    wanted = written(ours.select("shipment_id").where("shipment_id is not null").distinct(), "touched-shipments")
    shipment_parts = store.layouts["shipments"].parts(wanted)
    shipments = store.stage("shipments", gold.enrich_shipments(store.read_parts("shipments", shipment_parts), ours, attributes, touched))
    known = stored_ledger(store, files)
    ledger = gold.cost_ledger(charges, attributes, methods, charge_types, categories, ours, shipments, orders, known)
    append = {"ledger": ledger}
    if markups is not None and default_markups is not None:
        stored = store.read("markups") if store.has("markups") else markups
        new = gold.missing_markups(methods, stored, default_markups)
        append["markups"] = new if store.has("markups") else markups.select(*new.columns).unionByName(new)
    store.publish(append=append, update={"packages": (packages, package_parts), "shipments": (shipments, shipment_parts)}, after=version)


def backfill_waiting(store: Store, methods: DataFrame, packages: DataFrame, shipments: DataFrame, orders: DataFrame) -> None:
    """Ledger rows that waited for their package get it; run after each delivery of warehouse data.

    Only the waiting rows are read and rewritten, with the attributes of their shipments.
    """
    version = store.version()
    parts = store.layouts["ledger"].parts(store.read_where("ledger", "waiting = true"))
    if not parts:
        return
    waiting = store.read_parts("ledger", parts)
    attributes = gold.of_files(store.read_beside("attributes", waiting), waiting.select(*SHIPMENT_KEY).distinct())
    matched = gold.match_waiting(waiting, attributes, methods, packages, shipments, orders)
    store.publish(update={"ledger": (matched, parts)}, after=version)
