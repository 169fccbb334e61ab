"""The query registry: each entry runs a job over one folder of tables and names its check query."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import (
    blank_to_null, decimal_of, fold, parse_date, parse_long_date, parse_rfc3339, parse_us_dashed, to_inches,
    to_ounces, try_iso_or_us,
)
from ..operators.intervals import as_of_join, gaps, overlaps, range_lookup, version_on, version_periods
from ..operators.merge import duplicate_keys
from ..plans import adapter, gold, intake, legacy, multipiece, quality, thresholds, variance
from ..plans.carriers import EASYPOST, FEDEX, PASSPORT, PLANS, UNIUNI, UPS, split_dimensions
from ..plans.load_gold import backfill_waiting, layouts, load_to_gold, stored_charges, stored_ledger, unified
from ..plans.normalise import (
    incomplete_files, invoice_rollup, lines_with_invoice, normalise, skip_loaded_files, typed_lines,
)
from ..plans.reference import discover_carriers, discover_charge_types, discover_methods
from ..plans.unify import (
    CHARGE_KEY, SHIPMENT_KEY, _consolidate, charge_rows, new_charges, shipment_attributes, shipment_charges,
    shipment_summary, upsert_attributes,
)
from ..session import configure, fresh_dir, written
from ..sources.contracts import EASYPOST as EASYPOST_CONTRACT
from ..sources.store import Store
from . import oracle as o
from .fixtures import relation

Job = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    job: Job
    sql: str | None


QUERIES: dict[str, Query] = {}


def add(name: str, job: Job, sql: str | None) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return job(configure(spark, billing=True), folder)

    QUERIES[name] = Query(run, sql)


def query(name: str, sql: str | None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        add(name, job, sql)
        return job

    return register


def staged(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return relation(spark, folder, f"stg_{key}")


def lines(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return typed_lines(PLANS[key], staged(spark, folder, key))


def rel(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [relation(spark, folder, n) for n in names]


def reference(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    methods, carriers = rel(spark, folder, "methods", "carriers")
    return {"methods": methods, "carriers": carriers}


def attributes_of(spark: SparkSession, folder: str, key: str) -> DataFrame:
    plan = PLANS[key]
    extra = reference(spark, folder) if plan.integrated else {}
    return shipment_attributes(plan, lines(spark, folder, key), **extra)


def charges_of(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return shipment_charges(PLANS[key], lines(spark, folder, key), relation(spark, folder, "charge_types"))


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


# --- the flagship: billed cost per shipment ---------------------------------------------------------


@query("shipment_summary", o.unified("easypost") + ", " + o.SUMMARY + "SELECT * FROM summary")
def summary(spark: SparkSession, folder: str) -> DataFrame:
    return shipment_summary(attributes_of(spark, folder, "easypost"), charges_of(spark, folder, "easypost"))


# --- per carrier ---------------------------------------------------------------------------------------


def _register_carrier(key: str) -> None:
    plan = PLANS[key]
    from_lines = "WITH " + o.ctes(f"stg_{key}") + ", " + o.lines(key) + " "
    add(
        f"invoice_rollup_{key}",
        lambda spark, folder: invoice_rollup(plan, staged(spark, folder, key)),
        "WITH " + o.ctes(f"stg_{key}") + ", " + o.bills(key) + f" SELECT {o.BILL} FROM bills_{key}",
    )
    add(f"normalise_{key}", lambda spark, folder: lines(spark, folder, key), from_lines + f"SELECT * FROM lines_{key}")
    if key != "ups":
        add(
            f"unpivot_{key}",
            lambda spark, folder: charge_rows(plan, lines(spark, folder, key)),
            from_lines + ", " + o.tall(key) + f" SELECT * FROM tall_{key}",
        )
    chain = o.unified(key)
    add(f"unify_attributes_{key}", lambda spark, folder: attributes_of(spark, folder, key), chain + f"SELECT {o.ATTR} FROM attr_{key}")
    add(
        f"unify_charges_{key}",
        lambda spark, folder: charges_of(spark, folder, key),
        o.unified(key, with_attributes=False) + f"SELECT * FROM chg_{key}",
    )

    def sync(spark: SparkSession, folder: str) -> DataFrame:
        typed = lines(spark, folder, key)
        refs = reference(spark, folder)
        methods = discover_methods(plan, typed, refs["methods"], refs["carriers"])
        types = discover_charge_types(plan, typed, relation(spark, folder, "charge_types").where("charge_type_id % 2 = 0"))
        none = F.lit(None)
        found = methods.select(
            F.lit("method").alias("kind"), "carrier_id", F.col("method_name").alias("name"), "service_level",
            none.cast("boolean").alias("freight"), none.cast("int").alias("charge_category_id"), "integrated_carrier_id",
        ).unionByName(types.select(
            F.lit("charge").alias("kind"), "carrier_id", F.col("charge_name").alias("name"), none.cast("string").alias("service_level"),
            "freight", "charge_category_id", none.cast("int").alias("integrated_carrier_id"),
        ))
        if plan.integrated:
            found = found.unionByName(discover_carriers(typed, refs["carriers"]).select(
                F.lit("carrier").alias("kind"), none.cast("int").alias("carrier_id"), F.col("carrier_name").alias("name"),
                none.cast("string").alias("service_level"), none.cast("boolean").alias("freight"),
                none.cast("int").alias("charge_category_id"), none.cast("int").alias("integrated_carrier_id"),
            ))
        return found

    add(f"sync_reference_{key}", sync, _sync_sql(key))


_METHOD_SQL = {
    "fedex": "service_type", "dhl": "shipping_method", "easypost": "service", "eliteworks": "service_method",
    "flavorcloud": "service_level", "passport": "service_level", "uniuni": "service_type",
    "ups": "CASE WHEN charge_category_code = 'SHP' AND charge_classification_code = 'FRT' THEN charge_description END",
}


def _sync_sql(key: str) -> str:
    plan, carrier = PLANS[key], o.IDS[key]
    own = plan.integrated
    join = "LEFT JOIN carriers ca ON lower(ca.carrier_name) = lower(l.integrated_carrier)" if own else ""
    inner = "ca.carrier_id" if own else "CAST(NULL AS INT)"
    method = _METHOD_SQL[key]
    names = {
        "fedex": "SELECT trim(charge_name) AS n, false AS f, CASE WHEN lower(charge_name) LIKE '%adjustment%' THEN 16 ELSE 11 END AS c FROM tall_fedex",
        "ups": "SELECT CASE WHEN charge_category_code = 'SHP' THEN charge_description ELSE charge_description || ' - ' || charge_category_code END, "
               "charge_category_code = 'SHP', CASE WHEN charge_category_code = 'ADJ' THEN 16 ELSE 11 END FROM lines_ups",
    }
    seeds = ", ".join(f"('{n}', {'true' if f else 'false'}, {c})" for n, f, c in plan.seeds)
    seeded = f"SELECT * FROM (VALUES {seeds}) AS sd(n, f, c)" if seeds else ""
    if key == "passport":
        fees = " UNION ALL ".join(
            f"SELECT fee_{k}_description, false, 11 FROM lines_passport WHERE trim(fee_{k}_description) <> '' AND fee_{k}_amount <> 0" for k in range(1, 9)
        )
        seeded += " UNION ALL " + fees
    types = names.get(key, seeded)
    sql = (
        f"WITH {o.ctes(f'stg_{key}', 'methods', 'carriers', 'charge_types')}, {o.lines(key)}, {o.tall(key)}, "
        f"found_methods AS (SELECT min(rtrim(m)) AS m, i FROM (SELECT {method} AS m, {inner} AS i FROM lines_{key} l {join}) q "
        f"WHERE trim(m) <> '' GROUP BY lower(rtrim(m)), i), "
        f"found_types(n, f, c) AS ({types}), "
        "picked AS (SELECT n, f, c, row_number() OVER (PARTITION BY lower(rtrim(n)) ORDER BY n, f, c) AS rn FROM found_types WHERE trim(n) <> '') "
        f"SELECT 'method' AS kind, CAST({carrier} AS INT) AS carrier_id, m AS name, 'Standard' AS service_level, CAST(NULL AS BOOLEAN) AS freight, "
        f"CAST(NULL AS INT) AS charge_category_id, CAST(i AS INT) AS integrated_carrier_id FROM found_methods f WHERE NOT EXISTS (SELECT 1 FROM methods sm "
        f"WHERE sm.carrier_id = {carrier} AND lower(rtrim(sm.method_name)) = lower(f.m) AND sm.integrated_carrier_id IS NOT DISTINCT FROM f.i) "
        f"UNION ALL SELECT 'charge', {carrier}, n, NULL, f, c, NULL FROM picked p WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM charge_types ct "
        f"WHERE ct.charge_type_id % 2 = 0 AND ct.carrier_id = {carrier} AND lower(rtrim(ct.charge_name)) = lower(rtrim(p.n)))"
    )
    if own:
        sql += (
            f" UNION ALL SELECT 'carrier', NULL, min(rtrim(integrated_carrier)), NULL, NULL, NULL, NULL FROM lines_{key} l "
            "WHERE trim(integrated_carrier) <> '' AND NOT EXISTS (SELECT 1 FROM carriers ca WHERE lower(ca.carrier_name) = lower(rtrim(l.integrated_carrier))) "
            "GROUP BY lower(rtrim(integrated_carrier))"
        )
    return sql


for _key in PLANS:
    _register_carrier(_key)


# --- cleaning, dates, units ------------------------------------------------------------------------------


@query("clean_blank_money", o.simple(["stg_fedex"], f"""
SELECT NULLIF(trim(invoice_number), '') AS invoice_number, NULLIF(trim(charge_description_1), '') AS description,
  {o.m('charge_amount_1')} AS amount, {o.m('net_charge_amount')} AS net, {o.d('dim_height')} AS height FROM stg_fedex"""))
def _(spark, folder):
    return staged(spark, folder, "fedex").select(
        blank_to_null(F.col("invoice_number")).alias("invoice_number"),
        blank_to_null(F.col("charge_description_1")).alias("description"),
        decimal_of(F.col("charge_amount_1"), commas=True).alias("amount"),
        decimal_of(F.col("net_charge_amount"), commas=True).alias("net"),
        decimal_of(F.col("dim_height")).alias("height"),
    )


@query("clean_default_zero", o.simple(["stg_easypost"], f"""
SELECT {o.cols(o.z, ['label_fee', 'insurance_fee', 'carbon_offset_fee', 'height'])} FROM stg_easypost"""))
def _(spark, folder):
    names = ["label_fee", "insurance_fee", "carbon_offset_fee", "height"]
    return staged(spark, folder, "easypost").select(*[decimal_of(F.col(n), blank="0").alias(n) for n in names])


@query("clean_try_cast", o.simple(["stg_ups"], """
SELECT TRY_CAST(NULLIF(trim(billed_weight), '') AS DECIMAL(18,2)) AS weight, TRY_CAST(NULLIF(trim(package_dimensions), '') AS DECIMAL(18,2)) AS dims,
  TRY_CAST(NULLIF(trim(zone), '') AS DECIMAL(18,2)) AS zone FROM stg_ups"""))
def _(spark, folder):
    return staged(spark, folder, "ups").select(
        decimal_of(F.col("billed_weight"), lenient=True).alias("weight"),
        decimal_of(F.col("package_dimensions"), lenient=True).alias("dims"),
        decimal_of(F.col("zone"), lenient=True).alias("zone"),
    )


@query("parse_dates_multi", o.simple(["date_texts"], """
SELECT ok, CAST(CASE ok % 6 WHEN 0 THEN strptime(any_date, '%Y%m%d') WHEN 1 THEN strptime(trim(any_date), '%Y-%m-%d')
    WHEN 2 THEN strptime(left(any_date, 10), '%Y-%m-%d') WHEN 3 THEN strptime(any_date, '%-m/%-d/%Y') END AS DATE) AS any_date,
  CAST(strptime(long_date, '%b %d, %Y') AS DATE) AS long_date, CAST(strptime(dashed_date, '%m-%d-%Y') AS DATE) AS dashed_date,
  CAST(replace(replace(rfc_date, 'T', ' '), 'Z', '') AS TIMESTAMP) AS rfc_time,
  CASE ok % 4 WHEN 0 THEN CAST(replace(replace(two_forms, 'T', ' '), 'Z', '') AS TIMESTAMP) WHEN 1 THEN strptime(two_forms, '%-m/%-d/%y') END AS two_forms,
  ok % 4 = 3 AS two_forms_bad FROM date_texts"""))
def _(spark, folder):
    two = try_iso_or_us(F.col("two_forms"))
    return relation(spark, folder, "date_texts").select(
        "ok",
        parse_date(F.col("any_date")).alias("any_date"),
        parse_long_date(F.col("long_date")).alias("long_date"),
        parse_us_dashed(F.col("dashed_date")).alias("dashed_date"),
        parse_rfc3339(F.col("rfc_date")).alias("rfc_time"),
        two.alias("two_forms"),
        (blank_to_null(F.col("two_forms")).isNotNull() & two.isNull()).alias("two_forms_bad"),
    )


@query("ups_dims_split", o.simple(["dim_texts"], """
SELECT pk, """ + ", ".join(
    f"NULLIF(TRY_CAST(CASE WHEN len(string_split(dims, 'x')) = 3 THEN trim(string_split(dims, 'x')[{i}]) END AS DECIMAL(18,2)), 0) AS {n}"
    for i, n in ((1, "length"), (2, "width"), (3, "height"))) + " FROM dim_texts"))
def _(spark, folder):
    length, width, height = split_dimensions(F.col("dims"))
    return relation(spark, folder, "dim_texts").select("pk", length.alias("length"), width.alias("width"), height.alias("height"))


@query("dhl_tracking", "WITH " + o.ctes("stg_dhl") + ", " + o.lines("dhl") + f" SELECT bill_number, domestic_tracking_number, {o.DHL_TRACKING} AS tracking_number FROM lines_dhl")
def _(spark, folder):
    return lines(spark, folder, "dhl").select("bill_number", "domestic_tracking_number", PLANS["dhl"].attributes.tracking().alias("tracking_number"))


_UNITS = {
    # carrier -> weight (value, unit, sql), dimension (values, unit, sql)
    "fedex": (("rated_weight_amount", "rated_weight_units", o.fedex_weight), (["dim_length", "dim_width", "dim_height"], "dim_unit", o.fedex_dim)),
    "ups": (("billed_weight", "billed_weight_unit", o.ups_weight), (["dim_length", "dim_width", "dim_height"], "dim_unit", o.ups_dim)),
    "dhl": (("billed_weight", "billed_weight_unit", o.dhl_weight), None),
    "flavorcloud": (("total_weight", "weight_unit", o.flavor_weight), (["length", "width", "height"], "dimension_unit", o.flavor_dim)),
    "uniuni": (("dim_weight", "dim_weight_uom", o.uni_weight), (["dim_length", "dim_width", "dim_height"], "package_dim_uom", o.uni_dim)),
}


def _register_units(key: str) -> None:
    (value, unit, weight_sql), dims = _UNITS[key]
    head = "WITH " + o.ctes(f"stg_{key}") + ", " + o.lines(key) + " "
    add(
        f"weight_to_oz_{key}",
        lambda spark, folder: lines(spark, folder, key).select(value, unit, to_ounces(F.col(value), F.col(unit), key).alias("ounces")),
        head + f"SELECT {value}, {unit}, {weight_sql(value, unit)} AS ounces FROM lines_{key}",
    )
    if dims:
        names, dim_unit, dim_sql = dims
        add(
            f"dims_to_in_{key}",
            lambda spark, folder: lines(spark, folder, key).select(
                dim_unit, *[c for n in names for c in (F.col(n), to_inches(F.col(n), F.col(dim_unit), key).alias(f"{n}_in"))]
            ),
            head + f"SELECT {dim_unit}, " + ", ".join(f"{n}, {dim_sql(n, dim_unit)} AS {n}_in" for n in names) + f" FROM lines_{key}",
        )


for _key in _UNITS:
    _register_units(_key)


@query("invoice_synthetic_ids", "WITH " + o.ctes("stg_easypost", "stg_eliteworks") + ", " + o.lines("easypost") + ", " + o.lines("eliteworks") + """
SELECT carrier_id, bill_number, bill_date, count(*) AS n FROM (SELECT carrier_id, bill_number, bill_date FROM lines_easypost
  UNION ALL SELECT carrier_id, bill_number, bill_date FROM lines_eliteworks) q GROUP BY 1, 2, 3""")
def _(spark, folder):
    both = [lines(spark, folder, k).select("carrier_id", "bill_number", "bill_date") for k in ("easypost", "eliteworks")]
    return both[0].unionByName(both[1]).groupBy("carrier_id", "bill_number", "bill_date").agg(F.count(F.lit(1)).alias("n"))


@query("lines_with_invoice", "WITH " + o.ctes("stg_passport") + ", " + o.lines("passport") + ", " + o.bills("passport") + """
SELECT l.bill_number, l.bill_date, l.file_id, l.tracking_number, l.total, b.total_amount, b.num_shipments FROM lines_passport l
JOIN bills_passport b USING (bill_number, bill_date, file_id)""")
def _(spark, folder):
    bills, typed = normalise(PASSPORT, staged(spark, folder, "passport"))
    return lines_with_invoice(typed, bills, ["total_amount", "num_shipments"]).select(
        "bill_number", "bill_date", "file_id", "tracking_number", "total", "total_amount", "num_shipments"
    )


# --- FedEx groups, UPS consolidation ---------------------------------------------------------------------

_FX = "WITH " + o.ctes("stg_fedex") + ", " + o.lines("fedex") + ", " + o.FEDEX_ROLES
_FX_ID = "file_id, express_or_ground_tracking_id, msp_tracking_id"


@query("fedex_mps_roles", _FX + f" SELECT {_FX_ID}, group_rows, mps_role FROM fx_roles")
def _(spark, folder):
    return multipiece.with_roles(lines(spark, folder, "fedex")).select(*_FX_ID.split(", "), "group_rows", "mps_role")


@query("fedex_mps_hoist", _FX + f" SELECT {_FX_ID}, mps_role, group_net_charge_amount, group_shipment_date, group_service_type, group_zone_code FROM fx_hoisted")
def _(spark, folder):
    hoisted = [f"group_{n}" for n in multipiece.HOISTED]
    return multipiece.with_roles(lines(spark, folder, "fedex")).select(*_FX_ID.split(", "), "mps_role", *hoisted)


_UPS = "WITH " + o.ctes("stg_ups", "charge_types") + ", " + o.lines("ups") + ", " + o.attributes("ups")


@query("ups_consolidate", _UPS + " SELECT * EXCLUDE (nth) FROM ups_files")
def _(spark, folder):
    return _consolidate(UPS, lines(spark, folder, "ups")).drop("__arrival", "__key")


@query("ups_charges", _UPS + ", " + o.tall("ups") + """ SELECT file_id, bill_number, tracking_number, charge_name, amount FROM tall_ups""")
def _(spark, folder):
    return charge_rows(UPS, lines(spark, folder, "ups")).select("file_id", "bill_number", "tracking_number", "charge_name", "amount")


_MEASURES = ("destination_zone", "billed_weight_oz", "billed_length_in", "billed_width_in", "billed_height_in")
_UPS_OLD = f"""old AS (SELECT carrier_id, tracking_number, CAST(TIMESTAMP '2020-01-01 00:00:00' AS TIMESTAMP) AS shipment_date, 'old' AS shipping_method,
  'Z' AS destination_zone, CAST(1.5 AS DECIMAL(18,2)) AS billed_weight_oz, CAST(2.5 AS DECIMAL(18,2)) AS billed_length_in,
  CAST(3.5 AS DECIMAL(18,2)) AS billed_width_in, CAST(NULL AS DECIMAL(18,2)) AS billed_height_in, CAST(NULL AS INT) AS integrated_carrier_id
  FROM attr_ups WHERE billed_weight_oz > 100 OR billed_length_in IS NULL)"""


@query("ups_upsert", _UPS + ", " + _UPS_OLD + f""" SELECT COALESCE(t.carrier_id, s.carrier_id) AS carrier_id, COALESCE(t.tracking_number, s.tracking_number) AS tracking_number,
  CASE WHEN t.tracking_number IS NULL THEN s.shipment_date ELSE t.shipment_date END AS shipment_date,
  CASE WHEN t.tracking_number IS NULL THEN s.shipping_method ELSE t.shipping_method END AS shipping_method,
  {', '.join(f'COALESCE(s.{c}, t.{c}) AS {c}' for c in _MEASURES)}, CAST(NULL AS INT) AS integrated_carrier_id
  FROM attr_ups s FULL JOIN old t ON t.tracking_number = s.tracking_number""")
def _(spark, folder):
    found = attributes_of(spark, folder, "ups")
    money = "decimal(18,2)"
    existing = found.where("billed_weight_oz > 100 OR billed_length_in IS NULL").select(
        *SHIPMENT_KEY,
        F.lit("2020-01-01").cast("timestamp_ntz").alias("shipment_date"),
        F.lit("old").alias("shipping_method"),
        F.lit("Z").alias("destination_zone"),
        *[F.lit(v).cast(money).alias(n) for n, v in zip(_MEASURES[1:], ("1.5", "2.5", "3.5", None))],
        F.lit(None).cast("int").alias("integrated_carrier_id"),
    )
    store = Store(spark, fresh_dir(spark, "store"), layouts())
    store.publish(append={"attributes": existing})
    found = written(found, "attributes")
    parts = store.layouts["attributes"].parts(found)
    store.publish(update={"attributes": (upsert_attributes(UPS, store.read_parts("attributes", parts), found), parts)})
    return store.read("attributes")


# --- duplicates, idempotent loads, corrections --------------------------------------------------------------

_TYPED_TALL = ("typed AS (SELECT t.carrier_id, t.file_id, t.bill_number, t.bill_date, t.tracking_number, ct.charge_type_id, t.amount FROM tall_easypost t "
               "JOIN charge_types ct ON ct.carrier_id = t.carrier_id AND lower(ct.charge_name) = lower(t.charge_name))")


def _typed_charges(spark: SparkSession, folder: str) -> DataFrame:
    types = relation(spark, folder, "charge_types").where("carrier_id = 4").select("charge_name", "charge_type_id")
    return charge_rows(EASYPOST, lines(spark, folder, "easypost")).join(F.broadcast(types), "charge_name")


@query("charges_dedupe_sum", o.unified("easypost") + f"SELECT {o.CHARGE_KEY}, amount FROM chg_easypost")
def _(spark, folder):
    return charges_of(spark, folder, "easypost").select(*CHARGE_KEY, "amount")


@query("charges_duplicate_check", o.unified("easypost") + ", " + _TYPED_TALL + f" SELECT {o.CHARGE_KEY}, count(*) AS n_rows FROM typed GROUP BY ALL HAVING count(*) > 1")
def _(spark, folder):
    return duplicate_keys(_typed_charges(spark, folder), CHARGE_KEY)


@query("idempotent_append", o.unified("easypost") + ", " + "loaded AS (SELECT DISTINCT file_id FROM li WHERE ok % 8 < 3)" + f" SELECT {o.CHARGE_KEY}, amount FROM chg_easypost WHERE file_id NOT IN (SELECT file_id FROM loaded)")
def _(spark, folder):
    # the history lies in buckets of its files; those that the new charges do not touch are not read
    store = Store(spark, fresh_dir(spark, "store"), layouts())
    charges = written(charges_of(spark, folder, "easypost"), "charges")
    store.publish(append={"charges": charges.join(relation(spark, folder, "loaded_files"), "file_id", "left_semi")})
    return new_charges(charges, store.read_beside("charges", charges.select("file_id"))).select(*CHARGE_KEY, "amount")


@query("ups_corrections_arrival_order", "WITH " + o.ctes("stg_ups") + ", " + o.lines("ups") + """, turned AS (SELECT *, 9 - file_id AS came FROM lines_ups), """
       + o.attributes("ups").replace("FROM lines_ups", "FROM (SELECT * REPLACE (came AS file_id) FROM turned) lines_ups") + " SELECT * EXCLUDE (integrated_carrier_id) FROM attr_ups")
def _(spark, folder):
    # files that came in the opposite order of their ids
    typed = lines(spark, folder, "ups").withColumn("arrival", 9 - F.col("file_id"))
    return shipment_attributes(UPS, typed).drop("integrated_carrier_id")


@query("ledger_append_again", o.gold("SELECT * FROM ledger"))
def _(spark, folder):
    # two loads that overlap: the second one adds only what the first one lacks
    w = warehouse(spark, folder)
    enriched = written(w.enriched(), "packages")
    w.store.publish(append={"ledger": w.ledger(enriched).where(F.xxhash64("tracking_number") % 3 == 0)})
    w.store.publish(append={"ledger": w.ledger(enriched, existing=stored_ledger(w.store, w.charges))})
    return w.store.read("ledger")


@query("range_lookup_many", "WITH " + o.ctes("li") + """, r AS (SELECT DISTINCT ok * 3 AS lo, ok * 3 + 2 AS hi FROM li)
SELECT l.ok AS order_key, l.ln AS line, CAST(r.lo AS DECIMAL(12,2)) AS range_start FROM li l LEFT JOIN r ON l.pk >= r.lo AND l.pk < r.hi""")
def _(spark, folder):
    # as many ranges as there are orders
    li = relation(spark, folder, "li")
    low = (F.col("ok") * 3).cast("decimal(12,2)")
    ranges = li.select(low.alias("range_min"), (low + 2).cast("decimal(12,2)").alias("range_max"), low.alias("start")).distinct()
    facts = li.select(F.col("ok").alias("order_key"), F.col("ln").alias("line"), F.col("pk").cast("decimal(12,2)").alias("v"))
    return range_lookup(facts, "v", ranges, ["start"], "range_").drop("v")


@query("charges_mixed_case", o.unified("easypost") + """SELECT file_id, lower(rtrim(bill_number)) AS bill, lower(rtrim(tracking_number)) AS tracking, charge_type_id, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
  FROM chg_easypost GROUP BY ALL""")
def _(spark, folder):
    # every second line spells its shipment in capitals: one shipment, one charge row
    rows = staged(spark, folder, "easypost")
    # written: put in place of the name, the hash of all cells would stand in the plan as often as the shipment is named
    spelled = F.when(F.xxhash64(*rows.columns) % 2 == 0, F.upper("tracking_code")).otherwise(F.lower("tracking_code"))
    typed = typed_lines(EASYPOST, written(rows.withColumn("tracking_code", spelled), "spelled"))
    charges = shipment_charges(EASYPOST, typed, relation(spark, folder, "charge_types"))
    return charges.select("file_id", fold(F.col("bill_number")).alias("bill"), fold(F.col("tracking_number")).alias("tracking"), "charge_type_id", "amount")


@query("file_guard", "WITH " + o.ctes("stg_dhl", "loaded_files") + ", " + o.bills("dhl") + f" SELECT {o.BILL} FROM bills_dhl WHERE file_id NOT IN (SELECT file_id FROM loaded_files)")
def _(spark, folder):
    return invoice_rollup(PLANS["dhl"], skip_loaded_files(staged(spark, folder, "dhl"), relation(spark, folder, "loaded_files")))


_CORR = "WITH " + o.ctes("stg_corrections", "charge_types") + ", " + o.lines("easypost", "lines_easypost").replace("FROM stg_easypost", "FROM stg_corrections") + ", " + o.tall("easypost") + ", " + o.charges("easypost")


@query("correction_accumulates", _CORR + """ SELECT tracking_number, CAST(COALESCE(sum(amount) FILTER (WHERE file_id <= 3), 0) AS DECIMAL(18,2)) AS cost_before,
  CAST(sum(amount) AS DECIMAL(18,2)) AS cost_after, count(*) AS charge_count FROM chg_easypost GROUP BY 1""")
def _(spark, folder):
    typed = typed_lines(EASYPOST, relation(spark, folder, "stg_corrections"))
    charges = shipment_charges(EASYPOST, typed, relation(spark, folder, "charge_types"))
    first = charges.where("file_id <= 3")
    # the second delivery repeats the first one and adds later files
    total = first.unionByName(new_charges(charges, first))
    before = first.groupBy("tracking_number").agg(F.sum("amount").alias("b"))
    return (
        total.groupBy("tracking_number")
        .agg(F.sum("amount").cast("decimal(18,2)").alias("cost_after"), F.count(F.lit(1)).alias("charge_count"))
        .join(before, "tracking_number", "left")
        .select("tracking_number", F.coalesce("b", F.lit(0)).cast("decimal(18,2)").alias("cost_before"), "cost_after", "charge_count")
    )


@query("method_lookup_nullsafe", o.simple(["method_uses", "methods"], """
SELECT u.*, sm.shipping_method_id FROM method_uses u LEFT JOIN (SELECT carrier_id, lower(rtrim(method_name)) AS k, integrated_carrier_id, min(shipping_method_id) AS shipping_method_id
  FROM methods GROUP BY 1, 2, 3) sm ON sm.carrier_id = u.carrier_id AND sm.k = lower(rtrim(u.shipping_method)) AND sm.integrated_carrier_id IS NOT DISTINCT FROM u.integrated_carrier_id"""))
def _(spark, folder):
    uses, methods = rel(spark, folder, "method_uses", "methods")
    return gold.with_method_id(uses, methods).select(*uses.columns, "shipping_method_id")


# --- warehouse and ledger -------------------------------------------------------------------------------------


@dataclass
class Warehouse:
    attributes: DataFrame
    charges: DataFrame
    methods: DataFrame
    types: DataFrame
    categories: DataFrame
    packages: DataFrame
    shipments: DataFrame
    orders: DataFrame
    store: Store

    @property
    def in_files(self) -> DataFrame:
        return gold.file_shipments(self.charges)

    def enriched(self) -> DataFrame:
        billed = gold.of_files(self.attributes, self.in_files)
        return gold.enrich_packages(self.packages, shipment_summary(billed, self.charges), self.methods)

    def ledger(self, packages: DataFrame, existing: DataFrame | None = None) -> DataFrame:
        return gold.cost_ledger(
            self.charges, self.attributes, self.methods, self.types, self.categories, packages, self.shipments, self.orders, existing
        )


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The gold jobs read the unified tables from the store that the carrier load published them to."""
    store = Store(spark, fresh_dir(spark, "store"), layouts())
    typed = store.stage("lines", lines(spark, folder, "easypost"))
    append, _ = unified(store, EASYPOST, typed, relation(spark, folder, "charge_types"), **reference(spark, folder))
    store.publish(append=append | {"lines": typed})
    return Warehouse(
        store.read("attributes"),
        store.read("charges"),
        *rel(spark, folder, "methods", "charge_types", "categories", "packages", "shipments", "wms_orders"),
        store,
    )


@query("file_shipments", o.unified("easypost") + "SELECT DISTINCT carrier_id, tracking_number FROM chg_easypost WHERE file_id IN (SELECT file_id FROM li WHERE ok % 8 < 3)")
def _(spark, folder):
    store = Store(spark, fresh_dir(spark, "store"), layouts())
    store.publish(append={"charges": charges_of(spark, folder, "easypost")})
    return gold.file_shipments(stored_charges(store, relation(spark, folder, "loaded_files").select("file_id")))


@query("load_to_gold", o.gold("SELECT * FROM ledger"))
def _(spark, folder):
    # three loads, one after the other, each followed by its warehouse work and ledger; the first is run twice
    names = ("methods", "charge_types", "categories", "carriers", "wms_orders")
    methods, types, categories, carriers, orders = (written(t, n) for t, n in zip(rel(spark, folder, *names), names))
    store = Store(spark, fresh_dir(spark, "store"), layouts())
    packages, shipments = rel(spark, folder, "packages", "shipments")
    store.publish(append={"packages": packages, "shipments": shipments})
    typed = written(lines(spark, folder, "easypost"), "typed")
    for low, high in ((0, 2), (3, 5), (6, 99)):
        new = store.stage("lines", typed.where(F.col("file_id").between(low, high)))
        append, update = unified(store, EASYPOST, new, types, methods=methods, carriers=carriers)
        store.publish(append=append | {"lines": new}, update=update)
        files = written(new.select("file_id").distinct(), "files")
        for _ in range(2 if low == 0 else 1):
            load_to_gold(store, files, methods=methods, charge_types=types, categories=categories, orders=orders)
    return store.read("ledger")


@query("gold_enrich_shipment", o.gold("""
SELECT s.shipment_id, s.order_id, s.external_id, CASE WHEN b.tracking_number IS NULL THEN s.destination_zone ELSE b.destination_zone END AS destination_zone,
  COALESCE(b.carrier_id, s.carrier_id) AS carrier_id
FROM shipments s LEFT JOIN packages p ON p.shipment_id = s.shipment_id LEFT JOIN billed b ON lower(b.tracking_number) = lower(p.tracking_number)"""))
def _(spark, folder):
    w = warehouse(spark, folder)
    return gold.enrich_shipments(w.shipments, w.packages, w.attributes, w.in_files)


@query("gold_enrich_package", o.gold("SELECT * FROM enriched"))
def _(spark, folder):
    return warehouse(spark, folder).enriched()


@query("cost_ledger", o.gold("SELECT * FROM ledger"))
def _(spark, folder):
    w = warehouse(spark, folder)
    return w.ledger(w.enriched())


@query("ledger_backfill", o.gold("SELECT * FROM ledger"))
def _(spark, folder):
    # first load: the warehouse knows half of the packages; the rest arrives later
    w = warehouse(spark, folder)
    enriched = written(w.enriched(), "packages")
    w.store.publish(append={"ledger": w.ledger(enriched.where("shipment_package_id % 2 = 0"))})
    backfill_waiting(w.store, w.methods, enriched, w.shipments, w.orders)
    return w.store.read("ledger")


@query("default_markup_sync", o.simple(["catalog_methods", "catalog_markups", "default_markups"], """
SELECT m.carrier_id, m.shipping_method_id, d.markup, 'percentage' AS markup_type, m.integrated_carrier_id FROM catalog_methods m,
 (SELECT markup FROM default_markups WHERE deleted_at IS NULL ORDER BY created_at DESC, id DESC LIMIT 1) d
WHERE m.shipping_method_id NOT IN (SELECT shipping_method_id FROM catalog_markups)"""))
def _(spark, folder):
    return gold.missing_markups(*rel(spark, folder, "catalog_methods", "catalog_markups", "default_markups"))


@query("carrier_display", o.simple(["catalog_methods", "carriers"], """
SELECT m.*, c.carrier_name || CASE WHEN i.carrier_name IS NULL THEN '' ELSE ' (' || i.carrier_name || ')' END AS carrier_label,
  c.carrier_name || CASE WHEN i.carrier_name IS NULL THEN '' ELSE ' (' || i.carrier_name || ')' END || ' ' || m.method_name AS method_label,
  COALESCE(m.integrated_carrier_id, m.carrier_id) AS invoice_carrier_id, COALESCE(i.carrier_name, c.carrier_name) AS invoice_carrier_name
FROM catalog_methods m JOIN carriers c ON c.carrier_id = m.carrier_id LEFT JOIN carriers i ON i.carrier_id = m.integrated_carrier_id"""))
def _(spark, folder):
    return gold.with_display_names(*rel(spark, folder, "catalog_methods", "carriers"))


@query("markup_price", o.simple(["priced_items", "catalog_markups"], """
SELECT p.*, k.markup, CAST(p.amount * CAST(1 + COALESCE(k.markup, 0) / 100.0 AS DECIMAL(8,4)) AS DECIMAL(18,2)) AS customer_price
FROM priced_items p LEFT JOIN catalog_markups k USING (shipping_method_id)"""))
def _(spark, folder):
    return gold.marked_up(*rel(spark, folder, "priced_items", "catalog_markups"))


# --- variance and thresholds --------------------------------------------------------------------------------------


@query("recon_variance_fixed", "WITH " + o.ctes("billed_packages") + ", " + o.fixed_variance("billed_packages") + " SELECT * FROM fixed_var WHERE is_cost_exception = 1")
def _(spark, folder):
    return variance.fixed_variance(relation(spark, folder, "billed_packages"))


_DYN = "WITH " + o.ctes("billed_packages", "thresholds") + """,
base AS (SELECT p.shipment_package_id, p.tracking_number, p.billed_weight_oz, p.actual_weight_oz, p.wms_shipping_cost, p.billed_shipping_cost,
  c.range_min AS cost_range_min, c.range_max AS cost_range_max, c.threshold_type AS cost_threshold_type, c.threshold_value AS cost_threshold_value,
  w.range_min AS weight_range_min, w.range_max AS weight_range_max, w.threshold_type AS weight_threshold_type, w.threshold_value AS weight_threshold_value, w.weight_unit
  FROM billed_packages p
  LEFT JOIN thresholds c ON c.metric_type = 'cost' AND p.billed_shipping_cost >= c.range_min AND (c.range_max IS NULL OR p.billed_shipping_cost < c.range_max)
  LEFT JOIN thresholds w ON w.metric_type = 'weight' AND p.billed_weight_oz >= w.range_min AND (w.range_max IS NULL OR p.billed_weight_oz < w.range_max)),
cost AS (SELECT *, CAST(billed_shipping_cost - wms_shipping_cost AS DECIMAL(10,2)) AS cost_variance_amount,
  CAST(CASE WHEN COALESCE(wms_shipping_cost, 0) = 0 THEN 100 ELSE round(CAST(billed_shipping_cost - wms_shipping_cost AS DOUBLE) / CAST(wms_shipping_cost AS DOUBLE) * 100, 2) END AS DECIMAL(10,2)) AS cost_variance_pct,
  CASE WHEN cost_threshold_type = 'pct' AND billed_shipping_cost * 100 > wms_shipping_cost * (100 + cost_threshold_value) THEN 'cost_high'
       WHEN cost_threshold_type = 'pct' AND billed_shipping_cost * 100 < wms_shipping_cost * (100 - cost_threshold_value) THEN 'cost_low'
       WHEN cost_threshold_type = 'abs' AND billed_shipping_cost - wms_shipping_cost > cost_threshold_value THEN 'cost_high'
       WHEN cost_threshold_type = 'abs' AND wms_shipping_cost - billed_shipping_cost > cost_threshold_value THEN 'cost_low' ELSE 'Normal' END AS cost_exception_type,
  CAST(CASE weight_unit WHEN 'lb' THEN ceil(billed_weight_oz / 16.0) WHEN 'kg' THEN CAST(billed_weight_oz / 35.274 AS DECIMAL(10,4)) ELSE billed_weight_oz END AS DECIMAL(18,4)) AS billed_weight_cmp,
  CAST(CASE weight_unit WHEN 'lb' THEN ceil(actual_weight_oz / 16.0) WHEN 'kg' THEN CAST(actual_weight_oz / 35.274 AS DECIMAL(10,4)) ELSE actual_weight_oz END AS DECIMAL(18,4)) AS actual_weight_cmp
  FROM base),
weight AS (SELECT *, CASE WHEN cost_exception_type = 'Normal' THEN 0 ELSE 1 END AS is_cost_exception,
  CAST(billed_weight_cmp - actual_weight_cmp AS DECIMAL(10,2)) AS weight_variance,
  CAST(CASE WHEN COALESCE(actual_weight_cmp, 0) = 0 THEN 100 ELSE round(CAST(billed_weight_cmp - actual_weight_cmp AS DOUBLE) / CAST(actual_weight_cmp AS DOUBLE) * 100, 2) END AS DECIMAL(10,2)) AS weight_variance_pct,
  CASE WHEN cost_exception_type = 'Normal' THEN 'Normal'
       WHEN weight_threshold_type = 'pct' AND billed_weight_cmp * 100 > actual_weight_cmp * (100 + weight_threshold_value) THEN 'weight_high'
       WHEN weight_threshold_type = 'pct' AND billed_weight_cmp * 100 < actual_weight_cmp * (100 - weight_threshold_value) THEN 'weight_low'
       WHEN weight_threshold_type = 'abs' AND billed_weight_cmp - actual_weight_cmp > weight_threshold_value THEN 'weight_high'
       WHEN weight_threshold_type = 'abs' AND actual_weight_cmp - billed_weight_cmp > weight_threshold_value THEN 'weight_low' ELSE 'Normal' END AS weight_exception_type FROM cost)
SELECT *, CASE WHEN weight_exception_type = 'Normal' THEN 0 ELSE 1 END AS is_weight_exception FROM weight WHERE is_cost_exception = 1"""


@query("recon_variance_dynamic", _DYN)
def _(spark, folder):
    return variance.dynamic_variance(*rel(spark, folder, "billed_packages", "thresholds"))


_SCOPE = ["scope"]
_OVERLAP = """over AS (SELECT scope, metric_type, range_id, range_min, range_max,
  max(COALESCE(range_max, 9999999999.99)) OVER (PARTITION BY scope, metric_type ORDER BY range_min, range_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM config_ranges)"""


@query("threshold_overlaps", "WITH " + o.ctes("config_ranges") + ", " + _OVERLAP + """ SELECT scope, metric_type, range_id, range_min, range_max,
  CAST(NULLIF(reach, 9999999999.99) AS DECIMAL(12,2)) AS reached FROM over WHERE reach > range_min""")
def _(spark, folder):
    return overlaps(relation(spark, folder, "config_ranges"), ["scope", "metric_type"], "range_id")


@query("threshold_gaps", "WITH " + o.ctes("config_ranges") + """, nxt AS (SELECT *, lead(range_min) OVER (PARTITION BY scope, metric_type ORDER BY range_min, range_id) AS n FROM config_ranges)
SELECT scope, metric_type, range_max AS gap_start, n AS gap_end FROM nxt WHERE range_max < n""")
def _(spark, folder):
    return gaps(relation(spark, folder, "config_ranges"), ["scope", "metric_type"], "range_id")


_ISSUES = _OVERLAP + """, broken AS (
  SELECT scope, range_id, 'metric_type' AS issue FROM config_ranges WHERE metric_type NOT IN ('cost', 'weight')
  UNION ALL SELECT scope, range_id, 'threshold_type' FROM config_ranges WHERE threshold_type NOT IN ('pct', 'abs')
  UNION ALL SELECT scope, range_id, 'weight_unit_required' FROM config_ranges WHERE metric_type = 'weight' AND (weight_unit IS NULL OR weight_unit NOT IN ('oz', 'lb', 'kg'))
  UNION ALL SELECT scope, range_id, 'weight_unit_on_cost' FROM config_ranges WHERE metric_type = 'cost' AND weight_unit IS NOT NULL
  UNION ALL SELECT scope, range_id, 'range_order' FROM config_ranges WHERE range_min >= range_max
  UNION ALL SELECT scope, range_id, 'threshold_value' FROM config_ranges WHERE threshold_value <= 0
  UNION ALL SELECT scope, range_id, 'range_min' FROM config_ranges WHERE range_min < 0
  UNION ALL SELECT scope, range_id, 'overlap' FROM over WHERE reach > range_min AND metric_type IN ('cost', 'weight'))"""


@query("threshold_validate", "WITH " + o.ctes("config_ranges") + ", " + _ISSUES + " SELECT * FROM broken")
def _(spark, folder):
    return thresholds.issues(_SCOPE, relation(spark, folder, "config_ranges"), "range_id")


_JSON_SQL = """, parts AS (SELECT p_partkey AS scope, p_size AS z, p_size % 9 = 0 AS clash, p_size % 5 = 0 AS zero FROM part)"""


def _json_ranges(spark: SparkSession, folder: str) -> DataFrame:
    parsed = thresholds.parse_ranges(relation(spark, folder, "json_configs"), "config_json", ["scope"])
    return parsed.withColumn("range_id", F.xxhash64("metric_type", "range_min", "threshold_type"))


@query("threshold_json", "WITH " + o.ctes("json_configs") + _JSON_SQL + """
SELECT scope, 'cost' AS metric_type, CAST(0 AS DECIMAL(12,2)) AS range_min, CAST(z + 1 AS DECIMAL(12,2)) AS range_max, 'pct' AS threshold_type, CAST(15 AS DECIMAL(10,2)) AS threshold_value, CAST(NULL AS VARCHAR) AS weight_unit FROM parts
UNION ALL SELECT scope, 'cost', z + 1 - CASE WHEN clash THEN 1 ELSE 0 END, NULL, 'abs', CAST(z % 5 AS DECIMAL(10,2)), NULL FROM parts
UNION ALL SELECT scope, 'weight', 0, 16, 'abs', CAST(2.5 AS DECIMAL(10,2)), 'oz' FROM parts""")
def _(spark, folder):
    return _json_ranges(spark, folder).drop("range_id")


@query("threshold_replace", "WITH " + o.ctes("json_configs") + _JSON_SQL + """
SELECT scope, CASE WHEN clash OR zero THEN 'ERROR' ELSE 'SUCCESS' END AS status, CAST(CASE WHEN clash OR zero THEN 0 ELSE 3 END AS BIGINT) AS ranges_configured,
  CAST(CASE WHEN clash OR zero THEN 0 ELSE 2 END AS BIGINT) AS cost_ranges, CAST(CASE WHEN clash OR zero THEN 0 ELSE 1 END AS BIGINT) AS weight_ranges,
  CAST(CASE WHEN clash THEN 1 ELSE 0 END + CASE WHEN zero THEN 1 ELSE 0 END AS BIGINT) AS n_issues FROM parts""")
def _(spark, folder):
    return thresholds.replacement(_SCOPE, _json_ranges(spark, folder), "range_id")[1]


@query("threshold_replace_stored", "WITH " + o.ctes("json_configs") + _JSON_SQL + """
SELECT scope, CAST(CASE WHEN clash OR zero THEN 1 ELSE 3 END AS BIGINT) AS ranges_stored FROM parts""")
def _(spark, folder):
    # every scope begins with one range of its own; a scope that fails a rule keeps it
    store = Store(spark, fresh_dir(spark, "store"), thresholds.threshold_layout(_SCOPE))
    ranges = written(_json_ranges(spark, folder), "ranges")
    first = ranges.where("metric_type = 'weight'").withColumns({"threshold_value": F.lit(1).cast("decimal(12,2)"), "range_min": F.lit(0).cast("decimal(12,2)")})
    thresholds.publish_replacement(store, _SCOPE, first.dropDuplicates(_SCOPE).select(*ranges.columns), "range_id")
    thresholds.publish_replacement(store, _SCOPE, ranges, "range_id")
    return store.read(thresholds.CONFIGURED).groupBy(*_SCOPE).agg(F.count("*").alias("ranges_stored"))


@query("threshold_versions", o.simple(["config_versions"], """
SELECT scope, effective_date, max(version_id) AS version_id, lead(effective_date) OVER (PARTITION BY scope ORDER BY effective_date) AS next_effective_date
FROM config_versions GROUP BY scope, effective_date"""))
def _(spark, folder):
    return version_periods(relation(spark, folder, "config_versions"), _SCOPE)


@query("threshold_asof", o.simple(["config_versions"], """
SELECT scope, version_id, effective_date FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY effective_date DESC, version_id DESC) AS rn
FROM config_versions WHERE effective_date <= DATE '1998-06-30') q WHERE rn = 1"""))
def _(spark, folder):
    return version_on(relation(spark, folder, "config_versions"), _SCOPE, F.lit("1998-06-30").cast("date"))


@query("threshold_asof_join", o.simple(["li", "config_versions"], """
SELECT f.*, v.version_id FROM (SELECT pk % 1000 AS scope, sd, ok, ln FROM li) f ASOF LEFT JOIN
  (SELECT scope, effective_date, max(version_id) AS version_id FROM config_versions GROUP BY 1, 2) v ON v.scope = f.scope AND f.sd >= v.effective_date"""))
def _(spark, folder):
    facts = relation(spark, folder, "li").selectExpr("pk % 1000 AS scope", "sd", "ok", "ln")
    return as_of_join(facts, relation(spark, folder, "config_versions"), _SCOPE, "sd")


def _versioned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Versions and their ranges; the ranges of a version are those of the order it came from."""
    versions = thresholds.activate(relation(spark, folder, "config_versions"), _SCOPE)
    ranges = relation(spark, folder, "config_ranges").withColumnRenamed("range_id", "version_id")
    return versions, ranges.select("scope", "version_id", *thresholds.RANGE_COLUMNS)


_ACTIVE = "act AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY effective_date DESC, version_id DESC) = 1 AS is_active FROM config_versions)"


@query("threshold_history", "WITH " + o.ctes("config_versions", "config_ranges") + ", " + _ACTIVE + """
SELECT a.*, count(r.range_id) AS total_ranges, count(*) FILTER (WHERE r.metric_type = 'cost') AS cost_ranges, count(*) FILTER (WHERE r.metric_type = 'weight') AS weight_ranges
FROM act a LEFT JOIN config_ranges r ON r.range_id = a.version_id GROUP BY ALL""")
def _(spark, folder):
    return thresholds.history(*_versioned(spark, folder), _SCOPE)


@query("threshold_rollback", "WITH " + o.ctes("config_versions", "config_ranges") + """
SELECT scope, version_id, effective_date, created_by, false AS is_active FROM config_versions
UNION ALL SELECT scope, 1000000000 + scope, DATE '2030-01-01', 'rollback', true FROM (SELECT DISTINCT scope FROM config_versions) q""")
def _(spark, folder):
    versions, ranges = _versioned(spark, folder)
    oldest = versions.groupBy("scope").agg(F.min("version_id").alias("version_id"))
    header = {
        "version_id": F.lit(1_000_000_000) + F.col("scope"),
        "effective_date": F.lit("2030-01-01").cast("date"),
        "created_by": F.lit("rollback"),
    }
    return thresholds.rollback(versions, ranges, _SCOPE, oldest, header)[0]


@query("threshold_migrate", "WITH " + o.ctes("config_ranges") + """
SELECT scope, scope + 1 AS version_id, metric_type, range_min, range_max, threshold_type, threshold_value, weight_unit FROM config_ranges""")
def _(spark, folder):
    header = {"version_id": F.col("scope") + 1, "created_by": F.lit("MIGRATION")}
    return thresholds.migrate_to_versions(relation(spark, folder, "config_ranges"), _SCOPE, header)[1]


# --- reconciliation and quality -----------------------------------------------------------------------------------


@query("totals_reconcile", "WITH " + o.ctes("stg_dhl", "charge_types") + ", " + o.lines("dhl") + ", " + o.bills("dhl") + ", " + o.tall("dhl") + ", " + o.charges("dhl") + """,
f AS (SELECT file_id, CAST(sum(total_amount) AS DECIMAL(18,2)) AS v FROM bills_dhl GROUP BY 1), c AS (SELECT file_id, CAST(sum(amount) AS DECIMAL(18,2)) AS v FROM chg_dhl GROUP BY 1),
s AS (SELECT file_id, CAST(sum(COALESCE(transportation_cost, 0) + COALESCE(non_qualified_dimensional_charges, 0) + COALESCE(fuel_surcharge_amount, 0) + COALESCE(delivery_area_surcharge_amount, 0)) AS DECIMAL(18,2)) AS v FROM lines_dhl GROUP BY 1)
SELECT s.file_id, s.v AS file_total, f.v AS bill_total, c.v AS charge_total, abs(s.v - f.v) < 0.01 AS file_equals_bills, abs(f.v - c.v) < 0.01 AS bills_equal_charges, abs(s.v - c.v) < 0.01 AS all_equal
FROM s JOIN f USING (file_id) JOIN c USING (file_id)""")
def _(spark, folder):
    plan, rows = PLANS["dhl"], staged(spark, folder, "dhl")
    bills, typed = normalise(plan, rows)
    return quality.totals_by_file(plan, rows, bills, shipment_charges(plan, typed, relation(spark, folder, "charge_types")))


_CT = "charge_type_id, charge_name, freight"


@query("charge_breakdown", o.unified("passport", with_attributes=False) + f"""SELECT {_CT}, charge_category_id, count(*) AS charge_count, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount,
  CAST(round(CAST(sum(amount) AS DOUBLE) / count(*), 2) AS DECIMAL(18,2)) AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount
  FROM chg_passport JOIN charge_types USING (charge_type_id, carrier_id) GROUP BY ALL""")
def _(spark, folder):
    return quality.charge_breakdown(charges_of(spark, folder, "passport"), relation(spark, folder, "charge_types"))


@query("charge_usage", o.unified("easypost", with_attributes=False) + f"""SELECT {_CT}, count(c.amount) AS usage_count, CAST(COALESCE(sum(c.amount), 0) AS DECIMAL(18,2)) AS total_amount
  FROM charge_types LEFT JOIN chg_easypost c USING (charge_type_id, carrier_id) WHERE carrier_id = 4 GROUP BY ALL""")
def _(spark, folder):
    own = relation(spark, folder, "charge_types").where("carrier_id = 4")
    return quality.charge_usage(charges_of(spark, folder, "easypost"), own)


@query("charge_type_seeding", "WITH " + o.ctes("charge_types") + """ SELECT e.carrier_id, CAST(e.expected AS BIGINT) AS expected, count(DISTINCT lower(t.charge_name)) AS actual, count(DISTINCT lower(t.charge_name)) = e.expected AS complete
  FROM (VALUES (7, 6), (4, 5), (3, 4), (8, 17), (5, 1), (6, 4)) AS e(carrier_id, expected) LEFT JOIN charge_types t ON t.carrier_id = e.carrier_id GROUP BY e.carrier_id, e.expected""")
def _(spark, folder):
    expected = spark.createDataFrame([(7, 6), (4, 5), (3, 4), (8, 17), (5, 1), (6, 4)], "carrier_id int, expected int")
    return quality.seeding_check(relation(spark, folder, "charge_types"), expected)


@query("shipment_count_check", o.unified("uniuni") + """SELECT count(DISTINCT lower(tracking_number)) AS line_shipments, (SELECT count(*) FROM attr_uniuni) AS attribute_rows,
  count(DISTINCT lower(tracking_number)) - (SELECT count(*) FROM attr_uniuni) AS difference, count(*) FILTER (WHERE tracking_number IS NULL) AS lines_without_tracking,
  count(DISTINCT lower(tracking_number)) = (SELECT count(*) FROM attr_uniuni) AS complete FROM lines_uniuni""")
def _(spark, folder):
    typed = lines(spark, folder, "uniuni")
    return quality.shipment_counts(UNIUNI, typed, shipment_attributes(UNIUNI, typed))


@query("charge_share_of_total", o.unified("easypost", with_attributes=False) + f"SELECT {o.CHARGE_KEY}, amount, CAST(sum(amount) OVER (PARTITION BY carrier_id, tracking_number) AS DECIMAL(18,2)) AS shipment_total FROM chg_easypost")
def _(spark, folder):
    return quality.charge_share(charges_of(spark, folder, "easypost"))


@query("largest_charge", o.unified("easypost", with_attributes=False) + f"""SELECT * FROM (SELECT {o.CHARGE_KEY}, amount, CAST(sum(amount) OVER (PARTITION BY carrier_id, tracking_number) AS DECIMAL(18,2)) AS shipment_total,
  charge_name FROM chg_easypost JOIN charge_types USING (charge_type_id, carrier_id)) q ORDER BY amount DESC, tracking_number, charge_name LIMIT 1""")
def _(spark, folder):
    return quality.largest_charge(charges_of(spark, folder, "easypost"), relation(spark, folder, "charge_types"))


@query("unmapped_charges", o.unified("fedex") + """SELECT charge_name, count(*) AS n_charges, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM tall_fedex t
  WHERE NOT EXISTS (SELECT 1 FROM charge_types ct WHERE ct.carrier_id = 1 AND lower(rtrim(ct.charge_name)) = lower(rtrim(t.charge_name))) GROUP BY 1""")
def _(spark, folder):
    return quality.unmapped_charges(FEDEX, lines(spark, folder, "fedex"), relation(spark, folder, "charge_types"))


@query("invoice_level_charges", "WITH " + o.ctes("stg_ups") + ", " + o.lines("ups") + ", " + o.tall("ups") + """ SELECT carrier_id, file_id, bill_number, bill_date, charge_name, count(*) AS n_charges,
  CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM tall_ups WHERE COALESCE(trim(tracking_number), '') = '' GROUP BY ALL""")
def _(spark, folder):
    return quality.invoice_level_charges(UPS, lines(spark, folder, "ups"))


_FX_TYPED = ("fx_typed AS (SELECT t.*, ct.charge_type_id FROM tall_fedex t JOIN charge_types ct ON ct.carrier_id = 1 AND lower(rtrim(ct.charge_name)) = lower(rtrim(t.charge_name))), "
             "fx_sum AS (SELECT file_id, bill_number, bill_date, tracking_number, charge_type_id, sum(amount) AS amount FROM fx_typed GROUP BY ALL)")


@query("orphans", o.unified("fedex") + ", " + _FX_TYPED + """ SELECT CAST(1 AS INT) AS carrier_id, count(*) FILTER (WHERE a.tracking_number IS NULL) AS without_shipment_charges,
  CAST(COALESCE(sum(s.amount) FILTER (WHERE a.tracking_number IS NULL), 0) AS DECIMAL(18,2)) AS without_shipment_amount,
  CAST(0 AS BIGINT) AS without_invoice_charges, CAST(0 AS DECIMAL(18,2)) AS without_invoice_amount
  FROM fx_sum s LEFT JOIN attr_fedex a ON lower(a.tracking_number) = lower(s.tracking_number)""")
def _(spark, folder):
    rows = staged(spark, folder, "fedex")
    bills, typed = normalise(FEDEX, rows)
    types = relation(spark, folder, "charge_types")
    everything = charge_rows(FEDEX, typed).withColumn("charge_key", fold(F.col("charge_name")))
    known = types.where("carrier_id = 1").select(fold(F.col("charge_name")).alias("charge_key"), "charge_type_id")
    # charges before the check against shipments: a group without a parent loses its charges there
    charges = everything.join(F.broadcast(known), "charge_key").groupBy(*CHARGE_KEY).agg(F.sum("amount").alias("amount"))
    return quality.orphan_charges(charges, shipment_attributes(FEDEX, typed), bills)


@query("component_mismatches", "WITH " + o.ctes("stg_flavorcloud") + ", " + o.lines("flavorcloud") + """ SELECT bill_number, tracking_number, CAST(shipping_charges + commissions + landed_cost + insurance AS DECIMAL(18,2)) AS component_sum,
  shipment_total_charges AS stated_total FROM lines_flavorcloud WHERE abs(shipping_charges + commissions + landed_cost + insurance - shipment_total_charges) >= 0.01""")
def _(spark, folder):
    return quality.component_mismatches(
        lines(spark, folder, "flavorcloud"), ["shipping_charges", "commissions", "landed_cost", "insurance"],
        "shipment_total_charges", ["bill_number", "tracking_number"],
    )


@query("required_blank", o.simple(["stg_uniuni"], """
SELECT file_id, invoice_number, concat_ws(',', CASE WHEN COALESCE(trim(tracking_number), '') = '' THEN 'tracking_number' END,
  CASE WHEN COALESCE(trim(total_billed_amount), '') = '' THEN 'total_billed_amount' END) AS missing FROM stg_uniuni
WHERE COALESCE(trim(tracking_number), '') = '' OR COALESCE(trim(total_billed_amount), '') = ''"""))
def _(spark, folder):
    return quality.blank_required(
        staged(spark, folder, "uniuni"), ["invoice_number", "invoice_time", "tracking_number", "total_billed_amount", "merchant_id"],
        ["file_id", "invoice_number"],
    )


@query("incomplete_files", "WITH " + o.ctes("stg_uniuni") + ", " + o.lines("uniuni") + """ SELECT file_id, count(*) AS n_lines, 'tracking_number' AS missing
  FROM lines_uniuni WHERE tracking_number IS NULL GROUP BY 1""")
def _(spark, folder):
    return incomplete_files(UNIUNI, lines(spark, folder, "uniuni"))


_HEADERS = list(EASYPOST_CONTRACT.headers.values())


@query("schema_drift", o.simple(["file_headers"], """
SELECT file_id, true AS drifted, concat_ws(',', CASE WHEN file_id % 7 = 0 THEN 'carbon_offset_fee' END, CASE WHEN file_id % 5 = 0 THEN 'insurance_fee' END) AS missing,
  CASE file_id % 5 WHEN 0 THEN 'insurance' WHEN 1 THEN 'new_fee' ELSE '' END AS unexpected FROM file_headers WHERE file_id % 7 = 0 OR file_id % 5 IN (0, 1)"""))
def _(spark, folder):
    return quality.header_drift(relation(spark, folder, "file_headers"), "header", _HEADERS, ["file_id"])


@query("freshness", o.simple(["ev"], """
SELECT user_id, max(ts) AS last_change, max(ts) >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOURS AS is_fresh FROM ev GROUP BY 1"""))
def _(spark, folder):
    return quality.freshness(relation(spark, folder, "ev"), "ts", F.lit(ts("2024-01-30T00:00:00")).cast("timestamp_ntz"), by=["user_id"])


# --- intake -----------------------------------------------------------------------------------------------------------


_ROUTE = "WITH " + o.ctes("ord", "arrivals", "tracker", "file_carriers") + """,
a AS (SELECT 'tenant ' || (ck % 3) AS tenant, 'acc' || ck AS expected_account, 'bill ' || ok || '.csv' AS file_name, ok, ck,
  CASE ok % 9 WHEN 0 THEN 'fedex' WHEN 1 THEN 'ups' WHEN 2 THEN 'dhl' WHEN 3 THEN 'usps - easy post' WHEN 4 THEN 'eliteworks' WHEN 5 THEN 'flavor cloud' WHEN 6 THEN 'passport' WHEN 7 THEN 'uniuni' ELSE 'canpar' END AS carrier,
  CASE WHEN ok % 9 IN (0, 2, 3) THEN 'acc' || ck WHEN ok % 9 IN (1, 4) THEN CASE WHEN ck % 10 = 0 THEN '' ELSE 'ACC' || ck END
       WHEN ok % 9 IN (5, 7) THEN 'acc' || (ck + CASE WHEN ok % 4 = 0 THEN 1 ELSE 0 END) END AS found_account FROM ord),
b AS (SELECT a.*, c.carrier_id, t.file_id IS NOT NULL AS known, t.completed_at,
  CASE WHEN a.carrier = 'canpar' THEN 'unsupported carrier' WHEN c.carrier_id IS NULL THEN 'carrier not registered'
       WHEN lower(found_account) IS DISTINCT FROM lower(expected_account) THEN 'account mismatch' END AS error
  FROM a LEFT JOIN file_carriers c ON lower(c.carrier_name) = a.carrier LEFT JOIN tracker t ON t.carrier_id = c.carrier_id AND lower(t.file_name) = a.file_name)
"""


@query("file_route", _ROUTE + """SELECT tenant, carrier, carrier_id, file_name, expected_account, found_account, error,
  CASE WHEN error IS NULL THEN CASE WHEN completed_at IS NOT NULL THEN 'Skip' ELSE carrier END END AS route, error IS NULL AND NOT known AS is_new FROM b""")
def _(spark, folder):
    return intake.route_files(*rel(spark, folder, "arrivals", "file_carriers", "tracker"))


@query("file_register", _ROUTE + """SELECT file_name, carrier_id, created_at, completed_at FROM tracker
UNION ALL SELECT file_name, carrier_id, TIMESTAMP '2026-01-01 00:00:00', NULL FROM b WHERE error IS NULL AND NOT known""")
def _(spark, folder):
    arrivals, carriers, tracker = rel(spark, folder, "arrivals", "file_carriers", "tracker")
    now = F.lit(ts("2026-01-01T00:00:00")).cast("timestamp_ntz")
    tracker = tracker.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "completed_at")})
    return intake.register_files(intake.route_files(arrivals, carriers, tracker), tracker, now).drop("file_id")


@query("validate_account", _ROUTE + "SELECT file_name, carrier, expected_account, found_account FROM b WHERE error = 'account mismatch'")
def _(spark, folder):
    routed = intake.route_files(*rel(spark, folder, "arrivals", "file_carriers", "tracker"))
    return routed.where("error = 'account mismatch'").select("file_name", "carrier", "expected_account", "found_account")


@query("file_complete", o.simple(["tracker", "ord"], """
SELECT file_id, file_name, carrier_id, created_at, CASE WHEN file_id IN (SELECT ok FROM ord WHERE os = 'P') THEN TIMESTAMP '2026-01-01 00:00:00' ELSE completed_at END AS completed_at FROM tracker"""))
def _(spark, folder):
    tracker, orders = rel(spark, folder, "tracker", "ord")
    tracker = tracker.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "completed_at")})
    done = orders.where("os = 'P'").selectExpr("ok AS file_id")
    return intake.complete_files(tracker, done, F.lit(ts("2026-01-01T00:00:00")).cast("timestamp_ntz"))


# --- older jobs ------------------------------------------------------------------------------------------------------------

_OLD = "WITH " + o.ctes("legacy_dhl", "packages", "shipments", "methods", "charge_types", "run_tracker")
_SINCE = "recent AS (SELECT * FROM legacy_dhl WHERE created_date > (SELECT last_run_time FROM run_tracker WHERE procedure_name = 'job 3'))"


def _recent(spark: SparkSession, folder: str) -> DataFrame:
    return legacy.since_last_run(relation(spark, folder, "legacy_dhl"), "created_date", relation(spark, folder, "run_tracker"), "job 3")


@query("legacy_incremental_scan", _OLD + ", " + _SINCE + " SELECT invoice_number, domestic_tracking_number, created_date FROM recent")
def _(spark, folder):
    return _recent(spark, folder).select("invoice_number", "domestic_tracking_number", "created_date")


@query("legacy_run_tracker", o.simple(["run_tracker"], """
SELECT procedure_name, CASE WHEN procedure_name = 'job 3' THEN TIMESTAMP '2026-01-01 00:00:00' ELSE last_run_time END AS last_run_time FROM run_tracker"""))
def _(spark, folder):
    tracker = relation(spark, folder, "run_tracker").withColumn("last_run_time", F.col("last_run_time").cast("timestamp_ntz"))
    return legacy.record_run(tracker, "job 3", F.lit(ts("2026-01-01T00:00:00")).cast("timestamp_ntz"))


@query("legacy_dhl_shipments", _OLD + ", " + _SINCE + """, z AS (SELECT p.shipment_id, max(zone) AS zone FROM recent r JOIN packages p ON p.tracking_number = r.domestic_tracking_number GROUP BY 1)
SELECT s.shipment_id, s.order_id, s.external_id, COALESCE(z.zone, s.destination_zone) AS destination_zone, CASE WHEN z.zone IS NULL THEN s.carrier_id ELSE 3 END AS carrier_id
FROM shipments s LEFT JOIN z USING (shipment_id)""")
def _(spark, folder):
    shipments, packages = rel(spark, folder, "shipments", "packages")
    return legacy.update_shipments(shipments, packages, _recent(spark, folder), "domestic_tracking_number", "zone", 3)


@query("legacy_dhl_packages", _OLD + ", " + _SINCE + """, u AS (SELECT r.domestic_tracking_number AS tracking_number, CAST(shipment_date AS TIMESTAMP) AS d, m.shipping_method_id AS mid,
    CAST(CASE WHEN billed_weight_unit = 'LB' THEN billed_weight * 16 ELSE billed_weight END AS DECIMAL(18,2)) AS w FROM recent r
    LEFT JOIN (SELECT method_name, min(shipping_method_id) AS shipping_method_id FROM methods GROUP BY 1) m ON m.method_name = r.shipping_method),
  one AS (SELECT *, row_number() OVER (PARTITION BY tracking_number ORDER BY d DESC NULLS LAST, mid DESC NULLS LAST, w DESC NULLS LAST) AS rn FROM u WHERE tracking_number IS NOT NULL)
SELECT p.shipment_package_id, p.tracking_number, one.d AS carrier_pickup_date, one.mid AS shipping_method_id, one.w AS billed_weight_oz FROM packages p LEFT JOIN one ON one.tracking_number = p.tracking_number AND rn = 1""")
def _(spark, folder):
    packages, methods = rel(spark, folder, "packages", "methods")
    packages = packages.withColumn("carrier_pickup_date", F.col("carrier_pickup_date").cast("timestamp_ntz"))
    ounces = F.when(F.col("billed_weight_unit") == "LB", F.col("billed_weight") * 16).otherwise(F.col("billed_weight"))
    values = {
        "carrier_pickup_date": F.col("shipment_date").try_cast("timestamp_ntz"),
        "billed_weight_oz": ounces.cast("decimal(18,2)"),
    }
    updated = legacy.update_packages(packages, _recent(spark, folder), methods, "domestic_tracking_number", values, "shipping_method")
    return updated.select("shipment_package_id", "tracking_number", "carrier_pickup_date", "shipping_method_id", "billed_weight_oz")


@query("legacy_dhl_invoices", _OLD + """, seen AS (SELECT DISTINCT invoice_number, tn FROM (SELECT invoice_number, overall_tracking_number AS tn FROM legacy_dhl UNION ALL SELECT invoice_number, domestic_tracking_number FROM legacy_dhl) q),
cnt AS (SELECT invoice_number, count(DISTINCT shipment_id) AS n FROM seen JOIN packages p ON p.tracking_number = seen.tn GROUP BY 1)
SELECT CAST(3 AS INT) AS carrier_id, l.invoice_number AS bill_number, max(invoice_date) AS bill_date,
  CAST(sum(COALESCE(transportation_cost, 0) + COALESCE(fuel_surcharge, 0) + COALESCE(non_qualified_dim_charges, 0) + COALESCE(delivery_area_surcharge, 0)) AS DECIMAL(18,2)) AS total_amount,
  CAST(COALESCE(max(cnt.n), 0) AS INT) AS num_shipments FROM legacy_dhl l LEFT JOIN cnt USING (invoice_number)
WHERE l.invoice_number NOT IN (SELECT 'DHL' || inv FROM li WHERE ok < 1000) GROUP BY 2""")
def _(spark, folder):
    existing = relation(spark, folder, "li").where("ok < 1000").selectExpr("'DHL' || CAST(inv AS STRING) AS bill_number").distinct()
    return legacy.dhl_invoices(relation(spark, folder, "legacy_dhl"), relation(spark, folder, "packages"), existing, 3)


@query("legacy_dhl_charges", _OLD + """, seen AS (SELECT overall_tracking_number AS tn, * FROM legacy_dhl UNION ALL SELECT domestic_tracking_number, * FROM legacy_dhl),
items AS (SELECT tn, invoice_number, 'Fuel Surcharge' AS n, fuel_surcharge AS v FROM seen UNION ALL SELECT tn, invoice_number, 'Delivery Area Surcharge', delivery_area_surcharge FROM seen
  UNION ALL SELECT tn, invoice_number, 'Non-Qualified Dim', non_qualified_dim_charges FROM seen)
SELECT DISTINCT p.shipment_id, p.shipment_package_id, i.invoice_number AS bill_number, ct.charge_type_id, CAST(i.v AS DECIMAL(18,2)) AS amount
FROM items i JOIN packages p ON p.tracking_number = i.tn JOIN charge_types ct ON ct.charge_name = i.n AND ct.carrier_id = 3 WHERE i.v <> 0""")
def _(spark, folder):
    bills, packages, types = rel(spark, folder, "legacy_dhl", "packages", "charge_types")
    return legacy.dhl_charges(bills, packages, types.where("carrier_id = 3"))


_EP_OLD = "WITH " + o.ctes("stg_easypost", "packages", "charge_types") + ", " + o.lines("easypost") + ", " + o.tall("easypost")


@query("legacy_easypost_invoices", _EP_OLD + """ SELECT CAST(4 AS INT) AS carrier_id, bill_number, bill_date, CAST(sum(label_fee + postage_fee + carbon_offset_fee + insurance_fee) AS DECIMAL(18,2)) AS total_amount,
  CAST(count(tracking_code) AS INT) AS num_shipments FROM lines_easypost GROUP BY 2, 3""")
def _(spark, folder):
    bills = lines(spark, folder, "easypost").withColumnRenamed("bill_number", "invoice_number")
    none = bills.sparkSession.createDataFrame([], "bill_number string")
    return legacy.easypost_invoices(bills, none, 4)


@query("legacy_easypost_charges", _EP_OLD + """ SELECT p.shipment_id, p.shipment_package_id, ct.charge_type_id, t.amount, count(*) AS n_rows FROM tall_easypost t
  JOIN packages p ON p.tracking_number = t.tracking_number JOIN charge_types ct ON ct.charge_name = t.charge_name AND ct.carrier_id = 4 GROUP BY ALL""")
def _(spark, folder):
    packages, types = rel(spark, folder, "packages", "charge_types")
    return legacy.easypost_charges(lines(spark, folder, "easypost"), packages, types.where("carrier_id = 4"))


_ADAPT = "WITH " + o.ctes("stg_easypost", "date_texts", "ord") + """,
raw AS (SELECT o.ok, CASE WHEN o.ok % 12 = 5 THEN 'x1' ELSE CAST(o.ok % 300 AS STRING) END AS weight, d.two_forms AS created_at, o.ck FROM ord o JOIN date_texts d ON d.ok = o.ok)
"""


def _adapter_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One EasyPost row per order, with dates in two forms and some unreadable cells."""
    texts = relation(spark, folder, "date_texts").select("ok", "two_forms")
    rows = relation(spark, folder, "ord").join(texts, "ok")
    blank = F.lit("")
    return rows.select(
        "ok",
        F.concat(F.lit("T"), F.col("ok").cast("string")).alias("tracking_code"),
        F.col("two_forms").alias("created_at"),
        F.when(F.col("ok") % 12 == 5, "x1").otherwise((F.col("ok") % 300).cast("string")).alias("weight"),
        *[blank.alias(n) for n in adapter.NUMBERS if n != "weight"],
        blank.alias("usps_zone"),
        F.lit("84101").alias("from_zip"),
        F.col("two_forms").alias("postage_label_created_at"),
        F.lit("Ground").alias("service"),
        F.when(F.col("ck") % 4 == 0, "").otherwise(F.concat(F.lit("ca_"), (F.col("ck") % 3).cast("string"))).alias("carrier_account_id"),
    )


_PARSED = """, parsed AS (SELECT 'T' || ok AS tracking_code, ok, ck, TRY_CAST(weight AS DECIMAL(18,4)) AS weight,
  CAST(CASE ok % 4 WHEN 0 THEN CAST(replace(replace(created_at, 'T', ' '), 'Z', '') AS TIMESTAMP) WHEN 1 THEN strptime(created_at, '%-m/%-d/%y') END AS DATE) AS day,
  CASE WHEN ok % 12 = 5 THEN 'weight' WHEN ok % 4 = 3 THEN 'created_at' END AS reject, CASE WHEN ck % 4 = 0 THEN '' ELSE 'ca_' || (ck % 3) END AS account FROM raw)"""


@query("easypost_parse_reject", _ADAPT + _PARSED + " SELECT tracking_code, weight, account || '-' || COALESCE(strftime(day, '%Y-%m-%d'), '') AS invoice_number, reject FROM parsed")
def _(spark, folder):
    return adapter.parse_rows(_adapter_rows(spark, folder)).select("tracking_code", "weight", "invoice_number", "reject")


@query("easypost_bill_details", _ADAPT + _PARSED + """ SELECT DISTINCT account || '-' || COALESCE(strftime(day, '%Y-%m-%d'), '') AS invoice_number, day AS invoice_date, '84101' AS warehouse_zip, account AS account_number
  FROM parsed WHERE reject IS NULL""")
def _(spark, folder):
    return adapter.bill_details(adapter.parse_rows(_adapter_rows(spark, folder)))


@query("easypost_account_check", _ADAPT + _PARSED + """ SELECT DISTINCT account || '-' || COALESCE(strftime(day, '%Y-%m-%d'), '') AS invoice_number, day AS invoice_date, '84101' AS warehouse_zip, account AS account_number
  FROM parsed WHERE reject IS NULL AND account NOT IN ('', 'ca_1')""")
def _(spark, folder):
    details = adapter.bill_details(adapter.parse_rows(_adapter_rows(spark, folder)))
    return adapter.account_mismatches(details, F.lit("ca_1"))


from . import file_queries  # noqa: E402,F401  (registers the queries that read and write files)
