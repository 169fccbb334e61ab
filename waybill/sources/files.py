"""Reading carrier files. Each row keeps its file path, so many files run in one job."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import decimal_of, not_blank, null_as_zero
from ..operators.lookup import lookup_join
from ..session import written
from .contracts import CARRIER_ALIASES, CONTRACTS, DHL_HEADER, Contract
from .heads import PATH, file_heads



class MissingColumns(ValueError):
    """A named file lacks columns of its contract."""


def _text_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, width + 1)])


def _csv_options(has_header: bool) -> dict[str, object]:
    return {"header": has_header, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def read_positional(
    spark: SparkSession, contract: Contract, path: str | list[str], *, has_header: bool | None = None
) -> DataFrame:
    """Bind cells by position; the header line of a carrier that sends one is skipped, its names (which
    repeat) are ignored."""
    raw = (
        spark.read.schema(_text_schema(contract.width))
        .options(**_csv_options(contract.has_header if has_header is None else has_header), enforceSchema=True)
        .csv(path)
    )
    return raw.select(
        *[F.col(f"c{i}").alias(name) for name, i in contract.ordinals.items()],
        F.col("_metadata.file_path").alias(PATH),
    )


def head_problems(contract: Contract, heads: list) -> dict[str, str]:
    """Why files cannot be read, by path, from their heads (file_path, header, first_row)."""
    out = {}
    for row in heads:
        cells = _cells(row["header"])
        if not contract.positional:
            missing = header_drift(contract, cells)["missing"]
            if missing:
                out[row[PATH]] = f"no column {', '.join(missing)}"
        elif contract.header_record and not all(len(cells) >= i and cells[i - 1] for i in DHL_HEADER.values()):
            out[row[PATH]] = "its first line is no header record"
    return out


def account_in(contract: Contract, head) -> str | None:
    """The account named in a file's first row of data, from its head (header, first_row)."""
    titled = not contract.positional or contract.has_header or contract.header_record
    cells = _cells(head["first_row"] if titled else head["header"])
    return cells[contract.account_ordinal] if len(cells) > contract.account_ordinal else None


def _cells(record: str | None) -> list[str]:
    return [c.strip() for c in next(csv.reader([record]), [])] if record else []


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else unquote(path)


def read_named(spark: SparkSession, contract: Contract, path: str | list[str]) -> DataFrame:
    """Bind cells by header name, file by file: files may order and add columns as they like.

    Files that hold the needed columns at the same places are read in one scan, whatever else they hold. A file that
    lacks a column of the contract is refused.
    """
    heads = file_heads(spark, path).collect()
    bad = head_problems(contract, heads)
    if bad:
        file, reason = min(bad.items())
        raise MissingColumns(f"{contract.carrier}: {reason} in {file}")
    layouts: dict[tuple[int, ...], list[str]] = {}
    for row in heads:
        names = _cells(row["header"])
        layouts.setdefault(tuple(names.index(h) + 1 for h in contract.headers.values()), []).append(row[PATH])
    parts = []
    for places, files in sorted(layouts.items()):
        raw = (
            spark.read.schema(_text_schema(max(places)))
            .options(**_csv_options(True), enforceSchema=True)
            .csv([_local(f) for f in files])
        )
        parts.append(raw.select(
            *[F.col(f"c{i}").alias(name) for i, name in zip(places, contract.headers)], F.col("_metadata.file_path").alias(PATH),
        ))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in [*contract.headers, PATH]))
    return reduce(DataFrame.unionByName, parts)


def header_drift(contract: Contract, headers: list[str]) -> dict[str, list[str]]:
    """Which contract headers a file lacks and which it adds."""
    expected = set(contract.headers.values())
    return {
        "missing": [h for h in contract.headers.values() if h not in headers],
        "unexpected": [h for h in headers if h not in expected],
    }


def read_dhl(spark: SparkSession, contract: Contract, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """A DHL file's (headers, details). The header record is the file's first line, whatever its first cell holds.

    A file whose first line does not name invoice, day, account, total and shipments is refused. A shipment has a second
    line without values; it carries no tracking and goes.
    """
    heads = written(file_heads(spark, path), "heads")
    bad = head_problems(contract, heads.collect())
    if bad:
        file, reason = min(bad.items())
        raise MissingColumns(f"{file}: {reason}, it has 0 header records instead of one")
    schema = _text_schema(contract.width)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    own = heads.select(PATH, F.from_csv("header", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("__c"))
    headers = own.select(PATH, *[F.trim(F.col(f"__c.c{i}")).alias(f"header_{name}") for name, i in DHL_HEADER.items()])
    raw = spark.read.schema(schema).options(**_csv_options(False)).csv(path).withColumn(PATH, F.col("_metadata.file_path"))
    first = own.select(PATH, F.xxhash64("__c.*").alias("__first"))
    details = lookup_join(raw.withColumn("__hash", F.xxhash64(*[F.col(f"c{i}") for i in range(1, contract.width + 1)])), first, [PATH], "left")
    details = details.where(F.col("__hash") != F.coalesce("__first", F.lit(0))).select(
        PATH, *[F.col(f"c{i}").alias(name) for name, i in contract.ordinals.items()]
    )
    tracked = F.coalesce(not_blank(F.col("international_tracking_number")), F.lit(False)) | F.coalesce(
        not_blank(F.col("unique_id")), F.lit(False)
    )
    return headers, details.where(tracked)


def read_staged(spark: SparkSession, contract: Contract, paths: list[str]) -> DataFrame:
    """Staged rows of files of any carrier, with the path of their file."""
    if contract.header_record:
        headers, details = read_dhl(spark, contract, paths)
        return attach_header(details, headers)
    return (read_positional if contract.positional else read_named)(spark, contract, paths)


def arrived(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, first_row) of files under tenant/carrier/account folders, the row as JSON with Prop_<n> keys.

    It is the file's first record, or its second one where the carrier's files begin with names or a header record.
    """
    titled = [name for name, c in CONTRACTS.items() if not c.positional or c.has_header or c.header_record]
    carrier = carrier_key(path_parts(F.col(PATH)).getField("carrier"))
    record = F.when(carrier.isin(titled), F.col("first_row")).otherwise(F.col("header"))
    width = max([1 + c.account_ordinal for c in CONTRACTS.values()])
    cells = F.from_csv(record, ", ".join(f"Prop_{i} string" for i in range(width)), {"quote": '"', "escape": '"'})
    return file_heads(spark, path).select(PATH, F.to_json(cells).alias("first_row"))


def carrier_key(name: Column) -> Column:
    result = F.lower(name)
    for alias, key in CARRIER_ALIASES.items():
        result = F.when(F.lower(name) == alias, key).otherwise(result)
    return result


def path_parts(path: Column) -> Column:
    """`.../tenant/carrier/account/file` as a struct; the path is a URI, so `%20` means a blank."""
    parts = F.slice(F.split(path, "/"), -4, 4)
    text = [F.url_decode(F.replace(parts[i], F.lit("+"), F.lit("%2B"))) for i in range(4)]
    return F.struct(
        text[0].alias("tenant"),
        F.lower(text[1]).alias("carrier"),
        text[2].alias("account"),
        text[3].alias("file_name"),
    )


def first_row_account(raw_json: Column, carrier: Column, ordinals: dict[str, int]) -> Column:
    """The account named in a file's first row (JSON with Prop_<n> keys), by carrier; else NULL."""
    result = None
    for name, position in ordinals.items():
        value = F.get_json_object(raw_json, f"$.Prop_{position}")
        result = F.when(carrier == name, value) if result is None else result.when(carrier == name, value)
    return result


def attach_header(details: DataFrame, headers: DataFrame) -> DataFrame:
    """Each detail with invoice number and date of its file's header, matched by file and never by
    the order of rows."""
    own = headers.select(
        PATH, F.col("header_bill_number").alias("invoice_number"), F.col("header_bill_date").alias("invoice_date")
    )
    return lookup_join(details, own, [PATH], "inner", derived=True)


def header_totals(details: DataFrame, headers: DataFrame) -> DataFrame:
    """Per file: the header's total against the sum of the four charge columns."""
    total = None
    for c in ("transportation_cost", "non_qualified_dimensional_charges", "fuel_surcharge_amount", "delivery_area_surcharge_amount"):
        part = null_as_zero(decimal_of(F.col(c)))
        total = part if total is None else total + part
    added = details.groupBy(PATH).agg(F.sum(total).cast("decimal(18,2)").alias("detail_total"))
    stated = headers.select(
        PATH, F.col("header_bill_number").alias("bill_number"), decimal_of(F.col("header_total_amount")).alias("header_total")
    )
    return stated.join(added, PATH, "left").select(
        PATH, "bill_number", "header_total", F.coalesce("detail_total", F.lit(0).cast("decimal(18,2)")).alias("detail_total"),
        (F.abs(F.col("header_total") - F.coalesce("detail_total", F.lit(0))) < F.expr("0.01BD")).alias("agrees"),
    )
