"""The whole run: clean, fact, dimensions, checks, aggregates, publish.

Every run writes to a folder of its own below ``runs``. Range checks and the row checks of
the load gate are counted by the jobs that write there, and references by the unknown keys
that the filter found; the gate's rows go to ``quality_log`` in any case. Only when
nothing fails does ``published`` name the run, so a bad load never replaces a good one.
The two runs published last are kept.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.operators.aggregates import STATE_KEYS, aggregate
from tradewind.operators.cleaning import DataQualityError, clean_all, unknown_keys, without_keys
from tradewind.operators.quality import append_quality_log, gate_counts, load_gate
from tradewind.operators.star import (
    DEFAULT_SOURCE, dimensions, fact_order_items, measured, ordered_items,
)
from tradewind.schemas import GATE_RULES, MAX_FK_VIOLATIONS, STAGED_TABLES, CleaningRules
from tradewind.session import configure, counted_write, scratch_path, together
from tradewind.sources.files import children, delete_path, read_tables
from tradewind.sources.tables import (
    FACT_PARTITION, previous_version, read_back, read_current, replace_table, write_version,
)

log = logging.getLogger(__name__)


@dataclass
class Warehouse:
    """Tables of one run. ``failures`` names aggregates that could not be built."""

    tables: dict[str, DataFrame]
    dims: dict[str, DataFrame]
    fact: DataFrame
    aggregates: dict[str, DataFrame] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def clean(
    raw: Mapping[str, DataFrame], folder: str,
    rules: Mapping[str, CleaningRules] | None = None, used: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Clean the raw tables; staged ones are stored once and read from there on.

    With ``used`` only those tables are read later: they are all stored below the folder,
    while the others are worked out and checked but not stored.
    """

    def keep(
        name: str, df: DataFrame, counts: Mapping[str, Column]
    ) -> tuple[DataFrame, dict[str, int]]:
        spark = df.sparkSession
        if used is not None and name not in used:
            return df, counted_write(df, counts, lambda rows: rows.write.format("noop").mode(
                "overwrite").save())
        path = (f"{folder}/staging/raw_{name}" if name in STAGED_TABLES or used is not None
                else scratch_path(spark, name))
        found = replace_table(df, path, counts=counts)
        return read_back(spark, path, df), found

    return clean_all(raw, rules, counted_keep=keep)


def star(
    tables: Mapping[str, DataFrame], run_ts: dt.datetime | None = None,
    source: str = DEFAULT_SOURCE,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact with valid references only, and the dimensions."""
    fact, dims, _ = _star(tables, run_ts, source)
    return fact, dims


def _star(
    tables: Mapping[str, DataFrame], run_ts: dt.datetime | None, source: str,
    dealt: bool = False,
) -> tuple[DataFrame, dict[str, DataFrame], dict[str, DataFrame]]:
    """Fact, dimensions, and the keys without a dimension row.

    A fact that is ``dealt`` is rebalanced by month for its write. Measures and lineage are
    worked out after that, so they are not shuffled.
    """
    dims = dimensions(tables, run_ts, source)
    if dealt:
        lines = ordered_items(tables["orders"], tables["order_items"])
        fact = measured(lines.hint("rebalance", FACT_PARTITION), run_ts, source)
    else:
        fact = fact_order_items(tables["orders"], tables["order_items"], run_ts, source)
    keys = {
        "customer_id": tables["orders"],
        "product_id": tables["order_items"],
        "seller_id": tables["order_items"],
    }
    lost = unknown_keys(fact, dims, keys)
    return without_keys(fact, lost), dims, lost


def run(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str,
    rules: Mapping[str, CleaningRules] | None = None, run_ts: dt.datetime | None = None,
    source: str = DEFAULT_SOURCE, max_broken: float = MAX_FK_VIOLATIONS,
) -> Warehouse:
    """Raw tables to a published warehouse, every layer stored and read back.

    Any broken rule of cleaning, and any limit of the load gate that fails, raises and
    leaves the published run as it was. ``max_broken`` is the share of rows whose
    customer, product or seller may be unknown. The fact is stored before aggregates are
    built from it, so its joins run once. An aggregate that fails is reported and does
    not stop the run.
    """
    configure(spark)
    run_ts = run_ts or dt.datetime.now()  # one load time for the whole run
    name_of_run = uuid.uuid4().hex
    place = f"{folder}/runs/{name_of_run}"
    tables = clean(raw, place, rules)
    fact, dims, lost = _star(tables, run_ts, source, dealt=True)
    counted: dict[str, dict[str, int]] = {}

    def keep(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{place}/dwh/{name}"
        counts = gate_counts(df) if name in GATE_RULES else None
        counted[name] = replace_table(df, path, partition_by, counts=counts, dealt=True)
        return read_back(spark, path, df)

    stored = together({
        "fact_order_items": partial(keep, "fact_order_items", fact, (FACT_PARTITION,)),
        **{name: partial(keep, name, df) for name, df in dims.items()},
    })
    house = Warehouse(tables, {name: stored[name] for name in dims}, stored["fact_order_items"])
    rows = load_gate({**house.dims, "fact_order_items": house.fact}, tables, max_broken,
                     counted=counted, lost=lost)
    record_gate(spark, rows, folder, run_ts)

    def build(name: str) -> None:
        try:
            house.aggregates[name] = keep(name, aggregate(house.fact, name, run_ts))
        except Exception as error:  # noqa: BLE001 - reported to the caller
            log.warning("aggregate %s failed: %s", name, error)
            house.failures[name] = str(error)

    together({name: partial(build, name) for name in STATE_KEYS})
    _publish(spark, folder, name_of_run, run_ts)
    return house


def record_gate(
    spark: SparkSession, rows: DataFrame, folder: str, run_ts: dt.datetime
) -> None:
    """Log every limit of the gate and raise if one fails."""
    found = rows.collect()  # a row per table and check
    at = F.lit(run_ts).cast("timestamp_ntz")
    append_quality_log(
        spark.createDataFrame(found, rows.schema).withColumn("check_timestamp", at).coalesce(1),
        f"{folder}/quality_log",
    )
    failed = [f"{r.table_name} {r.check_name}: {r.failed} of {r.checked}"
              for r in found if r.result == "FAIL"]
    if failed:
        raise DataQualityError("load gate: " + "; ".join(sorted(failed)))


def _publish(spark: SparkSession, folder: str, name: str, run_ts: dt.datetime) -> None:
    entry = spark.createDataFrame([(name, run_ts.isoformat())], "run string, run_ts string")
    write_version(entry, f"{folder}/published")
    before = previous_version(spark, f"{folder}/published")
    used = {name} | ({before.first().run} if before is not None else set())
    for other in children(spark, f"{folder}/runs"):
        if other not in used:
            delete_path(spark, f"{folder}/runs/{other}")


def published(spark: SparkSession, folder: str) -> str:
    """Folder of the run published last: ``staging`` and ``dwh`` lie below it."""
    return f"{folder}/runs/{read_current(spark, f'{folder}/published').first().run}"


def run_files(
    spark: SparkSession, source_folder: str, folder: str,
    rules: Mapping[str, CleaningRules] | None = None, run_ts: dt.datetime | None = None,
    source: str = DEFAULT_SOURCE, max_broken: float = MAX_FK_VIOLATIONS,
) -> Warehouse:
    """The run from CSV files; of rows with the same key the first in file order stays."""
    raw = read_tables(spark, source_folder, file_order=True)
    return run(spark, raw, folder, rules, run_ts, source, max_broken)
