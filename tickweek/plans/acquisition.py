"""Acquisition: keep constituents, attach profiles, nest histories, flatten.

The reference fetched a profile and a history per symbol over the network;
here both are tables and the per-symbol calls become joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweek.fixed import COMPANY_COLUMNS
from tickweek.functions.text import comma_to_dot
from tickweek.operators.clean import within
from tickweek.operators.enrich import (
    PAGE_ROWS,
    attach_history,
    documents_with_bars,
    documents_without_bars,
    first_record,
    flatten_documents,
    keep_members,
    merge_right_wins,
    nest_history,
    one_per_key,
)
from tickweek.operators.open import merge_open, open_documents, open_first_records
from tickweek.schemas import BAR_COLUMNS, CSV_OPTIONS, INSTRUMENT, PROFILE
from tickweek.sinks.routed import STATUS, routed


def profiles(profile_bodies: DataFrame) -> DataFrame:
    """First record of each profile response body."""
    return first_record(profile_bodies, "body", PROFILE, present=True)


def companies(instruments: DataFrame, members: DataFrame, profile_bodies: DataFrame) -> DataFrame:
    """Constituent instruments, each merged with its profile (profile wins)."""
    return merge_right_wins(keep_members(instruments, members), profiles(profile_bodies))


def _member_bars(history: DataFrame, members: DataFrame, history_range: tuple[str | None, str | None] | None) -> DataFrame:
    bars = history if history_range is None else within(history, "date", *history_range)
    return keep_members(bars, members)


def company_documents(
    instruments: DataFrame,
    members: DataFrame,
    profile_bodies: DataFrame,
    history: DataFrame,
    history_range: tuple[str | None, str | None] | None = None,
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Company documents with nested bars (see ``attach_history``).

    Only the members' bars and bodies go further: both are chosen before
    anything is nested or parsed."""
    bars = _member_bars(history, members, history_range)
    listed = companies(instruments, members, keep_members(profile_bodies, members))
    return attach_history(listed, nest_history(bars, page_rows=page_rows), history=bars)


def documents_from_records(
    instruments: DataFrame,
    members: DataFrame,
    profiles: DataFrame,
    history: DataFrame,
    history_range: tuple[str | None, str | None] | None = None,
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """As ``company_documents``, with profiles already as records; a symbol
    with several records keeps one (``one_per_key``)."""
    bars = _member_bars(history, members, history_range)
    listed = merge_right_wins(keep_members(instruments, members), one_per_key(keep_members(profiles, members)))
    return attach_history(listed, nest_history(bars, page_rows=page_rows), history=bars)


def flat_rows(docs: DataFrame) -> DataFrame:
    """One row per (company, bar): the 19 company columns, then the 13 bar columns."""
    return flatten_documents(documents_with_bars(docs), COMPANY_COLUMNS, BAR_COLUMNS)


def csv_rows(docs: DataFrame) -> DataFrame:
    """Flat rows ready for comma text: commas in text cells become dots."""
    return comma_to_dot(flat_rows(docs))


def flat_csv(
    instruments: DataFrame,
    members: DataFrame,
    profile_bodies: DataFrame,
    history: DataFrame,
    history_range: tuple[str | None, str | None] | None = None,
) -> DataFrame:
    """The rows of ``csv_rows`` straight from the tables: companies joined to bars, nothing nested."""
    bars = _member_bars(history, members, history_range)
    listed = companies(instruments, members, keep_members(profile_bodies, members)).select(*COMPANY_COLUMNS)
    return comma_to_dot(listed.join(bars, "symbol").select(*COMPANY_COLUMNS, *BAR_COLUMNS))


def open_companies(instrument_lines: DataFrame, members: DataFrame, profile_bodies: DataFrame) -> DataFrame:
    """As ``companies``, from JSON lines of instruments; fields that no schema knows stay in ``extra``."""
    listed = keep_members(open_documents(instrument_lines, INSTRUMENT), members)
    return merge_open(listed, open_first_records(keep_members(profile_bodies, members), "body", PROFILE))


def routed_documents(docs: DataFrame) -> DataFrame:
    """Flattening in one pass: text rows ``value`` with their ``status``.

    A document with bars gives one good row per bar, comma text as ``csv_rows``
    has it; one without gives one rejected row, its JSON. An empty array of bars
    counts as none."""
    company = [f.name for f in PROFILE.fields]
    rows = docs.select(F.to_json(F.struct(*company)).alias("_json"), *COMPANY_COLUMNS, F.explode_outer("stockData").alias("_bar"))
    flat = comma_to_dot(rows.select("_json", "_bar", *COMPANY_COLUMNS, "_bar.*"), [*COMPANY_COLUMNS, *BAR_COLUMNS])
    line = F.to_csv(F.struct(*COMPANY_COLUMNS, *BAR_COLUMNS), CSV_OPTIONS)
    has_bar = F.col("_bar").isNotNull()
    return routed(flat.withColumn("value", F.when(has_bar, line).otherwise(F.col("_json"))), has_bar).select("value", STATUS)


def rejects(docs: DataFrame) -> DataFrame:
    """Documents without bars, without the nesting columns."""
    return documents_without_bars(docs).drop("page_month", "page", "stockData")
