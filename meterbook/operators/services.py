"""Services and their multipliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterbook.functions.rules import MONEY, code_number, day, empty_date, or_zero
from meterbook.operators.ids import assign_ids, highest_id
from meterbook.operators.joins import join_keyed


def target_accounts(accounts: DataFrame, account_type: str, division: str) -> DataFrame:
    return (
        accounts.filter((F.col("account_type") == account_type) & (F.col("division") == division))
        .select("account")
        .distinct()
    )


def service_accounts_semi(
    services: DataFrame, accounts: DataFrame, service: str, account_type: str, division: str
) -> DataFrame:
    """Services of one kind on accounts of one type and division."""
    return join_keyed(
        services.filter(F.col("service") == service),
        target_accounts(accounts, account_type, division),
        ["account"],
        "left_semi",
    )


def stage_target_accounts(
    services: DataFrame, accounts: DataFrame, service: str, account_type: str, division: str
) -> DataFrame:
    """The working rows for a staged multiplier run."""
    return service_accounts_semi(services, accounts, service, account_type, division).select(
        "account", "service", "servgrp_id"
    )


def staged_receivables(targets: DataFrame, ar_txns: DataFrame) -> DataFrame:
    """Number and sum of the receivables of each target account; without an exchange where both are in buckets by account."""
    return targets.join(ar_txns, "account", "left").groupBy("account").agg(
        F.count("amount").alias("transactions"), or_zero(F.sum("amount")).alias("amount")
    )


def multiplier_coverage(
    services: DataFrame, accounts: DataFrame, multipliers: DataFrame, service: str, account_type: str, division: str
) -> DataFrame:
    """How many (multiplier 1, service) matches the targets have, in one row.

    Both sides are counted per key before they meet, so matches are never listed.
    """
    key = ["servgrp_id", "service_group"]
    ones = multipliers.filter(F.col("multiplier") == 1).groupBy(*key).agg(F.count(F.lit(1)).alias("m"))
    targets = (
        service_accounts_semi(services, accounts, service, account_type, division)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("s"))
    )
    return targets.join(ones, key).agg(
        F.coalesce(F.sum(F.col("m") * F.col("s")), F.lit(0)).cast("bigint").alias("existing_multipliers")
    )


def numeric_targets(accounts: DataFrame, account_type: str, company: int, division: int) -> DataFrame:
    """Account rows per account for a type, company and division compared as numbers."""
    return (
        accounts.filter(
            (F.col("account_type") == account_type)
            & (code_number(F.col("company")) == company)
            & (code_number(F.col("division")) == division)
        )
        .groupBy("account", "account_type")
        .agg(F.count(F.lit(1)).alias("account_rows"))
    )


def multiplier_profile(
    services: DataFrame,
    accounts: DataFrame,
    multipliers: DataFrame,
    account_type: str,
    service: int,
    company: int,
    division: int,
) -> DataFrame:
    """Account × service × multiplier matches counted by multiplier (NULL where a service has none).

    Each side is counted per key first; the counts are then multiplied.
    """
    per_account = numeric_targets(accounts, account_type, company, division)
    own = services.filter(code_number(F.col("service")) == service).select("account", "service", "service_id")
    per_service = (
        join_keyed(own, per_account, ["account"], "inner")
        .groupBy("account_type", "service", F.col("service_id").alias("servgrp_id"))
        .agg(F.sum("account_rows").alias("n"))
    )
    per_multiplier = multipliers.groupBy("servgrp_id", "multiplier").agg(F.count(F.lit(1)).alias("m"))
    return (
        per_service.join(per_multiplier, "servgrp_id", "left")
        .groupBy("account_type", "service", "multiplier")
        .agg(F.sum(F.col("n") * F.coalesce("m", F.lit(1))).cast("bigint").alias("record_count"))
    )


def _target_rows(accounts: DataFrame, account_type: str, company: int, division: int) -> DataFrame:
    """Account rows per (customer, account) for a type, company and division compared as numbers."""
    return (
        accounts.filter(
            (F.col("account_type") == account_type)
            & (code_number(F.col("company")) == company)
            & (code_number(F.col("division")) == division)
        )
        .groupBy("customer", "account", "account_type")
        .agg(F.count(F.lit(1)).alias("account_rows"))
    )


def multiplier_targets(
    services: DataFrame, accounts: DataFrame, account_type: str, service: int, company: int, division: int
) -> DataFrame:
    """Account × service rows that need a multiplier, counted per customer, account, type and service."""
    own = services.filter(code_number(F.col("service")) == service)
    per_service = own.groupBy("account", "service").agg(F.count(F.lit(1)).alias("n"))
    return _target_rows(accounts, account_type, company, division).join(per_service, "account").select(
        "customer", "account", "account_type", "service", (F.col("account_rows") * F.col("n")).alias("record_count")
    )


def multiplier_verification(
    services: DataFrame,
    accounts: DataFrame,
    multipliers: DataFrame,
    account_type: str,
    service: int,
    company: int,
    division: int,
) -> DataFrame:
    """The same counts over the rows that multiplier 1 joins back to."""
    ones = multipliers.filter(F.col("multiplier") == 1).groupBy(F.col("servgrp_id").alias("service_id"))
    own = services.filter(code_number(F.col("service")) == service).select("account", "service", "service_id")
    per_service = (
        join_keyed(own, ones.agg(F.count(F.lit(1)).alias("m")), ["service_id"], "inner")
        .groupBy("account", "service")
        .agg(F.sum("m").alias("n"))
    )
    return _target_rows(accounts, account_type, company, division).join(per_service, "account").select(
        "customer",
        "account",
        "account_type",
        "service",
        F.lit(1).alias("multiplier"),
        (F.col("account_rows") * F.col("n")).alias("verified_count"),
    )


def target_services(
    services: DataFrame, accounts: DataFrame, account_type: str, service: int, company: int, division: int
) -> int:
    """How many distinct services need a multiplier."""
    own = services.filter(code_number(F.col("service")) == service)
    targets = _target_rows(accounts, account_type, company, division).select("account").distinct()
    return join_keyed(own, targets, ["account"], "left_semi").select("service_id").distinct().count()


def add_multipliers(
    services: DataFrame,
    accounts: DataFrame,
    multipliers: DataFrame,
    account_type: str,
    service: int,
    company: int,
    division: int,
    only_missing: bool = False,
) -> DataFrame:
    """New multiplier rows for the target services, with keys after the highest one.

    One row per service row whose id is a target id. ``only_missing`` leaves out
    services that already have multiplier 1.
    """
    per_account = numeric_targets(accounts, account_type, company, division).select("account")
    own = services.filter(code_number(F.col("service")) == service)
    ids = join_keyed(own, per_account, ["account"], "left_semi").select("service_id").distinct()
    rows = join_keyed(services, ids, ["service_id"], "left_semi")
    if only_missing:
        ones = (
            multipliers.filter(F.col("multiplier") == 1)
            .select(F.col("servgrp_id").alias("service_id"))
            .distinct()
        )
        rows = join_keyed(rows, ones, ["service_id"], "left_anti")
    rows = rows.select("service_id", "account", "install_date", "service")
    numbered = assign_ids(
        rows,
        ["service_id", "account", "install_date", "service"],
        highest_id(multipliers, "multiplier_pk"),
        "multiplier_pk",
    )
    return numbered.select(
        F.col("service_id").alias("servgrp_id"),
        F.lit(1).alias("multiplier"),
        F.lit(4).cast(MONEY).alias("basic_multiple"),
        F.lit("").alias("notes"),
        "multiplier_pk",
        F.col("install_date").alias("start_date"),
        empty_date().alias("end_date"),
        F.col("service").alias("service_group"),
    )


def add_multipliers_staged(staged: DataFrame, multipliers: DataFrame, start: str, service_group: str) -> DataFrame:
    """The same from a staged table, with a fixed start date and service group."""
    numbered = assign_ids(
        staged.select("servgrp_id", "account", "service"),
        ["servgrp_id", "account", "service"],
        highest_id(multipliers, "multiplier_pk"),
        "multiplier_pk",
    )
    return numbered.select(
        "servgrp_id",
        F.lit(1).alias("multiplier"),
        F.lit(4).cast(MONEY).alias("basic_multiple"),
        "multiplier_pk",
        day(start).alias("start_date"),
        F.lit(service_group).alias("service_group"),
    )
