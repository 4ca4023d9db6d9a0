"""The checks of the four layers, and their log.

The DWH and mart checks and their names are given; the Bronze and Silver ones are our own rules
over the same categories (required fields, day match, lineage, duplicates, keys, references).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tillworks.operators.checks import (
    BUSINESS_RULE,
    CRITICAL,
    ERROR,
    RECONCILIATION,
    REFERENTIAL,
    UNIQUENESS,
    WARNING,
    Check,
    NotEmpty,
    References,
    RowRule,
    Run,
    SameValue,
    Unique,
    evaluate,
    evaluate_runs,
)
from tillworks.plans.views import check_blocks, status_order
from tillworks.schema import AUDIT, NATURAL_KEY, SURROGATE_KEY, UNKNOWN_KEY, conform

LOAD_LOG = "audit.etl_table_load_log"
GOOD_LOADS = "'SUCCESS', 'SUCCESS_WITH_WARNING', 'SKIPPED'"  # fixed values


def _batch_scope(column: str, batch: str | None, extra: str | None = None) -> str | None:
    parts = [f"{column} = '{batch}'"] if batch else []
    return " AND ".join(parts + ([extra] if extra else [])) or None


def _any(*conditions: str) -> str:
    return " OR ".join(conditions)


def _negative(*columns: str) -> str:
    return _any(*[f"{c} < 0" for c in columns])


def _outside_share(column: str) -> str:
    return _any(f"{column} < 0", f"{column} > 1")


def _null(*columns: str) -> str:
    return _any(*[f"{c} IS NULL" for c in columns])


def _other(column: str, value: int | str | None) -> str:
    """NULL, or not the batch's day or week (a snapshot has neither). The value may be the name of the
    column that says to which batch a row belongs, when the batches of many days are checked at once."""
    return _null(column) if value is None else _any(_null(column), f"{column} <> {value}")


def _links(*dims: str) -> tuple[tuple[str, str, str], ...]:
    return tuple((SURROGATE_KEY[d], f"dwh.{d}", SURROGATE_KEY[d]) for d in dims)


# --- DWH ------------------------------------------------------------------------------------
_SHORT = {name: name.removeprefix("dim_") for name in SURROGATE_KEY}
_FACT_GRAIN = {
    "fact_sales_transaction": ("FACT_SALES", "sales_fact"),
    "fact_coupon_redemption": ("FACT_COUPON", "coupon_redemption_fact"),
    "fact_campaign_target": ("FACT_CAMPAIGN_TARGET", "campaign_target_fact"),
    "fact_promotion_weekly": ("FACT_PROMOTION", "promotion_weekly_fact"),
}
_FACT_DIMS = {
    "fact_sales_transaction": ("sales", "FACT_SALES", ("dim_product", "dim_household", "dim_store", "dim_day")),
    "fact_coupon_redemption": (
        "coupon",
        "FACT_COUPON",
        ("dim_household", "dim_coupon", "dim_campaign", "dim_day"),
    ),
    "fact_campaign_target": ("campaign_target", "FACT_CAMPAIGN_TARGET", ("dim_household", "dim_campaign")),
    "fact_promotion_weekly": ("promotion", "FACT_PROMOTION", ("dim_product", "dim_store")),
}


def dwh_checks(batch: str | None = None, day: int | str | None = None, week: int | str | None = None) -> dict[str, Check]:
    """28 checks, keyed qw1..qw28."""
    scope = _batch_scope("SourceBatchID", batch)
    in_week = f"WeekNumber = {week}" if week is not None else None
    checks: list[Check] = []
    for dim, short in _SHORT.items():
        checks.append(
            NotEmpty(
                f"DQ_DWH_{dim.upper()}_NOT_EMPTY", "DWH", f"dwh.{dim}", f"{dim}_not_empty",
                RECONCILIATION, CRITICAL, f"{dim} holds more than the unknown member", at_least=2,
            )
        )
    for fact, suffix, name, where in (
        ("fact_sales_transaction", "FACT_SALES_NOT_EMPTY", "fact_sales_not_empty", scope),
        ("fact_campaign_target", "FACT_CAMPAIGN_TARGET_NOT_EMPTY", "fact_campaign_target_not_empty", scope),
        (
            "fact_promotion_weekly", "FACT_PROMOTION_NOT_EMPTY", "fact_promotion_weekly_not_empty",
            _batch_scope("SourceBatchID", batch, in_week),
        ),
    ):
        checks.append(
            NotEmpty(
                f"DQ_DWH_{suffix}", "DWH", f"dwh.{fact}", name,
                RECONCILIATION, CRITICAL, f"{fact} has rows for the batch", where,
            )
        )
    for dim in ("dim_product", "dim_household", "dim_campaign", "dim_store", "dim_coupon", "dim_day"):
        checks.append(
            Unique(
                f"DQ_DWH_{dim.upper()}_NK_UNIQUE", "DWH", f"dwh.{dim}", f"{_SHORT[dim]}_natural_key_unique",
                UNIQUENESS, CRITICAL, f"{NATURAL_KEY[dim]} is unique among the members of {dim}",
                f"{SURROGATE_KEY[dim]} <> {UNKNOWN_KEY}", keys=(NATURAL_KEY[dim],),
            )
        )
    for fact, (suffix, name) in _FACT_GRAIN.items():
        checks.append(
            Unique(
                f"DQ_DWH_{suffix}_GRAIN_UNIQUE", "DWH", f"dwh.{fact}", f"{name}_grain_unique", UNIQUENESS, CRITICAL,
                f"RecordHash is unique in {fact}", scope, keys=("RecordHash",),
            )
        )
    for fact, (short, suffix, dims) in _FACT_DIMS.items():
        checks.append(
            References(
                f"DQ_DWH_{suffix}_RI", "DWH", f"dwh.{fact}", f"{short}_fact_dimension_referential_integrity",
                REFERENTIAL, CRITICAL, f"every key of {fact} exists in its dimension", scope, links=_links(*dims),
            )
        )
    sales_keys = [SURROGATE_KEY[d] for d in _FACT_DIMS["fact_sales_transaction"][2]]
    checks.append(
        RowRule(
            "DQ_DWH_FACT_SALES_UNKNOWN_KEYS", "DWH", "dwh.fact_sales_transaction", "sales_fact_unknown_key_usage",
            REFERENTIAL, WARNING, "use of the unknown member in the sales fact is observed", scope, "WARN",
            bad=_any(*[f"{k} = {UNKNOWN_KEY}" for k in sales_keys]),
        )
    )
    for fact, silver, suffix, short, where in (
        ("fact_sales_transaction", "transaction_clean", "SALES", "sales", ("day_no", day)),
        ("fact_campaign_target", "campaign_target_clean", "CAMPAIGN_TARGET", "campaign_target", None),
        ("fact_promotion_weekly", "promotion_weekly_clean", "PROMOTION", "promotion", ("week_no", week)),
    ):
        source_scope = f"{where[0]} = {where[1]}" if where and where[1] is not None else None
        checks.append(
            SameValue(
                f"DQ_DWH_{suffix}_RECONCILIATION", "DWH", f"dwh.{fact}", f"silver_to_{short}_fact_reconciliation",
                RECONCILIATION, CRITICAL, f"{fact} has as many rows as {silver}", scope,
                source=f"silver.{silver}", source_where=_batch_scope("SourceBatchID", batch, source_scope),
            )
        )
    checks.append(_load_status("DWH", "dwh", batch))
    return {f"qw{i}": c for i, c in enumerate(checks, 1)}


def _load_status(layer: str, short: str, batch: str | None) -> Check:
    return RowRule(
        f"DQ_{layer}_LOAD_STATUS", layer, LOAD_LOG, f"{short}_load_status_check", RECONCILIATION, CRITICAL,
        f"loads of the {layer} layer exist and none failed", _batch_scope("BatchID", batch, f"LayerName = '{layer}'"),
        bad=f"LoadStatus NOT IN ({GOOD_LOADS})", empty_fails=True,
    )


# --- marts ----------------------------------------------------------------------------------
_MART_GRAIN = {
    "dm_daily_sales": ("DAILY_SALES", ("DayKey",)),
    "dm_product_sales": ("PRODUCT_SALES", ("ProductKey",)),
    "dm_campaign_performance": ("CAMPAIGN", ("CampaignKey",)),
    "dm_promotion_performance": ("PROMOTION", ("ProductKey", "StoreKey", "WeekNumber", "HasDisplay", "HasMailer")),
}
_AMOUNTS = ("TotalQuantity", "GrossSalesAmount", "TotalDiscountAmount", "NetSalesAmount")


def mart_checks(batch: str | None = None, day: int | str | None = None, week: int | str | None = None) -> dict[str, Check]:
    """17 checks, keyed qm1..qm17."""
    scope = _batch_scope("SourceBatchID", batch)
    checks: list[Check] = []
    for mart, (suffix, _) in _MART_GRAIN.items():
        in_week = f"WeekNumber = {week}" if week is not None and mart == "dm_promotion_performance" else None
        checks.append(
            NotEmpty(
                f"DQ_{mart.upper()}_NOT_EMPTY", "DM", f"dm_marketing.{mart}", f"{mart}_not_empty", RECONCILIATION,
                CRITICAL, f"{mart} has rows for the batch", _batch_scope("SourceBatchID", batch, in_week),
            )
        )
    checks += [
        RowRule(
            "DQ_DM_DAILY_SALES_DAY", "DM", "dm_marketing.dm_daily_sales", "dm_daily_sales_process_day_check",
            BUSINESS_RULE, ERROR, "days are those of the batch", scope, bad=_other("DayNumber", day),
        ),
        RowRule(
            "DQ_DM_PROMOTION_WEEK", "DM", "dm_marketing.dm_promotion_performance", "dm_promotion_process_week_check",
            BUSINESS_RULE, ERROR, "weeks are those of the batch", scope, bad=_other("WeekNumber", week),
        ),
    ]
    for mart, (suffix, grain) in _MART_GRAIN.items():
        checks.append(
            Unique(
                f"DQ_DM_{suffix}_GRAIN_UNIQUE", "DM", f"dm_marketing.{mart}", f"{mart}_grain_unique",
                UNIQUENESS, CRITICAL, f"one row per {', '.join(grain)}", scope, keys=grain,
            )
        )
    rules = {
        "dm_daily_sales": ("DAILY_SALES", "dm_daily_sales", _any(
            _negative("BasketCount", "HouseholdCount", "ProductCount", "StoreCount", *_AMOUNTS, "AverageBasketAmount"),
            _outside_share("DiscountRate"))),
        "dm_product_sales": ("PRODUCT_SALES", "dm_product_sales", _any(
            _negative("BasketCount", "HouseholdCount", "StoreCount", *_AMOUNTS, "AverageUnitNetSales"),
            _outside_share("DiscountRate"))),
        "dm_campaign_performance": ("CAMPAIGN", "dm_campaign", _any(
            _negative("TargetHouseholdCount", "RedeemingHouseholdCount", "RedemptionCount", "DistinctCouponCount"),
            _outside_share("RedemptionRate"),
            "RedeemingHouseholdCount > TargetHouseholdCount")),
    }
    for mart, (suffix, name, bad) in rules.items():
        checks.append(
            RowRule(
                f"DQ_DM_{suffix}_METRICS", "DM", f"dm_marketing.{mart}", f"{name}_metric_rules", BUSINESS_RULE,
                CRITICAL, "measures are not negative and rates lie between 0 and 1", scope, bad=bad,
            )
        )
    for mart, suffix in (("dm_daily_sales", "DAILY_SALES"), ("dm_product_sales", "PRODUCT_SALES")):
        checks.append(
            SameValue(
                f"DQ_DM_{suffix}_RECONCILIATION", "DM", f"dm_marketing.{mart}", f"dwh_to_{mart}_reconciliation",
                RECONCILIATION, CRITICAL, f"net sales of {mart} equal those of the sales fact", scope,
                source="dwh.fact_sales_transaction", source_where=scope,
                source_value="NetSalesAmount", value="NetSalesAmount", amount=True,
            )
        )
    checks.append(
        SameValue(
            "DQ_DM_CAMPAIGN_TARGET_RECONCILIATION", "DM", "dm_marketing.dm_campaign_performance",
            "dwh_to_dm_campaign_target_reconciliation", RECONCILIATION, CRITICAL,
            "targeted households equal the rows of the target fact", scope,
            source="dwh.fact_campaign_target", source_where=scope, value="TargetHouseholdCount",
        )
    )
    checks.append(_load_status("DM", "dm", batch))
    return {f"qm{i}": c for i, c in enumerate(checks, 1)}


# --- Bronze: our rules ------------------------------------------------------------------------
_BRONZE_REQUIRED = {
    "transaction_data_raw": ("basket_id", "product_id", "day_no", "quantity", "sales_value"),
    "coupon_redemption_raw": ("household_key", "day_no", "coupon_upc"),
}


def bronze_checks(batch: str | None = None, day: int | str | None = None, week: int | str | None = None) -> dict[str, Check]:
    """19 checks, keyed qb1..qb19."""
    scope = _batch_scope("BatchID", batch)
    checks: list[Check] = []

    def ident(table: str, rule: str) -> tuple[str, str, str, str]:
        return f"DQ_BRONZE_{table.upper()}_{rule.upper()}", "BRONZE", f"bronze.{table}", f"{table}_{rule}"

    for table in (
        "transaction_data_raw", "coupon_redemption_raw", "product_raw", "household_demographic_raw",
        "campaign_desc_raw", "campaign_target_raw", "coupon_raw", "causal_data_raw",
    ):
        optional = table == "coupon_redemption_raw"  # a day may have no redemption
        checks.append(
            NotEmpty(
                *ident(table, "not_empty"), RECONCILIATION, WARNING if optional else CRITICAL,
                f"{table} has rows for the batch", scope, "WARN" if optional else "FAIL",
            )
        )
    for table, columns in _BRONZE_REQUIRED.items():
        checks.append(
            RowRule(
                *ident(table, "required_fields"), BUSINESS_RULE, WARNING,
                f"{', '.join(columns)} are given; rows without them are rejected in Silver", scope, "WARN",
                bad=_null(*columns),
            )
        )
    for table in _BRONZE_REQUIRED:
        checks.append(
            RowRule(
                *ident(table, "process_day"), BUSINESS_RULE, ERROR, "rows belong to the batch's day", scope,
                bad=_other("day_no", day),
            )
        )
    checks.append(
        RowRule(
            *ident("causal_data_raw", "process_week"), BUSINESS_RULE, ERROR, "rows belong to the batch's week", scope,
            bad=_other("week_no", week),
        )
    )
    for table in _BRONZE_REQUIRED:
        checks.append(
            RowRule(
                *ident(table, "lineage"), BUSINESS_RULE, CRITICAL, "lineage columns are filled", scope,
                bad=_null("SourceFile", "SourceSystem", "BatchID", "ProcessDate", "ETLTime", "RecordHash"),
            )
        )
    for table in ("transaction_data_raw", "coupon_redemption_raw", "campaign_target_raw", "causal_data_raw"):
        checks.append(
            Unique(
                *ident(table, "duplicates"), UNIQUENESS, WARNING, "copies of a record are dropped in Silver", scope,
                "WARN", keys=("RecordHash",),
            )
        )
    return {f"qb{i}": c for i, c in enumerate(checks, 1)}


# --- Silver: our rules ------------------------------------------------------------------------
_SILVER_KEYS = {
    "transaction_clean": ("basket_id", "day_no", "product_id"),
    "coupon_redemption_clean": ("household_key", "day_no", "coupon_upc"),
    "product_clean": ("product_id",),
    "household_demographic_clean": ("household_key",),
    "campaign_clean": ("campaign_id",),
    "campaign_target_clean": ("household_key", "campaign_id"),
    "coupon_product_clean": ("coupon_upc", "product_id"),
    "promotion_weekly_clean": ("product_id", "store_id", "week_no"),
}
_SILVER_UNIQUE = {
    "transaction_clean": ("RecordHash",),
    "coupon_redemption_clean": ("RecordHash",),
    "product_clean": ("product_id",),
    "household_demographic_clean": ("household_key",),
    "campaign_clean": ("campaign_id",),
    "campaign_target_clean": ("household_key", "campaign_id"),
    "coupon_product_clean": ("RecordHash",),
    "promotion_weekly_clean": ("RecordHash",),
}


def silver_checks(batch: str | None = None) -> dict[str, Check]:
    """21 checks, keyed qs1..qs21."""
    scope = _batch_scope("SourceBatchID", batch)
    checks: list[Check] = []

    def ident(table: str, rule: str) -> tuple[str, str, str, str]:
        return f"DQ_SILVER_{table.upper()}_{rule.upper()}", "SILVER", f"silver.{table}", f"{table}_{rule}"

    for table, keys in _SILVER_KEYS.items():
        checks.append(
            RowRule(
                *ident(table, "keys_present"), BUSINESS_RULE, CRITICAL, f"{', '.join(keys)} are given", scope,
                bad=_null(*keys),
            )
        )
    for table, keys in _SILVER_UNIQUE.items():
        checks.append(
            Unique(
                *ident(table, "unique"), UNIQUENESS, CRITICAL, f"one row per {', '.join(keys)}", scope, keys=keys
            )
        )
    checks.append(
        RowRule(
            *ident("campaign_clean", "day_range"), BUSINESS_RULE, ERROR, "a campaign does not end before it starts",
            scope, bad="start_day > end_day",
        )
    )
    for table, column, other, severity in (
        ("transaction_clean", "product_id", "product_clean", ERROR),
        ("transaction_clean", "household_key", "household_demographic_clean", WARNING),
        ("coupon_redemption_clean", "campaign_id", "campaign_clean", ERROR),
        ("campaign_target_clean", "campaign_id", "campaign_clean", ERROR),
    ):
        checks.append(
            References(
                *ident(table, f"{column}_exists"), REFERENTIAL, severity, f"{column} exists in {other}", scope,
                "WARN" if severity == WARNING else "FAIL", links=((column, f"silver.{other}", column),), other_where=scope,
            )
        )
    return {f"qs{i}": c for i, c in enumerate(checks, 1)}


# --- log and reports --------------------------------------------------------------------------
def tables_of(checks: Iterable[Check]) -> list[str]:
    """The tables that the checks read."""
    names = {c.table for c in checks} | {c.source for c in checks if isinstance(c, SameValue)}
    return sorted(names | {other for c in checks if isinstance(c, References) for _, other, _ in c.links})


def _as_log(results: DataFrame) -> DataFrame:
    logged = {"DQLogID": F.concat_ws("_", "BatchID", "CheckID"), "ETLTime": F.current_timestamp()}
    return conform(results.withColumns(logged), AUDIT["data_quality_log"])


def run_checks(checks: Iterable[Check], tables: dict[str, DataFrame], batch: str, packed: bool = False) -> DataFrame:
    """Evaluate the checks as log rows of one batch."""
    return _as_log(evaluate(list(checks), tables, packed=packed).withColumn("BatchID", F.lit(batch)))


def run_checks_of_all(
    snapshot: DataFrame, tables: dict[str, DataFrame], batches: DataFrame, daily_tables: dict[str, DataFrame], grain: dict[str, str], batch: str
) -> DataFrame:
    """All 85 checks of the snapshot (one row with BatchID, ProcessDay and ProcessWeek) and of every batch in
    `batches`, as log rows. All rows of the tables are those of `batch`; the load log has rows of every batch, and
    a batch checks its own. What a day's checks read of a table is counted in the same pass as the snapshot's."""
    scope = {"day": "ProcessDay", "week": "ProcessWeek"}

    def checks(of: str | None, **scope: str) -> dict[str, Check]:
        return {**bronze_checks(of, **scope), **silver_checks(of), **dwh_checks(of, **scope), **mart_checks(of, **scope)}

    own = {key: c for key, c in checks(None, **scope).items() if c.table == LOAD_LOG}
    columns = ("BatchID", "ProcessDay", "ProcessWeek")
    runs = [
        Run(list(checks(batch).values()), tables, snapshot.select(*columns), {}),
        Run(list((checks(batch, **scope) | own).values()), daily_tables, batches.select(*columns), grain),
    ]
    return _as_log(evaluate_runs(runs, packed=True))


def process_day_checks() -> list[Check]:
    """The five checks that a batch holds only rows of its own day or week, over the column that says
    for which day or week a row was delivered."""
    scope = {"day": "ProcessDay", "week": "ProcessWeek"}
    raw, mart = bronze_checks(**scope), mart_checks(**scope)
    return [raw["qb11"], raw["qb12"], raw["qb13"], mart["qm5"], mart["qm6"]]


def detail_report(dq_log: DataFrame, layer: str) -> DataFrame:
    """Checks of a layer, failures first."""
    return dq_log.filter(F.col("LayerName") == layer).orderBy(status_order(), "TableName", "CheckName")


def status_report(dq_log: DataFrame) -> DataFrame:
    return dq_log.groupBy("LayerName", "CheckStatus").agg(F.count("*").alias("CheckCount"))


def critical_failures(dq_log: DataFrame) -> DataFrame:
    return dq_log.filter(check_blocks()).agg(F.count("*").alias("CriticalFailureCount"))


def duplicate_targets(targets: DataFrame) -> DataFrame:
    """Campaign and household pairs that occur more than once in the target fact."""
    pairs = targets.groupBy("CampaignKey", "HouseholdKey").agg(F.count("*").alias("DuplicateCount"))
    return pairs.filter("DuplicateCount > 1")


def surplus_targets(targets: DataFrame) -> DataFrame:
    extra = F.coalesce(F.sum(F.col("DuplicateCount") - 1), F.lit(0))
    return duplicate_targets(targets).agg(extra.alias("ExtraDuplicateRows"))
