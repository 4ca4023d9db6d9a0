"""Dashboard tiles: one grouped aggregate over a dataset each, as a declarative registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Tile:
    """`measures` maps output columns to aggregate expressions; `rows` lists plain columns shown
    row by row, without grouping."""

    dataset: str
    dims: tuple[str, ...] = ()
    measures: tuple[tuple[str, str], ...] = ()
    where: str | None = None
    rows: tuple[str, ...] = ()


def _sum(column: str) -> tuple[str, str]:
    return column, f"sum({column})"


def _avg(column: str) -> tuple[str, str]:
    return column, f"avg({column})"


def _distinct(name: str, column: str) -> tuple[str, str]:
    return name, f"count(DISTINCT {column})"


_CUSTOMERS = (_distinct("customers", "household_key"),)

TILES: dict[str, Tile] = {
    # daily sales
    "g01_net_sales": Tile("daily_sales", (), (_sum("NetSalesAmount"),)),
    "g01_gross_sales": Tile("daily_sales", (), (_sum("GrossSalesAmount"),)),
    "g01_baskets": Tile("daily_sales", (), (_sum("BasketCount"),)),
    "g01_households": Tile("daily_sales", (), (_sum("HouseholdCount"),)),
    "g01_average_basket": Tile("daily_sales", (), (_avg("AverageBasketAmount"),)),
    "g01_discount_rate": Tile("daily_sales", (), (_avg("DiscountRate"),)),
    "g02_sales_by_day": Tile("daily_sales", ("DayNumber",), (_sum("NetSalesAmount"), _sum("GrossSalesAmount"))),
    "g02_discount_by_day": Tile(
        "daily_sales", rows=("DayNumber", "GrossSalesAmount", "TotalDiscountAmount", "NetSalesAmount")
    ),
    "g02_sales_by_week": Tile("daily_sales", ("WeekNumber",), (_sum("NetSalesAmount"),)),
    "g02_coupons_by_day": Tile(
        "daily_sales", ("DayNumber",), (_avg("CouponTransactionRate"), _sum("CouponTransactionCount"))
    ),
    # products
    "g03_top_products": Tile("top_10_products", ("CommodityDescription",), (_sum("NetSalesAmount"),)),
    "g04_sales_by_department": Tile("products", ("Department",), (_sum("NetSalesAmount"),)),
    "g04_discount_by_department": Tile("products", ("Department",), (_avg("DiscountRate"),)),
    "g04_discount_against_sales": Tile("products", rows=("DiscountRate", "NetSalesAmount")),
    # campaigns
    "g05_campaigns": Tile("campaigns", (), (_distinct("campaigns", "CampaignID"),)),
    "g05_targeted": Tile("campaigns", (), (_sum("TargetHouseholdCount"),)),
    "g05_redeeming": Tile("campaigns", (), (_sum("RedeemingHouseholdCount"),)),
    "g05_rate": Tile("campaigns", (), (_avg("RedemptionRate"),)),
    "g05_redemptions": Tile("campaigns", (), (_sum("RedemptionCount"),)),
    "g06_median_rate": Tile(
        "campaigns", ("CampaignDescription",), (("RedemptionRate", "percentile_approx(RedemptionRate, 0.5)"),)
    ),
    "g06_targets": Tile(
        "campaigns", ("CampaignDescription",), (_sum("TargetHouseholdCount"), _sum("RedeemingHouseholdCount"))
    ),
    "g06_redemptions": Tile("campaigns", ("CampaignDescription",), (_sum("RedemptionCount"),)),
    "g07_levels": Tile("campaign_levels", ("CampaignPerformanceLevel",), (_sum("CampaignCount"),)),
    # promotions
    "g08_average_basket": Tile("promotions", ("PromotionType",), (_avg("AverageBasketAmount"),)),
    "g08_discount_rate": Tile("promotions", ("PromotionType",), (_avg("DiscountRate"),)),
    "g08_net_sales": Tile("promotions", ("PromotionType",), (_sum("NetSalesAmount"),)),
    # return on discount
    "g09_average_roi": Tile("campaign_roi", (), (_avg("roi_ratio"),)),
    "g09_profit": Tile("campaign_roi", (), (_sum("net_profit"),)),
    "g09_cost": Tile("campaign_roi", (), (_sum("total_discount_cost"),)),
    "g09_net_sales": Tile("campaign_roi", (), (_sum("net_sales"),)),
    "g09_roi_by_campaign": Tile("campaign_roi", ("CampaignDescription",), (_avg("roi_ratio"),)),
    "g09_campaigns_by_band": Tile("campaign_roi", ("roi_category",), (_distinct("campaigns", "CampaignID"),)),
    "g09_cost_by_campaign": Tile("campaign_roi", ("CampaignDescription",), (_sum("total_discount_cost"),)),
    # timing
    "g10_weekday": Tile("timing", ("day_name",), (_sum("net_sales"),)),
    "g10_status": Tile("timing", ("campaign_status",), (_sum("net_sales"),)),
    "g10_month": Tile("timing", ("month_name",), (_sum("net_sales"),)),
    # stores
    "g11_sales": Tile("stores", ("store_id",), (_sum("total_sales"),)),
    "g11_adoption": Tile("stores", ("store_id",), (_avg("campaign_adoption_rate"),)),
    "g11_revenue_per_customer": Tile("stores", ("store_id",), (_avg("revenue_per_customer"),)),
    # categories
    "g12_sales": Tile("categories", ("category",), (_sum("total_sales"),)),
    "g12_promotion_rate": Tile("categories", ("category",), (_avg("promotion_rate"),)),
    "g12_item_value": Tile("categories", ("category",), (_avg("avg_item_value"),)),
    # customer segments
    "g13_customers": Tile("rfm", (), _CUSTOMERS),
    "g13_champions": Tile("rfm", (), _CUSTOMERS, "customer_segment = 'Champions'"),
    "g13_loyal": Tile("rfm", (), _CUSTOMERS, "customer_segment = 'Loyal Customers'"),
    "g13_at_risk": Tile("rfm", (), _CUSTOMERS, "customer_segment = 'At Risk'"),
    "g13_lost": Tile("rfm", (), _CUSTOMERS, "customer_segment = 'Lost'"),
    "g13_average_money": Tile("rfm", (), (_avg("monetary_value"),)),
    "g13_customers_by_segment": Tile("rfm", ("customer_segment",), _CUSTOMERS),
    "g13_money_by_segment": Tile("rfm", ("customer_segment",), (_sum("monetary_value"),)),
    "g13_customers_by_code": Tile("rfm", ("RFM_segment",), _CUSTOMERS),
    # customer groups
    "g14_customers": Tile("behaviour", ("customer_group",), (_sum("customer_count"),)),
    "g14_average_basket": Tile("behaviour", ("customer_group",), (_avg("avg_basket_value"),)),
    "g14_baskets": Tile("behaviour", ("customer_group",), (_sum("total_baskets"),)),
    # batches and checks
    "g15_statuses": Tile("batches", rows=("BatchStatus",)),
    "g15_loads": Tile("batches", (), (_sum("TableLoadCount"),)),
    "g15_failed": Tile("batches", (), (_sum("FailedCount"),)),
    "g15_inserted": Tile("batches", (), (_sum("TotalInsertedRowCount"),)),
    "g15_rejected": Tile("batches", (), (_sum("TotalRejectedRowCount"),)),
    "g15_loads_by_batch": Tile(
        "batches", ("BatchID",), (_sum("SuccessCount"), _sum("WarningCount"), _sum("FailedCount"))
    ),
    "g15_batches_by_status": Tile("batches", ("BatchStatus",), (("batches", "count(BatchID)"),)),
    "g16_checks_by_layer": Tile("checks", ("LayerName",), (_sum("CheckCount"),)),
    "g16_failure_rate_by_layer": Tile("checks", ("LayerName",), (_avg("FailureRate"),)),
    # the older dashboard
    "g17_net_sales": Tile("daily_sales", (), (_sum("NetSalesAmount"),)),
    "g17_gross_sales": Tile("daily_sales", (), (_sum("GrossSalesAmount"),)),
    "g17_baskets": Tile("daily_sales", (), (_sum("BasketCount"),)),
    "g17_average_basket": Tile("daily_sales", (), (_avg("AverageBasketAmount"),)),
    "g17_discount_rate": Tile("daily_sales", (), (_avg("DiscountRate"),)),
    "g17_coupon_rate": Tile("daily_sales", (), (_avg("CouponTransactionRate"),)),
    "g17_sales_rows": Tile("daily_sales", rows=("DayNumber", "NetSalesAmount", "GrossSalesAmount")),
    "g17_discount_rows": Tile(
        "daily_sales", rows=("DayNumber", "GrossSalesAmount", "TotalDiscountAmount", "NetSalesAmount")
    ),
    "g17_row_count": Tile("daily_sales", (), (("row_count", "count(*)"),)),
}


def tile(spec: Tile, dataset: DataFrame) -> DataFrame:
    if spec.where:
        dataset = dataset.filter(spec.where)
    if spec.rows:
        return dataset.select(*spec.rows)
    return dataset.groupBy(*spec.dims).agg(*[F.expr(e).alias(name) for name, e in spec.measures])
