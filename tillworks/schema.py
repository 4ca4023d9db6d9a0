"""Table schemas of every layer, and the names that the layers share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

ID = T.DecimalType(10, 0)
LONG_ID = T.DecimalType(20, 0)
MONEY = T.DecimalType(18, 4)
MART_MONEY = T.DecimalType(20, 4)
RATE = T.DecimalType(18, 6)
UNITS = T.DecimalType(18, 0)
ROWS = T.DecimalType(20, 0)
TEXT = T.StringType()
BIGINT = T.LongType()
FLAG = T.BooleanType()
DATE = T.DateType()
STAMP = T.TimestampType()

# Key and attribute text of the row that stands for "no such member".
UNKNOWN_KEY = -1
UNKNOWN_TEXT = "UNKNOWN"
SYSTEM_BATCH = "SYSTEM"


def struct(columns: dict[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns.items()])


# --- sources: header in the CSV file -> (column here, type) -------------------------------
SOURCES: dict[str, dict[str, tuple[str, T.DataType]]] = {
    "transaction_data": {
        "household_key": ("household_key", ID),
        "BASKET_ID": ("basket_id", LONG_ID),
        "DAY": ("day_no", ID),
        "PRODUCT_ID": ("product_id", ID),
        "QUANTITY": ("quantity", MONEY),
        "SALES_VALUE": ("sales_value", MONEY),
        "STORE_ID": ("store_id", ID),
        "RETAIL_DISC": ("retail_disc", MONEY),
        "TRANS_TIME": ("trans_time", ID),
        "WEEK_NO": ("week_no", ID),
        "COUPON_DISC": ("coupon_disc", MONEY),
        "COUPON_MATCH_DISC": ("coupon_match_disc", MONEY),
    },
    "coupon_redempt": {
        "household_key": ("household_key", ID),
        "DAY": ("day_no", ID),
        "COUPON_UPC": ("coupon_upc", LONG_ID),
        "CAMPAIGN": ("campaign_id", ID),
    },
    "product": {
        "PRODUCT_ID": ("product_id", ID),
        "MANUFACTURER": ("manufacturer", ID),
        "DEPARTMENT": ("department", TEXT),
        "BRAND": ("brand", TEXT),
        "COMMODITY_DESC": ("commodity_desc", TEXT),
        "SUB_COMMODITY_DESC": ("sub_commodity_desc", TEXT),
        "CURR_SIZE_OF_PRODUCT": ("curr_size_of_product", TEXT),
    },
    "hh_demographic": {
        "AGE_DESC": ("age_desc", TEXT),
        "MARITAL_STATUS_CODE": ("marital_status_code", TEXT),
        "INCOME_DESC": ("income_desc", TEXT),
        "HOMEOWNER_DESC": ("homeowner_desc", TEXT),
        "HH_COMP_DESC": ("hh_comp_desc", TEXT),
        "HOUSEHOLD_SIZE_DESC": ("household_size_desc", TEXT),
        "KID_CATEGORY_DESC": ("kid_category_desc", TEXT),
        "household_key": ("household_key", ID),
    },
    "campaign_desc": {
        "DESCRIPTION": ("description", TEXT),
        "CAMPAIGN": ("campaign_id", ID),
        "START_DAY": ("start_day", ID),
        "END_DAY": ("end_day", ID),
    },
    "campaign_table": {
        "DESCRIPTION": ("description", TEXT),
        "household_key": ("household_key", ID),
        "CAMPAIGN": ("campaign_id", ID),
    },
    "coupon": {
        "COUPON_UPC": ("coupon_upc", LONG_ID),
        "PRODUCT_ID": ("product_id", ID),
        "CAMPAIGN": ("campaign_id", ID),
    },
    "causal_data": {
        "PRODUCT_ID": ("product_id", ID),
        "STORE_ID": ("store_id", ID),
        "WEEK_NO": ("week_no", ID),
        "display": ("display_code", TEXT),
        "mailer": ("mailer_code", TEXT),
    },
}

# Bronze table of each source.
BRONZE_TABLE = {
    "transaction_data": "transaction_data_raw",
    "coupon_redempt": "coupon_redemption_raw",
    "product": "product_raw",
    "hh_demographic": "household_demographic_raw",
    "campaign_desc": "campaign_desc_raw",
    "campaign_table": "campaign_target_raw",
    "coupon": "coupon_raw",
    "causal_data": "causal_data_raw",
}


def source_columns(source: str) -> list[str]:
    return [name for name, _ in SOURCES[source].values()]


LINEAGE = {
    "SourceFile": TEXT,
    "SourceSystem": TEXT,
    "BatchID": TEXT,
    "ProcessDate": DATE,
    "ETLTime": STAMP,
    "RecordHash": TEXT,
}
CLEAN_LINEAGE = {"SourceBatchID": TEXT, "ProcessDate": DATE, "ETLTime": STAMP, "RecordHash": TEXT}

BRONZE = {
    BRONZE_TABLE[s]: struct({**dict(cols.values()), **LINEAGE}) for s, cols in SOURCES.items()
}


def _columns(source: str) -> dict[str, T.DataType]:
    return dict(SOURCES[source].values())


SILVER = {
    "transaction_clean": struct(
        {**_columns("transaction_data"), "net_sales_value": MONEY, "has_coupon": TEXT, **CLEAN_LINEAGE},
        ("basket_id", "day_no", "product_id"),
    ),
    "coupon_redemption_clean": struct(
        {**_columns("coupon_redempt"), **CLEAN_LINEAGE}, ("household_key", "day_no", "coupon_upc")
    ),
    "product_clean": struct({**_columns("product"), **CLEAN_LINEAGE}, ("product_id",)),
    "household_demographic_clean": struct(
        {**_columns("hh_demographic"), **CLEAN_LINEAGE}, ("household_key",)
    ),
    "campaign_clean": struct(
        {**_columns("campaign_desc"), "campaign_duration": ID, **CLEAN_LINEAGE}, ("campaign_id",)
    ),
    "campaign_target_clean": struct(
        {**_columns("campaign_table"), **CLEAN_LINEAGE}, ("household_key", "campaign_id")
    ),
    "coupon_product_clean": struct(
        {**_columns("coupon"), **CLEAN_LINEAGE}, ("coupon_upc", "product_id")
    ),
    "promotion_weekly_clean": struct(
        {**_columns("causal_data"), "has_display": TEXT, "has_mailer": TEXT, **CLEAN_LINEAGE},
        ("product_id", "store_id", "week_no"),
    ),
}

_DIM_TAIL = {
    "IsCurrent": FLAG,
    "SourceBatchID": TEXT,
    "CreatedAt": STAMP,
    "UpdatedAt": STAMP,
    "RecordHash": TEXT,
}
DIMENSION_COLUMNS: dict[str, dict[str, T.DataType]] = {
    "dim_product": {
        "ProductID": ID,
        "Manufacturer": ID,
        "Department": TEXT,
        "Brand": TEXT,
        "CommodityDescription": TEXT,
        "SubCommodityDescription": TEXT,
        "CurrentProductSize": TEXT,
    },
    "dim_household": {
        "HouseholdID": ID,
        "AgeDescription": TEXT,
        "MaritalStatusCode": TEXT,
        "IncomeDescription": TEXT,
        "HomeownerDescription": TEXT,
        "HouseholdCompositionDescription": TEXT,
        "HouseholdSizeDescription": TEXT,
        "KidCategoryDescription": TEXT,
    },
    "dim_campaign": {
        "CampaignID": ID,
        "CampaignDescription": TEXT,
        "StartDay": ID,
        "EndDay": ID,
        "CampaignDuration": ID,
    },
    "dim_store": {"StoreID": ID},
    "dim_coupon": {"CouponUPC": LONG_ID, "CampaignID": ID},
    "dim_day": {"DayNumber": ID, "WeekNumber": ID},
}
SURROGATE_KEY = {
    "dim_product": "ProductKey",
    "dim_household": "HouseholdKey",
    "dim_campaign": "CampaignKey",
    "dim_store": "StoreKey",
    "dim_coupon": "CouponKey",
    "dim_day": "DayKey",
}
NATURAL_KEY = {name: next(iter(cols)) for name, cols in DIMENSION_COLUMNS.items()}
DIMENSIONS = {
    name: struct({SURROGATE_KEY[name]: BIGINT, **cols, **_DIM_TAIL})
    for name, cols in DIMENSION_COLUMNS.items()
}

_FACT_TAIL = {"SourceBatchID": TEXT, "ProcessDate": DATE, "CreatedAt": STAMP, "RecordHash": TEXT}
FACTS = {
    "fact_sales_transaction": struct(
        {
            "HouseholdKey": BIGINT,
            "ProductKey": BIGINT,
            "StoreKey": BIGINT,
            "DayKey": BIGINT,
            "BasketID": LONG_ID,
            "TransactionTime": ID,
            "WeekNumber": ID,
            "Quantity": MONEY,
            "GrossSalesAmount": MONEY,
            "RetailDiscountAmount": MONEY,
            "CouponDiscountAmount": MONEY,
            "CouponMatchDiscountAmount": MONEY,
            "TotalDiscountAmount": MONEY,
            "NetSalesAmount": MONEY,
            "HasCoupon": TEXT,
            **_FACT_TAIL,
        }
    ),
    "fact_coupon_redemption": struct(
        {
            "HouseholdKey": BIGINT,
            "CouponKey": BIGINT,
            "CampaignKey": BIGINT,
            "DayKey": BIGINT,
            "RedemptionCount": UNITS,
            **_FACT_TAIL,
        }
    ),
    "fact_campaign_target": struct(
        {"HouseholdKey": BIGINT, "CampaignKey": BIGINT, "TargetCount": UNITS, **_FACT_TAIL}
    ),
    "fact_promotion_weekly": struct(
        {
            "ProductKey": BIGINT,
            "StoreKey": BIGINT,
            "WeekNumber": ID,
            "DisplayCode": TEXT,
            "MailerCode": TEXT,
            "HasDisplay": TEXT,
            "HasMailer": TEXT,
            "PromotionCount": UNITS,
            **_FACT_TAIL,
        }
    ),
}

_MART_TAIL = {"SourceBatchID": TEXT, "ProcessDate": DATE, "CreatedAt": STAMP}
_SALES_SUMS = {
    "TotalQuantity": MART_MONEY,
    "GrossSalesAmount": MART_MONEY,
    "TotalDiscountAmount": MART_MONEY,
    "NetSalesAmount": MART_MONEY,
}
MARTS = {
    "dm_daily_sales": struct(
        {
            "DayKey": BIGINT,
            "DayNumber": ID,
            "WeekNumber": ID,
            "BasketCount": BIGINT,
            "HouseholdCount": BIGINT,
            "ProductCount": BIGINT,
            "StoreCount": BIGINT,
            **_SALES_SUMS,
            "CouponTransactionCount": BIGINT,
            "AverageBasketAmount": MART_MONEY,
            "DiscountRate": RATE,
            **_MART_TAIL,
        }
    ),
    "dm_product_sales": struct(
        {
            "ProductKey": BIGINT,
            "ProductID": ID,
            "Department": TEXT,
            "Brand": TEXT,
            "CommodityDescription": TEXT,
            "BasketCount": BIGINT,
            "HouseholdCount": BIGINT,
            "StoreCount": BIGINT,
            **_SALES_SUMS,
            "CouponTransactionCount": BIGINT,
            "AverageUnitNetSales": MART_MONEY,
            "DiscountRate": RATE,
            **_MART_TAIL,
        }
    ),
    "dm_campaign_performance": struct(
        {
            "CampaignKey": BIGINT,
            "CampaignID": ID,
            "CampaignDescription": TEXT,
            "StartDay": ID,
            "EndDay": ID,
            "CampaignDuration": ID,
            "TargetHouseholdCount": BIGINT,
            "RedeemingHouseholdCount": BIGINT,
            "RedemptionCount": BIGINT,
            "DistinctCouponCount": BIGINT,
            "RedemptionRate": RATE,
            **_MART_TAIL,
        }
    ),
    "dm_promotion_performance": struct(
        {
            "ProductKey": BIGINT,
            "ProductID": ID,
            "StoreKey": BIGINT,
            "StoreID": ID,
            "WeekNumber": ID,
            "HasDisplay": TEXT,
            "HasMailer": TEXT,
            "PromotionCount": BIGINT,
            "BasketCount": BIGINT,
            **_SALES_SUMS,
            "AverageBasketAmount": MART_MONEY,
            **_MART_TAIL,
        }
    ),
}

CONTROL = {
    "etl_batch_control": struct(
        {
            "BatchID": TEXT,
            "ProcessDate": DATE,
            "ProcessDay": ID,
            "ProcessWeek": ID,
            "LoadMode": TEXT,
            "BatchStatus": TEXT,
            "StartTime": STAMP,
            "EndTime": STAMP,
            "TriggerType": TEXT,
            "TriggeredBy": TEXT,
            "ErrorMessage": TEXT,
            "ETLTime": STAMP,
        },
        ("BatchID", "ProcessDate", "LoadMode", "BatchStatus", "StartTime", "ETLTime"),
    ),
    "source_watermark": struct(
        {
            "SourceName": TEXT,
            "WatermarkType": TEXT,
            "LastProcessValue": ROWS,
            "LastProcessDate": DATE,
            "LastSuccessfulBatchID": TEXT,
            "LastSuccessTime": STAMP,
            "IsActive": TEXT,
            "ETLTime": STAMP,
        },
        ("SourceName", "WatermarkType", "IsActive", "ETLTime"),
    ),
}
AUDIT = {
    "etl_table_load_log": struct(
        {
            "ETLLogID": TEXT,
            "BatchID": TEXT,
            "LayerName": TEXT,
            "SourceName": TEXT,
            "SourceFile": TEXT,
            "TargetTableName": TEXT,
            "LoadStrategy": TEXT,
            "ProcessDate": DATE,
            "ProcessValue": ROWS,
            "StartTime": STAMP,
            "EndTime": STAMP,
            "SourceRowCount": ROWS,
            "InsertedRowCount": ROWS,
            "UpdatedRowCount": ROWS,
            "DeletedRowCount": ROWS,
            "RejectedRowCount": ROWS,
            "UnchangedRowCount": ROWS,
            "LoadStatus": TEXT,
            "ErrorMessage": TEXT,
            "ETLTime": STAMP,
        },
        ("ETLLogID", "BatchID", "LayerName", "TargetTableName", "LoadStrategy", "StartTime", "LoadStatus", "ETLTime"),
    ),
    "data_quality_log": struct(
        {
            "DQLogID": TEXT,
            "BatchID": TEXT,
            "LayerName": TEXT,
            "TableName": TEXT,
            "CheckName": TEXT,
            "CheckCategory": TEXT,
            "SeverityLevel": TEXT,
            "CheckedRowCount": ROWS,
            "PassedRowCount": ROWS,
            "FailedRowCount": ROWS,
            "FailureRate": RATE,
            "CheckStatus": TEXT,
            "CheckDescription": TEXT,
            "ETLTime": STAMP,
        },
        ("DQLogID", "BatchID", "LayerName", "TableName", "CheckName", "CheckCategory", "SeverityLevel", "CheckStatus", "ETLTime"),
    ),
}


# every table by its qualified name
SCHEMAS: dict[str, T.StructType] = {
    **{f"bronze.{n}": s for n, s in BRONZE.items()},
    **{f"silver.{n}": s for n, s in SILVER.items()},
    **{f"dwh.{n}": s for n, s in {**DIMENSIONS, **FACTS}.items()},
    **{f"dm_marketing.{n}": s for n, s in MARTS.items()},
    **{f"control.{n}": s for n, s in CONTROL.items()},
    **{f"audit.{n}": s for n, s in AUDIT.items()},
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in the declared order and type; a column not given is NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
