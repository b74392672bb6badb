"""Column names and types of the report exports, the event export and the event log."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
DATE = T.DateType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
STRING = T.StringType()

# Export headers (lower case, letters and digits only) and the column each one becomes.
SEARCH_KEYWORD_COLUMNS = {
    "day": ("date", DATE),
    "dayofweek": ("day_of_week", STRING),
    "keyword": ("keyword", STRING),
    "keywordstate": ("keyword_state", STRING),
    "campaignid": ("campaign_id", LONG),
    "campaign": ("campaign_name", STRING),
    "adgroupid": ("ad_group_id", LONG),
    "adgroup": ("ad_group_name", STRING),
    "cost": ("cost", MONEY),
    "networkwithsearchpartners": ("network", STRING),
    "searchimprshare": ("est_search_impression_share", DOUBLE),
    "searchlostisrank": ("est_search_impression_share_lost_rank", DOUBLE),
    "device": ("device", STRING),
    "impressions": ("impressions", LONG),
    "clicks": ("clicks", LONG),
    "position": ("average_position", DOUBLE),
    "qualityscore": ("quality_score", DOUBLE),
    "landingpageexperience": ("landing_page_experience", STRING),
    "matchtype": ("match_type", STRING),
}
CAMPAIGN_COLUMNS = {
    "day": ("date", DATE),
    "dayofweek": ("day_of_week", STRING),
    "campaignstate": ("campaign_state", STRING),
    "campaignid": ("campaign_id", LONG),
    "campaign": ("campaign_name", STRING),
    "cost": ("cost", MONEY),
    "networkwithsearchpartners": ("network", STRING),
    "searchimprshare": ("est_search_impression_share", DOUBLE),
    "searchlostisrank": ("est_search_impression_share_lost_rank", DOUBLE),
    "searchlostisbudget": ("est_search_impression_share_lost_budget", DOUBLE),
    "device": ("device", STRING),
    "budget": ("budget", MONEY),
    "impressions": ("impressions", LONG),
    "clicks": ("clicks", LONG),
    "position": ("average_position", DOUBLE),
}
BING_KEYWORD_COLUMNS = {
    "gregoriandate": ("date", DATE),
    "keywordid": ("keyword_id", LONG),
    "keyword": ("keyword", STRING),
    "keywordstatus": ("keyword_state", STRING),
    "campaignid": ("campaign_id", LONG),
    "campaignname": ("campaign_name", STRING),
    "adgroupid": ("ad_group_id", LONG),
    "adgroup": ("ad_group_name", STRING),
    "spend": ("cost", MONEY),
    "devicetype": ("device", STRING),
    "impressions": ("impressions", LONG),
    "clicks": ("clicks", LONG),
    "avgposition": ("average_position", DOUBLE),
    "qualityscore": ("quality_score", DOUBLE),
    "deliveredmatchtype": ("match_type", STRING),
}

# Properties of an order-conversion event. A leading "$" becomes "x_" in the flat table.
EVENT_PROPERTIES = T.StructType(
    [T.StructField("time", LONG)]
    + [
        T.StructField(name, STRING)
        for name in (
            "distinct_id",
            "id",
            "orderId",
            "latest_ad_utm_source",
            "latest_ad_utm_medium",
            "latest_ad_utm_campaign",
            "latest_ad_awkeyword",
            "latest_ad_awadgroupid",
            "latest_ad_awmatchtype",
            "latest_ad_device",
            "latest_ad_awcreativeid",
            "latest_ad_awnetwork",
            "latest_ad_awposition",
            "latest_ad_psgeo",
            "latest_ad_search",
            "$browser",
            "$browser_version",
            "$city",
            "$created",
            "$current_url",
            "$device",
            "$email",
            "$first_name",
            "$initial_referrer",
            "$initial_referring_domain",
            "$last_name",
            "$lib_version",
            "$name",
            "$os",
            "$referrer",
            "$referring_domain",
            "$region",
            "$screen_height",
            "$screen_width",
            "$search_engine",
            "currency",
            "discount",
            "lastOrderedFrom",
            "mp_country_code",
            "mp_keyword",
            "mp_lib",
            "products",
            "tax",
            "total",
            "traits",
            "utm_campaign",
            "utm_content",
            "utm_medium",
            "utm_source",
        )
    ]
)
EVENT = T.StructType([T.StructField("event", STRING), T.StructField("properties", EVENT_PROPERTIES)])

# What an event log does not keep (raw times, tracking internals and personal data).
TRACKING_COLUMNS = (
    "transaction_date",
    "event",
    "time",
    "distinct_id",
    "x_created",
    "x_email",
    "x_first_name",
    "x_last_name",
    "x_lib_version",
    "x_name",
    "currency",
    "discount",
    "mp_country_code",
    "mp_lib",
    "products",
    "tax",
    "total",
    "lastOrderedFrom",
    "utm_content",
    "mp_keyword",
    "traits",
)
