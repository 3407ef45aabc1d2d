"""The stream schemas and schema-drift tolerant alignment.

Field names, types, defaults and enum symbols below are fixed values: they are
the record layout producers write. Times are epoch milliseconds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Every stream's record as Spark DDL.
STREAM_DDL: dict[str, str] = {
    "customer-profile": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        eventType string NOT NULL,
        firstName string,
        lastName string,
        email string,
        phone string,
        dateOfBirth string,
        gender string,
        countryCode string NOT NULL,
        locale string NOT NULL,
        marketId string,
        distributorId string,
        registrationSource string NOT NULL,
        metadata map<string,string> NOT NULL
    """,
    "customer-preferences": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        skinType string NOT NULL,
        skinConcerns array<string> NOT NULL,
        preferredProductLines array<string> NOT NULL,
        dietaryRestrictions array<string> NOT NULL,
        allergies array<string> NOT NULL,
        preferredNotificationChannel string NOT NULL,
        optInMarketing boolean NOT NULL,
        languagePreference string NOT NULL,
        metadata map<string,string> NOT NULL
    """,
    "customer-consent": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        consentId string NOT NULL,
        consentType string NOT NULL,
        granted boolean NOT NULL,
        version string NOT NULL,
        ipAddress string,
        userAgent string,
        countryCode string NOT NULL,
        expiresAt bigint,
        metadata map<string,string> NOT NULL
    """,
    "customer-loyalty": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        eventType string NOT NULL,
        pointsDelta int NOT NULL,
        pointsBalance int NOT NULL,
        tier string NOT NULL,
        sourceOrderId string,
        sourceScanId string,
        metadata map<string,string> NOT NULL
    """,
    "customer-sessions": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        sessionId string NOT NULL,
        eventType string NOT NULL,
        platform string NOT NULL,
        appVersion string,
        deviceModel string,
        osVersion string,
        sessionDurationMs bigint,
        screenCount int,
        metadata map<string,string> NOT NULL
    """,
    "scan-session": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        scanId string NOT NULL,
        sessionId string,
        deviceId string NOT NULL,
        deviceFirmware string,
        scanType string NOT NULL,
        status string NOT NULL,
        lightingScore float,
        motionScore float,
        scanDurationMs bigint,
        countryCode string NOT NULL,
        metadata map<string,string> NOT NULL
    """,
    "scan-facial": """
        customerId string NOT NULL,
        scanId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        faceConfidence float,
        faceWidth float,
        faceHeight float,
        symmetryScore float,
        skinToneLabel string,
        skinToneITA float,
        facialRegionsAnalysed array<string> NOT NULL,
        landmarkCount int,
        metadata map<string,string> NOT NULL
    """,
    "scan-hydration": """
        customerId string NOT NULL,
        scanId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        overallHydrationScore float,
        hydrationLabel string NOT NULL,
        zoneScores map<string,float> NOT NULL,
        tewlValue float,
        recommendedIntakeGlasses int,
        metadata map<string,string> NOT NULL
    """,
    "scan-pigmentation": """
        customerId string NOT NULL,
        scanId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        overallPigmentationScore float,
        darkSpotsCount int,
        darkSpotsArea float,
        uvSpotsCount int,
        melasmaScore float,
        zoneScores map<string,float> NOT NULL,
        melaninIndex float,
        metadata map<string,string> NOT NULL
    """,
    "scan-texture": """
        customerId string NOT NULL,
        scanId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        overallTextureScore float,
        poreScore float,
        poreCount int,
        poreAvgDiameterMicrons float,
        roughnessScore float,
        smoothnessScore float,
        zoneScores map<string,float> NOT NULL,
        metadata map<string,string> NOT NULL
    """,
    "scan-wrinkles": """
        customerId string NOT NULL,
        scanId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        overallWrinkleScore float,
        wrinkleGrade string NOT NULL,
        fineLinesCount int,
        deepLinesCount int,
        crowsFeetScore float,
        foreheadLinesScore float,
        nasolabialScore float,
        zoneScores map<string,float> NOT NULL,
        estimatedSkinAge int,
        metadata map<string,string> NOT NULL
    """,
    "scan-radiance": """
        customerId string NOT NULL,
        scanId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        radianceScore float,
        clarityScore float,
        glossScore float,
        luminosityL float,
        colorA float,
        colorB float,
        zoneScores map<string,float> NOT NULL,
        metadata map<string,string> NOT NULL
    """,
    "scan-overall": """
        customerId string NOT NULL,
        scanId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        overallSkinScore float,
        hydrationScore float,
        pigmentationScore float,
        textureScore float,
        wrinkleScore float,
        radianceScore float,
        skinAgeEstimate int,
        topConcerns array<string> NOT NULL,
        improvementSinceLastScan float,
        metadata map<string,string> NOT NULL
    """,
    "product-catalog": """
        productId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        eventType string NOT NULL,
        sku string NOT NULL,
        name string NOT NULL,
        productLine string,
        category string,
        targetSkinConcerns array<string> NOT NULL,
        targetSkinTypes array<string> NOT NULL,
        keyIngredients array<string> NOT NULL,
        marketIds array<string> NOT NULL,
        priceUSD double,
        imageUrl string,
        isActive boolean NOT NULL,
        metadata map<string,string> NOT NULL
    """,
    "product-recommendations": """
        customerId string NOT NULL,
        scanId string,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        recommendationId string NOT NULL,
        recommendationSource string NOT NULL,
        products array<struct<productId:string,rank:int,score:float,reasons:array<string>,targetConcern:string>> NOT NULL,
        expiresAt bigint,
        metadata map<string,string> NOT NULL
    """,
    "product-interactions": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        sessionId string,
        productId string NOT NULL,
        interactionType string NOT NULL,
        recommendationId string,
        durationMs bigint,
        metadata map<string,string> NOT NULL
    """,
    "commerce-orders": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        orderId string NOT NULL,
        eventType string NOT NULL,
        channel string NOT NULL,
        lineItems array<struct<productId:string,sku:string,quantity:int,unitPrice:double,currency:string>> NOT NULL,
        totalAmount double NOT NULL,
        currency string NOT NULL,
        pointsEarned int,
        couponCode string,
        scanId string,
        marketId string,
        metadata map<string,string> NOT NULL
    """,
    "commerce-returns": """
        customerId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        returnId string NOT NULL,
        orderId string NOT NULL,
        eventType string NOT NULL,
        returnedItems array<struct<productId:string,quantity:int,reason:string>> NOT NULL,
        refundAmount double,
        currency string NOT NULL,
        metadata map<string,string> NOT NULL
    """,
    "device-telemetry": """
        deviceId string NOT NULL,
        schemaVersion int NOT NULL,
        eventTime bigint NOT NULL,
        eventType string NOT NULL,
        firmwareVersion string,
        batteryLevel int,
        storageUsedMb bigint,
        wifiSignalDbm int,
        cpuTempCelsius float,
        cameraStatus string NOT NULL,
        lightStatus string NOT NULL,
        locationId string,
        associatedCustomerId string,
        errorCode string,
        errorMessage string,
        metadata map<string,string> NOT NULL
    """,
}
STREAM_KEYS = tuple(STREAM_DDL)

# Defaults that are not the empty array or map and not ``schemaVersion`` = 1.
SCHEMA_DEFAULTS: dict[str, dict[str, object]] = {
    "customer-profile": {"eventType": "CREATED", "countryCode": "US", "locale": "en-US", "registrationSource": "UNKNOWN"},
    "customer-preferences": {
        "skinType": "UNKNOWN", "preferredNotificationChannel": "PUSH", "optInMarketing": False, "languagePreference": "en",
    },
    "customer-consent": {"consentType": "DATA_PROCESSING", "countryCode": "US"},
    "customer-loyalty": {"eventType": "POINTS_EARNED", "tier": "BRONZE"},
    "customer-sessions": {"eventType": "STARTED", "platform": "UNKNOWN"},
    "scan-session": {"scanType": "FULL_FACE", "status": "INITIATED", "countryCode": "US"},
    "scan-hydration": {"hydrationLabel": "UNKNOWN"},
    "scan-wrinkles": {"wrinkleGrade": "UNKNOWN"},
    "product-catalog": {"eventType": "UPSERT", "isActive": True},
    "product-recommendations": {"recommendationSource": "SCAN_RESULTS"},
    "product-interactions": {"interactionType": "VIEW"},
    "commerce-orders": {"eventType": "PLACED", "channel": "APP", "currency": "USD"},
    "commerce-returns": {"eventType": "REQUESTED", "currency": "USD"},
    "device-telemetry": {"eventType": "HEARTBEAT", "cameraStatus": "UNKNOWN", "lightStatus": "UNKNOWN"},
}

SCHEMA_ENUMS: dict[str, dict[str, list[str]]] = {
    "customer-profile": {
        "eventType": ["CREATED", "UPDATED", "DELETED", "REACTIVATED", "ANONYMISED"],
        "registrationSource": ["APP", "WEB", "IN_STORE", "DISTRIBUTOR", "UNKNOWN"],
    },
    "customer-preferences": {
        "skinType": ["NORMAL", "DRY", "OILY", "COMBINATION", "SENSITIVE", "UNKNOWN"],
        "preferredNotificationChannel": ["EMAIL", "PUSH", "SMS", "IN_APP", "NONE"],
    },
    "customer-consent": {
        "consentType": [
            "DATA_PROCESSING", "MARKETING_EMAIL", "MARKETING_PUSH", "DATA_SHARING_PARTNERS",
            "BIOMETRIC_SCAN", "ANALYTICS", "ALL",
        ],
    },
    "customer-loyalty": {
        "eventType": ["POINTS_EARNED", "POINTS_REDEEMED", "TIER_UPGRADED", "TIER_DOWNGRADED", "POINTS_EXPIRED", "ENROLLED"],
        "tier": ["BRONZE", "SILVER", "GOLD", "PLATINUM", "AMBASSADOR"],
    },
    "customer-sessions": {
        "eventType": ["STARTED", "RESUMED", "ENDED", "TIMED_OUT"],
        "platform": ["IOS", "ANDROID", "WEB", "KIOSK", "UNKNOWN"],
    },
    "scan-session": {
        "scanType": ["FULL_FACE", "LEFT_CHEEK", "RIGHT_CHEEK", "FOREHEAD", "UNDER_EYES", "QUICK", "CALIBRATION"],
        "status": ["INITIATED", "PROCESSING", "COMPLETED", "FAILED", "CANCELLED"],
    },
    "scan-hydration": {
        "hydrationLabel": ["VERY_DRY", "DRY", "NORMAL", "HYDRATED", "VERY_HYDRATED", "UNKNOWN"],
    },
    "scan-wrinkles": {
        "wrinkleGrade": ["NONE", "MILD", "MODERATE", "DEEP", "UNKNOWN"],
    },
    "product-catalog": {
        "eventType": ["UPSERT", "DELETED", "ACTIVATED", "DISCONTINUED"],
    },
    "product-recommendations": {
        "recommendationSource": ["SCAN_RESULTS", "PURCHASE_HISTORY", "COLLABORATIVE_FILTER", "RULE_BASED", "MANUAL_OVERRIDE"],
    },
    "product-interactions": {
        "interactionType": [
            "VIEW", "DETAIL_VIEW", "ADD_TO_CART", "REMOVE_FROM_CART",
            "ADD_TO_WISHLIST", "SHARE", "RECOMMENDATION_CLICK", "RECOMMENDATION_DISMISS",
        ],
    },
    "commerce-orders": {
        "eventType": ["PLACED", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED", "PAYMENT_FAILED", "REFUNDED"],
        "channel": ["APP", "WEB", "IN_STORE", "SUBSCRIPTION", "DISTRIBUTOR"],
    },
    "commerce-returns": {
        "eventType": ["REQUESTED", "APPROVED", "RECEIVED", "REFUNDED", "REJECTED"],
    },
    "device-telemetry": {
        "eventType": ["HEARTBEAT", "SCAN_STARTED", "SCAN_COMPLETED", "SCAN_FAILED", "FIRMWARE_UPDATE", "CALIBRATION", "ERROR", "SHUTDOWN"],
        "cameraStatus": ["OK", "DIRTY", "OBSTRUCTED", "FAILED", "UNKNOWN"],
        "lightStatus": ["OK", "DEGRADED", "FAILED", "UNKNOWN"],
    },
}

DEAD_LETTER_DDL = (
    "stream_key string, operator_name string, failure_reason string, message string, failure_time_ms bigint, "
    "original_stream_key string, original_customer_id string, original_event_time_ms bigint, ingest_time_ms bigint, "
    "original_json string"
)


@cache
def stream_schema(stream_key: str) -> T.StructType:
    """The record's schema; Spark parses it, so a session must be running."""
    return T.StructType.fromDDL(STREAM_DDL[stream_key])


def read_schema(stream_key: str) -> T.StructType:
    """The schema for reading: producers may lag behind, so any field can be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in stream_schema(stream_key).fields])


def schema_defaults(stream_key: str) -> dict[str, object]:
    """Default per field that has one, empty arrays and maps included."""
    defaults: dict[str, object] = {}
    for field in stream_schema(stream_key).fields:
        if isinstance(field.dataType, T.ArrayType) and not field.nullable:
            defaults[field.name] = []
        elif isinstance(field.dataType, T.MapType):
            defaults[field.name] = {}
        elif field.name == "schemaVersion":
            defaults[field.name] = 1
    return defaults | SCHEMA_DEFAULTS.get(stream_key, {})


def _default_column(value: object, dtype: T.DataType):
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(value, list):
        return F.array().cast(dtype)
    if isinstance(value, dict):
        return F.create_map().cast(dtype)
    return F.lit(value).cast(dtype)


def aligned(schema: T.StructType, present: T.StructType, pick: Callable[[str], Column], defaults: Mapping[str, object] | None = None) -> list[Column]:
    """The fields of ``schema`` from a record with the fields ``present``: absent ones have
    their default, those of another type are cast (null where that fails)."""
    defaults = defaults or {}
    columns = []
    for field in schema.fields:
        if field.name not in present.names:
            column = _default_column(defaults.get(field.name), field.dataType)
        elif present[field.name].dataType == field.dataType:
            column = pick(field.name)
        else:
            column = pick(field.name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return columns


def align_to_schema(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Backward-compatible read, see ``aligned``; extra fields stay."""
    columns = aligned(schema, df.schema, lambda name: F.col(f"`{name}`"), defaults)
    extra = [F.col(f"`{name}`") for name in df.columns if name not in schema.names]
    return df.select(*columns, *extra)
