"""Declared schemas of governed tables (StructType = the DDL)."""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, IntegerType, MapType,
                               StringType, StructField, StructType, TimestampNTZType)

S, B, I, DT, TS, F = StringType(), BooleanType(), IntegerType(), DateType(), TimestampNTZType(), DoubleType()


def D(p, s):
    return DecimalType(p, s)


def schema(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


PARAM_SCHEMA = schema(("param_name", S), ("param_value", D(18, 4)), ("unit", S), ("used_by", S),
                      ("description", S), ("version", S), ("updated_at", TS),
                      ("min_value", D(18, 4)), ("max_value", D(18, 4)), ("whole_number", B))

PLANT_SCHEMA = schema(("werks", S), ("plant_name", S), ("city", S), ("country_code", S), ("region", S),
                      ("time_zone", S), ("local_currency", S), ("handling_usd_per_kg", D(10, 4)),
                      ("has_rfid_gate", B), ("plant_idx", I))

CARRIER_SCHEMA = schema(("carrier_code", S), ("carrier_name", S), ("transport_mode", S), ("carrier_idx", I))

SCOPE_SCHEMA = schema(("role_name", S), ("plant_id", S))

REGISTRY_SCHEMA = schema(("metric_id", S), ("display_name", S), ("semantic_metric", S), ("grain", S),
                         ("anchor_date", S), ("inclusions_exclusions", S), ("owner", S), ("version", S),
                         ("status", S), ("synonyms", S), ("not_to_be_confused_with", S), ("business_definition", S),
                         ("formula", S), ("effective_from", DT))

CHANGE_LOG_SCHEMA = StructType([
    StructField("change_id", S), StructField("changed_at", TS), StructField("changed_by", S),
    StructField("param_name", S), StructField("metric_id", S), StructField("old_value", D(18, 4)),
    StructField("new_value", D(18, 4)), StructField("old_version", S), StructField("new_version", S),
    StructField("reason", S),
    StructField("scorecard_before", MapType(S, F)), StructField("scorecard_after", MapType(S, F)),
])

ENTITLEMENT_RESULT_SCHEMA = schema(("run_ts", TS), ("test_id", S), ("persona_role", S), ("test_name", S),
                                   ("expectation", S), ("observed", S), ("status", S))

AUDIT_SCHEMA = schema(("logged_at", TS), ("app_user", S), ("persona", S), ("question", S),
                      ("generated_sql", S), ("metrics_resolved", S), ("verified_query_used", S),
                      ("analyst_request_id", S), ("outcome", S))
