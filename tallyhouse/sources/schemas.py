"""Declared schemas. Facts and dimensions are never inferred."""

from pyspark.sql import types as T

BRONZE_RESPONSES = T.StructType(
    [
        T.StructField("response_id", T.StringType()),
        T.StructField("respondent_id", T.StringType()),
        T.StructField("team_id", T.StringType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("question_id", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("submitted_at", T.StringType()),
    ]
)

QUESTION_CONFIG = T.StructType(
    [
        T.StructField("question_id", T.StringType()),
        T.StructField("question_text", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("is_reverse_scored", T.StringType()),
    ]
)

TEAM_HIERARCHY = T.StructType(
    [
        T.StructField("team_id", T.StringType()),
        T.StructField("team_name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("division", T.StringType()),
    ]
)

DIM_TEAM = T.StructType(
    [
        T.StructField("team_key", T.IntegerType(), False),
        T.StructField("team_name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

DIM_QUESTION = T.StructType(
    [
        T.StructField("question_key", T.IntegerType(), False),
        T.StructField("question_id", T.StringType()),
        T.StructField("question_text", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

DIM_TIME_PERIOD = T.StructType(
    [
        T.StructField("time_period_key", T.IntegerType(), False),
        T.StructField("period_label", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
    ]
)

FACT_RESPONSES = T.StructType(
    [
        T.StructField("response_id", T.LongType(), False),
        T.StructField("team_key", T.IntegerType(), False),
        T.StructField("project_key", T.IntegerType(), False),
        T.StructField("question_key", T.IntegerType(), False),
        T.StructField("time_period_key", T.IntegerType(), False),
        T.StructField("score", T.DecimalType(2, 1)),
        T.StructField("response_count", T.IntegerType()),
    ]
)

DIM_TEAM_SCD2 = T.StructType(
    [
        T.StructField("team_key", T.IntegerType(), False),
        T.StructField("team_code", T.StringType()),
        T.StructField("team_name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("headcount", T.IntegerType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("is_current", T.BooleanType()),
    ]
)

EAV = T.StructType(
    [
        T.StructField("response_id", T.LongType()),
        T.StructField("project", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("attribute", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

SLOT_MAPPING = T.StructType(
    [
        T.StructField("project", T.StringType()),
        T.StructField("slot_number", T.IntegerType()),
        T.StructField("question_id", T.StringType()),
        T.StructField("question_text", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

_KINDS = {
    "int": T.IntegerType,
    "bigint": T.LongType,
    "double": T.DoubleType,
    "string": T.StringType,
    "time": T.TimestampNTZType,
}


def _columns(text: str) -> T.StructType:
    """'name kind, name kind' -> schema."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]()) for name, kind in pairs])


# Given tables. A declared schema saves reading file footers before every query.
TABLES = {
    "region": _columns("r_regionkey int, r_name string"),
    "nation": _columns("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _columns("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": _columns("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _columns(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": _columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate time,"
        " o_orderpriority string"
    ),
    "lineitem": _columns(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate time"
    ),
    "events": EVENTS,
}
