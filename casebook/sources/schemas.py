"""Domain table schemas (inferred from use; SURVEY §1.2, FIXTURES §1).

Test bindings produce the same column names; key columns there are
``bigint`` because the source tables carry 64-bit keys.
"""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
_TS = T.TimestampNTZType()
MONEY_IN = T.DecimalType(18, 2)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS = {
    "sales": _struct(("customer_id", _S), ("order_date", _D), ("product_id", _I)),
    "menu": _struct(("product_id", _I), ("product_name", _S), ("price", MONEY_IN)),
    "members": _struct(("customer_id", _S), ("join_date", _D)),
    "customer_nodes": _struct(("customer_id", _I), ("region_id", _I), ("node_id", _I),
                              ("start_date", _D), ("end_date", _D)),
    "regions": _struct(("region_id", _I), ("region_name", _S)),
    "customer_transactions": _struct(("customer_id", _I), ("txn_date", _D),
                                     ("txn_type", _S), ("txn_amount", MONEY_IN)),
    "data_mart": _struct(("week_date", _S), ("region", _S), ("platform", _S),
                         ("segment", _S), ("customer_type", _S),
                         ("transactions", _I), ("sales", _L)),
    "users": _struct(("user_id", _L), ("cookie_id", _S)),
    "web_events": _struct(("visit_id", _S), ("cookie_id", _S), ("page_id", _I),
                          ("event_type", _I), ("sequence_number", _L), ("event_time", _TS)),
    "event_identifier": _struct(("event_type", _I), ("event_name", _S)),
    "page_hierarchy": _struct(("page_id", _I), ("page_name", _S),
                              ("product_category", _S), ("product_id", _I)),
    "campaign_identifier": _struct(("campaign_name", _S), ("start_date", _TS),
                                   ("end_date", _TS)),
    "change_dates": _struct(("change_name", _S), ("change_date", _D)),
}

_F = T.DoubleType()

#: The Parquet source tables that the test binding reads; a scan that declares
#: its schema opens no file to infer one.
SOURCES = {
    "region": _struct(("r_regionkey", _I), ("r_name", _S)),
    "nation": _struct(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _struct(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _F),
                        ("c_mktsegment", _S)),
    "part": _struct(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I),
                    ("p_retailprice", _F)),
    "orders": _struct(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _F),
                      ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _struct(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                        ("l_quantity", _F), ("l_extendedprice", _F), ("l_discount", _F), ("l_tax", _F),
                        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _struct(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _F),
                      ("props", _S)),
}
