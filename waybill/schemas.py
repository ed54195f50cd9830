"""Row types of the warehouse. Names and column order are the ones its users rely on."""

from __future__ import annotations

MONEY = "decimal(18,2)"

# Source tables with business events, and those that only feed dimensions.
FACT_TABLES = ["order_info", "order_cargo", "transport_task", "order_org_bound"]
DIM_TABLES = [
    "user_info",
    "user_address",
    "base_complex",
    "base_dic",
    "base_region_info",
    "base_organ",
    "express_courier",
    "express_courier_complex",
    "employee_info",
    "line_base_shift",
    "line_base_info",
    "truck_driver",
    "truck_info",
    "truck_model",
    "truck_team",
]
CONFIG_TABLE = "tms_config_dim"
ODS_TOPIC = "tms_ods"

ORDER_INFO = (
    "id string, order_no string, status string, collect_type string, user_id string, "
    "receiver_complex_id string, receiver_province_id string, receiver_city_id string, "
    "receiver_district_id string, receiver_name string, "
    "sender_complex_id string, sender_province_id string, sender_city_id string, "
    "sender_district_id string, sender_name string, "
    f"payment_type string, cargo_num int, amount {MONEY}, estimate_arrive_time bigint, "
    f"distance {MONEY}, create_time string, update_time string, is_deleted string"
)
ORDER_CARGO = (
    "id string, order_id string, cargo_type string, volumn_length int, volumn_width int, "
    f"volumn_height int, weight {MONEY}, create_time string, update_time string, is_deleted string"
)
ORDER_ORG_BOUND = (
    "id string, order_id string, org_id string, status string, inbound_time string, "
    "inbound_emp_id string, sort_time string, sorter_emp_id string, outbound_time string, "
    "outbound_emp_id string, create_time string, update_time string, is_deleted string"
)
TRANSPORT_TASK = (
    "id string, shift_id string, line_id string, start_org_id string, start_org_name string, "
    "end_org_id string, end_org_name string, order_num int, driver1_emp_id string, "
    "driver1_name string, driver2_emp_id string, driver2_name string, truck_id string, "
    "truck_no string, actual_start_time string, actual_end_time string, "
    f"actual_distance {MONEY}"
)
DIM_CONFIG = (
    "source_table string, sink_table string, sink_columns string, primary_key string, "
    "sink_extend string, foreign_keys string"
)

# Detail rows. ``event_time`` is the local text of the moment, ``ts`` the instant.
ORDER_EVENT = (
    "id string, order_id string, cargo_type string, volume_length int, volume_width int, "
    f"volume_height int, weight {MONEY}, event_time string, order_no string, status string, "
    "collect_type string, user_id string, receiver_complex_id string, "
    "receiver_province_id string, receiver_city_id string, receiver_district_id string, "
    "receiver_name string, sender_complex_id string, sender_province_id string, "
    "sender_city_id string, sender_district_id string, sender_name string, "
    f"payment_type string, cargo_num int, amount {MONEY}, estimate_arrive_time string, "
    f"distance {MONEY}, ts timestamp"
)
BOUND_EVENT = (
    "id string, order_id string, org_id string, event_time string, emp_id string, ts timestamp"
)
TRANSPORT_FINISH = TRANSPORT_TASK.replace(
    "actual_distance", "transport_time bigint, actual_distance"
) + ", ts timestamp"

# Order event -> (topic, name of its time field).
ORDER_TOPICS = {
    "order": ("tms_dwd_trade_order_detail", "order_time"),
    "pay_suc": ("tms_dwd_trade_pay_suc_detail", "pay_time"),
    "cancel": ("tms_dwd_trade_cancel_detail", "cancel_time"),
    "receive": ("tms_dwd_trans_receive_detail", "receive_time"),
    "dispatch": ("tms_dwd_trans_dispatch_detail", "dispatch_time"),
    "bound_finish": ("tms_dwd_trans_bound_finish_detail", "bound_finish_time"),
    "deliver_suc": ("tms_dwd_trans_deliver_detail", "deliver_time"),
    "sign": ("tms_dwd_trans_sign_detail", "sign_time"),
}
# Transfer event -> (topic, name of its time field, name of its employee field).
BOUND_TOPICS = {
    "inbound": ("tms_dwd_bound_inbound", "inbound_time", "inbound_emp_id"),
    "sort": ("tms_dwd_bound_sort", "sort_time", "sorter_emp_id"),
    "outbound": ("tms_dwd_bound_outbound", "outbound_time", "outbound_emp_id"),
}
TRANSPORT_TOPIC = "tms_dwd_trans_trans_finish"
# Which job writes a topic.
TOPIC_WRITERS = {
    ODS_TOPIC: "ods",
    **{topic: "dwd_order_relevant" for topic, _ in ORDER_TOPICS.values()},
    **{topic: "dwd_bound_relevant" for topic, _, _ in BOUND_TOPICS.values()},
    TRANSPORT_TOPIC: "dwd_trans_trans_finish",
}

# Metric table -> its columns, in the order rows are inserted.
METRICS = {
    "dws_bound_org_sort_day": [
        "cur_date", "org_id", "org_name", "city_id", "city_name", "province_id",
        "province_name", "sort_count_base", "ts",
    ],
    "dws_trade_cargo_type_order_day": [
        "cur_date", "cargo_type", "cargo_type_name", "order_amount_base",
        "order_count_base", "ts",
    ],
    "dws_trade_org_order_day": [
        "cur_date", "org_id", "org_name", "city_id", "city_name", "order_amount_base",
        "order_count_base", "ts",
    ],
    "dws_trans_bound_finish_day": ["cur_date", "bound_finish_order_count_base", "ts"],
    "dws_trans_dispatch_day": ["cur_date", "dispatch_order_count_base", "ts"],
    "dws_trans_org_deliver_suc_day": [
        "cur_date", "org_id", "org_name", "city_id", "city_name", "province_id",
        "province_name", "deliver_suc_count_base", "ts",
    ],
    "dws_trans_org_receive_day": [
        "cur_date", "org_id", "org_name", "city_id", "city_name", "province_id",
        "province_name", "receive_order_count_base", "ts",
    ],
    "dws_trans_org_truck_model_trans_finish_day": [
        "cur_date", "org_id", "org_name", "truck_model_id", "truck_model_name", "city_id",
        "city_name", "trans_finish_count_base", "trans_finish_distance_base",
        "trans_finish_dur_time_base", "ts",
    ],
}
# Measures are numbers, everything else in a metric row is text.
METRIC_TYPES = {
    "sort_count_base": "bigint",
    "order_amount_base": "decimal(38,2)",
    "order_count_base": "bigint",
    "bound_finish_order_count_base": "bigint",
    "dispatch_order_count_base": "bigint",
    "deliver_suc_count_base": "bigint",
    "receive_order_count_base": "bigint",
    "trans_finish_count_base": "bigint",
    "trans_finish_distance_base": "decimal(38,2)",
    "trans_finish_dur_time_base": "bigint",
    "ts": "bigint",
}
# What identifies a metric row; later versions replace earlier ones.
METRIC_KEYS = {
    "dws_bound_org_sort_day": ["cur_date", "org_id"],
    "dws_trade_cargo_type_order_day": ["cur_date", "cargo_type"],
    "dws_trade_org_order_day": ["cur_date", "org_id"],
    "dws_trans_bound_finish_day": ["cur_date"],
    "dws_trans_dispatch_day": ["cur_date"],
    "dws_trans_org_deliver_suc_day": ["cur_date", "org_id"],
    "dws_trans_org_receive_day": ["cur_date", "org_id"],
    "dws_trans_org_truck_model_trans_finish_day": ["cur_date", "org_id", "truck_model_id"],
}


def columns(ddl: str) -> list[str]:
    """Column names of a row type given as DDL."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fieldNames()
