"""Declared schemas. Nothing is inferred, so no read needs a pass of its own."""

from pyspark.sql import types as T

# Field names and types of the files that are read and written.

TX_SCHEMA = T.StructType(
    [
        T.StructField("id_pk", T.StringType()),
        T.StructField("transaction_date", T.TimestampType()),
        T.StructField("value_date", T.TimestampType()),
        T.StructField("asnu_code", T.StringType()),
        T.StructField("dt_account", T.StringType()),
        T.StructField("kt_account", T.StringType()),
        T.StructField("amount", T.DecimalType(38, 10)),
        T.StructField("payment_purpose", T.StringType()),
        T.StructField("dt_balance_account", T.StringType()),
        T.StructField("dt_tax_item_ofr", T.StringType()),
        T.StructField("kt_balance_account", T.StringType()),
        T.StructField("kt_tax_item_ofr", T.StringType()),
        T.StructField("is_drpl", T.StringType()),
        T.StructField("mem_order_number", T.StringType()),
        T.StructField("mem_order_date", T.TimestampType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("document_number", T.StringType()),
        T.StructField("document_date", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("ctl_validfrom", T.TimestampType()),
        T.StructField("operation_date", T.TimestampType(), nullable=False),
        T.StructField("is_spod", T.BooleanType()),
        T.StructField("usl_div_sk", T.LongType()),
        T.StructField("usl_div_dp_code", T.StringType()),
        T.StructField("usl_div_code", T.StringType()),
        T.StructField("input_dt", T.DateType()),
    ]
)

RULE_SCHEMA = T.StructType(
    [
        T.StructField("id_pk", T.LongType()),
        T.StructField("dt_tax_item", T.StringType()),
        T.StructField("kt_tax_item", T.StringType()),
        T.StructField("dt_tax_item_ofr_list", T.StringType()),
        T.StructField("kt_tax_item_ofr_list", T.StringType()),
        T.StructField("account_mask_rule", T.StringType()),
        T.StructField("dt_account_mask_list", T.StringType()),
        T.StructField("kt_account_mask_list", T.StringType()),
        T.StructField("payment_purpose_rule", T.StringType()),
        T.StructField("payment_purpose_pattern_list", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("description", T.StringType()),
        T.StructField("user_login", T.StringType()),
        T.StructField("updated_ts", T.TimestampType()),
    ]
)

CLASSIFIER_SCHEMA = T.StructType(
    [
        T.StructField("tax_item_ofr", T.StringType()),
        T.StructField("tax_item_code", T.StringType()),
        T.StructField("actual_from", T.DateType()),
        T.StructField("actual_to", T.DateType()),
    ]
)

# One result schema for every path, with or without matching rules.
OUT_SCHEMA = T.StructType(
    [
        T.StructField("id_pk", T.StringType()),
        T.StructField("input_dt", T.DateType()),
        T.StructField("operation_date", T.TimestampType()),
        T.StructField("created_ts", T.TimestampType()),
        T.StructField("dt_tax_item_auto", T.StringType()),
        T.StructField("kt_tax_item_auto", T.StringType()),
    ]
)
