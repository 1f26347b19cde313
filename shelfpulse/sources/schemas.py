"""Declared schemas of the input tables, one DDL string each."""

SCHEMAS = {
    "sales": (
        "order_id bigint, user_id bigint, product_id bigint, product_name string, "
        "option_1_id bigint, option_1_name string, variant_1_id bigint, variant_name string, "
        "option_2_id bigint, option_2_name string, variant_2_id bigint, variant_2_name string, "
        "barcode string, category_m string, category_s string, currency string, "
        "purchased_at timestamp, product_price double, marked_down_price double, "
        "product_qty double, order_qty double"
    ),
    "cart": (
        "user_id bigint, type string, user_type string, item_id bigint, item_type string, "
        "product_id bigint, amount bigint, price double, timestamp bigint"
    ),
    "users": (
        "user_id bigint, status string, user_type string, company_id bigint, last_login bigint, "
        "timestamp bigint, firstname string, lastname string, birthday string, "
        "age_range string, gender string"
    ),
    "posts": "post_id bigint, thread_id bigint, user_id bigint, status string, timestamp bigint",
    "ratings": "thread_id bigint, post_id bigint, rating_value bigint",
    "messages": "thread_id bigint, post_id bigint, message string",
    "threads": "thread_id bigint, object_id bigint, object_type string",
    "product_names": "product_id bigint, lang_code string, product string",
    "products": "product_id bigint, is_edp string, status string, hash_tag string",
    "stock": "barcode string, amount bigint, timestamp bigint",
    "feature_values": "product_id bigint, variant_id bigint, lang_code string, feature_id bigint",
    "variant_names": "variant_id bigint, lang_code string, variant string",
    "exposures": "product_id bigint, date timestamp, popularity double, main_rec_category string",
    "searches": "idx bigint, product_id bigint, timestamp bigint",
    "option_inventory": "product_id bigint, barcode string",
    "competitor_prices": (
        "date date, competitor string, product_id bigint, krw_price double, usd_price double"
    ),
    "crawls": "competitor string, product_id bigint, update_date timestamp, sale_or_not bigint",
    "items": "id bigint, product_id bigint",
    "item_prices": "item_id bigint, date date, krw_price double",
}
