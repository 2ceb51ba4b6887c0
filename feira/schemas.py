"""Column names and types of every table, as DDL text.

Fixed values: names and order of the columns. Money is decimal, so sums do not
depend on the order in which tasks finish; measures and coordinates are double.
"""

from pyspark.sql.types import StructType

BRONZE = {
    "customers": """
        customer_id string, customer_unique_id string, customer_zip_code_prefix int,
        customer_city string, customer_state string""",
    "orders": """
        order_id string, customer_id string, order_status string,
        order_purchase_timestamp string, order_approved_at string,
        order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price decimal(18,2), freight_value decimal(18,2)""",
    "order_payments": """
        order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value decimal(18,2)""",
    "products": """
        product_id string, product_category_name string, product_name_lenght double,
        product_description_lenght double, product_photos_qty double,
        product_weight_g double, product_length_cm double, product_height_cm double,
        product_width_cm double""",
    "order_reviews": """
        review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date string,
        review_answer_timestamp string""",
    "sellers": """
        seller_id string, seller_zip_code_prefix int, seller_city string,
        seller_state string""",
    "geolocation": """
        geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double,
        geolocation_city string, geolocation_state string""",
}

# A lookup that arrives with the exports but has no table of its own in any layer.
TRANSLATION = "product_category_name_translation"
LOOKUPS = {
    TRANSLATION: "product_category_name string, product_category_name_english string",
}

SILVER = {
    "customers": BRONZE["customers"],
    "orders": """
        order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp, order_approved_at timestamp,
        order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp,
        order_estimated_delivery_date timestamp""",
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp, price decimal(18,2), freight_value decimal(18,2)""",
    "order_payments": BRONZE["order_payments"],
    "products": """
        product_id string, product_name_length int, product_description_length int,
        product_photos_qty int, product_weight_g double, product_length_cm double,
        product_height_cm double, product_width_cm double, product_category_name string""",
    "order_reviews": """
        review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date timestamp,
        review_answer_timestamp timestamp""",
    "sellers": BRONZE["sellers"],
    "geolocation": """
        geolocation_zip_code_prefix int, geo_lat double, geo_lng double,
        geolocation_city string, geolocation_state string""",
}

GOLD = {
    "dim_customers": """
        customer_key string, customer_unique_id string, customer_zip_code_prefix int,
        customer_city string, customer_state string""",
    "dim_products": """
        product_key string, product_id string, category_name_english string,
        product_weight_g double, product_length_cm double, product_height_cm double,
        product_width_cm double""",
    "dim_sellers": """
        seller_key string, seller_id string, seller_zip_code_prefix int,
        seller_city string, seller_state string""",
    "dim_date": """
        date_key string, full_date date, day_of_week string, is_weekend boolean,
        month int, quarter int, year int, is_holiday boolean""",
    "fact_sales": """
        sale_key string, customer_key string, product_key string, seller_key string,
        date_key string, price decimal(18,2), freight_value decimal(18,2),
        payment_value decimal(28,2), payment_installments int, is_voucher int""",
    "fact_reviews": """
        review_key string, customer_key string, date_key string, order_id string,
        review_score int, comment_length int, response_time timestamp""",
    "fact_shipping": """
        shipping_key string, customer_key string, product_key string, seller_key string,
        date_key string, delivery_lead_time int, estimated_delivery_error int,
        shipping_distance_km double, is_late boolean""",
}

SEGMENTS = "cdp_rfm_segments"
RESPONSES = "review_response_days"
DERIVED = {
    RESPONSES: "review_id string, order_id string, response_days int",
    SEGMENTS: """
        customer_unique_id string, customer_city string, customer_state string,
        Recency int, Frequency bigint, Monetary decimal(38,2), Cluster int""",
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
