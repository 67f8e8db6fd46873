"""Declared schemas: no source is read with type inference."""

CUSTOMERS = "customer_id STRING, customer_unique_id STRING, customer_state STRING"
ORDERS = (
    "order_id STRING, customer_id STRING, order_status STRING, "
    "order_approved_at TIMESTAMP_NTZ, order_delivered_customer_date TIMESTAMP_NTZ, "
    "order_estimated_delivery_date TIMESTAMP_NTZ"
)
ORDER_ITEMS = "order_id STRING, product_id STRING, price DOUBLE"
AB_VALUES = "number INT, value STRING, experimentVariant STRING"
AA_EVENTS = "purchase INT, experimentVariant INT, version STRING"
GROUPS = "id BIGINT, grp STRING"
ACTIVE = "student_id BIGINT"
CHECKS = "student_id BIGINT, rev DOUBLE"
ANSWERS = "st_id BIGINT, timest TIMESTAMP_NTZ, correct INT, subject STRING"
STUDENTS = "st_id BIGINT, test_grp STRING"
PAYMENTS = "st_id BIGINT, money DOUBLE, subject STRING"
DOMAINS = "rank INT, domain STRING"
TRANSFERS = "id_sender INT, id_receiver INT, dates DATE, amount_new DOUBLE"
ISSUE_DATES = "id_sender INT, date_cred DATE"
PEOPLE = "id INT, name STRING"
SALES = "id INT, people_id INT, sale STRING, price DOUBLE"
POINTS = "x DOUBLE, y DOUBLE"
PAGES = "page_id BIGINT, url STRING, html STRING"
