"""Sample feed rows used by the golden tests.

Fixed values: these are the sample records of the four feeds (accounts,
customers, products, orders) the layered jobs were written against.
"""

from strata import schemas

# --- fixed values: sample feed rows -------------------------------------------
ACCOUNTS = [
    ("ACC001", "Acme Corporation", "Technology", "Enterprise", "USA", "USA", 5000, 50000000.0),
    ("ACC002", "GlobalTech Inc", "Technology", "Enterprise", "UK", "UK", 3000, 35000000.0),
    ("ACC003", "DataFlow Systems", "Software", "Mid-Market", "Germany", "Germany", 500, 8000000.0),
    ("ACC004", "CloudFirst Ltd", "Cloud Services", "SMB", "USA", "Canada", 150, 2500000.0),
    ("ACC005", "Analytics Pro", "Analytics", "Enterprise", "Japan", "Japan", 2000, 25000000.0),
    ("ACC006", "TechStart GmbH", "Technology", "Startup", "Germany", "Germany", 25, 500000.0),
    ("ACC007", "MegaCorp International", "Conglomerate", "Enterprise", "USA", "USA", 50000, 500000000.0),
    ("ACC008", "LocalBiz Solutions", "Consulting", "SMB", "France", "France", 75, 1200000.0),
    ("ACC009", "InnovateTech", "Technology", "Mid-Market", "UK", "UK", 800, 12000000.0),
    ("ACC010", "DataDriven Inc", "Analytics", "Enterprise", "USA", "USA", 1500, 18000000.0),
    ("ACC011", None, "Unknown", "Unknown", "Unknown", None, -100, -5000000.0),
    ("ACC012", "Bad Data Corp", None, "Enterprise", "", "", None, None),
]

CUSTOMERS = [
    (1, "John", "Doe", "john.doe@email.com", "123-456-7890", "New York", "NY", "active"),
    (2, "Jane", "Smith", "jane.smith@email.com", "234-567-8901", "Los Angeles", "CA", "active"),
    (3, "Bob", "Johnson", "bob.j@email.com", "345-678-9012", "Chicago", "IL", "active"),
    (4, "Alice", "Williams", "alice.w@email.com", "456-789-0123", "Houston", "TX", "inactive"),
    (5, "Charlie", "Brown", "charlie.b@email.com", "567-890-1234", "Phoenix", "AZ", "active"),
]

PRODUCTS = [
    (101, "Laptop Pro 15", "Electronics", "Computers", 1299.99, 50, "active"),
    (102, "Wireless Mouse", "Electronics", "Accessories", 29.99, 200, "active"),
    (103, "USB-C Hub", "Electronics", "Accessories", 49.99, 150, "active"),
    (104, "Monitor 27inch", "Electronics", "Displays", 399.99, 75, "active"),
    (105, "Office Chair", "Furniture", "Seating", 299.99, 40, "active"),
]

ORDERS = [
    (1001, 1, 101, 1, 1299.99, "2024-01-05 10:30:00", "delivered", "credit_card"),
    (1002, 1, 102, 2, 29.99, "2024-01-05 10:30:00", "delivered", "credit_card"),
    (1003, 2, 104, 1, 399.99, "2024-01-08 14:15:00", "delivered", "paypal"),
    (1004, 3, 105, 1, 299.99, "2024-01-10 09:45:00", "delivered", "credit_card"),
    (1005, 4, 101, 1, 1299.99, "2024-01-12 16:20:00", "delivered", "debit_card"),
    (1006, 5, 103, 2, 49.99, "2024-01-15 11:00:00", "delivered", "credit_card"),
]
# --------------------------------------------------------------------------------

AS_OF = "2024-02-01 06:00:00"


def accounts_df(spark, rows=ACCOUNTS):
    return spark.createDataFrame(rows, schemas.ACCOUNTS)


def customers_df(spark, rows=CUSTOMERS):
    return spark.createDataFrame(rows, schemas.CUSTOMERS)


def products_df(spark, rows=PRODUCTS):
    return spark.createDataFrame(rows, schemas.PRODUCTS)


def orders_df(spark, rows=ORDERS):
    return spark.createDataFrame(rows, schemas.ORDERS)


def sales_fact(spark, customers=CUSTOMERS, products=PRODUCTS, orders=ORDERS, as_of=AS_OF):
    from strata.plans import sales

    c = sales.dim_customers(sales.bronze_sales(customers_df(spark, customers), "customers", as_of), as_of)
    p = sales.dim_products(sales.bronze_sales(products_df(spark, products), "products", as_of), as_of)
    o = sales.bronze_sales(orders_df(spark, orders), "orders", as_of)
    return sales.fact_orders(o, c, p, as_of)


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
