"""A small retail sample written by the tests (values chosen by hand)."""

import os

SALES = """transaction_id,order_id,transaction_date,store_id,customer_id,product_id,quantity,unit_price,discount_pct,payment_method,channel
TXN-1,ORD-1,2024-01-01 08:15:32,STR-1,CUST-1,PRD-1,2,29.99,0,credit_card,in_store
TXN-2,ORD-1,2024-01-01 08:15:32,STR-1,CUST-1,PRD-2,1,59.99,10,credit_card,in_store
TXN-3,ORD-2,2024-01-01 17:40:00,,CUST-2,PRD-1,2,179.99,15,pix,online
TXN-4,ORD-4,2024-01-02 10:00:00,STR-2,,PRD-3,1,100.00,2.5,cash,in_store
TXN-5,ORD-3,2024-01-01 12:00:00,STR-1,CUST-3,PRD-1,1,29.99,,debit_card,in_store
"""
CUSTOMERS = """customer_id,first_name,last_name,email,loyalty_tier,loyalty_points,registration_date,city,state
CUST-1,Ana,Lima,ana@mail.test,Gold,500,2023-01-10,Recife,PE
CUST-2,Bruno,,not-an-email,,,2023-02-11,Natal,RN
CUST-3,Caio,Reis,caio@mail.test,Silver,20,2023-03-12,Olinda,PE
"""
PRODUCTS = """product_id,product_name,category,subcategory,brand,sku,unit_cost,unit_price,is_perishable,is_active
PRD-1,Shirt,Apparel,Tops,Acme,SKU-1,12.50,29.99,false,true
PRD-2,Headset,Electronics,Audio,Sono,SKU-2,27.69,59.99,false,true
PRD-3,Coffee,Food,Drinks,Bean,SKU-3,5.00,0.00,true,true
"""
STORES = """store_id,store_name,store_type,city,state,region,country,is_active
STR-1,Centro,mall,Recife,PE,Northeast,BR,true
STR-2,Praia,street,Natal,RN,Northeast,BR,true
"""
INVENTORY = """inventory_id,store_id,product_id,quantity_on_hand,quantity_reserved,reorder_point
INV-1,STR-1,PRD-1,0,0,5
INV-2,STR-1,PRD-2,4,1,5
INV-3,STR-2,PRD-3,50,10,5
"""
# the same sale again in a later file: same key, different file -> kept by Bronze
SALES_DAY2 = """transaction_id,order_id,transaction_date,store_id,customer_id,product_id,quantity,unit_price,discount_pct,payment_method,channel
TXN-4,ORD-4,2024-01-02 10:00:00,STR-2,,PRD-3,1,100.00,2.5,cash,in_store
"""

# hand-computed Silver measures (HALF_UP to cents)
EXPECTED_FACT = {
    "TXN-1": ("59.98", "0.00", "59.98"),
    "TXN-2": ("59.99", "6.00", "53.99"),
    "TXN-3": ("359.98", "54.00", "305.98"),
    "TXN-4": ("100.00", "2.50", "97.50"),
    "TXN-5": ("29.99", "0.00", "29.99"),
}
EXPECTED_MARGIN = {"PRD-1": "58.32", "PRD-2": "53.84", "PRD-3": None}


def write_landing(root: str, with_day2: bool = False) -> str:
    files = {"sales/sales_20240101.csv": SALES, "customers/customers_20240101.csv": CUSTOMERS,
             "products/products_20240101.csv": PRODUCTS, "stores/stores_20240101.csv": STORES,
             "inventory/inventory_20240101.csv": INVENTORY}
    if with_day2:
        files["sales/sales_20240102.csv"] = SALES_DAY2
    for rel, text in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as fh:
            fh.write(text)
    return root
