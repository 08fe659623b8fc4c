"""A small two-day landing zone with the kinds of dirt the feeds carry.

Written fresh by the tests; the expected silver / gold values are worked out
by hand in the tests that use it.
"""

DAY1, DAY2 = "2025-12-01", "2025-12-02"

FILES = {
    (DAY1, "customers"): (
        "customer_id,state,city,created_ts\n"
        "C1,sp ,São Paulo,2024-01-05 10:00:00\n"
        "C2,,,2024-13-40\n"
        ",RJ,Rio,2024-01-01\n"
        "C3,Rj,  belém ,\n"
    ),
    # day 2 appends a column (schema drift)
    (DAY2, "customers"): (
        "customer_id,state,city,created_ts,phone\n"
        "C1,SP,sao paulo,2024-01-05 10:00:00,123\n"
        "C4,mg,,2024-02-01T08:00:00,\n"
    ),
    (DAY1, "products"): (
        "product_id,category,brand,created_ts\n"
        "P1,Eletrônicos,ACME ,2024-01-01 00:00:00\n"
        "P2,,,05/01/2024 10:30\n"
        "P3,casa,nova,\n"
        "P4,  ,zetta,2024-03-01 09:00:00\n"
    ),
    (DAY2, "products"): (
        "product_id,category,brand,created_ts\n"
        "P1,eletronicos,Acme,2024-01-01 00:00:00\n"
    ),
    (DAY1, "orders"): (
        "order_id,customer_id,order_ts,status,payment_method,total_amount,currency\n"
        "O1,C1,2025-12-01 10:00:00,DELIVERED ,PIX , 199.90 ,BRL\n"
        "O2,C2,01/12/2025 05:57,,,abc,USD\n"
        'O3,C3,,paid,credit_card,"10,50",brl\n'
        "O4,C1,2025-12-01 11:00:00,created,BOLETO,-5.00,\n"
        ",C9,2025-12-01 11:00:00,created,PIX,1.00,BRL\n"
    ),
    (DAY2, "orders"): (
        "order_id,customer_id,order_ts,status,payment_method,total_amount,currency,sales_channel\n"
        "O1,C1,2025-12-01 10:00:00,shipped,pix,199.90,BRL,web\n"
    ),
    (DAY1, "order_items"): (
        "order_id,product_id,quantity,unit_price,discount_amount\n"
        "O1,P1,2,100.00,10\n"
        "O1,P2,two,50,\n"
        'O3,P1,1.7," 99,90",R$10\n'
        "O2,P3,-1,-50,-3\n"
        ",P1,1,1,1\n"
        "O9,P1,1,10.00,0\n"
    ),
    (DAY2, "order_items"): (
        "order_id,product_id,quantity,unit_price,discount_amount\n"
        "O1,P1,3,100.00,5\n"
    ),
    (DAY1, "shipments"): (
        "order_id,carrier,shipping_cost,shipped_ts,delivered_ts,delivery_status\n"
        'O1,CORREIOS ,"0,00",2025-12-01 12:00:00,2025-12-05 13:00:00,DELIVERED \n'
        "O3,,-5,2025-12-02 10:00:00,N/A,\n"
        "O4,  ,free,N/A,2025-12-03 00:00:00,lost\n"
    ),
    (DAY2, "shipments"): (
        "order_id,carrier,shipping_cost,shipped_ts,delivered_ts,delivery_status\n"
        ",Loggi,1,2025-12-02 10:00:00,,\n"
    ),
}


def write_text(path, text) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def write_landing(root) -> None:
    for (day, entity), text in FILES.items():
        write_text(root / f"ingest_date={day}" / f"{entity}.csv", text)
