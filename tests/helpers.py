import datetime as dt

from pyspark.sql import functions as F

PURCHASE_SCHEMA = "customer_id long, date date, product string"


def purchases_frame(spark, rows):
    """rows: (customer_id, 'YYYY-MM-DD', product) -> purchases with year/month/day."""
    data = [(c, dt.date.fromisoformat(d) if d else None, p) for c, d, p in rows]
    df = spark.createDataFrame(data, PURCHASE_SCHEMA)
    return df.select(
        "customer_id", "date", "product",
        F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
    )


def brute_pair_support(basket_sets):
    """{(a, b): baskets holding both} from an iterable of item sets."""
    out = {}
    for items in basket_sets:
        s = sorted(set(items))
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                out[(s[i], s[j])] = out.get((s[i], s[j]), 0) + 1
    return out
