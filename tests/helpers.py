"""Hand-written raw trip rows for edge-case tests."""

import datetime as dt

from tripmart import schemas

BASE = dt.datetime(2025, 1, 15, 8, 0, 0)


def trip(**over):
    """One raw trip with plausible defaults; keyword arguments override."""
    row = {
        "VendorID": 1, "tpep_pickup_datetime": BASE, "tpep_dropoff_datetime": BASE + dt.timedelta(minutes=10),
        "passenger_count": 1, "trip_distance": 2.0, "RatecodeID": 1, "store_and_fwd_flag": "N",
        "PULocationID": 4, "DOLocationID": 4, "payment_type": 1, "fare_amount": 10.0, "extra": 0.5,
        "mta_tax": 0.5, "tip_amount": 2.0, "tolls_amount": 0.0, "improvement_surcharge": 1.0,
        "total_amount": 14.0, "congestion_surcharge": 2.5, "airport_fee": 0.0,
    }
    row.update(over)
    return row


def raw_df(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in schemas.RAW_TRIP_COLUMNS) for r in rows],
                                 schema=schemas.RAW_TRIPS)
