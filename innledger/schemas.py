"""Column types of the five landing tables.

Only the columns the plans use are declared. A landing file may carry more; those
pass through as strings (see ``sources.landing``).
"""

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
)

LANDING_TABLES: dict[str, dict[str, DataType]] = {
    "hotels": {
        "hotel_id": StringType(),
        "hotel_name": StringType(),
        "stars": IntegerType(),
        "country": StringType(),
    },
    "rooms": {
        "room_id": StringType(),
        "hotel_id": StringType(),
        "room_type_code": StringType(),
        "room_type_desc": StringType(),
        "max_occupancy": IntegerType(),
    },
    "customers": {
        "customer_id": StringType(),
        "email": StringType(),
    },
    "bookings": {
        "booking_id": StringType(),
        "customer_id": StringType(),
        "hotel_id": StringType(),
        "room_id": StringType(),
        "checkin_date": DateType(),
        "checkout_date": DateType(),
        "total_amount": DoubleType(),
        "currency": StringType(),
        "status": StringType(),
        "source": StringType(),
    },
    "payments": {
        "booking_id": StringType(),
        "amount": DoubleType(),
        "currency": StringType(),
    },
}

INGESTION_COLUMN = "ingestion_date"
