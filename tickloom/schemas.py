"""Declared schemas. Column names are part of the data contract."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# Market tick as it arrives in a JSON message; volume is wide enough for real days.
TICK_MESSAGE = _struct(
    ticker=StringType(),
    timestamp=StringType(),
    open=DoubleType(),
    high=DoubleType(),
    low=DoubleType(),
    close=DoubleType(),
    volume=LongType(),
    change_pct=DoubleType(),
)

# Market tick after decoding; also the shape of an empty input.
TICK = _struct(
    ticker=StringType(),
    timestamp=TimestampType(),
    date=DateType(),
    open=DoubleType(),
    high=DoubleType(),
    low=DoubleType(),
    close=DoubleType(),
    volume=LongType(),
)

DAILY_BAR_COLUMNS = ("ticker", "date", "open", "high", "low", "close", "volume")

# User event: the three-field form and the form with purchase and page fields.
USER_EVENT_BASIC = _struct(
    user_id=IntegerType(),
    event=StringType(),
    timestamp=StringType(),
)

USER_EVENT = _struct(
    user_id=IntegerType(),
    event=StringType(),
    amount=IntegerType(),
    page=StringType(),
    timestamp=StringType(),
)

# What a Kafka source yields.
KAFKA_RECORD = _struct(
    key=BinaryType(),
    value=BinaryType(),
    topic=StringType(),
    partition=IntegerType(),
    offset=LongType(),
    timestamp=TimestampType(),
    timestampType=IntegerType(),
)

# Ridership counters come as numbers or as text, so they are read as text and cast.
RIDERSHIP_ROW = _struct(
    USE_YMD=StringType(),
    SBWY_ROUT_LN_NM=StringType(),
    SBWY_STNS_NM=StringType(),
    GTON_TNOPE=StringType(),
    GTOFF_TNOPE=StringType(),
    REG_YMD=StringType(),
)

RIDERSHIP_ENVELOPE = _struct(
    CardSubwayStatsNew=_struct(
        list_total_count=LongType(),
        RESULT=_struct(CODE=StringType(), MESSAGE=StringType()),
        row=ArrayType(RIDERSHIP_ROW),
    )
)

# Housing listings: text columns are categorical, price is the label.
LISTING = _struct(
    neighbourhood_cleansed=StringType(),
    room_type=StringType(),
    bedrooms=DoubleType(),
    bathrooms=DoubleType(),
    number_of_reviews=DoubleType(),
    price=DoubleType(),
)

PERSON = _struct(name=StringType(), age=LongType())
