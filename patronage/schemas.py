"""Declared schemas of the tracking tables and of the piped text lines."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


CONVERSION = _struct(
    ("idsite", T.LongType()),
    ("idvisitor", T.BinaryType()),
    ("server_time", T.TimestampNTZType()),
    ("location_country", T.StringType()),
    ("location_region", T.StringType()),
    ("location_city", T.StringType()),
    ("location_latitude", T.DoubleType()),
    ("location_longitude", T.DoubleType()),
    ("idgoal", T.IntegerType()),
    ("idorder", T.StringType()),
    ("items", T.IntegerType()),
    ("revenue", T.DoubleType()),
    ("revenue_subtotal", T.DoubleType()),
    ("revenue_tax", T.DoubleType()),
    ("revenue_shipping", T.DoubleType()),
    ("revenue_discount", T.DoubleType()),
)

CONVERSION_ITEM = _struct(
    ("idsite", T.LongType()),
    ("idvisitor", T.BinaryType()),
    ("server_time", T.TimestampNTZType()),
    ("idorder", T.StringType()),
    ("idaction_sku", T.LongType()),
    ("price", T.DoubleType()),
    ("quantity", T.DoubleType()),
    ("deleted", T.BooleanType()),
)

VISIT_ACTION = _struct(
    ("idsite", T.LongType()),
    ("idvisitor", T.BinaryType()),
    ("server_time", T.TimestampNTZType()),
    ("idvisit", T.LongType()),
    ("idaction_url", T.LongType()),
)

CLICK_EVENT = _struct(
    ("topic", T.StringType()),
    ("data", T.MapType(T.StringType(), T.StringType())),
)

LOCATION_LINE = _struct(
    ("idsite", T.LongType()),
    ("user", T.StringType()),
    ("idorder", T.StringType()),
    ("timestamp", T.LongType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
)

CLUSTER_LINE = _struct(
    ("cluster", T.IntegerType()),
    ("clat", T.DoubleType()),
    ("clon", T.DoubleType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
)

# Rows without these are no engagement records and are dropped at the source.
REQUIRED = {
    "conversion": ["idsite", "idvisitor", "server_time", "idorder"],
    "conversion_item": ["idsite", "idvisitor", "server_time", "idorder"],
    "visit_action": ["idsite", "idvisitor", "server_time", "idvisit"],
}


# Types that databases hand over and that fit the declared one without loss of meaning.
WIDENED = {
    T.DoubleType: (T.FloatType, T.DecimalType, T.IntegerType, T.ShortType, T.ByteType),
    T.LongType: (T.IntegerType, T.ShortType, T.ByteType),
    T.IntegerType: (T.ShortType, T.ByteType),
    T.BooleanType: (T.ByteType,),
}


def conform(df, schema: T.StructType):
    """Check that a table carries the declared columns; narrower types are cast to the declared ones."""
    casts = {}
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"column {field.name} is missing")
        found = have[field.name]
        both_times = isinstance(found, (T.TimestampType, T.TimestampNTZType)) and isinstance(
            field.dataType, T.TimestampNTZType
        )
        if isinstance(found, WIDENED.get(type(field.dataType), ())):
            casts[field.name] = df[field.name].cast(field.dataType)
        elif found != field.dataType and not both_times:
            raise ValueError(
                f"column {field.name} is {found.simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    return df.withColumns(casts) if casts else df
