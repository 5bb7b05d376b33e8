"""Record layouts of the inputs, by position in the source line."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def _layout(**fields):
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


USER_BEHAVIOR = _layout(
    user_id=LongType, item_id=LongType, category_id=IntegerType, behavior=StringType, epoch_s=LongType
)
AD_CLICK = _layout(
    user_id=LongType, ad_id=LongType, province=StringType, city=StringType, epoch_s=LongType
)
LOGIN = _layout(user_id=LongType, ip=StringType, event_type=StringType, epoch_s=LongType)
ORDER_LOG = _layout(order_id=LongType, event_type=StringType, tx_id=StringType, epoch_s=LongType)
RECEIPT = _layout(tx_id=StringType, pay_channel=StringType, epoch_s=LongType)
MARKET_BEHAVIOR = _layout(
    user_id=StringType, behavior=StringType, channel=StringType, epoch_ms=LongType
)
