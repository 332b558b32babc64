"""Column layout of the input files.

Rating rows stay narrow: everything that depends on the item alone (title, tags and what is
derived from them) stays in the items table and is joined by ``item_id`` where it is needed.
``item_id`` is the key of the items table.
"""

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("ts", T.LongType()),
    ]
)

ITEMS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("tags", T.StringType()),
    ]
)

# Rating rows also carry a key that tells every row from every other.
RATING_ROW = ["rating_key", "user_id", "item_id", "rating", "ts"]
