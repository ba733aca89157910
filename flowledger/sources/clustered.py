"""Tables laid out by entity: a look-up of a few entities opens the files of their buckets only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import conform

BUCKETS = 64


def write_clustered(df: DataFrame, name: str, schema: StructType | None = None, entity: str = "WellID",
                    order: Sequence[str] = ("ProductionMonth",), buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Overwrite a table whose files hold ranges of (bucket of the entity, entity, order); returns it.

    Rows are dealt by ranges that follow the buckets, so a task writes few files and an entity of any size is cut into
    several, rows that are all alike by their place in the input. Files are sorted, so row groups are skipped as
    well. An equality or IN list on the entity, joins and windows by it use the buckets without a hint. Null
    entities form a bucket's first rows. With `path` the table is external.
    """
    out = conform(df, schema) if schema is not None else df
    # The bucket as Spark numbers it, so that a task's rows belong to few buckets.
    bucket = F.pmod(F.hash(F.col(entity)), F.lit(buckets))
    place = F.monotonically_increasing_id()
    dealt = out.repartitionByRange(bucket, F.col(entity), *order, place)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, entity).sortBy(entity, *order)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
