"""The silver layer, the same for dated jobs and for snapshots as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rulspark.operators.ordering import with_ordinal
from rulspark.operators.projection import flatten_arrays, with_unit_id


def silver_frame(bronze: DataFrame, aux_layout: str = "with_dataset") -> DataFrame:
    """Bronze rows flattened and typed; ``seq`` becomes the dense position of a sample in its
    engine's series of the snapshot.

    Rows of the first split come before those of the second, as they were stacked.
    """
    flat = flatten_arrays(bronze, aux_layout=aux_layout, carry=["split", "seq"])
    numbered = with_ordinal(
        with_unit_id(flat), ["snapshot_date", "unit"], ["time", "split", "seq"], "_index"
    )
    return numbered.drop("unit", "split", "seq").withColumnRenamed("_index", "seq")
