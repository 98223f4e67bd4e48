"""Lineage cuts for multi-branch plans.

The attribution report joins the store-level frame with a dozen of its own
aggregates; the flag frames sit on Box-Cox grid searches and a Python-side
segmentation. Without a cut each branch would recompute that chain.
``materialize`` writes the frame as Parquet to the shared folder (see
``session.shared_folder``) and returns a frame reading it back with column
pruning and pushed filters. It runs a job at once; ``session.release`` deletes
the table when the caller is done with every frame built on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesguard.session import cut


def materialize(df: DataFrame, enabled: bool = True) -> DataFrame:
    return cut(df, "plan") if enabled else df
