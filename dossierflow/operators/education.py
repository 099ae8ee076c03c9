"""Education jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierflow.functions import education as E
from dossierflow.functions import text as T
from dossierflow.operators.common import explode_rows, reused, settle


@reused
def _studies() -> Column:
    return E.study_items(F.col("_text"))


def education_items(
    df: DataFrame, *, text: str = "education", keys: tuple[str, ...] = ("source_url",)
) -> DataFrame:
    """One row per study item: ``(*keys, item_no, place, degree, specialty, start,
    end, months, extra)``. A second line with years in one item replaces the first."""
    normal = settle(df.select(*keys, F.col(text)), _text=T.normal_text(F.col(text)))
    rows = explode_rows(normal, list(keys), _studies(), "e", "item_no")
    return rows.select(*keys, "item_no", "e.*")
