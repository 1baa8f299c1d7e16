"""Feature preparation (M1): the model's columns, flags as 0/1 integers,
missing values as 0, then one vector column."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa import rules


def prepare_features(df: DataFrame, feature_cols=rules.FEATURE_COLS, bool_cols=rules.BOOL_FEATURE_COLS,
                     keep: tuple[str, ...] = ("clinician_id",), label: str | None = rules.TARGET_COL,
                     prefix: str = "") -> DataFrame:
    """Numeric feature columns (named ``prefix + name``): booleans -> int,
    NULL -> 0; decimals become DOUBLE (the vector holds doubles anyway).  With
    ``label``, rows without a label are left out: they are neither trained on
    nor evaluated."""
    cols = []
    dtypes = dict(df.dtypes)
    for c in feature_cols:
        if c in bool_cols:
            cols.append(F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(prefix + c))
        else:
            x = F.col(c).cast("double") if dtypes[c].startswith("decimal") else F.col(c)
            cols.append(F.coalesce(x, F.lit(0)).alias(prefix + c))
    extra = [F.col(k) for k in keep]
    if label:
        df = df.filter(F.col(label).isNotNull())
        extra.append(F.col(label).cast("int").alias("label"))
    return df.select(*extra, *cols)


MODEL_PREFIX = "f_"
#: Bucket numbers of the prefixed features.
BUCKET_PREFIX = "b_"


def assembler(feature_cols=rules.FEATURE_COLS, output: str = "features", prefix: str = MODEL_PREFIX) -> VectorAssembler:
    return VectorAssembler(inputCols=[prefix + c for c in feature_cols], outputCol=output, handleInvalid="keep")
