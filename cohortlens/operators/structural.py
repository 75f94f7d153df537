"""Structural features from segmentation statistics (FS1-FS3), all subjects
in one plan.

Input: the long statistics table of ``sources.files.read_stats_text``
(subject, hemi, kind, struct, measure, value).  Output: long features
(subject, table, name, value) named ``fs__{table}__{column}`` or, for bounded
name lists, one wide row per subject.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import safe_div

# fixed values: subcortical structures kept (14)
SUBCORTICAL = ["Left-Thalamus-Proper", "Right-Thalamus-Proper",
               "Left-Caudate", "Right-Caudate",
               "Left-Putamen", "Right-Putamen",
               "Left-Pallidum", "Right-Pallidum",
               "Left-Hippocampus", "Right-Hippocampus",
               "Left-Amygdala", "Right-Amygdala",
               "Left-Accumbens-area", "Right-Accumbens-area"]

# fixed values: global measures kept (19), plus the two mean thicknesses
GLOBAL = ["3rd-Ventricle", "4th-Ventricle",
          "Left-Lateral-Ventricle", "Right-Lateral-Ventricle",
          "lhCortexVol", "rhCortexVol",
          "lhCerebralWhiteMatterVol", "rhCerebralWhiteMatterVol",
          "Left-Cerebellum-White-Matter", "Right-Cerebellum-White-Matter",
          "Left-Cerebellum-Cortex", "Right-Cerebellum-Cortex",
          "CC_Posterior", "CC_Mid_Posterior", "CC_Central", "CC_Mid_Anterior",
          "CC_Anterior",
          "SubCortGrayVol", "TotalGrayVol"]
MEAN_THICKNESS = ["lh_MeanThickness_thickness", "rh_MeanThickness_thickness"]

ETIV = "eTIV"


def etiv_normalise(long: DataFrame, keys: Sequence[str] = ("subject",), value: str = "value",
                   etiv: DataFrame | None = None) -> DataFrame:
    """FS1: value / eTIV of the same subject (the eTIV row itself is dropped).

    ``etiv`` is (keys..., etiv); by default taken from rows with struct 'eTIV'.
    One eTIV per subject: a small table joined on the subject key."""
    keys = list(keys)
    if etiv is None:
        etiv = long.filter(F.col("struct") == ETIV).groupBy(*keys).agg(F.first(value).alias("etiv"))
    body = long.filter(F.col("struct") != ETIV)
    return body.join(etiv, keys).withColumn(value, safe_div(F.col(value), F.col("etiv"))).drop("etiv")


def collect_tables(stats: DataFrame, keys: Sequence[str] = ("subject",)) -> DataFrame:
    """FS2: the four structural tables in long form (keys, table, name, value).

    subcortVolume : 14 aseg structures / eTIV
    globalVolume  : 2 mean thicknesses (not scaled) + 19 aseg measures / eTIV
    cortThickness : lh/rh parcel ThickAvg, '{hemi}_{parcel}_thickness'
    cortVolume    : lh/rh parcel GrayVol / eTIV, '{hemi}_{parcel}_volume'
    '&' in names becomes '_'.  JOIN2/JOIN3 are one pass over the rows, which
    are told apart by a CASE; scaled values need the eTIV of their keys.
    """
    keys = list(keys)
    kind, measure, struct = F.col("kind"), F.col("measure"), F.col("struct")
    etiv = (stats.filter((kind == "aseg") & (measure == "measure") & (struct == ETIV))
            .groupBy(*keys).agg(F.first("value").alias("etiv")))
    thickness = (kind == "aparc") & (measure == "measure") & (struct == "MeanThickness")
    table = (F.when((kind == "aseg") & struct.isin(SUBCORTICAL), "subcortVolume")
             .when(((kind == "aseg") & struct.isin(GLOBAL)) | thickness, "globalVolume")
             .when((kind == "aparc") & (measure == "ThickAvg"), "cortThickness")
             .when((kind == "aparc") & (measure == "GrayVol"), "cortVolume"))
    parcel = F.translate("struct", "&", "_")
    name = (F.when(kind == "aseg", struct)
            .when(thickness, F.concat("hemi", F.lit("_MeanThickness_thickness")))
            .otherwise(F.concat("hemi", F.lit("_"), parcel,
                                F.when(measure == "ThickAvg", "_thickness").otherwise("_volume"))))
    plain = thickness | (F.col("table") == "cortThickness")
    rows = stats.withColumn("table", table).filter("table IS NOT NULL").join(etiv, keys, "left")
    rows = rows.filter(plain | F.col("etiv").isNotNull())
    return rows.select(*keys, "table", F.concat(F.lit("fs__"), "table", F.lit("__"), name).alias("name"),
                       F.when(plain, F.col("value")).otherwise(safe_div(F.col("value"), F.col("etiv"))).alias("value"))


def struct_features(tables: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """FS3: one row per subject; ``names`` fixes the (bounded) column list."""
    if names is None:
        names = [r["name"] for r in tables.select("name").distinct().orderBy("name").collect()]
    return tables.groupBy("subject").pivot("name", list(names)).agg(F.first("value"))
