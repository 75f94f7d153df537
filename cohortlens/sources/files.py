"""File sources: session maps, confound tables, segmentation statistics text,
file inventories, and partitioned Parquet stores of features / predictions.

All readers declare their schema (no inference) and turn NaN into NULL.
Keys (subject, session, run, ...) come from the file path via
``_metadata.file_path``, so one read covers a whole directory tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators import checks as C
from cohortlens.operators.tidy import session_map
from cohortlens.sources.sinks import FILE_START

# fixed values: path entity patterns (BIDS-style names)
ENTITY_PATTERNS = {
    "subject": r"sub-([A-Za-z0-9]+)",
    "session": r"ses-([A-Za-z0-9]+)",
    "task": r"task-([A-Za-z0-9]+)",
    "run": r"run-([0-9]+)",
}
SUFFIX_PATTERN = r"_([A-Za-z0-9]+)\.(nii\.gz|nii|tsv|json|stats|parquet)$"
# segmentation measure header: "# Measure <structure>, <name>, <description>, <value>, <unit>"
MEASURE_PATTERN = r"^# Measure [^,]+, ([^,]+), .*, ([-0-9.eE]+), "


def path_col() -> Column:
    return F.col("_metadata.file_path")


def bundled_files(records: DataFrame) -> DataFrame:
    """(path, value) of the files in a bundle, from rows read with ``lineSep`` FILE_START.  Further columns are passed through."""
    name = F.substring_index("value", "\n", 1)
    further = [c for c in records.columns if c != "value"]
    return records.filter(F.length("value") > 0).select(
        *further, name.alias("path"), F.substring("value", F.length(name) + 2, F.length("value")).alias("value"))


def parse_entities(path: Column, default_run: int = 1) -> list[Column]:
    """SRC6: subject, session, task, run (missing -> default), suffix, ext from a path.

    Entities are taken from the file name (last path component) first and
    from the directories otherwise (``subject=..`` partition folders count)."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    out = []
    for ent, pat in ENTITY_PATTERNS.items():
        v = F.nullif(F.regexp_extract(name, pat, 1), F.lit(""))
        alt = F.nullif(F.regexp_extract(path, pat, 1), F.lit(""))
        part = F.nullif(F.regexp_extract(path, rf"/{ent}=([^/]+)", 1), F.lit(""))
        c = F.coalesce(v, alt, part)
        if ent == "run":
            c = F.coalesce(c.cast("int"), F.lit(default_run))
        out.append(c.alias(ent))
    out.append(F.nullif(F.regexp_extract(name, SUFFIX_PATTERN, 1), F.lit("")).alias("suffix"))
    out.append(F.nullif(F.regexp_extract(name, SUFFIX_PATTERN, 2), F.lit("")).alias("ext"))
    return out


# ---------------------------------------------------------------- SRC1, SRC2

SESSION_MAP_SCHEMA = T.StructType([T.StructField("participant_id", T.StringType()),
                                   T.StructField("session_id", T.StringType())])


def read_session_map(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: TSV (participant_id, session_id) -> (subject, session) without prefixes."""
    if not path.rstrip("/").endswith(".tsv") and "*" not in path:
        raise ValueError(f"session map must be a .tsv file: {path}")
    raw = spark.read.csv(path, sep="\t", header=True, schema=SESSION_MAP_SCHEMA)
    return session_map(raw)


def session_map_literal(spark: SparkSession, subject: str, session: str) -> DataFrame:
    """SRC1, literal form: exactly one subject with its session."""
    return spark.createDataFrame([(subject, session)], "subject string, session string")


SELECTED_SESSIONS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                         ["subject", "bl_mr_session", "bl_clinical_session", "bl_psych_session"]])


def read_selected_sessions(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: CSV with four string columns; empty cells are NULL."""
    return spark.read.csv(path, header=True, schema=SELECTED_SESSIONS_SCHEMA)


# ---------------------------------------------------------------- SRC3

def read_confounds(spark: SparkSession, path: str, columns: Sequence[str], null_value: str = "n/a",
                   key_cols: Sequence[str] = ("subject", "session", "task", "run"), bundled: bool = False) -> DataFrame:
    """SRC3: tab-separated confound tables, one file per run, header line first; ``bundled``: many
    such files in each text file below ``path``.

    Row order matters (it is time), and Spark rows have none, so each file is
    read whole (a run's table is small) and its lines are numbered: ``t`` is
    the 0-based line index after the header.  ``null_value`` and NaN -> NULL.
    """
    if bundled:
        files = bundled_files(spark.read.text(path, lineSep=FILE_START))
    else:
        files = spark.read.text(path, wholetext=True).select(path_col().alias("path"), "value")
    # the path is looked at once per file, not per line
    rows = files.select(*parse_entities(F.col("path")), F.split(F.regexp_replace("value", r"\r", ""), "\n").alias("ls"))
    ents = [c for c in rows.columns if c != "ls"]
    body = rows.select(*ents, F.split(F.get("ls", 0), "\t").alias("hdr"), F.posexplode("ls").alias("ln", "line"))
    body = body.filter((F.col("ln") > 0) & (F.length("line") > 0))
    cells = F.split("line", "\t")
    cols = []
    for c in columns:
        pos = F.array_position(F.col("hdr"), F.lit(c))
        raw = F.when(pos > 0, F.element_at(cells, pos.cast("int")))
        v = F.when(raw == F.lit(null_value), F.lit(None)).otherwise(raw).cast("double")
        cols.append(F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v).alias(c))
    return body.select(*key_cols, (F.col("ln") - 1).cast("bigint").alias("t"), *cols)


# ---------------------------------------------------------------- SRC4, SRC5

# fixed values: column positions in the two statistics table layouts
ASEG_COLUMNS = {"struct": 4, "Volume_mm3": 3}
APARC_COLUMNS = {"struct": 0, "GrayVol": 3, "ThickAvg": 4}


def read_stats_text(spark: SparkSession, path: str, kind: str | None = None, bundled: bool = False) -> DataFrame:
    """SRC4/SRC5: segmentation statistics text files -> long
    (subject, hemi, kind, struct, measure, value).

    * ``# Measure`` header lines give (struct = measure name, measure = 'measure');
      a malformed header line (missing comma) simply does not match.
    * table rows (non-comment) are split on whitespace; aseg files give
      Volume_mm3 per structure, aparc files GrayVol and ThickAvg.
    ``kind`` is 'aseg' or 'aparc' from the file name unless given, ``hemi``
    lh/rh (or NULL).  ``bundled``: many such files in each text file below ``path``.
    """
    if bundled:
        lines = bundled_files(spark.read.text(path, lineSep=FILE_START)).select("path", F.explode(F.split("value", "\n")).alias("line"))
    else:
        lines = spark.read.text(path).select(path_col().alias("path"), F.col("value").alias("line"))
    return parse_stats_lines(lines, kind)


def parse_stats_lines(lines: DataFrame, kind: str | None = None) -> DataFrame:
    """SRC4/SRC5 parser over (path, line) rows — shared by the batch reader and
    the incremental (streaming) job.  Further columns are passed through.  Each
    line is looked at once."""
    further = [c for c in lines.columns if c not in ("path", "line")]
    fname = F.regexp_extract("path", r"([^/]+)$", 1)
    lines = lines.select(
        *further, "line", F.split(F.trim("line"), r"\s+").alias("f"),
        (F.lit(kind) if kind else F.when(fname.startswith("aseg"), F.lit("aseg")).otherwise(F.lit("aparc")))
        .alias("kind"),
        F.coalesce(F.nullif(F.regexp_extract(fname, r"^(lh|rh)\.", 1), F.lit("")),
                   F.nullif(F.regexp_extract("path", r"/hemi=(lh|rh)/", 1), F.lit(""))).alias("hemi"),
        F.coalesce(F.nullif(F.regexp_extract("path", ENTITY_PATTERNS["subject"], 1), F.lit("")),
                   F.nullif(F.regexp_extract("path", r"/subject=([^/]+)", 1), F.lit(""))).alias("subject"))

    def item(struct, measure, value):
        return F.struct(struct.alias("struct"), F.lit(measure).alias("measure"), value.cast("double").alias("value"))

    def cell(columns, name):
        return F.get("f", columns[name])

    found = (F.when(F.col("line").rlike(MEASURE_PATTERN), F.array(
                 item(F.regexp_extract("line", MEASURE_PATTERN, 1), "measure",
                      F.regexp_extract("line", MEASURE_PATTERN, 2))))
             .when(F.col("line").startswith("#") | (F.length(F.trim("line")) == 0), F.lit(None))
             .when(F.col("kind") == "aseg", F.array(
                 item(cell(ASEG_COLUMNS, "struct"), "Volume_mm3", cell(ASEG_COLUMNS, "Volume_mm3"))))
             .otherwise(F.array(*[item(cell(APARC_COLUMNS, "struct"), m, cell(APARC_COLUMNS, m))
                                  for m in ("GrayVol", "ThickAvg")])))
    return lines.select("subject", *further, "hemi", "kind", F.inline(found))


# ---------------------------------------------------------------- SRC6

def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """SRC6: every file below ``root`` with its path entities (content not read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root).select("path", "length"))
    return files.select("path", "length", *parse_entities(F.col("path")))


# ---------------------------------------------------------------- SRC7 - SRC13 (Parquet stores)

FEATURE_SCHEMA = "subject string, name string, value double, kind string, session string"


def load_features(spark: SparkSession, base: str, kind: str, subjects: DataFrame | None = None,
                  one_per_key: bool = False) -> DataFrame:
    """SRC7: long features of one kind from a store partitioned by kind/session.

    Explicit schema (a session folder like 'ses-0129' must not become an
    integer); partition pruning on ``kind``; optional left-semi join on the
    requested subjects.  ``one_per_key``: a (subject, session, name) with several
    rows (several files, or a file with several rows) is an error, and so is
    a requested subject without any."""
    df = spark.read.schema(FEATURE_SCHEMA).parquet(base).filter(F.col("kind") == kind)
    if subjects is not None:
        df = df.join(subjects.select("subject"), "subject", "left_semi")
    if one_per_key:
        C.assert_none(C.duplicate_keys(df, ["subject", "session", "name"]), f"several values for a subject in the features {kind}")
        if subjects is not None:
            C.assert_none(C.missing_keys(subjects, df), f"requested subjects without features {kind}")
    return df


def load_table(spark: SparkSession, path: str, subjects: DataFrame | None = None, complete: bool = False) -> DataFrame:
    """SRC8: a subject table (clinical, targets) restricted to requested subjects; ``complete``:
    each of them must be in it, once."""
    df = spark.read.parquet(path)
    if subjects is not None:
        df = df.join(subjects.select("subject"), "subject", "left_semi")
        if complete:
            C.assert_none(C.missing_keys(subjects, df), f"requested subjects missing in {path}")
            C.assert_none(C.duplicate_keys(df, ["subject"]), f"subjects occur more than once in {path}")
    return df


def read_sample_weights(spark: SparkSession, path: str, y: DataFrame) -> DataFrame:
    """SRC9: weights left-aligned to the target rows."""
    w = spark.read.parquet(path).select("subject", "weight")
    return y.select("subject").join(w, "subject", "left")


def load_predictions(spark: SparkSession, base: str, model: str, modalities: Sequence[str],
                     permuted: bool = False, kind: str | None = None) -> DataFrame:
    """SRC10: predictions of one model for some modalities (partition pruning).  In a store with kinds
    those of the test rows, with ``permuted`` those fitted on permuted targets, or those of ``kind``."""
    df = spark.read.parquet(base).filter((F.col("model") == model) & F.col("modality").isin(list(modalities)))
    if "kind" in df.columns:
        return df.filter(F.col("kind") == (kind or ("permuted" if permuted else "test")))
    if permuted or kind not in (None, "test"):
        raise ValueError(f"{base} has no column 'kind', so no permuted predictions or those of train rows")
    return df


def load_gs(spark: SparkSession, base: str, model: str, modalities: Sequence[str]) -> DataFrame:
    """SRC11: grid-search results; numeric parameter gaps (unlimited depth) -> 0."""
    df = spark.read.parquet(base).filter((F.col("model") == model) & F.col("modality").isin(list(modalities)))
    return df.fillna(0)


def load_learning_curves(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: learning-curve scores (modality, train_size, kind, cv_0..) -> long."""
    from cohortlens.operators.tidy import unpivot_scores
    df = spark.read.parquet(path)
    cv = [c for c in df.columns if c.startswith("cv_")]
    return unpivot_scores(df, ["modality", "train_size", "kind"], cv)


def load_feature_importances(spark: SparkSession, path: str, n_splits: int | None = None) -> DataFrame:
    """SRC13: stored importances; ``n_splits`` keeps splits 0..n-1 (numeric order)."""
    df = spark.read.parquet(path)
    return df.filter(F.col("split") < n_splits) if n_splits else df
