"""Golden cases carried over from the studied project's tests (as literals)."""

import math

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import checks as C
from cohortlens.operators import metrics as M
from cohortlens.operators import models as ML
from cohortlens.operators import linear as L
from cohortlens.operators import signal as S
from cohortlens.operators import tidy as TD

MATRIX = [[1, .3, .7, .2], [.3, 1, .6, .5], [.7, .6, 1, .9], [.2, .5, .9, 1]]


def _edges(spark, mat):
    rows = [(i, j, None if v is None else float(v)) for i, r in enumerate(mat) for j, v in enumerate(r)]
    return spark.createDataFrame(rows, "i int, j int, r double")


def _labels(spark, labels):
    return spark.createDataFrame(list(enumerate(labels)), "roi int, label string")


def test_upper_triangle_sorted_labels(spark):
    e = S.label_edges(S.upper_triangle(_edges(spark, MATRIX)), _labels(spark, ["r1", "r2", "r3", "r4"]))
    got = sorted((r.roi1, r.roi2, r.r) for r in e.collect())
    assert got == [("r1", "r2", .3), ("r1", "r3", .7), ("r1", "r4", .2), ("r2", "r3", .6), ("r2", "r4", .5),
                   ("r3", "r4", .9)]


def test_repeated_labels_and_network_means(spark):
    e = S.label_edges(S.upper_triangle(_edges(spark, MATRIX)), _labels(spark, ["r1", "r2", "r3", "r1"]))
    got = sorted((r.roi1, r.roi2, r.r) for r in e.collect())
    assert got == sorted([("r1", "r2", .3), ("r1", "r3", .7), ("r1", "r1", .2), ("r2", "r3", .6),
                          ("r1", "r2", .5), ("r1", "r3", .9)])
    nm = S.network_means(e.withColumn("subject", F.lit("s")), ["subject"], value="r")
    means = {r.name: round(r.r, 10) for r in nm.collect()}
    assert means == {"r1_r1": .2, "r1_r2": .4, "r1_r3": .8, "r2_r3": .6}


def test_missing_row_and_column_kept(spark):
    mat = [[v if (i != 1 and j != 1) else None for j, v in enumerate(r)] for i, r in enumerate(MATRIX)]
    e = S.upper_triangle(_edges(spark, mat))
    rows = {(r.i, r.j): r.r for r in e.collect()}
    assert len(rows) == 6 and rows[(0, 1)] is None and rows[(1, 3)] is None and rows[(0, 2)] == .7


def test_symmetry_violation(spark):
    mat = [list(r) for r in MATRIX]
    mat[0][1] = 999
    bad = S.symmetry_violations(_edges(spark, mat).withColumn("run", F.lit(0)), ["run"]).collect()
    assert {(r.i, r.j) for r in bad} == {(0, 1), (1, 0)}
    assert S.symmetry_violations(_edges(spark, MATRIX).withColumn("run", F.lit(0)), ["run"]).count() == 0


def test_concat_modalities_outer(spark):
    a = spark.createDataFrame([("s1", 1.0), ("s2", 2.0)], "subject string, a double")
    b = spark.createDataFrame([("s2", 22.0), ("s3", 33.0)], "subject string, b double")
    got = sorted(tuple(r) for r in TD.concat_modalities([a, b]).collect())
    assert got == [("s1", 1.0, None), ("s2", 2.0, 22.0), ("s3", None, 33.0)]


def test_fillna_missing_in_attributes(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0), ("y", 3.0, 4.0), ("z", 5.0, None)], "subject string, a double, b double")
    out = TD.fillna_missing_in_attributes(df)
    assert out.columns == ["subject", "a", "b", "b_missing"]
    assert sorted(tuple(r)[1:] for r in out.collect()) == [(1.0, 2.0, 2.0), (3.0, 4.0, 4.0), (5.0, -999.0, 999.0)]


def test_check_missings_message(spark):
    df = spark.createDataFrame([("s1", None, 1.0, 1.0), ("s2", 1.0, None, 2.0), ("s3", 2.0, 3.0, 3.0)],
                               "subject string, a double, b double, c double")
    with pytest.raises(C.CheckFailed) as e:
        C.check_missings(df, ["b"])
    assert str(e.value) == "Columns ['a'] contain missings, but are not included in the allowed_missing_cols"


def test_imputer_feature_names(spark):
    x = spark.createDataFrame([(f"s{i}", v1, v2) for i, (v1, v2) in
                               enumerate(zip([1.0, 2.0, 3.0, 4.0, None, 5.0], [11.0, 12.0, 13.0, 14.0, 15.0, 16.0]))],
                              "subject string, v1 double, v2 double")
    y = spark.createDataFrame([(f"s{i}", float(i)) for i in range(6)], "subject string, t double")
    members = spark.createDataFrame([(0, f"s{i}", "train") for i in range(6)], "split int, subject string, role string")
    rows = L.design_rows(x, ["v1", "v2"], y, ["t"], members)
    _, names = ML.prepare(rows, feature_names=["v1", "v2"])
    assert names == ["v1", "v2", "v1_missing"]
    x2 = spark.createDataFrame(
        [(f"s{i}", v1, v2, f1, f1) for i, (v1, v2, f1) in
         enumerate(zip([1.0, 2.0, 3.0, 4.0, None, 5.0], [11.0, 12.0, 13.0, 14.0, 15.0, 16.0],
                       [1.0, 2.0, 3.0, 4.0, 4.4, 5.0]))],
        "subject string, v1 double, v2 double, fmri__1 double, fmri__2 double")
    feats = ["v1", "v2", "fmri__1", "fmri__2"]
    rows2 = L.design_rows(x2, feats, y, ["t"], members)
    _, names2 = ML.prepare(rows2, pca_block=[2, 3], n_components=1, feature_names=feats)
    assert names2 == ["fmri__pca_0", "v1", "v2", "v1_missing"]


def test_compare_distributions(spark):
    eq = spark.createDataFrame([(float(v), float(v)) for v in range(1, 6)], "m1_r2 double, m2_r2 double")
    r = M.compare_distributions(eq, "m1_r2", "m2_r2").first()
    assert (r.m1_better_m2, r.m2_better_m1, r.n_splits, r.mean_diff, r.std_diff) == (0.0, 0.0, 5, 0.0, 0.0)
    sh = spark.createDataFrame([(float(a), float(b)) for a, b in zip([2, 3, 4, 5, 5], [1, 2, 3, 4, 5])],
                               "m1_r2 double, m2_r2 double")
    r = M.compare_distributions(sh, "m1_r2", "m2_r2").first()
    assert r.m1_better_m2 == 80.0 and r.m2_better_m1 == 0.0 and r.n_splits == 5
    assert math.isclose(r.mean_diff, -0.8) and math.isclose(r.std_diff, math.sqrt(0.2))


def test_train_test_overlap(spark):
    ok = spark.createDataFrame([(0, "s1", "train"), (0, "s2", "train"), (0, "s3", "test"), (0, "s4", "test")],
                               "split int, subject string, role string")
    assert C.train_test_overlap(ok).count() == 0
    bad = spark.createDataFrame([(0, "s1", "train"), (0, "s2", "train"), (0, "s1", "test"), (0, "s4", "test")],
                                "split int, subject string, role string")
    assert [r.subject for r in C.train_test_overlap(bad).collect()] == ["s1"]


def test_session_map(spark, tmp_path):
    p = tmp_path / "sessions.tsv"
    p.write_text("participant_id\tsession_id\nsub-xx1\tses-s1\nsub-xx2\tses-s2\n")
    from cohortlens.sources import files as SRC
    got = {r.subject: r.session for r in SRC.read_session_map(spark, str(p)).collect()}
    assert got == {"xx1": "s1", "xx2": "s2"}
    with pytest.raises(ValueError):
        SRC.read_session_map(spark, str(tmp_path / "sessions.csv"))


def test_confounds_36p_from_tsv(spark, tmp_path):
    from cohortlens.sources import files as SRC
    cols = ["csf", "white_matter", "global_signal", "std_dvars", "trans_x", "trans_y", "trans_z",
            "rot_x", "rot_y", "rot_z"]
    lines = ["\t".join(cols)]
    for t in range(5):
        lines.append("\t".join("n/a" if (c == "std_dvars" and t == 0) else str(t * 1.5 + k)
                               for k, c in enumerate(cols)))
    d = tmp_path / "sub-01" / "func"
    d.mkdir(parents=True)
    (d / "sub-01_task-rest_desc-confounds_regressors.tsv").write_text("\n".join(lines) + "\n")
    conf = SRC.read_confounds(spark, str(tmp_path / "sub-*" / "func" / "*.tsv"), cols)
    assert conf.filter("t = 0").first()["std_dvars"] is None
    out = S.confounds_36p(conf, ["subject", "run"], ["t"])
    feats = [c for c in out.columns if c not in ("subject", "run", "t")]
    assert len(feats) == 36 and out.count() == 5
    first = out.filter("t = 0").first()
    assert first["csf_der"] == 0.0 and first["csf_der_2"] == 0.0
    assert out.filter("t = 3").first()["trans_x_der"] == 1.5


def test_stats_text_reader(spark, tmp_path):
    from cohortlens.sources import files as SRC
    from cohortlens.operators import structural as ST
    d = tmp_path / "sub-01" / "stats"
    d.mkdir(parents=True)
    (d / "aseg.stats").write_text(
        "# Measure lhCortex, lhCortexVol, Left hemisphere cortical gray matter volume, 170118.574520, mm^3\n"
        "# Measure EstimatedTotalIntraCranialVol, eTIV, Estimated Total Intracranial Volume, 1000.0, mm^3\n"
        "# ColHeaders  Index SegId NVoxels Volume_mm3 StructName normMean normStdDev normMin normMax normRange\n"
        "  1   4   8383   100.0  Left-Hippocampus  15.0 11.6 0.0 75.0 75.0\n"
        "  2   5    346   300.0  3rd-Ventricle     33.9 14.7 5.0 75.0 70.0\n")
    (d / "lh.aparc.a2009s.stats").write_text(
        "# Measure Cortex, MeanThickness, Mean Thickness, 2.20355, mm\n"
        "# Measure Cortex, CortexVol Total cortical gray matter volume, 338698.056464, mm^3\n"
        "# Measure EstimatedTotalIntraCranialVol, eTIV, Estimated Total Intracranial Volume, 1000.0, mm^3\n"
        "G&S_frontomargin   873  690  1809  2.258 0.807 0.188 0.049 21 1.9\n")
    st = SRC.read_stats_text(spark, str(tmp_path / "sub-*" / "stats" / "*.stats"))
    meas = {(r.kind, r.struct): r.value for r in st.filter("measure = 'measure'").collect()}
    assert meas[("aseg", "eTIV")] == 1000.0 and ("aparc", "CortexVol Total cortical gray matter volume") not in meas
    assert meas[("aparc", "MeanThickness")] == 2.20355
    feats = {r.name: r.value for r in ST.collect_tables(st).collect()}
    assert feats["fs__subcortVolume__Left-Hippocampus"] == pytest.approx(0.1)
    assert feats["fs__globalVolume__3rd-Ventricle"] == pytest.approx(0.3)
    assert feats["fs__globalVolume__lh_MeanThickness_thickness"] == pytest.approx(2.20355)
    assert feats["fs__cortThickness__lh_G_S_frontomargin_thickness"] == pytest.approx(2.258)
    assert feats["fs__cortVolume__lh_G_S_frontomargin_volume"] == pytest.approx(1.809)


def test_file_inventory_and_expected(spark, tmp_path):
    from cohortlens.sources import files as SRC
    root = tmp_path / "bids"
    paths = ["sub-01/ses-s1/anat/sub-01_ses-s1_T1w.nii.gz"] + [
        f"sub-01/ses-s1/func/sub-01_ses-s1_task-rest_run-{r}_bold.nii.gz" for r in (1, 2, 3)] + [
        "sub-02/ses-s1/func/sub-02_ses-s1_task-rest_bold.nii.gz"]
    for p in paths:
        f = root / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"\x00")
    inv = SRC.file_inventory(spark, str(root), "*.nii*")
    assert inv.count() == 5
    assert inv.filter("subject = '02'").first()["run"] == 1   # missing run -> 1
    bad = {r.subject for r in C.incomplete_subjects(inv).collect()}
    assert bad == {"02"}


def test_modality_strategy_and_checkerboard(spark):
    assert TD.validate_modality("clinical+structGlobScort") == ["clinical", "structGlobScort"]
    with pytest.raises(ValueError):
        TD.validate_modality("clinical+nothing")
    mods = spark.createDataFrame([(0, "non-brain"), (1, "non-brain + func")], "pos int, modality string")
    got = [tuple(r)[2:] for r in TD.modality_membership(mods, ["non-brain", "structGS", "func"]).orderBy("pos").collect()]
    assert got == [(1, 0, 0), (2, 0, 2)]


def test_metric_prefix_order(spark):
    df = spark.createDataFrame([("pearsonr2_sob",), ("r2_mmse",), ("mae_x",)], "t string")
    got = [r[0] for r in df.select(M.strip_metric_prefix(F.col("t"))).collect()]
    assert got == ["sob", "mmse", "x"]


def test_empty_rois_limit(spark):
    roi = spark.createDataFrame([(k, 0, 0, 0) for k in range(2)] + [(10 + k, -90, -90, -90) for k in range(2)],
                                "roi long, x int, y int, z int")
    vox = spark.createDataFrame([(x, y, 0, 1.0) for x in range(-3, 4) for y in range(-3, 4)],
                                "x int, y int, z int, value double")
    empty = S.empty_rois(roi, vox, 5.0)
    assert sorted(r.roi for r in empty.collect()) == [10, 11]
    assert S.check_empty_rois(empty, 10) == 2
    with pytest.raises(RuntimeError):
        S.check_empty_rois(empty, 1)
