"""Text files in bundles: the same rows as one file each, a bounded number of files, odd names."""

import glob
import os

import pytest

import __spark_entry__ as E
from cohortlens.sources import files as SRC
from cohortlens.sources import sinks as SNK

from conftest import SF001


def _many_subjects(spark, tmp_path, n=150):
    for name in ("supplier", "lineitem", "events"):
        spark.read.parquet(f"{SF001}/{name}.parquet").createOrReplaceTempView("t")
        more = {"supplier": f"SELECT s.* EXCEPT (s_suppkey), 1000 + k AS s_suppkey FROM (SELECT * FROM t LIMIT 1) s, (SELECT explode(sequence(1, {n})) k)",
                "lineitem": f"SELECT * EXCEPT (l_suppkey), l_orderkey % {n} AS l_suppkey FROM t",
                "events": f"SELECT * EXCEPT (user_id), event_id % {n} AS user_id FROM t"}[name]
        spark.sql(more).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("query, folder", [("src_confounds_tsv", "confounds"), ("src_stats_text", "stats"), ("fs_structural_tables", "structural"),
                                           ("stream_incremental_features", "stream-stats")])
def test_no_file_per_subject(spark, tmp_path, query, folder):
    sf, base = _many_subjects(spark, tmp_path), spark.conf.get("spark.checkpoint.dir")
    find = lambda: set(glob.glob(os.path.join(base, f"{folder}-*", "**", "*.txt"), recursive=True))
    before = find()
    assert len({r["subject"] for r in E.queries()[query](spark, sf).select("subject").collect()}) == 150
    assert 0 < len(find() - before) < 50


def test_bundled_confounds_like_single_files(spark, tmp_path):
    tables = {"sub-A1_run-2_conf.tsv": ["x\ty", "1\tn/a", "2.5\t3", "n/a\tNaN"], "sub-B_conf.tsv": ["y\tx", "7\t8"], "sub-C_conf.tsv": ["x\ty"]}
    for name, lines in tables.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = [(f"/{name}", k, line) for name, lines in tables.items() for k, line in enumerate(lines)]
    SNK.write_bundled_lines(spark.createDataFrame(rows, "file string, o int, line string"), str(tmp_path / "lines"))
    SNK.write_bundled_files(spark.createDataFrame([(f"/{n}", ls) for n, ls in tables.items()], "file string, lines array<string>"), str(tmp_path / "files"))
    want = sorted(map(str, SRC.read_confounds(spark, str(tmp_path / "*.tsv"), ["x", "y"]).collect()))
    assert len(want) == 4
    for form in ("lines", "files"):
        assert sorted(map(str, SRC.read_confounds(spark, str(tmp_path / form), ["x", "y"], bundled=True).collect())) == want


def test_file_without_subject_and_mark_in_a_line(spark, tmp_path):
    rows = spark.createDataFrame([(None, 0, "5"), ("/sub-1/a", 1, "6"), ("/sub-1/a", 0, "4")], "file string, o int, line string")
    SNK.write_bundled_lines(rows, str(tmp_path / "a"), header="x")
    got = SRC.read_confounds(spark, str(tmp_path / "a"), ["x"], bundled=True).select("subject", "t", "x").collect()
    assert sorted(map(tuple, got), key=str) == [("1", 0, 4.0), ("1", 1, 6.0), (None, 0, 5.0)]
    with pytest.raises(Exception, match="mark of a file"):
        SNK.write_bundled_lines(rows.selectExpr("file", "o", "concat(line, '\x1e') AS line"), str(tmp_path / "b"))
