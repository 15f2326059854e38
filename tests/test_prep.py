"""Delimited-table preparation (S5, A7, P10; D13)."""

from textfiles import write_text
from loomlog.operators import prep
from loomlog.sources import text

SCHEMA = "a double, b double, quality int"


def test_header_dropped_once_per_file(spark, workdir):
    write_text(f"{workdir}/w/red.csv", "a;b;quality\n1.0;2.0;5\n1.0;2.0;5\n3.5;0.1;6\n")
    write_text(f"{workdir}/w/white.csv", "a;b;quality\n1.0;2.0;5\n")
    df = text.read_delimited(spark, f"{workdir}/w", SCHEMA)
    assert df.count() == 4                       # headers gone, equal data rows kept (D13)
    d = prep.duplicate_rows(df).collect()[0]
    assert (d.n_rows, d.n_distinct, d.n_duplicates) == (4, 2, 2)


def test_labeled_points(spark, workdir):
    write_text(f"{workdir}/w2/x.csv", "a;b;quality\n1.0;2.0;5\n3.5;0.1;6\n")
    pts = prep.labeled_points(text.read_delimited(spark, f"{workdir}/w2", SCHEMA))
    assert sorted((r.label, list(r.features)) for r in pts.collect()) == [(5.0, [1.0, 2.0]), (6.0, [3.5, 0.1])]
    vec = prep.to_ml_vectors(pts).collect()[0]
    assert vec.features.size == 2


def test_text_lines(spark, workdir):
    write_text(f"{workdir}/t/a.txt", "abc\nxbz\r\nAlpha\ncat\n")
    lines = text.read_lines(spark, f"{workdir}/t")
    assert [r.value for r in lines.collect()] == ["abc", "xbz\r", "Alpha", "cat"]
