"""Delimited text: separator, header, malformed records, decisions on odd input."""

import pytest

from featureloom import (
    clean_key, detect_delimiter, expected_columns, fix_decimal_comma, label_column,
    malformed_records, null_token, read_delimited, require_columns, split_malformed, strip_ansi,
    take_columns, to_double, verify_table,
)
from featureloom.plans.matrices import distinct_records
from featureloom.sources.delimited import field_count
from featureloom.sources.lines import number_lines

# An invented table: semicolons, decimal commas, one record with an extra field.
SAMPLE = """NAME_ID;NOTATION;TARGET_X
w-01;CCOC(=O)c1ccccc1;2,25
w-02;C1CCNCC1;-0,4
w-03;OCC(O)CO;0,75
w-04;CC(=O)Nc1ccc(O)cc1;3,5
w-05;N#CCC1CC1;1,05
w-06;CC(N)C(=O)O;-1,5
w-07;c1ccoc1;6
w-08;CCS;0,33;one field more
w-09;CC(C)=O;0,08
w-10;ClCCBr;4,9
"""


def put(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_sample(spark, tmp_path):
    path = put(tmp_path, SAMPLE)
    assert detect_delimiter(spark, path) == ";"
    assert expected_columns(spark, path, ";") == ["NAME_ID", "NOTATION", "TARGET_X"]
    v = verify_table(spark, path)
    rows = distinct_records(v.rows).orderBy("ord").collect()
    assert [r.label for r in rows] == [2.25, -0.4, 0.75, 3.5, 1.05, -1.5, 6.0, 0.08, 4.9]
    assert rows[0].name == "w-01"
    bad = malformed_records(spark, path).collect()
    assert [(r.record_no, r.expected, r.found, r.kept) for r in bad] == [(9, 3, 4, False)]
    assert [(r.raw, r.found) for r in v.rejects.collect()] == [
        ("w-08;CCS;0,33;one field more", 4)
    ]
    # A projection to one column must not change which records count as malformed.
    assert v.rows.select("name").count() == 9


@pytest.mark.parametrize("text,sep", [("A,B;C\n", ","), ("a;b;c\n1,5;2;3\n", ";"), ("a\tb\tc\n", "\t")])
def test_separator(spark, tmp_path, text, sep):
    assert detect_delimiter(spark, put(tmp_path, text)) == sep


def test_missing_and_empty_input(spark, tmp_path):
    with pytest.raises(ValueError):
        detect_delimiter(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        detect_delimiter(spark, put(tmp_path, ""))


def test_long_short_and_blank_records(spark, tmp_path):
    path = put(tmp_path, "n;s;l\n1;x;2;err\n3;y\n\n4;z;5\n")
    df = read_delimited(spark, path)
    good, rejects = split_malformed(df, ";")
    assert sorted((r.n, r.s, r.l) for r in good.collect()) == [("3", "y", None), ("4", "z", "5")]
    assert [r.raw for r in rejects.collect()] == ["1;x;2;err"]
    strict, rejects = split_malformed(df, ";", "reject")
    assert [r.n for r in strict.collect()] == ["4"]
    assert sorted(r.found for r in rejects.collect()) == [2, 4]
    report = malformed_records(spark, path).collect()
    assert sorted((r.record_no, r.found, r.kept) for r in report) == [
        (2, 4, False), (3, 2, True), (4, 0, False)
    ]
    assert good.count() == 2 and good.select("n").count() == 2


def test_quoted_fields(spark, tmp_path):
    path = put(tmp_path, 'n,s,l\n"a,b",x,1\n"say ""hi""",y,2\nc,z,3,4\n')
    good, rejects = split_malformed(read_delimited(spark, path), ",")
    assert sorted(r.n for r in good.collect()) == ["a,b", 'say "hi"']
    assert rejects.count() == 1
    df = spark.createDataFrame([('"a,b",x,1',), ("",), ("a,b",), ('5" pipe,x,"y,z"',)], "r string")
    assert [r[0] for r in df.select(field_count("r", ",")).collect()] == [3, 0, 2, 3]


def test_multi_line(spark, tmp_path):
    path = put(tmp_path, 'n,s,l\n"a\nb",x,1\nc,y,2,9\n')
    good, rejects = split_malformed(read_delimited(spark, path, multi_line=True), ",")
    assert [r.n for r in good.collect()] == ["a\nb"]
    assert rejects.count() == 1


def test_line_numbers_over_many_splits(spark, tmp_path):
    for f in range(3):
        put(tmp_path, "".join(f"{f}-{i}\n" for i in range(5000)), f"f{f}.txt")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = number_lines(spark.read.text(str(tmp_path / "*.txt"))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 15000
    assert all(int(r.value.split("-")[1]) == r.line_no for r in rows)


def test_cells(spark):
    one = lambda value, fn: spark.createDataFrame([(value,)], "c string").select(fn("c")).first()[0]
    fixes = {"1,19": 1.19, "0,0": 0.0, "-0,15": -0.15, ",5": 0.5, "5,": 5.0, "1,2,3": None, "1.2,3": None}
    for raw, want in fixes.items():
        assert one(raw, lambda c: to_double(fix_decimal_comma(c))) == want, raw
    keys = {" a (b)/c ": "a_b__c", "a#b": "a_b", "007": "007", "\t x ": "x", "a\\b": "a_b"}
    for raw, want in keys.items():
        assert one(raw, clean_key) == want, raw
    for raw in ("NA", "None", "nan", "", "NULL", "n/a"):
        assert one(raw, null_token) is None
    assert one("Nan", null_token) == "Nan"
    assert one("\x1b[38;5;46mok\x1b[0m\x1bM!", strip_ansi) == "ok!"


def test_first_of_each_name_in_input_order(spark, tmp_path):
    body = "".join(f"k{i % 50},C,{i}\n" for i in range(2000))
    rows = distinct_records(verify_table(spark, put(tmp_path, "n,s,l\n" + body)).rows).collect()
    assert {r.name: r.label for r in rows} == {f"k{i}": float(i) for i in range(50)}


def test_missing_values_drop_rows(spark, tmp_path):
    v = verify_table(spark, put(tmp_path, "n,s,l\nNone,C,1\na,C,\nb,C,2\n"))
    assert [r.name for r in v.rows.collect()] == ["b"]
    assert {r.column: r.n for r in v.nulls.collect()} == {"n": 1, "s": 0, "l": 1}


def test_label_column_and_required_columns(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], "n string, s string, LABEL string, x string")
    three = take_columns(df)
    assert label_column(three, 3) == "LABEL"
    for k in (0, 1, 4):
        with pytest.raises(ValueError):
            label_column(three, k)
    with pytest.raises(ValueError):
        require_columns(df, ["SMILES"])


def test_long_quoted_field(spark):
    """A quoted field of a megabyte must not exhaust the stack."""
    raw = 'a,"' + "x" * 1_000_000 + '""y",z,"u,v"'
    assert spark.createDataFrame([(raw,)], "r string").select(field_count("r", ",")).first()[0] == 4


def test_quoted_line_breaks_in_the_report(spark, tmp_path):
    path = put(tmp_path, 'n,s,l\n"a\nb",x,1\nc,y,2,9\n"d\n\ne",z\nf,w,3\n')
    report = sorted((r.record_no, r.found, r.kept) for r in malformed_records(spark, path, multi_line=True).collect())
    assert report == [(3, 4, False), (4, 2, True)]


def test_every_file_must_have_the_header_of_the_first(spark, tmp_path):
    put(tmp_path, "n,s,l\na,C,1\n", "a.csv")
    put(tmp_path, "s,n,l\nCC,b,2\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path)).collect()


def test_blank_in_the_path(spark, tmp_path):
    path = put(tmp_path, "n;s;l\na;C;1,5\n", "a b.csv")
    assert [r.label for r in verify_table(spark, path).rows.collect()] == [1.5]


def test_labels_may_be_words(spark, tmp_path):
    path = put(tmp_path, "n,s,l\na,C,active\nb,CC,inactive\nc,CCC,1\n")
    assert {r.name: r.label for r in verify_table(spark, path).rows.collect()} == {"a": "active", "b": "inactive", "c": "1"}
    numbers = put(tmp_path, "n,s,l\na,C,1\nb,CC,2.5\n", "n.csv")
    assert [r.label for r in verify_table(spark, numbers).rows.orderBy("name").collect()] == [1.0, 2.5]
    assert [r.label for r in verify_table(spark, numbers, label_kind="text").rows.orderBy("name").collect()] == ["1", "2.5"]


def test_files_with_one_key_are_rejected(spark, tmp_path):
    from featureloom import read_vectors

    for folder, values in (("p", "1\n2\n"), ("q", "3\n4\n"), ("r", "5\n6\n7\n8\n")):
        (tmp_path / folder).mkdir()
        put(tmp_path / folder, values, "x.csv" if folder != "r" else "y.csv")
    vectors, rejects = read_vectors(spark, str(tmp_path), 4)
    assert [(r.name, r.features) for r in vectors.collect()] == [("y", [5.0, 6.0, 7.0, 8.0])]
    assert [tuple(r) for r in rejects.collect()] == [("x", 4, 4, 2)]
