"""Folders whose files have separators and column orders of their own."""

import csv
import random

import pytest

from featureloom import build_matrix, file_dialects, read_dialects, verify_table

CELLS = ["a", "", "x y", '5" pipe', "with;semi", "with,comma", "tab\there", 'say "hi"', "é", '"', "1,5"]


def put(folder, seed):
    """Files of three separators, columns in shuffled order; returns the records by id."""
    rng, want = random.Random(seed), {}
    for i, sep in enumerate([",", ";", "\t", ";"]):
        names = ["id", "u", "v", "w"]
        rng.shuffle(names)
        with open(folder / f"f{i}.csv", "w", encoding="utf-8", newline="") as out:
            writer = csv.DictWriter(out, names, delimiter=sep, lineterminator="\n")
            writer.writeheader()
            for k in range(300):
                row = {"id": f"{i}-{k}", **{n: rng.choice(CELLS) for n in "uvw"}}
                writer.writerow(row)
                want[row["id"]] = (sep, *[row[n] or None for n in "uvw"])
    return want


def test_every_file_is_read_in_its_dialect_over_its_splits(spark, tmp_path):
    want = put(tmp_path, 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        good, rejects = read_dialects(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        rows = good.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.id: (r.sep, r.u, r.v, r.w) for r in rows} == want and len(rows) == len(want)
    assert rejects.count() == 0
    assert {r.file[-6:]: r.sep for r in file_dialects(spark, str(tmp_path)).collect()} == {"f0.csv": ",", "f1.csv": ";", "f2.csv": "\t", "f3.csv": ";"}


def test_widths_are_those_of_the_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffn,s\n1,2\n\n1,2,3\n4\n"",x\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("\ns;t;n\n5;6;7\n8;9\n;;;\n")
    (tmp_path / "empty.csv").write_text("")
    good, rejects = read_dialects(spark, str(tmp_path))
    assert good.columns == ["n", "s", "t", "sep", "ord"]
    assert sorted(map(repr, (tuple(r)[:4] for r in good.collect()))) == sorted(map(repr, [
        ("1", "2", None, ","), ("4", None, None, ","), ("", "x", None, ","), ("7", "5", "6", ";"), (None, "8", "9", ";")]))
    assert sorted((r.raw, r.expected, r.found) for r in rejects.collect()) == [("1,2,3", 2, 3), (";;;", 3, 4)]
    _, rejects = read_dialects(spark, str(tmp_path), short_rows="reject")
    assert sorted(r.raw for r in rejects.collect()) == ["1,2,3", "4", "8;9", ";;;"]
    with pytest.raises(Exception, match="header of"):
        read_dialects(spark, str(tmp_path), names=["n", "t"])[0].collect()


def test_refused_headers_and_empty_folders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="is empty"):
        read_dialects(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text("n,n\n1,2\n")
    with pytest.raises(Exception, match="header of"):
        read_dialects(spark, str(tmp_path))[0].collect()
    with pytest.raises(ValueError, match="reserved"):
        read_dialects(spark, str(tmp_path), names=["n", "sep"])
    with pytest.raises(ValueError, match="cannot read"):
        read_dialects(spark, str(tmp_path / "none"))


def test_verified_tables_repair_commas_only_where_semicolons_part_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name;notation;label\nx;CC;1,5\ny;C;N/A\n")
    (tmp_path / "b.csv").write_text('label,name,notation\n2.5,z,"1,5"\n')
    got = verify_table(spark, str(tmp_path), dialects=True)
    assert sorted((r.name, r.notation, r.label) for r in got.rows.collect()) == [("x", "CC", 1.5), ("z", "1,5", 2.5)]
    assert got.separator == ",;"


def test_a_mode_over_a_folder_of_dialects(spark, tmp_path):
    rows = [(f"m{i}", "C" * (i % 5 + 1) + "O", i / 2) for i in range(20)] + [("bad", "C1CC", 1.0)]
    one, many = tmp_path / "one", tmp_path / "many"
    one.mkdir(), many.mkdir()
    (one / "in.csv").write_text("name,notation,label\n" + "".join(f"{n},{s},{v}\n" for n, s, v in rows))
    (many / "a.csv").write_text("name;notation;label\n" + "".join(f"{n};{s};{str(v).replace('.', ',')}\n" for n, s, v in rows[::2]) + "too;many;1;x\n")
    (many / "b.csv").write_text("label,name,notation\n" + "".join(f"{v},{n},{s}\n" for n, s, v in rows[1::2]))
    got, want = build_matrix(spark, str(many), "FP", n_bits=64, dialects=True), build_matrix(spark, str(one), "FP", n_bits=64)
    assert sorted(map(repr, got.matrix.collect())) == sorted(map(repr, want.matrix.collect()))
    assert [r.name for r in got.errors.collect()] == ["bad"] and [r.raw for r in got.rejects.collect()] == ["too;many;1;x"]
