"""Logical records over the splits of a file, against the reader that keeps a file in one task."""

import random

import pytest

from featureloom import malformed_records, read_delimited, verify_table

CELLS = ["a", "", "x y", '5" pipe', 'q"', '""', '"plain"', '"with, sep"', '"line\nbreak"', '"two\n\nbreaks ""quoted"" here"', '"\n"', '"ends\n"" "', "é"]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def put(folder, seed):
    rng = random.Random(seed)
    rows = [",".join(rng.choice(CELLS) for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) for _ in range(600)]
    for i in range(2):
        (folder / f"f{i}.csv").write_text("h1,h2,h3\n" + "\n".join(rows[i::2]) + "\n\n", encoding="utf-8")
    return str(folder)


def test_records_of_split_files_are_those_of_whole_ones(small_splits, tmp_path):
    path = put(tmp_path, 4)
    assert small_splits.read.text(path).rdd.getNumPartitions() > 4
    order = lambda r: (r.ord.path, r.ord.id)
    split = sorted(read_delimited(small_splits, path, multi_line="split").collect(), key=order)
    whole = sorted(read_delimited(small_splits, path, multi_line=True).collect(), key=order)
    assert [tuple(r)[:-1] for r in split] == [tuple(r)[:-1] for r in whole] and len(split) == 600
    bad = [sorted(map(tuple, malformed_records(small_splits, path, multi_line=how).collect())) for how in ("split", True)]
    assert bad[0] == bad[1] and bad[0]


def test_a_record_longer_than_splits_and_one_never_closed(small_splits, tmp_path):
    text = "\n".join(f"line {i}, and" for i in range(900))
    (tmp_path / "in.csv").write_text(f'a,b\n1,"{text}"\n2,x\n3,"open\nto the end\n4,y\n')
    rows = sorted(read_delimited(small_splits, str(tmp_path), multi_line="split").collect(), key=lambda r: r.ord.id)
    assert [(r.ord.id, r.a, r.b) for r in rows[:2]] == [(2, "1", text), (3, "2", "x")] and len(rows) == 3
    assert rows[2].ord.id == 4 and rows[2].a == "3"


def test_other_headers_fail_and_tables_are_verified(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('n;s;l\nx;"C\nC";1,5\n')
    got = verify_table(small_splits, str(tmp_path), multi_line="split").rows.collect()
    assert [(r.name, r.notation, r.label) for r in got] == [("x", "C\nC", 1.5)]
    (tmp_path / "b.csv").write_text("n;l;s\ny;1;C\n")
    with pytest.raises(Exception, match="another header"):
        read_delimited(small_splits, str(tmp_path), multi_line="split").collect()


def test_record_numbers_run_on_over_files_of_bounded_rows(small_splits, monkeypatch):
    """No task writes the whole table into one file; the rows are those of one file all the same."""
    from compare import compare, oracle_connection

    from featureloom.catalog import ORACLES, QUERIES, modes

    small_splits.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    written, read = [], modes.read_delimited
    monkeypatch.setattr(modes, "_FILE_ROWS", 37)
    monkeypatch.setattr(modes, "read_delimited", lambda spark, path, *a, **b: written.append(path) or read(spark, path, *a, **b))
    sf = "/root/testdata/sf0.001"
    equal, message, _ = compare(small_splits, oracle_connection(sf), sf, QUERIES["quoted_one_file"], ORACLES["quoted_one_file"])
    assert equal, message
    assert len(small_splits.read.text(written[0]).inputFiles()) > 3


def test_returns_in_fields_stay_and_end_records_outside(small_splits, tmp_path):
    """Line ends of all kinds: inside a field they are text, outside they end a record; the reader of whole files gives the same fields."""
    rng = random.Random(9)
    cells = ["a", "x y", '"two\rparts"', '"with\r\nboth"', '"\r"', '"ends\r\n"', '"plain ""q""\n\r\n"']
    rows = [",".join(rng.choice(cells) for _ in range(3)) for _ in range(400)]
    (tmp_path / "in.csv").write_bytes(("h1,h2,h3\n" + "\n".join(rows) + "\n").encode())
    split = sorted(read_delimited(small_splits, str(tmp_path), multi_line="split").collect(), key=lambda r: r.ord.id)
    whole = sorted(read_delimited(small_splits, str(tmp_path), multi_line=True).collect(), key=lambda r: r.ord.id)
    assert [tuple(r)[:-1] for r in split] == [tuple(r)[:-1] for r in whole] and len(split) == 400
    for end in ("\r\n", "\r"):
        other = tmp_path / f"ends{len(end)}"
        other.mkdir()
        (other / "in.csv").write_bytes(end.join(["n,s", '1,"a\nb"', "2,c", "", '3,"d\re"', ""]).encode())
        got = sorted(read_delimited(small_splits, str(other), ",", multi_line="split").collect(), key=lambda r: r.ord.id)
        assert [(r.ord.id, r.n, r.s) for r in got] == [(2, "1", "a\nb"), (3, "2", "c"), (4, "3", "d\re")]


def test_records_are_read_without_a_shuffle_of_their_text(small_splits, tmp_path):
    """Only lines at the edges of splits are exchanged; scans that no longer agree on the splits fail instead of losing rows."""
    from featureloom.sources.records import logical_records, record_starts

    path = put(tmp_path, 5)
    starts = record_starts(small_splits, path, ",")
    records = logical_records(small_splits, path, ",", starts)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") <= 2
    assert sum(r.records for r in starts.select("file", "records").distinct().collect()) == records.count()
    small_splits.conf.set("spark.sql.files.maxPartitionBytes", "900")
    with pytest.raises(Exception, match="splits have changed"):
        logical_records(small_splits, path, ",", starts).collect()


def test_quoted_one_file_on_odd_rows(small_splits, tmp_path, monkeypatch):
    """Empty texts, returns inside texts, rows without an id or a language, negative ids."""
    from compare import compare, oracle_connection

    from featureloom.catalog import ORACLES, QUERIES, modes

    rows = [(i, t, g) for i, (t, g) in enumerate([("", "en"), ("a\r\nb\rc", "de"), ("x\n\ny", None), (None, "fr"), ('"q"\r', "en"), ("\r\n", "es"), ("\n", "en")] * 5, -9)]
    rows = [*rows, (None, "no id\r\nat all", "en")]
    small_splits.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "t"))
    next((tmp_path / "t").glob("part-*.parquet")).rename(tmp_path / "documents.parquet")
    monkeypatch.setattr(modes, "_FILE_ROWS", 11)
    small_splits.conf.set("spark.sql.files.maxPartitionBytes", "60")
    for name in ("quoted_one_file", "quoted_records"):
        equal, message, n = compare(small_splits, oracle_connection(str(tmp_path)), str(tmp_path), QUERIES[name], ORACLES[name])
        assert equal, message
        assert n == (31 if name == "quoted_one_file" else 5)
