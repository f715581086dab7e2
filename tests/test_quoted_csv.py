"""Splittable quoted CSV against Python's csv module on the whole file."""

import csv
import io
import random
import time

import pytest
from pyspark.sql import functions as F

from molspark.operators.merge import combine_batches, numeric_columns
from molspark.sources.files import header_groups, read_batch_csv
from molspark.sources.quoted_csv import ends_inside, first_states, read_quoted_csv

SMALL = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b"}


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(r):
    kind = r.random()
    if kind < 0.2:
        return ""
    if kind < 0.5:
        return str(r.randint(0, 99999))
    text = "".join(r.choice(['"', ",", "\n", "\n\n", "a", "é", " ", "b,c", '""', "x" * 30, "\r\n"]) for _ in range(r.randint(1, 12)))
    return text + "." if text.strip('"') == "" else text


def write(path, rows, header, end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(header)
    w.writerows(rows)
    path.write_bytes(out.getvalue().encode())
    return out.getvalue()


def parsed(text):
    return sorted(tuple(c or None for c in row) for row in list(csv.reader(io.StringIO(text, newline="")))[1:] if row)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_ranges_cut_anywhere(spark, tmp_path, small_ranges, seed, end):
    r = random.Random(seed)
    header, want, paths = ["id", "note", "v"], [], []
    for f in range(3):
        p = tmp_path / f"f{f}.csv"
        text = write(p, [(i, cell(r), cell(r)) for i in range(1, 150)], header, end)
        want += parsed(text)
        paths.append(str(p))
    firsts, torn = first_states(spark, paths)
    assert len(firsts) > 20 and any(v is not None for v in firsts.values()) and torn
    got = read_quoted_csv(spark, paths, header)
    assert got.rdd.getNumPartitions() >= 8
    rows = got.collect()
    assert sorted(map(repr, [(x.id, x.note, x.v) for x in rows])) == sorted(map(repr, want))
    assert {x._file.rsplit("/", 1)[1] for x in rows} == {"f0.csv", "f1.csv", "f2.csv"}


def test_torn_files_among_others(spark, tmp_path):
    """Without settings the size of ranges follows from all files together."""
    paths = []
    for f in range(3):
        p = tmp_path / f"f{f}.csv"
        write(p, [(i, "x" * 50) for i in range(20_000)] if f else [(1, "a"), (2, "line\n" * 400_000)], ["id", "v"])
        paths.append(str(p))
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        rows = read_quoted_csv(spark, paths, ["id", "v"])
        assert rows.count() == 40_002 and rows.where("length(v) = 2000000").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_cell_longer_than_many_ranges(spark, tmp_path, small_ranges):
    p = tmp_path / "long.csv"
    block = "line, with \"quotes\"\n" * 2000
    write(p, [(1, "a"), (2, block), (3, "b"), (4, block + "x")], ["id", "v"])
    got = {r.id: r.v for r in read_quoted_csv(spark, [str(p)], ["id", "v"]).collect()}
    assert got == {"1": "a", "2": block, "3": "b", "4": block + "x"}


def test_odd_records(spark, tmp_path):
    p = tmp_path / "odd.csv"
    p.write_text('id,v,w\n1,5" pipe,a"b\n2\n3,x,y,z\n\n4,"",\n5,"q\nr",t\n6,"never closed\nto the end')
    got = sorted(((r.id, r.v, r.w) for r in read_quoted_csv(spark, [str(p)], ["id", "v", "w"]).collect()))
    assert got == [("1", '5" pipe', 'a"b'), ("2", None, None), ("3", "x", "y"), ("4", "", None), ("5", "q\nr", "t"),
                   ("6", "never closed\nto the end", None)]


@pytest.mark.parametrize("line,inside,want", [
    ("", False, False), ("", True, True), ('a,"b', False, True), ('a,"b""', False, True), ('a,"b"""', False, False),
    ('a,5" x', False, False), ('5" pipe,"open', False, True), ('x",y', True, False), ('x","y', True, True), ('x""', True, True),
    ('"a"b"c,d', False, False), ('"', False, True), ('"', True, False), ('""', False, False)])
def test_line_states(line, inside, want):
    assert ends_inside(line, inside) is want


def test_long_lines_are_read_once():
    line = '"' + 'a""' * 300_000 + 'b'
    t0 = time.time()
    assert ends_inside(line, False) and not ends_inside(line + '"', False) and ends_inside(',"' * 200_001, False)
    assert time.time() - t0 < 5


def test_files_whose_lines_are_records_stay_with_the_csv_source(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,"x, ""y"""\n2,5" z\n')
    (tmp_path / "b.csv").write_text('id,v\n1,"x\ny"\n')
    (tmp_path / "c.csv").write_bytes(b'id,v\r\n1,x\r\n2,"m\rn"\r\n')
    (header, plain, spanning), = header_groups(spark, [str(tmp_path / f"{n}.csv") for n in "abc"])
    assert (header, [f[-5:] for f in plain], [f[-5:] for f in spanning]) == ("id,v", ["a.csv"], ["b.csv", "c.csv"])
    got = {(r._file[-5:], r.id): r.v for r in read_batch_csv(spark, header, plain, spanning).collect()}
    assert got == {("a.csv", "1"): 'x, "y"', ("a.csv", "2"): '5" z', ("b.csv", "1"): "x\ny", ("c.csv", "1"): "x", ("c.csv", "2"): "m\rn"}


def test_votes_take_the_first_values_of_the_whole_file(spark, tmp_path, small_ranges):
    d = tmp_path / "run" / "batch_0"
    d.mkdir(parents=True)
    # v: its first ten values lie far apart; the eleventh is no number. w: the tenth is none.
    rows = [(f"{i:05d}", "n\n1" * 9, "" if i % 40 else "7" if i < 400 else "n/a", "" if i % 40 else "7" if i < 360 else "n/a")
            for i in range(800)]
    write(d / "molecule_property.csv", rows, ["unique_id", "note", "v", "w"])
    df = combine_batches(spark, str(tmp_path / "run"), "molecule_property.csv", keep_internal=True)
    assert (dict(df.dtypes)["v"], dict(df.dtypes)["w"]) == ("double", "string")
    assert df.count() == 800 and df.where("v is not null").count() == 10
    assert numeric_columns(df.limit(0)).count() == 0
