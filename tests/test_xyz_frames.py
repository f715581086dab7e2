"""XYZ files of many frames in byte ranges against a reader of whole files."""

import random

import pytest

from molspark.sources.xyz_frames import count_lines, first_states, read_frames, read_xyz_frames

SMALL = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def digits(line):
    return line.strip(" \t\r").isdigit()


def plain(text, stem):
    """Frames of a whole file, line by line."""
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    frames, before, comment = [], [], False
    for line in lines:
        comment = digits(line) and not comment
        if comment:
            frames.append([line])
        else:
            (frames[-1] if frames else before).append(line)
    out = {(stem, k, "\n".join(x)) for k, x in enumerate(frames)}
    return out | ({(None, -1, "\n".join(before))} if before else set())


def atom(r):
    return f"{r.choice('CHON')} {r.uniform(-9, 9):.4f} {r.uniform(-9, 9):.3f} {r.uniform(-9, 9):.2f}"


def test_count_lines():
    assert count_lines([0, 1, 2, 3, 7], 9, False) == ([0, 2, 7], False)
    assert count_lines([0, 1, 2], 3, True) == ([1], False)
    assert count_lines([], 0, True) == ([], True) and count_lines([4], 5, False) == ([4], True)


def test_ranges_against_whole_files(spark, tmp_path, small_ranges):
    r = random.Random(5)
    want = set()
    for f in range(6):
        lines = ["junk before", ""] if f == 4 else []
        for _ in range(60):
            n = r.choice([0, 1, 2, 3, 5, 40])
            # Comments of digits, blank ones, runs of digits across borders, wrong counts.
            lines += [r.choice(["{}", " {}\t", "{}\r"]).format(n), r.choice(["7", "", "12", "a comment", "0"])]
            lines += [atom(r) for _ in range(n + r.choice([0, 0, 0, 1]))] + [""] * r.choice([0, 0, 1])
        text = "\n".join(lines) + ("\n" if f % 2 else "")
        (tmp_path / f"part+{f} %.xyz").write_text(text, newline="")
        want |= plain(text, f"part+{f} %")
    (tmp_path / "empty.xyz").write_text("")
    states = first_states(spark, str(tmp_path))
    assert len(states) > 60 and any(after for _, after in states.values())
    got = read_frames(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_molecules_atoms_failures(spark, tmp_path, small_ranges):
    good = "2\nCO unique_id:a charge:-1 multiplicity:2\nC 0 0 0\nO 0 0 1.5\n"
    (tmp_path / "one.xyz").write_text(good)
    (tmp_path / "many.xyz").write_text(
        good.replace(":a", ":b") + "3\nshort\nC 0 0 0\n" + "1\n2\nH 1 2 3\n\n" + "1\nbad\nH 1 x 3\n" + good.replace(":a", ":c")
        + "300\nlarge\n" + "C 1 1 1\n" * 300)
    (tmp_path / "none.xyz").write_text("no frame at all\n")
    m, a, f = read_xyz_frames(spark, str(tmp_path))
    mols = {x.unique_id: (x.charge, x.multiplicity, x.num_atoms) for x in m.collect()}
    assert mols == {"one": (-1, 2, 2), "many": (-1, 2, 2), "many#2": (0, 1, 1), "many#4": (-1, 2, 2), "many#5": (0, 1, 300)}
    assert {(x.unique_id, x.atom_idx) for x in a.collect()} == {(i, k) for i, v in mols.items() for k in range(v[2])}
    assert sorted((x.unique_id or "", x.reason) for x in f.collect()) == [
        ("", "lines without a count line"), ("many#1", "1 atom lines, 3 announced"), ("many#3", "malformed atom line")]
    ids = {x.unique_id for x in read_xyz_frames(spark, str(tmp_path), id_from="comment")[0].collect()}
    assert {"a", "b", "c"} <= ids and len(ids) == 5


def test_charge_column(spark, tmp_path, small_ranges):
    """Atoms with a fifth column of partial charges, frame by frame."""
    frames = [f"3\nframe {k}\nC 0 0 0 {0.4 + k % 2}\nO 0 0 1 -0.3\nH 1 0 0 0.2\n" for k in range(40)]
    (tmp_path / "q.xyz").write_text("".join(frames) + "1\nrow too short\nC 0 0 0 \n2\nx\nC 0 0 0 1.0\nC 0 0 1 2.0 3\n")
    m, a, f = read_xyz_frames(spark, str(tmp_path / "q.xyz"), mode="tokens", charge_col_idx=4)
    got = {x.unique_id: x.charge for x in m.collect()}
    assert {k: got["q" if k == 0 else f"q#{k}"] for k in range(40)} == {k: k % 2 for k in range(40)}
    assert got["q#40"] == 0 and got["q#41"] == 3 and f.count() == 0
    assert {x.partial_charge for x in a.where("element = 'O'").collect()} == {-0.3}
