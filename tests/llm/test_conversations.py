import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from molspark.llm import conversations as cv
from molspark.llm import queries_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """(role, text, first fault) of ordered rows, by the contract."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(cv.BLANK_CHARACTERS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def legal(roles):
    s = "".join(r[:1] for r in roles)
    s = s[1:] if s[:1] == "s" and len(s) > 1 else s
    return len(s) % 2 == 0 and all(c == "ua"[i % 2] for i, c in enumerate(s))


def cheapest(rows):
    """Every way of editing, with up to two inserted turns in each place."""
    rows, best = faults(rows), None
    options = []
    for role, text, fault in rows:
        more = 5 if fault == "truncated" else 0
        one = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            one += [(more, "K", (role, text))] + [(1 + more, "R", (r, text)) for r in ("user", "assistant")]
        options.append(one)
    inserts = [()] + [x for n in (1, 2) for x in itertools.product(("user", "assistant"), repeat=n)]
    for edits in itertools.product(*options):
        base = sum(e[0] for e in edits)
        if best and base > best[0]:
            continue
        for places in itertools.product(inserts, repeat=len(rows) + 1):
            cost = base + 5 * sum(map(len, places))
            if best and cost > best[0]:
                continue
            audit, out = "", []
            for i, place in enumerate(places):
                audit += "I" * len(place)
                out += [(r, "") for r in place]
                if i < len(edits):
                    audit += edits[i][1]
                    out += [edits[i][2]] if edits[i][2] else []
            if legal([r for r, _ in out]) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
    return best


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations(n=60, most=4):
    r = random.Random(11)
    return {i: [(r.choice(["user", "assistant", "system", "tool", "user", "assistant"]),
                 r.choice(["a.", "b!", "c", " ", "d?", "", "é. \n", "f."])) for _ in range(r.randint(1, most))] for i in range(n)}


def test_against_every_repair(spark):
    data = conversations()
    df = spark.createDataFrame([(c, t, role, text) for c, rows in data.items() for t, (role, text) in enumerate(rows)], SCHEMA)
    got = {r.conv_id: r for r in cv.repair(df).collect()}
    assert len(got) == len(data)
    for c, rows in data.items():
        cost, audit, text = cheapest(rows)
        want = [f for _, _, f in faults(rows)]
        assert (got[c].cost, got[c].audit, got[c].repaired_sha256) == (cost, audit, sha(text)), rows
        assert [got[c][k] for k in ("blank", "duplicate", "truncated")] == [want.count(k) for k in ("blank", "duplicate", "truncated")]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
        assert got[c].illegal == sum(p not in ("su", "ua", "au") for p in pairs)


def test_repaired_turns_have_the_digest(spark):
    data = conversations(40, 12)
    df = spark.createDataFrame([(c or None, t, role, text) for c, rows in data.items() for t, (role, text) in enumerate(rows)], SCHEMA)
    fixed = cv.repair(df)
    turns = {}
    for r in cv.repaired_turns(df, fixed).orderBy("conv_id", "place").collect():
        rows = turns.setdefault(r.conv_id, [])
        assert r.place == len(rows)
        rows.append(f"{r.role}:{r.text}")
    for r in fixed.collect():
        assert r.repaired_sha256 == sha("\n".join(turns.get(r.conv_id, [])))


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_segments_change_nothing(monkeypatch, size):
    for seed, rows in conversations(80, 30).items():
        whole, parts = cv._Conversation(seed), cv._Conversation(seed)
        for t, (role, text) in enumerate(rows):
            whole.add(t, role, text)
        want = whole.result()
        monkeypatch.setattr(cv, "SEGMENT", size)
        for t, (role, text) in enumerate(rows):
            parts.add(t, role, text)
        assert parts.result() == want
        monkeypatch.undo()


def test_very_long_conversation(spark):
    n = 20_000
    df = (spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                F.concat(F.col("id").cast("string"), F.when(F.col("id") == 7, "").otherwise(F.lit("."))).alias("text")))
    r = cv.repair(df).first()
    # Row 7 cut: to keep it costs 5, to delete it and a neighbour 4; the earliest deletion is ASCII-least.
    assert (r.cost, r.truncated, r.illegal, r.gaps, len(r.audit)) == (4, 1, 0, 0, n)
    assert r.audit == "K" * 6 + "DD" + "K" * (n - 8)


def test_nulls_gaps_ties_and_dropped_rows(spark):
    rows = [(None, None, None, None, True), (None, 3, "user", "x.", True), (1, 5, "user", "x.", True), (1, 5, "user", "x.", True),
            (1, 9, "assistant", "y.", True), (2, 1, "user", "gone.", False), (3, None, "user", "a.", True),
            (4, 1, "user", "long " * 100_000 + ".", True), (4, 2, "assistant", "b.", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, present boolean") \
        .withColumn("conv", F.lit("clash")).withColumn("audit", F.lit("clash"))
    got = {r.conv_id: r for r in cv.repair(df, present=F.col("present")).collect()}
    assert len(got) == 5
    assert (got[None].blank, got[None].illegal, got[None].cost, got[None].audit) == (1, 1, 4, "DD")
    assert (got[1].gaps, got[1].duplicate, got[1].audit) == (3, 1, "KDK")
    assert (got[2].cost, got[2].audit, got[2].repaired_sha256, got[2].gaps) == (0, "", sha(""), 0)
    assert (got[3].gaps, got[3].audit) == (0, "D")
    assert got[4].audit == "D"


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cv.repair(df).count() == 0
    assert cv.repaired_turns(df, cv.repair(df)).count() == 0


def test_damage(spark):
    import zlib
    rows = [(c, t, "assistant", "a.b!c?") for c in range(30) for t in (None, 0, 1)] + [(None, None, None, None)]
    df = queries_repair.damaged(spark.createDataFrame(rows, SCHEMA))
    got = sorted(map(repr, map(tuple, df.collect())))
    want = []
    for c, t, role, text in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if f == 4 else role, "" if f == 1 else text.translate({33: None, 46: None, 63: None}) if f == 2 else text, f != 0)
        want += [row] * (2 if f == 3 else 1)
    assert got == sorted(map(repr, want))
