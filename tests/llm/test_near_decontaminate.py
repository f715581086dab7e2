import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from molspark.llm import decontaminate, near_duplicates
from molspark.llm.common import words
from molspark.llm.near_duplicates import Params


def shingle_set(text):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs, least=0.8):
    """{row: (class, links)} by comparing every pair."""
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(docs)
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= least * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (key, _) in enumerate(docs):
        groups[find(i)].append(key)
    return [(key, min(groups[find(i)]), links[i]) for i, (key, _) in enumerate(docs)]


def corpus(seed, n, copies, edits):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    docs = []
    for _ in range(n):
        base = [word() for _ in range(r.randint(3, 120))]
        docs.append(" ".join(base))
        for _ in range(r.randint(0, copies)):
            new = list(base)
            for _ in range(r.randint(0, edits)):
                new[r.randrange(len(new))] = word()
            docs.append(r.choice([" ".join(new), " ".join(new).upper(), ",  ".join(new)]))
    r.shuffle(docs)
    return [(i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed,n,copies,edits,params", [
    (1, 60, 4, 3, Params()), (2, 4, 60, 2, Params(tile=16, chunk=32)), (3, 2, 150, 4, Params(tile=32))])
def test_against_all_pairs(spark, seed, n, copies, edits, params):
    docs = corpus(seed, n, copies, edits) + [(9001, None), (9002, ""), (9003, "?! ."), (9004, "one"), (9005, "One!")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, near_duplicates.near_duplicates(df, params=params).collect()))
    assert got == sorted(brute(docs))


def test_group_over_many_tasks(spark):
    """A third of all rows near copies of one text, plus exact copies, in many partitions."""
    docs = corpus(5, 1, 220, 3) + [(10_000 + i, t) for i, t in corpus(6, 120, 1, 1)] + [(20_000 + i, "same text " * 9) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(17)
    got = sorted(map(tuple, near_duplicates.near_duplicates(df, params=Params(tile=64)).collect()))
    assert got == sorted(brute(docs))


def test_repeated_rows_null_keys_clashes_and_nothing(spark):
    long = "very " * 50_000 + "long"
    rows = [(1, "a b c d e f g", 1), (1, "a b c d e f g", 1), (None, "a b c d e f g", 1), (7, long, 1), (5, long, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int")
    got = sorted(((r.doc_id or 0), r.class_id, r.n_links) for r in near_duplicates.near_duplicates(df).collect())
    assert got == [(0, 1, 2), (1, 1, 2), (1, 1, 2), (5, 5, 1), (7, 5, 1)]
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0


def test_no_link_is_lost_where_the_forest_finds_nothing(spark):
    """One tree of whole labels, and texts that share a common line; chunks are small."""
    line = "a line that all of the texts of this table hold and more"
    docs = [(i, f"{t} {line}") for i, t in corpus(11, 40, 4, 4)] + [(5000, line), (5001, line.upper()), (5002, "one"), (5003, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for weak in (Params(trees=1, recall=0.0), Params(trees=1, recall=0.0, counted=200, tile=8)):
        assert sorted(map(tuple, near_duplicates.near_duplicates(df, params=weak).collect())) == sorted(brute(docs))


def test_stop_depth_follows_the_recall():
    assert Params().stop == 5 and Params(recall=0.9).stop > 5 and Params(trees=64).stop > 5
    assert Params(recall=1.1).stop == 1


def test_components_of_a_long_chain(spark):
    key = F.lpad(F.col("id").cast("string"), 6, "0").cast("binary")
    chain = spark.range(600).select(key.alias("node"), F.lpad((F.col("id") + 1).cast("string"), 6, "0").cast("binary").alias("other"))
    got = near_duplicates.connected_components(chain)
    assert got.count() == 601 and got.select("component").distinct().count() == 1
    assert bytes(got.head().component) == b"000000"


# --- decontamination ---------------------------------------------------------

WORDS = "alpha bravo carbon delta ember falcon garnet harbor indigo jasper kernel lumen meadow nectar orbit pepper quartz ripple saffron timber umbra velvet walnut xenon yonder zephyr".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ing", "ed", "ly"]) + str(r.randint(0, 40)) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(9)
    items = [(i, " ".join(sentence(r, r.randint(8, 14)) for _ in range(r.randint(2, 4)))) for i in range(30)]
    filler = lambda: " ".join(sentence(r, 12) for _ in range(r.randint(1, 30)))
    docs, truth = [], set()
    for d in range(200):
        text = filler()
        if d % 4 == 0:
            i = r.randrange(30)
            truth.add((d, i))
            text = f"{filler()} {items[i][1]} {filler()}"
        elif d % 4 == 1:  # a paraphrase: one word in five replaced, the answer kept
            i = r.randrange(30)
            head, _, answer = items[i][1][:-1].rpartition(". ")
            head = " ".join(w if k % 5 else "changed" for k, w in enumerate(head.split()))
            truth.add((d, i))
            text = f"{filler()} {head.upper()}. {answer}. {filler()}"
        elif d % 4 == 2:  # half an item without its answer is no leak
            text += " " + " ".join(items[0][1].split()[:12])
        docs.append((d, text))
    return items, docs, truth


def test_planted_leaks(spark, planted):
    items, docs, truth = planted
    bench = spark.createDataFrame(items + [(90, None), (91, ""), (92, "too short")], "item_id long, text string")
    df = spark.createDataFrame(docs + [(900, None), (901, "")], "doc_id long, text string").repartition(6)
    got = decontaminate.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == truth
    assert all(0 < r.cosine <= 1 and r.lcs_share >= 0.5 for r in got)
    kept = decontaminate.clean(df, bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in truth} | {900, 901}


def test_search_finds_what_all_windows_against_all_items_find(spark, planted):
    items, docs, _ = planted
    params = decontaminate.Params()
    hashes = {i: words(t)[0] for i, t in items}
    answers = {i: decontaminate.answer_words(t, None) for i, t in items}

    def held(text, i):
        at, item = words(text)[0], hashes[i]
        reach = len(item) + params.width
        for begin in range(0, max(1, len(at) - params.width + params.stride), params.stride):
            region = at[max(0, begin - reach):begin + params.width + reach]
            share = decontaminate.common_words(item, region) / len(item)
            answer = decontaminate.common_words(answers[i], region) / len(answers[i])
            if share >= params.copied or share >= params.paraphrased and answer >= params.answered:
                return True
        return False

    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs[:80], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(d, i) for d, t in docs[:80] for i, _ in items if held(t, i)}


def test_directions_keep_their_share_of_every_row():
    rng = np.random.default_rng(2)
    latent = rng.standard_normal((30, 12)) * np.linspace(3, 0.1, 12)
    latent[4] = 0
    size = decontaminate.directions(latent, 0.8)
    share = (latent[:, :size] ** 2).sum(1) / np.maximum((latent ** 2).sum(1), 1e-12)
    assert size < 12 and np.delete(share, 4).min() >= 0.8
    shorter = (latent[:, :size - 1] ** 2).sum(1) / np.maximum((latent ** 2).sum(1), 1e-12)
    assert np.delete(shorter, 4).min() < 0.8


def test_blocks_of_the_benchmark_change_nothing(spark, planted):
    items, docs, truth = planted
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.contaminated(df, bench, params=decontaminate.Params(block=20))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == truth


def test_given_answers(spark):
    question = "Which of the harbor stones was carved by the northern mason in the eleventh winter of the long siege"
    bench = spark.createDataFrame([("q", question, "the basalt lion")], "item_id string, text string, answer string")
    worse = " ".join(w if k % 3 else "other" for k, w in enumerate(question.split()))
    filler = [(f"f{i}", f"filler text number {i} says that nothing of it matters here at all") for i in range(40)]
    df = spark.createDataFrame([("with", worse + ", it was the basalt lion"), ("without", worse + ", nobody knows"), *filler],
                               "doc_id string, text string")
    got = decontaminate.contaminated(df, bench, answer="answer").collect()
    assert [r.doc_id for r in got] == ["with"]


def test_quote_before_the_copy(spark):
    """A short exact quote, then far behind it the item with words replaced."""
    r = random.Random(3)
    items = [(i, " ".join(sentence(r, 12) for _ in range(5))) for i in range(6)]
    filler = lambda n: " ".join(sentence(r, 12) for _ in range(n))
    quote = " ".join(items[2][1].split()[:24])
    copy = " ".join(w if k % 6 else "changed" for k, w in enumerate(items[2][1].split()))
    docs = [(1, f"{filler(2)} {quote} {filler(30)} {copy} {filler(4)}"), (2, f"{copy} {filler(30)} {quote}"),
            (3, f"{filler(30)} {quote} {filler(30)} {quote}"), *[(10 + i, filler(20)) for i in range(20)]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 2), (2, 2)}
    assert {r.doc_id for r in decontaminate.clean(df, bench).collect()} == {d for d, _ in docs} - {1, 2}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x y z")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert decontaminate.contaminated(docs.limit(0), some).count() == 0
    assert decontaminate.clean(docs, bench).count() == 1


def test_svd_against_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(sorted(rng.choice(40, 6, replace=False).tolist()), rng.random(6).tolist()) for _ in range(25)]
    dense = np.zeros((25, 40))
    for i, (f, w) in enumerate(rows):
        dense[i, f] = w
    df = spark.createDataFrame(rows, "features array<int>, weights array<double>").repartition(4)
    basis, values = decontaminate.randomised_svd(df, np.arange(40), 25, 3)
    assert np.allclose(values, np.linalg.svd(dense)[1], atol=1e-6)
    assert np.allclose((dense @ basis) @ basis.T, dense, atol=1e-6)


def test_common_words_against_table():
    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.randint(0, 5) for _ in range(r.randint(1, 90))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert decontaminate.common_words(np.array(a, np.uint64), np.array(b, np.uint64)) == row[-1]


def test_rows_without_key_keep_their_links(spark):
    text = [f"word{i}" for i in range(60)]
    rows = [(1, " ".join(text)), (None, " ".join(text + ["a", "b"])), (None, " ".join(text + ["c"])),
            (None, " ".join(text + ["c"])), (2, "something else that is not like any other text here")]
    out = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r.doc_id or 0, r.class_id, r.n_links) for r in out.collect())
    assert got == [(0, 1, 3), (0, 1, 3), (0, 1, 3), (1, 1, 3), (2, 2, 0)]


def test_a_pair_at_the_threshold_is_missed_less_than_once_in_ten_million():
    p = near_duplicates.near_duplicates.__defaults__[-1]
    assert (1 - p.similarity ** p.stop) ** p.trees < 1e-7


def test_frequencies_reach_the_driver_as_columns(spark, monkeypatch):
    """A row object for each of 2^18 features took 120 MB of the driver's Python."""
    import numpy as np

    from molspark.llm import decontaminate
    docs = spark.createDataFrame([("a b b",), ("b c",), (None,), ("b",)], "text string").repartition(3)

    def rows(self):
        raise AssertionError("collected by rows")

    for name in ("toPandas", "collect"):
        monkeypatch.setattr(type(docs), name, rows)
    params = decontaminate.Params()
    held, n = decontaminate.document_frequencies(docs, "text", params)
    at = [int(words(w)[0][0] & np.uint64(params.features - 1)) for w in "abc"]
    assert n == 4 and held[at].tolist() == [1, 3, 1] and held.sum() == 5
