import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from molspark.llm import collocations as co


def brute(docs, least, top):
    counts, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            counts.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    cand = {x: c for x, c in counts.items() if len(x[1]) > 1 and c >= least}
    gone = {(lang, w[i:i + k]) for (lang, w), c in cand.items() for k in range(2, len(w)) for i in range(len(w) - k + 1)
            if 100 * c >= 100 * cand[lang, w[i:i + k]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) in gone:
            continue
        n = total[lang]
        score, k = min((1000 * a * n // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]], n, k))
    return [(lang, i + 1, p.decode(), -a, l, r, n, -s, k) for lang, rows in out.items()
            for i, (s, a, p, l, r, n, k) in enumerate(sorted(rows)[:top])]


def corpus():
    r = random.Random(12)
    words = ["a", "b", "c", "The", "new", "york", "\x01", "ünï", "x y", "ÉA"]
    out = []
    for lang in ("en", "de", None):
        for _ in range(60):
            text = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t ", ". ", "\n", "\x0b", "!"]) for _ in range(r.randint(0, 60)))
            out.append((lang, text + " of New York City" * r.randint(0, 2)))
    return out + [("en", None), ("en", ""), (None, None), ("fr", "..."), ("en", "b " * 30_000), out[0], out[0]]


@pytest.mark.parametrize("bits,parts,hot", [(24, 3, 1024), (14, 40, 0), (20, 7, 1 << 40)])
def test_against_brute_force(spark, monkeypatch, bits, parts, hot):
    monkeypatch.setattr(co, "HOT", hot)
    docs = corpus()
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("w", F.lit(1)).withColumn("f", F.lit(1)).repartition(5)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:  # many ranges, so that phrases are torn at their borders
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted(map(tuple, co.collocations(df, co.Params(least=8, top=200, bits=bits)).collect()))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    want = sorted(brute(docs, 8, 200))
    assert len(want) > 150 and got == want


def test_products_beyond_64_bits(spark):
    rows = [("en", ["a", "b"], 3 * 10**12), ("en", ["a"], 4 * 10**12), ("en", ["b"], 5 * 10**12), ("en", [], 9 * 10**15)]
    df = spark.createDataFrame(rows, "lang string, w array<string>, f bigint")
    import unittest.mock as mock
    with mock.patch.object(co, "phrase_counts", lambda *a, **k: df):
        r = co.collocations(df).first()
    assert r.score == 1000 * 3 * 10**12 * 9 * 10**15 // (20 * 10**24)


def test_no_words(spark):
    df = spark.createDataFrame([("en", None), (None, "")], "lang string, text string")
    assert co.collocations(df).count() == 0 and co.collocations(df.limit(0)).count() == 0


def test_longest_is_bounded(spark):
    with pytest.raises(ValueError):
        co.collocations(spark.createDataFrame([], "lang string, text string"), co.Params(longest=6))
